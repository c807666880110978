"""Toxicity: a subsequence-kernel support vector machine with Nystrom landmarks.

The kernel between two strings counts the letter triples they share as
subsequences, each weighted by DECAY^(letters it spans), so 'idxiot' and
'idi--ot' stay near 'idiot' while unrelated words share little. A text's units
are its words (case, digits for letters and punctuation folded away)
and runs of spaced-out single letters; a document is judged by its worst
units: the largest margin, the mean of the largest three, and how many are
positive.

Labels belong to documents, not to the sentences that earn them, so training is
multiple-instance: each toxic document contributes its currently worst units as
positives, clean documents contribute units as negatives, and the two steps
alternate. The machine is linear over Nystrom features of landmark units; since
the kernel is a dot product of triple weights, landmarks and coefficients fold
into one weight per triple, which is all that scoring needs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import fold_of, text_of

TRAIN_DOCS = 1500            # labelled documents of each class in the training sample
TRAIN_DOC_BYTES = 16384      # and their largest size
HELD_OUT_FOLD = 0
DECAY = 0.75
LETTERS = 36                 # a-z and ten classes of other letters
LONGEST = 24                 # letters of a unit; longer words are taken in overlapping windows
LANDMARKS = 300
NEGATIVES = 8000
ROUNDS = 4
CHANCE = 0.98                # quantile of surprise under shuffled labels that a witness must exceed
COST = 5.0
SEED = 7
MAX_CACHED = 600_000
SILENT = -3.0                # margin of a text without units

#: Signs that stand for letters inside words.
STAND_INS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"})
SPACED = re.compile(rb"(?<!\S)(?:\S[ ]){2,}\S(?!\S)")
SENTENCE = re.compile(r"[.!?\n]+")


# --- units ---------------------------------------------------------------------

def units_of(token: bytes) -> list[str]:
    """The folded letters of a token, in windows of at most LONGEST; none if it has no letter."""
    word = token.decode("utf-8", "replace").lower()
    if not word.isalpha():
        core = word.strip(".,;:!?\"'()[]{}-_*")
        if not any(c.isalpha() for c in core):
            return []
        word = "".join(c for c in core.translate(STAND_INS) if c.isalpha())
    if len(word) <= LONGEST:
        return [word]
    step = LONGEST // 2
    return [word[i:i + LONGEST] for i in range(0, len(word) - step, step)]


def tokens_of(text: bytes) -> list[bytes]:
    """Words, and runs of spaced-out single signs joined to one."""
    return text.split() + [m.replace(b" ", b"") for m in SPACED.findall(text)]


def codes(words: list[str]) -> np.ndarray:
    """Words of one length as letter codes."""
    points = np.array(words, dtype=f"U{len(words[0])}").view(np.uint32).reshape(len(words), -1).astype(np.int64)
    ascii_ = (points >= 97) & (points <= 122)
    return np.where(ascii_, points - 97, 26 + points % (LETTERS - 26))


_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all subsequences of three letters, and their weights."""
    if length not in _TRIPLES:
        at = np.array(list(combinations(range(length), 3)), dtype=np.int64).reshape(-1, 3)
        _TRIPLES[length] = at, (DECAY ** (at[:, 2] - at[:, 0] + 1)).astype(np.float32)
    return _TRIPLES[length]


def features(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triple numbers (n x triples) and weights of words of one length."""
    at, weight = triples(c.shape[1])
    return (c[:, at[:, 0]] * LETTERS + c[:, at[:, 1]]) * LETTERS + c[:, at[:, 2]], weight


def self_kernel(c: np.ndarray) -> np.ndarray:
    """k(x, x) by the dynamic program over aligned end positions, for words of one length."""
    n, length = c.shape
    equal = [[(c[:, a] == c[:, b]).astype(np.float32) * DECAY**2 for b in range(length)] for a in range(length)]
    ends = equal
    for _ in range(2):
        zero = np.zeros(n, np.float32)
        sums = [[zero] * (length + 1) for _ in range(length + 1)]
        fresh = [[zero] * length for _ in range(length)]
        for a in range(1, length):
            for b in range(1, length):
                sums[a][b] = ends[a - 1][b - 1] + DECAY * (sums[a - 1][b] + sums[a][b - 1]) - DECAY**2 * sums[a - 1][b - 1]
                fresh[a][b] = equal[a][b] * sums[a][b]
        ends = fresh
    return sum((x for row in ends for x in row), np.zeros(n, np.float32))


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, where in groups.items():
        if length >= 3:
            step = max(1, 1_000_000 // max(1, len(triples(length)[1])))
            for at in range(0, len(where), step):
                some = where[at:at + step]
                yield np.array(some), [words[i] for i in some]


def project(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Dot products of the normalised features with columns of ``weights`` (triples x m)."""
    out = np.zeros((len(words), weights.shape[1]), np.float32)
    for where, some in by_length(words):
        c = codes(some)
        numbers, weight = features(c)
        norm = np.sqrt(np.maximum(self_kernel(c), 1e-12))[:, None]
        for j in range(weights.shape[1]):
            out[where, j] = weights[:, j][numbers] @ weight
        out[where] /= norm
    return out


def landmark_features(words: list[str]) -> np.ndarray:
    """Normalised triple weights of each landmark (triples x landmarks)."""
    out = np.zeros((LETTERS**3, len(words)), np.float32)
    for where, some in by_length(words):
        numbers, weight = features(codes(some))
        for j, row in zip(where, numbers):
            np.add.at(out[:, j], row, weight)
    out /= np.maximum(np.sqrt(np.einsum("ij,ij->j", out, out)), 1e-6)
    return out


# --- the machine ------------------------------------------------------------------

def squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> np.ndarray:
    """Primal Newton steps for an L2-regularised squared-hinge machine; the last column of x is the bias."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        inside = y * (x @ w) < 1
        xi = x[inside] * np.sqrt(weight[inside, None])
        new = np.linalg.solve(ridge + cost * xi.T @ xi, cost * xi.T @ (y[inside] * np.sqrt(weight[inside])))
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def fit_machine(positive: list[str], negative: list[str], weight: np.ndarray, landmarks: list[str]) -> tuple[np.ndarray, float]:
    """(weights per triple, bias) of the machine on Nystrom features of the landmarks."""
    z = landmark_features(landmarks)
    gram = (z.T @ z).astype(float)
    values, vectors = np.linalg.eigh(gram)
    use = values > 1e-4 * values.max()
    root = vectors[:, use] / np.sqrt(values[use])                # gram^(-1/2) on its range
    x = np.ones((len(positive) + len(negative), root.shape[1] + 1))
    np.matmul(project(positive + negative, z), root, out=x[:, :-1])
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    w = squared_hinge(x, y, weight, COST)
    return (z @ (root @ w[:-1])).astype(np.float32)[:, None], float(w[-1])


def summary(margins: list[float]) -> list[float]:
    """A document's evidence: largest margin, mean of the largest three, log of one plus the positive ones."""
    top = sorted(margins, reverse=True)[:3] + [SILENT] * 3
    return [top[0], sum(top[:3]) / 3, float(np.log1p(sum(m > 0 for m in margins)))]


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Platt scaling with his smoothed targets: coefficients and, last, the offset; none is negative but the offset."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    d = np.hstack([x, np.ones((len(x), 1))])
    a, use = np.zeros(d.shape[1]), np.ones(d.shape[1], bool)
    ridge = np.diag([0.05] * x.shape[1] + [1e-4])
    while True:
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(d @ a, -30, 30)))
            h = ((d * (p * (1 - p))[:, None]).T @ d + ridge)[np.ix_(use, use)]
            step = np.linalg.solve(h, (d.T @ (p - target) + ridge @ a)[use])
            a[use] -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-7:
                break
        wrong = use & (a < 0) & (np.arange(len(a)) < x.shape[1])
        if not wrong.any():
            return a
        a[wrong], use[wrong] = 0, False


def grams_of(words: set[str]) -> set[str]:
    """Letter runs of 4 and 5."""
    return {w[i:i + n] for w in words for n in (4, 5) for i in range(max(1, len(w) - n + 1))}


def surprise(docs: list[set[str]], toxic: np.ndarray) -> dict[str, float]:
    """Log-likelihood ratio of letter runs for toxic documents: where to start looking."""
    pos, neg = Counter(), Counter()
    for words, t in zip(docs, toxic):            # a document's runs are not kept: they are many
        (pos if t else neg).update(grams_of(words))
    n_pos, n_neg = max(1, toxic.sum()), max(1, (~toxic).sum())
    out = {}
    for g, a in pos.items():
        b = neg.get(g, 0)
        rate = (a + b) / (n_pos + n_neg)
        if a > 1 and a / n_pos > b / n_neg:
            g2 = a * np.log(a / n_pos / rate) + (b * np.log(b / n_neg / rate) if b else 0)
            out[g] = float(g2)
    return out


class Model:
    """Weights per triple, bias, and the coefficients that turn a document's evidence into a probability."""

    def __init__(self, weights: np.ndarray, bias: float, scale: np.ndarray):
        self.weights, self.bias, self.scale = weights, bias, scale

    def margins(self, words: list[str]) -> np.ndarray:
        return project(words, self.weights)[:, 0] + self.bias

    def probability(self, margins: list[float]) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.scale, [*summary(margins), 1.0]), -30, 30))))


def constant(share: float) -> Model:
    """The model of a sample with nothing to tell its classes apart."""
    odds = np.log(share / (1 - share)) if 0 < share < 1 else 4.0 if share else -4.0
    return Model(np.zeros((LETTERS**3, 1), np.float32), 0.0, np.array([0, 0, 0, odds]))


def fit(texts: list[bytes], labels: list[int]) -> Model:
    """Multiple-instance training on labelled texts; every fourth is kept to scale the margins by."""
    toxic = np.array(labels, bool)
    if not len(toxic) or not toxic.any() or toxic.all():
        return constant(float(toxic.mean()) if len(toxic) else 0.0)
    found: list[list[str]] = []              # units of each text, sentence by sentence
    seen: dict[bytes, list[str]] = {}        # one string object for each distinct unit
    for t in texts:
        own: list[str] = []
        for s in SENTENCE.split(t.decode("utf-8", "replace")):
            for tok in tokens_of(s.encode()):
                if tok not in seen:
                    seen[tok] = units_of(tok)
                own += seen[tok]
        found.append(own)
    del seen
    kept = np.zeros(len(toxic), bool)
    for label in (True, False):
        kept[np.flatnonzero(toxic == label)[::4][:-1]] = True
    every, all_toxic = found, toxic
    docs, toxic = [set(f) for f, k in zip(found, kept) if not k], toxic[~kept]
    number: dict[str, int] = {}
    bags = [np.array([number.setdefault(w, len(number)) for w in sorted(d)], np.int64) for d in docs]
    words = list(number)
    clean = np.zeros(len(words), bool)
    for b, t in zip(bags, toxic):
        if not t:
            clean[b] = True
    # a unit may stand for a toxic document if its runs surprise more than those of documents with shuffled
    # labels do; a document without such a unit (its label is noise, or its insult unique) names no positive
    rnd = np.random.default_rng(SEED)
    first = surprise(docs, toxic)
    shuffled = rnd.permutation(toxic)
    by_chance = surprise(docs, shuffled)
    chance = np.quantile([max((by_chance.get(g, 0.0) for g in grams_of(d)), default=0.0) for d, t in zip(docs, shuffled) if t], CHANCE)
    del by_chance
    margin = np.array([max((first.get(g, 0.0) for g in grams_of({w})), default=0.0) for w in words])
    eligible = (margin > chance) & ~clean
    sure = None                                        # at first: every unit at least half as surprising as the text's worst
    negatives = np.flatnonzero(clean)
    for _ in range(ROUNDS):
        witness: Counter = Counter()
        for b, t in zip(bags, toxic):
            if t and len(b):
                own = b[eligible[b]]
                if not len(own):
                    continue
                least = margin[own].max() / 2 if sure is None else min(sure, margin[own].max())
                witness.update(own[margin[own] >= least].tolist())
        if not witness:                                # nothing in common: every text gets the share of toxic ones
            return constant(float(toxic.mean()))
        hard = negatives[np.argsort(-margin[negatives], kind="stable")[:NEGATIVES // 3]]
        some = np.union1d(hard, rnd.permutation(negatives)[:NEGATIVES - len(hard)])
        pos = sorted(witness)
        weight = np.concatenate([[witness[i] for i in pos], np.ones(len(some))]).astype(float)
        weight[:len(pos)] *= len(some) / weight[:len(pos)].sum() / 4
        marks = [i for i, _ in witness.most_common(LANDMARKS * 3 // 8)]
        marks += [i for i in rnd.permutation(pos)[:LANDMARKS // 4].tolist() if i not in set(marks)]
        marks += hard[:LANDMARKS // 4].tolist() + rnd.permutation(some)[:LANDMARKS // 8].tolist()
        weights, bias = fit_machine([words[i] for i in pos], [words[i] for i in some], weight, [words[i] for i in dict.fromkeys(marks)])
        margin, sure = project(words, weights)[:, 0] + bias, 0.5
    model = Model(weights, bias, np.zeros(4))
    use = np.flatnonzero(kept) if kept.sum() and all_toxic[kept].any() else np.arange(len(every))
    fresh = list({u for i in use for u in every[i]})
    known = dict(zip(fresh, model.margins(fresh).tolist()))
    evidence = np.array([summary([known[u] for u in every[i]]) for i in use])
    model.scale = logistic(evidence, all_toxic[use].astype(float))
    return model


# --- Spark -----------------------------------------------------------------------------

def train(docs: DataFrame, labels: DataFrame, held_out_fold: int = HELD_OUT_FOLD, per_class: int = TRAIN_DOCS) -> Model:
    """Fit on a bounded sample: per class the ``per_class`` training documents of smallest hash.

    Only labelled rows outside the held-out fold of crc32(doc_id) mod 5 and of
    at most TRAIN_DOC_BYTES are taken; null ids, texts or labels are not.
    """
    known = labels.where("toxic is not null and doc_id is not null").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["doc_id"])
    # ids are chosen first, from narrow columns: only the chosen rows' texts leave their partitions
    sized = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.octet_length(F.coalesce("text", F.lit(""))).alias("size"))
             .where((fold_of("doc_id") != held_out_fold) & (F.col("size") <= TRAIN_DOC_BYTES)).select("doc_id").distinct())
    able = known.join(sized, "doc_id").withColumn("h", F.xxhash64("doc_id"))
    chosen = None
    for label in (0, 1):
        own = able.where(F.col("toxic") == label).orderBy("h", "doc_id").limit(per_class)
        chosen = own if chosen is None else chosen.unionByName(own)
    texts = text_of(docs).where(F.octet_length("text") <= TRAIN_DOC_BYTES)
    # a repeated id may bring several rows: the bound holds all the same
    sample = (texts.join(F.broadcast(chosen), "doc_id").orderBy("h", F.xxhash64("text")).limit(2 * per_class)
              .select("text", "toxic"))
    got = sorted((r.text.encode(), r.toxic) for r in sample.collect())       # at most 2 * per_class texts of bounded size
    return fit([t for t, _ in got], [y for _, y in got])


def learn(model: Model, tokens: list[list[bytes]], known: dict[bytes, float]) -> None:
    """Margins of the tokens that are not known yet: each distinct token is judged once."""
    if len(known) > MAX_CACHED:
        known.clear()
    fresh = list({t for ts in tokens for t in ts if t not in known})
    units = [units_of(t) for t in fresh]
    margin = iter(model.margins([u for us in units for u in us]).tolist())
    for t, us in zip(fresh, units):
        known[t] = max((next(margin) for _ in us), default=SILENT)


def score_documents(docs: DataFrame, model: Model, held_out_fold: int = HELD_OUT_FOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and the worst token (witness) of every row's whole text.

    A null or empty text, or one without letters, has no units and gets the
    floor score; null ids count as the text '' for the fold; repeated rows and
    extra columns do not matter; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                tokens = [tokens_of(t) for t in part.column(2).to_pylist()]
                learn(model, tokens, known)
                worst = [max(ts, key=known.__getitem__, default=None) for ts in tokens]
                score = [model.probability([known[t] for t in ts]) for ts in tokens]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32()),
                     pa.array([None if w is None else w.decode("utf-8", "replace") for w in worst], pa.string())],
                    names=["doc_id", "held_out", "score", "predicted", "witness"])

    texts = text_of(docs).select("doc_id", (fold_of("doc_id") == held_out_fold).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int, witness string")


def not_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not predict to be toxic, with all their columns (no shuffle)."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        for batch in batches:
            keep = []
            for lo in range(0, batch.num_rows, 512):
                tokens = [tokens_of((t or "").encode()) for t in batch.column(at).slice(lo, 512).to_pylist()]
                learn(model, tokens, known)
                keep += [model.probability([known[t] for t in ts]) < 0.5 for ts in tokens]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def q_toxicity(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
