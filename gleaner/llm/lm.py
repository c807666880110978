"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood estimates of order 2, 1 and 0:

    p(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1)

b is the bucket of the context's frequency (its power of two), and each bucket's
weights are learned by expectation-maximisation on held-out counts: every
training token is scored by the counts with that one token deleted, as it would
be had it been held out.

Scale. Documents are read once into blocks of a bounded number of tokens (a long
document spans blocks). A block asks for the corpus counts of its own distinct
words and word pairs: it sends sorted 64-bit keys and its own training counts to
the part that owns the key range, a part adds up what all blocks sent, and
answers each block in its own order. So each distinct pair of a block moves
once, pre-aggregated, however often it occurs, and no table of counts is
broadcast or collected. The sufficient statistics of the EM are a histogram of
quantised ratios per bucket, whose size does not depend on the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import drop_scratch, fold_of, shuffle_partitions, spark_read, text_of, write_scratch

BLOCK_TOKENS = 1_000_000
BLOCKS_PER_PART = 4         # a part gathers about as many keys as so many blocks hold
HELD_OUT_FOLD = 1
BUCKETS = 40                # of context frequency: 0, 1, 2-3, 4-7, ...
STEPS = 8                   # quantisation of ratios: steps per octave
EM_ROUNDS = 100
END, BEGIN = xxhash.xxh64_intdigest(b" "), xxhash.xxh64_intdigest(b"\n")     # no word holds white space


# --- arrays as bytes -----------------------------------------------------------

def planes(a: np.ndarray) -> bytes:
    """Compressed by byte plane: the high bytes of small numbers cost nothing."""
    a = np.ascontiguousarray(a)
    raw = a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b""
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unplanes(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


def pack_keys(sorted_keys: np.ndarray) -> bytes:
    return planes(np.diff(sorted_keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, "<u8"), dtype=np.uint64)


# --- blocks --------------------------------------------------------------------

def blocks_of(docs: DataFrame, held_out_fold: int, size: int) -> DataFrame:
    """Token blocks: distinct words' hashes, tokens as positions in them, and the segments of documents."""
    # kind, and whether Arrow holds it as a list (segments) or as packed bytes
    schema = "words binary, tokens binary, docs array<bigint>, rows array<bigint>, held array<boolean>, lengths array<bigint>, firsts array<bigint>"
    names = ["words", "tokens", "docs", "rows", "held", "lengths", "firsts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh64_intdigest
        known: dict = {}            # word -> number in the block, in order of appearance
        tokens: list[int] = []
        segments: list[tuple] = []  # doc, row, held out, tokens, number of the word before it

        def start() -> None:
            known.clear()
            known[END_WORD], known[BEGIN_WORD] = 0, 1
            tokens.clear()
            segments.clear()

        def block() -> pa.RecordBatch:
            keys = np.fromiter((END if w is END_WORD else BEGIN if w is BEGIN_WORD else hashed(w) for w in known), np.uint64, len(known))
            order = np.argsort(keys)
            place = np.empty(len(keys), np.uint32)
            place[order] = np.arange(len(keys), dtype=np.uint32)
            cols = list(zip(*segments))
            return pa.RecordBatch.from_arrays(
                [pa.array([pack_keys(keys[order])]), pa.array([planes(place[np.array(tokens, np.int64)])]),
                 *(pa.array([list(c)], pa.list_(pa.bool_() if n == "held" else pa.int64()))
                   for n, c in zip(names[2:6], cols)),
                 pa.array([[int(place[x]) for x in cols[4]]], pa.list_(pa.int64()))], names=names)

        start()
        for batch in batches:
            for doc, row, held, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.lower().split()
                words.append(END_WORD)
                at, before = 0, BEGIN_WORD
                while at < len(words):
                    part = words[at:at + size - len(tokens)]
                    first = known.setdefault(before, len(known))
                    tokens.extend([known.setdefault(w, len(known)) for w in part])
                    segments.append((doc, row, held, len(part), first))
                    at, before = at + len(part), part[-1]
                    if len(tokens) >= size:
                        yield block()
                        start()
        if segments:
            yield block()

    texts = text_of(docs).select("doc_id", F.monotonically_increasing_id().alias("row"),
                                 (fold_of("doc_id") == held_out_fold).alias("held"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, schema)


END_WORD, BEGIN_WORD = b" ", b"\n"


class Tokens:
    """A block's tokens with their contexts, words and distinct pairs."""

    def __init__(self, row: dict):
        self.words = unpack_keys(row["words"])
        self.w = unplanes(row["tokens"], "<u4").astype(np.int64)
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.repeat(np.array(row["held"], bool), self.lengths)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1]))
        self.v = np.empty_like(self.w)
        self.v[1:] = self.w[:-1]
        self.v[self.starts] = np.array(row["firsts"], np.int64)

    def word_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of the words, and their training counts here."""
        return self.words, np.bincount(self.w[~self.held], minlength=len(self.words)).astype(np.uint32)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct pair keys, and each token's position among them."""
        left, right = self.words[self.v], self.words[self.w]
        mixed = left * np.uint64(0x9E3779B97F4A7C15)            # odd constants of multiplicative hashing
        mixed = (mixed ^ (mixed >> np.uint64(29)) ^ right) * np.uint64(0xBF58476D1CE4E5B9)
        keys, of_token = np.unique(mixed ^ (mixed >> np.uint64(32)), return_inverse=True)
        return keys, of_token.reshape(-1)

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        keys, of_token = self.pairs()
        return keys, np.bincount(of_token[~self.held], minlength=len(keys)).astype(np.uint32)


# --- corpus counts ---------------------------------------------------------------

def corpus_counts(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """(block, part, counts, types, total): the corpus counts of each block's keys, in its own order."""
    width = np.uint64(-(-(1 << 64) // parts))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Tokens(row)
                keys, n = block.word_counts() if order == 1 else block.pair_counts()
                cuts = np.searchsorted(keys, np.arange(1, parts, dtype=np.uint64) * width).tolist()
                spans = [(p, a, b) for p, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(keys)])) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(spans), pa.int64()), pa.array([p for p, _, _ in spans], pa.int32()),
                     pa.array([pack_keys(keys[a:b]) for _, a, b in spans], pa.binary()),
                     pa.array([planes(n[a:b]) for _, a, b in spans], pa.binary())], names=["block", "part", "keys", "counts"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def part() -> pa.RecordBatch:
            keys = [unpack_keys(r[2]) for r in held]
            counts = np.concatenate([unplanes(r[3], "<u4") for r in held])
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(at.reshape(-1), weights=counts, minlength=len(distinct)).astype(np.uint64)
            back = np.split(total[at.reshape(-1)], np.cumsum([len(k) for k in keys])[:-1])
            n = len(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in held], pa.int64()), pa.array([r[1] for r in held], pa.int32()),
                 pa.array([planes(b.astype("<u8")) for b in back], pa.binary()),
                 pa.array([int((total > 0).sum())] + [0] * (n - 1), pa.int64()),
                 pa.array([int(total.sum())] + [0] * (n - 1), pa.int64())], names=["block", "part", "counts", "types", "total"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][1] != row[1]:
                    yield part()
                    held.clear()
                held.append(row)
        if held:
            yield part()

    asked = blocks.mapInArrow(ask, "block bigint, part int, keys binary, counts binary")
    return (asked.repartition(parts, "part").sortWithinPartitions("part", "block")
            .mapInArrow(answer, "block bigint, part int, counts binary, types bigint, total bigint"))


def joined(blocks: DataFrame, words: DataFrame, pairs: DataFrame, n_blocks: int) -> DataFrame:
    """Blocks with the corpus counts of their words and pairs, one row per block."""
    cols = blocks.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema) + ", word_counts binary, pair_counts binary"

    def padded(answers: DataFrame, kind: int) -> DataFrame:
        return answers.select(F.lit(kind).alias("kind"), "part", "counts", "block",
                              *[F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in cols if c != "block"])

    own = blocks.select(F.lit(0).alias("kind"), F.lit(0).alias("part"), F.lit(None).cast("binary").alias("counts"), "block",
                        *[c for c in cols if c != "block"])
    rows = (own.unionByName(padded(words, 1)).unionByName(padded(pairs, 2))
            .repartition(n_blocks, "block").sortWithinPartitions("block", "kind", "part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, got = None, {1: [], 2: []}

        def block() -> pa.RecordBatch:
            merged = [planes(np.concatenate([unplanes(x, "<u8") for x in got[k]])) for k in (1, 2)]
            return own.append_column("word_counts", pa.array([merged[0]], pa.binary())).append_column(
                "pair_counts", pa.array([merged[1]], pa.binary()))

        for batch in batches:
            kinds, counts = batch.column("kind").to_pylist(), batch.column("counts").to_pylist()
            for i, (kind, c) in enumerate(zip(kinds, counts)):
                if kind == 0:
                    if own is not None:
                        yield block()
                    own, got = batch.slice(i, 1).select(cols), {1: [], 2: []}
                else:
                    got[kind].append(c)
        if own is not None:
            yield block()

    return rows.mapInArrow(run, schema)


# --- the model ---------------------------------------------------------------------

def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for no occurrence, then 1 + floor(log2)."""
    return np.minimum(np.frexp(context.astype(float))[1], BUCKETS - 1).astype(np.int64)


class Counted(Tokens):
    """A block's tokens with corpus counts: c1 of the word, cv of the context, c2 of the pair."""

    def __init__(self, row: dict):
        super().__init__(row)
        words = unplanes(row["word_counts"], "<u8").astype(np.int64)
        of_context = words.copy()
        of_context[np.searchsorted(self.words, np.uint64(BEGIN))] = words[np.searchsorted(self.words, np.uint64(END))]
        self.c1, self.cv = words[self.w], of_context[self.v]
        self.c2 = unplanes(row["pair_counts"], "<u8").astype(np.int64)[self.pairs()[1]]


def octaves(ratio: np.ndarray) -> np.ndarray:
    """Quantised log2, with 0 kept apart as the smallest short."""
    out = np.full(len(ratio), -(1 << 15), np.int64)
    some = ratio > 0
    out[some] = np.rint(np.log2(ratio[some]) * STEPS)
    return out


def deleted_histogram(counted: DataFrame, n: int, v: int) -> DataFrame:
    """Training tokens under counts with the token deleted, by cells of equal bucket and quantised p2/p1 and p1/p0.

    (cell, n, p2, p1): the cell's number of tokens and their summed estimates in units of p0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                t = Counted(batch.slice(i, 1).to_pylist()[0])
                c1, cv, c2 = ((x[~t.held] - 1) for x in (t.c1, t.cv, t.c2))
                p1 = c1 / max(n - 1, 1)
                p2 = np.where(cv > 0, c2 / np.maximum(cv, 1), 0)
                r2 = octaves(np.divide(p2, p1, out=np.zeros_like(p2), where=p1 > 0))
                cell = (bucket_of(cv) << 40) + ((r2 + (1 << 16)) << 20) + octaves(p1 * (v + 1)) + (1 << 16)
                cells, at, counts = np.unique(cell, return_inverse=True, return_counts=True)
                add = lambda x: pa.array(np.bincount(at.reshape(-1), x * (v + 1), len(cells)), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(counts, pa.int64()), add(p2), add(p1)],
                                                 names=["cell", "n", "p2", "p1"])

    return counted.mapInArrow(run, "cell bigint, n bigint, p2 double, p1 double").groupBy("cell").agg(
        *[F.sum(c).alias(c) for c in ("n", "p2", "p1")])


def learn_weights(bucket: np.ndarray, counts: np.ndarray, p2: np.ndarray, p1: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """EM: weights (l2, l1, l0) per bucket from cells of tokens and their mean estimates in units of p0.

    A prior of half a token each keeps every weight above zero.
    """
    p = np.stack([p2, p1, np.ones(len(bucket))], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(rounds):
        share = weights[bucket] * p
        share *= (counts / share.sum(axis=1))[:, None]
        mass = np.full((BUCKETS, 3), 0.5)
        np.add.at(mass, bucket, share)
        weights = mass / mass.sum(axis=1, keepdims=True)
    weights[0, 0] = 0                                                              # no estimate of order 2 there
    weights[0] /= weights[0].sum()
    return weights


def scores(counted: DataFrame, n: int, v: int, weights: np.ndarray) -> DataFrame:
    """A row per segment of a document."""
    names = ["doc_id", "row", "held_out", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                t = Counted(row)
                l2, l1, l0 = weights[bucket_of(t.cv)].T
                p = l2 * t.c2 / np.maximum(t.cv, 1) + l1 * t.c1 / max(n, 1) + l0 / (v + 1)
                base = np.log10((t.c1 + 0.5) / (n + 0.5 * (v + 1)))
                add = lambda x: np.add.reduceat(x, t.starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["docs"], pa.int64()), pa.array(row["rows"], pa.int64()), pa.array(row["held"], pa.bool_()),
                     pa.array(t.lengths, pa.int64()), pa.array(add((t.c1 > 0).astype(np.int64)), pa.int64()),
                     pa.array(add(base), pa.float64()), pa.array(add(np.log10(p)), pa.float64())], names=names)

    return counted.mapInArrow(run, "doc_id bigint, row bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                   "base_score double, score double")


def score_documents(docs: DataFrame, held_out_fold: int = HELD_OUT_FOLD, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Score every row of ``docs`` by a model of the rows outside the held-out fold of crc32(doc_id) mod 5.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score (log10). A null or empty text is its end alone; a null id counts as
    the text '' for the fold; repeated rows are scored (and learned) as often as
    they occur; with no training rows all counts are 0 and the model is uniform;
    an empty table gives no rows; extra columns are not read. Words are compared
    by 64-bit hashes.
    """
    spark = docs.sparkSession

    def keep(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = write_scratch(df, name)
        return spark_read(spark, path, df), path

    blocks, block_path = keep(blocks_of(docs, held_out_fold, block_tokens).withColumn("block", F.monotonically_increasing_id()),
                              "lm-blocks")
    n_blocks = max(1, blocks.count())
    parts = max(shuffle_partitions(spark), -(-n_blocks // BLOCKS_PER_PART))
    words, word_path = keep(corpus_counts(blocks, 1, parts), "lm-words")
    pairs, pair_path = keep(corpus_counts(blocks, 2, parts), "lm-pairs")
    seen = words.agg(F.coalesce(F.sum("types"), F.lit(0)).alias("v"), F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()
    counted, _ = keep(joined(blocks, words.select("block", "part", "counts"), pairs.select("block", "part", "counts"), n_blocks),
                      "lm-counted")
    for path in (block_path, word_path, pair_path):
        drop_scratch(spark, path)
    cells = deleted_histogram(counted, seen.n, seen.v).collect()        # bounded by buckets and octaves
    cell, k, p2, p1 = np.array([tuple(r) for r in cells], float).reshape(-1, 4).T
    weights = learn_weights(cell.astype(np.int64) >> 40, k, p2 / k, p1 / k)
    segments = scores(counted, seen.n, seen.v, weights)
    return (segments.groupBy("row").agg(
                F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
                *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(seen.n)).cast("bigint").alias("train_tokens"),
                    "base_score", "score"))


def q_lm(spark, sf_dir) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
