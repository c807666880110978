"""Packing by cutting-stock column generation.

Every document is a run of token ids; full sequences are cut off its front and
the remainder is one piece. How the pieces fill sequences is the cutting-stock
problem over the histogram of piece lengths:

1. lengths are rounded up to a grain, which bounds the histogram (capacity /
   grain classes) whatever the number of documents;
2. the linear program over patterns (how many pieces of each class share a
   sequence) is solved by column generation: a revised simplex keeps the basis,
   a knapsack dynamic program prices the best new pattern from its duals, and
   Farley's bound ends it;
3. pattern counts are rounded down, and the few pieces left over are packed
   best-fit into further patterns;
4. every class's demand becomes intervals of ranks, each owned by one pattern;
   the documents' pieces are ranked inside their class by prefix sums over
   partitions, and the rank names the sequence and the place in it.

Only the histogram and the patterns pass through the driver; both are bounded
by the number of classes.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import spark_read, text_of, worker_state, write_scratch

CAPACITY = 4096
GRAIN = 8
GAP = 0.001                 # the linear program ends this near its bound
MAX_CACHED = 1_600_000        # words remembered by a Python worker
STOPS = b".,;:!?"


# --- tokens -----------------------------------------------------------------

class WordCache:
    """Ids of a text from the ids of its white-space separated words.

    The tokenizer drops white space, no match of its pattern holds any, no
    special string holds any or strips its neighbours, and neither the
    normalisation nor the merges reach across it, so the ids of a text are those
    of its words in turn. It lower-cases, so ASCII words are looked up in lower
    case; and a match of letters ends where punctuation begins, so the stops
    after an ASCII letter are looked up apart. Each form is encoded by the
    library once, many at a time with a special string between them. Words with
    a special string in any case of letters are encoded as they are.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.between, self.between_id = max(special.items())
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in special), re.IGNORECASE).search

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if len(self.known) > MAX_CACHED:
            self.known.clear()
        known, words = self.known, [t.split() for t in texts]
        fresh = {w: self.forms(w) for w in {w for ws in words for w in ws if w not in known}}
        self.look_up(list({f for fs in fresh.values() for f in fs if f not in known}))
        for w, forms in fresh.items():
            known[w] = b"".join([known[f] for f in forms])
        return [b"".join([known[w] for w in ws]) for ws in words]

    def forms(self, word: bytes) -> tuple[bytes, ...]:
        if self.special(word):
            return (word,)
        lower = word.lower() if word.isascii() else word
        core = lower.rstrip(STOPS)
        if core != lower and core[-1:].isalpha():
            return core, lower[len(core):]
        return (lower,)

    def look_up(self, forms: list[bytes]) -> None:
        plain = []
        for f in forms:
            if self.special(f):
                self.known[f] = np.array(self.library.encode(f.decode(), add_special_tokens=False).ids, "<u4").tobytes()
            else:
                plain.append(f)
        for at in range(0, len(plain), 512):
            some = plain[at:at + 512]
            ids = np.array(self.library.encode(self.between.join([f.decode() for f in some]), add_special_tokens=False).ids, "<u4")
            cuts = (4 * np.flatnonzero(ids == self.between_id)).tolist()
            raw = ids.tobytes()
            for f, lo, hi in zip(some, [0, *(c + 4 for c in cuts)], [*cuts, len(raw)]):
                self.known[f] = raw[lo:hi]


def word_cache(path: str) -> WordCache:
    held = worker_state("packing words")
    if path not in held:
        held[path] = WordCache(path)
    return held[path]


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece, and its ids if asked for."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_cache(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), words.encode(part.column(1).to_pylist())):
                    ids += end
                    for lo in range(0, len(ids), width):
                        piece = ids[lo:lo + width]
                        rows.append((doc, lo // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece))
                cols = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(names, cols)], names=names)

    texts = text_of(docs)
    return texts.withColumn("text", texts["text"].cast("binary")).mapInArrow(
        run, ", ".join(f"{n} {'binary' if n == 'ids' else 'bigint'}" for n in names))


# --- the cutting-stock problem on the histogram ------------------------------

def best_pattern(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, Counter]:
    """Knapsack: the pattern of classes (by position) with the largest total value."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    use = value > 1e-12
    order = np.flatnonzero(use)[np.argsort(sizes[use], kind="stable")]
    size, worth = sizes[order], value[order]
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        n = np.searchsorted(size, r, side="right")
        if n:
            total = best[r - size[:n]] + worth[:n]
            k = int(total.argmax())
            if total[k] > best[r] + 1e-12:
                best[r], pick[r] = total[k], order[k]
    chosen, r = Counter(), room
    while r > 0:
        if pick[r] < 0:
            r -= 1
        else:
            chosen[int(pick[r])] += 1
            r -= int(sizes[pick[r]])
    return float(best[room]), chosen


def linear_program(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> list[tuple[float, Counter]]:
    """Fractional pattern counts that meet the demand with the fewest sequences."""
    m = len(sizes)
    patterns = [Counter({i: room // int(s)}) for i, s in enumerate(sizes)]
    inverse = np.diag(1.0 / np.array([room // int(s) for s in sizes], float))
    level = inverse @ demand
    for _ in range(40 * m + 200):
        duals = inverse.sum(axis=0)
        worth, chosen = best_pattern(duals, sizes, room)
        if worth <= 1 + gap:                     # Farley: level.sum() / worth bounds the optimum
            break
        column = np.zeros(m)
        for i, a in chosen.items():
            column[i] = a
        way = inverse @ column
        ratio = np.where(way > 1e-9, level / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        pivot = inverse[out] / way[out]
        inverse -= np.outer(way, pivot)
        inverse[out] = pivot
        level = np.maximum(level - step * way, 0)
        level[out] = step
        patterns[out] = chosen
    return [(float(x), p) for x, p in zip(level, patterns) if x > 1e-9]


def best_fit(sizes: np.ndarray, demand: np.ndarray, room: int) -> Counter:
    """Patterns (as sorted tuples of class counts) that pack what rounding left, largest first."""
    bins: list[Counter] = []
    free: dict[int, list[int]] = {}              # room left -> bins
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        for _ in range(int(demand[i])):
            fits = [r for r in free if r >= size]
            if fits:
                r = min(fits)
                b = free[r].pop()
                if not free[r]:
                    del free[r]
            else:
                b, r = len(bins), room
                bins.append(Counter())
            bins[b][int(i)] += 1
            free.setdefault(r - size, []).append(b)
    return Counter(tuple(sorted(b.items())) for b in bins)


def solve(histogram: dict[int, int], room: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """[(count, ((size, copies), ...))]: patterns that hold exactly the pieces of the histogram."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n), dtype=np.int64)
    if not len(sizes):
        return []
    left = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    out: Counter = Counter()
    for x, pattern in sorted(linear_program(sizes, left.astype(float), room), key=lambda p: -p[0]):
        n = min([int(x + 1e-9), *(int(left[i]) // a for i, a in pattern.items())])
        if n > 0:
            for i, a in pattern.items():
                left[i] -= n * a
            out[tuple(sorted(pattern.items()))] += n
    out += best_fit(sizes, left, room)
    return [(n, tuple((int(sizes[i]), a) for i, a in reversed(p))) for p, n in sorted(out.items())]


def intervals(patterns: list[tuple[int, tuple[tuple[int, int], ...]]]) -> list[tuple[int, ...]]:
    """(class, first rank, end rank, copies, first sequence, first place) of each pattern's share of a class."""
    rows, taken, sequence = [], Counter(), 0
    for n, parts in patterns:
        place = 0
        for size, copies in parts:
            rows.append((size, taken[size], taken[size] + n * copies, copies, sequence, place))
            taken[size] += n * copies
            place += copies
        sequence += n
    return rows


# --- documents to sequences ---------------------------------------------------

def pack_documents(docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """Pack all rows of ``docs`` into sequences of at most ``capacity`` tokens.

    Returns a row per piece: doc_id, start (its document's ids before it),
    length, ids_crc32, doc_tokens, sequence_id, offset (in the sequence,
    gapless from 0). A null or empty text is its end id alone; null ids and
    repeated rows are packed as they come; an empty table gives no rows; extra
    columns are not read. ``pieces(..., with_ids=True)`` gives the ids.
    """
    spark = docs.sparkSession
    cut = pieces(docs, path, end_id, capacity).withColumns({
        "class": F.expr(f"cast((length + {grain - 1}) div {grain} as int)"), "part": F.spark_partition_id()})
    made = spark_read(spark, write_scratch(cut, "packing-pieces"), cut)      # texts are encoded once
    counts = made.groupBy("part", "class").count()

    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("count").alias("n")).collect()}
    room = capacity // grain              # at most this many classes, so all below is bounded
    rows = intervals(solve(histogram, room))
    owners = spark.createDataFrame(rows, "class int, lo bigint, hi bigint, copies bigint, first_sequence bigint, first_place bigint")

    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("part", "class", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("part", "class").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (made.withColumn("nth", F.row_number().over(inside)).join(ahead, ["part", "class"])
              .withColumn("rank", F.col("ahead") + F.col("nth") - 1))
    placed = (ranked.join(F.broadcast(owners), "class").where("rank >= lo and rank < hi")
              .withColumn("sequence_id", F.expr("first_sequence + (rank - lo) div copies"))
              .withColumn("place", F.expr("first_place + (rank - lo) % copies")))
    upto = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         (F.sum("length").over(upto) - F.col("length")).alias("offset"))


def q_packing(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
