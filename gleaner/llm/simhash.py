"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint's bit is the majority of that bit over the hashes of its text's
word shingles. Two fingerprints link at ``radius`` or fewer differing bits.

Covering masks: give each bit position i a vector m(i) of radius+1 bits, and
let table v (each of the 2^(radius+1) - 1 vectors but zero) keep the positions
with an odd <m(i), v>. The vectors of ``radius`` differing positions span at
most ``radius`` dimensions, so some v is orthogonal to all of them: that table
keeps none of the positions in which the pair differs, and the pair collides
there. No pair within the radius can be missed.

Only distinct fingerprints enter the tables. A bucket larger than a block is
split into blocks by hash and every pair of blocks becomes a task's work of its
own, and work on a block or pair of blocks returns a spanning forest of the
links found, never all pairs. Components come from contraction of the links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import spark_read, text_of, write_scratch, written
from gleaner.llm.graph import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
BLOCK = 1024            # fingerprints of a bucket compared at once
AT_ONCE = 1 << 15       # shingle hashes counted at once


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(radius: int = RADIUS) -> list[int]:
    """The covering tables' bit masks (unsigned)."""
    last = (1 << radius + 1) - 1
    vectors = [1 + i % last for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, last + 1)]


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint of a UTF-8 text; A-Z are lower-cased, words are split at ASCII white space."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(line[a:b], seed) for a, b in zip(first, last)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for lo in range(0, n, AT_ONCE):
        part = hashes[lo:lo + AT_ONCE].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, row, print): the signed 64-bit fingerprint of every row's whole text, and the row's place in the scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [signed(simhash(t, shingle, seed)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.int64())],
                                             names=["doc_id", "row", "print"])

    texts = text_of(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, row bigint, print bigint")


def forest(own: np.ndarray, other: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Spanning links of the pairs within the radius: inside ``own``, or between ``own`` and ``other``."""
    left, right = own.view(np.uint64), (own if other is None else other).view(np.uint64)
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
    links, free_left, free_right = [], np.ones(len(left), bool), np.ones(len(right), bool)
    for seed in np.flatnonzero(near.sum(axis=1) > (1 if other is None else 0)):
        if not free_left[seed]:
            continue
        free_left[seed] = False
        front = [int(seed)]
        if other is None:
            while front:
                i = front.pop()
                new = np.flatnonzero(near[i] & free_left)
                free_left[new] = False
                links += [(int(own[i]), int(own[k])) for k in new]
                front += new.tolist()
            continue
        while front:                         # alternate between the sides
            i = front.pop()
            new = np.flatnonzero(near[i] & free_right)
            free_right[new] = False
            links += [(int(own[i]), int(other[k])) for k in new]
            for k in new.tolist():
                back = np.flatnonzero(near[:, k] & free_left)
                free_left[back] = False
                links += [(int(own[j]), int(other[k])) for j in back]
                front += back.tolist()
    return links


def links(prints: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect exactly the distinct fingerprints ``print`` within the radius."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("print").bitwiseAND(F.lit(signed(m))).alias("key"))
                       for t, m in enumerate(masks(radius))])
    dealt = prints.select("print", F.explode(tables).alias("x")).select("print", "x.t", "x.key")
    crowded = dealt.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Spark sizes the exploded rows as the few prints they come from and would broadcast them: they are merged instead
    # members of a large bucket go to all pairs of blocks that hold their own block
    member = (dealt.join(crowded.hint("merge"), ["t", "key"])
              .withColumn("blocks", F.expr(f"cast((n + {block - 1}) div {block} as int)"))
              .withColumn("own", F.expr("pmod(xxhash64(print), blocks)"))
              .withColumn("other", F.explode(F.expr("sequence(cast(0 as bigint), cast(blocks - 1 as bigint))")))
              .select("t", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      (F.col("own") > F.col("other")).cast("int").alias("side"), "print"))
    unit = ["t", "key", "i", "j"]
    units = member.repartition(*unit).sortWithinPartitions(*unit, "side", "print")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def work(cols: list[np.ndarray]) -> pa.RecordBatch:
            t, key, i, j, side, p = cols
            fresh = np.concatenate(([True], (t[1:] != t[:-1]) | (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
            starts = np.append(np.flatnonzero(fresh), len(t))
            sizes = np.diff(starts)
            two = starts[:-1][(sizes == 2)]
            two = two[(i[two] == j[two])]
            close = np.bitwise_count((p[two] ^ p[two + 1]).view(np.uint64)) <= radius
            a, b = [p[two[close]]], [p[two[close] + 1]]
            for s, n in zip(starts[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
                if i[s] == j[s]:
                    found = forest(p[s:s + n], None, radius) if n > 2 else []
                else:
                    cut = s + int(np.searchsorted(side[s:s + n], 1))
                    found = forest(p[s:cut], p[cut:s + n], radius) if s < cut < s + n else []
                if found:
                    pair = np.array(found, np.int64)
                    a.append(pair[:, 0])
                    b.append(pair[:, 1])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            # the last unit may go on in the next batch
            last = len(cols[0]) - 1
            if last < 0:
                continue
            same = np.ones(last + 1, bool)
            for c in cols[:4]:
                same &= c == c[last]
            at = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if at:
                yield work([c[:at] for c in cols])
            held = [c[at:] for c in cols]
        if held and len(held[0]):
            yield work(held)

    return units.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, row (its place in the scan), fingerprint, root and component_id.

    ``component_id`` is the smallest doc_id reachable over links, ``root`` names
    the component (its smallest signed fingerprint, as hex). A null, empty or
    blank text has fingerprint zero, linked like any other; repeated rows share a
    component; null ids take part but never name a component (one of null ids
    alone has a null component_id); an empty table gives no rows; extra columns
    are not read.
    """
    spark = docs.sparkSession
    own = written(fingerprints(docs, shingle, seed), "simhash-prints")
    smallest = own.groupBy("print").agg(F.min("doc_id").alias("first"))
    distinct = written(smallest, "simhash-distinct")
    found = links(distinct.select("print"), radius)
    trees = components(spark_read(spark, write_scratch(found, "simhash-links"), found))
    rooted = distinct.join(trees.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_print = written(rooted.select("print", "root").join(names, "root"), "simhash-components")
    return own.join(of_print, "print").select("doc_id", "row", hexed("print").alias("fingerprint"), hexed("root").alias("root"),
                                              "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id, of repeated ids the first row.

    Rows are named by their place in the scan, so ``docs`` must be a table (or
    anything else that gives the same partitions whenever it is read).
    """
    row = "row of the scan"                       # no column of documents has such a name
    own = near_duplicates(docs)
    best = own.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best"))
    keep = best.select(F.col("best.row").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(keep, row, "left_semi").select(*docs.columns)


def hexed(name: str):
    return F.lower(F.lpad(F.hex(name), 16, "0"))


def q_simhash(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "fingerprint", "component_id")
