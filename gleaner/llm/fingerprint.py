"""Document fingerprints by locally consistent parsing.

A text's code points are parsed into phrases, the phrases' names into longer
phrases, and so on up to one name for the whole. Where phrases end is decided
by deterministic coin tossing: runs of one name become one name; each name gets
the label 2 l + b, where l is the lowest bit in which it differs from its left
neighbour and b its own bit there; four rounds of this turn 64-bit names into
labels below 6, no two neighbours alike; a phrase starts at each local maximum.
A label depends on a few names to the left and one to the right, so equal
substrings are parsed alike but for their ends, wherever they stand, and share
their interior names on every level. A phrase's name is a hash of the names in
it and of the level, so names agree across documents without a shared table.

The fingerprint samples the names of all levels into ``BINS`` bins by hash. A
bin keeps the name whose exponential draw, divided by the phrase's length (at
most ``WIDEST``), is least, so long shared stretches weigh more than letter
pairs that all texts share, and 16 bits of it are written. Likeness is the share
of agreeing bins among those that either fingerprint fills.

Scale. A text alone gives its fingerprint. Where neighbours in the order of ids
are compared, the texts move once, to parts cut at quantiles of the ids; the
first document of each part also goes to the part before it, so no document is
looked up and no part waits for another. The driver holds two numbers per part.
A text is parsed whole, in about 100 bytes of memory per code point.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import shuffle_partitions

BINS = 64
WIDEST = 16                 # code points; longer phrases weigh no more
BATCH_CHARS = 1_000_000     # parsed together

U = np.uint64
ONE, GOLD, SHIFT = U(1), U(0x9E3779B97F4A7C15), U(29)
SPREAD = U(0xD6E8FEB86659FD93)


def mix(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> SHIFT)) * GOLD
    a = (a ^ (a >> SHIFT)) * SPREAD
    return a ^ (a >> SHIFT)


def toss(names: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """One round of coin tossing; ``heads`` are the first places of the texts, whose left neighbour is taken to differ at once."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[heads] = ~names[heads]
    differ = names ^ left
    low = differ & (~differ + ONE)
    at = np.frexp(low.astype(np.float64))[1] - 1
    return (2 * at).astype(U) + ((names & low) != 0)


def merged_runs(names: np.ndarray, widths: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each run of one name within a text as one name."""
    start = np.ones(len(names), bool)
    start[1:] = (names[1:] != names[:-1]) | (texts[1:] != texts[:-1])
    at = np.flatnonzero(start)
    if len(at) == len(names):
        return names, widths, texts
    count = np.diff(at, append=len(names))
    names = np.where(count > 1, mix(names[at] + count.astype(U) * SPREAD), names[at])
    return names, np.add.reduceat(widths, at), texts[at]


def starts_of(names: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Where phrases start: at the texts' first places and at the local maxima of the labels."""
    labels = names
    for _ in range(4):
        labels = toss(labels, heads)
    labels = labels.astype(np.int8)
    top = np.zeros(len(names), bool)
    top[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    top[heads[1:] - 1] = False          # a text's last place has no right neighbour
    top[heads] = True
    return np.flatnonzero(top)


def parse(codes: np.ndarray, texts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Names, lengths and text numbers of the phrases on each level, for texts laid end to end."""
    names, widths, level = codes.astype(U), np.ones(len(codes), np.int64), U(0)
    while len(names):
        names, widths, texts = merged_runs(names, widths, texts)
        heads = np.flatnonzero(np.diff(texts, prepend=-1))
        starts = starts_of(names, heads)
        level += ONE
        place = np.arange(len(names)) - np.repeat(starts, np.diff(starts, append=len(names)))
        names = mix(np.add.reduceat(mix(names + (place.astype(U) + ONE) * GOLD), starts) + level)
        widths, texts = np.add.reduceat(widths, starts), texts[starts]
        yield names, widths, texts
        heads = np.flatnonzero(np.diff(texts, prepend=-1))
        alone = np.diff(heads, append=len(texts)) == 1        # parsed to one name: done
        more = np.repeat(~alone, np.diff(heads, append=len(texts)))
        names, widths, texts = names[more], widths[more], texts[more]


def sketches(many: list[str], bins: int = BINS) -> np.ndarray:
    """One row of 16-bit names per text; 0 is an empty bin."""
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in many]
    texts = np.repeat(np.arange(len(many)), [len(c) for c in codes])
    least = np.full(len(many) * bins, np.inf)
    kept = np.zeros(len(many) * bins, np.uint16)
    for names, widths, owner in parse(np.concatenate(codes) if codes else np.zeros(0, np.uint32), texts):
        draw = mix(names ^ GOLD)
        bin_ = owner * bins + (draw % U(bins)).astype(np.int64)
        key = -np.log(((draw >> U(11)).astype(np.float64) + 1.0) / 2.0**53) / np.minimum(widths, WIDEST)
        np.minimum.at(least, bin_, key)
        won = np.flatnonzero(least[bin_] == key)
        kept[bin_[won]] = np.maximum(mix(names[won]) & U(0xFFFF), ONE).astype(np.uint16)
    return kept.reshape(len(many), bins)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, agreeing bins over filled bins; two texts without any are alike."""
    filled = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    return np.where(filled == 0, 1.0, same / np.maximum(filled, 1))


def written(sketch: np.ndarray) -> list[str]:
    return [row.astype(">u2").tobytes().hex() for row in sketch]


def similarity(a: str, b: str, bins: int = BINS) -> Column:
    """Likeness of two columns of fingerprints (no Python)."""

    def both(i: Column) -> tuple[Column, Column]:
        return tuple(F.substr(F.col(c), 4 * i + 1, F.lit(4)) for c in (a, b))

    at = F.sequence(F.lit(0), F.lit(bins - 1))
    filled = F.size(F.filter(at, lambda i: (both(i)[0] != "0000") | (both(i)[1] != "0000")))
    same = F.size(F.filter(at, lambda i: (both(i)[0] == both(i)[1]) & (both(i)[0] != "0000")))
    return F.when(filled == 0, F.lit(1.0)).otherwise(same / filled)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of every row, in place (no shuffle).

    A null text counts as empty; the empty text fills no bin. Null and repeated
    ids pass through, equal texts get equal fingerprints, other columns are not
    read, and no rows give none.
    """
    out = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("fingerprint", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in bounded(zip(*(c.to_pylist() for c in b.columns)) for b in batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(map(len, texts), pa.int64()),
                                              pa.array(written(sketches(texts)), pa.string())], schema=out)

    return bytes_of(docs).mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string")


def bounded(batches) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of some rows at a time, about BATCH_CHARS in sum."""
    ids, texts, size = [], [], 0
    for rows in batches:
        for i, t in rows:
            ids.append(i)
            texts.append(t.decode("utf-8", "replace"))
            size += len(texts[-1])
            if size >= BATCH_CHARS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def bytes_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


# --- neighbours ------------------------------------------------------------------

def constant(numbers: list[int | None]) -> Column:
    """A literal array, also of many numbers."""
    return F.from_json(F.lit(json.dumps(numbers)), "array<bigint>")


def in_order(docs: DataFrame) -> DataFrame:
    """(part, extra, doc_id, text): parts of the documents in order, each followed by copies of the first of the next part.

    The order is by doc_id, nulls first, then by the text's bytes. The last
    part's next is the first.
    """
    texts = bytes_of(docs)
    parts = shuffle_partitions(docs.sparkSession)
    fractions = [k / parts for k in range(1, parts)]
    cuts = texts.agg(F.percentile_approx("doc_id", fractions or [0.5], 100 * parts).alias("cuts")).first()["cuts"] if parts > 1 else []
    limits = constant(sorted(set(cuts or [])))
    part = F.coalesce(F.size(F.filter(limits, lambda c: c <= F.col("doc_id"))), F.lit(0))
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(part).cast("int")
    placed = texts.withColumn("part", part)
    rows = placed.groupBy("part").agg(F.max(F.col("doc_id").isNull()).alias("none"), F.min("doc_id").alias("least")).collect()
    heads = {r["part"]: None if r["none"] else r["least"] for r in rows}
    there = sorted(heads)
    before = {p: there[k - 1] for k, p in enumerate(there)}
    first, back = (constant([d.get(p) for p in range(parts)]) for d in (heads, before))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("extra"))
    copy = F.struct(F.get(back, F.col("part")).cast("int").alias("part"), F.lit(1).alias("extra"))
    to = F.when(F.get(first, F.col("part")).eqNullSafe(F.col("doc_id")), F.array(own, copy)).otherwise(F.array(own))
    dealt = placed.select(F.explode(to).alias("to"), "doc_id", "text").select("to.part", "to.extra", "doc_id", "text")
    return dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "extra", F.col("doc_id").asc_nulls_first(), "text")


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    The edited text's last ``n_chars // 4`` code points are the first as many
    (or all) of the next document by doc_id (nulls first, ties by text; after
    the last comes the first, which may be the document itself). Nulls, repeats,
    empty texts, extra columns and empty tables as in ``fingerprints``.
    """
    out = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compared(ids: list, texts: list[str]) -> pa.RecordBatch:
        own, nexts = texts[:-1], texts[1:]
        edited = [t[:len(t) - len(t) // 4] + u[:len(t) // 4] for t, u in zip(own, nexts)]
        a, b = sketches(texts), sketches(edited)
        shas = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited]
        cols = (ids[:-1], map(len, own), shas, written(a[:-1]), written(b), likeness(a[:-1], b), likeness(a[:-1], a[1:]))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, part, closed = [], [], 0, None, False
        for batch in batches:
            for p, extra, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    part, closed = p, False
                if closed:
                    continue
                ids.append(doc)
                texts.append(text.decode("utf-8", "replace"))
                size += len(texts[-1])
                if extra or (size >= BATCH_CHARS and len(texts) > 1):
                    yield compared(ids, texts)
                    closed = bool(extra)
                    ids, texts = ([], []) if extra else (ids[-1:], texts[-1:])
                    size = sum(map(len, texts))

    return in_order(docs).mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                          "edited_fingerprint string, near_edited double, near_next double")


def q_fingerprints(spark, sf_dir) -> DataFrame:
    return with_neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet"))
