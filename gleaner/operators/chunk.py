"""Overlapping fixed-size text chunks.

One row per chunk: ``posexplode`` over the numbers of the chunks — a narrow,
per-row transformation, so chunking never shuffles, and its time grows with the
length of a document and not with its square.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_step(size: int, overlap: float) -> int:
    """Start-to-start distance of chunks of ``size`` that share the ``overlap`` part of their length."""
    if size <= 0:
        raise ValueError(f"a chunk of {size} characters holds nothing")
    if not 0.0 <= overlap <= 1.0:
        raise ValueError(f"overlap {overlap} is no share between 0 and 1")
    return max(1, int(size * (1 - overlap)))


def chunk_text(df: DataFrame, text: str = "text", size: int = 512, overlap: float = 0.2,
               keep: tuple[str, ...] = ("doc_id",), keep_tail: bool = False) -> DataFrame:
    """Split ``text`` into windows of ``size`` characters, ``step`` apart.

    Only full windows are kept (text shorter than ``size`` gives no chunk and
    the tail is dropped), matching the reference. ``keep_tail=True`` also
    emits the windows that start before the end but run short.

    Output: ``*keep, chunk_idx int, chunk_start int, chunk_txt string``.
    """
    step = chunk_step(size, overlap)
    n = F.char_length(F.col(text))
    # the text is cut once into stretches of a step; a chunk is a few of them, so long texts cost no more per chunk
    stretches = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    cut = df.select(*keep, n.alias("_n"), stretches.alias("_s")).where(F.col("_n") >= (1 if keep_tail else size))
    last = F.floor((F.col("_n") - F.lit(1 if keep_tail else size)) / step).cast("int")
    exploded = cut.select(*keep, "_s", F.posexplode(F.sequence(F.lit(0), last)).alias("chunk_idx", "_i"))
    whole = F.array_join(F.slice(F.col("_s"), F.col("_i") + 1, F.lit(-(-size // step))), "")
    return exploded.select(*keep, "chunk_idx", (F.col("_i") * step).alias("chunk_start"), F.substring(whole, 1, size).alias("chunk_txt"))


def chunk_stats(chunks: DataFrame, by: str = "lang") -> DataFrame:
    """Per-group chunk counts and sizes (partial+final hash aggregate)."""
    return chunks.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.countDistinct("doc_id").alias("n_docs"),
        F.sum(F.char_length("chunk_txt")).alias("total_chars"),
        F.min(F.char_length("chunk_txt")).alias("min_len"),
        F.max(F.char_length("chunk_txt")).alias("max_len"),
    )
