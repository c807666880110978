"""Quality rules by compression bands.

A text's zstandard ratio (compressed bytes / bytes) says how much it repeats
itself: boilerplate falls far below prose of its length, random characters
stay far above. Both limits depend on the length, because a short text has
little to repeat and carries the frame's fixed cost. Fixed chunks are held to
a band of their own, so a long document cannot hide a large repetitive or
random part behind its prose.

The fixed bands only catch extremes. What is usual at a length is learned from
the corpus itself: for every octave of lengths the median ratio of the texts
that pass the base rules, and how far the upper quartile lies above it. Texts
that repeat themselves drag the lower half down but not the upper, so a text
that lies ``SPREADS`` such distances below the median is rejected. Octaves with
fewer than ``LEAST_TEXTS`` texts have the fixed bands only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import SPACE, spark_read, text_of, write_scratch

#: Fixed values: (bytes up to, lowest ratio, highest ratio) of a whole text.
BANDS = (
    (64, 0.0, 9.0),
    (128, 0.35, 9.0),
    (256, 0.35, 1.02),
    (1024, 0.30, 0.88),
    (4096, 0.25, 0.76),
    (16384, 0.20, 0.73),
    (float("inf"), 0.15, 0.72),
)
CHUNK_BYTES = 1024
CHUNK_BAND = (0.18, 0.78)      # of full chunks
MAX_CHUNK_SHARE = 0.25         # larger shares of chunks outside the band reject the text
SPREADS = 4.0                  # of median to upper quartile, that a text may lie below the median of its length
LEAST_TEXTS = 100              # of an octave of lengths, to learn from
LEVEL = 3
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))   # bytes that start no code point

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, n_bytes bigint, ratio double, bad_chunks bigint, n_chunks bigint")


def repeated_words(words: Sequence[bytes], n: int = 5) -> int:
    """Words that lie in an n-word window found twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(n))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + n - max(i, upto)
            upto = i + n
    return covered


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (len(words), len(text.translate(None, CONTINUATION + SPACE)),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words))


def compression(text: bytes, pack: zstandard.ZstdCompressor, chunk: int = CHUNK_BYTES,
                band: tuple[float, float] = CHUNK_BAND) -> tuple[float, int, int]:
    """Whole-text ratio, chunks outside the band, chunks; what is left over is judged with the chunk's length before the end."""
    if not text:
        return 0.0, 0, 0
    ratio = len(pack.compress(text)) / len(text)
    view, starts = memoryview(text), list(range(0, len(text) - chunk + 1, chunk))
    if len(text) > chunk and len(text) % chunk:
        starts.append(len(text) - chunk)
    bad = 0
    for at in starts:
        r = len(pack.compress(view[at:at + chunk])) / chunk
        bad += not band[0] <= r <= band[1]
    return ratio, bad, len(starts)


def octave(n_bytes: int) -> int:
    return n_bytes.bit_length()


def octave_of(n_bytes: str) -> Column:
    return F.length(F.bin(n_bytes))


def in_bands(n_bytes: int, ratio: float, bad: int, chunks: int, bands=BANDS, share: float = MAX_CHUNK_SHARE,
             usual: dict[int, float] | None = None) -> bool:
    low, high = next((lo, hi) for upto, lo, hi in bands if n_bytes < upto)
    return max(low, (usual or {}).get(octave(n_bytes), low)) <= ratio <= high and bad <= share * chunks


def base_fails(counts: tuple[int, ...]) -> bool:
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def measured(docs: DataFrame, chunk: int = CHUNK_BYTES, chunk_band: tuple[float, float] = CHUNK_BAND) -> DataFrame:
    """One row per row of ``docs``: base counts and compression ratios."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = base_counts(text)
                rows.append((doc, *counts, base_fails(counts), len(text), *compression(text, pack, chunk, chunk_band)))
            cols = list(zip(*rows)) or [[]] * len(OUT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, OUT)], schema=OUT)

    texts = text_of(docs)
    return texts.withColumn("text", texts["text"].cast("binary")).mapInArrow(run, SCHEMA)


def usual_ratios(rows: DataFrame, spreads: float = SPREADS, least: int = LEAST_TEXTS) -> dict[int, float]:
    """The lowest usual ratio for each octave of lengths, from all ``measured`` rows that pass the base rules (64 rows at most)."""
    stats = rows.where("not base_failed").groupBy(octave_of("n_bytes").alias("octave")).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("ratio", [0.5, 0.75], 10_000).alias("q")).where(F.col("n") >= least).collect()
    return {r["octave"]: r["q"][0] - spreads * (r["q"][1] - r["q"][0]) for r in stats}


def quality_rules(docs: DataFrame, bands=BANDS, chunk: int = CHUNK_BYTES, chunk_band: tuple[float, float] = CHUNK_BAND,
                  share: float = MAX_CHUNK_SHARE, spreads: float = SPREADS) -> DataFrame:
    """One row per row of ``docs``: base counts, ratios and the verdict ``kept``.

    ``base_failed``: fewer than ten words, or over a fifth of the words in
    repeated five-word windows; the bands judge what passes. Repeated rows and
    null ids pass through, a null or empty text has no words and fails, a text of
    any length is measured whole, an empty table gives no rows, and extra
    columns are not read. The measures are written under the checkpoint folder
    at once, since the usual ratios are learned from all of them.
    """
    spark = docs.sparkSession
    rows = measured(docs, chunk, chunk_band)
    rows = spark_read(spark, write_scratch(rows, "quality-measures"), rows)
    low, high = F.lit(bands[-1][1]), F.lit(bands[-1][2])
    for upto, lo, hi in reversed(bands[:-1]):
        low, high = (F.when(F.col("n_bytes") < upto, F.lit(own)).otherwise(rest) for own, rest in ((lo, low), (hi, high)))
    usual = usual_ratios(rows, spreads)
    if usual:
        ratios = F.create_map(*[F.lit(x) for pair in usual.items() for x in pair])
        low = F.greatest(low, F.coalesce(F.try_element_at(ratios, octave_of("n_bytes")), F.lit(0.0)))
    kept = ~F.col("base_failed") & (F.col("ratio") >= low) & (F.col("ratio") <= high) & (F.col("bad_chunks") <= share * F.col("n_chunks"))
    return rows.withColumn("kept", kept).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                "base_failed", "kept", "ratio", "bad_chunks", "n_chunks")


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns (no shuffle); texts are read twice, first for the usual ratios."""
    at = docs.columns.index("text")
    usual = usual_ratios(measured(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            yield batch.filter(pa.array([keeps((t or "").encode(), pack, usual) for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def keeps(text: bytes, pack: zstandard.ZstdCompressor, usual: dict[int, float] | None = None) -> bool:
    return not base_fails(base_counts(text)) and in_bands(len(text), *compression(text, pack), usual=usual)


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
                 ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()),
                 ("n_bytes", pa.int64()), ("ratio", pa.float64()), ("bad_chunks", pa.int64()), ("n_chunks", pa.int64())])


def q_quality(spark, sf_dir) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
