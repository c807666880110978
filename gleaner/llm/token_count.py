"""Token counts with overlap resynchronisation for huge documents.

Texts up to ``chunk_chars`` are encoded whole. A longer one is cut into chunks
that overlap, so that one document is encoded by many tasks, and the counts are
spliced at a boundary that both neighbours found. A boundary counts as stable
only where this is proven:

* The tokenizer first finds special strings and pattern matches from left to
  right, looking at most one character past a match, then merges inside each
  match. What follows the start of a match therefore depends on nothing before
  it, so if two chunks both start a match at position p, they agree from p on.
* Chunk k agrees with the whole text from its own splice on, up to ``TAIL``
  characters before its end (a contraction or special string may be cut there).
* The first position of a chunk is never used: the cut made it a boundary.

So with splices p_k the count is ``sum(A_k(p_k) - B_k+1(p_k)) + tokens of the
last chunk``, where A and B are the tokens before p in a chunk and in the next
one. If two neighbours share no boundary in their overlap (one match spans it),
that document is cut again with a wider overlap, at last as one chunk.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import text_of, written

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 256
TAIL = 32                 # longer than any special string of the tokenizer plus a contraction
WIDER = 16
LIMIT = 512

_LOADED: dict = {}


def tokenizer(path: str):
    """Loaded once per Python worker; Spark's tasks are the parallelism."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
        longest = max([0, *(len(t.content) for t in _LOADED[path].get_added_tokens_decoder().values())])
        if longest + 3 > TAIL:
            raise ValueError(f"special strings of up to {longest} characters need a longer TAIL than {TAIL}")
    return _LOADED[path]


def count_whole(texts: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of texts encoded as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):        # encodings hold far more than counts
                part = batch.slice(at, 256)
                got = [len(e) for e in t.encode_batch_fast(part.column(2).to_pylist(), add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(got, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    return texts.select("doc_id", "n_bytes", "text").mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")


def cut(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, k, last, first, piece): chunks of ``chunk`` characters, each ``overlap`` into the next."""
    step = chunk - overlap

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k = 0
                while True:
                    last = len(text) <= k * step + chunk
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array([key]), "k": pa.array([k], pa.int32()), "last": pa.array([last]),
                        "first": pa.array([k * step], pa.int64()), "piece": pa.array([text[k * step:k * step + chunk]])})
                    if last:
                        break
                    k += 1

    return texts.select("key", "text").mapInArrow(run, "key string, k int, last boolean, first bigint, piece string")


def boundaries(t, piece: str) -> tuple[int, list[tuple[int, int]]]:
    """Tokens of a chunk, and (position, tokens before it) where a match starts."""
    e = t.encode(piece, add_special_tokens=False)
    words, offsets = e.word_ids, e.offsets
    return len(words), [(offsets[i][0], i) for i in range(1, len(words)) if words[i] is None or words[i] != words[i - 1]]


def encode_chunks(chunks: DataFrame, path: str, overlap: int) -> DataFrame:
    """Tokens of each chunk and its match starts in the overlaps before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            for row in batch.to_pylist():
                n, starts = boundaries(t, row["piece"])
                size, first = len(row["piece"]), row["first"]
                left = [(first + p, i) for p, i in starts if 0 < p < overlap]
                right = [(first + p, i) for p, i in starts if size - overlap < p < size - TAIL]
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array([row["key"]]), "k": pa.array([row["k"]], pa.int32()), "last": pa.array([row["last"]]),
                    "n": pa.array([n], pa.int64()),
                    **{f"{side}_{what}": pa.array([[x[i] for x in found]], pa.list_(pa.int64()))
                       for side, found in (("left", left), ("right", right)) for i, what in enumerate(("at", "n"))}})

    return chunks.mapInArrow(run, "key string, k int, last boolean, n bigint, left_at array<bigint>, left_n array<bigint>, "
                                  "right_at array<bigint>, right_n array<bigint>")


def splice(encoded: DataFrame) -> DataFrame:
    """(key, n_tokens, aligned): the counts of a text's chunks joined at common boundaries."""
    w = Window.partitionBy("key").orderBy("k")
    both = (encoded.withColumn("next_at", F.lead("left_at").over(w)).withColumn("next_n", F.lead("left_n").over(w))
            .withColumn("p", F.array_min(F.array_intersect("right_at", "next_at"))))
    before = F.expr("element_at(right_n, cast(array_position(right_at, p) as int))")
    beyond = F.expr("element_at(next_n, cast(array_position(next_at, p) as int))")
    return (both.withColumn("part", F.when(F.col("last"), F.col("n")).when(F.col("p").isNotNull(), before - beyond))
            .groupBy("key").agg(F.sum("part").alias("n_tokens"), (F.count("part") == F.count(F.lit(1))).alias("aligned")))


def count_chunked(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(key, n_tokens) of the long ``texts`` (key, text), overlaps widened until every text is aligned."""
    todo, done = texts, None
    while True:
        pieces = cut(todo, chunk, overlap).repartition("key", "k")
        got = written(splice(encode_chunks(pieces, path, overlap)), "token-splices")
        fine = got.where("aligned").select("key", "n_tokens")
        done = fine if done is None else done.unionByName(fine)
        failed = got.where("not aligned").select("key")
        if failed.isEmpty():
            return done
        todo = todo.join(failed, "key", "left_semi")
        chunk, overlap = chunk * WIDER, overlap * WIDER


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK_CHARS,
                 overlap: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``.

    A null text is empty (no bytes, no tokens); null ids and repeated rows pass
    through (equal long texts are encoded once); an empty table gives no rows;
    extra columns are not read. Special strings in a text are special tokens,
    as is the library's default.
    """
    if not 2 * TAIL < overlap <= chunk // 2:
        raise ValueError(f"overlap {overlap} must lie between {2 * TAIL} and half the chunk {chunk}")
    texts = text_of(docs).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    whole = count_whole(texts.where(F.col("n_bytes") <= chunk), path)
    keyed = texts.where(F.col("n_bytes") > chunk).withColumn("key", F.sha2("text", 256))
    distinct = written(keyed.select("key", "text").dropDuplicates(["key"]), "token-long-texts")
    counts = count_chunked(distinct, path, chunk, overlap)
    long = keyed.select("doc_id", "n_bytes", "key").join(counts, "key").select("doc_id", "n_bytes", "n_tokens")
    return whole.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)


def q_token_counts(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
