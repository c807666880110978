"""Embedding and vector search.

* E1 ``embed_chunks``: a user embedding function ``list[str] -> matrix`` runs
  inside ``mapInPandas``; a request whose calls do not all succeed fails as a
  whole, with the error's text.
* E4 ``cosine_top_k``: the base is dealt into parts of a bounded size and the
  queries, a DataFrame of any size, stream past every part (``Q @ B.T`` on unit
  vectors, top k per query and part). No pair table is ever materialised.
* E5 ``approx_top_k``: as E4, but only rows with a near sign signature are
  scored; checked by recall against E4. ``fill`` searches queries with too few
  near rows exactly. A stored index is in ``vector_index``.
* E6 ``check_vectors``: dimension / chunk length / column checks with a
  quarantine output.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.postings import barrier
from gleaner.session import scratch_path

PART_FLOATS = 8_000_000          # vector components of a part, which one task holds: 64 MB
SCORES_HELD = 4_000_000          # scores computed at a time
SCORE_DIGITS = 6                 # scores are ranked at this precision, ties by id


def feature_hash_embedder(dim: int = 64) -> Callable[[list[str]], np.ndarray]:
    """Deterministic bag-of-words feature hashing, L2-normalised, float32."""
    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, t in enumerate(texts):
            for w in (t or "").lower().split():
                h = zlib.crc32(w.encode("utf-8"))
                out[i, h % dim] += 1.0 if (h >> 16) & 1 else -1.0
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norms == 0, 1.0, norms)
    return embed


def embed_chunks(df: DataFrame, fn: Callable[[list[str]], object], request: str | list[str], text: str = "chunk_txt",
                 dim: int | None = None, admitted: str | None = None, rows_per_call: int = 2048) -> DataFrame:
    """Add ``ok boolean``, ``error string`` and ``vec array<float>``; all-or-nothing per request.

    A request is the rows that share the ``request`` columns, however many and
    wherever they lie. ``fn`` gets at most ``rows_per_call`` texts of one
    request at a time (an embedding API caps the inputs of a call); if any of
    a request's calls fails, no row of it gets a vector and all carry the first
    error's text. With ``admitted`` (a boolean column, e.g. from ``budget``) a
    request with a refused row is not sent at all. The calls are made at once
    and their results written under ``spark.checkpoint.dir``.
    """
    if fn is None:
        raise ValueError("embed_chunks needs an embedding function, e.g. feature_hash_embedder(64)")
    keys = [request] if isinstance(request, str) else list(request)
    own = F.struct(*keys)
    if admitted is None:
        src = df.withColumn("_send", F.lit(True))
    else:
        refused = df.where(~F.coalesce(F.col(admitted), F.lit(False))).select(own.alias("_request")).distinct()
        src = (df.withColumn("_request", own).join(refused.withColumn("_refused", F.lit(True)), "_request", "left")
               .withColumn("_send", F.col("_refused").isNull()).drop("_request", "_refused"))
    schema = T.StructType(src.schema.fields + [T.StructField("error", T.StringType()),
                                               T.StructField("vec", T.ArrayType(T.FloatType()))])

    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        if not bool(pdf["_send"].iloc[0]):
            return pdf.assign(error="refused by the budget", vec=None)
        texts = pdf[text].fillna("").tolist()
        try:
            mat = np.asarray(fn(texts), dtype=np.float32)
            if mat.ndim != 2 or mat.shape[0] != len(texts) or (dim is not None and mat.shape[1] != dim):
                raise ValueError(f"the embedding function returned shape {mat.shape} for {len(texts)} texts")
            return pdf.assign(error=None, vec=list(mat))
        except Exception as exc:              # the caller's function may raise anything; it is reported, not hidden
            return pdf.assign(error=f"{type(exc).__name__}: {exc}", vec=None)

    def calls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, own in pdf.groupby(keys, sort=False, dropna=False):
                for at in range(0, len(own), rows_per_call):
                    yield call(own.iloc[at:at + rows_per_call])

    sent = src.mapInPandas(calls, schema).drop("_send")
    path = scratch_path(df.sparkSession, "embedded")
    sent.write.parquet(path)                   # two readers follow, and every text is sent once
    sent = df.sparkSession.read.schema(sent.schema).parquet(path)
    # one row per failed request, reduced before the shuffle; no request is gathered in one task
    failed = sent.where("error is not null").groupBy(own.alias("_request")).agg(F.min("error").alias("_error"))
    out = sent.withColumn("_request", own).join(failed, "_request", "left")
    return out.select(*df.columns, F.col("_error").isNull().alias("ok"), F.col("_error").alias("error"),
                      F.when(F.col("_error").isNull(), F.col("vec")).alias("vec"))


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1.0, n)


def _usable(vec: str):
    """Not null, and no component null or not a number."""
    c = F.col(vec)
    return F.coalesce(c.isNotNull() & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))), F.lit(False))


def vectors_of(lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Unit vectors by dimension: row numbers and a matrix."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    out = {}
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out[int(d)] = rows, _unit(flat[starts[rows][:, None] + np.arange(d)])
    return out


def best_rows(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k best entries above -inf; ties to the lower column."""
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    else:
        least = np.full(len(scores), -np.inf)
    rows, cols = [], []
    for i, (line, worst) in enumerate(zip(scores, least)):
        at = np.flatnonzero((line >= worst) & (line > -np.inf))
        at = at[np.argsort(-line[at], kind="stable")[:k]]
        rows.append(np.full(len(at), i))
        cols.append(at)
    return np.concatenate(rows), np.concatenate(cols)


class _Part:
    """The base rows of one part, in the order of their ids, and the search of query rows among them."""

    def __init__(self, table: pa.Table, candidates):
        ids = table.column("_id").to_numpy()
        self.table = table.take(pa.array(np.argsort(ids, kind="stable")))
        self.by_dim = vectors_of(self.table.column("_v").combine_chunks())
        self.candidates = candidates
        if candidates and "_sig" in table.column_names:
            stored = np.frombuffer(b"".join(self.table.column("_sig").to_pylist()), np.uint8).reshape(self.table.num_rows, -1)
            self.marks = {d: stored[rows] for d, (rows, _) in self.by_dim.items()}
        else:
            self.marks = {d: candidates.mark(m) for d, (_, m) in self.by_dim.items()} if candidates else {}

    def search(self, queries: pa.RecordBatch, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Query rows, base rows and scores of the hits."""
        for d, (q_rows, q) in vectors_of(queries.column("_v")).items():
            if d not in self.by_dim:
                continue
            rows, base = self.by_dim[d]
            if self.candidates:
                for row, one, mark in zip(q_rows, q, self.candidates.mark(q)):
                    at = self.candidates.near(self.marks[d], mark)
                    scores = np.round(base[at] @ one, SCORE_DIGITS)[None, :]
                    _, j = best_rows(scores, k)
                    yield np.full(len(j), row), rows[at[j]], scores[0, j]
                continue
            step = max(1, SCORES_HELD // len(rows))
            for at in range(0, len(q_rows), step):
                scores = np.round(q[at:at + step] @ base.T, SCORE_DIGITS)
                i, j = best_rows(scores, k)
                yield q_rows[at + i], rows[j], scores[i, j]


def search_parts(base: DataFrame, queries: DataFrame, k: int, qid_col: str, keep: tuple[str, ...] = (), candidates=None) -> DataFrame:
    """The k best base rows of each query over the parts it visits.

    ``base``: part, _id, _v and the ``keep`` columns; ``queries``: part, _qid
    and _v, one row for each part to visit. A part's base rows are held by one
    task and must fit there (see ``PART_FLOATS``); its queries stream past them,
    so neither side is collected and no query set is too large. A part emits at
    most k rows per query to the final window. With ``candidates`` only the rows
    that these name are scored; a ``_sig`` column saves computing their marks.
    """
    q = queries.select("part", F.lit(1).alias("kind"), "_qid", F.col("_v").cast("array<double>").alias("_v"))
    marks = [c for c in base.columns if c == "_sig"]
    b = base.select("part", F.lit(0).alias("kind"), "_id", F.col("_v").cast("array<double>").alias("_v"), *marks, *keep)
    both = b.unionByName(q, allowMissingColumns=True)
    fields = [T.StructField(qid_col, queries.schema["_qid"].dataType), T.StructField("id", base.schema["_id"].dataType),
              T.StructField("score", T.DoubleType()), *[base.schema[c] for c in keep]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, rows = None, [], None
        for batch in batches:
            parts, kinds = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if lo == hi:
                    continue
                own = batch.slice(lo, hi - lo)
                if parts[lo] != part:
                    part, held, rows = parts[lo], [], None
                if kinds[lo] == 0:
                    held.append(own)
                    continue
                if held and rows is None:
                    rows, held = _Part(pa.Table.from_batches(held), candidates), []
                for qi, bi, scores in rows.search(own, k) if rows else ():
                    hit = rows.table.select(["_id", *keep]).take(pa.array(bi)).combine_chunks().columns
                    flat = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in hit]
                    yield pa.RecordBatch.from_arrays([own.column("_qid").take(pa.array(qi)), flat[0], pa.array(scores), *flat[1:]],
                                                     names=[f.name for f in fields])

    found = both.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(run, T.StructType(fields))
    w = Window.partitionBy(qid_col).orderBy(F.col("score").desc(), F.col("id"))
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(qid_col, F.col("rank").cast("bigint"), "id", "score", *keep))


def query_rows(queries: DataFrame, qid_col: str, qvec_col: str) -> DataFrame:
    """_qid and _v of the usable queries; of several rows with one id the least vector is searched."""
    return queries.where(_usable(qvec_col)).groupBy(F.col(qid_col).alias("_qid")).agg(
        F.min(F.col(qvec_col).cast("array<double>")).alias("_v"))


def _top_k(base: DataFrame, queries: DataFrame, k: int, id_col: str, vec_col: str, qid_col: str, qvec_col: str,
           keep: tuple[str, ...], candidates) -> DataFrame:
    src = base.where(_usable(vec_col)).select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"), *keep)
    floats = src.agg(F.sum(F.size("_v").cast("bigint")).alias("n")).first()["n"] or 0
    parts = max(1, -(-floats // PART_FLOATS))
    dealt = src.withColumn("part", F.pmod(F.xxhash64("_id"), F.lit(parts)))
    asked = query_rows(queries, qid_col, qvec_col).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    return search_parts(dealt, asked, k, qid_col, keep, candidates)


def cosine_top_k(base: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
                 qid_col: str = "query_id", qvec_col: str = "query_vec", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per query the k most cosine-similar base rows.

    Output ``query_id, rank, id, score`` (rounded to 6 places; ranks by rounded
    score then id) and the ``keep`` columns of the base row, e.g. ``chunk_idx``
    and ``chunk_txt``. Null vectors and vectors with null or NaN components
    take no part; a query meets only base vectors of its own dimension; no
    queries or no base rows give no rows. The base is dealt once, by id, into
    parts of a bounded size, and the queries go to every part.
    """
    return _top_k(base, queries, k, id_col, vec_col, qid_col, qvec_col, keep, None)


SIGNATURE_BITS, SIGNATURE_REACH = 384, 162
PRIME = 2**31 - 1


def signature_planes(dim: int, bits: int = SIGNATURE_BITS) -> np.ndarray:
    """bits x dim random hyperplanes from an integer rule any engine can repeat."""
    i = np.arange(bits * dim, dtype=np.int64)
    h = (i * 48271 + 11) % PRIME
    h = h * h % PRIME
    return ((h * h + i) % PRIME / PRIME - 0.5).reshape(bits, dim)


class Signatures:
    """Candidates by sign signatures: one bit per hyperplane, near in at most ``reach`` differing bits."""

    def __init__(self, bits: int, reach: int):
        self.bits, self.reach = bits, reach

    def mark(self, m: np.ndarray) -> np.ndarray:
        return np.packbits(m @ signature_planes(m.shape[1], self.bits).T > 0, axis=1)

    def differing(self, base: np.ndarray, query: np.ndarray) -> np.ndarray:
        return np.bitwise_count(base ^ query).sum(axis=1, dtype=np.int64)

    def near(self, base: np.ndarray, query: np.ndarray) -> np.ndarray:
        return np.flatnonzero(self.differing(base, query) <= self.reach)


class NearestSignatures(Signatures):
    """Candidates are the ``share`` of a part's rows with the nearest signatures, ``least`` rows at least, and all that tie with them."""

    def __init__(self, share: float, least: int, bits: int = SIGNATURE_BITS):
        super().__init__(bits, bits)
        self.share, self.least = share, least

    def near(self, base: np.ndarray, query: np.ndarray) -> np.ndarray:
        differing, wanted = self.differing(base, query), max(self.least, int(np.ceil(self.share * len(base))))
        if wanted >= len(base):
            return np.arange(len(base))
        return np.flatnonzero(differing <= np.partition(differing, wanted - 1)[wanted - 1])


def approx_top_k(base: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
                 qid_col: str = "query_id", qvec_col: str = "query_vec", keep: tuple[str, ...] = (),
                 bits: int = SIGNATURE_BITS, reach: int = SIGNATURE_REACH, fill: bool = False) -> DataFrame:
    """E5: approximate top-k: exact scores only for rows whose sign signature is near the query's.

    A signature has one bit per hyperplane. Unrelated vectors differ in half of
    the bits, vectors at angle t in t/pi of them; rows that differ from the query
    in at most ``reach`` bits are candidates. Signatures are compared by popcount inside the base partitions.

    A query with fewer than ``k`` rows within reach gets only those; with
    ``fill`` it is searched again exactly, as by ``cosine_top_k``, so every query
    gets k rows if the base has them. Filling writes the first search under
    ``spark.checkpoint.dir`` at once, to see which queries are short.
    """

    found = _top_k(base, queries, k, id_col, vec_col, qid_col, qvec_col, keep, Signatures(bits, reach))
    if not fill:
        return found
    path = scratch_path(base.sparkSession, "approx-top-k")
    found.write.parquet(path)
    found = base.sparkSession.read.schema(found.schema).parquet(path)
    full = found.where(F.col("rank") == k).select(qid_col)
    short = queries.where(_usable(qvec_col)).join(full, qid_col, "left_anti")
    if short.isEmpty():
        return found
    return found.join(full, qid_col, "left_semi").unionByName(
        cosine_top_k(base, short, k, id_col, vec_col, qid_col, qvec_col, keep))


VECTOR_COLUMNS = ("application_id", "chunk_idx", "chunk_txt", "chunk_vec")


def check_vectors(df: DataFrame, dim: int, chunk_size: int) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) for vector rows: int config, exact column set,
    ``size(chunk_vec) = dim``, ``char_length(chunk_txt) <= chunk_size``."""
    if not isinstance(dim, int) or not isinstance(chunk_size, int):
        raise TypeError("dim and chunk_size must be int")
    extra = sorted(set(df.columns) - set(VECTOR_COLUMNS))
    missing = sorted(set(VECTOR_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError(f"missing vector columns: {missing}")
    errs = F.filter(F.array(
        F.when(F.col("chunk_vec").isNull() | (F.size("chunk_vec") != dim), F.lit("E6_dim")),
        F.when(F.col("chunk_txt").isNull() | (F.char_length("chunk_txt") > chunk_size), F.lit("E6_chunk_len")),
        F.when(F.col("application_id").isNull(), F.lit("E6_id_null")),
        *[F.lit(f"E6_extra_{c}") for c in extra]), lambda e: e.isNotNull())
    tagged = barrier(df.withColumn("_errors", errs), "check_vectors")
    good = tagged.filter(F.size("_errors") == 0).select(*VECTOR_COLUMNS)
    bad = tagged.filter(F.size("_errors") > 0)
    return good, bad
