"""Exact top-k inner products by pivot-table elimination.

Components are scaled and floored to integers, so scores are exact. Every
vector carries its distances to a few pivots. For a query q, a candidate x and
any pivot p the triangle inequality gives |q - x| >= | |q - p| - |x - p| |, and
since 2 q.x = |q|^2 + |x|^2 - |q - x|^2, the largest of these lower bounds gives
an upper bound on the score. Candidates are evaluated in the order of that
bound until it falls below the k-th best score so far: what is left cannot
enter the result.

Before that every query is scored against a bounded sample of the rows: its k-th
best score there is one that the result cannot fall below, so all parts start
with a threshold.

Vectors travel in blocks. The base is dealt once, over parts of a bounded number
of blocks that a task holds; the query blocks go to every part and stream past
its base blocks with a running top k per query, so a part emits at most k rows
per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import spark_read, write_scratch

SCALE = 64
PIVOTS = 64
PIVOT_SAMPLE = 2000       # rows that pivots are picked from; any pivots give exact results
BASE_BLOCK = 2048         # vectors
QUERY_BLOCK = 512
PART_BLOCKS = 64          # base blocks of a part at most
FIRST, LATER = 64, 1024   # candidates evaluated between two looks at the threshold: at first, and then
SLACK = 1e-5              # relative, above the rounding of float32 distances
NO_ID = np.iinfo(np.int64).max

LONG = 2**63 - 1

BLOCK_SCHEMA = "dim int, wide boolean, ids binary, rows binary, vectors binary, table binary, n int"
BLOCK_NAMES = ["dim", "wide", "ids", "rows", "vectors", "table", "n"]


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, row, v, wide): the scaled integer vectors (as doubles, which hold them exactly) of the rows that take part.

    ``wide`` rows have a norm of 2^31 or more, so that their scores may leave 62 bits.
    """
    v = F.transform("embedding", lambda x: F.rint(x.cast("double") * scale - F.when(F.rint(x.cast("double") * scale) > x.cast("double") * scale, 1.0).otherwise(0.0)))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
            .withColumn("row", F.monotonically_increasing_id()).where(F.coalesce(finite, F.lit(False)))
            .select("vec_id", "row", v.alias("v")).withColumn("wide", norm >= 2.0**31 - F.size("v")))


def pick_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal: each pivot is the sample row farthest from those picked."""
    x = sample.astype(float)
    chosen = [int(np.argmax((x * x).sum(axis=1)))]
    far = ((x - x[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < n and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def pivots_by_dimension(vectors: DataFrame, n: int, sample: int) -> dict[int, np.ndarray]:
    return {d: pick_pivots(x, n) for d, (x, _) in sampled(vectors, sample).items()}


def sampled(vectors: DataFrame, n: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors and row numbers of at most ``n`` rows that are not wide, chosen by hash, by dimension."""
    by_dim: dict[int, list] = {}
    for r in vectors.where("not wide").orderBy(F.xxhash64("v", "vec_id"), "row").limit(n).select("v", "row").collect():
        by_dim.setdefault(len(r.v), []).append(r)
    return {d: (np.array([r.v for r in rows]), np.array([r.row for r in rows])) for d, rows in by_dim.items() if d}


def distances(x: np.ndarray, pivots: np.ndarray | None) -> np.ndarray:
    """Pivot table: n x pivots float32; the last column is the norm (distance to the origin)."""
    x = x.astype(float)
    out = [np.sqrt(((x - p) ** 2).sum(axis=1)) for p in (pivots if pivots is not None else ())]
    return np.stack([*out, np.sqrt((x * x).sum(axis=1))], axis=1).astype(np.float32)


def blocks(vectors: DataFrame, size: int, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Rows packed into blocks of one dimension with their pivot distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[int, bool], list] = {}

        def block(kind: tuple[int, bool]) -> pa.RecordBatch:
            (dim, wide), got = kind, waiting.pop(kind)
            x = np.array([r[2] for r in got], dtype="<f8" if wide else "<i4").reshape(len(got), dim)
            table = distances(x, None if wide else pivots.get(dim))
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([wide]), pa.array([np.array([NO_ID if r[0] is None else r[0] for r in got], "<i8").tobytes()]),
                 pa.array([np.array([r[1] for r in got], "<i8").tobytes()]), pa.array([x.tobytes()]),
                 pa.array([table.astype("<f4").tobytes()]), pa.array([len(got)], pa.int32())], names=BLOCK_NAMES)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                own = waiting.setdefault((len(row[2]), row[3]), [])
                own.append(row)
                if len(own) == size:
                    yield block((len(row[2]), row[3]))
        for kind in list(waiting):
            yield block(kind)

    return vectors.select("vec_id", "row", "v", "wide").mapInArrow(run, BLOCK_SCHEMA)


class Block:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.rows = np.frombuffer(row["rows"], "<i8")
        self.dim, self.wide = row["dim"], row["wide"]
        self.x = np.frombuffer(row["vectors"], "<f8" if row["wide"] else "<i4").reshape(row["n"], row["dim"]).astype(float)
        self.table = np.frombuffer(row["table"], "<f4").reshape(row["n"], -1)
        self.norm = self.table[:, -1].astype(float)

    def whole(self) -> np.ndarray:
        """The components as Python integers, for scores of any size."""
        return np.array([[int(c) for c in v] for v in self.x.tolist()], dtype=object).reshape(self.x.shape)


class Running:
    """The top k of a block's queries over the base blocks seen so far; ``floor`` is a score that the result cannot fall below."""

    def __init__(self, queries: Block, k: int, floor: np.ndarray | None = None):
        self.q, self.k, self.floor = queries, k, floor
        self.top = [(np.empty(0, object), np.empty(0, np.int64)) for _ in queries.ids]   # scores, ids
        self.evaluated = 0

    def merge(self, i: int, base: Block, some: np.ndarray, scores: np.ndarray) -> None:
        s, n = np.concatenate([self.top[i][0], scores]), np.concatenate([self.top[i][1], base.ids[some]])
        best = np.lexsort((n, -s))[:self.k] if s.dtype != object else np.array(
            sorted(range(len(s)), key=lambda j: (-s[j], n[j]))[:self.k], dtype=np.int64)
        self.top[i] = s[best], n[best]

    def worst(self, i: int):
        """The score below which nothing can enter query i's result, if that is known yet."""
        scores = self.top[i][0]
        own = scores[-1] if len(scores) == self.k else None
        floor = None if self.floor is None else self.floor[i]
        return own if floor is None or np.isnan(floor) else floor if own is None else max(own, floor)

    def see(self, base: Block) -> None:
        q = self.q
        if q.wide or base.wide:
            mine, others = q.whole(), base.whole()
            for i in range(len(q.ids)):
                some = np.flatnonzero(base.rows != q.rows[i])
                self.evaluated += len(some)
                scores = [max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(mine[i], v)))) for v in others[some]]
                self.merge(i, base, some, np.array(scores, dtype=object))
            return
        exact = q.norm.max() * base.norm.max() < 2.0**52       # then float64 sums are exact integers
        rows, asked = (base.x, q.x) if exact else (base.x.astype(np.int64), q.x.astype(np.int64))
        gap, each = np.zeros((len(q.ids), len(base.ids)), np.float32), np.empty((len(q.ids), len(base.ids)), np.float32)
        for mine, others in zip(q.table.T, np.ascontiguousarray(base.table.T)):
            np.subtract(mine[:, None], others, out=each)
            np.maximum(gap, np.abs(each, out=each), out=gap)
        both = base.norm + q.norm[:, None]
        near = np.maximum(gap - SLACK * both, 0)
        bounds = (base.norm ** 2 + q.norm[:, None] ** 2 - near ** 2) / 2 + SLACK * both ** 2 + 1
        for i, bound in enumerate(bounds):
            worst = self.worst(i)
            order = np.flatnonzero((base.rows != q.rows[i]) if worst is None else (bound >= worst) & (base.rows != q.rows[i]))
            order = order[np.argsort(-bound[order])]
            at, step = 0, FIRST
            while at < len(order):
                some = order[at:at + step]
                if worst is not None and bound[some[0]] < worst:
                    break
                at, step = at + len(some), LATER
                self.evaluated += len(some)
                scores = rows[some] @ asked[i]
                if worst is not None:
                    some, scores = some[scores >= worst], scores[scores >= worst]
                if len(some):
                    self.merge(i, base, some, scores.astype(np.int64))
                    worst = self.worst(i)

    def result(self) -> pa.RecordBatch:
        n = [len(s) for s, _ in self.top]
        ids = np.concatenate([i for _, i in self.top])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.q.ids, n)), pa.array(np.repeat(self.q.rows, n)),
             pa.array(ids, mask=ids == NO_ID), pa.array([int(x) for s, _ in self.top for x in s], pa.int64())],
            names=["query_id", "query_row", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: int = SCALE, n_pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows of ``vectors`` for each row where ``is_query`` holds.

    Ties go to the smaller vec_id (null ids last). Candidates are all rows but
    the query's own, so a repeated row is a candidate of its twin; fewer than k
    candidates give fewer rows. A vector that is null or holds null or
    non-finite components takes no part; vectors of another length than the
    query's are no candidates; a score that does not fit a long is given as the
    nearest long; an empty table gives no rows; extra columns are not read.
    """
    spark = vectors.sparkSession
    table = usable(vectors, scale)
    table = spark_read(spark, write_scratch(table, "topk-vectors"), table)       # fixes the row numbers
    queries = table.where(is_query)
    sample = sampled(table, PIVOT_SAMPLE)                                        # bounded: rows x dimension
    pivots = {d: pick_pivots(x, n_pivots) for d, (x, _) in sample.items()}

    base = blocks(table, BASE_BLOCK, pivots).withColumn("block", F.monotonically_increasing_id())
    base = spark_read(spark, write_scratch(base, "topk-base"), base)
    asked = blocks(queries.repartition(max(1, -(-queries.count() // QUERY_BLOCK)), "row"), QUERY_BLOCK, pivots)
    asked = asked.withColumn("block", F.monotonically_increasing_id())
    asked = spark_read(spark, write_scratch(asked, "topk-queries"), asked)

    # parts: enough for every core, and none with more than PART_BLOCKS base blocks
    n_base = base.count()
    parts = max(1, -(-n_base // PART_BLOCKS), min(n_base, 2 * spark.sparkContext.defaultParallelism))
    held = base.select(F.pmod(F.hash("block"), F.lit(parts)).alias("part"), F.lit(0).alias("kind"), "block", *BLOCK_NAMES)
    past = asked.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(1).alias("kind"), "block", *BLOCK_NAMES)
    units = held.unionByName(past).repartition(parts, "part").sortWithinPartitions("part", "kind", "block")

    def floor_of(block: Block) -> np.ndarray | None:
        """The k-th best score of each query in the sample; nan where there are fewer."""
        if block.wide or block.dim not in sample:
            return None
        x, rows = sample[block.dim]
        if np.sqrt((x * x).sum(axis=1)).max() * block.norm.max() >= 2.0**52 or len(x) <= k:
            return None
        scores = np.where(rows == block.rows[:, None], -np.inf, block.x @ x.T)
        return np.partition(scores, len(x) - k, axis=1)[:, len(x) - k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, here = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["part"] != part:
                    part, here = row["part"], []
                if row["kind"] == 0:
                    here.append(Block(row))
                    continue
                block = Block(row)
                running = Running(block, k, floor_of(block))
                for one in here:
                    if one.dim == block.dim:
                        running.see(one)
                yield running.result()

    found = units.mapInArrow(run, "query_id bigint, query_row bigint, vec_id bigint, score bigint")
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def q_top_k(spark, sf_dir) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20)


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
