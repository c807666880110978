"""E5: a stored inverted-file index of vectors.

``build_index`` fits centroids on a bounded sample, puts *every* row into the
cell of its nearest centroid and writes the cells as partitions of a Parquet
table, each row with its sign signature, beside a small table of the centroids.
A search ranks the cells of each query, reads only the partitions that some
query visits, and scores in each cell only the rows with the nearest signatures.
Cells are written in ranges of (cell, id), so a cell that holds most rows spans
as many files and search parts as its size needs.

A query visits its ``probes`` nearest cells, and further ones until they hold k
rows, so it gets k rows whenever the index has them. The defaults suit vectors
without clusters, where a query's neighbours lie in many cells; clustered ones
need fewer probes. With ``exact`` every row of the visited cells is scored, and
then every cell that may hold a better row is visited too: by the triangle
inequality on angles, no row of a cell is nearer to the query than the angle to
the centroid less the cell's reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators import vectors as V
from gleaner.session import scratch_path

SAMPLE_ROWS = 20_000     # rows that centroids are fitted on
MAX_CELLS = 4096
ROUNDS = 12
PROBES = 0.6             # share of the cells that a query visits
SCORED = 0.12            # of a visited part's rows, but k at least
SLACK = 2e-6             # scores are rounded to 6 places


def fit_centroids(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means on unit rows, from rows spread evenly over the sample; a cell that loses all rows takes the worst served one."""
    centroids = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        sims = sample @ centroids.T
        own, best = sims.argmax(axis=1), sims.max(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=len(centroids)) == 0)
        sums[empty] = sample[np.argsort(best, kind="stable")[:len(empty)]]
        centroids = V._unit(sums)
    return centroids


def build_index(base: DataFrame, path: str, id_col: str = "vec_id", vec_col: str = "embedding", keep: tuple[str, ...] = (),
                cells: int | None = None, sample_rows: int = SAMPLE_ROWS, dim: int | None = None) -> "VectorIndex":
    """Write the index of ``base`` under ``path`` (a folder that all executors share).

    Null vectors and vectors with null or NaN components are left out, and so
    are vectors of another dimension than ``dim`` (default: the one most rows
    have, of equally frequent ones the larger). ``cells`` defaults to the square
    root of the number of rows, 4096 at most. The sample is the ``sample_rows``
    rows with the least id hashes.
    """
    rows = base.where(V._usable(vec_col)).select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_v"), *keep)
    sizes = rows.groupBy(F.size("_v").alias("d")).agg(F.count(F.lit(1)).alias("n")).where("d > 0")
    if dim is not None:
        sizes = sizes.where(F.col("d") == dim)
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    d, n = (top["d"], top["n"]) if top else (dim or 1, 0)
    rows = rows.where(F.size("_v") == d)
    sample = rows.select(F.col("_v").cast("array<double>").alias("_v"), F.xxhash64("_id").alias("h")).orderBy("h").limit(sample_rows).toArrow()
    vectors = V.vectors_of(sample.column("_v").combine_chunks())[d][1] if n else np.zeros((1, d))
    centroids = fit_centroids(vectors, cells or max(1, min(MAX_CELLS, round(n ** 0.5))))
    spark = base.sparkSession
    spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], "cell int, centroid array<double>") \
        .coalesce(1).write.parquet(f"{path.rstrip('/')}/centroids")
    index = VectorIndex(spark, path, rows.schema)
    index._write(rows)
    return index


class VectorIndex:
    """A written index; ``open_index`` finds one again."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        rows = spark.read.schema("cell int, centroid array<double>").parquet(f"{self.path}/centroids").orderBy("cell").collect()
        self.centroids = np.array([r["centroid"] for r in rows])

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    def _write(self, rows: DataFrame) -> None:
        shared = self.spark.sparkContext.broadcast(self.centroids)
        marks = V.Signatures(V.SIGNATURE_BITS, 0)
        schema = T.StructType([*rows.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_sim", T.DoubleType()),
                               T.StructField("_sig", T.BinaryType())])
        names = [f.name for f in schema.fields]

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                units = V.vectors_of(batch.column("_v"))[shared.value.shape[1]][1]
                sims = units @ shared.value.T
                # a zero vector has no angle to anything: its cell reaches everywhere
                best = np.where(units.any(axis=1), sims.max(axis=1), -1.0)
                signs = pa.array([m.tobytes() for m in marks.mark(units)], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sims.argmax(axis=1).astype(np.int32)), pa.array(best), signs], names=names)

        placed = rows.mapInArrow(assign, schema).withColumn("_h", F.xxhash64("_id"))
        (placed.repartitionByRange("_cell", "_h").sortWithinPartitions("_cell", "_h").withColumn("cell", F.col("_cell")).drop("_cell")
         .write.mode("append").partitionBy("cell").parquet(f"{self.path}/rows"))
        self._measure()

    def _measure(self) -> None:
        """Rows and reach of every cell, one row each."""
        stats = self.rows().groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("_sim").alias("reach")).collect()
        self.sizes, self.reach = np.zeros(len(self.centroids), np.int64), np.ones(len(self.centroids))
        for r in stats:
            self.sizes[r["cell"]], self.reach[r["cell"]] = r["n"], r["reach"]

    def rows(self) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("_sim", T.DoubleType()), T.StructField("_sig", T.BinaryType()),
                               T.StructField("_h", T.LongType()), T.StructField("cell", T.IntegerType())])
        if not path_exists(self.spark, f"{self.path}/rows"):
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(f"{self.path}/rows")

    def append(self, base: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> None:
        """Put further rows into the cells there are; the centroids stay."""
        keep = [f.name for f in self.schema.fields if f.name not in ("_id", "_v")]
        rows = base.where(V._usable(vec_col) & (F.size(vec_col) == self.dim)).select(
            *[F.col(c).cast(self.schema[t].dataType).alias(t) for c, t in ((id_col, "_id"), (vec_col, "_v"))], *keep)
        self._write(rows)

    # -- search ---------------------------------------------------------------

    def _plan(self, queries: DataFrame, k: int, probes: int, kind: str) -> DataFrame:
        """(_qid, _v, cell) of the visits: ``near`` the first pass, ``more`` the cells that a bound still allows (needs _least)."""
        shared = self.spark.sparkContext.broadcast((self.centroids, self.sizes, self.reach))
        fields = [queries.schema["_qid"], queries.schema["_v"], T.StructField("cells", T.ArrayType(T.IntegerType()))]

        def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centroids, sizes, reach = shared.value
            there = np.flatnonzero(sizes)
            angles = np.arccos(np.clip(reach[there], -1, 1))
            for batch in batches:
                if not batch.num_rows:
                    continue
                units = V.vectors_of(batch.column("_v"))[centroids.shape[1]][1]
                sims = units @ centroids[there].T
                lists = []
                for i, line in enumerate(sims):
                    order = np.argsort(-line, kind="stable")
                    enough = int(np.searchsorted(np.cumsum(sizes[there][order]), k)) + 1
                    first = order[:max(probes, enough)]
                    if kind == "more":
                        least = batch.column("_least")[i].as_py()
                        apart = np.arccos(np.clip(line, -1, 1)) - angles
                        bound = np.where(units[i].any(), np.cos(np.clip(apart, 0, np.pi)), 1.0)
                        may = np.ones(len(there), bool) if least is None else bound + SLACK >= least
                        may[first] = False
                        first = np.flatnonzero(may)
                    lists.append(there[first].tolist())
                yield pa.RecordBatch.from_arrays([batch.column("_qid"), batch.column("_v"), pa.array(lists, pa.list_(pa.int32()))],
                                                 names=[f.name for f in fields])

        return queries.mapInArrow(visits, T.StructType(fields)).select("_qid", "_v", F.explode("cells").alias("cell"))

    def _visit(self, visits: DataFrame, k: int, qid_col: str, keep: tuple[str, ...], candidates=None) -> DataFrame:
        visits = visits.withColumn("cell", F.col("cell").cast("bigint"))
        path = scratch_path(self.spark, "vector-visits")
        visits.write.parquet(path)
        visits = self.spark.read.schema(visits.schema).parquet(path)
        wanted = sorted(r["cell"] for r in visits.select("cell").distinct().collect())      # at most MAX_CELLS numbers
        base = self.rows().where(F.col("cell").isin(wanted))
        # a cell is searched in as many parts as its size needs
        splits = [max(1, -(-int(n) * self.dim // V.PART_FLOATS)) for n in self.sizes]
        per_cell = F.element_at(F.array(*[F.lit(s) for s in splits]), (F.col("cell") + 1).cast("int")).cast("bigint")
        stride = F.lit(max(splits)).cast("bigint")
        base = base.withColumn("part", F.col("cell") * stride + F.pmod(F.col("_h"), per_cell))
        asked = visits.withColumn("part", F.explode(F.sequence(F.col("cell") * stride, F.col("cell") * stride + per_cell - 1)))
        return V.search_parts(base if candidates else base.drop("_sig"), asked, k, qid_col, keep, candidates)

    def search(self, queries: DataFrame, k: int, qid_col: str = "query_id", qvec_col: str = "query_vec", keep: tuple[str, ...] = (),
               probes: int | None = None, scored: float = SCORED, exact: bool = False) -> DataFrame:
        """Per query k rows: ``query_id, rank, id, score`` and the ``keep`` columns, as ``vectors.cosine_top_k`` gives them.

        ``probes`` defaults to ``PROBES`` of the cells; ``scored`` is the share
        of a visited part's rows that are scored, those with the nearest
        signatures. Queries that are null, hold null or NaN components or have
        another dimension than the index get no rows. The visits are written under ``spark.checkpoint.dir`` at once, to
        know which partitions to read.
        """
        asked = V.query_rows(queries, qid_col, qvec_col).where(F.size("_v") == self.dim)
        probes = probes or max(1, round(PROBES * len(self.centroids)))
        candidates = None if exact else V.NearestSignatures(scored, k)
        first = self._visit(self._plan(asked, k, probes, "near"), k, qid_col, keep, candidates)
        if not exact:
            return first
        path = scratch_path(self.spark, "vector-first")
        first.write.parquet(path)
        first = self.spark.read.schema(first.schema).parquet(path)
        least = first.where(F.col("rank") == k).select(F.col(qid_col).alias("_qid"), F.col("score").alias("_least"))
        again = asked.join(least, "_qid", "left").select("_qid", "_v", "_least")
        second = self._visit(self._plan(again, k, probes, "more"), k, qid_col, keep)
        w = V.Window.partitionBy(qid_col).orderBy(F.col("score").desc(), F.col("id"))
        return (first.unionByName(second).withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k))


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index written earlier."""
    stored = spark.read.parquet(f"{path.rstrip('/')}/rows").schema
    fields = [f for f in stored.fields if f.name not in ("_sim", "_sig", "_h", "cell")]
    index = VectorIndex(spark, path, T.StructType(fields))
    index._measure()
    return index
