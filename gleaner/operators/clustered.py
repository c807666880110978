"""E7 and S8 on a clustered table: sorted by a key, with a small table of what each file holds.

``write`` lays rows out in key order, one range of keys per file, and records
the first and last key of every file. A lookup asks that record which files can
hold the wanted ids and reads only those; a delete rewrites only those and
leaves every other file as it is. Each change makes a new version of the record
(the files it lists are the table), so readers of an older version are not
disturbed and a failed write changes nothing.

The record has one row per file, which is what the driver of any scan holds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "file string, lo string, hi string, n bigint"


class ClusteredTable:
    """Parquet files under ``path``, sorted by ``key``; versions of the record under ``path/_files``."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: T.StructType, version: int):
        self.spark, self.path, self.key, self.schema, self.version = spark, path.rstrip("/"), key, schema, version

    # -- the record ---------------------------------------------------------------

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "ClusteredTable":
        """The newest version."""
        jvm = spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_files")
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [st.getPath().getName() for st in fs.listStatus(folder)]
        done = [int(n.removeprefix("v=")) for n in names if n.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(folder, f"{n}/_SUCCESS"))]
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, "table.json"))
        about = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        return cls(spark, path, about["key"], T.StructType.fromJson(about["schema"]), max(done))

    @classmethod
    def write(cls, df: DataFrame, path: str, key: str, then: tuple[str, ...] = (), files: int | None = None) -> "ClusteredTable":
        """Write ``df`` as version 0, in ``files`` files (default: as many as a shuffle has partitions).

        ``then`` are further sort columns; with them a key that holds many rows
        spans several files. Rows without a key are kept and never looked up.
        """
        spark = df.sparkSession
        table = cls(spark, path, key, df.schema, -1)
        jvm = spark._jvm
        about = jvm.org.apache.hadoop.fs.Path(f"{table.path}/_files/table.json")
        stream = about.getFileSystem(spark._jsc.hadoopConfiguration()).create(about, False)
        stream.writeBytes(json.dumps({"key": key, "schema": df.schema.jsonValue()}))
        stream.close()
        return table._next(None, table._put(df, then, files))

    def record(self) -> DataFrame:
        return self.spark.read.schema(RECORD).parquet(f"{self.path}/_files/v={self.version}")

    def _put(self, df: DataFrame, then: tuple[str, ...] = (), files: int | None = None) -> DataFrame:
        """Write rows in key order to a folder of their own; the record rows of its files."""
        folder = f"{self.path}/data-{uuid.uuid4().hex[:12]}"
        n = files or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (df.repartitionByRange(n, self.key, *then).sortWithinPartitions(self.key, *then).write
         .option(f"parquet.bloom.filter.enabled#{self.key}", "true").parquet(folder))
        rows = self.spark.read.schema(self.schema).parquet(folder)
        return rows.groupBy(F.input_file_name().alias("file")).agg(
            F.to_json(F.struct(F.min(self.key).alias("k"))).alias("lo"), F.to_json(F.struct(F.max(self.key).alias("k"))).alias("hi"),
            F.count(F.lit(1)).alias("n"))

    def _next(self, kept: DataFrame | None, new: DataFrame) -> "ClusteredTable":
        record = new if kept is None else kept.unionByName(new)
        record.coalesce(1).write.parquet(f"{self.path}/_files/v={self.version + 1}")
        return ClusteredTable(self.spark, self.path, self.key, self.schema, self.version + 1)

    # -- reads --------------------------------------------------------------------

    def _read(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def rows(self) -> DataFrame:
        return self._read([r["file"] for r in self.record().select("file").collect()])

    def files_of(self, ids: DataFrame, id_col: str | None = None) -> list[str]:
        """The files whose range of keys holds some of ``ids``; the ids stay with the executors, file names come back."""
        kind = self.schema[self.key].dataType
        bounds = self.record().select("file", *[F.from_json(c, T.StructType([T.StructField("k", kind)]))["k"].alias(c) for c in ("lo", "hi")])
        rows = sorted((r for r in bounds.collect() if r["lo"] is not None), key=lambda r: (r["lo"], r["hi"]))
        if not rows:
            return []
        lows = self.spark.sparkContext.broadcast([r["lo"] for r in rows])
        highs = self.spark.sparkContext.broadcast(np.maximum.accumulate(np.array([r["hi"] for r in rows], dtype=object)).tolist())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = (np.array(x.value) if not isinstance(x.value[0], str) else np.array(x.value, dtype=object) for x in (lows, highs))
            hit = np.zeros(len(low), bool)
            for batch in batches:
                wanted = np.unique(np.array(batch.column(0).to_pylist(), dtype=low.dtype)) if batch.num_rows else []
                # files are in order of their first key; a wanted id is in those from the first that reaches it on
                for a, b in zip(np.searchsorted(high, wanted, side="left"), np.searchsorted(low, wanted, side="right")):
                    hit[a:b] = True
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(hit))], names=["file"])

        own = ids.select(F.col(id_col or self.key).cast(kind).alias("id")).where("id is not null")
        found = own.mapInArrow(run, "file bigint").distinct().collect()
        return [rows[r["file"]]["file"] for r in found]

    def lookup(self, ids: DataFrame, id_col: str | None = None) -> DataFrame:
        """The rows whose key is in ``ids``, from the files that can hold them."""
        wanted = ids.select(F.col(id_col or self.key).alias(self.key))
        return self._read(self.files_of(ids, id_col)).join(wanted, self.key, "left_semi")

    # -- changes ------------------------------------------------------------------

    def append(self, df: DataFrame, then: tuple[str, ...] = (), files: int | None = None) -> "ClusteredTable":
        """The next version, with further rows in files of their own."""
        return self._next(self.record(), self._put(df.select(*self.schema.names), then, files))

    def delete(self, ids: DataFrame, id_col: str | None = None, then: tuple[str, ...] = ()) -> "ClusteredTable":
        """The next version, without the rows whose key is in ``ids``; only files that can hold them are rewritten."""
        touched = self.files_of(ids, id_col)
        if not touched:
            return self
        gone = ids.select(F.col(id_col or self.key).alias(self.key))
        left = self._read(touched).join(gone, self.key, "left_anti")
        return self._next(self.record().where(~F.col("file").isin(touched)), self._put(left, then, len(touched)))
