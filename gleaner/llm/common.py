"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Iterable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.session import scratch_path

#: bytes.split() without arguments splits on exactly these: the white space of
#: the word pattern ``[^\x20\x09-\x0D]+``.
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Whether Spark deletes a query's shuffle files when it ends, and not only when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_of(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, the text with null read as empty, and ``more`` columns.

    Selecting first keeps other columns of ``docs`` (whatever their names) out
    of every later step and out of the Parquet scan.
    """
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fold_of(doc_id: Column | str, k: int = 5) -> Column:
    """crc32 of the id as text, modulo ``k``; a null id counts as the text ''."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(k)).cast("int")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` under the shared checkpoint folder and read it back."""
    return spark_read(df.sparkSession, write_scratch(df, name), df)


def write_scratch(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def write_parts(parts: Iterable[DataFrame], name: str) -> str:
    """Write frames of one schema to one scratch table, one after another.

    Spark deletes the shuffle files of each as soon as it is written, and the
    next can use their room. Parquet's newer encodings keep numbers as small differences.
    """
    path = None
    for df in parts:
        spark = df.sparkSession
        path = path or scratch_path(spark, name)
        before = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("append").option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0").parquet(path)
        finally:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return path


def spark_read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no returned DataFrame reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def worker_state(name: str) -> dict:
    """A dictionary that lives as long as the Python worker.

    The package is shipped by value, so a module's own globals are new in each
    task; what later tasks should find again (loaded vocabularies, encoded
    words) is kept under a module name of its own.
    """
    return sys.modules.setdefault("gleaner_worker_state", ModuleType("gleaner_worker_state")).__dict__.setdefault(name, {})


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
