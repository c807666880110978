"""Sharding by global byte prefix sums (DataFrame functions only).

Rows are put in one global order (doc_id, then crc and size of the text),
every row gets the number of bytes before it, and the line of bytes is cut at
equal targets, so each shard is a contiguous run of the order and differs from
the target by less than one row at either end (law ``bytes``).

The prefix sum never puts the data in one task: rows are range-partitioned,
each partition is summed, the running sum over those totals (one row per
partition) is broadcast, and rows add their own running sum inside the
partition. Only (doc_id, size, crc) is shuffled, never the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import drop_scratch, spark_read, write_scratch

ROW_BYTES = 8          # added to every row's text bytes


def row_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 8) and the text's unsigned crc32."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"))


def byte_shards(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """Cut ``docs`` into ``n_shards`` contiguous shards of nearly equal bytes.

    Returns doc_id, size, text_crc32, shard, slot (position in the shard, from
    0) and start (bytes before the row). Defined for odd input: a null text is
    empty (crc32 0, size 8); null ids sort first; repeated rows keep separate
    slots; an empty table gives no rows; a row larger than a shard's target
    leaves shards beside it empty. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    slim = row_sizes(docs).withColumn("tie", F.monotonically_increasing_id())
    slim_path = write_scratch(slim, "shard-sizes")        # the text is read once
    order = ["doc_id", "text_crc32", "size", "tie"]
    ranged = (spark_read(spark, slim_path, slim).repartitionByRange(*order)
              .withColumn("part", F.spark_partition_id()))
    rows_path = write_scratch(ranged, "shard-rows")       # fixes the partition of every row
    drop_scratch(spark, slim_path)
    rows = spark_read(spark, rows_path, ranged)

    # one row per partition: its totals, then what lies before it
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("part_bytes").over(Window.partitionBy()).alias("total"))

    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.withColumn("upto", F.sum("size").over(inside))
              .withColumn("nth", F.count(F.lit(1)).over(inside))
              .join(F.broadcast(offsets), "part")
              .select("doc_id", "size", "text_crc32",
                      (F.col("bytes_before") + F.col("upto") - F.col("size")).alias("start"),
                      (F.col("rows_before") + F.col("nth") - 1).alias("rank"), "total"))
    # the shard whose span holds the middle of the row; long arithmetic is
    # exact up to 2^63 / (2 * n_shards) bytes
    cut = F.expr(f"least(({n_shards}L * (2L * start + size)) div (2L * total), {n_shards - 1}L)")
    sharded = placed.withColumn("shard", cut.cast("int"))
    firsts = sharded.groupBy("shard").agg(F.min("rank").alias("first"))     # n_shards rows at most
    return (sharded.join(F.broadcast(firsts), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"), "start"))


def q_sharding(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return byte_shards(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
