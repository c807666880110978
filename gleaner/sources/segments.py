"""S10, S11 as a running policy: landed topics in time segments.

Messages lie under ``topic=<t>/segment=<n>``, n being the number of the time
segment their timestamp falls in. Retention removes whole segments without
reading a message; compaction rewrites only the segments that hold a message
whose key has a newer one, and leaves the files of the others alone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.messages import ENVELOPE_SCHEMA
from gleaner.session import scratch_path
from gleaner.sources.topics import RETENTION_HOURS, SEGMENT_HOURS

STORED = T.StructType([*(f for f in ENVELOPE_SCHEMA.fields if f.name != "topic"), T.StructField("topic", T.StringType()),
                       T.StructField("segment", T.LongType())])


class SegmentedTopics:
    """Landed topics under ``root`` in segments of ``hours``."""

    def __init__(self, spark: SparkSession, root: str, hours: int = SEGMENT_HOURS):
        self.spark, self.root, self.hours = spark, root.rstrip("/"), hours

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _folders(self, path: str, name: str) -> list[str]:
        fs, p = self._fs(path)
        names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n.removeprefix(f"{name}=") for n in names if n.startswith(f"{name}="))

    def land(self, envelopes: DataFrame) -> None:
        """Append messages to the segments of their timestamps (UTC)."""
        segment = F.floor(F.unix_seconds(F.col("timestamp").cast("timestamp")) / (3600 * self.hours)).cast("bigint")
        # as many tasks as a shuffle has: segments are many small folders
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (envelopes.select(*ENVELOPE_SCHEMA.names).withColumn("segment", segment).repartition(n, "topic", "segment")
         .write.mode("append").partitionBy("topic", "segment").parquet(self.root))

    def segments(self) -> list[tuple[str, int]]:
        return [(t, int(s)) for t in self._folders(self.root, "topic") for s in self._folders(f"{self.root}/topic={t}", "segment")]

    def read(self) -> DataFrame:
        fs, p = self._fs(self.root)
        if not fs.exists(p):
            return self.spark.createDataFrame([], STORED)
        return self.spark.read.schema(STORED).parquet(self.root)

    def retain(self, now: str | datetime, hours: int = RETENTION_HOURS) -> list[tuple[str, int]]:
        """Remove the segments that ended more than ``hours`` before ``now`` (UTC); they are returned."""
        moment = datetime.fromisoformat(now) if isinstance(now, str) else now
        epoch = (moment.replace(tzinfo=None) - datetime(1970, 1, 1)).total_seconds()
        old = [(t, s) for t, s in self.segments() if (s + 1) * self.hours * 3600 < epoch - hours * 3600]
        for t, s in old:
            fs, p = self._fs(f"{self.root}/topic={t}/segment={s}")
            fs.delete(p, True)
        return old

    def compact(self) -> list[tuple[str, int]]:
        """Keep each key's newest message by (partition, offset), and none whose newest is a null value.

        Messages without a key stay. Returns the segments that were rewritten:
        their surviving messages are written aside, then take their place.
        """
        rows = self.read()
        newest = rows.where("key is not null").groupBy("topic", "key").agg(
            F.max_by(F.struct("partition", "offset", F.col("value").isNull().alias("gone")), F.struct("partition", "offset")).alias("newest"))
        seen = rows.join(newest, ["topic", "key"], "left")
        stays = F.col("key").isNull() | (~F.col("newest.gone") & (F.col("newest.partition") == F.col("partition"))
                                         & (F.col("newest.offset") == F.col("offset")))
        touched = sorted(tuple(r) for r in seen.where(~stays).select("topic", "segment").distinct().collect())
        if not touched:
            return []
        own = F.concat_ws("/", F.concat(F.lit("topic="), "topic"), F.concat(F.lit("segment="), F.col("segment").cast("string")))
        hit = rows.where(own.isin([f"topic={t}/segment={s}" for t, s in touched]) & F.col("topic").isin(sorted({t for t, _ in touched}))
                         & F.col("segment").isin(sorted({s for _, s in touched})))
        aside = scratch_path(self.spark, "segments")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        (hit.join(newest, ["topic", "key"], "left").where(stays).select(*STORED.names).repartition(n, "topic", "segment")
         .write.partitionBy("topic", "segment").parquet(aside))
        # one write puts every rewritten segment in its place; a segment without survivors goes
        self.spark.read.schema(STORED).parquet(aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("topic", "segment").parquet(self.root)
        for t, s in touched:
            fs, new = self._fs(f"{aside}/topic={t}/segment={s}")
            if not fs.exists(new):
                fs.delete(self._fs(f"{self.root}/topic={t}/segment={s}")[1], True)
        return touched
