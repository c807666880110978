"""Topic streams, landed topic tables and page fetch results.

A topic is read with the Kafka source when its connector is on the
classpath, otherwise from a *landed* table: Parquet files holding the same
envelope columns (``topic, partition, offset, timestamp, key, value``),
partitioned by ``topic``. Everything downstream only sees the envelope
schema, so both paths share all operators.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.operators.messages import ENVELOPE_SCHEMA

# Topic layout of the pipeline (names are ours; partitions/retention follow
# the reference's provisioning: 3 partitions, 24 h retention, 12 h segments).
TOPICS = {
    "list_commands": "extract.postings.stage1.v1",
    "detail_commands": "extract.postings.stage2.v1",
    "list_pages": "raw.postings.stage1.v1",
    "detail_pages": "raw.postings.stage2.v1",
    "load": "load.postings.v1",
}
TOPIC_PARTITIONS = 3
RETENTION_HOURS = 24
SEGMENT_HOURS = 12


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create a folder through the Hadoop FileSystem API (works for any
    cluster file system, not only local disks)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def topic_path(root: str, topic: str) -> str:
    """Folder of one landed topic (Hive-style, so a batch ``partitionBy``
    write and a per-topic streaming file sink share one layout)."""
    return f"{root.rstrip('/')}/topic={topic}"


_STORED = [f for f in ENVELOPE_SCHEMA.fields if f.name != "topic"]


def read_topics(spark: SparkSession, source: str, topics: list[str], start: str | datetime | dict[str, int] = "earliest",
                streaming: bool = True, options: dict | None = None) -> DataFrame:
    """Subscribe to a set of topics.

    ``source`` is a Kafka bootstrap server list (``kafka://host:port,...``)
    or the root folder of landed topics. Returns envelope rows of those
    topics only (a topic folder that does not exist yet is skipped in batch
    mode; a stream waits for it to appear).

    ``start`` is ``earliest``, ``latest``, a time (messages stamped from then
    on) or, for landed topics, a first offset per topic (others from the
    earliest; Kafka takes its own JSON of offsets per partition). For landed
    topics ``latest`` is resolved when this is called, from the recorded
    offsets; a query that shall go on from its checkpoint keeps the positions
    of ``latest_offsets`` and passes them.
    """
    from functools import reduce

    from pyspark.sql import types as T

    options = options or {}
    if source.startswith("kafka://"):
        reader = spark.readStream if streaming else spark.read
        r = (reader.format("kafka").option("kafka.bootstrap.servers", source[len("kafka://"):])
             .option("subscribe", ",".join(topics)))
        if isinstance(start, datetime):
            r = r.option("startingTimestamp", str(int(start.timestamp() * 1000)))
        else:
            r = r.option("startingOffsets", start)
        for k, v in options.items():
            r = r.option(k, v)
        return r.load().select(*[f.name for f in ENVELOPE_SCHEMA.fields])
    if start == "latest":
        start = latest_offsets(spark, source, topics)
    elif isinstance(start, str) and start != "earliest":
        start = datetime.fromisoformat(start)
    frames = []
    for t in topics:
        path = topic_path(source, t)
        if streaming:
            ensure_dir(spark, path)
            # a topic's messages lie in its folder (publish) and in folders of batches (the pipeline)
            r = spark.readStream.schema(T.StructType(_STORED)).option("recursiveFileLookup", "true")
            for k, v in options.items():
                r = r.option(k, v)
            df = r.parquet(path)
        else:
            try:
                df = spark.read.schema(T.StructType(_STORED)).option("recursiveFileLookup", "true").parquet(path)
            except Exception as exc:   # topic never written
                if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
                    raise
                continue
        if isinstance(start, datetime):
            df = df.where(F.col("timestamp") >= F.lit(start))
        elif isinstance(start, dict) and t in start:
            df = df.where(F.col("offset") >= F.lit(start[t]))
        frames.append(df.select(F.lit(t).alias("topic"), *[f.name for f in _STORED]))
    if not frames:
        return spark.createDataFrame([], ENVELOPE_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), frames)


def latest_offsets(spark: SparkSession, source: str, topics: list[str]) -> dict[str, int]:
    """The offset that the next message of each landed topic will have at least."""
    return {t: next_offset(spark, topic_path(source, t)) for t in topics}


def to_envelope(df: DataFrame, topic: str | Column, key: str | Column | None, value: str | Column,
                partition: Column | None = None, offset: Column | None = None,
                timestamp: Column | None = None) -> DataFrame:
    """Shape rows as envelopes (used to land a table as a topic)."""
    t = F.lit(topic) if isinstance(topic, str) else topic
    k = F.lit(None).cast("binary") if key is None else (F.col(key) if isinstance(key, str) else key)
    v = F.col(value) if isinstance(value, str) else value
    if partition is None:
        partition = F.pmod(F.hash(k), F.lit(TOPIC_PARTITIONS))
    if offset is None:
        # landed files have no broker offsets: a unique id per write (batch),
        # or the ingest time in microseconds for a stream
        offset = F.unix_micros(F.current_timestamp()) if df.isStreaming else F.monotonically_increasing_id()
    return df.select(t.alias("topic"), partition.cast("int").alias("partition"),
                     offset.cast("bigint").alias("offset"),
                     (timestamp if timestamp is not None else F.current_timestamp()).cast("timestamp").alias("timestamp"),
                     k.cast("binary").alias("key"), v.cast("binary").alias("value"))


def _offset_marks(spark: SparkSession, folder: str):
    """File system, folder and (batch, next offset, name) of the marks that writers of a topic left."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_offsets")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return fs, p, sorted((int(n.split("..")[0]), int(n.split("..")[1]), n) for n in names if ".." in n and not n.startswith("."))


def next_offset(spark: SparkSession, folder: str, batch: int | None = None) -> int:
    """The offset that the next message of a topic (``folder``) gets, from the marks of earlier writes, without reading messages.

    For a pipeline's ``batch`` only marks of earlier batches (and of publishes,
    batch -1) count, so a batch that is written again numbers its messages as
    before. A folder without marks, landed by something else, is read once.
    """
    fs, p, marks = _offset_marks(spark, folder)
    mine = [n for b, n, _ in marks if batch is None or b < batch]
    if marks or not fs.exists(p.getParent()):
        return max(mine, default=0)
    files = [st for st in fs.listStatus(p.getParent()) if not st.getPath().getName().startswith(("_", "."))]
    if not files:
        return 0
    top = spark.read.schema("offset bigint").option("recursiveFileLookup", "true").parquet(folder).agg(F.max("offset").alias("top")).first().top
    return 0 if top is None else top + 1


def record_offset(spark: SparkSession, folder: str, offset: int, batch: int = -1, kept: int = 100) -> None:
    """Mark where the offsets of a written batch (-1: a publish) end; old marks go."""
    fs, p, marks = _offset_marks(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(p)
    fs.create(path(p, f"{batch}..{offset}"), True).close()
    for _, _, name in marks[:-kept]:
        fs.delete(path(p, name), False)


def publish(df: DataFrame, topic: str | None, sink: str, key: str | None = None,
            checkpoint: str | None = None, trigger: dict | None = None, query_name: str | None = None):
    """Keyed append to a topic.

    ``df`` has a ``value`` column (and optionally ``topic``/``key``). A
    ``kafka://`` sink uses the Kafka writer; anything else appends envelope
    Parquet files under ``sink/topic=<name>``. Streaming frames return the
    started query (its checkpoint makes delivery restartable) and need a
    fixed ``topic``; batch frames return the number of messages written,
    counted by ``observe`` on the write itself (a failed delivery fails the
    task, which Spark retries).
    """
    cols = df.columns
    t = F.lit(topic) if topic is not None else F.col("topic")
    k = F.col(key).cast("string").cast("binary") if key else (
        F.col("key") if "key" in cols else F.lit(None).cast("binary"))
    out = df.select(t.alias("topic"), k.alias("key"), F.col("value").cast("binary").alias("value"),
                    *[c for c in ("partition", "offset", "timestamp") if c in cols])
    kafka = sink.startswith("kafka://")
    folder = sink if topic is None else topic_path(sink, topic)
    if not kafka and "offset" not in cols and not df.isStreaming:
        # unique and growing over publishes, with gaps as a broker's may have
        out = out.withColumn("offset", F.lit(next_offset(df.sparkSession, folder)) + F.monotonically_increasing_id())
        cols = [*cols, "offset"]
    if not kafka:
        out = to_envelope(out, F.col("topic"), F.col("key"), F.col("value"),
                          F.col("partition") if "partition" in cols else None,
                          F.col("offset") if "offset" in cols else None,
                          F.col("timestamp") if "timestamp" in cols else None)
    if df.isStreaming:
        if checkpoint is None:
            raise ValueError("a streaming publish needs a checkpoint location")
        if not kafka:
            if topic is None:
                raise ValueError("a streaming file publish needs a fixed topic")
            out = out.drop("topic")
        w = out.writeStream.option("checkpointLocation", checkpoint)
        if query_name:
            w = w.queryName(query_name)
        if trigger:
            w = w.trigger(**trigger)
        if kafka:
            return w.format("kafka").option("kafka.bootstrap.servers", sink[len("kafka://"):]).start()
        return w.format("parquet").start(topic_path(sink, topic))
    from pyspark.sql import Observation

    obs = Observation("publish")
    top = F.lit(None).cast("bigint") if kafka else F.max("offset")
    out = out.observe(obs, F.count(F.lit(1)).alias("n"), top.alias("top"))
    if kafka:
        out.select("topic", "key", "value").write.format("kafka") \
            .option("kafka.bootstrap.servers", sink[len("kafka://"):]).save()
    else:
        out.write.mode("append").partitionBy("topic").parquet(sink)
        if obs.get["top"] is not None:
            record_offset(df.sparkSession, folder, max(obs.get["top"] + 1, next_offset(df.sparkSession, folder)))
    return int(obs.get["n"] or 0)


def replay(landed: DataFrame, topic: str, from_offset: int | None = None, to_offset: int | None = None,
           from_ts=None, to_ts=None) -> DataFrame:
    """S3: a slice of a topic (by offset and/or timestamp, inclusive)."""
    cond = F.col("topic") == topic
    if from_offset is not None:
        cond = cond & (F.col("offset") >= from_offset)
    if to_offset is not None:
        cond = cond & (F.col("offset") <= to_offset)
    if from_ts is not None:
        cond = cond & (F.col("timestamp") >= F.lit(from_ts).cast("timestamp"))
    if to_ts is not None:
        cond = cond & (F.col("timestamp") <= F.lit(to_ts).cast("timestamp"))
    return landed.filter(cond)


def retain(landed: DataFrame, now, hours: int = RETENTION_HOURS, segment_hours: int = SEGMENT_HOURS,
           ts: str = "timestamp") -> DataFrame:
    """Time retention at segment granularity.

    Rows fall into ``segment_hours`` segments; a whole segment is deleted
    once its *end* is older than ``now - hours`` (so rows may outlive the
    retention by up to one segment, as with the broker's policy). The oldest
    kept segment is known beforehand, so the filter is one comparison with a
    literal, which reaches the scan. ``now`` is wall-clock time
    (a ``datetime`` or ISO text).
    """
    from datetime import timedelta

    moment = datetime.fromisoformat(now) if isinstance(now, str) else now
    epoch, segment = datetime(1970, 1, 1), timedelta(hours=segment_hours)
    # kept: end of segment >= now - hours, that is start >= now - hours - segment
    behind = moment.replace(tzinfo=None) - timedelta(hours=hours) - segment - epoch
    oldest = epoch + -(-behind // segment) * segment
    kind = dict(landed.dtypes)[ts]
    return landed.filter(F.col(ts) >= F.lit(oldest.isoformat(sep=" ")).cast(kind))


def compact_by_key(landed: DataFrame) -> DataFrame:
    """Newest value per (topic, key) by (partition, offset); a null value
    (tombstone) deletes the key. Partial aggregation keeps hot keys cheap."""
    cols = [c for c in landed.columns if c not in ("topic", "key")]
    newest = landed.groupBy("topic", "key").agg(
        F.max_by(F.struct(*cols), F.struct("partition", "offset")).alias("_r"))
    return newest.select("topic", "key", "_r.*").filter(F.col("value").isNotNull())


# -- S4 / S5 --------------------------------------------------------------------

LIST_URL_TEMPLATE = "https://postings.example/job-search/?page=%d&per_page=%d"


def url_frontier(commands: DataFrame, template: str = LIST_URL_TEMPLATE, keep: tuple[str, ...] = ()) -> DataFrame:
    """One URL per page from ``start_page`` to ``end_page`` inclusive;
    ``start > end`` gives no pages (``sequence`` would count down)."""
    pages = F.when(F.col("start_page") <= F.col("end_page"),
                   F.sequence(F.col("start_page").cast("bigint"), F.col("end_page").cast("bigint")))
    ex = commands.select(*keep, "per_page", F.explode(pages).alias("page"))
    return ex.select(*keep, "page", "per_page", F.format_string(template, "page", "per_page").alias("url"))


def split_fetch_results(pages: DataFrame, success: str = "success",
                        keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(successful pages, status rows ``url, e2_success``) from one input.

    Both outputs derive from the same scan; in a streaming stage they are
    written from one ``foreachBatch`` over a persisted batch.
    """
    ok = pages.filter(F.coalesce(F.col(success), F.lit(False))).drop(success)
    status = pages.select(*keep, "url", F.coalesce(F.col(success), F.lit(False)).alias("e2_success"))
    return ok, status
