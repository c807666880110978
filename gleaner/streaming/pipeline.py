"""Structured Streaming forms of the staged pipeline.

* T1 ``micro_batch``: run a function per micro-batch. With a Kafka source
  the reference's "100 messages or 30 s" rule is the reader options
  ``minOffsetsPerTrigger`` / ``maxTriggerDelay`` (``kafka_batching``); with
  landed-file topics a processing-time trigger of ``max_delay``.
* T2 ``drain``: ``trigger(availableNow=True)`` processes everything that is
  buffered, then stops (also on an empty input).
* T4 ``NewOnlyWriter``: a ``foreachBatch`` function doing U1+U2 per batch:
  change rows are written to the lake under their own batch partition
  (a retried batch overwrites only itself) and the new keys are those not
  written by an *earlier* batch, so a replayed batch re-emits the same rows.
* T3 ``run_pipeline``: four streaming queries, one per stage, chained through
  topics; each has its own checkpoint and restarts where it stopped. A stage
  started with a new checkpoint over existing output continues after the
  last batch id it finds (``resolve_base``) instead of overwriting it.

The fetch step of the reference (a headless browser) is out of scope: pages
arrive as a table ``url, html, success`` joined stream-static by url.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import clean as C
from gleaner.operators import html as H
from gleaner.operators import lake as L
from gleaner.operators import messages as M
from gleaner.operators import postings as P
from gleaner.sources import topics as S

MIN_ROWS, MAX_DELAY = 100, "30 seconds"   # the reference's detail-stage buffer


def kafka_batching(min_rows: int = MIN_ROWS, max_delay: str = MAX_DELAY) -> dict:
    """T1 reader options for a Kafka source: a batch fires at ``min_rows``
    new messages or after ``max_delay``, whichever comes first."""
    return {"minOffsetsPerTrigger": str(min_rows), "maxTriggerDelay": max_delay}


def micro_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                max_delay: str = MAX_DELAY, trigger: dict | None = None, query_name: str | None = None):
    """Start a query calling ``fn(batch_df, batch_id)`` per micro-batch."""
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return w.trigger(**(trigger or {"processingTime": max_delay})).start()


def drain(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
          query_name: str | None = None, timeout: float | None = None):
    """Process everything available now, then stop; returns the query."""
    q = micro_batch(stream, fn, checkpoint, trigger={"availableNow": True}, query_name=query_name)
    q.awaitTermination(timeout)
    if q.exception() is not None:
        raise q.exception()
    return q


def order_of(df: DataFrame, batch_id: int, item: str | None = None) -> Column:
    """Order of a batch's writes: the batch, then the source's (offset, partition), then the place within a message.

    It follows the source and not the clock or the scan, which takes large
    files first, so the newer message wins wherever its file lies, and a batch
    that is run again orders its rows as before. Without an ``offset`` column
    the place in the frame stands for it.
    """
    there = df.columns
    return F.struct(
        F.lit(batch_id).cast("bigint").alias("batch"),
        (F.col("offset").cast("bigint") if "offset" in there else F.monotonically_increasing_id()).alias("offset"),
        (F.col("partition").cast("int") if "partition" in there else F.lit(0)).alias("partition"),
        (F.lit(0) if item is None else F.col(item)).cast("bigint").alias("item"))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def next_batch(spark: SparkSession, folders: list[str]) -> int:
    """One past the largest batch in ``folders``, by their ``batch=<id>`` and ``run=<level>..<lo>..<hi>`` entries."""
    top = -1
    for folder in folders:
        fs, p = _fs(spark, folder)
        if not fs.exists(p):
            continue
        for st in fs.listStatus(p):
            name, _, value = st.getPath().getName().partition("=")
            if name in ("batch", "run") and value.split("..")[-1].lstrip("-").isdigit():
                top = max(top, int(value.split("..")[-1]))
    return top + 1


def resolve_base(spark: SparkSession, checkpoint: str, folders: list[str]) -> int:
    """Batch-id offset for a stage, fixed once per checkpoint.

    Batch ids restart at 0 with a new checkpoint; writing those over an
    existing lake or topic would replace the earlier run's partitions. The
    first start of a checkpoint takes the next free batch id of the folders
    the stage writes and records it beside the checkpoint (as an empty marker
    file ``base=<n>``); restarts read it back.
    """
    marker_dir = checkpoint.rstrip("/") + "_base"
    fs, p = _fs(spark, marker_dir)
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("base="):
                return int(name[len("base="):])
    ck_fs, ck = _fs(spark, checkpoint)
    base = next_batch(spark, folders) if not ck_fs.exists(ck) else 0
    fs.mkdirs(p)
    fs.createNewFile(spark._jvm.org.apache.hadoop.fs.Path(p, f"base={base}"))
    return base


def emit(df: DataFrame, topic: str, root: str, batch_id: int, order: str | None = None) -> None:
    """Publish a batch's messages under ``topic=<t>/batch=<id>`` (a retried batch replaces its own files).

    Offsets go on from those of the batches before, so they are unique in the
    topic and grow with the batch and, within it, with ``order``; there are
    gaps between, as a broker's log may have. Where they end is recorded once
    the batch is written.
    """
    path = S.topic_path(root, topic)
    if order is not None:
        df = df.sort(order)
    offset = F.lit(S.next_offset(df.sparkSession, path, batch_id)) + F.monotonically_increasing_id()
    out = S.to_envelope(df, F.lit(topic), F.col("key") if "key" in df.columns else None, F.col("value"), offset=offset)
    seen = Observation(f"emit-{topic}")
    (out.drop("topic").observe(seen, F.max("offset").alias("top")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))
    top = seen.get["top"]
    if top is not None:
        S.record_offset(df.sparkSession, path, top + 1, batch_id)


class NewOnlyWriter:
    """T4: ``foreachBatch`` function — upsert postings, pass on new keys only."""

    def __init__(self, lake: L.Lake, on_new: Callable[[DataFrame, int], None],
                 to_changes: Callable[[DataFrame, int], DataFrame] | None = None,
                 writer: str = "postings", base_batch: int = 0):
        self.lake, self.on_new, self.writer, self.base = lake, on_new, writer, base_batch
        self.to_changes = to_changes or (lambda df, b: L.upsert_postings(
            df.withColumn("_seq", order_of(df, b, "item" if "item" in df.columns else None)).withColumn("created_at", (
                F.col("timestamp") if "timestamp" in df.columns else F.current_timestamp()).cast("timestamp_ntz")), b))

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        b = self.base + batch_id
        changes = self.to_changes(df, b).persist()
        try:
            # only batches < b are consulted, so writing batch b cannot change
            # what is new: the write comes first, nothing is passed on if it
            # fails, and a retry passes on exactly the same rows
            self.lake.append(changes, self.writer, b)
            self.on_new(L.new_only(changes, self.lake.keys(self.writer, b), b), b)
        finally:
            changes.unpersist()


# ---------------------------------------------------------------------------
# The four stages
# ---------------------------------------------------------------------------

@dataclass
class PipelineConfig:
    topics_root: str                     # folder of landed topics
    lake_root: str
    checkpoint_root: str
    pages: DataFrame                     # fetch results: url, html, success
    dead_letters: str                    # folder for every row that a stage rejects
    list_template: str = S.LIST_URL_TEMPLATE
    detail_template: str = C.DEFAULT_URL_TEMPLATE
    trigger: dict = field(default_factory=lambda: {"availableNow": True})

    def __post_init__(self):
        if self.topics_root.startswith("kafka://"):
            raise ValueError("the staged pipeline works on landed topics; land Kafka topics with read_topics and publish")

    def ckpt(self, stage: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{stage}"

    def reject(self, bad: DataFrame, stage: str, batch_id: int) -> None:
        """Dead letters of one stage and batch; a batch run again replaces its own."""
        (P.route_dead_letters(bad, stage_names=(stage,)).drop("stage").write.mode("overwrite")
         .parquet(f"{self.dead_letters.rstrip('/')}/stage={stage}/batch={batch_id}"))


T = S.TOPICS
SOURCE = ("offset", "partition")          # where a message stands in its topic; goes with it through a stage


def stage_list_extract(spark: SparkSession, cfg: PipelineConfig):
    """Stage 1: list commands -> page urls -> fetched list pages (packed)."""
    cmds = S.read_topics(spark, cfg.topics_root, [T["list_commands"]])
    base = resolve_base(spark, cfg.ckpt("s1"), [S.topic_path(cfg.topics_root, T["list_pages"])])

    def batch(df: DataFrame, batch_id: int) -> None:
        good, bad = M.decode_envelope(df.persist(), M.LIST_PARAMS, M.LIST_DEFAULTS, keep=SOURCE)
        cfg.reject(bad, "list_commands", base + batch_id)
        urls = S.url_frontier(M.dispatch_action(good, M.ACTION_EXTRACT), cfg.list_template, keep=SOURCE)
        urls = urls.withColumn("order", order_of(urls, base + batch_id, "page")).select("url", "order")
        ok, _ = S.split_fetch_results(urls.join(cfg.pages, "url", "left"))
        emit(M.pack_html(ok, "html", keep=("order",)), T["list_pages"], cfg.topics_root, base + batch_id, "order")
        df.unpersist()

    return micro_batch(cmds, batch, cfg.ckpt("s1"), trigger=cfg.trigger, query_name="s1_list_extract")


def cards(list_pages: DataFrame, template: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Stage 2 body: list pages -> (job_id, role, url) cards, plus rejects."""
    links = H.extract_links(list_pages, "html", "a", where={"role": "button"},
                            attrs=("href", "aria-label"), within="main", keep=keep)
    jid = C.job_id("href")
    role = C.clean_role("aria_label")
    rows = links.select(*keep, F.col("link_idx").alias("item"), jid.alias("job_id"), role.alias("role"), "href", "aria_label")
    rows = rows.withColumn("url", C.canonical_url("job_id", template))
    tagged = P.barrier(rows.withColumn("_errors", F.filter(F.array(
        F.when(F.col("job_id").isNull(), F.lit("H2_job_id")),
        F.when(F.col("role").isNull(), F.lit("H3_role"))), lambda e: e.isNotNull())), "cards")
    return (tagged.filter(F.size("_errors") == 0).select(*keep, "item", "job_id", "role", "url"),
            tagged.filter(F.size("_errors") > 0))


def stage_cards(spark: SparkSession, cfg: PipelineConfig, lake: L.Lake):
    """Stage 2: list pages -> upsert postings -> detail commands for NEW keys."""
    pages = S.read_topics(spark, cfg.topics_root, [T["list_pages"]])

    def on_new(new: DataFrame, b: int) -> None:
        msgs = M.encode_envelope(new.select("_seq", "job_id", "role", "url"), M.ACTION_EXTRACT,
                                 {"job_id": "job_id", "role": "role", "url": "url"}, keep=("_seq",))
        emit(msgs, T["detail_commands"], cfg.topics_root, b, "_seq")

    base = resolve_base(spark, cfg.ckpt("s2"), [lake.writer_path("postings"),
                                                S.topic_path(cfg.topics_root, T["detail_commands"])])
    writer = NewOnlyWriter(lake, on_new, base_batch=base)

    def batch(df: DataFrame, batch_id: int) -> None:
        good, broken = M.unpack_html(df, keep=("timestamp", *SOURCE))
        good = M.dispatch_action(good, M.ACTION_TRANSFORM).persist()      # read and inflate once for both outputs
        ok, bad = cards(good, cfg.detail_template, keep=("timestamp", *SOURCE))
        writer(ok, batch_id)
        cfg.reject(broken, "list_pages", base + batch_id)
        cfg.reject(bad, "cards", base + batch_id)
        good.unpersist()

    return micro_batch(pages, batch, cfg.ckpt("s2"), trigger=cfg.trigger, query_name="s2_cards")


def stage_detail_extract(spark: SparkSession, cfg: PipelineConfig, lake: L.Lake):
    """Stage 3: detail commands -> fetch status + packed body html."""
    cmds = S.read_topics(spark, cfg.topics_root, [T["detail_commands"]])
    base = resolve_base(spark, cfg.ckpt("s3"), [lake.writer_path("status"),
                                                S.topic_path(cfg.topics_root, T["detail_pages"])])

    def batch(df: DataFrame, batch_id: int) -> None:
        batch_id = base + batch_id
        good, bad = M.decode_envelope(df, M.DETAIL_PARAMS, keep=("timestamp", *SOURCE))
        asked = M.dispatch_action(good, M.ACTION_EXTRACT)
        asked = asked.select("url", F.col("timestamp").cast("timestamp_ntz").alias("created_at"), order_of(asked, batch_id).alias("_seq"))
        fetched = asked.join(cfg.pages, "url", "left").persist()
        ok, status = S.split_fetch_results(fetched, keep=("_seq",))
        lake.append(L.set_status(status, batch_id, ok="e2_success"), "status", batch_id)
        body = ok.select("url", H.main_html("html").alias("html"), "created_at", "_seq")
        emit(M.pack_html(body, "html", url="url", created_at="created_at", keep=("_seq",)), T["detail_pages"],
             cfg.topics_root, batch_id, "_seq")
        cfg.reject(bad, "detail_commands", batch_id)
        fetched.unpersist()

    return micro_batch(cmds, batch, cfg.ckpt("s3"), trigger=cfg.trigger, query_name="s3_detail_extract")


ENRICHED = list(P.CLEAN_FIELDS) + ["url", "scraped_at"]


def stage_detail_transform(spark: SparkSession, cfg: PipelineConfig, lake: L.Lake):
    """Stage 4: detail pages -> fields -> clean -> validate -> lake + load topic."""
    pages = S.read_topics(spark, cfg.topics_root, [T["detail_pages"]])
    base = resolve_base(spark, cfg.ckpt("s4"), [lake.writer_path("enriched"),
                                                S.topic_path(cfg.topics_root, T["load"])])

    def batch(df: DataFrame, batch_id: int) -> None:
        batch_id = base + batch_id
        good, broken = M.unpack_html(df, keep=SOURCE)
        pages = M.dispatch_action(good, M.ACTION_TRANSFORM).withColumn("_seq", order_of(good, batch_id))
        fields = H.detail_fields(pages, "html", keep=("url", "created_at", "_seq"))
        # one Python pass per batch: both validation outputs read the cache
        clean = P.clean_postings(fields, "created_at", keep=("_seq",)).persist()
        ok, bad = P.validate_enriched(clean)
        lake.append(L.upsert_enriched(ok, batch_id, ENRICHED), "enriched", batch_id)
        emit(M.encode_load_record(ok, keep=("_seq",)), T["load"], cfg.topics_root, batch_id, "_seq")
        cfg.reject(broken, "detail_pages", batch_id)
        cfg.reject(bad.drop("_seq"), "clean", batch_id)
        clean.unpersist()

    return micro_batch(pages, batch, cfg.ckpt("s4"), trigger=cfg.trigger, query_name="s4_detail_transform")


def start_command(spark: SparkSession, root: str, start_page: int = 1, end_page: int = 40,
                  per_page: int = 50) -> None:
    """Publish one list command (the pipeline's entry message)."""
    cmd = spark.range(1).select(F.lit(start_page).cast("bigint").alias("s"), F.lit(end_page).cast("bigint").alias("e"),
                                F.lit(per_page).cast("bigint").alias("p"))
    msg = M.encode_envelope(cmd, M.ACTION_EXTRACT, {"start_page": "s", "end_page": "e", "per_page": "p"})
    S.publish(msg, T["list_commands"], root)


def run_pipeline(spark: SparkSession, cfg: PipelineConfig, wait: bool = True) -> list:
    """Start the four stages; with an ``availableNow`` trigger and
    ``wait`` they run one after another to completion (a full drain)."""
    lake = L.Lake(spark, cfg.lake_root)
    builders = [lambda: stage_list_extract(spark, cfg), lambda: stage_cards(spark, cfg, lake),
                lambda: stage_detail_extract(spark, cfg, lake), lambda: stage_detail_transform(spark, cfg, lake)]
    queries = []
    for build in builders:
        q = build()
        queries.append(q)
        if wait:
            q.awaitTermination()
            if q.exception() is not None:
                raise q.exception()
    return queries
