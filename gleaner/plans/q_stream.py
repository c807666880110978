"""Streaming queries: T3 (the whole staged pipeline) and T4 (new-only stream).

Both run real Structured Streaming queries (file topics, ``availableNow``)
under a fresh folder in the shared checkpoint location and return the
batch read of what the streams produced.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import clean as C
from gleaner.operators import lake as L
from gleaner.operators import messages as M
from gleaner.plans.catalog import register
from gleaner.plans.html_fixture import POSTING_HTML
from gleaner.plans.tables import table
from gleaner.session import scratch_path, spread
from gleaner.sources import topics as S
from gleaner.streaming import pipeline as PL

PER_PAGE = 50


def pipeline_pages(spark, sf_dir):
    """Fetch results for the pipeline: list pages of PER_PAGE cards over the
    ``part`` keys, and one detail page per part (every 7th fetch fails)."""
    part = spread(table(spark, sf_dir, "part"))
    cards = part.select(
        (F.floor((F.col("p_partkey") - 1) / PER_PAGE) + 1).cast("bigint").alias("page"), "p_partkey",
        F.format_string('<a role="button" href="/job-search/%d?p=1" aria-label="View %s">%s</a>',
                        "p_partkey", "p_name", "p_name").alias("card"))
    lists = cards.groupBy("page").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "card"))),
                                    lambda s: s["card"])).alias("cards"))
    list_pages = lists.select(
        F.format_string(S.LIST_URL_TEMPLATE, "page", F.lit(PER_PAGE)).alias("url"),
        F.concat(F.lit("<html><body><nav><a href='/home'>home</a></nav><main>"), "cards",
                 F.lit("</main></body></html>")).alias("html"), F.lit(True).alias("success"))
    details = part.selectExpr(f"{POSTING_HTML} AS html", "p_partkey").select(
        C.canonical_url("p_partkey").alias("url"), "html", (F.col("p_partkey") % 7 != 0).alias("success"))
    return list_pages.unionByName(details), lists


@register("T1_T2_T3_pipeline_load", """
SELECT 'https://postings.example/jobs/' || CAST(p_partkey AS VARCHAR) AS url,
       regexp_replace(lower(p_name), '^\\s+|\\s+$', '', 'g') AS position,
       'Maker ' || p_brand AS company, 'internship' AS job_type
FROM part WHERE p_partkey % 7 <> 0""")
def q_pipeline(spark, sf_dir):
    root = scratch_path(spark, "pipeline")
    pages, lists = pipeline_pages(spark, sf_dir)
    pages = pages.persist()     # the fetch table is joined by stages 1 and 3
    n_pages = lists.agg(F.max("page")).first()[0] or 0
    cfg = PL.PipelineConfig(topics_root=f"{root}/topics", lake_root=f"{root}/lake",
                            checkpoint_root=f"{root}/ckpt", pages=pages, dead_letters=f"{root}/dead")
    PL.start_command(spark, cfg.topics_root, 1, int(n_pages), PER_PAGE)
    PL.run_pipeline(spark, cfg)
    pages.unpersist()
    load = S.read_topics(spark, cfg.topics_root, [S.TOPICS["load"]], streaming=False)
    good, _ = M.decode_load_record(load)
    return good.select("url", "position", "company", "job_type")


_JSON_TS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def land_by_day(spark, ev, staging: str, topic_dir: str) -> list[str]:
    """Land rows as one file per calendar day, in day order.

    One partitioned write (each day goes to one task, so one file per day),
    then the files are moved into the topic folder with modification times in
    day order through the Hadoop FileSystem API; a file stream takes files by
    modification time, so ``maxFilesPerTrigger=1`` gives one day per batch.
    Returns the days (ISO text) in order.
    """
    cols = [c for c in ev.columns if c != "day"]
    env = ev.select("day", F.lit(0).alias("partition"), F.col("_seq").alias("offset"),
                    F.col("created_at").cast("timestamp").alias("timestamp"),
                    F.col("url").cast("binary").alias("key"),
                    F.encode(F.to_json(F.struct(*cols), _JSON_TS), "UTF-8").alias("value"))
    env.repartition("day").write.partitionBy("day").parquet(staging)
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(staging).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(Path(topic_dir))
    day_dirs = sorted((st.getPath() for st in fs.listStatus(Path(staging))
                       if st.getPath().getName().startswith("day=")), key=lambda p: p.getName())
    t0 = 1_000_000_000_000
    days = []
    for i, d in enumerate(day_dirs):
        days.append(d.getName()[len("day="):])
        for j, st in enumerate(sorted((st for st in fs.listStatus(d) if st.getPath().getName().endswith(".parquet")),
                                      key=lambda st: st.getPath().getName())):
            dst = Path(f"{topic_dir}/part-{i:05d}-{j:03d}.parquet")
            fs.rename(st.getPath(), dst)
            fs.setTimes(dst, t0 + i * 1000 + j, -1)
    return days


@register("T4_new_only_stream", """
SELECT CAST(user_id AS VARCHAR) || '-' || event_type AS key, min(event_id) AS first_seq,
       arg_min(ts, event_id) AS created_at, arg_min(user_id, event_id) AS job_id
FROM events GROUP BY 1""")
def q_new_only_stream(spark, sf_dir):
    root = scratch_path(spark, "t4")
    ev = table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("url"),
        F.col("event_type").alias("role"), F.col("user_id").alias("job_id"),
        F.col("ts").alias("created_at"), F.col("event_id").alias("_seq"), F.to_date("ts").alias("day"))
    days = land_by_day(spark, ev, f"{root}/staging", S.topic_path(f"{root}/topics", "events"))
    stream = S.read_topics(spark, f"{root}/topics", ["events"], options={"maxFilesPerTrigger": "1"})
    schema = "url string, role string, job_id bigint, created_at timestamp_ntz, _seq bigint"
    rows = stream.select(F.from_json(F.decode("value", "UTF-8"), schema, _JSON_TS).alias("r")).select("r.*")
    lake = L.Lake(spark, f"{root}/lake")
    sink = f"{root}/new"
    writer = PL.NewOnlyWriter(
        lake, lambda new, b: new.withColumn("batch", F.lit(b)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(sink),
        to_changes=lambda df, b: L.upsert_postings(df, b))
    PL.drain(rows, writer, f"{root}/ckpt")
    # one day delivered again under its batch id: replaces its own output
    mid = len(days) // 2
    again = ev.filter(F.col("day") == F.lit(days[mid]).cast("date")).drop("day") if days else None
    if again is not None:
        writer(again, mid)
    out = spark.read.parquet(sink)
    return out.select("key", F.col("_seq").alias("first_seq"), "created_at", "job_id")
