"""Queries for M1-M8 (codecs) and S1-S5, S10, S11 (topics).

``events`` plays the topic stream: topic = event_type, key = user_id,
offset = event_id, timestamp = ts, value = props, partition = user_id % 3.
"""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from gleaner.operators import messages as M
from gleaner.plans.catalog import register
from gleaner.plans.tables import table
from gleaner.session import scratch_path, spread
from gleaner.sources import topics as S
from gleaner.sources.segments import SegmentedTopics


def envelope_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return S.to_envelope(ev, F.col("event_type"), F.col("user_id").cast("string"), F.col("props"),
                         partition=F.col("user_id") % 3, offset=F.col("event_id"), timestamp=F.col("ts"))


def _publish(enc, spark, topic: str = M.LOAD_TOPIC):
    path = scratch_path(spark, "topics")
    S.publish(enc.withColumn("key", F.col("posting_id").cast("string").cast("binary")), topic, path)
    return path


def _land(spark, sf_dir):
    """Publish the events envelope to a fresh landed-topic folder."""
    path = scratch_path(spark, "topics")
    S.publish(envelope_events(spark, sf_dir), None, path)
    return path


# -- M1/M2 ---------------------------------------------------------------------

_LIST_CMD = ("CAST(user_id % 5 + 1 AS BIGINT)", "CAST(user_id % 5 + 1 + event_id % 4 AS BIGINT)",
             "CAST(25 + event_id % 26 AS BIGINT)")


@register("M1_M2_envelope_roundtrip", f"""
SELECT event_id, 'START_EXTRACT' AS action, {_LIST_CMD[0]} AS start_page, {_LIST_CMD[1]} AS end_page,
       {_LIST_CMD[2]} AS per_page,
       CAST(json_object('action', 'START_EXTRACT', 'params', json_object('start_page', {_LIST_CMD[0]},
            'end_page', {_LIST_CMD[1]}, 'per_page', {_LIST_CMD[2]})) AS VARCHAR) AS wire
FROM events""")
def q_envelope(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    enc = M.encode_envelope(ev, M.ACTION_EXTRACT,
                            {"start_page": F.expr(_LIST_CMD[0]), "end_page": F.expr(_LIST_CMD[1]),
                             "per_page": F.expr(_LIST_CMD[2])}, keep=("event_id",))
    good, _ = M.decode_envelope(enc, M.LIST_PARAMS, M.LIST_DEFAULTS, keep=("event_id",))
    wire = enc.select("event_id", F.decode("value", "UTF-8").alias("wire"))
    return good.join(wire, "event_id")


_BAD_VALUE = """CASE event_id % 5
  WHEN 0 THEN '{"action":"START_EXTRACT","params":{"job_id":' || CAST(event_id AS STRING) || ',"role":"r","url":"u"}}'
  WHEN 1 THEN '{"params":{"job_id":1,"role":"r","url":"u"}}'
  WHEN 2 THEN '{"action":"START_EXTRACT","params":{"job_id":1,"role":"r","url":"u","extra":1}}'
  WHEN 3 THEN 'not json ' || event_type
  ELSE '{"action":"START_EXTRACT","params":{"job_id":2,"role":"r"}}' END"""


@register("M2_decode_quarantine", f"""
SELECT CASE event_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'M2_missing_action' WHEN 2 THEN 'M2_unexpected_param'
            WHEN 3 THEN 'M2_not_json_object' ELSE 'M2_missing_url' END AS outcome, COUNT(*) AS n_rows
FROM events GROUP BY 1""")
def q_decode_quarantine(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", F.expr(_BAD_VALUE).alias("value"))
    good, bad = M.decode_envelope(ev, M.DETAIL_PARAMS, keep=("event_id",))
    outcome = good.select(F.lit("ok").alias("outcome")).unionByName(
        bad.select(F.array_join("_errors", ",").alias("outcome")))
    return outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))


# -- M3 ------------------------------------------------------------------------

@register("M3_pack_unpack_html", """
SELECT page_id, 'good' AS variant, md5(html) AS html_md5, length(html) AS n_chars FROM pages
UNION ALL
SELECT page_id, 'corrupt' AS variant, NULL AS html_md5, NULL AS n_chars FROM pages""")
def q_pack_unpack(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    packed = M.pack_html(pages, "html", url="url", keep=("page_id",))
    # a corrupted copy: drop the first 8 base64 characters of the payload
    corrupt = packed.select("page_id", F.encode(F.regexp_replace(F.decode("value", "UTF-8"),
                                                                 '"b64":"[A-Za-z0-9+/]{8}', '"b64":"'),
                                                "UTF-8").alias("value"))
    g1, _ = M.unpack_html(packed, keep=("page_id",))
    _, b2 = M.unpack_html(corrupt, keep=("page_id",))
    good = g1.select("page_id", F.lit("good").alias("variant"), F.md5("html").alias("html_md5"),
                     F.char_length("html").cast("bigint").alias("n_chars"))
    bad = b2.select("page_id", F.lit("corrupt").alias("variant"), F.lit(None).cast("string").alias("html_md5"),
                    F.lit(None).cast("bigint").alias("n_chars"))
    return good.unionByName(bad)


# -- M4 / M5 / M6 --------------------------------------------------------------

@register("M4_json_roundtrip", "SELECT event_id, CAST(json(props) AS VARCHAR) AS json FROM events")
def q_json(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "props")
    return M.json_roundtrip(ev, "props").select("event_id", "json")


@register("M5_dispatch_action", "SELECT event_id FROM events WHERE event_type = 'click'")
def q_dispatch(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    enc = M.encode_envelope(ev, F.when(F.col("event_type") == "click", F.lit(M.ACTION_EXTRACT))
                            .otherwise(F.lit("NOOP")), {"job_id": "user_id", "role": "event_type",
                                                        "url": F.lit("u")}, keep=("event_id",))
    good, _ = M.decode_envelope(enc, M.DETAIL_PARAMS, keep=("event_id",))
    return M.dispatch_action(good, M.ACTION_EXTRACT, Observation("dispatch")).select("event_id")


_LISTENERS = [("click", "stage_a"), ("view", "stage_a"), ("view", "stage_b"), ("purchase", "stage_b")]


@register("M6_fan_out", """
SELECT l.listener, e.event_type AS topic, COUNT(*) AS n_rows
FROM events e JOIN (VALUES ('click', 'stage_a'), ('view', 'stage_a'), ('view', 'stage_b'),
                           ('purchase', 'stage_b')) l(topic, listener) ON e.event_type = l.topic
GROUP BY 1, 2""")
def q_fan_out(spark, sf_dir):
    msgs = envelope_events(spark, sf_dir).select("topic", "offset")
    listeners = spark.createDataFrame(_LISTENERS, "topic string, listener string")
    return M.fan_out(msgs, listeners).groupBy("listener", "topic").agg(F.count(F.lit(1)).alias("n_rows"))


# -- M7 / M8 -------------------------------------------------------------------

_LOAD_SRC = {
    "about": "'## ' || o_orderpriority || ' order ' || CAST(o_orderkey AS STRING)",
    "apply_by": "o_orderdate",
    "apply_type": "CASE WHEN o_orderstatus = 'F' THEN 'internal' ELSE 'external' END",
    "company": "'company ' || CAST(o_custkey AS STRING)",
    "employment_type": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'full-time' END",
    "industry": "o_orderpriority",
    "job_type": "'job'",
    "location": "'city ' || CAST(o_custkey % 40 AS STRING)",
    "position": "'position ' || o_orderstatus",
    "posted_at": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END",
    "url": "'/jobs/' || CAST(o_orderkey AS STRING)",
    "wage_lo": "CAST(floor(o_totalprice) AS BIGINT)",
}


@register("M7_M8_load_record", "SELECT o_orderkey AS posting_id, " +
          ", ".join(f"{v} AS {k}" for k, v in _LOAD_SRC.items()) + " FROM orders")
def q_load_record(spark, sf_dir):
    o = spread(table(spark, sf_dir, "orders")).selectExpr("o_orderkey AS posting_id",
                                                         *[f"{v} AS {k}" for k, v in _LOAD_SRC.items()])
    rec = o.select("posting_id", *[c for c in o.columns if c not in ("posting_id", "wage_lo")],
                   F.array("wage_lo", F.col("wage_lo") + 1000).alias("wage"),
                   F.array(F.lit("transcript")).alias("documents"), F.array(F.lit("onsite")).alias("location_type"))
    enc = M.encode_load_record(rec, keep=("posting_id",))
    # publish to a landed topic, then decode what the next stage reads
    landed = S.read_topics(spark, _publish(enc, spark), [M.LOAD_TOPIC], streaming=False)
    good, _ = M.decode_load_record(landed.select(F.col("key").cast("string").cast("bigint").alias("posting_id"),
                                                 "value"), keep=("posting_id",))
    return good.select("posting_id", *[k for k in _LOAD_SRC if k != "wage_lo"],
                       F.col("wage")[0].alias("wage_lo"))


# -- S1-S5, S10, S11 -----------------------------------------------------------

@register("S1_S2_publish_read_topics", """
SELECT event_type AS topic, COUNT(*) AS n_rows, MIN(event_id) AS min_offset, MAX(event_id) AS max_offset
FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1""")
def q_publish_read(spark, sf_dir):
    path = _land(spark, sf_dir)
    got = S.read_topics(spark, path, ["click", "view", "purchase"], streaming=False)
    return got.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rows"), F.min("offset").alias("min_offset"),
                                    F.max("offset").alias("max_offset"))


@register("S3_replay", """
SELECT event_id AS "offset", CAST(user_id AS VARCHAR) AS key, props AS value FROM events
WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""")
def q_replay(spark, sf_dir):
    landed = S.read_topics(spark, _land(spark, sf_dir), ["click"], streaming=False)
    got = S.replay(landed, "click", from_ts="2024-01-10 00:00:00", to_ts="2024-01-20 00:00:00")
    return got.select("offset", F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value"))


@register("S4_url_frontier", """
SELECT n_nationkey, CAST(p AS BIGINT) AS page, CAST(25 + n_nationkey AS BIGINT) AS per_page,
       'https://postings.example/job-search/?page=' || CAST(p AS VARCHAR) || '&per_page=' || CAST(25 + n_nationkey AS VARCHAR) AS url
FROM (SELECT n_nationkey, unnest(range(n_regionkey + 1, n_nationkey % 7 + 2)) AS p FROM nation)""")
def q_frontier(spark, sf_dir):
    cmds = table(spark, sf_dir, "nation").select(
        "n_nationkey", (F.col("n_regionkey") + 1).alias("start_page"), (F.col("n_nationkey") % 7 + 1).alias("end_page"),
        (F.col("n_nationkey") + 25).cast("bigint").alias("per_page"))
    return S.url_frontier(cmds, keep=("n_nationkey",))


@register("S5_split_fetch_results", """
SELECT page_id, url, page_id % 7 <> 0 AS e2_success,
       CASE WHEN page_id % 7 <> 0 THEN length(html) END AS ok_chars FROM pages""")
def q_split(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("success", F.col("page_id") % 7 != 0)
    ok, status = S.split_fetch_results(pages, keep=("page_id",))
    okc = ok.select("page_id", F.char_length("html").cast("bigint").alias("ok_chars"))
    return status.join(okc, "page_id", "left").select("page_id", "url", "e2_success", "ok_chars")


@register("S10_retention", """
SELECT event_type AS topic, COUNT(*) AS n_rows FROM events
WHERE (floor(epoch(ts) / 43200) + 1) * 43200 >= epoch(TIMESTAMP '2024-01-30 00:00:00') - 86400
GROUP BY 1""")
def q_retention(spark, sf_dir):
    kept = S.retain(envelope_events(spark, sf_dir), "2024-01-30 00:00:00")
    return kept.groupBy("topic").agg(F.count(F.lit(1)).alias("n_rows"))


@register("S11_compact_by_key", """
SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key, arg_max(event_id, event_id) AS "offset",
       arg_max(props, event_id) AS value
FROM events GROUP BY event_type, user_id""")
def q_compact(spark, sf_dir):
    c = S.compact_by_key(envelope_events(spark, sf_dir))
    return c.select("topic", F.decode("key", "UTF-8").alias("key"), "offset", F.decode("value", "UTF-8").alias("value"))


@register("S10_S11_segments", """
SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS key, arg_max(event_id, event_id) AS "offset",
       arg_max(props, event_id) AS value
FROM events WHERE (floor(epoch(ts) / 43200) + 1) * 43200 >= epoch(TIMESTAMP '2024-01-30 00:00:00') - 10 * 86400
GROUP BY event_type, user_id""")
def q_segments(spark, sf_dir):
    """Events landed in 12-hour segments; those over ten days old are dropped, the others compacted."""
    topics = SegmentedTopics(spark, scratch_path(spark, "segments"))
    topics.land(envelope_events(spark, sf_dir))
    topics.retain("2024-01-30 00:00:00", hours=240)
    topics.compact()
    return topics.read().select("topic", F.decode("key", "UTF-8").alias("key"), "offset", F.decode("value", "UTF-8").alias("value"))
