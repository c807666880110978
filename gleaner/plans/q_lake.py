"""Queries for U1-U5 (lake) and S6-S8, E7, Q1-Q8 (warehouse CRUD)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleaner.operators import lake as L
from gleaner.operators import warehouse as W
from gleaner.operators.chunk import chunk_text
from gleaner.operators.clustered import ClusteredTable
from gleaner.plans.catalog import ORACLES, register
from gleaner.plans.tables import table
from gleaner.session import scratch_path

# -- U1-U5 on events as a change feed ----------------------------------------
# batch = calendar day of ts, seq = event_id, key = user/event type.

_BATCH_SQL = "year(ts) * 10000 + month(ts) * 100 + day(ts)"


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        F.expr(_BATCH_SQL).cast("bigint").alias("batch"))


@register("U1_U2_new_only", f"""
WITH c AS (SELECT CAST(user_id AS VARCHAR) || '-' || event_type AS key, CAST({_BATCH_SQL} AS BIGINT) AS batch,
                  event_id, ts, user_id FROM events),
f AS (SELECT key, min(batch) AS b FROM c GROUP BY key)
SELECT c.key, c.batch AS first_batch, min(c.event_id) AS first_seq, arg_min(c.ts, c.event_id) AS created_at,
       arg_min(c.user_id, c.event_id) AS job_id
FROM c JOIN f ON c.key = f.key AND c.batch = f.b GROUP BY c.key, c.batch""")
def q_new_only(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn(
        "url", F.concat_ws("-", F.col("user_id").cast("string"), "event_type"))
    ev = ev.select("url", F.col("event_type").alias("role"), F.col("user_id").alias("job_id"),
                   F.col("ts").alias("created_at"), F.col("event_id").alias("_seq"), "batch")
    changes = L.upsert_postings(ev, F.col("batch"))
    # every batch is delivered twice (a full replay); the result must not change
    firsts = L.new_only_all(changes.unionByName(changes))
    return firsts.select("key", F.col("_batch").alias("first_batch"), F.col("_seq").alias("first_seq"),
                         "created_at", "job_id")


@register("U3_U4_U5_merged_view", """
SELECT 'u' || CAST(user_id AS VARCHAR) AS key,
  arg_max(event_type, event_id) FILTER (WHERE event_type IN ('view', 'click', 'signup')) AS role,
  'u' || CAST(user_id AS VARCHAR) AS url,
  arg_min(ts, event_id) FILTER (WHERE event_type IN ('view', 'click', 'signup')) AS created_at,
  arg_min(user_id, event_id) FILTER (WHERE event_type IN ('view', 'click', 'signup')) AS job_id,
  arg_max(value >= 50, event_id) FILTER (WHERE event_type = 'error') AS e2_success,
  arg_max_null(CASE WHEN value < 20 THEN NULL ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END, event_id)
      FILTER (WHERE event_type = 'purchase') AS position,
  arg_max(props, event_id) FILTER (WHERE event_type = 'purchase') AS about,
  COUNT(*) AS n_writes
FROM events GROUP BY user_id""")
def q_merged_view(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn("url", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    posts = ev.filter(F.col("event_type").isin("view", "click", "signup")).select(
        "url", F.col("event_type").alias("role"), F.col("user_id").alias("job_id"),
        F.col("ts").alias("created_at"), F.col("event_id").alias("_seq"), "batch")
    status = ev.filter(F.col("event_type") == "error").select(
        "url", (F.col("value") >= 50).alias("ok"), F.col("event_id").alias("_seq"), "batch")
    enriched = ev.filter(F.col("event_type") == "purchase").select(
        "url", F.when(F.col("value") < 20, F.lit(None))
        .otherwise(F.floor("value").cast("bigint").cast("string")).alias("position"),
        F.col("props").alias("about"), F.col("event_id").alias("_seq"), "batch")
    log = L.union_changes(
        L.upsert_postings(posts, F.col("batch")),
        L.set_status(status, F.col("batch")),
        L.upsert_enriched(enriched, F.col("batch"), ["url", "position", "about"]))
    view = L.merged_view(log, ["role", "url", "created_at", "job_id", "e2_success", "position", "about"])
    return view.select("key", "role", "url", "created_at", "job_id", "e2_success", "position", "about",
                       F.col("_writes").alias("n_writes"))


# -- Q1-Q8 on orders / customer ----------------------------------------------

@register("Q1_select_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def q_distinct(spark, sf_dir):
    return W.select_rows(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], distinct=True)


@register("Q2_where", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
                      "WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def q_where(spark, sf_dir):
    return W.select_rows(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"],
                         where=(F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))


@register("Q3_Q4_order_limit_offset",
          "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey "
          "LIMIT 20 OFFSET 5")
def q_top(spark, sf_dir):
    return W.select_rows(table(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice"],
                         order_by=[F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")],
                         limit=20, offset=5)


@register("Q5_insert_count", "SELECT o_orderstatus, COUNT(*) AS n_rows FROM orders GROUP BY o_orderstatus")
def q_insert(spark, sf_dir):
    """One insert into a fresh table; the rows it holds by status, which must be as many as the write reports."""
    rows = table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {a}" for e, a in _APPS_COLS])
    apps = rows.select("id", "posted_at", "work_type", "position", "location", "company",
                       W.pay_range("pay_lo", "pay_hi").alias("pay"))
    name, path = _fresh("insert"), scratch_path(spark, "insert")
    W.create_applications(spark, name)
    written = W.insert_applications(apps, name)
    status = F.regexp_extract("position", "^analyst (.*)$", 1)
    spark.table(name).groupBy(status.alias("o_orderstatus")).agg(F.count(F.lit(1)).alias("n_rows")).write.parquet(path)
    W.drop_applications(spark, name)
    counts = spark.read.schema("o_orderstatus string, n_rows bigint").parquet(path)
    found = counts.agg(F.sum("n_rows")).first()[0] or 0
    if found != written:
        raise RuntimeError(f"{written} rows were inserted and {found} are there")
    return counts


@register("Q6_update", """
SELECT o.o_orderkey,
  CASE WHEN c.c_custkey IS NOT NULL THEN '0-FLAGGED'
       WHEN o.o_orderstatus = 'P' AND o.o_totalprice > 200000 THEN '0-BIG'
       ELSE o.o_orderpriority END AS o_orderpriority
FROM orders o LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) c ON o.o_custkey = c.c_custkey""")
def q_update(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                "o_orderpriority")
    step1 = W.update_where(o, (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000),
                           {"o_orderpriority": F.lit("0-BIG")})
    flagged = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("o_custkey"), F.lit("0-FLAGGED").alias("o_orderpriority"))
    step2 = W.update_by_ids(step1, flagged, "o_custkey", ["o_orderpriority"])
    return step2.select("o_orderkey", "o_orderpriority")


@register("Q7_delete", """
SELECT o_orderkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
  AND NOT coalesce(o_totalprice < 50000, false)""")
def q_delete(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    ids = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    snap = W.delete_by_ids(o, ids, "o_custkey", "c_custkey")
    return W.delete_where(snap, F.col("o_totalprice") < 50000).select("o_orderkey")


@register("Q8_rows_by_ids", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)""")
def q_by_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ids = table(spark, sf_dir, "customer").filter(F.col("c_nationkey") == 7)
    return W.rows_by_ids(o, ids, "o_custkey", "c_custkey")


# -- S6 applications table (write + read back) --------------------------------

_APPS_COLS = [
    ("o_orderkey", "id"), ("o_orderdate", "posted_at"),
    ("CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'full-time' "
     "WHEN o_orderpriority = '3-MEDIUM' THEN 'part-time' ELSE 'internship' END", "work_type"),
    ("'analyst ' || o_orderstatus", "position"),
    ("'city ' || CAST(o_custkey % 50 AS STRING)", "location"),
    ("'company ' || CAST(o_custkey AS STRING)", "company"),
    ("CAST(floor(o_totalprice) AS DECIMAL(18,2))", "pay_lo"),
    ("CAST(floor(o_totalprice) + 10000 AS DECIMAL(18,2))", "pay_hi"),
]
_APPS_SQL = "SELECT " + ", ".join(f"{e} AS {a}" for e, a in _APPS_COLS) + " FROM orders"


def _fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:8]}"


@register("S6_applications_table",
          f"SELECT * REPLACE (CAST(pay_lo AS DOUBLE) AS pay_lo, CAST(pay_hi AS DOUBLE) AS pay_hi), "
          f"true AS pay_lo_inc, false AS pay_hi_inc FROM ({_APPS_SQL})")
def q_applications(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {a}" for e, a in _APPS_COLS])
    apps = rows.select("id", "posted_at", "work_type", "position", "location", "company",
                       W.pay_range("pay_lo", "pay_hi").alias("pay"))
    name, path = _fresh("applications"), scratch_path(spark, "applications")
    W.create_applications(spark, name)
    W.insert_applications(apps, name)
    spark.table(name).write.parquet(path)             # the table is dropped, its rows are returned
    W.drop_applications(spark, name)
    back = spark.read.parquet(path)
    return back.select("id", "posted_at", "work_type", "position", "location", "company",
                       F.col("pay.lo").cast("double").alias("pay_lo"),
                       F.col("pay.hi").cast("double").alias("pay_hi"),
                       F.col("pay.lo_inc").alias("pay_lo_inc"), F.col("pay.hi_inc").alias("pay_hi_inc"))


# -- S8 vector delete, E7 lookup by id -----------------------------------------

@register("S8_vector_delete", "SELECT vec_id, label FROM embeddings "
                              "WHERE vec_id NOT IN (SELECT vec_id FROM embeddings WHERE label = 3)")
def q_vector_delete(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return W.delete_by_ids(e, e.filter(F.col("label") == 3), "vec_id")


@register("E7_lookup_by_id", """
SELECT doc_id AS application_id, CAST(s // 409 AS BIGINT) AS chunk_idx FROM (
  SELECT doc_id, unnest(range(0, length(text) - 511, 409)) AS s FROM documents WHERE length(text) >= 512)
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def q_lookup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chunks = chunk_text(docs, "text", 512, 0.2, keep=("doc_id",)).select(
        F.col("doc_id").alias("application_id"), F.col("chunk_idx").cast("bigint"))
    ids = table(spark, sf_dir, "labels").filter(F.col("quality") == 1)
    return W.rows_by_ids(chunks, ids, "application_id", "doc_id")


@register("S8_vector_delete_clustered", ORACLES["S8_vector_delete"])
def q_vector_delete_clustered(spark, sf_dir):
    """As S8, on a table clustered by id: only the files that can hold deleted ids are rewritten."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    stored = ClusteredTable.write(e, scratch_path(spark, "vectors-by-id"), "vec_id")
    return stored.delete(stored.rows().filter(F.col("label") == 3)).rows()


@register("E7_lookup_clustered", ORACLES["E7_lookup_by_id"])
def q_lookup_clustered(spark, sf_dir):
    """As E7, on chunks clustered by application id: only the files that can hold the ids are read."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chunks = chunk_text(docs, "text", 512, 0.2, keep=("doc_id",)).select(
        F.col("doc_id").alias("application_id"), F.col("chunk_idx").cast("bigint"), "chunk_txt")
    stored = ClusteredTable.write(chunks, scratch_path(spark, "chunks-by-id"), "application_id", ("chunk_idx",))
    ids = table(spark, sf_dir, "labels").filter(F.col("quality") == 1)
    return stored.lookup(ids, "doc_id").select("application_id", "chunk_idx")


# -- V1 conform on inventories composed from events ---------------------------------

_INVENTORY = ("""'{"a": "' || event_type || '", "n": ' || CAST(CAST(round(value * 100) AS BIGINT) AS STRING) ||
  CASE event_id % 3 WHEN 0 THEN ', "c": null' WHEN 1 THEN ', "c": "' || CAST(user_id AS STRING) || '"'
       ELSE '' END || '}'""")
V1_SCHEMAS = {          # name -> (fields, optional, not_required)
    "s_a": ({"a": "string"}, (), ()),
    "s_c": ({"c": "string"}, ("c",), ()),
    "s_d": ({"d": "string"}, (), ("d",)),
    "s_f": ({"f": "string"}, (), ()),
    "s_an": ({"a": "string", "n": "bigint"}, (), ()),
    "s_ns": ({"n": "string"}, (), ()),
}


@register("V1_conform", """
SELECT event_id, '{"a":"' || event_type || '"}' AS s_a,
  CASE event_id % 3 WHEN 0 THEN '{"c":null}' WHEN 1 THEN '{"c":"' || CAST(user_id AS VARCHAR) || '"}' END AS s_c,
  '{}' AS s_d, CAST(NULL AS VARCHAR) AS s_f,
  '{"a":"' || event_type || '","n":' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || '}' AS s_an,
  CAST(NULL AS VARCHAR) AS s_ns
FROM events""")
def q_conform(spark, sf_dir):
    from gleaner.operators.conform import conform_col

    ev = table(spark, sf_dir, "events").selectExpr("event_id", f"try_parse_json({_INVENTORY}) AS inv")
    return ev.select("event_id", *[conform_col("inv", f, o, n).alias(name)
                                   for name, (f, o, n) in V1_SCHEMAS.items()])


# -- S9 lake scan: the three writers persisted, scanned, compacted --------------------

@register("S9_lake_scan_compact", """
SELECT 'u' || CAST(user_id AS VARCHAR) AS key,
  arg_max(event_type, event_id) FILTER (WHERE event_type IN ('view', 'click', 'signup')) AS role,
  arg_min(ts, event_id) FILTER (WHERE event_type IN ('view', 'click', 'signup')) AS created_at,
  arg_max(value >= 50, event_id) FILTER (WHERE event_type = 'error') AS e2_success,
  arg_max_null(CASE WHEN value < 20 THEN NULL ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END, event_id)
      FILTER (WHERE event_type = 'purchase') AS position
FROM events GROUP BY user_id""")
def q_lake_scan(spark, sf_dir):
    ev = _events(spark, sf_dir).withColumn("url", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    lake = L.Lake(spark, scratch_path(spark, "lake"))
    cut = F.col("event_id") % 2 == 0     # two loads whose writes interleave: the second also holds earlier ones
    for part, tag in ((cut, "a"), (~cut, "b")):
        e = ev.filter(part)
        lake.append(L.upsert_postings(e.filter(F.col("event_type").isin("view", "click", "signup")).select(
            "url", F.col("event_type").alias("role"), F.col("user_id").alias("job_id"),
            F.col("ts").alias("created_at"), F.col("event_id").alias("_seq"), "batch"), F.col("batch")),
            f"postings_{tag}")
        lake.append(L.set_status(e.filter(F.col("event_type") == "error").select(
            "url", (F.col("value") >= 50).alias("ok"), F.col("event_id").alias("_seq"), "batch"),
            F.col("batch")), f"status_{tag}")
        lake.append(L.upsert_enriched(e.filter(F.col("event_type") == "purchase").select(
            "url", F.when(F.col("value") < 20, F.lit(None))
            .otherwise(F.floor("value").cast("bigint").cast("string")).alias("position"),
            F.col("event_id").alias("_seq"), "batch"), F.col("batch"), ["url", "position"]), f"enriched_{tag}")
        if tag == "a":
            # compact the first load into a one-row-per-key snapshot, then
            # start a fresh log on top of it (what a periodic compaction does)
            snap = lake.compact()
            lake = L.Lake(spark, scratch_path(spark, "lake"))
            lake.append(spark.read.parquet(snap), "snapshot")
    view = lake.scan(["role", "created_at", "e2_success", "position"])
    return view.select("key", "role", "created_at", "e2_success", "position")
