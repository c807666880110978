"""Queries for A1-A7 (tokens, budgets, reports) and E1, E4-E6, S7 (vectors)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gleaner.operators import budget as B
from gleaner.operators import vector_index as VI
from gleaner.operators import vectors as V
from gleaner.operators import warehouse as W
from gleaner.plans.catalog import _D_CHUNKS, ORACLES, _chunks, register
from gleaner.plans.tables import table
from gleaner.session import scratch_path
from gleaner.sources.topics import url_frontier
from gleaner.streaming import budget as SB
from gleaner.streaming import pipeline as PL

_TOKEN_RE = "[^ \\t\\n\\r\\f\\x0B]+"   # one token = a run of non-whitespace
_D_TOK = f"CAST(len(regexp_extract_all(chunk_txt, '{_TOKEN_RE}')) AS BIGINT)"
_D_CHUNK_TOK = f"SELECT *, {_D_TOK} AS tokens FROM ({_D_CHUNKS})"


def _chunk_tokens(spark, sf_dir):
    return B.with_tokens(_chunks(spark, sf_dir), "chunk_txt").withColumn("chunk_idx", F.col("chunk_idx").cast("bigint"))


# -- A1 / A2 -------------------------------------------------------------------------

@register("A1_count_tokens", f"SELECT doc_id, COUNT(*) AS n_chunks, CAST(SUM(tokens) AS BIGINT) AS tokens "
                             f"FROM ({_D_CHUNK_TOK}) GROUP BY doc_id")
def q_count_tokens(spark, sf_dir):
    return B.count_tokens(_chunks(spark, sf_dir), "chunk_txt", ["doc_id"])


_MODEL_OF_DOC = ("CASE doc_id % 3 WHEN 0 THEN 'nomic-embed-text' WHEN 1 THEN 'text-embedding-3-small' "
                 "ELSE 'text-embedding-3-large' END")
_D_PRICE = ("CASE model WHEN 'nomic-embed-text' THEN 0.02e-6 WHEN 'text-embedding-3-small' THEN 0.02e-6 "
            "ELSE 0.13e-6 END")


@register("A2_E2_cost", f"""
SELECT doc_id, model, tokens, CAST(tokens AS DOUBLE) * ({_D_PRICE}) AS cost_usd FROM (
  SELECT doc_id, {_MODEL_OF_DOC} AS model, CAST(SUM(tokens) AS BIGINT) AS tokens FROM ({_D_CHUNK_TOK}) GROUP BY doc_id)""")
def q_cost(spark, sf_dir):
    per_doc = _chunk_tokens(spark, sf_dir).groupBy("doc_id").agg(F.sum("tokens").cast("bigint").alias("tokens"))
    per_doc = per_doc.withColumn("model", F.expr(_MODEL_OF_DOC))
    out = B.cost(per_doc, B.model_catalog(spark), "tokens", "model")
    return out.select("doc_id", "model", "tokens", (F.col("tokens").cast("double") * F.col("cost_per_token"))
                      .alias("cost_usd"))


# -- A3 / A4 / A5 -----------------------------------------------------------------------

TOKEN_LIMIT, USD_LIMIT, PRICE = 3000.0, 4e-5, 0.02e-6

_PRICE_U, _USD_U = B.usd_units(PRICE), B.usd_units(USD_LIMIT)   # exact 1e-18 USD units
_D_FOLD = f"""
WITH RECURSIVE o AS (
  SELECT lang, source, doc_id, chunk_idx, CAST(tokens AS HUGEINT) AS t,
         row_number() OVER (PARTITION BY lang, source ORDER BY doc_id, chunk_idx) AS rn
  FROM ({_D_CHUNK_TOK})),
f AS (
  SELECT lang, source, rn, doc_id, chunk_idx,
         t <= {int(TOKEN_LIMIT)} AS tok_ok,
         CASE WHEN t <= {int(TOKEN_LIMIT)} THEN t ELSE 0 END AS tu,
         t <= {int(TOKEN_LIMIT)} AND t * {_PRICE_U} <= {_USD_U} AS admitted,
         CASE WHEN t <= {int(TOKEN_LIMIT)} AND t * {_PRICE_U} <= {_USD_U} THEN t * {_PRICE_U} ELSE 0 END AS uu,
         t
  FROM o WHERE rn = 1
  UNION ALL
  SELECT o.lang, o.source, o.rn, o.doc_id, o.chunk_idx,
         f.tu + o.t <= {int(TOKEN_LIMIT)},
         CASE WHEN f.tu + o.t <= {int(TOKEN_LIMIT)} THEN f.tu + o.t ELSE f.tu END,
         f.tu + o.t <= {int(TOKEN_LIMIT)} AND f.uu + o.t * {_PRICE_U} <= {_USD_U},
         CASE WHEN f.tu + o.t <= {int(TOKEN_LIMIT)} AND f.uu + o.t * {_PRICE_U} <= {_USD_U}
              THEN f.uu + o.t * {_PRICE_U} ELSE f.uu END,
         o.t
  FROM f JOIN o ON o.lang = f.lang AND o.source = f.source AND o.rn = f.rn + 1)"""


def _budgeted(spark, sf_dir):
    return B.budget(_chunk_tokens(spark, sf_dir), ["lang", "source"], ["doc_id", "chunk_idx"], "tokens",
                    token_limit=TOKEN_LIMIT, usd_limit=USD_LIMIT, price=PRICE)


@register("A3_A4_budget", _D_FOLD + "\nSELECT doc_id, chunk_idx, tok_ok, admitted FROM f")
def q_budget(spark, sf_dir):
    return _budgeted(spark, sf_dir).select("doc_id", "chunk_idx", "tok_ok", "admitted")


@register("A5_usage_report", _D_FOLD + f"""
SELECT lang, source, COUNT(*) AS n_requests, CAST(SUM(CAST(admitted AS BIGINT)) AS BIGINT) AS n_admitted,
       CAST(SUM(CASE WHEN tok_ok THEN t ELSE 0 END) AS DOUBLE) AS used_tokens,
       {TOKEN_LIMIT} - CAST(SUM(CASE WHEN tok_ok THEN t ELSE 0 END) AS DOUBLE) AS remaining_tokens,
       round(CAST(SUM(CASE WHEN admitted THEN t * {_PRICE_U} ELSE 0 END) AS DOUBLE) / 1e12, 6) AS used_usd_micro
FROM f GROUP BY lang, source""")
def q_usage(spark, sf_dir):
    rep = B.usage_report(_budgeted(spark, sf_dir), ["lang", "source"], "tokens", TOKEN_LIMIT, USD_LIMIT, PRICE)
    return rep.select("lang", "source", "n_requests", "n_admitted", "used_tokens", "remaining_tokens",
                      F.round(F.col("used_usd") * 1e6, 6).alias("used_usd_micro"))


# -- A6 / A7 ------------------------------------------------------------------------------

_MODEL_OF_EVENT = ("CASE event_type WHEN 'click' THEN 'text-embedding-3-small' "
                   "WHEN 'view' THEN 'text-embedding-3-large' ELSE 'nomic-embed-text' END")


@register("A6_rate_audit", f"""
SELECT minute, model, n_requests, n_tokens,
       n_requests > CASE WHEN model = 'nomic-embed-text' THEN NULL ELSE 3000 END AS over_rpm,
       n_tokens > CASE WHEN model = 'nomic-embed-text' THEN NULL ELSE 1e6 END AS over_tpm
FROM (SELECT date_trunc('minute', ts) AS minute, {_MODEL_OF_EVENT} AS model, COUNT(*) AS n_requests,
             CAST(SUM(CAST(floor(value) AS BIGINT)) AS BIGINT) AS n_tokens FROM events GROUP BY 1, 2)""")
def q_rate(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(
        "ts", F.expr(_MODEL_OF_EVENT).alias("model"), F.floor("value").cast("bigint").alias("tokens"))
    return B.rate_audit(ev, "ts", "model", "tokens", B.model_catalog(spark))


@register("A7_yield_report", """
WITH p AS (SELECT CAST(n_regionkey AS BIGINT) AS run, unnest(range(n_regionkey + 1, n_nationkey % 7 + 2)) AS page,
                  25 + n_nationkey AS per_page FROM nation)
SELECT run, COUNT(*) AS expected_pages, CAST(SUM(per_page) AS BIGINT) AS expected_postings,
       COUNT(*) FILTER (WHERE page % 7 <> 0) AS obtained_pages,
       CAST(coalesce(SUM(per_page) FILTER (WHERE page % 7 <> 0), 0) AS BIGINT) AS obtained_postings,
       round(COUNT(*) FILTER (WHERE page % 7 <> 0) / COUNT(*), 6) AS page_yield
FROM p GROUP BY run""")
def q_yield(spark, sf_dir):
    cmds = table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").cast("bigint").alias("run"), (F.col("n_regionkey") + 1).alias("start_page"),
        (F.col("n_nationkey") % 7 + 1).alias("end_page"), (F.col("n_nationkey") + 25).cast("bigint").alias("per_page"))
    pages = url_frontier(cmds, keep=("run",))
    fetched = pages.filter(F.col("page") % 7 != 0)   # simulated fetch outcome of each page
    rep = B.yield_report(pages, fetched, "run")
    return rep.select("run", "expected_pages", F.col("expected_postings").cast("bigint"), "obtained_pages",
                      F.col("obtained_postings").cast("bigint"), "page_yield")


# -- E1 / E4 / E5 / E6 / S7 ------------------------------------------------------------------

def letter_statistics(texts: list[str]):
    """A small embedding that SQL can repeat; it refuses texts with a pipe, so some requests fail."""
    if any("|" in t for t in texts):
        raise ValueError("a pipe in the text")
    return [[len(t), t.count(" "), t.count("e"), t.count("\n")] for t in texts]


@register("E1_embed_chunks", f"""
SELECT doc_id, chunk_idx, ok, CASE WHEN ok THEN 4 END AS dim,
       CASE WHEN ok THEN CAST(length(chunk_txt) + 10 * (length(chunk_txt) - length(replace(chunk_txt, ' ', '')))
         + 100 * (length(chunk_txt) - length(replace(chunk_txt, 'e', '')))
         + 1000 * (length(chunk_txt) - length(replace(chunk_txt, chr(10), ''))) AS BIGINT) END AS checked
FROM (SELECT *, NOT bool_or(contains(chunk_txt, '|')) OVER (PARTITION BY doc_id) AS ok FROM ({_D_CHUNKS}))""")
def q_embed(spark, sf_dir):
    c = _chunks(spark, sf_dir).select("doc_id", F.col("chunk_idx").cast("bigint").alias("chunk_idx"), "chunk_txt")
    e = V.embed_chunks(c, letter_statistics, request="doc_id", dim=4)
    total = F.aggregate(F.zip_with("vec", F.array(*[F.lit(x) for x in (1, 10, 100, 1000)]), lambda v, w: v.cast("bigint") * w),
                        F.lit(0).cast("bigint"), lambda a, x: a + x)
    return e.select("doc_id", "chunk_idx", "ok", F.when(F.col("ok"), F.size("vec")).alias("dim"),
                    F.when(F.col("ok"), total).alias("checked"))


def label_centroids(spark, sf_dir):
    """Search queries: the mean vector of every label (computed by Spark)."""
    e = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    per_dim = e.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return per_dim.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("query_vec")) \
        .withColumnRenamed("label", "query_id")


_D_TOPK = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
x AS (SELECT label, unnest(range(len(v))) AS i, unnest(v) AS xv FROM e),
m AS (SELECT label, i, avg(xv) AS mv FROM x GROUP BY label, i),
c AS (SELECT label, list(mv ORDER BY i) AS q FROM m GROUP BY label),
s AS (SELECT c.label AS query_id, e.vec_id AS id, round(list_cosine_similarity(e.v, c.q), 6) AS score
      FROM e CROSS JOIN c)
SELECT query_id, CAST(rank AS BIGINT) AS rank, id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) WHERE rank <= 5"""


@register("E4_cosine_top_k", _D_TOPK.replace("SELECT query_id, CAST(rank AS BIGINT) AS rank, id, score FROM",
                                              "SELECT query_id, CAST(rank AS BIGINT) AS rank, r.id, score, e.label AS chunk_idx, "
                                              "'vector ' || r.id AS chunk_txt FROM")
          .replace(") WHERE rank <= 5", ") r JOIN embeddings e ON e.vec_id = r.id WHERE rank <= 5"))
def q_topk(spark, sf_dir):
    base = table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "embedding", "label AS chunk_idx", "'vector ' || vec_id AS chunk_txt")
    return V.cosine_top_k(base, label_centroids(spark, sf_dir), 5, keep=("chunk_idx", "chunk_txt"))


# the same hyperplanes from the same integer rule
_D_APPROX = _D_TOPK.split("s AS (")[0] + f"""
i AS (SELECT unnest(range({V.SIGNATURE_BITS} * 64)) AS i),
h AS (SELECT i, (i * 48271 + 11) % {V.PRIME} AS a, a * a % {V.PRIME} AS h FROM i),
p AS (SELECT i // 64 AS bit, list(CAST((h * h + i) % {V.PRIME} AS DOUBLE) / {V.PRIME} - 0.5 ORDER BY i) AS plane FROM h GROUP BY 1),
bs AS (SELECT vec_id, bit, list_inner_product(v, plane) > 0 AS s FROM e CROSS JOIN p),
qs AS (SELECT label, bit, list_inner_product(q, plane) > 0 AS s FROM c CROSS JOIN p),
n AS (SELECT qs.label, bs.vec_id FROM qs JOIN bs USING (bit) GROUP BY ALL
      HAVING count(*) FILTER (WHERE qs.s <> bs.s) <= {V.SIGNATURE_REACH}),
s AS (SELECT c.label AS query_id, e.vec_id AS id, round(list_cosine_similarity(e.v, c.q), 6) AS score
      FROM n JOIN e USING (vec_id) JOIN c ON c.label = n.label)
SELECT query_id, CAST(rank AS BIGINT) AS rank, id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) WHERE rank <= 5"""


@register("E5_approx_top_k", _D_APPROX)
def q_approx(spark, sf_dir):
    return V.approx_top_k(table(spark, sf_dir, "embeddings"), label_centroids(spark, sf_dir), 5)


# the same searches with every fiftieth row as a query
_D_ROWS = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT c.vec_id AS query_id, e.vec_id AS id, round(list_cosine_similarity(e.v, c.v), 6) AS score
      FROM e CROSS JOIN e c WHERE c.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS BIGINT) AS rank, id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) WHERE rank <= 5"""


def rows_as_queries(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").where("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "embedding AS query_vec")


@register("E4_cosine_top_k_rows", _D_ROWS)
def q_topk_rows(spark, sf_dir):
    return V.cosine_top_k(table(spark, sf_dir, "embeddings"), rows_as_queries(spark, sf_dir), 5)


@register("E5_index_top_k", None)
def q_index(spark, sf_dir):
    """Approximate: the nearest cells of a stored index; recall is tested against E4."""
    index = VI.build_index(table(spark, sf_dir, "embeddings"), scratch_path(spark, "vector-index"))
    return index.search(rows_as_queries(spark, sf_dir), 5)


@register("E5_index_exact_top_k", _D_ROWS)
def q_index_exact(spark, sf_dir):
    """Exact: the cells whose bound allows a better row are visited as well."""
    index = VI.build_index(table(spark, sf_dir, "embeddings"), scratch_path(spark, "vector-index"))
    return index.search(rows_as_queries(spark, sf_dir), 5, exact=True)


_E6_ROWS = {
    "application_id": "vec_id", "chunk_idx": "CAST(label AS BIGINT)",
    "chunk_txt": "repeat('x', CAST(vec_id % 700 AS INT))",
}


@register("E6_check_vectors", """
SELECT CASE WHEN vec_id % 9 = 0 AND vec_id % 700 > 512 THEN 'E6_dim,E6_chunk_len'
            WHEN vec_id % 9 = 0 THEN 'E6_dim' WHEN vec_id % 700 > 512 THEN 'E6_chunk_len' ELSE 'ok' END AS outcome,
       COUNT(*) AS n_rows FROM embeddings GROUP BY 1""")
def q_check_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").selectExpr(
        *[f"{v} AS {k}" for k, v in _E6_ROWS.items()],
        "CASE WHEN vec_id % 9 = 0 THEN slice(embedding, 1, 32) ELSE embedding END AS chunk_vec")
    good, bad = V.check_vectors(e, 64, 512)
    out = good.select(F.lit("ok").alias("outcome")).unionByName(
        bad.select(F.array_join("_errors", ",").alias("outcome")))
    return out.groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"))


@register("S7_vector_collection", "SELECT label, COUNT(*) AS n_rows, CAST(MIN(len(embedding)) AS INTEGER) AS dim "
                                  "FROM embeddings GROUP BY label")
def q_collection(spark, sf_dir):
    name = f"vectors_{uuid.uuid4().hex[:8]}"
    W.create_vectors(spark, name, 64, 512, location=scratch_path(spark, name))
    W.create_vectors(spark, name, 64, 512)          # present: a no-op
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("application_id"), F.col("label").cast("bigint").alias("chunk_idx"),
        F.concat(F.lit("vector "), "vec_id").alias("chunk_txt"), F.col("embedding").alias("chunk_vec"))
    good, _ = V.check_vectors(rows, 64, 512)
    W.append_table(good, name)
    path = scratch_path(spark, name)
    spark.table(name).write.parquet(path)             # the collection goes, what was read from it stays
    W.drop_vectors(spark, name)
    W.drop_vectors(spark, name)                       # absent: a no-op
    return spark.read.parquet(path).groupBy(F.col("chunk_idx").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.size("chunk_vec")).alias("dim"))


# -- A3 / A4 / A6 as requests arrive -----------------------------------------------------------

ARRIVALS = 3


def arriving(df, order: str):
    """The table in ARRIVALS parts, each all before the next in ``order`` (equal widths of its range)."""
    number = F.col(order).cast("double")
    lo, hi = df.agg(F.min(number), F.max(number)).first()
    if lo is None:
        return []
    step = (hi - lo) / ARRIVALS
    part = F.least(F.floor((number - F.lit(lo)) / F.lit(step or 1.0)), F.lit(ARRIVALS - 1))
    return [df.where(part == i) for i in range(ARRIVALS)]


@register("A3_A4_budget_stream", ORACLES["A3_A4_budget"])
def q_budget_stream(spark, sf_dir):
    """Requests arrive in three landings; the query is started anew for each and goes on from its checkpoint."""
    root = scratch_path(spark, "budget-stream")
    requests = _chunk_tokens(spark, sf_dir).select("lang", "source", "doc_id", "chunk_idx", "tokens")
    for part in arriving(requests, "doc_id"):
        part.write.mode("append").parquet(f"{root}/requests")
        stream = spark.readStream.schema(requests.schema).parquet(f"{root}/requests")
        decided = SB.budget_stream(stream, ["lang", "source"], ["doc_id", "chunk_idx"], token_limit=TOKEN_LIMIT,
                                   usd_limit=USD_LIMIT, price=PRICE)
        PL.drain(decided, lambda df, b: df.write.mode("overwrite").parquet(f"{root}/decided/batch={b}"), f"{root}/ckpt")
    out = spark.read.schema("doc_id bigint, chunk_idx bigint, tok_ok boolean, admitted boolean").parquet(f"{root}/decided")
    return out.select("doc_id", "chunk_idx", "tok_ok", "admitted")


@register("A6_rate_audit_stream", ORACLES["A6_rate_audit"])
def q_rate_stream(spark, sf_dir):
    """Events arrive in order in three landings; a heartbeat two days on lets the watermark pass the last window."""
    root = scratch_path(spark, "audit-stream")
    events = table(spark, sf_dir, "events").select(
        "ts", F.expr(_MODEL_OF_EVENT).alias("model"), F.floor("value").cast("bigint").alias("tokens"))
    beat = events.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts")).where("ts is not null").select(
        "ts", F.lit(None).cast("string").alias("model"), F.lit(0).cast("bigint").alias("tokens"))
    for part in [*arriving(events.withColumn("at", F.col("ts").cast("timestamp")), "at"), beat]:
        part.select("ts", "model", "tokens").write.mode("append").parquet(f"{root}/events")
    stream = spark.readStream.schema(events.schema).parquet(f"{root}/events")
    audit = SB.rate_audit_stream(stream, "ts", "model", "tokens", B.model_catalog(spark))
    (audit.writeStream.outputMode("append").format("parquet").option("path", f"{root}/audit")
     .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(audit.schema).parquet(f"{root}/audit")
