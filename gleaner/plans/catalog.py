"""Registered queries: one per operator group of the survey inventory.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql)``.
The oracle is DuckDB SQL over the same parquet tables (registered as views
named after the tables); ``None`` marks operators with no SQL form, which
get a row-count check only. Column names and types are aligned on both
sides (BIGINT ids, VARCHAR text, DOUBLE rounded to 6 places).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import clean as C
from gleaner.operators.chunk import chunk_stats, chunk_text
from gleaner.operators.postings import clean_postings, route_dead_letters, validate_enriched
from gleaner.plans import postings_fixture as PF
from gleaner.plans.tables import table
from gleaner.session import spread

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------------------
# C18 chunking (documents)
# ---------------------------------------------------------------------------

CHUNK_SIZE, CHUNK_OVERLAP = 512, 0.2   # the setting the reference's tests use
CHUNK_STEP = 409


def _chunks(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    return chunk_text(docs, "text", CHUNK_SIZE, CHUNK_OVERLAP, keep=("doc_id", "lang", "source"))


_D_CHUNKS = (f"SELECT doc_id, lang, source, CAST(s // {CHUNK_STEP} AS BIGINT) AS chunk_idx, "
             f"substring(text, s + 1, {CHUNK_SIZE}) AS chunk_txt FROM ("
             f"SELECT doc_id, lang, source, text, unnest(range(0, length(text) - {CHUNK_SIZE - 1}, {CHUNK_STEP})) AS s "
             f"FROM documents WHERE length(text) >= {CHUNK_SIZE})")


@register("C18_chunk_text", f"SELECT doc_id, chunk_idx, chunk_txt FROM ({_D_CHUNKS})")
def q_chunk_text(spark, sf_dir):
    return _chunks(spark, sf_dir).select("doc_id", F.col("chunk_idx").cast("bigint"), "chunk_txt")


@register("C18_chunk_stats",
          f"SELECT lang, COUNT(*) AS n_chunks, COUNT(DISTINCT doc_id) AS n_docs, "
          f"CAST(SUM(length(chunk_txt)) AS BIGINT) AS total_chars, CAST(MIN(length(chunk_txt)) AS BIGINT) AS min_len, "
          f"CAST(MAX(length(chunk_txt)) AS BIGINT) AS max_len FROM ({_D_CHUNKS}) GROUP BY lang")
def q_chunk_stats(spark, sf_dir):
    return chunk_stats(_chunks(spark, sf_dir), "lang").select(
        "lang", "n_chunks", "n_docs", F.col("total_chars").cast("bigint"),
        F.col("min_len").cast("bigint"), F.col("max_len").cast("bigint"))


# ---------------------------------------------------------------------------
# C2-C17 cleaning rules (raw posting text composed from orders)
# ---------------------------------------------------------------------------

def _oracle(select: str, tail: str = "") -> str:
    return f"WITH {PF.oracle_base()}\nSELECT {select} FROM nz {tail}"


def _raw(spark, sf_dir):
    return PF.raw_postings(spark, sf_dir)


@register("C2_C8_job_type", _oracle("posting_id, job_n AS job_type"))
def q_job_type(spark, sf_dir):
    return _raw(spark, sf_dir).select("posting_id", C.job_type("job_raw").alias("job_type"))


@register("C4_wage", _oracle(
    f"posting_id, CASE WHEN wage_raw IS NULL THEN NULL WHEN w_unit = 'unpaid' THEN 0 "
    f"WHEN w_unit = 'paid' OR w_lo IS NULL THEN NULL ELSE w_lo * ({PF.d_wage_scale()}) END AS wage_lo, "
    f"CASE WHEN wage_raw IS NULL THEN NULL WHEN w_unit = 'unpaid' THEN 0 "
    f"WHEN w_unit = 'paid' OR w_lo IS NULL THEN NULL ELSE coalesce(w_hi, w_lo) * ({PF.d_wage_scale()}) END AS wage_hi"))
def q_wage(spark, sf_dir):
    w = _raw(spark, sf_dir).select("posting_id", C.wage("wage_raw").alias("w"))
    return w.select("posting_id", F.col("w")[0].alias("wage_lo"), F.col("w")[1].alias("wage_hi"))


@register("C5_C6_location", _oracle(
    "posting_id, nullif(regexp_extract(loc_n, 'based in ([^\\n]*)$', 1), '') AS location, "
    "CASE WHEN location_raw IS NULL THEN '' "
    "WHEN regexp_matches(loc_n, 'onsite|remote|hybrid') THEN regexp_extract(loc_n, '(onsite|remote|hybrid)', 1) "
    "END AS location_type"))
def q_location(spark, sf_dir):
    lt = C.location_type("location_raw")
    return _raw(spark, sf_dir).select(
        "posting_id", C.location("location_raw").alias("location"),
        F.when(lt.isNotNull(), F.array_join(lt, ",")).alias("location_type"))


@register("C7_employment_type", _oracle(
    "posting_id, nullif(regexp_extract(emp_n, '(\\w+-time)', 1), '') AS employment_type"))
def q_employment(spark, sf_dir):
    return _raw(spark, sf_dir).select("posting_id", C.employment_type("employment_raw").alias("employment_type"))


@register("C10_apply_type", _oracle(
    "posting_id, CASE WHEN apply_raw IS NULL THEN NULL WHEN apply_n = 'apply' THEN 'internal' "
    "ELSE 'external' END AS apply_type"))
def q_apply_type(spark, sf_dir):
    return _raw(spark, sf_dir).select("posting_id", C.apply_type("apply_raw").alias("apply_type"))


@register("C11_C14_C15_text_fields", _oracle(
    f"posting_id, {PF.d_lower_strip('position_raw')} AS position, {PF.d_strip('company_raw')} AS company, "
    f"{PF.d_lower_strip('industry_raw')} AS industry"))
def q_text_fields(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "posting_id", C.position("position_raw").alias("position"),
        C.company("company_raw").alias("company"), C.industry("industry_raw").alias("industry"))


_D_POSTED_N = "TRY_CAST(regexp_extract(times_c, '(?i)posted (\\d+) (\\w*[^s\\W])', 1) AS INTEGER)"
_D_POSTED_U = "regexp_extract(times_c, '(?i)posted (\\d+) (\\w*[^s\\W])', 2)"


@register("C12_posted_at", _oracle(
    f"posting_id, CASE {_D_POSTED_U} "
    f"WHEN 'year' THEN extracted_on - to_years({_D_POSTED_N}) "
    f"WHEN 'month' THEN extracted_on - to_months({_D_POSTED_N}) "
    f"WHEN 'week' THEN extracted_on - to_weeks({_D_POSTED_N}) "
    f"WHEN 'day' THEN extracted_on - to_days({_D_POSTED_N}) "
    f"WHEN 'hour' THEN extracted_on - to_hours({_D_POSTED_N}) "
    f"WHEN 'minute' THEN extracted_on - to_minutes({_D_POSTED_N}) "
    f"WHEN 'second' THEN extracted_on - to_seconds({_D_POSTED_N}) END AS posted_at"))
def q_posted_at(spark, sf_dir):
    return _raw(spark, sf_dir).select("posting_id", C.posted_at("times_raw", "extracted_on").alias("posted_at"))


_D_APPLY = "'(?i)apply by (\\w+) (\\d+), (\\d+) at (\\d+:\\d+) (am|pm)'"


@register("C13_apply_by", _oracle(
    f"posting_id, try_strptime(regexp_extract(times_c, {_D_APPLY}, 1) || ' ' || regexp_extract(times_c, {_D_APPLY}, 2) "
    f"|| ' ' || regexp_extract(times_c, {_D_APPLY}, 3) || ' ' || regexp_extract(times_c, {_D_APPLY}, 4) "
    f"|| ' ' || upper(regexp_extract(times_c, {_D_APPLY}, 5)), '%B %d %Y %I:%M %p') AS apply_by"))
def q_apply_by(spark, sf_dir):
    return _raw(spark, sf_dir).select("posting_id", C.apply_by("times_raw").alias("apply_by"))


_D_DOCS = ("array_to_string(list_transform(list_filter([" + PF.d_strip("doc1") + ", " + PF.d_strip("doc2") +
           "], lambda d: regexp_matches(d, 'Search your\\s')), "
           "lambda d: regexp_extract(d, 'Search your\\s([^\\n]*[^s]|)', 1)), '|')")


@register("C16_documents", _oracle(f"posting_id, {_D_DOCS} AS documents"))
def q_documents(spark, sf_dir):
    return _raw(spark, sf_dir).select("posting_id", F.array_join(C.documents("documents_raw"), "|").alias("documents"))


def _clean(spark, sf_dir):
    return clean_postings(_raw(spark, sf_dir), "extracted_on", keep=("posting_id",))


_D_WAGE = ("CASE WHEN wage_raw IS NULL THEN NULL WHEN w_unit = 'unpaid' THEN 0 "
           "WHEN w_unit = 'paid' OR w_lo IS NULL THEN NULL ELSE {v} * (" + PF.d_wage_scale() + ") END")
_D_HAS_POSTED = "regexp_matches(times_c, '(?i)posted (\\d+) (\\w*[^s\\W])')"
_D_FIELDS = {
    "apply_by": (f"try_strptime(regexp_extract(times_c, {_D_APPLY}, 1) || ' ' || regexp_extract(times_c, {_D_APPLY}, 2) "
                 f"|| ' ' || regexp_extract(times_c, {_D_APPLY}, 3) || ' ' || regexp_extract(times_c, {_D_APPLY}, 4) "
                 f"|| ' ' || upper(regexp_extract(times_c, {_D_APPLY}, 5)), '%B %d %Y %I:%M %p')"),
    "apply_type": "CASE WHEN apply_raw IS NULL THEN NULL WHEN apply_n = 'apply' THEN 'internal' ELSE 'external' END",
    "company": PF.d_strip("company_raw"),
    "employment_type": "nullif(regexp_extract(emp_n, '(\\w+-time)', 1), '')",
    "industry": PF.d_lower_strip("industry_raw"),
    "job_type": "job_n",
    "location": "nullif(regexp_extract(loc_n, 'based in ([^\\n]*)$', 1), '')",
    "position": PF.d_lower_strip("position_raw"),
    "posted_at": (f"CASE {_D_POSTED_U} "
                  + " ".join(f"WHEN '{u}' THEN extracted_on - to_{u}s({_D_POSTED_N})"
                             for u in ("year", "month", "week", "day", "hour", "minute", "second")) + " END"),
    "documents": _D_DOCS,
    "location_type": ("CASE WHEN location_raw IS NULL THEN '' WHEN regexp_matches(loc_n, 'onsite|remote|hybrid') "
                      "THEN regexp_extract(loc_n, '(onsite|remote|hybrid)', 1) END"),
    "wage_lo": _D_WAGE.format(v="w_lo"),
    "wage_hi": _D_WAGE.format(v="coalesce(w_hi, w_lo)"),
}
_D_ERRORS = ("concat_ws(',', "
             "CASE WHEN wage_raw IS NOT NULL AND NOT coalesce(w_unit IN ('paid', 'unpaid'), false) "
             f"AND ({_D_FIELDS['wage_lo']}) IS NULL THEN 'C4_wage' END, "
             f"CASE WHEN times_raw IS NOT NULL AND NOT {_D_HAS_POSTED} THEN 'C12_posted_missing' END, "
             f"CASE WHEN {_D_HAS_POSTED} AND NOT coalesce({_D_POSTED_U} IN "
             "('year','month','week','day','hour','minute','second','microsecond') "
             f"AND {_D_POSTED_N} IS NOT NULL, false) THEN 'C12_posted_unit' END, "
             f"CASE WHEN times_raw IS NOT NULL AND ({_D_FIELDS['apply_by']}) IS NULL THEN 'C13_apply_by' END)")


@register("C17_clean_postings", _oracle("posting_id, " + ", ".join(f"{v} AS {k}" for k, v in _D_FIELDS.items())
                                        + f", {_D_ERRORS} AS errors"))
def q_clean_postings(spark, sf_dir):
    df = _clean(spark, sf_dir)
    return df.select("posting_id", "apply_by", "apply_type", "company", "employment_type", "industry",
                     "job_type", "location", "position", "posted_at",
                     F.array_join("documents", "|").alias("documents"),
                     F.array_join("location_type", ",").alias("location_type"),
                     F.col("wage")[0].alias("wage_lo"), F.col("wage")[1].alias("wage_hi"),
                     F.array_join("_errors", ",").alias("errors"))


@register("V2_V3_quarantine_counts", _oracle(
    "CASE WHEN location_raw IS NOT NULL AND NOT regexp_matches(loc_n, 'onsite|remote|hybrid') "
    "THEN 'bad' ELSE 'good' END AS side, COUNT(*) AS n_rows", "GROUP BY 1"))
def q_quarantine(spark, sf_dir):
    good, bad = validate_enriched(_clean(spark, sf_dir).withColumn("url", F.lit("u")),
                                  include_rule_errors=False)
    return (good.select(F.lit("good").alias("side"))
            .unionByName(route_dead_letters(bad, stage_names=("bad",)).select(F.col("stage").alias("side")))
            .groupBy("side").agg(F.count(F.lit(1)).alias("n_rows")))


# Query modules register themselves on import (kept last: they import
# ``register`` from here).
from gleaner.plans import q_html, q_lake, q_messages, q_stream, q_vectors  # noqa: E402,F401
