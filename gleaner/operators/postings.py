"""C17 clean_postings, V2 validate_enriched, V3 route_dead_letters.

All three are single ``select``/``filter`` projections over native Column
rules: no shuffle, no Python worker, and they behave the same on a batch or
a streaming DataFrame. Rows the reference would reject with an exception are
kept and routed to a quarantine DataFrame with an ``_errors`` array instead
of failing the job; ``mode='failfast'`` restores the raising behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions import clean as C
from gleaner.functions.text import first_match, normalize

# The cleaned record (the reference's 13 fields, plus url and scraped_at).
CLEAN_FIELDS = ("about", "apply_by", "apply_type", "company", "documents", "employment_type",
                "industry", "job_type", "location", "location_type", "position", "posted_at", "wage")

RAW_DEFAULTS = {
    "wage_raw": "string", "location_raw": "string", "employment_raw": "string",
    "job_raw": "string", "about_raw": "string", "apply_raw": "string",
    "position_raw": "string", "times_raw": "string", "company_raw": "string",
    "industry_raw": "string", "documents_raw": "array<string>", "url": "string",
}


def _col_or_null(df: DataFrame, name: str, dtype: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def clean_postings(raw: DataFrame, extracted_on: str | Column = "extracted_on",
                   keep: tuple[str, ...] = (), about: str | Column | None = None) -> DataFrame:
    """Raw detail fields -> cleaned posting record.

    Input columns (missing ones are treated as null): ``wage_raw``,
    ``location_raw``, ``employment_raw``, ``job_raw``, ``apply_raw``,
    ``position_raw``, ``times_raw``, ``company_raw``, ``industry_raw``,
    ``documents_raw`` (array<string>), ``url``, and ``about_md`` (already
    converted by the HTML pass) or ``about``.

    Output: ``*keep``, the 13 clean fields, ``url``, ``scraped_at`` and
    ``_errors`` (array<string>; the rules that would raise in the reference).

    Three narrow projections: (1) normalize each raw text once, (2) extract
    the regex parts from the normalized columns, (3) combine. Each expensive
    value is referenced by column, so Catalyst keeps the stages apart instead
    of re-evaluating a look-behind regex in every CASE branch.
    """
    g = {k: _col_or_null(raw, k, t) for k, t in RAW_DEFAULTS.items()}
    ext = F.col(extracted_on) if isinstance(extracted_on, str) else extracted_on
    if about is None:
        about_col = _col_or_null(raw, "about_md", "string") if "about_md" in raw.columns \
            else _col_or_null(raw, "about", "string")
    else:
        about_col = F.col(about) if isinstance(about, str) else about
    k = [F.col(c) for c in keep]
    s1 = raw.select(
        *k, about_col.alias("about"), g["url"].alias("url"), ext.cast("timestamp_ntz").alias("scraped_at"),
        g["wage_raw"].alias("_wr"), g["location_raw"].alias("_lr"), g["apply_raw"].alias("_ar"),
        g["position_raw"].alias("_pr"), g["company_raw"].alias("_cr"), g["industry_raw"].alias("_ir"),
        g["documents_raw"].alias("_dr"),
        normalize(g["wage_raw"]).alias("_wn"), normalize(g["location_raw"]).alias("_ln"),
        normalize(g["employment_raw"]).alias("_en"), normalize(g["job_raw"]).alias("_jn"),
        normalize(g["apply_raw"]).alias("_an"), C._times(g["times_raw"]).alias("_tc"))
    wp = C.wage_parts_of_normalized("_wn")
    pp = C.posted_parts("_tc")
    s2 = s1.select(
        *keep, "about", "url", "scraped_at", "_wr", "_tc",
        C.apply_by_clean("_tc").alias("apply_by"),
        C.apply_type_from_normalized("_ar", "_an").alias("apply_type"),
        C.company("_cr").alias("company"),
        C.documents("_dr").alias("documents"),
        first_match("_en", C.EMPLOYMENT_PATTERN).alias("employment_type"),
        C.industry("_ir").alias("industry"),
        F.col("_jn").alias("job_type"),
        first_match("_ln", C.LOCATION_PATTERN).alias("location"),
        C.location_type_from_normalized("_lr", "_ln").alias("location_type"),
        C.position("_pr").alias("position"),
        wp["unit"].alias("_wu"), wp["k"].alias("_wk"), wp["lo"].alias("_wlo"), wp["hi"].alias("_whi"),
        pp["n"].alias("_pn"), pp["unit"].alias("_pu"))
    wage_col = C.wage_from_parts("_wr", "_wu", "_wk", "_wlo", "_whi")
    s3 = s2.select(
        *keep, "about", "apply_by", "apply_type", "company", "documents", "employment_type", "industry",
        "job_type", "location", "location_type", "position",
        C.posted_from_parts("_pn", "_pu", "scraped_at").alias("posted_at"),
        wage_col.alias("wage"), "url", "scraped_at", "_wr", "_wu", "_tc", "_pn", "_pu")
    return s3.select(
        *keep, *CLEAN_FIELDS, "url", "scraped_at",
        C.rule_errors(C.wage_error_from_parts("_wr", "_wu", "wage"), "_tc", "_pn", "_pu", "apply_by")
        .alias("_errors"))


def barrier(tagged: DataFrame, name: str) -> DataFrame:
    """Count rows and quarantined rows with ``observe`` before a split.

    The metrics node also stops the good/bad filters from being pushed into
    the tagging projection, which would evaluate every rule (and any Python
    pass) twice: once for the filter and once for the output.
    """
    import uuid

    return tagged.observe(f"{name}_{uuid.uuid4().hex[:8]}", F.count(F.lit(1)).alias("rows"),
                          F.sum((F.size("_errors") > 0).cast("long")).alias("quarantined"))


def contract_errors(df: DataFrame) -> Column:
    """V2: the enriched-record contract as predicates -> array<string>.

    ``documents`` and ``location_type`` must be lists (not null) and ``url``
    must be present; every other field is nullable. Types are enforced by the
    DataFrame schema itself.
    """
    checks = [
        F.when(F.col("url").isNull(), F.lit("V2_url_null")),
        F.when(F.col("documents").isNull(), F.lit("V2_documents_null")),
        F.when(F.col("location_type").isNull(), F.lit("V2_location_type_null")),
    ]
    if "wage" in df.columns:
        checks.append(F.when(F.col("wage").isNotNull() & (F.size("wage") != 2), F.lit("V2_wage_shape")))
    return F.filter(F.array(*checks), lambda e: e.isNotNull())


def validate_enriched(df: DataFrame, mode: str = "permissive",
                      include_rule_errors: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split cleaned records into (good, quarantine).

    A row is quarantined when it breaks the contract (V2) or, with
    ``include_rule_errors``, when a cleaning rule failed (C4/C12/C13). The
    good side drops ``_errors``; the quarantine side keeps it.
    ``mode='failfast'`` raises on the first bad row instead (one extra job).
    """
    prior = F.col("_errors") if ("_errors" in df.columns and include_rule_errors) \
        else F.array().cast("array<string>")
    tagged = barrier(df.withColumn("_errors", F.concat(prior, contract_errors(df))), "validate")
    bad_pred = F.size("_errors") > 0
    good = tagged.filter(~bad_pred).drop("_errors")
    bad = tagged.filter(bad_pred)
    if mode == "failfast":
        first = bad.select("_errors").limit(1).collect()
        if first:
            raise ValueError(f"record breaks the contract: {first[0]['_errors']}")
    elif mode != "permissive":
        raise ValueError("mode must be 'permissive' or 'failfast'")
    return good, bad


def route_dead_letters(*quarantines: DataFrame, stage_names: tuple[str, ...] | None = None) -> DataFrame:
    """V3: union quarantine frames into one dead-letter table.

    Each row becomes ``stage, _errors, record`` where ``record`` is the
    offending row as JSON, so frames with different schemas share one table.
    """
    out = None
    for i, q in enumerate(quarantines):
        stage = stage_names[i] if stage_names else f"stage{i}"
        payload = [c for c in q.columns if c != "_errors"]
        errs = F.col("_errors") if "_errors" in q.columns else F.array().cast("array<string>")
        part = q.select(F.lit(stage).alias("stage"), errs.alias("_errors"),
                        F.to_json(F.struct(*payload)).alias("record"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no quarantine frames given")
    return out
