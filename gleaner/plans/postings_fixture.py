"""Raw posting fields composed from ``orders`` rows.

The driver tables hold no job postings, so the cleaning queries build raw
field text from ``orders`` columns with plain SQL expressions that Spark and
DuckDB evaluate identically (``||``, ``CASE``, ``%``, ``lpad``, ``chr``).
The same expression text feeds both engines; each engine then applies the
rules its own way (Spark: the ``gleaner.functions.clean`` Column rules;
DuckDB: the RE2-safe rewrites below), so the comparison checks the rules,
not the composition.

Every ``orders`` row yields one posting, so the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleaner.plans.tables import table

MONTHS = ("January February March April May June July August September "
          "October November December").split()

_BS = "chr(92)"
_LIT_DASH = f"({_BS} || 'xe2' || {_BS} || 'x80' || {_BS} || 'x93')"
_LIT_BULLET = f"({_BS} || 'xe2' || {_BS} || 'x88' || {_BS} || 'x99')"


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _month_case(idx: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTHS))
    return f"CASE {idx} {arms} END"


K = "o_orderkey"

# (column, SQL expression over one orders row)
COMPOSE: list[tuple[str, str]] = [
    ("posting_id", K),
    ("extracted_on", "o_orderdate"),
    ("wage_raw", f"""CASE {K} % 11
        WHEN 0 THEN '$' || {_s(f'{K} % 40 + 15')} || '-' || {_s(f'{K} % 40 + 25')} || '/hr'
        WHEN 1 THEN '$' || {_s(f'{K} % 90 + 10')} || 'K/yr'
        WHEN 2 THEN '$' || {_s(f'{K} % 30 + 10')} || ' per hour'
        WHEN 3 THEN 'Unpaid'
        WHEN 4 THEN 'Paid'
        WHEN 5 THEN '$' || {_s(f'{K} % 900 + 300')} || '/wk'
        WHEN 6 THEN '$' || {_s(f'{K} % 5 + 2')} || '-' || {_s(f'{K} % 5 + 4')} || 'K/mo'
        WHEN 7 THEN '$' || {_s(f'{K} % 100 + 50')} || '/day'
        WHEN 8 THEN 'Paid, $' || {_s(f'{K} % 20 + 15')} || '/hr'
        WHEN 9 THEN '$' || {_s(f'{K} % 30 + 10')} || '.50/hr'
        ELSE NULL END"""),
    ("location_raw", f"""CASE {K} % 5
        WHEN 0 THEN 'OnsiteBased in ' || o_orderpriority
        WHEN 1 THEN 'RemoteBased in City' || {_s('o_custkey % 50')} || ', NY'
        WHEN 2 THEN 'Hybrid' || {_s(f'{K} % 7')} || 'Based in USAToday'
        WHEN 3 THEN 'Anywhere ' || o_orderstatus
        ELSE NULL END"""),
    ("employment_raw", f"""CASE {K} % 4
        WHEN 0 THEN 'Full-time'
        WHEN 1 THEN 'InternshipPart-time' || {_LIT_DASH} || 'Seasonal'
        WHEN 2 THEN 'Internship'
        ELSE NULL END"""),
    ("job_raw", f"""CASE {K} % 3
        WHEN 0 THEN 'On' || o_orderstatus || 'Campus' || {_LIT_BULLET} || 'Job'
        WHEN 1 THEN '  Co-opKProgram' || {_s(f'{K} % 9')} || 'K '
        ELSE NULL END"""),
    ("apply_raw", f"""CASE {K} % 3 WHEN 0 THEN ' Apply ' WHEN 1 THEN 'Apply externally' ELSE NULL END"""),
    ("position_raw", f"""CASE WHEN {K} % 6 = 5 THEN NULL
        ELSE '  Data ' || o_orderpriority || ' Engineer ' END"""),
    ("company_raw", f"""CASE WHEN {K} % 8 = 7 THEN NULL
        ELSE ' Acme ' || o_orderstatus || ' Co ' END"""),
    ("industry_raw", f"""CASE WHEN {K} % 9 = 8 THEN NULL
        ELSE ' Industry ' || {_s('o_custkey % 13')} || ' ' END"""),
    ("times_raw", f"""CASE WHEN {K} % 23 = 22 THEN NULL ELSE
        'Posted ' || CASE WHEN {K} % 17 = 16 THEN '30+' ELSE {_s(f'{K} % 30 + 1')} END || ' '
        || CASE {K} % 7 WHEN 0 THEN 'days' WHEN 1 THEN 'weeks' WHEN 2 THEN 'months'
                        WHEN 3 THEN 'hours' WHEN 4 THEN 'day' WHEN 5 THEN 'Weeks' ELSE 'years' END
        || ' ago' || {_LIT_BULLET} || 'Apply by ' || {_month_case(f'{K} % 12')} || ' '
        || {_s(f'{K} % 28 + 1')} || ', ' || {_s(f'2024 + {K} % 3')} || ' at '
        || {_s(f'{K} % 12 + 1')} || ':' || lpad({_s(f'{K} % 60')}, 2, '0') || ' '
        || CASE {K} % 2 WHEN 0 THEN 'am' ELSE 'PM' END END"""),
    ("doc1", f"CASE {K} % 4 WHEN 0 THEN ' Search your transcripts ' WHEN 1 THEN 'Search your class' "
             f"WHEN 2 THEN 'Upload resume' ELSE 'Search your s' END"),
    ("doc2", f"CASE {K} % 3 WHEN 0 THEN 'Search your cover letters' WHEN 1 THEN 'search your x' ELSE NULL END"),
]


def compose_sql_select() -> str:
    return ",\n  ".join(f"{expr} AS {name}" for name, expr in COMPOSE)


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw posting per ``orders`` row (Spark side)."""
    from pyspark.sql import functions as F

    from gleaner.session import spread

    df = spread(table(spark, sf_dir, "orders")).selectExpr(*[f"{e} AS {n}" for n, e in COMPOSE])
    return df.withColumn("documents_raw", F.filter(F.array("doc1", "doc2"), lambda d: d.isNotNull())) \
             .drop("doc1", "doc2")


# ---------------------------------------------------------------------------
# DuckDB (RE2, no look-behind) forms of the rules, used only by oracle SQL.
# Each takes a column name and returns an expression over that column.
# ---------------------------------------------------------------------------

def d_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def d_lower_strip(x: str) -> str:
    return d_strip(f"lower({x})")


def d_normalize(col: str) -> str:
    """C2 on column ``col`` (char-wise look-behind test)."""
    s = f"replace(replace({col}, {_LIT_DASH}, '-'), {_LIT_BULLET}, ' ')"
    c, p1, p12 = f"substr({s}, i, 1)", f"substr({s}, i - 1, 1)", f"substr({s}, i - 2, 2)"
    cond = (f"(i > 1 AND (({c} = 'K' AND NOT regexp_matches({p1}, '^[0-9A-Z\\s]$'))"
            f" OR (regexp_matches({c}, '^[A-JL-Z]$') AND NOT regexp_matches({p1}, '^[A-Z\\s]$'))))"
            f" OR (i > 2 AND regexp_matches({c}, '^[A-Z]$') AND regexp_matches({p12}, '^[A-Z][A-Z]$'))")
    body = (f"array_to_string(list_transform(range(1, length({s}) + 1), "
            f"lambda i: CASE WHEN {cond} THEN ' ' ELSE '' END || {c}), '')")
    return d_lower_strip(body)


def d_wage_cols(n: str) -> dict[str, str]:
    """C4 pieces over a normalized column ``n``: unit word, lo, hi, k."""
    first = f"regexp_extract({n}, '(/\\w+|per \\w+|unpaid|paid)', 1)"
    return {
        "w_unit": (f"CASE WHEN {first} = '' THEN NULL WHEN {first} LIKE '/%' THEN substr({first}, 2) "
                   f"WHEN {first} LIKE 'per %' THEN substr({first}, 5) ELSE {first} END"),
        "w_lo": f"TRY_CAST(nullif(regexp_extract({n}, '(\\d+)', 1), '') AS BIGINT)",
        "w_hi": f"TRY_CAST(nullif(regexp_extract({n}, '^\\D*\\d+\\D[^\\n]*?(\\d+)', 1), '') AS BIGINT)",
        "w_k": f"regexp_matches({n}, '\\dk')",
    }


def d_wage_scale() -> str:
    """Multiplier from columns w_unit / w_k (null for an unknown unit)."""
    k = "CASE WHEN w_k THEN 1000 ELSE 1 END"
    return (f"CASE WHEN w_unit IN ('hr','hour') AND w_k THEN 1000 "
            f"WHEN w_unit IN ('hr','hour') THEN 2080 "
            f"WHEN w_unit IN ('wk','week') THEN 52 * {k} "
            f"WHEN w_unit IN ('mo','month') THEN 12 * {k} "
            f"WHEN w_unit IN ('yr','year') THEN {k} END")


def oracle_base() -> str:
    """CTEs ``raw`` (composed fields) and ``nz`` (normalized + wage pieces)."""
    norm_cols = {"wage_n": "wage_raw", "loc_n": "location_raw", "emp_n": "employment_raw",
                 "job_n": "job_raw", "apply_n": "apply_raw"}
    norms = ",\n  ".join(f"{d_normalize(src)} AS {dst}" for dst, src in norm_cols.items())
    wage = ",\n  ".join(f"{e} AS {k}" for k, e in d_wage_cols("wage_n").items())
    times = f"replace(times_raw, {_LIT_BULLET}, ' ')"
    return (f"raw AS (SELECT {compose_sql_select()} FROM orders),\n"
            f"n0 AS (SELECT *, {norms}, {times} AS times_c FROM raw),\n"
            f"nz AS (SELECT *, {wage} FROM n0)")
