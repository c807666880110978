"""Posting field cleaning rules (C3-C16) as native Column expressions.

Each rule returns null where the reference raises (unknown wage unit, missing
posted/apply-by pattern); ``error_codes`` names the failing rule so the
operator in ``gleaner.operators.postings`` can route the row to quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import (LITERAL_BULLET, _c, first_match, let, lower_strip, normalize,
                                    strip)

# Fixed values from the reference's rules.
HOURS_PER_YEAR = 40 * 52
WEEKS_PER_YEAR = 52
MONTHS_PER_YEAR = 12
UNIT_PATTERN = r"(?U)(?<=/)(\w+)|(?<=per )(\w+)|(paid)|(unpaid)"
WAGE_PATTERN = r"(?dU).*?(\d+)(?:[^\d].*?(\d+))?"
K_PATTERN = r"(?U)(?<=\d)(k)"
LOCATION_PATTERN = r"(?dU)(?<=based in )(.*)$"
LOCATION_TYPE_PATTERN = r"(onsite|remote|hybrid)"
EMPLOYMENT_PATTERN = r"(?U)\w+-time"
POSTED_PATTERN = r"(?iuU)(?<=posted )(\d+) (\w+)(?<!s)"
APPLY_PATTERN = r"(?iuU)(?<=apply by )(\w+) (\d+), (\d+) at (\d+:\d+) (am|pm)"
DOCUMENT_PATTERN = r"(?dU)(?<=Search your\s)(?:.*[^s]|)"
# Units accepted by the date subtraction (the reference appends "s" and
# passes the word as a keyword, so only these lower-case words work).
POSTED_UNITS = ("year", "month", "week", "day", "hour", "minute", "second", "microsecond")


def annual_wage(unit, k, lo, hi=None) -> Column:
    """Scale a (lo, hi) pair to a yearly amount; null for an unknown unit.

    hour/hr with ``k`` is read as an annual figure in thousands.
    """
    unit, k, lo = _c(unit), _c(k), _c(lo)
    hi = lo if hi is None else F.coalesce(_c(hi), lo)
    thousand = F.when(k, F.lit(1000)).otherwise(F.lit(1)).cast("bigint")
    hourly = unit.isin("hr", "hour")
    per_year = (F.when(hourly & k, F.lit(1))
                .when(hourly, F.lit(HOURS_PER_YEAR))
                .when(unit.isin("wk", "week"), F.lit(WEEKS_PER_YEAR))
                .when(unit.isin("mo", "month"), F.lit(MONTHS_PER_YEAR))
                .when(unit.isin("yr", "year"), F.lit(1))).cast("bigint")
    scale = F.when(hourly & ~k, per_year).otherwise(F.try_multiply(per_year, thousand))
    return F.when(per_year.isNotNull() & lo.isNotNull(),
                  F.array(F.try_multiply(lo, scale), F.try_multiply(hi, scale)))


def wage_parts_of_normalized(n) -> dict[str, Column]:
    """Pieces of C4 on an already normalized text: unit, k flag, lo, hi."""
    n = _c(n)
    return {
        "unit": first_match(n, UNIT_PATTERN),
        "k": n.rlike(K_PATTERN),
        "lo": F.nullif(F.regexp_extract(n, WAGE_PATTERN, 1), F.lit("")).try_cast("bigint"),
        "hi": F.nullif(F.regexp_extract(n, WAGE_PATTERN, 2), F.lit("")).try_cast("bigint"),
    }


def wage_from_parts(raw, unit, k, lo, hi) -> Column:
    """C4 from precomputed parts (``raw`` only decides null input)."""
    raw, unit = _c(raw), _c(unit)
    return (F.when(raw.isNull(), F.lit(None))
            .when(unit == "unpaid", F.array(F.lit(0).cast("bigint"), F.lit(0).cast("bigint")))
            .when(unit == "paid", F.lit(None))
            .otherwise(annual_wage(unit, k, lo, hi)))


def wage_error_from_parts(raw, unit, wage_col) -> Column:
    """True when the reference would raise (unknown unit / no number)."""
    raw, unit = _c(raw), _c(unit)
    known = F.coalesce(unit.isin("paid", "unpaid"), F.lit(False))
    return raw.isNotNull() & ~known & _c(wage_col).isNull()


def _numeric(raw: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(raw, r"(?<=\d),(?=\d{3})", ""), r"(?<=\d)\.\d+", "")


def wage(x, numeric_wages: bool = False) -> Column:
    """C4: raw wage text -> [lo, hi] yearly amounts.

    ``unpaid`` -> [0, 0]; ``paid`` -> null; otherwise C3 on the first two
    digit runs (null when the unit is unknown or there is no number).
    ``numeric_wages=True`` first drops thousands separators and decimals so
    ``$50,000/yr`` and ``$25.50/hr`` read as single numbers.
    """
    raw = _c(x)
    if numeric_wages:
        raw = _numeric(raw)

    def on_parts(p):
        return wage_from_parts(raw, p["unit"], p["k"], p["lo"], p["hi"])

    return let(normalize(raw), lambda n: let(F.struct(*[v.alias(k) for k, v in
                                                       wage_parts_of_normalized(n).items()]), on_parts))


def wage_error(x) -> Column:
    """True when C4 would raise in the reference (unknown unit / no digits)."""
    raw = _c(x)
    return let(normalize(raw), lambda n: let(
        F.struct(first_match(n, UNIT_PATTERN).alias("unit"), wage(raw).alias("w")),
        lambda p: wage_error_from_parts(raw, p["unit"], p["w"])))


def location(x) -> Column:
    """Text after ``based in `` to the end, on normalized input."""
    return let(normalize(_c(x)), lambda n: first_match(n, LOCATION_PATTERN))


def location_type(x) -> Column:
    """[] for null input, [first keyword], or null when none appears."""
    raw = _c(x)
    return let(normalize(raw), lambda n: location_type_from_normalized(raw, n))


def location_type_from_normalized(raw, n) -> Column:
    kw = first_match(n, LOCATION_TYPE_PATTERN)
    return (F.when(_c(raw).isNull(), F.array().cast("array<string>"))
            .when(kw.isNotNull(), F.array(kw)))


def employment_type(x) -> Column:
    """First ``word-time`` token of the normalized text."""
    return let(normalize(_c(x)), lambda n: first_match(n, EMPLOYMENT_PATTERN))


def job_type(x) -> Column:
    """C8."""
    return normalize(_c(x))


def apply_type(x) -> Column:
    """``internal`` when the button reads exactly ``apply``."""
    return apply_type_from_normalized(x, normalize(_c(x)))


def apply_type_from_normalized(raw, n) -> Column:
    return F.when(_c(raw).isNotNull(),
                  F.when(_c(n) == "apply", F.lit("internal")).otherwise(F.lit("external")))


def position(x) -> Column:
    """C11."""
    return lower_strip(x)


def company(x) -> Column:
    """C14: strip, case kept."""
    return strip(x)


def industry(x) -> Column:
    """C15."""
    return lower_strip(x)


def _times(x) -> Column:
    return F.replace(_c(x), F.lit(LITERAL_BULLET), F.lit(" "))


def posted_parts(times_clean) -> dict[str, Column]:
    """(N, unit) of ``posted N unit(s)`` on bullet-cleaned text."""
    t = _c(times_clean)
    return {"n": F.nullif(F.regexp_extract(t, POSTED_PATTERN, 1), F.lit("")).try_cast("int"),
            "unit": F.nullif(F.regexp_extract(t, POSTED_PATTERN, 2), F.lit(""))}


#: Largest N of each unit; more would leave the calendar (years before 1).
POSTED_MOST = {"year": 2000, "month": 24_000, "week": 104_000, "day": 730_000, "hour": 17_520_000,
               "minute": 1_051_200_000, "second": 2**31 - 1, "microsecond": 2**31 - 1}


def posted_in_range(n, unit) -> Column:
    """Whether N units back is a date of the calendar (null unit or N: true)."""
    n, unit = _c(n), _c(unit)
    most = F.coalesce(*[F.when(unit == u, F.lit(m)) for u, m in POSTED_MOST.items()])
    return F.coalesce(n <= most, F.lit(True))


def posted_from_parts(n, unit, extracted_on) -> Column:
    """extracted_on minus N units (month/year arithmetic clips to month end);
    null when N leaves the calendar, so no row can end the job."""
    n, unit = _c(n), _c(unit)
    n = F.when(posted_in_range(n, unit), n)
    zero = F.lit(0)
    secs = F.lit(0).cast("decimal(18,6)")

    def iv(years=zero, months=zero, weeks=zero, days=zero, hours=zero, mins=zero, s=secs):
        return F.make_interval(years, months, weeks, days, hours, mins, s)

    interval = (F.when(unit == "year", iv(years=n))
                .when(unit == "month", iv(months=n))
                .when(unit == "week", iv(weeks=n))
                .when(unit == "day", iv(days=n))
                .when(unit == "hour", iv(hours=n))
                .when(unit == "minute", iv(mins=n))
                .when(unit == "second", iv(s=n.cast("decimal(18,6)")))
                .when(unit == "microsecond", iv(s=(n / F.lit(1000000)).cast("decimal(18,6)"))))
    return (_c(extracted_on).cast("timestamp_ntz") - interval).cast("timestamp_ntz")


def posted_at(times, extracted_on) -> Column:
    """extracted_on minus ``posted N unit(s)``; month/year clip to month end.

    Null when the pattern is missing or the unit is not one the reference's
    date arithmetic accepts (``POSTED_UNITS``, lower case).
    """
    p = posted_parts(_times(times))
    return let(F.struct(p["n"].alias("n"), p["unit"].alias("unit")),
               lambda s: posted_from_parts(s["n"], s["unit"], extracted_on))


def apply_by(times) -> Column:
    """``apply by Month D, YYYY at H:MM am|pm`` -> timestamp (no zone).

    Parsed with separators, so days 1-2 with hours 11-12 read correctly; an
    abbreviated month name gives null, as in the reference.
    """
    return apply_by_clean(_times(times))


def apply_by_clean(times_clean) -> Column:
    t = _c(times_clean)
    g = [F.regexp_extract(t, APPLY_PATTERN, i) for i in range(1, 6)]
    text = F.concat_ws(" ", F.initcap(g[0]), g[1], g[2], g[3], F.upper(g[4]))
    ts = F.try_to_timestamp(text, F.lit("MMMM d yyyy h:mm a"))
    return F.when(t.rlike(APPLY_PATTERN), ts.cast("timestamp_ntz"))


def documents(x) -> Column:
    """Keep elements matching ``Search your <doc>`` and return <doc>
    with all trailing ``s`` removed; others are dropped."""
    stripped = F.transform(F.coalesce(_c(x), F.array().cast("array<string>")), strip)
    kept = F.filter(stripped, lambda d: d.rlike(DOCUMENT_PATTERN))
    return F.transform(kept, lambda d: F.regexp_extract(d, DOCUMENT_PATTERN, 0))


def error_codes(wage_raw, times_raw) -> Column:
    """Rule names that would raise in the reference, as array<string>."""
    t = _times(times_raw)
    pp = posted_parts(t)
    return let(F.struct(wage_error(wage_raw).alias("w"), t.alias("t"), pp["n"].alias("n"),
                        pp["unit"].alias("u")),
               lambda s: rule_errors(s["w"], s["t"], s["n"], s["u"], apply_by_clean(s["t"])))


def rule_errors(wage_err, times_clean, posted_n, posted_unit, apply_by_col) -> Column:
    """Error names from precomputed pieces (see ``error_codes``)."""
    t = _c(times_clean)
    has_posted = t.rlike(POSTED_PATTERN)
    errs = [
        F.when(_c(wage_err), F.lit("C4_wage")),
        F.when(t.isNotNull() & ~has_posted, F.lit("C12_posted_missing")),
        F.when(has_posted & (~F.coalesce(_c(posted_unit).isin(*POSTED_UNITS), F.lit(False))
                             | _c(posted_n).isNull()), F.lit("C12_posted_unit")),
        F.when(has_posted & ~posted_in_range(posted_n, posted_unit), F.lit("C12_posted_range")),
        F.when(t.isNotNull() & _c(apply_by_col).isNull(), F.lit("C13_apply_by")),
    ]
    return F.filter(F.array(*errs), lambda e: e.isNotNull())


# -- H2-H4: card url rules -------------------------------------------------

JOB_ID_PATTERN = r"(?<=job-search/)\d+"
ROLE_PATTERN = r"(?dU)(?<=View\s).*"
# The posting host is deployment configuration; only the "/jobs/<id>" shape
# is part of the rule.
DEFAULT_URL_TEMPLATE = "https://postings.example/jobs/%d"


def job_id(url) -> Column:
    """H2: digits right after the first ``job-search/``; null if absent."""
    return first_match(_c(url), JOB_ID_PATTERN).try_cast("bigint")


def clean_role(raw) -> Column:
    """H3: text after ``View`` + one whitespace, to the end of the line."""
    return first_match(_c(raw), ROLE_PATTERN)


def canonical_url(jid, template: str = DEFAULT_URL_TEMPLATE) -> Column:
    """H4: ``<host>/jobs/<job_id>``."""
    return F.format_string(template, _c(jid))
