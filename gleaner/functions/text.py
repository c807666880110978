"""String rules shared by the cleaning and extraction operators.

Every function maps Column -> Column and stays a native Catalyst expression
(regexp_replace / regexp_extract / rlike), so it runs inside whole-stage
codegen with no Python worker.

Regex parity notes (Python ``re`` -> Java ``java.util.regex``):
  * ``(?U)`` makes ``\\s``, ``\\w`` and ``\\d`` Unicode-aware, as they are
    for Python str patterns.
  * ``(?d)`` (UNIX_LINES) makes ``.`` and ``$`` treat only ``\\n`` as a line
    end, as Python does.
  * Python ``str.strip()`` also strips the separators ``\\x1c``-``\\x1f``,
    which Java's ``\\s`` does not contain.
  * ``regexp_extract`` returns ``''`` on no match; rules that need "no match"
    use ``rlike`` or ``nullif``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
# The dash and bullet are matched as their 12-character escaped *text*
# (a bytes repr leaking into a str), not as the characters themselves.
LITERAL_DASH = "\\xe2\\x80\\x93"
LITERAL_BULLET = "\\xe2\\x88\\x99"
# Insert a space before a mid-string capital: any capital except K not
# preceded by whitespace or a capital; a K not preceded by a digit, capital
# or whitespace; any capital preceded by two capitals.
SPLIT_CAPITALS = r"((?<!^)(?:(?<!\d|[A-Z]|\s)K|(?<!\s|[A-Z])[A-JL-Z])|(?<=[A-Z][A-Z])[A-Z])"

_WS = r"[\s\x1c-\x1f]"
_STRIP = rf"(?U)^{_WS}+|{_WS}+$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_c(x), _STRIP, "")


def lower_strip(x) -> Column:
    """Lower-case then strip."""
    return strip(F.lower(_c(x)))


def normalize(x, literal_only: bool = False) -> Column:
    """dash/bullet fix-up, split glued words at capitals, lower+strip.

    ``literal_only=True`` reproduces the reference exactly (only the escaped
    text forms are mapped); the default also maps the real U+2013 dash and
    U+2219 bullet characters.
    """
    s = F.replace(_c(x), F.lit(LITERAL_DASH), F.lit("-"))
    s = F.replace(s, F.lit(LITERAL_BULLET), F.lit(" "))
    if not literal_only:
        s = F.replace(s, F.lit("–"), F.lit("-"))
        s = F.replace(s, F.lit("∙"), F.lit(" "))
    s = F.regexp_replace(s, "(?U)" + SPLIT_CAPITALS, " $1")
    return lower_strip(s)


def let(value, fn) -> Column:
    """Bind ``value`` once and use it several times in ``fn(value)``.

    Catalyst cannot share a sub-expression across CASE branches, so a rule
    that reads an expensive value (a look-behind regex) in many branches would
    evaluate it once per reference; the one-element array binds it once.
    """
    return F.transform(F.array(_c(value)), fn)[0]


def first_match(x, pattern: str) -> Column:
    """Whole text of the leftmost match, or null when there is none."""
    x = _c(x)
    return F.when(x.rlike(pattern), F.regexp_extract(x, pattern, 0))
