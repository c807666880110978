"""HTML -> records.

H1 (links/cards) and H5 (body) are native regex projections: comments,
script and style blocks are removed with ``regexp_replace``, tags are
exploded and attributes tokenised with ``regexp_extract_all`` — no Python worker, whole-stage codegen throughout.

H6 (the detail-page tree walks) and C9 (Markdown) need a real tree, so they
run as ONE ``mapInPandas`` pass per Arrow batch using
``gleaner.functions.dom``; filters and column pruning are applied before the
pass (they do not push through it).
"""

from __future__ import annotations

from collections.abc import Iterator
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.functions.dom import detail_fields as _walk
from gleaner.functions.dom import to_markdown as _to_markdown

_NOISE = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
# One attribute of a start tag: a quoted value is consumed whole, so what it holds is never read as markup.
_ATTRIBUTE = r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?"""
_ENTITY = r"&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[a-zA-Z][a-zA-Z0-9]*;"
#: Named character references of HTML 4, from the standard library.
_NAMED = {f"&{name};": chr(code) for name, code in name2codepoint.items()} | {"&apos;": "'"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_noise(html) -> Column:
    """Remove comments, script and style blocks."""
    return F.regexp_replace(_c(html), _NOISE, "")


def _decoded(entity: Column) -> Column:
    """The character of one reference, or the reference itself if there is none."""
    number = F.coalesce(
        F.conv(F.nullif(F.regexp_extract(entity, r"^&#[xX]([0-9a-fA-F]+);$", 1), F.lit("")), 16, 10).cast("bigint"),
        F.nullif(F.regexp_extract(entity, r"^&#([0-9]+);$", 1), F.lit("")).cast("bigint"))
    valid = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, number)), 8, "0")), "UTF-32")
    names = F.create_map(*[F.lit(x) for pair in _NAMED.items() for x in pair])
    return F.coalesce(char, F.try_element_at(names, entity), entity)


def unescape_attr(x: Column) -> Column:
    """Decode character references once: those of '&' last, so what they uncover stays as it is."""
    found = F.transform(F.array_distinct(F.regexp_extract_all(x, F.lit(_ENTITY), F.lit(0))),
                        lambda e: F.struct(e.alias("written"), _decoded(e).alias("char")))
    ordered = F.concat(F.filter(found, lambda p: p["char"] != "&"), F.filter(found, lambda p: p["char"] == "&"))
    return F.when(~x.contains("&"), x).otherwise(
        F.aggregate(ordered, x, lambda acc, p: F.replace(acc, p["written"], p["char"])))


def attributes(tag_text) -> tuple[Column, Column]:
    """(lower-cased names, raw values) of a start tag's attributes."""
    body = F.regexp_replace(_c(tag_text), r"^<\s*[^\s/>]+", "")
    part = lambda i: F.regexp_extract_all(body, F.lit(_ATTRIBUTE), F.lit(i))
    # a value is in one of three groups, the others are empty
    either = lambda x, y: F.concat(x, y)
    values = F.zip_with(F.zip_with(part(2), part(3), either), part(4), either)
    return F.transform(part(1), F.lower), values


def attr_of(names: Column, values: Column, name: str) -> Column:
    at = F.array_position(names, F.lit(name.lower())).cast("int")
    return F.when(at > 0, F.element_at(values, at))


def attr(tag_text, name: str) -> Column:
    """Value of attribute ``name`` in a start-tag text (null when absent, first wins)."""
    return unescape_attr(attr_of(*attributes(tag_text), name))


def extract_links(df: DataFrame, html: str = "html", tag: str = "a", where: dict[str, str] | None = None,
                  attrs: tuple[str, ...] = ("href",), within: str | None = None,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """H1: one row per ``<tag>`` start tag (optionally only inside the first
    ``<within>`` element and only with attribute values equal to ``where``).

    Output: ``*keep, link_idx, <attrs...>``. For the card list of the list
    page: ``extract_links(df, within='main', where={'role': 'button'},
    attrs=('href', 'aria-label'))``. A tag's attributes are matched once, and
    character references are decoded only in values that hold an ``&``.
    """
    body = strip_noise(html)
    if within:
        body = F.regexp_extract(body, rf"(?is)<{within}\b[^>]*>(.*?)(?:</{within}\s*>|$)", 1)
    tags = F.regexp_extract_all(body, F.lit(rf"""(?is)<{tag}\b(?:"[^"]*"|'[^']*'|[^'">])*>"""), F.lit(0))
    ex = df.select(*keep, F.posexplode(tags).alias("link_idx", "_tag"))
    names, values = attributes("_tag")
    wanted = list(dict.fromkeys([*(where or {}), *attrs]))
    found = ex.select(*keep, "link_idx", names.alias("_names"), values.alias("_values"))
    # explode of one struct: a row boundary that keeps the arrays from being matched again for each attribute
    raw = found.select(*keep, "link_idx", F.explode(F.array(F.struct(
        *[attr_of(F.col("_names"), F.col("_values"), a).alias(a) for a in wanted]))).alias("_raw"))
    value = {a: unescape_attr(F.col("_raw").getField(a)) for a in wanted}
    for k, v in (where or {}).items():
        raw = raw.filter(value[k] == F.lit(v))
    return raw.select(*keep, F.col("link_idx").cast("bigint"), *[value[a].alias(a.replace("-", "_")) for a in attrs])


def main_html(html) -> Column:
    """H5: inner HTML of the first ``<body>`` up to ``</body>`` or the end of
    the document; null when there is no body tag."""
    h = _c(html)
    pat = r"(?is)<body\b[^>]*>(.*?)(?:</body\s*>|$)"
    return F.when(h.rlike(r"(?is)<body\b"), F.regexp_extract(h, pat, 1))


# -- H6 + C9: one Arrow pass ------------------------------------------------------

DETAIL_SCHEMA = T.StructType([
    T.StructField("wage_raw", T.StringType()), T.StructField("location_raw", T.StringType()),
    T.StructField("employment_raw", T.StringType()), T.StructField("job_raw", T.StringType()),
    T.StructField("about_raw", T.StringType()), T.StructField("about_md", T.StringType()),
    T.StructField("apply_raw", T.StringType()), T.StructField("position_raw", T.StringType()),
    T.StructField("times_raw", T.StringType()), T.StructField("company_raw", T.StringType()),
    T.StructField("industry_raw", T.StringType()),
    T.StructField("documents_raw", T.ArrayType(T.StringType())),
])
_OUT = {"wage": "wage_raw", "location": "location_raw", "employment_type": "employment_raw",
        "job_type": "job_raw", "about": "about_raw", "apply_type": "apply_raw", "position": "position_raw",
        "times": "times_raw", "company": "company_raw", "industry": "industry_raw",
        "documents": "documents_raw"}


PAGES = 128      # walked and returned at once, whatever the size of the Arrow batches


def detail_fields(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """H6 + C9: raw detail fields (and the about section as Markdown) for each
    page, in one Python pass over Arrow batches."""
    src = df.select(*keep, F.col(html).alias("_html"))
    in_fields = [f for f in src.schema.fields if f.name != "_html"]
    schema = T.StructType(in_fields + DETAIL_SCHEMA.fields)
    keep_names = [f.name for f in in_fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in (big.iloc[at:at + PAGES] for big in batches for at in range(0, len(big), PAGES)):
            rows = [_walk(h) for h in pdf["_html"].tolist()]
            out = pd.DataFrame({k: pdf[k].values for k in keep_names})
            for src_name, dst in _OUT.items():
                out[dst] = [r[src_name] for r in rows]
            out["about_md"] = [_to_markdown(r["about"]) for r in rows]
            yield out[[f.name for f in schema.fields]]

    return src.mapInPandas(run, schema)
