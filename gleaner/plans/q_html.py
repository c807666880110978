"""Queries for H1-H6 and C9 (HTML extraction)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.functions import clean as C
from gleaner.operators import html as H
from gleaner.plans.catalog import register
from gleaner.plans.html_fixture import _EXPECTED, K, POSTING_HTML
from gleaner.plans.tables import table
from gleaner.session import spread

_D_NOISE = "'<!--.*?-->|<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>'"
_D_ATTR = "'\\shref\\s*=\\s*(?:\"([^\"]*)\"|''([^'']*)''|([^\\s\"''>]+))'"


def _d_href(tag: str) -> str:
    g = [f"nullif(regexp_extract({tag}, {_D_ATTR}, {i}, 'is'), '')" for i in (1, 2, 3)]
    v = f"coalesce({', '.join(g)}, '')"
    for ent, ch in (("&quot;", '"'), ("&#39;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        v = f"replace({v}, '{ent}', '{ch}')"
    return f"CASE WHEN regexp_matches({tag}, {_D_ATTR}, 'is') THEN {v} END"


@register("H1_extract_links", f"""
SELECT page_id, CAST(link_idx AS BIGINT) AS link_idx, {_d_href('tag')} AS href FROM (
  SELECT page_id, unnest(range(len(tags))) AS link_idx, unnest(tags) AS tag FROM (
    SELECT page_id, regexp_extract_all(regexp_replace(html, {_D_NOISE}, '', 'gis'), '(?is)<a\\b[^>]*>') AS tags
    FROM pages))""")
def q_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return H.extract_links(pages, "html", "a", attrs=("href",), keep=("page_id",))


@register("H5_main_html", """
SELECT page_id, md5(b) AS body_md5, CAST(length(b) AS BIGINT) AS body_chars FROM (
  SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<body\\b')
         THEN regexp_extract(html, '(?is)<body\\b[^>]*>(.*?)(?:</body\\s*>|$)', 1) END AS b FROM pages)""")
def q_body(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    b = H.main_html("html")
    return pages.select("page_id", F.md5(b).alias("body_md5"), F.char_length(b).cast("bigint").alias("body_chars"))


# -- H2-H4 on card urls / labels composed from orders -------------------------------

_CARD = {
    "card_url": """CASE o_orderkey % 4
        WHEN 0 THEN '/job-search/' || CAST(o_orderkey AS STRING) || '?page=1'
        WHEN 1 THEN 'https://x.example/job-search/' || CAST(o_orderkey AS STRING) || '/job-search/7'
        WHEN 2 THEN '/jobs/' || CAST(o_orderkey AS STRING)
        ELSE '/job-search/abc' END""",
    "card_label": """CASE o_orderkey % 3
        WHEN 0 THEN 'View ' || o_orderpriority || ' analyst'
        WHEN 1 THEN 'Viewer ' || o_orderstatus
        ELSE 'View ' || o_orderstatus || chr(10) || 'second line' END""",
}


@register("H2_H3_H4_card_rules", f"""
SELECT posting_id, job_id, role,
       CASE WHEN job_id IS NOT NULL THEN 'https://postings.example/jobs/' || CAST(job_id AS VARCHAR) END AS url
FROM (SELECT o_orderkey AS posting_id,
        TRY_CAST(nullif(regexp_extract({_CARD['card_url']}, 'job-search/(\\d+)', 1), '') AS BIGINT) AS job_id,
        CASE WHEN regexp_matches({_CARD['card_label']}, 'View\\s')
             THEN regexp_extract({_CARD['card_label']}, 'View\\s([^\\n]*)', 1) END AS role
      FROM orders)""")
def q_card_rules(spark, sf_dir):
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS posting_id",
                                                 *[f"{v} AS {k}" for k, v in _CARD.items()])
    jid = C.job_id("card_url")
    return o.select("posting_id", jid.alias("job_id"), C.clean_role("card_label").alias("role"),
                    F.when(jid.isNotNull(), C.canonical_url(jid)).alias("url"))


# -- H6 + C9 on posting pages composed from part --------------------------------------

def posting_pages(spark, sf_dir):
    return spread(table(spark, sf_dir, "part")).selectExpr(f"{K} AS posting_id", f"{POSTING_HTML} AS html")


@register("H6_C9_detail_fields", "SELECT p_partkey AS posting_id, " +
          ", ".join(f"{v} AS {k}" for k, v in _EXPECTED.items()) + " FROM part")
def q_detail(spark, sf_dir):
    d = H.detail_fields(posting_pages(spark, sf_dir), "html", keep=("posting_id",))
    return d.select("posting_id", *[k for k in _EXPECTED if k != "documents_raw"],
                    F.array_join("documents_raw", "|").alias("documents_raw"))
