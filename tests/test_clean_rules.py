"""Golden values for the cleaning rules (read off the reference's rules)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gleaner.functions import clean as C
from gleaner.functions import text as T
from gleaner.operators.chunk import chunk_text


def one(spark, col, value, schema="s string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("$25-30/hr", [52000, 62400]),
    ("$20/hr", [41600, 41600]),
    ("$20 per hour", [41600, 41600]),
    ("$50-60K/yr", [50000, 60000]),
    ("$60K/hr", [60000, 60000]),
    ("Unpaid", [0, 0]),
    ("Paid", None),
    ("Paid, $20/hr", None),
    ("$25.50/hr", [52000, 104000]),
    ("$50,000/yr", [50, 0]),
    ("$100/day", None),
    (None, None),
    ("$3-4K/mo", [36000, 48000]),
    ("$700/wk", [36400, 36400]),
])
def test_wage(spark, raw, expected):
    assert one(spark, C.wage(F.col("s")), raw) == expected


def test_wage_numeric_option(spark):
    assert one(spark, C.wage(F.col("s"), numeric_wages=True), "$50,000/yr") == [50000, 50000]


@pytest.mark.parametrize("raw,expected", [
    ("OnsiteBased in New York, NY", "onsite based in new york, ny"),
    ("50K", "50k"),
    ("USAToday", "us a today"),
    ("  Full-time\\xe2\\x80\\x93Internship ", "full-time- internship"),
    ("a\\xe2\\x88\\x99b", "a b"),
])
def test_normalize(spark, raw, expected):
    assert one(spark, T.normalize(F.col("s")), raw) == expected


def test_location_rules(spark):
    assert one(spark, C.location(F.col("s")), "OnsiteBased in New York, NY") == "new york, ny"
    assert one(spark, C.location_type(F.col("s")), "OnsiteBased in New York, NY") == ["onsite"]
    assert one(spark, C.location_type(F.col("s")), None) == []
    assert one(spark, C.location_type(F.col("s")), "Anywhere") is None
    assert one(spark, C.location(F.col("s")), "Anywhere") is None


def test_employment_job_apply(spark):
    assert one(spark, C.employment_type(F.col("s")), "Full-time job") == "full-time"
    assert one(spark, C.employment_type(F.col("s")), "Internship") is None
    assert one(spark, C.apply_type(F.col("s")), " Apply ") == "internal"
    assert one(spark, C.apply_type(F.col("s")), "Apply externally") == "external"
    assert one(spark, C.company(F.col("s")), "  Acme Co \n") == "Acme Co"
    assert one(spark, C.industry(F.col("s")), "  Big Tech ") == "big tech"


@pytest.mark.parametrize("times,expected", [
    ("Posted 3 days ago", dt.datetime(2025, 3, 28, 10, 0)),
    ("posted 2 weeks ago", dt.datetime(2025, 3, 17, 10, 0)),
    ("Posted 1 month ago", dt.datetime(2025, 2, 28, 10, 0)),
    ("Posted 30+ days ago", None),
    ("Posted 2 Weeks ago", None),
    ("Posted 5 hours ago\\xe2\\x88\\x99Apply by March 5, 2025 at 11:59 pm", dt.datetime(2025, 3, 31, 5, 0)),
])
def test_posted_at(spark, times, expected):
    col = C.posted_at(F.col("s"), F.lit(dt.datetime(2025, 3, 31, 10, 0)).cast("timestamp_ntz"))
    assert one(spark, col, times) == expected


@pytest.mark.parametrize("times,expected", [
    ("Posted 5 hours ago\\xe2\\x88\\x99Apply by March 5, 2025 at 11:59 pm", dt.datetime(2025, 3, 5, 23, 59)),
    ("apply by JANUARY 1, 2025 at 11:05 AM", dt.datetime(2025, 1, 1, 11, 5)),
    ("Apply by Mar 5, 2025 at 11:59 pm", None),
    ("nothing here", None),
])
def test_apply_by(spark, times, expected):
    assert one(spark, C.apply_by(F.col("s")), times) == expected


def test_documents(spark):
    got = one(spark, C.documents(F.col("s")),
              [" Search your transcripts", "Search your class", "Upload resume", "search your x"],
              "s array<string>")
    assert got == ["transcript", "cla"]


def test_card_rules(spark):
    assert one(spark, C.job_id(F.col("s")), "/job-search/12345?x=1") == 12345
    assert one(spark, C.job_id(F.col("s")), "/jobs/1") is None
    assert one(spark, C.clean_role(F.col("s")), "View Data Engineer") == "Data Engineer"
    assert one(spark, C.clean_role(F.col("s")), "Data Engineer") is None
    assert one(spark, C.canonical_url(F.lit(7)), "x") == "https://postings.example/jobs/7"


def test_chunk_docstring_example(spark):
    df = spark.createDataFrame([(1, "abcdefghij"), (2, "abc")], "doc_id long, text string")
    rows = chunk_text(df, size=4, overlap=0.25).orderBy("doc_id", "chunk_idx").collect()
    assert [r.chunk_txt for r in rows] == ["abcd", "defg", "ghij"]
    tail = chunk_text(df, size=4, overlap=0.25, keep_tail=True).orderBy("doc_id", "chunk_idx").collect()
    assert [r.chunk_txt for r in tail] == ["abcd", "defg", "ghij", "j", "abc"]


def test_chunk_validation():
    from gleaner.operators.chunk import chunk_step
    with pytest.raises(ValueError):
        chunk_step(0, 0.2)
    with pytest.raises(ValueError):
        chunk_step(10, 1.5)
    assert chunk_step(512, 0.2) == 409
