import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeats, odd characters, clashing extra columns."""
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "an id that is null here", "en", "s", 3),
            (3, " \t\n\x0b\x0c\r ", "en", "s", 1), (4, "word " * 60_000, "en", "s", 2),
            (5, "The same words, twice over: the cat sat on the mat near the door.", "en", "s", 1),
            (5, "The same words, twice over: the cat sat on the mat near the door.", "en", "s", 1),
            (6, "the SAME words, twice over: the cat sat on the mat near the door.", None, None, 1),
            (7, "x" * 5000, "en", "s", 1), (8, "a b\x1cc\x85d e  été \U0001f600 你好 123 <|endoftext|> it's we'LL\n\n x  <|endoftext|>", "en", "s", 1),
            (9, "line one is here\nline one is here\n\n\nother | $5 <b> & #1 *\n", "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("shard", "rank", "part", "size", "tie", "n_tokens", "ids", "fingerprint", "component_id", "score", "fold",
              "words", "start", "total", "key", "chunk", "n_words", "kept", "rid", "count"):
        df = df.withColumn(c, F.lit(f"clash {c}"))
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df, *cols):
    """doc_id and text of the frame as Python rows, null texts as ''."""
    return [(r.doc_id, r.text or "", *(r[c] for c in cols)) for r in df.select("doc_id", "text", *cols).collect()]
