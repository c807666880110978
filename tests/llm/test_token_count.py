import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleaner.llm import token_count
from gleaner.llm.token_count import count_tokens, q_token_counts
from tests.llm.conftest import SF, pairs

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def want(df, limit=512):
    out = []
    for i, t in pairs(df):
        n = len(LIBRARY.encode(t, add_special_tokens=False))
        out.append(str((i, len(t.encode()), n, n > limit)))
    return sorted(out)


def got(df, **how):
    return sorted(str(tuple(r)) for r in count_tokens(df, PATH, **how).collect())


def test_chunks_of_any_size_equal_the_library(documents):
    expected = want(documents)
    for chunk, overlap in ((1 << 16, 256), (1000, 200), (300, 80)):
        assert got(documents, chunk=chunk, overlap=overlap) == expected


def test_hard_texts(spark):
    hard = ["a" * 3000 + " b", "<|endoftext|>" * 200, "x <|endof" * 150 + "<|endoftext|>  <|endoftext|> \n\n y" * 60,
            " " * 2500 + "end", "it's we're they'll " * 200, "\n \t\n  word\n\n\n" * 200, "été 你好\U0001f600 " * 300,
            "1234567890" * 300, "!?!" * 900 + "a" * 1200 + " tail " * 100]
    df = spark.createDataFrame(list(enumerate(hard)), "doc_id bigint, text string")
    assert got(df, chunk=300, overlap=80) == want(df)
    assert got(df.unionByName(df), chunk=400, overlap=120) == want(df.unionByName(df))


def test_overlaps_are_widened(spark, monkeypatch):
    seen, cut = [], token_count.cut
    monkeypatch.setattr(token_count, "cut", lambda t, c, o: seen.append((c, o)) or cut(t, c, o))
    df = spark.createDataFrame([(1, "b" * 2000), (2, "plain words " * 200)], "doc_id bigint, text string")
    assert got(df, chunk=300, overlap=80) == want(df)
    assert seen == [(300, 80), (4800, 1280)]


def test_odd_rows(odd, nothing):
    assert got(odd) == want(odd)
    assert got(odd, chunk=200, overlap=70) == want(odd)
    assert got(nothing) == []


def test_arguments(documents):
    with pytest.raises(ValueError):
        count_tokens(documents, PATH, chunk=100, overlap=80)


def test_query(spark, documents):
    rows = q_token_counts(spark, SF).agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows")).first()
    texts = [t for _, t in pairs(documents)]
    assert (rows.n, rows.rows) == (sum(len(LIBRARY.encode(t, add_special_tokens=False)) for t in texts), len(texts))
