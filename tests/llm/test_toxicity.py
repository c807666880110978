import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import toxicity as T
from tests.llm.conftest import pairs


def kernel(x, z):
    """Shared triples by enumeration, weighted by the spans in both strings."""
    total = 0.0
    for a in combinations(range(len(x)), 3):
        for b in combinations(range(len(z)), 3):
            if all(x[i] == z[j] for i, j in zip(a, b)):
                total += T.DECAY ** (a[2] - a[0] + 1 + b[2] - b[0] + 1)
    return total


def test_kernel_equals_enumeration():
    rnd = random.Random(1)
    words = ["".join(rnd.choices("abcde", k=rnd.randint(3, 9))) for _ in range(25)] + ["idiot", "idxiot", "aaaaaa"]
    marks = ["idiot", "abcab", "aaaa", "edcba"]
    got = T.project(words, T.landmark_features(marks))
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            assert got[i, j] == pytest.approx(kernel(w, m) / np.sqrt(kernel(w, w) * kernel(m, m)), abs=1e-5)
    assert (T.project(["", "ab"], T.landmark_features(marks)) == 0).all()


def test_gaps_and_insertions_stay_near():
    near = T.project(["idxiot", "idiiot", "idot", "garden", "oidti"], T.landmark_features(["idiot"]))[:, 0]
    assert near[:3].min() > 0.3 and near[3] < 0.05 and near[4] < near[:2].min()


def test_units():
    assert T.units_of(b"ID1OT!!") == ["idiot"] and T.units_of(b"i.d.i.o.t") == ["idiot"] and T.units_of(b"12-34") == []
    assert [t for t in T.tokens_of(b"you i d i o t now")][-1] == b"idiot"
    long = T.units_of(b"x" * 100 + b"idiot" + b"y" * 100)
    assert max(map(len, long)) <= T.LONGEST and any("idiot" in u for u in long)


@pytest.fixture(scope="module")
def invented(spark):
    """Sentences in an invented language; toxic texts hold one of a few words, sometimes disguised."""
    rnd = random.Random(3)
    syllables = ["ba", "ke", "lo", "mi", "nu", "ra", "so", "ti", "ve", "zu", "da", "fo"]
    plain = ["".join(rnd.choices(syllables, k=rnd.randint(1, 4))) for _ in range(600)]
    bad = ["grunzpik", "wexqual", "schmodder"]

    def text(word=None):
        words = rnd.choices(plain, k=40)
        if word:
            words[rnd.randrange(40)] = word
        return " ".join(words[:20]).capitalize() + ". " + " ".join(words[20:]) + "."

    rows, labels = [], []
    for i in range(500):
        toxic = i % 4 == 0
        rows.append((i, text(rnd.choice(bad) if toxic else None)))
        labels.append((i, int(toxic)))
    probes = ["grunzpik", "GRUNZ-PIK!", "grunnzpik", "g r u n z p i k", "wexxqual", "schm0dder", "schmoddder"]
    rows += [(10_000 + k, text(p)) for k, p in enumerate(probes)] + [(20_000 + k, text()) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_finds_held_out_and_disguised_words(invented):
    docs, labels = invented
    got = {r.doc_id: r for r in T.score_documents(docs, T.train(docs, labels)).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 500]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    assert len(held) > 60 and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert all(r.predicted for i, r in got.items() if 10_000 <= i < 20_000)
    assert sum(r.predicted for i, r in got.items() if i >= 20_000) <= 1


def test_held_out_labels_are_not_read(invented):
    docs, labels = invented
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    turned = labels.withColumn("toxic", F.when(fold == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.train(docs, labels), T.train(docs, turned)
    assert (a.weights == b.weights).all() and (a.scale == b.scale).all()


def test_held_out_accuracy_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = T.q_toxicity(spark, sf).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)
    assert T.q_toxicity(spark, sf).count() == docs.count()


def test_odd_rows(spark, odd, nothing, invented):
    docs, labels = invented
    model = T.train(docs, labels)
    got = T.score_documents(odd, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in pairs(odd))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.predicted for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert T.score_documents(nothing, model).collect() == []
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    odd_labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (4, 0), (4, 0), (5, 1)], "doc_id bigint, toxic int")
    for y in (none, odd_labels, odd_labels.where("toxic = 1"), odd_labels.where("toxic = 0")):
        assert T.score_documents(odd, T.train(odd, y)).count() == odd.count()
