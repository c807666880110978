"""E5's stored index: every row stored, recall, pruning, k rows, the exact second pass, hot cells, odd input."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import vector_index as VI
from gleaner.operators import vectors as V

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def emb(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")


@pytest.fixture(scope="module")
def index(spark, emb, tmp_path_factory):
    return VI.build_index(emb, str(tmp_path_factory.mktemp("index")), keep=("label",))


def asked(emb, every=50):
    return emb.where(F.col("vec_id") % every == 0).selectExpr("vec_id AS query_id", "embedding AS query_vec")


def test_every_row_is_stored_once(emb, index):
    assert index.rows().select("_id").exceptAll(emb.select(F.col("vec_id").alias("_id"))).count() == 0
    assert index.rows().count() == emb.count() == index.sizes.sum()


def test_recall_of_rows_against_brute_force(emb, index):
    q = asked(emb)
    exact = {(r.query_id, r.id) for r in V.cosine_top_k(emb, q, 5).collect()}
    got = index.search(q, 5, keep=("label",)).collect()
    assert len(got) == len(exact) == 5 * q.count()
    assert len(exact & {(r.query_id, r.id) for r in got}) >= 0.9 * len(exact)
    visits = index._plan(V.query_rows(q, "query_id", "query_vec"), 5, round(VI.PROBES * len(index.centroids)), "near").collect()
    scored = sum(min(index.sizes[v.cell], max(5, np.ceil(VI.SCORED * index.sizes[v.cell]))) for v in visits)
    assert scored < 0.15 * q.count() * index.sizes.sum()


def test_one_query_reads_only_its_cells(emb, index):
    found = index.search(asked(emb).limit(1), 5, probes=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[cell#\d+ IN \(\d+,\d+\)", plan) and found.count() == 5


def test_exact_equals_brute_force(emb, index):
    q = asked(emb, 200)
    want = {tuple(r) for r in V.cosine_top_k(emb, q, 5).collect()}
    assert {tuple(r) for r in index.search(q, 5, probes=2, exact=True).collect()} == want


def test_clustered_vectors_let_the_bound_skip_cells(spark, tmp_path):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(12, 16))
    rows = [(i, (centers[i % 12] + 0.01 * rng.normal(size=16)).tolist()) for i in range(1200)]
    base = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = VI.build_index(base, str(tmp_path), cells=12)
    q = base.where("vec_id < 24").selectExpr("vec_id AS query_id", "embedding AS query_vec")
    assert {tuple(r) for r in index.search(q, 5, probes=1, exact=True).collect()} == {tuple(r) for r in V.cosine_top_k(base, q, 5).collect()}
    least = index.search(q, 5, probes=1, exact=True).where("rank = 5").selectExpr("query_id AS _qid", "score AS _least")
    more = index._plan(V.query_rows(q, "query_id", "query_vec").join(least, "_qid"), 5, 1, "more")
    assert more.count() < 0.1 * 24 * 11          # a cluster may be split between two cells


def test_small_cells_still_give_k_rows(spark, tmp_path):
    rng = np.random.default_rng(2)
    base = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(60)], "vec_id long, embedding array<double>")
    index = VI.build_index(base, str(tmp_path), cells=20)
    got = index.search(base.selectExpr("vec_id AS query_id", "embedding AS query_vec"), 9, probes=1)
    assert got.groupBy("query_id").count().where("count <> 9").count() == 0 and got.count() == 540
    assert index.search(base.selectExpr("vec_id AS query_id", "embedding AS query_vec"), 70).count() == 3600


def test_hot_cell_is_searched_in_parts(spark, tmp_path, monkeypatch):
    rows = [(i, [1.0, 0.0, 1e-6 * i]) for i in range(500)] + [(i, [0.0, 1.0, 0.0]) for i in range(500, 520)]
    base = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = VI.build_index(base, str(tmp_path), cells=2)
    monkeypatch.setattr(V, "PART_FLOATS", 90)
    q = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0])], "query_id long, query_vec array<double>")
    found = index.search(q, 4, exact=True)
    assert sorted((r.query_id, r.rank, r.id) for r in found.collect()) == [(1, i + 1, i) for i in range(4)] + [(2, i + 1, 500 + i) for i in range(4)]


def test_append_and_open(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(200)]
    base = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    VI.build_index(base.where("vec_id < 150"), str(tmp_path)).append(base.where("vec_id >= 150"))
    index = VI.open_index(spark, str(tmp_path))
    q = base.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding AS query_vec")
    assert {tuple(r) for r in index.search(q, 3, exact=True).collect()} == {tuple(r) for r in V.cosine_top_k(base, q, 3).collect()}


def test_odd_input(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 0.0]), (5, None), (6, [None, 1.0]), (7, [float("nan"), 1.0])]
    base = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = VI.build_index(base, str(tmp_path / "a"))
    q = spark.createDataFrame([(1, [2.0, 0.0]), (2, [1.0, 1.0, 1.0]), (3, None), (4, [0.0, 0.0])], "query_id long, query_vec array<double>")
    got = sorted((r.query_id, r.rank, r.id) for r in index.search(q, 5, exact=True).collect())
    assert got == [(1, 1, 1), (1, 2, 2), (1, 3, 4), (4, 1, 1), (4, 2, 2), (4, 3, 4)]
    assert index.search(q.limit(0), 5).collect() == []
    empty = VI.build_index(base.limit(0), str(tmp_path / "b"))
    assert empty.search(q, 5).collect() == [] == empty.search(q, 5, exact=True).collect()
