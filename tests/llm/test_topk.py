import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.llm import topk
from gleaner.llm.topk import ORACLE, Block, Running, distances, pick_pivots, q_top_k, top_k
from tests.llm.conftest import SF


def brute(rows, k, is_query):
    ok = [(i, n, [math.floor(64 * x) for x in e]) for n, (i, e) in enumerate(rows)
          if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for qi, qn, q in ok:
        if qi is not None and is_query(qi):
            clamp = lambda s: max(-2**63, min(2**63 - 1, s))
            s = [(-clamp(sum(a * b for a, b in zip(q, e))), i is None, i or 0, i) for i, n, e in ok if n != qn and len(e) == len(q)]
            s.sort(key=lambda x: x[:3])
            out += [(qi, r + 1, x[3], -x[0]) for r, x in enumerate(s[:k])]
    return sorted(out, key=str)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = sorted(tuple(r) for r in q_top_k(spark, SF).collect())
    assert got == sorted(con.execute(ORACLE).fetchall())
    assert q_top_k(spark, SF).columns == [d[0] for d in con.execute(ORACLE).description]


@pytest.mark.parametrize("sizes", [(2048, 512, 64), (7, 3, 2)])
def test_odd_rows(spark, monkeypatch, sizes):
    for name, n in zip(("BASE_BLOCK", "QUERY_BLOCK", "PART_BLOCKS"), sizes):
        monkeypatch.setattr(topk, name, n)
    rnd = np.random.default_rng(4)
    rows = [(i, rnd.normal(size=6).round(2).tolist()) for i in range(60)]
    rows += [(i, [0.5] * 6) for i in range(100, 140)]                      # ties: equal vectors
    rows += [(10, rows[10][1]), (10, rows[10][1]), (None, [0.5] * 6), (None, [9.0] * 6)]
    rows += [(200, None), (220, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (240, [math.nan] * 6), (260, [math.inf] + [0.0] * 5),
             (280, [1e30] * 6), (300, []), (301, []), (320, [1.0, 2.0]), (321, [-1.0, 0.25]), (340, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("row", F.lit("x")).withColumn(
        "dim", F.lit(1)).withColumn("rank", F.lit(0)).repartition(3)
    rows += [(400, [4e7, 0.0]), (401, [4e7, 0.5]), (420, [-1.0, 3e18])]      # finite, however large
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("row", F.lit("x")).withColumn(
        "dim", F.lit(1)).withColumn("rank", F.lit(0)).repartition(3)
    want = brute(rows, 20, lambda i: i % 20 == 0)
    assert sorted((tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0, 20).collect()), key=str) == want
    assert top_k(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert top_k(df, F.col("vec_id") < 0).collect() == []


def test_bounds_stop_early_and_stay_exact():
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(20, 8)) * 200
    x = np.floor(centres[rnd.integers(0, 20, 4000)] + rnd.normal(size=(4000, 8)) * 5).astype("<i4")
    table = distances(x, pick_pivots(x[:500], 16))

    def block(rows):
        return Block({"wide": False, "ids": rows.astype("<i8").tobytes(), "rows": rows.astype("<i8").tobytes(), "n": len(rows), "dim": 8,
                      "vectors": x[rows].tobytes(), "table": table[rows].astype("<f4").tobytes()})

    run = Running(block(np.arange(0, 4000, 100)), 10)
    for lo in range(0, 4000, 1000):
        run.see(block(np.arange(lo, lo + 1000)))
    for n, q in enumerate(range(0, 4000, 100)):
        s = x.astype(np.int64) @ x[q]
        best = [i for i in np.lexsort((np.arange(4000), -s)) if i != q][:10]
        assert run.top[n][1].tolist() == best and run.top[n][0].tolist() == s[best].tolist()
    assert run.evaluated < 0.5 * 40 * 4000


def test_large_vectors_are_queries_and_candidates(spark):
    df = spark.createDataFrame([(20, [4e7, 1.0]), (1, [4e7, 0.0]), (2, [0.0, 1.0]), (3, [-1e300, 0.0])], "vec_id bigint, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(20, 1, 1, (64 * 40_000_000) ** 2), (20, 2, 2, 64 * 64), (20, 3, 3, -2**63)]


def test_a_sampled_threshold_only_skips_what_cannot_enter():
    rnd = np.random.default_rng(2)
    x = np.floor(rnd.normal(size=(3000, 16)) * 64).astype("<i4")
    table = distances(x, pick_pivots(x[:500], 64))

    def block(rows):
        return Block({"wide": False, "ids": rows.astype("<i8").tobytes(), "rows": rows.astype("<i8").tobytes(), "n": len(rows), "dim": 16,
                      "vectors": x[rows].tobytes(), "table": table[rows].astype("<f4").tobytes()})

    queries = block(np.arange(0, 3000, 100))
    full = x.astype(float)[::100] @ x.astype(float).T
    full[np.arange(30), np.arange(0, 3000, 100)] = -np.inf
    floor = np.partition(full[:, :500], 480, axis=1)[:, 480]
    runs = Running(queries, 20), Running(queries, 20, floor)
    for lo in range(0, 3000, 500):
        for run in runs:
            run.see(block(np.arange(lo, lo + 500)))
    for (s, i), (t, j) in zip(runs[0].top, runs[1].top):
        assert s.tolist() == t.tolist() and i.tolist() == j.tolist()
    assert runs[1].evaluated < runs[0].evaluated <= 30 * 3000
