"""Null keys, hot keys and the streaming forms, held to a sequential fold."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleaner.operators import budget as B
from gleaner.streaming import budget as SB
from gleaner.streaming import pipeline as PL

SCHEMA = "a string, b string, ord bigint, tokens bigint"


def fold(rows, tl, ul, price):
    """Row by row in order; counters per (a, b)."""
    spent, out = {}, {}
    for a, b, o, t in sorted(rows, key=lambda r: r[2]):
        used, usd = spent.get((a, b), (0, 0))
        t = t or 0
        fits = tl is None or used + t <= tl
        pays = fits and (ul is None or usd + t * price <= ul)
        spent[a, b] = (used + t * fits, usd + t * price * pays)
        out[o] = (fits, pays)
    return out


def decisions(df):
    return {r.ord: (r.tok_ok, r.admitted) for r in df.collect()}


def requests(seed, n, sizes=(0, 1, 2, 5, 9, 30, 80, None)):
    rnd = random.Random(seed)
    keys = [(None, "x"), ("x", None), ("x", "x"), (None, None), ("", "x")]
    return [(*rnd.choice(keys), i, rnd.choice(sizes)) for i in range(n)]


@pytest.mark.parametrize("tl,ul,price", [(400, None, None), (None, 300.0, 1.0), (400, 250.0, 1.0), (90, 10_000.0, 1.0), (10_000, 55.0, 1.0)])
def test_null_keys_are_budgets_of_their_own(spark, tl, ul, price):
    rows = requests(1, 300)
    df = spark.createDataFrame(rows, SCHEMA)
    got = decisions(B.budget(df, ["a", "b"], ["ord"], token_limit=tl, usd_limit=ul, price=price, partitions=5))
    assert got == fold(rows, tl, ul, price or 0)


def test_one_key_over_many_partitions_takes_few_rounds(spark, monkeypatch):
    # sizes that keep fitting after each refusal: a per-key fold would walk all of them
    rnd = random.Random(2)
    rows = [("hot", None, i, rnd.randint(0, 200)) for i in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = B.budget(df, ["a", "b"], ["ord"], token_limit=100_000, usd_limit=60_000.0, price=1.0, partitions=16)
    assert decisions(out) == fold(rows, 100_000, 60_000, 1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and "Python" not in plan
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") < 40


def stream_run(spark, landed, checkpoint, out, tl, ul, price):
    stream = spark.readStream.schema(SCHEMA).parquet(landed)
    decided = SB.budget_stream(stream, ["a", "b"], ["ord"], token_limit=tl, usd_limit=ul, price=price)
    q = PL.drain(decided, lambda df, b: df.write.mode("overwrite").parquet(f"{out}/batch={b}"), checkpoint)
    return q


def test_stream_restart_and_replay_equal_the_batch(spark, tmp_path):
    rows = requests(3, 240)
    landed, out, ck = (str(tmp_path / n) for n in ("landed", "out", "ck"))
    tl, ul, price = 400, 250.0, 1.0
    for lo in (0, 80, 160):                         # three micro-batches, the query restarted before each
        spark.createDataFrame(rows[lo:lo + 80], SCHEMA).write.mode("append").parquet(landed)
        stream_run(spark, landed, ck, out, tl, ul, price)
    whole = decisions(B.budget(spark.createDataFrame(rows, SCHEMA), ["a", "b"], ["ord"], token_limit=tl, usd_limit=ul, price=price))
    assert decisions(spark.read.parquet(out)) == whole == fold(rows, tl, ul, 1)
    # the last batch's commit is lost, as when the driver dies before it: the batch runs again
    commits = sorted((f for f in os.listdir(f"{ck}/commits") if f.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{ck}/commits/{name}"):
            os.remove(f"{ck}/commits/{name}")
    q = stream_run(spark, landed, ck, out, tl, ul, price)
    assert [p["batchId"] for p in q.recentProgress if p["numInputRows"]] == [int(commits[-1])]
    assert decisions(spark.read.parquet(out)) == whole


def test_stream_needs_limits(spark):
    with pytest.raises(ValueError):
        SB.budget_stream(spark.range(1), ["id"], [])


def test_rate_audit_stream_equals_the_batch(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    rnd = random.Random(4)
    rows = [(t0 + timedelta(seconds=7 * i), rnd.choice(["text-embedding-3-small", "text-embedding-3-large", None]), rnd.randint(0, 900_000))
            for i in range(200)]
    schema = "ts timestamp_ntz, model string, tokens bigint"
    landed, out, side = (str(tmp_path / n) for n in ("landed", "out", "side"))
    catalog = B.model_catalog(spark)
    late = SB.LateEvents("ts", side, delay="1 minute")
    parts = [rows[:90], rows[90:], [(rows[3][0], "text-embedding-3-small", 1), (rows[-1][0] + timedelta(hours=1), None, 0)]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        audit = SB.rate_audit_stream(stream, "ts", "model", "tokens", catalog, delay="1 minute")
        q = audit.writeStream.outputMode("append").format("parquet").option("path", out) \
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
        PL.drain(spark.readStream.schema(schema).parquet(landed), late, str(tmp_path / "ck-late"))
    batch = B.rate_audit(spark.createDataFrame(rows, schema), "ts", "model", "tokens", catalog)
    key = lambda r: str((r.minute, r.model, r.n_requests, r.n_tokens, r.over_rpm, r.over_tpm))
    assert sorted(map(key, spark.read.parquet(out).collect())) == sorted(map(key, batch.collect()))
    behind = spark.read.parquet(f"{side}/late").collect()
    assert [(r.ts, r.tokens) for r in behind] == [(rows[3][0], 1)]


def test_sliding_windows_count_each_event_in_each(spark, tmp_path):
    rows = [(datetime(2024, 1, 1, 0, 0, 30 + i), "m", 1) for i in range(3)] + [(datetime(2024, 1, 2), "m", 0)]
    landed = str(tmp_path / "landed")
    spark.createDataFrame(rows, "ts timestamp_ntz, model string, tokens bigint").coalesce(1).write.parquet(landed)
    stream = spark.readStream.schema("ts timestamp_ntz, model string, tokens bigint").parquet(landed)
    audit = SB.rate_audit_stream(stream, "ts", "model", "tokens", B.model_catalog(spark), window="1 minute", slide="30 seconds")
    q = audit.writeStream.outputMode("append").format("memory").queryName("sliding").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((r.minute, r.n_requests) for r in spark.table("sliding").collect())
    assert got == [(datetime(2024, 1, 1), 3), (datetime(2024, 1, 1, 0, 0, 30), 3)]
