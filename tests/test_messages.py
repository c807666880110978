"""T1 buffers, M6 listeners, M8 key checks, S1 start positions, V1 nested schemas, Q6 order."""

import json
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators import messages as M
from gleaner.operators import warehouse as W
from gleaner.operators.conform import Field, conform
from gleaner.sources import topics as S
from gleaner.streaming import pipeline as PL
from gleaner.streaming.buffer import buffered

MSG = "topic string, n int"


# -- T1 ------------------------------------------------------------------------------

def start(spark, landed, out, ck, min_rows, delay):
    held = buffered(spark.readStream.schema(MSG).parquet(landed), "topic", min_rows, delay)
    return (held.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
            .trigger(processingTime="1 second").start())


def land(spark, landed, rows):
    spark.createDataFrame(rows, MSG).coalesce(1).write.mode("append").parquet(landed)


def wait_for(spark, out, n, seconds=90):
    until, got = time.time() + seconds, []
    while time.time() < until and len(got) < n:
        time.sleep(0.5)
        got = spark.read.schema(MSG + ", buffer_batch bigint, fired string").parquet(out).collect()
    return sorted(got)


def test_count_timeout_and_drain(spark, tmp_path):
    landed, out, ck = (str(tmp_path / n) for n in ("landed", "out", "ck"))
    spark.createDataFrame([], MSG).write.parquet(landed)
    spark.createDataFrame([], MSG + ", buffer_batch bigint, fired string").write.parquet(out)
    q = start(spark, landed, out, ck, 3, 600_000)
    try:
        land(spark, landed, [("a", 1), ("a", 2), ("b", 1)])
        time.sleep(3)
        land(spark, landed, [("a", 3)])                     # the third of a: by count
        got = wait_for(spark, out, 3)
        assert [(r.topic, r.n, r.buffer_batch, r.fired) for r in got] == [("a", i, 0, "count") for i in (1, 2, 3)]
    finally:
        q.stop()
    # b's message is in the checkpoint; stopped and started again, its timer still stands, so a drain needs a new message
    q = start(spark, landed, out, ck, 1, 600_000)
    try:
        land(spark, landed, [("b", 2)])
        got = [r for r in wait_for(spark, out, 5) if r.topic == "b"]
        assert [(r.n, r.fired) for r in got] == [(1, "count"), (2, "count")]
    finally:
        q.stop()


def test_timeout(spark, tmp_path):
    landed, out, ck = (str(tmp_path / n) for n in ("landed", "out", "ck"))
    spark.createDataFrame([], MSG + ", buffer_batch bigint, fired string").write.parquet(out)
    land(spark, landed, [("a", 1), ("b", 1)])
    q = start(spark, landed, out, ck, 100, 2000)
    try:
        assert [(r.topic, r.n, r.fired) for r in wait_for(spark, out, 2)] == [("a", 1, "timeout"), ("b", 1, "timeout")]
        land(spark, landed, [("a", 2)])
        assert [(r.n, r.buffer_batch) for r in wait_for(spark, out, 3) if r.topic == "a"] == [(1, 0), (2, 1)]
    finally:
        q.stop()


# -- M6 ------------------------------------------------------------------------------

def test_listeners_decode_with_their_own_schema_and_a_failing_sink_is_retried(spark, tmp_path):
    rows = [("t1", '{"action":"A","params":{"x":1}}'), ("t2", '{"action":"A","params":{"x":2,"s":"q"}}'),
            ("t2", '{"action":"B","params":{"x":3,"s":"r"}}'), ("t3", "junk")]
    df = spark.createDataFrame(rows, "topic string, value string")
    x = T.StructType([T.StructField("x", T.LongType())])
    xs = T.StructType([T.StructField("x", T.LongType()), T.StructField("s", T.StringType())])
    tries = []

    def sink(name, fail=0):
        def write(good, bad, b):
            tries.append(name)
            if tries.count(name) <= fail:
                raise OSError("sink is down")
            good.write.mode("overwrite").parquet(str(tmp_path / name / f"batch={b}"))
            bad.write.mode("overwrite").parquet(str(tmp_path / f"{name}-bad" / f"batch={b}"))
        return write

    batch = M.deliver([M.Listener("one", ("t1", "t2"), x, sink("one")), M.Listener("two", ("t2", "t3"), xs, sink("two", fail=1)),
                       M.Listener("three", ("t2",), xs, sink("three"), action="B")])
    with pytest.raises(RuntimeError, match="two"):
        batch(df, 0)
    assert tries == ["one", "two", "three"]                 # the others got the batch
    batch(df, 0)
    read = lambda n, *c: sorted(tuple(r[k] for k in c) for r in spark.read.parquet(str(tmp_path / n)).collect())
    assert read("one", "topic", "x") == [("t1", 1)] and len(read("one-bad", "topic")) == 2       # s is unexpected to it
    assert read("two", "x", "s") == [(2, "q"), (3, "r")] and read("two-bad", "topic") == [("t3",)]
    assert read("three", "x", "s") == [(3, "r")]


# -- M8 ------------------------------------------------------------------------------

def test_load_record_needs_every_key_and_its_types(spark):
    whole = {f: None for f in M.LOAD_FIELDS} | {"documents": [], "location_type": [], "topic": M.LOAD_TOPIC, "action": "START_LOAD", "about_codec": "zlib"}
    records = [whole, {k: v for k, v in whole.items() if k not in ("url", "position")}, whole | {"wage": "high"}, whole | {"documents": None},
               {k: v for k, v in whole.items() if k != "about"}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, value string")
    good, bad = M.decode_load_record(df, keep=("i",))
    assert [r.i for r in good.collect()] == [0]
    assert {r.i: r._errors for r in bad.collect()} == {
        1: ["M8_missing_position", "M8_missing_url"], 2: ["M8_bad_wage"], 3: ["M8_documents"], 4: ["M8_missing_about"]}


# -- S1 ------------------------------------------------------------------------------

def test_start_positions(spark, tmp_path):
    root = str(tmp_path)
    at = lambda h: datetime(2024, 1, 1, h, tzinfo=timezone.utc)
    rows = lambda lo, hi: spark.createDataFrame([(f"v{i}", at(i)) for i in range(lo, hi)], "value string, timestamp timestamp").coalesce(1)
    S.publish(rows(0, 3), "t", root)
    latest = S.latest_offsets(spark, root, ["t", "never"])
    assert latest == {"t": 3, "never": 0}
    S.publish(rows(3, 5), "t", root)
    values = lambda **kw: sorted(bytes(r.value).decode() for r in S.read_topics(spark, root, ["t"], streaming=False, **kw).collect())
    assert values() == values(start="earliest") == [f"v{i}" for i in range(5)]
    assert values(start=latest) == ["v3", "v4"] and values(start="latest") == []
    assert values(start=at(2)) == ["v2", "v3", "v4"] == values(start=at(2).isoformat())
    seen = []
    PL.drain(S.read_topics(spark, root, ["t"], start=latest), lambda df, b: seen.extend(df.collect()), str(tmp_path / "ck"))
    assert sorted(bytes(r.value).decode() for r in seen) == ["v3", "v4"]


# -- V1 ------------------------------------------------------------------------------

def conformed(spark, spec, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    return [r.conformed for r in conform(df, "j", spec).orderBy("i").collect()]


def test_numbers_are_coerced_without_loss(spark):
    got = conformed(spark, {"n": "bigint"}, '{"n":7}', '{"n":"7"}', '{"n":7e0}', '{"n":7.0}', '{"n":" -8 "}', '{"n":9007199254740993}',
                    '{"n":6.55}', '{"n":"x"}', '{"n":"7 8"}', '{"n":true}', '{"n":1e30}')
    assert got == ['{"n":7}'] * 4 + ['{"n":-8}', '{"n":9007199254740993}'] + [None] * 5
    assert conformed(spark, {"s": "string", "b": "boolean"}, '{"s":7,"b":true}', '{"s":"7","b":"Yes"}', '{"s":"x","b":0}', '{"s":"x","b":2}') == [
        None, '{"s":"7","b":true}', '{"s":"x","b":false}', None]


@pytest.mark.parametrize("wrap", [lambda s, t: ({"in": {"deep": s}}, '{"in":{"deep":' + t + ',"extra":1}}'),
                                  lambda s, t: ({"in": [[s]]}, '{"in":[[' + t + "]]}"),
                                  lambda s, t: ({"in": {"*": {"*": s}}}, '{"in":{"k":{"l":' + t + "}}}")])
def test_the_references_cases_nested_two_deep(spark, wrap):
    inventory = '{"a":"a","b":"b","c":"c"}'
    cases = [({"a": "string"}, '{"a":"a"}'), ({"b": "string"}, '{"b":"b"}'), ({"c": Field("string", optional=True)}, '{"c":"c"}'),
             ({"d": Field("string", not_required=True)}, "{}"), ({"f": "string"}, None), ({"a": "string", "b": "string"}, '{"a":"a","b":"b"}')]
    for spec, want in cases:
        nested, text = wrap(spec, inventory)
        expect = None if want is None else json.loads(wrap(spec, want)[1].replace(',"extra":1', ""))
        got = conformed(spark, nested, text)[0]
        assert (None if got is None else json.loads(got)) == expect


def test_nulls_and_absent_fields_inside(spark):
    spec = {"a": {"b": ["bigint"], "c": Field({"d": "string"}, optional=True)}, "f": Field("boolean", not_required=True)}
    assert conformed(spark, spec, '{"a":{"b":["1",2.0],"c":null}}', '{"a":{"b":[1.5],"c":null}}', '{"a":{"b":[]}}', '{"a":{"b":[null],"c":null}}',
                     '{"a":{"b":[],"c":{"d":7}}}', '{"a":[],"f":true}') == ['{"a":{"b":[1,2],"c":null}}'] + [None] * 5


# -- Q6 ------------------------------------------------------------------------------

def test_the_last_update_wins(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    updates = spark.createDataFrame([(1, "z", 1), (1, "c", 2)], "id int, v string, at int")
    assert sorted(tuple(r) for r in W.update_by_ids(base, updates, "id", ["v"], order="at").collect()) == [(1, "c"), (2, "b")]
    assert sorted(tuple(r) for r in W.update_by_ids(base, updates, "id", ["v"]).collect()) == [(1, "z"), (2, "b")]


# -- S6 ------------------------------------------------------------------------------

def test_inserted_rows_get_ids(spark):
    name = "applications_with_serial_ids"
    W.create_applications(spark, name)
    try:
        rows = spark.createDataFrame([("full-time", "p")] * 5, "work_type string, position string").repartition(3).select(
            F.lit(None).cast("timestamp_ntz").alias("posted_at"), "work_type", "position", F.lit("l").alias("location"),
            F.lit("c").alias("company"), W.pay_range(F.lit(1), F.lit(2)).alias("pay"))
        assert W.insert_applications(rows, name) == 5
        first = {r.id for r in spark.table(name).collect()}
        assert W.insert_applications(rows, name) == 5 and W.insert_applications(rows.limit(1).withColumn("id", F.lit(-7).cast("bigint")), name) == 1
        ids = [r.id for r in spark.table(name).collect()]
        assert len(first) == 5 and len(set(ids)) == 11 and min(set(ids) - first - {-7}) > max(first)
    finally:
        W.drop_applications(spark, name)


def test_load_records_are_parsed_for_their_keys_once(spark):
    df = spark.createDataFrame([(b"{}",)], "value binary")
    good, _ = M.decode_load_record(df)
    assert good._jdf.queryExecution().analyzed().toString().count("json_object_keys") == 1


def test_pages_leave_no_trees_behind():
    import gc

    from gleaner.functions.dom import Element, detail_fields, to_markdown

    trees = lambda: sum(isinstance(x, Element) for x in gc.get_objects())
    gc.collect()
    gc.disable()
    try:
        before = trees()
        got = detail_fields("<body><div><h1>a</h1></div><button aria-label='Apply'>go</button><p>un<b>closed</body>")
        assert got["apply_type"] == "go" and to_markdown("<p>a <b>c</b></p>") == "a **c**"
        assert trees() == before
    finally:
        gc.enable()


def test_pages_are_returned_in_small_batches(spark):
    from gleaner.operators.html import PAGES, detail_fields

    df = spark.range(2 * PAGES + 1).coalesce(1).selectExpr("id", "concat('<button aria-label=Apply>', id, '</button>') AS html")
    got = detail_fields(df, keep=("id",)).select("id", "apply_raw").collect()
    assert sorted((r.id, r.apply_raw) for r in got) == [(i, str(i)) for i in range(2 * PAGES + 1)]
