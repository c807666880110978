"""E7/S8 on clustered tables, S10/S11 on segments."""

import random
from datetime import datetime, timezone

import pytest

from gleaner.operators.clustered import ClusteredTable
from gleaner.sources import topics as S
from gleaner.sources.segments import SegmentedTopics

SCHEMA = "application_id bigint, chunk_idx int, chunk_txt string"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def data():
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 2000), i, f"t{i}") for i in range(5000)] + [(777, i, "hot") for i in range(2500)] + [(None, 0, "no id")]
    rnd.shuffle(rows)
    return rows


def test_lookup_reads_few_files(spark, tmp_path, data):
    table = ClusteredTable.write(spark.createDataFrame(data, SCHEMA), str(tmp_path), "application_id", ("chunk_idx",), files=40)
    assert rows_of(table.rows()) == sorted(data, key=str)
    ids = spark.createDataFrame([(i,) for i in (3, 4, 5, 1500, 1501, 99999, None)], "id bigint")
    found = table.lookup(ids, "id")
    assert rows_of(found) == sorted((r for r in data if r[0] in (3, 4, 5, 1500, 1501)), key=str)
    assert len(table.files_of(ids, "id")) <= 4 and len(found.inputFiles()) <= 4
    hot = table.files_of(spark.createDataFrame([(777,)], "id bigint"), "id")
    assert len(hot) > 8                                            # a key with a third of the rows spans files
    assert rows_of(table.lookup(spark.createDataFrame([(777,)], "id bigint"), "id")) == sorted((r for r in data if r[0] == 777), key=str)
    assert table.lookup(ids.limit(0), "id").collect() == []


def test_delete_rewrites_only_touched_files(spark, tmp_path, data):
    table = ClusteredTable.write(spark.createDataFrame(data, SCHEMA), str(tmp_path), "application_id", ("chunk_idx",), files=40)
    before = {r.file for r in table.record().collect()}
    gone = {10, 11, 1200}
    after = table.delete(spark.createDataFrame([(i,) for i in gone], "application_id bigint"))
    files = {r.file for r in after.record().collect()}
    assert rows_of(after.rows()) == sorted((r for r in data if r[0] not in gone), key=str)
    assert len(before - files) <= 3 and len(before & files) >= 37
    assert rows_of(table.rows()) == sorted(data, key=str)         # the older version still reads
    again = ClusteredTable.open(spark, str(tmp_path))
    assert again.version == 1 and rows_of(again.rows()) == rows_of(after.rows())
    assert after.delete(spark.createDataFrame([(10**9,)], "application_id bigint")) is after


def test_append_and_text_keys(spark, tmp_path):
    rows = [(f"k{i:03d}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, n int")
    table = ClusteredTable.write(df.where("n < 200"), str(tmp_path), "k", files=10).append(df.where("n >= 200"), files=5)
    ids = spark.createDataFrame([("k005",), ("k250",), ("zzz",)], "k string")
    assert rows_of(table.lookup(ids)) == [("k005", 5), ("k250", 250)]
    assert len(table.files_of(ids)) == 2 and table.rows().count() == 300


def test_empty_table(spark, tmp_path):
    table = ClusteredTable.write(spark.createDataFrame([], SCHEMA), str(tmp_path), "application_id")
    ids = spark.createDataFrame([(1,)], "application_id bigint")
    assert table.lookup(ids).collect() == [] == table.rows().collect() and table.delete(ids) is table


# -- S10 / S11 -----------------------------------------------------------------------

def envelopes(spark, rows):
    return spark.createDataFrame([(t, 0, o, at, None if k is None else k.encode(), None if v is None else v.encode()) for t, o, at, k, v in rows],
                                 "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary")


def files(tmp_path):
    return {str(f): f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}


def test_retention_drops_whole_segments(spark, tmp_path):
    at = lambda day, hour: datetime(2024, 1, day, hour, tzinfo=timezone.utc)
    rows = [("t", i, at(1 + i // 4, 6 * (i % 4)), f"k{i}", "v") for i in range(16)] + [("u", 0, at(1, 0), "k", "v")]
    topics = SegmentedTopics(spark, str(tmp_path))
    topics.land(envelopes(spark, rows))
    before = files(tmp_path)
    dropped = topics.retain("2024-01-04T00:00:00", hours=24)
    assert len(dropped) == 3 + 1 and {t for t, _ in dropped} == {"t", "u"}
    kept = files(tmp_path)
    assert kept.items() < before.items()                           # nothing was rewritten
    want = S.retain(envelopes(spark, rows), "2024-01-04T00:00:00").select("topic", "offset")
    assert rows_of(topics.read().select("topic", "offset")) == rows_of(want)
    assert topics.retain("2024-01-04T00:00:00", hours=24) == []


def test_compaction_touches_only_segments_with_older_values(spark, tmp_path):
    at = lambda day: datetime(2024, 1, day, tzinfo=timezone.utc)
    rows = [("t", 0, at(1), "a", "0"), ("t", 1, at(1), "b", "1"), ("t", 2, at(2), "c", "2"), ("t", 3, at(3), "a", "3"), ("t", 4, at(3), None, "4"),
            ("t", 5, at(3), None, "5"), ("u", 0, at(2), "a", "0"), ("v", 0, at(1), "x", "0"), ("v", 1, at(2), "x", None)]
    topics = SegmentedTopics(spark, str(tmp_path))
    topics.land(envelopes(spark, rows))
    before = files(tmp_path)
    touched = topics.compact()
    day = lambda d: (at(d) - datetime(1970, 1, 1, tzinfo=timezone.utc)).days * 2
    assert touched == [("t", day(1)), ("v", day(1)), ("v", day(2))]
    after = files(tmp_path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("topic=")[1].split("/part")[0] for f in same} == {f"t/segment={day(2)}", f"t/segment={day(3)}", f"u/segment={day(2)}"}
    keyed = S.compact_by_key(envelopes(spark, [r for r in rows if r[3] is not None])).select("topic", "offset")
    assert rows_of(topics.read().where("key is not null").select("topic", "offset")) == rows_of(keyed)
    assert topics.read().where("key is null").count() == 2 and topics.compact() == []
