import zlib
from collections import Counter, defaultdict

from gleaner.llm.shard import byte_shards, q_sharding
from tests.llm.conftest import SF, pairs


def brute(rows, n):
    """Rows in order, each in the shard that holds its middle byte."""
    line = sorted(((i is not None, i or 0), zlib.crc32(t.encode()), len(t.encode()) + 8, i) for i, t in rows)
    total, start, out, slots = sum(x[2] for x in line), 0, [], Counter()
    for _, crc, size, i in line:
        shard = min(n - 1, n * (2 * start + size) // (2 * total))
        out.append((i, size, crc, shard, slots[shard], start))
        slots[shard] += 1
        start += size
    return out


def check(df, n):
    got = [tuple(r) for r in byte_shards(df, n).collect()]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(brute(pairs(df), n), key=key)
    return got


def test_matches_brute_force(documents):
    got = check(documents, 24)
    sizes = defaultdict(int)
    for _, size, _, shard, _, _ in got:
        sizes[shard] += size
    largest = max(r[1] for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_partition_counts_do_not_matter(spark, documents):
    a = set(map(tuple, byte_shards(documents.repartition(13, "source"), 7).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        assert a == set(map(tuple, byte_shards(documents, 7).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_odd_rows(odd, nothing):
    check(odd, 5)
    check(odd.unionByName(odd).unionByName(odd), 3)
    assert byte_shards(nothing, 4).collect() == []


def test_no_python_in_the_plan(spark):
    plan = q_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExternalRDD"))
