import random
from collections import Counter
from itertools import combinations

import xxhash

from gleaner.llm.graph import components
from gleaner.llm.simhash import links, masks, near_duplicates, q_simhash, signed, simhash
from tests.llm.conftest import SF, pairs


def brute_print(text):
    import re

    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(nodes, linked):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def brute(rows):
    prints = {i: brute_print(t) for i, t in rows}
    distinct = sorted(set(prints.values()))
    root = brute_roots(distinct, [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= 4])
    smallest = {}
    for i, p in prints.items():
        r = root[p]
        if i is not None:
            smallest[r] = min(smallest.get(r, i), i)
    return Counter((i, f"{prints[i]:016x}", smallest.get(root[prints[i]])) for i, _ in rows)


def check(df):
    assert Counter(tuple(r) for r in near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()) == brute(pairs(df))


def test_masks_cover_every_pair_within_the_radius():
    tables = masks()
    rnd = random.Random(2)
    patterns = [sum(1 << i for i in c) for d in (1, 2) for c in combinations(range(64), d)]
    patterns += [sum(1 << i for i in rnd.sample(range(64), d)) for d in (3, 4) for _ in range(20_000)]
    assert len(tables) == 31 and all(any(m & p == 0 for m in tables) for p in patterns)


def test_fingerprint(documents):
    for _, t in pairs(documents.limit(60)):
        assert simhash(t.encode()) == brute_print(t)


def test_links_connect_what_brute_force_connects(spark):
    rnd = random.Random(8)
    centre, prints = rnd.getrandbits(64), set()
    for _ in range(900):                       # one crowd, and smaller ones
        x = centre
        for b in rnd.sample(range(64), rnd.randint(0, 5)):
            x ^= 1 << b
        prints.add(x)
    for _ in range(150):
        x = rnd.getrandbits(64)
        prints |= {x, x ^ (1 << rnd.randrange(64)), x ^ sum(1 << b for b in rnd.sample(range(64), 5))}
    prints = sorted(map(signed, prints))
    near = [(a, b) for a, b in combinations(prints, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    df = spark.createDataFrame([(p,) for p in prints], "print bigint").repartition(5)
    for block in (1024, 64):
        found = [tuple(r) for r in links(df, block=block).distinct().collect()]
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 and a != b for a, b in found)
        assert brute_roots(prints, found) == brute_roots(prints, near)


def test_dealt_prints_are_not_broadcast(spark):
    """Spark sizes the 31 rows of a print as one row; broadcast, they take the driver's memory."""
    df = spark.range(4000).selectExpr("xxhash64(id) as print").repartition(2)
    plan = links(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, k) for k in range(1001, 1200)] + [(5000, 4000), (4000, 5000), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == brute_roots({n for e in edges for n in e}, edges)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_odd_rows(odd, nothing):
    check(odd)
    assert near_duplicates(nothing).collect() == []


def test_query(spark, documents):
    got = Counter(tuple(r) for r in q_simhash(spark, SF).collect())
    assert got == brute(pairs(documents))
