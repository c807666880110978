import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gleaner.llm import lm
from gleaner.llm.lm import learn_weights, pack_keys, planes, q_lm, score_documents, unpack_keys, unplanes
from tests.llm.conftest import SF, pairs


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)), None]


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def brute(rows):
    """Exact counts, EM over single tokens without quantisation, direct scores."""
    train = [tokens(t) for i, t in rows if not held(i)]
    c1, c2, cv = Counter(), Counter(), Counter()
    for ts in train:
        for v, w in zip([0, *ts], ts):
            c1[w] += 1
            c2[v, w] += 1
            cv[v] += 1
    n, v_ = sum(c1.values()), len(c1)
    bucket = lambda c: int(math.log2(c)) + 1 if c else 0
    stats = Counter()
    for (v, w), c in c2.items():
        stats[bucket(cv[v] - 1), (c - 1) / (cv[v] - 1) if cv[v] > 1 else 0.0, (c1[w] - 1) / max(n - 1, 1)] += c
    b, p2, p1, k = (np.array(x, float) for x in zip(*((*s, k) for s, k in stats.items()))) if stats else [np.empty(0)] * 4
    b, p = b.astype(int), np.stack([p2, p1, np.full(len(p1), 1 / (v_ + 1))], axis=1)
    weights = np.full((40, 3), 1 / 3)
    for _ in range(100):
        share = weights[b] * p
        share *= (k / share.sum(axis=1))[:, None]
        mass = np.full((40, 3), 0.5)
        np.add.at(mass, b, share)
        weights = mass / mass.sum(axis=1, keepdims=True)
    weights[0, 0] = 0
    weights[0] /= weights[0].sum()
    out = []
    for i, t in rows:
        ts = tokens(t)
        base = sum(math.log10((c1[w] + 0.5) / (n + 0.5 * (v_ + 1))) for w in ts)
        score = 0.0
        for v, w in zip([0, *ts], ts):
            l2, l1, l0 = weights[bucket(cv[v])]
            score += math.log10((l2 * c2[v, w] / cv[v] if cv[v] else 0) + l1 * c1[w] / max(n, 1) + l0 / (v_ + 1))
        out.append((i, held(i), len(ts), sum(c1[w] > 0 for w in ts), n, base, score))
    return out


def check(df, near=1e-3, **how):
    key = lambda r: (str(r[0]), r[2], round(r[5], 3))
    got = sorted((tuple(r) for r in score_documents(df, **how).collect()), key=key)
    want = sorted(brute(pairs(df)), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=near, abs=1e-6)      # weights from quantised ratios
    return got


def test_matches_brute_force(documents):
    rows = check(documents)
    unseen = [r for r in rows if r[1]]
    assert sum(r[6] for r in unseen) > sum(r[5] for r in unseen)        # better than the unigram base on held-out text


def test_documents_that_span_blocks(documents):
    some = documents.where("doc_id < 9")
    check(some, block_tokens=211)


def test_odd_rows(odd, nothing):
    check(odd)
    check(odd.repartition(4), block_tokens=9000)
    assert score_documents(nothing).collect() == []
    check(odd.where("doc_id = 4"))
    only_held = odd.where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")
    assert only_held.count() > 0
    check(only_held)


def test_probabilities_add_up_to_one(documents, spark):
    rows = pairs(documents)[:40]
    words = sorted({w for _, t in rows for w in tokens(t)[:-1]})
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = [(10_000 + k, w) for k, w in enumerate(words)]
    # held-out one-word texts that start alike: p(word | begin) p(end | word)
    probe = [(i, w) for i, w in ((5 * 10**6 + k, w) for k, (_, w) in enumerate(texts)) if held(i)]
    got = {r.doc_id: r.score for r in score_documents(df.unionByName(spark.createDataFrame(probe, df.schema))).collect()}
    assert sum(10 ** got[i] for i, _ in probe) < 1


def test_weights_follow_the_evidence():
    # bucket 5: the pair estimate is always good; bucket 6: it never fires
    w = learn_weights(np.array([5, 6]), np.array([1000.0, 1000.0]), np.array([30_000.0, 0]), np.array([30.0, 30]))
    assert w[5, 0] > 0.95 and w[6, 0] < 0.01 and w[6, 1] > 0.9
    assert np.allclose(w.sum(axis=1), 1) and (w[1:] > 0).all()


def test_arrays_round_trip():
    keys = np.sort(np.random.default_rng(0).integers(0, 2**64, 5000, dtype=np.uint64))
    assert (unpack_keys(pack_keys(keys)) == keys).all()
    for a in (np.arange(300, dtype=np.uint32), np.empty(0, np.uint32)):
        assert (unplanes(planes(a), "<u4") == a).all()


def test_query(spark, documents):
    rows = q_lm(spark, SF).collect()
    assert len(rows) == documents.count() and {r.held_out for r in rows} == {True, False}
    assert lm.HELD_OUT_FOLD == 1
