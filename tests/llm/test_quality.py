import base64
import math
import random
import re
import string

import zstandard

from gleaner.llm.quality import BANDS, in_bands, passing, q_quality, quality_rules
from tests.llm.conftest import pairs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    marked = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in lines
            lines.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(marked),
            n < 10 or 100 * len(marked) > 20 * n)


def check(df):
    rows = [tuple(r)[:7] for r in quality_rules(df).collect()]
    want = [(i, *brute(t)) for i, t in pairs(df)]
    assert sorted(map(str, rows)) == sorted(map(str, want))


def test_base_counts(documents):
    check(documents)


def test_odd_rows(odd, nothing):
    check(odd)
    assert quality_rules(nothing).collect() == []
    assert not any(r.kept for r in quality_rules(odd).collect() if r.doc_id in (1, 2, 3, 4, 7))


def test_bands_reject_repetition_and_noise(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choices(string.ascii_lowercase, k=rnd.randint(2, 9))) for _ in range(3000)]
    prose = " ".join(rnd.choices(words, weights=[1 / (i + 1) for i in range(3000)], k=1500))
    noise = base64.b64encode(rnd.randbytes(9000)).decode()
    noise = " ".join(noise[i:i + 60] for i in range(0, len(noise), 60))
    # repeats with a changing counter: no five-word window repeats, yet little new is said
    loops = "".join(f"{i} buy now {i} best price {i} call us {i} today " for i in range(900))
    hidden = prose + " " + noise
    df = spark.createDataFrame([(1, prose), (2, noise), (3, loops), (4, hidden)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    assert [got[i].base_failed for i in (1, 2, 3, 4)] == [False] * 4
    assert [got[i].kept for i in (1, 2, 3, 4)] == [True, False, False, False]


def test_limits_cover_every_length():
    assert [b[0] for b in BANDS] == sorted(b[0] for b in BANDS) and BANDS[-1][0] == float("inf")
    assert in_bands(10**9, 0.4, 0, 10) and not in_bands(10**9, 0.01, 0, 10) and not in_bands(10**5, 0.4, 40, 100)


def test_verdict_by_brute_force(spark):
    """Every ratio and verdict of a table, text by text, with the usual ratios from sorted lists."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pack = zstandard.ZstdCompressor(level=3)
    rows, by_octave = {}, {}
    for i, t in pairs(docs):
        b = t.encode()
        ratio = len(pack.compress(b)) / len(b) if b else 0.0
        starts = [*range(0, len(b) - 1023, 1024), *([len(b) - 1024] if len(b) > 1024 and len(b) % 1024 else [])]
        bad = sum(not 0.18 <= len(pack.compress(b[k:k + 1024])) / 1024 <= 0.78 for k in starts)
        rows[i] = (brute(t)[-1], len(b), ratio, bad, len(starts))
        if not rows[i][0]:
            by_octave.setdefault(math.floor(math.log2(len(b))), []).append(ratio)
    usual = {}
    for o, own in by_octave.items():
        own.sort()
        if len(own) >= 100:
            q50, q75 = (own[math.ceil(p * len(own)) - 1] for p in (0.5, 0.75))
            usual[o] = q50 - 4 * (q75 - q50)
    assert len(usual) >= 3
    kept = {}
    for i, (failed, n, ratio, bad, chunks) in rows.items():
        low, high = next((lo, hi) for upto, lo, hi in BANDS if n < upto)
        kept[i] = not failed and max(low, usual.get(math.floor(math.log2(n)), low)) <= ratio <= high and bad <= 0.25 * chunks
    got = {r.doc_id: r for r in q_quality(spark, "/root/testdata/sf0.01").collect()}
    assert {i: r.kept for i, r in got.items()} == kept
    assert all(abs(got[i].ratio - r[2]) < 1e-12 and (got[i].bad_chunks, got[i].n_chunks) == r[3:] for i, r in rows.items())
    assert {r.doc_id for r in passing(docs).collect()} == {i for i, k in kept.items() if k}


def test_bands_reject_poor_documents_and_keep_good_ones(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in q_quality(spark, sf).select("doc_id", "base_failed", "kept").collect() if not r.base_failed and labels.get(r.doc_id) is not None]
    good, poor = ([r.kept for r in rows if labels[r.doc_id] == q] for q in (1, 0))
    assert len(good) > 3000 and sum(good) >= 0.98 * len(good)
    assert len(poor) > 250 and sum(poor) <= 0.55 * len(poor)
