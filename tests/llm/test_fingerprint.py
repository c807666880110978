import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from gleaner.llm import fingerprint as P
from gleaner.llm.fingerprint import fingerprints, likeness, q_fingerprints, similarity, sketches, with_neighbours, written
from tests.llm.conftest import SF

M = 2**64 - 1


def mix(a):
    a = ((a ^ (a >> 29)) * 0x9E3779B97F4A7C15) & M
    a = ((a ^ (a >> 29)) * 0xD6E8FEB86659FD93) & M
    return a ^ (a >> 29)


def brute_levels(text):
    """The phrases of each level as (name, length), name by name."""
    seq, level, out = [(ord(c), 1) for c in text], 0, []
    while seq:
        runs = []
        for name, width in seq:
            if runs and runs[-1][0] == name:
                runs[-1][1] += width
                runs[-1][2] += 1
            else:
                runs.append([name, width, 1])
        seq = [(mix((n + k * 0xD6E8FEB86659FD93) & M) if k > 1 else n, w) for n, w, k in runs]
        labels = [n for n, _ in seq]
        for _ in range(4):
            tossed = []
            for i, x in enumerate(labels):
                y = labels[i - 1] if i else ~x & M
                low = next(b for b in range(64) if (x ^ y) >> b & 1)
                tossed.append(2 * low + (x >> low & 1))
            labels = tossed
        assert all(0 <= x < 6 for x in labels) and all(x != y for x, y in zip(labels, labels[1:]))
        starts = [i for i in range(len(seq)) if i == 0 or (i + 1 < len(seq) and labels[i - 1] < labels[i] > labels[i + 1])]
        level += 1
        phrases = [seq[a:b] for a, b in zip(starts, starts[1:] + [len(seq)])]
        seq = [(mix((sum(mix((n + (j + 1) * 0x9E3779B97F4A7C15) & M) for j, (n, _) in enumerate(p)) + level) & M), sum(w for _, w in p)) for p in phrases]
        out.append(seq)
        if len(seq) == 1:
            return out
    return out


def brute(text):
    best = {}
    for level in brute_levels(text):
        for name, width in level:
            draw = mix(name ^ 0x9E3779B97F4A7C15)
            key = -math.log((float(draw >> 11) + 1.0) / 2.0**53) / min(width, P.WIDEST)
            best[draw % 64] = min(best.get(draw % 64, (math.inf, 0)), (key, max(mix(name) & 0xFFFF, 1)))
    return "".join(f"{best.get(b, (0, 0))[1]:04x}" for b in range(64))


def alike(a, b):
    bins = [(a[i:i + 4], b[i:i + 4]) for i in range(0, 256, 4)]
    filled = [x for x in bins if x != ("0000", "0000")]
    return sum(x == y for x, y in filled) / len(filled) if filled else 1.0


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        q = len(t) // 4
        edited = t[:len(t) - q] + u[:q]
        a, b = brute(t), brute(edited)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, alike(a, b), alike(a, brute(u))))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000 and doc_id % 3 = 0")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = expected(rows)
    assert len(rows) > 20 and rows_of(with_neighbours(docs)) == want
    assert sorted((r.doc_id, r.fingerprint) for r in fingerprints(docs).collect()) == sorted((w[0], w[3]) for w in want)
    assert rows_of(with_neighbours(docs.repartition(7))) == want


def test_batches_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(P, "BATCH_CHARS", 700)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 2000 and doc_id % 4 = 1")
    assert rows_of(with_neighbours(docs)) == expected([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_odd_rows(spark, odd, nothing):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    short = odd.where("text is null or length(text) < 10000")
    assert rows_of(with_neighbours(short)) == expected([tuple(r) for r in short.select("doc_id", "text").collect()])
    got = {(r.doc_id, r.n_chars): r for r in with_neighbours(odd).collect()}
    assert len(got) == len({(i, len(t or "")) for i, t in rows}) and got[4, 300000].fingerprint == written(sketches(["word " * 60_000]))[0]
    assert got[2, 0].fingerprint == "0" * 256
    assert with_neighbours(nothing).collect() == [] and fingerprints(nothing).collect() == []


def test_one_document_is_its_own_next(spark):
    (r,) = with_neighbours(spark.createDataFrame([(5, "abcdefgh")], "doc_id bigint, text string")).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and r.near_next == 1.0


@pytest.mark.parametrize("shift", [1, 2, 3, 17, 101])
def test_equal_substrings_share_interior_names(shift):
    rnd = random.Random(shift)
    shared = "".join(rnd.choices("abcdefghij klmnop", k=4000))
    one, two = "".join(rnd.choices("xyz", k=50)) + shared, "".join(rnd.choices("uvw", k=50 + shift)) + shared + "rest"
    for level, (a, b) in enumerate(zip(brute_levels(one)[:4], brute_levels(two)[:4])):
        kept = {n for n, _ in a} & {n for n, _ in b}
        outside = sum(n not in kept for n, _ in a)
        assert outside <= 60 / 2**level + 14         # the prefix and a few phrases at its border


def test_texts_parsed_together_do_not_touch():
    rnd = random.Random(9)
    many = ["", "a", "aa", "ab" * 40, "a" * 999, "\U0001f600é\x00"] + ["".join(rnd.choices("ab c", k=rnd.randint(0, 60))) for _ in range(200)]
    assert written(sketches(many)) == [brute(t) for t in many]


def test_edits_stay_near_and_others_far(spark):
    rows = q_fingerprints(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts)
    nexts = dict(zip(ids, ids[1:] + ids[:1]))
    other = [r for r in rows if r.near_next < 0.3]
    assert len(rows) == len(texts) and len(other) > 0.9 * len(rows)
    assert all(r.near_edited > r.near_next for r in other if r.n_chars >= 16 and texts[r.doc_id] != texts[nexts[r.doc_id]])
    assert sum(r.near_edited for r in rows) / len(rows) > 0.5
    by_text = {}
    for r in rows:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_native_likeness(spark):
    rows = q_fingerprints(spark, SF).select("fingerprint", "edited_fingerprint", "near_edited", similarity("fingerprint", "edited_fingerprint").alias("s"))
    assert rows.where(F.abs(F.col("s") - F.col("near_edited")) > 1e-12).count() == 0 and rows.count() > 0


def test_likeness_of_empty_texts():
    assert likeness(sketches([""]), sketches([""])).tolist() == [1.0] and likeness(sketches([""]), sketches(["abc"])).tolist() == [0.0]
