import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from gleaner.llm import collocation as K
from gleaner.llm.collocation import ORACLE, collocations, cuts, dictionary, mine, phrase_counts, q_collocations
from tests.llm.conftest import SF

ENGLISH = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts_of(rows):
    """f of every phrase, and the words of each language."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ENGLISH)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    return f, n


def brute(rows, least=30, top=2000):
    f, n = counts_of(rows)
    out = []
    cands = {k: a for k, a in f.items() if len(k[1]) >= 2 and a >= least}
    within = Counter()
    for (lang, w), a in cands.items():
        for m in range(2, len(w)):
            for s in range(len(w) - m + 1):
                within[lang, w[s:s + m]] = max(within[lang, w[s:s + m]], a)
    for lang in n:
        own = []
        for (g, w), a in cands.items():
            if g == lang and not 100 * within[g, w] >= 80 * a:
                score, _, l, r = min((2000000 * a // (f[g, w[:k]] + f[g, w[k:]]), k, f[g, w[:k]], f[g, w[k:]]) for k in range(1, len(w)))
                own.append((-score, -a, " ".join(w).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g) for i, (g, t) in enumerate(rows)], "doc_id bigint, text string, lang string")


def some_texts(seed, n, vocabulary=25):
    rnd = random.Random(seed)
    words = ["Été", "A", "b", "C3", "d\xa0e", "f", "漢字", "'s", "-"] + [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(len(words))]
    seps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", ";", "?!", "\x0b", "\r\n"]
    return [(rnd.choice(["en", "en", "fr", None]),
             "".join(w + rnd.choice(seps) for w in rnd.choices(words, weights, k=rnd.randint(0, 90)))) for _ in range(n)]


@pytest.mark.parametrize("trigger", [1, 3, 1000])
def test_every_occurrence_is_counted_once(spark, monkeypatch, trigger):
    rows = some_texts(1, 120)
    f, n = counts_of(rows)
    got = {(r.lang, r.phrase): r.f for r in phrase_counts(frame(spark, rows), least=3, trigger=trigger).collect() if r.n}
    assert got == {(g, " ".join(w)): a for (g, w), a in f.items() if a >= 3}


def test_brute_force(spark):
    rows = some_texts(2, 800, 12)
    want = brute(rows)
    assert len(want) > 100 and {len(r[2].split(" ")) for r in want} == {2, 3, 4}
    assert sorted(map(tuple, mine(frame(spark, rows)).collect())) == want
    counts = phrase_counts(frame(spark, rows))
    assert sorted(map(tuple, collocations(counts, top=7).collect())) == brute(rows, top=7)


def test_chunks_overlap_by_a_window_and_bodies_part_the_text(spark):
    rnd = np.random.default_rng(3)
    hashes, lengths = rnd.integers(0, 50, 5000).astype(np.uint64), np.array([1, 2, 3, 4, 990, 4000])
    starts, ends, bodies = cuts(hashes, lengths, 7)
    assert bodies.sum() == 5000 and (starts[1:] == (starts + bodies)[:-1]).all()
    piece_end = np.cumsum(lengths)[np.searchsorted(np.cumsum(lengths), starts, side="right")]
    assert (ends == np.minimum(starts + bodies + 3, piece_end)).all() and len(starts) > 300


def test_equal_passages_share_chunks(spark):
    rnd = random.Random(4)
    passage = " ".join(rnd.choices([f"w{i}" for i in range(400)], k=600))
    texts = [("en", " ".join(rnd.choices([f"v{i}" for i in range(400)], k=k)) + " " + passage) for k in (0, 5, 17, 40)]
    shared = [r for r in dictionary(frame(spark, texts)).collect() if r.freq == 4]
    assert sum(r.body for r in shared) > 540


def test_wide_products(spark):
    big = 9_000_000_000_000
    rows = [(1, "en", "x", big), (1, "en", "y", big), (2, "en", "x y", big - 7), (0, "en", "", 4 * big)]
    got = collocations(spark.createDataFrame(rows, "n int, lang string, phrase string, f bigint")).collect()
    assert [(r.a, r.score) for r in got] == [(big - 7, 2000000 * (big - 7) // (2 * big))]


def test_odd_rows(spark, odd, nothing):
    rows = [(r.lang, r.text) for r in odd.select("lang", "text").collect()]
    assert sorted(map(tuple, mine(odd).collect())) == brute(rows)
    assert mine(nothing).collect() == []


def test_given_table_and_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = con.execute("SELECT lang, text FROM documents").fetchall()
    want = brute(rows)
    assert sorted(con.execute(ORACLE).fetchall()) == want
    assert sorted(map(tuple, q_collocations(spark, SF).collect())) == want
