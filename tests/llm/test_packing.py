import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gleaner.llm.packing import WordCache, best_pattern, intervals, pack_documents, pieces, q_packing, solve
from tests.llm.conftest import SF, pairs

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CACHE = WordCache(PATH)


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=50), max_size=6))
def test_words_encode_as_texts(texts):
    got = CACHE.encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids_of(t) for t in texts]


@pytest.mark.parametrize("text", ["a <|endoftext|>b<|startoftext|> c", "é ́ Å x\x85y z", "IT'S we'RE 12 3x9 'll",
                                  "İ ΣΣ ẞ", "\x1c \x1d\x00 a"])
def test_words_encode_as_texts_odd(text):
    assert np.frombuffer(CACHE.encode([text.encode()])[0], "<u4").tolist() == ids_of(text)


def test_knapsack_equals_exhaustive_search():
    rnd = random.Random(1)
    for _ in range(60):
        sizes = np.array(sorted(rnd.sample(range(1, 13), rnd.randint(1, 5))))
        value = np.array([rnd.choice([0, -0.5, rnd.random()]) for _ in sizes])
        best = [0.0] * 21
        for r in range(1, 21):
            best[r] = max([best[r - 1]] + [best[r - s] + v for s, v in zip(sizes, value) if s <= r])
        got, chosen = best_pattern(value, sizes, 20)
        assert got == pytest.approx(best[20])
        assert sum(sizes[i] * n for i, n in chosen.items()) <= 20
        assert sum(value[i] * n for i, n in chosen.items()) == pytest.approx(got)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 400), max_size=20))
def test_patterns_hold_the_histogram(histogram):
    patterns = solve(histogram, 32)
    held = Counter()
    for n, parts in patterns:
        assert n > 0 and sum(s * a for s, a in parts) <= 32
        for s, a in parts:
            held[s] += n * a
    assert held == Counter({s: n for s, n in histogram.items() if n})
    by_class = defaultdict(list)
    for size, lo, hi, *_ in intervals(patterns):
        by_class[size].append((lo, hi))
    for size, spans in by_class.items():
        assert [lo for lo, _ in spans] == [0] + [hi for _, hi in spans[:-1]] and spans[-1][1] == histogram[size]


def test_near_the_bound():
    rnd = random.Random(3)
    histogram = Counter(min(512, max(1, int(rnd.lognormvariate(4, 1)))) for _ in range(20_000))
    n = sum(x for x, _ in solve(histogram, 512))
    assert n <= 1.01 * sum(s * c for s, c in histogram.items()) / 512 + 1


def check(df, **how):
    rows = pack_documents(df, PATH, **how).collect()
    capacity = how.get("capacity", 4096)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    want = Counter()
    for i, t in pairs(df):
        ids = [*ids_of(t), 2]
        for lo in range(0, len(ids), capacity):
            part = ids[lo:lo + capacity]
            want[i, lo, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return rows


def test_documents(documents):
    rows = check(documents)
    used = sum(r.length for r in rows)
    assert used / (4096 * len({r.sequence_id for r in rows})) > 0.97
    check(documents, capacity=256, grain=4)


def test_odd_rows(odd, nothing):
    check(odd)
    check(odd.unionByName(odd).repartition(5), capacity=64, grain=2)
    assert pack_documents(nothing, PATH).collect() == []


def test_pieces_carry_their_ids(documents):
    for r in pieces(documents.limit(20), PATH, 2, with_ids=True).collect():
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length


def test_query(spark, documents):
    assert q_packing(spark, SF).select("doc_id").distinct().count() == documents.count()


def test_short_pieces_are_planned_near_their_length(spark):
    """340 pieces of 24 tokens fill two sequences of 170; planned at 32 they would take three."""
    text = "a " * 23
    assert len(ids_of(text)) == 23
    df = spark.createDataFrame([(i, text) for i in range(340)], "doc_id bigint, text string")
    assert pack_documents(df, PATH).select("sequence_id").distinct().count() == 2
