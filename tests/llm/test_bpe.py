import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm.bpe import Vocabulary, encode_documents, packed, q_bpe, unpacked
from tests.llm.conftest import SF, pairs

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCAB = Vocabulary(PATH, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCAB.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_block_equals_library(texts):
    got = VOCAB.encode_block(texts)
    assert [list(unpacked(x)) for x in got] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [VOCAB.decode(x).decode() for x in got] == texts


@pytest.mark.parametrize("text", ["aaaaaaaaaaaaaaaaa", "abababababab" * 30, " " * 70 + "x", "\x1c\x1d a\x85b  c 　d", "'s'S're x'll"])
def test_runs_and_white_space(text):
    VOCAB.cache.clear()
    assert list(unpacked(VOCAB.encode_block([text])[0])) == LIBRARY.encode_ordinary(text)


def test_lower_rank_made_by_a_merge():
    # merging (b, c) makes the pair (a, bc), which outranks the second (b, c)
    v = Vocabulary.__new__(Vocabulary)
    v.ranks = {b"abc": 0, b"a": 1, b"b": 2, b"c": 3, b"bc": 4, b"bcb": 5, b"abcb": 6}
    v.tokens = {i: t for t, i in v.ranks.items()}
    v.of_byte, v.pairs, v.cache = [v.ranks.get(bytes([b]), -1) for b in range(256)], {}, {}

    def alone(word):
        parts = [bytes([b]) for b in word]
        while True:
            best = min(((v.ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in v.ranks), default=None)
            if best is None:
                return [v.ranks[p] for p in parts]
            parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    words = [b"abc", b"bcabc", b"abcbc", b"bcbc", b"abcabcbcb", b"b", b""]
    assert v.replay(words) == [alone(w) for w in words]


def same(df, block=4_000_000):
    got = sorted((str(r.doc_id), r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in
                 encode_documents(df, PATH, public_tokenizers.PATTERN, block).collect())
    want = []
    for i, t in pairs(df):
        ids = LIBRARY.encode_ordinary(t)
        want.append((str(i), len(ids), packed(ids), t.encode()))
    assert got == sorted(want)


def test_documents(documents):
    same(documents, 50_000)


def test_odd_rows(odd, nothing):
    same(odd)
    assert encode_documents(nothing, PATH, public_tokenizers.PATTERN).collect() == []


def test_query(spark, documents):
    texts = {i: t for i, t in pairs(documents)}
    for r in q_bpe(spark, SF).collect():
        ids = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.binary(max_size=40), st.text("aeinrst ", max_size=40).map(str.encode)), max_size=12))
def test_rounds_equal_the_index(words):
    assert [list(unpacked(x)) for x in VOCAB.encode_matches(words)] == VOCAB.replay(words)


def test_only_long_matches_go_through_the_index(monkeypatch):
    v, asked = Vocabulary(PATH, public_tokenizers.PATTERN), []
    replay = v.replay
    monkeypatch.setattr(v, "replay", lambda words: asked.extend(words) or replay(words))
    texts = ["unbelievableness " * 3 + "x" * 31, "q" * 33 + " zzäh", "", "straw"]
    ids = v.encode_block(texts)
    assert asked == [b"q" * 33]
    assert [list(unpacked(x)) for x in ids] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert v.decode_block(ids).to_pylist() == [t.encode() for t in texts]
    assert v.decode_block([]).to_pylist() == [] and v.decode_block([b"", b""]).to_pylist() == [b"", b""]
