"""Byte-level BPE by corpus-level merge replay, and decoding.

A block of documents (an Arrow batch of a Spark partition) is one corpus: its
distinct pattern matches are laid out in one array of tokens, an inverted index
maps each mergeable pair to the positions where it stands, and merges are
applied in rank order, each to all its positions at once, touching only the
neighbours of what it merges. Short matches, nearly all, are laid out by their
length and replayed in rounds of array operations, each of which applies the
next merge of all of them. Matches are independent of one another, so the
result equals a merge loop over each match alone, at one heap step per distinct
pair, or one round, instead of one scan per match and merge.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gleaner.llm.common import text_of, worker_state

MAX_CACHED = 400_000         # matches remembered by a Python worker between batches
SHORT = 32                   # bytes of a match whose merges are replayed in rounds
NONE = 1 << 62               # no rank: above all


class Vocabulary:
    """Ranks of a byte-level BPE: ``tokens[id]`` is the token's bytes."""

    mergeable: tuple[np.ndarray, np.ndarray] | None = None      # made when first asked for, as are the bytes by id
    bytes_of: pa.Array | None = None

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.of_byte = [self.ranks.get(bytes([b]), -1) for b in range(256)]
        self.pairs: dict[int, int] = {}       # left << 32 | right -> merged id, or -1
        self.cache: dict[str, bytes] = {}     # match -> little-endian ids

    def merged(self, left: int, right: int) -> int:
        key = left << 32 | right
        got = self.pairs.get(key)
        if got is None:
            got = self.pairs[key] = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
        return got

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word, all merges replayed over the words together."""
        token: list[int] = []
        heads: list[int] = []
        for w in words:
            heads.append(len(token))
            token.extend([self.of_byte[b] for b in w])
        size = len(token)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        for head in heads:            # no links across words
            if head:
                after[head - 1] = -1
            if head < size:
                before[head] = -1
        if size:
            after[size - 1] = -1
        merged, index = self.merged, {}
        for i in range(size):
            j = after[i]
            if j >= 0 and (r := merged(token[i], token[j])) >= 0:
                index.setdefault(r, []).append(i)
        heap = list(index)
        heapify(heap)
        while heap:
            rank = heappop(heap)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()             # leftmost first inside a word
            for k, i in enumerate(places):
                j = after[i]
                if j < 0 or token[i] < 0 or merged(token[i], token[j]) != rank:
                    continue          # a neighbour was merged away meanwhile
                token[i], token[j] = rank, -1
                right = after[i] = after[j]
                left, lower = before[i], False
                if right >= 0:
                    before[right] = i
                    if (r := merged(rank, token[right])) >= 0:
                        if r not in index:
                            heappush(heap, r)
                        index.setdefault(r, []).append(i)
                        lower = r < rank
                if left >= 0 and (r := merged(token[left], rank)) >= 0:
                    if r not in index:
                        heappush(heap, r)
                    index.setdefault(r, []).append(left)
                    lower |= r < rank
                if lower:             # that pair comes first, then the rest of this one
                    if rest := places[k + 1:]:
                        if rank not in index:
                            heappush(heap, rank)
                        index.setdefault(rank, []).extend(rest)
                    break
        out = []
        for head, w in zip(heads, words):
            ids, i = [], head if w else -1
            while i >= 0:
                ids.append(token[i])
                i = after[i]
            out.append(ids)
        return out

    def merges(self) -> tuple[np.ndarray, np.ndarray]:
        """(left << 32 | right, merged id) of every mergeable pair, by key."""
        if self.mergeable is None:
            got = {}
            for t, i in self.ranks.items():
                for cut in range(1, len(t)):
                    left, right = self.ranks.get(t[:cut]), self.ranks.get(t[cut:])
                    if left is not None and right is not None:
                        got[left << 32 | right] = i
            keys = np.fromiter(got, np.int64, len(got))
            order = np.argsort(keys)
            self.mergeable = np.append(keys[order], NONE), np.append(np.fromiter(got.values(), np.int64, len(got))[order], NONE)
        return self.mergeable

    def merged_all(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``merged`` of many pairs, with NONE where nothing is merged or a token is -1."""
        keys, ids = self.merges()
        asked = left << 32 | right
        at = np.searchsorted(keys, asked)
        return np.where(keys[at] == asked, ids[at], NONE)

    def replay_rounds(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many of each word) of words of one length, a row of bytes each.

        As ``replay``, with the index kept as the rank of the pair that starts
        at each place: a round merges the pair of lowest rank, the leftmost of
        them, in every word that has one.
        """
        count, width = words.shape
        none = width                                  # a column beyond the word ends its links
        token = np.full((count, width + 1), -1, np.int64)
        token[:, :none] = np.array(self.of_byte)[words]
        after, before = (np.tile(np.clip(np.arange(width + 1) + d, -1, none), (count, 1)) for d in (1, -1))
        before[:, 0] = none
        rank = np.full((count, width + 1), NONE)
        rank[:, :none] = self.merged_all(token[:, :-1], token[:, 1:])
        alive = np.ones((count, width), bool)
        todo, lowest = np.arange(count), rank
        while len(todo):
            i = lowest.argmin(axis=1)
            best = lowest[np.arange(len(todo)), i]
            more = best < NONE
            todo, i, best = todo[more], i[more], best[more]
            j = after[todo, i]
            right, left = after[todo, j], before[todo, i]
            token[todo, i], alive[todo, j], rank[todo, j] = best, False, NONE
            after[todo, i], before[todo, right] = right, i
            rank[todo, i] = self.merged_all(best, token[todo, right])
            rank[todo, left] = self.merged_all(token[todo, left], best)
            lowest = rank[todo]
        return token[:, :none][alive], alive.sum(axis=1)

    def encode_matches(self, words: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each word; only long words go through the index."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(sizes[order])) + 1):
            if not len(group) or not 0 < (size := int(sizes[group[0]])) <= SHORT:
                continue
            own = group.tolist()
            raw = np.frombuffer(b"".join([words[k] for k in own]), np.uint8).reshape(-1, size)
            ids, many = self.replay_rounds(raw)
            ids, ends = ids.astype("<u4").tobytes(), np.cumsum(4 * many).tolist()
            for k, at, end in zip(own, [0, *ends], ends):
                out[k] = ids[at:end]
        long = np.flatnonzero(sizes > SHORT).tolist()
        for k, ids in zip(long, self.replay([words[k] for k in long])):
            out[k] = packed(ids)
        return out

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split, cache = self.split, self.cache
        if len(cache) > MAX_CACHED:
            cache.clear()
            self.pairs.clear()
        pieces = [split(t) for t in texts]
        fresh = set().union(*pieces).difference(cache)
        loose = []
        for p in fresh:
            whole = self.ranks.get(p.encode())
            if whole is None:
                loose.append(p)
            else:                     # a match that is a token needs no merges
                cache[p] = whole.to_bytes(4, "little")
        cache.update(zip(loose, self.encode_matches([p.encode() for p in loose])))
        return [b"".join([cache[p] for p in ps]) for ps in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join([self.tokens[i] for i in unpacked(ids)])

    def decode_block(self, ids: list[bytes]) -> pa.Array:
        """The bytes of each text's ids, all looked up at once."""
        if self.bytes_of is None:
            self.bytes_of = pa.array([self.tokens.get(i) for i in range(max(self.tokens) + 1)], pa.binary())
        ends = np.append(0, np.cumsum([len(x) // 4 for x in ids], dtype=np.int64))
        if not ends[-1]:
            return pa.array([b""] * len(ids), pa.binary())
        whole = self.bytes_of.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        offsets = np.frombuffer(whole.buffers()[1], np.int32)[ends]
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets.tobytes()), whole.buffers()[2]])


def packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if LITTLE is False:
        out.byteswap()
    return out.tobytes()


def unpacked(ids: bytes) -> array:
    out = array("I")
    out.frombytes(ids)
    if LITTLE is False:
        out.byteswap()
    return out


LITTLE = array("I", [1]).tobytes()[0] == 1


def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Loaded once per Python worker; the matches it remembers serve the worker's later tasks."""
    loaded = worker_state("byte-level BPE")
    if (path, pattern) not in loaded:
        loaded[path, pattern] = Vocabulary(path, pattern)
    return loaded[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, block_chars: int = 4_000_000) -> DataFrame:
    """doc_id, n_tokens and the ids (little-endian uint32) of every row, with their decoding.

    Row by row: a null or empty text has no tokens (digests of no bytes),
    repeated rows and null ids pass through, an empty table gives no rows,
    extra columns are not read. Blocks hold about ``block_chars`` characters
    at least one whole text each, whatever the Arrow batch size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for batch in batches:
            docs_, texts = batch.column(0), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars < block_chars):
                    chars += len(texts[to])
                    to += 1
                ids = vocab.encode_block(texts[at:to])
                yield pa.RecordBatch.from_arrays(
                    [docs_.slice(at, to - at), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), vocab.decode_block(ids)],
                    names=["doc_id", "n_tokens", "ids", "decoded"])
                at = to

    return text_of(docs).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary, decoded binary")


def q_bpe(spark, sf_dir) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
