"""Phrase collocation mining by prefix-free parsing.

A piece of text (a stretch without ``.,;:!?`` or line ends) is parsed into
chunks where its content says so: a chunk starts at the piece's start and at
every window of three words whose hash is divisible by ``TRIGGER``, and runs on
to the end of the next such window. Equal stretches are therefore cut alike
wherever they stand, and the corpus becomes a dictionary of distinct chunks
with their frequencies in the parse. Neighbouring chunks share exactly the
three words of a window, and a phrase of up to four words that starts in front
of a window ends inside it; so every occurrence is counted in one chunk, the
one whose body (the words before the next window) it starts in, weighted by the
chunk's frequency.

Scale. Counts are exact, and no table of phrases is broadcast. The dictionary is
written once, in blocks of chunks whose words are numbers. A phrase that occurs
often consists of shorter ones that do, so the blocks are read four times: words;
64-bit hashes of the pairs of words that may be frequent; pairs that may be, and
hashes of triples made of such pairs; triples that may be, and quadruples made
of them. What may be frequent is told by a bit table of a fixed size, which only
ever lets too much through: on a corpus far larger than the table was sized for,
more is shuffled and the result is the same. A block adds up its own phrases by
exact keys before anything is shuffled, so a phrase that is everywhere moves
once per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import drop_scratch, spark_read, write_scratch
from gleaner.llm.lm import planes, unplanes

LONGEST = 4                  # words of a phrase
OVERLAP = LONGEST - 1        # words of a trigger window
TRIGGER = 12                 # one window in so many starts a chunk
LEAST = 30                   # occurrences of a candidate
TOP = 2000                   # phrases reported for each language
BLOCK_BYTES = 8_000_000      # of chunks in a block of the dictionary
TEXT_BYTES = 16_000_000      # parsed together; one text may be longer
TABLE_BITS = 26              # log2 of the bits that tell what may be frequent: 8 MB

BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
MULTIPLY, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)


def mix(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> SHIFT)) * MULTIPLY
    return a ^ (a >> SHIFT)


def pieces_of(texts: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of all pieces end to end, A-Z lower-cased, and the number of words of each piece that has any."""
    pieces = pc.split_pattern(pa.array([texts.lower().translate(BREAKS)], pa.binary()), b"\n").flatten()
    split = pc.ascii_split_whitespace(pieces.view(pa.string()))
    words = split.flatten().view(pa.binary())
    there = pc.binary_length(words).to_numpy() > 0          # blanks at a piece's ends leave empty words
    ends = np.concatenate([[0], np.cumsum(there)])[split.offsets.to_numpy()]
    lengths = np.diff(ends)
    return words.filter(pa.array(there)), lengths[lengths > 0]


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words as numbers, and the distinct words."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def hashed_words(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words.to_pylist()), np.uint64, len(words))


def joined(words: pa.Array, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The stretches of ``lengths`` words from ``starts`` on, as text with spaces."""
    ends = np.cumsum(lengths)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words.take(pa.array(ids[at]))), b" ")


def spans(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position of its stretch and one past its last, for every position of stretches laid end to end."""
    ends = np.cumsum(lengths)
    return np.repeat(ends - lengths, lengths), np.repeat(ends, lengths)


# --- the parse -----------------------------------------------------------------

def cuts(hashes: np.ndarray, lengths: np.ndarray, trigger: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and body length of every chunk of pieces laid end to end."""
    first, end = spans(lengths)
    at = np.arange(len(hashes))
    h = np.concatenate([hashes, np.zeros(OVERLAP, np.uint64)])
    window = hashes.copy()
    for k in range(1, OVERLAP):
        window = mix(window) + h[k:k + len(hashes)]
    starts = np.flatnonzero((at == first) | ((at + OVERLAP <= end) & (mix(window) % np.uint64(trigger) == 0)))
    bodies = np.diff(starts, append=len(hashes))
    return starts, np.minimum(starts + bodies + OVERLAP, end[starts]), bodies


def dictionary(docs: DataFrame, trigger: int = TRIGGER) -> DataFrame:
    """(lang, chunk, body, freq): the distinct chunks of each language and how often the parse has them."""
    out = pa.schema([("lang", pa.string()), ("chunk", pa.binary()), ("body", pa.int32()), ("freq", pa.int64())])

    def parsed(lang: str, texts: list[bytes]) -> pa.Table:
        words, lengths = pieces_of(b"\n".join(texts))
        ids, distinct = numbered(words)
        starts, ends, bodies = cuts(hashed_words(distinct)[ids], lengths, trigger)
        chunks = pa.table({"chunk": joined(distinct, ids, starts, ends - starts), "body": pa.array(bodies.astype(np.int32))})
        counts = chunks.group_by(["chunk", "body"]).aggregate([([], "count_all")])
        return pa.table([pa.repeat(pa.scalar(lang), counts.num_rows), counts["chunk"], counts["body"], counts["count_all"]], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                size += len(text)
                if size >= TEXT_BYTES:
                    for item in held.items():
                        yield from parsed(*item).to_batches()
                    held, size = {}, 0
        for item in held.items():
            yield from parsed(*item).to_batches()

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = texts.mapInArrow(run, "lang string, chunk binary, body int, freq bigint")
    return found.groupBy("lang", "chunk", "body").agg(F.sum("freq").alias("freq"))


# --- counts in the dictionary ----------------------------------------------------

BLOCK = ["langs", "words", "lang", "ids", "lengths", "bodies", "freqs"]


def blocks(chunks: DataFrame) -> DataFrame:
    """The dictionary in blocks of about BLOCK_BYTES: chunks laid end to end, words and languages as numbers."""
    out = pa.schema([("langs", pa.list_(pa.string())), *((c, pa.binary()) for c in BLOCK[1:])])

    def pack(held: pa.Table) -> pa.RecordBatch:
        lang, langs = numbered(held["lang"].combine_chunks())
        split = pc.split_pattern(held["chunk"].combine_chunks(), b" ")
        ids, words = numbered(split.flatten())
        numbers = (lang, ids, np.diff(split.offsets.to_numpy()), held["body"].to_numpy(), held["freq"].to_numpy())
        row = ([langs.to_pylist()], [b" ".join(words.to_pylist())], *([planes(n)] for n in numbers))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, out)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += pc.sum(pc.binary_length(batch.column("chunk"))).as_py()
            if size >= BLOCK_BYTES:
                yield pack(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield pack(pa.Table.from_batches(held))

    return chunks.select("lang", "chunk", "body", "freq").mapInArrow(
        run, "langs array<string>, words binary, lang binary, ids binary, lengths binary, bodies binary, freqs binary")


class Block:
    """Chunks laid end to end, with exact keys and hashes of the phrases that start in their bodies."""

    def __init__(self, langs, words, lang, ids, lengths, bodies, freqs):
        lengths = unplanes(lengths, "<i4").astype(np.int64)
        ids = unplanes(ids, "<i4").astype(np.int64)
        self.langs, self.words = langs, pc.split_pattern(pa.array([words], pa.binary()), b" ").flatten()
        first, self.end = spans(lengths)
        self.at = np.arange(len(ids))
        self.inside = self.at - first < np.repeat(unplanes(bodies, "<i4"), lengths)
        self.freq = np.repeat(unplanes(freqs, "<i8"), lengths)
        self.lang = np.repeat(unplanes(lang, "<i4").astype(np.int64), lengths)
        self.ids = np.concatenate([ids, np.zeros(LONGEST, np.int64)])
        seeds = np.array([xxhash.xxh64_intdigest(x.encode(), seed=1) for x in self.langs], np.uint64)
        self.word_hash = hashed_words(self.words)[self.ids]
        self.seed = seeds[self.lang]

    def hashes(self, n: int) -> np.ndarray:
        """Of the ``n`` words from every position on (those that run past a chunk's end mean nothing)."""
        h = self.seed
        for k in range(n):
            h = mix(h + self.word_hash[k:k + len(self.at)])
        return h

    def starting(self, n: int) -> np.ndarray:
        """Whether a phrase of ``n`` words to count here starts at each position."""
        return self.inside & (self.at + n <= self.end)

    def phrases(self, n: int, chosen: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Language, words and weighted count of the distinct phrases among those at ``chosen``."""
        key = self.lang[chosen]
        for k in range(n):
            key = key * len(self.words) + self.ids[chosen + k]
            if k < n - 1:
                key = np.unique(key, return_inverse=True)[1]
        order, starts, totals = added_up(key, self.freq[chosen])
        at = chosen[order[starts]]
        return (pa.array(self.langs, pa.string()).take(pa.array(self.lang[at])),
                joined(self.words, self.ids, at, np.full(len(at), n)), totals)


def added_up(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A sorting order of the keys, where each distinct key starts in it, and the sum of its values."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return order, starts, np.add.reduceat(values[order], starts) if len(keys) else np.zeros(0, np.int64)


def may_be(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set: true for all in the table, and for a few more."""
    mask = np.uint64((1 << TABLE_BITS) - 1)
    found = np.ones(len(h), bool)
    for bits in (h, h >> np.uint64(TABLE_BITS)):
        at = bits & mask
        found &= (table[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


def bit_table(frequent: DataFrame):
    """The fixed-size table of the hashes ``h``, made by the executors and broadcast: at most 2^20 rows reach the driver."""
    mask = F.lit((1 << TABLE_BITS) - 1).cast("bigint")
    bits = frequent.select(F.explode(F.array(F.col("h").bitwiseAND(mask), F.shiftrightunsigned("h", TABLE_BITS).bitwiseAND(mask))).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    rows = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(table.tobytes())


def counted(packed: DataFrame, strings: list[int], hashed: int = 0, table=None, least: int = LEAST) -> DataFrame:
    """(n, lang, phrase, h, f) with f >= ``least``: phrases of the lengths ``strings`` and hashes of those of ``hashed`` words.

    With a ``table`` of the hashes of frequent phrases of some length, a phrase
    counts only if it may be frequent: if the table has it, or all its parts of
    that length; the length is the least of ``strings``, or one less than
    ``hashed``. Without, rows of n = 0 hold the words of each language.
    """
    size = min(strings, default=hashed - 1)
    out = pa.schema([("n", pa.int32()), ("lang", pa.string()), ("phrase", pa.binary()), ("h", pa.int64()), ("f", pa.int64())])

    def count(block: Block, bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        hit = None if bits is None else np.concatenate([may_be(block.hashes(size), bits), np.zeros(LONGEST, bool)])

        def chosen(n: int) -> np.ndarray:
            ok = block.starting(n)
            if hit is not None:
                for k in range(n - size + 1):
                    ok = ok & hit[k:k + len(ok)]
            return np.flatnonzero(ok)

        def rows(n: int, lang: pa.Array, phrase: pa.Array, f: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(f), n, np.int32)), lang, phrase, pa.nulls(len(f), pa.int64()), pa.array(f)], schema=out)

        for n in strings:
            yield rows(n, *block.phrases(n, chosen(n)))
        if bits is None:
            order, starts, totals = added_up(block.lang, np.where(block.inside, block.freq, 0))
            yield rows(0, pa.array(block.langs, pa.string()).take(pa.array(block.lang[order[starts]])), pa.array([b""] * len(totals), pa.binary()), totals)
        if hashed:
            at = chosen(hashed)
            h = block.hashes(hashed)[at]
            order, starts, totals = added_up(h, block.freq[at])
            h = h[order[starts]]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), hashed, np.int32)), pa.nulls(len(h), pa.string()),
                                              pa.nulls(len(h), pa.binary()), pa.array(h.view(np.int64)), pa.array(totals)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if table is None else np.frombuffer(table.value, np.uint64)
        for batch in batches:
            for i in range(batch.num_rows):
                yield from count(Block(*(batch.column(c)[i].as_py() for c in BLOCK)), bits)

    found = packed.mapInArrow(run, "n int, lang string, phrase binary, h bigint, f bigint")
    return found.groupBy("n", "lang", "phrase", "h").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("n") == 0))


def hashes_of(words: DataFrame) -> DataFrame:
    """The hash of each counted word, as a block has it for one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = [xxhash.xxh64_intdigest(x.encode(), seed=1) for x in batch.column(0).to_pylist()]
            known = [xxhash.xxh64_intdigest(w) for w in batch.column(1).to_pylist()]
            h = mix(np.array(seeds, np.uint64) + np.array(known, np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return words.select("lang", "phrase").mapInArrow(run, "h bigint")


def phrase_counts(docs: DataFrame, least: int = LEAST, trigger: int = TRIGGER) -> DataFrame:
    """(n, lang, phrase, f): every phrase of 1 to 4 words with f >= ``least``, and each language's number of words as n = 0."""
    spark, scratch, tables = docs.sparkSession, [], []

    def keep(df: DataFrame, name: str) -> DataFrame:
        scratch.append(write_scratch(df, name))
        return spark_read(spark, scratch[-1], df)

    def table(hashes: DataFrame):
        tables.append(bit_table(hashes))
        return tables[-1]

    packed = keep(blocks(dictionary(docs, trigger)), "phrase-blocks")
    ones = keep(counted(packed, [1], least=least), "phrase-words")
    pairs = keep(counted(packed, [], 2, table(hashes_of(ones.where("n = 1"))), least), "phrase-pair-hashes")
    twos = keep(counted(packed, [2], 3, table(pairs), least), "phrase-pairs")
    more = counted(packed, [3, 4], 0, table(twos.where("h is not null")), least)
    every = ones.unionByName(twos).unionByName(more).where("h is null").select("n", "lang", F.col("phrase").cast("string").alias("phrase"), "f")
    path = write_scratch(every, "phrase-counts")
    for p in scratch:
        drop_scratch(spark, p)
    for t in tables:
        t.destroy()
    return spark_read(spark, path, every)


# --- scores ----------------------------------------------------------------------

def exact(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def words(c: str, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.col(c), start, n), " ")


def collocations(counts: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases of 2 to 4 words by their lowest-scoring cut.

    A candidate goes if a longer one that holds it occurs at least 0.8 times as
    often. Ties stand by count, then by the phrase's UTF-8 bytes. Scores are
    whole numbers computed in decimals of 38 digits.
    """
    parts = counts.where("n between 1 and 3").select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    found = counts.where((F.col("n") >= 2) & (F.col("f") >= least)).select("lang", "n", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cut = found.select("*", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", words("w", F.lit(1), F.col("k")).alias("left"),
        words("w", F.col("k") + 1, F.col("n") - F.col("k")).alias("right"))
    left = parts.select("lang", F.col("part").alias("left"), F.col("part_f").alias("l"))
    right = parts.select("lang", F.col("part").alias("right"), F.col("part_f").alias("r"))
    both = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("sum", exact("l") + exact("r")).withColumn("big", exact("a") * 2000000)
    scored = both.withColumn("score", F.expr("big div sum"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min_by(F.struct("score", "l", "r"), F.struct("score", "k")).alias("cut"))

    longer = found.where("n >= 3").select("lang", "n", "w", "a", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("m"))
    inner = longer.select("lang", "a", "m", "w", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("m") + 1)).alias("s"))
    held = inner.select("lang", words("w", F.col("s"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = lowest.join(held, ["lang", "phrase"], "left").where(
        F.col("within").isNull() | (exact("within") * 100 < exact("a") * 80))

    totals = counts.where("n = 0").select("lang", F.col("f").alias("total"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    ranked = ranked.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
                                              F.col("total").alias("n"), "score")


def mine(docs: DataFrame) -> DataFrame:
    """Collocations of the texts, per language.

    Null and empty texts have no words, a null language is ``und``; repeated
    rows count as often as they stand; no rows give none; other columns are not
    read, and a text of any length is parsed whole.
    """
    return collocations(phrase_counts(docs))


def q_collocations(spark, sf_dir) -> DataFrame:
    return mine(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w, count(*) AS c FROM pieces GROUP BY ALL),
grams AS (
  SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase, CAST(sum(c) AS BIGINT) AS f
  FROM (SELECT lang, w, c, n, unnest(range(1, len(w) - n + 2)) AS i FROM worded, range(1, 5) t(n) WHERE len(w) >= n)
  GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS total FROM grams WHERE n = 1 GROUP BY lang),
candidates AS (SELECT lang, n, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE n >= 2 AND f >= 30),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:n], ' ') AS rest
  FROM (SELECT *, unnest(range(1, n)) AS k FROM candidates)),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) + y.f) AS score
  FROM cut c JOIN grams x ON x.lang = c.lang AND x.phrase = c.first JOIN grams y ON y.lang = c.lang AND y.phrase = c.rest
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY (CAST(2000000 AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) + y.f), k) = 1),
held AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS within
  FROM (SELECT *, unnest(range(1, n - m + 2)) AS s FROM (SELECT *, unnest(range(2, n)) AS m FROM candidates WHERE n >= 3))
  GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN held h ON h.lang = s.lang AND h.phrase = s.phrase
  WHERE h.within IS NULL OR CAST(100 AS HUGEINT) * h.within < CAST(80 AS HUGEINT) * a)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, total AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
