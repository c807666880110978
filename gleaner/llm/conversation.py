"""Conversation structure repair by rank-convergence parallel Viterbi.

A repaired conversation's role initials read ``(s?(ua)+)?``. Its rows are kept
(K, 0), given the role that fits (R, 2), deleted (D, 3) or preceded by inserted
empty turns (I, 2 each); blank and duplicate rows must go, and a truncated row
that stays costs 1 more. The cheapest edits are a shortest path over four
states (nothing yet, after system, after user, after assistant), and of equally
cheap ones the ASCII-least string of initials is wanted, which tracing forward
along backward costs gives.

Scale. A conversation may hold any share of the rows, so none is walked by one
task to be solved: rows, reduced to one code each, are range-partitioned by
conversation and place and cut into chunks. Every chunk computes its backward
costs at once, from true costs at its right end where the conversation ends
there and from speculative ones (all equal) elsewhere. Fix-up passes hand each
chunk its right neighbour's result and rerun it only where that differs from
what it assumed by more than a constant; a constant changes no choice. Costs
forget their start after a few rows, so one or two passes do; in the worst case
(rows whose role fits nowhere, throughout) convergence walks a chunk per pass.
Chunks that only delete pass any vector through and are left out. Tracing links
chunks the same way: where all entry states end in one state, the next chunk
starts at once; the rest follow pass by pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.llm.common import drop_scratch, shuffle_partitions, spark_read, write_scratch

CHUNK_ROWS = 65_536
#: after nothing, system, user, assistant: the state that one more user or assistant turn leads to
NEXT = (2, 2, 3, 2)
#: cost of ending in each state, and the inserts that do it
FINAL, TAIL = (0, 4, 2, 0), ("", "II", "I", "")
ROLE = {2: "user", 3: "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
BLANKS = " \t\n\x0b\x0c\r"
FINE, TRUNCATED, GONE = 0, 1, 2      # fault classes; a row's code is 4 * class + role initial


def row_options(code: int) -> list[list[tuple[str, int, int]]]:
    """For each state the best (letters, cost, next state) for every next state, for a row of this code."""
    fault, initial = divmod(code, 4)
    out = []
    for start in range(4):
        best: dict[int, tuple[int, str]] = {}
        at = start
        for inserts in range(3):
            acts = [("D", 3, at)]
            if fault != GONE:
                acts.append(("R", 2 + fault, NEXT[at]))
                if (initial, at) in ((0, 0), (1, 0), (1, 1), (1, 3), (2, 2)):
                    acts.append(("K", fault, initial + 1))
            for letter, cost, to in acts:
                step = (cost + 2 * inserts, "I" * inserts + letter)
                best[to] = min(best.get(to, step), step)
            at = NEXT[at]
        out.append([(letters, cost, to) for to, (cost, letters) in best.items()])
    return out


OPTIONS = [row_options(code) for code in range(12)]


def backward(codes: bytes, right: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Cost to go from every state before each row, and after the last."""
    vectors = [tuple(right)]
    for code in reversed(codes):
        v = vectors[-1]
        vectors.append(tuple(min(c + v[to] for _, c, to in options) for options in OPTIONS[code]))
    vectors.reverse()
    return vectors


def trace(codes: bytes, vectors: list[tuple[int, ...]], state: int) -> tuple[list[str], int]:
    """The ASCII-least cheapest letters of each row from ``state``, and the state after the last."""
    letters = []
    for i, code in enumerate(codes):
        cost, after = vectors[i][state], vectors[i + 1]
        best, state = min((l, to) for l, c, to in OPTIONS[code][state] if c + after[to] == cost)
        letters.append(best)
    return letters, state


# --- rows ------------------------------------------------------------------------

def key_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it
    (``copies`` 2), 4 sets role user. Nulls read as one space.
    """
    code = F.crc32(F.concat(key_of("conv_id"), F.lit(":"), key_of("turn")).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return conversations.where(code != 0).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(code == 3, 2).otherwise(1).alias("copies"))


def named(rows: DataFrame) -> DataFrame:
    """The rows with their conversation as text (null: a space) and the digest that orders rows of one turn and role."""
    return rows.select(key_of("conv_id").alias("conv"), "conv_id", "turn", "role", "text", "copies",
                       F.unhex(F.sha2("text", 256)).alias("dig"))


def places() -> tuple[Column, ...]:
    return F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("dig")


def runs_of(rows: DataFrame) -> DataFrame:
    """One row per (conversation, turn, role, text): its code, without the text.

    Equal rows of a turn stand next to each other, and all but the first are
    duplicates whatever follows, so they are aggregated before anything else.
    """
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    keys = named(rows).select("conv", "conv_id", "turn", "role", "dig", end.alias("end"))
    runs = keys.groupBy("conv", "conv_id", "turn", "role", "dig", "end").agg(F.lit(1).alias("one")).drop("one")
    firsts = runs.groupBy("conv", "role", "dig").agg(F.max(F.col("turn").isNull()).alias("from_null"), F.min("turn").alias("first"))
    gone = (F.col("end") == "") | ~F.col("turn").eqNullSafe(F.when(~F.col("from_null"), F.col("first")))
    fault = F.when(gone, GONE).when(F.col("end").isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return runs.join(firsts, ["conv", "role", "dig"]).select("conv", "conv_id", "turn", "role", "dig", (4 * fault + kind).alias("code"))


# --- chunks ----------------------------------------------------------------------

CHUNK = pa.schema([("conv", pa.string()), ("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("turn", pa.int64()),
                   ("role", pa.string()), ("dig", pa.binary()), ("codes", pa.binary()), ("free", pa.int64())])
CHUNK_SQL = ("conv string, conv_id bigint, part int, seq bigint, turn bigint, role string, dig binary, codes binary, free bigint")


def table(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def chunks_of(runs: DataFrame, size: int) -> DataFrame:
    """Each range partition's stretch of a conversation, in pieces of at most ``size`` rows: codes and the first row's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, codes, seq = None, bytearray(), 0

        def chunk():
            return (*head[:3], seq, *head[3:], bytes(codes), sum(c < 4 * GONE for c in codes))

        for batch in batches:
            done = []
            for conv, conv_id, part, turn, role, dig, code in zip(*(c.to_pylist() for c in batch.columns)):
                if head is None or head[0] != conv or len(codes) == size:
                    if head is not None:
                        done.append(chunk())
                        seq += 1
                    head, codes = (conv, conv_id, part, turn, role, dig), bytearray()
                codes.append(code)
            yield table(CHUNK, done)
        if head is not None:
            yield table(CHUNK, [chunk()])

    parts = shuffle_partitions(runs.sparkSession)
    ordered = runs.repartitionByRange(parts, *places()).sortWithinPartitions(*places())
    return ordered.select("conv", "conv_id", F.spark_partition_id().alias("part"), "turn", "role", "dig", "code").mapInArrow(run, CHUNK_SQL)


# --- passes ----------------------------------------------------------------------

def level(v: str) -> Column:
    return F.transform(v, lambda x: x - F.col(v)[0])


def solve(chunks: DataFrame) -> DataFrame:
    """The chunks with the letters of each row and, where the conversation ends, the inserts after it."""
    spark = chunks.sparkSession
    scratch: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        scratch.append(write_scratch(df, name))
        return spark_read(spark, scratch[-1], df)

    order = Window.partitionBy("conv").orderBy("part", "seq")
    heads = chunks.where("free > 0").select("conv", "part", "seq", F.row_number().over(order).alias("idx"),
                                            F.lead("seq").over(order).isNull().alias("last"))
    work = keep(chunks.join(heads, ["conv", "part", "seq"], "left"), "conversation-work")
    several = keep(work.where("idx > 1 or not last").select("conv", "idx", "last", "codes"), "conversation-several")

    def vectors(df: DataFrame) -> DataFrame:
        out = pa.schema([("conv", pa.string()), ("idx", pa.int32()), ("last", pa.bool_()), ("right", pa.list_(pa.int64())),
                         ("left", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32()))])

        def run(batches):
            for batch in batches:
                rows = []
                for conv, idx, last, codes, right in zip(*(c.to_pylist() for c in batch.columns)):
                    v = backward(codes, tuple(right))
                    rows.append((conv, idx, last, right, v[0], [trace(codes, v, s)[1] for s in range(4)]))
                yield table(out, rows)

        return df.select("conv", "idx", "last", "codes", "right").mapInArrow(
            run, "conv string, idx int, last boolean, right array<bigint>, left array<bigint>, ends array<int>")

    def fixed(*cost: int) -> Column:
        return F.array(*(F.lit(c).cast("bigint") for c in cost))

    guess = F.when(F.col("last"), fixed(*FINAL)).otherwise(fixed(0, 0, 0, 0))
    found = keep(vectors(several.withColumn("right", guess)), "conversation-vectors")
    while True:
        wanted = found.select("conv", (F.col("idx") - 1).alias("idx"), F.col("left").alias("want"))
        seen = found.join(wanted, ["conv", "idx"], "left")
        same = F.col("want").isNull() | (level("want") == level("right"))
        stale = keep(seen.where(~same).select("conv", "idx", F.col("want").alias("right")), "conversation-stale")
        if stale.isEmpty():
            break
        again = vectors(several.join(stale, ["conv", "idx"]))
        found = keep(found.join(stale, ["conv", "idx"], "left_anti").unionByName(again), "conversation-vectors")

    before = found.select("conv", (F.col("idx") + 1).alias("idx"), "ends")
    linked = found.select("conv", "idx").join(before, ["conv", "idx"], "left")
    one = F.array_max("ends") == F.array_min("ends")
    entry = F.when(F.col("ends").isNull(), F.lit(0)).when(one, F.col("ends")[0])
    known = keep(linked.select("conv", "idx", "ends", entry.cast("int").alias("entry")), "conversation-entries")
    while not known.where("entry is null").isEmpty():
        prev = known.where("entry is not null").select("conv", (F.col("idx") + 1).alias("idx"), F.col("entry").alias("was"))
        step = F.coalesce("entry", F.get("ends", F.col("was")))
        known = keep(known.join(prev, ["conv", "idx"], "left").select("conv", "idx", "ends", step.alias("entry")), "conversation-entries")

    out = pa.schema([*CHUNK, ("letters", pa.list_(pa.string())), ("tail", pa.string())])

    def letters(batches):
        for batch in batches:
            rows = []
            for *chunk, right, state, last in zip(*(c.to_pylist() for c in batch.columns)):
                codes = chunk[7]
                got, end = trace(codes, backward(codes, tuple(right)), state)
                rows.append((*chunk, got, TAIL[end] if last else ""))
            yield table(out, rows)

    linked = found.join(known.select("conv", "idx", "entry"), ["conv", "idx"]).select("conv", "idx", "right", "entry")
    last = F.coalesce("last", F.lit(False))
    ready = work.join(linked, ["conv", "idx"], "left").select(
        *CHUNK.names, F.coalesce("right", fixed(*FINAL)).alias("right"), F.coalesce("entry", F.lit(0)).alias("entry"), last.alias("last"))
    result = ready.mapInArrow(letters, CHUNK_SQL + ", letters array<string>, tail string")
    path = write_scratch(result, "conversation-edits")
    for p in scratch:
        drop_scratch(spark, p)
    return spark_read(spark, path, result)


def edits_of(rows: DataFrame, size: int = CHUNK_ROWS) -> DataFrame:
    """Cheapest edits of every conversation: chunks of consecutive rows with each row's letters.

    ``rows``: conv_id, turn, role, text (none null but conv_id and turn) and
    copies. A conversation's rows stand by turn, nulls first; rows of one turn
    by role, then by SHA-256 of the text, so equal rows are adjacent. Null ids
    make one conversation. No rows give no edits; other columns are not read.
    """
    chunks = chunks_of(runs_of(rows), size)
    path = write_scratch(chunks, "conversation-chunks")
    edits = solve(spark_read(rows.sparkSession, path, chunks))
    drop_scratch(rows.sparkSession, path)
    return edits


# --- edits applied -----------------------------------------------------------------

class Walk:
    """One conversation's rows in order, with their edits: repaired rows, counts, audit and digest."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.rows, self.audit = conv_id, 0, [], []
        self.sha, self.first = hashlib.sha256(), True
        self.low = self.high = self.turn = None
        self.turns = self.blank = self.dup = self.cut = self.illegal = self.cost = 0
        self.initial = self.run = self.edits = None
        self.at, self.tail, self.place = 0, "", 0

    def say(self, turn, role, text, letter):
        self.sha.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False
        self.rows.append((self.conv_id, turn, role, text, letter))

    def insert(self, n: int):
        for _ in range(n):
            self.state = NEXT[self.state]
            self.cost += 2
            self.say(None, ROLE[self.state], "", "I")

    def row(self, turn, role, text, dig):
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += self.high is None or turn != self.high
            self.high = turn
        initial = role[:1]
        self.illegal += self.initial is not None and (self.initial, initial) not in LEGAL
        self.initial = initial
        run = (turn, role, dig)
        if run == self.run:
            letters, code = "D", 4 * GONE
        else:
            letters, code = self.edits[0][self.at], self.edits[1][self.at]
            self.run, self.at = run, self.at + 1
        fault = code // 4
        if fault == GONE:
            if text.strip(BLANKS):
                self.dup += 1
            else:
                self.blank += 1
        self.cut += fault == TRUNCATED
        self.audit.append(letters)
        self.insert(len(letters) - 1)
        if letters[-1] == "D":
            self.cost += 3
            return
        if letters[-1] == "K":
            self.state = {"s": 1, "u": 2, "a": 3}[initial]
        else:
            self.state = NEXT[self.state]
            self.cost += 2
            role = ROLE[self.state]
        self.cost += fault
        self.say(turn, role, text, letters[-1])

    def end(self):
        self.audit.append(self.tail)
        self.insert(len(self.tail))

    def summary(self):
        gaps = min(self.high - self.low + 1 - self.turns, 2**63 - 1) if self.turns else 0
        return (self.conv_id, gaps, self.blank, self.dup, self.cut, self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[Walk]:
    """The walk after every batch and every conversation; a reader takes its rows, so that no conversation is held."""
    conv = walk = None
    for batch in batches:
        for name, conv_id, turn, role, dig, kind, text, copies, codes, letters, tail in zip(*(c.to_pylist() for c in batch.columns)):
            if name != conv:
                if walk:
                    walk.end()
                    yield walk
                conv, walk = name, Walk(conv_id)
            if letters is not None:
                walk.edits, walk.at = (letters, codes), 0
                walk.tail = tail or walk.tail
            elif text is not None:
                for _ in range(copies):
                    walk.row(turn, role, text, dig)
        if walk:
            yield walk
    if walk:
        walk.end()
        yield walk


def streamed(rows: DataFrame, edits: DataFrame, originals: DataFrame) -> DataFrame:
    """Each conversation's rows in order in one task, each chunk's letters before its first row.

    A digest of a conversation is a sequential thing, so its rows pass through
    one task; they are sorted on disk and streamed, and only the audit string
    stays in memory.
    """
    text = named(rows).select("conv", "conv_id", F.lit(1).alias("body"), "turn", "role", "dig", F.lit(1).alias("kind"), "text", "copies",
                              F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("array<string>").alias("letters"),
                              F.lit(None).cast("string").alias("tail"))
    marks = edits.select("conv", "conv_id", F.lit(1).alias("body"), "turn", "role", "dig", F.lit(0).alias("kind"),
                         F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"), "codes", "letters", "tail")
    heads = originals.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct().select(
        key_of("conv_id").alias("conv"), "conv_id", F.lit(0).alias("body"), F.lit(None).cast("bigint").alias("turn"),
        F.lit("").alias("role"), F.lit(None).cast("binary").alias("dig"), F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("text"), F.lit(0).alias("copies"), F.lit(None).cast("binary").alias("codes"),
        F.lit(None).cast("array<string>").alias("letters"), F.lit(None).cast("string").alias("tail"))
    every = text.unionByName(marks).unionByName(heads)
    return every.repartition("conv").sortWithinPartitions(
        "conv", "body", F.col("turn").asc_nulls_first(), "role", "dig", "kind").drop("body")


def repaired(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place, turn (null: inserted), role, text and the edit (K, R or I)."""
    out = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
                     ("text", pa.string()), ("edit", pa.string())])

    def run(batches):
        for walk in walks(batches):
            at, got = walk.place, walk.rows
            walk.rows, walk.place = [], at + len(got)
            yield table(out, [(r[0], at + i, *r[1:]) for i, r in enumerate(got)])

    return streamed(rows, edits, rows).mapInArrow(run, "conv_id bigint, place bigint, turn bigint, role string, text string, edit string")


def audits(rows: DataFrame, edits: DataFrame, originals: DataFrame) -> DataFrame:
    """One row per conversation of ``originals``: faults, cost, edits and digest of the repaired rows.

    A conversation without rows has zeros, an empty audit and the digest of the
    empty string.
    """
    out = pa.schema([("conv_id", pa.int64()), *((n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches):
        last, done = None, []
        for walk in walks(batches):
            walk.rows = []
            if last is not None and walk is not last:
                done.append(last.summary())
                if len(done) >= 1000:
                    yield table(out, done)
                    done = []
            last = walk
        if last is not None:
            done.append(last.summary())
        yield table(out, done)

    return streamed(rows, edits, originals).mapInArrow(
        run, "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
             "audit string, repaired_sha256 string")


def q_conversations(spark, sf_dir) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = damaged(conversations)
    return audits(rows, edits_of(rows), conversations)


#: crc32 by its table rule, edits by a recursive shortest path that carries (cost, audit, repaired text) per state
ORACLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS tbl FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
source AS (
  SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k,
         coalesce(role, ' ') AS role, coalesce(text, ' ') AS text
  FROM conversations),
coded AS (
  SELECT source.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda p: CAST(ascii(substr(k, p, 1)) AS BIGINT))),
           lambda c, b: xor(c >> 8, tbl[xor(c & 255, b) + 1])), 4294967295) % 20 AS code
  FROM source, crc_table),
damaged AS (
  SELECT conv, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy
  FROM coded WHERE code <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body
  FROM damaged),
faulty AS (
  SELECT conv, i, turn, role, text, substr(role, 1, 1) AS initial,
         CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv ORDER BY i) AS prior
  FROM placed),
after(s, t) AS (VALUES (0, 2), (1, 2), (2, 3), (3, 2)),
inserts AS (
  SELECT s, '' AS letters, 0 AS cost, s AS t, '' AS said FROM after
  UNION ALL SELECT s, 'I', 2, t, CASE WHEN t = 2 THEN E'\nuser:' ELSE E'\nassistant:' END FROM after
  UNION ALL SELECT a.s, 'II', 4, b.t, CASE WHEN a.t = 2 THEN E'\nuser:\nassistant:' ELSE E'\nassistant:\nuser:' END FROM after a JOIN after b ON a.t = b.s),
acts(letter, initial, s, cost, t) AS (
  VALUES ('K', 's', 0, 0, 1), ('K', 'u', 0, 0, 2), ('K', 'u', 1, 0, 2), ('K', 'u', 3, 0, 2), ('K', 'a', 2, 0, 3),
         ('D', NULL, 0, 3, 0), ('D', NULL, 1, 3, 1), ('D', NULL, 2, 3, 2), ('D', NULL, 3, 3, 3),
         ('R', NULL, 0, 2, 2), ('R', NULL, 1, 2, 2), ('R', NULL, 2, 2, 3), ('R', NULL, 3, 2, 2)),
steps AS (
  SELECT n.s, n.letters || a.letter AS letters, n.cost + a.cost AS cost, a.t, a.letter, a.initial, n.said
  FROM inserts n JOIN acts a ON n.t = a.s),
paths AS (
  SELECT DISTINCT conv, CAST(0 AS BIGINT) AS i, 0 AS s, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS said FROM faulty
  UNION ALL
  SELECT conv, i, s, cost, audit, said FROM (
    SELECT p.conv, p.i + 1 AS i, t.t AS s,
           p.cost + t.cost + CASE WHEN f.fault = 'truncated' AND t.letter <> 'D' THEN 1 ELSE 0 END AS cost,
           p.audit || t.letters AS audit,
           p.said || t.said || CASE t.letter WHEN 'D' THEN '' WHEN 'K' THEN E'\n' || f.role || ':' || f.text
             ELSE (CASE WHEN t.t = 2 THEN E'\nuser:' ELSE E'\nassistant:' END) || f.text END AS said
    FROM paths p JOIN faulty f ON f.conv = p.conv AND f.i = p.i + 1
    JOIN steps t ON t.s = p.s AND (t.letter = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND (t.letter = 'R' OR t.initial = f.initial))))
  QUALIFY row_number() OVER (PARTITION BY conv, i, s ORDER BY cost, audit) = 1),
ends(s, cost, letters, said) AS (VALUES (0, 0, '', ''), (1, 4, 'II', E'\nuser:\nassistant:'), (2, 2, 'I', E'\nassistant:'), (3, 0, '', '')),
best AS (
  SELECT p.conv, p.cost + e.cost AS cost, p.audit || e.letters AS audit, p.said || e.said AS said
  FROM paths p JOIN (SELECT conv, max(i) AS n FROM faulty GROUP BY conv) m ON m.conv = p.conv AND m.n = p.i JOIN ends e ON e.s = p.s
  QUALIFY row_number() OVER (PARTITION BY p.conv ORDER BY p.cost + e.cost, p.audit || e.letters) = 1),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE prior IS NOT NULL AND prior || '>' || initial NOT IN ('s>u', 'u>a', 'a>u')) AS illegal
  FROM faulty GROUP BY conv)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(substr(said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM source) o LEFT JOIN counts USING (conv) LEFT JOIN best USING (conv)
"""
