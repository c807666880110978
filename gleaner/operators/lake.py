"""U1-U5 keyed upserts on an append-only change log, S9 lake scan.

The document store of the reference (upsert by key, ``$set`` /
``$setOnInsert``, "which keys were inserted") is re-expressed as:

* a **change log**: every write appends rows ``key, _seq, _batch, _set,
  _ins, <fields>``. ``_set`` lists the fields the row sets (last write wins),
  ``_ins`` the fields it sets only on insert (first write wins). An explicit
  null in a listed field is a real write.
* a **merged view** (U5): one row per key, each field resolved with
  ``max_by(field, _seq) FILTER (WHERE array_contains(_set, field))`` — a
  hash aggregate with partial (map-side) merge, so a hot key is reduced on
  every mapper before the shuffle.
* **new_only** (U2): keys whose first write is in this batch. In-batch
  duplicates are reduced with ``min_by`` (partial aggregate, skew-safe),
  then ``left_anti`` against keys first written by *earlier* batches — so a
  replayed batch re-emits exactly the same rows.

``_seq`` is the order of the writes, a number or any other sortable value (the
pipeline uses a struct of the source's offsets). ``Lake`` persists the log as
Parquet under a root folder, in runs that are merged as they pile up.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = ("key", "_seq", "_batch", "_set", "_ins", "_writer")


def _arr(names) -> Column:
    return F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")


def change_rows(df: DataFrame, key: str | Column, seq: str | Column, batch_id: int | Column,
                set_fields: dict[str, Column | str] | None = None,
                insert_fields: dict[str, Column | str] | None = None) -> DataFrame:
    """Turn a DataFrame of writes into change-log rows.

    ``set_fields`` / ``insert_fields`` map field name -> value expression.
    Writers of one lake must number their writes in one type.
    """
    set_fields = set_fields or {}
    insert_fields = insert_fields or {}
    k = F.col(key) if isinstance(key, str) else key
    s = F.col(seq) if isinstance(seq, str) else seq
    b = F.lit(batch_id) if isinstance(batch_id, int) else batch_id
    cols = [k.cast("string").alias("key"), s.alias("_seq"), b.cast("bigint").alias("_batch"),
            _arr(list(set_fields)).alias("_set"), _arr(list(insert_fields)).alias("_ins")]
    for name, v in {**insert_fields, **set_fields}.items():
        cols.append((F.col(v) if isinstance(v, str) else v).alias(name))
    return df.select(*cols)


def union_changes(*logs: DataFrame) -> DataFrame:
    """Union change frames from different writers (missing fields -> null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), logs)


def upsert_postings(df: DataFrame, batch_id: int | Column, key: str = "url", seq: str = "_seq",
                    created_at: str | Column = "created_at") -> DataFrame:
    """On insert set created_at, job_id; always set role, url."""
    return change_rows(df, key, seq, batch_id,
                       set_fields={"role": "role", "url": "url"},
                       insert_fields={"created_at": created_at, "job_id": "job_id"})


def set_status(df: DataFrame, batch_id: int | Column, key: str = "url", seq: str = "_seq",
               ok: str = "ok") -> DataFrame:
    """Upsert one flag by url."""
    return change_rows(df, key, seq, batch_id,
                       set_fields={"url": "url", "e2_success": F.col(ok).cast("boolean")})


def upsert_enriched(df: DataFrame, batch_id: int | Column, fields: list[str],
                    key: str = "url", seq: str = "_seq") -> DataFrame:
    """U4: set every given field by url; explicit nulls overwrite."""
    return change_rows(df, key, seq, batch_id, set_fields={f: f for f in fields})


def merged_view(log: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One row per key; per field last write wins (insert-only: first)."""
    fields = fields or [c for c in log.columns if c not in META]
    aggs = []
    for f in fields:
        last = F.expr(f"max_by(`{f}`, _seq) FILTER (WHERE array_contains(_set, '{f}'))")
        first = F.expr(f"min_by(`{f}`, _seq) FILTER (WHERE array_contains(_ins, '{f}'))")
        was_set = F.max(F.array_contains("_set", f).cast("int"))
        aggs.append(F.when(was_set == 1, last).otherwise(first).alias(f))
    aggs += [F.min("_batch").alias("_first_batch"), F.max("_seq").alias("_last_seq"),
             F.count(F.lit(1)).alias("_writes")]
    return log.groupBy("key").agg(*aggs)


def surviving(log: DataFrame) -> DataFrame:
    """The change rows that decide some field of their key, with masks cut to those fields.

    Per field that is the last row that sets it and the first that inserts it;
    a key's first and last rows stay too, for its first batch and last
    sequence number. One hash aggregate and one join on the key.
    """
    fields = [c for c in log.columns if c not in META]
    at = [F.max(F.when(F.array_contains("_set", f), F.col("_seq"))).alias(f"set {f}") for f in fields]
    at += [F.min(F.when(F.array_contains("_ins", f), F.col("_seq"))).alias(f"ins {f}") for f in fields]
    deciding = log.groupBy(F.col("key").alias("decided key")).agg(
        *at, F.min(F.struct("_batch", "_seq")).alias("first write"), F.max("_seq").alias("last write"))
    rows = log.join(deciding, F.col("key") == F.col("decided key"))
    cut = {m: F.filter(F.array(*[F.when(F.array_contains(m, f) & (F.col(f"{m[1:]} {f}") == F.col("_seq")), F.lit(f))
                                 for f in fields]), lambda x: x.isNotNull()) for m in ("_set", "_ins")}
    kept = rows.withColumns({"cut set": cut["_set"], "cut ins": cut["_ins"]}).where(
        (F.size("cut set") > 0) | (F.size("cut ins") > 0) | (F.col("_seq") == F.col("last write"))
        | (F.struct("_batch", "_seq") == F.col("first write")))
    return kept.select(*[F.col("cut set").alias(c) if c == "_set" else F.col("cut ins").alias(c) if c == "_ins" else F.col(c)
                         for c in log.columns])


def first_writes(changes: DataFrame, order: str | Column = "_seq") -> DataFrame:
    """Per key the earliest change row (batch, then order) — skew-safe."""
    o = F.col(order) if isinstance(order, str) else order
    payload = [c for c in changes.columns if c != "key"]
    best = changes.groupBy("key").agg(
        F.min_by(F.struct(*payload), F.struct(F.col("_batch"), o)).alias("_r"))
    return best.select("key", "_r.*")


def new_only(batch: DataFrame, log: DataFrame | None, batch_id: int | None = None,
             writer: str | None = None) -> DataFrame:
    """Rows of this batch whose key was not written by an earlier batch.

    ``batch`` is change rows of one batch (see ``upsert_postings``); ``log``
    the persisted log (or its compacted snapshot). Rows of the same or later
    batches in the log are ignored, so re-running a batch is idempotent.
    """
    firsts = first_writes(batch)
    if log is None:
        return firsts
    seen = log
    if writer is not None and "_writer" in log.columns:
        seen = seen.filter(F.col("_writer") == F.lit(writer))
    if batch_id is not None:
        seen = seen.filter(F.col("_batch") < F.lit(batch_id))
    return firsts.join(seen.select("key"), "key", "left_anti")


def new_only_all(changes: DataFrame) -> DataFrame:
    """Set form of U2 over many batches at once: each key is 'new' exactly
    in the batch holding its first write (what replaying every batch in
    order through ``new_only`` yields)."""
    return first_writes(changes)


@dataclass(frozen=True)
class Run:
    """Change rows of the batches ``lo`` to ``hi`` of one writer; a level is merged from runs of the level below."""

    level: int
    lo: int
    hi: int
    path: str

    def holds(self, other: "Run") -> bool:
        return self.lo <= other.lo and other.hi <= self.hi and self.level > other.level


class Lake:
    """A change-log collection stored as Parquet (S9 scan + U1-U5 writes).

    Every writer has runs: an appended batch is a run of level 0, and as soon
    as a level has ``fan_in`` runs they are merged into one of the next level
    that keeps only the rows that still decide something. A reader takes the
    few runs that no complete larger run holds, so what it reads grows with the
    keys and not with the number of batches. Merged rows lie in hash buckets of
    their key, and a merge writes only the buckets its runs touched. A run counts
    once its ``_SUCCESS`` marker is there; runs that a merge replaced are
    deleted at the writer's next merge, when their last readers are gone.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, fan_in: int = 8):
        self.spark, self.root, self.buckets, self.fan_in = spark, root.rstrip("/"), buckets, fan_in
        self._schemas: dict[str, T.StructType] = {}
        self._written: dict[str, list[Run]] = {}     # complete runs of writers that write through this object

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    def writer_path(self, writer: str) -> str:
        return f"{self.log_path}/_writer={writer}"

    # -- files --------------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []

    def writers(self) -> list[str]:
        return sorted(n.removeprefix("_writer=") for n in self._children(self.log_path) if n.startswith("_writer="))

    def _all_runs(self, writer: str) -> list[Run]:
        out = []
        for name in self._children(self.writer_path(writer)):
            if name.startswith("run="):
                level, lo, hi = map(int, name.removeprefix("run=").split(".."))
                path = f"{self.writer_path(writer)}/{name}"
                fs, done = self._fs(f"{path}{self._folder(level)}/_SUCCESS")
                if fs.exists(done):
                    out.append(Run(level, lo, hi, path))
        return out

    @staticmethod
    def _folder(level: int) -> str:
        """A batch is written as it comes, under one bucket of its own; merges deal it into the buckets of its keys."""
        return "/bucket=-1" if level == 0 else ""

    @staticmethod
    def _live(every: list[Run]) -> list[Run]:
        return sorted((r for r in every if not any(o.holds(r) for o in every)), key=lambda r: (r.lo, r.level))

    def runs(self, writer: str) -> list[Run]:
        """The runs to read: complete ones that no larger one holds."""
        return self._live(self._all_runs(writer))

    def _schema(self, writer: str) -> T.StructType | None:
        """The fields that a writer's batches have had so far, kept beside its runs."""
        if writer not in self._schemas:
            names = sorted(n for n in self._children(self.writer_path(writer)) if n.startswith("_schema-"))
            if not names:
                return None
            fs, p = self._fs(f"{self.writer_path(writer)}/{names[-1]}")
            stream = fs.open(p)
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            self._schemas[writer] = T.StructType.fromJson(json.loads(text))
        return self._schemas[writer]

    def _remember(self, writer: str, schema: T.StructType) -> None:
        known = self._schema(writer)
        fields = {f.name: T.StructField(f.name, f.dataType) for f in (*(known.fields if known else ()), *schema.fields)}
        if known is not None and len(fields) == len(known.fields):
            return
        self._schemas[writer] = T.StructType(list(fields.values()))
        fs, p = self._fs(f"{self.writer_path(writer)}/_schema-{len(fields):06d}")
        stream = fs.create(p, True)
        stream.writeBytes(self._schemas[writer].json())
        stream.close()

    # -- writes -------------------------------------------------------------------

    def append(self, changes: DataFrame, writer: str = "default", batch: int | None = None) -> None:
        """Append change rows as a run.

        ``batch`` says that all rows are of that batch; without it the rows
        tell. A batch that is written again replaces its own run, or nothing
        if a merge has taken the run up (its rows are the same). Writers never
        touch each other's runs.
        """
        if batch is None:
            span = changes.agg(F.min("_batch").alias("lo"), F.max("_batch").alias("hi")).first()
            if span["lo"] is None:
                return
            run = Run(0, span["lo"], span["hi"], "")
        else:
            run = Run(0, batch, batch, "")
        if writer not in self._written:
            self._written[writer] = self._all_runs(writer)
        if any(o.holds(run) for o in self._written[writer]):
            return
        self._remember(writer, changes.schema)
        self._write(changes, writer, run)
        self._merge(writer)

    def _write(self, rows: DataFrame, writer: str, run: Run) -> None:
        path = f"{self.writer_path(writer)}/run={run.level}..{run.lo}..{run.hi}"
        if run.level == 0:
            rows.write.mode("overwrite").parquet(path + self._folder(0))
        else:
            bucket = F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")
            rows.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        done = replace(run, path=path)
        self._written[writer] = [r for r in self._written[writer] if r != done] + [done]

    def _merge(self, writer: str) -> None:
        """Merge full levels, and delete what earlier merges replaced."""
        while True:
            live = self._live(self._written[writer])
            level = next((n for n in sorted({r.level for r in live}) if sum(r.level == n for r in live) >= self.fan_in), None)
            if level is None:
                return
            full = [r for r in live if r.level == level]
            gone = [r for r in self._written[writer] if r not in live]
            rows = self._read(writer, full)
            self._write(surviving(rows.select(*self._schema(writer).names)), writer,
                        Run(level + 1, min(r.lo for r in full), max(r.hi for r in full), ""))
            for r in gone:
                fs, p = self._fs(r.path)
                fs.delete(p, True)
            self._written[writer] = [r for r in self._written[writer] if r not in gone]

    # -- reads --------------------------------------------------------------------

    def _read(self, writer: str, runs: list[Run]) -> DataFrame | None:
        if not runs:
            return None
        schema = T.StructType([*self._schema(writer).fields, T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(schema).option("basePath", self.writer_path(writer)).parquet(*[r.path for r in runs]).drop("run")

    def log(self, writer: str | None = None) -> DataFrame | None:
        """The change log (of one writer or of all), or None before the first write."""
        parts = []
        for w in [writer] if writer is not None else self.writers():
            rows = self._read(w, self.runs(w))
            if rows is not None:
                parts.append(rows.drop("bucket").withColumn("_writer", F.lit(w)))
        return union_changes(*parts) if parts else None

    def keys(self, writer: str, before_batch: int | None = None) -> DataFrame | None:
        """(key, _batch, bucket) rows of keys already written, by one writer and before a batch; a merged key has a row or two."""
        live = self._live(self._written[writer]) if writer in self._written else self.runs(writer)
        rows = self._read(writer, [r for r in live if before_batch is None or r.lo < before_batch])
        if rows is None:
            return None
        rows = rows.select("key", "_batch", "bucket")
        return rows if before_batch is None else rows.filter(F.col("_batch") < F.lit(before_batch))

    def scan(self, fields: list[str] | None = None) -> DataFrame:
        """The collection as a table (merge-on-read)."""
        log = self.log()
        if log is None:
            raise FileNotFoundError(self.log_path)
        return merged_view(log, fields)

    def compact(self) -> str:
        """Write the change rows that still matter to a fresh path and return it.

        The snapshot is itself a change log: later writes, also ones with an
        earlier sequence number, merge with it as with the full log.
        """
        log = self.log()
        if log is None:
            raise FileNotFoundError(self.log_path)
        path = f"{self.root}/snapshot-{uuid.uuid4().hex[:8]}"
        surviving(log).write.parquet(path)
        return path
