"""A3/A4 and A6 as requests arrive: keyed state and event-time windows.

``budget_stream`` holds two counters per budget key (tokens and USD units
spent) in Spark's state store and decides the requests of every micro-batch
against them, so a budget is enforced over the life of a stream and survives
restarts with the checkpoint. A micro-batch that is run again starts from the
counters it started from before and decides the same.

``rate_audit_stream`` counts requests per model and event-time window once the
watermark has passed a window, and puts what comes later into a side output.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gleaner.operators.budget import limits, over_limits

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_state(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store, which keeps it on disk and changelogs in the checkpoint."""
    if "RocksDB" not in (spark.conf.get(STATE_STORE, "") or ""):
        spark.conf.set(STATE_STORE, ROCKSDB)


class Spender(StatefulProcessor):
    """The two counters of one budget key."""

    def __init__(self, order: list[str], tokens: str, token_limit: int | None, usd_limit: int | None, price: int):
        self.order, self.tokens, self.token_limit, self.usd_limit, self.price = order, tokens, token_limit, usd_limit, price

    def init(self, handle: StatefulProcessorHandle) -> None:
        # USD units exceed 64 bits, so they are kept as text
        self.spent = handle.getValueState("spent", "tokens bigint, usd string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        if self.order:
            batch = batch.sort_values(self.order, kind="stable", na_position="first", ignore_index=True)
        used, usd = (int(self.spent.get()[0]), int(self.spent.get()[1])) if self.spent.exists() else (0, 0)
        tok_ok, admitted = [], []
        for t in batch[self.tokens]:
            t = 0 if pd.isna(t) else int(t)
            fits = self.token_limit is None or used + t <= self.token_limit
            pays = fits and (self.usd_limit is None or usd + t * self.price <= self.usd_limit)
            used += t * fits
            usd += t * self.price * pays
            tok_ok.append(fits)
            admitted.append(pays)
        self.spent.update((used, str(usd)))
        yield batch.assign(tok_ok=tok_ok, admitted=admitted)

    def close(self) -> None:
        pass


def budget_stream(stream: DataFrame, key: list[str], order: list[str], tokens: str = "tokens", token_limit: float | None = None,
                  usd_limit: float | None = None, price: float | None = None) -> DataFrame:
    """A3/A4 over a stream: ``tok_ok`` and ``admitted`` for every arriving request.

    The rules are those of ``operators.budget.budget``. Requests are decided
    micro-batch by micro-batch, within one in ``order`` (nulls first), so
    batches that arrive in order are decided exactly as the whole table would
    be. A key's rows of one micro-batch are held in memory while they are
    decided: bound the batch at its source (``maxFilesPerTrigger``,
    ``maxOffsetsPerTrigger``). Null keys are budgets of their own.
    """
    tl, ul, price_u = limits(token_limit, usd_limit, price)
    keyed_state(stream.sparkSession)
    out = T.StructType([*stream.schema.fields, T.StructField("tok_ok", T.BooleanType()), T.StructField("admitted", T.BooleanType())])
    return stream.groupBy(*key).transformWithStateInPandas(
        Spender(order, tokens, tl, ul, price_u), outputStructType=out, outputMode="Append", timeMode="None")


def rate_audit_stream(stream: DataFrame, ts: str, model: str, tokens: str, catalog: DataFrame, window: str = "1 minute",
                      slide: str | None = None, delay: str = "1 minute") -> DataFrame:
    """A6 over a stream: one row per model and window when the watermark (``delay`` behind the newest event) passes its end.

    ``slide`` makes the windows overlap. Events behind the watermark are in no
    window; ``late_events`` finds them.
    """
    events = stream.select(F.col(ts).cast("timestamp").alias("_ts"), F.col(model).alias("model"), F.col(tokens).alias("_tokens"))
    span = F.window("_ts", window, slide) if slide else F.window("_ts", window)
    per = events.withWatermark("_ts", delay).groupBy(span.alias("w"), "model").agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum("_tokens").alias("n_tokens"))
    return over_limits(per, catalog)


class LateEvents:
    """``foreachBatch`` function: rows that came behind the watermark go to ``late/batch=<id>``, all rows to ``on_time``.

    The watermark is that of ``rate_audit_stream`` with the same ``delay``:
    the newest event time of earlier batches less the delay. It is kept beside
    the side output, one value per batch, so a batch run again finds the value
    it had.
    """

    def __init__(self, ts: str, late_path: str, delay: str = "1 minute", on_time=None):
        self.ts, self.path, self.delay, self.on_time = ts, late_path.rstrip("/"), delay, on_time

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        at = F.col(self.ts).cast("timestamp")
        mark = spark.createDataFrame([], "batch bigint, newest timestamp") if batch_id == 0 else spark.read.schema(
            "newest timestamp, batch bigint").parquet(f"{self.path}/marks").where(F.col("batch") == batch_id - 1)
        newest = mark.agg(F.max("newest").alias("m")).first()["m"]
        df = df.persist()
        try:
            if newest is None:
                late, good = df.limit(0), df
            else:
                behind = at < F.lit(newest) - F.expr(f"INTERVAL {self.delay}")
                late, good = df.where(behind), df.where(~F.coalesce(behind, F.lit(False)))
            late.write.mode("overwrite").parquet(f"{self.path}/late/batch={batch_id}")
            if self.on_time is not None:
                self.on_time(good, batch_id)
            (df.agg(F.greatest(F.max(at), F.lit(newest).cast("timestamp")).alias("newest")).coalesce(1)
             .write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}"))
        finally:
            df.unpersist()
