"""Process when enough messages are buffered or enough time has passed, for landed topics.

A Kafka reader has options for this (``pipeline.kafka_batching``); a stream of
files has none. ``buffered`` keeps arriving messages in keyed list state, one
buffer per topic, and lets a buffer go as a whole when it holds ``min_rows`` or
when its oldest message has waited ``max_delay``, which a processing-time timer
tells. The buffer lives in the checkpoint, so nothing is lost by a restart;
``min_rows=1`` lets everything go at once, which drains it on stop.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gleaner.streaming.budget import keyed_state

MIN_ROWS, MAX_DELAY_MS = 100, 30_000      # the reference's detail-stage buffer


class Buffer(StatefulProcessor):
    """Messages of one key that wait, and the number of the batch they will leave in."""

    def __init__(self, schema: T.StructType, min_rows: int, max_delay_ms: int):
        self.schema, self.min_rows, self.max_delay_ms = schema, min_rows, max_delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)
        self.counts = handle.getValueState("counts", "waiting int, batch bigint")

    def _go(self, batch: int, why: str) -> pd.DataFrame:
        out = pd.DataFrame([tuple(r) for r in self.rows.get()], columns=self.schema.names)
        self.rows.clear()
        self.counts.update((0, batch + 1))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        return out.assign(buffer_batch=batch, fired=why)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, batch = self.counts.get() if self.counts.exists() else (0, 0)
        fresh = [tuple(None if pd.isna(x) else x for x in r) for pdf in rows for r in pdf[self.schema.names].itertuples(index=False)]
        self.rows.appendList(fresh)
        if waiting + len(fresh) >= self.min_rows:
            yield self._go(batch, "count")
            return
        if waiting == 0:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.max_delay_ms)
        self.counts.update((waiting + len(fresh), batch))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        waiting, batch = self.counts.get()
        if waiting:
            yield self._go(batch, "timeout")

    def close(self) -> None:
        pass


def buffered(stream: DataFrame, key: str = "topic", min_rows: int = MIN_ROWS, max_delay_ms: int = MAX_DELAY_MS) -> DataFrame:
    """The stream's rows, held back until their buffer goes; ``buffer_batch`` numbers a key's batches, ``fired`` is count or timeout.

    Timers are looked at in every micro-batch, so run it with a
    ``processingTime`` trigger shorter than the delay. A buffer takes whole
    micro-batches of its key, so it may leave with more than ``min_rows``.
    """
    keyed_state(stream.sparkSession)
    out = T.StructType([*stream.schema.fields, T.StructField("buffer_batch", T.LongType()), T.StructField("fired", T.StringType())])
    return stream.groupBy(key).transformWithStateInPandas(
        Buffer(stream.schema, min_rows, max_delay_ms), outputStructType=out, outputMode="Append", timeMode="ProcessingTime")
