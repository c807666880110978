"""M1-M8: message envelopes and codecs as DataFrame operators.

An envelope row is ``topic, partition, offset, timestamp, key, value`` (the
Kafka source/sink schema). ``value`` carries UTF-8 JSON
``{"action": ..., "params": {...}}``. Encoding is ``to_json(struct)``;
decoding is ``from_json`` plus key checks, with bad rows routed to a
quarantine frame instead of raising.

Spark SQL has no zlib, so deflate/inflate is the only Python step: an
Arrow-batched ``pandas_udf`` over a binary column (base64 stays native).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleaner.operators.postings import barrier

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
])

# Command envelopes (defaults as in the reference's list command).
LIST_PARAMS = T.StructType([T.StructField("start_page", T.LongType()),
                            T.StructField("end_page", T.LongType()),
                            T.StructField("per_page", T.LongType())])
LIST_DEFAULTS = {"start_page": 1, "end_page": 40, "per_page": 50}
DETAIL_PARAMS = T.StructType([T.StructField("job_id", T.LongType()),
                              T.StructField("role", T.StringType()),
                              T.StructField("url", T.StringType())])
ACTION_EXTRACT, ACTION_TRANSFORM, ACTION_LOAD = "START_EXTRACT", "START_TRANSFORM", "START_LOAD"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- zlib (Arrow batches) ----------------------------------------------------

@F.pandas_udf(T.BinaryType())
def deflate(s: pd.Series) -> pd.Series:
    """zlib.compress of the UTF-8 text (null stays null)."""
    return s.map(lambda x: None if x is None else zlib.compress(x.encode("utf-8")))


def _inflate_one(b):
    if b is None:
        return None
    try:
        return zlib.decompress(bytes(b)).decode("utf-8")
    except (zlib.error, UnicodeDecodeError):
        return None


@F.pandas_udf(T.StringType())
def inflate(s: pd.Series) -> pd.Series:
    """zlib.decompress to UTF-8 text; null on corrupt input."""
    return s.map(_inflate_one)


def pack_text(x) -> Column:
    """UTF-8 -> zlib -> base64 text."""
    return F.base64(deflate(_c(x)))


def unpack_text(x) -> Column:
    """base64 text -> zlib -> UTF-8; null when either step fails."""
    raw = F.try_to_binary(_c(x), F.lit("base64"))
    return inflate(raw)


# -- M1/M2 envelopes ---------------------------------------------------------

def encode_envelope(df: DataFrame, action: str | Column, params: dict[str, Column | str],
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """M1: ``value = to_json({action, params{...}})`` as UTF-8 bytes."""
    act = F.lit(action) if isinstance(action, str) else action
    p = F.struct(*[_c(v).alias(k) for k, v in params.items()])
    body = F.to_json(F.struct(act.alias("action"), p.alias("params")))
    return df.select(*keep, F.encode(body, "UTF-8").alias("value"))


def decode_envelope(df: DataFrame, params_schema: T.StructType, defaults: dict | None = None,
                    value: str = "value", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """M2: parse ``value``; returns (good, quarantine).

    Bad: not JSON, missing ``action`` or ``params``, a ``params`` key the
    schema does not declare, a declared key missing with no default, or a
    value that is not of the declared type.
    """
    defaults = defaults or {}
    text = F.decode(_c(value), "UTF-8") if dict(df.dtypes).get(value) == "binary" else _c(value)
    schema = T.StructType([T.StructField("action", T.StringType()),
                           T.StructField("params", params_schema)])
    top_keys = F.json_object_keys(text)
    param_keys = F.json_object_keys(F.get_json_object(text, "$.params"))
    declared = F.array(*[F.lit(f.name) for f in params_schema.fields])
    parsed = df.select(*keep, text.alias("_text"), F.from_json(text, schema).alias("_m"),
                       top_keys.alias("_top"), param_keys.alias("_pk"))
    fields = []
    for f in params_schema.fields:
        c = F.col(f"_m.params.{f.name}")
        if f.name in defaults:
            c = F.when(F.array_contains("_pk", f.name), c).otherwise(F.lit(defaults[f.name]).cast(f.dataType))
        fields.append(c.alias(f.name))
    required = [f.name for f in params_schema.fields if f.name not in defaults]
    errs = [
        F.when(F.col("_top").isNull(), F.lit("M2_not_json_object")),
        F.when(F.col("_top").isNotNull() & ~F.array_contains("_top", "action"), F.lit("M2_missing_action")),
        F.when(F.col("_top").isNotNull() & ~F.array_contains("_top", "params"), F.lit("M2_missing_params")),
        F.when(F.size(F.array_except(F.coalesce("_pk", F.array().cast("array<string>")), declared)) > 0,
               F.lit("M2_unexpected_param")),
    ] + [F.when(F.col("_pk").isNotNull() & ~F.array_contains("_pk", r), F.lit(f"M2_missing_{r}"))
         for r in required] + [
        # present, but not a value of the declared type: never a good row with a null; only nulls are looked up in the text
        F.when(F.col(f"_m.params.{f.name}").isNull() & F.get_json_object("_text", f"$.params.{f.name}").isNotNull(),
               F.lit(f"M2_bad_{f.name}")) for f in params_schema.fields]
    tagged = barrier(parsed.select(*keep, "_text", F.col("_m.action").alias("action"), *fields,
                                   F.filter(F.array(*errs), lambda e: e.isNotNull()).alias("_errors")),
                     "decode_envelope")
    good = tagged.filter(F.size("_errors") == 0).drop("_errors", "_text")
    bad = tagged.filter(F.size("_errors") > 0).select(*keep, F.col("_text").alias("value"), "_errors")
    return good, bad


def json_roundtrip(df: DataFrame, col: str, out: str = "json") -> DataFrame:
    """M4: any JSON value -> VARIANT -> canonical JSON text (null if invalid)."""
    return df.withColumn(out, F.to_json(F.try_parse_json(F.col(col))))


def dispatch_action(df: DataFrame, action: str, observation=None) -> DataFrame:
    """M5: keep rows whose action is ``action``; others are silently ignored
    (counted in ``observation`` when given)."""
    hit = F.coalesce(F.col("action") == F.lit(action), F.lit(False))
    if observation is not None:
        df = df.observe(observation, F.sum((~hit).cast("long")).alias("ignored"),
                        F.sum(hit.cast("long")).alias("dispatched"))
    return df.filter(hit)


@dataclass(frozen=True)
class Listener:
    """Who hears which topics, with which parameters a message must have, and what is done with a batch.

    ``sink(good, bad, batch_id)`` must be idempotent by batch id: it is called
    again for a batch that failed half-way.
    """

    name: str
    topics: tuple[str, ...]
    params: T.StructType
    sink: Callable[[DataFrame, DataFrame, int], None]
    action: str | None = None
    defaults: dict | None = None


def deliver(listeners: list[Listener]) -> Callable[[DataFrame, int], None]:
    """M6 with a decoder per listener: a ``foreachBatch`` function.

    The batch is read once; every listener gets all messages of its topics,
    decoded by its own parameters (and only its ``action``, if it names one). A
    sink that fails does not keep the others from theirs; then the batch fails
    and is run again, and what was already delivered is written over.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        failed = []
        try:
            for one in listeners:
                good, bad = decode_envelope(df.where(F.col("topic").isin(*one.topics)), one.params, one.defaults,
                                            keep=tuple(c for c in ("topic", "partition", "offset", "timestamp") if c in df.columns))
                try:
                    one.sink(dispatch_action(good, one.action) if one.action else good, bad, batch_id)
                except Exception as exc:          # reported below, after the other listeners had the batch
                    failed.append((one.name, exc))
        finally:
            df.unpersist()
        if failed:
            raise RuntimeError(f"batch {batch_id}: listeners {[n for n, _ in failed]} failed") from failed[0][1]

    return batch


def fan_out(messages: DataFrame, listeners: DataFrame) -> DataFrame:
    """M6: each listener of a topic receives every message of that topic.

    ``listeners`` is a (topic, listener) configuration table; how it is joined
    is left to the planner, which knows its size.
    """
    return messages.join(listeners, "topic", "inner")


# -- M3 HTML payloads ----------------------------------------------------------

def pack_html(df: DataFrame, html: str = "html", url: str | None = None,
              created_at: str | None = None, action: str = ACTION_TRANSFORM,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """M3: ``{action, params{codec:'zlib', [created_at], [url], b64}}``."""
    params = {"codec": F.lit("zlib")}
    if created_at:
        params["created_at"] = F.date_format(F.col(created_at), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if url:
        params["url"] = F.col(url)
    params["b64"] = pack_text(html)
    return encode_envelope(df, action, params, keep=keep)


def unpack_html(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """M3 inverse -> (good[action, url, created_at, html], quarantine)."""
    text = F.decode(F.col(value), "UTF-8") if dict(df.dtypes).get(value) == "binary" else F.col(value)
    schema = "action string, params struct<codec string, created_at string, url string, b64 string>"
    m = df.select(*keep, text.alias("_text"), F.from_json(text, schema).alias("_m"))
    html = unpack_text(F.col("_m.params.b64"))
    out = m.select(*keep, "_text", F.col("_m.action").alias("action"), F.col("_m.params.url").alias("url"),
                   F.try_to_timestamp(F.col("_m.params.created_at")).cast("timestamp_ntz").alias("created_at"),
                   F.col("_m.params.codec").alias("_codec"), html.alias("html"))
    errs = F.filter(F.array(
        F.when(F.col("action").isNull(), F.lit("M3_bad_envelope")),
        F.when(F.col("_codec") != "zlib", F.lit("M3_unknown_codec")),
        F.when(F.col("html").isNull(), F.lit("M3_corrupt_payload"))), lambda e: e.isNotNull())
    tagged = barrier(out.withColumn("_errors", errs).drop("_codec"), "unpack_html")
    return (tagged.filter(F.size("_errors") == 0).drop("_errors", "_text"),
            tagged.filter(F.size("_errors") > 0).select(*keep, F.col("_text").alias("value"), "_errors"))


# -- M7/M8 load records ----------------------------------------------------------

LOAD_TOPIC = "load.postings.v1"
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LOAD_FIELDS = ("about", "apply_by", "apply_type", "company", "documents", "employment_type", "industry",
               "job_type", "location", "location_type", "position", "posted_at", "url", "wage")
LOAD_SCHEMA = ("topic string, action string, about_codec string, about string, apply_by string, "
               "apply_type string, company string, documents array<string>, employment_type string, "
               "industry string, job_type string, location string, location_type array<string>, "
               "position string, posted_at string, url string, wage array<bigint>")


def encode_load_record(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """M7: flat record -> JSON with topic/action/about_codec, ``about``
    packed, timestamps as text. Nulls stay JSON null."""
    cols = []
    for f in LOAD_FIELDS:
        if f == "about":
            cols.append(pack_text("about").alias("about"))
        elif f in ("apply_by", "posted_at"):
            cols.append(F.date_format(F.col(f), TS_TEXT).alias(f))
        else:
            cols.append(F.col(f).alias(f))
    body = F.to_json(F.struct(F.lit(LOAD_TOPIC).alias("topic"), F.lit(ACTION_LOAD).alias("action"),
                              F.lit("zlib").alias("about_codec"), *cols), {"ignoreNullFields": "false"})
    return df.select(*keep, F.encode(body, "UTF-8").alias("value"))


def decode_load_record(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()
                       ) -> tuple[DataFrame, DataFrame]:
    """M8: validate, inflate ``about``, parse timestamps -> (good, quarantine).

    A good record has every field of the load record as a key, null where its
    type allows it, and values of the declared types.
    """
    text = F.decode(F.col(value), "UTF-8") if dict(df.dtypes).get(value) == "binary" else F.col(value)
    m = df.select(*keep, text.alias("_text"), F.from_json(text, LOAD_SCHEMA).alias("_m"),
                  F.coalesce(F.json_object_keys(text), F.array().cast("array<string>")).alias("_keys"))      # once a row
    about_txt = unpack_text(F.col("_m.about"))

    def ts(name):
        raw = F.col(f"_m.{name}")
        return F.try_to_timestamp(raw, F.lit(TS_TEXT)).cast("timestamp_ntz")

    out = m.select(*keep, "_text", "_keys", about_txt.alias("about"), ts("apply_by").alias("apply_by"),
                   *[F.col(f"_m.{f}").alias(f) for f in LOAD_FIELDS if f not in ("about", "apply_by", "posted_at")],
                   ts("posted_at").alias("posted_at"),
                   F.col("_m.topic").alias("_topic"), F.col("_m.action").alias("_action"),
                   F.col("_m.about_codec").alias("_codec"), F.col("_m.about").alias("_about_raw"),
                   F.col("_m.apply_by").alias("_apply_raw"), F.col("_m.posted_at").alias("_posted_raw"))
    errs = F.filter(F.array(
        *[F.when(~F.array_contains("_keys", f), F.lit(f"M8_missing_{f}")) for f in LOAD_FIELDS],
        # there, but not a value of the declared type: never a good row with a null; only nulls are looked up in the text
        *[F.when(F.col(f).isNull() & F.get_json_object("_text", f"$.{f}").isNotNull(), F.lit(f"M8_bad_{f}"))
          for f in LOAD_FIELDS if f not in ("about", "apply_by", "posted_at")],
        F.when(F.col("_topic").isNull() | (F.col("_topic") != LOAD_TOPIC), F.lit("M8_topic")),
        F.when(F.col("_action").isNull() | (F.col("_action") != ACTION_LOAD), F.lit("M8_action")),
        F.when(F.col("_codec").isNull() | (F.col("_codec") != "zlib"), F.lit("M8_codec")),
        F.when(F.col("_about_raw").isNotNull() & F.col("about").isNull(), F.lit("M8_about")),
        F.when(F.col("_apply_raw").isNotNull() & F.col("apply_by").isNull(), F.lit("M8_apply_by")),
        F.when(F.col("_posted_raw").isNotNull() & F.col("posted_at").isNull(), F.lit("M8_posted_at")),
        F.when(F.col("documents").isNull(), F.lit("M8_documents")),
        F.when(F.col("location_type").isNull(), F.lit("M8_location_type"))), lambda e: e.isNotNull())
    tagged = barrier(out.withColumn("_errors", errs).drop("_keys", "_topic", "_action", "_codec", "_about_raw",
                                                           "_apply_raw", "_posted_raw"), "decode_load_record")
    return (tagged.filter(F.size("_errors") == 0).drop("_errors", "_text"),
            tagged.filter(F.size("_errors") > 0).select(*keep, F.col("_text").alias("value"), "_errors"))
