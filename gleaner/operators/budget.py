"""Token counts, cost, token/USD budgets, usage and rate reports.

A1/A2/A5/A6/A7 are plain hash aggregates and broadcast joins with the
(3-row, fixed) model catalogue.

A3/A4 are an ordered fold per budget key: a request is admitted iff
``used + tokens <= limit``; a refused request does not consume, so a later
smaller one may still fit. That is not a running sum; ``budget`` computes it
exactly with rounds of parallel prefix sums, each up to a key's next refusal,
over only the requests that can still fit, so a key holding most of the rows
is split across tasks instead of being walked by one. Requests that keep
arriving are budgeted by ``gleaner.streaming.budget``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values from the reference's model catalogue.
MODEL_CATALOG = [
    # model, dim, cost_per_token (USD), rpm_limit, tpm_limit
    ("nomic-embed-text", 768, 0.02e-6, None, None),
    ("text-embedding-3-small", 1536, 0.02e-6, 3000, 1e6),
    ("text-embedding-3-large", 3072, 0.13e-6, 3000, 1e6),
]
CATALOG_SCHEMA = "model string, dim int, cost_per_token double, rpm_limit int, tpm_limit double"


def model_catalog(spark: SparkSession) -> DataFrame:
    """The supported embedding models (a fixed 3-row table)."""
    return spark.createDataFrame(MODEL_CATALOG, CATALOG_SCHEMA)


def whitespace_tokens(text) -> Column:
    """Default tokenizer: number of whitespace-separated words (native)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.when(t.isNotNull(), F.size(F.regexp_extract_all(t, F.lit(r"\S+"), F.lit(0)))).cast("bigint")


def count_tokens(df: DataFrame, text: str, by: list[str], tokenizer=None, out: str = "tokens") -> DataFrame:
    """A1: total tokens per request (``by``) over its chunks.

    ``tokenizer`` is ``None`` (whitespace words, native) or a Python
    function ``str -> int`` applied in Arrow batches.
    """
    return with_tokens(df, text, tokenizer, out).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(out).alias(out))


def with_tokens(df: DataFrame, text: str, tokenizer=None, out: str = "tokens") -> DataFrame:
    if tokenizer is None:
        return df.withColumn(out, whitespace_tokens(text))

    @F.pandas_udf(T.LongType())
    def tok(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else int(tokenizer(x)))

    return df.withColumn(out, tok(F.col(text)))


def cost(df: DataFrame, catalog: DataFrame, tokens: str = "tokens", model: str = "model") -> DataFrame:
    """A2: tokens x cost_per_token of the row's model (catalogue broadcast;
    it is a fixed 3-row table)."""
    cat = F.broadcast(catalog.select(F.col("model").alias(model), "cost_per_token"))
    return df.join(cat, model, "left").withColumn("cost_usd", F.col(tokens) * F.col("cost_per_token"))


USD_SCALE = 10 ** 18          # USD is accounted in exact integer units of 1e-18 USD


def usd_units(x) -> int:
    """Exact integer units for a price or a USD amount given as a float."""
    from decimal import Decimal

    return int(Decimal(repr(float(x))) * USD_SCALE)


def _dlit(v: int) -> Column:
    """Exact decimal(38,0) literal (beyond the 64-bit range of ``lit``)."""
    return F.lit(str(int(v))).cast("decimal(38,0)")


DEC = "decimal(38,0)"


def limits(token_limit: float | None, usd_limit: float | None, price: float | None) -> tuple[int | None, int | None, int]:
    """Token limit, USD limit and price in whole units; an argument error where they make no budget."""
    if usd_limit is not None and price is None:
        raise ValueError("USD limiting needs a price per token")
    if token_limit is None and usd_limit is None:
        raise ValueError("no limit given")
    return (None if token_limit is None else int(token_limit), None if usd_limit is None else usd_units(usd_limit),
            0 if price is None else usd_units(price))


def budget(df: DataFrame, key: list[str], order: list[str], tokens: str = "tokens",
           token_limit: float | None = None, usd_limit: float | None = None,
           price: float | None = None, partitions: int | None = None) -> DataFrame:
    """A3/A4: admit requests in ``order`` within each ``key`` under the limits.

    Token limit first; a request refused by tokens consumes nothing. Then the
    USD limit on ``tokens * price``; a request refused by USD keeps its
    tokens spent (as in the reference). Adds ``tok_ok`` and ``admitted``. Null
    tokens count as 0; key columns are compared as they are, nulls as equal.

    Exact and parallel, also for a key holding most of the rows, whatever
    sortable types ``order`` has. Rows are range-partitioned by key and order
    once, so a key takes as many partitions as its rows need. Then, in rounds
    over the rows not decided yet, each round knowing its keys' counters:

    1. rows whose cost no longer fits are refused by USD whatever comes, and
       only their tokens count; running sums per key and partition, plus what
       lies before the partition (a table of one row per key and partition),
       decide every row up to the key's first violation of a limit;
    2. the violating row is refused and the counters behind it are known;
    3. of the rows behind it, those whose tokens do not fit any more can change
       nothing and are refused at once; the others go to the next round.

    A round ends by a row that fitted the budget left before it and does not
    fit the one left after it, so what may still be admitted shrinks fast: a
    budget takes a few rounds. USD is accounted in integer units of 1e-18 USD,
    so sums are exact and independent of the summation order.
    """
    from pyspark.sql import Observation, Window

    from gleaner.session import scratch_path

    tl, ul, price_u = limits(token_limit, usd_limit, price)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def fixed(frame: DataFrame, name: str) -> tuple[DataFrame, int]:
        # several branches read it, and ranges are sampled anew whenever they are computed
        path, seen = scratch_path(spark, name), Observation(name)
        frame.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path), int(seen.get["n"] or 0)

    cost_units = (F.col("_t").cast(DEC) * _dlit(price_u)).cast(DEC)
    src = df.withColumn("_k", F.struct(*key)).withColumn("_t", F.coalesce(F.col(tokens).cast("bigint"), F.lit(0).cast("bigint")))
    src = src.withColumn("_c", cost_units).withColumn("_t0", F.lit(0).cast("bigint")).withColumn("_c0", _dlit(0))
    ordered = src.repartitionByRange(n, "_k", *order).sortWithinPartitions("_k", *order)
    left = ordered.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))

    in_part = Window.partitionBy("_k", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before_part = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    affordable = F.lit(True) if ul is None else F.col("_c") <= (_dlit(ul) - F.col("_c0")).cast(DEC)
    no_tokens = F.lit(False) if tl is None else F.col("_pt") > F.lit(tl) - F.col("_t0")
    no_usd = F.lit(False) if ul is None else F.col("_usd") & (F.col("_pc") > (_dlit(ul) - F.col("_c0")).cast(DEC))

    decided = []
    left, _ = fixed(left, "budget-rows")
    while True:
        rows = left.withColumn("_usd", affordable)
        spent = F.when(F.col("_usd"), F.col("_c")).otherwise(_dlit(0))
        totals = rows.groupBy("_k", "_part").agg(F.sum("_t").alias("_t"), F.sum(spent).alias("_c"))
        earlier = totals.select("_k", "_part", F.coalesce(F.sum("_t").over(before_part), F.lit(0)).alias("_ot"),
                                F.coalesce(F.sum("_c").over(before_part), _dlit(0)).alias("_oc"))
        sums = rows.withColumn("_pt", F.sum("_t").over(in_part)).withColumn("_pc", F.sum(spent).over(in_part)) \
            .join(earlier, ["_k", "_part"]).withColumn("_pt", F.col("_pt") + F.col("_ot")) \
            .withColumn("_pc", (F.col("_pc") + F.col("_oc")).cast(DEC)).drop("_ot", "_oc")
        sums = sums.withColumn("_no_tok", no_tokens).withColumn("_bad", F.col("_no_tok") | no_usd)
        sums, count = fixed(sums, "budget-sums")
        if not count and decided:
            break
        own = F.when(F.col("_no_tok"), F.col("_t")).otherwise(F.lit(0))
        first = sums.where("_bad").groupBy("_k").agg(F.min_by(F.struct(
            F.col("_at").alias("at"), F.col("_no_tok").alias("no_tok"), (F.col("_t0") + F.col("_pt") - own).alias("t0"),
            (F.col("_c0") + F.col("_pc") - F.when(F.col("_usd"), F.col("_c")).otherwise(_dlit(0))).cast(DEC).alias("c0")), "_at").alias("_v"))
        seen = sums.join(first, "_k", "left")
        behind = F.coalesce(F.col("_at") > F.col("_v.at"), F.lit(False))
        at_it = F.coalesce(F.col("_at") == F.col("_v.at"), F.lit(False))
        if tl is not None:
            fits = F.col("_t") <= F.lit(tl) - F.col("_v.t0")
        else:
            fits = F.col("_c") <= (_dlit(ul) - F.col("_v.c0")).cast(DEC)
        tok_ok = F.lit(True) if tl is None else F.when(behind, F.lit(False)).when(at_it, ~F.col("_v.no_tok")).otherwise(F.lit(True))
        decided.append(seen.where(~behind | ~fits).select(
            *df.columns, tok_ok.alias("tok_ok"), (~behind & ~at_it & F.col("_usd")).alias("admitted")))
        left = seen.where(behind & fits).select(*df.columns, "_k", "_t", "_c", F.col("_v.t0").alias("_t0"), F.col("_v.c0").alias("_c0"),
                                                "_at", "_part")
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out


def usage_report(budgeted: DataFrame, key: list[str], tokens: str = "tokens", token_limit: float | None = None,
                 usd_limit: float | None = None, price: float | None = None) -> DataFrame:
    """A5: used / remaining per budget key. Without a limiter the remaining
    amount is null (the reference raises)."""
    spent_tok = F.sum(F.when(F.col("tok_ok"), F.col(tokens)).otherwise(F.lit(0))).cast("double")
    units = F.col(tokens).cast("decimal(38,0)") * _dlit(usd_units(price or 0.0))
    # exact integer sum, then one division (decimal / decimal would round
    # to the result type's scale)
    spent_usd = F.sum(F.when(F.col("admitted"), units).otherwise(F.lit(0))).cast("double") / F.lit(float(USD_SCALE))
    rep = budgeted.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum(F.col("admitted").cast("long")).alias("n_admitted"),
        spent_tok.alias("used_tokens"), spent_usd.alias("used_usd"))
    return rep.select(
        *key, "n_requests", "n_admitted", "used_tokens",
        (F.lit(token_limit) - F.col("used_tokens") if token_limit is not None
         else F.lit(None).cast("double")).alias("remaining_tokens"),
        "used_usd",
        (F.lit(usd_limit) - F.col("used_usd") if usd_limit is not None
         else F.lit(None).cast("double")).alias("remaining_usd"))


def rate_audit(df: DataFrame, ts: str, model: str, tokens: str, catalog: DataFrame,
               window: str = "1 minute") -> DataFrame:
    """Requests and tokens per model per minute against the declared
    rpm/tpm limits (the reference declares them but never enforces them)."""
    per = df.groupBy(F.window(F.col(ts).cast("timestamp"), window).alias("w"), F.col(model).alias("model")).agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum(tokens).alias("n_tokens"))
    return over_limits(per, catalog)


def over_limits(per: DataFrame, catalog: DataFrame) -> DataFrame:
    """Counts per window ``w`` and model beside the model's declared limits."""
    out = per.join(catalog.select("model", "rpm_limit", "tpm_limit"), "model", "left")
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("minute"), "model", "n_requests", "n_tokens",
                      (F.col("n_requests") > F.col("rpm_limit")).alias("over_rpm"),
                      (F.col("n_tokens") > F.col("tpm_limit")).alias("over_tpm"))


def yield_report(expected: DataFrame, obtained: DataFrame, run: str = "run") -> DataFrame:
    """Expected vs obtained pages and postings per run.

    ``expected``: one row per requested page (``run, page, per_page``);
    ``obtained``: one row per successfully fetched page (``run, page``).
    """
    exp = expected.groupBy(run).agg(F.count(F.lit(1)).alias("expected_pages"),
                                    F.sum("per_page").alias("expected_postings"))
    got = obtained.groupBy(run).agg(F.count(F.lit(1)).alias("obtained_pages"),
                                    F.sum("per_page").alias("obtained_postings"))
    j = exp.join(got, run, "left").fillna(0, ["obtained_pages", "obtained_postings"])
    return j.withColumn("page_yield", F.round(F.col("obtained_pages") / F.col("expected_pages"), 6))
