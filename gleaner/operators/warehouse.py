"""Table CRUD as set-based DataFrame operations.

Plain Parquet tables have no in-place UPDATE/DELETE, so every mutating
operation returns a *new snapshot* DataFrame: updates are a join + ``coalesce``, deletes are a
``left_anti`` join or a negated, null-safe filter. Id lists always travel as
DataFrames and are joined, never inlined as a giant ``IN (...)`` literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# -- S6: the relational applications table ----------------------------------

APPLICATIONS_DDL = ("id BIGINT, posted_at TIMESTAMP_NTZ, work_type STRING, position STRING, "
                    "location STRING, company STRING, "
                    "pay STRUCT<lo: DECIMAL(18,2), hi: DECIMAL(18,2), lo_inc: BOOLEAN, hi_inc: BOOLEAN>")


def pay_range(lo, hi, bounds: str = "[)") -> Column:
    """A numeric range value; a 2-tuple becomes a half-open ``[lo, hi)``."""
    lo_c = (F.col(lo) if isinstance(lo, str) else F.lit(lo) if not isinstance(lo, Column) else lo)
    hi_c = (F.col(hi) if isinstance(hi, str) else F.lit(hi) if not isinstance(hi, Column) else hi)
    return F.struct(lo_c.cast("decimal(18,2)").alias("lo"), hi_c.cast("decimal(18,2)").alias("hi"),
                    F.lit(bounds[0] == "[").alias("lo_inc"), F.lit(bounds[1] == "]").alias("hi_inc"))


def create_applications(spark: SparkSession, name: str = "applications", location: str | None = None) -> None:
    """Create the table; an existing table is an error (as in the reference)."""
    if spark.catalog.tableExists(name):
        raise ValueError(f"table {name} already exists")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} ({APPLICATIONS_DDL}) USING parquet{loc}")


def drop_applications(spark: SparkSession, name: str = "applications") -> None:
    """Drop the table; a missing table is an error."""
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    spark.sql(f"DROP TABLE {name}")


def insert_applications(df: DataFrame, name: str = "applications") -> int:
    """Set-based append; returns the number of rows written (Q5).

    The count comes from ``observe`` on the write itself, so the data is
    scanned once. Rows without an ``id`` column get one, as a serial column
    would give it: above all ids there are, growing, with gaps.
    """
    from pyspark.sql import Observation

    if "id" not in df.columns:
        top = df.sparkSession.table(name).agg(F.max("id")).first()[0]
        df = df.withColumn("id", F.lit(0 if top is None else top + 1).cast("bigint") + F.monotonically_increasing_id())
    obs = Observation("insert")
    append_table(df.observe(obs, F.count(F.lit(1)).alias("n")), name)
    return int(obs.get["n"])


def append_table(df: DataFrame, name: str) -> None:
    """Append to a catalog table, matching columns by name (``insertInto``
    is positional)."""
    cols = df.sparkSession.table(name).columns
    df.select(*cols).write.mode("append").insertInto(name)


# -- S7/S8/E7: vector collection --------------------------------------------

def create_vectors(spark: SparkSession, name: str, dim: int, chunk_size: int, location: str | None = None) -> None:
    """Create if absent (no-op when present)."""
    if not isinstance(dim, int) or not isinstance(chunk_size, int):
        raise TypeError("dim and chunk_size must be int")
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (application_id BIGINT, chunk_idx BIGINT, "
              f"chunk_txt STRING, chunk_vec ARRAY<FLOAT>) USING parquet "
              f"TBLPROPERTIES ('dim'='{dim}', 'chunk_size'='{chunk_size}'){loc}")


def drop_vectors(spark: SparkSession, name: str) -> None:
    """Drop if present (no-op when absent)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def delete_by_ids(base: DataFrame, ids: DataFrame, key: str, id_col: str | None = None) -> DataFrame:
    """Remove every row whose key is in ``ids`` (left_anti join;
    duplicate ids need no dedup shuffle, the anti join ignores them)."""
    id_col = id_col or key
    return base.join(ids.select(F.col(id_col).alias(key)), key, "left_anti")


def rows_by_ids(base: DataFrame, ids: DataFrame, key: str, id_col: str | None = None) -> DataFrame:
    """Rows whose key is in ``ids`` (left_semi join)."""
    id_col = id_col or key
    return base.join(ids.select(F.col(id_col).alias(key)), key, "left_semi")


# -- Q1-Q7 ------------------------------------------------------------------

def select_rows(df: DataFrame, columns: list[str], where: Column | None = None,
                distinct: bool = False, order_by: list[Column] | None = None,
                limit: int | None = None, offset: int = 0) -> DataFrame:
    """Q1-Q4: SELECT [DISTINCT] cols WHERE ... ORDER BY ... LIMIT/OFFSET.

    LIMIT/OFFSET require a total order (ties are broken by the caller's
    ``order_by``); Spark plans ``TakeOrderedAndProject`` for it.
    """
    out = df if where is None else df.filter(where)
    out = out.select(*columns)
    if distinct:
        out = out.distinct()
    if order_by:
        out = out.orderBy(*order_by)
    if offset:
        if not order_by:
            raise ValueError("OFFSET needs ORDER BY for a deterministic result")
        out = out.offset(offset)
    if limit is not None:
        out = out.limit(limit)
    return out


def insert_rows(base: DataFrame, new: DataFrame) -> DataFrame:
    """Q5: the snapshot after a multi-row insert."""
    return base.unionByName(new)


def update_where(base: DataFrame, where: Column, assignments: dict[str, Column]) -> DataFrame:
    """Q6: UPDATE ... SET ... WHERE (rows where ``where`` is null are untouched)."""
    hit = F.coalesce(where, F.lit(False))
    return base.select(*[F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c)
                         if c in assignments else F.col(c) for c in base.columns])


def update_by_ids(base: DataFrame, updates: DataFrame, key: str, fields: list[str], order: str | None = None) -> DataFrame:
    """Q6: per-id field update from an updates DataFrame.

    Of several updates of one id the last in ``order`` (a column of
    ``updates``) counts, so rows of ``base`` never multiply; without ``order``
    the largest by ``fields`` in turn.
    """
    last = F.struct(*([order] if order else []), *fields)
    one = updates.groupBy(F.col(key).alias("_k")).agg(F.max(last).alias("_u"))
    u = one.select("_k", *[F.col(f"_u.{f}").alias(f"_u_{f}") for f in fields], F.lit(True).alias("_hit"))
    joined = base.join(u, base[key] == u["_k"], "left")
    return joined.select(*[F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(base[c]).alias(c)
                           if c in fields else base[c] for c in base.columns])


def delete_where(base: DataFrame, where: Column) -> DataFrame:
    """Q7: DELETE ... WHERE; rows where the predicate is null are kept."""
    return base.filter(~F.coalesce(where, F.lit(False)))
