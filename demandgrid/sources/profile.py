"""Table profiling and load reconciliation (one aggregate pass per table)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def column_profile(df: DataFrame, table: str, approx: bool = False) -> DataFrame:
    """Per column: type, NULL count, NULL %, distinct count.

    One scan a table: every value becomes a ``(column, key)`` pair, where the key
    is the value itself for whole numbers, dates and times and a 128-bit digest
    for anything longer, so no text, page or vector is shuffled. Pairs are counted
    map-side first (a frequent value is one row per task); nulls, rows and distinct
    values follow from the counts. ``approx=True`` takes ``approx_count_distinct``
    (sketches that merge) in one pass over the table instead."""
    if approx:
        aggs = [F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                                   F.count_if(F.col(c).isNull()).alias("n_nulls"), F.count(F.lit(1)).alias("n"),
                                   F.approx_count_distinct(c).alias("n_distinct")) for c in df.columns]).alias("x")]
        parts = df.agg(*aggs).select(F.inline("x"))
    else:
        names = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"))
                          for c in df.columns])
        pairs = df.select(F.posexplode(F.array(*[value_key(df, c) for c in df.columns])).alias("at", "key"))
        counts = pairs.groupBy("at", "key").agg(F.count(F.lit(1)).alias("c"))
        own = counts.groupBy("at").agg(F.sum(F.when(F.col("key").isNull(), F.col("c"))).alias("nulls"), F.sum("c").alias("n"),
                                       F.count("key").alias("n_distinct"))
        # A table without rows still has its columns.
        found = own.agg(F.map_from_entries(F.collect_list(F.struct("at", F.struct("nulls", "n", "n_distinct")))).alias("found"))
        one = found.select("found", F.posexplode(names).alias("at", "name")).withColumn("f", F.try_element_at("found", F.col("at")))
        zero = F.lit(0).cast("long")
        parts = one.select("name.column_name", "name.data_type", *[F.coalesce(F.col(f"f.{c}"), zero).alias(out) for c, out in
                                                                   (("nulls", "n_nulls"), ("n", "n"), ("n_distinct", "n_distinct"))])
    return parts.select(F.lit(table).alias("table_name"), "column_name", "data_type",
                        F.col("n_nulls").cast("long").alias("n_nulls"),
                        F.round(F.try_divide(F.lit(100.0) * F.col("n_nulls"), F.col("n")), 2).alias("pct_nulls"),
                        F.col("n_distinct").cast("long").alias("n_distinct"))


def value_key(df: DataFrame, column: str) -> Column:
    """A short binary key that tells a column's values apart (NULL for NULL)."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return F.unhex(F.hex(c.cast("long")))
    if isinstance(kind, T.DateType):
        return F.unhex(F.hex(F.unix_date(c).cast("long")))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.unhex(F.md5((c + F.lit(0.0).cast(kind)).cast("string").cast("binary")))     # -0.0 is 0.0
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.unhex(F.md5(F.to_json(c).cast("binary")))
    return F.unhex(F.md5((c if isinstance(kind, T.BinaryType) else c.cast("string").cast("binary"))))


def sample_rows(df: DataFrame, rows: int = 3, order: Sequence[str] = ()) -> DataFrame:
    """The values of the first ``rows`` rows (by ``order``, else as they come) as
    text, a row per column, in the rows' order; missing values are NULL. The limit
    is the feature; with ``order`` it is a take-ordered, not a full sort."""
    first = (df.orderBy(*order) if order else df).limit(rows)
    values = first.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.transform(
        F.collect_list(F.struct(F.col(f"`{c}`").cast("string").alias("v"))), lambda s: s["v"]).alias("sample")) for c in df.columns]).alias("x"))
    return values.select(F.inline("x"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` for many tables in one union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "n_rows")


def reconcile(spark: SparkSession, expected: Mapping[str, int], actual: DataFrame) -> DataFrame:
    """Expected vs stored rows per table, with an ok / MISMATCH status."""
    exp = spark.createDataFrame([(k, int(v)) for k, v in expected.items()], "table_name string, expected long")
    return exp.join(actual, "table_name", "full").select(
        "table_name", "expected", F.col("n_rows").alias("actual"),
        F.when(F.col("expected") == F.col("n_rows"), "ok").otherwise("MISMATCH").alias("status"))
