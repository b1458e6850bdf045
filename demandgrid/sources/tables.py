"""Reads of the driver tables and of the raw order-dump layout.

Reads always name their columns, so Catalyst prunes the Parquet scan to the
columns a query needs, and filters written after a read reach the scan as
``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.constants import DATE_COL, ENTITY_COL, SHIPPED_STATUSES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan of one driver table, pruned to ``columns``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def shipments(spark: SparkSession, sf_dir: str, grain: str = "nation",
              statuses: Sequence[str] = SHIPPED_STATUSES,
              date_col: str = DATE_COL, entity_col: str = ENTITY_COL) -> DataFrame:
    """One row per shipped line item: ``(date_col, entity_col)``.

    A shipment is a line item of an order whose status is in ``statuses``
    with a non-NULL ship date; the entity is the customer's nation (or its
    region). The two fact tables join on ``o_orderkey`` (sort-merge at scale,
    AQE splits a hot key); the nation/region dimensions are tiny by the
    schema (25 / 5 rows) and Spark broadcasts them by measured size.
    """
    orders = (read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
              .where(F.col("o_orderstatus").isin(list(statuses)))
              .select("o_orderkey", "o_custkey"))
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    lines = (read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"])
             .where(F.col("l_shipdate").isNotNull()))
    order_nation = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "c_nationkey")
    facts = lines.join(order_nation, lines.l_orderkey == order_nation.o_orderkey).select(
        F.to_date("l_shipdate").alias(date_col), "c_nationkey")
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    if grain == "nation":
        dim = nation.select(F.col("n_nationkey").alias("c_nationkey"),
                            F.col("n_name").alias(entity_col))
    elif grain == "region":
        region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
        dim = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias(entity_col))
    else:
        raise ValueError(f"grain must be 'nation' or 'region', got {grain!r}")
    return facts.join(dim, "c_nationkey").select(date_col, entity_col)


def shipment_counts(spark: SparkSession, sf_dir: str, grain: str = "nation",
                    statuses: Sequence[str] = SHIPPED_STATUSES, date_col: str = DATE_COL,
                    entity_col: str = ENTITY_COL, target_col: str = "n_shipments") -> DataFrame:
    """Sparse shipment counts per (date, entity), aggregated before naming.

    The count runs on the integer nation key (partial aggregation on the map
    side, so a hot nation or day never reaches one task as raw rows); only
    the small aggregate is mapped to nation or region names.
    """
    lines = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    return counts_from_facts(spark, sf_dir, lines, orders, grain, statuses, date_col, entity_col, target_col)


def counts_from_facts(spark: SparkSession, sf_dir: str, lines: DataFrame, orders: DataFrame,
                      grain: str = "nation", statuses: Sequence[str] = SHIPPED_STATUSES,
                      date_col: str = DATE_COL, entity_col: str = ENTITY_COL,
                      target_col: str = "n_shipments") -> DataFrame:
    """:func:`shipment_counts` on given ``lineitem`` / ``orders`` frames
    (Parquet scans, or the order-key bucketed tables of
    :func:`write_bucketed_facts`); dimensions are read from ``sf_dir``."""
    orders = orders.where(F.col("o_orderstatus").isin(list(statuses))).select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    lines = lines.where(F.col("l_shipdate").isNotNull())
    order_nation = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "c_nationkey")
    by_key = (lines.join(order_nation, lines.l_orderkey == order_nation.o_orderkey)
              .groupBy(F.to_date("l_shipdate").alias(date_col), "c_nationkey")
              .agg(F.count(F.lit(1)).alias(target_col)))
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    if grain == "nation":
        named = by_key.join(nation.select(F.col("n_nationkey").alias("c_nationkey"),
                                          F.col("n_name").alias(entity_col)), "c_nationkey")
        return named.select(date_col, entity_col, target_col)
    if grain == "region":
        region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
        dim = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias(entity_col))
        return (by_key.join(dim, "c_nationkey").groupBy(date_col, entity_col)
                .agg(F.sum(target_col).cast("long").alias(target_col)))
    raise ValueError(f"grain must be 'nation' or 'region', got {grain!r}")


def write_bucketed_facts(spark: SparkSession, sf_dir: str, folder: str, n_buckets: int,
                         names: tuple[str, str] = ("facts_lineitem", "facts_orders")) -> tuple[str, str]:
    """Write the join columns of ``lineitem`` and ``orders`` once, both
    bucketed by order key into ``n_buckets`` (external tables under
    ``folder``, a shared location on a cluster).

    Every later panel rebuild (:func:`bucketed_shipment_counts`) then joins
    line items to orders bucket by bucket: the line items, the widest input,
    are not shuffled again; only the (smaller) orders-with-nation side is
    hash-partitioned to the same bucket count. Use ``n_buckets`` >=
    ``spark.sql.shuffle.partitions`` so the planner keeps the bucketing.
    All rows are kept (no filter), so the copy answers any status choice.
    """
    if n_buckets < 1:
        raise ValueError(f"n_buckets must be positive, got {n_buckets}")
    parts = ((names[0], read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"]), "l_orderkey"),
             (names[1], read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"]),
              "o_orderkey"))
    for name, df, key in parts:
        (df.write.mode("overwrite").format("parquet").bucketBy(n_buckets, key)
         .option("path", f"{folder.rstrip('/')}/{name}").saveAsTable(name))
    return names


def bucketed_shipment_counts(spark: SparkSession, sf_dir: str,
                             names: tuple[str, str] = ("facts_lineitem", "facts_orders"),
                             grain: str = "nation", **kw) -> DataFrame:
    """:func:`shipment_counts` over the bucketed fact tables (same result)."""
    return counts_from_facts(spark, sf_dir, spark.table(names[0]), spark.table(names[1]), grain, **kw)


def event_rows(spark: SparkSession, sf_dir: str, date_col: str = DATE_COL,
               entity_col: str = ENTITY_COL) -> DataFrame:
    """The ``events`` stream table as ``(date_col, entity_col=event_type)``."""
    ev = read_table(spark, sf_dir, "events", ["ts", "event_type"]).where(
        F.col("ts").isNotNull() & F.col("event_type").isNotNull())
    return ev.select(F.to_date("ts").alias(date_col), F.col("event_type").alias(entity_col))


# ---------------------------------------------------------------------------
# Raw order-dump layout (CSV with header), explicit schemas: no inference.
# ---------------------------------------------------------------------------
_TS = T.TimestampType()
RAW_SCHEMAS: dict[str, T.StructType] = {
    "customers": T.StructType([
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("customer_unique_id", T.StringType(), True),
        T.StructField("customer_zip_code_prefix", T.IntegerType(), True),
        T.StructField("customer_city", T.StringType(), True),
        T.StructField("customer_state", T.StringType(), True),
    ]),
    "sellers": T.StructType([
        T.StructField("seller_id", T.StringType(), False),
        T.StructField("seller_zip_code_prefix", T.IntegerType(), True),
        T.StructField("seller_city", T.StringType(), True),
        T.StructField("seller_state", T.StringType(), True),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.StringType(), False),
        T.StructField("product_category_name", T.StringType(), True),
        T.StructField("product_name_lenght", T.DoubleType(), True),
        T.StructField("product_description_lenght", T.DoubleType(), True),
        T.StructField("product_photos_qty", T.DoubleType(), True),
        T.StructField("product_weight_g", T.DoubleType(), True),
        T.StructField("product_length_cm", T.DoubleType(), True),
        T.StructField("product_height_cm", T.DoubleType(), True),
        T.StructField("product_width_cm", T.DoubleType(), True),
    ]),
    "translation": T.StructType([
        T.StructField("product_category_name", T.StringType(), True),
        T.StructField("product_category_name_english", T.StringType(), True),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("order_status", T.StringType(), False),
        T.StructField("order_purchase_timestamp", _TS, False),
        T.StructField("order_approved_at", _TS, True),
        T.StructField("order_delivered_carrier_date", _TS, True),
        T.StructField("order_delivered_customer_date", _TS, True),
        T.StructField("order_estimated_delivery_date", _TS, True),
    ]),
    "order_items": T.StructType([
        T.StructField("order_id", T.StringType(), False),
        T.StructField("order_item_id", T.IntegerType(), False),
        T.StructField("product_id", T.StringType(), False),
        T.StructField("seller_id", T.StringType(), False),
        T.StructField("shipping_limit_date", _TS, True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("freight_value", T.DoubleType(), True),
    ]),
}
# Misspelled source column names and their corrected names.
PRODUCT_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def read_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV scan with header and the fixed schema of ``table``."""
    df = spark.read.schema(RAW_SCHEMAS[table]).option("header", True).csv(path)
    if table == "products":
        df = df.withColumnsRenamed(PRODUCT_RENAMES)
    return df


# Load order: referenced tables before those that refer to them.
def load_raw(spark: SparkSession, csv_dir: str, out_dir: str, batch: str | None = None) -> dict[str, int]:
    """Read the raw CSV of every table with its schema, write it as a table and
    return the stored rows per table, in load order. With ``batch`` the rows are
    added as that batch (``sources.incremental.append_batch``: loading it again
    replaces its own rows only), and the batch's rows are counted."""
    from demandgrid.sources.incremental import append_batch
    rows: dict[str, int] = {}
    for table in RAW_SCHEMAS:
        target = f"{out_dir.rstrip('/')}/{table}"
        raw = read_raw_csv(spark, f"{csv_dir.rstrip('/')}/{table}.csv", table)
        if batch is not None:
            rows[table] = append_batch(raw, target, batch)
            continue
        write_table(raw, target)
        rows[table] = spark.read.parquet(target).count()
    return rows


def products_with_category(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products left-joined to the category translation (unmatched kept).

    NULL categories never match (SQL join semantics), unlike a pandas merge.
    """
    return products.join(translation, "product_category_name", "left")


def raw_shipments(orders: DataFrame, customers: DataFrame,
                  statuses: Sequence[str] = ("delivered", "shipped"),
                  date_col: str = DATE_COL, entity_col: str = "customer_state") -> DataFrame:
    """Shipment rows of the raw layout: status filter, carrier date present."""
    valid = orders.where(F.col("order_status").isin(list(statuses))
                         & F.col("order_delivered_carrier_date").isNotNull())
    return valid.join(customers, "customer_id").select(
        F.to_date("order_delivered_carrier_date").alias(date_col),
        F.col("customer_state").alias(entity_col))


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------
def write_panel(panel: DataFrame, path: str, date_col: str = DATE_COL) -> None:
    """Full rebuild of the panel table: overwrite, partitioned by month so
    date-window reads prune partitions."""
    (panel.withColumn("month", F.date_format(date_col, "yyyy-MM"))
     .write.mode("overwrite").partitionBy("month").parquet(path))


def read_panel(spark: SparkSession, path: str, date_col: str = DATE_COL,
               entity_col: str = ENTITY_COL, target_col: str = "n_shipments") -> DataFrame:
    """Panel read: the three panel columns (a missing table is a clear error)."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no panel table at {path}") from e
    return df.select(date_col, entity_col, target_col)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a table (``sources.incremental.append_batch`` adds to one)."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV result scan with an explicit schema."""
    return spark.read.schema(schema).option("header", True).csv(path)
