"""The given Parquet tables seen as mart tables and as a change feed."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions.envelope import build_records
from cdcmart.operators.reports import SOURCE_QUANTITY
from cdcmart.specs import CUSTOMERS, EXTRAS, OFFSET, ORDER_ITEMS, ORDERS, PRODUCTS, TableSpec

# Days between order and delivery in the source system.
DELIVERY_DAYS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with status letters spelled out and a delivery date."""
    status = (
        F.when(F.col("o_orderstatus") == "O", "PENDING")
        .when(F.col("o_orderstatus") == "P", "PROCESSING")
        .otherwise("COMPLETED")
    )
    ordered = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        ordered.alias("order_date"),
        F.date_add(ordered, DELIVERY_DAYS).alias("delivery_date"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("status"),
    )


def fact_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as order items, the quantity among the unknown fields as in the source system."""
    quantity = F.col("l_quantity").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.lit(None).cast("int").alias("quantity"),
        F.to_json(F.struct(quantity.alias(SOURCE_QUANTITY))).alias(EXTRAS),
    )


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as plain order lines."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )


# -- source rows in the operational schema ---------------------------------------------------


def _at(column: str) -> Column:
    return F.col(column).cast("timestamp")


def _no_user() -> Column:
    return F.lit(None).cast("long")


def source_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = F.timestamp_millis(F.lit(0))
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(F.col("c_acctbal") >= 0, F.lit(True)).alias("is_active"),
        F.lit(None).cast("string").alias("customer_address"),
        epoch.alias("updated_at"),
        _no_user().alias("updated_by"),
        epoch.alias("created_at"),
        F.col("c_nationkey").cast("long").alias("created_by"),
        F.col("c_mktsegment").alias("segment"),
    )


def source_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = F.timestamp_millis(F.lit(0))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("barcode"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unity_price"),
        F.lit(True).alias("is_active"),
        epoch.alias("updated_at"),
        _no_user().alias("updated_by"),
        epoch.alias("created_at"),
        _no_user().alias("created_by"),
        F.col("p_type").alias("kind"),
    )


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        fact_orders(spark, sf_dir)
        .withColumn("updated_at", F.col("order_date").cast("timestamp"))
        .withColumn("updated_by", _no_user())
        .withColumn("created_at", F.col("order_date").cast("timestamp"))
        .withColumn("created_by", F.col("customer_id"))
    )


# Line items repeat (order, line), so these two are their key here and the newest line survives.
LINE_ITEMS: TableSpec = dataclasses.replace(
    ORDER_ITEMS,
    key=("order_id", "line_no"),
    schema=T.StructType(
        [T.StructField("line_no", T.IntegerType())]
        + [f for f in ORDER_ITEMS.schema if f.name != "order_item_id"]
    ),
    required=("line_no", "quantity", "order_status"),
)


def source_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their ship date as change time, and a log position to break ties."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("line_no"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.lit(None).cast("int").alias("quantity"),
        _at("l_shipdate").alias("updated_at"),
        _no_user().alias("updated_by"),
        _at("l_shipdate").alias("created_at"),
        _no_user().alias("created_by"),
        F.col("l_quantity").cast("int").alias(SOURCE_QUANTITY),
        (F.col("l_partkey") * 100 + F.col("l_quantity").cast("int")).alias("position"),
    )


def snapshot_records(rows: DataFrame, spec: TableSpec, offset: Column) -> DataFrame:
    """Source rows as snapshot reads; columns outside the schema become unknown fields."""
    extras = {
        c: F.col(c) for c in rows.columns if c not in spec.schema.names and c != "position"
    }
    return build_records(rows, spec, spec.source, offset, F.lit("r"), extras)


SOURCES = {
    "dim_customer": (CUSTOMERS, source_customers, "customer_id"),
    "dim_product": (PRODUCTS, source_products, "product_id"),
    "fact_orders": (ORDERS, source_orders, "order_id"),
    "fact_order_items": (LINE_ITEMS, source_line_items, "position"),
}


def records_of(spark: SparkSession, sf_dir: str, name: str) -> tuple[TableSpec, DataFrame]:
    """A table of the given data as the change feed its first snapshot would produce."""
    spec, rows, offset = SOURCES[name]
    return spec, snapshot_records(rows(spark, sf_dir), spec, F.col(offset))


# -- the event table as a change feed ---------------------------------------------------------

USER_STATE = TableSpec(
    name="user_state",
    source="users",
    key=("user_id",),
    schema=T.StructType(
        [
            T.StructField("user_id", T.LongType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("is_active", T.BooleanType()),
            T.StructField("updated_at", T.TimestampType()),
            T.StructField("created_at", T.TimestampType()),
        ]
    ),
    defaults={"is_active": True},
    required=("user_id", "is_active"),
    soft_delete_flag="is_active",
)


def event_records(events: DataFrame) -> DataFrame:
    """``events`` as change records: sign-ups create, errors delete, the rest update.

    ``props`` plays the field the table schema does not know.
    """
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )
    rows = events.select(
        "user_id",
        "value",
        F.lit(None).cast("boolean").alias("is_active"),
        _at("ts").alias("updated_at"),
        _at("ts").alias("created_at"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        "event_id",
        op.alias("op"),
    )
    return build_records(
        rows, USER_STATE, USER_STATE.source, F.col("event_id"), F.col("op"), {"k": F.col("k")}
    )
