"""Report totals from row changes: each changed row is taken back as it was and counted as it is.

Changes are rows with a sign: -1 as they were, 1 as they are. All totals are counts and sums, so the totals of two
sets of changes add up, and the totals of a whole table are those of its rows as changes from nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.operators import reports

SIGN = "_sign"


@dataclass(frozen=True)
class Totals:
    """Totals by some columns; a group is there while ``present`` is not 0."""

    by: tuple[str, ...]
    measures: tuple[str, ...]
    present: str


TOTALS = {
    "open_orders": Totals(("delivery_date", "status"), ("order_count",), "order_count"),
    "pending_items": Totals(
        ("product_id",), ("pending_quantity", "pending_item_count"), "pending_item_count"
    ),
    "pending_orders": Totals(("customer_id",), ("pending_order_count",), "pending_order_count"),
}


def appeared(rows: DataFrame) -> DataFrame:
    """Rows of which nothing was known before."""
    return rows.withColumn(SIGN, F.lit(1))


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows as they were and as they are; what is in neither must not have changed."""
    return before.withColumn(SIGN, F.lit(-1)).unionByName(appeared(after))


def open_orders(orders: DataFrame) -> DataFrame:
    """Open orders by delivery date and status, of order changes."""
    return reports.open_orders(orders).groupBy("delivery_date", "status").agg(
        F.sum(F.when(F.col("order_id").isNotNull(), F.col(SIGN)).otherwise(0)).alias("order_count")
    )


def pending_orders(orders: DataFrame) -> DataFrame:
    """Pending orders by customer, of order changes."""
    pending = orders.where(F.col("status") == reports.PENDING)
    return pending.groupBy("customer_id").agg(F.sum(SIGN).alias("pending_order_count"))


def pending_switches(orders: DataFrame) -> DataFrame:
    """Orders that became pending (1) or ceased to be (-1), of order changes; all others cancel out."""
    pending = orders.where((F.col("status") == reports.PENDING) & F.col("order_id").isNotNull())
    net = pending.groupBy("order_id").agg(F.sum(SIGN).alias("_switch"))
    return net.where("_switch <> 0")


def pending_items(
    items: DataFrame,
    orders: DataFrame,
    other_items: DataFrame | None = None,
    switches: DataFrame | None = None,
    source_field: str = reports.SOURCE_QUANTITY,
) -> DataFrame:
    """Quantity and items of pending orders by product, of item changes and of order changes.

    ``items`` are item changes and ``orders`` the orders as they are. ``switches`` are the orders of
    :func:`pending_switches`, which move the items as they were, ``other_items``, in or out.
    """
    quantity = reports.pending_quantity(source_field).cast("long").alias("_quantity")
    wanted = orders.where(F.col("status") == reports.PENDING).select("order_id")
    lines = items.where(F.col("order_id").isNotNull()).select("order_id", "product_id", quantity, SIGN)
    moved = lines.join(wanted, "order_id")
    if switches is not None:
        stayed = other_items.where(F.col("order_id").isNotNull()).select("order_id", "product_id", quantity)
        moved = moved.unionByName(stayed.join(switches, "order_id").withColumnRenamed("_switch", SIGN))
    return moved.groupBy("product_id").agg(
        F.sum(F.col("_quantity") * F.col(SIGN)).alias("pending_quantity"),
        F.sum(SIGN).alias("pending_item_count"),
    )


def added_up(parts: DataFrame, name: str) -> DataFrame:
    """Totals of all changes together, without groups that are gone."""
    totals = TOTALS[name]
    sums = [F.sum(m).alias(m) for m in totals.measures]
    return parts.groupBy(*totals.by).agg(*sums).where(F.col(totals.present) != 0)


# -- reports from totals ----------------------------------------------------------------------


def delivery_status_summary(totals: DataFrame) -> DataFrame:
    return totals.orderBy("delivery_date", "status")


def top_delivery_dates(totals: DataFrame, k: int = 3) -> DataFrame:
    by_date = totals.groupBy("delivery_date").agg(F.sum("order_count").alias("open_order_count"))
    return reports.top_k(by_date, k, "open_order_count", "delivery_date")


def pending_items_by_product(totals: DataFrame, products: DataFrame) -> DataFrame:
    return reports.with_product_names(totals, products).orderBy(F.desc("pending_quantity"), "product_id")


def top_customers(totals: DataFrame, customers: DataFrame, k: int = 3) -> DataFrame:
    return reports.top_k(reports.with_customer_names(totals, customers), k, "pending_order_count", "customer_id")


def union(parts: Iterable[DataFrame]) -> DataFrame:
    """All of some frames with the same columns."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first
