"""The four mart reports and their totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcmart.operators.skew import salted_join
from cdcmart.specs import EXTRAS

# Order status values (fixed by the source system).
COMPLETED = "COMPLETED"
PENDING = "PENDING"

# The source spells its quantity column this way, so the value arrives among the unknown fields.
SOURCE_QUANTITY = "quanity"


def open_orders(orders: DataFrame) -> DataFrame:
    """Orders in any status but completed."""
    return orders.where(~F.col("status").isin(COMPLETED))


def delivery_status_summary(orders: DataFrame, ordered: bool = True) -> DataFrame:
    """Open orders by delivery date and status."""
    counts = (
        open_orders(orders)
        .groupBy("delivery_date", "status")
        .agg(F.count("order_id").alias("order_count"))
    )
    return counts.orderBy("delivery_date", "status") if ordered else counts


def open_order_total(orders: DataFrame) -> DataFrame:
    """Grand total of the delivery status summary; 0 when nothing is open."""
    summary = delivery_status_summary(orders, ordered=False)
    return summary.agg(F.coalesce(F.sum("order_count"), F.lit(0)).alias("total_open_orders"))


def top_delivery_dates(orders: DataFrame, k: int = 3) -> DataFrame:
    """The k delivery dates with most open orders; earlier dates win ties."""
    counts = (
        open_orders(orders)
        .groupBy("delivery_date")
        .agg(F.count("order_id").alias("open_order_count"))
    )
    return top_k(counts, k, "open_order_count", "delivery_date")


def pending_quantity(source_field: str = SOURCE_QUANTITY) -> Column:
    """Quantity from the unknown fields, else from the column, else 0."""
    return F.coalesce(
        F.get_json_object(EXTRAS, f"$.{source_field}").try_cast("int"),
        F.col("quantity"),
        F.lit(0),
    )


def pending_items_by_product(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    status_from: str = "order",
    source_field: str = SOURCE_QUANTITY,
    salt: int | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Quantity and number of items of pending orders, by product.

    Rows are counted per product before the product name is joined, so only totals meet the
    dimension. ``status_from="item"`` reads the status copied onto the items, which saves the
    join with the orders and agrees with it once the copy is in sync.
    """
    quantity = pending_quantity(source_field).alias("_quantity")
    if status_from == "item":
        pending = items.where(F.col("order_status") == PENDING).select("product_id", quantity)
    elif status_from == "order":
        wanted = orders.where(F.col("status") == PENDING).select("order_id")
        lines = items.where(F.col("order_id").isNotNull()).select("order_id", "product_id", quantity)
        pending = salted_join(lines, wanted, "order_id", "inner", salt)
    else:
        raise ValueError(f"status_from must be 'order' or 'item', got {status_from!r}")
    totals = pending.groupBy("product_id").agg(
        F.sum("_quantity").alias("pending_quantity"),
        F.count(F.lit(1)).alias("pending_item_count"),
    )
    named = with_product_names(totals, products)
    return named.orderBy(F.desc("pending_quantity"), "product_id") if ordered else named


def with_product_names(totals: DataFrame, products: DataFrame) -> DataFrame:
    """Totals by product with the product's name, null where it is not known."""
    return totals.join(products.select("product_id", "product_name"), "product_id", "left").select(
        "product_id", "product_name", "pending_quantity", "pending_item_count"
    )


def with_customer_names(counts: DataFrame, customers: DataFrame) -> DataFrame:
    """Counts by customer with the customer's name; those of unknown customers are left out."""
    return counts.join(customers.select("customer_id", "customer_name"), "customer_id").select(
        "customer_id", "customer_name", "pending_order_count"
    )


def top_customers(orders: DataFrame, customers: DataFrame, k: int = 3) -> DataFrame:
    """The k customers with most pending orders; orders of unknown customers do not count."""
    counts = (
        orders.where(F.col("status") == PENDING)
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("pending_order_count"))
    )
    return top_k(with_customer_names(counts, customers), k, "pending_order_count", "customer_id")


def top_k(rows: DataFrame, k: int, measure: str, tie_break: str) -> DataFrame:
    """The k rows with the largest measure, smallest tie-break first."""
    return rows.orderBy(F.desc(measure), tie_break).limit(k)


def with_rank(top: DataFrame, measure: str, tie_break: str, name: str = "rnk") -> DataFrame:
    """Position beside the rows of a top-k report, so equal measures still get different ranks.

    The window has no partition: use it on the k rows of :func:`top_k` only.
    """
    order = Window.orderBy(F.desc(measure), tie_break)
    return top.select(F.row_number().over(order).alias(name), *top.columns)
