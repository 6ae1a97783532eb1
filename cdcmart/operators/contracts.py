"""Column contracts of the reports and tables, and checks against them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.specs import TableSpec

CONTRACT_VERSION = "1.0.0"


def _contract(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else False) for f in fields])


CONTRACTS: dict[str, T.StructType] = {
    "delivery_status_summary": _contract(
        ("delivery_date", T.DateType()),
        ("status", T.StringType()),
        ("order_count", T.LongType()),
    ),
    "top_delivery_dates": _contract(
        ("delivery_date", T.DateType()),
        ("open_order_count", T.LongType()),
    ),
    "pending_items_by_product": _contract(
        ("product_id", T.LongType()),
        ("product_name", T.StringType(), True),
        ("pending_quantity", T.LongType()),
        ("pending_item_count", T.LongType()),
    ),
    "top_customers": _contract(
        ("customer_id", T.LongType()),
        ("customer_name", T.StringType()),
        ("pending_order_count", T.LongType()),
    ),
}


def table_contract(spec: TableSpec) -> T.StructType:
    """Contract of a mart table: its schema with the required columns marked."""
    return T.StructType(
        [T.StructField(f.name, f.dataType, f.name not in spec.required) for f in spec.mart_schema]
    )


def schema_differences(df: DataFrame, contract: T.StructType) -> list[str]:
    """Missing and unexpected columns and wrong types, as text; empty when the schema fits."""
    actual = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in contract}
    found = [f"missing column {n}" for n in wanted if n not in actual]
    found += [f"unexpected column {n}" for n in actual if n not in wanted]
    found += [
        f"column {n} is {actual[n].simpleString()}, expected {t.simpleString()}"
        for n, t in wanted.items()
        if n in actual and actual[n] != t
    ]
    return found


def violations(
    df: DataFrame, contract: T.StructType, max_lengths: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows breaking each rule, as ``(column_name, rule, n_rows, violations)``, in one pass.

    Rules: ``not_null`` for every required column, ``max_length`` for every bounded text.
    """
    rules = [
        (f.name, "not_null", F.col(f.name).isNull())
        for f in contract
        if not f.nullable and f.name in df.columns
    ]
    rules += [
        (n, "max_length", F.length(n) > size)
        for n, size in (max_lengths or {}).items()
        if n in df.columns
    ]
    if not rules:
        raise ValueError("the contract has no rule for any column of this frame")
    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(broken).alias(f"_{i}") for i, (_, _, broken) in enumerate(rules)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(rule).alias("rule"),
                F.col("n_rows").alias("n_rows"),
                F.col(f"_{i}").alias("violations"),
            )
            for i, (name, rule, _) in enumerate(rules)
        ]
    )
    return totals.select(F.inline(lines))


def stamp(report: DataFrame, generated_at: dt.datetime | None = None) -> DataFrame:
    """Add the contract version and the generation time to a report."""
    when = F.lit(generated_at) if generated_at else F.current_timestamp()
    return report.select(
        F.lit(CONTRACT_VERSION).alias("contract_version"), when.alias("generated_at"), *report.columns
    )
