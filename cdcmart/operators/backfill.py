"""Date-range extraction from a source table and the counts of a backfill run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.functions.envelope import extra_columns_from_row
from cdcmart.specs import EXTRAS, OFFSET, TableSpec


def parse_date(text: str) -> dt.date:
    """Strict ``YYYY-MM-DD``."""
    try:
        return dt.datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError:
        raise ValueError(f"{text!r} is not a date of the form YYYY-MM-DD") from None


def extract(
    source: DataFrame,
    spec: TableSpec,
    from_date: str | dt.date,
    to_date: str | dt.date | None = None,
    date_column: str = "created_at",
    renames: Mapping[str, str] | None = None,
) -> DataFrame:
    """Source rows created in an inclusive date range, in the shape of the mart table.

    The range is written on the timestamp itself, so it reaches the Parquet or JDBC scan. Columns
    outside the table schema are kept as JSON; ``renames`` maps source names to mart names.
    """
    start = parse_date(from_date) if isinstance(from_date, str) else from_date
    end = parse_date(to_date) if isinstance(to_date, str) else to_date or dt.date.today()
    rows = source.withColumnsRenamed(dict(renames or {}))
    kind = rows.schema[date_column].dataType
    low = F.lit(start).cast(kind)
    high = F.lit(end + dt.timedelta(days=1)).cast(kind)
    window = rows.where((F.col(date_column) >= low) & (F.col(date_column) < high))
    wanted = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        for f in spec.schema
        if f.name in rows.columns and f.name not in spec.backfill_omits
    ]
    return window.select(
        *wanted,
        extra_columns_from_row(window, spec.schema.names).alias(EXTRAS),
        F.lit(0).cast("long").alias(OFFSET),
    )


def run_summary(target: DataFrame, extracted: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows before, extracted and after a backfill, and the net change, as one row.

    ``extracted`` holds each key at most once.
    """
    key = list(spec.key)
    known = target.select(*key, F.lit(0).alias("_known"))
    marked = extracted.select(*key).join(known, key, "left")
    parts = target.select(
        F.lit(1).alias("before"), F.lit(0).alias("extracted"), F.lit(0).alias("inserted")
    ).unionByName(
        marked.select(
            F.lit(0).alias("before"),
            F.lit(1).alias("extracted"),
            F.coalesce("_known", F.lit(1)).alias("inserted"),
        )
    )
    totals = parts.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("before", "extracted", "inserted")]
    )
    return totals.select(
        F.col("before").alias("rows_before"),
        F.col("extracted").alias("rows_extracted"),
        (F.col("before") + F.col("inserted")).alias("rows_after"),
        F.col("inserted").alias("net_change"),
    )
