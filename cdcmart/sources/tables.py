"""Scans of operational source tables, for backfills."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def file_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A source table exported to files."""
    return spark.read.format(fmt).load(path)


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC scan; key, bounds and partitions together make it a parallel one."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    given = [key is not None, bounds is not None, partitions is not None]
    if any(given) and not all(given):
        raise ValueError("key, bounds and partitions belong together")
    if key is not None:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def jdbc_table(spark: SparkSession, **arguments) -> DataFrame:
    """A source table over JDBC; filters and column selection are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(**arguments)).load()
