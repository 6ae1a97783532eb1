"""Writing a batch to a database staging table, or merging it into a catalog table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.operators.upsert import LAST_BATCH, NEWEST
from cdcmart.specs import TableSpec


def staging_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    partitions: int = 8,
) -> dict[str, str]:
    """Options of a staging write: empty the table but keep its definition, and cap connections."""
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": str(batch_size),
        "numPartitions": str(partitions),
        **(properties or {}),
    }


def write_jdbc_staging(batch: DataFrame, **arguments) -> None:
    """Replace the rows of a staging table by one micro-batch."""
    batch.write.format("jdbc").options(**staging_options(**arguments)).mode("overwrite").save()


def merge_into_table(
    latest: DataFrame, table: str, spec: TableSpec, on_conflict: str = LAST_BATCH
) -> None:
    """Upsert a batch, one row per key, into a catalog table whose format supports MERGE.

    With ``newest`` a matched row is updated only where the batch's order columns are not smaller.
    """
    names = [c for c in spec.columns if c in latest.columns]
    matched = {c: F.col(f"s.{c}") for c in names if c not in (*spec.key, *spec.insert_only)}
    on = " and ".join(f"{table}.{k} = s.{k}" for k in spec.key)
    merge = latest.alias("s").mergeInto(table, F.expr(on))
    update = merge.whenMatched(newer(table, spec)) if on_conflict == NEWEST else merge.whenMatched()
    update.update(matched).whenNotMatched().insert({c: F.col(f"s.{c}") for c in names}).merge()


def newer(table: str, spec: TableSpec) -> Column:
    """The batch's row is at least as new as the table's; a null is older than anything."""
    mine, theirs = (", ".join(f"{side}.{c}" for c in spec.order_by) for side in ("s", table))
    return F.expr(f"struct({mine}) >= struct({theirs})")


@dataclass(frozen=True)
class Outside:
    """A current-state table that is kept elsewhere: how to read it, and how to upsert the newest rows of a batch.

    The write has to bear a batch that comes again; an upsert does.
    """

    read: Callable[[], DataFrame]
    write: Callable[[DataFrame], None]


def catalog_table(spark: SparkSession, table: str, spec: TableSpec, on_conflict: str = LAST_BATCH) -> Outside:
    """A catalog table whose format supports ``MERGE``."""
    return Outside(lambda: spark.table(table), lambda latest: merge_into_table(latest, table, spec, on_conflict))
