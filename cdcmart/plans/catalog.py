"""The mart's tables in the session catalog, for SQL beside the mart, and their validation there.

A catalog table stands on the newest full state of a mart table: it shows what the last fold has made, not the changes
after it. Registering again moves it on; readers that were planned before keep their files until they are vacuumed.
"""

from __future__ import annotations

from cdcmart.operators.contracts import schema_differences
from cdcmart.sinks.mart import Mart

DATABASE = "mart"


def _location(mart: Mart, name: str) -> str | None:
    """Where the newest full state of a table is; None before the first."""
    table = mart.table(name)
    states = table.versions("state")
    return f"{table.path}/state/version={states[-1]}" if states else None


def _stands_on(mart: Mart, table: str) -> str:
    """The folder that a catalog table reads."""
    lines = mart.spark.sql(f"describe extended {table}").where("col_name = 'Location'").collect()
    return lines[0]["data_type"] if lines else ""


def register(mart: Mart, database: str = DATABASE, fold: bool = False) -> dict[str, str]:
    """Create or move the catalog tables ``<database>.<table>``; returns the folder each one reads.

    ``fold`` folds pending changes first, so that the tables are as new as the mart. Tables without a state and
    those that are kept outside are left alone.
    """
    spark = mart.spark
    spark.sql(f"create database if not exists {database}")
    made = {}
    for name, spec in mart.specs.items():
        if name in mart.outside:
            continue
        if fold:
            mart.table(name).rewrite()
        folder = _location(mart, name)
        if folder is None:
            continue
        table = f"{database}.{name}"
        if spark.catalog.tableExists(table):
            if not _stands_on(mart, table).endswith(folder.split("://")[-1]):
                spark.sql(f"alter table {table} set location '{folder}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path=folder, source="parquet", schema=spec.mart_schema)
        made[name] = folder
    return made


def problems(mart: Mart, database: str = DATABASE) -> list[str]:
    """What is wrong with the catalog's view of the mart: tables that are missing, whose columns differ from their
    spec, in the catalog or in the files, or that stand on an older state than the newest."""
    spark, found = mart.spark, []
    for name, spec in mart.specs.items():
        if name in mart.outside:
            continue
        table = f"{database}.{name}"
        if not spark.catalog.tableExists(table):
            found.append(f"{table}: missing")
            continue
        found += [f"{table}: {p}" for p in schema_differences(spark.table(table), spec.mart_schema)]
        folder = _stands_on(mart, table)
        if folder:
            stored = schema_differences(spark.read.parquet(folder), spec.mart_schema)
            found += [f"{table}: files: {p}" for p in stored]
        newest = _location(mart, name)
        if newest is None or not folder.endswith(newest.split("://")[-1]):
            found.append(f"{table}: does not stand on the newest state")
    return found


def validate(mart: Mart, database: str = DATABASE) -> None:
    """Fail where :func:`problems` finds any."""
    found = problems(mart, database)
    if found:
        raise RuntimeError("catalog validation failed: " + "; ".join(found))
