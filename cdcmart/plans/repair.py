"""Repair jobs: backfill, reset and replay."""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.operators import backfill as ops
from cdcmart.operators import upsert
from cdcmart.sinks.mart import Mart

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class BackfillResult:
    """Counts of a backfill; a dry run has the plan and the extracted count only."""

    table: str
    rows_extracted: int
    rows_before: int | None = None
    rows_after: int | None = None
    net_change: int | None = None
    version: int | None = None
    plan: str | None = None


def backfill(
    mart: Mart,
    name: str,
    source: DataFrame,
    from_date: str | dt.date,
    to_date: str | dt.date | None = None,
    dry_run: bool = False,
    date_column: str = "created_at",
    renames: Mapping[str, str] | None = None,
) -> BackfillResult:
    """Upsert the source rows of a date range into a mart table.

    The range overwrites streamed rows unless the mart keeps the newest. Columns the source
    does not deliver keep their stored value. Only the extracted rows are written.
    """
    table = mart.table(name)
    spec = table.spec
    rows = ops.extract(source, spec, from_date, to_date, date_column, renames)

    def prepared() -> DataFrame:
        latest = upsert.drop_duplicate_keys(rows, spec)
        if "order_status" in spec.derived:
            wanted = rows.select("order_id").where("order_id is not null")
            latest = upsert.denormalize(latest, mart.current("fact_orders", wanted))
        absent = [c for c in spec.columns if c not in latest.columns]
        filled = upsert.carry_over(latest, mart.current(spec.name, rows), spec, absent)
        return upsert.apply_defaults(filled, spec)

    if dry_run:
        return BackfillResult(spec.name, rows_extracted=rows.count(), plan=_plan(prepared()))

    outside = spec.name in mart.outside
    # Reserved before anything is read, so that no fold of a stream beside this job passes it by.
    version = None if outside else table.claim()
    try:
        changes = prepared().persist()
        try:
            counts = ops.run_summary(mart.current(spec.name).select(*spec.key), changes, spec).first().asDict()
            if counts["rows_extracted"] == 0:
                logger.warning("%s: the source has no rows from %s to %s", spec.name, from_date, to_date)
                return BackfillResult(spec.name, **counts)
            mart.commit(spec.name, changes, version)
            if outside:
                return BackfillResult(spec.name, **counts)
            # Only a claim that outlived its day can have been passed by; the rows then go in again.
            while table.superseded(version):
                table.release(version)
                version = table.claim()
                table.commit_changes(changes, version)
            return BackfillResult(spec.name, version=version, **counts)
        finally:
            changes.unpersist()
    finally:
        if version is not None:
            table.release(version)


def sync_status(mart: Mart, name: str = "fact_order_items", orders: str = "fact_orders") -> int | None:
    """Store the present status of their orders with the items that differ; returns the version written.

    Only orders changed since the last sync are looked at, and only items of those are read and written; once a
    rewrite or a replay of the orders has folded those changes away, all items are compared once.
    """
    items, parents = mart.table(name), mart.table(orders)
    kept = {items.spec.name, parents.spec.name} & set(mart.outside)
    if kept:
        return _sync_outside(mart, items.spec.name, parents.spec.name)
    seen, latest = items.synced_to(orders), parents.latest_version()
    if latest <= seen:
        return None
    changed = parents.changed_since(seen, latest)
    known = parents.read(latest, keys=changed)
    able = items.read().where("order_id is not null")
    touched = able if changed is None else able.join(changed.select("order_id").distinct(), "order_id", "left_semi")
    version = items.claim()
    try:
        stale = _stale(touched, known).persist()
        try:
            wrote = not stale.isEmpty()
            if wrote:
                items.commit_changes(stale, version)
        finally:
            stale.unpersist()
        items.mark_synced(orders, latest)
        return version if wrote else None
    finally:
        items.release(version)


def sync_after_commit(mart: Mart, name: str, version: int) -> None:
    """For ``on_commit`` of the streams: a batch of orders stores their status with the items, a batch of items does
    that itself."""
    if name == "fact_orders":
        sync_status(mart)


def _stale(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items that store another status than their order has, with the present one."""
    fresh = upsert.sync_from(items.withColumn("_stored", F.col("order_status")), orders)
    return fresh.where(~F.col("_stored").eqNullSafe(F.col("order_status"))).drop("_stored")


def _sync_outside(mart: Mart, items: str, orders: str) -> int | None:
    """:func:`sync_status` where one of the tables has no versions to go by: all items are compared."""
    stale = _stale(mart.current(items).where("order_id is not null"), mart.current(orders)).persist()
    try:
        if stale.isEmpty():
            return None
        if items in mart.outside:
            mart.outside[items].write(stale)
            return None
        table = mart.table(items)
        version = table.claim()
        try:
            table.commit_changes(stale, version)
        finally:
            table.release(version)
        return version
    finally:
        stale.unpersist()


def _plan(df: DataFrame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def reset_table(mart: Mart, name: str, replay: bool = False) -> dict:
    """Empty one table and its history; with ``replay`` its stream starts over as well."""
    table = mart.table(name)
    if table.spec.name in mart.outside:
        raise ValueError(f"{table.spec.name} is kept outside: empty it there")
    before = table.read().count()
    version = table.reset()
    if replay:
        table.start_generation()
    return {
        "table": table.spec.name,
        "rows_before": before,
        "rows_after": table.read().count(),
        "version": version,
        "checkpoint": mart.checkpoint(name),
    }


def reset_all(mart: Mart, replay: bool = True) -> list[dict]:
    """Empty every table, all histories included."""
    return [reset_table(mart, name, replay) for name in mart.specs]


def request_replay(mart: Mart, *names: str) -> dict[str, str]:
    """Let the streams of some tables, or of all, start over without emptying anything.

    Returns the new checkpoint folders. Where to start is an option of the source
    (``replay.starting_offsets``).
    """
    chosen = names or tuple(mart.specs)
    for name in chosen:
        mart.table(name).start_generation()
    return {name: mart.checkpoint(name) for name in chosen}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table, as ``(table_name, n)``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result
