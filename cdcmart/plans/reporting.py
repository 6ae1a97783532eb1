"""The report set of a mart: computed, checked against its contracts and stored."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.operators import reports
from cdcmart.operators.contracts import CONTRACTS, schema_differences, stamp, violations
from cdcmart.sinks import files
from cdcmart.sinks.mart import Mart

# Each report with the tables it reads.
REPORTS = {
    "delivery_status_summary": {"fact_orders"},
    "top_delivery_dates": {"fact_orders"},
    "pending_items_by_product": {"fact_order_items", "fact_orders", "dim_product"},
    "top_customers": {"fact_orders", "dim_customer"},
}

# How long a stored report stays after a newer one was stored.
RETENTION = dt.timedelta(days=1)

# Length rules of report columns (none of the four has one of its own) go here, by report.
MAX_LENGTHS: dict[str, dict[str, int]] = {}


class BrokenContract(RuntimeError):
    """A report that must not be served."""


def report_set(mart: Mart, names: Iterable[str] = tuple(REPORTS), k: int = 3) -> dict[str, DataFrame]:
    """Reports over the current state, by name."""
    orders = mart.read("fact_orders")
    make = {
        "delivery_status_summary": lambda: reports.delivery_status_summary(orders),
        "top_delivery_dates": lambda: reports.top_delivery_dates(orders, k),
        # The report joins the orders itself, so the items' own copy of the status is not needed.
        "pending_items_by_product": lambda: reports.pending_items_by_product(
            mart.current("fact_order_items"), orders, mart.read("dim_product")
        ),
        "top_customers": lambda: reports.top_customers(orders, mart.read("dim_customer"), k),
    }
    return {name: make[name]() for name in names}


def broken_rules(name: str, report: DataFrame) -> list[str]:
    """What a report breaks of its contract, schema first, then the rules of its rows; empty if nothing."""
    contract = CONTRACTS[name]
    found = schema_differences(report, contract)
    if found:
        return found
    lines = violations(report, contract, MAX_LENGTHS.get(name)).where("violations > 0").collect()
    return [f"{r['column_name']}: {r['violations']} of {r['n_rows']} rows break {r['rule']}" for r in lines]


def checked(name: str, report: DataFrame) -> DataFrame:
    """The report as it is, or ``BrokenContract``."""
    found = broken_rules(name, report)
    if found:
        raise BrokenContract(f"{name}: " + "; ".join(found))
    return report


def all_violations(made: dict[str, DataFrame]) -> DataFrame:
    """Every rule of every report with its rows and violations, as one frame."""
    found = None
    for name, report in made.items():
        lines = violations(report, CONTRACTS[name], MAX_LENGTHS.get(name)).select(F.lit(name).alias("report"), "*")
        found = lines if found is None else found.unionByName(lines)
    return found


def publish(mart: Mart, names: Iterable[str] = tuple(REPORTS), k: int = 3, folder: str | None = None) -> dict[str, str]:
    """Write whole reports, stamped, and return where each one is. A job of its own: it reads the whole mart.

    Each report is written to ``<folder>/<report>/version=<time>``, checked there, and moved nowhere: one that breaks
    its contract is removed and raises. Older versions go once a newer one has been there for a day.
    """
    now = dt.datetime.now(dt.timezone.utc)
    base = folder or f"{mart.root}/reports"
    written = {}
    for name, report in report_set(mart, names, k).items():
        differences = schema_differences(report, CONTRACTS[name])
        if differences:
            raise BrokenContract(f"{name}: " + "; ".join(differences))
        path = f"{base}/{name}/version={int(now.timestamp() * 1_000_000)}"
        stamp(report, now).write.mode("errorifexists").parquet(path)
        # The rows are checked as they were written, so the report is computed once.
        stored = mart.spark.read.parquet(path).drop("contract_version", "generated_at")
        try:
            checked(name, stored)
        except BrokenContract:
            files.remove_folder(mart.spark, path)
            raise
        written[name] = path
        _drop_older(mart, f"{base}/{name}")
    return written


def _drop_older(mart: Mart, folder: str) -> None:
    versions = sorted(int(v.split("=")[1]) for v in files.subfolders(mart.spark, folder))
    replaced = [
        v
        for v, after in zip(versions, versions[1:])
        if files.age(mart.spark, f"{folder}/version={after}") >= RETENTION.total_seconds()
    ]
    for v in replaced:
        files.remove_folder(mart.spark, f"{folder}/version={v}")


def latest_report(mart: Mart, name: str, folder: str | None = None) -> DataFrame | None:
    """The newest stored report; None before the first."""
    base = f"{folder or f'{mart.root}/reports'}/{name}"
    done = [
        v for v in files.subfolders(mart.spark, base) if files.exists(mart.spark, f"{base}/{v}/_SUCCESS")
    ]
    return mart.spark.read.parquet(f"{base}/{max(done)}") if done else None
