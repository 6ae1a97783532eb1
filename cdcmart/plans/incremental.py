"""Reports kept up to date by what changed: a refresh reads the rows that were committed since the last one.

The totals behind the reports are kept as signed parts below ``<root>/totals``. A refresh takes the changed keys of
orders and items, looks their rows up as they were at the last refresh and as they are, and appends one small part
per kind of totals; a report adds the parts up. Where the changes are no longer at hand, since a state or a merge
has folded them away, or on the first run, the totals are computed from the whole tables.

A part is written to a folder of its own and counts once a commit names it. A commit is a file that only one writer
can create; a refresh that loses, or dies, leaves nothing behind that is read.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame

from cdcmart.operators import deltas
from cdcmart.plans.reporting import RETENTION
from cdcmart.session import small_tasks
from cdcmart.sinks import files
from cdcmart.sinks.mart import Mart

# Parts that are added up at every reading before a refresh folds them into one.
MOST_PARTS = 24


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the table versions it reached, and whether it read whole tables."""

    versions: dict[str, int]
    whole: bool


class MaintainedReports:
    """The four reports of a mart, refreshed by changes."""

    def __init__(
        self, mart: Mart, orders: str = "fact_orders", items: str = "fact_order_items", folder: str | None = None
    ):
        if kept := {orders, items} & set(mart.outside):
            raise ValueError(f"no versions to follow: {', '.join(sorted(kept))} is kept outside")
        self.mart = mart
        self.orders, self.items = mart.table(orders), mart.table(items)
        self.path = folder or f"{mart.root}/totals"

    # -- refreshing -----------------------------------------------------------------------

    def refresh(self) -> Refresh | None:
        """Bring the totals up to what is committed; None where nothing is new.

        A version that a repair has reserved but not committed holds it up to the version before, so no row is
        passed by. The customers and products are joined when a report is read.
        """
        number, last = self._newest()
        tables = {t.spec.name: t for t in (self.orders, self.items)}
        reached = {name: t.settled_version() for name, t in tables.items()}
        if last and last["versions"] == reached:
            return None
        stored = sum(files.size(self.mart.spark, t.path) for t in tables.values() if t.exists())
        with small_tasks(self.mart.spark, stored):
            parts = self._from_changes(last["versions"], reached) if last else None
            whole = parts is None
            if whole:
                parts = self._from_tables(reached)
            kept = last["parts"] if last and not whole else []
            if len(kept) >= MOST_PARTS:
                parts = {n: deltas.added_up(deltas.union([self._parts(n, kept), p]), n) for n, p in parts.items()}
                kept = []
            part = uuid.uuid4().hex
            for name, rows in parts.items():
                rows.write.parquet(f"{self.path}/{name}/part={part}")
        commit = {"versions": reached, "parts": [*kept, part], "whole": whole}
        if not files.create_new(self.mart.spark, f"{self.path}/commits/{number + 1}", json.dumps(commit)):
            # Another refresh was first; whatever it has not seen is seen by the next.
            return None
        return Refresh(reached, whole)

    def _from_changes(self, seen: dict[str, int], reached: dict[str, int]) -> dict[str, DataFrame] | None:
        keys = {}
        for table in (self.orders, self.items):
            name = table.spec.name
            if reached[name] < seen[name]:
                return None
            if reached[name] == seen[name]:
                rows = self.mart.spark.createDataFrame([], table.spec.mart_schema)
            else:
                rows = table.changed_since(seen[name], reached[name])
            if rows is None:
                return None
            keys[name] = rows.select(*table.spec.key).distinct()

        def changed(table) -> DataFrame:
            name = table.spec.name
            before = table.read(seen[name], keys=keys[name])
            return deltas.changed(before, table.read(reached[name], keys=keys[name]))

        orders, items = changed(self.orders), changed(self.items)
        lookup = items.select("order_id").where("order_id is not null")
        return {
            "open_orders": deltas.open_orders(orders),
            "pending_orders": deltas.pending_orders(orders),
            "pending_items": deltas.pending_items(
                items,
                self.orders.read(reached[self.orders.spec.name], keys=lookup),
                self.items.read(seen[self.items.spec.name]),
                deltas.pending_switches(orders),
            ),
        }

    def _from_tables(self, reached: dict[str, int]) -> dict[str, DataFrame]:
        orders, items = (t.read(reached[t.spec.name]) for t in (self.orders, self.items))
        rows = deltas.appeared(orders)
        return {
            "open_orders": deltas.open_orders(rows),
            "pending_orders": deltas.pending_orders(rows),
            "pending_items": deltas.pending_items(deltas.appeared(items), orders),
        }

    # -- reading --------------------------------------------------------------------------

    def totals(self, name: str) -> DataFrame:
        """Totals of one kind as of the last refresh."""
        _, last = self._newest()
        if last is None:
            raise RuntimeError("no totals yet: refresh first")
        return deltas.added_up(self._parts(name, last["parts"]), name)

    def report(self, name: str, k: int = 3) -> DataFrame:
        """A report as of the last refresh, in the form of :func:`reporting.report_set`."""
        if name == "delivery_status_summary":
            return deltas.delivery_status_summary(self.totals("open_orders"))
        if name == "top_delivery_dates":
            return deltas.top_delivery_dates(self.totals("open_orders"), k)
        if name == "pending_items_by_product":
            return deltas.pending_items_by_product(self.totals("pending_items"), self.mart.read("dim_product"))
        if name == "top_customers":
            return deltas.top_customers(self.totals("pending_orders"), self.mart.read("dim_customer"), k)
        raise ValueError(f"unknown report {name!r}")

    def clean(self, older_than: dt.timedelta = RETENTION) -> list[str]:
        """Remove parts and commits that a commit replaced at least ``older_than`` ago; returns the commits."""
        spark = self.mart.spark
        numbers = self._numbers()
        old = [
            n
            for n, after in zip(numbers, numbers[1:])
            if files.age(spark, f"{self.path}/commits/{after}") >= older_than.total_seconds()
        ]
        named = {p for n in numbers if n not in old for p in self._commit(n)["parts"]}
        for name in deltas.TOTALS:
            for folder in files.subfolders(spark, f"{self.path}/{name}"):
                path = f"{self.path}/{name}/{folder}"
                # A part without a commit may belong to a refresh that is at work.
                if folder.split("=")[1] not in named and files.age(spark, path) >= older_than.total_seconds():
                    files.remove_folder(spark, path)
        for n in old:
            files.remove_folder(spark, f"{self.path}/commits/{n}")
        return [str(n) for n in old]

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in files.names(self.mart.spark, f"{self.path}/commits") if n.isdigit())

    def _commit(self, number: int) -> dict:
        return json.loads(files.read_text(self.mart.spark, f"{self.path}/commits/{number}"))

    def _newest(self) -> tuple[int, dict | None]:
        numbers = self._numbers()
        return (numbers[-1], self._commit(numbers[-1])) if numbers else (0, None)

    def _parts(self, name: str, parts: list[str]) -> DataFrame:
        spec = deltas.TOTALS[name]
        rows = self.mart.spark.read.parquet(*[f"{self.path}/{name}/part={p}" for p in parts])
        return rows.select(*spec.by, *spec.measures)


def refresh_after_commit(mart: Mart, name: str, version: int) -> None:
    """For ``on_commit`` of the streams of orders and items: every batch brings the totals up to date."""
    MaintainedReports(mart).refresh()
