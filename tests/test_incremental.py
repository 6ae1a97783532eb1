"""Reports kept up to date by changes: equal to the whole reports after every kind of change."""

import datetime as dt
import random

import pytest
from helpers import event, rows
from test_mart import Feed, customer, item, order

from cdcmart import session
from cdcmart.operators import deltas
from cdcmart.plans import incremental, repair, reporting
from cdcmart.plans.incremental import MaintainedReports, refresh_after_commit
from cdcmart.sinks import files
from cdcmart.sinks.mart import Mart


def same(mart, maintained):
    for name, whole in reporting.report_set(mart).items():
        assert rows(maintained.report(name)) == rows(whole), name


@pytest.fixture
def feeds(spark, tmp_path):
    return {n: Feed(spark, tmp_path / n) for n in ("customers", "products", "orders", "order_items")}


def test_refreshes_follow_the_streams(spark, root, feeds):
    rng = random.Random(3)
    mart = Mart(spark, root)
    maintained = MaintainedReports(mart)
    feeds["customers"].send(*[event("c", customer(i, f"c{i}")) for i in range(5)])
    feeds["products"].send(*[event("c", {"product_id": i, "product_name": f"p{i}"}) for i in range(3)])
    for name in ("customers", "products"):
        feeds[name].run(mart, name, deletes="soft")
    whole = []
    statuses = ["PENDING", "PROCESSING", "COMPLETED", None]
    for step in range(4):
        # Orders of new and of known keys, in any order of time, and items before and after their orders.
        feeds["orders"].send(*[
            event("u", order(rng.randrange(12), rng.choice(statuses), rng.randrange(50), rng.randrange(6), rng.randrange(20000, 20003)))
            for _ in range(6)
        ])
        feeds["order_items"].send(*[
            event("u", item(rng.randrange(20), rng.choice([None, 0, *range(14)]), rng.randrange(4), rng.choice([1, 5, "x"]), rng.randrange(50)))
            for _ in range(8)
        ])
        for name in ("orders", "order_items"):
            feeds[name].run(mart, name)
        if step == 1:
            # A customer is deleted softly; the name stays in the report, as in the whole one.
            feeds["customers"].send(event("d", None, customer(1, "c1")))
            feeds["customers"].run(mart, "customers", deletes="soft")
        done = maintained.refresh()
        whole.append(done.whole)
        same(mart, maintained)
        assert maintained.refresh() is None
    assert whole == [True, False, False, False]


def test_folds_and_resets_lead_to_the_whole_tables(spark, root, feeds):
    mart = Mart(spark, root)
    mart.create()
    maintained = MaintainedReports(mart)
    with pytest.raises(RuntimeError, match="refresh first"):
        maintained.report("top_customers")
    feeds["orders"].send(event("c", order(1)))
    feeds["orders"].run(mart, "orders")
    assert maintained.refresh().whole
    feeds["orders"].send(event("u", order(1, "COMPLETED", 9)), event("c", order(2)))
    feeds["orders"].run(mart, "orders")
    mart.table("orders").rewrite()
    assert maintained.refresh().whole
    same(mart, maintained)
    repair.reset_table(mart, "orders")
    assert maintained.refresh().whole
    same(mart, maintained)


def test_a_reserved_version_is_waited_for(spark, root, feeds):
    mart = Mart(spark, root)
    feeds["orders"].send(event("c", order(1)))
    feeds["orders"].run(mart, "orders")
    maintained = MaintainedReports(mart)
    maintained.refresh()
    table = mart.table("orders")
    version = table.claim()
    late = table.read().withColumns({"order_id": reporting.F.lit(7).cast("long")})
    feeds["orders"].send(event("c", order(2)))
    feeds["orders"].run(mart, "orders")
    assert maintained.refresh() is None
    table.commit_changes(late, version)
    table.release(version)
    assert not maintained.refresh().whole
    same(mart, maintained)
    assert rows(maintained.report("top_delivery_dates"), "open_order_count") == [(3,)]


def test_parts_are_folded_and_removed(spark, root, feeds, monkeypatch):
    monkeypatch.setattr(incremental, "MOST_PARTS", 2)
    mart = Mart(spark, root)
    maintained = MaintainedReports(mart)
    for i in range(4):
        feeds["orders"].send(event("c", order(i % 3, ["PENDING", "PROCESSING"][i % 2], i)))
        feeds["orders"].run(mart, "orders", on_commit=refresh_after_commit)
        same(mart, maintained)
    _, last = maintained._newest()
    assert len(last["parts"]) <= 2
    assert maintained.clean() == []
    assert maintained.clean(dt.timedelta(0)) == ["1", "2", "3"]
    same(mart, maintained)
    kept = files.subfolders(spark, f"{maintained.path}/open_orders")
    assert sorted(kept) == sorted(f"part={p}" for p in last["parts"])


def test_one_of_two_refreshes_counts(spark, root, feeds, monkeypatch):
    mart = Mart(spark, root)
    feeds["orders"].send(event("c", order(1)))
    feeds["orders"].run(mart, "orders")
    first, second = MaintainedReports(mart), MaintainedReports(mart)
    real = second._from_tables

    def overtaken(reached):
        made = real(reached)
        assert first.refresh() is not None
        return made

    monkeypatch.setattr(second, "_from_tables", overtaken)
    assert second.refresh() is None
    same(mart, second)


def test_a_refresh_looks_up_changed_keys_only(spark, root, feeds):
    mart = Mart(spark, root)
    feeds["orders"].send(*[event("c", order(i)) for i in range(30)])
    feeds["orders"].run(mart, "orders")
    maintained = MaintainedReports(mart)
    maintained.refresh()
    feeds["orders"].send(event("u", order(4, "COMPLETED", 5)))
    feeds["orders"].run(mart, "orders")
    _, last = maintained._newest()
    reached = {"fact_orders": mart.table("orders").settled_version(), "fact_order_items": -1}
    parts = maintained._from_changes(last["versions"], reached)
    assert [tuple(r) for r in parts["pending_orders"].collect()] == [(1, -1)]
    plan = parts["open_orders"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 2


def test_a_refresh_starts_as_wide_as_its_tables_are_large(spark, root, feeds, monkeypatch):
    """The joins of a refresh get more tasks as the tables grow, and the session's settings come back."""
    names = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    outside = [spark.conf.get(n, None) for n in names]
    mart = Mart(spark, root)
    maintained = MaintainedReports(mart)
    feeds["orders"].send(*[event("c", order(i)) for i in range(20)])
    feeds["order_items"].send(*[event("c", item(i, i)) for i in range(20)])
    for name in ("orders", "order_items"):
        feeds[name].run(mart, name)
    monkeypatch.setattr(session, "_STORED_BYTES", 100)
    seen, plain = [], deltas.pending_items

    def noted(*args):
        seen.append([int(spark.conf.get(n)) for n in names])
        return plain(*args)

    monkeypatch.setattr(deltas, "pending_items", noted)
    maintained.refresh()
    stored = sum(files.size(spark, mart.table(n).path) for n in ("orders", "order_items"))
    assert seen == [[-(-stored // 100), session._JOIN_BYTES]] and stored > 1000
    assert [spark.conf.get(n, None) for n in names] == outside
    monkeypatch.setattr(deltas, "pending_items", lambda *_: 1 / 0)
    feeds["orders"].send(event("u", order(3, "COMPLETED", 5)))
    feeds["orders"].run(mart, "orders")
    with pytest.raises(ZeroDivisionError):
        maintained.refresh()
    assert [spark.conf.get(n, None) for n in names] == outside
