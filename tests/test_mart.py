"""Stored tables, streams and repair jobs on local files."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from helpers import decimal, event, records, rows
from pyspark.sql import functions as F

from cdcmart import session
from cdcmart.operators import reports, upsert
from cdcmart.plans import registry, repair, reporting
from cdcmart.plans.incremental import MaintainedReports
from cdcmart.sinks import files
from cdcmart.sinks.external import Outside
from cdcmart.sinks.mart import Mart, version_of
from cdcmart.sources.changes import change_batch, change_stream
from cdcmart.specs import EXTRAS, OFFSET, SPECS
from cdcmart.streaming import batches, runner


def customer(i, name="n", minute=0, **more):
    return {"customer_id": i, "customer_name": name, "updated_at": minute * 60000,
            "created_at": minute * 60000, **more}


def order(i, status="PENDING", minute=0, customer_id=1, days=20000):
    return {"order_id": i, "status": status, "customer_id": customer_id, "order_date": days,
            "delivery_date": days + 10, "updated_at": minute * 60000, "created_at": minute * 60000}


def item(i, order_id, product_id=5, amount=2, minute=0):
    return {"order_item_id": i, "order_id": order_id, "product_id": product_id, "quanity": amount,
            "updated_at": minute * 60000, "created_at": minute * 60000}


class Feed:
    """A topic as a folder; every ``send`` adds a file."""

    def __init__(self, spark, path):
        self.spark, self.path, self.next = spark, str(path), 0

    def send(self, *values, first=None):
        start = self.next if first is None else first
        records(self.spark, values, first=start).coalesce(1).write.mode("append").parquet(self.path)
        self.next = max(self.next, start + len(values))

    def run(self, mart, name, **options):
        scan = change_stream(self.spark, "parquet", {"path": self.path})
        query = runner.start_mart_stream(mart, name, scan, trigger=None, **options)
        query.awaitTermination()
        return query


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "feed")


def names(mart, table="dim_customer"):
    return rows(mart.read(table), "customer_id", "customer_name")


def test_stream_equals_batch_by_batch(spark, root, feed):
    mart = Mart(spark, root)
    feed.send(event("c", customer(1, "a", 5)), event("c", customer(2, "b", 1)), None, "junk")
    feed.run(mart, "customers")
    feed.send(
        event("u", customer(1, "late", 2)),
        event("u", {"customer_id": 2, "updated_at": 600000, "colour": "red"}),
        event("d", None, customer(2)),
        event("r", customer(3, "tie", 7)),
        event("u", customer(3, "tie won", 7)),
    )
    feed.run(mart, "customers")
    got = {r.customer_id: r for r in mart.read("dim_customer").collect()}
    assert [got[i].customer_name for i in (1, 2, 3)] == ["late", "", "tie won"]
    assert got[2].customer_address is None and got[2].is_active is True
    assert json.loads(got[2][EXTRAS]) == {"colour": "red"}
    stored = mart.read("dim_customer").select("customer_id", F.unix_seconds("created_at"))
    assert rows(stored) == [(1, 300), (2, 60), (3, 420)]
    assert rows(mart.table("customers").read_history(), OFFSET) == [(0,), (1,), (4,), (5,), (7,), (8,)]


@pytest.mark.parametrize("fold", ["none", "merge", "rewrite"])
def test_folds_change_nothing_visible(spark, root, feed, fold):
    mart = Mart(spark, root)
    table = mart.table("customers")
    for n in range(4):
        feed.send(*[event("u", customer(i, f"{n}", n)) for i in range(n, 6)])
        feed.run(mart, "customers")
        if fold != "none":
            getattr(table, fold)()
    assert names(mart) == [(i, str(min(i, 3))) for i in range(6)]
    made = mart.read("dim_customer").select(F.unix_seconds("created_at"))
    assert {r[0] for r in made.collect()} == {0}
    assert bool(table.versions("state")) == (fold == "rewrite")
    assert bool(table.versions("merged")) == (fold == "merge")


def frame_of(spark, table, ids, name, created=None, minute=None):
    when = None if minute is None else dt.datetime(2024, 1, 1, 0, minute)
    data = [(i, name, True, None, when, None, created, None, None, 1) for i in ids]
    return spark.createDataFrame(data, table.spec.mart_schema).coalesce(1)


def test_changes_are_merged_among_themselves(spark, root):
    table = Mart(spark, root).table("customers")
    first, later = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    one = frame_of(spark, table, [0], "old", first)
    many = one.withColumn("customer_id", F.explode(F.sequence(F.lit(0), F.lit(9_999)).cast("array<long>")))
    table.commit_state(many, 1)
    for version in range(2, 6):
        table.commit_changes(frame_of(spark, table, [version, 10, 600_000], str(version), later), version)
        assert table.merge() == (None if version == 2 else version)
    assert table.versions("state") == [1]
    table.commit_changes(frame_of(spark, table, [10, 700_000], "last", later), 6)
    want = {i: "old" for i in range(10_000)} | {v: str(v) for v in range(2, 6)}
    want |= {600_000: "5", 10: "last", 700_000: "last"}

    def check():
        got = table.read()
        assert dict(rows(got, "customer_id", "customer_name")) == want
        assert got.where(F.col("created_at") == first).count() == 10_000
        some = spark.createDataFrame([(10,), (600_000,), (999_999,)], "customer_id long")
        picked = table.read(keys=some, bounds=(10, 999_999))
        assert rows(picked, "customer_id", "customer_name") == [(10, "last"), (600_000, "5")]

    check()
    assert table.rewrite() == 6
    assert table.versions("state") == [1, 6]
    check()
    assert table.rewrite() is None and table.merge() is None
    assert table.vacuum() == []
    removed = table.vacuum(dt.timedelta(0))
    assert "state/version=1" in removed and "changes/version=6" in removed
    check()


def test_a_reader_outlives_folds_and_vacuum(spark, root):
    table = Mart(spark, root).table("customers")
    table.commit_state(frame_of(spark, table, range(5), "old"), 1)
    table.commit_changes(frame_of(spark, table, [1], "new"), 2)
    planned = table.read()
    for version in (3, 4, 5):
        assert table.rewrite() == version - 1
        table.vacuum()
        table.commit_changes(frame_of(spark, table, [version], "later"), version)
    assert rows(planned, "customer_id", "customer_name") == [(0, "old"), (1, "new"), *[(i, "old") for i in (2, 3, 4)]]


@pytest.mark.parametrize("rule", ["last_batch", "newest"])
def test_filters_reach_the_state_with_changes_pending(spark, root, rule):
    table = Mart(spark, root, on_conflict=rule).table("customers")
    table.commit_state(frame_of(spark, table, range(50), "old", minute=1), 1)
    table.commit_changes(frame_of(spark, table, range(45, 60), "new", minute=2), 2)
    found = table.read().where("customer_name = 'old'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 45
    assert any("FileScan parquet" in x and "EqualTo(customer_name,old)" in x for x in plan.split("\n"))


def test_files_of_a_state_hold_ranges_of_keys(spark, root):
    table = Mart(spark, root).table("customers")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.commit_state(frame_of(spark, table, range(1000), "x").repartition(4), 1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = (
        table.read()
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.min("customer_id").alias("low"), F.max("customer_id").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(spans) > 1
    assert all(a.high < b.low for a, b in zip(spans, spans[1:]))


def test_the_conflict_rule_stays_with_the_table(spark, root, feed):
    mart = Mart(spark, root, on_conflict="newest")
    feed.send(event("u", customer(1, "NEW", 9)))
    feed.run(mart, "customers")
    feed.send(event("u", customer(1, "OLD", 2)))
    feed.run(mart, "customers")
    told_nothing = Mart(spark, root)
    assert names(told_nothing) == [(1, "NEW")]
    told_nothing.table("customers").rewrite()
    assert names(told_nothing) == names(mart) == [(1, "NEW")]
    with pytest.raises(ValueError, match="on_conflict=newest"):
        Mart(spark, root, on_conflict="last_batch").read("dim_customer")
    with pytest.raises(ValueError, match="deletes=ignore"):
        feed.run(told_nothing, "customers", deletes="soft")


def test_a_fold_stops_below_a_claimed_version(spark, root):
    table = Mart(spark, root).table("customers")
    table.commit_state(frame_of(spark, table, [1], "state"), 0)
    claimed = table.claim()
    assert table.claim() == claimed + 1
    table.release(claimed + 1)
    # A stream batch and a fold while the repair is at work.
    table.commit_changes(frame_of(spark, table, [2], "batch"), version_of(0, 0))
    assert table.rewrite() is None
    table.commit_changes(frame_of(spark, table, [3], "repair"), claimed)
    assert table.rewrite() == version_of(0, 0)
    table.release(claimed)
    assert rows(table.read(), "customer_id") == [(1,), (2,), (3,)]


def test_only_one_fold_of_a_version_runs(spark, root):
    table = Mart(spark, root).table("customers")
    table.commit_changes(frame_of(spark, table, [1], "a"), 1)
    assert files.create_new(spark, f"{table.path}/claims/fold=1", "")
    assert table.rewrite() is None
    files.remove_folder(spark, f"{table.path}/claims/fold=1")
    assert table.rewrite() == 1


def test_half_written_history_is_not_read(spark, root):
    table = Mart(spark, root).table("customers")
    changes = batches.parse(records(spark, [event("c", customer(1, "a"))]), table.spec)
    table.append_history(changes, 1000)
    table.append_history(changes, 2000)
    day = files.subfolders(spark, f"{table.path}/history")[0]
    files.remove_folder(spark, f"{table.path}/history/{day}/batch_id=2000/_SUCCESS")
    assert rows(table.read_history(), "batch_id") == [(1000,)]


def test_a_failed_batch_runs_again_without_duplicates(spark, root, feed):
    mart = Mart(spark, root)
    feed.send(event("c", customer(1, "a")))
    feed.run(mart, "customers")
    feed.send(event("u", customer(1, "b", 1)), event("c", customer(2, "c", 1)))

    def fail(_mart, _table, version):
        raise RuntimeError(f"stop after {version}")

    with pytest.raises(Exception, match="stop after"):
        feed.run(mart, "customers", on_commit=fail)
    feed.run(mart, "customers")
    assert names(mart) == [(1, "b"), (2, "c")]
    assert rows(mart.table("customers").read_history(), OFFSET) == [(0,), (1,), (2,)]
    assert mart.table("customers").versions("changes") == [version_of(0, 0), version_of(0, 1)]


def test_a_batch_retried_after_midnight_stays_on_its_day(spark, root):
    table = Mart(spark, root).table("customers")
    log = records(spark, [event("c", customer(1, "a"))])
    changes = batches.parse(log, table.spec)
    before, after = (dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in (1, 2))
    table.append_history(changes, 1000, before)
    table.append_history(changes, 1000, after)
    table.append_history(changes, 2000, after)
    stored = table.read_history()
    assert rows(stored, "recorded_on", "batch_id") == [
        (before.date(), 1000), (after.date(), 2000)]
    one_day = stored.where(F.col("recorded_on") == after.date())
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(recorded_on" in plan
    assert rows(one_day, "batch_id") == [(2000,)]


def test_days_that_are_over_are_merged(spark, root):
    table = Mart(spark, root).table("customers")
    days = [dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in (1, 2)]
    for n, day in enumerate((days[0], days[0], days[1])):
        log = records(spark, [event("c", customer(n, "a"))], first=n)
        table.append_history(batches.parse(log, table.spec), 1000 * (n + 1), day)
    before = rows(table.read_history(), "recorded_on", "batch_id", "history_id", "customer_id")
    assert table.merge_history(days[1].date()) == ["recorded_on=2024-01-01"]
    assert table.merge_history(days[1].date()) == []
    assert rows(table.read_history(), "recorded_on", "batch_id", "history_id", "customer_id") == before
    assert table.vacuum() == []
    assert table.vacuum(dt.timedelta(0)) == ["history/recorded_on=2024-01-01"]
    assert rows(table.read_history(), "recorded_on", "batch_id", "history_id", "customer_id") == before
    table.reset()
    assert table.read_history().count() == 0


def test_values_that_are_too_long_are_told(spark, root, feed, caplog):
    feed.send(event("c", customer(1, "x" * 1000)))
    with caplog.at_level("WARNING"):
        feed.run(Mart(spark, root), "customers")
    assert "1 values of customer_name exceed" in caplog.text


def test_an_unfinished_version_is_ignored(spark, root, feed):
    mart = Mart(spark, root)
    feed.send(event("c", customer(1, "a")))
    feed.run(mart, "customers")
    table = mart.table("customers")
    half = f"{table.path}/state/version={version_of(0, 5)}"
    mart.read("dim_customer").write.parquet(half)
    files.remove_folder(spark, f"{half}/_SUCCESS")
    assert table.latest_version() == version_of(0, 0)
    assert names(mart) == [(1, "a")]


def test_only_deletes_write_nothing(spark, root, feed):
    mart = Mart(spark, root)
    feed.send(event("c", customer(1, "a")))
    feed.run(mart, "customers")
    feed.send(event("d", None, customer(1, "a")))
    feed.run(mart, "customers")
    assert names(mart) == [(1, "a")]
    assert len(mart.table("customers").versions("changes")) == 1


def test_soft_deletes(spark, root, feed):
    mart = Mart(spark, root)
    feed.send(event("c", customer(1, "a")), event("c", customer(2, "b")))
    feed.send(event("d", None, customer(1, "a")))
    feed.run(mart, "customers", deletes="soft")
    assert rows(mart.read("dim_customer"), "customer_id", "is_active") == [(1, False), (2, True)]


def test_soft_deletes_keep_unknown_fields(spark):
    log = records(spark, [event("d", None, customer(1, "a", colour="red")), event("c", customer(2, "b", size=3))])
    parsed = batches.parse(log, SPECS["dim_customer"], "soft")
    assert [json.loads(r[0]) for r in parsed.orderBy("customer_id").select(EXTRAS).collect()] == [
        {"colour": "red"}, {"size": 3}]


def test_a_bad_timestamp_is_null_and_the_stream_goes_on(spark, root, feed):
    mart = Mart(spark, root)
    for bad in (2**63 - 1, -(2**63)):
        feed.send(event("c", {"customer_id": 1, "customer_name": "a", "updated_at": bad}))
    feed.send(event("c", {"product_id": 1, "unity_price": {"scale": -(2**31), "value": "AQ=="}}))
    feed.run(mart, "customers")
    assert rows(mart.read("dim_customer"), "customer_name", "updated_at") == [("a", None)]


class Elsewhere:
    """A current-state table of another system: upserts into a frame that is written anew each time."""

    def __init__(self, spark, path, spec):
        self.spark, self.path, self.spec, self.number = spark, str(path), spec, 0
        spark.createDataFrame([], spec.mart_schema).write.parquet(f"{self.path}/0")

    def read(self):
        return self.spark.read.parquet(f"{self.path}/{self.number}")

    def write(self, latest):
        upsert.merge_latest(self.read(), latest, self.spec).write.parquet(f"{self.path}/{self.number + 1}")
        self.number += 1

    def outside(self):
        return Outside(self.read, self.write)


def test_only_the_current_state_is_kept_outside(spark, root, feed, tmp_path):
    kept = Elsewhere(spark, tmp_path / "kept", SPECS["dim_customer"])
    mart = Mart(spark, root, outside={"dim_customer": kept.outside()})
    mart.create()
    mart.validate()
    feed.send(event("c", customer(1, "a", 1)), event("u", customer(1, "b", 2)), event("c", {"customer_name": "x"}))
    feed.run(mart, "customers")
    assert names(mart) == [(1, "b")] and rows(kept.read(), "is_active") == [(True,)]
    table = mart.table("customers")
    assert not table.exists()
    assert rows(table.read_history(), OFFSET) == [(0,), (1,)]
    assert spark.read.parquet(f"{table.path}/rejected").count() == 1
    with pytest.raises(ValueError, match="kept outside"):
        repair.reset_table(mart, "customers")
    gone = Outside(lambda: spark.table("no_such_table"), print)
    assert Mart(spark, root, outside={"dim_customer": gone}).problems() == ["dim_customer: missing outside"]


def test_orders_and_items_outside_feed_status_sync_backfill_and_reports(spark, root, tmp_path):
    kept = {n: Elsewhere(spark, tmp_path / n, SPECS[n]) for n in ("fact_orders", "fact_order_items")}
    mart = Mart(spark, root, outside={n: k.outside() for n, k in kept.items()})
    plain = Mart(spark, f"{root}-plain")
    sent = {
        "orders": [event("c", order(1)), event("c", order(2, "COMPLETED"))],
        "order_items": [event("c", item(1, 1)), event("c", item(2, 2)), event("c", item(3, 9))],
        "products": [event("c", {"product_id": 5, "product_name": "bolt"})],
        "customers": [event("c", customer(1, "ann"))],
    }
    for m in (mart, plain):
        m.create()
        for name, values in sent.items():
            log = Feed(spark, tmp_path / m.root.replace("/", "_") / name)
            log.send(*values)
            log.run(m, name)
    stored = rows(kept["fact_order_items"].read(), "order_item_id", "order_status")
    assert stored == [(1, "PENDING"), (2, "COMPLETED"), (3, "unknown")]
    found, want = reporting.report_set(mart), reporting.report_set(plain)
    assert {n: rows(r) for n, r in found.items()} == {n: rows(r) for n, r in want.items()}
    assert rows(found["pending_items_by_product"], "product_name", "pending_quantity") == [("bolt", 2)]

    source = spark.sql("select 9L order_id, 'PENDING' status, timestamp'2024-05-01' created_at, timestamp'2024-05-01' updated_at")
    done = repair.backfill(mart, "orders", source, "2024-05-01", "2024-05-02")
    assert (done.rows_before, done.net_change, done.version) == (2, 1, None)
    assert not mart.table("orders").exists()
    assert repair.sync_status(mart) is None
    assert rows(kept["fact_order_items"].read(), "order_item_id", "order_status")[2] == (3, "PENDING")
    assert repair.sync_status(mart) is None and kept["fact_order_items"].number == 2
    with pytest.raises(ValueError, match="kept outside"):
        MaintainedReports(mart)


def test_a_day_with_an_unfinished_batch_is_not_merged(spark, root):
    """The batch dies while it writes, the fold comes, the batch runs again the next day, and all is cleaned up."""
    table = Mart(spark, root).table("customers")
    first, later = (dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in (1, 3))
    logs = [records(spark, [event("c", customer(n, "a"))], first=n) for n in range(2)]
    changes = [batches.parse(log, table.spec) for log in logs]
    table.append_history(changes[0], 1000, first)
    table.append_history(changes[1], 2000, first)
    files.remove_folder(spark, f"{table.path}/history/recorded_on=2024-01-01/batch_id=2000/_SUCCESS")
    assert table.merge_history(later.date()) == []
    table.append_history(changes[1], 2000, later)
    assert table.merge_history(later.date()) == ["recorded_on=2024-01-01"]
    table.vacuum(dt.timedelta(0))
    assert rows(table.read_history(), OFFSET, "batch_id") == [(0, 1000), (1, 2000)]


@pytest.mark.parametrize("vacuumed", [False, True])
def test_a_batch_of_a_merged_day_is_kept_once(spark, root, vacuumed):
    """The batch had written its events and then failed: the fold has them, so the retry adds nothing."""
    table = Mart(spark, root).table("customers")
    first, later = (dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in (1, 3))
    logs = [records(spark, [event("c", customer(n, "a"))], first=n) for n in range(2)]
    changes = [batches.parse(log, table.spec) for log in logs]
    table.append_history(changes[0], 1000, first)
    assert table.merge_history(later.date()) == ["recorded_on=2024-01-01"]
    if vacuumed:
        table.vacuum(dt.timedelta(0))
    table.append_history(changes[0], 1000, later)
    table.append_history(changes[1], 2000, later)
    assert rows(table.read_history(), OFFSET, "batch_id", "recorded_on") == [(0, 1000, first.date()), (1, 2000, later.date())]


def test_a_replay_adds_no_event_twice(spark, root, feed):
    mart = Mart(spark, root)
    feed.send(*[event("c", customer(i, "a", i)) for i in range(4)])
    feed.run(mart, "customers")
    repair.request_replay(mart, "customers")
    # Read again with what came meanwhile; the batch fails once after it has written, and runs again.
    feed.send(event("c", customer(9, "new", 9)))

    def fail(*_):
        raise RuntimeError("stop")

    with pytest.raises(Exception, match="stop"):
        feed.run(mart, "customers", on_commit=fail)
    feed.run(mart, "customers")
    stored = mart.table("customers").read_history()
    assert rows(stored, OFFSET) == [(i,) for i in range(5)]
    assert stored.select("history_id").distinct().count() == 5
    assert len(names(mart)) == 5


def test_tables_without_a_flag_ignore_deletes(spark):
    log = records(spark, [event("c", order(1)), event("d", None, order(1))])
    assert batches.parse(log, SPECS["fact_orders"], "soft").count() == 1
    with pytest.raises(ValueError):
        batches.parse(log, SPECS["fact_orders"], "hard")


def test_events_without_a_key_are_set_aside(spark, root, feed):
    mart = Mart(spark, root)
    feed.send(event("c", customer(1, "a")), event("c", {"customer_name": "nobody"}), '{"op":"u"}')
    feed.run(mart, "customers")
    assert names(mart) == [(1, "a")]
    kept = spark.read.parquet(f"{mart.table('customers').path}/rejected")
    assert rows(kept, OFFSET) == [(1,), (2,)]
    assert mart.table("customers").read_history().count() == 1


def test_newest_mode(spark, root, feed):
    mart = Mart(spark, root, on_conflict="newest")
    for value in (customer(1, "new", 9), customer(1, "late", 2), customer(1, "newer", 10)):
        feed.send(event("u", value))
        feed.run(mart, "customers")
        mart.table("customers").rewrite()
    assert names(mart) == [(1, "newer")]
    feed.send(event("u", customer(1, "late again", 3)))
    feed.run(mart, "customers")
    assert names(mart) == [(1, "newer")]


def test_products_decode_prices(spark, root, feed):
    mart = Mart(spark, root)
    feed.send(event("c", {"product_id": 1, "product_name": "p", "unity_price": decimal(1999, 2)}))
    feed.run(mart, "products")
    assert rows(mart.read("dim_product"), "unity_price", "barcode") == [(Decimal("19.99"), "")]


@pytest.fixture
def shop(spark, root, tmp_path):
    """A mart with customers, a product, orders and items of three batches."""
    mart = Mart(spark, root)
    feeds = {s.source: Feed(spark, tmp_path / s.source) for s in SPECS.values()}
    feeds["customers"].send(event("c", customer(1, "ann")), event("c", customer(2, "bob")))
    feeds["products"].send(event("c", {"product_id": 5, "product_name": "bolt"}))
    feeds["orders"].send(event("c", order(10)), event("c", order(11, customer_id=2)))
    feeds["order_items"].send(
        event("c", item(1, 10)), event("c", item(2, 12)), event("c", item(3, None)),
        event("u", item(1, 10, amount=7, minute=1)),
    )
    for name in ("customers", "products", "orders", "order_items"):
        feeds[name].run(mart, name)
    return mart, feeds


def status_of(mart):
    return rows(mart.read("fact_order_items"), "order_item_id", "order_status")


def test_item_status_follows_the_orders(shop):
    mart, feeds = shop
    assert status_of(mart) == [(1, "PENDING"), (2, "unknown"), (3, "unknown")]
    feeds["orders"].send(event("u", order(10, "COMPLETED", 1)), event("c", order(12, "PROCESSING", 1)))
    feeds["orders"].run(mart, "orders")
    want = [(1, "COMPLETED"), (2, "PROCESSING"), (3, "unknown")]
    assert status_of(mart) == want
    # Only what items store themselves, by the orders that changed.
    assert repair.sync_status(mart) is not None
    feeds["order_items"].send(event("c", item(4, 11)))
    feeds["order_items"].run(mart, "order_items")
    assert repair.sync_status(mart) is None
    stored = mart.read("order_items", stored_status=True)
    assert rows(stored, "order_item_id", "order_status") == [*want, (4, "PENDING")]
    assert "fact_orders" not in stored._jdf.queryExecution().executedPlan().toString()
    mart.table("orders").rewrite()
    feeds["orders"].send(event("u", order(11, "COMPLETED", 2)))
    feeds["orders"].run(mart, "orders")
    assert repair.sync_status(mart) is not None
    assert rows(mart.read("order_items", stored_status=True), "order_item_id", "order_status")[-1] == (4, "COMPLETED")


def test_a_batch_without_history_is_held_as_its_newest_rows(spark, root, feed, monkeypatch):
    mart, held = Mart(spark, root), []
    frame = type(spark.range(0))
    real = frame.persist
    monkeypatch.setattr(frame, "persist", lambda df, *a: (held.append(sorted(df.columns)), real(df, *a))[1])
    feed.send(
        *[event("u", item(1, None, amount=n, minute=n)) for n in range(5)],
        event("c", item(2, None)),
        event("c", {"quanity": 9}),
        '{"op":"c"}',
    )
    feed.run(mart, "order_items")
    table = mart.table("order_items")
    quantity = F.get_json_object(EXTRAS, "$.quanity").cast("int")
    assert rows(table.read().select("order_item_id", quantity)) == [(1, 4), (2, 2)]
    assert rows(spark.read.parquet(f"{table.path}/rejected"), OFFSET) == [(6,), (7,)]
    # What is cached has a count beside each newest row: no event is held that a later one replaced.
    assert held == [sorted([*(c for c in table.spec.columns if c != "order_status"), "events", "without_key"])]


def test_many_items_join_the_orders_without_a_lookup(spark, root, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "_LOOKED_UP", 2)
    mart, asked = Mart(spark, root), []
    orders, items = Feed(spark, tmp_path / "orders"), Feed(spark, tmp_path / "items")
    orders.send(event("c", order(10)), event("c", order(11, "COMPLETED")))
    orders.run(mart, "orders")
    real = Mart.current
    monkeypatch.setattr(Mart, "current", lambda m, n, keys=None, *a: (asked.append(keys is None), real(m, n, keys, *a))[1])
    items.send(event("c", item(1, 10)), event("c", item(2, 11)), event("c", item(3, 12)))
    items.run(mart, "order_items")
    items.send(event("c", item(4, 10)))
    items.run(mart, "order_items")
    assert asked == [True, False]
    monkeypatch.undo()
    assert status_of(mart) == [(1, "PENDING"), (2, "COMPLETED"), (3, "unknown"), (4, "PENDING")]


def test_log_files_are_read_by_small_tasks(spark, feed):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    with session.log_tasks(spark):
        assert spark.conf.get(name) == str(16 * 1024**2)
    assert spark.conf.get(name) == before


def test_the_shop_streams_run_side_by_side_and_items_after_orders(spark, monkeypatch):
    seen = []

    class Started:
        def __init__(self, name):
            self.name = name
            seen.append(("start", name))

        def awaitTermination(self):
            seen.append(("end", self.name))

    monkeypatch.setattr(registry, "_append", lambda *a: None)
    monkeypatch.setattr(registry, "change_stream", lambda *a: None)
    monkeypatch.setattr(registry, "start_mart_stream", lambda mart, name, *a, **o: Started(name))
    registry._streamed_shop(spark, "/root/testdata/sf0.001")
    first = ["dim_customer", "dim_product", "fact_orders"]
    assert sorted(seen[:3]) == [("start", n) for n in first] and sorted(seen[3:6]) == [("end", n) for n in first]
    assert seen[6:] == [("start", "fact_order_items"), ("end", "fact_order_items")]


def test_the_first_items_count_as_synced(shop):
    mart, feeds = shop
    items, orders = mart.table("order_items"), mart.table("orders")
    assert items.synced_to("fact_orders") == orders.latest_version()
    feeds["orders"].send(event("c", order(12, "PROCESSING", 1)))
    feeds["orders"].run(mart, "orders")
    version = repair.sync_status(mart)
    assert rows(items.changed_since(version - 1, version), "order_item_id", "order_status") == [(2, "PROCESSING")]
    # Items that come later leave the mark: those before them are as old as they were.
    mark = items.synced_to("fact_orders")
    feeds["orders"].send(event("u", order(10, "COMPLETED", 2)))
    feeds["orders"].run(mart, "orders")
    feeds["order_items"].send(event("c", item(4, 10)))
    feeds["order_items"].run(mart, "order_items")
    assert items.synced_to("fact_orders") == mark
    assert repair.sync_status(mart) is not None
    stored = mart.read("order_items", stored_status=True)
    want = [(1, "COMPLETED"), (2, "PROCESSING"), (3, "unknown"), (4, "COMPLETED")]
    assert rows(stored, "order_item_id", "order_status") == want


def test_every_order_reaches_the_items(spark, tmp_path, monkeypatch):
    """Orders that come before the items, after them and without a date; 4 comes with a date and without one."""
    orders = [(1, "O", "1996-01-01"), (2, "P", "2001-05-01"), (3, "O", None), (4, "P", "2001-05-01"), (4, "O", None)]
    spark.createDataFrame(
        [(i, 1, status, day and dt.datetime.fromisoformat(day)) for i, status, day in orders],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(
        [(i, 7, 1, 2.0, dt.datetime(1996, 1, 2)) for i in range(1, 6)],
        "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_shipdate timestamp",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))

    def found():
        return rows(registry.QUERIES["stream_order_items"](spark, str(tmp_path)), "order_id", "order_status")

    want = {1: "PENDING", 2: "PROCESSING", 3: "PENDING", 4: "PROCESSING", 5: "unknown"}
    assert found() == sorted(want.items())
    # Without the sync the items of late orders keep what they came with.
    monkeypatch.setattr(repair, "sync_status", lambda *a: None)
    assert found() == sorted({**want, 2: "unknown", 4: "PENDING"}.items())


def test_both_status_sources_agree_after_sync(shop):
    mart, feeds = shop
    feeds["orders"].send(event("c", order(12, "PENDING", 1)), event("u", order(11, "COMPLETED", 1)))
    feeds["orders"].run(mart, "orders")
    args = (mart.read("fact_order_items"), mart.read("fact_orders"), mart.read("dim_product"))
    by_order = reports.pending_items_by_product(*args)
    by_item = reports.pending_items_by_product(*args, status_from="item")
    assert rows(by_order) == rows(by_item) == [(5, "bolt", 9, 2)]


def test_reports_are_published_whole_and_checked(shop, spark, monkeypatch):
    mart, feeds = shop
    feeds["orders"].send(event("c", order(13, customer_id=2)))
    feeds["orders"].run(mart, "orders")
    written = reporting.publish(mart)
    assert set(written) == set(reporting.REPORTS)
    stored = reporting.latest_report(mart, "top_customers")
    assert rows(stored, "contract_version", "customer_name", "pending_order_count") == [
        ("1.0.0", "ann", 1), ("1.0.0", "bob", 2)]
    assert reporting.latest_report(mart, "none") is None
    # A report that breaks its contract is not left behind.
    broken = stored.drop("contract_version", "generated_at").withColumn("customer_name", F.lit(None).cast("string"))
    monkeypatch.setattr(reporting, "report_set", lambda *a: {"top_customers": broken})
    with pytest.raises(reporting.BrokenContract, match="customer_name: 2 of 2 rows break not_null"):
        reporting.publish(mart)
    assert rows(reporting.latest_report(mart, "top_customers")) == rows(stored)
    monkeypatch.setattr(reporting, "report_set", lambda *a: {"top_customers": broken.drop("customer_id")})
    with pytest.raises(reporting.BrokenContract, match="missing column customer_id"):
        reporting.publish(mart)


def source_orders(spark, *extra):
    data = [
        (10, "REPROCESSING", dt.datetime(2024, 5, 1, 23, 59), 7, "x"),
        (20, None, dt.datetime(2024, 5, 2), 7, None),
        (30, "PENDING", dt.datetime(2024, 5, 3), 7, "y"),
        (40, "PENDING", dt.datetime(2024, 4, 30, 23, 59, 59), 7, "y"),
        *extra,
    ]
    return spark.createDataFrame(
        data, "order_id long, status string, created_at timestamp, created_by long, channel string"
    ).withColumn("updated_at", F.col("created_at"))


def test_backfill(shop, spark):
    mart, _ = shop
    done = repair.backfill(mart, "orders", source_orders(spark), "2024-05-01", "2024-05-02")
    assert (done.rows_before, done.rows_extracted, done.rows_after, done.net_change) == (2, 2, 3, 1)
    got = {r.order_id: r for r in mart.read("fact_orders").collect()}
    assert got[10].status == "REPROCESSING" and got[10][OFFSET] == 0
    assert json.loads(got[10][EXTRAS]) == {"channel": "x"}
    assert json.loads(got[20][EXTRAS]) == {"channel": None}
    assert got[20].status == "unknown" and got[20].customer_id == 0
    assert got[20].created_by is None
    created = mart.read("fact_orders").where("order_id = 10").select(F.unix_seconds("created_at"))
    assert created.first()[0] == 0
    assert set(got) == {10, 11, 20}


def test_backfill_keeps_columns_it_does_not_deliver(spark, root, feed):
    mart = Mart(spark, root)
    feed.send(event("c", {**order(10), "created_by": 3, "updated_by": 4}))
    feed.run(mart, "orders")
    repair.backfill(mart, "orders", source_orders(spark), "2024-05-01", "2024-05-01")
    assert rows(mart.read("fact_orders"), "status", "created_by", "updated_by") == [("REPROCESSING", 3, 4)]


def test_backfill_dry_run_and_empty_range(shop, spark):
    mart, _ = shop
    before = mart.table("orders").latest_version()
    dry = repair.backfill(mart, "orders", source_orders(spark), "2024-05-01", dry_run=True)
    assert dry.rows_extracted == 3 and "Physical Plan" in dry.plan and dry.version is None
    none = repair.backfill(mart, "orders", source_orders(spark), "2020-01-01", "2020-01-02")
    assert (none.rows_extracted, none.rows_before, none.net_change, none.version) == (0, 2, 0, None)
    assert mart.table("orders").latest_version() == before
    with pytest.raises(ValueError):
        repair.backfill(mart, "orders", source_orders(spark), "2024/05/01")


def test_backfill_of_items_takes_the_order_status(shop, spark):
    mart, _ = shop
    source = spark.createDataFrame(
        [(8, 11, 5, 3, dt.datetime(2024, 5, 1))],
        "order_item_id long, order_id long, product_id long, quanity int, created_at timestamp",
    ).withColumn("updated_at", F.col("created_at"))
    repair.backfill(mart, "order_items", source, "2024-05-01", renames={"quanity": "quantity"})
    got = mart.table("order_items").read().where("order_item_id = 8")
    assert rows(got, "quantity", "order_status", EXTRAS) == [(3, "PENDING", None)]


def test_stream_batches_come_after_a_backfill(shop, spark):
    mart, feeds = shop
    repair.backfill(mart, "orders", source_orders(spark), "2024-05-01", "2024-05-01")
    feeds["orders"].send(event("u", order(10, "COMPLETED", 1)))
    feeds["orders"].run(mart, "orders")
    assert mart.read("fact_orders").where("order_id = 10").first().status == "COMPLETED"


def test_reset_and_replay(shop):
    mart, feeds = shop
    done = repair.reset_table(mart, "orders", replay=True)
    assert (done["rows_before"], done["rows_after"]) == (2, 0)
    assert mart.table("orders").read_history().count() == 0
    feeds["orders"].run(mart, "orders")
    assert rows(mart.read("fact_orders"), "order_id") == [(10,), (11,)]
    assert rows(mart.table("orders").read_history(), OFFSET) == [(0,), (1,)]


def test_reset_without_replay_continues(shop):
    mart, feeds = shop
    repair.reset_table(mart, "orders")
    feeds["orders"].send(event("c", order(14)))
    feeds["orders"].run(mart, "orders")
    assert rows(mart.read("fact_orders"), "order_id") == [(14,)]


def test_replay_over_a_kept_table(shop):
    mart, feeds = shop
    before = rows(mart.read("fact_orders"))
    repair.request_replay(mart, "orders")
    feeds["orders"].run(mart, "orders")
    assert rows(mart.read("fact_orders")) == before
    table = mart.table("orders")
    # The events were there: the replay has stored none of them again.
    assert rows(table.read_history(), OFFSET) == [(0,), (1,)]
    assert rows(table.read_history(distinct=True), OFFSET) == [(0,), (1,)]


def test_full_reset_clears_every_history(shop):
    mart, _ = shop
    repair.reset_all(mart)
    assert all(mart.table(n).read().count() == 0 for n in SPECS)
    assert all(mart.table(n).read_history().count() == 0 for n, s in SPECS.items() if s.history)


def test_validation(spark, root):
    mart = Mart(spark, root)
    assert mart.problems() == [f"{n}: missing" for n in SPECS]
    with pytest.raises(RuntimeError, match="dim_customer: missing"):
        mart.validate()
    mart.create()
    mart.validate()
    assert names(mart) == []
    wrong = mart.read("dim_customer").drop("is_active")
    wrong.write.parquet(f"{root}/dim_customer/state/version=7")
    assert mart.problems() == ["dim_customer: missing column is_active"]


def test_run_all_stops_every_stream_when_one_fails(spark, root, tmp_path):
    mart = Mart(spark, root)
    mart.create()
    good, bad = Feed(spark, tmp_path / "good"), Feed(spark, tmp_path / "bad")
    good.send(event("c", customer(1)))
    bad.send(event("c", order(1)))
    scans = {
        "customers": change_stream(spark, "parquet", {"path": good.path}),
        "orders": change_stream(spark, "parquet", {"path": bad.path}),
    }

    def fail_on_orders(_mart, table, _version):
        if table == "fact_orders":
            raise RuntimeError("orders stopped")

    with pytest.raises(Exception, match="orders stopped"):
        runner.run_all(mart, scans, trigger="1 second", on_commit=fail_on_orders)
    assert spark.streams.active == []


def test_progress_and_checkpoint_status(spark, root, feed):
    mart = Mart(spark, root)
    path = mart.checkpoint("customers")
    assert runner.checkpoint_status(spark, path)["exists"] is False
    feed.send(event("c", customer(1)))
    query = feed.run(mart, "customers")
    state = runner.progress(query)
    assert (state["name"], state["active"], state["batch_id"]) == ("customers_stream", False, 0)
    assert state["rows"] == 1
    assert runner.checkpoint_status(spark, path) == {"path": path, "exists": True, "committed_batches": 1}


def test_the_handler_alone_is_idempotent(spark, root):
    mart = Mart(spark, root)
    handle = batches.scd4_batch(mart, "dim_customer")
    log = records(spark, [event("c", customer(1, "a")), event("c", customer(2, "b"))])
    changes = batches.parse(log, SPECS["dim_customer"])
    for _ in range(2):
        handle(changes, 0)
    assert names(mart) == [(1, "a"), (2, "b")]
    assert mart.table("customers").read_history().count() == 2


def test_a_stored_feed_can_be_read_as_a_batch(spark, feed):
    feed.send(event("c", customer(1)), event("c", customer(2)))
    log = change_batch(spark, "parquet", {"path": feed.path})
    assert batches.parse(log, SPECS["dim_customer"]).count() == 2
