"""Lost offsets, unreadable records and unknown fields, in batch and in audited streams."""

import json

import pytest
from helpers import decimal, event, records, rows
from pyspark.sql import functions as F
from test_mart import Feed, customer, item, order

from cdcmart.functions import envelope
from cdcmart.operators import audit
from cdcmart.plans import repair
from cdcmart.sinks.mart import Mart
from cdcmart.specs import CUSTOMERS, EXTRAS, OFFSET, PARTITION, PRODUCTS, TOPIC
from cdcmart.streaming import batches


@pytest.mark.parametrize("size", [1, 3, 10, 1000])
def test_gaps_are_found_whatever_the_ranges(spark, size):
    log = {("a", 0): [0, 1, 2, 5, 6, 6, 9, 30, 31, 31, 31], ("a", 1): [7], ("b", None): [-3, 2, 4], (None, 0): [1, 2]}
    given = [(t, p, o) for (t, p), offsets in log.items() for o in offsets] + [("a", 0, None)]
    positions = spark.createDataFrame(given, f"{TOPIC} string, {PARTITION} int, {OFFSET} long").repartition(3)
    assert rows(audit.offset_gaps(positions, size)) == sorted([
        ("a", 0, 3, 4, 2), ("a", 0, 7, 8, 2), ("a", 0, 10, 29, 20), ("b", None, -2, 1, 4), ("b", None, 3, 3, 1),
    ], key=repr)
    assert rows(audit.offset_summary(positions, size)) == sorted([
        ("a", 0, 0, 31, 8, 3, 24), ("a", 1, 7, 7, 1, 0, 0), ("b", None, -3, 4, 3, 0, 5), (None, 0, 1, 2, 2, 0, 0),
    ], key=repr)
    assert audit.offset_gaps(positions.limit(0), size).count() == 0


CASES = [
    (event("c", customer(1)), "change", None),
    (event("d", None, customer(1)), "delete", None),
    (None, "tombstone", None),
    ("", "not_json", None),
    ("junk", "not_json", None),
    ('{"op":"c","after":{"customer_id":1}', "not_json", None),
    ("[]", "not_json", None),
    ("3", "not_json", None),
    ("null", "not_json", None),
    ("{}", "no_op", None),
    (json.dumps({"op": None, "after": customer(1)}), "no_op", None),
    (event("t", customer(1)), "unknown_op", None),
    (event("c"), "missing_image", None),
    (event("u", None, customer(1)), "missing_image", None),
    (event("d", customer(1)), "missing_image", None),
    (event("c", customer("one", is_active="maybe")), "misfit", "customer_id,is_active"),
    (event("c", customer(1, updated_by=None, colour={"a": 1})), "change", None),
    (event("c", {"customer_id": 1, "updated_at": 2**62}), "misfit", "updated_at"),
]


def test_every_record_has_one_outcome(spark):
    log = records(spark, [c[0] for c in CASES])
    found = {r[OFFSET]: (r.outcome, r.fields) for r in audit.outcomes(log, CUSTOMERS).collect()}
    assert [found[i] for i in range(len(CASES))] == [c[1:] for c in CASES]
    bad = audit.quarantine(log, CUSTOMERS)
    assert bad.columns == [TOPIC, PARTITION, OFFSET, "reason", "fields", "text"]
    assert bad.count() == sum(c[1] not in audit.READABLE for c in CASES)
    # What the parser keeps: changes, those with values that do not fit, and events without an image.
    kept = {r[OFFSET] for r in envelope.parse_events(log, CUSTOMERS).collect()}
    assert kept == {i for i, c in enumerate(CASES) if c[1] in ("change", "delete", "misfit", "missing_image")}
    assert audit.quarantine(log.limit(0), CUSTOMERS).count() == 0


def test_decimals_that_do_not_fit(spark):
    good = {"product_id": 1, "unity_price": decimal(123, 2)}
    bad = {"product_id": 1, "unity_price": {"scale": 2, "value": "?"}}
    log = records(spark, [event("c", good), event("c", bad), event("c", {"product_id": 1, "unity_price": 5})])
    assert rows(audit.outcomes(log, PRODUCTS), OFFSET, "outcome", "fields") == [
        (0, "change", None), (1, "misfit", "unity_price"), (2, "misfit", "unity_price")]


def test_drift_tells_types_and_places(spark):
    extras = ['{"a":1}', '{"a":"x","b":null}', None, '{"a":2,"c":{"d":[1.5]}}', '{"b":true}']
    changes = spark.createDataFrame(list(enumerate(extras)), f"{OFFSET} long, {EXTRAS} string")
    report = audit.drift_report(changes)
    assert rows(report) == sorted([
        ("a", "BIGINT", "VARIANT", 2, 0, 3), ("a", "STRING", "VARIANT", 1, 1, 1), ("b", "VOID", "BOOLEAN", 1, 1, 1),
        ("b", "BOOLEAN", "BOOLEAN", 1, 4, 4), ("c", "OBJECT<d: ARRAY<DECIMAL(2,1)>>", "OBJECT<d: ARRAY<DECIMAL(2,1)>>", 1, 3, 3),
    ], key=repr)
    assert rows(audit.new_fields(report, ["a", "b"]), "field") == [("c",)]
    assert audit.drift_report(changes.limit(0)).count() == 0


def test_an_audited_stream_notes_what_it_never_saw(spark, root, tmp_path):
    mart, feed = Mart(spark, root), Feed(spark, tmp_path / "feed")
    assert batches.lost_offsets(mart, "customers") is None and batches.unreadable(mart, "customers") is None
    feed.send(event("c", customer(1)), "junk", None)
    feed.run(mart, "customers", audit=True)
    feed.send(event("u", customer(1, "b", 3)), event("c", customer("x")), event("d", None, customer(1)), first=7)
    feed.run(mart, "customers", audit=True)
    assert rows(batches.lost_offsets(mart, "customers"), "first_missing", "last_missing") == [(3, 6)]
    assert rows(batches.unreadable(mart, "customers"), OFFSET, "reason") == [(1, "not_json"), (8, "misfit")]
    assert rows(mart.read("dim_customer"), "customer_id", "customer_name") == [(1, "b")]
    # A replay is a log of its own.
    repair.request_replay(mart, "customers")
    assert batches.lost_offsets(mart, "customers") is None
    feed.run(mart, "customers", audit=True)
    assert rows(batches.lost_offsets(mart, "customers"), "missing") == [(4,)]
    assert rows(batches.lost_offsets(mart, "customers", 0), "missing") == [(4,)]


def test_a_failed_batch_is_noted_once(spark, root, tmp_path):
    mart, feed = Mart(spark, root), Feed(spark, tmp_path / "feed")
    feed.send(event("c", customer(1)), "junk")

    def fail(*_):
        raise RuntimeError("stop")

    with pytest.raises(Exception, match="stop"):
        feed.run(mart, "customers", audit=True, on_commit=fail)
    feed.run(mart, "customers", audit=True)
    assert batches.unreadable(mart, "customers").count() == 1 and batches.lost_offsets(mart, "customers").count() == 0


def test_a_batch_of_orders_syncs_the_items(spark, root, tmp_path):
    mart = Mart(spark, root)
    orders, items = Feed(spark, tmp_path / "o"), Feed(spark, tmp_path / "i")
    run = lambda feed, name: feed.run(mart, name, on_commit=repair.sync_after_commit)
    orders.send(event("c", order(1)))
    run(orders, "orders")
    items.send(event("c", item(1, 1)), event("c", item(2, 2)))
    run(items, "order_items")
    stored = lambda: rows(mart.read("fact_order_items", stored_status=True), "order_item_id", "order_status")
    assert stored() == [(1, "PENDING"), (2, "unknown")]
    # A batch of orders only: the stored status follows without a command.
    orders.send(event("u", order(1, "COMPLETED", 5)), event("c", order(2, "PROCESSING")))
    run(orders, "orders")
    assert stored() == [(1, "COMPLETED"), (2, "PROCESSING")]
    items.send(event("u", item(1, 2, minute=9)))
    run(items, "order_items")
    assert stored() == [(1, "PROCESSING"), (2, "PROCESSING")]
    assert mart.table("order_items").read().where(F.col("order_status").isNull()).count() == 0


def test_a_record_is_parsed_once(spark):
    """A filter on the outcome repeats no parser: each of them stands once in the plan."""
    log = records(spark, [event("c", customer(1))])
    plan = audit.quarantine(log, CUSTOMERS)._jdf.queryExecution().optimizedPlan().toString()
    # One for the typed images, one for the values as they were given.
    assert plan.lower().count("from_json(") == 2
