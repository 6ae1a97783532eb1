import datetime as dt

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cdcmart.operators import contracts, reports
from cdcmart.operators.contracts import CONTRACTS
from cdcmart.specs import CUSTOMERS, EXTRAS

D1, D2, D3, D4 = (dt.date(2024, 1, d) for d in (1, 2, 3, 4))


@pytest.fixture(scope="module")
def orders(spark):
    data = [
        (1, 100, D1, "PENDING"),
        (2, 100, D1, "PROCESSING"),
        (3, 101, D2, "PENDING"),
        (4, 101, D2, "unknown"),
        (5, 102, D3, "COMPLETED"),
        (6, 102, D3, "REPROCESSING"),
        (7, 999, D4, "PENDING"),
        (8, 999, D4, "PENDING"),
        (9, 999, D4, "PENDING"),
    ]
    return spark.createDataFrame(data, "order_id long, customer_id long, delivery_date date, status string")


@pytest.fixture(scope="module")
def items(spark):
    data = [
        (1, 1, 50, 4, None, "PENDING"),
        (2, 1, 50, 9, '{"quanity": 6}', "PENDING"),
        (3, 3, 51, None, '{"quanity": "many"}', "PENDING"),
        (4, 3, 51, 2, '{"quanity": null}', "PENDING"),
        (5, 3, 52, 1, "not json", "PENDING"),
        (6, 5, 50, 100, None, "COMPLETED"),
        (7, 77, 50, 100, None, "unknown"),
        (8, None, 50, 100, None, "unknown"),
    ]
    return spark.createDataFrame(
        data,
        f"order_item_id long, order_id long, product_id long, quantity int, {EXTRAS} string, order_status string",
    )


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([(50, "bolt"), (51, "nut")], "product_id long, product_name string")


def test_delivery_status_summary(orders):
    got = [tuple(r) for r in reports.delivery_status_summary(orders).collect()]
    assert got == [
        (D1, "PENDING", 1),
        (D1, "PROCESSING", 1),
        (D2, "PENDING", 1),
        (D2, "unknown", 1),
        (D3, "REPROCESSING", 1),
        (D4, "PENDING", 3),
    ]


def test_open_order_total(orders):
    assert reports.open_order_total(orders).first()[0] == 8
    assert reports.open_order_total(orders.where("status = 'COMPLETED'")).first()[0] == 0


def test_top_delivery_dates_breaks_ties_by_date(orders):
    got = reports.top_delivery_dates(orders)
    assert [tuple(r) for r in got.collect()] == [(D4, 3), (D1, 2), (D2, 2)]
    ranked = reports.with_rank(got, "open_order_count", "delivery_date")
    assert rows(ranked, "rnk", "delivery_date") == [(1, D4), (2, D1), (3, D2)]


@pytest.mark.parametrize("options", [{}, {"salt": 4}, {"status_from": "item"}])
def test_pending_items(items, orders, products, options):
    got = reports.pending_items_by_product(items, orders, products, **options)
    assert [tuple(r) for r in got.collect()] == [(50, "bolt", 10, 2), (51, "nut", 2, 2), (52, None, 1, 1)]


def test_pending_items_refuses_an_unknown_status_source(items, orders, products):
    with pytest.raises(ValueError):
        reports.pending_items_by_product(items, orders, products, status_from="guess")


def test_top_customers_need_a_customer(orders, spark):
    customers = spark.createDataFrame([(100, "a"), (101, "b"), (102, "c")], "customer_id long, customer_name string")
    got = reports.top_customers(orders, customers)
    assert [tuple(r) for r in got.collect()] == [(100, "a", 1), (101, "b", 1)]
    assert [r.customer_id for r in reports.top_customers(orders, customers, k=1).collect()] == [100]


def test_reports_fit_their_contracts(orders, items, products, spark):
    customers = spark.createDataFrame([(100, "a")], "customer_id long, customer_name string")
    made = {
        "delivery_status_summary": reports.delivery_status_summary(orders),
        "top_delivery_dates": reports.top_delivery_dates(orders),
        "pending_items_by_product": reports.pending_items_by_product(items, orders, products),
        "top_customers": reports.top_customers(orders, customers),
    }
    for name, contract in CONTRACTS.items():
        assert contracts.schema_differences(made[name], contract) == []
        broken = contracts.violations(made[name], contract).where("violations > 0")
        assert broken.count() == 0


def test_schema_differences(spark):
    frame = spark.createDataFrame([(1, "x")], "product_id int, extra string")
    found = contracts.schema_differences(frame, CONTRACTS["pending_items_by_product"])
    assert found == [
        "missing column product_name",
        "missing column pending_quantity",
        "missing column pending_item_count",
        "unexpected column extra",
        "column product_id is int, expected bigint",
    ]


def test_violations_count_nulls_and_long_texts(spark):
    frame = spark.createDataFrame(
        [(1, "x" * 256, True), (None, None, None), (3, "ok", None)],
        "customer_id long, customer_name string, is_active boolean",
    )
    got = contracts.violations(frame, contracts.table_contract(CUSTOMERS), CUSTOMERS.max_lengths)
    assert rows(got) == [
        ("customer_id", "not_null", 3, 1),
        ("customer_name", "max_length", 3, 1),
        ("customer_name", "not_null", 3, 1),
        ("is_active", "not_null", 3, 2),
    ]


def test_stamp(orders):
    when = dt.datetime(2024, 5, 6, tzinfo=dt.timezone.utc)
    got = contracts.stamp(reports.delivery_status_summary(orders), when)
    assert got.columns[:2] == ["contract_version", "generated_at"]
    assert got.select(F.unix_seconds("generated_at")).distinct().collect()[0][0] == when.timestamp()


def test_stored_status_filter_reaches_the_scan(orders, items, products, spark, tmp_path):
    for name, frame in {"o": orders, "i": items}.items():
        frame.write.parquet(str(tmp_path / name))
    stored = spark.read.parquet(str(tmp_path / "o"))
    plan = reports.top_delivery_dates(stored)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters: [Not(In(status, [COMPLETED]))]" in plan or "Not(EqualTo(status,COMPLETED))" in plan
    plan = reports.pending_items_by_product(spark.read.parquet(str(tmp_path / "i")), stored, products)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,PENDING)" in text
    assert "ReadSchema: struct<order_id:bigint,status:string>" in text
