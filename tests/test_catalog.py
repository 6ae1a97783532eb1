"""The mart's tables under their names in the catalog."""

import uuid

import pytest
from helpers import event, rows
from test_mart import Feed, customer, order

from cdcmart.plans import catalog
from cdcmart.sinks.mart import Mart


@pytest.fixture
def database(spark):
    name = f"mart_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"drop database if exists {name} cascade")


def test_sql_over_the_mart(spark, root, tmp_path, database):
    mart = Mart(spark, root)
    assert catalog.register(mart, database) == {}
    assert catalog.problems(mart, database) == [f"{database}.{n}: missing" for n in mart.specs]
    mart.create()
    made = catalog.register(mart, database)
    assert sorted(made) == sorted(mart.specs) and catalog.problems(mart, database) == []
    orders, customers = Feed(spark, tmp_path / "o"), Feed(spark, tmp_path / "c")
    orders.send(event("c", order(1)), event("c", order(2, "COMPLETED")), event("c", order(3, customer_id=2)))
    customers.send(event("c", customer(1, "ann")), event("c", customer(2, "bob")))
    orders.run(mart, "orders")
    customers.run(mart, "customers")
    assert spark.table(f"{database}.fact_orders").count() == 0
    catalog.register(mart, database, fold=True)
    found = spark.sql(
        f"select c.customer_name, count(*) n from {database}.fact_orders o join {database}.dim_customer c"
        " using (customer_id) where o.status = 'PENDING' group by 1"
    )
    assert rows(found) == [("ann", 1), ("bob", 1)]
    catalog.validate(mart, database)


def test_missing_changed_and_old_tables_are_found(spark, root, tmp_path, database):
    mart = Mart(spark, root)
    mart.create()
    catalog.register(mart, database)
    orders = Feed(spark, tmp_path / "o")
    orders.send(event("c", order(1)))
    orders.run(mart, "orders")
    mart.table("orders").rewrite()
    assert catalog.problems(mart, database) == [f"{database}.fact_orders: does not stand on the newest state"]
    catalog.register(mart, database)
    spark.sql(f"drop table {database}.dim_product")
    spark.sql(f"drop table {database}.dim_customer")
    folder = catalog._location(mart, "dim_customer")
    spark.catalog.createTable(f"{database}.dim_customer", path=folder, source="parquet",
                              schema=mart.specs["fact_orders"].mart_schema)
    found = catalog.problems(mart, database)
    assert f"{database}.dim_product: missing" in found
    assert any(p.startswith(f"{database}.dim_customer: ") for p in found)
    with pytest.raises(RuntimeError, match="dim_product: missing"):
        catalog.validate(mart, database)
