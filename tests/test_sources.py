import json

import pytest

from cdcmart.operators import backfill, replay
from cdcmart.plans.repair import row_counts
from cdcmart.session import scratch_dir, shuffle_width
from cdcmart.sinks.external import merge_into_table, staging_options
from cdcmart.sources import changes, tables
from cdcmart.specs import CUSTOMERS, ORDER_ITEMS, OFFSET, resolve


def test_kafka_options():
    topic = changes.topic_name("shop", "operations", "orders")
    assert changes.kafka_options("broker:9092", topic) == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "shop.operations.orders",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    bounded = changes.kafka_options("b", "t", max_offsets_per_trigger=10, min_partitions=4)
    assert (bounded["maxOffsetsPerTrigger"], bounded["minPartitions"]) == ("10", "4")


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError):
        changes.change_stream(spark, "csv", {"path": "x"})


def test_positions():
    assert replay.parse_position("Earliest") == "earliest"
    assert replay.parse_position("latest") == "latest"
    assert replay.parse_position("5000") == 5000
    for bad in ("-1", "soon", ""):
        with pytest.raises(ValueError):
            replay.parse_position(bad)
    assert replay.starting_offsets("t", "latest") == "latest"
    assert json.loads(replay.starting_offsets("t", 7, range(2))) == {"t": {"0": 7, "1": 7}}


def test_replay_from(spark):
    log = spark.range(5).withColumnRenamed("id", OFFSET)
    assert replay.replay_from(log, 3).count() == 2
    assert replay.replay_from(log, "earliest").count() == 5
    with pytest.raises(ValueError):
        replay.replay_from(log, "latest")


def test_jdbc_options():
    assert tables.jdbc_options("jdbc:x", "t")["fetchsize"] == "10000"
    parallel = tables.jdbc_options("jdbc:x", "t", key="id", bounds=(0, 100), partitions=4)
    assert parallel["partitionColumn"] == "id" and parallel["numPartitions"] == "4"
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", key="id")
    staging = staging_options("jdbc:x", "s", {"user": "u"})
    assert staging["truncate"] == "true" and staging["user"] == "u" and staging["dbtable"] == "s"


def test_merge_needs_a_table_format_that_supports_it(spark, tmp_path):
    empty = spark.createDataFrame([], CUSTOMERS.mart_schema)
    empty.write.option("path", str(tmp_path / "t")).saveAsTable("plain_customers")
    try:
        with pytest.raises(Exception, match="MERGE INTO TABLE"):
            merge_into_table(empty, "plain_customers", CUSTOMERS)
    finally:
        spark.sql("drop table plain_customers")


def test_shuffle_width():
    assert shuffle_width(1) == 200
    assert shuffle_width(1024**4) == 2048
    assert shuffle_width(100 * 1000**4) == 186_265


def test_names_resolve():
    assert resolve("Customers") is resolve("dim_customer") is CUSTOMERS
    assert resolve("order_items") is ORDER_ITEMS
    with pytest.raises(ValueError, match="dim_customer"):
        resolve("nothing")


def test_strict_dates():
    assert backfill.parse_date("2024-02-29").day == 29
    for bad in ("2024-2-30", "20240229", "2024-02-29 ", "today"):
        with pytest.raises(ValueError):
            backfill.parse_date(bad)


def test_extract_range_reaches_the_scan(spark):
    source = tables.file_table(spark, "/root/testdata/sf0.001/orders.parquet").withColumnRenamed(
        "o_orderkey", "order_id"
    )
    from cdcmart.specs import ORDERS

    rows = backfill.extract(source, ORDERS, "1996-01-01", "1996-12-31", date_column="o_orderdate")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_row_counts(spark):
    got = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert [tuple(r) for r in got.orderBy("table_name").collect()] == [("a", 3), ("b", 0)]


class Settings:
    """Stands in for a session: the real setting cannot be changed while one runs."""

    def __init__(self, master, **conf):
        self.conf = conf
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_follows_the_session(spark):
    named = Settings("spark://host", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = scratch_dir(named, "x"), scratch_dir(named, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second
    shared = {"spark.sql.warehouse.dir": "file:/house"}
    assert scratch_dir(Settings("yarn", **shared), "x").startswith("file:/house/scratch/x-")
