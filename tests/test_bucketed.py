"""Joins of bucketed tables: no exchange below them, hot keys outside the buckets, the same rows."""

import uuid

import pytest
from helpers import rows
from pyspark.sql import functions as F

from cdcmart.operators import upsert
from cdcmart.plans import registry
from cdcmart.sinks import bucketed
from cdcmart.sinks.bucketed import BucketedTable


@pytest.fixture
def pair(spark, tmp_path):
    mark = uuid.uuid4().hex
    made = [BucketedTable(spark, f"{name}_{mark}", "order_id") for name in ("items", "orders")]
    yield made
    for table in made:
        table.drop()


def items(spark):
    """A third of the rows without an order, a third of the rest with one and the same."""
    key = F.when(F.col("id") % 9 < 2, F.lit(None)).when(F.col("id") % 9 == 2, 0).when(F.col("id") % 9 < 5, 7)
    return spark.range(9000).select(
        F.col("id").alias("item_id"), key.otherwise(F.col("id") % 2500).cast("long").alias("order_id")
    )


def orders(spark, first=1):
    return spark.range(first, 2000).select(F.col("id").alias("order_id"), F.concat(F.lit("s"), F.col("id") % 4).alias("status"))


def shuffles(df):
    """Shuffles by a key; the scalar subquery for the default key gathers one row, which is none."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("first", [0, 1])
def test_parts_make_the_whole_join(spark, pair, tmp_path, first):
    many, one = pair
    many.write(items(spark), 4, str(tmp_path), default=0)
    one.write(orders(spark, first), 4, str(tmp_path), unique=True)
    want = upsert.denormalize(items(spark), orders(spark, first))
    assert rows(bucketed.by_parts(many, one, upsert.denormalize)) == rows(want)
    loose = {r.order_id: r["count"] for r in many.loose().groupBy("order_id").count().collect()}
    assert loose[None] == 2000 and loose[0] >= 1000 and loose[7] >= 2000 and len(loose) <= 1003
    assert many.rows().count() + many.loose().count() == 9000
    # Written again, it is replaced.
    many.write(items(spark).limit(10), 4, str(tmp_path), default=0)
    assert many.rows().count() + many.loose().count() == 10


def test_no_exchange_below_a_bucketed_join(spark, pair, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many, one = pair
        many.write(items(spark), 4, str(tmp_path), default=0)
        one.write(orders(spark), 4, str(tmp_path), unique=True)
        (left, right), loose = bucketed.parts(many, one)
        assert shuffles(upsert.sync_from(left.withColumn("order_status", F.lit("x")), right)) == 0
        counted = left.join(right.where("status = 's1'"), "order_id").groupBy("order_id").count()
        assert shuffles(counted) == 0
        plain = items(spark).where("order_id > 0").join(orders(spark), "order_id")
        assert shuffles(plain) == 2
        assert shuffles(loose[0].join(loose[1], "order_id")) > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_tables(spark, pair, tmp_path):
    many, one = pair
    many.write(items(spark).limit(0), 4, str(tmp_path), default=0)
    one.write(orders(spark).limit(0), 4, str(tmp_path), unique=True)
    assert bucketed.by_parts(many, one, upsert.denormalize).count() == 0
    assert bucketed.width(0) == 8 and bucketed.width(10**12) == 3726


def test_buckets_grow_with_the_rows(spark, pair, tmp_path):
    """A bucket is one task's work: more rows make more buckets, not larger ones."""
    many, _ = pair
    lines = spark.range(40_000).select(F.col("id").alias("order_id"))
    buckets = bucketed.width_for(lines, 2000)
    assert (buckets, bucketed.width_for(lines.limit(10), 2000)) == (20, 8)
    many.write(lines, buckets, str(tmp_path))
    sizes = [r["count"] for r in many.rows().groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 3000


def test_the_bucketed_query_takes_its_width_from_the_rows(spark, monkeypatch):
    monkeypatch.setattr(bucketed.width_for, "__defaults__", (500,))
    items, orders = registry._bucketed(spark, "/root/testdata/sf0.001")
    n = registry.b.fact_order_items(spark, "/root/testdata/sf0.001").count()
    assert n > 4000
    for table in (items, orders):
        told = {r.col_name: r.data_type for r in spark.sql(f"describe extended {table.name}").collect()}
        assert int(told["Num Buckets"]) == -(-n // 500)
        table.drop()


def test_loose_rows_are_not_shuffled_by_their_key(spark, pair, tmp_path):
    """All of them may have one key: only the distinct keys are shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many, one = pair
        many.write(items(spark), 4, str(tmp_path), default=0)
        one.write(orders(spark, 0), 4, str(tmp_path), unique=True)
        _, (left, right) = bucketed.parts(many, one)
        met = left.join(right.where("status = 's0'").select("order_id"), "order_id")
        assert shuffles(met) == 1
        assert met.count() == left.join(orders(spark, 0).where("status = 's0'"), "order_id").count() >= 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
