import datetime as dt
import json
from decimal import Decimal

import pytest
from helpers import decimal, event, records, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions import codec, envelope
from cdcmart.specs import CUSTOMERS, EXTRAS, OFFSET, ORDERS, PRODUCTS


def test_keeps_creates_updates_and_reads_only(spark):
    row = {"customer_id": 1, "customer_name": "a"}
    log = records(
        spark,
        [event(op, row) for op in "cur"]
        + [event("d", None, row), event("t", row), None, "not json", '{"op": null}', "[]"],
    )
    parsed = envelope.parse_changes(log, CUSTOMERS)
    assert rows(parsed, "op", OFFSET) == [("c", 0), ("r", 2), ("u", 1)]


def test_deletes_come_from_the_before_image(spark):
    log = records(
        spark, [event("d", None, {"customer_id": 4, "customer_name": "x"}), event("c", {"customer_id": 5})]
    )
    parsed = envelope.parse_deletes(log, CUSTOMERS)
    assert rows(parsed, "customer_id", "customer_name", "op") == [(4, "x", "d")]


def test_one_pass_over_all_operations(spark):
    log = records(
        spark, [event("d", None, {"customer_id": 4}), event("c", {"customer_id": 5, "z": 1}), None]
    )
    parsed = envelope.parse_events(log, CUSTOMERS)
    assert rows(parsed, "customer_id", "op", EXTRAS) == [(4, "d", None), (5, "c", '{"z":1}')]


def test_connector_encodings(spark):
    order = {"order_id": 1, "order_date": 20000, "delivery_date": -1, "updated_at": 1735689600123}
    product = {"product_id": 2, "unity_price": decimal(12345, 2)}
    got = envelope.parse_changes(records(spark, [event("c", order)]), ORDERS).first()
    assert got.order_date == dt.date(2024, 10, 4)
    assert got.delivery_date == dt.date(1969, 12, 31)
    text = envelope.parse_changes(records(spark, [event("c", order)]), ORDERS).select(
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSS")
    )
    assert text.first()[0] == "2025-01-01 00:00:00.123"
    got = envelope.parse_changes(records(spark, [event("c", product)]), PRODUCTS).first()
    assert got.unity_price == Decimal("123.45")


def test_iso_encodings(spark):
    product = {"product_id": 2, "unity_price": "123.45", "updated_at": "2025-01-01T00:00:00.123"}
    order = {"order_id": 1, "order_date": "2024-10-04"}
    got = envelope.parse_changes(records(spark, [event("c", product)]), PRODUCTS, codec.ISO)
    assert rows(got, F.col("unity_price"), F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSS")) == [
        (Decimal("123.45"), "2025-01-01 00:00:00.123")
    ]
    got = envelope.parse_changes(records(spark, [event("c", order)]), ORDERS, codec.ISO)
    assert got.first().order_date == dt.date(2024, 10, 4)


def test_unknown_encoding_is_refused(spark):
    with pytest.raises(ValueError):
        envelope.parse_changes(records(spark, []), ORDERS, "avro")


@pytest.mark.parametrize(
    ("unscaled", "scale", "expected"),
    [
        (12345, 2, "123.45"),
        (7, 0, "7"),
        (-1500, 3, "-1.5"),
        (-1, 1, "-0.1"),
        (128, 2, "1.28"),
        (0, 2, "0"),
        (2**63, 12, "9223372.036854775808"),
        (-(2**64), 13, "-1844674.4073709551616"),
        (10**37, 30, "10000000"),
        (-123456789012345678901234567890, 24, "-123456.789012345678901234567890"),
    ],
)
def test_decimal_is_exact(spark, unscaled, scale, expected):
    wire = decimal(unscaled, scale)
    frame = spark.createDataFrame([(wire["value"], wire["scale"])], "v string, s int")
    wide = codec.decode_decimal(F.col("v"), F.col("s"), T.DecimalType(38, 28))
    assert frame.select(wide.alias("d")).first().d == Decimal(expected)


def test_unreadable_decimals_are_null(spark):
    frame = spark.createDataFrame(
        [("!!", 1), (None, 1), ("", 1), ("Bw==", None), ("fw" + "8A" * 40, 1), ("B4XuENXaRtkA9DagAAAAAA==", 0)],
        "v string, s int",
    )
    got = frame.select(codec.decode_decimal(F.col("v"), F.col("s"), T.DecimalType(10, 2)).alias("d"))
    assert [r.d for r in got.collect()] == [None] * 6


def test_decimal_round_trip(spark):
    kind = T.DecimalType(10, 2)
    values = [Decimal(v) for v in ("0.00", "-0.05", "12.34", "99999999.99", "-99999999.99")]
    frame = spark.createDataFrame([(v,) for v in [*values, None]], T.StructType([T.StructField("p", kind)]))
    back = frame.select("p", codec.decode(codec.encode(F.col("p"), kind), kind).alias("q"))
    assert all(r.p == r.q for r in back.collect())


def test_unknown_fields_keep_their_json_types(spark):
    extra = {"n": 5, "s": "5", "text": "žluť", "nested": {"a": [1, None]}, "nothing": None, "flag": True}
    log = records(spark, [event("c", {"customer_id": 1, **extra})])
    got = envelope.parse_changes(log, CUSTOMERS).first()[EXTRAS]
    assert json.loads(got) == extra


def test_no_unknown_fields_is_null(spark):
    log = records(
        spark,
        [event("c", {"customer_id": 1}), event("u", None), event("u", [1]), event("r", {})],
    )
    assert [r[EXTRAS] for r in envelope.parse_changes(log, CUSTOMERS).collect()] == [None] * 4


def test_a_field_named_like_a_lineage_column_is_unknown(spark):
    log = records(spark, [event("c", {"customer_id": 1, "_kafka_offset": 99})], first=7)
    got = envelope.parse_changes(log, CUSTOMERS).first()
    assert got[OFFSET] == 7
    assert json.loads(got[EXTRAS]) == {"_kafka_offset": 99}


def test_extras_from_a_table_row(spark):
    frame = spark.createDataFrame([(1, None, "é")], "a int, b int, c string")
    got = frame.select(envelope.extra_columns_from_row(frame, ["a"]).alias("x")).first().x
    assert json.loads(got) == {"b": None, "c": "é"}
    none = frame.select(envelope.extra_columns_from_row(frame, "abc").alias("x")).first().x
    assert none is None


def test_records_round_trip(spark):
    frame = spark.createDataFrame(
        [(1, "é", True, None, dt.datetime(2024, 1, 2, 3, 4, 5), 9, None, None)], CUSTOMERS.schema
    )
    log = envelope.build_records(
        frame, CUSTOMERS, "t", F.lit(3), F.lit("c"), {"loyalty": F.lit(8)}, F.lit(2)
    )
    back = envelope.parse_changes(log, CUSTOMERS)
    assert rows(back, *CUSTOMERS.schema.names) == rows(frame)
    assert rows(back, EXTRAS, OFFSET, "_kafka_partition") == [('{"loyalty":8}', 3, 2)]
