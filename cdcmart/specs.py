"""Table specifications: one record per mart table drives every operator."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import types as T

OFFSET = "_kafka_offset"
EXTRAS = "_additional_columns"
TOPIC = "_kafka_topic"
PARTITION = "_kafka_partition"
LINEAGE = (EXTRAS, OFFSET)

# Marks a column whose null default is the processing date.
TODAY = object()


@dataclass(frozen=True)
class TableSpec:
    """What a mart table is keyed by, how nulls are filled and how versions of a row are ordered."""

    name: str
    source: str
    schema: T.StructType
    key: tuple[str, ...]
    defaults: Mapping[str, object] = field(default_factory=dict)
    order_by: tuple[str, ...] = ("updated_at", OFFSET)
    insert_only: tuple[str, ...] = ("created_at",)
    history: bool = True
    derived: Mapping[str, T.DataType] = field(default_factory=dict)
    backfill_omits: tuple[str, ...] = ("created_by", "updated_by")
    max_lengths: Mapping[str, int] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    soft_delete_flag: str | None = None

    @property
    def columns(self) -> list[str]:
        """Columns of the current-state table, in order."""
        return [f.name for f in self.mart_schema]

    @property
    def mart_schema(self) -> T.StructType:
        extra = [T.StructField(c, t) for c, t in self.derived.items()]
        return T.StructType(
            [T.StructField(f.name, f.dataType) for f in self.schema]
            + extra
            + [T.StructField(EXTRAS, T.StringType()), T.StructField(OFFSET, T.LongType())]
        )

    @property
    def history_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField("history_id", T.LongType())]
            + list(self.mart_schema)
            + [T.StructField("recorded_at", T.TimestampType())]
        )


def _schema(*columns: tuple[str, T.DataType]) -> T.StructType:
    audit = [
        ("updated_at", T.TimestampType()),
        ("updated_by", T.LongType()),
        ("created_at", T.TimestampType()),
        ("created_by", T.LongType()),
    ]
    return T.StructType([T.StructField(c, t) for c, t in [*columns, *audit]])


CUSTOMERS = TableSpec(
    name="dim_customer",
    source="customers",
    key=("customer_id",),
    schema=_schema(
        ("customer_id", T.LongType()),
        ("customer_name", T.StringType()),
        ("is_active", T.BooleanType()),
        ("customer_address", T.StringType()),
    ),
    defaults={"customer_name": "", "is_active": True},
    max_lengths={"customer_name": 255, "customer_address": 500},
    required=("customer_id", "customer_name", "is_active"),
    soft_delete_flag="is_active",
)

PRODUCTS = TableSpec(
    name="dim_product",
    source="products",
    key=("product_id",),
    schema=_schema(
        ("product_id", T.LongType()),
        ("product_name", T.StringType()),
        ("barcode", T.StringType()),
        ("unity_price", T.DecimalType(10, 2)),
        ("is_active", T.BooleanType()),
    ),
    defaults={
        "product_name": "",
        "barcode": "",
        "unity_price": Decimal("0.00"),
        "is_active": True,
    },
    max_lengths={"product_name": 255, "barcode": 100},
    required=("product_id", "product_name", "unity_price", "is_active"),
    soft_delete_flag="is_active",
)

ORDERS = TableSpec(
    name="fact_orders",
    source="orders",
    key=("order_id",),
    schema=_schema(
        ("order_id", T.LongType()),
        ("order_date", T.DateType()),
        ("delivery_date", T.DateType()),
        ("customer_id", T.LongType()),
        ("status", T.StringType()),
    ),
    defaults={
        "customer_id": 0,
        "order_date": TODAY,
        "delivery_date": TODAY,
        "status": "unknown",
    },
    max_lengths={"status": 50},
    required=("order_id", "order_date", "delivery_date", "status"),
)

ORDER_ITEMS = TableSpec(
    name="fact_order_items",
    source="order_items",
    key=("order_item_id",),
    schema=_schema(
        ("order_item_id", T.LongType()),
        ("order_id", T.LongType()),
        ("product_id", T.LongType()),
        ("quantity", T.IntegerType()),
    ),
    defaults={"order_id": 0, "product_id": 0, "quantity": 0, "order_status": "unknown"},
    history=False,
    derived={"order_status": T.StringType()},
    max_lengths={"order_status": 50},
    required=("order_item_id", "quantity", "order_status"),
)

SPECS: dict[str, TableSpec] = {s.name: s for s in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)}


def resolve(name: str) -> TableSpec:
    """Find a spec by mart table name or by source table name, ignoring case."""
    wanted = name.lower()
    for spec in SPECS.values():
        if wanted in (spec.name, spec.source):
            return spec
    known = sorted(n for s in SPECS.values() for n in (s.name, s.source))
    raise ValueError(f"unknown table {name!r}; known names: {', '.join(known)}")
