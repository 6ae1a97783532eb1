"""Change envelope ``{before, after, op}``: parse it, keep unknown fields, build it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions import codec
from cdcmart.specs import EXTRAS, LINEAGE, OFFSET, PARTITION, TOPIC, TableSpec

# Shape of a change record, as the Kafka source delivers it.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Operation codes: create, update, snapshot read, delete.
UPSERTS = ("c", "u", "r")
DELETE = "d"


def envelope_schema(
    schema: T.StructType, images: Iterable[str] = ("before", "after"), encoding: str = codec.CONNECT
) -> T.StructType:
    """Envelope around a table schema; only the images asked for are materialised."""
    row = codec.wire_schema(schema, encoding)
    return T.StructType(
        [T.StructField(i, row) for i in images] + [T.StructField("op", T.StringType())]
    )


def _parsed(
    records: DataFrame, spec: TableSpec, images: tuple[str, ...], ops: tuple[str, ...], encoding: str
) -> DataFrame:
    text = F.col("value").cast("string")
    event = F.from_json(text, envelope_schema(spec.schema, images, encoding))
    # Exploding a filtered one-element array parses the text once. A where() on the parsed op would
    # be pushed below the projection and parse every text a second time.
    wanted = F.filter(F.array(event), lambda e: e["op"].isin(*ops))
    return records.select(
        text.alias("_value"),
        F.explode(wanted).alias("_event"),
        F.col("topic").alias(TOPIC),
        F.col("partition").alias(PARTITION),
        F.col("offset").alias(OFFSET),
    )


def _image(spec: TableSpec, row: Column, encoding: str) -> list[Column]:
    return [
        codec.decode(row.getField(f.name), f.dataType, encoding).alias(f.name) for f in spec.schema
    ]


def parse_changes(records: DataFrame, spec: TableSpec, encoding: str = codec.CONNECT) -> DataFrame:
    """Creates, updates and snapshot reads, flattened from the after-image.

    Tombstones, text that is not JSON and deletes carry no wanted ``op`` and drop out.
    """
    parsed = _parsed(records, spec, ("after",), UPSERTS, encoding)
    return parsed.select(
        *_image(spec, F.col("_event.after"), encoding),
        F.col("_event.op").alias("op"),
        extra_columns(F.col("_value"), spec.schema.names).alias(EXTRAS),
        TOPIC,
        PARTITION,
        OFFSET,
    )


def parse_deletes(records: DataFrame, spec: TableSpec, encoding: str = codec.CONNECT) -> DataFrame:
    """Deletes, flattened from the before-image."""
    parsed = _parsed(records, spec, ("before",), (DELETE,), encoding)
    return parsed.select(
        *_image(spec, F.col("_event.before"), encoding),
        F.col("_event.op").alias("op"),
        TOPIC,
        PARTITION,
        OFFSET,
    )


def parse_events(records: DataFrame, spec: TableSpec, encoding: str = codec.CONNECT) -> DataFrame:
    """Every operation in one pass: deletes from the before-image, the rest from the after-image."""
    parsed = _parsed(records, spec, ("before", "after"), (*UPSERTS, DELETE), encoding)
    row = F.when(F.col("_event.op") == DELETE, F.col("_event.before")).otherwise(
        F.col("_event.after")
    )
    flat = parsed.withColumn("_row", row)
    return flat.select(
        *_image(spec, F.col("_row"), encoding),
        F.col("_event.op").alias("op"),
        F.when(F.col("_event.op") == DELETE, extra_columns(F.col("_value"), spec.schema.names, "before"))
        .otherwise(extra_columns(F.col("_value"), spec.schema.names))
        .alias(EXTRAS),
        TOPIC,
        PARTITION,
        OFFSET,
    )


def extra_columns(value: Column, known: Iterable[str], image: str = "after") -> Column:
    """Fields of an image outside the table schema, as JSON text; NULL when there are none.

    The image is read as a map of variants, which keeps numbers, strings, nested values and
    explicit nulls apart.
    """
    names = [n for n in known if n not in LINEAGE]
    fields = F.from_json(value, f"struct<{image}: map<string, variant>>").getField(image)
    unknown = F.map_filter(fields, lambda k, _: ~k.isin(*names))
    return F.nullif(F.to_json(unknown), F.lit("{}"))


def extra_columns_from_row(rows: DataFrame, known: Iterable[str]) -> Column:
    """Columns of a table row outside the known ones, as JSON text; NULL when there are none."""
    known = set(known)
    others = [c for c in rows.columns if c not in known]
    if not others:
        return F.lit(None).cast("string")
    return F.to_json(F.struct(*others), {"ignoreNullFields": "false"})


def build_records(
    rows: DataFrame,
    spec: TableSpec,
    topic: str,
    offset: Column,
    op: Column,
    extras: Mapping[str, Column] | None = None,
    partition: Column | None = None,
    encoding: str = codec.CONNECT,
) -> DataFrame:
    """Turn table rows into change records, the inverse of :func:`parse_changes`."""
    fields = [
        codec.encode(F.col(f.name), f.dataType, encoding).alias(f.name) for f in spec.schema
    ] + [c.alias(n) for n, c in (extras or {}).items()]
    row = F.struct(*fields)
    envelope = F.struct(
        F.when(op == DELETE, row).alias("before"),
        F.when(op != DELETE, row).alias("after"),
        op.alias("op"),
    )
    return rows.select(
        F.to_json(F.struct(*spec.key)).cast("binary").alias("key"),
        F.to_json(envelope, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (partition if partition is not None else F.lit(0)).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
