"""What a log holds and what was made of it: lost and repeated offsets, records that cannot be read, unknown fields."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.functions import codec
from cdcmart.functions.envelope import DELETE, UPSERTS, envelope_schema
from cdcmart.specs import EXTRAS, OFFSET, PARTITION, TOPIC, TableSpec

# Offsets of one range that a task looks at; a partition of a topic has any number of them.
_RANGE = 1_000_000

# -- offsets ----------------------------------------------------------------------------------


def offset_ranges(positions: DataFrame, size: int = _RANGE) -> DataFrame:
    """Distinct offsets by range of a partition: first, last, how many, all rows, and gaps within.

    Repeated offsets are merged before anything is sorted, and a sort sees one range at a time.
    """
    log = [TOPIC, PARTITION]
    seen = (
        positions.where(F.col(OFFSET).isNotNull())
        .groupBy(*log, OFFSET)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("range", F.floor(F.col(OFFSET) / size))
    )
    before = F.lag(OFFSET).over(Window.partitionBy(*log, "range").orderBy(OFFSET))
    gap = F.when(F.col(OFFSET) > F.col("before") + 1, F.struct(F.col("before") + 1, F.col(OFFSET) - 1))
    return (
        seen.withColumn("before", before)
        .groupBy(*log, "range")
        .agg(
            F.min(OFFSET).alias("first"),
            F.max(OFFSET).alias("last"),
            F.count(F.lit(1)).alias("offsets"),
            F.sum("rows").alias("rows"),
            F.collect_list(gap).cast("array<struct<first:bigint,last:bigint>>").alias("gaps"),
        )
    )


def offset_gaps(positions: DataFrame, size: int = _RANGE) -> DataFrame:
    """Every stretch of offsets that is missing between two that are there, by topic and partition.

    Offsets that a compacted or transactional topic never gives out are missing too.

    ``positions`` are all records that were taken from the log, whatever became of them: history, rejected and
    unreadable ones, deletes and tombstones (see :func:`outcomes`). Null topics and partitions are a log of their
    own; rows without an offset are left out.
    """
    return gaps_of(offset_ranges(positions, size))


def gaps_of(ranges: DataFrame) -> DataFrame:
    """:func:`offset_gaps` from ranges; none may hold offsets that lie in a gap of another."""
    within = ranges.select(TOPIC, PARTITION, F.explode("gaps").alias("gap"))
    # One row a range: what is sorted by partition here is smaller by the size of a range.
    earlier = Window.partitionBy(TOPIC, PARTITION).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    before = F.max("last").over(earlier)
    between = (
        ranges.select(TOPIC, PARTITION, "first", "last")
        .withColumn("before", before)
        .where(F.col("first") > F.col("before") + 1)
        .select(
            TOPIC, PARTITION, F.struct((F.col("before") + 1).alias("first"), (F.col("first") - 1).alias("last")).alias("gap")
        )
    )
    return within.unionByName(between).select(
        TOPIC,
        PARTITION,
        F.col("gap.first").alias("first_missing"),
        F.col("gap.last").alias("last_missing"),
        (F.col("gap.last") - F.col("gap.first") + 1).alias("missing"),
    )


def offset_summary(positions: DataFrame, size: int = _RANGE) -> DataFrame:
    """Per topic and partition: first and last offset, offsets seen, rows that repeat one, and offsets missing."""
    return (
        offset_ranges(positions, size)
        .groupBy(TOPIC, PARTITION)
        .agg(
            F.min("first").alias("first_offset"),
            F.max("last").alias("last_offset"),
            F.sum("offsets").alias("offsets"),
            F.sum(F.col("rows") - F.col("offsets")).alias("repeated"),
            (F.max("last") - F.min("first") + 1 - F.sum("offsets")).alias("missing"),
        )
    )


# -- records ----------------------------------------------------------------------------------

# What became of a record. The first three are as they should be.
CHANGE, DELETED, TOMBSTONE = "change", "delete", "tombstone"
NOT_JSON, NO_OP, UNKNOWN_OP, NO_IMAGE, MISFIT = "not_json", "no_op", "unknown_op", "missing_image", "misfit"
READABLE = (CHANGE, DELETED, TOMBSTONE)


def outcomes(records: DataFrame, spec: TableSpec, encoding: str = codec.CONNECT) -> DataFrame:
    """Position, ``outcome``, ``fields`` and text of every record, as the parser of ``spec`` sees it.

    ``not_json``: text that is no JSON object. ``no_op``, ``unknown_op``: an object without an operation, or with one
    that is not known. ``missing_image``: the image that the operation speaks of is missing. ``misfit``: a value of
    the image does not fit its column; ``fields`` names them, and the parser keeps the row with nulls there.
    """
    # Each step is exploded out of a one-element array, so that it runs once a record: a filter on the outcome would
    # be pushed below plain projections, and every mention of a parsed field there would parse the text again.
    once = lambda column: F.explode(F.array(column))
    texts = records.select(
        F.col("topic").alias(TOPIC),
        F.col("partition").alias(PARTITION),
        F.col("offset").alias(OFFSET),
        once(F.col("value").cast("string")).alias("text"),
    )
    event = F.from_json("text", envelope_schema(spec.schema, encoding=encoding))
    raw = F.from_json("text", "struct<before:map<string,variant>,after:map<string,variant>>")
    parsed = texts.select("*", once(F.struct(event.alias("event"), raw.alias("raw"))).alias("_parsed"))
    op = F.col("_parsed.event.op")
    deleted = op == DELETE
    image = F.when(deleted, F.col("_parsed.event.before")).otherwise(F.col("_parsed.event.after"))
    given = F.when(deleted, F.col("_parsed.raw.before")).otherwise(F.col("_parsed.raw.after"))
    images = parsed.select(
        TOPIC, PARTITION, OFFSET, "text", once(F.struct(op.alias("op"), image.alias("image"), given.alias("given"))).alias("_r")
    ).select(TOPIC, PARTITION, OFFSET, "text", "_r.*")
    found = images.select("*", once(_misfits(spec, encoding)).alias("misfits"))
    op = F.col("op")
    outcome = (
        F.when(F.col("text").isNull(), TOMBSTONE)
        .when(op.isNull() & ~_is_object(F.try_parse_json("text")), NOT_JSON)
        .when(op.isNull(), NO_OP)
        .when(~op.isin(*UPSERTS, DELETE), UNKNOWN_OP)
        .when(F.col("given").isNull(), NO_IMAGE)
        .when(F.size("misfits") > 0, MISFIT)
        .when(op == DELETE, DELETED)
        .otherwise(CHANGE)
    )
    fields = F.when(F.size("misfits") > 0, F.array_join("misfits", ","))
    return found.select(
        TOPIC, PARTITION, OFFSET, once(outcome).alias("outcome"), fields.alias("fields"), "text"
    )


def _is_object(json: Column) -> Column:
    return F.coalesce(F.schema_of_variant(json).startswith("OBJECT"), F.lit(False))


def _misfits(spec: TableSpec, encoding: str) -> Column:
    """Names of columns that the image gives a value for and the decoded row has none."""
    names = []
    for field in spec.schema:
        given = F.col("given").getItem(field.name)
        told = given.isNotNull() & ~F.is_variant_null(given)
        decoded = codec.decode(F.col("image").getField(field.name), field.dataType, encoding)
        names.append(F.when(told & decoded.isNull(), F.lit(field.name)))
    return F.coalesce(F.array_compact(F.array(*names)), F.array().cast("array<string>"))


def quarantine(records: DataFrame, spec: TableSpec, encoding: str = codec.CONNECT) -> DataFrame:
    """The records that are not as they should be, with position, reason, columns that do not fit, and text."""
    found = outcomes(records, spec, encoding).where(~F.col("outcome").isin(*READABLE))
    return found.withColumnRenamed("outcome", "reason")


# -- unknown fields ---------------------------------------------------------------------------


def drift_report(changes: DataFrame) -> DataFrame:
    """Fields that the table schema does not know, by JSON type: rows, first and last offset, and the one type that
    fits all values of the field. Changes without unknown fields add nothing; a JSON null has the type ``VOID``."""
    unknown = F.from_json(F.col(EXTRAS), T.MapType(T.StringType(), T.VariantType()))
    fields = changes.where(F.col(EXTRAS).isNotNull()).select(OFFSET, F.explode(unknown).alias("field", "value"))
    typed = fields.select("field", "value", F.schema_of_variant("value").alias("type"), OFFSET)
    # Some rows for each pair of field and type: what is joined is as small as the schema.
    by_type = typed.groupBy("field", "type").agg(
        F.count(F.lit(1)).alias("rows"), F.min(OFFSET).alias("first_offset"), F.max(OFFSET).alias("last_offset")
    )
    merged = typed.groupBy("field").agg(F.schema_of_variant_agg("value").alias("merged_type"))
    return by_type.join(merged, "field").select("field", "type", "merged_type", "rows", "first_offset", "last_offset")


def new_fields(report: DataFrame, known: Iterable[str]) -> DataFrame:
    """The lines of a drift report about fields that are not among ``known`` ones."""
    return report.where(~F.col("field").isin(*known))
