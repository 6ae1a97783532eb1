"""Append-only history: every change event, one row each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.operators.upsert import apply_defaults
from cdcmart.specs import OFFSET, PARTITION, TOPIC, TableSpec


def event_id() -> Column:
    """Id of an event: a hash of its log position."""
    return F.xxhash64(TOPIC, PARTITION, OFFSET)


def not_in(changes: DataFrame, stored: DataFrame) -> DataFrame:
    """The changes whose events ``stored`` history does not hold.

    Only the stored rows between the smallest and the largest offset of the changes are looked at. A batch covers a
    stretch of offsets, so the files of other stretches are passed by; both bounds come from one aggregate.
    """
    ends = changes.agg(F.min(OFFSET).alias("low"), F.max(OFFSET).alias("high")).first()
    if ends["low"] is None:
        return changes
    near = stored.where(F.col(OFFSET).between(ends["low"], ends["high"])).select("history_id")
    told = changes.withColumn("history_id", event_id())
    return told.join(near, "history_id", "left_anti").drop("history_id")


def entries(
    changes: DataFrame,
    spec: TableSpec,
    as_of: dt.date | None = None,
    recorded_at: dt.datetime | None = None,
) -> DataFrame:
    """History rows of a batch; the id depends on the log position only, so a replay repeats it."""
    captured = F.lit(recorded_at) if recorded_at else F.current_timestamp()
    rows = apply_defaults(changes, spec, as_of)
    return rows.select(
        event_id().alias("history_id"),
        *[c for c in spec.columns if c in rows.columns],
        captured.alias("recorded_at"),
        TOPIC,
        PARTITION,
    )


def distinct_events(history: DataFrame) -> DataFrame:
    """One row per log position, the first capture of it, when a feed was read more than once."""
    position = [TOPIC, PARTITION, OFFSET]
    rest = [c for c in history.columns if c not in position]
    return (
        history.groupBy(*position)
        .agg(F.min_by(F.struct(*rest), "recorded_at").alias("_row"))
        .select(*[F.col(c) if c in position else F.col("_row").getField(c).alias(c)
                  for c in history.columns])
    )
