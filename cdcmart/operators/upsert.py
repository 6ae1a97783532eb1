"""Keyed upserts: defaults, latest row per key, merge, status denormalisation and sync."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdcmart.operators.skew import salted_join
from cdcmart.specs import ORDER_ITEMS, TODAY, TableSpec

# The order of items that have none.
NO_ORDER = ORDER_ITEMS.defaults["order_id"]

LAST_BATCH = "last_batch"
NEWEST = "newest"


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def has_key(spec: TableSpec) -> Column:
    """True where every key column is set."""
    return _all(F.col(k).isNotNull() for k in spec.key)


def apply_defaults(rows: DataFrame, spec: TableSpec, as_of: dt.date | None = None) -> DataFrame:
    """Fill nulls by the table's defaults; ``as_of`` fixes the date that stands in for today."""
    today = F.lit(as_of) if as_of else F.current_date()
    types = {f.name: f.dataType for f in spec.mart_schema}
    filled = {}
    for name, default in spec.defaults.items():
        if name in rows.columns:
            value = today if default is TODAY else F.lit(default)
            filled[name] = F.coalesce(F.col(name), value.cast(types[name]))
    return rows.withColumns(filled) if filled else rows


def latest_by_key(rows: DataFrame, key: Iterable[str], order_by: Iterable[str]) -> DataFrame:
    """The row with the largest ``order_by`` per key; nulls order last, null keys are left out.

    An aggregate, so a hot key shrinks to one row per input partition before the shuffle.
    """
    key = list(key)
    rest = [c for c in rows.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*order_by))
    return (
        rows.where(_all(F.col(k).isNotNull() for k in key))
        .groupBy(*key)
        .agg(best.alias("_row"))
        .select(*[F.col(c) if c in key else F.col("_row").getField(c).alias(c) for c in rows.columns])
    )


# Beyond the largest and below the smallest instant, in microseconds, and the range of an offset.
_NO_TIME = -(10**18) + 1
_OFFSETS = 2**64


def _place(time: str, offset: str) -> Column:
    """A time and a log position as one number; nulls come first."""
    instant = F.coalesce(F.unix_micros(time), F.lit(_NO_TIME)).cast("decimal(18,0)")
    return instant * F.lit(str(_OFFSETS)).cast("decimal(20,0)") + F.coalesce(F.col(offset), F.lit(-(2**63))).cast("decimal(20,0)")


def latest_by_key_late(rows: DataFrame, key: Iterable[str], time: str, offset: str) -> DataFrame:
    """Same result as :func:`latest_by_key` by a timestamp, then a log position, for rows that are wide and can be read
    twice, as those of a cached batch.

    First only the keys and one number for each row are aggregated, in a hash table; then the rows that hold the
    largest number of their key are fetched by a semi-join. Whole rows are sorted and shuffled only where they won, or
    where there are too many keys to broadcast.
    """
    key = list(key)
    placed = rows.where(_all(F.col(k).isNotNull() for k in key)).withColumn("_place", _place(time, offset))
    best = placed.groupBy(*key).agg(F.max("_place").alias("_place"))
    winners = placed.join(best, [*key, "_place"], "left_semi").drop("_place")
    # Rows that agree in key, time and position are one event read more than once.
    return winners.repartition(*key).dropDuplicates(key)


def latest_by_key_window(rows: DataFrame, key: Iterable[str], order_by: Iterable[str]) -> DataFrame:
    """Same result as :func:`latest_by_key`, as row number 1 of a window."""
    key = list(key)
    order = Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order_by])
    return (
        rows.where(_all(F.col(k).isNotNull() for k in key))
        .withColumn("_rn", F.row_number().over(order))
        .where("_rn = 1")
        .drop("_rn")
    )


def drop_duplicate_keys(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per key; the survivor is the newest, not an arbitrary one."""
    return latest_by_key(rows, spec.key, spec.order_by)


def latest_and_counts(rows: DataFrame, spec: TableSpec, counts: Mapping[str, Column]) -> DataFrame:
    """:func:`drop_duplicate_keys` that also counts, for each key, the rows of each condition; rows without a whole key
    are kept as one row per key as well, so that none goes uncounted. For rows that are read only once."""
    key = list(spec.key)
    rest = [c for c in rows.columns if c not in key]
    best = F.max_by(F.struct(*rest), F.struct(*spec.order_by))
    totals = [F.count_if(condition).alias(name) for name, condition in counts.items()]
    picked = [F.col(c) if c in key else F.col("_row").getField(c).alias(c) for c in rows.columns]
    return rows.groupBy(*key).agg(best.alias("_row"), *totals).select(*picked, *counts)


def merge_upsert(
    target: DataFrame,
    changes: DataFrame,
    spec: TableSpec,
    on_conflict: str = LAST_BATCH,
    columns: Iterable[str] | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Fold one batch of changes into the current state.

    Matched keys take the incoming row (``last_batch``) or the row with the larger order columns
    (``newest``); an incoming null does overwrite. Insert-only columns keep their first value.
    ``columns`` limits what an update may touch; an insert leaves the others null.
    """
    needed = [c for c in changes.columns if c in target.columns or c in spec.order_by]
    latest = drop_duplicate_keys(changes.select(*needed), spec)
    return merge_latest(target, apply_defaults(latest, spec, as_of), spec, on_conflict, columns)


def merge_latest(
    target: DataFrame,
    latest: DataFrame,
    spec: TableSpec,
    on_conflict: str = LAST_BATCH,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """:func:`merge_upsert` for changes that already hold one row per key, defaults applied.

    Rows of the target without a change pass as they are, so a filter on the result reaches their
    scan. Only the changed keys are looked up in the target, with the columns that can survive there;
    where the changes are small Spark broadcasts them and leaves the target unshuffled.
    """
    key = list(spec.key)
    covered = set(columns if columns is not None else target.columns) & set(latest.columns)
    unchanged = target.join(latest.select(*key), key, "left_anti").select(*target.columns)

    survivors = [c for c in target.columns if c not in key and (c not in covered or c in spec.insert_only)]
    if on_conflict != LAST_BATCH:
        survivors = [c for c in target.columns if c not in key]
    old = (
        target.select(*key, *survivors)
        .join(latest.select(*key), key, "left_semi")
        .withColumn("_old", F.lit(True))
        .alias("t")
    )
    joined = latest.alias("s").join(old, key, "left")
    known = F.col("_old").isNotNull()
    take_new = ~known | _wins(spec, on_conflict)
    changed = []
    for name in target.columns:
        if name in key:
            changed.append(F.col(name))
        elif name not in covered:
            changed.append(F.col(f"t.{name}"))
        elif name in spec.insert_only:
            changed.append(F.when(known, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}")).alias(name))
        elif on_conflict == LAST_BATCH:
            changed.append(F.col(f"s.{name}"))
        else:
            changed.append(F.when(take_new, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
    return unchanged.unionByName(joined.select(*changed))


def _wins(spec: TableSpec, on_conflict: str) -> Column:
    if on_conflict == LAST_BATCH:
        return F.lit(True)
    if on_conflict == NEWEST:
        # Struct comparison orders nulls first, so a row without a timestamp never beats one with it.
        return F.struct(*[F.col(f"s.{c}") for c in spec.order_by]) >= F.struct(
            *[F.col(f"t.{c}") for c in spec.order_by]
        )
    raise ValueError(f"on_conflict must be {LAST_BATCH!r} or {NEWEST!r}, got {on_conflict!r}")


def fold_batches(
    batches: DataFrame, spec: TableSpec, version: str, on_conflict: str = LAST_BATCH
) -> DataFrame:
    """Fold many committed batches, each with one row per key, into one row per key.

    Equals applying :func:`merge_latest` batch by batch, in a single pass. No batch repeats a key, so an aggregate before
    the shuffle would sort all rows and merge none. A window lets the reader's columns alone be read and shuffled.
    """
    key = list(spec.key)
    rest = [c for c in batches.columns if c not in (*key, version)]
    order = [version] if on_conflict == LAST_BATCH else [*spec.order_by, version]
    first = [c for c in spec.insert_only if c in rest]
    same = Window.partitionBy(*key)
    firsts = {f"_first_{c}": F.min_by(F.struct(c), F.col(version)).over(same) for c in first}
    newest = same.orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ranked = (
        batches.repartition(*key)
        .withColumns({**firsts, "_rn": F.row_number().over(newest)})
        .where("_rn = 1")
    )
    picked = [F.col(f"_first_{c}").getField(c).alias(c) if c in first else F.col(c) for c in rest]
    return ranked.select(*key, *picked)


def soft_delete(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Mark rows of delete events inactive instead of dropping them."""
    flag = spec.soft_delete_flag
    if flag is None:
        raise ValueError(f"{spec.name} has no active flag")
    return events.withColumn(flag, F.when(F.col("op") == "d", F.lit(False)).otherwise(F.col(flag)))


def denormalize(
    items: DataFrame,
    orders: DataFrame,
    on: str = "order_id",
    value: str = "status",
    into: str = "order_status",
    default: str = "unknown",
    salt: int | None = None,
    no_key: object = NO_ORDER,
) -> DataFrame:
    """Copy the order's status onto each item; items without a known order get the default.

    ``no_key`` is the default of the key, see :func:`_with_status`.
    """
    joined = _with_status(items, orders, on, value, salt, no_key)
    return joined.withColumn(into, F.coalesce("_status", F.lit(default))).drop("_status")


def _with_status(
    items: DataFrame, orders: DataFrame, on: str, value: str, salt: int | None, no_key: object
) -> DataFrame:
    """Add the status of its order, or null, to each item.

    A null key matches nothing and the key's default at most one order, and both may be frequent: such items go
    round the join. The status of that one order, where there is one, is looked up once.
    """
    lookup = orders.select(on, F.col(value).alias("_status"))
    able = F.col(on).isNotNull() & (F.col(on) != F.lit(no_key))
    joined = salted_join(items.where(able), lookup, on, "left", salt)
    only = lookup.where(F.col(on) == F.lit(no_key)).agg(F.max("_status")).scalar()
    rest = items.where(F.col(on).isNull() | (F.col(on) == F.lit(no_key)))
    return joined.unionByName(rest.withColumn("_status", F.when(F.col(on).isNotNull(), only)))


def sync_from(
    items: DataFrame,
    orders: DataFrame,
    on: str = "order_id",
    value: str = "status",
    into: str = "order_status",
    salt: int | None = None,
    no_key: object = NO_ORDER,
) -> DataFrame:
    """Refresh the copied status where it differs; items without an order keep theirs."""
    joined = _with_status(items, orders, on, value, salt, no_key)
    fresh = F.when(F.col(into) != F.col("_status"), F.col("_status")).otherwise(F.col(into))
    return joined.withColumn(into, fresh).select(*items.columns)


def carry_over(
    changes: DataFrame, target: DataFrame, spec: TableSpec, columns: Iterable[str]
) -> DataFrame:
    """Fill columns a partial source does not deliver from the current state, by key.

    Reads only the key and those columns of the target, and yields only the changed rows.
    """
    names = list(columns)
    if not names:
        return changes
    kept = target.select(*spec.key, *names)
    return changes.drop(*names).join(kept, list(spec.key), "left")
