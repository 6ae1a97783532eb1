"""Handlers for one micro-batch of change records."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcmart.functions import codec
from cdcmart.functions.envelope import parse_changes, parse_events
from cdcmart.operators import audit, history, upsert
from cdcmart.session import coalesced_cache
from cdcmart.sinks import files
from cdcmart.sinks.mart import Mart, version_of
from cdcmart.specs import OFFSET, PARTITION, TOPIC, TableSpec

logger = logging.getLogger(__name__)

BatchHandler = Callable[[DataFrame, int], None]

# Counts of a batch.
_EVENTS = "events"
_WITHOUT_KEY = "without_key"

# Up to so many events the orders that a batch of items names are looked up by a semi-join, which is broadcast then;
# with more of them it would shuffle all orders, as the join that follows does.
_LOOKED_UP = 1_000_000

# Called after a commit with the mart, the table's name and the version committed.
OnCommit = Callable[[Mart, str, int], None]


def parse(
    records: DataFrame, spec: TableSpec, deletes: str = "ignore", encoding: str = codec.CONNECT
) -> DataFrame:
    """Changes of a record scan.

    ``deletes="soft"`` keeps deletes as inactive rows in tables that have an active flag; the other
    tables ignore them in any case.
    """
    if deletes not in ("ignore", "soft"):
        raise ValueError(f"deletes must be 'ignore' or 'soft', got {deletes!r}")
    if deletes == "soft" and spec.soft_delete_flag:
        return upsert.soft_delete(parse_events(records, spec, encoding), spec)
    return parse_changes(records, spec, encoding)


def scd4_batch(
    mart: Mart,
    name: str,
    generation: int = 0,
    on_commit: OnCommit | None = None,
) -> BatchHandler:
    """Handler that keeps current state and history from one batch.

    Events without a key go to a side folder. Any failure ends the query; the restarted batch has
    the same version and overwrites what it wrote before.
    """
    return _handler(mart, name, generation, on_commit)


def order_items_batch(
    mart: Mart,
    name: str = "fact_order_items",
    generation: int = 0,
    on_commit: OnCommit | None = None,
    orders: str = "fact_orders",
) -> BatchHandler:
    """Handler for order items: newest row per key, order status copied from the orders table.

    The copy is refreshed whenever the table is read, and stored anew by ``repair.sync_status``.
    """
    return _handler(mart, name, generation, on_commit, orders)


def _handler(mart, name, generation, on_commit, orders=None) -> BatchHandler:
    def handle(batch: DataFrame, batch_id: int) -> None:
        table = mart.table(name)
        spec = table.spec
        version = version_of(generation, batch_id)
        # One processing time for both outputs, so that defaults agree.
        now = dt.datetime.now(dt.timezone.utc)
        stored = [c for c in spec.columns if c in batch.columns]
        conditions = {_EVENTS: F.lit(True), _WITHOUT_KEY: ~upsert.has_key(spec)}
        conditions |= {
            f"{c}_too_long": F.length(c) > size for c, size in spec.max_lengths.items() if c in batch.columns
        }
        if spec.history:
            kept = batch
            measures = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
        else:
            # All that is needed of such a batch are its newest rows, so it is parsed into those and never held whole.
            kept = upsert.latest_and_counts(batch.select(*stored), spec, conditions)
            measures = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in conditions]
        if orders:
            measures += [F.min("order_id").alias("low"), F.max("order_id").alias("high")]
        try:
            with coalesced_cache(batch.sparkSession):
                kept = kept.persist()
                # Fills the cache, so later plans know the batch's size.
                counts = kept.agg(*measures).first()
            keyed = kept.where(upsert.has_key(spec))
            if counts[_EVENTS] > counts[_WITHOUT_KEY]:
                latest, as_of = keyed.select(*stored), None
                if spec.history:
                    latest = upsert.drop_duplicate_keys(latest, spec)
                if orders:
                    bounds = (counts["low"], counts["high"]) if counts["low"] is not None else None
                    wanted = None
                    if counts[_EVENTS] <= _LOOKED_UP:
                        wanted = keyed.select("order_id").where("order_id is not null")
                    # With the first items of a table the status of all of them is that of one version of the orders.
                    inside = not {spec.name, mart.table(orders).spec.name} & set(mart.outside)
                    as_of = mart.table(orders).latest_version() if inside and not table.exists() else None
                    known = mart.current(orders, wanted, bounds, as_of)
                    latest = upsert.denormalize(latest, known)
                mart.commit(spec.name, upsert.apply_defaults(latest, spec, now.date()), version)
                if as_of is not None and as_of >= 0:
                    table.mark_synced(orders, as_of)
                if spec.history:
                    events = keyed
                    if generation:
                        # A replay reads events again: those that other batches have written are left out.
                        others = table.read_history().where(F.col("batch_id") != version)
                        events = history.not_in(keyed, others)
                    table.append_history(events, version, now)
            if counts[_WITHOUT_KEY]:
                # Rare, so a batch that was not held whole is parsed once more for them.
                table.append_rejected((kept if spec.history else batch).where(~upsert.has_key(spec)), version)
            logger.info("%s batch %s: %s", name, batch_id, counts.asDict())
            for column, size in spec.max_lengths.items():
                if broken := counts.asDict().get(f"{column}_too_long"):
                    logger.warning("%s batch %s: %s values of %s exceed %s", name, batch_id, broken, column, size)
        finally:
            kept.unpersist()
        if on_commit:
            on_commit(mart, spec.name, version)

    return handle


# -- audited streams --------------------------------------------------------------------------


def audited(
    mart: Mart, name: str, handler: BatchHandler, generation: int = 0, deletes: str = "ignore", encoding: str = codec.CONNECT
) -> BatchHandler:
    """Handler of raw records: notes the offsets of the batch and the records that cannot be read, then hands what the
    parser makes of it to ``handler``. Both notes overwrite those of an earlier run of the batch."""

    def handle(records: DataFrame, batch_id: int) -> None:
        table = mart.table(name)
        version = version_of(generation, batch_id)
        records = records.persist()
        try:
            positions = records.select(
                F.col("topic").alias(TOPIC), F.col("partition").alias(PARTITION), F.col("offset").alias(OFFSET)
            )
            audit.offset_ranges(positions).write.mode("overwrite").parquet(f"{table.path}/offsets/batch_id={version}")
            unread = audit.quarantine(records, table.spec, encoding)
            unread.write.mode("overwrite").parquet(f"{table.path}/quarantine/batch_id={version}")
            handler(parse(records, table.spec, deletes, encoding), batch_id)
        finally:
            records.unpersist()

    return handle


def _noted(mart: Mart, name: str, kind: str, generation: int | None) -> DataFrame | None:
    """Notes of the batches of a generation, by default the present one; None without any."""
    table = mart.table(name)
    number = table.generation() if generation is None else generation
    base = f"{table.path}/{kind}"
    done = [
        f"{base}/{folder}"
        for folder in files.subfolders(mart.spark, base)
        if version_of(number, -1) <= int(folder.split("=")[1]) < version_of(number + 1, -1)
        and files.exists(mart.spark, f"{base}/{folder}/_SUCCESS")
    ]
    return mart.spark.read.option("basePath", base).parquet(*done) if done else None


def lost_offsets(mart: Mart, name: str, generation: int | None = None) -> DataFrame | None:
    """Stretches of offsets that an audited stream has never been given; None before its first batch."""
    ranges = _noted(mart, name, "offsets", generation)
    return None if ranges is None else audit.gaps_of(ranges)


def unreadable(mart: Mart, name: str, generation: int | None = None) -> DataFrame | None:
    """Records that an audited stream could not read as they should be, with the batch; None before its first batch."""
    return _noted(mart, name, "quarantine", generation)
