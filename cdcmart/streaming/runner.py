"""Starting, watching and stopping the mart's streams."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cdcmart.functions import codec
from cdcmart.sinks import files
from cdcmart.sinks.mart import Mart
from cdcmart.streaming import batches

logger = logging.getLogger(__name__)

# Default trigger interval of every stream.
TRIGGER = "10 seconds"


def start_mart_stream(
    mart: Mart,
    name: str,
    records: DataFrame,
    trigger: str | None = TRIGGER,
    deletes: str = "ignore",
    encoding: str = codec.CONNECT,
    on_commit: batches.OnCommit | None = None,
    audit: bool = False,
) -> StreamingQuery:
    """Start the stream that keeps one mart table current.

    ``trigger=None`` processes what is there and stops. The checkpoint belongs to the table's
    generation, so a stream started after a replay request reads the log from its start position.
    Folds, vacuum and reports are jobs of their own. ``audit`` keeps the offsets of every batch and the records
    that cannot be read (``batches.lost_offsets``, ``batches.unreadable``).
    """
    table = mart.table(name)
    table.settle(on_conflict=table.on_conflict, deletes=deletes, encoding=encoding)
    kind = batches.order_items_batch if "order_status" in table.spec.derived else batches.scd4_batch
    handler = kind(
        mart,
        table.spec.name,
        generation=table.generation(),
        on_commit=on_commit,
    )
    if audit:
        handler = batches.audited(mart, name, handler, table.generation(), deletes, encoding)
        changes = records
    else:
        changes = batches.parse(records, table.spec, deletes, encoding)
    writer = (
        changes.writeStream.queryName(f"{table.spec.source}_stream")
        .option("checkpointLocation", mart.checkpoint(name))
        .foreachBatch(handler)
    )
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def run_all(
    mart: Mart,
    records: Mapping[str, DataFrame],
    **options,
) -> None:
    """Run one stream per table until any of them ends, then stop all; a failure is raised."""
    mart.validate()
    mart.spark.streams.resetTerminated()
    queries: list[StreamingQuery] = []
    try:
        for name, scan in records.items():
            queries.append(start_mart_stream(mart, name, scan, **options))
        mart.spark.streams.awaitAnyTermination()
    finally:
        stop_all(queries)


def stop_all(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        try:
            query.stop()
        except Exception as error:  # one stubborn query must not keep the others running
            logger.warning("stopping %s failed: %s", query.name, error)


def progress(query: StreamingQuery) -> dict:
    """Where a query stands: last batch, its rows and the offsets it reached."""
    last = query.lastProgress
    return {
        "name": query.name,
        "active": query.isActive,
        "batch_id": last.batchId if last else None,
        "rows": last.numInputRows if last else 0,
        "offsets": [s.endOffset for s in last.sources] if last else [],
    }


def checkpoint_status(spark: SparkSession, path: str) -> dict:
    """Whether a checkpoint exists and how many batches it has committed."""
    started = files.exists(spark, f"{path}/metadata")
    committed = None
    if started and files.exists(spark, f"{path}/commits"):
        committed = spark.read.text(f"{path}/commits").select("_metadata.file_path").distinct().count()
    return {"path": path, "exists": started, "committed_batches": committed}
