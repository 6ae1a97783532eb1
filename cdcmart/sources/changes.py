"""Scans of a change log: Kafka topics, or files holding records of the same shape."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from cdcmart.functions.envelope import RECORD_SCHEMA
from cdcmart.operators.replay import EARLIEST

FILE_FORMATS = ("parquet", "json", "orc")


def topic_name(prefix: str, schema: str, table: str) -> str:
    """Topic of one source table."""
    return f"{prefix}.{schema}.{table}"


def kafka_options(
    bootstrap: str,
    topic: str,
    starting_offsets: str = EARLIEST,
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source; the last two bound a batch and split large partitions."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def _load(reader, fmt: str, options: Mapping[str, str]) -> DataFrame:
    options = dict(options)
    if fmt == "kafka":
        return reader.format("kafka").options(**options).load()
    if fmt not in FILE_FORMATS:
        raise ValueError(f"format must be kafka or one of {', '.join(FILE_FORMATS)}, got {fmt!r}")
    path = options.pop("path")
    return reader.format(fmt).schema(RECORD_SCHEMA).options(**options).load(path)


def change_stream(spark: SparkSession, fmt: str, options: Mapping[str, str]) -> DataFrame:
    """Streaming scan with columns key, value, topic, partition, offset, timestamp."""
    return _load(spark.readStream, fmt, options)


def change_batch(spark: SparkSession, fmt: str, options: Mapping[str, str]) -> DataFrame:
    """The same scan as a batch, for replays and repairs."""
    return _load(spark.read, fmt, options)
