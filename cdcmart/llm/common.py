"""Helpers the operators share: their code on the executors, column names, written intermediates."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cdcmart.session import scratch_dir
from cdcmart.sinks import files


_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


# Rows that Spark hands to a Python worker at once: texts are thousands of bytes, so its default is too many.
_ROWS_AT_ONCE = "1000"


def ship_package(spark: SparkSession) -> None:
    """Let Spark serve this package to its Python workers, once per application, in batches they can hold.

    The archive is the driver's own; executors fetch it from the driver as they do any ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _ROWS_AT_ONCE)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp()) / f"{_PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(_PACKAGE.rglob("*.py")):
            z.write(source, source.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def in_slices(
    batches: Iterable[pa.RecordBatch], column: str | int, limit: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose texts or lists in ``column`` are about ``limit`` bytes; a row that is
    larger is a slice of its own. What Arrow keeps for later is given back at the end."""
    for batch in batches:
        at = batch.schema.get_field_index(column) if isinstance(column, str) else column
        values = batch.column(at)
        if pa.types.is_list(values.type):
            sizes = 4 * np.diff(values.offsets.to_numpy())
        else:
            sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
    pa.default_memory_pool().release_unused()


def map_arrow(
    rows: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``rows.mapInArrow(step, schema)`` for columns of any name: Spark's own fails at a dot."""
    inner = T.StructType([T.StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema)])
    names = rows.columns

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in step(pa.RecordBatch.from_arrays(b.columns, names) for b in batches):
            yield pa.RecordBatch.from_arrays(batch.columns, inner.names)

    plain = rows.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(renamed, inner).toDF(*schema.names)


def quoted(names: Iterable[str]) -> list[str]:
    """Column names as they are, whatever signs they hold."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or that with underscores, so that no column of ``df`` is hidden by it."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


_folders: dict[str, list[str]] = {}


def run_folder(spark: SparkSession, label: str) -> str:
    """A new folder for the tables one run writes, below the shared checkpoint folder. The results of the run are read
    from there, so it stays until :func:`clean_up`."""
    folder = scratch_dir(spark, label)
    _folders.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def clean_up(spark: SparkSession) -> list[str]:
    """Remove the tables that this application's runs have written, once their results have been read or stored
    elsewhere; returns the folders."""
    done = _folders.pop(spark.sparkContext.applicationId, [])
    for folder in done:
        files.remove_folder(spark, folder)
    return done


def saved(df: DataFrame, folder: str, name: str | None = None) -> DataFrame:
    """Write ``df`` below ``folder`` and read it back: its lineage ends in a table all executors reach."""
    path = f"{folder}/{name or uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
