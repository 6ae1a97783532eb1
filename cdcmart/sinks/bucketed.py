"""Tables bucketed by a join key in the session catalog: two of the same width join without an exchange.

A bucket is read by one task, so keys that would fill one are kept out of the buckets: null keys and the key's default,
which find no partner or one at most, and heavy keys, found by a sketch when the table is written. They stand in a
second table of plain files beside the first, and are joined for themselves: what they can meet on the other
side are a few rows, which a semi-join picks out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcmart.operators.skew import heavy_keys
from cdcmart.sinks import files

# Bytes of a bucket, of which a task reads one at a time.
_BUCKET_BYTES = 256 * 1024**2

# Rows of a bucket, which a task sorts to write it and again to join it.
_BUCKET_ROWS = 500_000


def width(input_bytes: int) -> int:
    """Buckets for a table of that size; both sides of a join take the number of the larger one."""
    return max(8, -(-input_bytes // _BUCKET_BYTES))


def width_for(rows: DataFrame, bucket_rows: int = _BUCKET_ROWS) -> int:
    """Buckets for these rows, which are counted. What a task holds follows from rows, whatever the bytes they are
    compressed to."""
    return max(8, -(-rows.count() // bucket_rows))


class BucketedTable:
    """Rows in buckets of ``key``, and loose rows, as the catalog tables ``<name>`` and ``<name>_loose``."""

    def __init__(self, spark: SparkSession, name: str, key: str):
        self.spark, self.name, self.key = spark, name, key

    def write(self, rows: DataFrame, buckets: int, path: str, default: object = None, unique: bool = False) -> None:
        """Replace the table by ``rows``, below ``path``.

        ``default`` is a value of the key that stands for none. A side that holds each key once at most is ``unique``:
        it has no heavy keys, and no loose rows but those without a key.
        """
        loose = self._loose(rows, default, unique)
        for name, part in ((self.name, rows.where(~loose)), (f"{self.name}_loose", rows.where(loose))):
            self.spark.sql(f"drop table if exists {name}")
            files.remove_folder(self.spark, f"{path}/{name}")
            if name == self.name:
                # One file a bucket: the shuffle deals rows out as the buckets do.
                part = part.repartition(buckets, self.key)
                writer = part.write.bucketBy(buckets, self.key).sortBy(self.key)
            else:
                writer = part.write
            writer.format("parquet").option("path", f"{path}/{name}").saveAsTable(name)

    def _loose(self, rows: DataFrame, default: object, unique: bool) -> Column:
        key = F.col(self.key)
        loose = key.isNull()
        if unique:
            return loose
        if default is not None:
            loose |= key.eqNullSafe(F.lit(default))
        heavy = heavy_keys(rows, self.key)
        return (loose | F.coalesce(key.isin(heavy), F.lit(False))) if heavy else loose

    def rows(self) -> DataFrame:
        """Rows in buckets."""
        return self.spark.table(self.name)

    def loose(self) -> DataFrame:
        """Rows outside the buckets."""
        return self.spark.table(f"{self.name}_loose")

    def drop(self) -> None:
        """Take both tables out of the catalog; their files stay."""
        for name in (self.name, f"{self.name}_loose"):
            self.spark.sql(f"drop table if exists {name}")


def parts(many: BucketedTable, one: BucketedTable) -> Iterable[tuple[DataFrame, DataFrame]]:
    """Pairs of frames whose joins on the key, taken together, are the join of the tables.

    The first pair needs no exchange. The second holds the loose rows and what they can meet: one row at most for each
    heavy key and the default, which is broadcast. A shuffle by the key would bring all rows of a heavy key to one task.
    """
    yield many.rows(), one.rows()
    loose = many.loose()
    keys = loose.select(many.key).where(F.col(many.key).isNotNull()).distinct().withColumnRenamed(many.key, one.key)
    yield loose, F.broadcast(one.rows().join(F.broadcast(keys), one.key, "left_semi"))


def by_parts(
    many: BucketedTable, one: BucketedTable, join: Callable[[DataFrame, DataFrame], DataFrame]
) -> DataFrame:
    """``join`` applied to both pairs of :func:`parts`, the results put together."""
    bucketed, loose = (join(left, right) for left, right in parts(many, one))
    return bucketed.unionByName(loose)
