"""Joins that stay balanced when a few keys hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is heavy from 1/1000 of the rows on, so there are at most 1000 of them; the sketch that
# looks for them tracks ten times as many.
_SHARE = 1000
_TRACKED = 10000


def heavy_keys(rows: DataFrame, key: str) -> list:
    """Keys holding about 1/1000 of the rows or more, never over 1000 of them.

    One column-pruned pass that merges fixed-size sketches. Runs at once and brings the keys to
    the driver: both sides of a join must use the very same list.
    """
    sketch = F.call_function("approx_top_k", F.col(key), F.lit(_SHARE), F.lit(_TRACKED))
    top = rows.where(F.col(key).isNotNull()).agg(
        sketch.alias("top"), F.count(F.lit(1)).alias("n")
    )
    heavy = F.filter("top", lambda t: t["count"] * _SHARE >= F.col("n"))
    found = top.select(F.transform(heavy, lambda t: t["item"]).alias("keys")).first()
    return list(found["keys"] or [])


def salted_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", salt: int | None = None
) -> DataFrame:
    """Equi-join of a large left side with a right side that holds each key at most once.

    Without ``salt`` this is a plain join: Spark broadcasts the right side if its size allows and
    AQE splits skewed partitions. With ``salt`` the heavy keys of the left side are spread over
    that many sub-keys and only the matching right rows are repeated. Which keys count as heavy
    never changes the result. Null keys of a left join are spread too.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}")
    if not salt:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(heavy_keys(left, key)), F.lit(False))
    # A hash of the row, not a random number: a task that runs again must repeat its choice.
    hashable = [f.name for f in left.schema
                if f.name != key and f.dataType.typeName() not in ("map", "variant")]
    spread = F.pmod(F.xxhash64(*hashable), F.lit(salt)).cast("int")
    salted = left.withColumn(
        "_salt", F.when(is_hot | F.col(key).isNull(), spread).otherwise(F.lit(0))
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salt - 1))).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn("_salt", F.explode(copies))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
