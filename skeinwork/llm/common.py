"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.sources.storage import materialise, shared_dir, table

__all__ = ["bound_batches", "fresh", "hot_join", "materialise", "row_key", "shared_dir", "table"]

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Whole texts go to the Python workers in Arrow batches of 2 MB, unless the session has a setting of its own."""
    if spark.conf.get(_BATCH, "67108864b") in ("67108864b", "64m", "67108864"):
        spark.conf.set(_BATCH, "2m")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that df does not have (compared as Spark does, without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        own = f"_{name}"
        while own.lower() in taken:
            own = f"_{own}"
        taken.add(own.lower())
        out.append(own)
    return out


def row_key(df: DataFrame) -> Column:
    """A digest of 128 bits of a whole row, as text; equal rows have equal digests. Where the nulls are counts."""
    columns = [x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.concat(F.hex(F.xxhash64(*columns)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *columns)))


#: A key is frequent if it has more than a thousand rows and more than this share of all; so there are 20,000 at most.
HOT_SHARE = 1 / 20_000


def hot_join(left: DataFrame, right: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """left joined to right, which has a row a key and in `count` the rows that left (of `total` rows) has of it.

    Rows of frequent keys stay where they are: their few rows of right are broadcast. The others meet by a shuffle,
    which no key can then fill a task of.
    """
    frequent = F.col(count) > max(1000.0, total * HOT_SHARE)
    hot = F.broadcast(right.filter(frequent))
    rest = left.join(hot.select(key), key, "left_anti").join(right.filter(~frequent), key)
    return left.join(hot, key).unionByName(rest)
