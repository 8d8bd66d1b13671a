"""Sinks: numbered batches, reports, merged catalogues. Publishing and appending are in versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.operators.batching import assign_batches


def write_batches(df: DataFrame, size: int, path: str, order: list[str]) -> None:
    """Writes JSON Lines below path/batch_id=n, `size` records a batch, in the given order; the count is a column of
    the folder's name. Null fields are left out."""
    numbered = assign_batches(df, size, order).drop("rank")
    counts = numbered.groupBy("batch_id").agg(F.count("*").alias("batch_count"))
    joined = numbered.join(counts, "batch_id").repartition("batch_id").sortWithinPartitions("batch_id", *order)
    joined.write.partitionBy("batch_id", "batch_count").json(path)


def write_report(tables: dict[str, DataFrame], path: str, one_file: int = 100_000) -> None:
    """One folder of JSON for each result table; in one file if it has no more than so many rows."""
    for name, df in tables.items():
        few = df.limit(one_file + 1).count() <= one_file
        (df.coalesce(1) if few else df).write.mode("overwrite").json(f"{path}/{name}")


def reorder_link_columns(df: DataFrame) -> DataFrame:
    """url, id, name first and the rest sorted, if all three are there; else as it is."""
    first = ["url", "id", "name"]
    if not set(first) <= set(df.columns):
        return df
    return df.select(*first, *sorted(c for c in df.columns if c not in first))


def merge_catalogs(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of both, one per key; existing rows win. Rows without a key are kept."""
    both = existing.unionByName(new.join(existing.filter(F.col(key).isNotNull()).select(key), key, "left_anti"), allowMissingColumns=True)
    keyed = both.filter(F.col(key).isNotNull()).dropDuplicates([key])
    return keyed.unionByName(both.filter(F.col(key).isNull()))
