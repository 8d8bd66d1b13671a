"""Deduplication and merging. The survivor rules are the semantics; `seq` is the total order of the rows.

Survivors come from min_by / max_by, so each task combines its rows before the shuffle and a hot key costs no
more than one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame):
    return F.struct(*[F.col(c) for c in df.columns])


def dedup_first(df: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The first row of each key; rows with a null in the key are dropped."""
    kept = df.dropna(subset=key).groupBy(*key).agg(F.min_by(_row(df), F.col(seq)).alias("r"))
    return kept.select("r.*")


def dedup_report(df: DataFrame, key: str) -> DataFrame:
    """(key, removed) of the keys that repeat: what dedup_first takes away."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg((F.count("*") - 1).alias("removed")).filter("removed > 0")


def merge_batches(df: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The first row of each key, and every row without one."""
    null = F.lit(False)
    for k in key:
        null = null | F.col(k).isNull()
    return dedup_first(df, key, seq).unionByName(df.filter(null))


def consolidate_last(df: DataFrame, key: str, seq: str, group: list[str] | None = None, position: str = "position") -> DataFrame:
    """The last row of each key (within a group), at the position of its first; rows without a key are dropped."""
    kept = df.filter(F.col(key).isNotNull()).groupBy(*(group or []), key).agg(F.max_by(_row(df), F.col(seq)).alias("r"), F.min(seq).alias(position))
    return kept.select("r.*", position)


def dedup_within_file(df: DataFrame, key: str, seq: str, file: str = "file") -> DataFrame:
    """The first row of each key in each file, and every row without one."""
    keyed = df.filter(F.col(key).isNotNull()).groupBy(file, key).agg(F.min_by(_row(df), F.col(seq)).alias("r")).select("r.*")
    return keyed.unionByName(df.filter(F.col(key).isNull()))


def dedup_files(files: DataFrame, digest: str = "md5", file: str = "file") -> DataFrame:
    """Each file with the first file (by name) of the same content, and whether it is that one."""
    first = files.groupBy(digest).agg(F.min(file).alias("kept_file"))
    return files.join(first, digest).withColumn("kept", F.col(file) == F.col("kept_file"))


def ingest_gate(new: DataFrame, existing: DataFrame, key: str, fingerprint: str, seq: str) -> DataFrame:
    """The new rows that pass: those without a key always; of the others the first of each key that no earlier batch
    has, and of these the first of each fingerprint."""
    keyed = new.filter(F.col(key).isNotNull()).join(existing.select(key).dropna().distinct(), key, "left_anti").select(new.columns)
    first = dedup_first(keyed, [key], seq)
    return dedup_first(first, [fingerprint], seq).unionByName(new.filter(F.col(key).isNull()))


def catalog_index(df: DataFrame, key: str, seq: str, file: str = "file") -> DataFrame:
    """For each key its last row in the first file (by name) that has it, and in how many further files it is."""
    last = df.filter(F.col(key).isNotNull()).groupBy(file, key).agg(F.max_by(_row(df), F.col(seq)).alias("r"))
    return last.groupBy(key).agg(F.min_by("r", file).alias("r"), (F.count("*") - 1).alias("other_files")).select("r.*", "other_files")


def skip_processed(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key).dropna().distinct(), key, "left_anti").select(df.columns)
