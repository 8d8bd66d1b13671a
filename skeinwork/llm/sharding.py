"""Extendible hashing into shards of a bounded size.

A row's place is a hash of 60 bits. The directory is indexed by its leading bits; a bucket over the limit splits
on the next bit, and only such buckets do, so shards differ in depth. Sizes are summed per prefix, never per
row on the driver, and the directory stays a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import materialise

BITS = 60
#: Levels that one pass over the open buckets' sums decides.
LEVELS = 12


def shard_documents(docs: DataFrame, limit: int) -> DataFrame:
    """One row per document: doc_id, n_bytes (of the text in UTF-8), shard (its leading hash bits as text, '' for
    the one shard of a small table), depth, shard_bytes.

    The hash is of doc_id and text, so rows that share a doc_id can still part. Rows equal in both share all 60
    bits; should they alone exceed the limit, their copies are numbered and a hash of the number carries on
    (shard: the 60 bits, a dash, further bits). Only a single document over the limit stays over it, alone in
    its shard. A null text has no bytes; null ids take part; an empty table gives no rows.
    """
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))).cast("binary"))
    place = F.lpad(F.conv(F.substring(digest, 1, 15), 16, 2), BITS, "0")
    rows = materialise(docs.select(F.col("doc_id").cast("long"), size.alias("n_bytes"), place.alias("place"), F.monotonically_increasing_id().alias("copy")), "shard-rows")
    shards = _split(rows.select("place", "n_bytes"), limit)
    split = _assign(rows, shards)
    over = split.filter((F.length("shard") == BITS) & (F.col("shard_bytes") > limit))
    copies = materialise(over.select("doc_id", "n_bytes", F.col("shard").alias("head"), F.lpad(F.conv(F.substring(F.md5(F.col("copy").cast("string")), 1, 15), 16, 2), BITS, "0").alias("tail")), "shard-copies")
    if copies.isEmpty():
        return split.select("doc_id", "n_bytes", "shard", F.length("shard").alias("depth"), "shard_bytes")
    own = _split(copies.select(F.concat("head", "tail").alias("place"), "n_bytes"), limit, BITS, 2 * BITS)
    again = _assign(copies.select("doc_id", "n_bytes", F.concat("head", "tail").alias("place"), F.lit(0).alias("copy")), own)
    done = split.join(over.select("shard").distinct(), "shard", "left_anti")
    out = done.select("doc_id", "n_bytes", "shard", F.length("shard").alias("depth"), "shard_bytes")
    return out.union(again.select("doc_id", "n_bytes", F.concat(F.substring("shard", 1, BITS), F.lit("-"), F.substring("shard", BITS + 1, BITS)), F.length("shard"), "shard_bytes"))


def _split(sizes: DataFrame, limit: int, depth: int = 0, most: int = BITS) -> DataFrame:
    """(shard, shard_bytes): the leaves over rows (place, n_bytes), from buckets at `depth` on."""
    open_rows, leaves = sizes, None
    while True:
        low = min(depth + LEVELS, most)
        cells = open_rows.groupBy(F.substring("place", 1, low).alias("cell")).agg(F.sum("n_bytes").alias("bytes"))
        levels = F.explode(F.sequence(F.lit(depth), F.lit(low))).alias("depth")
        nodes = cells.select("cell", "bytes", levels).groupBy(F.expr("substring(cell, 1, depth)").alias("shard"), "depth").agg(F.sum("bytes").alias("shard_bytes"))
        nodes = materialise(nodes, "shard-nodes")
        full = nodes.filter(F.col("shard_bytes") > limit).select(F.col("shard").alias("above"), (F.col("depth") + 1).alias("depth"))
        below = _below(nodes, full)
        first = nodes.filter(F.col("depth") == depth)
        ends = first.unionByName(below).filter((F.col("shard_bytes") <= limit) | (F.col("depth") == most)).select("shard", "shard_bytes")
        leaves = ends if leaves is None else leaves.union(ends)
        still = materialise(nodes.filter((F.col("depth") == low) & (F.col("shard_bytes") > limit)).select(F.col("shard").alias("cell")), "shard-open")
        if low == most or still.isEmpty():
            return materialise(leaves, "shard-leaves")
        open_rows = open_rows.join(still, F.substring("place", 1, low) == F.col("cell"), "left_semi")
        depth = low


def _below(nodes: DataFrame, full: DataFrame) -> DataFrame:
    """The nodes whose parent is over the limit; sums only shrink downwards, so all above it are too."""
    keyed = nodes.filter(F.col("depth") > 0).withColumn("above", F.expr("substring(shard, 1, depth - 1)"))
    return keyed.join(full, ["above", "depth"], "left_semi").drop("above")


def _assign(rows: DataFrame, shards: DataFrame) -> DataFrame:
    """rows with the shard whose bits their place starts with, by one equi-join for each depth in use."""
    depths = [r[0] for r in shards.select(F.length("shard")).distinct().collect()]  # at most one for each bit
    head = F.array(*[F.substring("place", 1, d) for d in sorted(depths)]) if depths else F.array(F.lit(""))
    return rows.select("doc_id", "n_bytes", "copy", F.explode(head).alias("shard")).join(shards, "shard")
