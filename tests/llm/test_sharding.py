from collections import defaultdict

from pyspark.sql import functions as F

from skeinwork.llm import sharding as S


def check(rows, limit):
    size, members = defaultdict(int), defaultdict(set)
    for r in rows:
        size[r["shard"]] += r["n_bytes"]
        members[r["shard"]].add(r["doc_id"])
        assert r["shard_bytes"] >= 0 and r["depth"] >= 0
    for r in rows:
        assert size[r["shard"]] == r["shard_bytes"]
    names = sorted(size)
    assert all(not b.startswith(a) for a in names for b in names if a != b)  # prefix-free: a directory
    for name in names:
        if name and "-" not in name:  # only oversized buckets were split
            assert sum(size[n] for n in names if n.replace("-", "").startswith(name[:-1])) > limit
    return size


def test_every_shard_fits_and_only_oversized_ones_split(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), (F.col("id") % 50).cast("int")).alias("text"), F.lit(1).alias("place"))
    rows = S.shard_documents(docs, 4000).collect()
    assert len(rows) == 3000 and sum(r["n_bytes"] for r in rows) == sum(2 * (i % 50) for i in range(3000))
    size = check(rows, 4000)
    assert len(size) > 10 and max(size.values()) <= 4000
    again = S.shard_documents(docs.repartition(7), 4000).collect()
    assert {(r["doc_id"], r["shard"]) for r in rows} == {(r["doc_id"], r["shard"]) for r in again}


def test_small_and_empty_tables_have_one_shard_or_none(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None), (2, "")], "doc_id long, text string")
    assert {(r["doc_id"], r["shard"], r["shard_bytes"]) for r in S.shard_documents(docs, 10).collect()} == {(1, "", 1), (None, "", 1), (2, "", 1)}
    assert S.shard_documents(docs.limit(0), 10).count() == 0


def test_copies_of_one_row_and_oversized_documents(spark):
    docs = spark.createDataFrame([(1, "x" * 10)] * 300 + [(2, "y" * 5000)] + [(3, "z" * k) for k in range(50)], "doc_id long, text string")
    rows = S.shard_documents(docs, 500).collect()
    assert len(rows) == 351
    size = check(rows, 500)
    over = [n for n, b in size.items() if b > 500]
    assert [r["doc_id"] for r in rows if r["shard"] in over] == [2]
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) >= 6


def test_a_very_long_text_stands_alone(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 7, F.repeat(F.lit("x"), 3_000_000)).otherwise("short").alias("text"))
    rows = {r["doc_id"]: r for r in S.shard_documents(docs, 1000).collect()}
    assert len(rows) == 40 and rows[7]["shard_bytes"] == 3_000_000
    assert all(r["shard_bytes"] <= 1000 for i, r in rows.items() if i != 7)
