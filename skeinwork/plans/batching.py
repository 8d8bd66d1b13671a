"""Ordering, batch and window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators import batching as W
from skeinwork.plans.registry import query
from skeinwork.sources.sinks import write_batches
from skeinwork.sources.storage import fresh_path, table

FILES = "SELECT l_suppkey AS file, max(l_shipdate) AS modified FROM lineitem GROUP BY 1"
SIZES = "SELECT l_suppkey AS file, l_suppkey AS place, count(DISTINCT l_partkey) AS size FROM lineitem GROUP BY 1"
#: Caps of a compaction over suppliers, whose sizes are some hundred parts.
CAP = 1500


def supplier_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("file")).agg(F.max("l_shipdate").alias("modified"))


def supplier_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("file")).agg(F.count_distinct("l_partkey").alias("size")).select("file", F.col("file").alias("place"), "size")


#: Sizes that differ from supplier to supplier, some below the bound of the smaller variant and some above.
VARIED = f"SELECT file, place, size % 97 + 1 AS size FROM ({SIZES})"
SMALL, SMALL_CAP = 60, 150


def varied_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_sizes(spark, sf_dir).withColumn("size", F.col("size") % 97 + 1)


def compaction_sql(where: str, sizes: str = SIZES, cap: int = CAP) -> str:
    return f"""WITH RECURSIVE f AS (SELECT *, row_number() OVER (ORDER BY place) AS n FROM ({sizes}) WHERE {where}),
  w AS (SELECT file, place, size, n, 1::BIGINT AS group_id, size::BIGINT AS total FROM f WHERE n = 1
    UNION ALL SELECT f.file, f.place, f.size, f.n, w.group_id + (w.total + f.size > {cap})::BIGINT, CASE WHEN w.total + f.size > {cap} THEN f.size ELSE w.total + f.size END FROM w JOIN f ON f.n = w.n + 1)
  SELECT file, place, size, group_id, count(*) OVER (PARTITION BY group_id) > 1 AS rewritten FROM w"""


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rank, (row_number() OVER (ORDER BY o_orderkey) - 1) // 50 + 1 AS batch_id FROM orders")
def w1_assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.assign_batches(table(spark, sf_dir, "orders").select("o_orderkey"), 50, ["o_orderkey"])


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 150")
def w2_batch_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.batch_slice(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), 50, 3, ["o_orderkey"])


@query(f"SELECT *, row_number() OVER (ORDER BY modified DESC, file) AS rank, row_number() OVER (ORDER BY modified DESC, file) <= 10 AS kept FROM ({FILES})")
def w3_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.retention(supplier_files(spark, sf_dir), 10)


@query("SELECT event_id, event_id || ' | ' || coalesce(event_type, 'N/A') || ' | ' || coalesce(user_id::VARCHAR, 'N/A') AS line FROM (SELECT * FROM events ORDER BY event_id DESC LIMIT 10)")
def w4_latest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.latest_summary(table(spark, sf_dir, "events"), 10, "event_id", ["event_id", "event_type", "user_id"])


@query("SELECT event_id, user_id FROM events WHERE event_id > coalesce((SELECT min(event_id) FROM events WHERE user_id = 7), -1)")
def w5_resume_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.resume_after(table(spark, sf_dir, "events").select("event_id", "user_id"), "user_id", 7, "event_id")


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10")
def w6_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.top(table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")), 10, [F.desc("n"), F.col("l_partkey")])


@query(compaction_sql("TRUE"))
def w7_plan_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.plan_compaction(supplier_sizes(spark, sf_dir), CAP)


@query(compaction_sql(f"size < {SMALL}", VARIED, SMALL_CAP))
def w7_plan_small_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.plan_compaction(varied_sizes(spark, sf_dir), SMALL_CAP, SMALL)


@query(f"SELECT *, row_number() OVER (ORDER BY file) - 1 AS index FROM ({FILES}) QUALIFY index >= 20 AND index < 45")
def w8_plan_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.plan_chunk(supplier_files(spark, sf_dir), 20, 25)[0]


@query(f"SELECT greatest(least(45, n) - 20, 0) AS processed, n - least(45, n) AS remaining, least(45, n) AS next_index, CASE WHEN least(45, n) >= n THEN 'complete' ELSE 'partial' END AS status FROM (SELECT count(*) AS n FROM ({FILES}))")
def w8_chunk_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.plan_chunk(supplier_files(spark, sf_dir), 20, 25)[1]


@query("SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 100")
def w9_limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.limit_rows(table(spark, sf_dir, "events").select("event_id", "event_type"), 100, ["event_id"])


@query("SELECT event_id, event_type FROM events WHERE event_id <= (SELECT max(event_id) FROM (SELECT event_id FROM events WHERE event_type = 'purchase' ORDER BY event_id LIMIT 100))")
def w9_limit_successes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.limit_successes(table(spark, sf_dir, "events").select("event_id", "event_type"), 100, F.col("event_type") == "purchase", ["event_id"])


@query("SELECT event_id, user_id, array_to_string(list(event_type) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), ',') AS recent FROM events")
def w10_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = W.recent(table(spark, sf_dir, "events"), 10, ["user_id"], ["event_id"], "event_type")
    return own.select("event_id", "user_id", F.array_join("recent", ",").alias("recent"))


@query("""SELECT event_id, requests, requests > 3 AS over_limit, coalesce(ts - prev < INTERVAL 90 SECOND, FALSE) AS too_close FROM (SELECT event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev,
  count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS requests FROM events)""")
def w11_trailing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = W.trailing_rate(table(spark, sf_dir, "events"), 3600, 3, 90, "user_id")
    return log.select("event_id", "requests", "over_limit", "too_close")


@query("""WITH i AS (SELECT *, sum((event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM events)
  SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS failures FROM i WHERE event_type = 'error' GROUP BY user_id, island HAVING count(*) >= 2""")
def w12_failure_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.failure_streaks(table(spark, sf_dir, "events"), 2, "user_id", ["event_id"], F.col("event_type") != "error")


@query(f"SELECT arg_max(file, (modified, file)) AS file FROM (SELECT file::VARCHAR AS file, modified FROM ({FILES})) WHERE file LIKE '%1'")
def w13_latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.latest_file(supplier_files(spark, sf_dir).withColumn("file", F.col("file").cast("string")), "%1")


@query("SELECT batch_id::BIGINT AS batch_id, count(*) AS batch_count, min(o_orderkey) AS first, max(o_orderkey) AS last FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 + 1 AS batch_id FROM orders) GROUP BY 1")
def s5_write_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the orders as batches of JSON Lines and reads what each batch holds."""
    path = fresh_path(spark, "batches")
    write_batches(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), 1000, path, ["o_orderkey"])
    rows = spark.read.schema("o_orderkey long, o_custkey long, o_totalprice double, batch_id long, batch_count long").json(path)
    return rows.groupBy("batch_id").agg(F.count("*").alias("batch_count"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))
