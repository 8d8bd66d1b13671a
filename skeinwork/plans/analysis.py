"""Duplication and outcome queries: suppliers stand for batch files, parts for products, events for a log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators import analysis as A
from skeinwork.operators import quality as V
from skeinwork.operators.batching import with_place
from skeinwork.plans.registry import query
from skeinwork.sources.storage import materialise, table

PAIRS = "SELECT DISTINCT l_suppkey AS file, l_partkey AS product FROM lineitem"
MULTI = f"SELECT product, count(*) AS n FROM ({PAIRS}) GROUP BY product"
RATE = "round(CASE WHEN {1} > 0 THEN 100e0 * {0} / {1} ELSE 0e0 END, 6)"
SUMMARY = f"""SELECT *, {RATE.format("duplicate_products", "unique_products")} AS duplication_rate FROM (SELECT (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS files,
  (SELECT count(l_partkey) FROM lineitem) AS rows, count(*) AS unique_products, count(*) FILTER (n > 1) AS duplicate_products FROM ({MULTI}))"""
ALIKE = f"""SELECT file1, file2, shared, s1.n + s2.n - shared AS "union", {RATE.format("shared", "(s1.n + s2.n - shared)")} AS similarity
  FROM (SELECT a.file AS file1, b.file AS file2, count(*) AS shared FROM ({PAIRS}) a JOIN ({PAIRS}) b ON a.product = b.product AND a.file < b.file GROUP BY 1, 2)
  JOIN (SELECT file, count(*) AS n FROM ({PAIRS}) GROUP BY 1) s1 ON s1.file = file1 JOIN (SELECT file, count(*) AS n FROM ({PAIRS}) GROUP BY 1) s2 ON s2.file = file2"""
DISTRIBUTION = f"""SELECT count(*) FILTER (n = 1) AS in_1_file, count(*) FILTER (n = 2) AS in_2_files, count(*) FILTER (n = 3) AS in_3_files,
  count(*) FILTER (n >= 4) AS in_4_plus_files, coalesce(max(n), 0) AS max_files FROM ({MULTI})"""
ACTIONS = "CASE event_type WHEN 'signup' THEN 'created' WHEN 'purchase' THEN 'updated' WHEN 'view' THEN 'skipped' WHEN 'error' THEN 'error' ELSE 'other' END"


def catalogue_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("file"), F.col("l_partkey").alias("product"))


@query(SUMMARY)
def a1_duplication_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.duplication_summary(catalogue_pairs(spark, sf_dir))


#: Files of a page of A2: few enough that the given tables need several.
PAGE = 3


@query(f"""SELECT product, (place - 1) // {PAGE} AS page, array_to_string(list(file ORDER BY file), ',') AS files, any_value(n) AS file_count FROM
  (SELECT *, row_number() OVER (PARTITION BY product ORDER BY file) AS place, count(*) OVER (PARTITION BY product) AS n FROM ({PAIRS})) WHERE n > 1 GROUP BY 1, 2""")
def a2_duplicate_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = A.duplicate_products(catalogue_pairs(spark, sf_dir), PAGE)
    return found.withColumn("files", F.array_join(F.transform("files", lambda x: x.cast("string")), ","))


@query(DISTRIBUTION)
def a3_file_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.file_distribution(catalogue_pairs(spark, sf_dir))


@query(ALIKE)
def a4_batch_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.batch_similarity(catalogue_pairs(spark, sf_dir))


@query(f"""SELECT file1, file2, a.product FROM ({PAIRS}) a JOIN ({PAIRS}) b ON a.product = b.product JOIN (SELECT file1, file2 FROM ({ALIKE}) ORDER BY similarity DESC, file1, file2 LIMIT 10) t ON a.file = t.file1 AND b.file = t.file2""")
def j11_shared_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products that the ten most alike pairs of files share."""
    pairs = catalogue_pairs(spark, sf_dir)
    most = materialise(A.batch_similarity(pairs).orderBy(F.desc("similarity"), "file1", "file2").limit(10), "most-alike")
    return A.shared_products(pairs, most).select("file1", "file2", F.explode("products").alias("product"))


RECOMMENDED = f"""SELECT CASE WHEN duplication_rate > 20 THEN 'high_duplication' WHEN duplication_rate > 10 THEN 'moderate_duplication' ELSE 'low_duplication' END AS code, duplication_rate AS value,
  NULL::BIGINT AS file1, NULL::BIGINT AS file2 FROM ({SUMMARY})
  UNION ALL SELECT 'similar_pairs', count(*)::DOUBLE, NULL, NULL FROM ({ALIKE}) WHERE similarity > 80 HAVING count(*) > 0
  UNION ALL (SELECT 'similar_pair', similarity, file1, file2 FROM ({ALIKE}) WHERE similarity > 80 ORDER BY similarity DESC, file1, file2 LIMIT 3)
  UNION ALL SELECT 'in_4_plus_files', in_4_plus_files::DOUBLE, NULL, NULL FROM ({DISTRIBUTION}) WHERE in_4_plus_files > 0"""


@query("WITH twice AS (SELECT 2 * l_suppkey + c AS l_suppkey, l_partkey FROM lineitem, (VALUES (0), (1)) v(c) WHERE c = 0 OR l_partkey % 10 <> 0) " + RECOMMENDED.replace("FROM lineitem", "FROM twice"))
def a5_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's file is there twice, the second time without every tenth part, so that there are similar pairs."""
    copies = catalogue_pairs(spark, sf_dir).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("c")).filter("c = 0 OR product % 10 <> 0")
    return A.recommendations(copies.select((2 * F.col("file") + F.col("c")).alias("file"), "product"))


@query("SELECT l_suppkey AS file, sum(length(l_returnflag || l_linestatus))::BIGINT AS bytes, max(l_shipdate) AS modified, count(*) AS rows, count(DISTINCT l_partkey) AS unique_products FROM lineitem GROUP BY 1")
def a6_file_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    files = rows.groupBy(F.col("l_suppkey").alias("file")).agg(F.sum(F.length(F.concat("l_returnflag", "l_linestatus"))).alias("bytes"), F.max("l_shipdate").alias("modified"))
    return A.file_profile(catalogue_pairs(spark, sf_dir), files)


@query("""SELECT *, round(CASE WHEN "unique" > 0 THEN 100e0 * duplicates / "unique" ELSE 0e0 END, 6) AS rate_of_unique, round(CASE WHEN total > 0 THEN 100e0 * duplicates / total ELSE 0e0 END, 6) AS rate_of_total
  FROM (SELECT count(DISTINCT event_type) AS batches, count(*) AS total, count(*) FILTER (rn = 1) AS "unique", count(*) FILTER (rn > 1) AS duplicates
  FROM (SELECT event_type, row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) AS rn FROM events))""")
def a7_batch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("file"), "user_id", "event_id")
    first = events.groupBy("file", "user_id").agg(F.min("event_id").alias("first"))
    return A.batch_stats(events.join(first, ["file", "user_id"]), F.col("event_id") > F.col("first"))


@query(f"SELECT *, {RATE.format('(created + updated)', 'total')} AS success_rate FROM (SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (a = '{a}') AS {n}" for a, n in (("created", "created"), ("updated", "updated"), ("skipped", "skipped"), ("error", "errors"))) + f" FROM (SELECT {ACTIONS} AS a FROM events))")
def a9_outcome_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.outcome_stats(table(spark, sf_dir, "events"), F.expr(ACTIONS))


@query("SELECT user_id, arg_max(event_type, (width * height, bytes, -event_id)) AS url, max(width * height) AS area, arg_max(bytes, (width * height, bytes, -event_id)) AS bytes FROM (SELECT *, length(event_type) AS width, floor(value)::BIGINT AS height, length(props) AS bytes FROM events) GROUP BY user_id")
def a11_pick_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each user's events the one with the largest area (its type's length by its value)."""
    own = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("url"), F.length("event_type").cast("long").alias("width"), F.floor("value").alias("height"), F.length("props").cast("long").alias("bytes"), F.col("event_id").alias("pos"))
    return A.pick_best(own, "user_id")


@query("""WITH m AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type END AS url, CASE WHEN event_type = 'error' THEN 0 ELSE length(event_type) * floor(value)::BIGINT END AS area,
  CASE WHEN event_type = 'error' THEN 0 ELSE length(props) END AS bytes, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events),
  u AS (SELECT user_id, count(url) AS urls, max(bytes) AS bytes, max(area) AS best, max(area) FILTER (pos = 0) AS base FROM m GROUP BY user_id)
  SELECT count(*) AS tested, count(*) FILTER (urls = 0) AS no_url, count(*) FILTER (bytes > 0) AS any_bytes, count(*) FILTER (base > 0 AND best > base) AS improved FROM u""")
def a12_probe_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok, events = F.col("event_type") != "error", with_place(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "props"), "user_id", ["event_id"])
    own = events.select("user_id", F.when(ok, F.col("event_type")).alias("url"), F.when(ok, F.length("event_type")).alias("width"), F.when(ok, F.floor("value")).alias("height"), F.when(ok, F.length("props")).alias("bytes"), (F.col("place") - 1).alias("pos"))
    return A.probe_summary(own, "user_id")


@query("""WITH n AS (SELECT o_custkey, CAST(ceil(count(*) / 5e0) AS BIGINT) AS pages FROM orders GROUP BY 1), w AS (SELECT o_custkey, unnest(generate_series(1, pages)) AS page FROM n)
  SELECT o_custkey, page FROM w WHERE NOT EXISTS (SELECT 1 FROM (SELECT o_custkey AS c, 1 + count(*) // 5 AS p FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) s WHERE c = o_custkey AND p = page)""")
def a13_page_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of five orders that each customer needs, without the one that its finished orders reach."""
    orders = table(spark, sf_dir, "orders")
    pages = orders.groupBy("o_custkey").agg(F.count("*").alias("n")).select("o_custkey", A.pages_needed(F.col("n"), F.lit(5)).alias("pages"))
    seen = orders.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg((F.floor(F.count("*") / 5) + 1).alias("page"))
    return A.page_coverage(pages, seen, "o_custkey")


@query("SELECT user_id, count(*) FILTER (event_type = 'purchase') AS done, count(*) AS total, round_even(100e0 * count(*) FILTER (event_type = 'purchase') / count(*), 1) AS percent FROM events GROUP BY user_id")
def a14_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("done"), F.count("*").alias("total"))
    return own.withColumn("percent", A.progress(F.col("done"), F.col("total")))


@query("SELECT count(*) AS runs, sum(l)::BIGINT AS total_products, arg_max(l, (ts, event_id)) AS last_products, arg_max(value, (ts, event_id)) AS last_duration, arg_max(event_type <> 'error', (ts, event_id)) AS last_ok FROM (SELECT *, length(props) AS l FROM events)")
def a15_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("ts", F.col("event_id").alias("run_id"), F.length("props").cast("long").alias("products"), F.col("value").alias("duration"), (F.col("event_type") != "error").alias("ok"))
    return A.run_stats(log)


@query("SELECT event_type AS file, count(*) AS lines FROM events WHERE trim(props) <> '' GROUP BY 1")
def v4_batch_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.batch_line_stats(table(spark, sf_dir, "events").select(F.col("event_type").alias("file"), F.col("props").alias("value")))


@query("SELECT max(l_shipdate) AS newest, TIMESTAMP '1998-12-01 00:00:00' - INTERVAL 6 HOUR > max(l_shipdate) AS stale FROM lineitem")
def v10_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.max("l_shipdate").alias("modified"))
    return V.is_stale(files, F.lit("1998-12-01 00:00:00").cast("timestamp_ntz"), "6 HOURS")
