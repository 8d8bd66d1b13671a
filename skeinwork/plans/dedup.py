"""Deduplication queries: events keyed by user, some of them without a key, with the event type as file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators import analysis as A
from skeinwork.operators import batching as W
from skeinwork.operators import dedup as D
from skeinwork.operators import identity as K
from skeinwork.plans.batching import SMALL, SMALL_CAP, VARIED, compaction_sql, varied_sizes
from skeinwork.plans.registry import query
from skeinwork.sources.sinks import merge_catalogs
from skeinwork.sources.storage import table

KEYED = "SELECT event_id AS seq, nullif(user_id % 97, 0) AS key, event_type AS file, value FROM events"
FIRST = "SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {1} ORDER BY {2}) AS rn FROM ({0})) WHERE rn = 1"


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.nullif(F.col("user_id") % 97, F.lit(0)).alias("key"), F.col("event_type").alias("file"), "value")


@query(FIRST.format(f"SELECT * FROM ({KEYED}) WHERE key IS NOT NULL", "key", "seq"))
def d1_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dedup_first(keyed(spark, sf_dir), ["key"], "seq")


@query(f"SELECT key, count(*) - 1 AS removed FROM ({KEYED}) WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1")
def d1_dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dedup_report(keyed(spark, sf_dir), "key")


@query(FIRST.format(f"SELECT * FROM ({KEYED}) WHERE key IS NOT NULL", "key", "seq") + f" UNION ALL SELECT * FROM ({KEYED}) WHERE key IS NULL")
def d2_merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.merge_batches(keyed(spark, sf_dir), ["key"], "seq")


@query(f"SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn, min(seq) OVER (PARTITION BY key) AS position FROM ({KEYED}) WHERE key IS NOT NULL) WHERE rn = 1")
def d3_consolidate_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.consolidate_last(keyed(spark, sf_dir), "key", "seq")


@query(FIRST.format(f"SELECT * FROM ({KEYED}) WHERE key IS NOT NULL", "file, key", "seq") + f" UNION ALL SELECT * FROM ({KEYED}) WHERE key IS NULL")
def d4_dedup_within_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dedup_within_file(keyed(spark, sf_dir), "key", "seq")


@query("SELECT doc_id AS file, md5(text) AS md5, min(doc_id) OVER (PARTITION BY md5(text)) AS kept_file, doc_id = min(doc_id) OVER (PARTITION BY md5(text)) AS kept FROM documents")
def d5_dedup_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), K.file_fingerprint(F.col("text").cast("binary")).alias("md5"))
    return D.dedup_files(files)


@query("""WITH n AS (SELECT doc_id AS seq, nullif(doc_id % 1000, 0) AS key, md5(text) AS fp FROM documents WHERE source <> 'src1'), e AS (SELECT DISTINCT nullif(doc_id % 1000, 0) AS key FROM documents WHERE source = 'src1'),
  f AS (SELECT * FROM n WHERE key IS NOT NULL AND key NOT IN (SELECT key FROM e WHERE key IS NOT NULL)), a AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY key ORDER BY seq) = 1)
  SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY fp ORDER BY seq) = 1 UNION ALL SELECT * FROM n WHERE key IS NULL""")
def d6_ingest_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source is what earlier batches hold; the others come in."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.nullif(F.col("doc_id") % 1000, F.lit(0)).alias("key"), F.md5(F.col("text").cast("binary")).alias("fp"), "source")
    old = docs.filter("source = 'src1'")
    return D.ingest_gate(docs.filter("source <> 'src1'").drop("source"), old, "key", "fp", "seq")


@query("SELECT * EXCLUDE rn FROM (SELECT event_id AS seq, coalesce(nullif(user_id % 97, 0)::VARCHAR, event_type || '_' || event_id) AS key, row_number() OVER (PARTITION BY coalesce(nullif(user_id % 97, 0)::VARCHAR, event_type || '_' || event_id) ORDER BY event_id) AS rn FROM events) WHERE rn = 1")
def d7_prepare_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), (F.col("user_id") % 97).alias("product_id"), F.col("event_type").alias("name"))
    own = events.withColumn("key", K.prepared_identity(events, "seq")).select("seq", "key")
    return D.dedup_first(own, ["key"], "seq")


@query(f"""WITH l AS (SELECT *, row_number() OVER (PARTITION BY file, key ORDER BY seq DESC) AS rn FROM ({KEYED}) WHERE key IS NOT NULL), k AS (SELECT * EXCLUDE rn FROM l WHERE rn = 1)
  SELECT * EXCLUDE r2 FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY file) AS r2, count(*) OVER (PARTITION BY key) - 1 AS other_files FROM k) WHERE r2 = 1""")
def d8_catalog_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.catalog_index(keyed(spark, sf_dir), "key", "seq")


@query("SELECT user_id, page, array_to_string(list_distinct_ordered, '|') AS kinds FROM (SELECT user_id, page, list(event_type ORDER BY first) AS list_distinct_ordered FROM (SELECT user_id, event_id // 5000 AS page, event_type, min(event_id) AS first FROM events GROUP BY 1, 2, 3) GROUP BY 1, 2)")
def d9_array_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of event of each user and five thousand event ids, in order; an array holds that many at most."""
    page = F.floor(F.col("event_id") / 5000).alias("page")
    rows = table(spark, sf_dir, "events").groupBy("user_id", page).agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))).alias("e"))
    return rows.select("user_id", "page", F.array_join(F.array_distinct(F.col("e.event_type")), "|").alias("kinds"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')")
def d10_skip_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("user_id").alias("o_custkey"))
    return D.skip_processed(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), done, "o_custkey")


@query(f"""WITH f AS (SELECT doc_id AS file, doc_id = min(doc_id) OVER (PARTITION BY md5(text)) AS kept FROM documents), p AS ({compaction_sql(f"size < {SMALL}", VARIED, SMALL_CAP)})
  SELECT (SELECT count(*) FROM f) AS files, (SELECT count(*) FILTER (NOT kept) FROM f) AS files_removed, (SELECT count(*) FILTER (rewritten) FROM p) AS files_consolidated,
  (SELECT count(*) FROM documents) AS rows_before, (SELECT count(DISTINCT md5(text)) FROM documents) AS rows_after, (SELECT count(*) - count(DISTINCT md5(text)) FROM documents) AS rows_removed""")
def a8_cleanup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: identical ones go; small suppliers are merged."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file"), F.md5(F.col("text").cast("binary")).alias("md5"))
    files = D.dedup_files(docs)
    return A.cleanup_report(files, W.plan_compaction(varied_sizes(spark, sf_dir), SMALL_CAP, SMALL), docs, D.dedup_first(docs, ["md5"], "file"))


@query("SELECT o_orderkey AS id, o_totalprice AS price FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderstatus <> 'F'")
def s14_merge_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are the existing catalogue; all orders, dearer by one, come in."""
    orders = table(spark, sf_dir, "orders")
    old = orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    return merge_catalogs(old, orders.select(F.col("o_orderkey").alias("id"), (F.col("o_totalprice") + 1).alias("price")), "id")
