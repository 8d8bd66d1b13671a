"""Synchronisation queries: orders before a date are the store, later ones what was scraped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators import analysis as A
from skeinwork.operators import sync as J
from skeinwork.plans.registry import query
from skeinwork.sources.storage import table

CUT = "1998-01-01"
SCRAPED = f"SELECT o_custkey::VARCHAR AS product_id, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS scraped_date FROM orders WHERE o_custkey % 3 <> 0 OR o_orderdate < TIMESTAMP '{CUT}' GROUP BY o_custkey"
STORE = f"SELECT o_custkey::VARCHAR AS product_id, CASE WHEN o_custkey % 7 <> 0 THEN strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') END AS scraped_date FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}' AND o_custkey % 11 <> 0 GROUP BY o_custkey"
ACTION = f"""SELECT s.product_id, s.scraped_date, CASE WHEN t.product_id IS NULL THEN 'create' WHEN t.scraped_date IS NULL THEN 'update' WHEN s.scraped_date::TIMESTAMP > t.scraped_date::TIMESTAMP THEN 'update' ELSE 'skip' END AS action
  FROM ({SCRAPED}) s LEFT JOIN ({STORE}) t USING (product_id)"""
BUYERS = f"SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}'"
SHOP = "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'id' || p_partkey END AS product_id, CASE WHEN p_partkey % 3 = 0 THEN p_name || p_partkey END AS sku FROM part"


def scraped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").filter((F.col("o_custkey") % 3 != 0) | (F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")))
    return rows.groupBy(F.col("o_custkey").cast("string").alias("product_id")).agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("scraped_date"))


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").filter((F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")) & (F.col("o_custkey") % 11 != 0))
    last = rows.groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"))
    return last.select(F.col("o_custkey").cast("string").alias("product_id"), F.when(F.col("o_custkey") % 7 != 0, F.date_format("d", "yyyy-MM-dd'T'HH:mm:ss")).alias("scraped_date"))


def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")).select(F.col("o_custkey").alias("id"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


@query(f"SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey NOT IN ({BUYERS})")
def j1_filter_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.filter_mode(customers(spark, sf_dir), buyers(spark, sf_dir), "new")


@query(f"SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey NOT IN ({BUYERS}) AND c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase')")
def j2_new_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(F.col("user_id").alias("id"))
    return J.new_links(customers(spark, sf_dir), buyers(spark, sf_dir), done)


@query(f"SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_custkey::VARCHAR NOT IN (SELECT product_id FROM ({STORE})) AND c_custkey % 13 <> 0")
def j3_filter_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = customers(spark, sf_dir).select(F.col("id").cast("string").alias("id"))
    skus = customers(spark, sf_dir).filter("id % 13 = 0").select(F.lit(None).cast("string").alias("product_id"), F.col("id").cast("string").alias("sku"))
    both = store(spark, sf_dir).select("product_id", F.lit("").alias("sku")).union(skus)
    return J.filter_existing(own, both, "scrape")


@query(ACTION)
def j4_sync_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.sync_classify(scraped(spark, sf_dir), store(spark, sf_dir))


@query(f"SELECT s.product_id, s.scraped_date, coalesce(s.scraped_date <= t.scraped_date, FALSE) AS skip FROM ({SCRAPED}) s LEFT JOIN ({STORE}) t USING (product_id)")
def j5_sync_skip_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.sync_skip_lexical(scraped(spark, sf_dir), store(spark, sf_dir))


@query(f"""SELECT s.product_id AS id, s.scraped_date AS last_modified FROM ({SCRAPED}) s LEFT JOIN ({STORE}) t USING (product_id) WHERE s.product_id::BIGINT NOT IN (SELECT user_id FROM events WHERE event_type = 'error')
  AND CASE WHEN t.scraped_date IS NOT NULL THEN s.scraped_date > t.scraped_date ELSE t.product_id IS NULL END""")
def j6_link_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"product_id": "id", "scraped_date": "last_modified"}
    done = table(spark, sf_dir, "events").filter("event_type = 'error'").select(F.col("user_id").cast("string").alias("id"))
    return J.link_sync(scraped(spark, sf_dir).withColumnsRenamed(names), done, store(spark, sf_dir).withColumnsRenamed(names), "sync")


def shop(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(products, store): the store knows half of the parts by id and a third by sku."""
    key = F.col("p_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("id"), key).alias("product_id"), F.concat("p_name", key).alias("sku"), "p_size")
    known = part.select(F.when(key % 2 == 0, F.col("product_id")).alias("product_id"), F.when(key % 3 == 0, F.col("sku")).alias("sku"), key.alias("wp_id"))
    return part, known


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 OR p_partkey % 3 = 0 THEN p_partkey END AS wp_id FROM part")
def j7_match_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.match_existing(*shop(spark, sf_dir)).select("p_partkey", "wp_id")


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def j8_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", F.lit(-1).alias("quality"))
    return J.enrich(own, table(spark, sf_dir, "labels"), "doc_id", ["quality", "toxic"])


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error' AND user_id % 5 <> 0) AND c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND user_id % 3 = 0)")
def j9_retry_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users fail and all purchase; of the failures four in five count, of the purchases a third."""
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "event_type")
    return J.retry_backlog(users.filter("event_type = 'error' AND id % 5 <> 0"), users.filter("event_type = 'purchase' AND id % 3 = 0"), customers(spark, sf_dir))


@query("""WITH c AS (SELECT min(p_type) AS name, replace(lower(p_type), ' ', '-') AS slug FROM part GROUP BY 2), d AS (SELECT p_brand AS name, replace(lower(p_brand), ' ', '-') AS slug, row_number() OVER (ORDER BY p_brand) AS id FROM (SELECT DISTINCT p_brand FROM part)
  UNION ALL SELECT name, slug, 1000 + row_number() OVER (ORDER BY slug) FROM c WHERE slug < 'm')
  SELECT d.id, c.name, c.slug FROM c JOIN d USING (slug) UNION ALL SELECT (SELECT max(id) FROM d) + row_number() OVER (ORDER BY slug), name, slug FROM c WHERE slug NOT IN (SELECT slug FROM d)""")
def j10_upsert_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types as categories; the store has all brands, and the types before m."""
    from pyspark.sql import Window

    part = table(spark, sf_dir, "part")
    slug = lambda c: F.replace(F.lower(c), F.lit(" "), F.lit("-"))
    by_slug = F.row_number().over(Window.orderBy("slug"))
    brands = part.select(slug(F.col("p_brand")).alias("slug")).distinct().select("slug", by_slug.cast("long").alias("id"))
    types = part.select(slug(F.col("p_type")).alias("slug")).distinct().filter("slug < 'm'").select("slug", (by_slug + 1000).cast("long").alias("id"))
    return J.upsert_categories(part.select(F.col("p_type").alias("name")), brands.union(types))


@query("""SELECT id, CASE WHEN l AND r THEN 'both' WHEN l THEN 'left' ELSE 'right' END AS kind FROM (SELECT id, bool_or(s = 1) AS l, bool_or(s = 2) AS r FROM
  (SELECT c_custkey AS id, 1 AS s FROM customer UNION ALL SELECT o_custkey, 2 FROM orders UNION ALL SELECT user_id, 2 FROM events) GROUP BY id)""")
def j12_id_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    right = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")).union(table(spark, sf_dir, "events").select("user_id"))
    return J.id_sets(customers(spark, sf_dir), right, "id")


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 OR p_partkey % 3 = 0 THEN p_partkey END AS wp_id, CASE WHEN p_size <= 5 THEN 'error' WHEN p_partkey % 2 = 0 OR p_partkey % 3 = 0 THEN 'updated' ELSE 'created' END AS action FROM part")
def j13_import_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.import_action(*shop(spark, sf_dir), F.col("p_size") > 5).select("p_partkey", "wp_id", "action")


@query(f"SELECT count(*) AS total, count(*) FILTER (action = 'create') AS to_create, count(*) FILTER (action = 'update') AS to_update, count(*) FILTER (action = 'skip') AS skipped, count(*) FILTER (action = 'error') AS errors FROM ({ACTION})")
def a10_sync_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.sync_summary(J.sync_classify(scraped(spark, sf_dir), store(spark, sf_dir)))
