"""Identity, predicate and scalar queries over part, pages and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.functions import columns as C
from skeinwork.operators import identity as K
from skeinwork.operators import quality as V
from skeinwork.plans.registry import query
from skeinwork.sources.storage import table

KEYS = "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE p_partkey END AS product_id, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand END AS \"productId\", p_name AS id FROM part"


def drifting(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select("p_partkey", F.when(key % 3 == 0, 0).otherwise(key).alias("product_id"), F.when(key % 5 == 0, "").otherwise(F.col("p_brand")).alias("productId"), F.col("p_name").alias("id"), "p_size")


@query(f"""SELECT p_partkey, coalesce(nullif(product_id, 0)::VARCHAR, nullif("productId", ''), nullif(id, '')) AS batch, 'n:' || nullif(product_id, 0)::VARCHAR AS analyser, coalesce(nullif(id, ''), nullif("productId", '')) AS links,
  coalesce(nullif("productId", ''), nullif(id, '')) AS details, nullif(id, '') AS page, coalesce(nullif(product_id, 0)::VARCHAR, nullif(id, '')) AS "import", NULL::VARCHAR AS sync, coalesce(nullif(product_id, 0)::VARCHAR, nullif(id, ''), '?') AS probe,
  coalesce(id, "productId") AS dedup FROM ({KEYS})""")
def k1_identity_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every profile on records whose keys drift, the not-null one (K2) as well. Names that differ only by case are
    one column here, as Spark resolves them."""
    own = drifting(spark, sf_dir)
    names = ("batch", "analyser", "links", "details", "page", "import", "sync", "probe", "dedup")
    return own.select("p_partkey", *[K.identity(own, n).alias(n) for n in names])


CAMEL = """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'P' || p_partkey END AS pid, CASE WHEN p_partkey % 8 IN (0, 1) THEN 0 ELSE p_partkey END AS id,
  CASE WHEN p_partkey % 16 IN (0, 1) THEN 'https://shop.example.com/x' ELSE 'https://shop.example.com/?a=1&productID=' || p_partkey || 'x' END AS url FROM part"""


def camel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with ProductID, id and SourceURL, each missing or empty by a rule of the part's key."""
    k = F.col("p_partkey")
    pid = F.when(k % 4 == 0, "").when(k % 4 == 1, F.lit(None)).otherwise(F.concat(F.lit("P"), k))
    url = F.when((k % 16).isin(0, 1), "https://shop.example.com/x").otherwise(F.concat(F.lit("https://shop.example.com/?a=1&productID="), k, F.lit("x")))
    return table(spark, sf_dir, "part").select("p_partkey", pid.alias("ProductID"), F.when((k % 8).isin(0, 1), 0).otherwise(k).alias("id"), url.alias("SourceURL"))


@query(f"""SELECT p_partkey, coalesce(nullif(pid, ''), nullif(id, 0)::VARCHAR, nullif(regexp_extract(url, 'productID=(\\d+)', 1), '')) AS page, nullif(pid, '') AS sync, coalesce(nullif(pid, ''), nullif(id, 0)::VARCHAR, '?') AS probe,
  coalesce(nullif(pid, ''), nullif(id, 0)::VARCHAR) AS "import" FROM ({CAMEL})""")
def k1_camel_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profiles that ask for ProductID, down to the number in the URL and the default."""
    own = camel(spark, sf_dir)
    return own.select("p_partkey", *[K.identity(own, n).alias(n) for n in ("page", "sync", "probe", "import")])


@query(f"""SELECT DISTINCT id FROM (SELECT coalesce(nullif(pid, ''), nullif(id, 0)::VARCHAR, nullif(regexp_extract(url, 'productID=(\\d+)', 1), '')) AS id FROM ({CAMEL}) UNION ALL SELECT 'P' || s_suppkey FROM supplier UNION ALL SELECT 'S' || s_suppkey FROM supplier) WHERE id IS NOT NULL""")
def k1_page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of page records and of the keys of an index map, some of which the records have as well."""
    key = F.col("s_suppkey")
    index = table(spark, sf_dir, "supplier").select(F.create_map(F.concat(F.lit("P"), key), F.lit("a"), F.concat(F.lit("S"), key), F.lit("b")).alias("index"))
    return K.page_ids(camel(spark, sf_dir), index)


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'X' || p_partkey WHEN 1 THEN p_brand WHEN 2 THEN 'P' || p_partkey ELSE p_name || '_' || p_partkey END AS key FROM part")
def k3_prepared_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    sku = F.when(key % 4 == 0, F.concat(F.lit('[{"SKU":"X'), key, F.lit('"}]'))).when(key % 4 == 1, F.concat(F.lit('["'), F.col("p_brand"), F.lit('"]'))).when(key % 4 == 2, F.concat(F.lit('"P'), key, F.lit('"'))).otherwise("[]")
    own = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"), sku.alias("sku"))
    return own.select("p_partkey", K.prepared_identity(own, "p_partkey").alias("key"))


@query("""WITH t AS (SELECT p_partkey, trim(CASE WHEN p_partkey % 2 = 0 THEN p_name || ' ' || (10000 + p_partkey) || ' ' || p_type ELSE (10000 + p_partkey) || upper(substr(p_brand, 1, 3)) || p_size END) AS v FROM part)
  SELECT p_partkey, CASE WHEN length(v) > 20 THEN nullif(regexp_extract(v, '\\b(\\d{4,5})\\b', 1), '') WHEN length(regexp_replace(v, '[^a-zA-Z0-9\\-]', '', 'g')) > 4 THEN
    coalesce(nullif(regexp_extract(regexp_replace(v, '[^a-zA-Z0-9\\-]', '', 'g'), '^(\\d{4,5})[A-Z]+', 1), ''), regexp_replace(v, '[^a-zA-Z0-9\\-]', '', 'g')) END AS number FROM t""")
def k4_product_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    text = F.when(key % 2 == 0, F.concat_ws(" ", "p_name", key + 10000, "p_type")).otherwise(F.concat(key + 10000, F.upper(F.substring("p_brand", 1, 3)), "p_size"))
    own = table(spark, sf_dir, "part").select("p_partkey", text.alias("sku"))
    return own.select("p_partkey", K.product_number(own).alias("number"))


@query("""SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'A-' || (10000 + p_partkey) WHEN 1 THEN (10000 + p_partkey % 5000)::VARCHAR WHEN 2 THEN 'B' || (10000 + p_partkey) WHEN 3 THEN 'C' || (10000 + p_partkey) WHEN 4 THEN 'D' || (10000 + p_partkey) WHEN 5 THEN 'E' || (10000 + p_partkey)
  WHEN 6 THEN 'F' || p_partkey ELSE 'G' || p_partkey END AS number FROM part""")
def k4_number_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each field in turn holds the number, as text, list or record; the ones before it are too short or hold none."""
    key = F.col("p_partkey")
    at = lambda i, value: F.when(key % 8 == i, value).when(key % 8 > i, F.lit("x")).otherwise(F.lit(None))
    n = key + 10000
    own = table(spark, sf_dir, "part").select(
        "p_partkey", at(0, F.concat(F.lit("A-"), n)).alias("number"), at(1, F.concat(F.lit('["'), key % 5000 + 10000, F.lit('XL"]'))).alias("numbers"), at(2, F.concat(F.lit(" B"), n)).alias("product_number"), at(3, F.concat(F.lit("C#"), n)).alias("ProductNumber"),
        at(4, F.concat(F.lit('{"SKU":"D'), n, F.lit('"}'))).alias("sku"), at(5, F.concat(F.lit("E"), n)).alias("product_id"),
        F.when(key % 8 == 6, F.concat(F.lit('{"Number":"F'), key, F.lit('"}'))).when(key % 8 == 7, F.concat(F.lit('{"Number":"","Numbers":["G'), key, F.lit('","H"]}'))).alias("raw_data"),
    )
    return own.select("p_partkey", K.product_number(own).alias("number"))


@query("SELECT page_id, CASE WHEN regexp_matches(url, '(?i)[?&]page=') THEN regexp_extract(url, '(?i)[?&]page=([^&#]*)', 1) END AS page FROM pages")
def k5_id_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", K.id_from_url(F.col("url"), "page").alias("page"))


@query("""SELECT event_id, md5('{"event_id": ' || event_id || ', "user_id": ' || user_id || '}') AS fp FROM events""")
def k6_content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of each event as a record with shuffled keys and a scrape date, which do not count."""
    doc = F.to_json(F.struct("user_id", F.col("ts").cast("string").alias("scraped_date"), "event_id"))
    return table(spark, sf_dir, "events").select("event_id", K.content_fingerprint(doc).alias("fp"))


@query("SELECT doc_id, md5(text) AS digest FROM documents")
def k7_file_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", K.file_fingerprint(F.col("text").cast("binary")).alias("digest"))


@query(f"""SELECT p_partkey FROM ({KEYS}) WHERE nullif(product_id, 0) IS NOT NULL AND nullif("productId", '') IS NOT NULL""")
def v5_valid_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.valid_products(drifting(spark, sf_dir), ("product_id", "productId")).select("p_partkey")


@query("SELECT s_suppkey FROM supplier WHERE lower(s_name) LIKE '%r#00000001%'")
def v6_filter_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.filter_supplier(table(spark, sf_dir, "supplier"), "R#00000001", "s_name").select("s_suppkey")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '/media/' || p_partkey WHEN p_size % 2 = 0 THEN '/media/' || p_name WHEN p_size % 5 = 0 THEN '/media/x' || p_size END AS url FROM part""")
def v7_first_media_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    main = F.when(key % 3 == 0, F.concat(F.lit("/media/"), key)).otherwise("none")
    first = F.array(F.lit("a"), F.when(size % 2 == 0, F.concat(F.lit("/media/"), "p_name")))
    second = F.when(size % 5 == 0, F.array(F.concat(F.lit("/media/x"), size)))
    return table(spark, sf_dir, "part").select("p_partkey", V.first_media_url(main, [first, second]).alias("url"))


@query("SELECT p_partkey, regexp_matches(trim(CASE p_partkey % 4 WHEN 0 THEN '$' || p_size || '.88' WHEN 1 THEN ' ' || p_size || ' ' WHEN 2 THEN p_size || '.' ELSE p_brand END), '^\\$?\\d+(\\.\\d+)?$') AS ok FROM part")
def v8_is_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    text = F.when(key % 4 == 0, F.concat(F.lit("$"), size, F.lit(".88"))).when(key % 4 == 1, F.concat(F.lit(" "), size, F.lit(" "))).when(key % 4 == 2, F.concat(size, F.lit("."))).otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", C.is_price(text).alias("ok"))


@query("SELECT page_id AS id, nullif(regexp_replace(url, '^https://.*', ''), '') AS url FROM pages WHERE page_id <> 0 AND url NOT LIKE 'https://%'")
def v9_has_link_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.regexp_replace("url", "^https://.*", "").alias("url"))
    return V.has_link_fields(own)
