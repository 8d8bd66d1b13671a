"""Projection queries: records are built from part and lineitem, as JSON or as nested columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.functions import columns as C
from skeinwork.operators import project as P
from skeinwork.plans.registry import query
from skeinwork.sources.storage import table

BASE = "https://media.example.com/"


def api_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, doc): an API record per part; every third has no supplier, every fifth no attributes."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    tier = lambda price: F.struct(F.struct(F.lit(1).alias("From"), F.lit(49).alias("To")).alias("Quantity"), price.alias("Price"), F.lit("USD").alias("CurrencyCode"))
    supplier = F.struct(F.concat(F.lit("S"), key % 10).alias("Name"), (key % 10).alias("Id"), F.struct((key % 5).cast("int").alias("Rating")).alias("Rating"), F.struct(F.lit("555").alias("Primary")).alias("Phone"), F.array(F.lit("w")).alias("Websites"))
    colors = F.struct(F.struct(F.array(F.struct(F.lit("B").alias("Code"), F.lit("Blue").alias("Name"))).alias("Values")).alias("Colors"))
    doc = F.to_json(F.struct(
        key.alias("Id"), F.col("p_name").alias("Name"), F.when(key % 4 != 0, F.col("p_brand")).alias("SKU"), F.col("p_type").alias("Description"), F.concat(F.lit("/img/"), key).alias("ImageUrl"), key.cast("string").alias("Number"),
        F.when(key % 3 != 0, supplier).alias("Supplier"), tier(F.round("p_retailprice", 2)).alias("LowestPrice"), tier(F.round(F.col("p_retailprice") * 2, 2)).alias("HighestPrice"), F.array(tier(F.round("p_retailprice", 2))).alias("Prices"),
        F.array(F.struct(F.lit("Std").alias("Name"), (F.col("p_size") % 7).alias("Days"))).alias("ProductionTime"), F.lit("US").alias("MinimumOrder"), F.when(key % 5 != 0, colors).alias("Attributes"),
        F.struct(F.struct(F.array(F.struct(F.lit("Laser").alias("Name"))).alias("Values")).alias("Methods")).alias("Imprinting"), F.struct(F.lit("lb").alias("WeightUnit"), F.col("p_size").alias("WeightPerPackage")).alias("Shipping"),
        F.array(F.struct(F.lit("v").alias("Number"), F.lit("http://a/b").alias("ImageUrl"))).alias("Variants"), F.array(F.lit("x.jpg"), F.lit("/y.jpg")).alias("Images"),
    ))
    return p.select("p_partkey", "p_size", "p_retailprice", doc.alias("doc"))


@query("""SELECT p_partkey::VARCHAR AS product_id, p_name AS name, CASE WHEN p_partkey % 4 <> 0 THEN p_brand ELSE 'N/A' END AS sku, p_type AS description, '' AS short_description, 'https://media.example.com/img/' || p_partkey AS image_url,
  CASE WHEN p_partkey % 3 <> 0 THEN 'S' || (p_partkey % 10) ELSE '' END AS supplier_name, CASE WHEN p_partkey % 3 <> 0 THEN (p_partkey % 5)::INT END AS supplier_rating, CASE WHEN p_partkey % 3 <> 0 THEN '555' ELSE '' END AS phone,
  CASE WHEN p_partkey % 3 <> 0 THEN 1 ELSE 0 END AS websites, round(p_retailprice, 2) AS base_price, round(p_retailprice * 2, 2) AS discount_price, 'USD' AS currency, p_size % 7 AS days, '' AS maximum_order,
  CASE WHEN p_partkey % 5 <> 0 THEN 'Blue' END AS color, 'Laser' AS method, 'lb' AS weight_unit, p_size::VARCHAR AS weight, 'http://a/b' AS variant_image, 'https://media.example.com/x.jpg,https://media.example.com/y.jpg' AS images FROM part""")
def p1_product_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 to P6: API records as product records, flattened to compare."""
    r = P.product_record(api_records(spark, sf_dir), "doc", BASE)
    return r.select(
        "product_id", "name", "sku", "description", "short_description", "image_url", "supplier_info.supplier_name", "supplier_info.supplier_rating", "supplier_info.phone", F.size("supplier_info.websites").alias("websites"),
        F.col("pricing_info.base_price.Price").alias("base_price"), F.col("pricing_info.discount_price.Price").alias("discount_price"), "pricing_info.currency", F.col("production_info.production_time")[0]["Days"].alias("days"), "production_info.maximum_order",
        F.try_element_at("attributes.colors", F.lit(1))["Name"].alias("color"), F.col("imprinting.imprinting_methods")[0]["Name"].alias("method"), "shipping.weight_unit", F.col("shipping.weight_per_package").alias("weight"),
        F.col("variants")[0]["image_url"].alias("variant_image"), F.array_join(F.col("images.url"), ",").alias("images"),
    )


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, replace(lower(p_type), ' ', '-') AS category, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'https://media.example.com/' || trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') || '-' || p_partkey || '/7' END AS url FROM part")
def p7_slugs_and_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7, P8: slugs, and URLs of products that have a number."""
    number = F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", C.slug(F.col("p_name")).alias("slug"), C.category_slug(F.col("p_type")).alias("category"), P.derived_url(number, F.col("p_name"), BASE, F.lit("7")).alias("url"))


@query("SELECT DISTINCT p_partkey, s.l_suppkey::VARCHAR AS id, 'https://media.example.com/i' || s.l_suppkey AS image_url, 'https://shop.example.com/' || s.l_suppkey AS product_url FROM part JOIN lineitem s ON l_partkey = p_partkey")
def p9_related_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.struct(F.col("l_suppkey").cast("string").alias("Id"), F.lit("n").alias("Name"), F.concat(F.lit("/i"), "l_suppkey").alias("ImageUrl"))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.collect_set(one).alias("r"))
    found = rows.join(table(spark, sf_dir, "part").select("p_partkey"), "p_partkey").select("p_partkey", F.explode(P.related_products(F.col("r"), BASE, "https://shop.example.com/{id}")).alias("x"))
    return found.select("p_partkey", "x.id", "x.image_url", "x.product_url")


def sectioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sectioned records of the even parts, flat ones of the others."""
    p, key = table(spark, sf_dir, "part"), F.col("p_partkey")
    nested = F.to_json(F.struct(F.struct(key.alias("id"), F.col("p_name").alias("name"), F.lit("f").alias("featured_image")).alias("product"), F.struct(F.col("p_size").alias("w")).alias("pricing"), F.struct(F.col("p_size").alias("weight")).alias("specifications"), F.array(F.lit("t")).alias("themes"), F.lit("top").alias("name")))
    flat = F.to_json(F.struct(key.alias("product_id"), F.col("p_name").alias("name"), F.struct(F.col("p_size").alias("w")).alias("pricing_info"), F.lit("i").alias("image_url")))
    return p.select("p_partkey", F.when(key % 2 == 0, nested).otherwise(flat).alias("doc"))


@query("""SELECT p_partkey::VARCHAR AS product_id, p_name AS name, CASE p_partkey % 2 WHEN 0 THEN 'd' || p_size ELSE '' END AS description, 'sd' AS short_description, p_brand AS sku, CASE p_partkey % 2 WHEN 0 THEN 'N' || p_partkey ELSE '' END AS product_number,
  CASE p_partkey % 2 WHEN 0 THEN 'f' ELSE 'i' END AS image_url, 'u' || p_partkey AS product_url, '{"w":' || p_size || '}' AS pricing_info, CASE p_partkey % 2 WHEN 0 THEN '{"a":1}' ELSE '{}' END AS attributes, CASE p_partkey % 2 WHEN 0 THEN '{"i":2}' ELSE '{"i":3}' END AS imprinting,
  '{"s":"' || p_brand || '"}' AS supplier_info, CASE p_partkey % 2 WHEN 0 THEN '{"p":4}' ELSE '{"p":5}' END AS production_info, CASE p_partkey % 2 WHEN 0 THEN '{"h":6}' ELSE '{}' END AS shipping, CASE p_partkey % 2 WHEN 0 THEN '{"weight":' || p_size || '}' ELSE '{}' END AS specifications,
  CASE p_partkey % 2 WHEN 0 THEN '["v"]' ELSE '[]' END AS variants, '[]' AS warnings, CASE p_partkey % 2 WHEN 0 THEN '["s"]' ELSE '[]' END AS services, CASE p_partkey % 2 WHEN 0 THEN '[]' ELSE '["im"]' END AS images, '[]' AS virtual_samples, '{}' AS raw_data,
  CASE p_partkey % 2 WHEN 0 THEN '7' ELSE '0' END AS extraction_time, CASE p_partkey % 2 WHEN 0 THEN '' ELSE 'api' END AS extraction_method, 'day' AS scraped_date, '[]' AS related_products, CASE p_partkey % 2 WHEN 0 THEN '["c"]' ELSE '[]' END AS categories,
  CASE p_partkey % 2 WHEN 0 THEN '["t"]' ELSE '[]' END AS themes, '{}' AS color_images, CASE p_partkey % 2 WHEN 0 THEN 'art' || p_partkey END AS product_art_url, CASE p_partkey % 2 WHEN 0 THEN '{"f":8}' END AS fpd_config, CASE p_partkey % 2 WHEN 1 THEN '{"m":9}' END AS meta FROM part""")
def p10_flatten_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All outputs, of sectioned records and of flat ones, each with some of the fields."""
    p, one = table(spark, sf_dir, "part"), lambda name, value: F.struct((F.lit(value) if isinstance(value, int) else value).alias(name))
    key, size = F.col("p_partkey"), F.col("p_size")
    product = F.struct(
        key.alias("id"), F.col("p_name").alias("name"), F.concat(F.lit("d"), size).alias("description"), F.lit("sd").alias("short_description"), F.col("p_brand").alias("sku"), F.concat(F.lit("N"), key).alias("product_number"), F.lit("f").alias("featured_image"), F.concat(F.lit("u"), key).alias("product_url"),
    )
    lists = lambda *names: [F.array(F.lit(v)).alias(n) for n, v in names]
    nested = F.struct(
        product.alias("product"), F.lit("top").alias("name"), F.lit("flat").alias("description"), one("w", size).alias("pricing"), one("a", 1).alias("attributes"), one("i", 2).alias("imprinting"), one("s", F.col("p_brand")).alias("supplier"), one("p", 4).alias("production"), one("h", 6).alias("shipping"),
        one("weight", size).alias("specifications"), one("x", 0).alias("pricing_info"), *lists(("variants", "v"), ("services", "s"), ("categories", "c"), ("themes", "t")), F.lit(7).alias("extraction_time"), F.lit("day").alias("scraped_date"),
        one("url", F.concat(F.lit("art"), key)).alias("art_template"), one("f", 8).alias("fpd_config"),
    )
    flat = F.struct(
        key.alias("product_id"), F.col("p_name").alias("name"), F.lit("sd").alias("short_description"), F.col("p_brand").alias("sku"), F.lit("i").alias("image_url"), F.concat(F.lit("u"), key).alias("product_url"), one("w", size).alias("pricing_info"), one("i", 3).alias("imprinting"), one("s", F.col("p_brand")).alias("supplier_info"),
        one("p", 5).alias("production_info"), *lists(("images", "im")), F.lit("api").alias("extraction_method"), F.lit("day").alias("scraped_date"), one("m", 9).alias("meta"),
    )
    return P.flatten_sections(p.select(F.when(key % 2 == 0, F.to_json(nested)).otherwise(F.to_json(flat)).alias("doc")), "doc")


@query("""SELECT p_partkey, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN '{"w":' || p_size || '}' END AS pricing, CASE WHEN p_partkey % 2 = 0 THEN p_size::VARCHAR END AS weight FROM part""")
def p11_overlay_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("product")
    return P.overlay_sections(sectioned(spark, sf_dir), "doc").select("p_partkey", F.try_element_at(p, F.lit("name")).alias("name"), F.try_element_at(p, F.lit("pricing")).alias("pricing"), F.try_element_at(p, F.lit("weight")).alias("weight"))


@query("""SELECT p_name AS title, '' AS content, 'publish' AS status, p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS sku, '{"size":' || p_size || '}' AS shipping, 4 + (p_partkey % 4 <> 0)::INT + 1 AS keys FROM part""")
def p12_store_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    own = table(spark, sf_dir, "part").select(key.alias("ProductID"), F.col("p_name").alias("Name"), F.when(key % 4 != 0, F.col("p_brand")).otherwise("").alias("SKU"), F.struct(F.col("p_size").alias("size")).alias("Shipping"), F.array().cast("array<string>").alias("Variants"))
    m = F.col("meta")
    return P.store_payload(own).select("title", "content", "status", m["external_product_id"].alias("id"), F.try_element_at(m, F.lit("_sku")).alias("sku"), m["shipping_info"].alias("shipping"), F.size(m).alias("keys"))


@query("""SELECT 'product_id' || p_partkey AS "ProductID", 'name' || p_partkey AS "Name", 'sku' || p_partkey AS "SKU", 'description' || p_partkey AS "Description", 'short_description' || p_partkey AS "ShortDescription", 'image_url' || p_partkey AS "ImageURL",
  'product_url' || p_partkey AS "ProductURL", 'supplier_info' || p_partkey AS "SupplierInfo", 'pricing_info' || p_partkey AS "PricingTable", 'production_info' || p_partkey AS "ProductionInfo", 'attributes' || p_partkey AS "Attributes", 'imprinting' || p_partkey AS "Imprint",
  'shipping' || p_partkey AS "Shipping", 'variants' || p_partkey AS "Variants", 'warnings' || p_partkey AS "Warnings", 'services' || p_partkey AS "Services", 'images' || p_partkey AS "Images", 'extraction_time' || p_partkey AS "ExtractionTime",
  'extraction_method' || p_partkey AS "ExtractionMethod", 'scraped_date' || p_partkey AS "ScrapedDate" FROM part""")
def p13_to_pascal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All renames; each field holds its own name and the part's key, and one more field is left out."""
    names = "scraped_date extraction_method extraction_time images services warnings variants shipping imprinting attributes production_info pricing_info supplier_info product_url image_url short_description description sku name product_id other".split()
    return P.to_pascal(table(spark, sf_dir, "part").select(*[F.concat(F.lit(n), "p_partkey").alias(n) for n in names]))


@query("SELECT p_partkey, CASE WHEN p_size % 3 > 1 THEN 'variable' WHEN p_partkey % 2 = 0 THEN 'external' ELSE 'simple' END AS type FROM part")
def p14_product_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = F.slice(F.array(F.lit("a"), F.lit("b")), 1, F.col("p_size") % 3)
    return table(spark, sf_dir, "part").select("p_partkey", P.product_type(variants, F.when(F.col("p_partkey") % 2 == 0, "u").otherwise("")).alias("type"))


@query("""WITH i AS (SELECT o_custkey, list(o_orderkey::VARCHAR ORDER BY o_orderkey)[1:10] AS l FROM orders GROUP BY 1) SELECT o_custkey, l[1] AS featured, array_to_string(l[2:10], ',') AS gallery FROM i""")
def p15_select_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as images of their customer: the first is the main one, the others variants."""
    keys = F.transform(F.sort_array(F.collect_list("o_orderkey")), lambda x: x.cast("string"))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(keys.alias("k"))
    images = P.select_images(F.col("k")[0], F.slice("k", F.lit(2), F.size("k")), F.lit(None).cast("array<string>"))
    return rows.select("o_custkey", images.alias("i")).select("o_custkey", "i.featured", "i.gallery")


@query("SELECT page_id, pos, url || CASE WHEN arg = '' THEN '' WHEN contains(url, '?') THEN '&' || arg ELSE '?' || arg END AS variant FROM pages, (VALUES (0, ''), " + ", ".join(f"({i}, '{a}')" for i, a in enumerate(C.VARIANT_ARGUMENTS, 1)) + ") v(pos, arg)")
def p16_url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(C.url_variants(F.col("url"))).alias("pos", "variant"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 300 END AS width FROM part")
def p17_default_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = F.when(F.col("p_partkey") % 2 == 0, F.struct(F.col("p_size").alias("width")))
    return table(spark, sf_dir, "part").select("p_partkey", P.default_config(config, F.struct(F.lit(300).alias("width")))["width"].alias("width"))


@query("SELECT nullif(p_partkey, 0)::VARCHAR AS product_id, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS name, p_brand AS sku, NULL::VARCHAR AS image_url FROM part")
def p18_import_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("").alias("Name"), F.col("p_brand").alias("sku"))
    return P.import_record(own)


def price_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part a table for each return flag, with a break for each quantity; one table without breaks in front."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_partkey", "l_returnflag", F.col("l_quantity").cast("int").alias("quantity")).agg(F.max("l_extendedprice").alias("price"))
    breaks = rows.groupBy("l_partkey", "l_returnflag").agg(F.sort_array(F.collect_list(F.struct("quantity", "price", F.lit("R").alias("discount_code")))).alias("breaks"))
    tables = breaks.groupBy("l_partkey").agg(F.sort_array(F.collect_list(F.struct(F.col("l_returnflag").alias("type"), "breaks"))).alias("t"))
    empty = F.array(F.struct(F.lit("").alias("type"), F.array().cast("array<struct<quantity:int,price:double,discount_code:string>>").alias("breaks")))
    return tables.select("l_partkey", F.concat(empty, "t").alias("tables"))


TIERS = "SELECT l_partkey, l_returnflag AS type, l_quantity::INT AS quantity, max(l_extendedprice) AS price, 'R' AS discount_code FROM lineitem GROUP BY 1, 2, 3"


@query(f"SELECT * FROM ({TIERS}) UNION ALL SELECT DISTINCT l_partkey, 'Default', NULL::INT, NULL::DOUBLE, NULL FROM lineitem")
def p19_price_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.price_tiers(price_tables(spark, sf_dir), ["l_partkey"], "tables").select("l_partkey", "type", "quantity", "price", "discount_code")


@query(f"SELECT l_partkey, type, quantity, price FROM ({TIERS}) WHERE l_partkey % 3 = 0 UNION ALL SELECT l_partkey, 'variant_v', quantity, price FROM ({TIERS}) WHERE l_partkey % 3 = 0 AND l_partkey % 2 = 0 UNION ALL SELECT l_partkey, 'variant_v', quantity, price FROM ({TIERS}) WHERE l_partkey % 3 = 1 AND l_partkey % 2 = 0 UNION ALL SELECT l_partkey, type, quantity, price FROM ({TIERS}) WHERE (l_partkey % 3 = 1 AND l_partkey % 2 = 1) OR l_partkey % 3 = 2")
def p20_pricing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the parts has tables of its own, some of all parts but another third those of variants, the rest the page's."""
    key = F.col("l_partkey")
    own = price_tables(spark, sf_dir).select("l_partkey", F.slice("tables", F.lit(2), F.size("tables")).alias("tables"))
    kind = dict(own.dtypes)["tables"]
    tables, none = F.transform("tables", lambda t: F.struct(t["type"].alias("type"), t["breaks"].alias("breaks"))), F.array().cast(kind)
    variants = F.when((key % 2 == 0) & (key % 3 != 2), F.array(F.struct(F.lit("v").alias("number"), tables.alias("tables"))))
    chosen = P.pricing_sources(F.when(key % 3 == 0, tables).otherwise(none), variants, tables, F.lit(None).cast(kind)[0])
    flat = own.select("l_partkey", chosen.alias("tables"))
    return P.price_tiers(flat, ["l_partkey"], "tables").select("l_partkey", "type", "quantity", "price")


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS name, p_retailprice AS price, '' AS description FROM part")
def p21_normal_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    charge = F.struct(F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("").alias("Name"), F.col("p_type").alias("Type"), F.col("p_retailprice").alias("Price"), F.lit(None).cast("string").alias("Description"))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(P.normal_charges(F.array(charge))).alias("c")).select("p_partkey", "c.*")


@query("SELECT o_custkey, coalesce(nullif(p, '5-LOW'), 'Unnamed') AS name, arg_max(o_orderkey, o_orderkey) AS last FROM (SELECT *, o_orderpriority AS p FROM orders) GROUP BY 1, 2")
def p22_methods_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as methods named by their priority: of one name the last wins, one priority counts as unnamed."""
    one = F.struct("o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("Name"), F.col("o_orderkey").cast("string").alias("Description"), F.array().cast("array<string>").alias("Charges"))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(one)).alias("m"))
    found = rows.select("o_custkey", F.explode(P.methods_by_name(F.col("m"), "Unnamed")).alias("name", "v"))
    return found.select("o_custkey", "name", F.col("v.description").cast("long").alias("last"))


@query("SELECT p_partkey, p_brand AS brand, CASE WHEN p_size > 25 THEN p_size::VARCHAR END AS size, CASE WHEN p_partkey % 2 = 0 THEN 'a,b' END AS more FROM part")
def p23_truthy_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.when(F.col("p_size") > 25, F.col("p_size")).otherwise(0).alias("size"))
    more = F.create_map(F.lit("more"), F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")))
    m = own.select("p_partkey", P.truthy_map(own, ["brand", "size"], more).alias("m"))
    return m.select("p_partkey", *[F.try_element_at("m", F.lit(k)).alias(k) for k in ("brand", "size", "more")])


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_name END AS value FROM part")
def p24_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.when(F.col("p_partkey") % 3 == 0, F.col("p_type")).when(F.col("p_partkey") % 3 == 1, "")
    return table(spark, sf_dir, "part").select("p_partkey", P.overlay(F.col("p_name"), page).alias("value"))


@query("SELECT event_id, trim(part) AS part FROM (SELECT event_id, unnest(string_split(event_type || ' ,, ' || user_id || ',', ',')) AS part FROM events) WHERE trim(part) <> ''")
def p25_split_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("event_type", F.lit(" ,, "), "user_id", F.lit(","))
    return table(spark, sf_dir, "events").select("event_id", F.explode(C.split_list(text)).alias("part"))
