"""Projections between the catalogue's record shapes. Records come in as JSON text or as nested columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skeinwork.functions.columns import absolute_url, first_truthy, slug, truthy

TIER = "struct<Quantity:struct<From:bigint,To:bigint>,Price:double,Cost:double,DiscountCode:string,CurrencyCode:string,IsQUR:boolean>"
VALUES = "struct<Values:array<struct<Code:string,Name:string,VendorCode:string,SKU:string>>>"
#: The API's record, as far as it is read.
API = f"""struct<Id:string,Name:string,SKU:string,Description:string,ShortDescription:string,ImageUrl:string,Number:string,
Supplier:struct<Name:string,Id:bigint,Rating:struct<Rating:int>,Location:string,AsiNumber:string,Email:string,Phone:struct<Primary:string>,Websites:array<string>>,
LowestPrice:{TIER},HighestPrice:{TIER},Prices:array<{TIER}>,Currency:string,
ProductionTime:array<struct<Name:string,Days:int>>,MinimumOrder:string,MaximumOrder:string,ProductionMethods:array<string>,Origin:array<string>,TradeNames:array<string>,
Category:string,Subcategory:string,Tags:array<string>,Features:array<string>,Attributes:struct<Colors:{VALUES},Sizes:{VALUES},Materials:{VALUES}>,
Imprinting:struct<Methods:{VALUES},Locations:{VALUES},Colors:{VALUES},Services:{VALUES}>,
Shipping:struct<Methods:{VALUES},Time:string,Cost:string,FreeThreshold:string,WeightUnit:string,WeightPerPackage:string,PackageUnit:string,ItemsPerPackage:string,FOBPoints:{VALUES}>,
Variants:array<struct<Number:string,Name:string,ImageUrl:string>>,Images:array<string>,VirtualSampleImages:array<string>,Warnings:array<struct<Name:string,Description:string,Warning:string,Type:string>>,Services:array<struct<Id:string,Name:string,Code:string>>>"""


def parse_api(doc: Column) -> Column:
    """The API's record from JSON text; fields of another type come out null, the record stays."""
    return F.from_json(doc, API.replace("\n", ""))


def _text(c: Column, default: str = "") -> Column:
    return F.coalesce(c.cast("string"), F.lit(default))


def _list(c: Column, kind: str = "array<string>") -> Column:
    return F.coalesce(c, F.array().cast(kind))


def _values(c: Column) -> Column:
    return _list(c["Values"], VALUES[len("struct<Values:") : -1])


def supplier_info(r: Column) -> Column:
    s = r["Supplier"]
    return F.struct(
        _text(s["Name"]).alias("supplier_name"), s["Id"].alias("supplier_id"), s["Rating"]["Rating"].alias("supplier_rating"), _text(s["Location"]).alias("supplier_location"),
        _text(s["AsiNumber"]).alias("asi_number"), _text(s["Email"]).alias("email"), _text(s["Phone"]["Primary"]).alias("phone"), _list(s["Websites"]).alias("websites"),
    )


def pricing_info(r: Column) -> Column:
    """base_price is the lowest price and discount_price the highest, as the feed's consumers expect."""
    return F.struct(r["LowestPrice"].alias("base_price"), r["HighestPrice"].alias("discount_price"), _list(r["Prices"], f"array<{TIER}>").alias("bulk_pricing"), _text(r["Currency"], "USD").alias("currency"))


def production_info(r: Column) -> Column:
    return F.struct(
        _list(r["ProductionTime"], "array<struct<Name:string,Days:int>>").alias("production_time"), _text(r["MinimumOrder"]).alias("minimum_order"), _text(r["MaximumOrder"]).alias("maximum_order"),
        _list(r["ProductionMethods"]).alias("production_methods"), _list(r["Origin"]).alias("origin"), _list(r["TradeNames"]).alias("trade_names"),
    )


def attributes(r: Column) -> Column:
    a = r["Attributes"]
    return F.struct(
        _text(r["Category"]).alias("category"), _text(r["Subcategory"]).alias("subcategory"), _list(r["Tags"]).alias("tags"), _list(r["Features"]).alias("features"),
        _values(a["Colors"]).alias("colors"), _values(a["Sizes"]).alias("sizes"), _values(a["Materials"]).alias("materials"),
    )


def imprinting(r: Column) -> Column:
    i = r["Imprinting"]
    return F.struct(_values(i["Methods"]).alias("imprinting_methods"), _values(i["Locations"]).alias("imprinting_locations"), _values(i["Colors"]).alias("imprinting_colors"), _values(i["Services"]).alias("setup_charges"))


def shipping(r: Column) -> Column:
    s = r["Shipping"]
    names = (("Time", "shipping_time"), ("Cost", "shipping_cost"), ("FreeThreshold", "free_shipping_threshold"), ("WeightUnit", "weight_unit"), ("WeightPerPackage", "weight_per_package"), ("PackageUnit", "package_unit"), ("ItemsPerPackage", "items_per_package"))
    return F.struct(_values(s["Methods"]).alias("shipping_methods"), *[_text(s[a]).alias(b) for a, b in names], _values(s["FOBPoints"]).alias("fob_points"))


def normal_images(urls: Column, base: str, kind: str) -> Column:
    """Texts, or JSON records with url or Url, as records {url, type}; absent ones give an empty list."""
    one = lambda x: F.struct(
        absolute_url(F.when(x.startswith("{"), F.coalesce(F.get_json_object(x, "$.url"), F.get_json_object(x, "$.Url"))).otherwise(x), base).alias("url"),
        F.when(x.startswith("{"), F.get_json_object(x, "$.type")).otherwise(F.lit(kind)).alias("type"),
    )
    return F.transform(_list(urls), one)


def product_record(df: DataFrame, doc: str, base: str) -> DataFrame:
    """df's API records (JSON text) as product records, with the defaults of missing fields."""
    own = df.withColumn("_r", parse_api(F.col(doc)))
    r = F.col("_r")
    variants = F.transform(_list(r["Variants"], "array<struct<Number:string,Name:string,ImageUrl:string>>"), lambda v: v.withField("image_url", absolute_url(v["ImageUrl"], base)))
    return own.select(
        _text(r["Id"]).alias("product_id"), _text(r["Name"], "N/A").alias("name"), _text(r["SKU"], "N/A").alias("sku"), _text(r["Description"]).alias("description"), _text(r["ShortDescription"]).alias("short_description"),
        absolute_url(r["ImageUrl"], base).alias("image_url"), _text(r["Number"]).alias("product_number"), supplier_info(r).alias("supplier_info"), pricing_info(r).alias("pricing_info"), production_info(r).alias("production_info"),
        attributes(r).alias("attributes"), imprinting(r).alias("imprinting"), shipping(r).alias("shipping"), variants.alias("variants"), normal_images(r["Images"], base, "product_image").alias("images"),
        normal_images(r["VirtualSampleImages"], base, "virtual_sample").alias("virtual_samples"), _list(r["Warnings"], "array<struct<Name:string,Description:string,Warning:string,Type:string>>").alias("warnings"),
        _list(r["Services"], "array<struct<Id:string,Name:string,Code:string>>").alias("services"),
    )


def derived_url(number: Column, name: Column, base: str, product_id: Column | None = None) -> Column:
    """base/slug-number, with the id behind it if given; '' without a number."""
    parts = [F.lit(base.rstrip("/") + "/"), slug(name), F.lit("-"), number]
    if product_id is not None:
        parts += [F.lit("/"), product_id]
    return F.when(number.isNull() | (number == ""), "").otherwise(F.concat(*parts))


def related_products(results: Column, base: str, url_template: str) -> Column:
    """Records {id, name, image_url, product_url} of search results {Id, Name, ImageUrl}."""
    return F.transform(results, lambda x: F.struct(
        x["Id"].alias("id"), x["Name"].alias("name"), absolute_url(x["ImageUrl"], base).alias("image_url"), F.replace(F.lit(url_template), F.lit("{id}"), x["Id"]).alias("product_url")
    ))


# Flat name, name in the section `product`.
FLAT = (("product_id", "id"), ("name", "name"), ("description", "description"), ("short_description", "short_description"), ("sku", "sku"), ("product_number", "product_number"), ("image_url", "featured_image"), ("product_url", "product_url"))
# Flat name, section.
SECTIONS = (("pricing_info", "pricing"), ("attributes", "attributes"), ("imprinting", "imprinting"), ("supplier_info", "supplier"), ("production_info", "production"), ("shipping", "shipping"), ("specifications", "specifications"))
# Fields that stay, with what stands for a missing one.
KEPT = (
    ("variants", "[]"), ("warnings", "[]"), ("services", "[]"), ("images", "[]"), ("virtual_samples", "[]"), ("raw_data", "{}"), ("extraction_time", "0"), ("extraction_method", ""), ("scraped_date", ""),
    ("related_products", "[]"), ("categories", "[]"), ("themes", "[]"), ("color_images", "{}"),
)


def _texts(*names: str, **nested: StructType) -> StructType:
    """A schema that takes fields as text; parts that are not scalars stay JSON. Nested ones are taken apart."""
    return StructType([*[StructField(n, StringType()) for n in names], *[StructField(n, t) for n, t in nested.items()]])


def flatten_sections(df: DataFrame, doc: str) -> DataFrame:
    """Sectioned records (JSON text) as flat columns of text; nested parts stay JSON. A section wins over the flat
    field of the same meaning, and flat records keep theirs. A record is parsed once."""
    flat = dict.fromkeys([name for name, _ in (*FLAT, *SECTIONS, *KEPT)] + [section for _, section in SECTIONS] + ["fpd_config", "meta"])
    schema = _texts(*flat, product=_texts(*[inner for _, inner in FLAT]), art_template=_texts("url"))
    own = df.select(F.from_json(doc, schema).alias("r"))
    get = lambda *path: F.col(".".join(f"`{p}`" for p in ("r", *path)))
    fields = [F.coalesce(get("product", inner), get(name), F.lit("")).alias(name) for name, inner in FLAT]
    fields += [F.coalesce(get(section), get(name), F.lit("{}")).alias(name) for name, section in SECTIONS]
    fields += [F.coalesce(get(name), F.lit(default)).alias(name) for name, default in KEPT]
    extra = [get("art_template", "url").alias("product_art_url"), get("fpd_config").alias("fpd_config"), get("meta").alias("meta")]
    return own.select(*fields, *extra)


# The sections that are laid over a product.
OVERLAID = ("pricing", "attributes", "imprinting", "supplier", "production", "shipping", "specifications", "fpd_config", "variants", "virtual_samples", "related_products", "services", "warnings", "categories", "themes")


def overlay_sections(df: DataFrame, doc: str) -> DataFrame:
    """(product map<string,string>): the fields of `product` with the record's sections laid over them, and weight and
    dimensions of the specifications; records whose product is no object stay whole. A record is parsed once, and the
    product and the specifications as parts of it."""
    parsed = f"_{uuid.uuid4().hex}"  # no column of df
    own = df.withColumn(parsed, F.from_json(doc, _texts("product", *OVERLAID)))
    get = lambda name: F.col(f"`{parsed}`.`{name}`")
    product, specs = F.from_json(get("product"), "map<string,string>"), F.from_json(get("specifications"), _texts("weight", "dimensions"))
    sections = F.map_from_arrays(F.array(*[F.lit(s) for s in OVERLAID]), F.array(*[get(s) for s in OVERLAID]))
    parts = F.map_from_arrays(F.array(F.lit("weight"), F.lit("dimensions")), F.array(specs["weight"], specs["dimensions"]))
    given = lambda m: F.map_filter(m, lambda _, v: v.isNotNull())
    keep = lambda m, o: F.map_filter(m, lambda k, _: ~F.map_contains_key(o, k))
    over = F.map_concat(given(sections), given(parts))
    merged = F.map_concat(keep(product, over), over)
    return own.withColumn("product", F.when(get("product").startswith("{"), merged).otherwise(F.from_json(doc, "map<string,string>"))).drop(parsed)


# Key in the store's meta map, field of the record.
PAYLOAD = (
    ("_sku", "SKU"), ("product_url", "ProductURL"), ("supplier_info", "SupplierInfo"), ("production_info", "ProductionInfo"), ("imprinting_info", "Imprint"), ("shipping_info", "Shipping"),
    ("pricing_table", "PricingTable"), ("product_attributes", "Attributes"), ("product_variants", "Variants"), ("product_warnings", "Warnings"), ("product_services", "Services"),
)


def _as_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    nested = kind.typeName() in ("struct", "array", "map")
    value = truthy(F.col(name), kind)
    return F.when(value.isNotNull(), F.to_json(F.col(name))) if nested else value.cast("string")


def store_payload(df: DataFrame) -> DataFrame:
    """title, content, excerpt, status, type and a meta map; nested parts are JSON text, empty ones are left out."""
    has = set(df.columns)
    text = lambda n, d: F.coalesce(F.col(n).cast("string"), F.lit(d)) if n in has else F.lit(d)
    pairs = [("external_product_id", F.col("ProductID").cast("string")), ("extraction_method", text("ExtractionMethod", "api")), ("extraction_time", text("ExtractionTime", "0")), ("scraped_date", text("ScrapedDate", ""))]
    pairs += [(key, _as_text(df, name)) for key, name in PAYLOAD if name in has]
    meta = F.map_filter(F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[v for _, v in pairs])), lambda _, v: v.isNotNull())
    return df.select(text("Name", "Imported Product").alias("title"), text("ShortDescription", "").alias("content"), text("ShortDescription", "").alias("excerpt"), F.lit("publish").alias("status"), F.lit("product").alias("type"), meta.alias("meta"))


# The page-derived name of each field.
PASCAL = (
    ("product_id", "ProductID"), ("name", "Name"), ("sku", "SKU"), ("description", "Description"), ("short_description", "ShortDescription"), ("image_url", "ImageURL"), ("product_url", "ProductURL"), ("supplier_info", "SupplierInfo"),
    ("pricing_info", "PricingTable"), ("production_info", "ProductionInfo"), ("attributes", "Attributes"), ("imprinting", "Imprint"), ("shipping", "Shipping"), ("variants", "Variants"), ("warnings", "Warnings"), ("services", "Services"),
    ("images", "Images"), ("extraction_time", "ExtractionTime"), ("extraction_method", "ExtractionMethod"), ("scraped_date", "ScrapedDate"),
)


def to_pascal(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in PASCAL if a in df.columns])


def product_type(variants: Column, url: Column) -> Column:
    """variable for several variants, else external with a product URL, else simple."""
    return F.when(F.coalesce(F.size(variants), F.lit(0)) > 1, "variable").when(url.isNotNull() & (url != ""), "external").otherwise("simple")


def select_images(main: Column, variants: Column, virtual: Column, most: int = 10) -> Column:
    """struct(featured, gallery): the first of the first `most` images that are not empty, the others comma-joined."""
    every = F.slice(F.filter(F.concat(F.array(main), _list(variants), _list(virtual)), lambda x: x.isNotNull() & (x != "")), 1, most)
    return F.struct(F.try_element_at(every, F.lit(1)).alias("featured"), F.when(F.size(every) > 1, F.array_join(F.slice(every, 2, most), ",")).otherwise("").alias("gallery"))


def default_config(config: Column, default: Column) -> Column:
    return F.coalesce(config, default)


def import_record(df: DataFrame) -> DataFrame:
    """product_id, name, sku and image_url of records in either casing."""
    names = (("product_id", ("ProductID", "product_id", "id")), ("name", ("Name", "name")), ("sku", ("SKU", "sku")), ("image_url", ("ImageURL", "image_url")))
    return df.select(*[first_truthy(df, found).alias(name) for name, found in names])


def price_tiers(df: DataFrame, key: list[str], tables: str) -> DataFrame:
    """One row per price break of tables array<struct<type, breaks array<struct<quantity, price, discount_code>>>>; a
    table without breaks has one row of nulls, a missing type reads Default."""
    t = df.select(*key, F.posexplode(tables).alias("table_no", "t"))
    rows = t.select(*key, "table_no", F.coalesce(F.nullif("t.type", F.lit("")), F.lit("Default")).alias("type"), F.posexplode_outer("t.breaks").alias("break_no", "b"))
    return rows.select(*key, "table_no", "type", "break_no", "b.quantity", "b.price", "b.discount_code")


def pricing_sources(main: Column, variants: Column, page: Column, single: Column) -> Column:
    """The tables of the record and its variants (typed variant_<number>); if none, the page's; if none, the single one."""
    own = F.concat(F.coalesce(main, F.array()), F.flatten(F.transform(F.coalesce(variants, F.array()), lambda v: F.transform(v["tables"], lambda t: F.struct(F.concat(F.lit("variant_"), v["number"]).alias("type"), t["breaks"].alias("breaks"))))))
    return F.coalesce(F.when(F.size(own) > 0, own), F.when(F.size(page) > 0, page), F.when(single.isNotNull(), F.array(single)))


def normal_charges(charges: Column) -> Column:
    return F.transform(charges, lambda c: F.struct(F.coalesce(F.nullif(c["Name"], F.lit("")), c["Type"], F.lit("")).alias("name"), c["Price"].alias("price"), F.coalesce(c["Description"], F.lit("")).alias("description")))


def methods_by_name(methods: Column, default: str) -> Column:
    """Map of name to {description, charges}; unnamed ones share a default name, of one name the last wins."""
    named = lambda m, i: F.struct(
        F.coalesce(F.nullif(m["Name"], F.lit("")), F.lit(default)).alias("k"), i.alias("i"), F.struct(m["Description"].alias("description"), m["Charges"].alias("charges")).alias("v")
    )
    # Sorted by name and place, the last of a name is the one before another name or the end.
    ordered = F.array_sort(F.transform(methods, named))
    beside = F.arrays_zip(ordered, F.slice(ordered, F.lit(2), F.greatest(F.size(ordered), F.lit(0))))
    last = F.filter(beside, lambda x: ~F.coalesce(x["0"]["k"] == x["1"]["k"], F.lit(False)))
    return F.map_from_entries(F.transform(last, lambda x: F.struct(x["0"]["k"], x["0"]["v"])))


def truthy_map(df: DataFrame, names: list[str], more: Column | None = None) -> Column:
    """Map of the named columns that are truthy, as text, and of the entries of a further map<string,array<string>> that
    have values (comma-joined)."""
    own = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[truthy(F.col(n), df.schema[n].dataType).cast("string") for n in names]))
    own = F.map_filter(own, lambda _, v: v.isNotNull())
    if more is None:
        return own
    listed = F.transform_values(F.map_filter(more, lambda k, v: (F.size(v) > 0) & ~F.map_contains_key(own, k)), lambda _, v: F.array_join(v, ","))
    return F.map_concat(own, listed)


def overlay(record: Column, page: Column) -> Column:
    """The page's value where there is one, else the record's."""
    return F.coalesce(F.nullif(page, F.lit("")), record)
