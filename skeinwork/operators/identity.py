"""Identity of records whose keys drift, and fingerprints of their content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.columns import first_given, first_truthy, query_argument
from skeinwork.functions.jsonlines import canonical_json

# The key fields in the order in which each consumer asks for them.
PROFILES = {
    "batch": ("product_id", "productId", "id"),
    "analyser": ("product_id",),
    "links": ("id", "productId", "ProductID"),
    "details": ("productId", "ProductID", "id"),
    "page": ("ProductID", "id"),
    "import": ("ProductID", "product_id", "id"),
    "sync": ("ProductID",),
    "probe": ("product_id", "ProductID", "id"),
    "prepare": ("product_id", "ProductID", "id"),
}
NUMBER_FIELDS = ("number", "numbers", "product_number", "ProductNumber", "sku", "SKU", "product_id", "ProductID")


def identity(df: DataFrame, profile: str, url: str = "SourceURL") -> Column:
    """The record's id as text by a profile; null if no key is truthy.

    `dedup` asks for the first key that is not null (an empty text counts) and only then for a truthy URL;
    `page` falls back to the number in the URL; `probe` to `?`; `analyser` keeps numbers and texts apart by
    a mark of the kind, as 5 and "5" are different there.
    """
    if profile == "dedup":
        return F.coalesce(first_given(df, ("id", "productId", "ProductID")), first_truthy(df, ("url", "URL")))
    own = first_truthy(df, PROFILES[profile])
    if profile == "page" and url in df.columns:
        digits = F.regexp_extract(F.col(url), r"productID=(\d+)", 1)
        return F.coalesce(own, F.when(digits != "", digits))
    if profile == "probe":
        return F.coalesce(own, F.lit("?"))
    if profile == "analyser" and "product_id" in df.columns:
        kind = dict(df.dtypes)["product_id"]
        return F.when(own.isNotNull(), F.concat(F.lit("s:" if kind == "string" else "n:"), own))
    return own


def page_ids(df: DataFrame, index: DataFrame | None = None, keys: str = "index") -> DataFrame:
    """(id): the distinct ids of records by the page profile, and the keys of index maps (column `keys`), if given."""
    own = df.select(identity(df, "page").alias("id"))
    if index is not None:
        own = own.union(index.select(F.explode(F.map_keys(keys)).alias("id")).select(F.col("id").cast("string")))
    return own.filter("id IS NOT NULL AND id <> ''").distinct()


def prepared_identity(df: DataFrame, seq: str, fields: tuple[str, ...] = ("sku", "SKU")) -> Column:
    """Keys of `prepare`; else the sku (of a list its first element, or that element's SKU); else the name with the
    row's place, which never repeats. Sku fields are JSON text, since they are a text, a list or records."""
    skus = [sku_text(F.col(f)) for f in fields if f in df.columns]
    named = F.concat_ws("_", first_truthy(df, ("name", "Name")), F.col(seq).cast("string"))
    return F.coalesce(first_truthy(df, PROFILES["prepare"]), *skus, named)


def sku_text(raw: Column) -> Column:
    """The sku in a JSON value: a text or number itself, of a list its first element or that one's SKU, of a record
    its SKU; null if that is empty. Text that is no JSON stands for itself."""
    head = F.trim(raw)
    first = F.get_json_object(raw, "$[0]")
    listed = F.coalesce(F.get_json_object(raw, "$[0].SKU"), F.when(~first.startswith("{"), first))
    value = F.when(head.startswith("["), listed).when(head.startswith("{"), F.get_json_object(raw, "$.SKU")).otherwise(F.regexp_replace(head, '^"|"$', ""))
    return F.when(~value.isin("", "0", "null", "false"), value)


def number_in(value: Column) -> Column:
    """The product number in a text: of over 20 characters the first word of 4 or 5 digits; else the text without
    other signs, if longer than 4, and of that the 4 or 5 digits before capitals, if it starts so."""
    text = F.trim(value)
    word = F.regexp_extract(text, r"\b(\d{4,5})\b", 1)
    plain = F.regexp_replace(text, r"[^a-zA-Z0-9\-]", "")
    base = F.regexp_extract(plain, r"^(\d{4,5})[A-Z]+", 1)
    short = F.when(F.length(plain) > 4, F.when(base != "", base).otherwise(plain))
    return F.when(F.length(text) > 20, F.when(word != "", word)).otherwise(short)


def product_number(df: DataFrame, fields: tuple[str, ...] = NUMBER_FIELDS, raw: str = "raw_data") -> Column:
    """The number of the first field that has one, then of the raw record's Number or first of Numbers."""
    found = [number_in(sku_text(F.col(f).cast("string"))) for f in fields if f in df.columns]
    if raw in df.columns:
        number, numbers = F.get_json_object(raw, "$.Number"), F.get_json_object(raw, "$.Numbers[0]")
        found += [F.when(~number.isin("", "0", "false", "null"), number), numbers]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def id_from_url(url: Column, name: str = "productid") -> Column:
    return query_argument(url, name)


def content_fingerprint(doc: Column, exclude: tuple[str, ...] = ("extraction_time", "scraped_date", "SourceURL")) -> Column:
    """md5 of a JSON record with sorted keys, without the keys that change on every run."""
    return F.md5(canonical_json(exclude)(doc).cast("binary"))


def file_fingerprint(content: Column) -> Column:
    return F.md5(content)
