"""Synchronisation with a store: filters against known ids, classification by date, two-key matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.columns import category_slug, has_offset, instant
from skeinwork.operators.batching import with_rank
from skeinwork.operators.dedup import dedup_first


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("_key")).dropna().distinct()


def _without(df: DataFrame, known: DataFrame, key: str, known_key: str | None = None) -> DataFrame:
    keys = _keys(known, known_key or key)
    return df.join(keys, F.col(key) == F.col("_key"), "left_anti")


def filter_mode(df: DataFrame, done: DataFrame, mode: str, key: str = "id") -> DataFrame:
    """New rows only, unless the mode is `scrape`, which takes all."""
    return df if mode == "scrape" else _without(df, done, key)


def new_links(df: DataFrame, collected: DataFrame, scraped: DataFrame, new_only: bool = True, key: str = "id") -> DataFrame:
    """Links not collected yet and, if new_only, not scraped either."""
    out = _without(df, collected, key)
    return _without(out, scraped, key) if new_only else out


def store_ids(store: DataFrame) -> DataFrame:
    """(id) the store's product ids and skus."""
    return store.select(F.col("product_id").alias("id")).union(store.select("sku")).filter(F.col("id") != "").distinct()


def filter_existing(df: DataFrame, store: DataFrame, mode: str, key: str = "id") -> DataFrame:
    """Mode `scrape`: rows whose id is neither a product id nor a sku of the store; other modes: all."""
    return _without(df, store_ids(store), key, "id") if mode == "scrape" else df


def sync_action(key: Column, date: Column, found: Column, known: Column) -> Column:
    """error without key or date; create if the store lacks it; update if the store has no date, a date can't be
    compared (no timestamp, or only one has an offset) or is newer; else skip."""
    ours, theirs = instant(date), instant(known)
    odd = ours.isNull() | theirs.isNull() | (has_offset(date) != has_offset(known))
    return (
        F.when(key.isNull() | (key == "") | date.isNull() | (date == ""), "error")
        .when(~F.coalesce(found, F.lit(False)), "create")
        .when(known.isNull() | (known == "") | odd | (ours > theirs), "update")
        .otherwise("skip")
    )


def _with_store(df: DataFrame, store: DataFrame, key: str, date: str) -> DataFrame:
    known = store.select(F.col(key).alias("_key"), F.col(date).alias("_known")).filter(F.col("_key").isNotNull()).groupBy("_key").agg(F.max("_known").alias("_known"))
    return df.join(known.withColumn("_found", F.lit(True)), F.col(key) == F.col("_key"), "left")


def sync_classify(df: DataFrame, store: DataFrame, key: str = "product_id", date: str = "scraped_date") -> DataFrame:
    """df with action: error, create, update or skip, by instants."""
    joined = _with_store(df, store, key, date)
    return joined.withColumn("action", sync_action(F.col(key), F.col(date), F.col("_found"), F.col("_known"))).select(*df.columns, "action")


def sync_skip_lexical(df: DataFrame, store: DataFrame, key: str = "product_id", date: str = "scraped_date") -> DataFrame:
    """df with skip: both dates are there and ours is not greater, compared as texts."""
    joined = _with_store(df, store, key, date)
    both = (F.coalesce(date, F.lit("")) != "") & (F.coalesce("_known", F.lit("")) != "")
    return joined.withColumn("skip", both & (F.col(date) <= F.col("_known"))).select(*df.columns, "skip")


def link_sync(df: DataFrame, scraped: DataFrame, store: DataFrame, mode: str, key: str = "id", date: str = "last_modified") -> DataFrame:
    """Links to process: never those scraped; `override` takes all others, `sync` those newer than the store's date
    (as texts, if both are there) or absent from it, other modes those absent from it."""
    own = _without(df, scraped, key)
    if mode == "override":
        return own
    joined = _with_store(own, store, key, date)
    absent = F.col("_found").isNull()
    if mode == "sync":
        both = (F.coalesce(date, F.lit("")) != "") & (F.coalesce("_known", F.lit("")) != "")
        absent = F.when(both, F.col(date) > F.col("_known")).otherwise(absent)
    return joined.filter(absent).select(df.columns)


def match_existing(df: DataFrame, store: DataFrame, key: str = "product_id", sku: str = "sku") -> DataFrame:
    """df with wp_id of the store's row with the same product id, else of that with the same sku (smallest wp_id)."""
    by_key = store.filter(F.col("product_id").isNotNull()).groupBy(F.col("product_id").alias("_k")).agg(F.min("wp_id").alias("_by_key"))
    by_sku = store.filter(F.col("sku").isNotNull()).groupBy(F.col("sku").alias("_s")).agg(F.min("wp_id").alias("_by_sku"))
    joined = df.join(by_key, F.col(key) == F.col("_k"), "left").join(by_sku, F.col(sku) == F.col("_s"), "left")
    return joined.select(*df.columns, F.coalesce("_by_key", "_by_sku").alias("wp_id"))


def enrich(df: DataFrame, pages: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """df with the pages' fields where the key matches; a field of the page wins, rows without a key stay as they are.
    pages hold one row per key."""
    own = pages.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_{f}") for f in fields])
    joined = df.join(own, F.col(key) == F.col("_key"), "left")
    merged = [F.coalesce(f"_{f}", f).alias(f) if f in df.columns else F.col(f"_{f}").alias(f) for f in fields]
    return joined.select(*[c for c in df.columns if c not in fields], *merged)


def retry_backlog(failed: DataFrame, scraped: DataFrame, links: DataFrame, key: str = "id") -> DataFrame:
    """Links of the failed ids that have not been scraped since."""
    left = _without(failed.select(key).dropna().distinct(), scraped, key)
    return links.join(left, key, "left_semi")


def upsert_categories(names: DataFrame, dim: DataFrame, name: str = "name") -> DataFrame:
    """(id, name, slug) of every category in names: ids of dim where the slug is known, new ones behind its largest.

    Only the names that are new are numbered, in ranges of their slugs.
    """
    wanted = dedup_first(names.select(F.col(name).alias("name")).filter(F.col("name") != "").withColumn("slug", category_slug(F.col("name"))), ["slug"], "name")
    known = wanted.join(dim.select("slug", "id"), "slug").select("id", "name", "slug")
    new = wanted.join(dim.select("slug"), "slug", "left_anti")
    top = dim.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    numbered = with_rank(new, ["slug"]).crossJoin(F.broadcast(top)).withColumn("id", F.col("top") + F.col("rank"))
    return known.unionByName(numbered.select(F.col("id").cast("long"), "name", "slug"))


def import_action(df: DataFrame, store: DataFrame, valid: Column, key: str = "product_id", sku: str = "sku") -> DataFrame:
    """match_existing with action: error for invalid rows, updated for matched ones, else created."""
    matched = match_existing(df, store, key, sku)
    return matched.withColumn("action", F.when(~F.coalesce(valid, F.lit(False)), "error").when(F.col("wp_id").isNotNull(), "updated").otherwise("created"))


def id_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(id, kind): both, left or right, for every id of two tables."""
    x, y = _keys(a, key).withColumn("l", F.lit(1)), _keys(b, key).withColumn("r", F.lit(1))
    kind = F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), "both").when(F.col("l").isNotNull(), "left").otherwise("right")
    return x.join(y, "_key", "full_outer").select(F.col("_key").alias("id"), kind.alias("kind"))
