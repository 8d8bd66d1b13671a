"""Duplication, overlap and outcome statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.functions.columns import percent
from skeinwork.operators.batching import prefix_sums, with_place
from skeinwork.sources.storage import materialise

#: Files in one list of a product; a product in more has several lists, which are dealt over several tasks.
SPLIT_FILES = 1000
#: Pairs of files that one cell of the overlap counts, at most, before equal ones are one.
CELL = 4_000_000
#: Rows of a counted table that may be broadcast.
BROADCAST_ROWS = 500_000
#: Products of a file that lie in one set, about; a larger file is cut into several.
SET = 16_384


def _counted(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _files_of(df: DataFrame) -> DataFrame:
    """(product, n) in how many files each product is."""
    return df.filter(F.col("product").isNotNull()).select("file", "product").distinct().groupBy("product").agg(F.count("*").alias("n"))


def _duplication_rate(duplicate: Column, unique: Column) -> Column:
    return F.round(percent(duplicate, unique), 6)


def duplication_summary(df: DataFrame) -> DataFrame:
    """files, rows, unique_products, duplicate_products (in more files than one) and their rate in percent."""
    products = _files_of(df).agg(F.count("*").alias("unique_products"), F.count_if(F.col("n") > 1).alias("duplicate_products"))
    rows = df.agg(F.count_distinct("file").alias("files"), F.count("product").alias("rows"))
    return rows.crossJoin(products).withColumn("duplication_rate", _duplication_rate(F.col("duplicate_products"), F.col("unique_products")))


def duplicate_products(df: DataFrame, size: int = 1000, parts: int | None = None) -> DataFrame:
    """(product, page, files, file_count) of products in several files, most files first, ties by product.

    Files are in order, `size` of them a page (from 0), so no row and no task holds all files of a product in very many.
    """
    pairs = df.filter(F.col("product").isNotNull()).select("file", "product").distinct()
    placed = with_place(pairs, "product", ["file"], parts).withColumn("page", F.floor((F.col("place") - 1) / size))
    pages = materialise(placed.groupBy("product", "page").agg(F.sort_array(F.collect_list("file")).alias("files"), F.max("place").alias("most")), "product-pages")
    counts = pages.groupBy("product").agg(F.max("most").alias("file_count")).filter("file_count > 1")
    return pages.join(counts, "product").select("product", "page", "files", "file_count").orderBy(F.desc("file_count"), "product", "page")


def file_distribution(df: DataFrame) -> DataFrame:
    """Products in 1, 2, 3, 4 or more files, and the most files; zeros for none."""
    n = F.col("n")
    return _files_of(df).agg(
        F.count_if(n == 1).alias("in_1_file"), F.count_if(n == 2).alias("in_2_files"), F.count_if(n == 3).alias("in_3_files"),
        F.count_if(n >= 4).alias("in_4_plus_files"), F.coalesce(F.max("n"), F.lit(0)).alias("max_files"),
    )


def batch_similarity(df: DataFrame, cell: int = CELL, split: int = SPLIT_FILES) -> DataFrame:
    """(file1, file2, shared, union, similarity in percent) of every two files that share a product.

    Files are numbered in order and weighed: a file's load is the number of other files that its products meet in it. Runs of
    files of one load (`cell`) are cells, and a pair is counted in the cell of one of its files. A product sends its list of files,
    once, to each cell that it has a file in; the pairs are made and counted there, so they are not shuffled. A file of
    more load than a cell is dealt over several by product, and a product in more than `split` files has several lists.
    """
    found = df.filter(F.col("product").isNotNull() & F.col("file").isNotNull()).select("file", "product").distinct()
    pairs = materialise(found, "similarity-pairs")
    often = materialise(pairs.groupBy("product").agg(F.count("*").alias("k")).filter("k > 1"), "similarity-products")
    loads = pairs.join(often, "product", "left").groupBy("file").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col("k") - 1, F.lit(0))).alias("load"))
    files = prefix_sums(loads, ["file"], "load", None)
    whole = files.agg(F.count("*").alias("files"), F.coalesce(F.max("_sum"), F.lit(0)).alias("load"), F.coalesce(F.max("load"), F.lit(0)).alias("most")).first()
    hot = often.filter(F.col("k") > split).select("product", F.ceil(F.col("k") / split).cast("int").alias("parts"))
    n_hot = hot.count()

    number = F.col("_i").cast("int" if whole["files"] < 2**31 else "long")
    cells = files.select("file", number.alias("id"), F.floor((F.col("_sum") - F.col("load")) / cell).alias("first"), F.greatest(F.lit(1), F.ceil(F.col("load") / cell)).alias("cells"))
    own = pairs.join(_counted(cells, whole["files"]), "file").withColumn("cell", F.col("first") + F.pmod(F.xxhash64("product"), "cells")).drop("file", "first", "cells")
    own = own.join(_counted(hot, n_hot), "product", "left") if n_hot else own.withColumn("parts", F.lit(1))
    own = own.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
    lists = own.repartition("product", "part").groupBy("product", "part").agg(F.max("parts").alias("parts"), F.sort_array(F.collect_list(F.struct("cell", "id"))).alias("own"))
    if n_hot:
        lists = materialise(lists, "similarity-lists")
    lists = lists.filter("parts > 1 OR size(own) > 1").select("product", "part", "parts", F.col("own.cell").alias("cells"), F.col("own.id").alias("ids"))
    # A pair is of the cell of the one that comes first by cell and number; of two lists, of the one in the first list.
    place = F.array_position("cells", F.col("cell"))
    mine = F.slice("ids", place, F.size("cells") + 2 - place - F.array_position(F.reverse("cells"), F.col("cell")))
    cut = lists.select("*", F.explode(F.array_distinct("cells")).alias("cell"))
    sent = cut.select("cell", mine.alias("ids"), F.slice("ids", place, F.size("ids")).alias("others"), F.lit(0).alias("behind"))
    if n_hot:
        left = cut.filter("part < parts - 1").select("product", "cell", mine.alias("own"), F.explode(F.expr("sequence(part + 1, parts - 1)")).alias("part"))
        sent = sent.union(left.join(lists.select("product", "part", "ids"), ["product", "part"]).select("cell", "own", "ids", F.size("own")))
    sent = sent.repartition(whole["load"] // cell + 1, "cell")
    made = sent.select("cell", "others", "behind", F.posexplode_outer("ids").alias("i", "a")).select("cell", "i", "a", "behind", F.posexplode_outer("others").alias("j", "b")).filter("i < j + behind")
    shared = made.groupBy("cell", F.least("a", "b").alias("id1"), F.greatest("a", "b").alias("id2")).agg(F.count("*").alias("shared"))  # behind the shuffle by cell
    if whole["most"] > cell:
        shared = shared.groupBy("id1", "id2").agg(F.sum("shared").alias("shared"))
    named = lambda i: _counted(files.select(number.alias(f"id{i}"), F.col("file").alias(f"file{i}"), F.col("n").alias(f"n{i}")), whole["files"])
    both = shared.join(named(1), "id1").join(named(2), "id2").withColumn("union", F.col("n1") + F.col("n2") - F.col("shared"))
    return both.select("file1", "file2", "shared", "union", F.round(percent(F.col("shared"), F.col("union")), 6).alias("similarity"))


def shared_products(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs (file1, file2) with the sorted products that both hold."""
    asked = pairs.select(F.explode(F.array("file1", "file2")).alias("file")).distinct()
    own = df.select("file", "product").join(asked, "file", "left_semi").distinct()
    met = pairs.select("file1", "file2").join(own.withColumnRenamed("file", "file1"), "file1").join(own.withColumnRenamed("file", "file2"), ["file2", "product"])
    return met.groupBy("file1", "file2").agg(F.sort_array(F.collect_list("product")).alias("products"))


def file_sets(df: DataFrame, over: int, size: int = SET) -> DataFrame:
    """(file, level, part, own, n, products): the products of each file, n in all, in sets.

    A file of more than `size` products is cut by their hash into 2 ** level parts of `size` at most, about. A file that is more than
    `over` percent like it has its level or the next one; so a file near the next level is cut that way, too (own marks the level of its own size).
    """
    rows, same = df.filter(F.col("product").isNotNull()).select("file", "product"), F.col("file").eqNullSafe(F.col("_file"))
    level = lambda n: F.greatest(F.lit(0), F.ceil(F.log2(n / size)).cast("int"))
    large = materialise(rows.groupBy("file").agg(F.count("*").alias("n")).filter(F.col("n") * 100 > size * over).select(F.col("file").alias("_file")), "large-files")
    n_large = large.count()
    own = materialise(rows.join(_counted(large, n_large), same, "left_semi").distinct(), "large-files")
    counts = own.groupBy(F.col("file").alias("_file")).agg(F.count("*").alias("_n"))
    counts = materialise(counts.select("_file", "_n", level(F.col("_n")).alias("_own"), level(F.col("_n") * 100 / over).alias("_next")), "large-files")
    parts = F.expr("shiftleft(1L, level)")
    cut = own.join(_counted(counts.select("_file", F.explode(F.sequence("_own", "_next")).alias("level")), 2 * n_large), same).select("file", "product", (parts + F.pmod(F.xxhash64("product"), parts)).alias("part"))
    rows = rows.join(_counted(large, n_large), same, "left_anti").select("file", "product", F.lit(1).cast("long").alias("part")).union(cut)
    sets = rows.repartition("file", "part").groupBy("file", "part").agg(F.collect_set("product").alias("products")).withColumn("level", F.length(F.bin("part")) - 1)
    mine, n = F.col("level") == F.coalesce("_own", F.lit(0)), F.coalesce("_n", F.size("products").cast("long"))
    return sets.join(_counted(counts, n_large), same, "left").select("file", "level", "part", mine.alias("own"), n.alias("n"), "products")


def _classes(sets: DataFrame) -> DataFrame:
    """(of, m, file, place): the first four files, by place from 1, of each class of m files with the same products; of is the first."""
    digest = F.concat_ws(":", "part", F.sha2(F.to_json(F.sort_array(F.transform("products", lambda x: x.cast("string")))), 256))
    marks = sets.filter("own").groupBy("file").agg(F.concat_ws(",", F.sort_array(F.collect_list(digest))).alias("mark"))
    marks = materialise(marks.select("file", F.sha2("mark", 256).alias("mark")), "file-marks")
    first = marks.withColumn("place", F.row_number().over(Window.partitionBy("mark").orderBy("file"))).filter("place <= 4")
    whole = marks.groupBy("mark").agg(F.min("file").alias("of"), F.count("*").alias("m"))
    return materialise(first.join(whole, "mark").drop("mark"), "file-classes")


def alike_candidates(sets: DataFrame, over: int) -> DataFrame:
    """(of1, of2, level) of all files that are more than `over` percent alike (50 at least), and of few others.

    In one part of theirs, at the least, two such files are as much alike. There a file's products are in order of their hash, and each makes a link with the
    one before. A product that only one of the two has changes the link of one common product at most, so the links in common are more than 2 over - 100 percent
    of the union, and so of either file (`least`). Of the first links by hash, as many as can differ and `need` more, they share `need`. That grows with the
    size of the part: neighbours are seldom shared by chance, where products are in many files.
    """
    size = F.size("hashes")
    least = (F.floor((2 * over - 100) * size / 100) + 1).cast("int")
    need = F.least(least, (4 + F.floor(size / 32)).cast("int"))
    hashed = sets.select("file", "part", F.sort_array(F.transform("products", lambda x: F.xxhash64(x))).alias("hashes"))
    linked = hashed.select("file", "part", (size - least + need).alias("first"), need.alias("need"), F.sort_array(F.transform("hashes", lambda x, i: F.xxhash64(x, F.get("hashes", i - 1)))).alias("links"))
    links = linked.select("file", "part", "need", F.explode(F.slice("links", F.lit(1), F.col("first"))).alias("link"))
    side = lambda i: links.select("link", "part", F.col("file").alias(f"of{i}"), F.col("need").alias(f"need{i}"))
    met = side(1).join(side(2), ["link", "part"]).filter("of1 < of2").groupBy("of1", "of2", "part", F.least("need1", "need2").alias("need")).agg(F.count("*").alias("n"))
    return met.filter("n >= need").groupBy("of1", "of2").agg((F.max(F.length(F.bin("part"))) - 1).alias("level"))


def similar_files(sets: DataFrame, over: int) -> DataFrame:
    """(file1, file2, similarity, pairs), from `file_sets`: how many two files are more than `over` percent alike (50 at least), and the first of them.

    Files with the same products are a class, and classes are compared by their first files, set by set. Of a class, or of two that are alike, only some
    of the first files are rows, their first three pairs among them; the sum of the column pairs is the number of all.
    """
    sets = sets.filter("file IS NOT NULL")
    classes = _classes(sets)
    firsts = classes.filter("place = 1")
    seen = firsts.agg(F.count("*").alias("classes"), F.count_if(F.col("m") > 1).alias("copied")).first()
    if seen["copied"]:
        sets = sets.join(_counted(firsts.select("file"), seen["classes"]), "file", "left_semi")
    met = materialise(alike_candidates(sets, over), "similar-candidates")
    own = lambda i: sets.select(F.col("file").alias(f"of{i}"), "level", "part", F.col("n").alias(f"n{i}"), F.col("products").alias(f"products{i}"))
    both = met.join(own(1), ["of1", "level"]).join(own(2), ["of2", "level", "part"])
    shared = both.groupBy("of1", "of2", "n1", "n2").agg(F.sum(F.size(F.array_intersect("products1", "products2"))).alias("shared"))
    alike = shared.select("of1", "of2", F.round(percent(F.col("shared"), F.col("n1") + F.col("n2") - F.col("shared")), 6).alias("similarity")).filter(F.col("similarity") > over)
    of = lambda i: classes.select(F.col("of").alias(f"of{i}"), F.col("file").alias(f"own{i}"), F.col("place").alias(f"place{i}"), F.col("m").alias(f"m{i}"))
    across = alike.join(of(1).filter("place1 <= 3"), "of1").join(of(2).filter("place2 <= 3"), "of2").withColumn("pairs", F.expr("CASE WHEN place1 = 1 AND place2 = 1 THEN m1 * m2 ELSE 0 END"))
    within = of(1).filter("m1 > 1").join(of(2), F.expr("of1 = of2 AND place1 < place2")).withColumn("similarity", F.lit(100.0)).withColumn("pairs", F.expr("CASE WHEN place1 = 1 AND place2 = 2 THEN m1 * (m1 - 1) DIV 2 ELSE 0 END"))
    out = [F.least("own1", "own2").alias("file1"), F.greatest("own1", "own2").alias("file2"), "similarity", "pairs"]
    return across.select(*out).union(within.select(*out))


def recommendations(df: DataFrame) -> DataFrame:
    """(code, value, file1, file2): the level of duplication, the number of pairs over 80 percent and the top 3 of them,
    and the products in 4 or more files if there are any."""
    none = F.lit(None).cast(dict(df.dtypes)["file"])
    sets = materialise(file_sets(df, 80), "file-sets")
    products = sets.filter("own").select(F.explode("products").alias("product")).groupBy("product").agg(F.count("*").alias("n"))
    found = products.agg(_duplication_rate(F.count_if(F.col("n") > 1), F.count("*")).alias("rate"), F.count_if(F.col("n") >= 4).cast("double").alias("many"))
    level = F.when(F.col("rate") > 20, "high_duplication").when(F.col("rate") > 10, "moderate_duplication").otherwise("low_duplication")
    row = lambda code, value: F.struct(code.alias("code"), value.alias("value"), none.alias("file1"), none.alias("file2"))
    overall = found.select(F.inline(F.array(row(level, F.col("rate")), row(F.lit("in_4_plus_files"), F.col("many"))))).filter("code != 'in_4_plus_files' OR value > 0")
    alike = materialise(similar_files(sets, 80), "similar-files")  # read twice
    count = alike.agg(F.sum("pairs").alias("n")).filter("n > 0").select(F.lit("similar_pairs"), F.col("n").cast("double"), none, none)
    top = alike.orderBy(F.desc("similarity"), "file1", "file2").limit(3).select(F.lit("similar_pair"), "similarity", "file1", "file2")
    return overall.union(count).union(top)


def file_profile(df: DataFrame, files: DataFrame) -> DataFrame:
    """Per file: rows, unique products, bytes, modified."""
    own = df.groupBy("file").agg(F.count("*").alias("rows"), F.count_distinct("product").alias("unique_products"))
    return files.select("file", "bytes", "modified").join(own, "file", "left").fillna(0, ["rows", "unique_products"])


def batch_stats(df: DataFrame, duplicate: Column) -> DataFrame:
    """Batches, total, unique and duplicate rows; the rate over unique and over all rows, in percent."""
    out = df.agg(F.count_distinct("file").alias("batches"), F.count("*").alias("total"), F.count_if(~duplicate).alias("unique"), F.count_if(duplicate).alias("duplicates"))
    rates = {"rate_of_unique": "unique", "rate_of_total": "total"}
    return out.select("*", *[F.round(percent(F.col("duplicates"), F.col(whole)), 6).alias(name) for name, whole in rates.items()])


def cleanup_report(files: DataFrame, plan: DataFrame, rows: DataFrame, kept: DataFrame) -> DataFrame:
    """files (kept or not), consolidated files of a compaction plan, rows before and after; each counted once."""
    a = files.agg(F.count("*").alias("files"), F.count_if(~F.col("kept")).alias("files_removed"))
    b = plan.agg(F.count_if("rewritten").alias("files_consolidated"))
    c, d = rows.agg(F.count("*").alias("rows_before")), kept.agg(F.count("*").alias("rows_after"))
    return a.crossJoin(b).crossJoin(c).crossJoin(d).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def outcome_stats(df: DataFrame, action: Column) -> DataFrame:
    """total, created, updated, skipped, errors and the success rate (created and updated, in percent of all)."""
    out = df.agg(F.count("*").alias("total"), *[F.count_if(action == a).alias(n) for a, n in (("created", "created"), ("updated", "updated"), ("skipped", "skipped"), ("error", "errors"))])
    return out.withColumn("success_rate", F.round(percent(F.col("created") + F.col("updated"), F.col("total")), 6))


def is_success(status: Column) -> Column:
    return status.isin(200, 201, 409)


def sync_summary(df: DataFrame) -> DataFrame:
    """total, to_create, to_update, skipped and errors over the column action."""
    names = (("create", "to_create"), ("update", "to_update"), ("skip", "skipped"), ("error", "errors"))
    return df.agg(F.count("*").alias("total"), *[F.count_if(F.col("action") == a).alias(n) for a, n in names])


def pick_best(df: DataFrame, key: str) -> DataFrame:
    """The url of each key with the largest area, then bytes; ties go to the first position."""
    rank = F.struct(F.coalesce(F.col("width") * F.col("height"), F.lit(0)).alias("area"), F.coalesce(F.col("bytes"), F.lit(0)).alias("bytes"), (-F.col("pos")).alias("pos"))
    return df.groupBy(key).agg(F.max_by("url", rank).alias("url"), F.max(rank).alias("best")).select(key, "url", F.col("best.area").alias("area"), F.col("best.bytes").alias("bytes"))


def probe_summary(df: DataFrame, key: str) -> DataFrame:
    """tested, no_url, any_bytes and improved keys (the best area exceeds that at position 0, which is over 0)."""
    area = F.coalesce(F.col("width") * F.col("height"), F.lit(0))
    own = df.groupBy(key).agg(F.count("url").alias("urls"), F.max(F.coalesce("bytes", F.lit(0))).alias("bytes"), F.max(area).alias("best"), F.max(F.when(F.col("pos") == 0, area)).alias("base"))
    return own.agg(
        F.count("*").alias("tested"), F.count_if(F.col("urls") == 0).alias("no_url"), F.count_if(F.col("bytes") > 0).alias("any_bytes"),
        F.count_if((F.col("base") > 0) & (F.col("best") > F.col("base"))).alias("improved"),
    )


def pages_needed(total: Column, per_page: Column) -> Column:
    """ceil(total / per_page); 22 a page where that is not known, one page where it is 0."""
    size = F.coalesce(per_page, F.lit(22))
    return F.when(size == 0, F.lit(1)).otherwise(F.ceil(F.coalesce(total, F.lit(0)) / F.nullif(size, F.lit(0)))).cast("long")


def page_coverage(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """(key, page) of the pages from 1 to the needed number that are not among seen (key, page)."""
    wanted = df.filter("pages > 0").select(key, F.explode(F.sequence(F.lit(1).cast("long"), F.col("pages"))).alias("page"))
    return wanted.join(seen.select(key, "page"), [key, "page"], "left_anti")


def progress(part: Column, whole: Column) -> Column:
    """Percent to one decimal, half to even; 0 for nothing."""
    return F.bround(percent(part, whole), 1)


def run_stats(log: DataFrame) -> DataFrame:
    """runs, products, and the size, duration and success of the latest run."""
    last = F.max_by(F.struct("products", "duration", "ok"), F.struct("ts", "run_id"))
    return log.agg(F.count("*").alias("runs"), F.sum("products").alias("total_products"), last.alias("l")).select("runs", "total_products", F.col("l.products").alias("last_products"), F.col("l.duration").alias("last_duration"), F.col("l.ok").alias("last_ok"))


def latest(df: DataFrame, by: str, key: list[str]) -> DataFrame:
    """The last row of each key by a column."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(by)))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
