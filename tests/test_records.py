"""Identity, survivors, synchronisation, projections: literal rows in, literal rows out."""

import random
import re
import time
from html.parser import HTMLParser

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skeinwork.functions import columns as C
from skeinwork.operators import analysis as A
from skeinwork.operators import batching as W
from skeinwork.operators import dedup as D
from skeinwork.operators import identity as K
from skeinwork.operators import pages as H
from skeinwork.operators import project as P
from skeinwork.operators import sync as J
from skeinwork.sources import sinks
from skeinwork.sources.storage import materialise


def values(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


def test_falsy_keys_fall_through(spark):
    df = spark.createDataFrame([(0, "", "7"), (5, "x", "7"), (None, None, None)], "product_id int, productId2 string, id string")
    assert values(df.select(K.identity(df, "batch").alias("k")), "k") == [("7",), ("5",), (None,)]
    assert values(df.select(K.identity(df, "probe").alias("k")), "k")[2] == ("?",)


def test_numbers_and_texts_are_apart_only_for_the_analyser(spark):
    a, b = spark.createDataFrame([(5,)], "product_id int"), spark.createDataFrame([("5",)], "product_id string")
    key = lambda df, p: df.select(K.identity(df, p)).first()[0]
    assert key(a, "batch") == key(b, "batch") and key(a, "analyser") != key(b, "analyser")


def test_an_empty_text_wins_where_only_null_is_missing(spark):
    df = spark.createDataFrame([("", "u"), (None, "u"), (None, "")], "id string, url string")
    assert values(df.select(K.identity(df, "dedup").alias("k")), "k") == [("",), ("u",), (None,)]


def test_the_number_comes_from_the_url(spark):
    df = spark.createDataFrame([("", "http://x/?productID=77&a")], "id string, SourceURL string")
    assert df.select(K.identity(df, "page")).first()[0] == "77"
    assert values(df.select(K.id_from_url(F.lit("http://x/?a=1&ProductId=a%20b#c")).alias("k")), "k") == [("a b",)]


@pytest.mark.parametrize(
    ("sku", "want"),
    [('[{"SKU":"X1"}]', "X1"), ('["a","b"]', "a"), ('{"SKU":"Y"}', "Y"), ('"z"', "z"), ("plain", "plain"), ("[]", "n_3"), ("", "n_3"), (None, "n_3")],
)
def test_skus_of_any_shape(spark, sku, want):
    df = spark.createDataFrame([(None, sku, "n", 3)], "id string, sku string, name string, seq int")
    assert df.select(K.prepared_identity(df, "seq")).first()[0] == want


@pytest.mark.parametrize(
    ("sku", "want"),
    [("12345ABC", "12345"), ("AB-123", "AB-123"), ("abc", None), ("a long text with 4711 and 12345", "4711"), ("a long text without any number", None), ("12345abc", "12345abc")],
)
def test_product_numbers(spark, sku, want):
    df = spark.createDataFrame([(sku,)], "sku string")
    assert df.select(K.product_number(df)).first()[0] == want
    raw = spark.createDataFrame([("abc", '{"Number":"N9","Numbers":["M"]}')], "sku string, raw_data string")
    assert raw.select(K.product_number(raw)).first()[0] == "N9"


ROWS = [("a", 1, "f"), ("b", 2, "f"), ("a", 3, "g"), (None, 4, "g"), (None, 5, "g")]


def test_survivors(spark):
    df = spark.createDataFrame(ROWS, "key string, seq int, file string")
    assert sorted(values(D.dedup_first(df, ["key"], "seq"), "key", "seq")) == [("a", 1), ("b", 2)]
    assert sorted(values(D.merge_batches(df, ["key"], "seq"), "seq")) == [(1,), (2,), (4,), (5,)]
    assert sorted(values(D.consolidate_last(df, "key", "seq"), "key", "seq", "position")) == [("a", 3, 1), ("b", 2, 2)]
    assert sorted(values(D.dedup_within_file(df, "key", "seq"), "seq")) == [(1,), (2,), (3,), (4,), (5,)]
    assert sorted(values(D.catalog_index(df, "key", "seq"), "key", "seq", "other_files")) == [("a", 1, 1), ("b", 2, 0)]
    assert values(D.dedup_report(df, "key"), "key", "removed") == [("a", 1)]


def test_the_gate_lets_rows_without_a_key_in(spark):
    new = spark.createDataFrame([("a", "x", 1), ("b", "x", 2), ("b", "y", 3), (None, "x", 4), ("c", "x", 5)], "key string, fp string, seq int")
    old = spark.createDataFrame([("a",), (None,)], "key string")
    assert sorted(values(D.ingest_gate(new, old, "key", "fp", "seq"), "seq")) == [(2,), (4,)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4))), min_size=1, max_size=12))
def test_what_is_kept_and_removed_is_the_input(spark, keys):
    df = spark.createDataFrame([(k, i) for i, (k,) in enumerate(keys)], "key int, seq int")
    once = D.merge_batches(df, ["key"], "seq")
    removed = D.dedup_report(df, "key").agg(F.coalesce(F.sum("removed"), F.lit(0))).first()[0]
    assert once.count() + removed == len(keys)
    assert sorted(values(D.merge_batches(once, ["key"], "seq"), "seq")) == sorted(values(once, "seq"))


def test_sync_actions(spark):
    store = spark.createDataFrame([("1", "2025-07-13T08:00:00"), ("2", None), ("3", "junk"), ("4", "2025-01-01T00:00:00Z")], "product_id string, scraped_date string")
    rows = [("1", "2025-07-13 08:00:53"), ("1", "2025-07-13 07:00:00"), ("2", "2025-01-01"), ("3", "2025-01-01"), ("4", "2025-01-01T00:00:00"), ("9", "2025-01-01"), (None, "2025-01-01"), ("1", "")]
    df = spark.createDataFrame(rows, "product_id string, scraped_date string")
    got = {r[:2]: r[2] for r in values(J.sync_classify(df, store), "product_id", "scraped_date", "action")}
    assert [got[r] for r in rows] == ["update", "skip", "update", "update", "update", "create", "error", "error"]
    skip = {r[:2]: r[2] for r in values(J.sync_skip_lexical(df, store), "product_id", "scraped_date", "skip")}
    assert skip[rows[0]] is True  # a blank sorts before a T


def test_compaction_groups(spark):
    files = spark.createDataFrame([(f"f{i}", i, n) for i, n in enumerate((60, 50, 40, 10))], "file string, place long, size long")
    got = sorted(values(W.plan_compaction(files, 100), "place", "group_id", "rewritten"))
    assert got == [(0, 1, False), (1, 2, True), (2, 2, True), (3, 2, True)]
    assert W.plan_compaction(files.limit(0), 100).count() == 0


def walk(sizes, cap):
    """The groups by the walk that the plan does without."""
    groups, total = [], 0
    for size in sizes:
        if groups and total + size <= cap:
            total += size
            groups.append(groups[-1])
        else:
            total = size
            groups.append(groups[-1] + 1 if groups else 1)
    return [(g, groups.count(g) > 1) for g in groups]


@pytest.mark.parametrize("parts", [1, 2, 5, 8])
def test_compaction_equals_a_walk(spark, parts):
    rng = random.Random(parts)
    for kind in ([1, 2, 3], [0, 0, 0, 1], [5, 150], [100], [0, 40, 101], [1] * 30 + [99]):
        sizes = [rng.choice(kind) for _ in range(rng.choice([1, 2, 7, 40, 150]))]
        files = spark.createDataFrame([(f"f{i}", i // 2, n or None) for i, n in enumerate(sizes)], "file string, place long, size long")
        # Files of one place go by name, as text.
        order = sorted(range(len(sizes)), key=lambda i: (i // 2, f"f{i}"))
        got = sorted(values(W.plan_compaction(files, 100, parts=parts), "place", "file", "size", "group_id", "rewritten"))
        want = [(i // 2, f"f{i}", sizes[i], *g) for i, g in zip(order, walk([sizes[i] for i in order], 100))]
        assert got == want, (kind, len(sizes))


def test_a_million_files_in_ranges(spark):
    n = 1_000_000
    size = lambda c: F.pmod(F.xxhash64(c), F.lit(97)) + 1
    files = spark.range(0, n, 1, 8).select(F.col("id").alias("file"), F.col("id").alias("place"), size(F.col("id")).alias("size"))
    got = W.plan_compaction(files, 5000, parts=8).select("place", "size", "group_id").toPandas().sort_values("place")
    sums, groups, total, group = got["size"].tolist(), [], 0, 0
    for x in sums:
        group, total = (group, total + x) if group and total + x <= 5000 else (group + 1, x)
        groups.append(group)
    assert len(got) == n and got["group_id"].tolist() == groups


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_streaks_across_ranges(spark, parts):
    rng = random.Random(parts)
    for share in (0.3, 0.9, 1.0):
        log = [(rng.choice(["a", "b", "c", None]) if share < 1 else "a", i, rng.random() > share) for i in range(200)]
        df = spark.createDataFrame([(u, i, ok if i % 50 else (None if not ok else ok)) for u, i, ok in log], "user string, id long, ok boolean")
        got = sorted(values(W.failure_streaks(df, 2, "user", ["id"], F.col("ok"), parts=parts), "user", "first", "last", "failures"), key=str)
        want = []
        for u in {u for u, *_ in log}:
            run = []
            for _, i, ok in [r for r in log if r[0] == u] + [(u, None, True)]:
                if ok and len(run) > 1:
                    want.append((u, run[0], run[-1], len(run)))
                run = [] if ok else [*run, i]
        assert got == sorted(want, key=str)
    assert W.failure_streaks(df.limit(0), 2, "user", ["id"], F.col("ok"), parts=parts).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 6])
def test_places_within_a_key_across_ranges(spark, parts):
    rng = random.Random(parts)
    for keys in (["a"], ["a", "b", "c", None], [str(i) for i in range(200)], ["a"] * 9 + ["b"]):
        rows = [(rng.choice(keys), i) for i in range(300)]
        df = spark.createDataFrame(rows, "k string, i long").repartition(3)
        got = sorted(values(W.with_place(df, "k", ["i"], parts), "k", "i", "place"), key=str)
        assert got == sorted(((k, i, sum(1 for x, j in rows if x == k and j <= i)) for k, i in rows), key=str)
    assert W.with_place(df.limit(0), "k", ["i"], parts).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_files_of_a_product_come_in_pages(spark, parts):
    df = spark.range(5000).selectExpr("id AS file", "IF(id % 5 = 4, id, 0) AS product")
    got = values(A.duplicate_products(df, 1000, parts), "product", "page", "files", "file_count")
    files = [i for i in range(5000) if i % 5 != 4]
    assert got == [(0, p, files[1000 * p : 1000 * p + 1000], 4000) for p in range(4)]
    assert A.duplicate_products(df.limit(0)).count() == 0


def exchanges(df):
    """Shuffles of rows in a plan, without broadcasts and without those of tables of a row a range (single partition)."""
    plan = df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    return len([line for line in plan.splitlines() if re.search(r"Exchange (hash|range)partitioning", line) and "_file" not in line])


def test_numbering_shuffles_once_and_windows_once_more(spark):
    df = spark.range(1000).selectExpr("id % 7 AS user", "id")
    assert exchanges(W.assign_batches(df, 50, ["id"])) == 0  # behind the written ranges
    assert exchanges(W.recent(df, 3, ["user"], ["id"], "id")) == 1


def test_ranks_do_not_depend_on_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        assert W.with_rank(df, ["k"]).filter("rank <> k + 1").count() == 0
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_catalogue(spark):
    df = spark.createDataFrame([], "file string, product string")
    assert tuple(A.file_distribution(df).first()) == (0, 0, 0, 0, 0)
    assert A.duplication_summary(df).first()["duplication_rate"] == 0
    assert A.batch_similarity(df).count() == 0


def test_similarity_is_within_bounds(spark):
    df = spark.createDataFrame([(f"f{i % 3}", i % 5) for i in range(30)], "file string, product int")
    rows = values(A.batch_similarity(df), "file1", "file2", "similarity")
    assert rows and all(a < b and 0 < s <= 100 for a, b, s in rows)


def overlaps(data):
    own = {}
    for f, p in data:
        if f is not None and p is not None:
            own.setdefault(f, set()).add(p)
    return sorted((a, b, n, m, round(100 * n / m, 6)) for a in own for b in own if a < b and (n := len(own[a] & own[b])) and (m := len(own[a] | own[b])))


def test_pairs_of_files_are_counted_where_they_are_made(spark):
    """One shuffle of lists and one by cell; none has a row for each pair and product."""
    df = spark.createDataFrame([(f"f{i % 7}", i % 5) for i in range(60)], "file string, product int")
    alike = A.batch_similarity(df)
    plan = alike._jdf.queryExecution().sparkPlan().toString() + alike._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "ids" in plan and not re.search(r"Exchange hashpartitioning\((file1|id1)", plan)
    assert sorted(map(tuple, alike.collect())) == overlaps(df.collect())


def test_overlap_does_not_depend_on_cells_and_lists(spark):
    """Files of more load than a cell, products in more files than a list holds, nulls and repeats."""
    rng = random.Random(1)
    data = [(f"f{rng.randint(0, 25)}" if rng.random() < 0.97 else None, rng.choice([1, 1, 1, 2, 2, rng.randint(3, 40), None])) for _ in range(600)]
    df, want = spark.createDataFrame(data, "file string, product int"), overlaps(data)
    for cell, split in ((4_000_000, 1000), (3, 2), (50, 4), (1, 1)):
        assert sorted(map(tuple, A.batch_similarity(df, cell, split).collect())) == want


def test_alike_files_are_found_once(spark):
    """The recommendations read similar pairs that were written, for their count and for the first three."""
    df = spark.createDataFrame([(f"f{i % 4}", i // 4 % 10) for i in range(40)], "file string, product int")
    found = A.recommendations(df)
    assert "similar-files" in "".join(found.inputFiles())
    rows = values(found, "code", "value", "file1", "file2")
    assert ("similar_pairs", 6.0, None, None) in rows and sum(r[0] == "similar_pair" for r in rows) == 3


def test_files_are_compared_only_where_they_are_alike(spark):
    """Each product is in 40 files, so nearly all of 79,800 pairs share some; one file has a near copy."""
    rng = random.Random(2)
    data = [(f, p) for f in range(400) for p in rng.sample(range(500), 50)]
    df = spark.createDataFrame(data + [(400, p) for f, p in data if f == 7][1:], "file int, product int")
    assert len(overlaps(df.collect())) > 70_000
    met = A.alike_candidates(A.file_sets(df, 80), 80)
    assert (7, 400) in values(met, "of1", "of2") and met.count() < 100
    found = A.recommendations(df)
    assert {r for r in values(found, "code", "value", "file1", "file2") if "similar" in r[0]} == {("similar_pairs", 1.0, None, None), ("similar_pair", 98.0, 7, 400)}


def test_alike_files_do_not_depend_on_sets(spark):
    """Families of files about as alike as the threshold, in one set or several, copies in classes of up to six, nulls, repeats and tiny files."""
    rng = random.Random(3)
    data, names = [], iter(rng.sample(range(10_000), 2000))
    for n in [*range(1, 12), 16, 19, 20, 21, 25, 40, 60, 79, 80, 81, 100]:
        own = rng.sample(range(4000), n)
        for change in (0, 0, 1, n // 10, n // 9, n // 8, n // 5, n // 4):
            kept = own[:n - change] + [rng.randint(5000, 9000) for _ in range(rng.choice([0, change]))]
            for _ in range(rng.choice([1, 1, 1, 2, 3])):
                file = f"f{next(names)}"
                data += [(file, p) for p in kept + kept[:2] + [None]]
    data += [(None, p) for p in range(90)]
    df, pairs = spark.createDataFrame(data, "file string, product int"), overlaps(data)
    for over, size in ((80, 16_384), (80, 5), (50, 64), (95, 20)):
        want = sorted(((-s, a, b) for a, b, _, _, s in pairs if s > over))
        sets = materialise(A.file_sets(df, over, size), "sets")
        assert {(a, b) for _, a, b in want} <= set(values(A.alike_candidates(sets.filter("file IS NOT NULL"), over), "of1", "of2"))
        rows = values(A.similar_files(sets, over), "file1", "file2", "similarity", "pairs")
        assert sum(r[3] for r in rows) == len(want) > 100
        assert sorted((-s, a, b) for a, b, s, _ in rows)[:3] == want[:3] and {(-s, a, b) for a, b, s, _ in rows} <= set(want)
    got = values(A.recommendations(df), "code", "value", "file1", "file2")
    want = sorted(((-s, a, b) for a, b, _, _, s in pairs if s > 80))
    assert [r[1] for r in got if r[0] == "similar_pairs"] == [len(want)]
    assert sorted((-r[1], *r[2:]) for r in got if r[0] == "similar_pair") == want[:3]
    assert [r[1] for r in got if r[0].endswith("duplication")] == [A.duplication_summary(df).first()["duplication_rate"]]
    assert [r[1] for r in got if r[0] == "in_4_plus_files"] == [A.file_distribution(df).first()["in_4_plus_files"]]


def test_shared_products_take_only_rows_of_the_files_asked_for(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), ("a", 2), ("b", 2), ("c", 1), ("a", 3), ("b", None), ("a", None)], "file string, product int")
    got = A.shared_products(df, spark.createDataFrame([("a", "b")], "file1 string, file2 string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("Aggregate [file") < plan.index("LeftSemi")
    assert [tuple(r) for r in got.collect()] == [("a", "b", [1, 2])]


def test_scalars(spark):
    one = spark.range(1)
    prices = one.select(*[C.is_price(F.lit(x)) for x in ("$7.88", "7.88", "7.", "$")]).first()
    assert tuple(prices) == (True, True, False, False)
    assert len(one.select(C.url_variants(F.lit("http://x/1"))).first()[0]) == 32
    assert one.select(C.slug(F.lit("  A b/C! "))).first()[0] == "a-b-c"
    assert one.select(C.split_list(F.lit(" a, ,b,"))).first()[0] == ["a", "b"]
    assert tuple(one.select(*[C.absolute_url(F.lit(x), "http://b/") for x in ("", "//a", "http://c")]).first()) == ("", "http://b/a", "http://c")


def test_product_types(spark):
    a = lambda n: F.array(*[F.lit("v")] * n)
    got = spark.range(1).select(P.product_type(a(2), F.lit("")), P.product_type(a(1), F.lit("u")), P.product_type(a(1), F.lit(""))).first()
    assert tuple(got) == ("variable", "external", "simple")


def test_of_methods_of_one_name_the_last_wins(spark):
    df = spark.createDataFrame([([("a", "1", []), ("", "2", []), ("a", "3", [])],)], "m array<struct<Name:string,Description:string,Charges:array<string>>>")
    got = df.select(P.methods_by_name(F.col("m"), "Method")).first()[0]
    assert {k: v["description"] for k, v in got.items()} == {"a": "3", "Method": "2"}


def test_broken_and_missing_pages(spark):
    df = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, "u", "<h1>T<table><tr><td>x")], "page_id int, url string, html string")
    rows = {r["page_id"]: r for r in H.extract_pages(df).collect()}
    assert rows[1]["name"] is None and rows[1]["main_image"] == "N/A" and rows[2]["prices"] == []
    assert rows[3]["name"].startswith("T")


def test_windows_of_a_long_key_are_cut(spark):
    """Results do not depend on where a key is cut."""
    log = spark.range(500).select(F.col("id"), F.when(F.col("id") < 420, 0).otherwise(F.col("id") % 5).alias("user"), (F.col("id") * 7 % 11 > 4).alias("ok"))
    whole = sorted((r["id"], tuple(r["recent"])) for r in W.recent(log, 4, ["user"], ["id"], "id").collect())
    assert whole[50] == (50, (47, 48, 49, 50)) and len(whole) == 500
    assert sorted((r["id"], tuple(r["recent"])) for r in W.recent(log, 4, ["user"], ["id"], "id", 7).collect()) == whole
    streaks = [sorted(map(tuple, W.failure_streaks(log, 2, "user", ["id"], F.col("ok"), size).collect())) for size in (100_000, 7)]
    assert streaks[0] == streaks[1] and streaks[0]
    timed = log.withColumn("ts", F.timestamp_seconds(F.col("id") * F.col("id") % 997))
    got = {r["id"]: (r["requests"], r["over_limit"], r["too_close"]) for r in W.trailing_rate(timed, 5, 3, 1.5, "user").collect()}
    at = {r["id"]: (r["user"], r["ts"].timestamp()) for r in timed.collect()}
    for i, (user, t) in at.items():
        near = [x for j, (u, x) in at.items() if u == user and t - 5 <= x <= t]
        assert got[i][:2] == (len(near), len(near) > 3)
    assert len(got) == 500


def test_records_are_parsed_once(spark):
    doc = '{"product": {"id": 5, "name": "n", "pricing": {"a": [1, 2.50]}}, "name": "top", "pricing": {"w": 1}, "specifications": {"weight": 3, "x": null}, "extraction_time": 7.0, "art_template": {"url": "u"}, "meta": [1, {"k": "\\u00e9"}], "themes": null}'
    df = spark.createDataFrame([(doc,), ('{"product": "text", "name": "flat", "sku": "s", "supplier": {}}',), ("{bad",), (None,)], "doc string")
    flat = P.flatten_sections(df, "doc")
    plan = flat._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"from_json\(", plan)) == 1 and "get_json_object" not in plan
    one, two, bad, none = flat.collect()
    assert (one["product_id"], one["name"], one["pricing_info"], one["specifications"], one["extraction_time"], one["product_art_url"]) == ("5", "n", '{"w":1}', '{"weight":3,"x":null}', "7.0", "u")
    assert one["meta"] == '[1,{"k":"é"}]' and one["themes"] == "[]" and (two["name"], two["sku"], two["supplier_info"]) == ("flat", "s", "{}")
    assert tuple(bad) == tuple(none) and none["name"] == "" and none["images"] == "[]" and none["meta"] is None
    over = [r["product"] for r in P.overlay_sections(df.filter("doc LIKE '%name%'"), "doc").collect()]
    assert over[0] == {"id": "5", "name": "n", "pricing": '{"w":1}', "specifications": '{"weight":3,"x":null}', "weight": "3"} and over[1]["name"] == "flat" and over[1]["product"] == "text"


def test_selectors():
    page = H.Page('<div id="a" class="x y"><p>one</p><b data-k="v1">two</b><i>three</i></div><p class="x">four</p>')
    texts = lambda s: [page.text(i) for i in H.select(page, s)]
    assert texts("#a p") == ["one"] and texts("div.x.y b") == ["two"] and texts(".x p") == ["one"] and texts("p") == ["one", "four"]
    assert texts('[data-k*="v"]') == ["two"] and texts("[data-k=v1] + i") == ["three"] and texts("b + p") == [] and texts("p + b") == ["two"]
    assert H.first_value(page, [".none", "p.x", "p"]) == "four"
    with pytest.raises(ValueError):
        H.selector("p:first-child")


def test_broken_pages_take_time_and_memory_in_proportion():
    """200,000 elements that are never closed, end tags that close nothing, tables in tables; each grid, selector and list."""
    n = 200_000
    deep = ["<p>" * n, "<div class='supplier'><a href='x'>" * (n // 2), "<b>" * n + "</i>" * n, "<table><tr><td>a<td>1" * (n // 4), "<table><tr><td>q</td><td>10</td></tr>" + "<tr><td>a</td><td>x" * (n // 3), "<tr><td>7</td>" * (n // 2)]
    for html in deep:
        began, page = time.process_time(), H.Page(html)
        for text in ["p b", "div p + a", "p p p p", ".supplier a[href*=x]", "table tr td"]:
            H.select(page, text)
        H.price_grid(page)
        H.parse_page(html, wanted=frozenset({"fields", "images", "rush", "supplier_link", "prices", "product_json", "product_number"}))
        assert time.process_time() - began < 12, html[:20]
        assert len(page.tags) <= n + 10 and len(page.pieces) <= n + 10 and all(a < b for a, b in zip(range(len(page.end)), page.end))
    page = H.Page("<p>" * n + "end")
    assert page.text(0) == page.text(n - 1) == "end" and page.end[0] == page.end[-1] == n


def plain_tree(html):
    """Every element with the parts of its text, as they are handed to all that are open."""
    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.all, self.stack = [], []

        def handle_starttag(self, tag, attrs):
            own = {k: v or "" for k, v in attrs}
            up = self.stack[-1] if self.stack else None
            kin = [e for e in self.all if up is not None and e["up"] is up]
            e = {"n": len(self.all), "tag": tag, "attrs": own, "up": up, "before": kin[-1] if kin else None, "text": ""}
            self.all.append(e)
            if tag not in H.VOID:
                self.stack.append(e)

        def handle_startendtag(self, tag, attrs):
            self.handle_starttag(tag, attrs)
            if tag not in H.VOID:
                self.handle_endtag(tag)

        def handle_endtag(self, tag):
            at = [i for i, e in enumerate(self.stack) if e["tag"] == tag]
            if at:
                del self.stack[at[-1] :]

        def handle_data(self, data):
            if not any(e["tag"] in ("script", "style") for e in self.stack):
                for e in self.stack:
                    e["text"] += data

    tree = Plain()
    tree.feed(html)
    tree.close()
    return tree.all


class Standard(H.Page):
    """A page that the standard parser reads from its first character on."""

    def _read(self, html):
        return 0


def test_plain_tags_are_read_as_the_standard_parser_reads_them():
    rng = random.Random(3)
    bits = [
        "<p>", "</p>", "<div class='x y'>", "</div>", "<br/>", "<br />", "<img src=q>", '<img src="a&amp;b" alt=\'&copy\'>', "<a href='x&lt=1'>", '<a href="&notit;">', "<script>", "</script>", "<SCRIPT>var a='<b>&amp;</h1>';</SCRIPT>",
        "</script >", "</ script>", "<!--", "</scriptx>", "<style>a<b</style>", "</ p>", "<!-- c -->", "<!---->", "<!-->", "<!-- a--b -->", "<!doctype html>", "<!DOCTYPE html PUBLIC 'x'>", "<?pi?>", "<![CDATA[x]]>", "<title>", "</title>", "a < b",
        "&amp", "&amp;", "&#65;", "&notit;", "x", "<", "<p", '<p a="1>', "<p a b='2' c=\"3\"  >", "<p a= 'b'>", "<p a='1'b='2'>", "<P ID=A Id='b'>", "<P ID='A' Id='b'>", "<\u00e9>", "<p \u00e9='1'>", "<x-y>", "</x-y>", "</x:y>", "<textarea>", "</textarea>", "<b/>",
        "<script src='a'/>", " ", "\n", "&", "-->", "<p\x00>", "<p\x0b a>", "</p x>", "<p/ a>", "<noscript>", "</noscript>", "<p a/>", "'", '"', ">", "<!", "</", "</>", "\r", "<meta name='n'>", "<p class='>' id='<b>'>",
    ]
    for _ in range(20_000):
        html = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        quick, standard = H.Page(html), Standard(html)
        for name in ("tags", "attrs", "up", "before", "end", "start", "stop", "index", "buffer"):
            assert getattr(quick, name) == getattr(standard, name), (name, html)


def test_product_pages_are_read_without_the_standard_parser(monkeypatch):
    """Scripts with tags in them, references in attributes, comments and titles are no reason to go over to it."""
    seen = []
    monkeypatch.setattr(HTMLParser, "goahead", lambda self, end: seen.append(self.rawdata))
    page = H.Page("<!doctype html><html><head><title>S &amp; T</title><script>var x = '<h1>no</h1>';</script></head><!-- c --><body data-product='{&quot;Number&quot;:&quot;N7&quot;}'><p class=\"a b\">x<br/>y</p></body></html>")
    assert not "".join(seen) and page.text(0) == "S & Txy" and [page.text(i) for i in H.select(page, "p.a")] == ["xy"] and page.tags[-2:] == ["p", "br"]
    assert page.attrs[page.of("tag", "body")[0]] == {"data-product": '{"Number":"N7"}'}


def test_selectors_of_what_a_page_lacks_are_not_followed(monkeypatch):
    page, looked = H.Page("<div class=a><p>x</p></div>"), []
    own = H._fitting
    monkeypatch.setattr(H, "_fitting", lambda page, conditions: looked.append(conditions) or own(page, conditions))
    assert [H.select(page, s) for s in ("div.a p.none", "#none p", "[data-x] div", "p + b")] == [[], [], [], []] and not looked
    assert H.select(page, "div.a p") == [1] and len(looked) == 2 and ("id", "none") not in page.index


def fits(e, part):
    kind = {"tag": e["tag"] == part[1], "id": e["attrs"].get("id") == part[1], "class": part[1] in e["attrs"].get("class", "").split()}
    if part[0] != "attribute":
        return kind[part[0]]
    value = e["attrs"].get(part[1])
    return value is not None and (part[2] is None or (value == part[3] if part[2] == "=" else part[3] in value))


def matches(e, parts, last):
    relation, conditions = parts[last]
    if not all(fits(e, c) for c in conditions):
        return False
    if not last:
        return True
    if relation == "+":
        return e["before"] is not None and matches(e["before"], parts, last - 1)
    while (e := e["up"]) is not None:
        if matches(e, parts, last - 1):
            return True
    return False


def test_random_pages_against_a_plain_tree():
    rng = random.Random(2)
    opening = ["<p>", "<div class='x y'>", "<b id=a>", "<i data-k='v1'>", "<td class=x>", "<tr>", "<table>", "<img src=q>", "<span class='y'/>", "<script>", "text ", "12,5", " 7. ", "3"]
    closing = ["</p>", "</div>", "</b>", "</i>", "</td>", "</tr>", "</table>", "</script>"]
    queries = ["p", ".x .y", "div p", "div div b", "p + i", ".x + .y", "#a", "[data-k]", "[data-k*=v] + p", "table tr td.x", "i[data-k=v1]", "div.x.y td", "p p p", "b + b p"]
    for _ in range(400):
        html = "".join(rng.choice(opening if rng.random() < 0.6 else closing) for _ in range(rng.randint(0, 60)))
        page, plain = H.Page(html), plain_tree(html)
        assert [" ".join(e["text"].split()) for e in plain] == [page.text(i) for i in range(len(page.tags))]
        for q in queries:
            parts = H.selector(q)[0]
            assert H.select(page, q) == [e["n"] for e in plain if matches(e, parts, len(parts) - 1)], (html, q)
        for e in plain:
            m = re.search(r"[\d.,]+\d", e["text"])
            assert page.first_number(e["n"]) == (m.group() if m else None)
        for t in (e for e in plain if e["tag"] == "table"):
            def nearest(r):
                while (r := r["up"]) is not None and r["tag"] != "table":
                    pass
                return r
            assert page.nearest(page.of("tag", "tr"), page.of("tag", "table"))[t["n"]] == [r["n"] for r in plain if r["tag"] == "tr" and nearest(r) is t]


def test_pages_of_another_layout(spark):
    """A table of selectors of one's own."""
    df = spark.createDataFrame([(1, "u", "<h1>no</h1><section id=s><h2 data-t='x'>Title</h2><img class=big data-src='/a.png'></section>")], "page_id int, url string, html string")
    row = H.extract_pages(df, spec={"name": ["#s h2"], "mark": ["h2@data-t"]}, images=["img.big@data-src"]).first()
    assert (row["name"], row["mark"], row["images"]) == ("Title", "x", ["/a.png"]) and "sku" not in row.asDict()


def test_art_templates_by_number(spark):
    base = "https://www.vendor.example.com"
    rows = [
        ("7", f'x "{base}/fs/artTemplates/7/a.pdf"', f"{base}/fs/artTemplates/7/a.pdf"), ("7", f'"{base}/artTemplates/7/b.pdf" "{base}/fs/artTemplates/7/a.pdf"', f"{base}/fs/artTemplates/7/a.pdf"),
        ("7", f'"{base}/fs/artTemplates/x7y"', f"{base}/fs/artTemplates/x7y"), ("7", '<a href="/download/8"></a><a class=c href="download/7?x">d</a>', f"{base}/download/7?x"), ("7", '<a href="//h.example.com/artTemplates/7">d</a>', "https://h.example.com/artTemplates/7"),
        ("7", f'"{base}/fs/artTemplates/8/a.pdf"', None), ("", f'"{base}/fs/artTemplates/7/a.pdf"', None), (None, "x", None), ("7", None, None), ("a.b", f'"{base}/artTemplates/axb/c"', None),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, number string, html string, want string")
    assert df.filter(~H.art_template(F.col("html"), F.col("number"), base).eqNullSafe(F.col("want"))).count() == 0


def test_link_columns_come_first_and_the_rest_is_sorted(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "z int, name int, a int, id int, url int")
    assert sinks.reorder_link_columns(df).columns == ["url", "id", "name", "a", "z"]
    assert sinks.reorder_link_columns(df.drop("url")).columns == ["z", "name", "a", "id"]
