import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from skeinwork.llm import decontaminate as D


def words(rng, n):
    return [f"{rng.choice('abcdefgh')}{rng.randint(0, 300)}" for _ in range(n)]


def plain_leaks(text, items, rule):
    """Every alignment of every item, without seeds."""
    own = D.token_hashes((text or "").encode())[0]
    out = set()
    for i, t in items:
        item = D.token_hashes((t or "").encode())[0]
        if not len(item):
            continue
        for shift in range(-len(item) + 1, len(own)):
            low, high = max(0, shift), min(len(own), shift + len(item))
            agree = (own[low:high] == item[low - shift : high - shift]).tolist()
            best, at, start, span = 0.0, 0.0, low, (0, 0)
            for k, a in enumerate(agree):
                at = at + (1 if a else -rule.penalty)
                if at <= 0:
                    at, start = 0.0, low + k + 1
                elif at > best:
                    best, span = at, (start - low, k + 1)
            same = sum(agree[span[0] : span[1]])
            if span[1] and same >= min(rule.tokens, len(item)) and same >= rule.identity * (span[1] - span[0]):
                out.add(i)
    return out


def test_planted_passages_are_found_and_others_left_alone(spark):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, rng.randint(3, 50)))) for i in range(30)] + [(30, None), (31, ""), (32, "...")]
    docs = []
    for i in range(60):
        text = words(rng, rng.randint(0, 200))
        if i % 2:
            item = items[i % 30][1].split()
            item = [w.upper() + "," for w in item]
            if len(item) > 20:
                item[len(item) // 2] = "substituted"
            text[len(text) // 2 : len(text) // 2] = item
        docs.append((i, " ".join(text)))
    docs += [(None, items[20][1]), (61, None), (62, ""), (1, docs[1][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(table, bench).collect()}
    assert got == {(i, k) for i, t in docs for k in plain_leaks(t, items, D.Rule())}
    assert {i for i, _ in got} >= {i for i in range(60) if i % 2} | {None}
    kept = D.drop_leaking(table, bench)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, t in docs if not plain_leaks(t, items, D.Rule()))


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert D.find_leaks(docs, bench).count() == 0 and D.drop_leaking(docs, bench).count() == 1
    assert D.find_leaks(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_an_item_of_few_tokens_has_to_be_there_whole(spark):
    docs = spark.createDataFrame([(1, "x a-b c y"), (2, "a b d c")], "doc_id long, text string")
    assert [r["doc_id"] for r in D.find_leaks(docs, spark.createDataFrame([(1, "A, b. C")], "item_id long, text string")).collect()] == [1]


def test_hits_survive_a_substitution_under_a_zero():
    item, tokens = (D.token_hashes(t)[0] for t in (b"a b c d e f g h i j k l m n o p", b"a b X d e Y g h i j k Z m n o p"))
    assert D.leak(tokens, item, D.Rule())


def test_short_items_are_found_with_substitutions():
    rng = random.Random(15)
    for n in range(4, 25):
        item = words(rng, n)
        own = D.token_hashes(" ".join(item).encode())[0]
        for _ in range(40):
            text = list(item)
            for at in rng.sample(range(n), n // 4):
                text[at] = "substituted"
            tokens = D.token_hashes(" ".join([*words(rng, 9), *text, *words(rng, 9)]).encode())[0]
            found = D.leak(tokens, own, D.Rule())
            assert found and found[0] >= D.Rule().least(n), (n, text)
            hashes = [D._windows(tokens, len(D.MASKS) + D.Rule().run(n) - 1, D.Rule()), D._windows(own, len(D.MASKS) + D.Rule().run(n) - 1, D.Rule())]
            assert np.isin(*hashes).sum() >= D.Rule().run_windows(n), (n, text)
            text[next(i for i in range(n) if text[i] != "substituted")] = "another"
            tokens = D.token_hashes(" ".join(text).encode())[0]
            if n < 16:
                assert not D.leak(tokens, own, D.Rule())


def test_repetitive_texts_stay_within_memory(spark):
    def peak(text, item):
        text, item = (D.token_hashes(t.encode())[0] for t in (text, item))
        tracemalloc.start()
        found = D.leak(text, item, D.Rule())
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return found, most

    found, most = peak("word " * 20_000, "word " * 2_000)
    assert found == (2000, 2000, 0, 0) and most < 300e6
    found, most = peak("a b " * 10_000, "b a " * 1_000 + "c " * 50)
    assert found[0] == 2000 and most < 300e6
    docs = spark.createDataFrame([(i, "word " * (20_000 if i else 5)) for i in range(3)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "word " * 2_000), (7, "word " * 2_000)], "item_id long, text string")
    assert sorted((r["doc_id"], r["n_agree"]) for r in D.find_leaks(docs, bench).collect()) == [(1, 2000)] * 2 + [(2, 2000)] * 2


def test_shifts_by_convolution_and_by_pairs_are_the_same(monkeypatch):
    rng = random.Random(5)
    for _ in range(20):
        text, item = (D.token_hashes(" ".join(rng.choice("ab") for _ in range(n)).encode())[0] for n in (300, 40))
        want = D.shifts_of(text, item, D.Rule())
        monkeypatch.setattr(D, "OVERLAY", 8)
        assert D.shifts_of(text, item, D.Rule()).tolist() == want.tolist()
        monkeypatch.undo()


def test_a_frequent_hash_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(D, "HOT_WINDOWS", 10)
    item = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"doc {i} {item if i % 3 else ''} end") for i in range(120)], "doc_id long, text string")
    got = D.find_leaks(docs, spark.createDataFrame([(1, item), (2, "none of it is here at all")], "item_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in got) == [i for i in range(120) if i % 3]


def test_the_filter_lets_all_seeds_through(spark):
    items = spark.range(200).selectExpr("id AS item", "concat_ws(' ', transform(sequence(1, 30), i -> concat('t', id * 31 + i))) AS text")
    seeds = D.materialise(D.seed_table(items, D.Rule()), "test-seeds")
    probe = D.Probe(D._filter(seeds, 19), 19, {}, D.Rule())
    hashes = np.array([r[0] for r in seeds.select("hash").collect()], dtype=np.int64).view(np.uint64)
    assert len(probe.may_hold(hashes)) == len(hashes)
    other = np.random.default_rng(1).integers(0, 2**63, 100_000).astype(np.uint64)
    assert len(probe.may_hold(other)) < 1500


@pytest.mark.parametrize("item, passage, agree", [(40, 16, 12), (40, 20, 15), (40, 24, 18), (60, 30, 23), (25, 25, 19), (40, 40, 30)])
def test_leaks_by_the_rule_are_found_by_the_seeds(monkeypatch, item, passage, agree):
    """A passage of an item in a text of 400 tokens, with substitutions anywhere: what every shift shows to be a leak, the seeds find."""
    rng, seeds, leaks, found = np.random.default_rng(passage), D.shifts_of, 0, 0
    every = lambda tokens, own, rule: np.arange(1 - len(own), len(tokens))
    for _ in range(400):
        own = rng.integers(0, 2**63, item, dtype=np.uint64)
        text = rng.integers(0, 2**63, 400, dtype=np.uint64)
        start, at = rng.integers(0, item - passage + 1), rng.integers(0, 400 - passage)
        kept = rng.permutation(passage)[:agree]
        text[at + kept] = own[start + kept]
        monkeypatch.setattr(D, "shifts_of", every)
        leaks += (whole := D.leak(text, own, D.Rule())) is not None
        monkeypatch.setattr(D, "shifts_of", seeds)
        found += whole is not None and D.leak(text, own, D.Rule()) == whole
    assert leaks > 50 and found >= 0.95 * leaks, (found, leaks)
