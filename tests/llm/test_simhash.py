import random

import numpy as np
import pytest
import xxhash

from skeinwork.llm import simhash as S
from skeinwork.llm.common import hot_join, row_key
from skeinwork.llm.components import components, spanning_edges


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)) if h else 0


def plain_components(values, limit=4):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= limit:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two three four", "A b c d E f g\x0bh", "é É x " * 9, "  a"])
def test_fingerprints(text):
    assert S.fingerprint(S.shingle_hashes(text, 4)) % 2**64 == plain_fingerprint(text)


@pytest.mark.parametrize("ring", [S.Ring(4, 16), S.Ring(3, 16), S.Ring(6, 16), S.Ring(2, 8), S.Ring(0, 4), S.Ring(7, 8)])
def test_every_close_pair_shares_a_key_and_keeps_a_chain(spark, ring):
    rng = random.Random(3)
    pairs = []
    for _ in range(150):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), ring.limit):
            b ^= 1 << bit
        pairs.append((a, b))
    signed = [x - 2**64 if x >= 2**63 else x for p in pairs for x in p]
    links = S.fingerprint_links(spark.createDataFrame([(x,) for x in set(signed)], "fp long"), ring).collect()
    found = {frozenset((r["a"], r["b"])) for r in links}
    assert all(frozenset(signed[2 * i : 2 * i + 2]) in found for i, (a, b) in enumerate(pairs) if a != b)
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= ring.limit for r in links)


@pytest.mark.parametrize("block", [8, 4096])
def test_components_of_a_dense_group_and_strays(spark, block):
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 160:
        x = rng.choice(sorted(values)) if rng.random() < 0.5 else centre
        for bit in rng.sample(range(64), rng.randint(1, 5)):
            x ^= 1 << bit
        values.add(x)
    values |= {rng.getrandbits(64) for _ in range(60)}
    values = [v - 2**64 if v >= 2**63 else v for v in sorted(values)]
    got = {r["fp"]: r["label"] for r in S.fingerprint_components(spark.createDataFrame([(v,) for v in values], "fp long"), S.Ring(), block).collect()}
    want = plain_components([v % 2**64 for v in values])
    groups = {}
    for v, w in zip(values, want):
        groups.setdefault(w, set()).add(v)
    for own in groups.values():
        assert {got.get(v, v) for v in own} == ({min(own)} if len(own) > 1 else own)


def test_documents_are_grouped_as_by_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    texts = [None, "", " ", *base, *base[:10], *[t.upper() for t in base[:5]], *[t + " end" for t in base]]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[5] = None
    docs = spark.createDataFrame(list(zip(ids, texts, ["x"] * len(ids))), "doc_id long, text string, fp string").repartition(3)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fp"] % 2**64, r["component_id"]) for r in S.simhash_groups(docs).collect())
    fps = [plain_fingerprint(t) for t in texts]
    roots = plain_components(fps)
    least = {}
    for i, r in zip(ids, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    assert got == sorted((i if i is not None else -1, f, least.get(r)) for i, f, r in zip(ids, fps, roots))
    assert S.simhash_groups(docs.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(9)
    text = " ".join(f"word{rng.randint(0, 500)}" for _ in range(300))
    near = text.replace(text.split()[7], "changed", 1)
    other = " ".join(f"other{rng.randint(0, 500)}" for _ in range(300))
    rows = [(5, text, 1), (3, text, 2), (9, near, 3), (2, other, 4), (None, other, 5), (None, "alone text", 6), (7, "same row", 7), (7, "same row", 7), (1, None, 8), (0, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key int")
    kept = sorted(r["_key"] for r in S.drop_near_duplicates(docs).collect())
    assert kept == [2, 4, 6, 7, 9]
    assert S.drop_near_duplicates(docs).columns == docs.columns
    assert S.drop_near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_loops_and_nulls(spark):
    edges = [(i, i + 1) for i in range(40)] + [(i + 1, i) for i in range(40)] + [(100, 100), (None, 3), (50, 60), (60, 70), (70, 50)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 50: 50, 60: 50, 70: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_spanning_edges_connect_what_was_connected():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 50, 40), rng.integers(0, 50, 40)
    x, y = spanning_edges(a, b)
    assert len(x) < 50 and len(set(x.tolist())) == len(x)
    want, got = list(range(50)), list(range(50))
    for label, edges in ((want, zip(a.tolist(), b.tolist())), (got, zip(x.tolist(), y.tolist()))):
        for p, q in edges:
            low, high = sorted((label[p], label[q]))
            label[:] = [low if v == high else v for v in label]
    assert want == got


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(6)
    for n, shared in ((2000, 1600), (300, 260), (40, 40), (40, 20), (3, 1)):
        pool = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        a, b = pool[:n], np.concatenate((pool[:shared], pool[n : 2 * n - shared]))
        x, y = (np.frombuffer(S.sketch(h), dtype="<u2") for h in (a, b))
        true = shared / (2 * n - shared)
        assert len(S.alike(x[None], y, true - 0.15)) == 1 and len(S.alike(x[None], y, true + 0.15)) == 0
    empty = np.frombuffer(S.sketch(np.zeros(0, dtype=np.uint64)), dtype="<u2")
    assert len(S.alike(empty[None], empty, 0.8)) == 1 and len(S.alike(empty[None], x, 0.8)) == 0


@pytest.mark.parametrize("block", [4, 4096])
def test_verified_links_connect_copies_and_nothing_else(spark, block):
    rng = random.Random(12)
    rows, group = [], {}
    for g in range(3):
        base = [f"w{rng.randint(0, 10_000)}" for _ in range(400)]
        for k in range(15):
            words = list(base)
            for _ in range(k % 3):
                words[rng.randrange(400)] = f"x{rng.randint(0, 10_000)}"
            cid = 100 * g + k
            group[cid] = g
            rows.append((cid, 7, bytearray(S.sketch(S.shingle_hashes(" ".join(words), 5)))))
    rows.append((999, 8, bytearray(S.sketch(S.shingle_hashes("alone", 5)))))
    links = S.verified_links(spark.createDataFrame(rows, "cid long, label long, sketch binary"), 0.76, block).collect()
    assert all(group[r["a"]] == group[r["b"]] for r in links)
    label = {c: c for c in group}
    for r in links:
        low, high = sorted((label[r["a"]], label[r["b"]]))
        label = {c: low if v == high else v for c, v in label.items()}
    assert len(set(label.values())) == 3


def test_texts_of_the_same_words_in_another_order_stay(spark):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(3):
        rng.shuffle(words)
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0].upper()])], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in S.drop_near_duplicates(docs).collect()) == [0, 1, 2]


def jaccard(a, b):
    x, y = (set(S.shingle_hashes(t, 5).tolist()) for t in (a, b))
    return len(x & y) / len(x | y)


def edited_pairs(rng):
    """Pairs of texts, one with words inserted, appended or cut, whose similarity is 0.8 to 0.95."""
    out = []
    for size in (45, 120, 400, 900):
        for kind in ("insert", "append", "cut"):
            for share in (0.06, 0.1, 0.16):
                base = [f"p{len(out)}w{rng.randint(0, 5000)}" for _ in range(size)]
                n, at = max(1, int(size * share)), rng.randrange(size // 2)
                new = [f"p{len(out)}n{i}" for i in range(n)]
                other = {"insert": base[:at] + new + base[at:], "append": base + new, "cut": base[:-n]}[kind]
                pair = " ".join(base), " ".join(other)
                if 0.8 <= jaccard(*pair) <= 0.95:
                    out.append(pair)
    return out


def test_near_copies_with_inserted_appended_and_cut_passages_are_found(spark):
    pairs = edited_pairs(random.Random(14))
    assert len(pairs) >= 25
    docs = spark.createDataFrame([(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in S.drop_near_duplicates(docs).collect()) == [2 * i for i in range(len(pairs))]


def test_pairs_are_linked_at_the_similarity_itself(spark):
    """Pairs of similarities just below and just above 0.8, told apart as by brute force."""
    rng = random.Random(16)
    pairs = []
    for i in range(60):
        base = [f"q{i}w{j}" for j in range(600)]
        pairs.append((" ".join(base), " ".join(base + [f"q{i}n{j}" for j in range(rng.choice((110, 130, 140, 147, 151, 155, 165, 180)))])))
    close = [jaccard(*p) >= 0.8 for p in pairs]
    assert 10 < sum(close) < 50
    docs = spark.createDataFrame([(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)], "doc_id long, text string")
    kept = {r["doc_id"] for r in S.drop_near_duplicates(docs).collect()}
    assert [2 * i + 1 not in kept for i in range(60)] == close


@pytest.mark.parametrize("block", [4, 4096])
def test_settled_links_in_blocks(spark, block):
    rng = random.Random(17)
    texts = {}
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(300)]
        for k in range(8):
            texts[g * 10 + k] = " ".join(base + [f"n{rng.random()}" for _ in range(k)])
    rows = [(c, bytearray(np.unique(S.shingle_hashes(t, 5)).tobytes())) for c, t in texts.items()]
    sets = spark.createDataFrame(rows, "cid long, hashes binary")
    links = S.settled_links(sets.selectExpr("cid", "7L AS label"), sets, 0.8, 0.15, block).select("a", "b")
    got = {r["node"]: r["label"] for r in components(links).collect()}
    assert got == {c: c // 10 * 10 for c in texts}


@pytest.mark.parametrize("parts", [2, 4, 8, 16])
def test_wider_keys_find_every_close_pair(spark, parts, monkeypatch):
    monkeypatch.setattr(S.Ring, "parts", lambda ring, rows: parts)
    test_every_close_pair_shares_a_key_and_keeps_a_chain(spark, S.Ring())
    assert len(S.Ring().keys("fp", parts)) == 16 * parts


def test_keys_widen_with_the_number_of_fingerprints():
    parts = [S.Ring().parts(n) for n in (0, 10**5, 10**8, 10**10)]
    assert parts == sorted(parts) and parts[0] == 2 and parts[-1] >= 8


def test_groups_of_all_kinds_of_copies_are_those_of_brute_force(spark):
    rng = random.Random(21)
    texts = [None, "", "  ", "one", "one", "ONE two"]
    for g in range(25):
        base = [f"g{g}w{rng.randint(0, 300)}" for _ in range(rng.randint(6, 150))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 2)] = [f"x{rng.randint(0, 99)}" for _ in range(rng.randint(0, 3))]
            texts.append(" ".join(words))
    rng.shuffle(texts)
    sets = [set(S.shingle_hashes(t, 5).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in S.drop_near_duplicates(docs).collect()) == sorted(set(root))


def test_rows_that_differ_in_where_the_null_is(spark):
    rows = [(1, None, "a"), (1, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string")
    assert docs.select(row_key(docs)).distinct().count() == 2


def test_frequent_keys_join_like_others(spark, monkeypatch):
    left = spark.range(5000).selectExpr("IF(id < 3000, 0, id) AS k", "id AS v")
    right = left.groupBy("k").count().withColumnRenamed("count", "n")
    got = hot_join(left, right, "k", "n", 5000)
    assert got.count() == 5000 and got.filter("k = 0").count() == 3000 and got.filter("n = 3000").count() == 3000


def test_very_long_texts(spark):
    base = " ".join(f"w{i % 9173}" for i in range(300_000))
    docs = spark.createDataFrame([(1, base), (2, base + " end"), (3, "x" * 2_000_000), (4, "other words here")], "doc_id long, text string")
    rows = {r["doc_id"]: r["component_id"] for r in S.simhash_groups(docs).collect()}
    assert rows[1] == rows[2] == 1 and {rows[3], rows[4]} == {3, 4}
    assert sorted(r["doc_id"] for r in S.drop_near_duplicates(docs).collect()) == [1, 3, 4]
