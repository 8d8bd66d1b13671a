import hashlib
import random
import zlib

import numpy as np
import pytest

from skeinwork.llm import queries, trie
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(table):
    """The nodes by a reading of every prefix of every rebuilt conversation."""
    own = {}
    for conv_id, turn, role, text in sorted(table, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv_id is not None:
            own.setdefault(conv_id, []).append((role or "", text or ""))
    convs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, out = {}, []
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    def subtree(node):
        found = [node]
        for x in found:
            found += kids.get(x, [])
        return found

    for node, ids in members.items():
        below = subtree(node)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(node))
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(kids.get(node, [])), sum(x not in kids for x in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, table, schema=SCHEMA):
    df = spark.createDataFrame(table, schema) if not hasattr(table, "columns") else table
    got = trie.prefix_trie(trie.rebuilt(trie.sequences(df)))
    assert got.columns == trie.RESULT
    return sorted((tuple(r) for r in got.collect()), key=str)


def made(seed, n, words=3, turns=9):
    rng = random.Random(seed)
    return [(c, t, rng.choice("ua"), "ab"[rng.randrange(2)] * rng.randrange(words)) for c in rng.sample(range(3 * n), n) for t in range(rng.randint(1, turns))]


def test_the_query_equals_its_sql(spark):
    got = queries.op12_prefix_trie(spark, SF).toPandas()
    assert rows(got) == rows(connect(SF).sql(queries.ORACLES["op12_prefix_trie"]).df())
    table = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert plain(table) == sorted((tuple(None if x != x else x for x in r) for r in got[trie.RESULT].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("parts, block", [("1", 1 << 15), ("4", 7), ("3", 1), ("7", 3)])
def test_blocks_and_ranges_recombine(spark, monkeypatch, parts, block):
    monkeypatch.setattr(trie, "BLOCK_ROWS", block)  # forked workers see it
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        table = made(len(parts), 300)
        assert found(spark, table) == plain(table)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("block", [1, 4, 50, 10_000])
def test_blocks_without_spark(block):
    """block_nodes, the streamed digests and the roll-up against plain sums over all prefixes; sequences longer than a chunk."""
    rng = random.Random(block)
    turns = {}
    seqs = []
    for c in range(300):
        seq = [f"{rng.randrange(2)}" for _ in range(rng.choice([0, 1, 2, 3, 5, 40, 70]))]
        if seqs and rng.random() < 0.5:
            seq = rng.choice(seqs)[0][: rng.randrange(80)] + seq[:3]
        seqs.append((seq, c))
    code = lambda t: turns.setdefault(t, hashlib.md5(t.encode()).digest())
    rows_ = sorted((b"".join(map(code, s)), c, [len(t) + ord(t) for t in s]) for s, c in seqs)
    blocks = [rows_[i : i + block] for i in range(0, len(rows_), block)]
    nodes = [n for b in blocks for n in trie.block_nodes(np.array([c for _, c, _ in b]), [s for s, _, _ in b], np.array([x for *_, z in b for x in z], dtype=np.int64)).to_pylist()]
    members = {}
    for s, c, z in rows_:
        for d in range(len(z) + 1):
            members.setdefault(s[: 16 * d], []).append((c, z[d - 1] if d else 0))
    whole = [n for n in nodes if n["key"] is None]
    keyed = {n["key"] for n in nodes if n["key"] is not None}
    assert len(whole) + len(keyed) == len(members)
    want = sorted((min(m)[0], len(k) // 16, len(m)) for k, m in members.items())
    edge = {k: [n for n in nodes if n["key"] == k] for k in keyed}
    got = [(n["conv_id"], n["depth"], n["n_convs"]) for n in whole]
    got += [(min(n["conv_id"] for n in e), e[0]["depth"], sum(n["n_convs"] for n in e)) for e in edge.values()]
    assert sorted(got) == want
    saved = lambda k: sum((len(m) - 1) * m[0][1] for x, m in members.items() if x.startswith(k))
    by_place = {(min(m)[0], len(k) // 16): saved(k) for k, m in members.items()}
    assert all(n["suffix_bytes"] - n["bytes"] == by_place[n["conv_id"], n["depth"]] for n in whole)


def test_odd_rows(spark):
    table = [(1, 0, None, None), (1, None, "user", "first"), (1, 1, "", ""), (5, 0, "user", "x" * 50_000), (5, 0, "user", "x" * 50_000), (6, 0, "user", "é"), (7, 3, "a", ""), (None, 0, "user", "nobody"), (-3, 0, "user", "é"), (2**60, 0, "u", "far"), (0, 0, "system", "s"), (0, 1, "user", "q"), (4, 9, "user", "gone")]
    assert found(spark, table) == plain(table)
    wide = spark.createDataFrame([(*r, 1, "y") for r in table], f"{SCHEMA}, base int, Head string")
    assert found(spark, wide) == plain(table)


def test_copies_of_one_conversation(spark):
    table = [(c, t, "user", f"turn {t}") for c in range(0, 3000, 5) for t in range(4)] + [(c, 0, "user", f"own {c}") for c in range(1, 900, 5)]
    got = found(spark, table)
    assert got == plain(table)


def test_an_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []
