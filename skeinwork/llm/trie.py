"""The trie of conversation prefixes, from padded matrices of turn ids.

A conversation is the sequence of its turns' 128-bit ids. Sequences are range-partitioned and sorted; a task takes its range in blocks,
pads a block's ids to a matrix, lexsorts it, marks where a column's value or one before it changes (these are the starts of
nodes) and sums up every depth with reduceat. Only nodes on the paths of a block's first and last sequence may go on in
other blocks: these few are added up by key and rolled up by depth, all others are whole already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.llm.common import hot_join, materialise

#: A block ends with the sequence that reaches either bound; memory follows it, not the partition.
BLOCK_ROWS, BLOCK_IDS = 1 << 15, 1 << 18
#: Columns of the matrix that are padded and compared at once.
CHUNK = 32
#: First characters of role and text that order turns of one number; then their digest does.
HEAD_CHARS = 64
BASE_EVERY, BASE_TURNS = 5, 9
NO_ENDS = hashlib.sha256(b"").hexdigest()
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
NODES = (
    "key binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, suffix_bytes long, "
    "bytes long, own_bytes long, ends_sha256 string, first_end long, ends string"
)
_KINDS = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
_FIELDS = {name: _KINDS[kind] for name, kind in (c.split() for c in NODES.split(", "))}


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as an array of (id, n_bytes); id is 32 hex digits.

    Turns are ordered by number, nulls first, then by role and text (by their first characters, then by a digest).
    Null role or text count as empty, repeated rows as turns of their own. Rows without conv_id belong to no
    conversation and are left out. Of a turn only its id and the bytes of its text travel.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.col("turn").cast("long")
    place = (turn.isNotNull().alias("known"), F.coalesce(turn, F.lit(0)).alias("turn"), F.substring(role, 1, HEAD_CHARS).alias("role"), F.substring(text, 1, HEAD_CHARS).alias("text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    conv_id = F.col("conv_id").cast("long")
    slim = conversations.filter(conv_id.isNotNull()).select(conv_id.alias("conv_id"), F.struct(*place, digest.alias("id"), F.octet_length(text).cast("long").alias("n_bytes")).alias("t"))
    # Conversations that are rebuilt from one another meet in one partition, so the window of rebuilt() shuffles nothing.
    dealt = slim.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(BASE_EVERY))).repartition("base")
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["n_bytes"].alias("n_bytes")))
    return dealt.groupBy("base", "conv_id").agg(turns.alias("turns")).select("base", "conv_id", "turns")


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Conversation c becomes the first h turns of conversation c - c mod 5 (all of them if it has fewer, none if it is absent) and its own
    turns behind its first h; h is the unsigned crc32 of c in decimal digits, mod 9. The modulus is never negative."""
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(BASE_TURNS)).cast("int")
    own = F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, BASE_TURNS))
    head = F.coalesce(F.first(own, ignorenulls=True).over(Window.partitionBy("base")), F.slice("turns", 1, 0))
    joined = seqs.withColumn("h", h).withColumn("head", head)
    return joined.select("conv_id", F.concat(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns") + 1)).alias("turns"))


def _sorted_rows(ids: np.ndarray, start: np.ndarray, lens: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """The rows' order by sequence, then conv_id: stable lexsorts of the padded columns, from the last ones to the first."""
    order = np.argsort(conv, kind="stable")
    for low in range((int(lens.max()) - 1) // CHUNK * CHUNK, -1, -CHUNK):
        deep = lens[order] > low
        rows = order[deep]
        padded = _padded(ids, start, lens, rows, low)[0]
        keys = padded.reshape(len(rows), -1).T[::-1]
        order = np.concatenate([order[~deep], rows[np.lexsort(keys)]])  # the shorter ones end in what they share
    return order


def _padded(ids: np.ndarray, start: np.ndarray, lens: np.ndarray, rows: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows' ids from column `low` on, padded with zeros, and which of them are there."""
    columns = low + np.arange(min(CHUNK, int(lens[rows].max()) - low))
    there = columns < lens[rows][:, None]
    out = np.zeros((*there.shape, 2), dtype=np.uint64)
    out[there] = ids[(start[rows][:, None] + columns)[there]]
    return out, there


def _levels(conv: np.ndarray, ids: np.ndarray, start: np.ndarray, lens: np.ndarray, sizes: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Per depth, the nodes of sorted rows: first and last row, members, smallest member, bytes of the members from that depth
    on, bytes of the last turn, members that end there, and the parent's place in the depth before."""
    n = len(conv)
    total = np.concatenate([[0], np.cumsum(sizes)])
    every = np.array([0])
    root = {"first": every, "last": every + n - 1, "n": every + n, "conv": np.array([conv.min()]), "suffix": np.array([total[-1]]), "own": every, "ends": np.array([(lens == 0).sum()]), "parent": every - 1}
    levels, node_of = [root], np.zeros(n, dtype=np.int64)
    differs = np.zeros(n, dtype=bool)  # from the row before, in the columns so far
    for low in range(0, int(lens.max(initial=0)), CHUNK):
        deep = lens > low
        rows = np.flatnonzero(deep)
        matrix, there = _padded(ids, start, lens, rows, low)
        change = np.ones(there.shape, dtype=bool)
        change[1:] = (matrix[1:] != matrix[:-1]).any(axis=2) | (there[1:] & ~there[:-1])
        groups = np.cumsum(differs)[rows]
        change[1:, 0] |= groups[1:] != groups[:-1]
        change = np.logical_or.accumulate(change, axis=1)
        next_differs = differs.copy()
        next_differs[1:] |= deep[1:] != deep[:-1]
        next_differs[rows] |= change[:, -1]
        for at in range(there.shape[1]):
            here = there[:, at]
            sub, starts = rows[here], np.flatnonzero(change[here, at])
            ends, depth = np.append(starts[1:], len(sub)), low + at + 1
            first = sub[starts]
            levels.append({
                "first": first,
                "last": sub[ends - 1],
                "n": ends - starts,
                "conv": np.minimum.reduceat(conv[sub], starts),
                "suffix": np.add.reduceat(total[(start + lens)[sub]] - total[start[sub] + depth - 1], starts),
                "own": sizes[start[first] + depth - 1],
                "ends": np.add.reduceat((lens[sub] == depth).astype(np.int64), starts),
                "parent": node_of[first],
            })
            node_of = node_of.copy()
            node_of[sub] = np.cumsum(change[here, at]) - 1
        differs = next_differs
    return levels


def _keys(seq: bytes) -> list[bytes]:
    """A 128-bit key of each prefix of a sequence."""
    state, out = hashlib.blake2b(digest_size=16), []
    for at in range(0, len(seq) + 16, 16):
        out.append(state.digest())
        state.update(seq[at : at + 16])
    return out


def block_nodes(conv: np.ndarray, seqs: list[bytes], sizes: np.ndarray) -> pa.RecordBatch:
    """The nodes of one block (see NODES). Those on the path of its first or last sequence have a key, and of what lies below them
    they count only the nodes without one; the others are whole, but for the parent_conv_id of those whose parent has a key."""
    lens = np.array([len(s) // 16 for s in seqs], dtype=np.int64)
    ids = np.frombuffer(b"".join(seqs), dtype=">u8").astype(np.uint64).reshape(-1, 2)
    start = np.cumsum(lens) - lens
    if len(ids):
        order = _sorted_rows(ids, start, lens, conv)
    else:
        order = np.argsort(conv, kind="stable")
    conv, lens, start = conv[order], lens[order], start[order]
    paths, n = [_keys(seqs[order[0]]), _keys(seqs[order[-1]])], len(conv)
    levels = _levels(conv, ids, start, lens, sizes) if len(ids) else _levels(conv, ids, start, lens, np.zeros(0, dtype=np.int64))
    for level in levels:
        level["edge"] = (level["first"] == 0) | (level["last"] == n - 1)
    below = None
    for level in reversed(levels):
        zeros = lambda: np.zeros(len(level["n"]), dtype=np.int64)
        level |= {"bytes": zeros(), "leaves": zeros(), "children": zeros()}
        if below is not None:
            whole = ~below["edge"]
            for name, value in (("bytes", below["bytes"]), ("leaves", below["leaves"]), ("children", np.ones_like(below["n"]))):
                np.add.at(level[name], below["parent"][whole], value[whole])
        inner = ~level["edge"]
        level["bytes"][inner] += level["own"][inner]
        level["leaves"][inner & (level["children"] == 0)] = 1
        below = level

    out = {name: [] for name in _FIELDS}
    for depth, level in enumerate(levels):
        edge, parents, m = level["edge"], level["parent"], len(level["n"])
        above = levels[depth - 1] if depth else None
        by_key = above["edge"][parents] if depth else np.zeros(m, dtype=bool)
        key_of = lambda nodes, i, d: paths[0 if nodes["first"][i] == 0 else 1][d]
        out["key"] += [key_of(level, i, depth) if e else None for i, e in enumerate(edge.tolist())]
        out["parent"] += [key_of(above, p, depth - 1) if k else None for p, k in zip(parents.tolist(), by_key.tolist())]
        out["parent_conv_id"] += [None] * m if not depth else [None if k else c for c, k in zip(above["conv"][parents].tolist(), by_key.tolist())]
        for name, value in (("conv_id", "conv"), ("n_convs", "n"), ("n_children", "children"), ("n_leaves", "leaves"), ("suffix_bytes", "suffix"), ("bytes", "bytes"), ("own_bytes", "own")):
            out[name] += level[value].tolist()
        out["depth"] += [depth] * m
        for i, (first, ends, e) in enumerate(zip(level["first"].tolist(), level["ends"].tolist(), edge.tolist())):
            # Those that end in a node are its first rows, in the order of their conv_id.
            text = ",".join(map(str, conv[first : first + ends].tolist())) if ends else ""
            out["ends_sha256"].append(None if e else hashlib.sha256(text.encode()).hexdigest() if ends else NO_ENDS)
            out["ends"].append(text if e and ends else None)
            out["first_end"].append(int(conv[first]) if e and ends else None)
    return pa.RecordBatch.from_arrays([pa.array(out[name], kind) for name, kind in _FIELDS.items()], names=list(_FIELDS))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, seqs, sizes, held = [], [], [], 0

    def block() -> pa.RecordBatch:
        return block_nodes(np.array(conv, dtype=np.int64), seqs, np.array(sizes, dtype=np.int64))

    for batch in batches:
        for c, s, z in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "seq", "sizes"))):
            conv.append(c)
            seqs.append(s)
            sizes += z
            held += len(z)
            if len(conv) >= BLOCK_ROWS or held >= BLOCK_IDS:
                yield block()
                conv, seqs, sizes, held = [], [], [], 0
    if conv:
        yield block()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each key's pieces of text, which come in order: hashed as they pass, never put together."""
    key, state, keys, digests = None, None, [], []
    for batch in batches:
        for own, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if own != key:
                if state:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = own, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if state:
        keys.append(key)
        digests.append(state.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["key", "ends_sha256"])


EDGES = "key binary, parent binary, conv_id long, depth long, n_convs long, n_children long, n_leaves long, suffix_bytes long, bytes long, own_bytes long"
ROLLED = "key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, whole_children long"


def _roll_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each node with a key what the nodes with keys below it hold themselves, the deepest ones first."""
    parts = list(batches)
    if not parts or not sum(b.num_rows for b in parts):
        return
    table = pa.Table.from_batches(parts)
    key, parent = table.column("key").to_pylist(), table.column("parent").to_pylist()
    place = {k: i for i, k in enumerate(key)}
    up = np.array([place[p] if p is not None else -1 for p in parent], dtype=np.int64)
    col = {name: table.column(name).to_numpy().astype(np.int64) for name in table.column_names if name not in ("key", "parent")}
    whole = col["n_children"].copy()
    children = whole + np.bincount(up[up >= 0], minlength=len(key))
    leaves, size = np.where(children == 0, 1, col["n_leaves"]), col["bytes"] + col["own_bytes"]
    by_depth = np.argsort(-col["depth"], kind="stable")
    for nodes in np.split(by_depth, np.flatnonzero(np.diff(col["depth"][by_depth])) + 1):
        nodes = nodes[up[nodes] >= 0]
        np.add.at(leaves, up[nodes], leaves[nodes])
        np.add.at(size, up[nodes], size[nodes])
    parents = [int(col["conv_id"][u]) if u >= 0 else None for u in up]
    found = [key, col["conv_id"], col["depth"], parents, col["n_convs"], children, leaves, col["suffix_bytes"] - size, whole]
    names = [c.split()[0] for c in ROLLED.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if i == 0 else pa.int64()) for i, x in enumerate(found)], names=names)


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, unique and not null; turns, see sequences()); the root
    is the prefix of no turns.

    conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; root: null), n_convs (members), n_children, n_leaves (childless
    nodes in the subtree), saved_tokens ((n_convs - 1) times the bytes of the last turn's text, summed over the subtree),
    ends_sha256 (of the conv_ids, ascending and joined by commas, of members that end here).

    Equal sequences are ordered by conv_id, so copies part over ranges as other rows do. What a node's members and
    interior nodes add up to needs no other block; the nodes with keys (two paths a block) are grouped by Spark and rolled up
    in one task, whose rows are blocks times depth, without texts or ids of conversations. Those that end in one node
    are hashed as a stream, in order: a SHA-256 has no other way. A conversation is one row of 24 bytes a turn. Empty
    tables have no nodes, not even the root.
    """
    seq = F.unhex(F.array_join(F.col("turns.id"), ""))
    own = seqs.select("conv_id", seq.alias("seq"), F.col("turns.n_bytes").alias("sizes"))
    parts = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.repartitionByRange(parts, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    nodes = materialise(dealt.mapInArrow(_nodes, NODES), "trie-nodes")
    edge = nodes.filter(F.col("key").isNotNull())
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "suffix_bytes", "bytes")]
    same = [F.any_value(c).alias(c) for c in ("parent", "depth", "own_bytes")]
    edges = edge.groupBy("key").agg(*sums, *same, F.min("conv_id").alias("conv_id")).select(*[c.split()[0] for c in EDGES.split(", ")])
    rolled = materialise(edges.repartition(1).mapInArrow(_roll_up, ROLLED), "trie-edges")
    pieces = edge.filter(F.col("ends").isNotNull()).select("key", "first_end", "ends")
    ends = pieces.repartition("key").sortWithinPartitions("key", "first_end").select("key", "ends").mapInArrow(_digests, "key binary, ends_sha256 string")
    edge_rows = rolled.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))

    inner = nodes.filter(F.col("key").isNull()).withColumn("saved_tokens", F.col("suffix_bytes") - F.col("bytes"))
    below = inner.filter(F.col("parent").isNotNull()).drop("parent_conv_id")
    above = rolled.filter(F.col("whole_children") > 0).select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "whole_children")
    total = above.agg(F.sum("whole_children")).first()[0] or 0
    found = hot_join(below, above, "parent", "whole_children", total)
    return inner.filter(F.col("parent").isNull()).select(*RESULT).unionByName(found.select(*RESULT)).unionByName(edge_rows.select(*RESULT))
