"""SimHash near-duplicates: candidates by chains of segments (pigeonring), then the full Hamming check.

Let two fingerprints of 64 bits, laid out in a ring of m segments, differ in at most t bits. Then there is a
segment from which every chain of l = 1..m consecutive segments differs in at most floor(l * t / m) bits
(were each start to fail at some l, the failing chains would cover the ring with more than t differences).
So it is enough to look for such starts. The first segments of a chain may not differ at all and the next
ones in one bit at most, so of their parts all but one are equal: (start, exact segments, equal parts) is a
join key, and the more fingerprints there are, the more parts are made, which widens the key. Rows that share a key are compared in NumPy: the budgets of longer chains prune first, the whole
ring (the Hamming distance) decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import bound_batches, fresh, hot_join, materialise, row_key
from skeinwork.llm.components import components, spanning_edges

SEED = 42
#: Fingerprints of one key that are compared in one go; larger groups are cut into blocks of this size,
#: and each pair of blocks is a group of its own.
BLOCK = 4096
#: What writing and sorting a key costs, in comparisons of two fingerprints.
KEY_COST = 20.0
#: SQL of the pairs of blocks (numbered) that a row of block `own` of `n` takes part in: the pair of a block with itself
#: is part of each pair of it with another.
PAIRS = "CASE WHEN n = 1 THEN array(0) ELSE transform(filter(sequence(0, n - 1), x -> x <> own), x -> least(x, own) * n + greatest(x, own)) END"
#: Up to this size a group is compared by offsets, all groups of a batch together.
SMALL = 48


def normal_words(text: str | None) -> list[bytes]:
    """Words of a text (UTF-8, A-Z lower-cased), cut at space and tab to carriage return."""
    return [] if text is None else text.encode().lower().split()


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of each shingle of `width` words, repeats included; shorter texts are one shingle."""
    words = normal_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(words)
    cuts = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 0x20)
    starts = [0, *(cuts + 1).tolist()]
    ends = [*cuts.tolist(), len(line)][min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends)], dtype=np.uint64)


def word_hashes(text: str | None) -> np.ndarray:
    """XXH64 of each distinct word."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w, SEED) for w in set(normal_words(text))], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes, as a signed 64-bit integer; zero without hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[at : at + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_column(width: int | None):
    """A column function: text to its fingerprint over word shingles, or over distinct words (None)."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(word_hashes(t) if width is None else shingle_hashes(t, width)) for t in texts], dtype="int64")

    return run


@dataclass(frozen=True)
class Ring:
    """The layout of a ring: `segments` segments of 64 bits in all, at most `limit` differing bits."""

    limit: int = 4
    segments: int = 16

    def __post_init__(self) -> None:
        if 64 % self.segments or not 0 <= self.limit < self.segments:
            raise ValueError("segments divide 64 and are more than the limit")

    @property
    def width(self) -> int:
        return 64 // self.segments

    def budget(self, length: int) -> int:
        return length * self.limit // self.segments

    @property
    def exact(self) -> int:
        """Bits from a chain's start that are equal."""
        return self.width * max(n for n in range(1, self.segments + 1) if self.budget(n) == 0)

    @property
    def loose(self) -> int:
        """Bits behind them with one difference at most."""
        return self.width * max(n for n in range(1, self.segments + 1) if self.budget(n) <= 1) - self.exact

    @property
    def checks(self) -> list[tuple[int, int]]:
        """(bits from the start, differences allowed): the last chain of each budget, the whole ring last."""
        last = {self.budget(n): n * self.width for n in range(1, self.segments + 1)}
        return [(bits, budget) for budget, bits in sorted(last.items())]

    def parts(self, rows: int) -> int:
        """Parts that the loose bits are cut into: with one difference at most, all parts but one are equal. More parts make
        wider keys, but more of them; so many are taken that writing the keys of `rows` fingerprints and comparing what
        shares one (random ones) costs least. Any number finds every pair."""
        most = [n for n in (2, 4, 8, 16) if n <= self.loose] or [1]
        return min(most, key=lambda n: n * (KEY_COST + rows / 2.0 ** (self.exact + self.loose - self.loose // n)))

    def keys(self, value: str, parts: int = 2) -> list[str]:
        """SQL of the keys of a fingerprint: the start and the part left out, then the exact bits and the other parts."""
        out = []
        for start in range(self.segments):
            k = start * self.width
            turned = f"({value})" if k == 0 else f"(shiftleft({value}, {k}) | shiftrightunsigned({value}, {64 - k}))"
            head = turned if self.exact == 64 else f"shiftrightunsigned({turned}, {64 - self.exact})"
            if self.limit == 0 or self.loose == 0:
                out.append(f"struct({start} AS start, {head} AS bits)")
                if self.limit == 0:
                    break
                continue
            loose = f"(shiftrightunsigned({turned}, {64 - self.exact - self.loose}) & {2**self.loose - 1}L)"
            cuts = [self.loose * i // parts for i in range(parts + 1)]
            for part, (low, high) in enumerate(zip(cuts, cuts[1:])):
                rest = f"(shiftleft(shiftrightunsigned({loose}, {high}), {low}) | ({loose} & {2**low - 1}L))"
                out.append(f"struct({start + part * self.segments} AS start, (shiftleft({head}, {self.loose - high + low}) | {rest}) AS bits)")
        return out


def _turn(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    left = bits.astype(np.uint64)
    return (values << left) | np.where(left == 0, np.uint64(0), values >> ((np.uint64(64) - left) & np.uint64(63)))


def _viable(difference: np.ndarray, checks: list[tuple[int, int]]) -> np.ndarray:
    """Indexes of (turned) differences whose chains all keep their budgets."""
    rows = np.arange(len(difference))
    for bits, budget in checks:
        if not len(rows):
            break
        rows = rows[np.bitwise_count(difference[rows] >> np.uint64(64 - bits)) <= budget]
    return rows


def _large_group(values: np.ndarray, checks: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of one group's links: rows reached are compared with the rows not reached yet."""
    a_out, b_out = [], []
    left = np.arange(len(values))
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            node, front = front[0], front[1:]
            hit = _viable(values[left] ^ values[node], checks)
            if len(hit):
                reached = left[hit]
                a_out.append(np.full(len(reached), node))
                b_out.append(reached)
                front = np.concatenate((front, reached))
                left = np.delete(left, hit)
    if not a_out:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(a_out), np.concatenate(b_out)


def group_links(group: np.ndarray, start: np.ndarray, values: np.ndarray, ring: Ring) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal group (rows lie sorted by it), as few as keep the groups connected."""
    turned = _turn(values.view(np.uint64), (start % ring.segments) * ring.width)
    checks = ring.checks
    bounds = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.append(bounds, len(group)))
    end = np.repeat(bounds + sizes, sizes)
    a_out, b_out = [], []
    rows = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL), sizes))
    step = 1
    while True:
        rows = rows[rows + step < end[rows]]
        if not len(rows):
            break
        hit = rows[_viable(turned[rows] ^ turned[rows + step], checks)]
        a_out.append(hit)
        b_out.append(hit + step)
        step += 1
    for at in np.flatnonzero(sizes > SMALL):
        a, b = _large_group(turned[bounds[at] : bounds[at] + sizes[at]], checks)
        a_out.append(a + bounds[at])
        b_out.append(b + bounds[at])
    a = np.concatenate(a_out) if a_out else np.zeros(0, dtype=np.int64)
    b = np.concatenate(b_out) if b_out else np.zeros(0, dtype=np.int64)
    return spanning_edges(values[a], values[b])


#: Rows that a task compares at a time.
CHUNK = 150_000


def _links_of_partition(ring: Ring):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found(parts: list[pd.DataFrame], last: bool) -> tuple[pd.DataFrame | None, list[pd.DataFrame]]:
            rows = pd.concat(parts, ignore_index=True)
            key = rows[["start", "bits", "block"]].to_numpy()
            new = np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))
            group = np.cumsum(new)
            keep = len(rows) if last else int(np.flatnonzero(new)[-1])  # the last group may go on
            if not keep:
                return None, [rows]
            a, b = group_links(group[:keep], key[:keep, 0], rows["fp"].to_numpy()[:keep], ring)
            return pd.DataFrame({"a": a, "b": b}), [rows[keep:]] if keep < len(rows) else []

        parts: list[pd.DataFrame] = []
        for batch in batches:
            if len(batch):
                parts.append(batch)
            if sum(map(len, parts)) >= CHUNK:
                out, parts = found(parts, False)
                if out is not None:
                    yield out
        if parts:
            yield found(parts, True)[0]

    return run


def fingerprint_links(fingerprints: DataFrame, ring: Ring, block: int = BLOCK) -> DataFrame:
    """Links (a, b) among the distinct values of column fp, enough of them to keep every group connected.

    Groups of over `block` fingerprints with one key are cut into blocks by a hash of the fingerprint; every
    pair of blocks is compared by a task of its own, so no task holds more than two blocks of a group.
    """
    parts = ring.parts(fingerprints.count())
    keys = fingerprints.select("fp", F.explode(F.expr(f"array({', '.join(ring.keys('fp', parts))})")).alias("key")).select("key.start", "key.bits", "fp")
    hot = materialise(keys.groupBy("start", "bits").count().filter(F.col("count") > block).withColumn("blocks", F.ceil(F.col("count") / block).cast("int")).drop("count"), "simhash-hot")
    if hot.isEmpty():
        rows = keys.withColumn("block", F.lit(0))
    else:
        joined = keys.join(hot, ["start", "bits"], "left").withColumn("n", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
        rows = joined.select("start", "bits", F.explode(F.expr(PAIRS)).alias("block"), "fp")
    dealt = rows.repartition("start", "bits", "block").sortWithinPartitions("start", "bits", "block")
    return dealt.select("start", "bits", "block", "fp").mapInPandas(_links_of_partition(ring), "a long, b long").distinct()


def fingerprint_components(fingerprints: DataFrame, ring: Ring, block: int = BLOCK) -> DataFrame:
    """(fp, label) of each fingerprint that has a link; label is the component's smallest fingerprint."""
    return components(materialise(fingerprint_links(fingerprints, ring, block), "simhash-links")).select(F.col("node").alias("fp"), "label")


def simhash_groups(docs: DataFrame, width: int | None = 4, limit: int = 4, segments: int = 16) -> DataFrame:
    """One row per document: doc_id, fp (long), component_id (the smallest doc_id of its component).

    width is the shingle's number of words; None takes the distinct words instead. Texts without words
    (null, empty, white space) have fingerprint zero, linked like any other. Repeated rows stay repeated; rows
    with a null doc_id take part, and a component of such rows alone has a null component_id. Columns but
    doc_id and text are left out. Rows of equal fingerprints meet only in aggregates and in joins to which frequent
    keys are broadcast, so copies do not gather in a task.
    """
    bound_batches(docs.sparkSession)
    own = materialise(docs.select(F.col("doc_id").cast("long"), fingerprint_column(width)(F.col("text").cast("string")).alias("fp")), "simhash-fp")
    distinct = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-distinct")
    labels = fingerprint_components(distinct.select("fp"), Ring(limit, segments))
    labelled = materialise(distinct.join(labels, "fp", "left").select("fp", "least", "n", F.coalesce("label", "fp").alias("label")), "simhash-labels")
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    of_fp = materialise(hot_join(labelled, smallest, "label", "members", labelled.count()).select("fp", "n", "component_id"), "simhash-least")
    return hot_join(own, of_fp, "fp", "n", own.count()).select("doc_id", "fp", "component_id")


#: Bins of a sketch of shingle hashes.
BINS = 256


def sketch(hashes: np.ndarray) -> bytes:
    """16 bits of the smallest hash in each of 256 bins (by the hash's first bits); 0 for an empty bin.

    The share of equal bins among those that either of two sketches fills estimates the similarity (Jaccard) of
    the two sets, with a standard error of 0.025 at 0.8; for short texts it is nearly exact.
    """
    own = np.unique(hashes)
    bins, first = np.unique((own >> np.uint64(56)).astype(np.int64), return_index=True)
    out = np.zeros(BINS, dtype="<u2")
    out[bins] = ((own[first] >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.uint16) | 1
    return out.tobytes()


#: Bins of a band. Two texts of a similarity of 0.8 agree in one of the 43 bands but for 3 pairs in a million.
BAND = 6


def bands(own: bytes) -> list[int]:
    """A hash of each band of bins of a sketch that is not empty; the last band goes on with the first bins."""
    bins = np.frombuffer(own, dtype="<u2")
    rows = np.resize(bins, (-(-BINS // BAND), BAND))
    digest = xxhash.xxh64_intdigest
    return [digest(rows[i].tobytes(), SEED + i) - 2**63 for i in np.flatnonzero(rows.any(axis=1)).tolist()]


def alike(sketches: np.ndarray, one: np.ndarray, least: float) -> np.ndarray:
    """Indexes of the sketches whose estimated similarity to one of them is `least` or more; empty ones are alike."""
    same = ((sketches == one) & (one != 0)).sum(axis=1)
    either = ((sketches != 0) | (one != 0)).sum(axis=1)
    return np.flatnonzero(same >= least * either)


def sketched_column(width: int | None, shingle: int):
    """A column function: text to struct(fp over `width` words or distinct ones, cid, bands); cid is a hash of the
    set of its shingles, bands are those of their sketch."""

    @F.pandas_udf("fp long, cid long, bands array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            fp = [fingerprint(word_hashes(t) if width is None else shingle_hashes(t, width)) for t in texts]
            own = [np.unique(shingle_hashes(t, shingle)) for t in texts]
            cid = [xxhash.xxh64_intdigest(x.tobytes(), SEED) - 2**63 for x in own]
            yield pd.DataFrame({"fp": np.array(fp, dtype=np.int64), "cid": np.array(cid, dtype=np.int64), "bands": pd.Series([bands(sketch(x)) for x in own], dtype=object)})

    return run


def _verified(least: float):
    def links(ids: np.ndarray, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a_out, b_out = [], []
        left = np.arange(len(ids))
        while len(left):
            front, left = [int(left[0])], left[1:]
            while front and len(left):
                node = front.pop()
                hit = alike(sketches[left], sketches[node], least)
                if len(hit):
                    front += left[hit].tolist()
                    a_out.append(np.full(len(hit), ids[node]))
                    b_out.append(ids[left[hit]])
                    left = np.delete(left, hit)
        none = np.zeros(0, dtype=np.int64)
        return (np.concatenate(a_out), np.concatenate(b_out)) if a_out else (none, none)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in chain(batches, (None,)):
            last = batch is None
            rows = rest if last else batch if rest is None else pd.concat((rest, batch), ignore_index=True)
            if rows is None or not len(rows):
                continue
            key = rows[["label", "block"]].to_numpy()
            bounds = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1))))
            ends = np.append(bounds[1:], len(rows))
            whole = len(bounds) if last else len(bounds) - 1  # the last group may go on
            ids, data = rows["cid"].to_numpy(), rows["sketch"]
            found = [links(ids[i:j], np.frombuffer(b"".join(data.iloc[i:j]), dtype="<u2").reshape(-1, BINS)) for i, j in zip(bounds[:whole], ends[:whole])]
            if found:
                yield pd.DataFrame({"a": np.concatenate([x for x, _ in found]), "b": np.concatenate([y for _, y in found])})
            rest = None if last else rows.iloc[bounds[-1] :]

    return run


def verified_links(classes: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Links (a, b) among the cid of classes (cid, label, sketch) that share a label and whose sketches are alike, enough
    of them to keep what is alike connected. Labels of over `block` classes are cut into pairs of blocks."""
    sizes = classes.groupBy("label").count().filter("count > 1").select("label", F.ceil(F.col("count") / block).cast("int").alias("n"))
    own = classes.join(sizes, "label").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("n")).cast("int"))
    rows = own.select("label", F.explode(F.expr(PAIRS)).alias("block"), "cid", "sketch")
    dealt = rows.repartition("label", "block").sortWithinPartitions("label", "block")
    return dealt.mapInPandas(_verified(least), "a long, b long").distinct()


def set_column(shingle: int):
    """A column function: text to the sorted distinct hashes of its shingles, 8 bytes each."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([np.unique(shingle_hashes(t, shingle)).astype("<u8").tobytes() for t in texts], dtype=object)

    return run


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets, given as sorted arrays of distinct values."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return same / (len(both) - same) if len(both) else 1.0


def settled(ids: np.ndarray, sets: list[np.ndarray], least: float, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links of a similarity of `least` or more: the sketches leave out pairs of less than
    `least` - `slack` by their estimate, the sets decide on the rest."""
    sketches = np.frombuffer(b"".join(map(sketch, sets)), dtype="<u2").reshape(-1, BINS)
    sizes = np.array([len(x) for x in sets])
    a_out, b_out = [], []
    left = np.arange(len(ids))
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            node = front.pop()
            low, high = np.minimum(sizes[left], sizes[node]), np.maximum(sizes[left], sizes[node])
            maybe = np.flatnonzero(low >= least * high)
            maybe = maybe[alike(sketches[left[maybe]], sketches[node], least - slack)]
            hit = np.array([i for i in maybe.tolist() if jaccard(sets[left[i]], sets[node]) >= least], dtype=np.int64)
            if len(hit):
                front += left[hit].tolist()
                a_out.append(np.full(len(hit), ids[node]))
                b_out.append(ids[left[hit]])
                left = np.delete(left, hit)
    none = np.zeros(0, dtype=np.int64)
    return (np.concatenate(a_out), np.concatenate(b_out)) if a_out else (none, none)


def _settled_groups(least: float, slack: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, sets = None, [], []
        for batch in chain(batches, (None,)):
            rows = [] if batch is None else zip(zip(batch["label"], batch["block"]), batch["cid"], batch["hashes"])
            a_out, b_out = [], []
            for own, cid, hashes in chain(rows, ((None, 0, b""),) if batch is None else ()):
                if own != key:
                    if len(ids) > 1:
                        a, b = settled(np.array(ids, dtype=np.int64), sets, least, slack)
                        a_out.append(a)
                        b_out.append(b)
                    key, ids, sets = own, [], []
                ids.append(cid)
                sets.append(np.frombuffer(bytes(hashes), dtype="<u8"))
            if a_out:
                yield pd.DataFrame({"a": np.concatenate(a_out), "b": np.concatenate(b_out)})

    return run


#: Bytes of sets that a block of a group holds, about.
BLOCK_BYTES = 32_000_000


def settled_links(members: DataFrame, sets: DataFrame, least: float, slack: float, block: int = BLOCK, size: int = BLOCK_BYTES) -> DataFrame:
    """Links (a, b) among the cid of members (cid, label) that share a label and whose sets of shingles, from sets
    (cid, hashes), have a similarity of `least` or more: enough to keep what is linked connected. Labels of over
    `block` members or `size` bytes are cut into pairs of blocks."""
    sized = members.join(sets.select("cid", F.length("hashes").alias("bytes")), "cid")
    blocks = F.ceil(F.greatest(F.count("*") / block, F.sum("bytes") / size)).cast("int")
    sized = materialise(sized, "simhash-sized")
    labels = materialise(sized.groupBy("label").agg(F.greatest(blocks, F.lit(1)).alias("n"), F.count("*").alias("members")), "simhash-sizes")
    own = hot_join(sized, labels, "label", "members", sized.count()).withColumn("own", F.pmod(F.xxhash64("cid"), F.col("n")).cast("int"))
    rows = own.select("label", F.explode(F.expr(PAIRS)).alias("block"), "cid").join(sets, "cid")
    dealt = rows.repartition("label", "block").sortWithinPartitions("label", "block")
    return dealt.select("label", "block", "cid", "hashes").mapInPandas(_settled_groups(least, slack), "a long, b long").distinct()


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(label, cid) of each group of two classes or more that share a band or a label, from (cid, label, bands).
    Of groups with the same members one stays."""
    keys = materialise(classes.select("cid", F.explode(F.concat("bands", F.array(F.xxhash64(F.lit("label"), "label")))).alias("label")), "simhash-bands")
    groups = keys.groupBy("label").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("cid")).alias("x"), F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("y"))
    once = materialise(groups.filter("n > 1").groupBy("n", "x", "y").agg(F.min("label").alias("label")).select("label", "n"), "simhash-groups")
    return hot_join(keys, once, "label", "n", keys.count()).select("label", "cid")


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, slack: float = 0.15, width: int | None = None, limit: int = 4, segments: int = 16) -> DataFrame:
    """docs with one row of each group of near-duplicates: that of the smallest doc_id (null last).

    Candidates are texts that share a band of the sketches of their shingles, and texts whose fingerprints are
    connected within `limit` bits, by default over the distinct words. The bands find texts of the similarity
    however they differ; the fingerprints alone lose inserted, appended and cut passages. Among candidates, texts are linked whose similarity (Jaccard, on
    the distinct shingles of `shingle` words) is `similarity` or more; pairs whose estimate by sketches falls short
    by over `slack`, six standard errors, are not looked at. Groups are the components of these links. Texts without words are one group. Of
    repeated rows one stays; all columns are kept, of any name.
    """
    bound_batches(docs.sparkSession)
    (key,) = fresh(docs, "key")
    keyed = docs.select("*", row_key(docs).alias(key))
    order = F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id"), F.col(key).alias("row"))
    own = keyed.select(order.alias("row"), sketched_column(width, shingle)(F.col("text").cast("string")).alias("s")).select("row", "s.*")
    own = materialise(own, "simhash-fp")
    classes = materialise(own.groupBy("cid").agg(F.min("row").alias("least"), F.first("fp").alias("fp"), F.first("bands").alias("bands")), "simhash-distinct")
    candidates = fingerprint_components(classes.select("fp").distinct(), Ring(limit, segments))
    labelled = classes.join(candidates, "fp", "left").select("cid", F.coalesce("label", "fp").alias("label"), "bands")
    members = materialise(candidate_groups(labelled), "simhash-candidates")
    wanted = classes.join(members.select("cid").distinct(), "cid").select("cid", F.col("least.row").alias(key))
    texts = keyed.select(key, F.col("text").cast("string").alias("text")).join(wanted, key).select("cid", "text").dropDuplicates(["cid"])
    sets = materialise(texts.select("cid", set_column(shingle)("text").alias("hashes")), "simhash-sets")
    groups = components(materialise(settled_links(members, sets, similarity, slack), "simhash-alike"))
    grouped = classes.join(groups.select(F.col("node").alias("cid"), "label"), "cid", "left").select("least", F.coalesce("label", "cid").alias("label"))
    kept = grouped.groupBy("label").agg(F.min("least").alias("least")).select(F.col("least.row").alias(key))
    survivors = keyed.join(kept, key, "left_semi")
    return survivors.dropDuplicates([key]).select(docs.columns)
