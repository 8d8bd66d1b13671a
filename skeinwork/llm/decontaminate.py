"""Benchmark decontamination by spaced seeds.

A text becomes a sequence of token hashes (letters and digits, A-Z lower-cased; everything else in ASCII
separates). A seed is a fixed mask over a window of tokens: the tokens under its zeros are ignored, so a hit
survives substitutions there. The seeds' hashes of the benchmark are a table; so are those of the documents' windows
that pass a bit filter of bounded size, and the two are joined on the hash. Each text and item that share one
are laid over each other at every shift that a seed gives, and the best stretch of that overlap decides, substitutions
counting against it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import bound_batches, fresh, materialise

# The masks; a 1 is a token that must agree. They have weights of 6 to 8 within 7 to 13 tokens. The last four were chosen
# one after the other so that the least of the shares of leaks found is largest, over all ways in which 4 of 16 and 5 of 20 tokens may be substituted and
# still be a leak, and samples for 6 of 24 and 7 of 30: with all eight these shares are 0.99 or more.
MASKS = ("110110111", "1101100101011", "111010010111", "1111111", "1110001011", "11010100011", "10010001111", "11100001101")
#: Items of at most so many tokens are also looked up by the run of tokens that every accepted overlap of theirs has.
SHORT_TOKENS = 24
#: Tokens that are laid over each other at a time, and pairs of positions that are formed at a time.
OVERLAY = 2_000_000
#: Bytes of text that are laid out in one array at a time.
BATCH_BYTES = 1_000_000
#: Bits of the filter: 32 a seed within these powers of two, so it has 16 MB at most. Beyond that more windows pass that
#: the join then drops.
FILTER_BITS = (16, 27)
#: Windows of one hash that one join task gets; a more frequent hash is dealt over several.
HOT_WINDOWS = 50_000
#: Rows of a table of keys and numbers that is broadcast at most.
BROADCAST_ROWS = 500_000

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Rule:
    """When an overlap is a leak: its best stretch has `tokens` agreeing tokens (or the share `identity` of the
    item, if that is fewer) and a share of agreeing tokens of `identity` at least; or the whole item has that
    share. A stretch loses `penalty` a substitution."""

    tokens: int = 12
    identity: float = 0.75
    penalty: float = 1.5
    masks: tuple[str, ...] = field(default=MASKS)

    def whole(self, n: int) -> int:
        """Agreeing tokens that make an item of n tokens a leak as a whole."""
        return max(1, ceil(self.identity * n - 1e-9))

    def least(self, n: int) -> int:
        """Agreeing tokens that a leak of an item of n tokens has at least."""
        return min(self.tokens, self.whole(n))

    def run(self, n: int) -> int:
        """Agreeing tokens in a row that a leak of an item of n tokens has at least: that many remain, however
        the substitutions are spread over the least overlaps."""
        runs = []
        for size in range(self.least(n), n + 1):
            same = max(self.least(n), self.whole(size))
            runs.append(-(-same // (size - same + 1)))
        return min(runs)

    def run_windows(self, n: int) -> int:
        """Windows of run(n) agreeing tokens in a row that a leak of an item of n tokens has at least."""
        run, counts = self.run(n), []
        for size in range(self.least(n), n + 1):
            same = max(self.least(n), self.whole(size))
            counts.append(size - run + 1 - (size - same) * run)
        return max(1, min(counts))


def token_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, its first byte) of a text in UTF-8."""
    low = np.frombuffer(data.lower(), dtype=np.uint8)
    word = np.concatenate(([False], _WORD[low], [False]))
    edge = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    sizes = ends - starts
    inside = np.flatnonzero(word[1:-1])
    place = np.arange(len(inside)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        weighted = (low[inside].astype(np.uint64) + np.uint64(1)) * _powers(int(sizes.max()))[place]
        total = np.add.reduceat(weighted, np.cumsum(sizes) - sizes)
        mixed = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32)), starts


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), 0x9E3779B97F4A7C15, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


def window_hashes(tokens: np.ndarray, offsets: list[int], seed: int) -> np.ndarray:
    """Hash of the masked tokens of the window at each position."""
    n = len(tokens) - offsets[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, (seed + 1) * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for o in offsets:
            out = (out ^ tokens[o : o + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(31)
    return out


def offsets_of(mask: int, rule: Rule) -> list[int]:
    """Places of the agreeing tokens of a seed: those of a mask by its number, or from len(masks) on a run."""
    if mask < len(rule.masks):
        return [i for i, c in enumerate(rule.masks[mask]) if c == "1"]
    return list(range(mask - len(rule.masks) + 1))


def masks_of(n: int, rule: Rule) -> list[int]:
    """The seeds of an item of n tokens: few masks fit into a short item, and fewer miss its substitutions, so those
    have their run as well."""
    own = list(range(len(rule.masks)))
    return own + [len(rule.masks) + rule.run(n) - 1] if 0 < n <= SHORT_TOKENS else own


def _windows(tokens: np.ndarray, mask: int, rule: Rule) -> np.ndarray:
    return window_hashes(tokens, offsets_of(mask, rule), mask)


def shifts_of(tokens: np.ndarray, item: np.ndarray, rule: Rule) -> np.ndarray:
    """Every shift (position in the text less position in the item) at which the two share a seed, ascending.

    Where a hash is frequent in both, the shifts are marked in an array as long as the two texts, by a convolution, so
    memory does not grow with the product of the two.
    """
    few = []
    for mask in masks_of(len(item), rule):
        a, b = _windows(tokens, mask, rule), _windows(item, mask, rule)
        for h in np.intersect1d(a, b):
            at, place = np.flatnonzero(a == h), np.flatnonzero(b == h)
            if len(at) * len(place) <= OVERLAY // 8:
                few.append(np.unique(at[:, None] - place))
                continue
            size = 1 << int(len(a) + len(b)).bit_length()
            text, own = np.zeros(size), np.zeros(size)
            text[at], own[len(b) - 1 - place] = 1.0, 1.0
            met = np.fft.irfft(np.fft.rfft(text) * np.fft.rfft(own), size)[: len(a) + len(b) - 1] > 0.5
            few.append(np.flatnonzero(met) - (len(b) - 1))
    return np.unique(np.concatenate(few)) if few else np.zeros(0, dtype=np.int64)


def best_stretch(agree: np.ndarray, penalty: float) -> tuple[int, int, int]:
    """(agreeing tokens, first, end) of the stretch with the highest score."""
    score = np.where(agree, 1.0, -penalty)
    total = np.concatenate(([0.0], np.cumsum(score)))
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmin(total[: end + 1]))
    return int(agree[start:end].sum()), start, end


def leak(tokens: np.ndarray, item: np.ndarray, rule: Rule) -> tuple[int, int, int, int] | None:
    """(agreeing tokens, tokens of the stretch, its first token in the text, in the item) of the best overlap that the
    rule calls a leak: that of most agreeing tokens, then the longest, then the earliest."""
    n, best = len(item), None
    shifts = shifts_of(tokens, item, rule) if n and len(tokens) else np.zeros(0, dtype=np.int64)
    step = max(1, OVERLAY // max(1, n))
    for at in range(0, len(shifts), step):
        place = shifts[at : at + step, None] + np.arange(n)
        within = (place >= 0) & (place < len(tokens))
        agree = (tokens[np.where(within, place, 0)] == item) & within
        for row in np.flatnonzero(agree.sum(axis=1) >= rule.least(n)).tolist():
            shift = int(shifts[at + row])
            low, high = max(0, shift), min(len(tokens), shift + n)
            own = agree[row, low - shift : high - shift]
            same, start, end = best_stretch(own, rule.penalty)
            found = same >= rule.least(n) and same >= rule.identity * (end - start)
            if not found and own.sum() >= rule.whole(n):
                found, same, start, end = True, int(own.sum()), 0, high - low
            if found:
                one = (same, end - start, -(low + start), -(low + start - shift))
                best = one if best is None else max(best, one)
        if best and best[0] == n:
            break  # shifts ascend, so no later one is better
    return None if best is None else (best[0], best[1], -best[2], -best[3])


LEAKS = "item_id long, n_agree int, n_tokens int, doc_token int, item_token int"


def _key(text) -> list:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _few(df: DataFrame) -> DataFrame:
    """df, broadcast if it is counted to be small; a larger one is left to the optimiser."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def seed_table(items: DataFrame, rule: Rule) -> DataFrame:
    """(item, size, mask, hash): the distinct seeds of each row (item, text) of the benchmark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"]):
                tokens = token_hashes(text.encode())[0]
                for mask in masks_of(len(tokens), rule):
                    h = np.unique(_windows(tokens, mask, rule))
                    if len(h):
                        yield pd.DataFrame({"item": item, "size": len(tokens), "mask": mask, "hash": h.view(np.int64)})

    return items.select("item", "text").mapInPandas(run, "item long, size int, mask int, hash long")


FACTORS = (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _place(hashes: np.ndarray, j: int, bits: int) -> np.ndarray:
    """The j-th of the four bits of each hash in the filter."""
    with np.errstate(over="ignore"):
        return ((hashes * np.uint64(FACTORS[j])) >> np.uint64(64 - bits)).astype(np.int64)


def _filter(seeds: DataFrame, bits: int) -> np.ndarray:
    """The bit filter of the seeds' hashes: words of it are made by tasks and joined; their number is bounded."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = np.unique(np.concatenate([_place(batch["hash"].to_numpy().view(np.uint64), j, bits) for j in range(4)]))
            word, first = np.unique(place >> 6, return_index=True)
            if len(word):
                value = np.bitwise_or.reduceat(np.uint64(1) << (place & 63).astype(np.uint64), first)
                yield pd.DataFrame({"word": word, "value": value.view(np.int64)})

    words = seeds.select("hash").mapInPandas(run, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toPandas()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["value"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


@dataclass
class Probe:
    """What a task needs to find windows that may be seeds: the filter, and for each mask in use how many windows
    (of a text) have to lie within how many positions for a leak."""

    words: np.ndarray
    bits: int
    classes: dict[int, tuple[int, int]]
    rule: Rule

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        """Indexes of the hashes whose four bits are set."""
        rows = np.arange(len(hashes))
        for j in range(4):
            place = _place(hashes[rows], j, self.bits)
            rows = rows[(self.words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)]
        return rows

    def windows(self, tokens: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of the windows that pass, each once; texts holds the number of the text of each token."""
        out = []
        for mask, (needed, span) in self.classes.items():
            h = _windows(tokens, mask, self.rule)
            last = offsets_of(mask, self.rule)[-1]
            rows = self.may_hold(h)
            rows = rows[texts[rows] == texts[rows + last]]
            if needed > 1 and len(rows):  # a window counts if it lies among so many of its text within the span
                ends = np.searchsorted(rows, rows + span - last, "left")  # first one that is too far on
                start = np.flatnonzero(ends - np.arange(len(rows)) >= needed)
                keep = np.bincount(start, minlength=len(rows) + 1) - np.bincount(ends[start], minlength=len(rows) + 1)
                rows = rows[np.cumsum(keep[:-1]) > 0]
            if len(rows):
                pairs = np.stack((texts[rows], h[rows].view(np.int64)), axis=1)
                out.append(np.unique(pairs, axis=0))
        every = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), dtype=np.int64)
        return every[:, 0], every[:, 1]


def text_windows(texts: DataFrame, probe: Probe) -> DataFrame:
    """(k1, k2, hash): the windows of each row (k1, k2, text) that pass the filter."""
    shared = texts.sparkSession.sparkContext.broadcast(probe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("text").to_pylist()
            start = 0
            while start < len(values):
                stop, data, places = start, bytearray(), []
                while stop < len(values) and (stop == start or len(data) < BATCH_BYTES):
                    places.append(len(data))
                    data += values[stop].encode() + b"\n"
                    stop += 1
                tokens, at = token_hashes(bytes(data))
                row, found = shared.value.windows(tokens, np.searchsorted(places, at, "right") - 1)
                take = pa.array(row + start)
                yield pa.RecordBatch.from_arrays([batch.column("k1").take(take), batch.column("k2").take(take), pa.array(found)], names=["k1", "k2", "hash"])
                start = stop

    return texts.select("k1", "k2", "text").mapInArrow(run, "k1 long, k2 long, hash long")


def _joined(windows: DataFrame, seeds: DataFrame) -> DataFrame:
    """(k1, k2, item) that share a hash; a frequent hash is dealt over several tasks, its seeds go to each of them."""
    often = windows.groupBy("hash").count().filter(F.col("count") > HOT_WINDOWS).select("hash", F.ceil(F.col("count") / HOT_WINDOWS).cast("int").alias("n"))
    often = materialise(often, "leak-hot")
    if often.isEmpty():
        return windows.join(seeds.select("hash", "item"), "hash").select("k1", "k2", "item").distinct()
    hot = _few(often)
    left = windows.join(hot, "hash", "left").withColumn("part", F.pmod("k1", F.coalesce("n", F.lit(1))).cast("int")).drop("n")
    right = seeds.select("hash", "item").join(hot, "hash", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("n", F.lit(1)) - 1))).drop("n")
    return left.join(right, ["hash", "part"]).select("k1", "k2", "item").distinct()


@lru_cache(256)
def _item_tokens(text: str) -> np.ndarray:
    return token_hashes(text.encode())[0]


def _settled(rule: Rule):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, tokens = None, None
        for batch in batches:
            out = []
            for k1, k2, text, item_id, item in zip(batch["k1"], batch["k2"], batch["text"], batch["item_id"], batch["item_text"]):
                if (k1, k2) != key:
                    key, tokens = (k1, k2), token_hashes(text.encode())[0]
                found = leak(tokens, _item_tokens(item), rule)
                if found:
                    out.append((k1, k2, item_id, *found))
            rows = pd.DataFrame(out, columns=["k1", "k2", *(c.split()[0] for c in LEAKS.split(", "))])
            yield rows.astype({"item_id": object})

    return run


def text_leaks(docs: DataFrame, benchmark: DataFrame, rule: Rule) -> DataFrame | None:
    """(k1, k2, item_id, ...) of each distinct text (column text) and row of the benchmark that it leaks; None if the
    benchmark has no seeds."""
    bound_batches(docs.sparkSession)
    own = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text IS NOT NULL")
    items = materialise(own, "leak-items")
    seeds = materialise(seed_table(items, rule), "leak-seeds")
    masks = seeds.groupBy("mask").agg(F.max("size").alias("size"), F.collect_set(F.when(F.col("mask") >= len(rule.masks), F.col("size"))).alias("sizes"), F.count("*").alias("n")).collect()  # a row a mask
    if not masks:
        return None
    classes = {r["mask"]: (min((rule.run_windows(n) for n in r["sizes"]), default=1), r["size"]) for r in masks}
    bits = min(max(FILTER_BITS[0], (32 * sum(r["n"] for r in masks)).bit_length()), FILTER_BITS[1])
    texts = docs.filter(F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text")).select(*_key("text"), "text")
    windows = materialise(text_windows(texts, Probe(_filter(seeds, bits), bits, classes, rule)).distinct(), "leak-windows")
    pairs = materialise(_joined(windows, seeds), "leak-pairs")
    keys = materialise(pairs.select("k1", "k2").distinct(), "leak-keys")
    wanted = materialise(texts.join(_few(keys), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]), "leak-texts")
    asked = pairs.join(items.select("item", "item_id", F.col("text").alias("item_text")), "item")
    rows = wanted.join(asked, ["k1", "k2"]).select("k1", "k2", "text", "item_id", "item_text")
    return materialise(rows.mapInPandas(_settled(rule), f"k1 long, k2 long, {LEAKS}"), "leaks")


def find_leaks(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document and benchmark item that it leaks: doc_id, item_id, n_agree agreeing tokens within
    the n_tokens of the best stretch, which starts at doc_token of the document and item_token of the item.

    Null and empty texts leak nothing and are leaked by nothing; a short item leaks with the rule's share of its
    tokens; null ids stay null and repeated rows, of documents or of the benchmark, give repeated results. An empty
    benchmark gives no row. The benchmark stays a table; documents are read twice (once for windows, once for the texts
    that share one with it) and once more for their ids, however large it is.
    """
    found = text_leaks(docs, benchmark, rule)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"doc_id long, {LEAKS}")
    own = docs.select(F.col("doc_id").cast("long"), *_key(F.col("text").cast("string")))
    return own.join(_few(found), ["k1", "k2"]).select("doc_id", *(c.split()[0] for c in LEAKS.split(", ")))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """docs without the rows whose text leaks a benchmark item; rows with null or empty texts stay, as do all columns."""
    found = text_leaks(docs, benchmark, rule)
    if found is None:
        return docs
    k1, k2 = fresh(docs, "k1", "k2")
    text = F.col("text").cast("string")
    keyed = docs.withColumn(k1, F.xxhash64(text)).withColumn(k2, F.xxhash64(F.lit(1), text))
    keys = materialise(found.select(F.col("k1").alias(k1), F.col("k2").alias(k2)).distinct(), "leak-keys")
    return keyed.join(_few(keys), [k1, k2], "left_anti").select(docs.columns)
