"""Byte-level BPE: pre-tokens by a parallel scan over an automaton, cached pair merging, exact decoding.

The usual pre-token pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

needs no regex: every code point falls into one of eight symbol classes (the class already says what a
look-ahead of at most two code points would), and an automaton of eight states says for each symbol whether
a pre-token starts there. The symbol's transition is a function from states to states; functions compose
associatively, and the automaton's functions close under composition into a small monoid, so the state
before every code point of a whole batch of texts comes from one prefix scan over monoid elements, each
step a table look-up on a NumPy array. The start of a text is a function that forgets the past, so texts
lie in one array and do not touch each other.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.llm.common import bound_batches, fresh

# Symbol classes of the automaton.
LETTER, NUMBER, OTHER, QUOTE_1, QUOTE_2, JOIN, LONE, SPACE = range(8)
# States: what stands before the next code point.
BEGIN, JOINED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, ONE_LEFT, TWO_LEFT = range(8)

# The two kinds of contraction, by what follows the apostrophe.
CONTRACTIONS_1 = "stmd"
CONTRACTIONS_2 = ("re", "ve", "ll")
# The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Pre-tokens a task keeps merged; beyond it the cache starts anew, so memory stays bounded.
CACHE_ENTRIES = 150_000
#: Longer pre-tokens are merged with a heap and are not cached.
LONG_PIECE = 96
#: Code points that are laid out in one array at a time.
BATCH_CHARS = 500_000


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a symbol, and whether a pre-token starts at the symbol."""
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return BEGIN, False
    if symbol == LETTER:
        return IN_LETTERS, state not in (JOINED, IN_LETTERS)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (JOINED, IN_NUMBERS)
    if symbol in (OTHER, QUOTE_1, QUOTE_2):
        if state in (JOINED, IN_OTHERS):
            return IN_OTHERS, False
        return (IN_OTHERS, ONE_LEFT, TWO_LEFT)[(OTHER, QUOTE_1, QUOTE_2).index(symbol)], True
    if symbol == JOIN:
        return JOINED, True
    if symbol == LONE:
        return BEGIN, True
    return IN_SPACES, state != IN_SPACES


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(element of a symbol, element of a symbol at a text's start, products, end state from BEGIN, starts).

    The products are of the monoid that the symbols' transition functions and the forgetting function
    generate: products[a * n + b] is "a, then b".
    """
    forget = (BEGIN,) * 8
    symbols = [tuple(_step(s, x)[0] for s in range(8)) for x in range(8)]
    elements = [tuple(range(8)), forget, *symbols]
    elements = list(dict.fromkeys(elements))
    grown = 0
    while grown < len(elements):
        a = elements[grown]
        for b in [forget, *symbols]:
            c = tuple(b[s] for s in a)
            if c not in elements:
                elements.append(c)
        grown += 1
    index = {e: i for i, e in enumerate(elements)}
    n = len(elements)
    products = np.array([index[tuple(b[s] for s in a)] for a in elements for b in elements], dtype=np.uint8 if n < 256 else np.uint16)
    of_symbol = np.array([index[x] for x in symbols], dtype=products.dtype)
    at_start = np.array([index[tuple(x[s] for s in forget)] for x in symbols], dtype=products.dtype)
    ends = np.array([e[BEGIN] for e in elements], dtype=np.uint8)
    starts = np.array([_step(s, x)[1] for s in range(8) for x in range(8)], dtype=bool)
    return of_symbol, at_start, products, ends, starts


def scan(elements: np.ndarray, products: np.ndarray, n: int) -> np.ndarray:
    """All prefix products, by pairs: the products of neighbours are scanned, then the gaps are filled."""
    if len(elements) < 64:
        out = elements.copy()
        for i in range(1, len(out)):
            out[i] = products[int(out[i - 1]) * n + int(out[i])]
        return out
    even = len(elements) & ~1
    pairs = products[elements[0:even:2].astype(np.uint32) * np.uint32(n) + elements[1:even:2]]
    half = scan(pairs, products, n)
    out = np.empty_like(elements)
    out[0] = elements[0]
    out[1:even:2] = half
    rest = elements[2::2]
    out[2::2] = products[half[: len(rest)].astype(np.uint32) * np.uint32(n) + rest]
    return out


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER for each code point."""
    out = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    categories = "".join(unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1))
    letters = np.frombuffer(categories.encode(), dtype=np.uint8)
    out[letters == ord("L")] = LETTER
    out[letters == ord("N")] = NUMBER
    out[WHITE_SPACE] = SPACE
    return out


def symbols_of(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbol classes of code points; first marks the first code point of each text."""
    classes = code_point_classes()[points]
    n = len(points)
    after = np.ones(n, dtype=bool)  # the text ends here
    after[:-1] = first[1:]
    space = classes == SPACE
    next_space = np.ones(n, dtype=bool)
    next_space[:-1] = space[1:]
    alone = space & ~next_space & ~after
    blank = points == 0x20
    classes[alone & blank] = JOIN
    classes[alone & ~blank] = LONE
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        padded = np.append(points, [0, 0])
        ends = np.append(after, [True, True])
        one, two = padded[quotes + 1], padded[quotes + 2]
        within_1 = ~ends[quotes]
        within_2 = within_1 & ~ends[quotes + 1]
        short = within_1 & np.isin(one, [ord(c) for c in CONTRACTIONS_1])
        long = within_2 & np.isin(one * np.uint32(65536) + two, [ord(a) * 65536 + ord(b) for a, b in CONTRACTIONS_2]) & (two < 65536) & (one < 65536)
        classes[quotes[long]] = QUOTE_2
        classes[quotes[short]] = QUOTE_1
    return classes


def pretoken_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Marks each code point at which a pre-token starts."""
    if not len(points):
        return np.zeros(0, dtype=bool)
    of_symbol, at_start, products, ends, starts = automaton()
    symbols = symbols_of(points, first)
    elements = np.where(first, at_start[symbols], of_symbol[symbols])
    state = np.empty(len(points), dtype=np.uint8)
    state[0] = BEGIN
    state[1:] = ends[scan(elements, products, len(ends))[:-1]]
    state[first] = BEGIN
    return starts[state.astype(np.uint16) * np.uint16(8) + symbols]


def read_ranks(path: str) -> list[bytes]:
    """The bytes of each id, from a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    out = [b""] * len(pairs)
    for word, rank in pairs:
        out[int(rank)] = base64.b64decode(word)
    return out


class PairTable:
    """Ranks of pairs of ids, in an open-addressing table of arrays: many pairs are looked up at a time."""

    EMPTY = np.uint64(2**64 - 1)

    def __init__(self, words: list[bytes], ranks: dict[bytes, int]) -> None:
        pairs = [(ranks[w[:i]], ranks[w[i:]], r) for r, w in enumerate(words) for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks]
        table = np.array(pairs or [(0, 0, 0)], dtype=np.uint64)
        self.none = len(words)
        bits = max(10, int(8 * len(table)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64(2**bits - 1)
        self.keys = np.full(2**bits, self.EMPTY, dtype=np.uint64)
        self.values = np.full(2**bits, self.none, dtype=np.int32)
        keys, values = (table[:, 0] << np.uint64(32)) | table[:, 1], table[:, 2].astype(np.int32)
        if not pairs:
            return
        place = self._place(keys)
        while len(keys):
            free = self.keys[place] == self.EMPTY
            taken, at = np.unique(place[free], return_index=True)
            rows = np.flatnonzero(free)[at]
            self.keys[taken], self.values[taken] = keys[rows], values[rows]
            left = np.ones(len(keys), dtype=bool)
            left[rows] = False
            keys, values, place = keys[left], values[left], (place[left] + 1) & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, which is the merged id too; the number of ids where a pair has none."""
        keys = ((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)).ravel()
        place = self._place(keys)
        found = self.keys[place]
        hit = found == keys
        out = np.where(hit, self.values[place], np.int32(self.none))
        rows = np.flatnonzero(~hit & (found != self.EMPTY))
        place = place[rows]
        while len(rows):
            place = (place + 1) & self.mask
            found = self.keys[place]
            hit = found == keys[rows]
            out[rows[hit]] = self.values[place[hit]]
            on = ~hit & (found != self.EMPTY)
            rows, place = rows[on], place[on]
        return out.reshape(left.shape)


class Encoder:
    """Merges pre-tokens by rank, with a bounded cache; one for each Python worker and rank file.

    The cache holds the ids of a pre-token as the bytes of 32-bit integers, so that a text's ids are one
    join of such bytes.
    """

    def __init__(self, path: str) -> None:
        self.words = read_ranks(path)
        self.ranks = {w: i for i, w in enumerate(self.words)}
        self.pairs = PairTable(self.words, self.ranks)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.cache: dict[bytes, bytes] = {}

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pre-tokens: while there is one, merges the leftmost pair of the lowest rank.

        Pre-tokens of one length are the rows of an array; each round merges one pair in every row that
        still has one, so the rows of a round all have the same width.
        """
        out: list[bytes] = [b""] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = np.uint32(whole).tobytes()
            elif len(piece) > LONG_PIECE:
                out[i] = np.array(self._merge_long(piece), dtype=np.uint32).tobytes()
            else:
                by_size.setdefault(len(piece), []).append(i)
        none = self.pairs.none
        for size, rows in by_size.items():
            index = np.array(rows)
            ids = self.of_byte[np.frombuffer(b"".join([pieces[i] for i in rows]), dtype=np.uint8).reshape(-1, size)]
            ranks = self.pairs.look_up(ids[:, :-1], ids[:, 1:])
            while True:
                at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), dtype=np.int64)
                least = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), none)
                done = least == none
                if done.any():
                    finished = ids[done].astype(np.uint32)
                    width = 4 * finished.shape[1]
                    data = finished.tobytes()
                    for k, i in enumerate(index[done].tolist()):
                        out[i] = data[k * width : (k + 1) * width]
                    keep = ~done
                    ids, ranks, at, least, index = ids[keep], ranks[keep], at[keep], least[keep], index[keep]
                if not len(ids):
                    break
                line = np.arange(len(ids))
                ids[line, at] = least
                columns = np.arange(ids.shape[1] - 1)
                ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
                columns = np.arange(ranks.shape[1] - 1)
                ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
                right = np.flatnonzero(at < ranks.shape[1])
                ranks[right, at[right]] = self.pairs.look_up(ids[right, at[right]], ids[right, at[right] + 1])
                left = np.flatnonzero(at > 0)
                ranks[left, at[left] - 1] = self.pairs.look_up(ids[left, at[left] - 1], ids[left, at[left]])
        return out

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        n, get, none = len(piece), self.ranks.get, len(self.ranks)
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i : i + 2], none)) < none]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if j <= 0 or j >= n or end[j] != stop:
                continue  # one of its halves has changed since
            end[i], end[j] = stop, -1
            if stop < n:
                before[stop] = i
                if (r := get(piece[i : end[stop]], none)) < none:
                    heapq.heappush(heap, (r, i, end[stop]))
            k = before[i]
            if k >= 0 and (r := get(piece[k:stop], none)) < none:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        out: list[np.ndarray] = []
        start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= BATCH_CHARS):
                size += len(texts[stop])
                stop += 1
            out += self._encode(texts[start:stop])
            start = stop
        return out

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
        data = joined.encode()
        ends = np.cumsum(sizes)
        first = np.zeros(len(points), dtype=bool)
        first[(ends - sizes)[sizes > 0]] = True
        at = np.flatnonzero(pretoken_starts(points, first))
        if len(data) == len(points):
            cuts = at
        else:
            widths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
            cuts = (np.cumsum(widths) - widths)[at]
        places = cuts.tolist()
        places.append(len(data))
        pieces = [data[a:b] for a, b in zip(places, places[1:])]
        cache = self.cache
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        merged = list(map(cache.get, pieces))
        if None in merged:
            lost = list(dict.fromkeys([p for p, m in zip(pieces, merged) if m is None]))
            found = dict(zip(lost, self.merge_all(lost)))
            merged = [found[p] if m is None else m for p, m in zip(pieces, merged)]
            cache.update((p, m) for p, m in found.items() if len(p) <= LONG_PIECE)
        counts = np.fromiter(map(len, merged), dtype=np.int64, count=len(merged)) >> 2
        flat = np.frombuffer(b"".join(merged), dtype=np.uint32)
        of_piece = np.concatenate(([0], np.cumsum(counts)))
        bounds = of_piece[np.searchsorted(at, np.concatenate(([0], ends)))]
        return [flat[a:b] for a, b in zip(bounds.tolist(), bounds[1:].tolist())]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.words.__getitem__, ids.tolist()))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _texts(values) -> list[str]:
    return ["" if v is None or v != v else v for v in values]


def encode_texts(path: str):
    """A column function: text to array<int> of ids. A null text counts as an empty one."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path)
        for texts in batches:
            yield pd.Series([x.astype(np.int32) for x in own.encode(_texts(texts))], dtype=object)

    return run


def decode_ids(path: str):
    """A column function: array<int> of ids to the bytes they stand for. Null gives null."""

    @F.pandas_udf(T.BinaryType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(path)
        for ids in batches:
            yield pd.Series([None if x is None else own.decode(np.asarray(x, dtype=np.int64)) for x in ids], dtype=object)

    return run


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """docs with the ids of each whole text in a new column; a column of that name is replaced."""
    bound_batches(docs.sparkSession)
    return docs.withColumn(ids, encode_texts(path)(F.col(f"`{text}`")))


def decode_documents(docs: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """docs with the decoded bytes of each row's ids in a new column."""
    return docs.withColumn(decoded, decode_ids(path)(F.col(f"`{ids}`")))


def with_tokens(docs: DataFrame, path: str) -> DataFrame:
    """docs with ids, n_tokens and intact (whether decoding the ids gives the text's bytes); all columns are
    kept, and columns of these names are replaced. A null text has no ids and counts as empty."""

    @F.pandas_udf("ids array<int>, intact boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for texts in batches:
            texts = _texts(texts)
            found = own.encode(texts)
            intact = [own.decode(x) == t.encode() for x, t in zip(found, texts)]
            yield pd.DataFrame({"ids": pd.Series([x.astype(np.int32) for x in found], dtype=object), "intact": np.array(intact, dtype=bool)})

    bound_batches(docs.sparkSession)
    (name,) = fresh(docs, "tokens")
    out = docs.withColumn(name, run(F.col("text").cast("string")))
    return out.withColumn("ids", F.col(f"{name}.ids")).withColumn("n_tokens", F.size("ids").cast("long")).withColumn("intact", F.col(f"{name}.intact")).drop(name)


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long"


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: its number of ids, and digests of the ids and of the bytes decoded from them.

    A null or empty text has no ids; both digests are then those of no bytes. A null doc_id stays null,
    repeated rows are repeated, other columns are left out. Encoding and decoding happen in one pass,
    so ids never leave the Python worker.
    """

    bound_batches(docs.sparkSession)

    @F.pandas_udf(DIGESTS)
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for texts in batches:
            found = own.encode(_texts(texts))
            decoded = [own.decode(x) for x in found]
            yield pd.DataFrame(
                {
                    "n_tokens": np.array([len(x) for x in found], dtype=np.int64),
                    "ids_sha256": [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found],
                    "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in decoded],
                    "n_bytes": np.array([len(x) for x in decoded], dtype=np.int64),
                }
            )

    return docs.select(F.col("doc_id").cast("long"), digests(F.col("text").cast("string")).alias("found")).select("doc_id", "found.*")
