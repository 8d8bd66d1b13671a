"""Packing by powers of two: a document is cut into pieces of binary lengths, pieces of one length form a bucket, and
each piece is a sequence of its own, so that no sequence crosses documents and none is padded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import bound_batches
from skeinwork.llm.tokenfiles import CACHE_ENTRIES, UNCOMMON, Encoder, _ranges

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
#: A sequence_id is the bucket (the exponent of its length), the task and the number in the task's bucket, of 5, 24 and 34 bits.
TASK_BITS, NUMBER_BITS = 24, 34
#: Bytes of ids in one Arrow batch of the result.
BATCH_BYTES = 2 << 20
#: The normalizer and the pre-tokenizer that LowercaseEncoder follows (fixed values of the tokenizer's file).
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRETOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


@lru_cache(1)
def words() -> re.Pattern:
    """SPLIT for lower-cased texts without uncommon code points."""
    letter, number = _ranges("L"), _ranges("N")
    return re.compile(SPLIT.replace(r"\p{L}", letter).replace(r"\p{N}", number))


class LowercaseEncoder(Encoder):
    """Ids of whole texts by the tokenizers library, for tokenizers that lower-case and drop white space.

    Where the lower case of a text has no uncommon code points, NFC changes nothing in it and tokens never cross a match of
    SPLIT, so each distinct match goes through the library's model once. Other texts, and all texts of a tokenizer of
    another kind, are encoded whole.
    """

    def __init__(self, path: str, kind: np.dtype) -> None:
        super().__init__(path, kind)
        self.cuts = self.rules.get("normalizer") == NORMALIZER and self.rules.get("pre_tokenizer") == PRETOKENIZER and self.rules["model"].get("type") == "BPE"

    def ids(self, text: str) -> bytes:
        lower = text.lower()  # which may hold uncommon letters where the text held none
        if not self.cuts or UNCOMMON.search(lower) or any(t in text for t in self.added):
            return self.whole(text)
        if len(self) > CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, words().findall(lower)))


@lru_cache(2)
def encoder(path: str) -> LowercaseEncoder:
    return LowercaseEncoder(path, np.dtype("<u4"))


def binary_lengths(n: int, longest: int) -> list[int]:
    """Powers of two that sum to n, in falling order: as many of `longest` as fit, then the bits of the rest."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str, end_id: int, longest: int = 2048) -> DataFrame:
    """Packs the ids of whole texts (null: empty), each with end_id behind, into sequences without padding.

    One row per piece: doc_id, start (ids of its document before it), length, doc_tokens (ids of the document with
    end_id), sequence_id, offset (0: a piece fills its sequence), ids (little-endian unsigned 32-bit integers).
    `longest` is a power of two, 2^18 at most. Sequences of one length have neighbouring ids (the bucket comes first), so a
    trainer that draws batches of one length reads a range of ids. A sequence_id also holds the task that made it and a
    running number there: nothing is shuffled, counted or written in between, and a task that runs again gives its sequences
    the same numbers as before.

    Repeated rows and null doc_ids are documents of their own; a text, however long, is one row and so one task's. An
    empty table has no pieces. Other columns of docs are not read.
    """
    if longest & (longest - 1) or not 0 < longest <= 1 << 18:
        raise ValueError("longest is a power of two, 2^18 at most")
    spark = docs.sparkSession
    bound_batches(spark)
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 6 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId() << NUMBER_BITS, [0] * longest.bit_length()
        library, end = encoder(path), np.array([end_id], dtype="<u4").tobytes()
        rows, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = library.ids(text.as_py() or "") + end
                start, n = 0, len(ids) // 4
                for length in binary_lengths(n, longest):
                    bucket = length.bit_length() - 1
                    rows.append((doc_id, start, length, n, (bucket << TASK_BITS + NUMBER_BITS) + task + made[bucket], 0, ids[4 * start : 4 * (start + length)]))
                    made[bucket] += 1
                    start, size = start + length, size + 4 * length
                    if size > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return own.mapInArrow(run, SCHEMA)
