"""Token ids as flat binary files with 64-bit document offsets, written and read by Spark tasks.

Documents are range-partitioned by doc_id; each partition writes one shard of three files: `.ids`, the ids of its
documents one after the other (little-endian unsigned 16-bit where the vocabulary fits, else 32-bit), `.off`,
64-bit offsets into them (documents + 1), and `.doc`, the 64-bit doc_ids with a mask byte for nulls. A manifest
row per shard holds its counts, and the prefix sums of the counts are the shards' bases in the whole.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skeinwork.llm.common import bound_batches, shared_dir

MANIFEST = "shard int, name string, n_docs long, n_ids long, id_bytes int"
#: Bytes of text a shard holds on average, up to so many shards; beyond it they grow, since the bounds of a range
#: partitioning are drawn from a sample of each range's keys, which the driver sorts.
SHARD_BYTES, MOST_SHARDS = 64 << 20, 20_000
#: First characters of a text by which rows of one doc_id are ordered.
HEAD_CHARS = 16
#: Pre-tokens a worker keeps encoded: so many of late and, of those before them, at most as many again.
CACHE_ENTRIES = 300_000
#: Longer pre-tokens are not kept.
LONG_PIECE = 64


@lru_cache(2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _ranges(major: str) -> str:
    """The code points below U+0250 whose category starts with `major`, as the inside of a character class."""
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == major)


#: Texts of other code points go to the library whole: in these (Latin, punctuation, currency) `re` and the library agree
#: on what is a letter, a number and white space.
UNCOMMON = re.compile("[^\x00-\x1b\x20-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")


@lru_cache(1)
def pretokens() -> re.Pattern:
    """The library's byte-level pre-token pattern, for texts without uncommon code points."""
    letter, number = _ranges("L"), _ranges("N")
    return re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+")


@lru_cache(1)
def byte_characters() -> dict[int, int]:
    """The character by which a byte-level tokenizer's model knows each byte: printable ones as they are, the others
    in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: b for b in plain} | {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in set(plain))}


class Encoder(dict):
    """Ids of whole texts by the tokenizers library, as the bytes of integers of `kind`.

    A byte-level tokenizer without normalizer merges only within pre-tokens, so the ids of a text are those of its
    pre-tokens one after the other: each distinct one goes through the library's model once and is kept (this dict).
    Texts for which that is not certain (uncommon code points, added tokens, another kind of tokenizer) are encoded
    whole.
    """

    def __init__(self, path: str, kind: np.dtype) -> None:
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.library, self.kind = tokenizer(path), kind
        self.model = self.library.model
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            self.rules = rules = json.load(file)
        cut = rules.get("pre_tokenizer") or {}
        self.cuts = not rules.get("normalizer") and cut.get("type") == "ByteLevel" and rules["model"].get("type") == "BPE" and not cut.get("add_prefix_space") and cut.get("use_regex", True)

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes() if len(ids) > 64 else pack(f"<{len(ids)}{'H' if self.kind.itemsize == 2 else 'I'}", *ids)

    def whole(self, text: str) -> bytes:
        return self.packed(self.library.encode(text, add_special_tokens=False).ids)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            tokens = self.model.tokenize(piece.encode().decode("latin-1").translate(byte_characters()))
            ids = self.packed([t.id for t in tokens])
        if len(piece) <= LONG_PIECE:
            self[piece] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if not self.cuts or UNCOMMON.search(text) or any(t in text for t in self.added):
            return self.whole(text)
        if len(self) > CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, pretokens().findall(text)))


@lru_cache(2)
def encoder(path: str, id_bytes: int) -> Encoder:
    return Encoder(path, np.dtype(f"<u{id_bytes}"))


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes the shards below folder, and a manifest; returns the manifest (shard, name, n_docs, n_ids, id_bytes,
    base_docs, base_ids), one row per shard.

    Each document's ids end with end_id. A null text counts as empty and so is end_id alone. Documents lie in
    ascending doc_id order, nulls first; rows of one doc_id lie in the order of the first characters of their texts,
    then of a hash of the whole, and equal rows are numbered. Shards part rows by all of these, so no doc_id and no
    repeated row fills a task. A task that runs again writes files of a new name, and only the names in the
    manifest count.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    text = F.col("text").cast("string")
    own = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.substring(text, 1, HEAD_CHARS).alias("head"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("copy"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_SHARDS, -(-total // shard_bytes)))
    order = ("doc_id", "head", "hash", "copy")
    dealt = own.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    id_bytes = 2 if max(tokenizer(path).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    end = np.array([end_id], dtype=f"<u{id_bytes}").tobytes()
    _open(folder)[0].create_dir(_open(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own = TaskContext.get().partitionId(), encoder(path, id_bytes)
        name = f"{shard:06d}-{uuid.uuid4().hex}"
        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        offsets, keys, nulls, place = [0], [], [], 0
        with store.open_output_stream(f"{root}/{name}.ids") as ids:
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    data = own.ids(text or "") + end
                    ids.write(data)
                    place += len(data) // id_bytes
                    offsets.append(place)
                doc_ids = batch.column("doc_id")
                keys.append(doc_ids.fill_null(0).to_numpy())
                nulls.append(doc_ids.is_null().to_numpy(zero_copy_only=False))
        if place:
            with store.open_output_stream(f"{root}/{name}.off") as out:
                out.write(np.array(offsets, dtype="<i8").tobytes())
            with store.open_output_stream(f"{root}/{name}.doc") as out:
                out.write(np.concatenate(keys).astype("<i8").tobytes() + np.concatenate(nulls).astype(np.uint8).tobytes())
            counts = [pa.array([x], kind) for x, kind in ((shard, pa.int32()), (name, pa.string()), (len(offsets) - 1, pa.int64()), (place, pa.int64()), (id_bytes, pa.int32()))]
            yield pa.RecordBatch.from_arrays(counts, names=[c.split()[0] for c in MANIFEST.split(", ")])

    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with each shard's bases: the prefix sums of documents and ids over the shards (one row each)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    base = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    return rows.select("*", base("n_docs").alias("base_docs"), base("n_ids").alias("base_ids"))


def _mapped(store: fs.FileSystem, path: str, kind: str, own: str) -> np.ndarray:
    """A file as a memory-mapped array; one in a remote store is first copied into the task's own folder."""
    if not isinstance(store, fs.LocalFileSystem):
        local = os.path.join(own, os.path.basename(path))
        with store.open_input_stream(path) as source, open(local, "wb") as out:
            while data := source.read(1 << 22):
                out.write(data)
        path = local
    return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, dtype=kind)


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of its ids as little-endian unsigned 32-bit integers). A task maps one shard at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _open(folder)
        for batch in batches:
            for name, base, width in zip(batch["name"], batch["base_ids"], batch["id_bytes"]):
                with tempfile.TemporaryDirectory() as own:
                    ids = _mapped(store, f"{root}/{name}.ids", f"<u{width}", own)
                    offsets = np.array(_mapped(store, f"{root}/{name}.off", "<i8", own))
                    raw = np.array(_mapped(store, f"{root}/{name}.doc", "u1", own))
                    n = len(offsets) - 1
                    keys, nulls = raw[: 8 * n].view("<i8"), raw[8 * n :].astype(bool)
                    for at in range(0, n, 10_000):
                        cut = range(at, min(n, at + 10_000))
                        doc_ids = [None if nulls[i] else str(keys[i]) for i in cut]
                        crc = [zlib.crc32(ids[offsets[i] : offsets[i + 1]].astype("<u4").tobytes()) for i in cut]
                        starts = offsets[at : at + len(cut)]
                        yield pd.DataFrame({"doc_id": doc_ids, "start": starts + int(base), "n_tokens": np.diff(offsets[at : at + len(cut) + 1]), "ids_crc32": crc})
                    del ids

    spark = manifest.sparkSession
    dealt = manifest.select("name", "base_ids", "id_bytes").repartition(max(1, manifest.count()))
    found = dealt.mapInPandas(run, "doc_id string, start long, n_tokens long, ids_crc32 long")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def round_trip(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Writes the token files of docs into the shared folder and reads each document back from them."""
    folder = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    return read_documents(write_shards(docs, folder, path, end_id), folder)
