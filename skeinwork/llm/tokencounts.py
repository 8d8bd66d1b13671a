"""Token counts per section: a document is encoded once, and its token spans are joined to its sections.

A token belongs to the section that holds its first character (the boundary rule); tokens that reach over
the section's end are counted there too and reported. Sections tile the document, so every token is counted
once and the counts of a document add up to its ids. The documents of a batch lie in one array of bytes, in which
both the token spans and the sections are sorted, so the interval join of a whole batch is one search.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.bpe import encoder
from skeinwork.llm.common import bound_batches

COUNTS = "doc_id long, section int, char_start long, char_end long, n_tokens long, n_crossing long"


def line_starts(data: np.ndarray) -> np.ndarray:
    """Bytes of UTF-8 at which a section starts besides the documents' first ones: those behind a line end."""
    return np.flatnonzero(data == 0x0A) + 1


def attribute(starts: np.ndarray, ends: np.ndarray, section_starts: np.ndarray, section_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens that start in each section, those of them that reach over its end); all spans lie sorted in one unit."""
    owner = np.searchsorted(section_starts, starts, "right") - 1
    count = np.bincount(owner, minlength=len(section_starts))
    crossing = np.bincount(owner[ends > section_ends[owner]], minlength=len(section_starts))
    return count, crossing


def count_sections(docs: DataFrame, path: str, sections: Callable[[np.ndarray], np.ndarray] = line_starts) -> DataFrame:
    """One row per section of each document: doc_id, section (from 0), char_start, char_end, n_tokens, n_crossing.

    A null or empty text has no sections and so no rows. Null ids and repeated rows stay, other columns are
    left out. Texts are encoded whole; only the counts leave the Python worker.
    """
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            found = _counts(texts.to_pylist(), pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64), own, sections)
            ids = batch.column("doc_id").take(pa.array(found[0]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(found[1].astype(np.int32)), *[pa.array(x.astype(np.int64)) for x in found[2:]]], names=[c.split()[0] for c in COUNTS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, COUNTS)


def _counts(texts: list[str], sizes: np.ndarray, own, sections: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, ...]:
    """(row, section, char_start, char_end, n_tokens, n_crossing) of the sections of some texts."""
    found = own.encode(texts)
    ids = np.concatenate([*found, np.zeros(0, dtype=np.uint32)]).astype(np.int64)
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    doc_ends = np.cumsum(sizes)
    doc_starts = doc_ends - sizes
    first = np.zeros(len(data) + 1, dtype=bool)
    first[doc_starts] = True
    first[sections(data)] = True
    starts = np.flatnonzero(first[: len(data)])
    ends = np.append(starts[1:], len(data))[: len(starts)]
    row = np.searchsorted(doc_ends, starts, "right")
    token_ends = np.cumsum(own.lengths[ids])
    count, crossing = attribute(token_ends - own.lengths[ids], token_ends, starts, ends)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    base = chars[doc_starts[row]]
    section = np.arange(len(starts)) - np.searchsorted(row, row)
    return row, section, chars[starts] - base, chars[ends] - base, count, crossing
