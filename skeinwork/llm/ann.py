"""Approximate nearest neighbours by a permutation index.

Every vector is represented by the order in which it sees a set of pivots, and posted in the inverted files of
its nearest pivots. A query reads the files of its own nearest pivots; within a file the rows are ranked by the
footrule distance of the two orders, the best share of them is compared exactly, and the nearest rows of all files
win. A file is a group of a Spark shuffle, cut into blocks where it is long, so a task holds one block of rows and
one block of queries.

How many files are read and which share is compared is measured on each table: a bounded sample of queries is answered
from all files, which is exact, and the cheapest setting that finds enough of these answers is taken. Where none
does (vectors of many dimensions without any structure), all files are read and all rows compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.llm.common import materialise

#: Pivots: a bounded sample of the distinct vectors, those of the smallest hashes.
PIVOTS = 128
#: Nearest pivots under which a vector is posted.
POSTINGS = 4
#: Settings that are measured: files that a query reads, and the share of a file that is compared, best footrule first.
PROBES, SHARES = (2, 4, 8, 16, 32, 64), (0.1, 0.25, 0.5, 1.0)
#: Queries that the settings are measured on at most, those of the smallest hashes, and the share of their answers to be found.
SAMPLE_QUERIES, RECALL = 128, 0.95
#: Rows of a file that are compared at least.
LEAST = 64
#: Rows and queries of a block.
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 1_024


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component near one: cosines stay as they are, and
    no square is too large or too small."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def units(vectors: np.ndarray) -> np.ndarray:
    own = scaled(vectors)
    return own / lengths(own)[:, None]


def orders(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pivots of each (unit) vector, nearest first (ties go to the earlier pivot), and the place of each pivot."""
    near = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")
    place = np.empty(near.shape, dtype=np.uint16 if len(pivots) > 256 else np.uint8)
    np.put_along_axis(place, near, np.broadcast_to(np.arange(len(pivots), dtype=place.dtype), near.shape), axis=1)
    return near, place


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def search_file(rows: pd.DataFrame, asked: pd.DataFrame, k: int, share: float, least: int, postings: int) -> pd.DataFrame:
    """For each query its k nearest rows among the best share of a file by footrule (ties included): query, query_id, row,
    vec_id, score, probe (the first file, in the query's order, of those under `postings` pivots that hold the row),
    part (of this file that is not worse by footrule).

    Cosines are taken row by row from the vectors as they are, so equal vectors tie exactly.
    """
    ids, row = rows["vec_id"].to_numpy(), rows["row"].to_numpy()
    vectors, queries = scaled(matrix(rows["v"])), scaled(matrix(asked["v"]))
    size, asked_size = lengths(vectors), lengths(queries)
    kind = np.uint16 if len(rows["place"].iloc[0]) > 2 * 256 else np.uint8
    place, asked_place = (np.frombuffer(b"".join(x["place"]), dtype=kind).reshape(len(x), -1) for x in (rows, asked))
    wanted = max(least, int(np.ceil(share * len(ids))), k + 1)
    out = []
    for i, (q, query_id) in enumerate(zip(asked["row"], asked["vec_id"])):
        rule = (np.maximum(place, asked_place[i]) - np.minimum(place, asked_place[i])).sum(axis=1, dtype=np.int64)
        found = np.flatnonzero(row != q)
        if len(found) > wanted:
            found = found[rule[found] <= np.partition(rule[found], wanted - 1)[wanted - 1]]
        if not len(found):
            continue
        cosine = (vectors[found] * queries[i]).sum(axis=1) / (size[found] * asked_size[i])
        best = np.lexsort((row[found], ids[found], -cosine))[:k]
        part = np.searchsorted(np.sort(rule), rule[found[best]], "right") / len(rule)
        probe = np.where(place[found[best]] < postings, asked_place[i], place.shape[1]).min(axis=1)
        out += [(q, query_id, int(row[found[j]]), int(ids[found[j]]), float(cosine[j]), int(f), float(p)) for j, f, p in zip(best, probe, part)]
    return pd.DataFrame(out, columns=FOUND_NAMES)


FOUND = "query long, query_id long, row long, vec_id long, score double, probe int, part double"
FOUND_NAMES = [c.split()[0] for c in FOUND.split(", ")]


def _usable(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, v, dim) of the vectors that take part, numbered; floats travel as such and are doubles in tasks."""
    v = F.col("embedding").cast("array<float>" if dict(embeddings.dtypes)["embedding"] == "array<float>" else "array<double>")
    own = embeddings.filter(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return own.filter(F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)).select(F.monotonically_increasing_id().alias("row"), "vec_id", "v", F.size("v").alias("dim"))


def _chosen_pivots(rows: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """Unit vectors of the pivots of each dimension: `pivots` rows at most come to the driver."""
    hashed = rows.select("v", F.xxhash64("v").alias("h"))
    few = hashed.select("h").distinct().orderBy("h").limit(pivots)
    chosen = hashed.join(F.broadcast(few), "h").dropDuplicates(["h"]).orderBy("h").collect()
    by_size: dict[int, list[list[float]]] = {}
    for r in chosen:
        by_size.setdefault(len(r["v"]), []).append(r["v"])
    return {n: units(np.array(v, dtype=np.float64)) for n, v in by_size.items()}


def _indexed(rows: DataFrame, pivots: dict[int, np.ndarray], postings: int, every: int) -> DataFrame:
    """rows with place (the place of each pivot, as bytes) and near: the pivots under which a row is posted, or all
    of them, nearest first, for a query. A dimension without pivots has one file, 0."""
    held = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for n, own in batch.groupby("dim"):
                known = held.value.get(n)
                if known is None:
                    yield own.assign(place=[b"\0"] * len(own), near=[[0]] * len(own))
                    continue
                near, place = orders(units(matrix(own["v"])), known)
                asked = (own["vec_id"] % every == 0).to_numpy()
                yield own.assign(place=[p.tobytes() for p in place], near=[p if a else p[:postings] for p, a in zip(near, asked)])

    return rows.mapInPandas(run, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema)}, place binary, near array<int>")


def _search(rows: DataFrame, queries: DataFrame, k: int, postings: int, probes: int, share: float, least: int, block_rows: int, block_queries: int, most: int) -> DataFrame:
    """What search_file finds for each query in each of the first `probes` files of its order, over rows that are
    posted under `postings` pivots. Long files, and files that many queries read, are met in blocks."""
    posted = rows.select("row", "vec_id", "v", "place", "dim", F.explode(F.slice("near", 1, postings)).alias("pivot"))
    read = queries.select("row", "vec_id", "v", "place", "dim", F.explode(F.slice("near", 1, probes)).alias("pivot"))
    count = lambda df, size: F.ceil(F.count("*") / size).cast("int")
    files = posted.groupBy("dim", "pivot").agg(count(posted, block_rows).alias("n"))
    readers = read.groupBy("dim", "pivot").agg(count(read, block_queries).alias("m"))
    blocks = materialise(files.join(readers, ["dim", "pivot"]), "ann-files")  # a row a pivot
    key = ["dim", "pivot", "row_block", "query_block"]
    left = posted.join(F.broadcast(blocks), ["dim", "pivot"]).withColumn("row_block", F.pmod(F.xxhash64("row"), F.col("n")).cast("int")).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    right = read.join(F.broadcast(blocks), ["dim", "pivot"]).withColumn("query_block", F.pmod(F.xxhash64("row", F.lit(1)), F.col("m")).cast("int")).withColumn("row_block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    names = [*key, "row", "vec_id", "v", "place"]
    right = right.select(*[F.col(c).alias(c) for c in names])  # columns of their own: both sides are of one table

    def run(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return search_file(own, asked, k, share, least, most) if len(own) and len(asked) else pd.DataFrame([], columns=FOUND_NAMES)

    return left.select(names).groupBy(key).cogroup(right.groupBy(key)).applyInPandas(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest distinct rows of each query, with their rank."""
    once = found.groupBy("query", "query_id", "row", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k)


def measured_setting(rows: DataFrame, queries: DataFrame, k: int, pivots: int, postings: int, recall: float, least: int, block_rows: int) -> tuple[int, int, float]:
    """(postings, probes, share): the cheapest setting that finds `recall` of the answers of a sample of queries, or the
    exact one. Their answers come from all files, with each row in that of its nearest pivot and all rows compared; of an
    answer it is known which file of the query would have held it, and how far down by footrule."""
    sample = materialise(queries.orderBy(F.xxhash64("row"), "row").limit(SAMPLE_QUERIES), "ann-sample")
    found = materialise(_search(rows, sample, k, 1, pivots, 1.0, least, block_rows, SAMPLE_QUERIES, postings), "ann-measured")
    true = _best(found, k).select("query", "row")
    entries = found.join(true, ["query", "row"], "right").groupBy("query", "row")
    grid = [(p, s) for p in PROBES for s in SHARES if p < pivots]
    hits = entries.agg(*[F.max(((F.col("probe") < p) & (F.col("part") <= s)).cast("int")).alias(f"hit{i}") for i, (p, s) in enumerate(grid)], F.lit(1).alias("one"))
    sums = hits.agg(F.sum("one").alias("n"), *[F.sum(f"hit{i}").alias(f"hit{i}") for i in range(len(grid))]).first()
    good = [(p * (0.15 + s), p, s) for i, (p, s) in enumerate(grid) if sums["n"] and sums[f"hit{i}"] >= recall * sums["n"] and postings * p * (0.15 + s) < pivots]
    if not good:
        return 1, pivots, 1.0
    _, probes, share = min(good)
    return postings, probes, share


def nearest(embeddings: DataFrame, every: int = 50, k: int = 5, pivots: int = PIVOTS, postings: int = POSTINGS, setting: tuple[int, int, float] | None = None, recall: float = RECALL, least: int = LEAST, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest rows found for each row whose id `every` divides.

    Nearness is the cosine in double precision, ties go to the smaller vec_id. Vectors that are null, empty,
    zero, or hold a null, NaN or infinite component take no part, as do rows with a null id; vectors of
    different lengths are never compared. All other rows count, repeated ones and ones that share an id too: each is a
    candidate of every row but itself, and each whose id is a query's is a query. Fewer candidates than k give fewer
    rows, an empty table gives none. `setting` (postings, probes,
    share) replaces the measured one; (1, pivots, 1.0) is exact.
    """
    rows = materialise(_usable(embeddings), "ann-rows")
    known = _chosen_pivots(rows, pivots)
    indexed = materialise(_indexed(rows, known, postings, every), "ann-index")
    queries = indexed.filter(F.col("vec_id") % every == 0)
    posted, probes, share = setting or measured_setting(indexed, queries, k, pivots, postings, recall, least, block_rows)
    found = _search(indexed, queries, k, posted, probes, share, least, block_rows, block_queries, posted)
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
