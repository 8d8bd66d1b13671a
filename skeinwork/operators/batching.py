"""Numbering, batches, limits, compaction plans, retention and rolling windows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from skeinwork.sources.storage import fresh_path, materialise


def with_rank(df: DataFrame, order: list[str]) -> DataFrame:
    """df with rank, the 1-based place in the total order, without a sort of all rows in one task.

    Rows are range-partitioned and sorted once and written, a file for each range. A row's place in its file comes
    with the file, and the files' counts (one row each) give the base, so nothing is shuffled a second time. Rows that tie in
    the order are numbered in any order.
    """
    rows, sizes = _ranges(_ranged(df, None, *order), df.schema, "ranked")
    return rows.join(F.broadcast(sizes), "_file").withColumn("rank", F.col("_base") + F.col("_row") + 1).drop("_file", "_row", "_base")


def _ranges(sorted_: DataFrame, schema: StructType, name: str) -> tuple[DataFrame, DataFrame]:
    """Writes sorted ranges; returns their rows with _file and _row (the place in it, from 0), and a row for each file with _base, the
    rows of the files before."""
    spark, path = sorted_.sparkSession, fresh_path(sorted_.sparkSession, name)
    sorted_.write.parquet(path)
    rows = spark.read.schema(schema).parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    number = [F.regexp_extract("_file", p, 1).cast("long") for p in (r"^part-(\d+)", r"-c(\d+)")]  # of the task, and of its file
    before = Window.orderBy(*number).rowsBetween(Window.unboundedPreceding, -1)
    return rows, rows.groupBy("_file").count().select("_file", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))


def assign_batches(df: DataFrame, size: int, order: list[str]) -> DataFrame:
    """df with rank and batch_id (from 1): `size` rows a batch, in order."""
    return with_rank(df, order).withColumn("batch_id", F.floor((F.col("rank") - 1) / size) + 1)


def batch_slice(df: DataFrame, size: int, n: int, order: list[str]) -> DataFrame:
    """Batch n (from 0): rows n * size up to (n + 1) * size."""
    return df.orderBy(*order).offset(n * size).limit(size)


def retention(files: DataFrame, keep: int) -> DataFrame:
    """files with kept (the newest `keep`) and rank from the newest; the table has a row for each file."""
    rank = F.row_number().over(Window.orderBy(F.desc("modified"), "file"))
    return files.withColumn("rank", rank).withColumn("kept", F.col("rank") <= keep)


def latest_summary(df: DataFrame, n: int, seq: str, fields: list[str]) -> DataFrame:
    """The last n rows as lines of text, oldest first; a missing field reads N/A."""
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("N/A")) for f in fields]
    return df.orderBy(F.desc(seq)).limit(n).select(seq, F.concat_ws(" | ", *parts).alias("line")).orderBy(seq)


def resume_after(df: DataFrame, key: str, value, seq: str) -> DataFrame:
    """Rows behind the first with the key's value; all rows if there is none."""
    first = df.filter(F.col(key) == value).agg(F.min(seq).alias("_first"))
    return df.crossJoin(F.broadcast(first)).filter(F.col("_first").isNull() | (F.col(seq) > F.col("_first"))).drop("_first")


def top(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _batches(rows: Iterator[tuple], schema: StructType, most: int = 10_000) -> Iterator[pa.RecordBatch]:
    own = to_arrow_schema(schema)
    while held := list(islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), own)], schema=own)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _ranged(df: DataFrame, parts: int | None, *order: Column | str) -> DataFrame:
    """df in sorted ranges: `parts` of them, or as many as its size asks for when it runs."""
    return (df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)).sortWithinPartitions(*order)


def prefix_sums(df: DataFrame, order: list[str], value: str, parts: int | None) -> DataFrame:
    """df with _i, the place in the total order from 1, and _sum, the values up to and with it: sums within each sorted range, and the ranges' totals
    (one row each) for those before."""
    schema = StructType([*df.schema.fields]).add("_part", IntegerType()).add("_i", LongType()).add("_sum", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sums = total + np.cumsum(batch.column(value).to_numpy())
            own = [pa.array(np.full(len(sums), part, np.int32)), pa.array(n + 1 + np.arange(len(sums))), pa.array(sums)]
            if len(sums):
                n, total = n + len(sums), sums[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=schema.names)

    rows = materialise(_ranged(df, parts, *order).mapInArrow(run, schema), "prefix-sums")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("_part").agg(F.max("_i").alias("n"), F.max("_sum").alias("s")).select("_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in "ns"])
    return rows.join(F.broadcast(ends), "_part").withColumns({"_i": F.col("_i") + F.col("_n"), "_sum": F.col("_sum") + F.col("_s")}).drop("_part", "_n", "_s")


def with_place(df: DataFrame, key: str, order: list[str], parts: int | None = None) -> DataFrame:
    """df with place, the 1-based place among the rows of its key, without a task that sees a whole key.

    Rows are sorted once, by ranges of key and order, and numbered as they pass; of a key that goes on from one range to the
    next the rows before are added from a table of the ranges' edges.
    """
    schema = StructType([*df.schema.fields]).add("_part", IntegerType()).add("_first", BooleanType()).add("place", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, place, first = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key)
            codes = pc.fill_null(keys.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
            goes_on = before is not None and keys[0].as_py() == before[0]
            change = np.append(not goes_on, codes[1:] != codes[:-1])
            at = np.arange(len(codes))
            starts = np.maximum.accumulate(np.where(change, at, -1))
            places = np.where(starts < 0, place + at + 1, at - starts + 1)
            in_first = np.cumsum(change) == (1 if before is None else 0) if first else np.zeros(len(codes), dtype=bool)
            before, place, first = (keys[-1].as_py(),), int(places[-1]), bool(in_first[-1])
            own = [pa.array(np.full(len(codes), part, np.int32)), pa.array(in_first), pa.array(places)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=schema.names)

    rows = materialise(_ranged(df, parts, key, *order).mapInArrow(run, schema), "placed")
    ends = rows.groupBy("_part").agg(F.min(F.struct(key)).alias("f"), F.max(F.struct(key, "place")).alias("l"))  # the first and the last row
    entry = lambda of, n, first: ends.select("_part", F.col(f"{of}.{key}").alias("k"), n.alias("n"), F.lit(first).alias("first"))
    before = Window.partitionBy("k").orderBy("_part", F.desc("first")).rowsBetween(Window.unboundedPreceding, -1)
    bases = entry("f", F.lit(0), True).unionByName(entry("l", F.col("l.place"), False)).withColumn("_base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    edges = F.broadcast(bases.filter("first").select("_part", "_base"))  # a row a range
    return rows.join(edges, "_part").withColumn("place", F.col("place") + F.when(F.col("_first"), F.col("_base")).otherwise(0)).drop("_part", "_first", "_base")


def _jumps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """A range of places and thresholds, the largest first: for each file (part, i, next, exit, file, place, size).

    next is where the group after one that starts here starts: the last place that came by, whose sum is over this one's threshold. exit
    is the first start outside this range, whichever starts lie between. Where no place has come by yet, next is open, and
    an exit by way of such a file is the file's number below zero. At the end a row without i has the last place as next.
    """
    part, last, exits, top = TaskContext.get().partitionId(), None, [], None
    for kind, i, *file in _rows(batches, "kind", "_i", "file", "place", "size"):
        if kind == 0:
            last = i
            continue
        top = i if top is None else top
        after = None if last is None else max(last, i + 1)
        exits.append(-i if after is None else after if after > top else exits[top - after])
        yield part, i, after, exits[-1], *file
    if last is not None:
        yield part, None, last, None, None, None, None


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Files by range and place, with `entry` where a group starts that no start of this range leads to: adds the starts so far in the
    range, and whether this is one."""
    part, expected, n = None, None, 0
    for own, i, after, entry, *file in _rows(batches, "part", "i", "next", "entry", "file", "place", "size"):
        if own != part:
            part, expected, n = own, None, 0
        start = bool(entry) or i == expected
        if start:
            expected, n = after, n + 1
        yield own, i, after, n, start, *file


def _reached(jumps: DataFrame) -> DataFrame:
    """Places that the jumps lead to from place 1, by pointer doubling: each round takes twice as many steps at once."""
    spark = jumps.sparkSession
    targets = jumps.select(F.col("exit").alias("i")).union(spark.range(1, 2).select(F.col("id").alias("i"))).distinct()
    steps, found, n = materialise(jumps.join(targets, "i", "left_semi"), "jumps"), spark.range(1, 2).select(F.col("id").alias("i")), 1
    while not steps.isEmpty():
        found = materialise(found.union(found.join(steps, "i").select(F.col("exit").alias("i"))).distinct(), "reached")
        before, n = n, found.count()
        if n == before:
            break
        steps = materialise(steps.join(steps.select(F.col("i").alias("exit"), F.col("exit").alias("further")), "exit").select("i", F.col("further").alias("exit")), "jumps")
    return found


def plan_compaction(files: DataFrame, cap: int, small: int | None = None, parts: int | None = None) -> DataFrame:
    """(file, place, size, group_id, rewritten): files are taken in order of place, and a group is closed when the next
    would take it over the cap; groups of two files or more are rewritten.

    With `small`, only files of less take part, as the smaller variant has it (its cap is twice its target). A file without
    a size counts as empty. Sizes are not below zero.

    No task sees all files. Sums up to each file are taken by sorted ranges (`parts`, or as many as their size asks for). A group that starts at a file ends
    before the first place whose sum is over the file's threshold: places and thresholds are sorted together, by ranges again, and each
    range finds them and the first start beyond it. These jumps are followed from the first file by pointer doubling, in as many joins as
    the logarithm of the number of ranges; they say where each range is entered, and it marks its own starts.
    """
    own = files if small is None else files.filter(F.col("size") < small)
    kind = files.schema["file"].dataType
    listed = own.select("file", F.col("place").cast("long"), F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"))
    summed = prefix_sums(listed, ["place", "file", "size"], "size", parts)
    payload = ["file", "place", "size"]
    places = summed.select(F.col("_sum").alias("value"), F.lit(0).alias("kind"), "_i", *[F.lit(None).cast(listed.schema[c].dataType).alias(c) for c in payload])
    thresholds = summed.select((F.col("_sum") - F.col("size") + cap).alias("value"), F.lit(1).alias("kind"), "_i", *payload)
    falling = [F.desc(c) for c in ("value", "kind", "_i")]  # a place of the same sum is not over the threshold
    tail = StructType([StructField("file", kind), StructField("place", LongType()), StructField("size", LongType())])
    numbers = lambda *names: [StructField(n, IntegerType() if n == "part" else LongType()) for n in names]
    schema = StructType([*numbers("part", "i", "next", "exit"), *tail.fields])
    both = _ranged(places.unionByName(thresholds), parts, *falling)
    found = materialise(both.mapInArrow(lambda b: _batches(_jumps(b), schema), schema), "jumps")

    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = found.groupBy("part").agg(F.min(F.when(F.col("i").isNull(), F.col("next"))).alias("last"), F.max("i").alias("top"))
    edges = F.broadcast(ranges.select("part", F.min("last").over(over).alias("carry"), F.max("top").over(Window.partitionBy()).alias("n")))  # a row a range
    by = lambda i: F.greatest(F.when(F.col("carry").isNotNull(), i + 1), F.col("carry"))
    jumps = found.filter(F.col("i").isNotNull()).join(edges, "part")
    jumps = jumps.withColumns({"next": F.coalesce("next", by(F.col("i"))), "exit": F.when(F.col("exit") > 0, F.col("exit")).otherwise(by(-F.col("exit")))})
    entries = _reached(jumps.filter(F.col("exit") <= F.col("n")).select("i", "exit"))
    flagged = jumps.join(F.broadcast(entries.withColumn("entry", F.lit(True))), "i", "left")  # two a range at most
    schema = StructType([*numbers("part", "i", "next", "starts"), StructField("start", BooleanType()), *tail.fields])
    in_order = flagged.repartition("part").sortWithinPartitions("part", "i").select("part", "i", "next", "entry", *payload)
    marked = materialise(in_order.mapInArrow(lambda b: _batches(_starts(b), schema), schema), "starts")
    # Later ranges lie further down the order of places.
    below = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    bases = marked.groupBy("part").agg(F.count_if("start").alias("m"), F.max("i").alias("top")).select("part", F.coalesce(F.sum("m").over(below), F.lit(0)).alias("base"), F.max("top").over(Window.partitionBy()).alias("n"))
    alone = F.col("start") & (F.coalesce("next", F.col("n") + 1) == F.col("i") + 1)
    return marked.join(F.broadcast(bases), "part").select(*payload, (F.col("base") + F.col("starts")).alias("group_id"), (~alone).alias("rewritten"))


def plan_chunk(files: DataFrame, start: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(files at places start to start + most, state): the state has processed, remaining, next_index and status."""
    numbered = files.withColumn("index", F.row_number().over(Window.orderBy("file")) - 1)
    chunk = numbered.filter((F.col("index") >= start) & (F.col("index") < start + most))
    after = F.least(F.lit(start + most), F.col("n"))
    state = files.agg(F.count("*").alias("n")).select(
        F.greatest(after - start, F.lit(0)).alias("processed"), (F.col("n") - after).alias("remaining"), after.alias("next_index"), F.when(after >= F.col("n"), "complete").otherwise("partial").alias("status")
    )
    return chunk, state


def limit_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def limit_successes(df: DataFrame, n: int, ok: Column, order: list[str]) -> DataFrame:
    """Rows up to and including the n-th success, in order. Only the n first successes are sorted for the cut."""
    successes = df.filter(ok).orderBy(*order).limit(n)
    last = successes.agg(F.max(F.struct(*order)).alias("_last"), F.count("*").alias("_n"))
    place = F.struct(*order)
    return df.crossJoin(F.broadcast(last)).filter((F.col("_n") < n) | (place <= F.col("_last"))).drop("_last", "_n")


#: Rows in a row that a window task of one key gets; longer keys are cut.
STRETCH = 100_000


def _stretched(df: DataFrame, key: list[str], order: list[str], size: int) -> DataFrame:
    """df with _rank, its place by key and order, and _stretch: rows of one key and stretch are neighbours, `size` at most."""
    return with_rank(df, [*key, *order]).withColumnRenamed("rank", "_rank").withColumn("_stretch", F.floor(F.col("_rank") / size))


def recent(df: DataFrame, n: int, key: list[str], order: list[str], value: str, size: int = STRETCH) -> DataFrame:
    """df with recent: the values of the last n rows up to each, oldest first.

    A key of many rows is cut into stretches, each with the last n - 1 rows of the one before, so no task sorts a key.
    """
    own = _stretched(df, key, order, max(size, n))
    late = F.pmod("_rank", F.lit(max(size, n))) > max(size, n) - n
    both = own.withColumn("_own", F.explode(F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    window = Window.partitionBy(*key, "_at").orderBy("_rank").rowsBetween(1 - n, 0)
    found = both.withColumn("_at", F.col("_stretch") + F.col("_own")).withColumn("recent", F.collect_list(value).over(window))
    return found.filter("_own = 0").drop("_own", "_at", "_rank", "_stretch")


def trailing_rate(log: DataFrame, seconds: int, most: int, least_gap: float, key: str, ts: str = "ts") -> DataFrame:
    """log with requests (in the trailing seconds), over_limit and too_close (to the one before).

    Time is cut into pieces, each with the end of the one before as far as a window reaches, so no task sorts a key.
    """
    reach = int(max(seconds, least_gap) * 1_000_000) + 1
    width = 10 * reach
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    own = log.withColumn("_at", micros).withColumn("_piece", F.floor(F.col("_at") / width))
    late = F.col("_at") - F.col("_piece") * width >= width - reach
    both = own.withColumn("_own", F.explode(F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).withColumn("_piece", F.col("_piece") + F.col("_own"))
    by_time = Window.partitionBy(key, "_piece").orderBy("_at")
    out = both.withColumn("requests", F.count("*").over(by_time.rangeBetween(-seconds * 1_000_000, 0)))
    gap = F.col("_at") - F.lag("_at").over(by_time)
    out = out.withColumn("over_limit", F.col("requests") > most).withColumn("too_close", F.coalesce(gap < int(least_gap * 1_000_000), F.lit(False)))
    return out.filter("_own = 0").drop("_at", "_piece", "_own")


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple]:
    """Runs of failures in one sorted range: (key, part, at, first, last, failures, opens, closes).

    `opens` and `closes` say whether a run is at the range's first and last row, where it may go on. A range whose first or
    last row is no failure has an empty run there, so that its neighbours know.
    """
    part, at, run, n = TaskContext.get().partitionId(), 0, None, 0
    for own, ok, place in _rows(batches, key, "_ok", "_place"):
        if run is not None and (ok or own != run[0]):
            yield run[0], part, at, *run[1:], at == 0, False
            run, at = None, at + 1
        elif n == 0 and ok:
            yield own, part, 0, None, None, 0, True, False
        at += n == 0 and bool(ok)
        n += 1
        if not ok:
            run = [own, place, place, 1] if run is None else [own, run[1], place, run[3] + 1]
    if run is not None:
        yield run[0], part, at, *run[1:], at == 0, True
    elif n:
        yield None, part, at, None, None, 0, False, True


def failure_streaks(log: DataFrame, n: int, key: str, order: list[str], ok: Column, parts: int | None = None) -> DataFrame:
    """(key, first, last, failures) of runs of n or more failures in a row; a success ends a run. A null outcome is a failure; rows
    without a key are one of their own.

    Rows are sorted once, by ranges of key and order, and each range is made to runs as it passes. Only the runs at a range's first and
    last row may go on in the next one: a few rows a range, which are put together by their key.
    """
    slim = log.select(key, *[c for c in order if c != key], F.coalesce(ok, F.lit(False)).alias("_ok"), F.col(order[-1]).alias("_place"))
    place = slim.schema["_place"].dataType
    schema = StructType([slim.schema[key], StructField("_part", IntegerType()), StructField("_at", LongType()), StructField("first", place), StructField("last", place), StructField("failures", LongType())])
    for name in ("_opens", "_closes"):
        schema = schema.add(name, BooleanType())
    runs = materialise(_ranged(slim, parts, key, *order).select(key, "_ok", "_place").mapInArrow(lambda b: _batches(_runs(b, key), schema), schema), "runs")
    inner = runs.filter("NOT _opens AND NOT _closes").select(key, "first", "last", "failures")
    edges = runs.filter("_opens OR _closes")
    in_order = Window.orderBy("_part", "_at")
    goes_on = F.lag("_closes").over(in_order) & (F.lag("failures").over(in_order) > 0) & F.col("_opens") & (F.col("failures") > 0) & F.lag(key).over(in_order).eqNullSafe(F.col(key))
    joined = edges.withColumn("_run", F.sum((~F.coalesce(goes_on, F.lit(False))).cast("long")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    outer = joined.filter("failures > 0").groupBy(key, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("failures").alias("failures")).drop("_run")
    return inner.unionByName(outer).filter(F.col("failures") >= n)


def latest_file(files: DataFrame, pattern: str) -> DataFrame:
    """One row: the newest file whose name fits a LIKE pattern; null if none does."""
    return files.filter(F.col("file").like(pattern)).agg(F.max_by("file", F.struct("modified", "file")).alias("file"))
