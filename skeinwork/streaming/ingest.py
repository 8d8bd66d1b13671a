"""Incremental runs: ingest with remembered ids, publishing in micro-batches, live monitoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from skeinwork.functions.jsonlines import parse_line
from skeinwork.operators.batching import assign_batches


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None, kind: str = "parquet", **options: str) -> DataFrame:
    reader = spark.readStream.format(kind).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def seen_once(stream: DataFrame, key: str, watermark: tuple[str, str] | None = None) -> DataFrame:
    """The first row of each key; rows without one are dropped.

    Ids are remembered for ever, as the batch ingest does, so the state grows with them; with a watermark
    (time column, delay) only those within the delay are, which is weaker and bounded.
    """
    own = stream.filter(F.col(key).isNotNull())
    if watermark is None:
        return own.dropDuplicates([key])
    return own.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what is there to parquet at path, once; the checkpoint makes the next run go on behind it."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LINES = "file string, value string, key string, doc string, reason string, rejected boolean"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep their state in RocksDB, which spills to disk; the session's own choice comes back behind it."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def state_size(query: StreamingQuery) -> dict[str, int]:
    """Rows and bytes of a stream's state as its last micro-batch left it: what is in memory, and the files of RocksDB; zeros if
    there was none."""
    operators = [o for p in query.recentProgress[-1:] for o in p["stateOperators"]]
    files = sum(o["customMetrics"].get("rocksdbSstFileSize", 0) for o in operators)
    return {"rows": sum(o["numRowsTotal"] for o in operators), "memory": sum(o["memoryUsedBytes"] for o in operators), "files": files}


def judged_lines(lines: DataFrame, key: str) -> DataFrame:
    """(file, value, key, doc, reason) of lines (file, value) that are not blank. reason is null for a line that is one JSON value
    with a key; else it says what is wrong."""
    parsed = lines.filter(F.trim("value") != "").withColumn("p", parse_line(F.col("value")))
    doc = F.when(F.col("p.valid"), F.element_at("p.docs", 1))
    own = parsed.select("file", "value", F.get_json_object(doc, f"$.{key}").alias("key"), doc.alias("doc"))
    return own.withColumn("reason", F.when(F.col("doc").isNull(), "not one JSON value").when(F.col("key").isNull(), f"no {key}"))


def ingest_lines(spark: SparkSession, source: str, folder: str, key: str, files_per_batch: int | None = None) -> dict[str, int]:
    """Takes in the JSON Lines files that have come to `source` since the last run; returns the size of what it remembers.

    Every line is parsed strictly, once, and written to folder/lines: those with a reason are the rejects (see rejects()). From there the
    first line of each key goes to folder/kept; keys seen in any earlier run are remembered in a state store on disk.
    Both steps are streams with checkpoints of their own, so a run that died is finished by the next one, and no line
    is lost or taken twice.
    """
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.load(source).select(F.col("_metadata.file_path").alias("file"), "value")
    judged = judged_lines(lines, key).withColumn("rejected", F.col("reason").isNotNull())
    out = judged.writeStream.format("parquet").partitionBy("rejected").option("path", f"{folder}/lines").option("checkpointLocation", f"{folder}/checkpoint-lines")
    out.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    good = spark.readStream.schema(LINES).parquet(f"{folder}/lines").filter("NOT rejected").select("file", "key", "doc")
    with state_on_disk(spark):
        kept = ingest(seen_once(good, "key"), f"{folder}/kept", f"{folder}/checkpoint-kept")
        kept.awaitTermination()
    return state_size(kept)


def rejects(spark: SparkSession, folder: str) -> DataFrame:
    """(file, value, reason) of the lines that ingest_lines() has not taken."""
    return spark.read.schema(LINES).parquet(f"{folder}/lines").filter("rejected").select("file", "value", "reason")


def publish_batches(stream: DataFrame, publish: Callable[[DataFrame, int], None], checkpoint: str, size: int | None = None, order: list[str] | None = None) -> StreamingQuery:
    """Hands every micro-batch to publish(batch, number). With `size` its rows have rank and batch_id: every `size` rows in
    `order` are a batch to flush, and what is left at the end is the last."""

    def flush(batch: DataFrame, number: int) -> None:
        publish(assign_batches(batch, size, order) if size else batch, number)

    return stream.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def monitor(stream: DataFrame, ts: str, ok: str, every: str = "60 seconds", delay: str = "10 minutes") -> DataFrame:
    """(start, ok, failed) counts per interval; intervals close once the watermark has passed them."""
    own = stream.withWatermark(ts, delay).groupBy(F.window(ts, every))
    return own.agg(F.count_if(F.col(ok)).alias("ok"), F.count_if(~F.col(ok)).alias("failed")).select(F.col("window.start").alias("start"), "ok", "failed")
