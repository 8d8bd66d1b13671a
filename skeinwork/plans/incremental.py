"""JSON Lines and streaming queries, over files that Spark derives from events.

Every event becomes a line of JSON; some lines are damaged by a rule of the event's id, so that the expected
verdicts follow from the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.operators import quality as V
from skeinwork.plans.registry import query
from skeinwork.sources import jsonl as S
from skeinwork.sources import sinks, versions
from skeinwork.sources.storage import fresh_path, table
from skeinwork.streaming import ingest as T

LINE = "concat('{\"id\":', event_id, ',\"user\":', user_id, '}')"
DAMAGE = f"CASE event_id % 10 WHEN 0 THEN substr({LINE}, 1, length({LINE}) - 1) WHEN 1 THEN concat({LINE}, {LINE}) WHEN 2 THEN concat({LINE}, ' xx') WHEN 3 THEN concat(' ', {LINE}, ' ') WHEN 4 THEN '' ELSE {LINE} END"
BAD = "event_id % 10 IN (0, 1, 2)"


def event_lines(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the damaged lines, one subfolder per event type, which names the file below."""
    path = fresh_path(spark, "lines")
    rows = table(spark, sf_dir, "events").select("event_type", F.expr(DAMAGE).alias("value"))
    rows.write.partitionBy("event_type").text(path)
    return path


def ordered_lines(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the damaged lines in one file per event type, in order of the event's id."""
    path = fresh_path(spark, "ordered")
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", F.expr(DAMAGE).alias("value"))
    rows.repartition("event_type").sortWithinPartitions("event_type", "event_id").drop("event_id").write.partitionBy("event_type").text(path)
    return path


def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = S.read_lines(spark, event_lines(spark, sf_dir), recursive=True)
    return S.parse_lines(lines).withColumn("file", F.regexp_extract("file", "event_type=([^/]*)", 1))


@query("SELECT event_type AS file, event_id AS id FROM events WHERE event_id % 10 IN (3, 5, 6, 7, 8, 9)")
def s1_read_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = S.read_jsonl(spark, event_lines(spark, sf_dir), recursive=True)
    return docs.select(F.regexp_extract("file", "event_type=([^/]*)", 1).alias("file"), F.get_json_object("doc", "$.id").cast("long").alias("id"))


@query("SELECT event_id AS id, 0 AS pos FROM events WHERE event_id % 10 NOT IN (0, 4) UNION ALL SELECT event_id, 1 FROM events WHERE event_id % 10 = 1")
def s2_explode_concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.explode_concatenated(parsed_lines(spark, sf_dir))
    return found.select(F.get_json_object("doc", "$.id").cast("long").alias("id"), "pos")


@query("SELECT event_type AS file, generate_series AS line_no FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1), generate_series(1, n)")
def s3_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of one file per event type, numbered; blank lines count."""
    path = fresh_path(spark, "numbered")
    rows = table(spark, sf_dir, "events").select("event_type", F.expr(DAMAGE).alias("value"))
    rows.repartition("event_type").write.partitionBy("event_type").text(path)
    lines = S.with_line_no(S.read_lines(spark, path, recursive=True))
    return lines.select(F.regexp_extract("file", "event_type=([^/]*)", 1).alias("file"), F.col("line_no").cast("long").alias("line_no"))


@query("SELECT 'https://shop.example.com/' || event_id AS url, event_id::VARCHAR AS id, CASE WHEN event_id % 3 = 0 THEN 'N/A' ELSE event_type END AS name FROM events WHERE event_id > 0")
def s4_flatten_search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as results of search responses, one for each user and thousand of event ids, so that none grows without
    bound; half of them hold d as JSON text."""
    events = table(spark, sf_dir, "events")
    result = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.col("event_id").alias("Id")))).otherwise(F.to_json(F.struct(F.col("event_id").alias("ProductId"), F.col("event_type").alias("ProductName"))))
    body = events.groupBy("user_id", F.floor(F.col("event_id") / 1000)).agg(F.concat(F.lit('{"Results":['), F.array_join(F.collect_list(result), ","), F.lit("]}")).alias("d"))
    response = F.when(F.col("user_id") % 2 == 0, F.concat(F.lit('{"d":'), "d", F.lit("}"))).otherwise(F.to_json(F.struct("d")))
    return S.flatten_search_results(body.select(response.alias("response")), "https://shop.example.com/{id}")


def published(spark: SparkSession, sf_dir: str) -> str:
    """A table of orders in two versions; a writer that started from the first one as well is refused."""
    path = fresh_path(spark, "published")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    first = versions.publish(orders.filter("price > 100000"), path)
    versions.publish(orders, path, base=first)
    try:
        versions.publish(orders.filter("price <= 100000"), path, base=first)
    except versions.VersionConflict:
        return path
    raise AssertionError("a version was replaced")


@query("SELECT o_orderkey AS id, o_totalprice AS price FROM orders")
def s6_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of the published orders."""
    return versions.read_version(spark, published(spark, sf_dir))


@query("SELECT 1 AS version, count(*) FILTER (o_totalprice > 100000) AS n, coalesce(sum(o_orderkey) FILTER (o_totalprice > 100000), 0)::BIGINT AS keys FROM orders UNION ALL SELECT 2, count(*), sum(o_orderkey)::BIGINT FROM orders")
def s6_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each version of the published orders holds; the older one can still be read."""
    path = published(spark, sf_dir)
    own = [versions.read_version(spark, path, n).agg(F.lit(n).alias("version"), F.count("*").alias("n"), F.coalesce(F.sum("id"), F.lit(0)).alias("keys")) for n in versions.versions(spark, path)]
    return own[0].unionByName(own[1])


@query(f"SELECT event_type AS file, md5(content) AS md5, strlen(content) AS bytes, TRUE AS dated FROM (SELECT event_type, string_agg({DAMAGE}, chr(10) ORDER BY event_id) || chr(10) AS content FROM events GROUP BY 1)")
def s7_scan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file of lines per event type, with its size, digest and whether it has a date; the larger ones are read in pieces."""
    files = S.scan_files(spark, f"{ordered_lines(spark, sf_dir)}/*", "*.txt", whole=1 << 14).filter("bytes > 0")
    return files.select(F.regexp_extract("file", "event_type=([^/]*)", 1).alias("file"), "md5", "bytes", (F.col("modified") > "2020-01-01").alias("dated"))


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'F'")
def s8_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second run appends, the first one having brought the finished orders."""
    path = fresh_path(spark, "appended")
    orders = table(spark, sf_dir, "orders")
    versions.append_new(orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")), path, "id")
    return versions.append_new(orders.select(F.col("o_orderkey").alias("id")), path, "id")


@query("""SELECT id, CASE WHEN id % 3 = 0 THEN 1 WHEN id % 3 = 1 THEN 2 ELSE 3 END AS run FROM (SELECT DISTINCT l_partkey AS id FROM lineitem)""")
def s8_appended_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts that each of three runs was the first to bring; every run also brings those of the runs before, several times."""
    path = fresh_path(spark, "runs")
    lines, found = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id")), []
    for run in (1, 2, 3):
        found.append(versions.append_new(lines.filter(F.col("id") % 3 < run), path, "id").withColumn("run", F.lit(run)))
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("SELECT dense_rank() OVER (ORDER BY event_type) - 1 AS file_no, count(*) FILTER (event_id % 10 IN (3, 5, 6, 7, 8, 9)) AS n FROM events GROUP BY event_type")
def s9_union_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All event types' files, in the order of their names."""
    path = event_lines(spark, sf_dir)
    types = [r[0] for r in table(spark, sf_dir, "events").select("event_type").distinct().orderBy("event_type").collect()]  # a row a file
    return S.union_files(spark, [f"{path}/event_type={t}" for t in types]).groupBy("file_no").agg(F.count("*").alias("n"))


@query("SELECT event_type AS kind, count(*) AS lines FROM events WHERE event_id % 3 <> 0 GROUP BY 1")
def s10_file_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the files whose name fits are read: a third of the events lies in files of another ending beside them."""
    path = fresh_path(spark, "filtered")
    rows = table(spark, sf_dir, "events").select("event_type", "event_id", F.lit("line").alias("value"))
    rows.filter("event_id % 3 <> 0").drop("event_id").write.partitionBy("event_type").text(path)
    rows.filter("event_id % 3 = 0").drop("event_id").write.mode("append").option("compression", "gzip").partitionBy("event_type").text(path)
    lines = S.read_lines(spark, path, "part-*.txt", recursive=True)
    return lines.groupBy(F.regexp_extract("file", "event_type=([^/]*)", 1).alias("kind")).agg(F.count("*").alias("lines"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def s11_write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "report")
    sinks.write_report({"by_type": table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))}, path)
    return spark.read.schema("event_type string, n long").json(f"{path}/by_type")


@query("SELECT url, page_id AS id, 'page' AS name, length(html) AS a FROM pages")
def s12_reorder_link_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "pages").select(F.length("html").cast("long").alias("a"), F.lit("page").alias("name"), F.col("page_id").alias("id"), "url")
    return sinks.reorder_link_columns(own)


@query("SELECT DISTINCT user_id::VARCHAR AS id FROM events WHERE user_id % 7 <> 0")
def s13_read_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids from a list with blank lines and spaces."""
    path = fresh_path(spark, "ids")
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    users.select(F.when(F.col("user_id") % 7 == 0, " ").otherwise(F.concat(F.lit(" "), "user_id")).alias("value")).write.text(path)
    return S.read_id_list(spark, path)


@query(f"SELECT event_type AS file, count(*) FILTER (NOT ({BAD})) AS valid_lines, count(*) FILTER ({BAD}) AS invalid_lines, count(*) AS total_lines FROM events WHERE event_id % 10 <> 4 GROUP BY 1")
def v1_validate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsed_lines(spark, sf_dir).withColumn("line_no", F.col("row"))
    return V.validate_lines(parsed)


@query(f"SELECT event_type AS file, line_no FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS line_no FROM events) WHERE {BAD}")
def v1_invalid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of the invalid lines; blank lines count."""
    parsed = S.parse_lines(S.with_line_no(S.read_lines(spark, ordered_lines(spark, sf_dir), recursive=True)))
    return V.invalid_lines(parsed).select(F.regexp_extract("file", "event_type=([^/]*)", 1).alias("file"), F.col("line_no").cast("long").alias("line_no"))


@query(f"SELECT count(DISTINCT event_type) AS files, count(DISTINCT event_type) FILTER ({BAD}) AS invalid_files, count(*) FILTER (NOT ({BAD})) AS products FROM events WHERE event_id % 10 <> 4")
def v2_validate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.validation_totals(V.validate_files(parsed_lines(spark, sf_dir)))


@query(f"SELECT event_type AS file, {LINE} AS value FROM events WHERE event_id % 10 NOT IN (0, 1, 2, 4)")
def v3_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = V.repair(parsed_lines(spark, sf_dir).withColumn("line_no", F.col("row")))
    return good.select("file", "value")


def event_files(spark: SparkSession, sf_dir: str, name: str, files: int) -> str:
    """A folder of so many files, each with the events of one remainder of the id."""
    path = fresh_path(spark, name)
    for i in range(files):
        table(spark, sf_dir, "events").filter(F.col("event_id") % files == i).coalesce(1).write.mode("append").parquet(path)
    return path


@query("SELECT DISTINCT user_id FROM events")
def t1_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users of the event stream, each once, from four files in four micro-batches, so that most were seen in an earlier
    file; a second run over the same files adds nothing."""
    path, source = fresh_path(spark, "ingested"), event_files(spark, sf_dir, "arriving", 4)
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        stream = T.read_stream(spark, source, schema, files_per_batch=1).select("user_id")
        T.ingest(T.seen_once(stream, "user_id"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query(f"""SELECT 'kept' AS kind, user_id::VARCHAR AS line, NULL AS reason, 1 AS n FROM events WHERE event_id % 10 NOT IN (0, 1, 2, 4, 6) GROUP BY user_id
  UNION ALL SELECT 'rejected', {DAMAGE}, 'not one JSON value', count(*) FROM events WHERE {BAD} GROUP BY 2 UNION ALL SELECT 'rejected', '{{"id":' || event_id || '}}', 'no user', count(*) FROM events WHERE event_id % 10 = 6 GROUP BY 2""")
def t1_damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged lines arrive in four files, two before the first run and two before the second; a third run finds nothing new. The first
    line of each user is kept; bad lines and those without a user are set apart."""
    path = fresh_path(spark, "lines")
    line = F.when(F.col("event_id") % 10 == 6, F.concat(F.lit('{"id":'), "event_id", F.lit("}"))).otherwise(F.expr(DAMAGE))
    for run in range(3):
        if run < 2:
            own = table(spark, sf_dir, "events").filter(F.col("event_id") % 2 == run).select(line.alias("value"), (F.col("event_id") % 4).alias("part"))
            own.write.mode("append").partitionBy("part").text(f"{path}/in")
        T.ingest_lines(spark, f"{path}/in/*", f"{path}/out", "user", files_per_batch=2)
    kept = spark.read.parquet(f"{path}/out/kept").select(F.lit("kept").alias("kind"), F.col("key").alias("line"), F.lit(None).cast("string").alias("reason"))
    bad = T.rejects(spark, f"{path}/out").select(F.lit("rejected").alias("kind"), F.col("value").alias("line"), "reason")
    return kept.unionByName(bad).groupBy("kind", "line", "reason").agg(F.count("*").alias("n"))


@query("SELECT file, (rank - 1) // 300 + 1 AS flush, count(*) AS n, min(event_id) AS first FROM (SELECT event_id % 3 AS file, event_id, row_number() OVER (PARTITION BY event_id % 3 ORDER BY event_id) AS rank FROM events) GROUP BY 1, 2")
def t2_publish_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files arrive one after the other; of each, every 300 events are published, and then the remainder."""
    path, source = fresh_path(spark, "micro"), event_files(spark, sf_dir, "arriving", 3)
    stream = T.read_stream(spark, source, table(spark, sf_dir, "events").schema, files_per_batch=1)
    publish = lambda batch, number: batch.select("event_id", F.col("batch_id").alias("flush")).write.mode("overwrite").parquet(f"{path}/out/batch={number}")
    T.publish_batches(stream, publish, f"{path}/checkpoint", 300, ["event_id"]).awaitTermination()
    out = spark.read.parquet(f"{path}/out").groupBy("batch", "flush").agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.min(F.col("event_id") % 3).alias("file"))
    return out.select("file", "flush", "n", "first")


@query("SELECT event_id FROM events")
def t3_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with one checkpoint: the second goes on behind the first, so that every event is there once."""
    path = fresh_path(spark, "resumed")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    for part in ("event_type < 'e'", "event_type >= 'e'"):
        events.filter(part).write.mode("append").parquet(f"{path}/in")
        T.ingest(T.read_stream(spark, f"{path}/in", events.schema).select("event_id"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("""SELECT time_bucket(INTERVAL 60 SECOND, ts) AS start, count(*) FILTER (event_type <> 'error') AS ok, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1
  HAVING time_bucket(INTERVAL 60 SECOND, ts) + INTERVAL 60 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def t4_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes a minute of the event stream, of the minutes that the watermark has closed."""
    path = fresh_path(spark, "monitor")
    stream = T.read_stream(spark, f"{sf_dir}/events.parquet*", table(spark, sf_dir, "events").schema).select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("ok"))
    T.ingest(T.monitor(stream, "ts", "ok"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out").withColumn("start", F.col("start").cast("timestamp_ntz"))
