"""JSON Lines sources: lines with their file and number, strictly parsed, bad lines kept apart."""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.functions.jsonlines import parse_line


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False) -> DataFrame:
    """(file, value, block, row): raw lines; block and row order the lines of a file."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(path)
    # A mark that keeps its place in the file: the start of the split a line was read in, then its row there.
    return lines.select(F.col("_metadata.file_path").alias("file"), "value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def with_line_no(lines: DataFrame) -> DataFrame:
    """Adds line_no, the 1-based physical line in its file; blank lines count.

    Lines of a split are numbered from the split's first, and the splits' sizes are summed, so that no task
    sorts a whole file.
    """
    within = Window.partitionBy("file", "block").orderBy("row")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy("file", "block").count().select("file", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    numbered = lines.withColumn("at", F.row_number().over(within))
    return numbered.join(sizes, ["file", "block"]).withColumn("line_no", F.col("base") + F.col("at")).drop("at", "base")


def parse_lines(lines: DataFrame) -> DataFrame:
    """Adds valid and docs (see parse_line); blank lines are left out."""
    own = lines.filter(F.trim("value") != "").withColumn("parsed", parse_line(F.col("value")))
    return own.select("*", "parsed.valid", "parsed.docs").drop("parsed")


def read_jsonl(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False) -> DataFrame:
    """(file, block, row, doc): one row per valid line; blank and bad lines are skipped."""
    parsed = parse_lines(read_lines(spark, path, glob, recursive))
    return parsed.filter("valid").select("file", "block", "row", F.element_at("docs", 1).alias("doc"))


def explode_concatenated(lines: DataFrame) -> DataFrame:
    """One row per JSON value: that of a valid line, or those that a bad line starts with (pos from 0)."""
    parsed = lines if "docs" in lines.columns else parse_lines(lines)
    return parsed.select("*", F.posexplode("docs").alias("pos", "doc")).drop("docs")


def read_id_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(id): one per line, trimmed, blanks dropped."""
    return spark.read.text(path).select(F.trim("value").alias("id")).filter("id <> ''")


#: Files up to here are digested as one value by Spark; larger ones are read in pieces.
WHOLE_BYTES, PIECE_BYTES = 64 << 20, 4 << 20


def digest_in_pieces(path: str) -> str:
    """md5 of a file of any size, of which one piece is in memory at a time."""
    if path.startswith("file:"):
        store, where = fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    else:
        store, where = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    digest, piece = hashlib.md5(), bytearray(PIECE_BYTES)
    with store.open_input_stream(where, compression=None) as source:
        while n := source.readinto(piece):
            digest.update(memoryview(piece)[:n])
    return digest.hexdigest()


def scan_files(spark: SparkSession, path: str | list[str], glob: str | None = None, whole: int = WHOLE_BYTES) -> DataFrame:
    """(file, bytes, modified, md5) of whole files; the content never leaves the executors.

    The listing is a table; contents are read for the digest alone. A file of over `whole` bytes is streamed from its store by the
    task that has it, in pieces, so its size does not matter (a row of Spark ends at 2 GB); its store has to be one that
    pyarrow opens. Smaller ones come from any store that Spark reads. Empty files are not listed, as Spark's source has it.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(path)
    names = [F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")]

    @F.pandas_udf("string")
    def streamed(paths: pd.Series) -> pd.Series:
        return paths.map(digest_in_pieces)

    small = listed.filter(F.col("length") <= whole).select(*names, F.md5("content").alias("md5"))
    large = listed.filter(F.col("length") > whole).select(*names)
    # One file a task, if there are as many tasks: reading one takes as long as it is.
    dealt = large.repartition(F.col("file"))
    return small.unionByName(dealt.withColumn("md5", streamed("file")))


def union_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The valid records of several files, with the files' order as file_no."""
    parts = [read_jsonl(spark, p).withColumn("file_no", F.lit(i)) for i, p in enumerate(paths)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


RESULT = T.ArrayType(T.MapType(T.StringType(), T.StringType()))


def flatten_search_results(df: DataFrame, url_template: str, response: str = "response") -> DataFrame:
    """(url, id, name) of each result of a search response {"d": {"Results": [...]}}; d may be JSON text.

    The id is ProductId or Id (rows without are dropped), the name ProductName or Name or N/A; {id} in the
    template becomes the id.
    """
    inner = F.get_json_object(response, "$.d")
    results = F.from_json(F.get_json_object(inner, "$.Results"), RESULT)
    own = df.select(F.explode(results).alias("r"))

    def either(a: str, b: str) -> Column:
        ok = lambda k: F.when(~F.col("r")[k].isin("", "0", "false", "null", "[]", "{}"), F.col("r")[k])
        return F.coalesce(ok(a), ok(b))

    found = own.select(either("ProductId", "Id").alias("id"), F.coalesce(either("ProductName", "Name"), F.lit("N/A")).alias("name")).filter("id IS NOT NULL")
    return found.select(F.replace(F.lit(url_template), F.lit("{id}"), F.col("id")).alias("url"), "id", "name")
