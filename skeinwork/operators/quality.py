"""Validity of lines, files and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.functions.columns import first_truthy


def validate_lines(parsed: DataFrame) -> DataFrame:
    """Per file: valid, invalid and total non-blank lines; invalid_lines has the numbers of the invalid ones."""
    return parsed.groupBy("file").agg(
        F.count_if("valid").alias("valid_lines"),
        F.count_if(~F.col("valid")).alias("invalid_lines"),
        F.count("*").alias("total_lines"),
    )


def invalid_lines(parsed: DataFrame) -> DataFrame:
    """(file, line_no): a row for each invalid line, so that a file of bad lines alone fills no row."""
    return parsed.filter(~F.col("valid")).select("file", "line_no")


def validate_files(parsed: DataFrame) -> DataFrame:
    """Per file: products (valid lines), errors and whether it is valid."""
    files = parsed.groupBy("file").agg(F.count_if("valid").alias("products"), F.count_if(~F.col("valid")).alias("errors"))
    return files.withColumn("is_valid", F.col("errors") == 0)


def validation_totals(files: DataFrame) -> DataFrame:
    """Files, invalid files and products over the verdicts of validate_files."""
    return files.agg(F.count("*").alias("files"), F.count_if(~F.col("is_valid")).alias("invalid_files"), F.coalesce(F.sum("products"), F.lit(0)).alias("products"))


def repair(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejects): stripped valid lines and the others, each with file and line_no, which keep the order."""
    own = parsed.select("file", "line_no", F.trim("value").alias("value"), "valid")
    return own.filter("valid").drop("valid"), own.filter(~F.col("valid")).drop("valid")


def batch_line_stats(lines: DataFrame) -> DataFrame:
    """Non-blank lines per file, valid or not."""
    return lines.filter(F.trim("value") != "").groupBy("file").agg(F.count("*").alias("lines"))


def valid_products(df: DataFrame, required: tuple[str, ...] = ("ProductID", "Name")) -> DataFrame:
    """Rows in which every required field is truthy."""
    for name in required:
        df = df.filter(first_truthy(df, [name]).isNotNull())
    return df


def filter_supplier(df: DataFrame, part: str, column: str = "supplier_name") -> DataFrame:
    return df.filter(F.lower(column).contains(part.lower()))


def first_media_url(main: Column, lists: list[Column], mark: str = "/media/") -> Column:
    """The first URL that holds the mark: the main one, then those of the lists in order; null if none does."""
    both = F.concat(F.array(main), *[F.coalesce(x, F.array().cast("array<string>")) for x in lists])
    return F.try_element_at(F.filter(both, lambda x: x.contains(mark)), F.lit(1))


def has_link_fields(df: DataFrame) -> DataFrame:
    """Rows with a truthy url and id."""
    return df.filter(first_truthy(df, ["url"]).isNotNull() & first_truthy(df, ["id"]).isNotNull())


def is_stale(files: DataFrame, as_of: Column, max_age: str) -> DataFrame:
    """One row: the newest of `modified`, and whether it is older than max_age (an interval) at as_of; none is stale."""
    newest = files.agg(F.max("modified").alias("newest"))
    return newest.select("newest", F.coalesce(as_of - F.expr(f"INTERVAL {max_age}") > F.col("newest"), F.lit(True)).alias("stale"))
