"""Column functions of the catalogue: truthiness, literals, slugs, URLs, rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def truthy(column: Column, kind: T.DataType) -> Column:
    """The value, or null where it is null, '', 0, false or an empty array or map (NaN counts as a value)."""
    if isinstance(kind, T.StringType):
        empty = column == ""
    elif isinstance(kind, T.BooleanType):
        empty = ~column
    elif isinstance(kind, T.NumericType):
        empty = column == 0
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        empty = F.size(column) == 0
    else:
        return column
    return F.when(~empty, column)


def first_truthy(df: DataFrame, names: Sequence[str]) -> Column:
    """The first truthy of the named columns that df has, as text."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    found = [truthy(F.col(n), kinds[n]).cast("string") for n in names if n in kinds]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def first_given(df: DataFrame, names: Sequence[str]) -> Column:
    """The first of the named columns that is not null, as text; an empty text counts."""
    found = [F.col(n).cast("string") for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def is_price(column: Column) -> Column:
    """Whether a text is a price literal: digits, perhaps with a dollar sign and decimals."""
    return F.trim(column).rlike(r"^\$?\d+(\.\d+)?$")


def slug(column: Column) -> Column:
    """Lower case, with everything but letters and digits folded into single hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(column), "[^a-z0-9]+", "-"), "^-|-$", "")


def category_slug(column: Column) -> Column:
    return F.replace(F.lower(column), F.lit(" "), F.lit("-"))


def absolute_url(column: Column, base: str) -> Column:
    """'' for nothing, absolute URLs as they are, others below base."""
    empty = column.isNull() | (column == "")
    absolute = column.startswith("http://") | column.startswith("https://")
    return F.when(empty, "").when(absolute, column).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(column, "^/+", "")))


def query_argument(column: Column, name: str) -> Column:
    """The first query argument of a URL by name, without regard to case, decoded; null if it is not there."""
    raw = F.regexp_extract(column, rf"(?i)[?&]{name}=([^&#]*)", 1)
    return F.when(column.rlike(rf"(?i)[?&]{name}="), F.try_url_decode(raw))


def split_list(column: Column) -> Column:
    """The parts of a comma list, trimmed, without empty ones; an empty array for null."""
    parts = F.filter(F.transform(F.split(column, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def percent(part: Column, whole: Column) -> Column:
    """100 part / whole as a double; 0 where whole is 0 or null."""
    return F.when(whole > 0, F.lit(100.0) * part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


# The arguments under which image servers give larger variants, in order.
VARIANT_ARGUMENTS = (
    "width=1200", "w=1200", "maxWidth=1200", "wid=1200", "maxwidth=1200",
    "width=1600", "w=1600", "maxWidth=1600", "wid=1600", "maxwidth=1600",
    "width=2000", "w=2000", "maxWidth=2000", "wid=2000", "maxwidth=2000",
    "width=2400", "w=2400", "maxWidth=2400", "wid=2400", "maxwidth=2400",
    "width=3000", "w=3000", "maxWidth=3000", "wid=3000", "maxwidth=3000",
    "format=jpeg&quality=100", "quality=100",
    "height=1200", "h=1200", "height=2000", "h=2000",
)


def url_variants(column: Column) -> Column:
    """The URL itself, then its variants in order, distinct; null for null."""
    mark = F.when(column.contains("?"), "&").otherwise("?")
    arguments = F.array(*[F.lit(x) for x in VARIANT_ARGUMENTS])
    found = F.concat(F.array(column), F.transform(arguments, lambda x: F.concat(column, mark, x)))
    return F.when(column.isNotNull(), F.array_distinct(found))


def instant(column: Column) -> Column:
    """A timestamp from text in any of the feed's three forms; null where it is none."""
    return F.try_to_timestamp(column)


def has_offset(column: Column) -> Column:
    """Whether a timestamp text carries a zone (Z or an offset)."""
    return column.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
