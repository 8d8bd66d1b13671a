"""Strict JSON per line, in Arrow batches: Spark's own parsers accept trailing data, Python's does not."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATORS = " \r\n\t"
_decoder = json.JSONDecoder()


def leading_values(line: str) -> list[str]:
    """Every JSON value from the start of a line, up to the first failure, each as text of its own."""
    out, at = [], 0
    while at < len(line):
        try:
            value, end = _decoder.raw_decode(line, at)
        except ValueError:
            break
        out.append(json.dumps(value, ensure_ascii=False))
        at = end
        while at < len(line) and line[at] in _SEPARATORS:
            at += 1
    return out


def _parse(line: str | None) -> tuple[bool, list[str]]:
    if line is None or not line.strip():
        return False, []
    try:
        return True, [json.dumps(json.loads(line.strip()), ensure_ascii=False)]
    except ValueError:
        return False, leading_values(line)


def parse_line(line: Column) -> Column:
    """struct(valid, docs): whether the line is one JSON value; that value, or of a bad line those it starts with."""

    @F.pandas_udf("valid boolean, docs array<string>")
    def run(lines: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_parse(x) for x in lines], columns=["valid", "docs"]).astype({"valid": bool})

    return run(line)


def canonical(text: str | None, exclude: tuple[str, ...]) -> str | None:
    if text is None:
        return None
    try:
        value = json.loads(text)
    except ValueError:
        return None
    if isinstance(value, dict):
        value = {k: v for k, v in value.items() if k not in exclude}
    return json.dumps(value, sort_keys=True)


def canonical_json(exclude: tuple[str, ...]):
    """A column function: JSON text with sorted keys and without the excluded ones; null for bad JSON."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([canonical(t, exclude) for t in texts], dtype=object)

    return run
