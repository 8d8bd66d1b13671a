"""URL filter: host rules first, else logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
BUCKETS = 1 << 18
SIZES = (3, 4, 5)
#: Labelled URLs that are learned from at most: those of the smallest hashes.
SAMPLE_ROWS = 20_000

# The labelled table's words, by hand: what names sites that are blocked, and what names others.
BLOCKED_WORDS = (
    "casino casinos poker slots jackpot roulette blackjack bet bets betting sportsbook lottery bingo gambling wager "
    "pills meds pharmacy viagra cialis steroids diet-pills adult adults xxx porn porno sex sexy nude cams escort hookup singles "
    "spam spammer linkfarm backlinks link-exchange ads adserver ad-network ad-click tracker tracking clicks popunder adware malware spyware phishing "
    "crack keygen warez torrent serials replica fake-watches payday quick-loans easy-cash free-money get-rich giveaway prizes "
    "winner miracle-cure weight-loss followers hacked botnet"
).split()
ALLOWED_WORDS = (
    "news weather library garden recipes history museum science travel music health city school sport university journal "
    "archive radio atlas forum wiki docs software hardware theatre nation station therapy north south tension notion heather thought "
    "ring anthem bread mother father brother weather-report council cinema kitchen bicycle railway harbour mountain river ocean forest "
    "village castle church temple market bakery brewery vineyard hotel hostel airport hospital clinic dentist doctor lawyer notary court "
    "parliament ministry police fire-brigade army navy embassy passport census statistics geology physics chemistry biology mathematics "
    "economics philosophy poetry novel author painter sculpture gallery opera ballet orchestra guitar piano violin football tennis "
    "cycling rowing chess weaving pottery carpentry plumbing electrician roofing insurance bank savings pension energy solar wind water "
    "recycling wildlife birds horses dogs cats aquarium zoo alphabet better essex roads heads uploads classes specialist theory either "
    "northern other there those thing thorn inner render entry tether ether ration edition heron ontario shore whale when which"
).split()
#: Parts that both kinds of names are joined with, and the shapes of both kinds of URLs.
COMPANIONS = ("online", "best", "shop", "club", "world", "free", "my", "cheap", "blog", "hub", "top", "live", "zone", "today", "plus", "24")
DOMAINS = ("com", "org", "net", "example.com", "example.org", "example.net", "co.uk", "de", "fr", "es", "info", "edu", "gov", "io")
STARTS = ("http://", "https://www.", "https://", "http://m.", "https://blog.", "https://en.")
PATHS = ("", "/", "/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}?page=2", "/en/{}#top", "/index.html", "/articles/{}", "/{}")


def labelled_rows() -> list[tuple[str, str]]:
    """The small labelled table (url, verdict): each word alone and joined with companions, in turn under all shapes,
    which both kinds share and which therefore say nothing."""
    out = []
    for verdict, words in ((BLOCK, BLOCKED_WORDS), (ALLOW, ALLOWED_WORDS)):
        for i, word in enumerate(words):
            other = [COMPANIONS[(5 * i + k) % len(COMPANIONS)] for k in (0, 3)]
            for k, name in enumerate((word, f"{word}-{other[0]}", f"{other[1]}-{word}")):
                at = 3 * i + k
                path = PATHS[at % len(PATHS)].format(at)
                out.append((f"{STARTS[at % len(STARTS)]}{name}.{DOMAINS[(at + i) % len(DOMAINS)]}{path}", verdict))
    return out


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no `://`."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, both null if none does; of equally long ones, that with the
    longer host. A rule fits its host and all subdomains where the path starts with the rule's."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def grams(host: str, path: str) -> np.ndarray:
    """Hashed n-grams of the host and of the path, each marked at its ends; each bucket once. Runs of digits are one 0."""
    out = set()
    for mark, part in (("h", host), ("p", path)):
        data = re.sub(r"\d+", "0", f"^{part}$".lower()).encode()
        for n in SIZES:
            for i in range(len(data) - n + 1):
                out.add(zlib.crc32(data[i : i + n] + mark.encode()) % BUCKETS)
    return np.array(sorted(out), dtype=np.int64)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def chance(self, host: str, path: str) -> float:
        """Of a URL to be blocked. Long URLs have no more say than short ones: the weights are averaged."""
        own = grams(host, path)
        z = self.bias + (self.weights[own].sum() / np.sqrt(len(own)) if len(own) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (url, verdict)."""
    return spark.createDataFrame(labelled_rows(), "url string, verdict string")


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS, rounds: int = 800, rate: float = 2.0, decay: float = 1e-4) -> Model:
    """Learns from at most `rows` rows (url, verdict); rows without a url or with another verdict are left out."""
    host, path = host_and_path(F.col("url").cast("string"))
    own = labelled.filter(F.col("verdict").isin(ALLOW, BLOCK) & F.col("url").isNotNull()).select(host.alias("host"), path.alias("path"), "verdict", F.xxhash64("url").alias("h"))
    sample = own.orderBy("h", "verdict").limit(rows).collect()
    weights, bias = np.zeros(BUCKETS), 0.0
    if not sample:
        return Model(weights, bias)
    found = [grams(r["host"], r["path"]) for r in sample]
    row = np.repeat(np.arange(len(found)), [len(g) for g in found])
    column = np.concatenate(found)
    value = 1 / np.sqrt(np.array([max(1, len(g)) for g in found]))[row]
    y = np.array([r["verdict"] == BLOCK for r in sample], dtype=float)
    for _ in range(rounds):
        z = bias + np.bincount(row, weights[column] * value, minlength=len(y))
        off = 1 / (1 + np.exp(-z)) - y
        gradient = np.bincount(column, off[row] * value, minlength=BUCKETS) / len(y) + decay * weights
        weights -= rate * 10 * gradient
        bias -= rate * off.mean()
    return Model(weights, bias)


def judge(pages: DataFrame, model: Model, rules: list[Rule], least: float = 0.5) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, chance (of the method, to be blocked).

    A null URL or one without `://` has an empty host and path and is allowed unless a rule says otherwise.
    Null ids and repeated rows stay, other columns are left out.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def chance(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            yield pd.Series([shared.value.chance(h, p) if h else 0.0 for h, p in zip(hosts, paths)], dtype=float)

    host, path = host_and_path(F.col("url").cast("string"))
    parts = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    scored = parts.select("*", rule.alias("rule"), verdict.alias("ruled"), chance("host", "path").alias("chance"))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("chance") >= least, BLOCK).otherwise(ALLOW)).alias("verdict"), "chance")
