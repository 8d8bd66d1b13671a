"""Hierarchical language identification: the family first, then its languages one against one.

Features are hashed counts of character 1- to 4-grams over the letters of the whole text (case folded, other
characters become one blank), damped and brought to length one. Every classifier is a linear support vector
machine, fitted on a bounded sample: one of each family against the rest, then, within a family, one for
each pair of its languages.
"""

from __future__ import annotations

import unicodedata
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skeinwork.llm.common import bound_batches, fresh

# Languages by family (ISO 639-1). A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "nb", "nn", "is", "fy", "lb", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "ur", "bn", "mr", "gu", "pa", "ne"),
    "semitic": ("ar", "he", "mt"),
}
UNDETERMINED = "und"
#: Hashed features.
BUCKETS = 4096
#: Rows of each language that are learned from at most; the rows of the smallest hashes are taken.
SAMPLE_ROWS = 600
#: Rows that are learned from in all, shared out where there are many languages; each language has at least one.
SAMPLE_TOTAL = 9_600
SIZES = (1, 2, 3, 4)
#: Share of a language's n-grams that its usual ones make up, and what share of a text's they have at least: this part of
#: a low quantile over the rows that were learned from. A text of another language has a third of it or less.
USUAL, LOW, PART = 0.7, 0.001, 0.65


def family_of(lang: str) -> str:
    return next((f for f, own in FAMILIES.items() if lang in own), lang)


@lru_cache(1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case code point if it is a letter, itself if it is a mark, else a blank; and
    whether it is a mark."""
    out = np.full(sys.maxunicode + 1, 0x20, dtype=np.uint32)
    marks = np.zeros(sys.maxunicode + 1, dtype=bool)
    for c in range(sys.maxunicode + 1):
        char = chr(c)
        kind = unicodedata.category(char)[0]
        if kind in "LM":
            low = char.lower()
            out[c] = ord(low) if len(low) == 1 and kind == "L" else c
            marks[c] = kind == "M"
    return out, marks


def _points(text: str) -> np.ndarray:
    """The letters of a text and the marks behind a letter, folded; everything else is a blank."""
    letters, marks = _letters()
    raw = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    points, mark = letters[raw], marks[raw]
    if mark.any():
        # The last code point before each mark that is none decides: a mark counts only behind a letter.
        place = np.where(mark, -1, np.arange(len(raw)))
        last = np.maximum.accumulate(place)
        points[mark & ((last < 0) | (points[last] == 0x20))] = 0x20
    return points


def features(text: str | None) -> np.ndarray | None:
    """The feature vector of a text, or None if it has no letters. Long texts are counted in pieces."""
    if not text:
        return None
    counts = np.zeros(BUCKETS, dtype=np.float64)
    letters = False
    for at in range(0, len(text), 1 << 20):
        points = _points(text[max(0, at - 3) : at + (1 << 20)])
        blank = points == 0x20
        if blank.all():
            continue
        letters = True
        keep = ~blank
        keep[1:] |= ~blank[:-1]  # one blank behind each word
        points = np.concatenate(([0x20], points[keep], [0x20])).astype(np.uint64)
        gram = np.zeros(len(points), dtype=np.uint64)
        with np.errstate(over="ignore"):
            for n in SIZES:
                if len(points) < n:
                    break
                gram = gram[: len(points) - n + 1] * np.uint64(1_000_003) + points[n - 1 :]
                mixed = (gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                counts += np.bincount((mixed >> np.uint64(64 - 12)).astype(np.int64), minlength=BUCKETS)
    if not letters:
        return None
    counts = np.sqrt(counts)
    return (counts / np.linalg.norm(counts)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 60) -> np.ndarray:
    """Weights (the bias last) of a linear support vector machine, by dual coordinate descent; y is +1 or -1."""
    x = np.hstack((x, np.ones((len(x), 1), dtype=x.dtype))).astype(np.float64)
    square = (x * x).sum(axis=1)
    count = {s: max(1, int((y == s).sum())) for s in (1, -1)}
    most = np.array([cost * len(y) / (2 * count[int(s)]) for s in y])  # both sides weigh the same
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            gradient = y[i] * (w @ x[i]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), most[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class Model:
    """families and their weights (families x features + 1); for each family its languages, pairs and weights."""

    families: list[str]
    family_weights: np.ndarray
    languages: dict[str, list[str]]
    pairs: dict[str, list[tuple[int, int]]]
    pair_weights: dict[str, np.ndarray]
    usual: dict[str, np.ndarray] = field(default_factory=dict)  # of each language, which features are its usual ones
    least: dict[str, float] = field(default_factory=dict)  # and which share of a text's n-grams they have at least

    def like(self, text: str | None, lang: str) -> float:
        """The share of a text's n-grams that are usual ones of a language, over the least that is; 1 or more: the text is in it."""
        x = features(text)
        if x is None or lang not in self.usual:
            return 0.0
        return float((x[self.usual[lang]].astype(np.float64) ** 2).sum() / self.least[lang])

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the language's share of certainty, that of its family times that within it."""
        x = features(text)
        if x is None or not self.families:
            return UNDETERMINED, 0.0
        margin = self.family_weights[:, :-1] @ x + self.family_weights[:, -1]
        best = int(np.argmax(margin))
        family = self.families[best]
        score = _certainty(margin[best]) if len(self.families) > 1 else 1.0
        languages = self.languages[family]
        if len(languages) == 1:
            return languages[0], score
        w = self.pair_weights[family]
        votes, sure = np.zeros(len(languages)), np.zeros(len(languages))
        for (a, b), m in zip(self.pairs[family], w[:, :-1] @ x + w[:, -1]):
            p = _certainty(m)
            votes[a if m >= 0 else b] += 1
            sure[a] += p
            sure[b] += 1 - p
        first = max(range(len(languages)), key=lambda i: (votes[i], sure[i], -i))
        return languages[first], float(score * sure[first] / (len(languages) - 1))


def _certainty(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(2.5 * margin, -30, 30))))


def _usual(shares: np.ndarray) -> np.ndarray:
    """The features of which the n-grams of texts (rows) mostly are, so many that they are USUAL of them all."""
    mass = shares.mean(axis=0)
    order = np.argsort(-mass, kind="stable")
    out = np.zeros(shares.shape[1], dtype=bool)
    out[order[: int(np.searchsorted(np.cumsum(mass[order]), USUAL * mass.sum())) + 1]] = True
    return out


def fit(labelled: DataFrame, rows: int = SAMPLE_ROWS, total: int = SAMPLE_TOTAL) -> Model:
    """Learns from rows (text, lang) with a lang: at most `rows` of each language, fewer where there are so many languages
    that they would be over `total`. Every language that has a text with letters is learned.

    Only this bounded sample comes to the driver, as feature vectors made by the executors. Texts without
    letters are left out; with one language or none, that is what is predicted (or `und`).
    """
    own = labelled.filter(F.col("lang").isNotNull()).select(F.col("text").cast("string"), F.col("lang").cast("string"), F.xxhash64("text").alias("h"))
    counts = own.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct("h").alias("texts")).orderBy("lang").collect()  # a row a language
    if not counts:
        return Model([], np.zeros((0, BUCKETS + 1)), {}, {}, {})
    rows = max(1, min(rows, total // len(counts)))
    # Rows of small hashes, a few more than needed: equal texts have equal hashes, so distinct ones are counted.
    bound = F.lit(None).cast("long")
    for r in counts:
        share = min(1.0, 4.0 * rows / max(1, r["texts"]))
        bound = F.when(F.col("lang") == r["lang"], F.lit(min(2**63 - 1, int((share * 2 - 1) * 2**63)))).otherwise(bound)
    few = own.filter(F.col("h") <= bound).groupBy("lang", "h").agg(F.first("text").alias("text"))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("rank") <= rows)

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([None if (x := features(t)) is None else x.astype("<f2").tobytes() for t in texts], dtype=object)

    sample = ranked.select("lang", "h", vector("text").alias("x")).filter("x IS NOT NULL").orderBy("lang", "h").collect()
    names = sorted({r["lang"] for r in sample})
    x = np.array([np.frombuffer(r["x"], dtype="<f2") for r in sample], dtype=np.float32).reshape(len(sample), BUCKETS)
    lang = np.array([r["lang"] for r in sample], dtype=object)
    family = np.array([family_of(v) for v in lang], dtype=object)
    families = sorted(set(family))
    of = {f: [n for n in names if family_of(n) == f] for f in families}
    sign = lambda hit: np.where(hit, 1, -1)
    family_weights = np.array([fit_svm(x, sign(family == f)) for f in families]) if len(families) > 1 else np.zeros((len(families), BUCKETS + 1))
    pairs = {f: list(combinations(range(len(own)), 2)) for f, own in of.items()}
    pair_weights = {}
    for f, own in of.items():
        weights = []
        for a, b in pairs[f]:
            rows_of = (lang == own[a]) | (lang == own[b])
            weights.append(fit_svm(x[rows_of], sign(lang[rows_of] == own[a])))
        pair_weights[f] = np.array(weights).reshape(len(weights), BUCKETS + 1)
    usual, least = {}, {}
    for name in names:
        own = x[lang == name].astype(np.float64) ** 2  # counts of n-grams, each text's as shares
        usual[name] = _usual(own)
        # How much of a text they are is measured on the half that they were not taken from; one text says nothing of others.
        shares = [own[1 - i :: 2][:, _usual(own[i::2])].sum(axis=1) for i in (0, 1)] if len(own) > 1 else [np.zeros(1)]
        least[name] = max(PART * float(np.quantile(np.concatenate(shares), LOW)), 1e-9)
    return Model(families, family_weights, of, pairs, pair_weights, usual, least)


def predict_column(spark, model: Model):
    """A column function: text to struct(lang_pred, score). A null text or one without letters is `und`, 0."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score"]).astype({"score": float})

    return run


def held_out(doc_id):
    """Whether a document is not learned from: crc32 of its id as text, modulo 4, is 2. A null id is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score. Null ids and repeated rows stay."""
    predict = predict_column(docs.sparkSession, model)
    own = docs.select(F.col("doc_id").cast("long"), predict(F.col("text").cast("string")).alias("p"))
    return own.select("doc_id", held_out("doc_id").alias("held_out"), "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """docs without the rows that are `und` or whose text is unlike the texts of the language it is nearest to: another language, or
    letters without one. All columns are kept, of any name."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.like(t, shared.value.predict(t)[0]) >= 1.0 for t in texts], dtype=bool)

    (p,) = fresh(docs, "lang_known")
    return docs.withColumn(p, known(F.col("text").cast("string"))).filter(F.col(p)).drop(p)
