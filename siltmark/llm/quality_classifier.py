"""Quality scores by Bradley-Terry pairwise ranking.

Each labelled pair of a good and a bad document is a preference; the score is linear in the documents' features and
is fitted by logistic loss on feature differences. The cut is a quantile of the scores of the fitted rows, and the
score that is returned is the logistic of the distance to the cut, so that the cut lies at ``threshold``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmark.llm._common import BLANKS, parquet, small_batches

#: Bounds of the fitting sample: labelled rows of each label, and preference pairs.
FIT_ROWS, FIT_PAIRS = 4000, 40_000
THRESHOLD = 0.3
FOLDS = 5
_LETTERS = re.compile(r"[^\W\d_]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_SYMBOLS = "#*$%&|<>@^~{}[]\\=_"
_MARKS = "!?"
FEATURES = ("log_words", "word_chars", "distinct", "top_word", "symbols", "pipes", "marks", "upper", "digits", "dup_lines", "line_words", "repeats", "stops", "short", "long", "wide")


def features(text: str | None) -> list[float]:
    """Of the whole text: shares and logarithms, so that they are comparable between texts of any length. An empty text gives zeros."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = len(text)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeats = sum(map(bytes.__eq__, words[1:], words[:-1]))
    lengths = list(map(len, words))
    return [
        np.log1p(n), sum(lengths) / n / 10, len(counts) / n, max(counts.values()) / n,
        min(3.0, sum(map(text.count, _SYMBOLS)) / n), min(2.0, text.count("|") / n), min(2.0, sum(map(text.count, _MARKS)) / n),
        sum(map(len, _UPPER.findall(text))) / chars, sum(map(text.count, "0123456789")) / chars,
        1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)), repeats / n,
        (text.count(",") + text.count(".")) / n, sum(x <= 3 for x in lengths) / n, sum(x > 15 for x in lengths) / n, len(text.encode("utf-8", "surrogatepass")) / chars - 1,
    ]


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return expanded((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray, threshold: float) -> np.ndarray:
        shift = np.log(threshold / (1 - threshold))
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + shift, -30, 30)))


def expanded(z: np.ndarray) -> np.ndarray:
    """Standardised features, clipped, with their squares: junk can lie on both sides of the usual."""
    z = np.clip(z, -6, 6)
    return np.column_stack([z, np.minimum(z * z, 16)])


def preferences(better: np.ndarray, worse: np.ndarray, pairs: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """So many random pairs, each of a good text and a bad one."""
    rng = np.random.default_rng(seed)
    return rng.choice(better, pairs), rng.choice(worse, pairs)


def fit(x: np.ndarray, good: np.ndarray, pairs: int = FIT_PAIRS, seed: int = 3, steps: int = 400, penalty: float = 1e-3) -> Ranking:
    """From features and labels. Without both labels there is no preference, and all texts score alike, above the cut."""
    if not len(x):
        x = np.zeros((1, len(FEATURES)))
        good = np.ones(1, bool)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = expanded((x - mean) / scale)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    w = np.zeros(z.shape[1])
    if not len(better) or not len(worse):
        return Ranking(mean, scale, w, -1.0)
    for_, against = preferences(better, worse, pairs, seed)
    d = z[for_] - z[against]
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):  # Adam on the mean logistic loss
        slope = -(d * (1 / (1 + np.exp(np.clip(d @ w, -30, 30))))[:, None]).mean(0) + penalty * w
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w -= 0.05 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    raw = z @ w
    order = np.sort(raw)
    tries = np.unique(np.linspace(0, len(order) - 1, 400).astype(int))
    cuts = [(order[i] + order[max(0, i - 1)]) / 2 for i in tries]
    # the quantile that tells the labels apart best, a bad text kept weighing as much as a good one lost
    lost = [((raw < c) & good).mean() + ((raw >= c) & ~good).mean() for c in cuts]
    return Ranking(mean, scale, w, float(cuts[int(np.argmin(lost))]))


def in_fold(id_: Column, folds: int = FOLDS) -> Column:
    """crc32 of the identifier as text, modulo the number of folds, is 0; a null identifier is in the fold."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % folds == 0, F.lit(True))


def fit_on_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = FIT_ROWS, folds: int = FOLDS) -> Ranking:
    """Fits on at most ``rows`` labelled documents of each label outside the held-out fold, those with the least hash.

    Rows with a null identifier or label don't count; of repeated labels the largest counts, of different texts with one
    identifier the one with the least features.
    """
    small_batches(docs.sparkSession)
    told = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good")).filter("id IS NOT NULL AND good IN (0, 1)").filter(~in_fold(F.col("id"), folds))
    told = told.groupBy("id").agg(F.max("good").alias("good"))
    least = [told.filter(F.col("good") == g).orderBy(F.xxhash64("id"), "id").limit(rows) for g in (0, 1)]
    chosen = least[0].union(least[1])  # bounded: 2 * rows small rows
    texts = docs.select(F.col(id_col).alias("of"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("of") == F.col("id")).select("id", "good", featured(F.col("text")).alias("x"))
    found = found.groupBy("id", "good").agg(F.min("x").alias("x")).toPandas().sort_values("id")  # a row for each of the chosen
    x = np.array(found["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, found["good"].to_numpy(int) == 1)


def featured(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([features(t) for t in batch])

    return run(text)


def quality_score(text: Column, model: Ranking, threshold: float = THRESHOLD) -> Column:
    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            x = np.array([features(t) for t in batch], float).reshape(-1, len(FEATURES))
            yield pd.Series(model.score(x, threshold))

    return run(text)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """Per input row: doc_id, held_out, score (0 to 1) and predicted (1 where score >= threshold).

    The score depends on the text alone; null counts as empty. Repeated rows score alike. An empty table gives no
    rows, and without usable labels every text scores above the threshold.
    """
    small_batches(docs.sparkSession)
    model = fit_on_labels(docs, labels, id_col, text_col, **options)
    scored = docs.select(F.col(id_col).alias("doc_id"), quality_score(F.col(text_col), model, threshold).alias("score"))
    return scored.select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows of docs, all columns, that score at least the threshold."""
    small_batches(docs.sparkSession)
    model = fit_on_labels(docs, labels, text_col=text_col, **options)
    return docs.filter(quality_score(F.col(text_col), model, threshold) >= threshold)


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return score_documents(parquet(spark, sf_dir, "documents").select("doc_id", "text"), parquet(spark, sf_dir, "labels"))


def crc_fold(id_: int) -> bool:
    """in_fold for one identifier, for tests."""
    return zlib.crc32(str(id_).encode()) % FOLDS == 0
