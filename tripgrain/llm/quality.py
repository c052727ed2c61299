"""Quality of documents by ordinal cumulative-link regression on graded ratings.

All grades share one vector of weights over hashed features of a text; ordered thresholds cut the
score into grades: P(grade <= k) = sigmoid(threshold_k - score). This gives the expected grade and
the probability of the best grades, by which documents are chosen.

Features are shares of a text's words by hashed word, by hashed shape (letters, capitals and signs
in runs) and by repetition of the words before, as square roots. A word of over `LONGEST_WORD`
characters, as in texts without blanks, counts as consecutive pieces of that length, each a word.
The model is fitted to at most
`MAX_RATED` rated documents, those of the lowest hash of their id; everything else covers all rows.

Defined results: NULL and empty texts have no features and get the probabilities of the thresholds
alone; ratings that are NULL are left out, and a document rated more than once counts once for each
rating; without ratings, or with one grade only, every document gets that grade (NULL if none);
rows with equal ids are scored one by one; result columns replace input columns of the same name.
Texts are read whole.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrain.llm.columns import (
    bounded_broadcast,
    fresh_name,
    prepare_workers,
    whole_text,
    with_results,
)

MAX_RATED = 6000
DIMENSIONS = 1 << 12
LONGEST_WORD = 64
STEPS, RATE, SHRINK = 400, 0.05, 1e-4

# Letters a, capitals A, digits 0; all other characters of Latin-1 stand for themselves.
_SHAPE = {
    code: "A" if chr(code).isupper() else "a" if chr(code).isalpha() else "0" if chr(code).isdigit()
    else chr(code)
    for code in range(0x250)
}


def _hashed(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (DIMENSIONS - 1)


@lru_cache(maxsize=50_000)
def _word_features(word: str) -> tuple[int, int]:
    shape = word.translate(_SHAPE)
    runs = "".join(b for a, b in zip(" " + shape, shape) if a != b)
    return _hashed(f"w:{word.lower()}"), _hashed(f"s:{runs}")


def _words(text: str) -> list[str]:
    words = text.split()
    if max(map(len, words), default=0) <= LONGEST_WORD:
        return words
    return [
        word[at : at + LONGEST_WORD] for word in words for at in range(0, len(word), LONGEST_WORD)
    ]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features, every word of it counted."""
    words = _words(text)
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    counts: Counter = Counter()
    for word, times in Counter(words).items():
        for feature in _word_features(word):
            counts[feature] += times
    same = sum(map(str.__eq__, words, words[1:]))
    counts[_hashed("r:word")] += same
    counts[_hashed("r:other")] += len(words) - 1 - same
    # How much of the text is new: long repetition of lines or phrases shows as few kinds of pairs.
    kinds = len(set(zip(words, words[1:], words[2:])))
    counts[_hashed("r:phrase")] += max(0, len(words) - 2 - kinds)
    index = np.fromiter(counts.keys(), np.int32, len(counts))
    value = np.fromiter(counts.values(), np.float32, len(counts))
    return index, np.sqrt(value / len(words))


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """Weights, ordered thresholds and the grades they separate, from the lowest up."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: list[float]

    def score(self, text: str) -> float:
        index, value = features(text)
        return float(self.weights[index] @ value)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade above the k-th) for each row and each threshold."""
        return 1.0 - _sigmoid(self.thresholds[None, :] - scores[:, None])


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], ratings: list[float]) -> OrdinalModel:
    """Maximum likelihood with a little shrinkage, by Adam over all rows at once.

    The first threshold is free and the others lie above it by exponentials, so they stay ordered.
    """
    grades = sorted(set(ratings))
    weights = np.zeros(DIMENSIONS)
    if len(grades) < 2:
        return OrdinalModel(weights, np.empty(0), grades)
    grade = np.array([grades.index(rating) for rating in ratings])
    row = np.repeat(np.arange(len(rows)), [len(index) for index, _ in rows])
    index = np.concatenate([index for index, _ in rows])
    value = np.concatenate([value for _, value in rows]).astype(float)
    levels = len(grades) - 1
    below = np.array([(grade <= k).mean() for k in range(levels)]).clip(1e-3, 1 - 1e-3)
    starts = np.log(below / (1 - below))
    steps = np.log(np.maximum(np.diff(starts), 1e-2))
    state = np.concatenate([weights, starts[:1], steps])
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, STEPS + 1):
        weights, gaps = state[:DIMENSIONS], np.exp(state[DIMENSIONS + 1 :])
        thresholds = state[DIMENSIONS] + np.concatenate([[0.0], np.cumsum(gaps)])
        scores = np.bincount(row, value * weights[index], len(rows))
        # P(y = k) = upper - lower, with the outermost thresholds at infinity.
        padded = np.concatenate([[-np.inf], thresholds, [np.inf]])
        upper, lower = _sigmoid(padded[grade + 1] - scores), _sigmoid(padded[grade] - scores)
        share = np.maximum(upper - lower, 1e-9)
        slope_upper, slope_lower = upper * (1 - upper) / share, lower * (1 - lower) / share
        by_score = (slope_upper - slope_lower) / len(rows)
        pull = np.bincount(grade, slope_upper, levels + 1)[:levels]
        push = np.bincount(grade, slope_lower, levels + 1)[1:]
        by_threshold = (push - pull) / len(rows)
        by_weight = np.bincount(index, value * by_score[row], DIMENSIONS) + SHRINK * weights
        above = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([by_weight, above[:1], above[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        moved = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        state = state - RATE * moved
    gaps = np.exp(state[DIMENSIONS + 1 :])
    thresholds = state[DIMENSIONS] + np.concatenate([[0.0], np.cumsum(gaps)])
    return OrdinalModel(state[:DIMENSIONS].astype(np.float32), thresholds, grades)


def fit_quality(
    documents: DataFrame,
    ratings: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    rating: str = "quality",
    max_rated: int = MAX_RATED,
) -> OrdinalModel:
    """Fit to at most `max_rated` rated documents, chosen by the hash of their id.

    What reaches the driver are the features of those, no more than `DIMENSIONS` numbers each.
    """
    prepare_workers(documents.sparkSession)
    rated = ratings.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{rating}`").cast("double").alias("rating")
    ).dropna()
    chosen = rated.orderBy(F.xxhash64("id"), "id", "rating").limit(max_rated)
    texts = documents.select(F.col(f"`{id_column}`").alias("id"), whole_text(text).alias("text"))

    def extract(rows: pa.Array) -> pa.Array:
        found = [features(text.as_py()) for text in rows]
        return pa.array(
            [{"index": index, "value": value} for index, value in found],
            type=pa.struct([("index", pa.list_(pa.int32())), ("value", pa.list_(pa.float32()))]),
        )

    extracted = F.arrow_udf(extract, "struct<index:array<int>,value:array<float>>")(F.col("text"))
    rows = texts.join(chosen, "id").select("rating", "id", extracted.alias("f")).collect()
    rows.sort(key=lambda row: (str(row["id"]), row["rating"], row["f"]["index"]))
    vectors = [
        (np.array(row["f"]["index"], np.int64), np.array(row["f"]["value"], np.float64))
        for row in rows
    ]
    return fit_ordinal(vectors, [row["rating"] for row in rows])


@lru_cache(maxsize=2)
def _loaded(payload: bytes) -> OrdinalModel:
    return pickle.loads(payload)


def _graded(documents: DataFrame, model: OrdinalModel, text: str) -> Column:
    """`expected_grade` and `top_probability` as a struct, for a model of two grades or more."""
    shared = bounded_broadcast(documents.sparkSession, pickle.dumps(model))
    grades = [float(grade) for grade in model.grades]

    def grade_batch(texts: pa.Array) -> pa.Array:
        loaded = _loaded(shared.value)
        scores = np.array([loaded.score(text.as_py()) for text in texts])
        tails = loaded.tails(scores)
        expected = grades[0] + tails @ np.diff(grades)
        return pa.StructArray.from_arrays(
            [pa.array(expected), pa.array(tails[:, -1])], ["expected_grade", "top_probability"]
        )

    kind = "struct<expected_grade:double,top_probability:double>"
    return F.arrow_udf(grade_batch, kind)(whole_text(text))


def grade_documents(documents: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """Documents with `expected_grade` and `top_probability`, that of the highest grade."""
    if len(model.grades) < 2:
        only = F.lit(float(model.grades[0]) if model.grades else None).cast("double")
        results = {"expected_grade": only, "top_probability": F.lit(1.0) + only * 0}
        return with_results(documents, results)
    graded = fresh_name(documents, "graded")
    marked = documents.withColumn(graded, _graded(documents, model, text))
    results = {name: F.col(f"{graded}.{name}") for name in ("expected_grade", "top_probability")}
    return with_results(marked, results).drop(graded)


def good_documents(
    documents: DataFrame,
    ratings: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    rating: str = "quality",
    min_probability: float = 0.5,
) -> DataFrame:
    """The documents whose probability of the highest grade is `min_probability` or more.

    Without two grades to tell apart nothing is rejected.
    """
    model = fit_quality(documents, ratings, id_column, text, rating)
    if len(model.grades) < 2:
        return documents
    graded = _graded(documents, model, text)
    return documents.filter(graded["top_probability"] >= min_probability)
