"""Toxicity: a linear classifier whose score may not depend on which group a sentence names."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stored

TOKEN = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*")
PREFIXES = range(3, 9)
CACHED = 200_000

# Terms that name groups, in sets whose members may take each other's place.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender", "nonbinary"),
    ("gay", "straight", "lesbian", "bisexual", "queer", "heterosexual", "homosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "catholic", "protestant", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "catholics", "protestants", "atheists"),
    ("black", "white", "asian", "latino", "hispanic", "arab", "african", "european"),
    ("american", "mexican", "chinese", "indian", "russian", "german", "french", "turkish", "polish", "nigerian"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("old", "young", "elderly", "teenage"),
    ("blind", "deaf", "disabled", "autistic"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
    ("muslime", "christen", "juden"),
    ("musulmans", "chrétiens", "juifs"),
    ("musulmanes", "cristianos", "judíos"),
)


def features_of(word: str) -> tuple[str, ...]:
    """The word itself and its beginnings (marked by a trailing asterisk)."""
    return (word, *(word[:n] + "*" for n in PREFIXES if n <= len(word)))


def features(text: str) -> set[str]:
    return {feature for word in set(TOKEN.findall(text.lower())) for feature in features_of(word)}


def swapped(text: str, groups: tuple[tuple[str, ...], ...]) -> list[str]:
    """Counterfactual texts: in every sentence that names a group, each term becomes another of its set.

    One text for each place by which the sets are turned, so a lone term meets all others of its
    set. No term, no text.
    """
    turns = range(1, max(map(len, groups), default=1))
    turned = {t: [others[(k + step) % len(others)] for step in turns] for others in groups for k, t in enumerate(others)}
    if not any(word in turned for word in set(TOKEN.findall(text.lower()))):
        return []

    def sentence(found: re.Match, step: int) -> str:
        return TOKEN.sub(lambda m: turned[m[0].lower()][step] if m[0].lower() in turned else m[0], found[0])

    made = dict.fromkeys(SENTENCE.sub(lambda m, step=step: sentence(m, step), text) for step in range(len(turns)))
    return [other for other in made if other.lower() != text.lower()]


@dataclass
class Model:
    """Weights of selected features, and the bias."""

    weights: dict[str, float]
    bias: float
    _seen: dict[str, tuple[tuple[str, float], ...]] = field(default_factory=dict, repr=False)

    def logit(self, text: str) -> float:
        """Sum over the distinct selected features of a whole text."""
        seen, weights, found = self._seen, self.weights, {}
        if len(seen) > CACHED:
            seen.clear()
        for word in set(TOKEN.findall(text.lower())):
            held = seen.get(word)
            if held is None:
                held = seen[word] = tuple((f, weights[f]) for f in features_of(word) if f in weights)
            if held:
                found.update(held)
        return self.bias + sum(found.values())

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "bias": self.bias, "_seen": {}}


def train(
    rows: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]], size: int,
    balance: float = 2.0, l2: float = 1e-4, steps: int = 400, rate: float = 0.1,
) -> tuple[np.ndarray, float]:
    """Logistic loss + l2 + ``balance`` * mean squared change of the logit under swaps, by Adam."""

    def sparse(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray, int]:
        return np.repeat(np.arange(len(lists)), [len(r) for r in lists]), np.array([c for r in lists for c in r], dtype=int), len(lists)

    def times(matrix: tuple, weights: np.ndarray) -> np.ndarray:
        return np.bincount(matrix[0], weights[matrix[1]], minlength=matrix[2])

    def back(matrix: tuple, residual: np.ndarray) -> np.ndarray:
        return np.bincount(matrix[1], residual[matrix[0]], minlength=size)

    x, left, right = sparse(rows), sparse([a for a, _ in pairs]), sparse([b for _, b in pairs])
    weights, bias = np.zeros(size), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    theta = np.append(weights, bias)
    mean, square = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        weights, bias = theta[:-1], theta[-1]
        residual = (1 / (1 + np.exp(-(times(x, weights) + bias))) - y) / len(y)
        gradient = back(x, residual) + l2 * weights
        if pairs:
            change = 2 * balance * (times(left, weights) - times(right, weights)) / len(pairs)
            gradient += back(left, change) - back(right, change)
        full = np.append(gradient, residual.sum())
        mean = 0.9 * mean + 0.1 * full
        square = 0.999 * square + 0.001 * full * full
        theta = theta - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(sample: DataFrame, groups: tuple = IDENTITY_TERMS, most_features: int = 1024, balance: float = 2.0) -> Model:
    """Model from (doc_id, text, y); the sample must be bounded, see ``common.labelled_sample``.

    Spark counts each feature by label and picks the ``most_features`` whose share differs most
    in standard errors; terms of the groups and their beginnings are picked as well, if they
    occur. Only the picked features of the bounded sample reach the driver.
    """

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, y in zip(batch["doc_id"], batch["text"], batch["y"]):
                texts = [text, *swapped(text, groups)]
                out += [(doc_id, y, copy, sorted(features(one))) for copy, one in enumerate(texts)]
            yield pd.DataFrame(out, columns=["doc_id", "y", "copy", "features"])

    rows = sample.select("doc_id", "text", F.col("y").cast("int").alias("y"))
    made = stored(rows.mapInPandas(extract, "doc_id long, y int, copy int, features array<string>"), "toxic-features")
    n, positive = made.filter("copy = 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not positive or positive == n:
        return Model({}, 20.0 if n and positive == n else -20.0)
    counts = made.filter("copy = 0").select("y", F.explode("features").alias("feature")).groupBy("feature")
    counts = counts.agg(F.count(F.lit(1)).alias("docs"), F.sum("y").alias("toxic")).filter("docs >= 3")
    share = positive / n
    gap = (F.col("toxic") - share * F.col("docs")) / F.sqrt(share * (1 - share) * F.col("docs"))
    picked = {r.feature for r in counts.orderBy(F.desc(F.abs(gap)), "feature").limit(most_features).select("feature").collect()}
    picked |= {f for others in groups for term in others for f in features_of(term)}
    place = {feature: k for k, feature in enumerate(sorted(picked))}
    kept = made.select("doc_id", "y", "copy", F.array_intersect("features", F.array(*map(F.lit, sorted(place)))).alias("features"))
    rows = sorted(((r.doc_id, r.copy, r.y, [place[f] for f in r.features]) for r in kept.toLocalIterator()))
    own = {doc: own for doc, copy, _, own in rows if not copy}
    pairs = [(own[doc], other) for doc, copy, _, other in rows if copy]
    y = np.array([label for _, copy, label, _ in rows if not copy], dtype=float)
    weights, bias = train([own for _, copy, _, own in rows if not copy], y, pairs, len(place), balance)
    return Model({f: float(weights[k]) for f, k in place.items() if abs(weights[k]) > 1e-6}, bias)


def score(documents: DataFrame, model: Model, column: str = "score", text: str = "text") -> DataFrame:
    """Add ``column``: the probability that the whole text is toxic.

    Null and empty texts have no features; their score is that of the bias. All columns and
    repeated rows pass unchanged, save one of that name, which is replaced; an empty table gives none. The model has a
    bounded number of weights and travels with the function.
    """

    @F.pandas_udf("double")
    def rate(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            logits = np.array([model.logit(one or "") for one in batch], dtype=float)
            yield pd.Series(1 / (1 + np.exp(-logits)))

    return documents.withColumn(column, rate(F.col(text)))


def predicted(score_column: Column, threshold: float = 0.5) -> Column:
    return (score_column >= threshold).cast("int")
