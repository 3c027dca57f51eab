"""Quality: neighbours among labelled latent-semantic vectors vote, weighted by similarity."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD, stored

WORDS = re.compile(WORD)
LOWER, UPPER, DIGITS = re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"[0-9]+")
CACHED = 200_000
TEXTS_AT_ONCE = 256


def shape(word: str) -> str:
    """The word with runs of small letters, capitals and digits written as a, A and 0, at most 12 characters."""
    return DIGITS.sub("0", UPPER.sub("A", LOWER.sub("a", word)))[:12]


class Terms:
    """Terms of a text and their counts: word shapes, pairs of them, short words, and repetition."""

    def __init__(self) -> None:
        self.shapes: dict[str, str] = {}

    def of(self, text: str) -> Counter:
        words = WORDS.findall(text)
        known = self.shapes
        if len(known) > CACHED:
            known.clear()
        for word in set(words).difference(known):
            known[word] = shape(word)
        shapes = [known[word] for word in words]
        counts = Counter(shapes)
        counts.update([f"{a} {b}" for a, b in zip(shapes, shapes[1:])])
        counts["same word again"] = sum(map(str.__eq__, words, words[1:]))
        triples = Counter(zip(words, words[1:], words[2:]))
        counts["same triple again"] = sum(triples.values()) - len(triples)
        lines = text.split("\n")
        counts["same line again"] = 5 * (len(lines) - len(set(lines)))
        counts["word seen before"] = len(words) - len(set(words))
        counts["line"] = len(lines)
        return +counts


@dataclass
class Space:
    """Latent-semantic space of a bounded labelled sample, with its vectors and labels."""

    place: dict[str, int]
    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float
    terms: Terms = field(default_factory=Terms, repr=False)

    def project(self, counted: list[dict[str, int]]) -> np.ndarray:
        """Unit vectors of term counts; zero where nothing is known."""
        matrix = np.zeros((len(counted), len(self.weight)), dtype=np.float32)
        for row, counts in enumerate(counted):
            total = sum(counts.values()) or 1
            for term, count in counts.items():
                column = self.place.get(term)
                if column is not None:
                    matrix[row, column] = np.sqrt(count / total)
        return _unit((matrix * self.weight) @ self.axes)

    def vote(self, texts: list[str]) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, by similarity; the prior share where none is similar."""
        vectors = self.project([self.terms.of(text) for text in texts])
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        if not len(self.labels):
            return np.full(len(texts), prior)
        products = vectors @ self.vectors.T
        few = min(self.neighbours, len(self.labels))
        near = np.argpartition(-products, few - 1, axis=1)[:, :few]
        weights = np.clip(np.take_along_axis(products, near, axis=1), 0, None).astype(float) ** self.power
        total = weights.sum(axis=1)
        votes = (weights * self.labels[near]).sum(axis=1)
        return np.clip(np.where(total > 0, votes / np.where(total > 0, total, 1), prior), 0, 1)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return (rows / np.where(length > 0, length, 1)).astype(np.float32)


def build(counted: list[dict[str, int]], labels: np.ndarray, vocabulary: dict[str, int], dimensions: int, neighbours: int, power: float) -> Space:
    """Weighted counts, their leading axes, and the projected labelled rows; ``vocabulary`` gives document counts."""
    place = {term: k for k, term in enumerate(sorted(vocabulary))}
    documents = np.array([vocabulary[term] for term in sorted(vocabulary)], dtype=float)
    weight = (np.log((1 + len(counted)) / (1 + documents)) + 1).astype(np.float32)
    space = Space(place, weight, np.eye(len(place), dtype=np.float32), np.zeros((0, 0)), labels.astype(float), neighbours, power)
    if not len(counted) or not place:
        space.labels = np.zeros(0)
        return space
    gram = np.zeros((len(place), len(place)))
    for at in range(0, len(counted), 1024):  # rows are scaled to unit length before the axes are sought
        part = space.project(counted[at : at + 1024]).astype(float)
        gram += part.T @ part
    values, axes = np.linalg.eigh(gram)
    space.axes = axes[:, ::-1][:, :dimensions].astype(np.float32)
    space.vectors = np.concatenate([space.project(counted[at : at + 1024]) for at in range(0, len(counted), 1024)])
    return space


def fit(sample: DataFrame, most_terms: int = 1024, dimensions: int = 64, neighbours: int = 15, power: float = 8.0) -> Space:
    """Space from (doc_id, text, y); the sample must be bounded, see ``common.labelled_sample``.

    Executors count terms; Spark picks the ``most_terms`` that occur in most documents of either
    label; counts of those alone reach the driver, which finds the axes.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for batch in batches:
            counts = [list(terms.of(text).items()) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "terms": [[{"term": t, "n": n} for t, n in one] for one in counts]})

    rows = sample.select("doc_id", F.col("y").cast("int").alias("y"), "text")
    counted = stored(rows.mapInPandas(count, "doc_id long, y int, terms array<struct<term:string,n:long>>"), "quality-terms")
    each = counted.select("doc_id", "y", F.explode("terms").alias("t")).select("doc_id", "y", "t.term", "t.n")
    by_label = each.groupBy("term").agg(F.count(F.lit(1)).alias("docs"), F.sum(1 - F.col("y")).alias("bad"))
    order = [F.desc(F.greatest("bad", F.col("docs") - F.col("bad"))), F.col("term")]
    half = most_terms // 2
    good_terms = by_label.orderBy(F.desc(F.col("docs") - F.col("bad")), "term").limit(half)
    bad_terms = by_label.orderBy(F.desc("bad"), "term").limit(half)
    picked = {r.term: r.docs for r in good_terms.union(bad_terms).orderBy(*order).collect()}
    names = F.array(*map(F.lit, sorted(picked))) if picked else F.array().cast("array<string>")
    slim = counted.select("doc_id", "y", F.filter("terms", lambda t: F.array_contains(names, t["term"])).alias("terms"),
                          F.aggregate("terms", F.lit(0).cast("long"), lambda total, t: total + t["n"]).alias("total"))
    rows = sorted((r.doc_id, r.y, r.total, [(t.term, t.n) for t in r.terms]) for r in slim.toLocalIterator())
    counts = [dict(terms) | {"": total - sum(n for _, n in terms)} for _, _, total, terms in rows]
    return build(counts, np.array([y for _, y, _, _ in rows]), picked, dimensions, neighbours, power)


def score(documents: DataFrame, space: Space, column: str = "score", text: str = "text") -> DataFrame:
    """Add ``column``: the similarity-weighted share of good neighbours of the whole text, 0 to 1.

    Every text is compared with all labelled vectors, in blocks. Null and empty texts count as
    one empty line and get what its neighbours say. All columns and repeated rows pass unchanged, save one of that name,
    which is replaced; an empty table gives none. Among neighbours of equal similarity at the edge of the vote any may count. The broadcast holds the bounded sample's vectors: a few MB.
    """
    shared = documents.sparkSession.sparkContext.broadcast(space)

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in batches:
            texts = [one or "" for one in batch]
            votes = [model.vote(texts[at : at + TEXTS_AT_ONCE]) for at in range(0, len(texts), TEXTS_AT_ONCE)]
            yield pd.Series(np.concatenate(votes) if votes else np.zeros(0))

    return documents.withColumn(column, rate(F.col(text)))


def predicted(score_column: Column, threshold: float = 0.3) -> Column:
    return (score_column >= threshold).cast("int")
