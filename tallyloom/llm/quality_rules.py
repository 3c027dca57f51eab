"""Quality rules: ordered decision lists learnt by sequential covering."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import WORD

WORDS = re.compile(WORD)
SYMBOLS = re.compile(r"[#*$%&|<>]")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE_COUNTS = ("n_chars_all", "n_lines", "n_upper", "n_digits", "n_punct", "n_same_next", "n_distinct", "n_long_words")
PUNCTUATION = re.compile(r"[!?.,;:]")
UPPER, DIGIT = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[0-9]")

# Ratios the conditions are learnt on; each divides by a count that is at least one.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "same_next_share": ("n_same_next", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "upper_share": ("n_upper", "n_chars_all"),
    "digit_share": ("n_digits", "n_chars_all"),
    "punct_per_word": ("n_punct", "n_words"),
    "long_word_share": ("n_long_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def count_text(text: str | None) -> tuple[int, ...]:
    """COUNTS and MORE_COUNTS of one whole text; a null text counts as empty."""
    text = text or ""
    words = WORDS.findall(text)
    n = len(words)
    first: dict[tuple[str, str, str], int] = {}
    repeated = np.zeros(n, dtype=bool)
    for at, window in enumerate(zip(words, words[1:], words[2:])):
        before = first.setdefault(window, at)
        if before != at:
            repeated[before : before + 3] = True
            repeated[at : at + 3] = True
    lines, seen, duplicates = text.split("\n"), set(), 0
    for line in lines:
        if line in seen:
            duplicates += WORDS.search(line) is not None
        else:
            seen.add(line)
    return (
        n,
        sum(map(len, words)),
        len(SYMBOLS.findall(text)),
        duplicates,
        int(repeated.sum()),
        len(text),
        len(lines),
        len(UPPER.findall(text)),
        len(DIGIT.findall(text)),
        len(PUNCTUATION.findall(text)),
        sum(map(str.__eq__, words, words[1:])),
        len(set(words)),
        sum(len(word) > 20 for word in words),
    )


def with_counts(documents: DataFrame) -> DataFrame:
    """(doc_id, COUNTS, MORE_COUNTS as longs) of every row; other columns are left out."""
    names = (*COUNTS, *MORE_COUNTS)
    schema = "doc_id long, " + ", ".join(f"{name} long" for name in names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counted = pd.DataFrame([count_text(text) for text in batch["text"]], columns=names, dtype="int64")
            counted.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield counted

    return documents.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)


def with_ratios(counted: DataFrame) -> DataFrame:
    return counted.withColumns({
        name: F.col(above) / F.greatest(F.col(below), F.lit(1)) for name, (above, below) in RATIOS.items()
    })


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values >= self.threshold if self.at_least else values < self.threshold

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold


@dataclass(frozen=True)
class Rule:
    """Every condition holds: the text is of low quality."""

    conditions: tuple[Condition, ...]

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(table.values()))), dtype=bool)
        for condition in self.conditions:
            out &= condition.holds(table[condition.feature])
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for condition in self.conditions:
            out = out & condition.column()
        return out

    def __str__(self) -> str:
        return " and ".join(f"{c.feature} {'>=' if c.at_least else '<'} {c.threshold:.6g}" for c in self.conditions)


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first that holds rejects, a text that none covers is kept."""

    rules: tuple[Rule, ...]

    def fired(self) -> Column:
        """Number of the first rule that holds, from 1, or null: one ordered conditional expression."""
        if not self.rules:
            return F.lit(None).cast("int")
        chain = F.when(self.rules[0].column(), F.lit(1))
        for number, rule in enumerate(self.rules[1:], start=2):
            chain = chain.when(rule.column(), F.lit(number))
        return chain


def _best_condition(table: dict[str, np.ndarray], bad: np.ndarray, covered: np.ndarray) -> tuple[float, Condition | None]:
    """Condition with the greatest information gain over the rows a rule covers so far."""
    best, found = 0.0, None
    y = bad[covered]
    p0, n0 = y.sum(), (~y).sum()
    base = np.log2(p0 / (p0 + n0))
    for feature, values in table.items():
        seen = values[covered]
        order = np.argsort(seen, kind="stable")
        ranked, hits = seen[order], np.cumsum(y[order])
        edges = np.flatnonzero(ranked[1:] > ranked[:-1]) + 1
        for at_least in (True, False):
            p = (p0 - hits[edges - 1]) if at_least else hits[edges - 1]
            total = (len(y) - edges) if at_least else edges
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / total) - base), -1.0)
            if len(gain) and gain.max() > best + 1e-9:
                k = edges[gain.argmax()]
                best, found = gain.max(), Condition(feature, at_least, float((ranked[k - 1] + ranked[k]) / 2))
    return best, found


def learn(table: dict[str, np.ndarray], bad: np.ndarray, least_precision: float = 0.9, least_covered: int = 3) -> DecisionList:
    """Sequential covering: grow a conjunction on two thirds of the rows, prune it on the rest.

    Growing adds the condition of greatest information gain until no good row is covered.
    Pruning drops the last conditions as long as (p - n) / (p + n) on the pruning rows does
    not fall. A rule stays if it is precise enough on the pruning rows; what it covers then
    leaves the table and the next rule is grown, until fewer than ``least_covered`` bad rows are
    left to grow from or a rule covers no pruning row. Every boundary between two values is
    tried; neither rules nor conditions are counted. Rows with missing values take part as zeros.
    """
    size, rules = len(bad), []
    if not size or bad.all() or not bad.any():
        return DecisionList(())
    table = {name: np.nan_to_num(np.asarray(values, dtype=float)) for name, values in table.items()}
    growing = np.arange(size) % 3 != 0
    left = np.ones(size, dtype=bool)
    while (bad & left & growing).sum() >= least_covered:
        covered, conditions = left & growing, []
        while (~bad & covered).any():
            _, condition = _best_condition(table, bad, covered)
            if condition is None:
                break
            same = (condition.feature, condition.at_least)  # a tighter bound takes the place of a looser one
            conditions = [c for c in conditions if (c.feature, c.at_least) != same] + [condition]
            covered &= condition.holds(table[condition.feature])
        if not conditions:
            break

        def worth(some: list[Condition]) -> tuple[float, int, int]:
            held = Rule(tuple(some)).holds(table) & left & ~growing
            p, n = int((held & bad).sum()), int((held & ~bad).sum())
            return ((p - n) / (p + n) if p + n else -1.0), p, n

        kept = conditions
        for length in range(len(conditions) - 1, 0, -1):
            if worth(conditions[:length])[0] >= worth(kept)[0]:
                kept = conditions[:length]
        _, p, n = worth(kept)
        rule = Rule(tuple(kept))
        left &= ~rule.holds(table)
        if p >= least_covered and p >= least_precision * (p + n):
            rules.append(rule)
        elif not (p + n):
            break
    return DecisionList(tuple(rules))


def fit(sample: DataFrame) -> DecisionList:
    """Decision list from (doc_id, text, y), y = 0 being low quality; one row of ratios a text reaches the driver.

    The sample must be bounded: see ``common.labelled_sample``.
    """
    names = list(RATIOS)
    counted = with_ratios(with_counts(sample)).select("doc_id", *names).join(sample.select("doc_id", "y"), "doc_id")
    rows = counted.toPandas().sort_values("doc_id", kind="stable")
    order = np.random.default_rng(7).permutation(len(rows))
    bad = rows["y"].to_numpy()[order] == 0
    return learn({name: rows[name].to_numpy()[order] for name in names}, bad)


def judge(documents: DataFrame, rules: DecisionList) -> DataFrame:
    """One row per document: doc_id, the five counts, base_failed, fired_rule, kept.

    A null or empty text has no words, so its base fails. Repeated rows and null ids are judged
    like any others; other columns are left out; an empty table gives an empty result. Ties do
    not occur: the first rule in order decides.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = with_ratios(with_counts(documents)).withColumns({"base_failed": failed, "fired_rule": rules.fired()})
    return judged.select("doc_id", *COUNTS, "base_failed", "fired_rule",
                         (~F.col("base_failed") & F.col("fired_rule").isNull()).alias("kept"))
