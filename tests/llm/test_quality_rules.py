import re

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import quality_rules as rules
from tallyloom.llm.common import labelled_sample
from tallyloom.llm.queries import op7_decision_lists

SF = "/root/testdata/sf0.01"


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = (text or "").split("\n")
    duplicates = sum(1 for i, line in enumerate(lines) if line.strip("\t\n\v\f\r ") and line in lines[:i])
    symbols = sum((text or "").count(s) for s in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, duplicates, len(repeated)


def test_whole_table_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sample = labelled_sample(spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/documents.parquet"), "quality", 12_000)
    learnt = rules.fit(sample)
    got = op7_decision_lists(spark, SF).collect()
    assert len(got) == len(texts)
    for row in got:
        text = texts[row.doc_id]
        if len(text or "") < 20_000:
            assert tuple(row[name] for name in rules.COUNTS) == slow_counts(text)
        counts = dict(zip((*rules.COUNTS, *rules.MORE_COUNTS), rules.count_text(text)))
        ratios = {name: counts[a] / max(counts[b], 1) for name, (a, b) in rules.RATIOS.items()}
        fired = [k for k, rule in enumerate(learnt.rules, 1)
                 if all((ratios[c.feature] >= c.threshold) == c.at_least for c in rule.conditions)]
        assert row.fired_rule == (fired[0] if fired else None)
        failed = row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words
        assert (row.base_failed, row.kept) == (failed, not failed and not fired)


def test_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    judged = op7_decision_lists(spark, "/root/testdata/sf0.1").join(labels.filter(held), "doc_id").filter("not base_failed")
    good, bad = (judged.filter(F.col("quality") == q).agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.98 and bad < 0.05


def test_rules_are_pruned_and_ordered():
    rng = np.random.default_rng(1)
    table = {"a": rng.random(3000), "b": rng.random(3000), "noise": rng.random(3000)}
    bad = ((table["a"] > 0.8) & (table["b"] > 0.5)) | (table["a"] < 0.1)
    learnt = rules.learn(table, bad)
    covered = np.any([rule.holds(table) for rule in learnt.rules], axis=0)
    assert (covered == bad).mean() > 0.99 and len(learnt.rules) <= 4
    assert {c.feature for rule in learnt.rules for c in rule.conditions} <= {"a", "b"}
    assert rules.learn(table, np.zeros(3000, bool)).rules == () == rules.learn({"a": np.array([])}, np.array([], bool)).rules


def test_nulls_empties_repeats_and_clashing_columns(spark):
    words = " ".join(f"w{n}" for n in range(60))
    frame = spark.createDataFrame([(1, None), (2, ""), (3, words), (3, words), (None, "a b\na b\n \n \n")], "doc_id long, text string")
    frame = frame.withColumns({name: F.lit("x") for name in ("n_words", "kept", "fired_rule")})
    nothing = rules.DecisionList(())
    got = [(r.doc_id, r.n_words, r.n_dup_lines, r.base_failed, r.kept) for r in rules.judge(frame, nothing).collect()]
    assert got == [(1, 0, 0, True, False), (2, 0, 0, True, False), *[(3, 60, 0, False, True)] * 2, (None, 4, 1, True, False)]
    assert rules.judge(frame.limit(0), nothing).collect() == []


def test_every_kind_and_every_boundary_counts():
    rng = np.random.default_rng(2)
    table = {f"f{k:02}": rng.random(12_000) for k in range(20)}
    bad = np.any([values > 0.98 for values in table.values()], axis=0)
    learnt = rules.learn(table, bad)
    assert {c.feature for rule in learnt.rules for c in rule.conditions} == set(table) and len(learnt.rules) > 12
    tail = {"x": rng.permutation(12_000).astype(float)}
    learnt = rules.learn(tail, tail["x"] >= 11_961)
    assert [c.threshold for c in learnt.rules[0].conditions] and abs(learnt.rules[0].conditions[0].threshold - 11_961) < 4
