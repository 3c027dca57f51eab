import random

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import queries, toxicity
from tallyloom.llm.common import labelled_sample


def test_whole_table_against_a_plain_sum(spark):
    """Each score is the logistic of the bias and the weights of the text's features, summed one by one."""
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(labelled_sample(spark.read.parquet(f"{folder}/labels.parquet"), documents, "toxic", queries.MOST_LABELLED))
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    got = {r.doc_id: r for r in queries.op1_toxicity(spark, folder).collect()}
    assert got.keys() == texts.keys() and model.weights
    for doc_id, text in texts.items():
        logit = model.bias + sum(model.weights.get(feature, 0.0) for feature in sorted(toxicity.features(text)))
        assert abs(got[doc_id].score - 1 / (1 + np.exp(-logit))) < 1e-9
        assert got[doc_id].predicted == int(got[doc_id].score >= 0.5)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op1_toxicity(spark, folder)
    joined = got.filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("predicted", "toxic").collect()
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    toxic, clean = [r for r in joined if r.toxic], [r for r in joined if not r.toxic]
    assert sum(r.predicted for r in toxic) > 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) < 0.01 * len(clean)


def biased_rows():
    """Insults make a text toxic; toxic texts often name one group as well."""
    rng, rows = random.Random(2), []
    filler = [f"word{n}x" for n in range(60)]
    for n in range(400):
        toxic = n % 2
        words = rng.choices(filler, k=8) + (["vilething"] if toxic and rng.random() < 0.7 else [])
        if rng.random() < (0.8 if toxic else 0.05):
            words.append("muslim")
        rng.shuffle(words)
        rows.append((n, " ".join(words) + ".", toxic))
    return rows


def test_neutral_mentions_score_lower_with_the_penalty(spark):
    sample = spark.createDataFrame(biased_rows(), "doc_id long, text string, y int")
    plain, fair = toxicity.fit(sample, balance=0.0), toxicity.fit(sample, balance=20.0)
    neutral, other = "word1x word2x muslim word3x", "word1x word2x catholic word3x"
    assert plain.logit(neutral) - plain.logit(other) > 2
    assert abs(fair.logit(neutral) - fair.logit(other)) < 0.6
    assert fair.logit("word1x vilething word2x") > fair.logit(neutral) + 2


def test_swaps_stay_inside_sentences_that_name_a_group():
    made = toxicity.swapped("The women sang. A stone fell.", toxicity.IDENTITY_TERMS)
    assert made == ["The men sang. A stone fell.", "The girls sang. A stone fell.", "The boys sang. A stone fell."]
    assert toxicity.swapped("A stone fell. womenfolk", toxicity.IDENTITY_TERMS) == []


def test_gradient_equals_differences():
    rows, y, pairs = [[0, 1], [1], [2], []], np.array([1.0, 0, 1, 0]), [([0], [2]), ([1, 2], [0])]
    few, bias = toxicity.train(rows, y, pairs, 3, steps=4000, rate=0.02, balance=0.5, l2=0.01)

    def loss(theta):
        z = np.array([sum(theta[c] for c in r) + theta[3] for r in rows])
        d = np.array([sum(theta[c] for c in a) - sum(theta[c] for c in b) for a, b in pairs])
        return np.mean(np.log1p(np.exp(z)) - y * z) + 0.005 * (theta[:3] ** 2).sum() + 0.5 * (d**2).mean()

    best = np.append(few, bias)
    for k in range(4):
        for step in (0.05, -0.05):
            moved = best.copy()
            moved[k] += step
            assert loss(moved) >= loss(best) - 1e-6


def test_nulls_empties_repeats_and_clashing_columns(spark):
    model = toxicity.Model({"bad": 4.0, "bad*": 1.0}, -2.0)
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "BAD day, bad."), (3, "BAD day, bad."), (None, "fine")], "doc_id long, text string")
    frame = frame.withColumns({"score": F.lit("old"), "features": F.lit(1)})
    got = toxicity.score(frame, model)
    assert got.columns == frame.columns
    assert [round(r.score, 4) for r in got.collect()] == [0.1192, 0.1192, 0.9526, 0.9526, 0.1192]
    assert toxicity.score(frame.limit(0), model).collect() == []
    none = spark.createDataFrame([], "doc_id long, text string, y int")
    assert toxicity.fit(none).bias == -20.0
