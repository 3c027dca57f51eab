import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import quality_neighbours as quality
from tallyloom.llm import queries


def test_whole_table_and_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op2_quality_neighbours(spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    joined = got.filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("predicted", "quality", "score").collect()
    good, bad = [r for r in joined if r.quality], [r for r in joined if not r.quality]
    assert all(0 <= r.score <= 1 for r in joined)
    assert sum(r.predicted for r in good) > 0.98 * len(good)
    assert sum(r.predicted for r in bad) < 0.05 * len(bad)


def test_votes_equal_a_plain_loop_over_all_labelled_vectors():
    rng = np.random.default_rng(4)
    words = ["Aa", "word.", "x%%%", "LOUD!!", "12", "mixed9"]
    texts = [" ".join(rng.choice(words, size=rng.integers(1, 30))) for _ in range(700)]
    terms = quality.Terms()
    counted, labels = [dict(terms.of(t)) for t in texts[:400]], rng.integers(0, 2, 400)
    vocabulary = {t: sum(t in c for c in counted) for t in {t for c in counted for t in c}}
    space = quality.build(counted, labels, vocabulary, 8, 5, 2.0)
    votes = space.vote(texts)
    for text, vote in list(zip(texts, votes))[390:430]:
        vector = space.project([terms.of(text)])[0].astype(float)
        cosines = sorted(((float(vector @ v), k) for k, v in enumerate(space.vectors)), reverse=True)
        fifth = cosines[4][0]
        near = [(c, k) for c, k in cosines if c > fifth - 1e-6]
        lows = sorted(labels[k] for c, k in near if c < fifth + 1e-6)  # ties: any of the equal ones may vote
        sure = [(c, k) for c, k in near if c >= fifth + 1e-6]
        low, high = ([*(labels[k] for _, k in sure), *part] for part in (lows[: 5 - len(sure)], lows[::-1][: 5 - len(sure)]))
        weights = [max(c, 0) ** 2 for c, _ in sure] + [fifth**2] * (5 - len(sure))
        assert np.average(low, weights=weights) - 1e-4 <= vote <= np.average(high, weights=weights) + 1e-4


def test_nulls_empties_repeats_and_clashing_columns(spark):
    sample = spark.createDataFrame([(n, "good words here " * 3 if n % 2 else "BAD!! BAD!! BAD!!", n % 2) for n in range(20)], "doc_id long, text string, y int")
    space = quality.fit(sample, neighbours=3)
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "fine words there"), (3, "fine words there"), (None, "SAD!! SAD!!")], "doc_id long, text string")
    frame = frame.withColumns({"score": F.lit("old"), "terms": F.lit(1)})
    got = quality.score(frame, space)
    assert got.columns == frame.columns
    scores = [r.score for r in got.collect()]
    assert scores[0] == scores[1] and 0 <= scores[0] <= 1
    assert scores[2] == scores[3] > 0.9 and scores[4] < 0.1
    assert quality.score(frame.limit(0), space).collect() == []
    nothing = quality.fit(sample.limit(0))
    assert [r.score for r in quality.score(frame, nothing).collect()] == [0.5] * 5
