import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import queries, topk
from twins import duck_rows, duck_types, spark_rows, spark_types

SF = "/root/testdata/sf0.01"


def test_query_equals_its_twin(spark, duck):
    frame = queries.op5_exact_top_k(spark, SF)
    sql = queries.SQL["op5_exact_top_k"]
    assert spark_rows(frame) == duck_rows(duck("sf0.01"), sql)
    assert spark_types(frame) == duck_types(duck("sf0.01"), sql)


def plain(rows, asked, k):
    out = []
    for q, v in rows.items():
        if q in asked:
            scores = sorted((-int(np.dot(v, w)), c) for c, w in rows.items() if c != q)[:k]
            out += [(q, rank, c, -score) for rank, (score, c) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("nodes", [1, 2, 3])
def test_ties_copies_and_negative_scores(spark, nodes):
    rng = np.random.default_rng(nodes)
    rows = {n: rng.integers(-2, 3, size=6).tolist() for n in range(150)}
    rows |= {n: [1, 1, 0, 0, -1, -1] for n in range(150, 220)} | {n: [-3] * 6 for n in range(220, 225)}
    frame = spark.createDataFrame(list(rows.items()), "vec_id long, v array<long>")
    asked = {n for n in rows if n % 7 == 0} | {221}
    got = topk.top_k(frame.union(frame.limit(9)), frame.filter(F.col("vec_id").isin(*asked)), k=5, nodes=nodes)
    assert sorted(map(tuple, got.collect())) == plain(rows, asked, 5)


def test_unusable_vectors_few_vectors_and_empty_tables(spark):
    rows = [(0, [0.5, 1.0]), (20, [float("nan"), 1.0]), (40, None), (60, [None, 1.0]), (80, [float("inf"), 0.0]),
            (None, [1.0, 1.0]), (1, [-0.01, 1.0]), (2, [])]
    frame = topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)))
    got = topk.top_k(frame, frame.filter("vec_id % 20 = 0"), k=20)
    assert list(map(tuple, got.collect())) == [(0, 1, 1, 32 * -1 + 64 * 64)]
    assert topk.top_k(frame.limit(0), frame.limit(0)).collect() == []
