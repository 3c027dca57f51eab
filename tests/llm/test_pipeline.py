import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyloom.llm import bpe, mixing, queries, toxicity
from tallyloom.llm.common import labelled_sample, stored

SF = "/root/testdata/sf0.01"
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


def test_each_stage_against_a_plain_version(spark):
    from test_simhash import slow_components, slow_print

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    frames = {"start": documents}
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = stored(stage(spark, list(frames.values())[-1], SF), f"test-{name}")
    rows = {name: frame.collect() for name, frame in frames.items()}
    for name in list(frames)[:-1]:
        assert frames[name].columns == documents.columns

    sample = labelled_sample(spark.read.parquet(f"{SF}/labels.parquet"), documents, "toxic", queries.MOST_LABELLED)
    model = toxicity.fit(sample)
    assert {r.doc_id for r in rows["toxicity"]} == {r.doc_id for r in rows["start"] if model.logit(r.text or "") < 0}
    assert len(rows["toxicity"]) < len(rows["start"])

    prints = {r.doc_id: slow_print(r.text) for r in rows["toxicity"]}
    groups = slow_components(prints, 3)
    assert sorted(r.doc_id for r in rows["simhash_near_dedup"]) == sorted(set(groups.values()))

    texts = {r.doc_id: r.text for r in rows["simhash_near_dedup"]}
    assert sorted(r.doc_id for r in rows["pii_surrogates"]) == sorted(texts)
    mail = re.compile(r"[\w.+-]+@[\w.-]+\.[a-z]+")
    for r in rows["pii_surrogates"]:
        old, new = mail.findall(texts[r.doc_id]), mail.findall(r.text)
        assert len(old) == len(new) and not set(old) & set(new) and r.n_chars == len(r.text)

    counts = mixing.drawn_counts(frames["pii_surrogates"], queries.mix_domain(), queries.MIX_WEIGHTS, queries.mix_budget(), queries.MIX_EPOCHS, queries.MIX_SEED)
    assert Counter(r.doc_id for r in rows["mixing"]) == Counter({r.doc_id: r.copies for r in counts.collect() if r.copies})

    mixed = {r.doc_id: r.text for r in rows["mixing"]}
    assert len(rows["byte_bpe"]) == len(rows["mixing"])
    for r in rows["byte_bpe"]:
        assert np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode_ordinary(mixed[r.doc_id])


def test_run_on_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "a b", "en", "s1", 3), (1, "", "en", "s1", 0), (1, "x y z w", "en", "s1", 7), (2, "x y z w", None, "s2", 7)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and got.count() >= 1


def test_an_empty_table_and_a_very_long_text(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choices("abcdeiouü", k=rng.randint(2, 9))) for _ in range(40_000)) for _ in range(5)]
    many = [(k, text, "de", "s1", len(text)) for k, text in enumerate([*texts, "kurz"])]
    for name, rows in (("none", []), ("long", many)):
        folder = tmp_path / name
        spark.createDataFrame(rows, schema).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.run(spark, str(folder)).collect()}
        assert all(got[doc_id] == LIBRARY.encode_ordinary(text) for doc_id, text, *_ in rows if doc_id in got)
        assert not rows and not got or len(got) >= 3 and set(got) <= set(range(6))


def test_a_wrong_round_trip_stops_the_run(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "gute Wörter", "de", "s1", 11), (None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    good = corpus_pipeline.tokenise(spark, docs, SF).collect()
    assert sorted(r.n_tokens for r in good) == sorted([0, len(LIBRARY.encode_ordinary("gute Wörter"))])
    encode = bpe.encode
    monkeypatch.setattr(bpe, "encode", lambda *args, **more: encode(*args, **more).withColumn("intact", F.lit(False)))
    with pytest.raises(Exception, match="decoded ids differ from the text of document"):
        corpus_pipeline.tokenise(spark, docs, SF).collect()
