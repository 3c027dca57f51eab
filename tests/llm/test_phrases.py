import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from twins import duck_rows, duck_types, spark_rows, spark_types

from tallyloom.llm import phrases
from tallyloom.llm.common import stored
from tallyloom.llm.queries import SQL, op12_collocations
from tallyloom.session import shared_folder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_collocations(rows, least, longest=5, top=2000, absorbed=100):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts.update((lang, *words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    frequent = {key: n for key, n in counts.items() if len(key) > 2 and n >= least}
    found = {}
    for (lang, *words), a in frequent.items():
        longer = [n for (other, *more), n in frequent.items() if other == lang and len(more) > len(words)
                  and any(more[i : i + len(words)] == words for i in range(len(more)))]
        if any(100 * n >= absorbed * a for n in longer):
            continue
        scored = [(1000 * a * totals[lang] // (counts[lang, *words[:k]] * counts[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(scored)
        found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, *words[:k]], counts[lang, *words[k:]]))
    return sorted((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
                  for lang, own in found.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:top], 1))


def invented(rng, n):
    words = ["The", "the", "of", "naïve", "Äpfel", "x y", "a\x1fb", "new", "york", "city", "très", "漢字"]
    marks = [" ", "  ", "\t", ". ", ", ", "\n", "!\r\n", " "]
    return "".join(rng.choice(words) + rng.choice(marks) for _ in range(n)) + "New York city of the " * rng.randint(0, 2)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    made = [(rng.choice(["en", "de", "und", None]), invented(rng, rng.randint(0, 60))) for _ in range(250)]
    return made + [("en", None), ("en", ""), (None, "same words here. " * 9), ("de", "Der Hund der Hund der Hund " * 400)]


def as_frame(spark, rows):
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    return frame.withColumns({name: F.lit("old") for name in ("ids", "phrase", "n", "word", "row", "id", "part")})


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_query_equals_its_twin(spark, duck):
    frame = op12_collocations(spark, "/root/testdata/sf0.01")
    names, found = spark_rows(frame)
    assert (names, found) == duck_rows(duck("sf0.01"), SQL["op12_collocations"]) and len(found) > 50
    assert spark_types(frame) == duck_types(duck("sf0.01"), SQL["op12_collocations"])


@pytest.mark.parametrize("least, absorbed", [(3, 100), (12, 60)])
def test_against_a_plain_count(spark, rows, least, absorbed):
    wanted = slow_collocations(rows, least, absorbed=absorbed)
    assert any(len(row[2].split(" ")) == 5 for row in wanted)
    frame = as_frame(spark, rows)
    assert got(phrases.collocations(frame, least=least, absorbed=absorbed)) == wanted


def test_joined_words_and_many_tries_give_the_same(spark, rows, monkeypatch):
    frame = as_frame(spark, rows)
    monkeypatch.setattr(phrases, "POSITIONS_AT_ONCE", 500)
    monkeypatch.setattr(phrases, "COUNTED_AT_ONCE", 20)
    assert got(phrases.collocations(frame, least=5, top=40, most_words=3, most_phrases=25)) == slow_collocations(rows, 5, top=40)


def test_empty_tables_and_no_phrase(spark, rows):
    frame = as_frame(spark, rows)
    assert got(phrases.collocations(frame.limit(0), least=1)) == []
    assert got(phrases.collocations(frame, least=10**6)) == []
    assert phrases.collocations(frame, least=10**6).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_trie_counts_every_phrase():
    rng = np.random.default_rng(4)
    words = 60
    ids = rng.integers(0, words + 1, 40_000)
    made = {tuple(ids[i : i + k].tolist()) for k in (1, 2, 3, 4) for i in rng.integers(0, len(ids) - 4, 1500)}
    made = sorted(one for one in made if 0 not in one) + [(1, 59, 59, 59, 59)]
    trie = phrases.DoubleArray(made, words + 1)
    totals = np.zeros(len(trie.check), dtype=np.int64)
    for _, state in trie.levels(ids, 5):
        totals += np.bincount(state, minlength=len(totals))
    plain = Counter(tuple(ids[i : i + k].tolist()) for k in range(1, 6) for i in range(len(ids) - k + 1))
    accepted = {trie.phrases[trie.accepts[s] - 1]: int(totals[s]) for s in np.flatnonzero(trie.accepts)}
    assert accepted == {one: plain[one] for one in made}


def test_candidates_leave_out_only_what_is_rare(spark, rows):
    texts = as_frame(spark, rows).select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    vocabulary = phrases._numbered(phrases.word_counts(texts, 10).filter("word is not null"))
    ids = stored(phrases.encoded(texts, vocabulary.select("lang", "word", "id")), "test-ids")
    named = {tuple(r.phrase) for r in phrases._candidates(ids, None, True, 2, 10).collect()}
    frequent = phrases.frequent_phrases(ids, vocabulary.count(), 10)
    assert {tuple(r.phrase) for r in frequent[0].collect()} <= named


def test_pairs_travel_in_few_packed_rows_and_add_up(spark):
    rng = np.random.default_rng(7)
    text = " ".join(f"w{k}" for k in rng.integers(0, 300, 1000))
    frame = spark.createDataFrame([("en", text)] * 400, "lang string, text string").coalesce(1)
    vocabulary = phrases._numbered(phrases.word_counts(frame, 400).filter("word is not null"))
    ids = stored(phrases.encoded(frame, vocabulary.select("lang", "word", "id")), "test-packed")
    assert 4 * 300_000 > ids.agg(F.max(F.octet_length("ids"))).first()[0]  # a batch of rows stays small
    words = text.split(" ")
    wanted = {pair: 400 * n for pair, n in Counter(zip(words, words[1:])).items()}
    spelt = {r.id: r.word for r in vocabulary.collect()}
    named = phrases._candidates(ids, None, True, 2, 800, buckets=3)
    assert {tuple(spelt[k] for k in r.phrase) for r in named.collect()} == {pair for pair, n in wanted.items() if n >= 800}
    assert named.rdd.getNumPartitions() == 3
    found = phrases.frequent_phrases(ids, len(spelt), 800, longest=2)[0]
    assert {tuple(spelt[k] for k in r.phrase): r.n for r in found.collect()} == {pair: n for pair, n in wanted.items() if n >= 800}


def test_texts_and_buckets_write_no_files(spark, rows, monkeypatch):
    monkeypatch.setattr(phrases, "BUCKET_POSITIONS", 50)  # many buckets
    folder = Path(shared_folder(spark).removeprefix("file:"))
    earlier, held = set(folder.rglob("part-*")), spark.sparkContext._jsc.getPersistentRDDs().size()
    assert got(phrases.collocations(as_frame(spark, rows), least=3)) == slow_collocations(rows, 3)
    written = Counter(path.parent.name.rpartition("-")[0] for path in set(folder.rglob("part-*")) - earlier)
    assert not written.keys() - {"llm-totals", "llm-vocabulary", "llm-phrases"} and written["llm-totals"] == 1
    assert written["llm-phrases"] == 4 and written["llm-vocabulary"] <= 16
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held


def test_packed_numbers_come_back():
    keys, counts = np.array([3, 1 << 32, (1 << 62) + 5]), np.array([1, 1 << 40, 7])
    back = phrases._restored(phrases._pressed(np.diff(keys, prepend=0), counts), 2)
    assert np.cumsum(back[0]).tolist() == keys.tolist() and back[1].tolist() == counts.tolist()
    both, sums = phrases._added([keys, keys[1:]], [counts, counts[1:]])
    assert both.tolist() == keys.tolist() and sums.tolist() == [1, 2 << 40, 14]
