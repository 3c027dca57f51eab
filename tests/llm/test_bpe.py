import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from tallyloom.llm import bpe, words
from tallyloom.llm.queries import op8_byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_kept_values_stay_bounded_and_right():
    kept, asked = words.Kept(4_000), []

    def make(keys):
        asked.extend(keys)
        return [key.upper() for key in keys]

    rng = random.Random(1)
    for _ in range(200):
        lists = [["often", *(str(rng.randint(0, 500)) for _ in range(3))], []]
        assert kept.values(lists, make) == [[key.upper() for key in keys] for keys in lists]
        assert len(kept.now) + len(kept.old) < 40
    assert asked.count("often") == 1


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_whole_table_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for row in op8_byte_bpe(spark, "/root/testdata/sf0.01").collect():
        ids = LIBRARY.encode_ordinary(texts[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()


def test_odd_characters_and_cut_points():
    encoder, rng = bpe.Encoder(RANKS, PATTERN), random.Random(3)
    alphabet = " \n\t\r\x1c\x1f\x85　  ab'sedt1!é漢😀́\0"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(5000)]
    assert [ids_of(p) for p in encoder.texts(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_long_pieces():
    encoder, rng = bpe.Encoder(RANKS, PATTERN), random.Random(4)
    texts = ["a" * 5000, " " * 3000, "漢" * 999, "".join(rng.choices("etaoin", k=4000)), *("x" * n for n in range(60, 70))]
    assert [ids_of(p) for p in encoder.texts(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_both_trees_agree_with_a_plain_scan():
    merges, rng = bpe.Merges(RANKS), random.Random(5)

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while True:
            ranked = [(RANKS[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in RANKS]
            if not ranked:
                return [RANKS[p] for p in parts]
            k = min(ranked)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    pieces = [bytes(rng.choices(b"aetin the", k=rng.randint(2, 32))) for _ in range(300)]
    assert [ids_of(line) for line in bpe.merge_side_by_side(pieces, 32, merges)] == [plain(p) for p in pieces]
    assert [bpe.merge_one(p, merges) for p in pieces] == [plain(p) for p in pieces]


def test_nulls_empties_repeats_and_clashing_columns(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "z")], "doc_id long, text string")
    frame = frame.withColumns({"ids": F.lit("old"), "decoded": F.lit(1), "extra": F.lit(None).cast("int")})
    tokens = bpe.decode(spark, bpe.encode(spark, frame, PATH, PATTERN), PATH)
    assert tokens.columns == ["doc_id", "extra", "ids", "decoded"]
    got = [(r.doc_id, ids_of(r.ids), bytes(r.decoded)) for r in tokens.collect()]
    once = bpe.encode(spark, frame, PATH, PATTERN, decoded="decoded", intact="intact")
    assert once.columns == ["doc_id", "extra", "ids", "decoded", "intact"]
    assert [(r.doc_id, ids_of(r.ids), bytes(r.decoded)) for r in once.collect()] == got
    assert all(r.intact for r in once.collect())
    assert got == [(1, [], b""), (2, [], b""), *[(3, LIBRARY.encode_ordinary("a b"), b"a b")] * 2,
                   (None, LIBRARY.encode_ordinary("z"), b"z")]
    assert bpe.encode(spark, frame.limit(0), PATH, PATTERN).collect() == []


def test_work_of_an_encoder_is_bounded(spark, monkeypatch):
    """Batches by bytes, new parts and merges in bounded lots, and no piece that is a whole part kept twice."""
    texts = [" ".join(f"{k:x}q{j}, zq{j}{k:x}" for j in range(300)) for k in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    asked, sizes, merge = [], [], bpe.merge_side_by_side
    monkeypatch.setattr(bpe, "merge_side_by_side", lambda some, width, merges: sizes.append(len(some) * width) or merge(some, width, merges))
    encoder = bpe.Encoder(RANKS, PATTERN)
    parts = encoder._parts
    encoder.words.encode = lambda strings: asked.append(len(strings)) or parts(strings)
    assert [ids_of(p) for p in encoder.texts(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]
    assert sum(asked) > words.MADE_AT_ONCE >= max(asked) and max(sizes) <= bpe.CELLS_AT_ONCE
    whole = encoder._parts([" zebraqx", " zebraqy,"])
    assert [ids_of(p) for p in whole] == [LIBRARY.encode_ordinary(" zebraqx"), LIBRARY.encode_ordinary(" zebraqy,")]
    assert " zebraqx" not in encoder.known.now and " zebraqy" in encoder.known.now

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 64 << 20)
        monkeypatch.setattr(bpe, "BYTES_AT_ONCE", 1 << 15)
        got = bpe.encode(spark, rows, PATH, PATTERN)
        assert int(spark.conf.get(name)) == 1 << 15
        seen = rows.mapInArrow(lambda batches: (b.select(["doc_id"]).slice(0, 1) for b in batches), "doc_id long").count()
        assert 3 <= seen < len(texts)
        assert {r.doc_id: ids_of(r.ids) for r in got.collect()} == dict(enumerate(map(LIBRARY.encode_ordinary, texts)))
        spark.conf.set(name, "1k")
        bpe.encode(spark, rows, PATH, PATTERN)
        assert spark.conf.get(name) == "1k"
    finally:
        spark.conf.set(name, before)
