import heapq
import json
import os
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import huffman, library, ranges
from tallyloom.llm.queries import op11_huffman_ids

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.encode_special_tokens = True


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_whole_table_equals_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got, start = sorted(map(tuple, op11_huffman_ids(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect())), 0
    assert [row[0] for row in got] == sorted(texts)
    for doc_id, at, n, crc in got:
        ids = ids_of(texts[doc_id])
        assert (at, n, crc) == (start, len(ids), zlib.crc32(packed(ids)))
        start += n


def slow_cost(counts, longest):
    """Least bits in all, by trying how many codes each length has (small alphabets only)."""
    weights = sorted((c for c in counts if c), reverse=True)

    def best(length, free, at, memo):
        if at == len(weights):
            return 0
        if length > longest or len(weights) - at > free << (longest - length):
            return float("inf")
        key = (length, free, at)
        if key not in memo:
            memo[key] = min(
                sum(weights[at : at + k]) * length + best(length + 1, 2 * (free - k), at + k, memo)
                for k in range(min(free, len(weights) - at) + 1)
            )
        return memo[key]

    return best(1, 2, 0, {})


def test_code_lengths_are_the_best_within_the_limit():
    rng = np.random.default_rng(1)
    for longest in (4, 5, 9):
        for _ in range(40):
            counts = rng.geometric(0.02, rng.integers(2, 14)) ** rng.integers(1, 4) * (rng.random() < 0.9)
            counts[0] = 1
            counts = np.append(counts, [0, 7])
            lengths = huffman.code_lengths(counts, longest)
            assert lengths.max() <= longest and ((lengths > 0) == (counts > 0)).all()
            assert sum(2.0 ** -int(n) for n in lengths if n) <= 1
            assert int((counts * lengths).sum()) == slow_cost(counts.tolist(), longest)
    counts = rng.integers(1, 1000, 5000)
    heap = counts.tolist()
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        joined = heapq.heappop(heap) + heapq.heappop(heap)
        cost += joined
        heapq.heappush(heap, joined)
    assert int((counts * huffman.code_lengths(counts, 30)).sum()) == cost
    assert huffman.code_lengths(np.array([0, 5])).tolist() == [0, 1] and not huffman.code_lengths(np.zeros(3, int)).any()


def test_blocks_round_trip_and_read_from_any_token(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(2)
    ids = (rng.pareto(0.6, 200_000) * 3).astype(np.int64) % 40_000
    book = huffman.Codebook(huffman.code_lengths(np.bincount(ids)))
    offsets, bits = book.pack(ids[: huffman.BLOCK])
    assert len(offsets) == huffman.BLOCK // huffman.EVERY
    assert (book.unpack(bits, offsets).reshape(-1) == ids[: huffman.BLOCK]).all()
    one = huffman.Codebook(huffman.code_lengths(np.array([0, 0, 9])))
    offsets, bits = one.pack(np.full(300, 2))
    assert (one.unpack(bits, offsets).reshape(-1)[:300] == 2).all()

    rows = [(k, " ".join(rng.choice(["alpha", "Beta,", "naïve", "漢字", "x\n y"], rng.integers(0, 60)))) for k in range(300)]
    rows.append((150, "long " * 120_000))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = huffman.write(frame, str(tmp_path / "w"), PATH, 0, shards=4)
    everything = [i for _, text in sorted(rows) for i in ids_of(text)]
    assert manifest["tokens"] == len(everything) and len(manifest["files"]) > 1
    fs, root = huffman.store(str(tmp_path / "w"))
    book = huffman.Codebook(np.frombuffer(zlib.decompress(open(tmp_path / "w/codes.bin", "rb").read()), np.uint8))
    for f in manifest["files"]:
        shard = huffman.Shard(fs, f"{root}/{f['file']}", book)
        assert shard.total == f["tokens"]
        for first in {0, f["tokens"] // 3, f["tokens"] - 1, min(huffman.BLOCK - 1, f["tokens"] - 1)}:
            count = min(777, f["tokens"] - first)
            assert shard.ids(first, count).tolist() == everything[f["start"] + first : f["start"] + first + count]
    back = sorted((r.start, bytes(r.ids)) for r in huffman.read(spark, str(tmp_path / "w")).collect())
    assert b"".join(one for _, one in back) == packed(everything)


def test_equal_rows_give_equal_files_whatever_their_partitions(spark, tmp_path):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    wide = documents.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(20)))).withColumn("doc_id", F.col("doc_id") * 50 + F.col("k"))
    wide = wide.withColumn("text", F.substring("text", 1, 60))
    for name, parts in (("a", 3), ("b", 7)):
        huffman.write(wide.repartition(parts), str(tmp_path / name), PATH, 0, shards=5)
    files = sorted(os.listdir(tmp_path / "a"))
    files = [f for f in files if not f.startswith(".")]
    assert len([f for f in files if f.endswith(".ids")]) == 5 and not any("temporary" in f for f in files)
    for f in files:
        assert open(tmp_path / "a" / f, "rb").read() == open(tmp_path / "b" / f, "rb").read()


def test_nulls_empties_repeats_and_clashing_columns(spark, tmp_path):
    rows = [(3, "b"), (3, "a"), (3, "a"), (None, None), (None, "z"), (-5, ""), (2**62, "<|endoftext|>"), (-(2**62), "q")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("old") for n in ("ids", "shard", "start", "k", "weight")})
    huffman.write(frame, str(tmp_path / "w"), PATH, 0, shards=3)
    order = [(None, None), (None, "z"), (-(2**62), "q"), (-5, ""), (3, "a"), (3, "a"), (3, "b"), (2**62, "<|endoftext|>")]
    got = sorted(huffman.read(spark, str(tmp_path / "w")).collect(), key=lambda r: r.start)
    assert [(r.doc_id, bytes(r.ids)) for r in got] == [(d, packed(ids_of(t))) for d, t in order]
    assert got[0].start == 0 and got[1].start == 1
    assert huffman.write(frame.limit(0), str(tmp_path / "e"), PATH, 0, shards=3)["files"] == []
    assert huffman.read(spark, str(tmp_path / "e")).collect() == []


def test_damage_is_found(spark, tmp_path):
    frame = spark.createDataFrame([(k, f"text {k}") for k in range(50)], "doc_id long, text string")
    manifest = huffman.write(frame, str(tmp_path), PATH, 0, shards=1)
    name = tmp_path / manifest["files"][0]["file"]
    data = bytearray(name.read_bytes())
    data[20] ^= 1
    name.write_bytes(bytes(data))
    with pytest.raises(Exception, match="not the file that its manifest lists"):
        huffman.read(spark, str(tmp_path)).collect()
    book = huffman.Codebook(np.frombuffer(zlib.decompress((tmp_path / "codes.bin").read_bytes()), np.uint8))
    fs, root = huffman.store(str(tmp_path))
    with pytest.raises(ValueError, match="damaged"):
        huffman.Shard(fs, f"{root}/{name.name}", book).ids(0, 10)
    assert json.loads((tmp_path / "_MANIFEST.json").read_text()) == manifest


def test_cuts_of_uneven_keys(spark):
    keys = [*range(1000), *[10**15] * 500, *range(-(2**63) + 5, -(2**63) + 300), 2**63 - 1, None]
    frame = spark.createDataFrame([(k,) for k in keys], "key long")
    chosen = ranges.cuts(frame, "key", F.lit(1), 6)
    assert chosen == ranges.cuts(frame.repartition(5), "key", F.lit(1), 6) == sorted(set(chosen)) and 4 <= len(chosen) <= 5
    got = {r.key: r.s for r in frame.select("key", ranges.shard_of("key", chosen).alias("s")).collect()}
    assert got[None] == 0 and all(got[k] == sum(c <= k for c in chosen) for k in keys if k is not None)
    assert ranges.cuts(frame.limit(0), "key", F.lit(1), 6) == []


def test_worker_keeps_no_parts_once_all_is_encoded(spark, tmp_path):
    """Texts reach Python in batches by bytes, and a worker that codes files holds no parts of texts any more."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 64 << 20)
        rows = spark.createDataFrame([(k, f"a{k} b{k} c{k}") for k in range(200)], "doc_id long, text string")
        huffman.write(rows, str(tmp_path / "ids"), PATH, 0, 8)
        assert int(spark.conf.get(name)) == huffman.TEXT_AT_ONCE
    finally:
        spark.conf.set(name, before)
    coder = library.library(PATH)
    text = pa.array(["one two three four"])
    packed = coder.texts(text)
    assert coder.words.kept.now
    library.forget()
    assert library.library(PATH) is coder and not coder.words.kept.now and not coder.words.kept.old
    assert coder.texts(text) == packed


def test_parts_go_to_the_library_in_short_strings(monkeypatch):
    coder, asked = library.Library(PATH), []
    ids = coder.ids
    monkeypatch.setattr(coder, "ids", lambda strings: asked.extend(strings) or ids(strings))
    text = " ".join(f"p{k:x}, é{k}" for k in range(4000))
    assert coder.texts(pa.array([text]))[0] == np.array(ids_of(text)[:-1], dtype=coder.kind).tobytes()
    assert max(one.count(" ") for one in asked) <= 1024


def test_packed_parts_are_not_encoded_again(monkeypatch):
    coder, asked = library.Library(PATH, kept_bytes=400_000), []
    ids = coder.ids
    monkeypatch.setattr(coder, "ids", lambda strings: asked.extend(strings) or ids(strings))
    texts = [" ".join(f"p{k:x}, é{k}" for k in range(at, at + 200)) for at in range(0, 2000, 200)] + ["", "  a  b ", "é", " x\ty  <|endoftext|> z", "q " * 40]
    wanted = [np.array(ids_of(text)[:-1], dtype=coder.kind).tobytes() for text in texts]
    for _ in range(3):
        assert [coder.texts(pa.array([text]))[0] for text in texts] == wanted
        again, asked[:] = sum(one.count(" ") for one in asked), []
    assert again < 100  # of 4,000 parts, more than the dictionary holds
    assert sum(one.nbytes for generation in coder.words.kept.packed for one in generation) <= 400_000
    assert coder.texts(pa.array(texts)) == wanted
    monkeypatch.setattr(library, "PARTS_IN_STRING", 7)
    coder.forget()
    assert coder.texts(pa.array(texts)) == wanted and max(one.count(" ") for one in asked) <= 200


def test_parts_of_equal_hash_are_encoded_again():
    coder = library.Library(PATH)
    text = pa.array(["one two three four two"])
    wanted = coder.texts(text)
    known, starts, sizes, held = coder.words.kept.packed[0]
    coder.words.kept.packed[0] = known, starts[::-1].copy(), sizes[::-1].copy(), held  # hashes now find other parts
    assert coder.texts(text) == wanted
