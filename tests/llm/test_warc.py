import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import queries, warc
from twins import duck_rows, duck_types, spark_rows, spark_types

SF = "/root/testdata/sf0.01"


def test_query_equals_its_twin(spark, duck):
    frame, sql = queries.op6_warc(spark, SF), queries.SQL["op6_warc"]
    assert spark_rows(frame) == duck_rows(duck("sf0.01"), sql)
    assert spark_types(frame) == duck_types(duck("sf0.01"), sql)


def folder_bytes(folder):
    return {name: hashlib.sha256(open(f"{folder}/{name}", "rb").read()).hexdigest() for name in os.listdir(folder)}


def test_round_trip_rolls_files_and_repeats_its_bytes(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for name in ("a", "b"):
        warc.write(pages.repartition(3 if name == "a" else 5), str(tmp_path / name), shards=3, roll_bytes=60_000)
    files = folder_bytes(tmp_path / "a")
    assert files == folder_bytes(tmp_path / "b")
    parts = [name for name in files if name.endswith(".warc.gz")]
    assert len(parts) > 3 and not any("temporary" in name for name in files)
    assert all(os.path.getsize(tmp_path / "a" / name) <= 60_000 for name in parts)
    got = {r.page_id: bytes(r.payload) for r in warc.read(spark, str(tmp_path / "a")).filter("payload is not null").collect()}
    wanted = {r.page_id: (r.html or "").encode() for r in pages.collect()}
    assert got and all(wanted[page] == payload for page, payload in got.items())


def test_a_large_table_gives_the_same_files_each_time(spark, tmp_path):
    """More rows than a range sample holds, twice from one plan and once from other partitions."""
    pages = spark.range(25_000).select((F.col("id") * 7919 % 1_000_003).alias("page_id"), F.concat(F.lit("u"), "id").alias("url"),
                                       F.repeat(F.sha1(F.col("id").cast("string")), (F.col("id") % 40).cast("int")).alias("html"))
    for name, frame in (("a", pages), ("b", pages), ("c", pages.repartition(7))):
        assert warc.write(frame, str(tmp_path / name), shards=8)["records"] == 25_000
    files = folder_bytes(tmp_path / "a")
    assert files == folder_bytes(tmp_path / "b") == folder_bytes(tmp_path / "c")
    sizes = [os.path.getsize(tmp_path / "a" / name) for name in files if name.endswith(".warc.gz")]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_leftovers_go_and_changed_files_are_found(spark, tmp_path):
    frame = spark.createDataFrame([(k, "u", f"text {k}") for k in range(20)], "page_id long, url string, html string")
    (tmp_path / "_temporary-00000-00000-0-dead").write_bytes(b"half")
    warc.write(frame, str(tmp_path), shards=1)
    assert not any("temporary" in name for name in os.listdir(tmp_path))
    name = tmp_path / "part-00000-00000.warc.gz"
    data = bytearray(name.read_bytes())
    data[4] ^= 1  # the time in the first member's header, which gunzip ignores
    name.write_bytes(bytes(data))
    with pytest.raises(Exception, match="not the file that its manifest lists"):
        warc.read(spark, str(tmp_path)).collect()


def test_a_very_long_page_comes_back_whole(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "ü" * 5_000_000), (2, "u", "short")], "page_id long, url string, html string")
    warc.write(frame, str(tmp_path), shards=2)
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, str(tmp_path)).collect()}
    assert got == {1: "ü" * 5_000_000, 2: "short"}


def test_nulls_repeats_and_clashing_columns(spark, tmp_path):
    big = "x" * 1000
    rows = [(1, "u", big), (2, None, big), (2, None, big), (3, "a b\r\nc", None), (4, "", ""), (None, "u", big), (None, "v", "y" * 2000), (5, "w", "x" * 999), (6, "w", "x" * 999)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame = frame.withColumns({n: F.lit(1) for n in ("digest", "payload", "page", "refers_to", "shard", "key", "weight")})
    assert warc.write(frame, str(tmp_path / "w"), shards=2)["records"] == 9
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in warc.read(spark, str(tmp_path / "w")).collect())
    assert got == [(0, 1000, "revisit", 2), (0, 2000, "response", 0), (1, 1000, "revisit", 2), (2, 1000, "response", 0), (2, 1000, "response", 0),
                   (3, 0, "response", 0), (4, 0, "response", 0), (5, 999, "response", 0), (6, 999, "response", 0)]
    assert warc.write(frame.limit(0), str(tmp_path / "e"), shards=2)["records"] == 0
    assert warc.read(spark, str(tmp_path / "e")).collect() == []


def test_damage_is_found(spark, tmp_path):
    good = warc.record(7, "u", b"abc", hashlib.sha1(b"abc").hexdigest(), None)
    assert warc.parse(good)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse(good.replace(b"abc", b"abd"))
