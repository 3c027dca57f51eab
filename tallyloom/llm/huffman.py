"""Token ids in binary files: canonical length-limited Huffman codes from global counts.

A folder holds ``codes.bin`` (the code length of every id), one file for each range of
documents, and ``_MANIFEST.json``, written last. A file is a run of independent blocks: token
count, byte count, a bit offset for every ``EVERY`` tokens, then the bits. Behind the blocks
stand their places, the documents with their token counts, and the length of this tail.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import ranges
from tallyloom.llm.bpe import groups_of
from tallyloom.llm.common import scratch
from tallyloom.llm.files import store, written
from tallyloom.llm.library import forget, library
from tallyloom.session import bounded_batches

MAGIC = b"IDHUFF1\n"
LONGEST = 18  # bits of a code at most, unless there are more ids than such codes
BLOCK = 1 << 16  # tokens of a block
EVERY = 256  # tokens between two checkpoints
BLOCKS_AT_ONCE = 16
TEXT_AT_ONCE = 4 << 20


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits of each id's code, 0 for ids that do not occur, least in sum among codes of at most ``longest``.

    Package-merge: on each level the ids and the pairs of the level before are merged by weight;
    an id gets a bit for each level among whose chosen items it is.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    longest = max(longest, int(len(used) - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64) if counts.sum() > 1 << 58 else counts[order].astype(np.int64)
    levels, packages = [], weights[:0]
    for _ in range(longest):
        merged = np.concatenate([weights, packages])
        by_weight = np.argsort(merged, kind="stable")
        levels.append(by_weight < len(weights))
        merged = merged[by_weight]
        packages = merged[0 : len(merged) - 1 : 2] + merged[1::2]
    chosen = 2 * len(used) - 2
    for own in reversed(levels):
        ids = int(own[:chosen].sum())
        lengths[order[:ids]] += 1
        chosen = 2 * (chosen - ids)
    return lengths


class Codebook:
    """Canonical codes: numbered by length, then by id, so the lengths alone say them all."""

    def __init__(self, lengths: np.ndarray) -> None:
        self.lengths = lengths.astype(np.int64)
        self.width = int(max(lengths.max(initial=0), 1))
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        spans = np.int64(1) << (self.width - self.lengths[order])  # of table entries that begin with the code
        firsts = np.cumsum(spans) - spans
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[order] = firsts >> (self.width - self.lengths[order])
        self.table = np.zeros(1 << self.width, dtype=np.int32)  # id << 5 | bits, by the next ``width`` bits
        self.table[: int(spans.sum())] = np.repeat(order << 5 | self.lengths[order], spans)

    def pack(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """The bit offset of every ``EVERY``-th token, and the bits."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        shifted = self.codes[ids] << (64 - (starts & 31) - sizes).astype(np.uint64)
        word = starts >> 5
        first = np.flatnonzero(np.diff(word, prepend=-1))
        held, at = np.add.reduceat(shifted, first), word[first]  # bits never overlap, so a sum joins them
        words = np.zeros(int(ends[-1] >> 5) + 2, dtype=np.uint64)
        words[at] += held >> np.uint64(32)
        words[at + 1] += held & np.uint64(0xFFFFFFFF)
        return starts[::EVERY].astype("<u4"), words.astype(">u4").tobytes()[: int(ends[-1] + 7) // 8]

    def unpack(self, bits: bytes, offsets: np.ndarray) -> np.ndarray:
        """``EVERY`` ids from each bit offset on, one row each: all rows take a step at a time."""
        data = np.frombuffer(bits + bytes(8), dtype=np.uint8).astype(np.uint32)
        windows = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
        at, last, rest = offsets.astype(np.int32), np.int32(8 * len(bits)), np.uint32(32 - self.width)
        out = np.empty((EVERY, len(at)), dtype=np.int32)
        for step in range(EVERY):
            found = self.table[(windows[at >> 3] << (at & 7).astype(np.uint32)) >> rest]
            np.right_shift(found, 5, out=out[step])
            at += found & 31
            np.minimum(at, last, out=at)
        return out.T


def _tail(doc_ids: list, counts: list[int], places: list[int]) -> bytes:
    null = np.array([one is None for one in doc_ids], dtype=np.uint8)
    ids = np.array([one or 0 for one in doc_ids], dtype="<i8")
    packed = zlib.compress(null.tobytes() + ids.tobytes() + np.array(counts, dtype="<u8").tobytes() + np.array(places, dtype="<u8").tobytes(), 1)
    return packed + struct.pack("<QQQ", len(packed), len(doc_ids), len(places)) + MAGIC


class Shard:
    """One file of ids: its documents, and the ids from any token on."""

    def __init__(self, fs: pa.fs.FileSystem, path: str, book: Codebook) -> None:
        self.file, self.book = fs.open_input_file(path), book
        end = self.file.size()
        packed, documents, blocks = struct.unpack("<QQQ", self._read(end - 32, 24))
        if self._read(end - 8, 8) != MAGIC:
            raise ValueError(f"{path} is not a whole file of ids")
        tail = zlib.decompress(self._read(end - 32 - packed, packed))
        null = np.frombuffer(tail, np.uint8, documents)
        ids = np.frombuffer(tail, "<i8", documents, documents)
        self.doc_ids = [None if gone else one for one, gone in zip(ids.tolist(), null.tolist())]
        self.counts = np.frombuffer(tail, "<u8", documents, 9 * documents).astype(np.int64)
        self.places = [*np.frombuffer(tail, "<u8", blocks, 17 * documents).tolist(), end - 32 - packed]
        self.total = int(self.counts.sum())

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def ids(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from the file's ``first`` token on; only what lies between two checkpoints is decoded in vain."""
        if not count:
            return np.zeros(0, dtype="<u4")
        b, e = first // BLOCK, (first + count - 1) // BLOCK
        held = self._read(self.places[b], self.places[e + 1] - self.places[b])
        bits, offsets, at, base = [], [], 0, 0
        for block in range(b, e + 1):
            tokens, size, check = struct.unpack_from("<III", held, at)
            marks = -(-tokens // EVERY)
            offsets.append(np.frombuffer(held, "<u4", marks, at + 12).astype(np.int64) + 8 * base)
            bits.append(held[at + 12 + 4 * marks : at + 12 + 4 * marks + size])
            if zlib.crc32(bits[-1]) != check:
                raise ValueError(f"block {block} is damaged")
            at, base = at + 12 + 4 * marks + size, base + size
        lanes = slice((first - b * BLOCK) // EVERY, (first + count - 1 - b * BLOCK) // EVERY + 1)
        skip = first - b * BLOCK - lanes.start * EVERY  # full blocks hold a whole number of lanes
        found = self.book.unpack(b"".join(bits), np.concatenate(offsets)[lanes])
        return found.reshape(-1)[skip : skip + count].astype("<u4")


def _index(fs: pa.fs.FileSystem, path: str) -> tuple[list, list[int]]:
    with fs.open_input_stream(path) as source:
        held = json.loads(zlib.decompress(source.read()))
    return held["doc_ids"], held["counts"]


def write(documents: DataFrame, folder: str, tokenizer: str, end_id: int, shards: int, text: str = "text") -> dict:
    """Encode each whole text, append ``end_id``, and write all ids in ascending doc_id order; returns the manifest.

    Cut points of the id ranges are exact (``ranges.cuts`` over text bytes), so equal input and
    settings give equal files. One job shuffles the texts to their range, encodes them once,
    spools plain ids to a scratch folder and counts them; its only result rows are counts by id,
    at most one for each id of the vocabulary on the driver. The next job codes each range; its
    tasks drop the parts that their worker kept for encoding. The session hands texts to Python
    in batches of about ``TEXT_AT_ONCE`` bytes from now on.
    Files get their names by renaming, and readers follow the manifest alone.

    Null texts count as empty and hold the end id alone; a null doc_id comes first; rows of one
    doc_id are ordered by text, repeated rows all stay; other columns are ignored; an empty table
    gives a manifest without files. Texts are never cut; a long one spans blocks.
    """
    spark = documents.sparkSession
    bounded_batches(spark, TEXT_AT_ONCE)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    chosen = ranges.cuts(rows, "doc_id", F.octet_length("text") + 1, shards)
    spool = scratch(spark, "ids")
    placed = ranges.by_shard(rows, "doc_id", chosen, ["doc_id", "text"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library(tokenizer)
        fs, root = store(spool)
        end = np.array([end_id], dtype=coder.kind).tobytes()
        totals, shard, out = np.zeros(max(len(coder.tokens), end_id + 1), dtype=np.int64), None, None

        def close() -> None:
            if shard is not None:
                out.write(packer.flush())
                stream.__exit__(None, None, None)
                with written(fs, f"{root}/documents-{shard:05d}") as index:
                    index.write(zlib.compress(json.dumps({"doc_ids": doc_ids, "counts": counts}).encode(), 1))

        for batch in batches:
            texts, sizes = batch.column(1), (len(one.as_buffer()) for one in batch.column(1))
            for part in groups_of(sizes, TEXT_AT_ONCE):
                packed = coder.texts(texts[part])
                for doc_id, one, own in zip(batch.column(0)[part].to_pylist(), packed, batch.column(2)[part].to_pylist()):
                    if own != shard:
                        close()
                        shard, packer, doc_ids, counts = own, zstandard.ZstdCompressor(level=1).compressobj(), [], []
                        stream = written(fs, f"{root}/ids-{shard:05d}")
                        out = stream.__enter__()
                    doc_ids.append(doc_id)
                    counts.append(len(one) // coder.kind.itemsize + 1)
                    out.write(packer.compress(one + end))
                totals += np.bincount(np.frombuffer(b"".join(packed), dtype=coder.kind), minlength=len(totals))
                totals[end_id] += len(packed)
        close()
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"id": pa.array(seen, pa.int64()), "n": pa.array(totals[seen], pa.int64())})

    fs, path = store(folder)
    fs.create_dir(path, recursive=True)
    spool_fs, spool_path = store(spool)
    spool_fs.create_dir(spool_path, recursive=True)
    found = placed.select("doc_id", "text", "shard").mapInArrow(encode, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in found), default=0) + 1, dtype=np.int64)
    for r in found:
        counts[r.id] = r.n
    lengths = code_lengths(counts)
    with written(fs, f"{path}/codes.bin") as out:
        out.write(zlib.compress(lengths.tobytes()))
    kind = library_kind(tokenizer)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # all texts are encoded
        book, source, target = Codebook(lengths), store(spool), store(folder)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([_coded(shard, book, kind, source, target)], schema=pa.schema(
                    [("shard", pa.int64()), ("tokens", pa.int64()), ("documents", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]))

    number = len(chosen) + 1 if found else 0
    tasks = spark.range(0, max(number, 1), 1, max(number, 1)).filter(F.col("id") < number)
    coded = sorted(tasks.mapInArrow(code, "shard long, tokens long, documents long, bytes long, sha256 string").collect())
    start, listed = 0, []
    for r in coded:
        listed.append({"file": f"part-{r.shard:05d}.ids", "start": start, **{k: r[k] for k in ("tokens", "documents", "bytes", "sha256")}})
        start += r.tokens
    manifest = {"tokens": start, "documents": sum(r.documents for r in coded), "cuts": chosen, "files": listed}
    with written(fs, f"{path}/_MANIFEST.json") as out:
        out.write(json.dumps(manifest).encode())
    spool_fs.delete_dir(spool_path)  # the coded files are complete and named
    return manifest


def library_kind(tokenizer: str) -> np.dtype:
    """Type of the spooled ids; of the vocabulary's size alone."""
    return library(tokenizer).kind


def _coded(shard: int, book: Codebook, kind: np.dtype, source: tuple, target: tuple) -> dict:
    """Read the plain ids of a range and write its coded file."""
    doc_ids, counts = _index(source[0], f"{source[1]}/documents-{shard:05d}")
    sha, places, at = hashlib.sha256(), [], 0

    def put(out, data: bytes) -> int:
        out.write(data)
        sha.update(data)
        return len(data)

    with written(target[0], f"{target[1]}/part-{shard:05d}.ids") as out:
        for ids in _blocks(source[0], f"{source[1]}/ids-{shard:05d}", kind):
            offsets, bits = book.pack(ids)
            places.append(at)
            at += put(out, struct.pack("<III", len(ids), len(bits), zlib.crc32(bits)) + offsets.tobytes() + bits)
        at += put(out, _tail(doc_ids, counts, places))
    return {"shard": shard, "tokens": sum(counts), "documents": len(counts), "bytes": at, "sha256": sha.hexdigest()}


def _blocks(fs: pa.fs.FileSystem, path: str, kind: np.dtype) -> Iterator[np.ndarray]:
    """The spooled ids in blocks."""
    unpacker, held, size = zstandard.ZstdDecompressor().decompressobj(), b"", BLOCK * kind.itemsize
    with fs.open_input_stream(path, compression=None) as source:
        while data := source.read(1 << 18):
            held += unpacker.decompress(data)
            whole = len(held) // size * size
            for at in range(0, whole, size):
                yield np.frombuffer(held, kind, BLOCK, at)
            held = held[whole:]
    if held:
        yield np.frombuffer(held, kind)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document: the tokens before it, and its packed ids (unsigned 32-bit little-endian).

    Files are read by many tasks, a run of blocks at a time; sizes, digests of files and checks
    of blocks are compared with what was written.
    """
    fs, path = store(folder)
    with fs.open_input_stream(f"{path}/_MANIFEST.json") as source:
        listed = json.loads(source.read())["files"]
    with fs.open_input_stream(f"{path}/codes.bin", compression=None) as source:
        lengths = np.frombuffer(zlib.decompress(source.read()), np.uint8)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, root = store(folder)
        book = Codebook(lengths)
        for batch in batches:
            for name, start, size, digest in zip(*(column.to_pylist() for column in batch.columns)):
                with own.open_input_stream(f"{root}/{name}", compression=None) as source:
                    sha, read_bytes = hashlib.sha256(), 0
                    while data := source.read(1 << 20):
                        sha.update(data)
                        read_bytes += len(data)
                if (read_bytes, sha.hexdigest()) != (size, digest):
                    raise ValueError(f"{name} is not the file that its manifest lists")
                yield from _documents(Shard(own, f"{root}/{name}", book), start)

    def _documents(shard: Shard, start: int) -> Iterator[pa.RecordBatch]:
        at = 0
        for some in groups_of(shard.counts.tolist(), BLOCK * BLOCKS_AT_ONCE):
            counts = shard.counts[some]
            ends = np.cumsum(counts)
            total = int(ends[-1]) if len(ends) else 0
            ids = b"".join(shard.ids(k, min(BLOCK * BLOCKS_AT_ONCE, at + total - k)).tobytes() for k in range(at, at + total, BLOCK * BLOCKS_AT_ONCE))
            offsets = np.concatenate([[0], 4 * ends])
            packed = [ids[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids[some], pa.int64()), pa.array(start + at + ends - counts), pa.array(packed, pa.binary())], schema=schema)
            at += total

    number = max(len(listed), 1)
    named = spark.createDataFrame([(k, f["file"], f["start"], f["bytes"], f["sha256"]) for k, f in enumerate(listed)], "k int, file string, start long, bytes long, sha256 string")
    return named.repartitionById(number, F.col("k")).drop("k").mapInArrow(decode, "doc_id long, start long, ids binary")
