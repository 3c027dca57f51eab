"""Suffix-array dedup: bytes covered by strings that also start earlier, by external induced sorting."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import batches_of, stored
from tallyloom.llm.induced import sorted_suffixes

GRAM = 20  # bytes of the hashed pieces that anchors are chosen from
BYTES_AT_ONCE = 1 << 20
SHARD_BYTES = 4 << 20
QUEUE_BYTES = 64 << 20
LATEST = (1 << 63) - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return (x ^ (x >> np.uint64(29))) * _ODD


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    n = len(data) - GRAM + 1
    wide = np.concatenate((data, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    for step in (1, 2, 4):  # words of 2, 4, 8 bytes
        wide = wide[:-step] | wide[step:] << np.uint64(8 * step)
    return _mixed(_mixed(_mixed(wide[:n]) + wide[8 : 8 + n]) + (wide[16 : 16 + n] & np.uint64(0xFFFFFFFF)))


def segments(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first start, number of starts, anchor hash, content hash) of runs of windows with one anchor.

    A window is ``length`` bytes within one text; texts follow each other in ``data`` up to
    ``ends``. Its anchor is the leftmost piece of least hash inside, so equal windows have equal
    anchors at equal places.
    """
    hashes = gram_hashes(data)
    place = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << 24) - 1)
    key = (hashes & ~low) | place
    width, size = length - GRAM + 1, 1
    while 2 * size <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    rest = width - size
    key = np.minimum(key[: len(key) - rest], key[rest:])
    starts = np.arange(len(key))
    text = np.searchsorted(ends, starts, side="right")
    valid = np.flatnonzero(starts + length <= ends[np.minimum(text, len(ends) - 1)])
    if not len(valid):
        return (np.zeros(0, np.int64),) * 4
    anchor = (key[valid] & low).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1))))
    first, count = valid[new], np.diff(np.append(new, len(valid)))
    power = np.multiply.accumulate(np.full(len(hashes) + 1, _ODD)) * _BACK
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(hashes) * power[:-1], dtype=np.uint64)))
    back = np.multiply.accumulate(np.full(len(hashes) + 1, _BACK)) * _ODD
    content = _mixed((total[first + count + length - GRAM] - total[first]) * back[first])
    return first, count, hashes[anchor[new]].view(np.int64), content.view(np.int64)


def _in_blocks(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Cut texts into blocks of bounded size: (bytes, ends, text numbers, offset of each part).

    Parts of a long text overlap by ``length`` - 1 bytes, so every window is in one part.
    """
    held, size = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), BYTES_AT_ONCE):
            part = text[at : at + BYTES_AT_ONCE + length - 1]
            if len(part) < length:
                continue
            held.append((part, number, at))
            size += len(part)
            if size >= BYTES_AT_ONCE:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(part for part, _, _ in held), dtype=np.uint8)
    return data, np.cumsum([len(part) for part, _, _ in held]), np.array([n for _, n, _ in held]), np.array([a for _, _, a in held])


SEGMENT = "id long, mark long, first long, count int, anchor long, content long"


def all_segments(texts: DataFrame, length: int) -> DataFrame:
    names = [part.split()[0] for part in SEGMENT.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for data, ends, number, offset in _in_blocks([t or b"" for t in batch.column(2).to_pylist()], length):
                first, count, anchor, content = segments(data, ends, length)
                part = np.searchsorted(ends, first, side="right")
                begin = np.concatenate(([0], ends[:-1]))[part]
                row = number[part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a) for a in (ids[row], marks[row], first - begin + offset[part], count.astype(np.int32), anchor, content)], names=names)

    return texts.select("id", "mark", "body").mapInArrow(cut, SEGMENT)


def covered_windows(strings: list[bytes], keys: list[tuple[int, int, int]], length: int, memory: int) -> Iterator[tuple[int, int, int, int]]:
    """(id, mark, from, to): bytes of later windows, as runs, among strings that start at ``keys``.

    Neighbours in suffix order whose common prefix reaches ``length`` are equal windows; of each
    such class the least (id, mark, start) stays.
    """
    sizes = np.array([len(s) for s in strings])
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    owner = np.array(keys, dtype=np.int64)
    positions, classes, opened = [], [], 0
    for position, prefix in sorted_suffixes(strings, length, memory):
        number = opened + np.cumsum(prefix < length)
        opened = int(number[-1])
        string = np.searchsorted(begin, position, side="right") - 1
        whole = position + length <= begin[string] + sizes[string]  # too short for a window: between classes, never inside one
        positions.append(position[whole])
        classes.append(number[whole])
    position, number = np.concatenate(positions), np.concatenate(classes)
    shared = np.bincount(number, minlength=opened + 1)[number] > 1 if len(number) else np.zeros(0, dtype=bool)
    position, number = position[shared], number[shared]
    if not len(position):
        return
    string = np.searchsorted(begin, position, side="right") - 1
    key = np.stack((owner[string, 0], owner[string, 1], owner[string, 2] + position - begin[string]))
    order = np.lexsort((key[2], key[1], key[0], number))
    position, number, key = position[order], number[order], key[:, order]
    first = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
    best = key[:, np.repeat(first, np.diff(np.append(first, len(number))))]
    later = position[(key != best).any(axis=0)]
    if not len(later):
        return
    marked = np.sort(later)
    new = np.concatenate(([True], marked[1:] != marked[:-1] + 1))
    runs = np.flatnonzero(new)
    last = np.append(runs[1:], len(marked)) - 1
    for a, b in zip(marked[runs].tolist(), marked[last].tolist()):
        string = int(np.searchsorted(begin, a, side="right")) - 1
        low = int(owner[string, 2] + a - begin[string])
        yield int(owner[string, 0]), int(owner[string, 1]), low, low + b - a + length


def removed_runs(texts: DataFrame, length: int, queue_bytes: int = QUEUE_BYTES) -> DataFrame:
    """(id, mark, low, high): byte ranges to remove, perhaps overlapping; see ``remove_repeats``."""
    own = F.struct("id", "mark", "first")
    of_anchor = Window.partitionBy("anchor")
    found = all_segments(texts, length).withColumns({
        "mixed": F.min("content").over(of_anchor) != F.max("content").over(of_anchor),
        "earliest": F.min(own).over(Window.partitionBy("anchor", "content")),
        "n": F.count(F.lit(1)).over(of_anchor),
    })
    found = stored(found.filter("n > 1").withColumn("copy", F.col("earliest") != own).filter("copy or mixed").drop("earliest", "n"), "segments")
    copies = found.filter("copy").select("id", "mark", F.col("first").alias("low"), (F.col("first") + F.col("count") + length - 1).alias("high"))

    wanted = found.filter("not copy").groupBy("id", "mark").agg(F.collect_list(F.struct("first", "count", "anchor")).alias("parts"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("mark", pa.int64()), ("first", pa.int64()), ("part", pa.binary())])

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for k in range(batch.num_rows):
                    key, mark, body, parts = (batch.column(c)[k].as_py() for c in range(4))
                    for part in parts:
                        at = part["first"]
                        yield part["anchor"], key, mark, at, body[at : at + part["count"] + length - 1]

        yield from batches_of(rows(), schema)

    bodies = texts.join(wanted, ["id", "mark"]).select("id", "mark", "body", "parts")
    parts = bodies.mapInArrow(take, "anchor long, id long, mark long, first long, part binary")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups of one anchor stay together; groups fill a shard up to SHARD_BYTES, a larger group is a shard of its own."""
        schema = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])

        def rows() -> Iterator[tuple]:
            strings, keys, size, last = [], [], 0, None
            for batch in batches:
                for anchor, key, mark, first, part in zip(*(column.to_pylist() for column in batch.columns)):
                    if anchor != last and size >= SHARD_BYTES:
                        yield from covered_windows(strings, keys, length, queue_bytes)
                        strings, keys, size = [], [], 0
                    last = anchor
                    strings.append(part)
                    keys.append((key, mark, first))
                    size += len(part)
            if strings:
                yield from covered_windows(strings, keys, length, queue_bytes)

        yield from batches_of(rows(), schema)

    shards = parts.repartition("anchor").sortWithinPartitions("anchor")
    return copies.union(shards.mapInArrow(sort, "id long, mark long, low long, high long"))


def _spans(low: list[int], high: list[int]) -> list[tuple[int, int]]:
    """Union of byte ranges as maximal runs, in order."""
    out: list[list[int]] = []
    for a, b in sorted(zip(low, high)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def keyed(documents: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, id, mark, body): rows without an id come last; rows of one id are ordered by a hash of the text."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LATEST)).alias("id"),
                            F.xxhash64(body).alias("mark"), body.alias("body"))


def remove_repeats(documents: DataFrame, length: int = 100, queue_bytes: int = QUEUE_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, spans, kept (the remaining bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document
    of smaller doc_id, or in the same one. Strings are judged on the input and never cross
    documents. Null texts are empty. Documents without an id count as the last ones; rows of one
    doc_id with other texts are ordered by a hash of the text, and rows that repeat id and text
    are one document whose result each of them gets. Other columns are ignored; an empty table
    gives an empty result.

    Windows go to shards by their anchor (see ``segments``), so equal windows meet. A segment
    that repeats another as a whole is settled by its hashes before text is moved; what is left
    of a shard is ordered by external induced sorting.
    """
    texts = keyed(documents)
    runs = removed_runs(texts.select("id", "mark", "body"), length, queue_bytes)
    gathered = runs.groupBy("id", "mark").agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))
    rows = texts.join(stored(gathered, "runs"), ["id", "mark"], "left").select("doc_id", "body", "low", "high")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, body, low, high in zip(*(column.to_pylist() for column in batch.columns)):
                spans = _spans(low or [], high or [])
                edges = [0, *(edge for span in spans for edge in span), len(body)]
                kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append({"doc_id": doc_id, "n_bytes": len(body), "n_removed": len(body) - len(kept), "n_spans": len(spans),
                            "spans": [{"low": a, "high": b} for a, b in spans], "kept": kept})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                ("spans", pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))), ("kept", pa.binary())]))

    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<low:long,high:long>>, kept binary")


def digest(kept: Column) -> Column:
    return F.sha2(kept, 256)
