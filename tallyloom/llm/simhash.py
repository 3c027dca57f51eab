"""Near-duplicates by SimHash: pivot distance tables discard pairs, verification settles the rest."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import binary_column, stored
from tallyloom.llm.components import components

SEED = 42
ROWS_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words_each: int) -> int:
    """64 majority bits over the hashes of all word shingles, as an unsigned number.

    ``bytes.lower`` touches A-Z alone and ``bytes.split`` splits at ASCII white space alone.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    each = min(words_each, len(words))
    spans = zip(starts[: len(words) - each + 1].tolist(), ends[each - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), ROWS_AT_ONCE):
        part = hashes[at : at + ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, words_each: int = 3) -> DataFrame:
    """(doc_id, bits long): the fingerprint of every whole text, its bits read as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text, words_each) for text in binary_column(batch, "text")]
            bits = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), bits], names=["doc_id", "bits"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(compute, "doc_id long, bits long")


def reference_fingerprints(count: int) -> np.ndarray:
    """The pivots: fixed pseudo-random 64-bit words."""
    return np.random.default_rng(SEED).integers(0, 1 << 64, size=count, dtype=np.uint64)


def masks(distance: int) -> list[int]:
    """Bit masks of which two fingerprints within ``distance`` bits agree on at least one.

    The word is cut into twice as many blocks as differing bits allowed; at least half of them
    are untouched, and each mask covers one choice of half the blocks: 32 bits or so.
    """
    blocks = max(2, 2 * distance)
    cuts = [round(64 * k / blocks) for k in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(block[k] for k in chosen) for chosen in combinations(range(blocks), blocks - distance)]


class _Forest:
    """Union-find over row numbers, with labels that can be compared as arrays."""

    def __init__(self, size: int) -> None:
        self.parent = np.arange(size)

    def join(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        parent, joined = self.parent, []
        for a, b in zip(left.tolist(), right.tolist()):
            x, y = a, b
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            while parent[y] != y:
                parent[y] = y = parent[parent[y]]
            if x != y:
                parent[max(x, y)] = min(x, y)
                joined.append((a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                return joined
            parent[:] = up


def forest_edges(group: np.ndarray, bits: np.ndarray, pivots: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Row pairs that span the links inside each group; rows come sorted by group.

    Row i meets row i + s for growing s, as long as both are of one group and not yet known to
    be connected. The triangle inequality on the pivot table discards a pair as soon as one
    coordinate differs by more than ``distance``; the Hamming distance of the others is verified.
    """
    table = np.stack([np.bitwise_count(bits ^ pivot) for pivot in pivots]).astype(np.int16)
    forest, found, shift = _Forest(len(bits)), [], 1
    rows = np.arange(len(bits))
    while True:
        rows = rows[rows + shift < len(bits)]
        rows = rows[group[rows] == group[rows + shift]]
        if not len(rows):
            return found
        left = rows[forest.parent[rows] != forest.parent[rows + shift]]
        for coordinate in table:
            if not len(left):
                break
            left = left[np.abs(coordinate[left] - coordinate[left + shift]) <= distance]
        left = left[np.bitwise_count(bits[left] ^ bits[left + shift]) <= distance]
        if len(left):
            found += forest.join(left, left + shift)
        shift += 1


def links(classes: DataFrame, distance: int = 3, pivots: int = 24, most_rows: int = 20_000) -> DataFrame:
    """(u, v): edges that connect exactly what chains of links connect, over distinct ``bits``.

    Each fingerprint goes to one group for each mask. A group with more than ``most_rows`` rows
    is cut into chunks, and every pair of chunks is a group of its own: no task gets an unbounded
    group, and no pair is left out.
    """
    wanted = masks(distance)
    places = F.array(*[F.struct(F.lit(k).alias("mask"), F.col("bits").bitwiseAND(_signed(m)).alias("part"))
                       for k, m in enumerate(wanted)])
    placed = classes.select("bits", F.explode(places).alias("p")).select("bits", "p.mask", "p.part")
    crowded = placed.groupBy("mask", "part").count().filter(F.col("count") > most_rows)
    crowded = crowded.select("mask", "part", F.ceil(2 * F.col("count") / most_rows).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("bits"), F.col("chunks")).cast("int")
    partners = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda other: F.least(chunk, other) * F.col("chunks") + F.greatest(chunk, other),
    )
    pair = F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(partners)
    dealt = placed.join(crowded, ["mask", "part"], "left").select("bits", "mask", "part", F.explode(pair).alias("pair"))
    reference = reference_fingerprints(pivots)

    def connect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of the last, perhaps unfinished group
        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)], axis=1)
            whole = np.concatenate([*held, rows]) if held else rows
            last = np.flatnonzero((whole[1:, 1:] != whole[:-1, 1:]).any(axis=1))
            end = last[-1] + 1 if len(last) else 0
            held = [whole[end:]]
            yield from emit(whole[:end])
        if held:
            yield from emit(held[0])

    def emit(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        group = np.concatenate(([0], np.cumsum((rows[1:, 1:] != rows[:-1, 1:]).any(axis=1))))
        crowd = np.bincount(group)[group] > 1
        group, bits = group[crowd], np.ascontiguousarray(rows[crowd, 0])
        edges = forest_edges(group, bits.view(np.uint64), reference, distance) if len(bits) else []
        if edges:
            ends = bits[np.array(edges)]
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["u", "v"])

    key = ["mask", "part", "pair"]
    sorted_rows = dealt.select("bits", *[F.col(name).cast("long") for name in key]).repartition(*key)
    return sorted_rows.sortWithinPartitions(*key, "bits").mapInArrow(connect, "u long, v long").distinct()


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_duplicates(documents: DataFrame, words_each: int = 3, distance: int = 3, pivots: int = 24) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Documents whose fingerprints differ in at most ``distance`` bits are linked; component_id is
    the least doc_id that can be reached. Null and empty texts have fingerprint zero and are
    linked like any others. Repeated rows and null ids stay, each with its own row; a null id is
    never the least one, unless its component has no other. Other columns are ignored. An empty
    table gives an empty result. Exact copies share one fingerprint and enter the search once.
    """
    prints = stored(fingerprints(documents, words_each), "prints")
    classes = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes, distance, pivots))
    rooted = classes.join(roots, classes.bits == roots.node, "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("bits", "component_id")
    return prints.join(named, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )
