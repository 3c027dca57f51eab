"""Byte-level BPE: a segment tree over byte positions holds the leftmost least pair rank."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.words import Kept, Words
from tallyloom.session import bounded_batches

NONE = np.int64(1) << 62
NEVER = int(NONE)
WIDEST = 64  # bytes of a piece up to which many pieces are merged side by side
CELLS_AT_ONCE = 1 << 16  # bytes of pieces merged side by side, each as wide as the widest
BYTES_AT_ONCE = 4 << 20  # of text in a batch that a worker hands on
KEPT_BYTES = 96 << 20  # a worker remembers parts of texts up to this size, and pieces they share up to a sixth of it


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Merges:
    """Rank of the token that two neighbouring tokens make, if they make one."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        found = {
            ranks[token[:k]] << 32 | ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.pairs = found
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.keys = np.array(sorted(found), dtype=np.int64)
        self.values = np.array([found[k] for k in self.keys.tolist()], dtype=np.int64)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, "<u4").tolist()))

    def many(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], NONE)


def merge_one(piece: bytes, merges: Merges) -> list[int]:
    """Token ids of one piece of any length: each merge updates three leaves and their ancestors."""
    n = len(piece)
    leaves = 1 << (n - 1).bit_length()
    ids, pairs = merges.single[np.frombuffer(piece, np.uint8)].tolist(), merges.pairs
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    tree = [(NEVER, 0)] * (2 * leaves)
    for p in range(n - 1):
        tree[leaves + p] = (pairs.get(ids[p] << 32 | ids[p + 1], NEVER), p)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(p: int, rank: int) -> None:
        node = leaves + p
        tree[node] = (rank, p)
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while tree[1][0] < NEVER:
        rank, p = tree[1]
        gone = after[p]
        ids[p], ids[gone], after[p] = rank, -1, after[gone]
        put(gone, NEVER)
        nxt = after[p]
        if nxt < n:
            before[nxt] = p
        put(p, pairs.get(rank << 32 | ids[nxt], NEVER) if nxt < n else NEVER)
        if p:
            put(before[p], pairs.get(ids[before[p]] << 32 | rank, NEVER))
    return [i for i in ids if i >= 0]


def merge_side_by_side(pieces: list[bytes], width: int, merges: Merges) -> list[bytes]:
    """Packed ids of many pieces of at most ``width`` bytes: one tree a piece, all stepped together."""
    count, levels = len(pieces), width.bit_length() - 1
    length = np.array([len(piece) for piece in pieces])
    padded = np.frombuffer(b"".join(piece.ljust(width, b"\0") for piece in pieces), np.uint8).reshape(count, width)
    column = np.arange(width)
    ids = np.where(column < length[:, None], merges.single[padded], -1)
    after = np.tile(column + 1, (count, 1))
    before = np.tile(column - 1, (count, 1))
    tree = np.full((count, 2 * width), NONE)

    def key(rank: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.where(rank < NONE, rank << levels | place, NONE)

    row, place = np.nonzero(column[:-1] < length[:, None] - 1)
    tree[row, width + place] = key(merges.many(ids[row, place], ids[row, place + 1]), place)
    for level in range(levels, 0, -1):
        first = 1 << (level - 1)
        nodes = tree[:, 2 * first : 4 * first]
        tree[:, first : 2 * first] = np.minimum(nodes[:, 0::2], nodes[:, 1::2])

    def lift(rows: np.ndarray, place: np.ndarray) -> None:
        node = place + width
        for _ in range(levels):
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    rows = np.flatnonzero(tree[:, 1] < NONE)
    while len(rows):
        least = tree[rows, 1]
        place, rank = least & (width - 1), least >> levels
        gone = after[rows, place]
        nxt = after[rows, gone]
        ids[rows, place], ids[rows, gone], after[rows, place] = rank, -1, nxt
        tree[rows, width + gone] = tree[rows, width + place] = NONE
        more = nxt < length[rows]
        r, p, q = rows[more], place[more], nxt[more]
        before[r, q] = p
        tree[r, width + p] = key(merges.many(rank[more], ids[r, q]), p)
        less = place > 0
        r, p = rows[less], before[rows[less], place[less]]
        tree[r, width + p] = key(merges.many(ids[r, p], rank[less]), p)
        lift(rows, gone)
        lift(rows, place)
        lift(r, p)
        rows = rows[tree[rows, 1] < NONE]
    packed, sizes = ids[ids >= 0].astype("<u4").tobytes(), (4 * (ids >= 0).sum(axis=1)).tolist()
    ends = list(accumulate(sizes))
    return [packed[end - size : end] for end, size in zip(ends, sizes)]


class Encoder:
    """Encodes texts; keeps the ids of pieces and of parts of texts it has met, in bounded memory."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.merges = Merges(ranks)
        self.pattern = regex.compile(pattern)
        self.words = Words(self._parts, KEPT_BYTES)
        self.known = Kept(KEPT_BYTES // 6)

    def pieces(self, pieces: Iterable[str]) -> list[bytes]:
        """Packed ids of each piece."""
        ranks, packed = self.merges.ranks, {}
        by_width: dict[int, list[bytes]] = {}
        coded = [piece.encode() for piece in pieces]
        for piece in coded:
            rank = ranks.get(piece)
            if rank is not None:
                packed[piece] = rank.to_bytes(4, "little")
            elif len(piece) <= WIDEST:
                by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(piece)
            else:
                packed[piece] = np.array(merge_one(piece, self.merges), dtype="<u4").tobytes()
        for width, some in by_width.items():
            for at in range(0, len(some), CELLS_AT_ONCE // width):
                part = some[at : at + CELLS_AT_ONCE // width]
                packed.update(zip(part, merge_side_by_side(part, width, self.merges)))
        return [packed[piece] for piece in coded]

    def _parts(self, parts: list[str]) -> list[bytes]:
        split = list(map(self.pattern.findall, parts))
        alone = iter(self.pieces([own[0] for own in split if len(own) == 1]))  # the part itself is kept, by ``words``
        shared = iter(self.known.values([own for own in split if len(own) != 1], self.pieces))
        return [next(alone) if len(own) == 1 else b"".join(next(shared)) for own in split]

    def texts(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Packed ids of each text: unsigned 32-bit little-endian numbers."""
        return self.words.of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))


def groups_of(sizes: Iterable[int], most: int) -> Iterator[slice]:
    """Neighbouring rows in groups that end once their sizes pass ``most``."""
    start, held, at = 0, 0, 0
    for at, size in enumerate(sizes, 1):
        held += size
        if held >= most:
            yield slice(start, at)
            start, held = at, 0
    if at > start:
        yield slice(start, at)


def encode(
    spark: SparkSession, documents: DataFrame, ranks_path: str, pattern: str, text: str = "text",
    decoded: str | None = None, intact: str | None = None,
) -> DataFrame:
    """Replace ``text`` by ``ids``: the packed token ids (unsigned 32-bit little-endian) of the whole text.

    With ``decoded`` the ids are decoded again in the same task and the bytes returned under
    that name; with ``intact`` a column of that name says whether they equal the text's, so the
    text travels to Python once. A null text counts as empty and gets no ids. All other columns
    and repeated rows pass unchanged; columns of the three names are replaced. An empty table
    gives none. The vocabulary file is read once, on the driver, and goes to the executors as a
    broadcast of its fixed size. The session hands texts to Python in batches of about
    ``BYTES_AT_ONCE`` from now on.
    """
    bounded_batches(spark, BYTES_AT_ONCE)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    added = {"ids": "binary", **({decoded: "binary"} if decoded else {}), **({intact: "boolean"} if intact else {})}
    others = [name for name in documents.columns if name not in (text, *added)]
    rows = documents.select(*others, F.coalesce(F.col(text), F.lit("")).alias(text))
    target = documents.select(*others, *[F.lit(None).cast(kind).alias(name) for name, kind in added.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern)
        for batch in batches:
            column = batch.column(len(others))
            for rows in groups_of((len(value.as_buffer()) for value in column), BYTES_AT_ONCE):
                packed = encoder.texts(column[rows])
                made = [pa.array(packed, pa.binary())]
                if decoded or intact:
                    back = [encoder.merges.decode(one) for one in packed]
                    made += [pa.array(back, pa.binary())] if decoded else []
                    made += [pa.array([one == text.as_buffer().to_pybytes() for one, text in zip(back, column[rows])])] if intact else []
                yield pa.RecordBatch.from_arrays([*(c[rows] for c in batch.columns[: len(others)]), *made], names=target.names)

    return rows.mapInArrow(run, target)


_ENCODERS: dict = {}


def _encoder(ranks, pattern: str) -> Encoder:
    """One encoder for all tasks of a worker process, with what it has learnt."""
    key = (ranks._jbroadcast.id() if getattr(ranks, "_jbroadcast", None) else id(ranks), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(ranks.value, pattern)
    return _ENCODERS[key]


def decode(spark: SparkSession, encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``: the bytes that the packed ids stand for; null ids give no bytes.

    All other columns and repeated rows pass unchanged; an empty table gives none.
    """
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    others = [name for name in encoded.columns if name not in (ids, "decoded")]
    rows = encoded.select(*others, F.col(ids))
    target = encoded.select(*others, ids, F.lit(b"").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in ranks.value.items()}
        for batch in batches:
            packed = batch.column(len(others))
            for rows in groups_of((len(value.as_buffer() or b"") for value in packed), BYTES_AT_ONCE):
                some = (value or b"" for value in packed[rows].to_pylist())
                back = [b"".join(map(tokens.__getitem__, np.frombuffer(one, "<u4").tolist())) for one in some]
                yield pa.RecordBatch.from_arrays([*(c[rows] for c in batch.columns), pa.array(back, pa.binary())], names=target.names)

    return rows.mapInArrow(run, target)


def token_count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
