"""Alignment of two tokenizers: fragments of byte ranges form a monoid, long texts are reduced as trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.bpe import groups_of
from tallyloom.llm.common import stored
from tallyloom.llm.library import PARTS_AT_ONCE, library
from tallyloom.llm.words import CUT, Words, joined, plain

CHUNK_BYTES = 1 << 16  # a longer text is aligned in chunks of this size, by many tasks
FAN = 8  # fragments that one step of the reduction composes
TEXT_AT_ONCE = 4 << 20
MOST_PAIRS = 4_000_000  # counted pairs that may be broadcast (12 bytes each); beyond, rows are joined by pair
KEPT_BYTES = 192 << 20  # of aligned parts that a worker remembers


class Pieces:
    """A sentencepiece model and the bytes of its pieces."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.tokens = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(k) else name.replace("▁", " ").encode() for k, name in enumerate(names)
        ]
        self.sizes = np.array(list(map(len, self.tokens)))
        # No piece goes on behind a space that follows something, so texts may be cut before such a space.
        self.separable = not any(" " in token.decode(errors="replace").lstrip(" ") for token in self.tokens)

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), dtype=np.int64)


class Closed(NamedTuple):
    """Whole groups: how many tokens and groups, the groups as text, and a key for each link."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    groups: bytes = b""
    links: bytes = b""

    def __add__(self, other: Closed) -> Closed:
        if not (self.n_groups and other.n_groups):
            return self if self.n_groups else other
        return Closed(self.n_a + other.n_a, self.n_b + other.n_b, self.n_groups + other.n_groups,
                      self.groups + b";" + other.groups, self.links + other.links)


@dataclass(frozen=True)
class Open:
    """Tokens of both kinds with their ends (byte offsets in the text) and no common end but perhaps the last."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def __add__(self, other: Open) -> Open:
        return Open(*(np.concatenate(both) for both in zip(self.parts(), other.parts())))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_ends, self.b, self.b_ends

    def between(self, low: int, high: int) -> Open:
        """Tokens whose end lies behind ``low`` and not behind ``high``."""
        i, j = np.searchsorted(self.a_ends, [low, high], "right"), np.searchsorted(self.b_ends, [low, high], "right")
        return Open(self.a[i[0] : i[1]], self.a_ends[i[0] : i[1]], self.b[j[0] : j[1]], self.b_ends[j[0] : j[1]])


MISSING = Closed(groups=b"-")  # stands among remembered values for what a tokenizer does not spell
NOTHING = Open(*[np.zeros(0, dtype=np.int64)] * 4)


@dataclass(frozen=True)
class Fragment:
    """What a byte range says: tokens up to its first common end, whole groups, tokens behind the last one.

    Without a common end (``cut`` false) all tokens are in ``lead``.
    """

    lead: Open = NOTHING
    closed: Closed = Closed()
    trail: Open = NOTHING
    cut: bool = False


class Aligner:
    """Groups and links of two vocabularies with token sizes in bytes."""

    def __init__(self, a_size: int, b_size: int) -> None:
        self.b_size = b_size
        self.kind = np.dtype("<u4") if a_size * b_size <= 1 << 32 else np.dtype("<u8")  # a link's key is a * b_size + b
        size = max(a_size, b_size)
        self.text = [[b"%d%s" % (k, mark) for k in range(size)] for mark in (b",", b"|", b";")]
        self.digits = np.array([len(one) for one in self.text[0]])

    def links(self, tokens: Open) -> tuple[np.ndarray, np.ndarray]:
        """Key and end of each pair of tokens that share bytes: the stretches between neighbouring ends."""
        ends = np.union1d(tokens.a_ends, tokens.b_ends)
        a = tokens.a[np.searchsorted(tokens.a_ends, ends)]
        return a * self.b_size + tokens.b[np.searchsorted(tokens.b_ends, ends)], ends

    def written(self, tokens: Open, common: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All groups as text, each with a ``;`` behind it, and where the text of each group ends."""
        group = np.concatenate([np.searchsorted(common, tokens.a_ends), np.searchsorted(common, tokens.b_ends)])
        kind = np.repeat([0, 1], [len(tokens.a), len(tokens.b)])
        order = np.argsort(2 * group + kind, kind="stable")
        ids, group, kind = np.concatenate([tokens.a, tokens.b])[order], group[order], kind[order]
        mark = np.full(len(ids), 2)  # a group ends
        mark[:-1] = np.where(group[1:] != group[:-1], 2, kind[1:] != kind[:-1])
        text = self.text
        out = b"".join([text[m][k] for m, k in zip(mark.tolist(), ids.tolist())])
        return out, np.cumsum(self.digits[ids])[mark == 2]

    def closed(self, tokens: Open) -> Closed:
        """Tokens that begin and end at common ends."""
        if not len(tokens.a):
            return Closed()
        common = np.intersect1d(tokens.a_ends, tokens.b_ends)
        groups, _ = self.written(tokens, common)
        return Closed(len(tokens.a), len(tokens.b), len(common), groups[:-1], self.links(tokens)[0].astype(self.kind).tobytes())

    def fragment(self, tokens: Open) -> Fragment:
        common = np.intersect1d(tokens.a_ends, tokens.b_ends)
        if not len(common):
            return Fragment(tokens)
        first, last = int(common[0]), int(common[-1])
        return Fragment(tokens.between(-1, first), self.closed(tokens.between(first, last)), tokens.between(last, 1 << 62), True)

    def compose(self, x: Fragment, y: Fragment) -> Fragment:
        """Of two neighbouring byte ranges; associative, with ``Fragment()`` as the neutral element."""
        if not x.cut:
            return Fragment(x.lead + y.lead, y.closed, y.trail, y.cut)
        if not y.cut:
            return Fragment(x.lead, x.closed, x.trail + y.lead, True)
        return Fragment(x.lead, x.closed + self.closed(x.trail + y.lead) + y.closed, y.trail, True)

    def finished(self, whole: Fragment) -> Closed:
        """Of a whole text, which begins and ends at a common end."""
        return self.closed(whole.lead) + whole.closed


def _weight(value: Closed | bytes) -> int:
    return 300 + len(value.groups) + len(value.links) if value else 50


class Pair(Words):
    """Two tokenizers: A encodes a space and the text, B, which adds the space itself, the text.

    Where both cut before each space between visible characters, what stands between two of
    them is a small text of its own. Its fragment is closed on both sides, so a text is the
    product of the fragments of its parts, and parts met before are not encoded again.
    """

    firsts_differ, before = False, ""

    def __init__(self, a_path: str, b_path: str, kept_bytes: int = KEPT_BYTES) -> None:
        self.a, self.b = library(a_path), Pieces(b_path)
        self.aligner = Aligner(len(self.a.tokens), len(self.b.tokens))
        super().__init__(lambda texts: [one or MISSING for one in self.small_texts(texts)], kept_bytes, _weight)

    def tokens(self, text: str) -> Open | None:
        """Both kinds of tokens of a text, or None if either does not spell it."""
        a, b, spelt = self.a.ids([" " + text])[0].astype(np.int64), self.b.ids(text), (" " + text).encode()
        if any(b"".join(map(which.tokens.__getitem__, ids.tolist())) != spelt for which, ids in ((self.a, a), (self.b, b))):
            return None
        return Open(a, np.cumsum(self.a.sizes[a]), b, np.cumsum(self.b.sizes[b]))

    def whole(self, text: str) -> Closed | None:
        tokens = self.tokens(text)
        return None if tokens is None else self.aligner.closed(tokens)

    def small_texts(self, texts: list[str]) -> list[Closed | None]:
        """Each as a text of its own; those between spaces as one long string, taken apart again."""
        made: dict[int, Closed | None] = {}
        between = [k for k, text in enumerate(texts) if plain(text)] if self.b.separable else []
        for at in range(0, len(between), PARTS_AT_ONCE):
            some = between[at : at + PARTS_AT_ONCE]
            made.update(zip(some, self._joined([texts[k] for k in some])))
        return [made[k] if k in made else self.whole(text) for k, text in enumerate(texts)]

    def _joined(self, texts: list[str]) -> list[Closed | None]:
        tokens, aligner = self.tokens(" ".join(texts)), self.aligner
        if tokens is None:
            return [self.whole(text) for text in texts]
        ends = np.cumsum([len(text.encode()) + 1 for text in texts])
        common = np.intersect1d(tokens.a_ends, tokens.b_ends)
        last = np.searchsorted(common, ends)
        if not (common[np.minimum(last, len(common) - 1)] == ends).all():
            return [self.whole(text) for text in texts]
        groups, group_ends = aligner.written(tokens, common)
        links, link_ends = aligner.links(tokens)
        packed, size = links.astype(aligner.kind).tobytes(), aligner.kind.itemsize
        bounds = [np.searchsorted(tokens.a_ends, ends, "right"), np.searchsorted(tokens.b_ends, ends, "right"),
                  last + 1, group_ends[last], np.searchsorted(link_ends, ends, "right") * size]
        lists = [[0, *bound.tolist()] for bound in bounds]
        return [
            Closed(a1 - a0, b1 - b0, g1 - g0, groups[t0 : t1 - 1], packed[l0:l1])
            for a0, a1, b0, b1, g0, g1, t0, t1, l0, l1 in zip(*(x for one in lists for x in (one[:-1], one[1:])))
        ]

    def string(self, key: str) -> str | None:
        """Two spaces mark what is not a part between spaces that both tokenizers cut at."""
        return key[2:] if key[:2] == "  " else None

    def keys(self, text: str) -> list[str]:
        first, *others = CUT.split(text) if self.b.separable else [text]
        parts = [first, *(part[1:] for part in others)]
        return [part if " " not in part and plain(part) and self.b.separable else "  " + part for part in parts]

    def aligned(self, texts: pa.Array) -> list[Closed]:
        """Of each whole text; nothing for one that either tokenizer does not spell."""
        if not len(texts):
            return []
        if not self.b.separable:
            return [self.whole(text) or Closed() if text else Closed() for text in texts.to_pylist()]
        values, at, bounds = self.parts(texts)
        n_a, n_b, n_groups = (np.add.reduceat(np.array(column, dtype=np.int64)[at], bounds[:-1]).tolist()
                              for column in zip(*((v.n_a, v.n_b, v.n_groups) if v else (0, 0, 0) for v in values)))
        groups = joined([v.groups + b";" if v else b"" for v in values], at, bounds)
        links = joined([v.links if v else b"" for v in values], at, bounds)
        missing = np.logical_or.reduceat(np.array([v is MISSING for v in values])[at], bounds[:-1]).tolist()
        return [
            Closed() if text == "" else (self.whole(text) or Closed()) if gone else Closed(a, b, n, text_groups[:-1], text_links)
            for text, gone, a, b, n, text_groups, text_links in zip(self._named(texts, missing), missing, n_a, n_b, n_groups, groups, links)
        ]

    @staticmethod
    def _named(texts: pa.Array, missing: list[bool]) -> Iterator[str | None]:
        """The texts that are looked at again or empty, others as None."""
        sizes = pc.binary_length(texts).to_pylist()
        return (texts[k].as_py() if gone or not size else None for k, (gone, size) in enumerate(zip(missing, sizes)))


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair(a_path: str, b_path: str) -> Pair:
    """One pair for all tasks of a worker process, with what it has learnt."""
    if (a_path, b_path) not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[a_path, b_path] = Pair(a_path, b_path)
    return _PAIRS[a_path, b_path]


ROW = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"
OPEN = [f"{side}_{part}" for side in ("lead", "trail") for part in ("a", "a_ends", "b", "b_ends")]
FRAGMENT = f"row long, doc_id long, chunk long, cut boolean, n_a long, n_b long, n_groups long, groups binary, links binary, {', '.join(f'{name} binary' for name in OPEN)}"


def _row(doc_id: int | None, whole: Closed, kind: np.dtype) -> dict:
    pairs, times = np.unique(np.frombuffer(whole.links, kind), return_counts=True)
    return {
        "doc_id": doc_id, "n_a": whole.n_a, "n_b": whole.n_b, "n_groups": whole.n_groups, "n_links": len(whole.links) // kind.itemsize,
        "groups": whole.groups.decode(), "pairs": pairs.tobytes(), "times": times.astype("<u4").tobytes(),
    }


ROW_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                        ("groups", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())])
FRAGMENT_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int64()), ("cut", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                             ("n_groups", pa.int64()), ("groups", pa.binary()), ("links", pa.binary()), *((name, pa.binary()) for name in OPEN)])


def _packed(fragment: Fragment, row: int, doc_id: int | None, chunk: int) -> dict:
    sides = [part.astype("<i8").tobytes() for side in (fragment.lead, fragment.trail) for part in side.parts()]
    return {"row": row, "doc_id": doc_id, "chunk": chunk, "cut": fragment.cut, **fragment.closed._asdict(), **dict(zip(OPEN, sides))}


def _unpacked(held: dict) -> Fragment:
    parts = [np.frombuffer(held[name], "<i8") for name in OPEN]
    closed = Closed(*(held[name] for name in ("n_a", "n_b", "n_groups", "groups", "links")))
    return Fragment(Open(*parts[:4]), closed, Open(*parts[4:]), held["cut"])


def _long_texts(documents: DataFrame, a_path: str, b_path: str, chunk_bytes: int) -> DataFrame:
    """Rows of long texts: tokens dealt out by byte range, one fragment each, composed ``FAN`` at a time."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(k) for k in range(3))):
                tokens = both.tokens(text.as_py()) or NOTHING
                end = int(tokens.a_ends[-1]) if len(tokens.a) else 0
                for chunk in range(max(-(-end // chunk_bytes), 1)):
                    held = tokens.between(chunk * chunk_bytes, (chunk + 1) * chunk_bytes)
                    yield pa.RecordBatch.from_pylist([_packed(Fragment(held), row.as_py(), doc_id.as_py(), chunk)], schema=FRAGMENT_SCHEMA)

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = pair(a_path, b_path).aligner
        for batch in batches:
            for held in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                made = aligner.fragment(_unpacked(held).lead)
                yield pa.RecordBatch.from_pylist([_packed(made, held["row"], held["doc_id"], held["chunk"])], schema=FRAGMENT_SCHEMA)

    def composed(group: pa.Table) -> pa.Table:
        aligner, rows = pair(a_path, b_path).aligner, sorted(group.to_pylist(), key=lambda held: held["chunk"])
        whole = reduce(aligner.compose, map(_unpacked, rows))
        return pa.Table.from_pylist([_packed(whole, rows[0]["row"], rows[0]["doc_id"], rows[0]["chunk"] // FAN)], schema=FRAGMENT_SCHEMA)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = pair(a_path, b_path).aligner
        for batch in batches:
            for held in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                yield pa.RecordBatch.from_pylist([_row(held["doc_id"], aligner.finished(_unpacked(held)), aligner.kind)], schema=ROW_SCHEMA)

    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    now = stored(rows.mapInArrow(chunks, FRAGMENT), "token-chunks")
    spread = now.repartition(F.col("row"), F.col("chunk"))
    most = now.agg(F.max("chunk")).first()[0] or 0
    now = stored(spread.mapInArrow(fragments, FRAGMENT), "fragments")
    while most:
        now = stored(now.groupBy("row", F.floor(F.col("chunk") / FAN).alias("step")).applyInArrow(composed, FRAGMENT), "fragments")
        most //= FAN
    return now.mapInArrow(finish, ROW)


def align(documents: DataFrame, a_path: str, b_path: str, text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Groups of tokens that two tokenizers cut alike, for each document.

    A is a byte-level BPE of the tokenizers library, read as a space and the text; B is a
    sentencepiece model, which adds the space. Offsets at which tokens of both end cut the tokens
    into groups; tokens that share bytes are linked. Returned are doc_id, n_a, n_b, n_groups,
    n_links, groups (``a1,a2|b1;a3|b2,b3``), pairs (sorted distinct keys a * size of B + b, packed)
    and times (how often each is linked, unsigned 32-bit).

    Texts that are null, empty or not spelt by either kind of tokens give zeros and empty values.
    A text of more than ``chunk_bytes`` is encoded by one task, aligned by many, a byte range each,
    and put together by a tree of compositions; the result does not depend on where chunks end.
    Repeated rows and null doc_ids stay; other columns are ignored; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(a_path, b_path)
        for batch in batches:
            texts = batch.column(1)
            for some in groups_of((len(one.as_buffer()) for one in texts), TEXT_AT_ONCE):
                wholes = both.aligned(texts[some])
                rows = [_row(doc_id, whole, both.aligner.kind) for doc_id, whole in zip(batch.column(0)[some].to_pylist(), wholes)]
                yield pa.RecordBatch.from_pylist(rows, schema=ROW_SCHEMA)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    is_long = F.octet_length("text") > chunk_bytes
    return rows.filter(~is_long).mapInArrow(run, ROW).union(_long_texts(rows.filter(is_long), a_path, b_path, chunk_bytes))


def pair_counts(aligned: DataFrame, b_size: int, kind: np.dtype) -> DataFrame:
    """(pair, documents, best): how many documents hold each linked pair, and whether none of its A id is held by more.

    Documents are counted by pair inside each task before anything is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, totals = np.zeros(0, dtype=kind), np.zeros(0, dtype=np.int64)
        held, size = [], 0

        def add() -> None:
            nonlocal keys, totals, held, size
            fresh, times = np.unique(np.concatenate(held), return_counts=True)
            every = np.concatenate([keys, fresh])
            keys, at = np.unique(every, return_inverse=True)
            totals = np.bincount(at, np.concatenate([totals, times]), len(keys)).astype(np.int64)
            held, size = [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(totals)], names=["pair", "documents"])

        for batch in batches:
            for one in batch.column(0).to_pylist():
                held.append(np.frombuffer(one, kind))
                size += len(held[-1])
                if size > 1 << 21:
                    add()
                    if len(keys) > 1 << 21:
                        yield out()
                        keys, totals = keys[:0], totals[:0]
        if held:
            add()
        yield out()

    counted = aligned.select("pairs").mapInArrow(count, "pair long, documents long")
    summed = stored(counted.groupBy("pair").agg(F.sum("documents").alias("documents")), "pair-counts")
    a_id = F.expr(f"pair div {b_size}")
    most = summed.groupBy(a_id.alias("a")).agg(F.max("documents").alias("most"))
    # At most one row for each id of A's vocabulary.
    return summed.withColumn("a", a_id).join(F.broadcast(most), "a").select("pair", "documents", (F.col("documents") == F.col("most")).alias("best"))


def with_counts(aligned: DataFrame, b_size: int, kind: np.dtype, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Add n_best (links whose pair no other pair of its A id beats) and count_sum (documents of the pair, over all links).

    ``aligned`` must be stored: it is read twice. Counted pairs are broadcast while there are at
    most ``most_pairs``; if there are more, the distinct pairs of each document are joined with them
    and summed by row, where Spark can split a pair that a large part of the documents hold.
    """
    counts = stored(pair_counts(aligned, b_size, kind), "pairs")
    if counts.count() > most_pairs:
        return _joined_counts(aligned, counts, kind)
    held = counts.orderBy("pair").toArrow()
    known = aligned.sparkSession.sparkContext.broadcast(
        (held["pair"].to_numpy().astype(kind), held["documents"].to_numpy(), held["best"].to_numpy(zero_copy_only=False))
    )
    added = [("n_best", "long"), ("count_sum", "long")]
    others = [name for name in aligned.columns if name not in ("n_best", "count_sum")]
    places = others.index("pairs"), others.index("times")

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, documents, best = known.value
        for batch in batches:
            sums = []
            for pairs, times in zip(*(batch.column(k).to_pylist() for k in places)):
                at, n = np.searchsorted(keys, np.frombuffer(pairs, kind)), np.frombuffer(times, "<u4").astype(np.int64)
                sums.append((int(n[best[at]].sum()), int((n * documents[at]).sum())))
            columns = [pa.array([one[k] for one in sums], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*others, "n_best", "count_sum"])

    target = aligned.select(*others, *[F.lit(None).cast(kind_).alias(name) for name, kind_ in added]).schema
    return aligned.select(*others).mapInArrow(look_up, target)


def _joined_counts(aligned: DataFrame, counts: DataFrame, kind: np.dtype) -> DataFrame:
    rows = stored(aligned.withColumn("__row", F.monotonically_increasing_id()), "aligned-rows")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pairs = np.frombuffer(batch.column(1)[k].as_buffer(), kind).astype(np.int64)
                times = np.frombuffer(batch.column(2)[k].as_buffer(), "<u4").astype(np.int64)
                row = np.full(len(pairs), batch.column(0)[k].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(pairs), pa.array(times)], names=["__row", "pair", "n"])

    links = rows.filter("n_links > 0").select("__row", "pairs", "times").mapInArrow(explode, "__row long, pair long, n long")
    sums = links.join(counts, "pair").groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("documents")).alias("count_sum")
    )
    none = F.lit(0).cast("long")
    kept = [name for name in aligned.columns if name not in ("n_best", "count_sum")]
    return rows.join(sums, "__row", "left").select(*kept, F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"))


def digest(groups: Column) -> Column:
    """Lower-case hex SHA-256 of the groups; empty without tokens."""
    return F.when(groups == "", F.lit("")).otherwise(F.sha2(groups, 256))


def vocabulary_sizes(spark: SparkSession, a_path: str, b_path: str) -> tuple[int, np.dtype]:
    """Size of B and type of the pairs' keys."""
    aligner = pair(a_path, b_path).aligner
    return aligner.b_size, aligner.kind
