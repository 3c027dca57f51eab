"""Phrase collocations: double-array tries of candidates are broadcast and all text positions advance at once."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import kept_on_disk, stored
from tallyloom.session import bounded_batches

# ASCII marks and line ends that end a piece. A tab parts words like a space.
ENDS = b".,;:!?\n\x0b\x0c\r"
SETTLE = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + b" ")
MOST_WORDS = 2_000_000  # frequent words that may be broadcast as a dictionary; beyond, words get their ids by a join
MOST_PHRASES = 1_000_000  # phrases of one trie; more are dealt to several tries, each broadcast and scanned by itself
COUNTED_AT_ONCE = 250_000  # distinct words a task holds before it hands their counts on
POSITIONS_AT_ONCE = 1 << 21  # pairs a task holds before it adds them up; of distinct ones it hands half as many on
BUCKET_POSITIONS = 1 << 21  # positions of the texts for each bucket that pairs are dealt to
NUMBERS_AT_ONCE = 1 << 16  # phrases whose counts travel together
TEXT_AT_ONCE = 1 << 17  # words in a row of ids
BYTES_AT_ONCE = 4 << 20  # in a batch that Spark hands to Python
LOOKS = (4, 16, 64, 256, 1024, 4096)
SLOTS_AT_ONCE = 4096  # places that are tried together for the children of a trie node


def words_of(text: str) -> list[bytes]:
    """Words of a text in lower-case ASCII; ``\\n`` stands where a piece ends, empty strings count for nothing."""
    return text.encode().lower().translate(SETTLE).replace(b"\n", b" \n ").split(b" ")


def word_counts(documents: DataFrame, least: int) -> DataFrame:
    """(lang, word, n) of words found ``least`` times or more, and of all words of a language with a null word.

    Tasks count in a dictionary of bounded size before anything is shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, found in held.items():
                found.pop(b"", None), found.pop(b"\n", None)
                rows = [[lang] * (len(found) + 1), [None, *(word.decode() for word in found)], [sum(found.values()), *found.values()]]
                yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int64())], names=["lang", "word", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(lang, Counter()).update(words_of(text.as_py()))
            if sum(map(len, held.values())) > COUNTED_AT_ONCE:
                yield from out()
        yield from out()

    counted = documents.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return counted.filter((F.col("n") >= least) | F.col("word").isNull())


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        return 0


def _useful(ids: np.ndarray) -> np.ndarray:
    """Ids without blanks (-1), without lone ones, and with one 0 for each break."""
    ids = ids[ids >= 0]
    before, after = np.append(0, ids[:-1]), np.append(ids[1:], 0)
    ids = np.where((before > 0) | (after > 0), ids, 0)
    before = np.append(0, ids[:-1])
    return ids[(ids > 0) | (before > 0)]


def encoded(documents: DataFrame, vocabulary: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """(ids): texts as packed ids of frequent words (unsigned 32-bit), 0 where a piece or a run of such words ends.

    Many texts share a row. ``vocabulary`` (lang, word, id) is broadcast while it has at most
    ``most_words`` rows; a larger one is joined with the exploded words.
    """
    spark, target = documents.sparkSession, "ids binary"

    def packed(lists: list[np.ndarray]) -> pa.RecordBatch:
        both = np.concatenate([part for ids in lists for part in (ids, [0])])
        return pa.RecordBatch.from_arrays([pa.array([_useful(both).astype("<u4").tobytes()], pa.binary())], names=["ids"])

    if vocabulary.count() <= most_words:
        by_lang: dict[str, dict[bytes, int]] = {}
        for r in vocabulary.toLocalIterator():
            by_lang.setdefault(r.lang, {})[r.word.encode()] = r.id
        known = spark.sparkContext.broadcast({lang: _Ids({**ids, b"": -1, b"\n": 0}) for lang, ids in by_lang.items()})

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables, held, size = known.value, [], 0
            for batch in batches:
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if lang in tables:
                        held.append(np.array(list(map(tables[lang].__getitem__, words_of(text.as_py()))), dtype=np.int64))
                        size += len(held[-1])
                    if size > TEXT_AT_ONCE:
                        yield packed(held)
                        held, size = [], 0
            if held:
                yield packed(held)

        return documents.mapInArrow(look_up, target)

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, lang, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                words = [None if word == b"\n" else word.decode() for word in words_of(text) if word]
                columns = [pa.array([row] * len(words), pa.int64()), pa.array([lang] * len(words), pa.string()), pa.array(range(len(words)), pa.int64()), pa.array(words, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "lang", "at", "word"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 0), dtype=np.int64)
        for batch in batches:
            held = np.concatenate([held, [batch.column(0).to_numpy(), batch.column(1).to_numpy()]], axis=1)
            whole = int(np.searchsorted(held[0], held[0][-1])) if held.shape[1] else 0  # the last text may go on
            if whole > POSITIONS_AT_ONCE >> 3:
                yield packed(np.split(held[1][:whole], np.flatnonzero(np.diff(held[0][:whole])) + 1))
                held = held[:, whole:]
        if held.shape[1]:
            yield packed(np.split(held[1], np.flatnonzero(np.diff(held[0])) + 1))

    rows = stored(documents.withColumn("row", F.monotonically_increasing_id()).select("row", "lang", "text"), "phrase-rows")
    words = rows.mapInArrow(explode, "row long, lang string, at long, word string")
    named = words.join(vocabulary, ["lang", "word"], "left").select("row", "at", F.coalesce("id", F.lit(0)).cast("long").alias("id"))
    return named.repartition("row").sortWithinPartitions("row", "at").select("row", "id").mapInArrow(gather, target)


class Phrases:
    """Phrases in one array of ids, by number from 0."""

    def __init__(self, phrases: list[tuple[int, ...]]) -> None:
        self.ids = np.fromiter(chain.from_iterable(phrases), np.int32)
        self.ends = np.cumsum(np.fromiter(map(len, phrases), np.int64, len(phrases)))

    def __len__(self) -> int:
        return len(self.ends)

    def __getitem__(self, number: int) -> tuple[int, ...]:
        return tuple(self.ids[self.ends[number - 1] if number else 0 : self.ends[number]].tolist())

    def rows(self, numbers: np.ndarray, length: int) -> np.ndarray:
        """One row for each of some phrases that all have ``length`` words."""
        return self.ids[self.ends[numbers][:, None] + np.arange(-length, 0)]


class DoubleArray:
    """A trie of phrases of word ids: the child of slot s by id w is slot ``base[s] + w`` if its ``check`` is s.

    Slots below ``width`` are the children of the root. Parents with the most children are placed
    first; those with one child fill what is left free.
    """

    def __init__(self, phrases: list[tuple[int, ...]], width: int) -> None:
        self.phrases, self.width = Phrases(phrases), width
        nodes: dict[tuple[int, ...], int] = {}
        children: dict[int, list[int]] = {}
        for phrase in phrases:
            parent = phrase[0]  # a child of the root has its id as number, others are numbered from ``width`` on
            for depth in range(2, len(phrase) + 1):
                node = nodes.get(phrase[:depth])
                if node is None:
                    node = nodes[phrase[:depth]] = width + len(nodes)
                    children.setdefault(parent, []).append(node)
                parent = node
        last = np.zeros(width + len(nodes), dtype=np.int64)  # the last word of each node
        for prefix, node in nodes.items():
            last[node] = prefix[-1]
        slot = np.arange(width + len(nodes))
        base = np.zeros(width + len(nodes), dtype=np.int64)
        used = np.zeros(2 * width + 2 * len(nodes) + 2, dtype=bool)
        used[:width] = True
        single = [parent for parent, own in children.items() if len(own) == 1]
        at, smallest = width, 0
        for parent in sorted((p for p, own in children.items() if len(own) > 1), key=lambda p: -len(children[p])):
            labels = last[children[parent]]
            first, size = labels.min(), len(labels)
            if 2 * size <= smallest or not smallest:  # sets of half the size are tried from the start again
                at, smallest = width, size
            steps, place = labels - first, None
            while place is None:
                while len(used) < at + SLOTS_AT_ONCE + 2 * width:
                    used = np.append(used, np.zeros(len(used), dtype=bool))
                good = at + np.arange(SLOTS_AT_ONCE)
                for tested, step in enumerate(steps.tolist(), 1):
                    good = good[~used[good + step]]
                    if not len(good):
                        break
                    if tested in LOOKS and not used[good[0] + steps].any():  # in an empty stretch the first place fits
                        break
                place = int(good[0]) if len(good) else None
                at += SLOTS_AT_ONCE if place is None else 0
            base[parent] = place - first
            used[base[parent] + labels] = True
            slot[children[parent]] = base[parent] + labels
        holes = np.flatnonzero(~used[: width + len(nodes) + int(used[width:].sum())])
        holes = holes[: len(single)]
        ends = np.array([children[parent][0] for parent in single], dtype=np.int64)
        slot[ends] = holes
        base[single] = holes - last[ends]
        size = int(max(slot.max(initial=0), width)) + width + 1
        self.base, self.check, self.accepts = np.zeros(size, dtype=np.int32), np.full(size, -1, dtype=np.int32), np.zeros(size, dtype=np.int32)
        for parent, own in children.items():
            self.base[slot[parent]] = base[parent]
            self.check[slot[own]] = slot[parent]
        roots = np.unique([phrase[0] for phrase in phrases]) if phrases else np.zeros(0, dtype=np.int64)
        self.check[roots] = 0
        for number, phrase in enumerate(phrases, 1):
            self.accepts[slot[nodes[phrase]] if len(phrase) > 1 else phrase[0]] = number

    def levels(self, ids: np.ndarray, deepest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions whose state lives, and the states, after one word, after two, and so on."""
        padded = np.append(ids, np.zeros(deepest, dtype=ids.dtype))
        at = np.flatnonzero((ids > 0) & (self.check[ids] == 0))
        state = ids[at]
        yield at, state
        for step in range(1, deepest):
            reached = self.base[state] + padded[at + step]
            lives = self.check[reached] == state
            at, state = at[lives], reached[lives]
            yield at, state


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1).astype(np.int32)))


def _pressed(*columns: np.ndarray) -> bytes:
    """Whole numbers of some columns, byte by byte of equal weight: most are small."""
    return zstandard.compress(b"".join(column.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for column in columns), 1)


def _restored(held: bytes, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(held), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(own.T).view("<i8").reshape(-1) for own in planes]


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    both, numbers = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(both, kind="stable")
    both = both[order]
    first = np.flatnonzero(np.diff(both, prepend=-1))
    return both[first], np.add.reduceat(numbers[order], first) if len(first) else numbers


def _tries(table: DataFrame, width: int, most_phrases: int) -> Iterator[tuple[DoubleArray, bool]]:
    """Tries of the phrases of a table, each of about ``most_phrases`` at most, and whether there is but one."""
    parts = -(-table.count() // most_phrases)
    for part in range(parts):
        some = table.filter(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == part) if parts > 1 else table
        yield DoubleArray(sorted(tuple(one) for one in some.select("phrase").toArrow()["phrase"].to_pylist()), width), parts == 1


def _candidates(texts: DataFrame, trie: Callable | None, whole: bool, length: int, least: int, buckets: int = 8) -> DataFrame:
    """Phrases of ``length`` words that may occur ``least`` times: (phrase).

    The words but the last are a frequent phrase, and so are those but the first if the trie
    holds all; and the pairs of that phrase's number and the last word, summed over all tasks,
    are at least ``least``. So what is left out is rare. Tasks add pairs up and send those of a
    bucket as one compressed row; a task for each bucket adds them up.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trie.value if trie else None
        held, size, known = [], 0, (np.zeros(0, np.int64), np.zeros(0, np.int64))

        def add() -> tuple[np.ndarray, np.ndarray]:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return _added([known[0], keys], [known[1], counts]) if len(known[0]) else (keys, counts)

        def out() -> pa.RecordBatch:
            keys, counts = known
            # Neighbouring last words stay together, so that differences are small; no frequent word fills a bucket.
            dealt = ((keys >> 8).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % buckets
            order = np.argsort(dealt, kind="stable")
            met, first = np.unique(dealt[order], return_index=True)
            rows = [_pressed(np.diff(keys[own], prepend=0), counts[own]) for own in np.split(order, first[1:])]
            return pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(rows, pa.binary())], names=["bucket", "pairs"])

        for batch in batches:
            for one in batch.column(0):
                ids = np.frombuffer(one.as_buffer(), "<u4").astype(np.int64)
                number = ids
                if tree:
                    *_, (at, state) = tree.levels(ids, length - 1)
                    number = np.zeros(len(ids), dtype=np.int64)
                    number[at] = tree.accepts[state]
                last = ids[length - 1 :]
                begin = number[: len(last)]
                follows = number[1 : len(last) + 1] if whole and length > 2 else last
                lives = (begin > 0) & (follows > 0) & (last > 0)
                held.append(begin[lives] << 32 | last[lives])
                size += len(held[-1])
                if size > POSITIONS_AT_ONCE:
                    known, held, size = add(), [], 0
                    if 2 * len(known[0]) > POSITIONS_AT_ONCE:
                        yield out()
                        known = known[0][:0], known[1][:0]
        if size:
            known = add()
        if len(known[0]):
            yield out()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trie.value if trie else None
        held, size, known = ([], []), 0, (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            for one in batch.column(1):
                steps, counts = _restored(one.as_py(), 2)
                held[0].append(np.cumsum(steps))
                held[1].append(counts)
                size += len(steps)
                if size > POSITIONS_AT_ONCE:
                    known, held, size = _added([known[0], *held[0]], [known[1], *held[1]]), ([], []), 0
        pairs, counts = _added([known[0], *held[0]], [known[1], *held[1]])
        pairs = pairs[counts >= least]
        for at in range(0, len(pairs), NUMBERS_AT_ONCE):
            some = pairs[at : at + NUMBERS_AT_ONCE]
            begins = tree.phrases.rows((some >> 32) - 1, length - 1) if tree else (some >> 32)[:, None]
            yield pa.RecordBatch.from_arrays([_lists(np.column_stack([begins, some & 0xFFFFFFFF]))], names=["phrase"])

    pairs = texts.mapInArrow(find, "bucket int, pairs binary")
    return pairs.repartitionById(buckets, F.col("bucket")).mapInArrow(add_up, "phrase array<int>")


def _occurrences(texts: DataFrame, trie: Callable, length: int, least: int, number: int) -> DataFrame:
    """(phrase, n) of the trie's ``number`` phrases that occur ``least`` times or more.

    Each task counts by state and sends the counts of a run of phrases as one compressed row.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trie.value
        totals = np.zeros(len(tree.check), dtype=np.int64)
        for batch in batches:
            for one in batch.column(0):
                ids = np.frombuffer(one.as_buffer(), "<u4").astype(np.int64)
                for _, state in tree.levels(ids, length):
                    pass
                np.add.at(totals, state, 1)
        counts = np.zeros(number + 1, dtype=np.int64)
        counts[tree.accepts] = totals  # each phrase ends in one state; 0 gathers all others
        for run, at in enumerate(range(1, number + 1, NUMBERS_AT_ONCE)):
            some = counts[at : at + NUMBERS_AT_ONCE]
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array([run], pa.int32()), pa.array([_pressed(some)], pa.binary())], names=["run", "counts"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, sums = trie.value, {}
        for batch in batches:
            for run, one in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums[run] = sums.get(run, 0) + _restored(one.as_py(), 1)[0]
        for run, counts in sums.items():
            met = np.flatnonzero(counts >= least)
            yield pa.RecordBatch.from_arrays([_lists(tree.phrases.rows(run * NUMBERS_AT_ONCE + met, length)), pa.array(counts[met])], names=["phrase", "n"])

    counted = texts.mapInArrow(count, "run int, counts binary")
    return counted.repartitionById(-(-number // NUMBERS_AT_ONCE), F.col("run")).mapInArrow(add_up, "phrase array<int>, n long")


def frequent_phrases(texts: DataFrame, words: int, least: int, longest: int = 5, most_phrases: int = MOST_PHRASES) -> list[DataFrame]:
    """For 2, 3, … ``longest`` words: (phrase, n) of the id sequences found ``least`` times or more.

    Each length takes two scans of ``texts`` (see ``encoded``): one names candidates such that all
    others are rare, one counts them by the states of a broadcast trie.
    """
    context = texts.sparkSession.sparkContext
    positions = texts.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    buckets = max(8, -(-positions // (4 * BUCKET_POSITIONS)))
    # Every counting task hands on a sum for each phrase, so there are no more of them than keep the cores busy.
    counted = texts.coalesce(max(8, 2 * context.defaultParallelism))
    found: list[DataFrame] = []
    for length in range(2, longest + 1):
        if length == 2:
            named = _candidates(texts, None, True, length, least, buckets)
        else:
            parts = [_candidates(texts, context.broadcast(trie), whole, length, least, buckets) for trie, whole in _tries(found[-1], words + 1, most_phrases)]
            if not parts:
                break
            named = parts[0]
            for part in parts[1:]:
                named = named.union(part)
        with kept_on_disk(named) as candidates:
            counts = [_occurrences(counted, context.broadcast(trie), length, least, len(trie.phrases)) for trie, _ in _tries(candidates, words + 1, most_phrases)]
        if not counts:
            break
        summed = counts[0]
        for part in counts[1:]:
            summed = summed.union(part)
        found.append(stored(summed, "phrases"))
    return found


SCORED = "phrase array<int>, a long, l long, r long, n long, score long"


def _least_cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The cut with the least score, the earliest of equals; whole numbers of any size."""
    for batch in batches:
        out = []
        for phrase, a, n, cuts in zip(batch["phrase"], batch["a"], batch["n"], batch["cuts"]):
            score, _, left, right = min((1000 * int(a) * int(n) // (int(c["l"]) * int(c["r"])), c["k"], c["l"], c["r"]) for c in cuts)
            out.append((phrase, a, left, right, n, score))
        yield pd.DataFrame(out, columns=["phrase", "a", "l", "r", "n", "score"])


def collocations(
    documents: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, absorbed: int = 100, text: str = "text", lang: str = "lang",
    most_words: int = MOST_WORDS, most_phrases: int = MOST_PHRASES,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are sequences of 2 to ``longest`` words inside a piece that occur a >= ``least``
    times in texts of their language, overlaps included. Cut in two parts that occur l and r times
    among n words, a candidate scores floor(1000 a n / (l r)); its lowest cut counts, the earliest
    of equals. Candidates inside a longer one that occurs at least ``absorbed`` per cent as often
    are left out. Order: score, then a, both descending, then the phrase by its UTF-8 bytes.

    Null texts have no words, a null language is ``und``, repeated rows count each time, other
    columns are ignored, an empty table gives none. Every count covers all texts. A dictionary or
    trie is broadcast up to a stated size; beyond, words are joined and phrases dealt to more tries.
    The session hands rows to Python in batches of about ``BYTES_AT_ONCE`` from now on.
    """
    spark = documents.sparkSession
    bounded_batches(spark, BYTES_AT_ONCE)
    texts = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    with kept_on_disk(word_counts(texts, least)) as counts:
        totals = stored(counts.filter("word is null").select("lang", F.col("n").alias("total")).coalesce(1), "totals")  # one row for each language
        vocabulary = _numbered(counts.filter("word is not null"))
    with kept_on_disk(encoded(texts, vocabulary.select("lang", "word", "id"), most_words)) as ids:
        phrases = frequent_phrases(ids, vocabulary.count(), least, longest, most_phrases)
    columns = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"
    if not phrases:
        return spark.createDataFrame([], columns)
    every = phrases[0]
    for more in phrases[1:]:
        every = every.union(more)
    return ranked(every, vocabulary, totals, top, absorbed)


def _numbered(words: DataFrame) -> DataFrame:
    """(lang, word, n, id), stored: ids from 1, frequent words first (tries stay dense), numbered range by range."""
    order = [F.desc("n"), F.asc("lang"), F.asc("word")]
    files = max(8, 2 * words.sparkSession.sparkContext.defaultParallelism)
    with kept_on_disk(words.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())) as ordered:
        sizes = ordered.groupBy("part").count()
        earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
        starts = sizes.select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start"))
        own = F.row_number().over(Window.partitionBy("part").orderBy(*order))
        numbered = ordered.withColumn("own", own).join(F.broadcast(starts), "part")
        return stored(numbered.select("lang", "word", "n", (F.col("start") + F.col("own")).cast("int").alias("id")).coalesce(files), "vocabulary")


def ranked(every: DataFrame, vocabulary: DataFrame, totals: DataFrame, top: int, absorbed: int) -> DataFrame:
    """Scores and order of frequent phrases (phrase, n) of word ids."""
    size = F.size("phrase")
    known = every.union(vocabulary.select(F.array("id").alias("phrase"), "n"))
    places = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = every.select("phrase", F.col("n").alias("a"), places).select(
        "phrase", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("left"), F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("right")
    )
    cuts = cuts.join(known.select(F.col("phrase").alias("left"), F.col("n").alias("l")), "left").join(known.select(F.col("phrase").alias("right"), F.col("n").alias("r")), "right")
    spans = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("phrase", i, n)))))
    inside = every.filter(size > 2).select(F.col("n").alias("longer"), spans.alias("phrase")).groupBy("phrase").agg(F.max("longer").alias("longer"))
    kept = every.join(inside, "phrase", "left").filter(F.col("longer").isNull() | (100 * F.col("longer") < absorbed * F.col("n"))).select("phrase")
    gathered = cuts.groupBy("phrase", "a").agg(F.collect_list(F.struct("k", "l", "r")).alias("cuts")).join(kept, "phrase", "left_semi")
    langs = vocabulary.select(F.col("id").alias("first"), "lang").join(F.broadcast(totals), "lang")  # one row for each language
    counted = gathered.withColumn("first", F.col("phrase")[0]).join(langs, "first").select("phrase", "a", F.col("total").alias("n"), "cuts")
    scored = counted.mapInPandas(_least_cut, SCORED)
    spelt = scored.select("*", F.posexplode("phrase").alias("at", "id")).join(vocabulary.select("id", "word", "lang"), "id")
    spelt = spelt.groupBy("phrase", "a", "l", "r", "n", "score", "lang").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda one: one["word"]), " ").alias("words")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "words")
    placed = spelt.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return placed.select("lang", "rank", F.col("words").alias("phrase"), "a", "l", "r", "n", "score")
