"""Suffix order and common prefixes of one shard, by induced sorting with disk-backed queues."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

END, GAP, FIRST = 0, 1, 2  # symbols: end of the shard, gap between strings, then the 256 byte values
SYMBOLS = 258


class BucketQueue:
    """Monotone priority queue of suffix tuples (position, common prefix with the tuple before).

    The priority is the suffix's first symbol; equal priorities leave in the order they came,
    which is the order of the suffixes that induced them. Blocks beyond ``memory`` bytes go to
    a file without a name in the folder Spark gives its workers for spilling.
    """

    def __init__(self, memory: int) -> None:
        self.blocks: list[list] = [[] for _ in range(SYMBOLS)]
        self.memory, self.held, self.file = memory, 0, None
        self.any = np.zeros(SYMBOLS, dtype=bool)  # symbols that ever got a tuple
        self.spilled = 0

    def push(self, symbol: int, position: np.ndarray, prefix: np.ndarray) -> None:
        size = position.nbytes + prefix.nbytes
        if self.held + size > self.memory:
            if self.file is None:
                folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
                self.file = tempfile.TemporaryFile(dir=folder if folder and os.path.isdir(folder) else None)
            at = self.file.seek(0, os.SEEK_END)
            self.file.write(position.tobytes())
            self.file.write(prefix.tobytes())
            self.blocks[symbol].append((at, len(position)))
            self.spilled += size
        else:
            self.held += size
            self.blocks[symbol].append((position, prefix))
        self.any[symbol] = True

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All tuples of a symbol, or None."""
        blocks, self.blocks[symbol] = self.blocks[symbol], []
        if not blocks:
            return None
        out = []
        for first, second in blocks:
            if isinstance(first, int):
                self.file.seek(first)
                out.append((np.frombuffer(self.file.read(8 * second), np.int64), np.frombuffer(self.file.read(second), np.uint8)))
            else:
                self.held -= first.nbytes + second.nbytes
                out.append((first, second))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low : high + 1]) for many ranges, by a table of powers of two."""
    width = high - low + 1
    level = np.frexp(width)[1] - 1
    out, table = np.empty(len(low), dtype=values.dtype), values
    for k in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k) + 1])
        half = 1 << k
        if half < len(table):
            table = np.minimum(table[: len(table) - half], table[half:])
    return out


class _Scan:
    """One pass over suffixes in (rising or falling) order: what each induces goes to the queue, with its common prefix."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, queue: BucketQueue, cap: int) -> None:
        self.text, self.wanted, self.queue, self.cap = text, wanted, queue, cap
        self.since = np.full(SYMBOLS, cap, dtype=np.uint8)  # least prefix scanned since the last push of a symbol

    def feed(self, position: np.ndarray, prefix: np.ndarray) -> None:
        before = position - 1
        at = np.flatnonzero((before >= 0) & self.wanted[before])
        lowest = prefix.min() if len(prefix) else self.cap
        if not len(at):
            self.since = np.minimum(self.since, lowest)
            return
        target = self.text[before[at]]
        order = np.argsort(target, kind="stable")
        at, target = at[order], target[order]
        first = np.concatenate(([True], target[1:] != target[:-1]))
        low = np.where(first, 0, np.concatenate(([0], at[:-1] + 1)))
        least = _range_minima(prefix, low, at)
        least = np.where(first, np.minimum(least, self.since[target]), least)
        own = np.minimum(least.astype(np.int16) + 1, self.cap).astype(np.uint8)
        starts = np.flatnonzero(first)
        new = ~self.queue.any[target[starts]]
        own[starts[new]] = 0  # the first of a bucket shares nothing with the bucket before
        self.since = np.minimum(self.since, lowest)
        ends = np.concatenate((starts[1:], [len(at)]))
        tail = at[ends - 1] + 1
        after = np.full(len(ends), self.cap, dtype=np.uint8)
        some = tail < len(prefix)
        after[some] = _range_minima(prefix, tail[some], np.full(some.sum(), len(prefix) - 1))
        self.since[target[starts]] = after
        moved = before[at]
        for a, b in zip(starts.tolist(), ends.tolist()):
            self.queue.push(int(target[a]), moved[a:b], own[a:b])


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is less than the one behind it (S), False where it is greater (L)."""
    step = np.sign(np.diff(text.astype(np.int32)))
    where = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(where[::-1])[::-1]
    return np.append(np.append(step, -1)[following] > 0, True)


def run_lengths(text: np.ndarray, cap: int) -> np.ndarray:
    """Length of the run of equal symbols that starts at each position, at most ``cap``."""
    changes = np.append(np.flatnonzero(np.diff(text)), len(text) - 1)
    return np.minimum(changes[np.searchsorted(changes, np.arange(len(text)))] - np.arange(len(text)) + 1, cap).astype(np.uint8)


def induce(text: np.ndarray, types: np.ndarray, runs: np.ndarray, seeds: np.ndarray, shared: np.ndarray, cap: int, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Order of all suffixes from that of the leftmost S-suffixes (``seeds``, with prefixes ``shared``).

    Yields (positions, prefixes with the next greater suffix) from the greatest suffix down.
    """
    symbols, bounds = text[seeds], np.searchsorted(text[seeds], np.arange(SYMBOLS + 1))
    queue = BucketQueue(memory)
    scan, larger = _Scan(text, ~types, queue, cap), BucketQueue(memory)
    for symbol in range(SYMBOLS):
        last = None
        while (batch := queue.pop(symbol)) is not None:
            larger.push(symbol, *batch)
            scan.feed(*batch)
            last = batch[0][-1]
        low, high = bounds[symbol], bounds[symbol + 1]
        if low < high:
            own = shared[low:high].copy()
            own[0] = 0 if last is None else min(runs[last], runs[seeds[low]])
            scan.feed(seeds[low:high], own)
    queue.close()
    queue = BucketQueue(memory)
    scan = _Scan(text, types, queue, cap)
    for symbol in range(SYMBOLS - 1, -1, -1):
        last = None
        while (batch := queue.pop(symbol)) is not None:
            yield batch
            scan.feed(*batch)
            last = batch[0][-1]
        if (batch := larger.pop(symbol)) is not None:
            position, prefix = batch[0][::-1], batch[1][::-1]
            own = np.empty_like(prefix)
            own[1:] = prefix[:-1]
            own[0] = 0 if last is None else min(runs[last], runs[position[0]])
            yield position, own
            scan.feed(position, own)
    queue.close()
    larger.close()


def _order_of_names(names: np.ndarray) -> np.ndarray:
    """Suffix order of the reduced string: ranks of doubled length until all differ."""
    rank, width = names.astype(np.int64), 1
    while True:
        following = np.zeros_like(rank)
        following[:-width or None] = rank[width:] + 1 if width < len(rank) else 0
        key = rank * (len(rank) + 2) + following
        order = np.argsort(key, kind="stable")
        new = np.empty_like(rank)
        new[order] = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank, width = new, 2 * width
        if rank[order[-1]] == len(rank) - 1 or width >= len(rank):
            return order


def _common(words: np.ndarray, left: np.ndarray, right: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of suffix pairs, at most ``cap`` symbols, four symbols a step."""
    out, active = np.full(len(left), cap, dtype=np.int64), np.arange(len(left))
    for at in range(0, cap, 4):
        a, b = left[active] + at, right[active] + at
        inside = (a < len(words)) & (b < len(words))
        differ = np.where(inside, words[np.minimum(a, len(words) - 1)] ^ words[np.minimum(b, len(words) - 1)], np.uint64(1))
        stop = differ != 0
        lanes = sum(((differ[stop] & np.uint64((1 << 16 * k) - 1)) == 0).astype(np.int64) for k in (1, 2, 3))
        out[active[stop]] = np.minimum(at + lanes, cap)
        active = active[~stop]
        if not len(active):
            break
    return out


def sorted_suffixes(strings: list[bytes], cap: int, memory: int = 64 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of the strings, joined with gaps, from the greatest down: (position, prefix with the next greater).

    Prefixes are cut at ``cap``, at most 254. Suffixes run on over gaps, so a prefix counts only
    as far as both strings reach. First the leftmost S-suffixes are put in order (an induction
    over unsorted seeds sorts their substrings, equal ones share a name, the reduced string of
    names is ordered), then a second induction carries order and prefixes to all suffixes.
    """
    raw = np.frombuffer(b"\0".join(strings), dtype=np.uint8)
    text = raw.astype(np.uint16) + np.uint16(FIRST)
    text[np.cumsum([len(s) + 1 for s in strings])[:-1] - 1] = GAP
    text = np.append(text, np.uint16(END))
    types, runs = suffix_types(text), run_lengths(text, cap)
    leftmost = np.zeros(len(text), dtype=bool)
    leftmost[1:] = types[1:] & ~types[:-1]
    seeds = np.flatnonzero(leftmost)
    seeds = seeds[np.argsort(text[seeds], kind="stable")]
    rough = [batch[leftmost[batch]] for batch, _ in induce(text, types, runs, seeds, np.zeros(len(seeds), np.uint8), cap, memory)]
    rough = np.concatenate([*rough, [len(text) - 1]])[::-1]  # the end of the shard is the least of all
    stops = np.append(np.flatnonzero(leftmost), len(text) - 1)
    length = stops[np.minimum(np.searchsorted(stops, rough, side="right"), len(stops) - 1)] - rough + 1
    padded = np.concatenate((text, np.zeros(4, dtype=np.uint16))).astype(np.uint64)
    words = padded[:-4] | padded[1:-3] << np.uint64(16) | padded[2:-2] << np.uint64(32) | padded[3:-1] << np.uint64(48)
    same = length[1:] == length[:-1]
    pair = np.flatnonzero(same)
    longest = int(length.max(initial=1))
    same[pair] = _common(words, rough[pair], rough[pair + 1], longest) >= length[pair]
    name = np.empty(len(text), dtype=np.int32)
    name[rough] = np.concatenate(([0], np.cumsum(~same)))
    places = np.flatnonzero(leftmost)
    seeds = places[_order_of_names(name[places])]
    shared = np.zeros(len(seeds), dtype=np.uint8)
    shared[1:] = _common(words, seeds[:-1], seeds[1:], cap)
    yield from induce(text, types, runs, seeds, shared, cap, memory)
