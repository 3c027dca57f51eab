"""Texts cut at single spaces, where tokenizers cut too, and what a worker remembers of the parts."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A space between two visible characters always begins a new piece, so texts can be cut there.
CUT = re.compile(r"(?<=\S)(?= \S)")
MADE_AT_ONCE = 1 << 14  # new keys
ENTRY = 200  # bytes of a dictionary entry beside its text and its value


class Kept:
    """Values by key in two generations of together at most ``most_bytes``.

    When the newer generation is full it becomes the older one, whose forerunner goes. A key
    that is asked for again moves to the newer one, so what is frequent stays. Values of new keys
    are made for ``MADE_AT_ONCE`` keys at a time, so the work on them is bounded as well.
    """

    def __init__(self, most_bytes: int) -> None:
        self.most, self.size = most_bytes // 2, 0
        self.now: dict = {}
        self.old: dict = {}

    def values(self, lists: list[list[str]], make: Callable[[list[str]], Iterable], weight: Callable = len) -> list[list]:
        """For each list of keys the list of their values; ``make`` gives those of new keys."""
        now, old = self.now, self.old
        got = [list(map(now.get, keys)) for keys in lists]
        gaps = [[at for at, value in enumerate(found) if value is None] if None in found else () for found in got]
        missing = list(dict.fromkeys(keys[at] for keys, places in zip(lists, gaps) for at in places))
        if missing:
            known = list(map(old.get, missing))
            new, made = [key for key, value in zip(missing, known) if value is None], []
            for at in range(0, len(new), MADE_AT_ONCE):
                made += make(new[at : at + MADE_AT_ONCE])
            fresh = iter(made)
            again = dict(zip(missing, (next(fresh) if value is None else value for value in known)))
            now.update(again)
            self.size += sum(map(len, again)) + sum(map(weight, again.values())) + ENTRY * len(again)
            for keys, found, places in zip(lists, got, gaps):
                for at in places:
                    found[at] = again[keys[at]]
        if self.size > self.most:
            self.now, self.old, self.size = {}, now, 0
        return got


def plain(part: str) -> bool:
    """Whether both neighbours of the spaces around a part are visible."""
    return bool(part) and not part[0].isspace() and not part[-1].isspace()


class Words:
    """Looks texts up part by part; parts met before are not encoded again.

    ``encode`` gives a value for each of many strings: never an empty one for a string that is
    not empty. The values of the parts of a text, in order, make up that of the text. Texts are
    cut and their parts numbered by Arrow, so Python sees each distinct part of a batch once.
    """

    firsts_differ = True  # a text's first part is no part that follows a space
    before = " "  # what belongs to a part that follows a space

    def __init__(self, encode: Callable[[list[str]], list], most_bytes: int = 64 << 20, weight: Callable = len) -> None:
        self.encode, self.kept, self.weight = encode, Kept(most_bytes), weight

    def string(self, key: str) -> str | None:
        """What a key stands for. Two spaces mark any string, one a text's first part; other keys are parts without
        the space before them, and stand for nothing if that space has no visible neighbour."""
        if key[:2] == "  ":
            return key[2:]
        if key[:1] == " ":
            return key[1:] if len(key) > 1 and not key[-1].isspace() else None
        return " " + key if plain(key) else None

    def keys(self, text: str) -> list[str]:
        """Keys of a text some of whose spaces have no visible neighbour: it is cut at the others."""
        first, *others = CUT.split(text)
        return ["  " + first, *(part[1:] if " " not in part[1:] and plain(part[1:]) else "  " + part for part in others)]

    def _make(self, keys: list[str]) -> list:
        strings = [self.before + key if key and key.strip() == key else self.string(key) for key in keys]
        made = iter(self.encode([string for string in strings if string is not None]))
        return [b"" if string is None else next(made) for string in strings]

    def parts(self, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """Values, the number of the value of each part of each text, and where the parts of each text begin and end."""
        lists = pc.split_pattern(texts, " ")
        bounds, coded = lists.offsets.to_numpy().astype(np.int64), lists.flatten().dictionary_encode()
        keys, at = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        if self.firsts_differ:
            names = [" " + keys[k] for k in at[bounds[:-1]].tolist()]
            numbers = {name: len(keys) + k for k, name in enumerate(dict.fromkeys(names))}
            at[bounds[:-1]] = [numbers[name] for name in names]
            keys += numbers
        values = self.kept.values([keys], self._make, self.weight)[0]
        odd = ()
        if b"" in values and len(texts):
            unusable = np.fromiter((value == b"" for value in values), bool, len(values))
            odd = np.flatnonzero(np.logical_or.reduceat(unusable[at], bounds[:-1]))
        if len(odd):
            pieces = np.split(at, bounds[1:-1])
            found = self.kept.values([self.keys(texts[k].as_py()) for k in odd.tolist()], self._make, self.weight)
            values = list(values)
            for k, own in zip(odd.tolist(), found):
                pieces[k] = np.arange(len(values), len(values) + len(own))
                values += own
            at, bounds = np.concatenate(pieces), np.cumsum([0, *map(len, pieces)])
        return values, at, bounds

    def of(self, texts: pa.Array) -> list[bytes]:
        """The joined values of each text."""
        return joined(*self.parts(texts)) if len(texts) else []


def joined(values: list[bytes], at: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """For each text the bytes of its parts' values."""
    taken = pa.array(values, pa.large_binary()).take(pa.array(at))
    ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :][bounds].tolist()
    data = memoryview(taken.buffers()[2]) if taken.buffers()[2] else b""
    return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]
