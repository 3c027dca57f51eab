"""Texts to ids by the tokenizers library, part by part."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyloom.llm.words import ENTRY, MADE_AT_ONCE, Kept, Words

PARTS_AT_ONCE = 1024
PARTS_IN_STRING = 128  # for longer strings the library takes new pages from the system each time


def byte_of_character() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: printable ones as themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(byte): byte for byte in shown} | {chr(256 + k): byte for k, byte in enumerate(hidden)}


class Spelt(Kept):
    """Ids of parts: those met again in a dictionary, all packed in arrays (sorted hashes, places, ids) of two generations.

    A packed part takes an eighth of the memory of a dictionary's entry. Ids spell their part, so
    what the hashes find is checked against the parts' own bytes; should two hashes ever agree, these
    parts are encoded again. The dictionary and each generation get a third of the memory.
    """

    def __init__(self, most_bytes: int, tokens: list[bytes], kind: np.dtype) -> None:
        super().__init__(most_bytes)
        self.most = most_bytes // 3
        self.tokens, self.kind = pa.array(tokens, pa.large_binary()), kind
        self.none = (np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.uint32), np.zeros(0, kind))
        self.packed, self.fresh = [self.none, self.none], []

    def values(self, lists: list[list[str]], make: Callable[[list[str]], Iterable], weight: Callable = len) -> list[list]:
        got = []
        for keys in lists:
            found = list(map(self.now.get, keys))
            places = [at for at, value in enumerate(found) if value is None]
            for at in range(0, len(places), MADE_AT_ONCE):
                some = places[at : at + MADE_AT_ONCE]
                missing = [keys[k] for k in some]
                values, again = self._found(missing, make)
                for k, value in zip(some, values):
                    found[k] = value
                known = [missing[k] for k in again]
                self.now.update(zip(known, [values[k] for k in again]))
                self.size += sum(map(len, known)) + sum(weight(values[k]) for k in again) + ENTRY * len(again)
                if self.size > self.most:  # all are packed as well
                    self.now, self.size = {}, 0
            self._pack()
            got.append(found)
        return got

    def _found(self, keys: list[str], make: Callable[[list[str]], Iterable]) -> tuple[list[bytes], list[int]]:
        """Values of keys, and which of them were packed already or can't be."""
        found: list = [None] * len(keys)
        hashes, left = np.fromiter(map(hash, keys), np.int64, len(keys)), np.arange(len(keys))
        for number, (known, starts, sizes, ids) in enumerate(self.packed):
            if len(known) and len(left):
                by = left[np.argsort(hashes[left])]
                at = np.minimum(np.searchsorted(known, hashes[by]), len(known) - 1)
                same = known[at] == hashes[by]
                by, at = by[same], at[same]
                if len(by):
                    ends = np.cumsum(sizes[at], dtype=np.int64)
                    picked = ids[np.repeat(starts[at] - np.append(0, ends[:-1]), sizes[at]) + np.arange(ends[-1])]
                    held, places, start = picked.tobytes(), by.tolist(), 0
                    spelt = self.tokens.take(pa.array(picked)).buffers()[2].to_pybytes()
                    if spelt == "".join([" " + keys[k] for k in places]).encode():  # only a part's first character is a space
                        for k, end in zip(places, (ends * self.kind.itemsize).tolist()):
                            found[k], start = held[start:end], end
                        missed = np.ones(len(keys), dtype=bool)
                        missed[by] = False
                        left = left[missed[left]]
            if not number:
                older = left
        new = left.tolist()
        if new:
            for k, value in zip(new, make([keys[k] for k in new])):
                found[k] = value
        fresh = [k for k in older.tolist() if found[k] and " " not in keys[k] and keys[k].strip() == keys[k]]
        self.fresh.append((hashes[fresh], [found[k] for k in fresh]))
        first = np.zeros(len(keys), dtype=bool)
        first[new] = True
        again = ~first
        first[fresh] = False
        return found, np.flatnonzero(again | first).tolist()

    def _pack(self) -> None:
        """Move what is fresh to the newer generation; a full one becomes the older."""
        own, (known, starts, sizes, ids) = list(chain.from_iterable(values for _, values in self.fresh)), self.packed[0]
        if not own:
            return
        lengths = np.fromiter(map(len, own), np.int64, len(own)) // self.kind.itemsize
        hashes = np.concatenate([known, *(one for one, _ in self.fresh)])
        starts = np.concatenate([starts, (len(ids) + np.cumsum(lengths) - lengths).astype(np.uint32)])
        sizes = np.concatenate([sizes, lengths.astype(np.uint32)])
        by_hash = len(known) + np.argsort(hashes[len(known) :])
        order = np.append(np.arange(len(known)), by_hash)
        order = order[np.argsort(hashes[order], kind="stable")]  # two runs to merge
        newer = hashes[order], starts[order], sizes[order], np.concatenate([ids, np.frombuffer(b"".join(own), self.kind)])
        self.packed = [self.none, newer] if sum(one.nbytes for one in newer) > self.most else [newer, self.packed[1]]
        self.fresh = []


class Library:
    """A byte-level BPE of the tokenizers library; strings of special tokens in a text are plain text.

    Its pattern cuts before each space between visible characters, so new parts that begin and
    end there are encoded as one long string and cut again by the bytes of their tokens.
    """

    def __init__(self, path: str, kept_bytes: int = 96 << 20) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size, byte_of = self.tokenizer.get_vocab_size(with_added_tokens=True), byte_of_character()
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        written = (self.tokenizer.id_to_token(k) or "" for k in range(size))
        self.tokens = [bytes(map(byte_of.__getitem__, token)) if all(c in byte_of for c in token) else token.encode() for token in written]
        self.sizes = np.array(list(map(len, self.tokens)))
        self.kept_bytes = kept_bytes
        self.forget()

    def forget(self) -> None:
        """Drop all parts that were kept."""
        self.words = Words(self.strings, self.kept_bytes)
        self.words.kept = Spelt(self.kept_bytes, self.tokens, self.kind)

    def ids(self, strings: list[str]) -> list[np.ndarray]:
        """Ids of whole strings, straight from the library."""
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(one.ids, dtype=self.kind) for one in found]

    def strings(self, strings: list[str]) -> list[bytes]:
        joined = [k for k, one in enumerate(strings) if one[:1] == " " and one.strip() == one[1:] != ""]
        alone = sorted(set(range(len(strings))).difference(joined)) if len(joined) < len(strings) else []
        packed: list[bytes] = [b""] * len(strings)
        for k, ids in zip(alone, self.ids([strings[k] for k in alone])):
            packed[k] = ids.tobytes()
        some, found = [strings[k] for k in joined] if alone else strings, []
        for at in range(0, len(some), PARTS_IN_STRING):
            found += self.ids(["".join(some[at : at + PARTS_IN_STRING])])
        ids = np.concatenate(found) if found else np.zeros(0, self.kind)
        ends = np.cumsum(pc.binary_length(pa.array(some, pa.large_string())).to_numpy())
        cuts = ((np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1) * self.kind.itemsize).tolist()
        held = ids.tobytes()
        for k, start, end in zip(joined, [0, *cuts], cuts):
            packed[k] = held[start:end]
        return packed

    def texts(self, texts: pa.Array) -> list[bytes]:
        """Packed ids (little-endian, of ``kind``) of each whole text."""
        return self.words.of(texts)


_LIBRARIES: dict[str, Library] = {}


def library(path: str) -> Library:
    """One encoder for all tasks of a worker process, with what it has learnt."""
    if path not in _LIBRARIES:
        _LIBRARIES.clear()
        _LIBRARIES[path] = Library(path)
    return _LIBRARIES[path]


def forget() -> None:
    """Drop what this worker's encoder has kept, once no text is left to encode; it stays loaded."""
    for one in _LIBRARIES.values():
        one.forget()
    pa.default_memory_pool().release_unused()
