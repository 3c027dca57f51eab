import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyloom.llm import alignment
from tallyloom.llm.common import stored
from tallyloom.llm.queries import op13_alignment

SF = "/root/testdata/sf0.01"
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_OF = {chr(b): b for b in SHOWN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in SHOWN)}


def spans(ids, tokens, spelt):
    if b"".join(tokens) != spelt:
        return None
    out, at = [], 0
    for one, token in zip(ids, tokens):
        out.append((one, at, at + len(token)))
        at += len(token)
    return out


def slow_tokens(text):
    """(id, start, end) of A's and B's tokens, or None."""
    if not text:
        return None
    encoded, spelt = A.encode(" " + text, add_special_tokens=False), (" " + text).encode()
    pieces = [(k, bytes([int(p[3:5], 16)]) if B.is_byte(k) else p.replace("▁", " ").encode()) for k in B.encode(text) for p in [B.id_to_piece(k)]]
    both = spans(encoded.ids, [bytes(BYTE_OF[c] for c in t) for t in encoded.tokens], spelt), spans([k for k, _ in pieces], [p for _, p in pieces], spelt)
    return None if None in both else both


def slow_groups(a, b):
    ends, out, low = sorted({e for _, _, e in a} & {e for _, _, e in b}), [], 0
    for high in ends:
        out.append("|".join(",".join(str(k) for k, _, e in side if low < e <= high) for side in (a, b)))
        low = high
    return out


def slow_links(a, b):
    return [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]


def slow_rows(rows):
    tokens = [(doc_id, slow_tokens(text)) for doc_id, text in rows]
    links = [slow_links(*both) if both else [] for _, both in tokens]
    holds = Counter(pair for own in links for pair in set(own))
    best = defaultdict(int)
    for (x, _), n in holds.items():
        best[x] = max(best[x], n)
    out = []
    for (doc_id, both), own in zip(tokens, links):
        a, b = both or ([], [])
        groups = slow_groups(a, b)
        out.append((doc_id, len(a), len(b), len(groups), len(own), sum(holds[p] == best[p[0]] for p in own), sum(holds[p] for p in own),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def run(spark, frame, chunk_bytes=alignment.CHUNK_BYTES, most_pairs=alignment.MOST_PAIRS):
    aligned = alignment.align(frame, A_PATH, B_PATH, chunk_bytes=chunk_bytes)
    kept = stored(aligned.withColumn("groups", alignment.digest(F.col("groups"))), "test-aligned")
    counted = alignment.with_counts(kept, *alignment.vocabulary_sizes(spark, A_PATH, B_PATH), most_pairs=most_pairs)
    return sorted((tuple(r) for r in counted.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups").collect()), key=key)


def test_small_table_against_every_pair_of_spans(spark):
    rows = [(r.doc_id, r.text[:1500]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    rng = random.Random(5)
    rows += [(1000 + k, "".join(rng.choices("ab é漢😀\n\t ▁'1. ", k=rng.randint(0, 30)))) for k in range(80)]
    rows += [(5, None), (5, ""), (None, "über the the"), (7, "same text"), (7, "same text"), (8, " lead"), (9, "trail "), (10, "a  b"),
             (11, "<|endoftext|> <s> <unk> <0x41>"), (12, "ｆ ①"), (13, "x\0y z"), (14, "▁"), (15, "a b▁c d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    frame = frame.withColumns({n: F.lit("old") for n in ("n_a", "pairs", "times", "row", "chunk", "groups")})
    wanted = sorted(slow_rows(rows), key=key)
    assert sum(row[1] == 0 for row in wanted) >= 4
    assert run(spark, frame) == wanted
    assert run(spark, frame, chunk_bytes=40, most_pairs=0) == wanted  # texts in chunks, counts joined
    assert run(spark, frame.limit(0)) == []


def test_whole_table_equals_the_libraries(spark):
    """Counts of tokens, groups and links and the groups' digest; the number of links follows from tokens and groups."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op13_alignment(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        both, r = slow_tokens(text), got[doc_id]
        if both is None:
            assert (r.n_a, r.n_b, r.n_links, r.groups_sha256) == (0, 0, 0, "")
            continue
        a, b = both
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        sides = [np.split([k for k, _, _ in side], np.searchsorted([e for _, _, e in side], ends, "right"))[: len(ends)] for side in both]
        groups = ";".join("|".join(",".join(map(str, one.tolist())) for one in pair) for pair in zip(*sides))
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(a), len(b), len(ends), len(a) + len(b) - len(ends))
        assert r.groups_sha256 == hashlib.sha256(groups.encode()).hexdigest()
        assert 0 < r.n_best <= r.n_links <= r.count_sum


def test_fragments_are_a_monoid():
    aligner, rng = alignment.Aligner(50, 40), random.Random(3)
    for _ in range(200):
        total = rng.randint(1, 60)
        ends = [sorted({total, *rng.sample(range(1, total + 1), rng.randint(0, total - 1))}) for _ in range(2)]
        tokens = alignment.Open(*(np.array(x, dtype=np.int64) for e, most in zip(ends, (50, 40)) for x in ([rng.randrange(most) for _ in e], e)))
        whole = aligner.closed(tokens)
        cuts = [-1, *sorted(rng.sample(range(1, total + 1), rng.randint(0, min(total, 6)))), total]
        parts = [aligner.fragment(tokens.between(*pair)) for pair in zip(cuts, cuts[1:])]
        assert aligner.finished(reduce(aligner.compose, parts)) == whole
        assert aligner.finished(reduce(lambda y, x: aligner.compose(x, y), reversed(parts))) == whole
        assert aligner.finished(aligner.compose(alignment.Fragment(), aligner.compose(reduce(aligner.compose, parts), alignment.Fragment()))) == whole


def test_a_very_long_text_is_aligned_in_chunks(spark):
    rng = random.Random(9)
    text = " ".join(rng.choices(["alpha", "Übergrößen", "12345", "漢字", "x\ny", "end."], k=30_000))
    frame = spark.createDataFrame([(1, text), (2, "short one")], "doc_id long, text string")
    assert len(text.encode()) > 3 * alignment.CHUNK_BYTES
    assert run(spark, frame) == run(spark, frame, chunk_bytes=1 << 30)
    assert run(spark, frame)[0][1] == len(A.encode(" " + text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", ["a", "naïve naïve", "don't 12,5 %", "emoji 😀😀 x", "tab\tx", "line\nline two\n"])
def test_parts_give_what_the_whole_gives(text):
    both = alignment.pair(A_PATH, B_PATH)
    assert both.b.separable
    assert both.aligned(pa.array([text]))[0] == (both.whole(text) or alignment.Closed())
