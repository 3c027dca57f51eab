import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import induced, repeats
from tallyloom.llm.queries import op4_suffix_array_dedup


def plain_spans(rows: list[tuple[int, bytes]], length: int) -> dict[int, tuple[int, int, str]]:
    """The same by a dictionary of all windows: {doc_id: (removed, spans, kept sha256)}; ids must differ."""
    seen, out = set(), {}
    for doc_id, body in sorted(rows):
        hits = []
        for at in range(len(body) - length + 1):
            window = body[at : at + length]
            if window in seen:
                hits.append(at)
            seen.add(window)
        spans = repeats._spans(hits, [at + length for at in hits])
        edges = [0, *(edge for span in spans for edge in span), len(body)]
        kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
        out[doc_id] = (len(body) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    return out


def test_whole_table_against_all_windows(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    wanted, size = plain_spans(rows, 100), {d: len(b) for d, b in rows}
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in op4_suffix_array_dedup(spark, folder).collect()}
    assert got == wanted and any(r[0] for r in wanted.values())
    assert {r.doc_id: r.n_bytes for r in op4_suffix_array_dedup(spark, folder).collect()} == size


def frame_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def outcome(frame, length, **more):
    return {r.doc_id: (r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in repeats.remove_repeats(frame, length, **more).collect()}


@pytest.mark.parametrize("queue_bytes", [0, 1 << 26])
def test_planted_repeats(spark, queue_bytes, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 2000)
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    passage, texts = prose(60), []
    for n in range(60):
        text = prose(rng.randint(0, 120))
        if n % 3 == 0:
            text = text[: len(text) // 2] + passage[rng.randint(0, 40) :] + text[len(text) // 2 :]
        texts.append(text)
    texts += [texts[3], texts[3][:50] + "X" + texts[3][51:], "ab" * 400, "z" * 250, "z" * 99, "z" * 100, "ab" * 60, passage * 3]
    rows = [(n, t.encode()) for n, t in enumerate(texts)]
    assert outcome(frame_of(spark, texts), 100, queue_bytes=queue_bytes) == plain_spans(rows, 100)


def test_long_text_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BYTES_AT_ONCE", 700)
    rng = random.Random(8)
    text = "".join(rng.choices("abcdefgh ", k=4000))
    texts = [text, "x" + text[300:2500], text[1000:1200] + text[1000:1200]]
    assert outcome(frame_of(spark, texts), 100) == plain_spans([(n, t.encode()) for n, t in enumerate(texts)], 100)


def test_suffix_order_and_prefixes_equal_a_plain_sort():
    rng = random.Random(1)
    for trial in range(150):
        alphabet = bytes(rng.sample(range(256), rng.randint(1, 4)))
        strings = [bytes(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(rng.randint(1, 6))]
        text = [s for k, string in enumerate(strings) for s in ([induced.GAP] if k else []) + [b + induced.FIRST for b in string]] + [induced.END]
        got = [(int(p), int(c)) for ps, cs in induced.sorted_suffixes(strings, 20, 0 if trial % 2 else 1 << 20) for p, c in zip(ps, cs)]
        order = sorted(range(len(text) - 1), key=lambda i: text[i:], reverse=True)
        assert [p for p, _ in got] == order
        for (p, c), q in zip(got[1:], order):
            shared = next((k for k in range(len(text)) if k == 20 or max(p, q) + k >= len(text) or text[p + k] != text[q + k]))
            assert c == shared


def test_queue_spills_and_keeps_order():
    queue = induced.BucketQueue(20)
    for k in range(5):
        queue.push(7, np.arange(3) + 3 * k, np.full(3, k, np.uint8))
    position, prefix = queue.pop(7)
    assert queue.spilled and position.tolist() == list(range(15)) and prefix.tolist() == [k for k in range(5) for _ in range(3)]
    assert queue.pop(7) is None
    queue.close()


def test_nulls_repeats_and_clashing_columns(spark):
    body = "".join(random.Random(2).choices("abcdefg ", k=150))
    rows = [(1, body), (1, body), (2, None), (3, ""), (None, body), (0, "q" + body)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(3) for n in ("id", "mark", "body", "low", "anchor")})
    got = sorted((r.doc_id if r.doc_id is not None else 9, r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove_repeats(frame).collect())
    assert got == [(0, 151, 0, 0), (1, 150, 150, 1), (1, 150, 150, 1), (2, 0, 0, 0), (3, 0, 0, 0), (9, 150, 150, 1)]
    assert repeats.remove_repeats(frame.limit(0)).collect() == []
