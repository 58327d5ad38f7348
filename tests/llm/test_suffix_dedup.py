import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from brandspark.llm import suffix_dedup as sd
from brandspark.llm.common import read


def brute(rows, width=sd.WIDTH):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + width] for _, b in data for k in range(len(b) - width + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - width + 1):
            if seen[b[k : k + width]] > 1:
                gone[k : k + width] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(docs):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in sd.suffix_dedup(docs).collect())


def test_documents_equal_brute_force(spark, sf):
    docs = read(spark, sf, "documents").limit(120)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("group", [2, 256])
def test_hot_groups_equal_brute_force(spark, group, monkeypatch):
    monkeypatch.setattr(sd, "GROUP", group)
    rng = random.Random(group)
    word = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage = word(420)
    rows = []
    for k in range(50):
        a, z = rng.randint(0, 120), rng.randint(300, 420)
        rows.append((k, word(rng.randint(0, 90)) + passage[a:z] + word(rng.randint(0, 150))))
    rows += [(100 + k, passage) for k in range(5)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int")
    assert run(docs) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a" * 199), (4, "z" * 5000), (5, "ab" * 150), (6, "x" * 200), (7, "é" * 250), (8, "q" * 201)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert run(docs) == brute(rows)
    twice = spark.createDataFrame([(1, "unique " + "".join(map(str, range(120))))] * 2, "doc_id long, text string")
    assert [r.n_removed for r in sd.suffix_dedup(twice).collect()] == [257, 257]
    assert sd.suffix_dedup(docs.limit(0)).count() == 0


def test_common_prefixes_by_increasing_value():
    rng = np.random.default_rng(0)
    for least in (1, 2, 3, 5, 8):
        symbols = rng.integers(1, 4, 300).astype(np.int32)  # 0 stands for a separator, which no window holds
        symbols[-1] = 0
        order = sd.suffix_array(symbols, least + 1)
        text = symbols.tolist()
        share = sd.common_prefixes(symbols, order, least)
        for i in range(1, len(text)):
            a, b = text[order[i - 1] :][:least], text[order[i] :][:least]
            assert share[i] == (a == b and len(a) == least), (least, i)


def test_suffix_array_orders_by_its_first_symbols():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 700):
        symbols = rng.integers(0, 3, n).astype(np.uint16)
        symbols[n // 2 :] = symbols[: n - n // 2]
        text = symbols.tolist()
        order = sd.suffix_array(symbols, 40).tolist()
        assert sorted(order) == list(range(n))
        heads = [text[k : k + 40] for k in order]
        assert heads == sorted(heads)


def test_segments_cover_every_window_once():
    rng = np.random.default_rng(2)
    sizes = [0, 199, 200, 3, 2 * sd.STRIDE + 77, 201, 0, 650]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    raw = rng.integers(97, 101, int(offsets[-1])).astype(np.uint8)
    raw[offsets[7] :][:600] = raw[1000:1600]  # also in another row
    with np.errstate(over="ignore"):
        s = sd.Segments(raw, offsets)
        windows = [(r, k) for r, a, z in zip(s.row, s.first, s.last, strict=True) for k in range(a, z + 1)]
        assert windows == [(r, k) for r in range(len(sizes)) for k in range(offsets[r], offsets[r + 1] - sd.WIDTH + 1)]
        hashes = {}
        for r, a, z, at, h in zip(s.row, s.first, s.last, s.anchor, s.hash, strict=True):
            assert z <= at <= a + sd.SPAN - 1
            assert hashes.setdefault(raw[at : at + sd.KMER].tobytes(), h) == h
        place = {k: at - k for a, z, at in zip(s.first, s.last, s.anchor, strict=True) for k in range(a, z + 1)}
        for k in range(600 - sd.WIDTH + 1):  # equal windows have their anchor at the same place
            assert place[1000 + k] == place[int(offsets[7]) + k]
