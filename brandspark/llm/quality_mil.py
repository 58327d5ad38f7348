"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of 64 words.  Every passage is encoded (byte
class bigrams, hashed words, share of repeated eight-word windows, word length;
one learned tanh layer), gated attention learned from document labels weighs
the encodings, and a logistic layer scores the weighted sum.

The model alone is fitted on a bounded sample of labelled rows: at most
``per_label`` documents of each label, whole ones of at most ``longest`` passages
(longer ones are not in the sample).  Scoring reads every passage of every document in one pass without a shuffle.

Edge cases: a null or empty text is a bag of one empty passage and gets a score;
of rows of one doc_id one is in the sample, a doc_id with both labels counts for each;
repeated rows score alike; labels that are null or neither 0 nor 1 are not
learned from; without labels every score is 0.5; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read
from .quality_rules import _repeated
from .textcore import BYTE_KEY_LOWER, slices, span_hash, text_bytes, windows, words

PASSAGE = 64
WORD_BUCKETS = 256

#: Classes of bytes: lower case, upper case, digit, space, newline, beyond ASCII, other control, and each sign its own.
_SIGNS = b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"""
_CLASS = np.full(256, 6, dtype=np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[10], _CLASS[128:] = 0, 1, 2, 3, 4, 5
_CLASS[list(_SIGNS)] = 7 + np.arange(len(_SIGNS))
CLASSES = 7 + len(_SIGNS)
#: Pairs of classes, hashed to fewer cells.
PAIRS = 384
_PAIR = (np.arange(CLASSES * CLASSES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % PAIRS
WIDTH = PAIRS + WORD_BUCKETS + 3
#: Steps of the training at least, also where a table has few documents.
STEPS = 600


def passages(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first passage of each row, features of each passage); every row has at least one passage."""
    rows = len(offsets) - 1
    w = words(raw, offsets)
    n = np.bincount(w.row, minlength=rows)
    count = np.maximum(1, -(-n // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    total = int(first[-1])
    before = np.cumsum(n) - n
    of_word = first[w.row] + (np.arange(len(w.row)) - before[w.row]) // PASSAGE
    x = np.zeros((total, WIDTH), dtype=np.float32)
    if not len(w.row):
        return first, x
    begin = w.start
    of_byte = np.repeat(of_word, np.diff(np.append(begin, len(raw))))  # a gap goes with the word before it
    c = _CLASS[raw[begin[0] :]]
    pair = _PAIR[c[:-1] * CLASSES + c[1:]]
    x[:, :PAIRS] = np.bincount(of_byte[:-1] * PAIRS + pair, minlength=total * PAIRS).reshape(total, PAIRS)
    bucket = (span_hash(raw, w.start, w.end, BYTE_KEY_LOWER) % np.uint64(WORD_BUCKETS)).astype(np.int64)
    x[:, PAIRS:-3] = np.bincount(of_word * WORD_BUCKETS + bucket, minlength=total * WORD_BUCKETS).reshape(total, WORD_BUCKETS)
    size = np.maximum(np.bincount(of_word, minlength=total), 1)
    x[:, :PAIRS] = np.sqrt(x[:, :PAIRS] / np.maximum(x[:, :PAIRS].sum(1, keepdims=True), 1))
    x[:, PAIRS:-3] = np.sqrt(x[:, PAIRS:-3] / size[:, None])
    exact = span_hash(raw, w.start, w.end)
    key, at = windows(exact, w.row, 8)
    marks = np.zeros(len(exact) + 1, dtype=np.int64)
    begins = at[_repeated(key, w.row[at])]
    np.add.at(marks, begins, 1)
    np.add.at(marks, begins + 8, -1)
    x[:, -3] = np.bincount(of_word[np.cumsum(marks)[:-1] > 0], minlength=total) / size
    x[:, -2] = np.bincount(of_word, w.end - w.start, minlength=total) / size / 10
    x[:, -1] = size / PASSAGE
    return first, x


@dataclass
class Model:
    encode: np.ndarray
    bias: np.ndarray
    gate_v: np.ndarray
    gate_u: np.ndarray
    attend: np.ndarray
    out: np.ndarray

    def forward(self, first: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
        starts, rows = first[:-1], np.repeat(np.arange(len(first) - 1), np.diff(first))
        h = np.tanh(x @ self.encode + self.bias)
        v, u = np.tanh(h @ self.gate_v), 1 / (1 + np.exp(-(h @ self.gate_u)))
        e = (v * u) @ self.attend
        e = np.exp(e - np.maximum.reduceat(e, starts)[rows])
        a = e / np.add.reduceat(e, starts)[rows]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ self.out[:-1] + self.out[-1], -30, 30)))
        return p, a, z, h, v, u, rows


def train(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gate: int = 12, epochs: int = 25, seed: int = 5) -> Model:
    """Adam on the log loss of documents; both labels weigh the same."""
    rng = np.random.default_rng(seed)
    normal = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    m = Model(normal(WIDTH, hidden) * 2, np.zeros(hidden, np.float32), normal(hidden, gate), normal(hidden, gate), normal(gate), np.append(normal(hidden), np.float32(0)))
    if not len(bags) or labels.min() == labels.max():
        m.out[:] = 0
        m.out[-1] = 0 if not len(bags) else (3 if labels[0] else -3)
        return m
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    names = ("encode", "bias", "gate_v", "gate_u", "attend", "out")
    state = {k: (np.zeros_like(getattr(m, k)), np.zeros_like(getattr(m, k))) for k in names}
    step, steps = 0, max(STEPS, epochs * -(-len(bags) // 64))
    while step < steps:
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            some = order[at : at + 64]
            first = np.concatenate([[0], np.cumsum([len(bags[k]) for k in some])])
            x = np.concatenate([bags[k] for k in some]).astype(np.float32)
            p, a, z, h, v, u, rows = m.forward(first, x)
            d = (weight[some] * (p - labels[some]) / len(some)).astype(np.float32)
            g_out = np.append(z.T @ d, d.sum())
            dz = (d[:, None] * m.out[:-1])[rows]
            da = (dz * h).sum(1)
            de = a * (da - np.add.reduceat(a * da, first[:-1])[rows])
            vu = v * u
            dv, du = de[:, None] * m.attend * u * (1 - v * v), de[:, None] * m.attend * v * u * (1 - u)
            dh = (a[:, None] * dz + dv @ m.gate_v.T + du @ m.gate_u.T) * (1 - h * h)
            grads = (x.T @ dh + 1e-4 * m.encode, dh.sum(0), h.T @ dv, h.T @ du, vu.T @ de, g_out)
            step += 1
            rate = 0.01 * 0.5 ** (2.5 * step / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, g in zip(names, grads, strict=True):
                s1, s2 = state[k]
                s1 += 0.1 * (g - s1)
                s2 += 0.001 * (g * g - s2)
                setattr(m, k, (getattr(m, k) - rate * s1 / (np.sqrt(s2) + 1e-8)).astype(np.float32))
    return m


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1200, longest: int = 320) -> Model:
    """Learn from ``labels`` (doc_id, quality), never from rows that are held out."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    some = lambda q: usable.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
    rows = some(0).unionByName(some(1)).collect()
    keys = docs.sparkSession.createDataFrame([tuple(r) for r in rows], "doc_id long, quality int")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            first, x = passages(*text_bytes(batch.column(2)))
            use = np.flatnonzero(np.diff(first) <= longest)
            bags = [x[first[k] : first[k + 1]].astype(np.float16).tobytes() for k in use]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(use)), batch.column(1).take(pa.array(use)), pa.array(bags, pa.binary())], names=["doc_id", "quality", "bag"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(keys), "doc_id").select("doc_id", "quality", "text")
    one = texts.mapInArrow(encode, "doc_id long, quality int, bag binary").groupBy("doc_id", "quality").agg(F.min("bag").alias("bag"))
    got = sorted((r["doc_id"], r["quality"], bytes(r["bag"])) for r in one.toLocalIterator())
    bags = [np.frombuffer(b, dtype=np.float16).reshape(-1, WIDTH) for _, _, b in got]
    return train(bags, np.array([q for _, q, _ in got], dtype=np.float32))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, n_passages) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            first, x = passages(*text_bytes(batch.column(1)))
            p = model.forward(first, x)[0].astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array(np.diff(first))], names=["doc_id", "score", "n_passages"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, n_passages long")


def query(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_passages",
    )
