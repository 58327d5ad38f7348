"""Quality rules by weak supervision.

Each rule votes good (+1), bad (-1) or abstains (0) on a document.  Expectation
maximisation over the table of distinct vote patterns (at most 3^rules rows,
whatever the corpus) estimates each rule's accuracy on good and on bad
documents; the posterior probability replaces all-must-pass filtering.

Plan: one scan with a vectorised pass, a checkpoint of the narrow features, a
map-side-combined count by pattern, and a broadcast of at most 3^rules rows.

Edge cases: a null or empty text has 0 in every count, is base_failed and not
kept; repeated rows are judged alike; other columns of the input are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .textcore import BYTE_KEY_LOWER, lines, slices, span_hash, text_bytes, windows, words

#: Function words of the four languages.
STOP_WORDS = (
    "the of and to a in is that for it as was with be by on not he this are or his from at which but have an had they you were "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "le la les de des et en un une du que qui dans pour par sur au est ce il ne pas plus avec "
    "el los las y del se por con una para su al lo como más o pero sus"
).split()

RULES = ("length", "symbols", "upper", "bangs", "repeats", "dup_lines", "stop_words", "word_length", "bare_words")
MIN_WORDS = 20

#: Bytes of letters; every byte of a character beyond ASCII counts as one.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

_FEATURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_stop long, n_upper long, n_bang long, n_bare long, votes string"
)


def _hash_words(items: list[str]) -> np.ndarray:
    raw, offsets = text_bytes(pa.array(items))
    return np.unique(span_hash(raw, offsets[:-1], offsets[1:], BYTE_KEY_LOWER))


def _repeated(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """True where the key occurs twice or more in its row."""
    order = np.lexsort((keys, row))
    same = (keys[order][1:] == keys[order][:-1]) & (row[order][1:] == row[order][:-1])
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _later_copies(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """True where an equal key stands earlier in the row."""
    order = np.lexsort((np.arange(len(keys)), keys, row))
    same = (keys[order][1:] == keys[order][:-1]) & (row[order][1:] == row[order][:-1])
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    return out


def _votes(n: dict[str, np.ndarray]) -> np.ndarray:
    w = np.maximum(n["n_words"], 1)
    good_bad = (
        (n["n_words"] >= 50, n["n_words"] < MIN_WORDS),
        (n["n_symbols"] * 50 < w, n["n_symbols"] * 5 > w),
        (n["n_upper"] * 5 < n["word_chars"], n["n_upper"] * 2 > n["word_chars"]),
        (n["n_bang"] * 20 < w, n["n_bang"] * 3 > w),
        (n["n_repeat_words"] * 20 < w, n["n_repeat_words"] * 5 > w),
        (n["n_dup_lines"] * 10 < np.maximum(n["n_lines"], 1), n["n_dup_lines"] * 10 > 3 * n["n_lines"]),
        (n["n_stop"] * 20 > w, n["n_stop"] * 100 < w),
        ((n["word_chars"] > 3 * w) & (n["word_chars"] < 9 * w), (n["word_chars"] < 2 * w) | (n["word_chars"] > 14 * w)),
        (n["n_bare"] * 20 < w, n["n_bare"] * 5 > w),
    )
    return np.stack([good.astype(np.int8) - (bad & ~good) for good, bad in good_bad], axis=1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stop = _hash_words(STOP_WORDS)
    symbol = np.zeros(256, dtype=bool)
    symbol[[ord(c) for c in "#*$%&|<>"]] = True
    for batch in slices(batches, "text"):
        raw, offsets = text_bytes(batch.column(1))
        size = batch.num_rows
        w = words(raw, offsets)
        hashes = span_hash(raw, w.start, w.end, BYTE_KEY_LOWER)
        exact = span_hash(raw, w.start, w.end)
        count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
        n = {"n_words": np.bincount(w.row, minlength=size)}
        covered = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        n["word_chars"] = np.bincount(w.row, covered[w.end] - covered[w.start], minlength=size).astype(np.int64)
        n["n_symbols"] = count(symbol[raw])
        n["n_upper"] = count((raw >= 65) & (raw <= 90))
        n["n_bang"] = count(raw == 33)
        letters = np.concatenate([[0], np.cumsum(_LETTER[raw])])
        n["n_bare"] = np.bincount(w.row[letters[w.end] == letters[w.start]], minlength=size)
        n["n_stop"] = np.bincount(w.row[np.isin(hashes, stop)], minlength=size)
        rows = lines(raw, offsets)
        has_word = np.searchsorted(w.start, rows.end) > np.searchsorted(w.start, rows.start)
        rows.row, rows.start, rows.end = rows.row[has_word], rows.start[has_word], rows.end[has_word]
        line_hash = span_hash(raw, rows.start, rows.end)
        n["n_lines"] = np.bincount(rows.row, minlength=size)
        n["n_dup_lines"] = np.bincount(rows.row[_later_copies(line_hash, rows.row)], minlength=size)
        key, at = windows(exact, w.row, 8)
        begin = at[_repeated(key, w.row[at])]
        marks = np.zeros(len(exact) + 1, dtype=np.int64)
        np.add.at(marks, begin, 1)
        np.add.at(marks, begin + 8, -1)
        n["n_repeat_words"] = np.bincount(w.row[np.cumsum(marks)[:-1] > 0], minlength=size)
        votes = ["".join("-0+"[v + 1] for v in row) for row in _votes(n)]
        order = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop", "n_upper", "n_bang", "n_bare")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(n[k].astype(np.int64)) for k in order), pa.array(votes, pa.string())],
            names=["doc_id", *order, "votes"],
        )


def fit_accuracies(patterns: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], np.ndarray, float]:
    """EM over vote patterns: (posterior of good by pattern, accuracy[rule, class], prior of good)."""
    if not patterns:
        return {}, np.full((len(RULES), 2), 0.8), 0.5
    names = sorted(patterns)
    weight = np.array([patterns[k] for k in names], dtype=float)
    vote = np.array([["-0+".index(c) - 1 for c in k] for k in names])
    up, down = (vote > 0).astype(float), (vote < 0).astype(float)
    # two bad votes among the rules make a document doubtful at the start
    good = np.where(down.sum(1) >= 2, 0.1, np.where(down.sum(1) == 1, 0.6, 0.95))
    accuracy, prior = np.zeros((vote.shape[1], 2)), 0.5
    for _ in range(rounds):
        g, b = weight * good, weight * (1 - good)
        prior = (g.sum() + 1) / (weight.sum() + 2)
        # Beta(8, 2) prior on both accuracies keeps them on the informed side of chance
        accuracy[:, 0] = (g @ up + 8) / (g @ (up + down) + 10)
        accuracy[:, 1] = (b @ down + 8) / (b @ (up + down) + 10)
        accuracy = accuracy.clip(1e-4, 1 - 1e-4)
        log_good = np.log(prior) + up @ np.log(accuracy[:, 0]) + down @ np.log(1 - accuracy[:, 0])
        log_bad = np.log(1 - prior) + up @ np.log(1 - accuracy[:, 1]) + down @ np.log(accuracy[:, 1])
        new = 1 / (1 + np.exp(np.clip(log_bad - log_good, -700, 700)))
        if np.abs(new - good).max() < 1e-9:
            good = new
            break
        good = new
    return dict(zip(names, good.tolist(), strict=True)), accuracy, float(prior)


def quality_rules(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Votes, counts and posterior of every document."""
    spark = docs.sparkSession
    features = saved(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_measure, _FEATURES))
    patterns = {r["votes"]: r["n"] for r in features.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior, _, _ = fit_accuracies(patterns)
    table = spark.createDataFrame([(k, float(v)) for k, v in posterior.items()], "votes string, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        features.join(F.broadcast(table), "votes", "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    return quality_rules(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes", "posterior"
    )
