import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest

from brandspark.llm import target_resampling as tr
from brandspark.llm.common import read

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans(tr.UPPER, tr.LOWER)


def features(text, width):
    w = TERM.findall((text or "").translate(FOLD))
    return w, [" ".join(w[i : i + k]) for k in range(1, width + 1) for i in range(len(w) - k + 1)]


def expected(documents, target, width=1, buckets=10_000):
    of = lambda x: zlib.crc32(x.encode()) % buckets
    s, t = (Counter(of(f) for x in texts for f in features(x, width)[1]) for texts in ([d for _, d in documents], target))
    all_s, all_t = s.total() + buckets, t.total() + buckets
    gain = [math.floor(1000 * math.log((t[k] + 1) * all_s / ((s[k] + 1) * all_t))) for k in range(buckets)]
    rows, fit = [], []
    for doc_id, text in documents:
        words, own = features(text, width)
        weight = sum(gain[of(f)] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(own), weight, score, None])
        if len(words) >= 20:
            fit.append(rows[-1])
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(fit[: len(fit) * 10 // 100]):
        r[4] = k + 1
    return Counter(map(tuple, rows))


def test_query_equals_brute_force(spark, sf):
    documents = [(r.doc_id, r.text) for r in read(spark, sf, "documents").collect()]
    target = [r.text for r in read(spark, sf, "benchmark").collect()]
    assert Counter(map(tuple, tr.query(spark, sf).collect())) == expected(documents, target)


def test_query_equals_sql(spark, sf):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert Counter(map(tuple, tr.query(spark, sf).collect())) == Counter(db.execute(tr.ORACLE).fetchall())


@pytest.mark.parametrize("width", [1, 2, 3])
def test_odd_texts_equal_brute_force(spark, width):
    line = "A line OF ten words that STANDS in many texts é日本 \U0001f600x 9"
    texts = [None, "", "\n\n", "one", "a\nb\nc", f"{line}\n{line}\r\n{line}", "x-y_z\x00q\x7fw Ünder", "word " * 30_000 + "\n" + "w" * 100_000, *[f"{line}\n{k} {line}\n" for k in range(40)]]
    documents = [(k if k % 7 else None, t) for k, t in enumerate(texts)] + [(99, f"{line} {line}")] * 50
    df = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in documents], "doc_id long, text string, score string, n int, weight int")
    target = [line, None, "a b\nc d"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = tr.resample(df, goal, width=width, buckets=500)
    assert Counter(map(tuple, got.collect())) == expected(documents, target, width, 500)


def test_empty_tables(spark, sf):
    documents, target = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    assert tr.resample(documents.limit(0), target).collect() == []
    assert tr.resample(documents, target.limit(0)).count() == documents.count()
