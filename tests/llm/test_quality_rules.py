import re
from collections import Counter

from brandspark.llm.common import read
from brandspark.llm.quality_rules import fit_accuracies, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def check(rows, texts):
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == counts(texts[r.doc_id]), r.doc_id
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_counts_equal_brute_force(spark, sf):
    docs = read(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    check(quality_rules(docs).collect(), texts)


def test_edges(spark):
    texts = {0: None, 1: "", 2: " \n\t", 3: "a b\na b\n a b\n\n", 4: "x y z w v u t s " * 50, 5: "é ß ü #|", 6: "q" * 300_000 + " r"}
    docs = spark.createDataFrame([(k, v, "extra") for k, v in texts.items()], "doc_id long, text string, votes string")
    check(quality_rules(docs).collect(), texts)
    assert quality_rules(docs.limit(0)).collect() == []
    assert quality_rules(docs.union(docs)).count() == 14


def test_quality_follows_labels(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    rows = quality_rules(docs).join(read(spark, "/root/testdata/sf0.01", "labels"), "doc_id").collect()
    bad, good = [r for r in rows if r.quality == 0], [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_em_recovers_planted_accuracies():
    import numpy as np

    rng = np.random.default_rng(1)
    good = rng.random(20000) < 0.85
    accuracy = [0.95, 0.9, 0.8, 0.9, 0.85, 0.95, 0.9, 0.7, 0.9]
    votes = Counter()
    for g in good:
        votes["".join("+" if (rng.random() < a) == g else "-" for a in accuracy)] += 1
    _, fitted, prior = fit_accuracies(dict(votes))
    assert abs(prior - 0.85) < 0.03
    assert np.abs(fitted[:, 0] - accuracy).max() < 0.03
