import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from brandspark.llm.common import components, read
from brandspark.llm.ngram_join import Index, links_of, ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 4]) for k in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}
    edges = defaultdict(set)
    for a, s in sets:
        for b, t in sets:
            if s and t and 100 * len(s & t) >= 85 * len(s | t):
                edges[a].add(b)
    for i in sorted(label):
        stack = [i] if label[i] == i else []
        while stack:
            for y in edges[stack.pop()]:
                if label[y] > i:
                    label[y] = i
                    stack.append(y)
    return sorted((i, len(s), label[i]) for i, s in sets)


def run(spark, rows):
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_shingles int")
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(docs).collect())


def test_documents_equal_brute_force(spark, sf):
    docs = read(spark, sf, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(docs).collect()) == brute(rows)


@pytest.mark.parametrize("seed", [0, 1])
def test_near_copies_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in rng.integers(0, 400, 70)]
    line = " ".join(f"c{k}" for k in range(12))
    rows = []
    for k in range(160):
        words = list(base)
        for at in rng.integers(0, 70, rng.integers(0, 5)):
            words[at] = f"x{rng.integers(0, 3)}"
        rows.append((k, " ".join(words)))
    rows += [(200 + k, line + " " + " ".join(f"u{v}" for v in rng.integers(0, 10**6, 30))) for k in range(60)]
    rows += [(300 + k, "Same Text as\tEver é" if k % 2 else "same text AS ever é") for k in range(40)]
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (7, "long " * 60_000), (8, "a b c d"), (9, "z y")]
    assert run(spark, rows) == brute(rows)
    docs = spark.createDataFrame([(1, "p q r s t"), (1, "p q r s t")], "doc_id long, text string")
    assert [tuple(r) for r in ngram_join(docs).collect()] == [(1, 2, 1)] * 2
    assert ngram_join(docs.limit(0)).count() == 0


def jaccard(s, t):
    s, t = set(s.tolist()), set(t.tolist())
    return Fraction(len(s & t), len(s | t)) if s or t else Fraction(0)


@pytest.mark.parametrize("bound", [Fraction(1, 2), Fraction(8, 10), Fraction(85, 100)])
def test_divide_skip_equals_sets(bound):
    rng = np.random.default_rng(3)
    for size in (12, 60, 300):
        base = np.unique(rng.integers(0, size, size // 2))
        sets = [np.unique(np.where(rng.random(len(base)) < share, rng.integers(0, size, len(base)), base)).astype(np.uint64) for share in (0, 0.02, 0.1, 0.3) for _ in range(12)]
        sets = sorted([*sets, np.zeros(0, np.uint64), base[:1].astype(np.uint64)], key=len)
        index = Index(sets)
        for q in sets:
            expected = [k for k, s in enumerate(sets) if len(q) and jaccard(q, s) >= bound]
            assert sorted(index.search(q, bound, lambda k: False)) == expected
            assert sorted(index.search(q, bound, lambda k: k % 2 == 0)) == [k for k in expected if k % 2]
        assert index.search(np.array([10**6], dtype=np.uint64), bound, lambda k: False) == []


def test_links_join_what_all_links_join():
    rng = np.random.default_rng(5)
    base = np.arange(100)
    sets = [np.unique(np.where(rng.random(100) < 0.06, rng.integers(1000, 9000, 100), base)).astype(np.uint64) for _ in range(40)]
    bound = Fraction(85, 100)
    links = links_of([*range(40)], sets, [*range(40)], [True] * 40, [True] * 40, bound)
    assert all(jaccard(sets[a], sets[b]) >= bound for a, b in links)

    def groups(edges):
        root = [*range(40)]
        for _ in range(40):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert groups(links) == groups([(a, b) for a in range(40) for b in range(a) if jaccard(sets[a], sets[b]) >= bound])


@pytest.mark.parametrize("cell, heavy", [(300, 1 << 18), (300, 0), (10**6, 5)])
def test_long_lists_in_a_grid_of_cells(spark, monkeypatch, cell, heavy):
    """Copies changed too much to link with most others, far more than a cell holds."""
    monkeypatch.setattr("brandspark.llm.ngram_join.CELL", cell)
    rng = np.random.default_rng(7)
    rows = []
    for k in range(150):
        words = [f"w{v}" for v in range(60)]
        for at in rng.integers(0, 60, rng.integers(0, 4)):
            words[at] = f"x{rng.integers(0, 2)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hubs in (0, 2):
        got = ngram_join(docs, hubs=hubs, heavy=heavy).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)


def test_one_doc_id_with_different_texts(spark):
    rows = [(1, "a b c d e f"), (1, "p q r s t u"), (2, "P q r s t u"), (None, "p q r s t u"), (None, "z"), (3, "a b c d e f"), (3, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join(docs).collect()), key=str)
    assert got == sorted([(1, 3, 1), (1, 3, 1), (2, 3, 1), (None, 3, 1), (None, 1, None), (3, 3, 1), (3, 3, 1)], key=str)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, k) for k in range(501, 560)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert all(got[k] == 0 for k in range(201)) and all(got[k] == 500 for k in range(500, 560))


def test_bound_is_exact(spark):
    rows = [(1, " ".join(map(str, range(23)))), (2, " ".join(map(str, range(20))))]  # 17 of 20 shingles: exactly 0.85
    assert run(spark, rows)[1][2] == 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in ngram_join(docs, bound=Fraction(86, 100)).collect()} == {1, 2}
