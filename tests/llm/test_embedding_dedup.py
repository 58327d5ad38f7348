import numpy as np

from brandspark.llm import embedding_dedup
from brandspark.llm.common import read
from brandspark.llm.embedding_dedup import audit, near_dup, range_search, robust_prune


def brute(rows, bound=0.93):
    ok = [r for r in rows if r[1] is not None and r[2] and all(v is not None and np.isfinite(v) for v in r[2]) and any(r[2])]
    label = {r[0]: r[0] for r in rows}
    x = {r[0]: np.float32(r[2]).astype(float) for r in ok}
    links = {r[0]: set() for r in rows}
    for a, la, _ in ok:
        for b, lb, _ in ok:
            if a != b and la == lb and len(x[a]) == len(x[b]) and x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= bound:
                links[a].add(b)
    for i in sorted(label):
        stack = [i] if label[i] == i else []
        while stack:
            for y in links[stack.pop()]:
                if label[y] > i:
                    label[y] = i
                    stack.append(y)
    return sorted((i, len(links[i]), label[i], label[i] == i) for i in label)


def run(spark, rows):
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, label int, embedding array<float>, node int")
    return sorted(tuple(r) for r in near_dup(table).collect())


def test_planted_groups(spark):
    rng = np.random.default_rng(1)
    rows, at = [], 0
    for label in range(3):
        for _ in range(60):
            base = rng.standard_normal(16)
            for _ in range(rng.integers(1, 6)):
                rows.append((at, label, (base + 0.15 * rng.standard_normal(16)).tolist()))
                at += 1
    rows += [(at + k, 1, rows[0][2]) for k in range(30)] + [(at + 100 + k, 0, rows[0][2]) for k in range(30)]
    got, want = run(spark, rows), brute(rows)
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [2.0, 0.0]), (3, 1, [1.0, 0.0]), (4, None, [1.0, 0.0]), (5, 0, None), (6, 0, []), (7, 0, [0.0, 0.0])]
    rows += [(8, 0, [nan, 1.0]), (9, 0, [inf, 1.0]), (10, 0, [None, 1.0]), (11, 0, [1.0, 0.0, 0.0]), (12, 0, [0.93, 0.36])]
    assert run(spark, rows) == brute(rows)
    table = spark.createDataFrame([(1, 0, [1.0, 0.5])] * 2, "vec_id long, label int, embedding array<float>")
    assert [tuple(r) for r in near_dup(table).collect()] == [(1, 1, 1, True)] * 2
    assert near_dup(table.limit(0)).count() == 0


def test_recall_is_measured(spark, sf):
    from pyspark.sql import functions as F

    rows = read(spark, sf, "embeddings")
    nodes = rows.select(F.col("vec_id").alias("node"), "label", "embedding", F.lit(1).cast("long").alias("m"))
    none = spark.createDataFrame([], "node long, links long")
    assert audit(nodes, none, 0.999999) == 1.0
    assert audit(nodes, none, -1.0) == 0.0


def test_search_along_the_graph():
    rng = np.random.default_rng(2)
    base = rng.standard_normal((120, 24))
    x = np.repeat(base, 3, axis=0) + 0.05 * rng.standard_normal((360, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, v = range_search(x, robust_prune(x.astype(np.float32)), 0.93)
    s = x @ x.T >= 0.93
    np.fill_diagonal(s, False)
    assert len(q) >= 0.97 * s.sum() and s[q, v].all()


def test_groups_larger_than_the_pool():
    rng = np.random.default_rng(4)
    x = np.repeat(rng.standard_normal((30, 64)), 50, axis=0) + 0.1 * rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, v = range_search(x, robust_prune(x.astype(np.float32)), 0.93)
    s = x @ x.T >= 0.93
    np.fill_diagonal(s, False)
    assert len(q) >= 0.97 * s.sum() and s[q, v].all()


def test_all_pairs_where_the_graph_misses(spark, monkeypatch):
    def nothing(nodes, bound, overlap, centroids):
        return spark.createDataFrame([], "node long, links long"), spark.createDataFrame([], "node long, head long")

    monkeypatch.setattr(embedding_dedup, "_once", nothing)
    monkeypatch.setattr(embedding_dedup, "SHARD", 10)
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 16))
    rows = [(k, k % 2, (base[k % 40] + 0.1 * rng.standard_normal(16)).tolist()) for k in range(160)]
    rows += [(160 + k, 0, rows[0][2]) for k in range(5)] + [(170, 0, rows[0][2][:8])]
    assert run(spark, rows) == brute(rows)


def test_audit_is_a_mean_over_queries(spark):
    vectors = [[1.0, 0.0]] * 1 + [[1.0, 0.001 * k] for k in range(1, 9)] + [[0.0, 1.0], [0.001, 1.0]]
    nodes = spark.createDataFrame([(k, 0, v, 1) for k, v in enumerate(vectors)], "node long, label int, embedding array<float>, m long")
    found = spark.createDataFrame([(k, 8) for k in range(9)], "node long, links long")  # the second group is lost
    assert abs(audit(nodes, found, 0.93) - 9 / 11) < 1e-9
