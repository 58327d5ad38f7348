"""Embedding near-duplicates by a robust-pruned flat graph.

Vectors are compared inside their label by cosine in double precision.

Build.  Equal vectors are one node with a count.  Each label is cut into
clusters of about ``SHARD`` nodes by centroids fitted on a bounded sample
(``SAMPLE`` nodes, at most ``CENTROIDS`` centroids); a node belongs to the
``overlap`` nearest ones, so shards overlap.  Each shard builds its graph by
robust pruning; the adjacency lists of a node from all its shards are united.
A shard that holds far more than its share (one very common vector with many
near copies) is dealt out in blocks, each pair of blocks a task.

Search.  Every node is a query: from the shard's medoids, greedy search with a
beam goes to its neighbourhood, and from the hits inside the range, and from the
query's own node, the search expands along the lists until no new hit is found.
Every hit is verified by its cosine.  A pair that several shards hold is counted
in one.

Audit.  Links of ``AUDIT`` nodes of all and of ``AUDIT`` nodes with links found
are measured against brute force over all rows, as the mean over those that have
any.  Below ``least_recall`` the graph is built again with more overlap; if the
last overlap is below it too, all pairs of a label are compared in blocks.

Edge cases: null labels, and vectors that are null, empty, zero or hold null or
non-finite components, link with nothing; vectors of another length than the
query's do not link; repeated rows are vectors of their own; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, read, saved

SHARD = 800
CENTROIDS = 4096
SAMPLE = 20_000
DEGREE = 24
POOL = 48
BEAM = 16
AUDIT = 1000
MOST_OVERLAP = 6


def unit(rows: list) -> np.ndarray:
    x = np.array(rows, dtype=np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_centroids(sample: list, counts: dict) -> dict:
    """Centroids for each group of nodes (label and length), by a few rounds of spherical k-means."""
    rng = np.random.default_rng(3)
    groups: dict = {}
    for key, vector in sample:
        groups.setdefault(key, []).append(vector)
    total = sum(counts.values())
    budget = min(1.0, CENTROIDS / max(1, -(-total // SHARD)))
    out = {}
    for key in sorted(counts):
        x = unit(groups[key]) if key in groups else np.zeros((1, key[1]))
        k = max(1, min(int(-(-counts[key] * budget // SHARD)), len(x)))
        c = x[rng.choice(len(x), k, replace=False)]
        for _ in range(8):
            near = (x @ c.T).argmax(1)
            for j in range(k):
                if (near == j).any():
                    m = x[near == j].mean(0)
                    c[j] = m / max(np.linalg.norm(m), 1e-12)
        out[key] = c
    return out


def _assign(centroids: dict, overlap: int):
    first, at = {}, 0
    for key in sorted(centroids):
        first[key] = at
        at += len(centroids[key])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, vectors = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            shards: list = [None] * batch.num_rows
            groups: dict = {}
            for i, key in enumerate(zip(labels, map(len, vectors), strict=True)):
                groups.setdefault(key, []).append(i)
            for key, rows in groups.items():
                c = centroids[key]
                s = unit([vectors[i] for i in rows]) @ c.T
                near = np.argsort(-s, axis=1, kind="stable")[:, :overlap] + first[key]
                for i, own in zip(rows, near.tolist(), strict=True):
                    shards[i] = sorted(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(shards, pa.list_(pa.int32())), batch.column(3)], names=["node", "embedding", "shards", "m"])

    return run


def robust_prune(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = 1.2) -> list[np.ndarray]:
    """Neighbours of each row: nearest first, without those that a chosen neighbour is nearer to by ``alpha``."""
    n = len(x)
    if n <= 1:
        return [np.zeros(0, np.int64)] * n
    pool = min(pool, n - 1)
    out = []
    for at in range(0, n, 256):
        s = x[at : at + 256] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        cand = np.argpartition(-s, pool - 1, axis=1)[:, :pool]
        own = np.take_along_axis(s, cand, 1)
        order = np.argsort(-own, axis=1, kind="stable")
        cand, own = np.take_along_axis(cand, order, 1), np.take_along_axis(own, order, 1)
        dist = np.sqrt(np.maximum(2 - 2 * own, 0))
        between = np.sqrt(np.maximum(2 - 2 * np.einsum("qid,qjd->qij", x[cand], x[cand]), 0))
        alive, chosen = np.ones(cand.shape, bool), np.zeros(cand.shape, bool)
        for _ in range(min(degree, pool)):
            some = alive.any(1)
            pick = alive.argmax(1)
            rows = np.flatnonzero(some)
            chosen[rows, pick[rows]] = True
            alive[rows, pick[rows]] = False
            alive[rows] &= alpha * between[rows, pick[rows]] > dist[rows]
        out += [c[k] for c, k in zip(cand, chosen, strict=True)]
    return out


def _build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    x = unit(table.column("embedding").to_pylist()).astype(np.float32)
    nodes = table.column("node").to_numpy()
    lists = robust_prune(x)
    return pa.table({"node": pa.array(nodes), "near": pa.array([nodes[k].tolist() for k in lists], pa.list_(pa.int64()))})


def medoids(x: np.ndarray, count: int = 16) -> np.ndarray:
    """The row nearest to the mean, and rows that are each farthest from those before."""
    out = [int((x @ x.mean(0)).argmax())]
    near = x @ x[out[0]]
    while len(out) < min(count, len(x)):
        out.append(int(near.argmin()))
        near = np.maximum(near, x @ x[out[-1]])
    return np.unique(out)


def range_search(x: np.ndarray, near: list[np.ndarray], bound: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, hit) for all rows of ``x`` as queries, hits with cosine of ``bound`` or more, found along the graph."""
    n = len(x)
    # both directions, as a padded table
    src = np.concatenate([np.repeat(np.arange(n), [len(k) for k in near]), np.concatenate(near)]).astype(np.int64)
    dst = np.concatenate([np.concatenate(near), np.repeat(np.arange(n), [len(k) for k in near])]).astype(np.int64)
    code = np.unique(src * n + dst)
    src, dst = code // n, code % n
    start = np.searchsorted(src, np.arange(n + 1))
    entry = medoids(x)
    found_q, found_v = [], []
    for at in range(0, n, 256):
        q = np.arange(at, min(n, at + 256))
        seen, done = np.zeros((len(q), n), bool), np.zeros((len(q), n), bool)
        sim = np.full((len(q), n), -2.0)
        seen[:, entry] = True
        sim[:, entry] = x[q] @ x[entry].T

        def visit(rows: np.ndarray, nodes: np.ndarray) -> None:
            """Open nodes for queries: what stands on their lists is seen and measured."""
            done[rows, nodes] = True  # noqa: B023
            count = start[nodes + 1] - start[nodes]
            to = dst[np.repeat(start[nodes], count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)]
            new = np.zeros_like(seen)  # noqa: B023
            new[np.repeat(rows, count), to] = True
            new &= ~seen  # noqa: B023
            a, v = np.nonzero(new)
            seen[a, v] = True  # noqa: B023
            sim[a, v] = np.einsum("ij,ij->i", x[q[a]], x[v])  # noqa: B023

        active = np.arange(len(q))
        while len(active):  # greedy: each step opens the best node of the beam that is not open yet
            own = sim[active]
            floor = -np.partition(-own, min(beam, n) - 1, axis=1)[:, min(beam, n) - 1]
            own[done[active]] = -3.0
            best = own.argmax(1)
            value = own[np.arange(len(active)), best]
            go = (value > -2) & (value >= floor) & (value < bound)
            near_it = value >= bound  # the range is reached; the expansion goes on from there
            active, best = active[go & ~near_it], best[go & ~near_it]
            if len(active):
                visit(active, best)
        # the lists of a group of copies may stay inside it, so no edge need lead in from the medoids
        own_row = np.arange(len(q))
        seen[own_row, q] = True
        sim[own_row, q] = 1.0
        while True:  # expansion: hits that are not open yet are opened together
            rows, nodes = np.nonzero((sim >= bound) & ~done)
            if not len(rows):
                break
            visit(rows, nodes)
        a, v = np.nonzero(sim >= bound)
        found_q.append(q[a])
        found_v.append(v)
    a, v = np.concatenate(found_q), np.concatenate(found_v)
    other = a != v
    return a[other], v[other]


def _linked(nodes: np.ndarray, m: np.ndarray, q: np.ndarray, v: np.ndarray) -> pa.Table:
    """(node, links, head) by the pairs (q, v), both directions given."""
    links = np.bincount(q, m[v], minlength=len(nodes)).astype(np.int64)
    label = np.arange(len(nodes))
    while len(q):  # least label of the neighbours, until nothing changes
        new = label.copy()
        np.minimum.at(new, q, label[v])
        new = new[new]
        if (new == label).all():
            break
        label = new
    return pa.table({"node": pa.array(nodes), "links": pa.array(links), "head": pa.array(nodes[label])})


def _search(bound: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard, left, right = (k.as_py() for k in key)
        nodes, m = table.column("node").to_numpy(), table.column("m").to_numpy()
        x = unit(table.column("embedding").to_pylist())
        place = {v: k for k, v in enumerate(nodes.tolist())}
        near = [np.array([place[v] for v in own or () if v in place], dtype=np.int64) for own in table.column("near").to_pylist()]
        block = table.column("block").to_numpy()
        # shards of each node below this one: a pair that shares one is counted there
        shards = table.column("shards").to_pylist()
        q, v = range_search(x, near, bound)
        keep = (block[q] != block[v]) if left != right else np.ones(len(q), bool)
        lower = [frozenset(s for s in own if s < shard) for own in shards]
        if any(lower):
            keep &= np.array([not (lower[a] & lower[b]) for a, b in zip(q.tolist(), v.tolist(), strict=True)], dtype=bool)
        return _linked(nodes, m, q[keep], v[keep])

    return run


def _compare(bound: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        left, right = (k.as_py() for k in key[2:])
        nodes, m, block = (table.column(c).to_numpy() for c in ("node", "m", "block"))
        x = unit(table.column("embedding").to_pylist())
        found = []
        for at in range(0, len(x), 256):
            q, v = np.nonzero(x[at : at + 256] @ x.T >= bound)
            found.append((q + at, v))
        q, v = (np.concatenate(k) for k in zip(*found, strict=True))
        keep = (block[q] != block[v]) if left != right else q != v
        return _linked(nodes, m, q[keep], v[keep])

    return run


def _block_pairs(member: DataFrame, *columns: str) -> DataFrame:
    """Rows with their block, once for each pair of blocks (left, right) that theirs is of."""
    member = member.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("left"), F.greatest("block", k).alias("right")))
    return member.withColumn("t", F.explode(pairs)).select("t.left", "t.right", "block", *columns)


def _all_pairs(nodes: DataFrame, bound: float) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (node, head) by comparing all pairs of a label, each pair of blocks a task."""
    sized = nodes.withColumn("d", F.size("embedding"))
    size = sized.groupBy("label", "d").agg(F.ceil(F.count("*") / (4.0 * SHARD)).cast("int").alias("blocks"))
    tasks = _block_pairs(sized.join(size, ["label", "d"]), "label", "d", "node", "embedding", "m")
    found = tasks.groupBy("label", "d", "left", "right").applyInArrow(_compare(bound), "node long, links long, head long")
    return _sums(found)


def _sums(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    found = saved(found.filter("links > 0"))
    return found.groupBy("node").agg(F.sum("links").alias("links")), found.filter("node <> head").select("node", "head")


def _once(nodes: DataFrame, bound: float, overlap: int, centroids: dict) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (node, head) of one build and search."""
    assigned = saved(nodes.select("node", "label", "embedding", "m").mapInArrow(_assign(centroids, overlap), "node long, embedding array<float>, shards array<int>, m long"))
    member = assigned.withColumn("shard", F.explode("shards"))
    size = member.groupBy("shard").agg(F.ceil(F.count("*") / (4.0 * SHARD)).cast("int").alias("blocks"))
    # every pair of blocks of a shard is a task; nearly all shards have one block
    tasks = _block_pairs(member.join(size, "shard"), "shard", "node", "embedding", "shards", "m")
    lists = tasks.select("shard", "left", "right", "node", "embedding").groupBy("shard", "left", "right").applyInArrow(_build, "node long, near array<long>")
    lists = lists.select("node", F.explode("near").alias("v")).distinct().groupBy("node").agg(F.collect_list("v").alias("near"))
    tasks = tasks.join(lists, "node", "left")
    found = tasks.groupBy("shard", "left", "right").applyInArrow(_search(bound), "node long, links long, head long")
    return _sums(found)


def audit(nodes: DataFrame, found: DataFrame, bound: float, queries: int = AUDIT) -> float:
    """Links found over links there are, against all rows: the mean over nodes with links.

    ``queries`` nodes of all are asked, and as many of those with links found; the lower mean counts.
    """
    pick = lambda rows: rows.orderBy(F.xxhash64("node", F.lit(9))).limit(queries).select("node", "label", "embedding").collect()
    samples = [pick(nodes), pick(nodes.join(found.filter("links > 0").select("node"), "node", "left_semi"))]
    groups: dict = {}
    for r in {r["node"]: r for own in samples for r in own}.values():
        groups.setdefault((r["label"], len(r["embedding"])), []).append((r["node"], r["embedding"]))
    ready = {k: ([n for n, _ in v], unit([e for _, e in v])) for k, v in groups.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, m = batch.column(0).to_numpy(), batch.column(3).to_numpy()
            out: dict = {}
            rows: dict = {}
            for i, key in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                rows.setdefault((key[0], len(key[1])), []).append((i, key[1]))
            for key, own in rows.items():
                if key in ready:
                    names, q = ready[key]
                    hit = q @ unit([e for _, e in own]).T >= bound
                    at = np.array([i for i, _ in own])
                    for name, h in zip(names, hit, strict=True):
                        out[name] = out.get(name, 0) + int(m[at[h & (node[at] != name)]].sum())
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.int64())], names=["node", "n"])

    truth = nodes.select("node", "label", "embedding", "m").mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    share = F.least("n", F.coalesce("links", F.lit(0))) / F.col("n")
    got = {r["node"]: r["r"] for r in truth.filter("n > 0").join(found, "node", "left").select("node", share.alias("r")).collect()}
    return min(float(np.mean([got[r["node"]] for r in own if r["node"] in got] or [1.0])) for own in samples)


def near_dup(rows: DataFrame, bound: float = 0.93, overlap: int = 2, least_recall: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    base = rows.select(F.col("vec_id").cast("long"), F.col("label"), F.col("embedding").cast("array<float>"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    valid = F.coalesce(F.col("label").isNotNull() & F.exists("embedding", lambda v: v != 0) & finite, F.lit(False))
    base = base.withColumn("node", F.when(valid, F.xxhash64("label", "embedding")))
    nodes = saved(
        base.filter("node IS NOT NULL").groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("m"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    )
    counts = {(r["label"], r["d"]): r["n"] for r in nodes.groupBy("label", F.size("embedding").alias("d")).agg(F.count("*").alias("n")).collect()}
    sample = nodes.orderBy(F.xxhash64("node", F.lit(4))).limit(SAMPLE).select("label", "embedding").collect()
    centroids = fit_centroids([((r["label"], len(r["embedding"])), r["embedding"]) for r in sample], counts)
    while True:
        links, edges = _once(nodes, bound, overlap, centroids)
        if audit(nodes, links, bound) >= least_recall:
            break
        if overlap >= MOST_OVERLAP:
            links, edges = _all_pairs(nodes, bound)
            break
        overlap += 2
    heads = components(edges, "node", "head").withColumnRenamed("component", "c")
    named = nodes.select("node", "vec_id", "m").join(heads, "node", "left").withColumn("c", F.coalesce("c", "node"))
    least = named.groupBy("c").agg(F.min("vec_id").alias("component_id"))
    named = named.join(least, "c").join(links, "node", "left").select("node", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id")
    result = base.select("vec_id", "node").join(named, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return near_dup(read(spark, sf_dir, "embeddings"))
