import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa

from brandspark.llm import mixing
from brandspark.llm.common import read
from brandspark.llm.mixing import mix, mixed_texts, permuted, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check(docs, result):
    rows, given = result.collect(), docs.collect()
    assert sorted((r.doc_id, r.size) for r in rows) == sorted((d.doc_id, len(WORD.findall(d.text or ""))) for d in given)
    sizes = defaultdict(int)
    for d in given:
        sizes[d.source] += len(WORD.findall(d.text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, targets([sizes[s] for s in order]), strict=True))
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= 64
    return rows


def test_near_targets_and_again(spark, sf):
    docs = read(spark, sf, "documents")
    first = check(docs, mix(docs)[0])
    again = mix(docs.repartition(5))[0].collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_edges(spark):
    rows = [(1, None, None), (2, "", "b"), (3, "a " * 5000, "b"), (4, "x y z", "a"), (4, "x y z", "a"), (None, "q", None), (6, "one", "é")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    check_rows = mix(docs)[0].collect()
    assert len(check_rows) == 7 and all(r.taken <= 2 * r.size for r in check_rows)
    assert mix(docs.limit(0))[0].count() == 0
    assert mix(docs.filter("doc_id = 2"))[0].first().taken == 0


def test_targets():
    assert targets([100, 100, 100]) == [200.0, 166.66666666666666, 83.33333333333333] or abs(sum(targets([100, 100, 100])) - 450) < 1e-9
    got = targets([10, 1000, 1000, 10, 5])
    assert abs(sum(got) - 1.5 * 2025) < 1e-9 and got[0] == 20 and got[4] <= 10
    assert targets([]) == []


def test_permutation_is_one_to_one():
    for n in (1, 2, 3, 17, 1000, 4097):
        out = permuted(np.arange(n), np.full(n, n), np.full(n, 12345, dtype=np.uint64))
        assert sorted(out.tolist()) == list(range(n))


def test_texts_hold_the_taken_words(spark, sf):
    docs = read(spark, sf, "documents")
    taken = {r.doc_id: r.taken for r in mix(docs)[0].collect() if r.taken}
    texts = mixed_texts(docs)
    assert texts.columns == docs.columns
    assert {r.doc_id: len(WORD.findall(r.text)) for r in texts.collect()} == taken


def test_slots_fill_shards(spark, sf):
    _, slots = mix(read(spark, sf, "documents"), shards=8)
    per_shard = [r["count"] for r in slots.groupBy("shard").count().collect()]
    assert len(per_shard) == 8 and max(per_shard) - min(per_shard) <= 1


def test_many_sources_and_repeated_doc_ids(spark, monkeypatch):
    rows = [(k % 7, "a b c d e " * (1 + k % 3), f"s{k % 40:02}" if k % 40 else None) for k in range(400)] + [(5, "w " * 9, "s01")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few = sorted(tuple(r) for r in mix(docs)[0].select("doc_id", "size", "source_size", "target", "taken").collect())
    monkeypatch.setattr("brandspark.llm.mixing.FEW_SOURCES", 3)
    many = sorted(tuple(r) for r in mix(docs)[0].select("doc_id", "size", "source_size", "target", "taken").collect())
    assert few == many and len(few) == len(rows) and all(r[4] <= 2 * r[1] for r in few)


def test_targets_and_taken_equal_a_plain_computation(spark, sf):
    docs = read(spark, sf, "documents")
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    share, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:  # give out what is left; whoever is above stops at twice its size
        unit = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if unit * weight[s] > 2 * sizes[s]}
        share.update({s: 2.0 * sizes[s] for s in above} if above else {s: unit * weight[s] for s in open_})
        left -= sum(2.0 * sizes[s] for s in above)
        open_ = open_ - above if above else set()
    taken = {}
    for r in mix(docs)[0].collect():
        assert r.source_size == sizes[r.source] and abs(r.target - share[r.source]) <= 1e-6 * max(1, share[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - share[s]) <= 0.02 * share[s] + 64 for s in names)


def test_shards_draw_the_quotas():
    quotas = np.array([0, 5, 1, 700, 33, 2, 0, 4096])
    total, before = np.zeros_like(quotas), np.zeros_like(quotas)
    for shard in range(13):
        take, drawn = mixing.shard_counts(quotas, 13, shard, 7)
        assert (drawn == before).all() and take.sum() == quotas.sum() * (shard + 1) // 13 - quotas.sum() * shard // 13
        before, total = before + take, total + take
    assert (total == quotas).all()


def test_many_sources_need_little_of_the_driver():
    n = 200_000
    rows = pa.table({"source": [f"s{k}" for k in range(n)], "size": np.arange(n) % 90 + 1, "docs": np.ones(n, np.int64)})
    tracemalloc.start()
    plan = mixing.draw_plan(rows, 32, 256, 1.5, (5, 2, 1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6 and plan.slots == plan.quotas.sum()
    take, before = mixing.shard_counts(plan.quotas, plan.shards, 255, 17)
    assert (take + before == plan.quotas).all()


def test_rows_that_repeat_are_dealt_over_chunks(spark):
    docs = spark.range(3000).selectExpr("IF(id < 2500, NULL, id) AS doc_id", "IF(id < 2000, 'a b c', concat('w ', id)) AS text", "'s' AS source")
    result = mixing.mix(docs)[0].collect()
    taken = sum(r.taken for r in result)
    assert len(result) == 3000 and abs(taken - result[0].target) <= 64 and all(r.taken <= 2 * r.size for r in result)
    assert sorted(r.taken for r in mixing.mix(docs)[0].collect()) == sorted(r.taken for r in result)
