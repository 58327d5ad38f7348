import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from brandspark.operators import images, matching, name_index, reports


def test_like_candidates_equal_sql(spark):
    names = ["a_c", "100%", "50% off", "x\\%y", "one two", "%", "ab", "a", "É", "under_score", "tail\\", "b\\c", "__", "Two%Words"]
    texts = ["abc", "a_c", "aXc and", "100% sure", "100 sure", "x%y", "xzy", "one of two", "ONE TWO", "é", "underXscore", "b c", "bc", "two of Words", "", "tail"]
    df = spark.createDataFrame([(n, f"%{n}%") for n in names], "key string, pattern string")
    got = {tuple(r) for r in matching.like_candidates(df, spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    db = duckdb.connect()
    want = set()
    for n in names:
        if not n.strip("%_"):
            continue  # without another character: matches none, by definition
        pattern = f"%{n}%".replace("b\\c", "bc").replace("tail\\%", "tail\\%")
        for t in texts:
            if db.execute("SELECT ? ILIKE ? ESCAPE '\\'", [t, pattern]).fetchall()[0][0]:
                want.add((n, t))
    assert got == want


def test_short_and_long_pieces_equal_plain_search(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abAB ") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    asked = {f"k{k}": ["".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 3))] for k in range(60)}
    df = spark.createDataFrame(list(asked.items()), "key string, pieces array<string>")
    got = {tuple(r) for r in matching.contains_candidates(df, spark.createDataFrame([(t,) for t in texts], "text string")).collect()}

    def holds(text, pieces):
        at = 0
        for p in pieces:
            at = text.lower().find(p, at)
            if at < 0:
                return False
            at += len(p)
        return True

    assert got == {(k, t) for k, p in asked.items() for t in texts if holds(t, p)}


def test_older_mode_takes_names_as_patterns(spark):
    marks = spark.createDataFrame(
        [(k, m, o, "700", "LIVE") for k, (m, o) in enumerate([("RED CUP", "Acme_Co Inc."), ("RED TIN CUP", "AcmeXCo Ltd"), ("BLUE", "Big Acme and Sons Company"), (None, None)])],
        "serial_number long, mark_identification string, owner_name string, status_code string, live_dead string",
    )
    names = spark.createDataFrame([("Acme_Co",), ("big sons",), ("none here",), ("",)], "name string")
    got = {(r.name, r.match_type, r.owner_name) for r in matching.match_owners(names, marks, mode="v1").collect()}
    assert got == {("Acme_Co", "exact", "Acme_Co Inc."), ("Acme_Co", "exact", "AcmeXCo Ltd"), ("big sons", "fuzzy", "Big Acme and Sons Company"), ("none here", "miss", None)}
    brands = spark.createDataFrame([("RED CUP",), ("red",), ("TIN RED",)], "name string")
    got = {(r.name, r.match_type, r.mark_identification) for r in matching.match_marks(brands, marks, mode="v1").collect()}
    assert got == {("RED CUP", "exact", "RED CUP"), ("red", "exact", "RED CUP"), ("red", "exact", "RED TIN CUP"), ("TIN RED", "miss", None)}
    many = spark.createDataFrame([(k, "M", f"one{k} and two", "700", "LIVE") for k in range(130)], marks.schema)
    assert matching.match_owners(spark.createDataFrame([("one two",)], "name string"), many, mode="v1").count() == 100


def test_retry_owners_takes_the_first_strategy_that_hits(spark):
    marks = spark.createDataFrame([(o,) for o in ["Foo, Inc.", "Hunter, Abraham", "Simental, Holly Denise LLC", "Brightest Light Trading", "Brightest Light Trade", None]], "owner_name string")
    names = spark.createDataFrame([(n,) for n in ["foo inc", "Abraham Hunter", "Holly Denise Simental", "Brightest Light Tradings", "abcd", "Nobody Knows This"]], "name string")
    got = {r.name: (r.strategy, list(r.companies)) for r in matching.retry_owners(names, marks).collect()}
    assert got == {
        "foo inc": ("clean_exact", ["Foo, Inc."]),
        "Abraham Hunter": ("name_flip", ["Hunter, Abraham"]),
        "Holly Denise Simental": ("name_flip", ["Simental, Holly Denise LLC"]),
        "Brightest Light Tradings": ("trgm", ["Brightest Light Trading", "Brightest Light Trade"]),
    }


def test_name_index_equals_plain_similarity(spark, tmp_path):
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "Inc.", "of", "x1", "Straße", "日本"]
    name = lambda n: " ".join(rng.choice(words) for _ in range(n))
    names = [name(rng.randint(1, 5)) for _ in range(150)] + ["...", "", None, name(400)]
    queries = [name(rng.randint(1, 4)) for _ in range(40)] + ["", None]
    rows = lambda column, values: spark.createDataFrame([(v,) for v in values], f"{column} string")
    index = name_index.build_name_index(rows("name", names), str(tmp_path / "index"), least=0.2, buckets=8)

    def grams(s):
        import re

        return {f"  {w} "[k : k + 3] for w in re.findall(r"[^\W_]+", s.lower()) for k in range(len(w) + 1)}

    for least in (0.2, 0.45):
        want = set()
        for q in {q for q in queries if q}:
            for n in {n for n in names if n}:
                a, b = grams(q), grams(n)
                if a and b and len(a & b) / len(a | b) >= least:
                    want.add((q, n, round(len(a & b) / len(a | b), 9)))
        got = {(r.query, r.name, round(r.sim, 9)) for r in name_index.search_names(index, rows("query", queries), least, top=None).collect()}
        assert got == want
        top = name_index.search_names(index, rows("query", queries), least, top=2).collect()
        ranked = {}
        for q, n, s in want:
            ranked.setdefault(q, []).append((-s, n))
        assert Counter((r.query, r.name) for r in top) == Counter((q, n) for q, v in ranked.items() for _, n in sorted(v)[:2])
    with pytest.raises(ValueError):
        name_index.search_names(index, rows("query", queries), 0.1)


def test_search_reads_the_lists_of_its_grams(spark, tmp_path):
    names = spark.range(2000).selectExpr("concat('name ', id, ' of ', hex(id * 7919)) AS name")
    index = name_index.build_name_index(names, str(tmp_path / "index"), buckets=16)
    found = name_index.search_names(index, spark.createDataFrame([("name 77 of",)], "query string"), top=None)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+", plan) and re.search(r"PushedFilters: \[[^\]]*\bg\b", plan)


def test_few_and_many_queries_find_the_same(spark, tmp_path, monkeypatch):
    names = spark.range(400).selectExpr("concat('name ', id % 90, ' of ', hex(id * 7919)) AS name")
    index = name_index.build_name_index(names, str(tmp_path / "index"), buckets=4)
    queries = spark.range(30).selectExpr("concat('name ', id, ' of ', hex(id * 7919 + 16)) AS query")
    few = {tuple(r) for r in name_index.search_names(index, queries, top=None).collect()}
    monkeypatch.setattr(name_index, "FEW_ASKED", 0)
    assert few == {tuple(r) for r in name_index.search_names(index, queries, top=None).collect()} and few


def test_search_compares_stored_sets(spark, tmp_path):
    names = spark.range(200).selectExpr("concat('name ', id, ' of ', hex(id * 7919)) AS name")
    index = name_index.build_name_index(names, str(tmp_path / "index"), buckets=4)
    found = name_index.search_names(index, spark.createDataFrame([("name 77 of",)], "query string"), top=None)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "split(lower(name" not in plan  # candidates are hashed, and their texts not taken apart again
    assert found.count() > 0


def test_similar_images_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [list(map(float, v)) for v in rng.normal(size=(300, 6)).astype(np.float32)]
    vectors[10] = vectors[20] = vectors[30] = vectors[40]
    rows = [(k, v) for k, v in enumerate(vectors)] + [(400, None), (401, [0.0] * 6), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [float("nan")] + [1.0] * 5), (404, [1.0, 2.0]), (405, [2.0, 1.0])]
    df = spark.createDataFrame([(k, v, "x") for k, v in rows], "image_id long, embedding array<float>, query_id string")
    asked = df.filter("image_id % 20 = 0 OR image_id >= 400")
    want = {}
    usable = {k: np.array(v, float) for k, v in rows if k < 300 or k >= 404}
    for q in [k for k, _ in rows if (k % 20 == 0 or k >= 400) and k in usable]:
        near = [(k, float(usable[q] @ v / np.linalg.norm(usable[q]) / np.linalg.norm(v))) for k, v in usable.items() if k != q and len(v) == len(usable[q])]
        want[q] = [k for k, _ in sorted(near, key=lambda x: (-round(x[1], 10), x[0]))[:5]]
    for block, part in ((512, 65_536), (3, 40)):
        found = images.similar_images(asked, df, 5, block, part).collect()
        got = {}
        for r in sorted(found, key=lambda r: (r.query_id, -round(r.similarity, 10), r.image_id)):
            got.setdefault(r.query_id, []).append(r.image_id)
        assert got == want
    assert images.similar_images(asked.limit(0), df).collect() == []


def test_overview_ranks_all_qualities_and_cuts_lists(spark):
    kinds = ["exact", "a_preferred", "a_only", "ai_high", "ai_medium", "b_only", "ai_low", "b_uncertain"]
    rng = random.Random(8)
    matched, want = [], {}
    for c in range(60):
        own = [(f"n{c}-{k}", rng.choice(kinds)) for k in range(rng.randint(1, 4))]
        matched += [(n, f"p{n}", "b" if c else f"brand {n}", f"C{c}", q, False) for n, q in own]
        want[f"C{c}"] = min((q for _, q in own), key=kinds.index)
    matched += [(f"m{k:04d}", f"plaintiff {k % 90}", None, "LARGE", "b_only", True) for k in range(900)] + [("z", "p", "b", "LARGE", "ai_medium", False), ("y", "p", "b", None, "exact", True)]
    schema = "case_number string, plaintiff_clean string, brand_clean string, real_company string, match_quality string, needs_review boolean"
    df = spark.createDataFrame(matched, schema)
    cases = df.selectExpr("case_number", "DATE '2024-01-01' AS date_filed", "'s' AS nature_of_suit")
    details = spark.createDataFrame([], "real_company string, mark_identification string")
    rows = {r.real_company: r for r in reports.company_overview(df, cases, details).collect()}
    assert {c: r.best_quality for c, r in rows.items()} == want | {"LARGE": "ai_medium"}
    numbers = ", ".join(sorted(f"m{k:04d}" for k in range(900)) + ["z"])
    plaintiffs = "; ".join(sorted({f"plaintiff {k}" for k in range(90)} | {"p"}))
    large = rows["LARGE"]
    assert (large.case_numbers, large.plaintiffs, large.brands, large.needs_review) == (numbers[:500] + "...", plaintiffs[:300] + "...", "b", "是")
    assert rows["C1"].case_numbers == ", ".join(sorted(n for n, *_, c, _, _ in [(m[0], m[3], m[4], m[5]) for m in matched] if c == "C1")) and rows["C1"].brands == "b"
    tables = reports.quality_by_suit(df, cases)
    assert {"ai_high", "ai_low", "not_found"} <= set(tables.columns)
