import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_line_dedup import brute as brute_lines
from test_packing import check as check_pieces

import corpus_pipeline
from brandspark.llm import language_id, mixing
from brandspark.llm.common import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts):
    return spark.createDataFrame([(k, v, "en", f"s{k % 3}", len(v or "")) for k, v in texts.items()], SCHEMA)


def texts_of(df):
    rows = df.collect()
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    return {r.doc_id: r.text for r in rows}


def expected_lines(texts):
    out, seen = {}, set()
    for k, text in sorted(brute_lines(texts.items()).items()):
        kept = []
        for line in text.split("\n"):
            x = line.strip(" \t\n\x0b\x0c\r")
            if not 0 < len(x) < 20 or x not in seen:
                kept.append(line)
            seen.add(x)
        out[k] = "\n".join(kept)
    return {k: v for k, v in out.items() if v == texts[k] or WORD.search(v)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def expected_near_copies(texts):
    """The least document of each group linked by a five-word Jaccard of 0.8 or more."""
    sets, kept, left = {k: shingles(v) for k, v in texts.items()}, {}, set(texts)
    for k in sorted(texts):
        stack = [k] if k in left else []
        if stack:
            kept[k] = texts[k]
        while stack:
            a = stack.pop()
            left.discard(a)
            near = {b for b in left if b == a or sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
            left -= near
            stack += near
    return kept


def check_mixture(docs, mixed):
    size = {r.doc_id: Counter(WORD.findall(r.text or "")) for r in docs.collect()}
    taken = {r.doc_id: r.taken for r in mixing.mix(docs)[0].collect() if r.taken}
    got = {r.doc_id: Counter(WORD.findall(r.text)) for r in mixed.collect()}
    assert {k: v.total() for k, v in got.items()} == taken
    for k, words in got.items():
        times = -(-taken[k] // size[k].total())
        assert all(n <= times * size[k][w] for w, n in words.items())


@pytest.mark.parametrize("n, changes", [(45, 1), (46, 1), (49, 1), (50, 1), (44, 1), (92, 2), (140, 3)])
def test_near_copies_at_the_bound(spark, n, changes):
    base = [f"w{k}" for k in range(n + 4)]
    copy = list(base)
    for k in range(changes):
        copy[10 + 30 * k] = f"x{k}"
    texts = {1: " ".join(base), 2: " ".join(copy), 3: "quite another text of its own words"}
    got = texts_of(corpus_pipeline.near_copies(spark, table(spark, texts), ""))
    assert got == expected_near_copies(texts)
    assert (2 in got) == ((n - 5 * changes) / (n + 5 * changes) < 0.8)


def test_near_copies_of_documents(spark, sf):
    docs = read(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.text for r in corpus_pipeline.near_copies(spark, docs, sf).collect()} == expected_near_copies(texts)


def test_lines_equal_brute_force(spark):
    rng = random.Random(4)
    base = [f"line {k} of some length {k * 7}" for k in range(8)]
    texts = {k: "\n".join(rng.choice(base) + rng.choice(["", "x", " "]) for _ in range(rng.randint(1, 4))) for k in range(40)} | {50: "", 51: "  "}
    assert texts_of(corpus_pipeline.lines(spark, table(spark, texts), "")) == expected_lines(texts)


def test_short_lines_equal_brute_force(spark):
    texts = {1: "end\n\nend \nEnd", 2: "ends\n\n end\nx", 3: "x", 4: "a line of some length that stays\nx\nsame nineteen chars", 5: "y\nsame nineteen chars"}
    got = texts_of(corpus_pipeline.lines(spark, table(spark, texts), ""))
    assert got == expected_lines(texts)
    assert got == {1: "end\n\nEnd", 2: "ends\n\nx", 4: "a line of some length that stays\nsame nineteen chars", 5: "y"}


def test_run_equals_its_stages_by_brute_force(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    small = pq.read_table(f"{folder}/documents.parquet").to_pylist()
    small = [r for r in small if len(r["text"] or "") < 3000][:120]
    schema = pq.read_schema(f"{folder}/documents.parquet")
    pq.write_table(pa.Table.from_pylist(small, schema), tmp_path / "documents.parquet")
    docs = read(spark, str(tmp_path), "documents")

    known = {r.id: r.lang for r in language_id.accepted(language_id.identify(docs, language_id.fit(docs), "doc_id", "text", declared_col="lang", host_col="source")).collect()}
    found = corpus_pipeline.language(spark, docs, "")
    assert found.columns == docs.columns
    assert {r.doc_id: (r.lang, r.text) for r in found.collect()} == {r["doc_id"]: (known[r["doc_id"]], r["text"]) for r in small if r["doc_id"] in known}

    rows = {r["doc_id"]: r for r in small}
    texts = expected_near_copies(expected_lines({k: rows[k]["text"] for k in known}))
    left = [{**rows[k], "text": v, "lang": known[k], "n_chars": len(v)} for k, v in sorted(texts.items())]
    kept = spark.createDataFrame([tuple(r[c] for c in docs.columns) for r in left], docs.schema)
    mixed = corpus_pipeline.mixture(spark, kept, "")
    check_mixture(kept, mixed)
    check_pieces(corpus_pipeline.run(spark, str(tmp_path)).collect(), texts_of(mixed))


ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, `found_` int, runs string, `key` string, __removed string, __lang string, __runs string, rid string"


def odd(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "r", 1, "u", "k", "m", "l", "n", "d") for i, t, s in rows], ODD)


A = "the first text of all has words enough for some shingles of five words each"
B = "another text that is a copy of nothing here and that nobody may lose at all"


def test_near_copies_keep_texts_that_share_a_doc_id(spark):
    docs = odd(spark, [(1, A, "x"), (2, A, "x"), (2, B, "y"), (None, A, "x"), (3, B, "y"), (3, B, "y"), (5, None, "z"), (5, None, "z"), (5, "", None), (None, "", None)])
    got = corpus_pipeline.near_copies(spark, docs, "")
    assert got.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert left == sorted([(1, A), (2, B), (5, None), (5, None), (5, ""), (None, "")], key=str)


def test_near_copies_one_name_for_two_groups(spark):
    docs = odd(spark, [(5, A, "x"), (6, A, "x"), (5, B, "y"), (6, B, "y"), (5, A, "q"), (5, A, "q")])
    assert sorted((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == sorted([(5, A), (5, B)])


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_names(spark, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    long = " ".join(f"word{k % 997}x{k}" for k in range(60_000))
    rows = [(1, A, "x"), (1, A, "x"), (2, B, None), (None, B + " more", "y"), (3, None, None), (None, None, None), (4, "", ""), (5, " \n ", "x"), (6, long, "x")]
    docs = odd(spark, rows)
    got = run(spark, docs, "")
    kept = got.collect()
    if stage != "packed":
        assert got.columns == docs.columns and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
        assert all((r.row, r.found_, r.runs, r.key, r["__removed"], r["__lang"], r["__runs"], r.rid) == ("r", 1, "u", "k", "m", "l", "n", "d") for r in kept)
        left = Counter((r.doc_id, r.text) for r in kept)
        texts = [(i, t) for i, t, _ in rows]
        empty = [(3, None), (None, None), (4, ""), (5, " \n ")]
        if stage == "language":
            assert not set(empty) & set(left) and left[1, A] in (0, 2) and left[6, long] == 1 and left <= Counter(texts)
        elif stage == "lines":
            assert left == Counter(texts)  # rows equal in doc_id and text keep the same lines
        elif stage == "near_copies":
            assert left == Counter(set(texts) - {(None, B + " more")})  # near (2, B)
        else:
            assert not set(empty) & set(left) and (6 in {r.doc_id for r in kept})
    else:
        assert {r.doc_id for r in kept} == {1, 2, 3, 4, 5, 6, None}
    assert run(spark, docs.limit(0), "").collect() == []
