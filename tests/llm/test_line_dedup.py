import random

import duckdb
import pytest

from brandspark.llm.common import read
from brandspark.llm.line_dedup import ORACLE, line_dedup


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(rows, least=20):
    out, seen = {}, []
    for doc, text in sorted(rows):
        kept = []
        for line in text.split("\n"):
            x = line.strip(" \t\n\x0b\x0c\r")
            if len(x) >= least:
                gone = any(abs(len(x) - len(y)) <= 1 and edits(x, y) <= 1 for y in seen)
                seen.append(x)
                if gone:
                    continue
            kept.append(line)
        out[doc] = "\n".join(kept)
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, line int")
    result = line_dedup(docs)
    assert result.columns == [*docs.columns, "__removed"]
    return {r.doc_id: r.text for r in result.collect()}


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(18, 26))) for _ in range(6)]

    def line():
        x = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(x))
            x[at : at + rng.randint(0, 1)] = [rng.choice("abé")] if rng.random() < 0.6 else []
        return rng.choice(["", " ", "\t"]) + "".join(x) + rng.choice(["", "  "])

    rows = [(k, "\n".join(line() for _ in range(rng.randint(1, 5)))) for k in range(60)]
    assert run(spark, rows) == brute(rows)


def test_documents_equal_sql(spark, sf):
    docs = read(spark, sf, "documents")
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = {r[0]: (r[1], r[3]) for r in duckdb.sql(ORACLE).fetchall()}
    from brandspark.llm.line_dedup import query

    assert {r.doc_id: (r.n_removed, r.kept_md5) for r in query(spark, sf).collect()} == want


def test_edges(spark):
    long = "z" * 100_000
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, long), (5, long + "y"), (6, "short\nshort"), (7, "a line of some length\na line of some length\nend")]
    got = run(spark, rows)
    assert got == {1: None, 2: "", 3: "\n\n", 4: long, 5: "", 6: "short\nshort", 7: "a line of some length\nend"}
    docs = spark.createDataFrame([(1, "the same line in a repeated row")] * 2 + [(2, "the same line in a repeated row")], "doc_id long, text string")
    assert sorted(r.text for r in line_dedup(docs).collect()) == ["", *["the same line in a repeated row"] * 2]
    assert line_dedup(docs.limit(0)).count() == 0


def test_columns_of_internal_names_stay(spark):
    line = "the same line in two rows"
    docs = spark.createDataFrame([(1, line, 3, [5], "x", 1), (2, line + "\nend", 4, None, "y", 2)], "doc_id long, text string, dk int, removed array<int>, `a.b` string, __removed int")
    got = line_dedup(docs)
    assert got.columns == ["doc_id", "text", "dk", "removed", "a.b", "__removed"]
    assert sorted(map(tuple, got.collect())) == [(1, line, 3, [5], "x", 0), (2, "end", 4, None, "y", 1)]
