import pytest
from pyspark.sql import functions as F

from brandspark.functions import dates, similarity, text

CASES = [
    (text.clean_plaintiff, [("Acme, Inc. | x", "Acme, Inc."), ("Acme; a Delaware corporation", "Acme"), ("A; B", "A; B"), ("Acme; 3200 Corporate Drive", "Acme"), ("Mega Delaware Corporation", "Meg"), (None, "")]),
    (text.clean_brand, [("MILWAUKEE TOOL 密尔沃基工具", "MILWAUKEE TOOL"), ("DESIGNICE珠宝", "DESIGNICE"), ("耐克Nike", "NIKE"), ("耐克", "耐克"), ("A", "A"), (None, "")]),
    (text.flip_person_name, [("Abraham Hunter", "Hunter, Abraham"), ("Holly Denise Simental", "Simental, Holly Denise"), ("One", None), ("a b c d", None)]),
    (text.norm_nice_class, [("25", "025"), ("IC 9", "009"), ("0", None), ("46", None), ("x", None)]),
    (text.map_confidence, [("真实_高", "0.95"), ("0.9", "0.9"), ("x", None)]),
    (text.normalize_brand, [(' "A  B" ', "A B"), (None, "")]),
    (text.registration_label, [("0000000", "(申请中)"), (None, "(申请中)"), ("1", "1")]),
    (text.flatten_cell, [('[{"text": "a"}, {"link": "b"}]', "ab"), (None, ""), ('{"text": "q"}', "q")]),
    (dates.parse_registry_date, [("20240229", "2024-02-29"), ("20240230", None), ("00000101", None), ("2024010", None), ("2024O101", None)]),
    (dates.parse_case_date, [("2024-1-2", "2024-01-02"), ("2024/01/02", "2024-01-02"), ("2024-01-02 03:04:05", "2024-01-02"), ("x", None)]),
    (dates.normalize_sheet_date, [("45000", "2023-03-15"), ("30000", "30000"), ("2026-04-10", "2026-04-10"), (" ", ""), (None, "")]),
    (similarity.word_boundary_pattern, [("a b", None)]),
]


@pytest.mark.parametrize("function,rows", CASES, ids=[f.__name__ for f, _ in CASES])
def test_rows(spark, function, rows):
    df = spark.createDataFrame([(k, v) for k, (v, _) in enumerate(rows)], "k int, v string")
    got = [r.x for r in df.select("k", function(F.col("v")).cast("string").alias("x")).orderBy("k").collect()]
    assert got == [want for _, want in rows]


def test_scores(spark):
    rows = [("Nike Inc", "NIKE, INC.", 1.0), ("The Company", "anything", 0.0), ("Red Blue", "Blue Sky", 0.5)]
    df = spark.createDataFrame(rows, "a string, b string, s double")
    assert all(r.x == r.s for r in df.select("s", similarity.match_score(F.col("a"), F.col("b")).alias("x")).collect())


def test_is_safe(spark):
    df = spark.createDataFrame([(None, None, True), ("FCC", "低", False), ("无", "高", False)], "c string, r string, s boolean")
    assert all(r.x == r.s for r in df.select("s", text.is_safe(F.col("c"), F.col("r")).alias("x")).collect())
