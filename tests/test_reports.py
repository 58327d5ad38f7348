import random

import pytest
from pyspark.sql import functions as F

from brandspark.operators import collect, reports
from brandspark.sources import readers
from test_collect import _registry


@pytest.fixture(scope="module")
def parts(spark):
    companies = spark.createDataFrame([("A Inc.",), ("B Inc.",)], "real_company string")
    registry = _registry(spark, random.Random(12))
    # codes that are empty, with white space, and without a name
    odd = spark.createDataFrame([(k, c, None) for k in range(0, 40, 3) for c in ("", "002 ", "zz")], registry["classes"].schema)
    registry["classes"] = registry["classes"].unionByName(odd)
    return collect.collect_brands(companies, **registry).localCheckpoint(), [p.localCheckpoint() for p in collect.detail_parts(companies, **registry)]


def test_report_in_groups_equals_the_plain_one(spark, parts):
    details, (marks, classes, names, goods) = parts
    rng = random.Random(13)
    keys = details.select("real_company", "mark_identification", "serial_number", F.coalesce("international_code", F.lit(""))).distinct().collect()
    old = [(f" {c}", m, str(s), n, rng.choice(["2020-01-01", "2021-01-01", "", None]), k) for k, (c, m, s, n) in enumerate(rng.choices(keys, k=len(keys)))]
    previous = spark.createDataFrame([*old, ("gone", "AX", "1", "001", "2019-01-01", 9), ("A Inc.", "AX", None, None, "x", 8)], "real_company string, mark_identification string, serial_number string, nice_class string, listed string, position long")
    plain = reports.brand_detail_report(details, previous, "2024-06-01")
    codes, groups = reports.report_groups(marks, classes, names, goods)
    report = reports.ordered_detail_report(groups, codes, names, reports.listings(previous, codes), "2024-06-01")
    got, want = [tuple(r) for r in report.select(plain.columns).collect()], [tuple(r) for r in plain.collect()]
    assert sorted(got) == sorted(want) and len(want) > 40 and len({w[-1] for w in want}) == 3
    assert [(g[0], g[1], g[5]) for g in got] == [(w[0], w[1], w[5]) for w in want]  # in the report's order
    # what is dealt over tasks are groups, not rows: classes are multiplied above the last exchange
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(places") < plan.index("RepartitionByExpression")


def test_places_of_details_equal_those_of_the_sink(spark, parts, monkeypatch):
    details, (marks, classes, _, _) = parts
    rows = details.filter("mark_identification <> ''").select("real_company", "mark_identification", F.coalesce("international_code", F.lit("")).alias("nice_class"), F.col("serial_number").cast("string").alias("serial_number")).distinct()
    want = {tuple(r) for r in readers.placed(rows, [F.asc(c) for c in rows.columns]).collect()}
    for size in (500_000, 7):
        monkeypatch.setattr(reports, "ROWS_A_PART", size)
        got = [tuple(r) for r in reports.placed_details(marks, classes).collect()]
        assert len(got) == len(want) and set(got) == want
