"""Court cases: typed rows, unique names, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_case_date
from ..functions.text import brand_eq_plaintiff, clean_brand, clean_plaintiff, strip
from .keys import first_by_key, latest_by_key


def build_cases(raw: DataFrame, keep: str = "last") -> DataFrame:
    """Rows (case_number, date_filed, nature_of_suit, plaintiff, brand, position) -> cases; of a number that repeats one stays."""
    text = lambda c: strip(F.coalesce(F.col(c).cast("string"), F.lit("")))
    date = F.col("date_filed") if raw.schema["date_filed"].dataType.simpleString() == "date" else parse_case_date(F.col("date_filed"))
    rows = raw.select(
        text("case_number").alias("case_number"),
        date.alias("date_filed"),
        text("nature_of_suit").alias("nature_of_suit"),
        text("plaintiff").alias("plaintiff_raw"),
        text("brand").alias("brand_raw"),
        "position",
    ).filter("case_number <> ''")
    one = (latest_by_key if keep == "last" else first_by_key)(rows, ["case_number"], ["position"]).drop("position")
    one = one.withColumns({"plaintiff_clean": clean_plaintiff(F.col("plaintiff_raw")), "brand_clean": clean_brand(F.col("brand_raw"))})
    same = brand_eq_plaintiff(*map(F.col, ("plaintiff_raw", "brand_raw", "plaintiff_clean", "brand_clean")))
    return one.withColumn("brand_eq_plaintiff", same)


def unique_plaintiffs(cases: DataFrame) -> DataFrame:
    return cases.filter("plaintiff_clean <> ''").groupBy("plaintiff_clean").agg(F.count("*").alias("case_count"))


def unique_brands(cases: DataFrame) -> DataFrame:
    return cases.filter("brand_clean <> '' AND NOT brand_eq_plaintiff").groupBy("brand_clean").agg(F.count("*").alias("case_count"))


def case_summary(cases: DataFrame) -> DataFrame:
    return cases.agg(F.count("*").alias("total"), F.count_if("brand_eq_plaintiff").alias("brand_eq"))


def pending_cases(cases: DataFrame, matched: DataFrame) -> DataFrame:
    return cases.join(matched.select("case_number").distinct(), "case_number", "left_anti")


def new_names(pending: DataFrame, results: DataFrame, unique: DataFrame, name: str) -> DataFrame:
    """Names of pending cases that have no result and were not queried before."""
    queried = unique.filter(F.col("query_status").isin("exact", "fuzzy", "miss")).select(name)
    names = pending.filter(F.col(name) != "").select(name).distinct()
    return names.join(results.select(name).distinct(), name, "left_anti").join(queried.distinct(), name, "left_anti")


def new_companies(companies: DataFrame, details: DataFrame) -> DataFrame:
    return companies.select("real_company").filter("real_company IS NOT NULL").distinct().join(details.select("real_company").distinct(), "real_company", "left_anti")
