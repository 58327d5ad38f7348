"""Second chances for cases without a company."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import known_plaintiff, latin_brand
from .lineage import settled
from .matching import retry_brands, retry_owners


def _lost(matched: DataFrame, cases: DataFrame) -> DataFrame:
    return matched.filter("match_quality = 'not_found'").select("case_number").join(cases, "case_number")


def lost_plaintiffs(matched: DataFrame, cases: DataFrame) -> DataFrame:
    """(name): the known plaintiffs of cases without a company."""
    return _lost(matched, cases).filter(known_plaintiff(F.col("plaintiff_clean"))).select(F.col("plaintiff_clean").alias("name")).distinct()


def _by_brand(asked: DataFrame, marks: DataFrame) -> DataFrame:
    """(case_number, companies) of cases with a brand in letters that equals a mark."""
    asked = asked.filter(latin_brand(F.col("brand_clean")))
    found = retry_brands(asked.select(F.col("brand_clean").alias("name")), marks)
    return asked.join(found, F.col("brand_clean") == F.col("name")).select("case_number", "companies")


def retry_brand_only(matched: DataFrame, cases: DataFrame, marks: DataFrame) -> DataFrame:
    """(case_number, companies) of cases without a company and without a plaintiff, by their brand."""
    return _by_brand(_lost(matched, cases).filter("coalesce(plaintiff_clean, '') = ''"), marks)


def retry_not_found(matched: DataFrame, cases: DataFrame, marks: DataFrame) -> DataFrame:
    """(case_number, strategy, source, companies): by plaintiff (a), else by brand (b); by brand where there is no plaintiff."""
    lost = _lost(matched, cases)
    named = lost.filter(known_plaintiff(F.col("plaintiff_clean")))
    by_name = named.join(retry_owners(lost_plaintiffs(matched, cases), marks), F.col("plaintiff_clean") == F.col("name"))
    by_name = settled(by_name.select("case_number", "strategy", F.lit("a").alias("source"), "companies"))
    left = named.join(by_name.select("case_number"), "case_number", "left_anti")
    by_brand = _by_brand(left, marks).unionByName(retry_brand_only(matched, cases, marks))
    return by_name.unionByName(by_brand.select("case_number", F.lit("brand_exact").alias("strategy"), F.lit("b").alias("source"), "companies"))
