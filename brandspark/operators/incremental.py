"""Daily runs: only what is new is matched, merged and collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cases import new_companies, new_names, pending_cases, unique_brands, unique_plaintiffs
from .collect import collect_brands
from .lineage import stored
from .matching import match_mark_owners, match_marks, match_owner_names, match_owners
from .resolve import resolve_companies, resolved_companies


def process_pending(cases: DataFrame, matched: DataFrame, path_a: DataFrame, path_b: DataFrame, marks: DataFrame, details: DataFrame, registry: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """New versions of path_a, path_b, matched and details after the pending cases.

    Paths with a row for each mark go with ``marks`` as live marks; those of owners alone with ``matching.mark_holders``.
    """
    by_owner = "serial_number" not in path_a.columns
    of_names, of_brands = (match_owner_names, match_mark_owners) if by_owner else (match_owners, match_marks)
    pending = pending_cases(cases, matched)
    queried = lambda unique, results, name: unique.join(
        results.select(F.col("name").alias(name), F.col("match_type").alias("query_status")).distinct(), name, "left"
    )
    names = lambda results, name: results.select(F.col("name").alias(name))
    a = new_names(pending, names(path_a, "plaintiff_clean"), queried(unique_plaintiffs(cases), path_a, "plaintiff_clean"), "plaintiff_clean")
    b = new_names(pending.filter("NOT brand_eq_plaintiff"), names(path_b, "brand_clean"), queried(unique_brands(cases), path_b, "brand_clean"), "brand_clean")
    path_a = path_a.unionByName(stored(of_names(a.withColumnRenamed("plaintiff_clean", "name"), marks)))
    path_b = path_b.unionByName(stored(of_brands(b.withColumnRenamed("brand_clean", "name"), marks)))
    added = resolve_companies(pending, path_a, path_b)
    matched = matched.join(pending.select("case_number"), "case_number", "left_anti").select(*added.columns).unionByName(added)
    companies = new_companies(resolved_companies(matched), details)
    details = details.unionByName(collect_brands(companies, **registry).select(*details.columns))
    return {"path_a": path_a, "path_b": path_b, "matched": matched, "details": details}


def refresh_brands(matched: DataFrame, details: DataFrame, registry: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """All details anew, and (old, new, change) row counts."""
    fresh = collect_brands(resolved_companies(matched), **registry)
    counts = details.agg(F.count("*").alias("old_rows")).crossJoin(fresh.agg(F.count("*").alias("new_rows")))
    return fresh, counts.withColumn("change", F.col("new_rows") - F.col("old_rows"))
