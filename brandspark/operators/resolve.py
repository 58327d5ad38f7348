"""From the candidates of both paths to one company for each case."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import match_score

LEAST_SCORE = 0.3
MANY_OWNERS = 5


def _hits(path: DataFrame) -> DataFrame:
    return path.filter("match_type <> 'miss' AND owner_name IS NOT NULL").select("name", "owner_name").distinct()


def case_candidates(cases: DataFrame, path_a: DataFrame, path_b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(case_number, owner_name) of path A and of path B; paths are (name, owner_name).

    Cases have one row a number, as ``build_cases`` gives them, and a name's owners are distinct, so no pair repeats.
    """
    a = cases.filter("plaintiff_clean <> ''").join(_hits(path_a), F.col("plaintiff_clean") == F.col("name")).select("case_number", "owner_name")
    b = cases.filter("brand_clean <> '' AND NOT brand_eq_plaintiff").join(_hits(path_b), F.col("brand_clean") == F.col("name")).select("case_number", "owner_name")
    return a, b


def _shared(cases: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows of ``a`` (plaintiff, owner_name) for each (plaintiff, brand) of the cases whose brand has that owner in ``b``.

    From the pairs that occur to the plaintiff's owners; those of the brand only filter, so no owner multiplies names.
    """
    both = (F.col("plaintiff_clean") != "") & (F.col("brand_clean") != "") & ~F.col("brand_eq_plaintiff")
    pairs = cases.filter(both).select(F.col("plaintiff_clean").alias("plaintiff"), F.col("brand_clean").alias("brand")).distinct()
    return pairs.join(a, "plaintiff").join(b.withColumnRenamed("name", "brand"), ["brand", "owner_name"], "left_semi")


def overlap(cases: DataFrame, path_a: DataFrame, path_b: DataFrame) -> DataFrame:
    """(case_number, owner_name): owners that both paths give for a case, found for each pair of names."""
    shared = _shared(cases, _hits(path_a).withColumnRenamed("name", "plaintiff"), _hits(path_b))
    named = cases.filter("NOT brand_eq_plaintiff").select("case_number", F.col("plaintiff_clean").alias("plaintiff"), F.col("brand_clean").alias("brand"))
    return named.join(shared, ["plaintiff", "brand"]).select("case_number", "owner_name")


def resolve_companies(cases: DataFrame, path_a: DataFrame, path_b: DataFrame, mode: str = "v2") -> DataFrame:
    """(case_number, plaintiff_clean, brand_clean, real_company, match_quality, needs_review, review_reason).

    Owners are scored, counted and compared for each name and each pair of
    names; cases only look up what their names have come to.
    """
    a, b = _hits(path_a), _hits(path_b)
    score = F.round(match_score(F.col("plaintiff"), F.col("owner_name")), 12)
    first = lambda df, name, *key: df.groupBy(*key).agg(F.min(F.struct((-F.col("score")).alias("s"), "owner_name")).alias(name), F.count("*").alias(f"{name}_n"))
    scored = a.withColumnRenamed("name", "plaintiff").withColumn("score", score)
    best_a = first(scored, "a", "plaintiff")
    best_b = b.groupBy(F.col("name").alias("brand")).agg(F.count("*").alias("b_n"), F.min("owner_name").alias("b_first"))
    best_ab = first(_shared(cases, scored, b), "ab", "plaintiff", "brand")
    joined = cases.withColumn("ka", F.when(F.col("plaintiff_clean") != "", F.col("plaintiff_clean")))
    joined = joined.withColumn("kb", F.when((F.col("brand_clean") != "") & ~F.col("brand_eq_plaintiff"), F.col("brand_clean")))
    joined = joined.join(best_a, F.col("ka") == F.col("plaintiff"), "left").drop("plaintiff").join(best_b, F.col("kb") == F.col("brand"), "left").drop("brand")
    joined = joined.join(best_ab, (F.col("ka") == F.col("plaintiff")) & (F.col("kb") == F.col("brand")), "left").drop("plaintiff", "brand")
    if mode == "v1":  # where the plaintiff has no owner, those of the brand are scored by the plaintiff's name
        alone = cases.filter("brand_clean <> '' AND NOT brand_eq_plaintiff").select(F.coalesce("plaintiff_clean", F.lit("")).alias("plaintiff"), F.col("brand_clean").alias("brand")).distinct()
        alone = alone.join(best_a.select("plaintiff"), "plaintiff", "left_anti").join(b.withColumnRenamed("name", "brand"), "brand").withColumn("score", score)
        best = alone.groupBy("plaintiff", "brand").agg(F.min(F.struct((-F.col("score")).alias("s"), "owner_name")).alias("b"))
        joined = joined.join(best, (F.coalesce("plaintiff_clean", F.lit("")) == F.col("plaintiff")) & (F.col("kb") == F.col("brand")), "left").drop("plaintiff", "brand")
    n = F.coalesce("b_n", F.lit(0))
    sa = -F.col("a.s")
    case = F.when(F.col("ab_n") > 0, "exact").when(F.col("a_n").isNotNull() & (n > 0), "a_preferred").when(F.col("a_n").isNotNull(), "a_only")
    if mode == "v1":
        quality = case.when(n > 0, "b_only").otherwise("not_found")
        b_company, b_review = F.col("b.owner_name"), n > 1
        b_reason = F.concat(F.lit("multiple_b_owners: "), n, F.lit(", best_score="), F.format_string("%.3f", -F.col("b.s")))
    else:
        quality = case.when((n > 0) & (n <= MANY_OWNERS), "b_only").when(n > MANY_OWNERS, "b_uncertain").otherwise("not_found")
        b_company, b_review = F.col("b_first"), n > MANY_OWNERS
        b_reason = F.concat(F.lit("brand "), F.col("brand_clean"), F.lit(" has "), n, F.lit(" owners"))
    low = F.col("q").isin("a_preferred", "a_only") & (sa < LEAST_SCORE)
    of_b = F.col("q").isin("b_only", "b_uncertain")
    joined = joined.withColumn("q", quality)
    return joined.select(
        "case_number",
        "plaintiff_clean",
        "brand_clean",
        F.when(F.col("q") == "exact", F.col("ab.owner_name")).when(F.col("a_n").isNotNull(), F.col("a.owner_name")).when(of_b, b_company).alias("real_company"),
        F.col("q").alias("match_quality"),
        (low | (of_b & b_review) | (F.col("q") == "not_found")).alias("needs_review"),
        F.when(low, F.concat(F.lit("low_similarity: "), F.format_string("%.3f", sa)))
        .when(of_b & b_review, b_reason)
        .when(F.col("q") == "not_found", F.concat(F.lit("nature="), F.coalesce("nature_of_suit", F.lit(""))))
        .alias("review_reason"),
    )


def quality_distribution(matched: DataFrame) -> DataFrame:
    return matched.groupBy("match_quality").agg(F.count("*").alias("cases"), F.count_if("needs_review").alias("review"))


def resolved_companies(matched: DataFrame) -> DataFrame:
    return matched.select("real_company").filter("real_company IS NOT NULL").distinct()
