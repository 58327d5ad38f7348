"""Reference lists: merged blacklist, brand by Nice class, product categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import normalize_sheet_date, valid_date_text
from ..functions.text import (
    category_path,
    is_live,
    is_multi_word,
    is_safe,
    map_confidence,
    norm_category_cell,
    norm_cell,
    norm_nice_class,
    normalize_brand,
    sample_count,
    strip,
)
from .keys import first_by_key


def merge_blacklist(tro: DataFrame, other: DataFrame, today: str) -> DataFrame:
    """(brand_name, source, listed): brands of the first list by upper-case name, then those that only the other has.

    First spelling wins; the first list keeps its earliest date, the other the date of its first row.
    Both are (brand_name, source, listed, position).
    """
    rows = lambda df: df.withColumn("brand_name", strip(F.coalesce("brand_name", F.lit("")))).filter("brand_name <> ''").withColumn("key", F.upper("brand_name"))
    date = F.coalesce(F.nullif(normalize_sheet_date(F.col("listed")), F.lit("")), F.lit(today))
    own = rows(tro).groupBy("key").agg(F.min_by("brand_name", "position").alias("brand_name"), F.lit("TRO品牌").alias("source"), F.min(date).alias("listed"))
    rest = first_by_key(rows(other).join(own.select("key"), "key", "left_anti"), ["key"], ["position"])
    source = F.coalesce(F.nullif(strip(F.col("source")), F.lit("")), F.lit("其他")).alias("source")
    return own.unionByName(rest.select("key", "brand_name", source, date.alias("listed"))).orderBy("key").select("brand_name", "source", "listed")


def sync_blacklist(rows: DataFrame) -> DataFrame:
    """(brand_name, source, added_date, position) -> one normalised row for each upper-case brand."""
    clean = rows.withColumn("brand_name", normalize_brand(F.col("brand_name"))).filter(F.length("brand_name") >= 2)
    clean = first_by_key(clean.withColumn("brand_upper", F.upper("brand_name")), ["brand_upper"], ["position"])
    return clean.select(
        "brand_name",
        "brand_upper",
        F.nullif(strip(F.col("source")), F.lit("")).alias("source"),
        valid_date_text(F.col("added_date")).cast("date").alias("added_date"),
        is_multi_word(F.col("brand_name")).alias("is_multi_word"),
    )


def blacklist_stats(blacklist: DataFrame) -> DataFrame:
    return blacklist.agg(F.count("*").alias("total"), F.count_if("is_multi_word").alias("multi_word"), F.count_if(~F.col("is_multi_word")).alias("single_word"))


def brand_nice_class(rows: DataFrame) -> DataFrame:
    """Typed detail rows; rows without a brand go, repeats stay."""
    c = {name: norm_cell(F.col(name)) for name in rows.columns}
    return rows.filter(c["brand_name"].isNotNull()).select(
        c["real_company"].alias("real_company"),
        c["brand_name"].alias("brand_name"),
        F.upper(c["brand_name"]).alias("brand_upper"),
        c["serial_number"].alias("serial_number"),
        c["registration_number"].alias("registration_number"),
        c["status"].alias("status"),
        is_live(c["status"]).alias("is_live"),
        norm_nice_class(F.col("nice_class")).alias("nice_class"),
        c["nice_class_cn"].alias("nice_class_cn"),
        c["nice_class_en"].alias("nice_class_en"),
        c["goods_services"].alias("goods_services"),
    )


def nice_class_stats(brands: DataFrame) -> DataFrame:
    live = F.count_if("is_live")
    return brands.agg(
        F.count("*").alias("total"),
        live.alias("live"),
        F.when(F.count("*") > 0, F.round(100.0 * live / F.count("*"), 1)).alias("live_pct"),
        F.countDistinct("brand_upper").alias("brands"),
        F.countDistinct("nice_class").alias("classes"),
    )


def top_classes(brands: DataFrame, n: int = 5) -> DataFrame:
    return brands.filter("nice_class IS NOT NULL").groupBy("nice_class").agg(F.count("*").alias("brands")).orderBy(F.desc("brands"), "nice_class").limit(n)


#: The 20 columns of the category sheet, in order.
CATEGORY_COLUMNS = (
    "walmart_category", "walmart_ptg", "walmart_product_type", "c3", "c4", "l1", "l2", "l3", "bsr", "path", "confidence", "source",
    "sample", "c13", "sales_qualification", "cert", "ip_risk", "compliance_notes", "c18", "notes",
)


def category_map(rows: DataFrame) -> DataFrame:
    """Category rows (CATEGORY_COLUMNS, position) -> one row for each (path, product type)."""
    c = {name: norm_category_cell(F.col(name)) for name in rows.columns if name != "position"}
    path = category_path(c["path"], c["l1"], c["l2"], c["l3"])
    typed = rows.select(
        path.alias("amazon_path"),
        c["walmart_product_type"].alias("walmart_product_type"),
        c["walmart_category"].alias("walmart_category"),
        c["walmart_ptg"].alias("walmart_ptg"),
        *[c[x].alias(f"recommended_amazon_{x}") for x in ("l1", "l2", "l3", "bsr")],
        path.alias("recommended_amazon_path"),
        map_confidence(F.col("confidence")).alias("confidence"),
        sample_count(F.col("sample")).alias("history_sample_count"),
        c["source"].alias("source"),
        c["cert"].alias("cert_required_text"),
        c["ip_risk"].alias("ip_risk_level"),
        c["compliance_notes"].alias("compliance_notes"),
        c["sales_qualification"].alias("sales_qualification"),
        c["notes"].alias("notes"),
        is_safe(c["cert"], c["ip_risk"]).alias("is_safe"),
        "position",
    )
    kept = typed.filter("amazon_path IS NOT NULL AND walmart_product_type IS NOT NULL")
    return first_by_key(kept, ["amazon_path", "walmart_product_type"], ["position"]).drop("position")


def category_stats(mapped: DataFrame) -> DataFrame:
    """(kind, label, categories): counts by sales qualification and by risk."""
    one = lambda c: mapped.filter(F.col(c).isNotNull()).groupBy(F.lit(c).alias("kind"), F.col(c).alias("label")).agg(F.count("*").alias("categories"))
    return one("sales_qualification").unionByName(one("ip_risk_level"))
