"""All live marks of resolved companies, with classes and goods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def detail_parts(
    companies: DataFrame, trademarks: DataFrame, owners: DataFrame, status: DataFrame, classes: DataFrame, nice: DataFrame, statements: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What the details of a serial number are the product of: its marks of each company, its classes, their names, its goods statements.

    Each part is distinct and has its key, so their product is distinct without being compared row by row.
    """
    wanted = companies.select(F.col("real_company").alias("party_name")).distinct()
    serials = owners.select("serial_number", "party_name").distinct().join(wanted, "party_name", "left_semi")
    live = F.broadcast(status.filter("live_dead = 'LIVE'").select("status_code", "live_dead", "category").distinct())
    marks = trademarks.select("serial_number", "mark_identification", "registration_number", "status_code").join(live, "status_code").distinct()
    marks = marks.join(serials.withColumnRenamed("party_name", "real_company"), "serial_number")
    names = nice.select(F.col("code").alias("international_code"), F.col("name_cn").alias("international_desc_cn"), F.col("name_en").alias("international_desc_en")).distinct()
    own = classes.select("serial_number", "international_code", "first_use_date").distinct()
    goods = statements.filter(F.col("type_code").startswith("GS")).select("serial_number", F.col("text").alias("goods_services")).distinct()
    return marks, own, names, goods


def collect_brands(
    companies: DataFrame, trademarks: DataFrame, owners: DataFrame, status: DataFrame, classes: DataFrame, nice: DataFrame, statements: DataFrame
) -> DataFrame:
    """Distinct details: each class of a mark with each of its goods statements.

    The wanted serial numbers are found first and cut the other tables.
    """
    marks, own, names, goods = detail_parts(companies, trademarks, owners, status, classes, nice, statements)
    own = own.join(names, "international_code", "left")
    return marks.join(own, "serial_number", "left").join(goods, "serial_number", "left").select(
        "real_company", "mark_identification", "serial_number", "registration_number", "status_code", "live_dead", "category",
        "international_code", "international_desc_cn", "international_desc_en", "goods_services", "first_use_date",
    )


def collection_summary(details: DataFrame) -> DataFrame:
    return details.agg(F.countDistinct("real_company").alias("companies"), F.countDistinct("mark_identification").alias("marks"), F.count("*").alias("row_count"))


def company_brand_pairs(details: DataFrame) -> DataFrame:
    return details.filter("mark_identification <> ''").select("real_company", "mark_identification").distinct()
