"""Windows over keys: latest, first, and capped rows; upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("__place", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("__place") <= n).drop("__place")


def latest_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row of each key; nested children stay with the row that wins."""
    return _ranked(df, key, [F.col(c).desc_nulls_last() for c in order], 1)


def first_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return _ranked(df, key, [F.col(c).asc_nulls_last() for c in order], 1)


def cap_per_key(df: DataFrame, key: list[str], order: list[Column], n: int | None) -> DataFrame:
    return df if n is None else _ranked(df, key, order, n)


def upsert(base: DataFrame, delta: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``base`` with the last rows of ``delta`` in place of those of the same key."""
    return base.join(delta.select(*key).distinct(), key, "left_anti").unionByName(latest_by_key(delta, key, order).select(*base.columns))


def upsert_children(base: DataFrame, delta_parents: DataFrame, delta_children: DataFrame, key: str) -> DataFrame:
    """Children of replaced parents go, those of the new ones come."""
    return base.join(delta_parents.select(key).distinct(), key, "left_anti").unionByName(delta_children.select(*base.columns))


def upsert_counts(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """One row: keys inserted and keys updated."""
    known = base.select(key).distinct().withColumn("known", F.lit(True))
    return delta.select(key).distinct().join(known, key, "left").agg(
        F.count_if(F.col("known").isNull()).alias("inserted"), F.count_if(F.col("known").isNotNull()).alias("updated")
    )


def carry_first_seen(current: DataFrame, previous: DataFrame, keys: list[str], today: Column, name: str = "listed") -> DataFrame:
    """Adds the earlier listing date of each key, else ``today``; of keys that repeat the last row wins."""
    trimmed = previous.select(*[F.trim(k).alias(k) for k in keys], F.col(name).alias("__d"), "position")
    dates = latest_by_key(trimmed, keys, ["position"]).select(*[F.col(k).alias(f"__{k}") for k in keys], "__d")
    on = [F.trim(F.col(k)) == F.col(f"__{k}") for k in keys]
    joined = current.join(dates, on, "left")
    return joined.select(*current.columns, F.coalesce(F.nullif(F.col("__d"), F.lit("")), today).alias(name))
