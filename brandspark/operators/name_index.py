"""A stored index of trigrams that name searches share.

Each name's distinct trigrams are ordered by how rare they are among the names.
A name and a query that are similar by ``least`` share one of the first
``a - ceil(least * a) + 1`` of either, so only this prefix is listed: rows (gram,
place in the order, number of trigrams, name id).  Lists lie in buckets of the
gram and are sorted by it in each file, so a search reads the buckets and row
groups of its own grams; lengths and places rule out most rows of a list before
sets of grams are compared, which are stored as 64-bit hashes of grams.  Names are
looked up for what is found.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.similarity import trigrams
from .keys import cap_per_key
from .lineage import settled, stored

#: Grams of queries up to which their list is handed to the scan as a filter; a search with more joins without it.
FEW_GRAMS = 10_000
#: Places of queries' grams up to which they are sent to the lists; beyond, both are dealt by gram.
FEW_ASKED = 200_000


@dataclass(frozen=True)
class NameIndex:
    spark: SparkSession
    root: str
    least: float
    buckets: int

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")


def _prefix(size: Column, least: float) -> Column:
    return size - F.ceil(size * F.lit(least) - 1e-9) + 1


def _ordered(rows: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """(key, size, g, place): the trigrams of each row, the rarest first; unknown ones count as rarest."""
    dealt = rows.select(key, "t").repartition(key)  # whole sets take less room than their grams, and stay in place behind
    grams = dealt.select(key, F.size("t").alias("size"), F.explode("t").alias("g")).join(counts, "g", "left")
    return grams.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.coalesce("n", F.lit(0)), "g"))).drop("n")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("g"), F.lit(buckets)).cast("int").alias("bucket")


def _hashes(grams: str) -> Column:
    return F.transform(grams, lambda g: F.xxhash64(g))


def build_name_index(names: DataFrame, root: str, least: float = 0.3, buckets: int = 64) -> NameIndex:
    """Index the distinct values of the column ``name`` for searches of ``least`` or more; they may be names or long texts.

    Equality of names is taken by their 64-bit hash inside the index.
    """
    rows = names.select("name").filter("name IS NOT NULL").distinct().withColumns({"id": F.xxhash64("name"), "t": trigrams(F.col("name"))})
    rows = stored(rows.filter(F.size("t") > 0))
    rows.select("id", "name").write.mode("overwrite").parquet(f"{root}/names")
    rows.select("id", _hashes("t").alias("s")).write.mode("overwrite").parquet(f"{root}/sets")
    rows.select(F.explode("t").alias("g")).groupBy("g").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{root}/counts")
    spark = names.sparkSession
    lists = _ordered(rows, "id", spark.read.parquet(f"{root}/counts")).filter(F.col("place") <= _prefix(F.col("size"), least))
    lists = lists.select(_bucket(buckets), "g", F.col("place").cast("int"), F.col("size").cast("int"), "id")
    # a frequent gram may be in several files of its bucket
    dealt = lists.repartition("bucket", F.pmod("id", F.lit(8))).sortWithinPartitions("bucket", "g", "size")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/lists")
    return NameIndex(spark, root, least, buckets)


def search_names(index: NameIndex, queries: DataFrame, least: float | None = None, top: int | None = 5) -> DataFrame:
    """(query, name, sim): trigram similarity of ``least`` or more, the best ``top`` of each query, ties by name."""
    least = index.least if least is None else least
    if least < index.least:
        raise ValueError(f"the index serves similarities of {index.least} or more")
    q = settled(queries.select("query").distinct().withColumns({"qid": F.xxhash64("query"), "t": trigrams(F.col("query"))}))
    asked = _ordered(q, "qid", index.table("counts")).filter(F.col("place") <= _prefix(F.col("size"), least))
    asked = settled(asked.select("qid", "g", _bucket(index.buckets), F.col("size").alias("q_size"), F.col("place").alias("q_place")))
    lists = index.table("lists")
    grams = asked.select("g", "bucket").distinct()
    if grams.count() <= FEW_GRAMS:
        wanted = grams.collect()
        lists = lists.filter(F.col("bucket").isin(sorted({r["bucket"] for r in wanted})) & F.col("g").isin(sorted({r["g"] for r in wanted})))
    # what is left of either set behind the common gram bounds what they can share
    most = 1 + F.least(F.col("q_size") - F.col("q_place"), F.col("size") - F.col("place"))
    if asked.count() <= FEW_ASKED:  # lists are dealt by name, so that a pair's places meet in one task
        asked, lists = F.broadcast(asked), lists.repartition("id")
    met = asked.join(lists, ["bucket", "g"]).filter((F.col("size") >= F.lit(least) * F.col("q_size") - 1e-9) & (F.col("q_size") >= F.lit(least) * F.col("size") - 1e-9))
    # grams have one order, so the first common one has the least place in either; sums of numbers alone are hashed, not sorted
    first = met.groupBy("qid", "id").agg(*[F.min(c).alias(c) for c in ("q_place", "place", "q_size", "size")])
    reach = most / (F.col("q_size") + F.col("size") - most)
    pairs = first.filter(reach >= F.lit(least) - 1e-9).select("qid", "id", "q_size", "size")
    both = F.size(F.array_intersect("s", "h"))
    scored = pairs.join(index.table("sets"), "id").join(q.select("qid", _hashes("t").alias("h")), "qid")
    scored = scored.select("qid", "id", (both / (F.col("q_size") + F.col("size") - both)).alias("sim")).filter(F.col("sim") >= least)
    found = scored.join(index.table("names"), "id").join(q.select("qid", "query"), "qid").select("query", "name", "sim")
    return cap_per_key(found, ["query"], [F.col("sim").desc(), F.col("name")], top)
