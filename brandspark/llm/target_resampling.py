"""Resampling of documents towards a target distribution, over distinct lines.

Texts and targets are bags of hashed word n-grams.  A bucket's gain is the log
ratio of its smoothed frequencies in the targets and in the documents; a
document's weight is the mean gain of its features.  Documents are drawn without
replacement by the largest weights with Gumbel noise that is fixed by doc_id.

Words never hold a newline, so separator newlines cut a text into lines: each
distinct line's features are counted once and multiplied by how often the line
occurs, and only n-grams that reach over a line's end (where n-grams are longer
than one word) are counted in each text.

Plan: lines are pre-aggregated in the tasks that read them, so a line that
stands everywhere travels once a task; their features likewise, into at most
``buckets`` sums.  Weights need no shuffle: the gains (one number a bucket) go
to the rows.  Ranks come from one range partitioning of (score, doc_id) rows
without texts, in which equal rows are one row with a count, and from the
totals of its partitions.

Edge cases: a null or empty text has no features, weight 0, and too few words
to be drawn; a null doc_id is the empty string in the noise and comes last among
equal scores; repeated rows have ranks of their own, side by side; words of any
length and texts of any length are read whole; extra columns are ignored;
an empty documents table gives an empty result, an empty target gives gains by
smoothing alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read, saved

BUCKETS = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words after lower-casing: digits, letters a to z, and all beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; of a null text none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def grams(words: Column, width: int) -> Column:
    """All runs of 1 to ``width`` words, joined by a space."""

    def of(k: int) -> Column:
        run = lambda i: F.array_join(F.slice(words, i, k), " ")
        return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), run)).otherwise(F.array().cast("array<string>"))

    return words if width == 1 else F.concat(words, *[of(k) for k in range(2, width + 1)])


def crossing(words: Column, line: Column, width: int) -> Column:
    """The runs of 2 to ``width`` words that reach over the end of a line; ``line`` has the number of each word's line.

    Both have to be columns, as each is looked into again and again.
    """

    def of(k: int) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.element_at(line, i) != F.element_at(line, i + (k - 1)))
        runs = F.transform(starts, lambda i: F.array_join(F.slice(words, i, k), " "))
        return F.when(F.size(words) >= k, runs).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(k) for k in range(2, width + 1)])


def bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def feature_counts(texts: DataFrame, width: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often the features of each bucket occur in the column ``text``."""
    pieces = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n", -1)
    lines = texts.select(F.explode(pieces).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    counted = lines.select(terms(F.col("line")).alias("words"), "times").select(F.explode(grams(F.col("words"), width)).alias("f"), "times")
    if width > 1:
        of_lines = texts.select(F.transform(pieces, terms).alias("lines"))
        number = F.flatten(F.transform("lines", lambda w, k: F.array_repeat(k, F.size(w))))
        flat = of_lines.select(F.flatten("lines").alias("words"), number.alias("line"))
        over = flat.select(F.explode(crossing(F.col("words"), F.col("line"), width)).alias("f"), F.lit(1).cast("long").alias("times"))
        counted = counted.unionByName(over)
    return counted.groupBy(bucket(F.col("f"), buckets).alias("bucket")).agg(F.sum("times").alias("n"))


def gains(documents: DataFrame, target: DataFrame, width: int = 1, buckets: int = BUCKETS) -> list[int]:
    """The gain of each bucket, in thousandths."""
    counts = []
    for texts in (documents, target):
        of = [0] * buckets
        for r in feature_counts(texts, width, buckets).collect():
            of[r["bucket"]] = r["n"]
        counts.append(of)
    s, t = counts
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000.0 * math.log((b + 1.0) * all_s / ((a + 1.0) * all_t))) for a, b in zip(s, t, strict=True)]


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of the seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scored(documents: DataFrame, gain: list[int], width: int = 1, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    table = documents.sparkSession.createDataFrame([(gain,)], "gains array<long>")  # one row, whatever the corpus
    words = documents.select(F.col("doc_id").cast("long").alias("doc_id"), terms(F.col("text")).alias("words")).crossJoin(F.broadcast(table))
    rows = words.select("doc_id", F.size("words").cast("long").alias("n_words"), grams(F.col("words"), width).alias("f"), "gains")
    total = F.aggregate("f", F.lit(0).cast("long"), lambda a, x: a + F.get("gains", bucket(x, len(gain))))
    rows = rows.select("doc_id", "n_words", F.size("f").cast("long").alias("n_features"), total.alias("total"))
    # floors go down: an integer mean by the remainder that is never negative
    mean = F.when(F.col("n_features") == 0, F.lit(0).cast("long")).otherwise(F.expr("(total - pmod(total, n_features)) div n_features"))
    rows = rows.select("doc_id", "n_words", "n_features", mean.alias("weight"))
    return rows.withColumn("score", (F.col("weight") + noise(F.col("doc_id"), seed)).cast("long"))


def ranked(rows: DataFrame, least_words: int = 20, share: tuple[int, int] = (10, 100)) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, ... by falling score, then doc_id, of the share of eligible rows that is drawn; else null."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    equal = saved(rows.groupBy("doc_id", "n_words", "n_features", "weight", "score").agg(F.count("*").alias("n")))
    fit = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    placed = equal.filter(fit).repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    placed = saved(placed)
    totals = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one row a partition
    drawn, before, starts = sum(totals.values()) * share[0] // share[1], 0, []
    for part in sorted(totals):
        starts.append((part, before))
        before += totals[part]
    starts = rows.sparkSession.createDataFrame(starts, "part int, start long")
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("last", F.sum("n").over(inside)).join(F.broadcast(starts), "part")
    copies = placed.select("*", F.explode(F.sequence(F.col("start") + F.col("last") - F.col("n") + 1, F.col("start") + F.col("last"))).alias("place"))
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    rest = equal.filter(~fit).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("place"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return copies.select(*columns, rank.alias("rank")).unionByName(rest.select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(documents: DataFrame, target: DataFrame, width: int = 1, buckets: int = BUCKETS, seed: int = 2024, least_words: int = 20, share: tuple[int, int] = (10, 100)) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it is not drawn."""
    return ranked(scored(documents, gains(documents, target, width, buckets), width, seed), least_words, share)


def query(spark, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


#: The same over the whole tables; the checksum is worked out bit by bit, once for each distinct word.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT 'd' AS side, rid, unnest(x) AS word FROM (
    SELECT row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM documents)
  UNION ALL
  SELECT 't', 0, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark
), v AS (
  SELECT DISTINCT word FROM w
), bits AS (
  SELECT unnest(range(256)) AS i
), crc_table AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t FROM bits
), b AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || substr(hex(word), 2 * k - 1, 2))::BIGINT FOR k IN range(1, strlen(word) + 1)]),
    lambda c, z: xor(c // 256, t[1 + xor(c % 256, z)])), 4294967295) % 10000 AS bucket FROM v, crc_table
), n AS (
  SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 't') AS t FROM w JOIN b USING (word) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000)::DOUBLE)))::BIGINT AS gain FROM n
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, text FROM documents
), f AS (
  SELECT rid, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight FROM w JOIN b USING (word) JOIN g USING (bucket) WHERE side = 'd' GROUP BY rid
), sc AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN f USING (rid)
), r AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM sc
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
  CASE WHEN place <= (SELECT count(*) FROM sc WHERE n_features >= 20) * 10 // 100 THEN place END AS rank FROM r
"""
