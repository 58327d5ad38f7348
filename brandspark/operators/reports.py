"""Aggregate reports of resolved cases and collected brands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import registration_label, status_label, truncate_text, yes_no
from .keys import cap_per_key, carry_first_seen, latest_by_key
from .lineage import settled, stored

#: Qualities from best to worst, those that the suit report has as columns, and the label of an unknown suit.
RANKED = ("exact", "a_preferred", "a_only", "ai_high", "ai_medium", "b_only", "ai_low", "b_uncertain")
COLUMNS = ("exact", "a_preferred", "a_only", "b_only", "b_uncertain", "not_found")
UNKNOWN = "未知"
#: Rows of a report that one task sorts at a time.
ROWS_A_PART = 500_000


#: The order of each report's rows; equal rows go by their other columns where a place is given (``sources.readers.placed``).
ORDERS = {
    "overview": lambda: [F.desc("case_count"), F.asc("real_company")],
    "suits": lambda: [F.desc("total"), F.asc("suit")],
    "not_found": lambda: [F.desc_nulls_last("date_filed"), F.desc("case_number")],
    "details": lambda: [F.asc("real_company"), F.asc("mark_identification"), F.asc("nice_class")],
    "brands": lambda: [F.asc("real_company"), F.asc("mark_identification")],
}


def _rank(quality: Column) -> Column:
    """The place of a quality among the ranked ones; all others share the last place."""
    out = F.lit(len(RANKED) + 1)
    for k, name in enumerate(RANKED, 1):
        out = F.when(quality == name, k).otherwise(out)
    return out


def first_of_lists(rows: DataFrame, key: str, lists: dict[str, tuple[str, str, int]]) -> DataFrame:
    """(key, and a text for each list): the distinct values of a column in order, joined, and cut after n characters.

    ``lists`` is name: (column, separator, n).  So many values as can have n characters are enough to know the text, and
    whether it is cut: of a key's values no more are gathered, and a rank limit drops the others before they travel.
    """
    one = lambda name, column: F.struct(F.lit(name).alias("list"), F.col(column).cast("string").alias("value"))
    values = rows.select(key, F.explode(F.array(*[one(name, column) for name, (column, _, _) in lists.items()])).alias("v")).select(key, "v.*")
    enough = {name: n // (1 + len(separator)) + 3 for name, (_, separator, n) in lists.items()}
    distinct = values.filter("value IS NOT NULL").distinct()
    first = cap_per_key(distinct, [key, "list"], [F.col("value")], max(enough.values()))
    of = lambda name: F.array_sort(F.collect_list(F.when(F.col("list") == name, F.col("value"))))
    text = {name: F.array_join(F.slice(of(name), 1, enough[name]), separator) for name, (_, separator, _) in lists.items()}
    gathered = first.groupBy(key).agg(*[c.alias(name) for name, c in text.items()])
    return gathered.select(key, *[truncate_text(F.col(name), n).alias(name) for name, (_, _, n) in lists.items()])


def active_brand_counts(details: DataFrame) -> DataFrame:
    return details.filter("mark_identification <> ''").groupBy("real_company").agg(F.countDistinct("mark_identification").alias("brand_count"))


def company_overview(matched: DataFrame, cases: DataFrame, details: DataFrame) -> DataFrame:
    """One row for each company, most cases first."""
    filed = cases.select("case_number", "date_filed", "nature_of_suit")
    rows = matched.filter("real_company IS NOT NULL").join(filed, "case_number", "left")
    grouped = rows.groupBy("real_company").agg(
        F.countDistinct("case_number").alias("case_count"),
        F.max("date_filed").alias("last"),
        F.min(F.struct(_rank(F.col("match_quality")), "match_quality"))["match_quality"].alias("best_quality"),
        F.bool_or("needs_review").alias("review"),
        F.array_join(F.array_sort(F.collect_set("nature_of_suit")), ", ").alias("suit_types"),  # all of them are the result
    )
    texts = first_of_lists(rows, "real_company", {"case_numbers": ("case_number", ", ", 500), "plaintiffs": ("plaintiff_clean", "; ", 300), "brands": ("brand_clean", "; ", 300)})
    return (
        grouped.join(active_brand_counts(details), "real_company", "left")
        .join(texts, "real_company", "left")
        .select(
            "real_company",
            "case_count",
            F.coalesce(F.date_format("last", "yyyy-MM-dd"), F.lit("")).alias("last_date"),
            F.coalesce("case_numbers", F.lit("")).alias("case_numbers"),
            F.coalesce("best_quality", F.lit("")).alias("best_quality"),
            F.coalesce("plaintiffs", F.lit("")).alias("plaintiffs"),
            F.coalesce("brands", F.lit("")).alias("brands"),
            F.coalesce("brand_count", F.lit(0)).alias("brand_count"),
            yes_no(F.col("review")).alias("needs_review"),
            "suit_types",
        )
        .orderBy(*ORDERS["overview"]())
    )


def _suits(matched: DataFrame, cases: DataFrame) -> DataFrame:
    suit = F.when(F.coalesce("nature_of_suit", F.lit("")) == "", UNKNOWN).otherwise(F.col("nature_of_suit"))
    return matched.join(cases.select("case_number", "nature_of_suit"), "case_number", "left").withColumn("suit", suit)


def quality_by_suit(matched: DataFrame, cases: DataFrame, qualities: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Suit type by quality, with the total of each row; qualities beyond the given ones follow, sorted.

    A null quality counts in the total only.
    """
    found = matched.select("match_quality").filter("match_quality IS NOT NULL").distinct()
    more = sorted(r[0] for r in found.filter(~F.col("match_quality").isin(*qualities)).collect())
    column = lambda q: F.count_if(F.col("match_quality") == q).alias(q)
    table = _suits(matched, cases).groupBy("suit").agg(*[column(q) for q in (*qualities, *more)], F.count("*").alias("total"))
    return table.orderBy(*ORDERS["suits"]())


def match_rate_by_suit(matched: DataFrame, cases: DataFrame) -> DataFrame:
    found = F.col("match_quality") != "not_found"
    table = _suits(matched, cases).groupBy("suit").agg(F.count("*").alias("total"), F.count_if(found).alias("matched"), F.count_if(~found).alias("not_found"))
    rate = F.col("matched") / F.col("total")
    return table.withColumns({"rate": rate, "rate_label": F.format_string("%.1f%%", 100 * rate)}).orderBy(*ORDERS["suits"]())


def pipeline_summary(cases: DataFrame, matched: DataFrame, details: DataFrame) -> DataFrame:
    one = matched.agg(F.count("*").alias("matched"), F.countDistinct("real_company").alias("companies"), F.count_if(F.col("match_quality") == "not_found").alias("not_found"))
    return cases.agg(F.count("*").alias("cases")).crossJoin(one).crossJoin(details.agg(F.count("*").alias("details")))


def not_found_report(matched: DataFrame, cases: DataFrame) -> DataFrame:
    rows = matched.filter("match_quality = 'not_found'").drop("plaintiff_clean", "brand_clean").join(cases, "case_number", "left")
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return rows.orderBy(*ORDERS["not_found"]()).select(
        "case_number",
        F.coalesce(F.date_format("date_filed", "yyyy-MM-dd"), F.lit("")).alias("date_filed"),
        *[text(c) for c in ("nature_of_suit", "plaintiff_raw", "brand_raw", "plaintiff_clean", "brand_clean")],
        yes_no(F.col("brand_eq_plaintiff")).alias("brand_eq_plaintiff"),
    )


def brand_detail_report(details: DataFrame, previous: DataFrame, today: str) -> DataFrame:
    """The collected details with labels and listing dates; ``previous``: the four key columns, listed, position."""
    rows = details.filter("mark_identification <> ''").select(
        "real_company",
        "mark_identification",
        F.col("serial_number").cast("string").alias("serial_number"),
        registration_label(F.col("registration_number")).alias("registration_number"),
        status_label(F.col("live_dead"), F.col("category")).alias("status"),
        F.coalesce("international_code", F.lit("")).alias("nice_class"),
        F.coalesce("international_desc_cn", F.lit("")).alias("nice_class_cn"),
        F.coalesce("international_desc_en", F.lit("")).alias("nice_class_en"),
        truncate_text(F.coalesce("goods_services", F.lit("")), 500).alias("goods_services"),
    )
    keys = ["real_company", "mark_identification", "serial_number", "nice_class"]
    return carry_first_seen(rows.distinct(), previous, keys, F.lit(today)).orderBy(*ORDERS["details"]())


def class_codes(classes: DataFrame, names: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Classes by their places in the order of ``nice_class``, which take less room than names: (code, nice_class, place), and (serial_number, places).

    There are some dozens of codes.  A code that is empty counts as none, unless it has a name of its own.
    """
    code = F.col("international_code")
    if names is None:
        own = classes.select("serial_number", F.coalesce(code, F.lit("")).alias("code"))
    else:
        known = names.select("international_code").distinct().withColumn("__known", F.lit(True))
        own = classes.join(F.broadcast(known), "international_code", "left").select("serial_number", F.when(F.col("__known"), code).otherwise(F.nullif(code, F.lit(""))).alias("code"))
    found = own.select("code").distinct().withColumn("nice_class", F.coalesce("code", F.lit("")))
    codes = settled(found.withColumn("place", F.row_number().over(Window.orderBy("nice_class", "code")).cast("short")))
    coded = own.join(F.broadcast(codes.select(F.col("code").alias("__code"), "place")), F.col("code").eqNullSafe(F.col("__code"))).groupBy("serial_number").agg(F.sort_array(F.collect_set("place")).alias("places"))
    return codes, coded


def no_class(codes: DataFrame) -> DataFrame:
    """``codes`` with a place 0 for marks without a class."""
    return codes.unionByName(codes.sparkSession.createDataFrame([(None, "", 0)], "code string, nice_class string, place short"))


def detail_groups(marks: DataFrame, coded: DataFrame) -> DataFrame:
    """``marks`` with a text, distinct, and ``places``: those of their classes, 0 if there are none.  One row stands for a row a class."""
    rows = marks.filter("mark_identification <> ''").distinct().join(coded, "serial_number", "left")
    return rows.withColumn("places", F.coalesce("places", F.array(F.lit(0).cast("short"))))


def placed_details(marks: DataFrame, classes: DataFrame) -> DataFrame:
    """(real_company, mark_identification, nice_class, serial_number, place) of the distinct detail rows, in the order of the report and of serial numbers as text.

    A row's place is that of its company and mark plus the one inside; these groups are dealt over tasks before they are
    multiplied by their classes.
    """
    key = ["real_company", "mark_identification"]
    codes, coded = class_codes(classes)
    groups = stored(detail_groups(marks.select(*key, "serial_number"), coded))
    # places of groups: sums over ranges, then inside each
    sums = groups.groupBy(*key).agg(F.sum(F.size("places")).alias("n")).repartitionByRange(*key)
    sums = settled(sums.withColumn("part", F.spark_partition_id()))
    before, starts = 0, []
    for r in sorted(sums.groupBy("part").agg(F.sum("n").alias("n")).collect()):  # one row a partition
        starts.append((r["part"], before))
        before += r["n"]
    starts = sums.sparkSession.createDataFrame(starts, "part int, start long")
    inside = Window.partitionBy("part").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(starts), "part").select(*key, (F.col("start") + F.col("inside")).alias("start"))
    rows = groups.repartition(max(1, before // ROWS_A_PART), *key).join(sums, key)
    rows = rows.select(*key, F.explode("places").alias("place"), F.col("serial_number").cast("string").alias("serial_number"), "start")
    order = Window.partitionBy(*key).orderBy("place", "serial_number")
    rows = rows.withColumn("inside", F.row_number().over(order)).join(F.broadcast(no_class(codes).select("place", "nice_class")), "place")
    return rows.select(*key, "nice_class", "serial_number", (F.col("start") + F.col("inside")).alias("place"))


def listings(previous: DataFrame, codes: DataFrame) -> DataFrame:
    """(company, mark, serial, seen): of the rows of an earlier report the listing dates, each with the places of its classes.

    ``previous``: the four key columns, listed, position; of keys that repeat the last row wins.  Classes without a place
    are in no row of the new report.
    """
    keys = ["real_company", "mark_identification", "serial_number", "nice_class"]
    rows = latest_by_key(previous.select(*[F.trim(k).alias(k) for k in keys], "listed", "position"), keys, ["position"]).filter("listed <> ''")
    rows = rows.join(F.broadcast(no_class(codes).select(F.trim("nice_class").alias("nice_class"), "place")), "nice_class")
    dates = rows.groupBy(*keys[:3], "listed").agg(F.collect_set("place").alias("places"))
    return dates.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, ("company", "mark", "serial"))]).agg(F.collect_list(F.struct("listed", "places")).alias("seen"))


def report_groups(marks: DataFrame, classes: DataFrame, names: DataFrame, goods: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The codes of classes, and the rows of the detail report before they are multiplied by ``places`` and ``goods``."""
    codes, coded = class_codes(classes, names)
    shown = marks.select(
        "real_company",
        "mark_identification",
        "serial_number",
        registration_label(F.col("registration_number")).alias("registration_number"),
        status_label(F.col("live_dead"), F.col("category")).alias("status"),
    )
    texts = goods.groupBy("serial_number").agg(F.collect_set(truncate_text(F.coalesce("goods_services", F.lit("")), 500)).alias("goods"))
    return codes, stored(detail_groups(shown, coded).join(texts, "serial_number", "left").withColumn("goods", F.coalesce("goods", F.array(F.lit("")))))


def ordered_detail_report(groups: DataFrame, codes: DataFrame, names: DataFrame, seen: DataFrame, today: str) -> DataFrame:
    """As ``brand_detail_report``, from ``report_groups`` and ``listings``: rows are dealt by range before they are multiplied."""
    key = ["real_company", "mark_identification"]
    on = [F.trim("real_company") == F.col("company"), F.trim("mark_identification") == F.col("mark"), F.trim(F.col("serial_number").cast("string")) == F.col("serial")]
    total = groups.agg(F.sum(F.size("places") * F.size("goods"))).first()[0] or 0
    rows = groups.join(seen, on, "left").drop("company", "mark", "serial").repartitionByRange(max(1, total // ROWS_A_PART), *key)
    rows = rows.withColumn("place", F.explode("places"))
    date = F.get(F.filter("seen", lambda s: F.array_contains(s["places"], F.col("place"))), F.lit(0))["listed"]
    labels = no_class(codes).join(names.withColumnRenamed("international_code", "code"), "code", "left")
    labels = labels.select("place", "nice_class", *[F.coalesce(f"international_desc_{x}", F.lit("")).alias(f"nice_class_{x}") for x in ("cn", "en")]).distinct()
    rows = rows.withColumns({"listed": F.coalesce(date, F.lit(today)), "goods_services": F.explode("goods")}).join(F.broadcast(labels), "place")
    columns = [*key, F.col("serial_number").cast("string").alias("serial_number"), "registration_number", "status", "nice_class", "nice_class_cn", "nice_class_en", "goods_services", "listed"]
    return rows.select(*columns).sortWithinPartitions(*ORDERS["details"]())  # ranges of the first two columns, sorted inside


def tro_brand_list(details: DataFrame, previous: DataFrame, today: str) -> DataFrame:
    from .collect import company_brand_pairs

    return carry_first_seen(company_brand_pairs(details), previous, ["real_company", "mark_identification"], F.lit(today)).orderBy(*ORDERS["brands"]())
