"""Registry load: nested records to five tables, with statistics and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_registry_date
from ..functions.similarity import jaccard, trigrams
from ..functions.text import flag
from .keys import latest_by_key

#: Columns of dates and flags, and the XML elements behind the flags.
_DATES = ("status_date", "filing_date", "registration_date", "cancellation_date", "abandonment_date")
_FLAGS = {
    "is_trademark": ("trademark-in",),
    "is_service_mark": ("service-mark-in",),
    "is_collective": ("collective-trademark-in", "collective-service-mark-in", "collective-membership-mark-in"),
    "is_certification": ("certification-mark-in",),
    "is_intent_to_use": ("intent-to-use-in",),
    "is_use_based": ("use-application-currently-in", "filed-as-use-application-in"),
    "is_44d": ("filing-basis-current-44d-in", "filing-basis-filed-as-44d-in"),
    "is_44e": ("filing-basis-current-44e-in", "filing-basis-filed-as-44e-in"),
    "is_66a": ("filing-basis-current-66a-in", "filing-basis-filed-as-66a-in"),
    "standard_characters": ("standard-characters-claimed-in",),
    "color_drawing": ("color-drawing-current-in", "color-drawing-filed-in"),
    "drawing_3d": ("drawing-3d-current-in", "drawing-3d-filed-in"),
    "renewal_filed": ("renewal-filed-in",),
    "section_8_accepted": ("section-8-accepted-in",),
    "section_15_acknowledged": ("section-15-acknowledged-in",),
}


def _field(name: str) -> Column:
    """From the header if there is one, else from the record itself; empty is null."""
    value = F.when(F.col("`case-file-header`").isNotNull(), F.col(f"`case-file-header`.`{name}`")).otherwise(F.col(f"`{name}`"))
    return F.nullif(F.trim(value), F.lit(""))


def valid_records(raw: DataFrame) -> DataFrame:
    serial = F.trim("`serial-number`").try_cast("long")
    return raw.withColumn("serial_number", serial).filter(serial.isNotNull())


def last_records(raw: DataFrame) -> DataFrame:
    """The last record of each serial number, nested; one shuffle before any child is exploded."""
    return latest_by_key(valid_records(raw), ["serial_number"], ["source_file", "position"])


def load_registry(raw: DataFrame) -> dict[str, DataFrame]:
    """trademarks, classes, statements, owners, design_codes of the last record of each serial number."""
    return registry_tables(last_records(raw))


def registry_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The five tables of nested records that are chosen already; settle these first where several tables are written."""
    text = {c: _field(c.replace("_", "-")) for c in ("mark_identification", "status_code", "mark_drawing_code", "attorney_name")}
    trademarks = rows.select(
        "serial_number",
        F.trim("`registration-number`").alias("registration_number"),
        text["mark_identification"].alias("mark_identification"),
        text["status_code"].alias("status_code"),
        *[parse_registry_date(_field(c.replace("_", "-"))).alias(c) for c in _DATES],
        text["mark_drawing_code"].alias("mark_drawing_code"),
        text["attorney_name"].alias("attorney_name"),
        *[flag(*map(_field, names)).alias(c) for c, names in _FLAGS.items()],
        "source_file",
    )
    child = lambda items: rows.select("serial_number", F.explode(items).alias("c"))
    c = lambda name: F.nullif(F.trim(f"c.`{name}`"), F.lit(""))
    classes = child(F.coalesce(F.col("classifications.classification"), F.col("classification"))).select(
        "serial_number",
        c("international-code").alias("international_code"),
        c("us-code").alias("us_code"),
        c("status-code").alias("status_code"),
        parse_registry_date(c("first-use-anywhere-date")).alias("first_use_date"),
        parse_registry_date(c("first-use-in-commerce-date")).alias("first_use_commerce_date"),
    )
    statements = child(F.col("`case-file-statements`.`case-file-statement`")).select("serial_number", c("type-code").alias("type_code"), c("text").alias("text"))
    owners = child(F.col("`case-file-owners`.`case-file-owner`")).select(
        "serial_number",
        c("entry-number").alias("entry_number"),
        c("party-type").alias("party_type"),
        c("party-name").alias("party_name"),
        F.coalesce(F.nullif(F.trim("c.`entity-statement`.`entity-type`"), F.lit("")), c("entity-type")).alias("entity_type"),
        F.col("c.nationality.state").alias("nationality_state"),
        F.col("c.nationality.country").alias("nationality_country"),
    )
    designs = child(F.col("`design-searches`.`design-search`")).select("serial_number", c("code").alias("design_code"))
    return {
        "trademarks": trademarks,
        "classes": classes,
        "statements": statements.filter("type_code IS NOT NULL"),
        "owners": owners,
        "design_codes": designs.filter("design_code IS NOT NULL"),
    }


def file_load_stats(raw: DataFrame) -> DataFrame:
    """Per source file: records in all, inserted, in error."""
    ok = F.trim("`serial-number`").try_cast("long").isNotNull()
    return raw.groupBy("source_file").agg(F.count("*").alias("total"), F.count_if(ok).alias("inserted"), F.count_if(~ok).alias("errored"))


def status_code_counts(status: DataFrame, trademarks: DataFrame) -> DataFrame:
    """Per live or dead: codes in all, codes that trademarks have, and trademarks."""
    used = trademarks.groupBy("status_code").agg(F.count("*").alias("n"))
    joined = status.join(used, "status_code", "left")
    return joined.groupBy("live_dead").agg(F.count("*").alias("codes"), F.count("n").alias("used"), F.coalesce(F.sum("n"), F.lit(0)).alias("marks"))


def orphan_counts(trademarks: DataFrame, **children: DataFrame) -> DataFrame:
    """(child, orphans) for each child table."""
    parent = trademarks.select("serial_number")
    out = None
    for name, df in sorted(children.items()):
        one = df.join(parent, "serial_number", "left_anti").agg(F.count("*").alias("orphans")).select(F.lit(name).alias("child"), "orphans")
        out = one if out is None else out.unionByName(one)
    return out


def registry_quality(
    trademarks: DataFrame, orphans: DataFrame, errors: DataFrame, probe: str, least_total: int = 13_000_000, least_similarity: float = 0.3
) -> DataFrame:
    """One row of checks, and whether all hold."""
    mark = F.col("mark_identification")
    probe_grams = trigrams(F.lit(probe))
    base = trademarks.agg(
        F.count("*").alias("total"),
        F.count_if(mark.isNotNull() & (mark != "")).alias("named"),
        F.max("filing_date").alias("last_filing"),
        F.count_if(jaccard(trigrams(mark), probe_grams) >= least_similarity).alias("probe_hits"),
    )
    rest = orphans.agg(F.sum("orphans").alias("orphans")).crossJoin(errors.agg(F.coalesce(F.sum("errored"), F.lit(0)).alias("errors")))
    named = F.when(F.col("total") > 0, F.round(100.0 * F.col("named") / F.col("total"), 1))
    ok = (F.col("errors") == 0) & (F.col("orphans") == 0) & (F.col("total") > least_total) & (F.col("probe_hits") > 0)
    return base.crossJoin(rest).select("total", "named", named.alias("named_pct"), "last_filing", "orphans", "errors", "probe_hits", ok.alias("ok"))


def missing_days(ledger: DataFrame, start: str, end: str) -> DataFrame:
    """Names of the daily files from ``start`` to ``end`` that the ledger (source_file) does not have."""
    days = ledger.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    names = days.select("day", F.concat(F.lit("apc"), F.date_format("day", "yyMMdd"), F.lit(".zip")).alias("source_file"))
    return names.join(ledger.select("source_file").distinct(), "source_file", "left_anti").select("day", "source_file")
