"""Sources and sinks. Every reader takes an explicit schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lineage import settled
from .archives import zipped_records

S = T.StringType()


def _struct(*names: str, **nested: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, S) for n in names] + [T.StructField(n.replace("_", "-"), t) for n, t in nested.items()])


#: Names of the header's leaf elements, as in the XML.
HEADER = (
    "mark-identification", "status-code", "mark-drawing-code", "attorney-name", "status-date", "filing-date", "registration-date",
    "cancellation-date", "abandonment-date", "trademark-in", "service-mark-in", "collective-trademark-in", "collective-service-mark-in",
    "collective-membership-mark-in", "certification-mark-in", "intent-to-use-in", "use-application-currently-in", "filed-as-use-application-in",
    "filing-basis-current-44d-in", "filing-basis-filed-as-44d-in", "filing-basis-current-44e-in", "filing-basis-filed-as-44e-in",
    "filing-basis-current-66a-in", "filing-basis-filed-as-66a-in", "standard-characters-claimed-in", "color-drawing-current-in",
    "color-drawing-filed-in", "drawing-3d-current-in", "drawing-3d-filed-in", "renewal-filed-in", "section-8-accepted-in",
    "section-15-acknowledged-in",
)
CLASSIFICATION = _struct("international-code", "us-code", "status-code", "first-use-anywhere-date", "first-use-in-commerce-date")
STATEMENT = _struct("type-code", "text")
OWNER = _struct("entry-number", "party-type", "party-name", "entity-type", entity_statement=_struct("entity-type"), nationality=_struct("state", "country"))
DESIGN = _struct("code")
CASE_FILE = T.StructType(
    [
        *_struct("serial-number", "registration-number", *HEADER).fields,
        T.StructField("case-file-header", _struct(*HEADER)),
        T.StructField("classification", T.ArrayType(CLASSIFICATION)),
        T.StructField("classifications", T.StructType([T.StructField("classification", T.ArrayType(CLASSIFICATION))])),
        T.StructField("case-file-statements", T.StructType([T.StructField("case-file-statement", T.ArrayType(STATEMENT))])),
        T.StructField("case-file-owners", T.StructType([T.StructField("case-file-owner", T.ArrayType(OWNER))])),
        T.StructField("design-searches", T.StructType([T.StructField("design-search", T.ArrayType(DESIGN))])),
    ]
)

#: Columns of the case sheet, in order.
CASE_COLUMNS = (
    "date_filed", "case_number", "case_name", "nature_of_suit", "plaintiff", "plaintiff_cn", "brand", "brand_title", "law_firms_abbr",
    "law_firms", "lawyer", "description", "court", "judge", "cause", "date_hit", "state", "url", "source", "created_at",
)
BLACKLIST_COLUMNS = ("brand_name", "source", "added_date")
DETAIL_COLUMNS = ("real_company", "brand_name", "serial_number", "registration_number", "status", "nice_class", "nice_class_cn", "nice_class_en", "goods_services")


def read_case_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each ``case-file`` record, with the file it comes from and its place there.

    The place is the start of the file's split plus the number of the row in its task: records follow
    each other by it, as a split has fewer records than bytes.
    """
    rows = spark.read.format("xml").option("rowTag", "case-file").schema(CASE_FILE).load(path)
    number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return rows.withColumns({"source_file": F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1), "position": F.input_file_block_start() + number})


def zipped_case_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(source_file, position, error, and the record's fields) of zip archives of any size, read as streams.

    The first member of each archive is read.  An archive that is broken gives a row with ``error`` set, besides the
    records before the break.
    """
    found = zipped_records(spark, paths, ("case-file",))
    return found.withColumn("r", F.from_xml("record", CASE_FILE)).select("r.*", "source_file", "position", "error")


def read_zipped_case_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of zip archives; a broken archive is an error (``zipped_case_files`` gives it as a row)."""
    rows = zipped_case_files(spark, path)
    broken = F.raise_error(F.concat("source_file", F.lit(": "), "error")).cast("boolean")
    return rows.filter(F.when(F.col("error").isNotNull(), broken).otherwise(True)).drop("error")


def read_rows(spark: SparkSession, path: str, columns: tuple[str, ...], form: str = "csv") -> DataFrame:
    """A sheet of strings with a header line; short rows are padded with nulls."""
    schema = T.StructType([T.StructField(c, S) for c in columns])
    reader = spark.read.schema(schema)
    return reader.option("header", True).option("enforceSchema", True).option("multiLine", True).csv(path) if form == "csv" else reader.format(form).load(path)


def read_cases(spark: SparkSession, path: str, form: str = "csv") -> DataFrame:
    return read_rows(spark, path, CASE_COLUMNS, form).filter(F.trim(F.coalesce("case_number", F.lit(""))) != "")


def write_table(df: DataFrame, path: str, partition: tuple[str, ...] = ()) -> None:
    """Full refresh of a table."""
    df.write.mode("overwrite").partitionBy(*partition).parquet(path)


def write_report(df: DataFrame, path: str, order: list[Column] | None = None, form: str = "csv", place: str = "place") -> None:
    """Write a report; with ``order``, part files follow each other in it and ``place`` numbers the rows from 1.

    Rows are dealt by range, sorted in each part, and numbered from the sizes of the parts before, so no task has more
    than its range and the order can be checked and restored after any read.
    """
    if order is not None:
        df = placed(df, order, place)
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if form == "csv" else writer.format(form).save(path)


def placed(df: DataFrame, order: list[Column], place: str = "place") -> DataFrame:
    """``df`` with each row's place in ``order``, sorted by it; rows equal in ``order`` go by their other columns."""
    ties = [F.col(f"`{c}`") for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    part, inside = "__part", "__inside"
    dealt = df.repartitionByRange(*order, *ties).sortWithinPartitions(*order, *ties)
    dealt = settled(dealt.withColumns({part: F.spark_partition_id(), inside: F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    before, starts = 0, []
    for r in sorted(dealt.groupBy(part).agg(F.count("*").alias("n")).collect()):  # one row a partition
        starts.append((r[0], before))
        before += r[1]
    starts = df.sparkSession.createDataFrame(starts, f"{part} int, start long")
    return dealt.join(F.broadcast(starts), part).withColumn(place, F.col("start") + F.col(inside) + 1).select(*df.columns, place)
