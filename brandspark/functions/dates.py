"""Date functions; bad input gives null, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def parse_registry_date(c: Column) -> Column:
    ok = c.rlike("^[0-9]{8}$") & (F.substring(c, 1, 4) != "0000")
    return F.when(ok, F.try_to_date(c, "yyyyMMdd"))


def parse_case_date(c: Column) -> Column:
    s = strip(c)
    parse = lambda form: F.try_to_timestamp(s, F.lit(form)).cast("date")
    return F.coalesce(parse("yyyy-M-d"), parse("yyyy/M/d"), parse("yyyy-M-d H:m:s"))


def normalize_sheet_date(c: Column) -> Column:
    """Spreadsheet day numbers become dates; everything else stays."""
    s = strip(F.coalesce(c, F.lit("")))
    n = F.floor(s.try_cast("double")).cast("int")
    day = F.date_format(F.date_add(F.lit("1899-12-30").cast("date"), n), "yyyy-MM-dd")
    dashed = (F.length(s) == 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-")
    return F.when(dashed, s).when((n > 30000) & (n < 60000), day).otherwise(s)


def valid_date_text(c: Column) -> Column:
    return F.when(strip(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), strip(c))
