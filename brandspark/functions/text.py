"""String functions of the brand jobs as Column expressions.

Python's ``strip`` and ``\\s`` are Unicode; ``(?U)`` makes Java's so.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What ends a plaintiff's name, tried in this order.
PLAINTIFF_ENDS = (
    r";?\s*a [A-Z][a-z]+ (corporation|company|limited|LLC)",
    r";?\s*an? (individual|entity)",
    r";?\s*doing business as",
    r";?\s*Plaintiff is",
    r";?\s*\[Terminated:",
    r";?\s*Esq\.",
    r";\s*\d{3,5}\s+\w+",
)
#: Characters of a brand's leading run, and ranges of CJK text.
BRAND_RUN = r"^([A-Za-z0-9][A-Za-z0-9\s&'.\-/+!@#$%^*(),:]+)"
CJK = r"[\x{4e00}-\x{9fff}\x{3000}-\x{303f}\x{ff00}-\x{ffef}]+"
#: Confidence labels.
CONFIDENCE = {
    "LLM_KB高": "0.85", "LLM_KB中": "0.70", "LLM_KB低": "0.50",
    "真实_高": "0.95", "真实_中": "0.80", "真实_低": "0.60",
    "LLM高": "0.95", "LLM中": "0.75", "LLM低": "0.55",
    "高": "0.90", "中": "0.70", "低": "0.50",
}


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def words(c: Column) -> Column:
    """Words between white space; none for an empty string."""
    return F.filter(F.split(squeeze(c), " "), lambda w: w != "")


def clean_plaintiff(c: Column) -> Column:
    s = strip(F.split(strip(F.coalesce(c, F.lit(""))), r"\|", 2)[0])
    for pattern in PLAINTIFF_ENDS:
        s = strip(F.regexp_replace(s, f"(?isU){pattern}.*", ""))
    return F.regexp_replace(s, r"[;,| ]+$", "")


def clean_brand(c: Column) -> Column:
    s = strip(F.coalesce(c, F.lit("")))
    run = F.regexp_replace(strip(F.regexp_extract(s, f"(?U){BRAND_RUN}", 1)), r"[ .,;:\-]+$", "")
    rest = F.upper(squeeze(F.regexp_replace(s, CJK, " ")))
    return F.when(~s.rlike("[a-zA-Z0-9]"), s).when(F.length(run) >= 2, F.upper(run)).when(rest != "", rest).otherwise(s)


def brand_eq_plaintiff(plaintiff_raw: Column, brand_raw: Column, plaintiff: Column, brand: Column) -> Column:
    return F.coalesce((plaintiff_raw == brand_raw) | (plaintiff == brand), F.lit(False))


def flag(*columns: Column) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(c == "T", F.lit(False))
    return out


def flatten_cell(json: Column) -> Column:
    """Text of a rich-text cell: lists join their items, objects give text or else link, scalars their string."""
    value = F.try_parse_json(json)
    item = lambda v: F.coalesce(
        F.nullif(F.try_variant_get(v, "$.text", "string"), F.lit("")), F.try_variant_get(v, "$.link", "string"), v.cast("string")
    )
    parts = F.try_variant_get(value, "$", "array<variant>")
    return F.when(json.isNull(), "").when(value.isNull(), json).when(parts.isNotNull(), F.array_join(F.transform(parts, item), "")).otherwise(F.coalesce(item(value), F.lit("")))


def normalize_brand(c: Column) -> Column:
    """No white space or quotes at the ends, single spaces inside."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), "(?U)^[\\s\"'“”‘’]+|[\\s\"'“”‘’]+$", "")
    return F.regexp_replace(bare, r"(?U)\s+", " ")


def is_multi_word(c: Column) -> Column:
    return c.contains(" ") | (c.contains("-") & (F.length(c) > 3))


def norm_cell(c: Column) -> Column:
    s = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "(?U)^[\\s\"'“”‘’]+|[\\s\"'“”‘’]+$", "")
    return F.nullif(strip(s), F.lit(""))


def norm_nice_class(c: Column) -> Column:
    n = F.regexp_extract(F.coalesce(c, F.lit("")), r"(\d+)", 1).try_cast("int")
    return F.when(n.between(1, 45), F.lpad(n.cast("string"), 3, "0"))


def norm_category_cell(c: Column) -> Column:
    s = strip(c)
    return F.when((s != "") & (F.upper(s) != "NONE"), s)


def map_confidence(c: Column) -> Column:
    s = strip(c)
    table = F.create_map(*[F.lit(x) for pair in CONFIDENCE.items() for x in pair])
    return F.coalesce(F.try_element_at(table, s), s.try_cast("double").cast("string"))


def category_path(path: Column, *levels: Column) -> Column:
    return F.coalesce(path, F.nullif(F.concat_ws(" > ", *levels), F.lit("")))


def is_safe(certificate: Column, risk: Column) -> Column:
    return (certificate.isNull() | certificate.isin("无特殊限制", "无")) & ~risk.eqNullSafe(F.lit("高"))


def flip_person_name(c: Column) -> Column:
    """``A B`` becomes ``B, A``; ``A B C`` becomes ``C, A B``; anything else null."""
    flipped = F.regexp_replace(squeeze(c), r"^(\S+(?: \S+)?) (\S+)$", "$2, $1")
    return F.when(squeeze(c).rlike(r"^\S+(?: \S+){1,2}$"), flipped)


def clean_name(c: Column) -> Column:
    return squeeze(F.regexp_replace(c, r"""[.,;:'"()\[\]]+""", " "))


def two_word_like(c: Column, version: str = "v2") -> Column:
    """A LIKE pattern of the first two words."""
    w = words(c)
    two = F.concat(F.lit("%"), w[0], F.lit("%"), w[1], F.lit("%"))
    if version == "v1":
        return F.when(F.size(w) >= 2, two).otherwise(F.concat(F.lit("%"), c, F.lit("%")))
    return F.when(F.size(w) >= 2, two).when((F.size(w) == 1) & (F.length(w[0]) >= 3), F.concat(F.lit("%"), w[0], F.lit("%")))


def truncate_text(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def registration_label(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")).isin("", "0000000"), "(申请中)").otherwise(c)


def status_label(live_dead: Column, category: Column) -> Column:
    return F.concat(live_dead, F.lit("/"), F.coalesce(category, F.lit("")))


def yes_no(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), "是").otherwise("否")


def is_live(c: Column) -> Column:
    return F.coalesce(F.upper(c).startswith("LIVE"), F.lit(False))


def sample_count(c: Column) -> Column:
    return F.coalesce(F.when(c.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(c).try_cast("int")), F.lit(0))


def has_letter(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\p{L}"), F.lit(False))


def latin_brand(c: Column) -> Column:
    """Two characters or more, with a letter outside the CJK range."""
    return F.coalesce((F.length(c) >= 2) & c.rlike(r"[\p{L}&&[^\x{4e00}-\x{9fff}]]"), F.lit(False))


def known_plaintiff(c: Column) -> Column:
    return F.coalesce(~c.isin("", "？", "?") & (F.length(strip(c)) >= 2), F.lit(False))
