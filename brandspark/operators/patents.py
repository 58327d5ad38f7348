"""Patent grants: records to the table of grants and its five children; the first record of a number wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_registry_date
from ..sources.archives import tarred_records
from .keys import first_by_key
from .lineage import stored

S = T.StringType()
GRANT = "us-patent-grant"


def _of(*names: str, **parts: T.DataType) -> T.StructType:
    """A struct of text elements, then of others; ``_`` in a keyword stands for ``-`` and a final one for an attribute."""
    named = [T.StructField(f"_{n[:-1].replace('_', '-')}" if n.endswith("_") else n.replace("_", "-"), t) for n, t in parts.items()]
    return T.StructType([T.StructField(n, S) for n in names] + named)


_DOCUMENT = _of("country", "doc-number", "kind", "date")
_BOOK = _of("orgname", "first-name", "last-name", address=_of("city", "state", "country"))
_CPC = _of("section", "class", "subclass", "main-group", "subgroup")
#: The elements of a grant that the tables need, by their names in the public schema of grants.
SCHEMA = _of(
    us_bibliographic_data_grant=_of(
        "invention-title", "number-of-claims",
        publication_reference=_of(document_id=_DOCUMENT),
        application_reference=_of(appl_type_=S, document_id=_DOCUMENT),
        us_term_of_grant=_of("length-of-grant", "us-term-extension"),
        figures=_of("number-of-drawing-sheets", "number-of-figures"),
        classification_locarno=_of("main-classification"),
        classification_national=_of("main-classification", further_classification=T.ArrayType(S)),
        classifications_cpc=_of(
            main_cpc=_of(classification_cpc=T.ArrayType(_CPC)), further_cpc=_of(classification_cpc=T.ArrayType(_CPC))
        ),
        us_references_cited=_of(us_citation=T.ArrayType(_of("category", patcit=_of(document_id=_DOCUMENT)))),
        us_parties=_of(inventors=_of(inventor=T.ArrayType(_of(addressbook=_BOOK)))),
        assignees=_of(assignee=T.ArrayType(_of("orgname", addressbook=_BOOK))),
    ),
    abstract=_of(p=T.ArrayType(S)),
)


def read_patent_archives(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The grant records of tar archives of zip files; supplements are left out."""
    return tarred_records(spark, path, (GRANT,), skip=r"SUPP")


def _text(c: Column) -> Column:
    """An element's text without the markup in it; empty is null."""
    plain = F.regexp_replace(c.cast("string"), r"<[^>]*>", "")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(sign))
    return F.nullif(F.trim(F.regexp_replace(plain, r"\s+", " ")), F.lit(""))


def _number(c: Column) -> Column:
    return F.trim(c).try_cast("int")


def parse_patents(records: DataFrame) -> DataFrame:
    """Adds ``g``, the parsed record, and ``patent_number``; a record that does not parse has none.

    The parsed record is the one item of an exploded array: a filter on a plain column would be moved below it, and Spark
    would parse each record for the filter and once more for its parts.
    """
    parsed = records.withColumn("g", F.explode(F.array(F.from_xml("record", SCHEMA))))
    return parsed.withColumn("patent_number", _text(F.col("g.us-bibliographic-data-grant.publication-reference.document-id.doc-number")))


def load_patents(records: DataFrame) -> dict[str, DataFrame]:
    """grants, assignees, inventors, classifications, citations, images of the first record of each patent number.

    ``records`` is (source_tar, source_zip, position, record, images).  The record is chosen by number before its parts
    are exploded; records without a number are left out (``load_errors`` counts them).  Only designs have images.
    """
    named = parse_patents(records).filter("patent_number IS NOT NULL").drop("record")
    parsed = stored(named.withColumn("__id", F.monotonically_increasing_id()))  # six tables read parts of it
    # records are chosen by their keys alone; each table moves its own parts of those that stay
    first = stored(first_by_key(parsed.select("patent_number", "source_tar", "position", "__id"), ["patent_number"], ["source_tar", "position", "__id"]).select("__id"))
    chosen = lambda some: some.join(first, "__id", "left_semi")
    rows = chosen(parsed)
    b = lambda name: F.col(f"g.us-bibliographic-data-grant.{name}")
    kind = F.lower(_text(b("application-reference._appl-type")))
    grants = parsed.select(
        "__id",
        "patent_number",
        _text(b("publication-reference.document-id.kind")).alias("kind"),
        _text(b("application-reference.document-id.doc-number")).alias("application_number"),
        kind.alias("appl_type"),
        _text(b("invention-title")).alias("title"),
        parse_registry_date(b("publication-reference.document-id.date")).alias("grant_date"),
        parse_registry_date(b("application-reference.document-id.date")).alias("filing_date"),
        F.nullif(F.array_join(F.transform("g.abstract.p", _text), " "), F.lit("")).alias("abstract"),
        _number(b("number-of-claims")).alias("num_claims"),
        _number(b("figures.number-of-figures")).alias("num_figures"),
        _number(b("figures.number-of-drawing-sheets")).alias("num_drawing_sheets"),
        _number(b("us-term-of-grant.length-of-grant")).alias("term_years"),
        _number(b("us-term-of-grant.us-term-extension")).alias("term_extension_days"),
        "source_tar",
    )
    grants = chosen(grants).drop("__id")
    child = lambda items: rows.select("patent_number", F.explode(items).alias("c"))
    of = lambda name, alias: _text(F.col(f"c.{name}")).alias(alias)
    place = [of(f"addressbook.address.{x}", x) for x in ("city", "state", "country")]
    person = [of("addressbook.first-name", "first_name"), of("addressbook.last-name", "last_name")]
    orgname = F.coalesce(_text(F.col("c.addressbook.orgname")), _text(F.col("c.orgname"))).alias("orgname")
    cpc = lambda c: F.concat(*[F.trim(c[x]) for x in ("section", "class", "subclass")], F.lit(" "), F.trim(c["main-group"]), F.lit("/"), F.trim(c["subgroup"]))
    one = lambda system, code, main: F.struct(F.lit(system).alias("system"), code.alias("code"), F.lit(main).alias("is_main"))
    none = F.array().cast("array<struct<system: string, code: string, is_main: boolean>>")
    many = lambda items, system, code, main: F.coalesce(F.transform(items, lambda c: one(system, code(c), main)), none)
    codes = F.concat(
        many(b("classifications-cpc.main-cpc.classification-cpc"), "cpc", cpc, True),
        many(b("classifications-cpc.further-cpc.classification-cpc"), "cpc", cpc, False),
        F.array(one("locarno", _text(b("classification-locarno.main-classification")), True)),
        F.array(one("uspc", _text(b("classification-national.main-classification")), True)),
        many(b("classification-national.further-classification"), "uspc", _text, False),
    )
    cited = child(b("us-references-cited.us-citation")).filter("c.patcit IS NOT NULL")
    images = rows.filter(kind == "design").select("patent_number", F.explode("images").alias("image_name"))
    return {
        "grants": grants,
        "assignees": child(b("assignees.assignee")).select("patent_number", orgname, *person, *place),
        "inventors": child(b("us-parties.inventors.inventor")).select("patent_number", *person, *place),
        "classifications": child(F.filter(codes, lambda c: c["code"].isNotNull())).select("patent_number", "c.system", "c.code", "c.is_main"),
        "citations": cited.select(
            "patent_number",
            of("patcit.document-id.doc-number", "cited_doc_number"),
            of("patcit.document-id.country", "cited_country"),
            of("patcit.document-id.kind", "cited_kind"),
            of("category", "category"),
        ),
        "images": images.select("patent_number", "image_name", F.concat(F.lit("design_images/"), "patent_number", F.lit("/"), "image_name").alias("image_path")),
    }


def load_errors(records: DataFrame) -> DataFrame:
    """Per archive: records in all, with a number, in error."""
    ok = F.col("patent_number").isNotNull()
    counts = parse_patents(records).groupBy(F.col("source_tar").alias("source_file"))
    return counts.agg(F.count("*").alias("total"), F.count_if(ok).alias("inserted"), F.count_if(~ok).alias("errored"))


def insert_patents(existing: DataFrame, delta: DataFrame) -> DataFrame:
    """``existing`` with the first row of each new patent_number."""
    fresh = delta.join(existing.select("patent_number"), "patent_number", "left_anti")
    return existing.unionByName(first_by_key(fresh, ["patent_number"], ["source_file", "position"]).select(*existing.columns))


def insert_children(existing: DataFrame, delta: DataFrame, new: DataFrame) -> DataFrame:
    """Children of patents that are new (``new`` has their numbers), in place of any rows these have already."""
    fresh = new.select("patent_number").distinct()
    kept = existing.join(fresh, "patent_number", "left_anti")
    return kept.unionByName(delta.join(fresh, "patent_number", "left_semi").select(*existing.columns))
