"""The jobs' input tables as views of the test tables, in SQL that Spark and DuckDB both take."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators.cases import build_cases, unique_brands, unique_plaintiffs
from ..operators.collect import collect_brands, detail_parts
from ..operators.lineage import stored
from ..operators.matching import live_marks, mark_holders, match_mark_owners, match_marks, match_owner_names, match_owners
from ..operators.resolve import resolve_companies, resolved_companies
from ..sources.status import status_codes

VIEWS = {
    "v_trademarks": """
        SELECT p_partkey AS serial_number,
               CASE WHEN p_partkey % 7 = 0 THEN '0000000' ELSE lpad(CAST(p_partkey AS STRING), 7, '0') END AS registration_number,
               upper(p_name) AS mark_identification, CAST(600 + p_partkey % 220 AS STRING) AS status_code
        FROM {part}""",
    "v_owners": """
        SELECT DISTINCT l.l_partkey AS serial_number, concat(p.p_name, ' ', n.n_name, ' Inc.') AS party_name
        FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
        JOIN {part} p ON p.p_partkey = s.s_suppkey JOIN {nation} n ON n.n_nationkey = s.s_nationkey""",
    "v_cases_raw": """
        SELECT CAST(o.o_orderkey AS STRING) AS case_number, CAST(o.o_orderdate AS DATE) AS date_filed, o.o_orderpriority AS nature_of_suit,
               CASE WHEN o.o_orderkey % 13 = 0 THEN ''
                    ELSE concat(p.p_name, ' NATION_', CAST(o.o_orderkey % 25 AS STRING), '; a Delaware corporation') END AS plaintiff,
               CASE WHEN o.o_orderkey % 11 = 0 THEN '' ELSE concat(b.p_name, ' 品牌') END AS brand, o.o_orderkey AS position
        FROM {orders} o JOIN {part} p ON p.p_partkey = o.o_custkey JOIN {part} b ON b.p_partkey = o.o_orderkey % 100""",
    "v_classes": """
        SELECT DISTINCT l_partkey AS serial_number, lpad(CAST(1 + CAST(l_quantity AS INT) % 45 AS STRING), 3, '0') AS international_code,
               CAST(CAST(NULL AS STRING) AS DATE) AS first_use_date
        FROM {lineitem}""",
    "v_nice": "SELECT lpad(CAST(n_nationkey + 1 AS STRING), 3, '0') AS code, n_name AS name_en, n_name AS name_cn FROM {nation}",
    "v_statements": "SELECT doc_id AS serial_number, CASE WHEN doc_id % 3 = 0 THEN 'DS0000' ELSE 'GS0251' END AS type_code, text FROM {documents}",
    "v_changes": "SELECT user_id AS serial_number, event_id AS position, event_type AS source_file, value, CAST(ts AS DATE) AS filing_date FROM {events}",
    "v_images": "SELECT vec_id AS image_id, label AS patent_number, embedding FROM {embeddings}",
}
PATENTS = """
    WITH cited AS (
      SELECT l_orderkey, array_join(array_sort(collect_list(concat('<us-citation><patcit num="1"><document-id><country>US</country><doc-number>', l_partkey,
        '</doc-number><kind>', l_returnflag, '</kind></document-id></patcit><category>cited by ', CASE WHEN l_linestatus = 'O' THEN 'examiner' ELSE 'applicant' END, '</category></us-citation>'))), '') AS x
      FROM {lineitem} GROUP BY l_orderkey)
    SELECT concat('I', year(o_orderdate), '.tar') AS source_tar, concat(o_orderkey, '.ZIP') AS source_zip, o_orderkey AS position,
      array('D00000.TIF', concat('D', lpad(o_orderkey % 7, 5, '0'), '.TIF')) AS images,
      concat('<us-patent-grant lang="EN"><us-bibliographic-data-grant>',
        CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE concat('<publication-reference><document-id><country>US</country><doc-number>', CASE WHEN o_orderkey div 2 % 4 = 0 THEN 'D' ELSE '' END,
          lpad(o_orderkey div 2, 7, '0'), '</doc-number><kind>', o_orderstatus, '</kind><date>', date_format(o_orderdate, 'yyyyMMdd'), '</date></document-id></publication-reference>') END,
        '<application-reference appl-type="', CASE WHEN o_orderkey div 2 % 4 = 0 THEN 'design' ELSE 'utility' END, '"><document-id><doc-number>', o_custkey, '</doc-number><date>20240230</date></document-id></application-reference>',
        '<invention-title id="t">Order of <i>', o_orderpriority, '</i> &amp;  more</invention-title><number-of-claims> ', o_orderkey % 30, ' </number-of-claims>',
        '<figures><number-of-drawing-sheets>', o_orderkey % 5, '</number-of-drawing-sheets></figures>',
        '<us-term-of-grant><length-of-grant>', CASE WHEN o_orderkey div 2 % 4 = 0 THEN '15' ELSE '' END, '</length-of-grant></us-term-of-grant>',
        '<classifications-cpc><main-cpc><classification-cpc><section>H</section><class>01</class><subclass>M</subclass><main-group>', o_custkey % 50, '</main-group><subgroup>', o_orderkey % 9,
          '</subgroup></classification-cpc></main-cpc><further-cpc><classification-cpc><section>G</section><class>06</class><subclass>F</subclass><main-group>1</main-group><subgroup>2</subgroup></classification-cpc></further-cpc></classifications-cpc>',
        CASE WHEN o_orderkey div 2 % 4 = 0 THEN concat('<classification-locarno><main-classification>', lpad(o_custkey % 99, 4, '0'), '</main-classification></classification-locarno>') ELSE '' END,
        '<classification-national><main-classification>D24</main-classification><further-classification>D1</further-classification><further-classification>D2</further-classification></classification-national>',
        '<us-references-cited>', coalesce(x, ''), '<us-citation><nplcit><othercit>a book</othercit></nplcit><category>cited by examiner</category></us-citation></us-references-cited>',
        '<us-parties><inventors><inventor><addressbook><last-name>', c_name, '</last-name><first-name>', c_mktsegment, '</first-name><address><city>', n_name, '</city><country>US</country></address></addressbook></inventor></inventors></us-parties>',
        '<assignees><assignee><addressbook><orgname>', c_name, ' Inc.</orgname><address><city>', n_name, '</city></address></addressbook></assignee></assignees>',
        '</us-bibliographic-data-grant><abstract><p>First of ', o_orderkey, '.</p><p>Second.</p></abstract></us-patent-grant>') AS record
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey LEFT JOIN cited ON l_orderkey = o_orderkey"""
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages")


class Analog:
    """Lazily built inputs and intermediate results over one folder of tables.

    What several steps read is settled, so that their plans stay small.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        used = {t: self.table(t) for t in TABLES if f"{{{t}}}" in VIEWS[name]}
        return self.spark.sql(VIEWS[name], **used)

    @cached_property
    def status(self) -> DataFrame:
        return status_codes(self.spark)

    @cached_property
    def cases(self) -> DataFrame:
        return stored(build_cases(self.view("v_cases_raw")))

    @cached_property
    def marks(self) -> DataFrame:
        return stored(self._live_marks)

    @property
    def _live_marks(self) -> DataFrame:
        return live_marks(self.view("v_trademarks"), self.view("v_owners"), self.status)

    @cached_property
    def holders(self) -> DataFrame:
        """The owners of each mark text, with their numbers of marks: all that finding owners needs."""
        return stored(mark_holders(self._live_marks))

    @cached_property
    def owners_a(self) -> DataFrame:
        """The owners of path A alone."""
        return stored(match_owner_names(unique_plaintiffs(self.cases).withColumnRenamed("plaintiff_clean", "name"), self.holders))

    @cached_property
    def owners_b(self) -> DataFrame:
        """The owners of path B alone."""
        return stored(match_mark_owners(unique_brands(self.cases).withColumnRenamed("brand_clean", "name"), self.holders))

    @cached_property
    def path_a(self) -> DataFrame:
        return stored(match_owners(unique_plaintiffs(self.cases).withColumnRenamed("plaintiff_clean", "name"), self.marks))

    @cached_property
    def path_b(self) -> DataFrame:
        return stored(match_marks(unique_brands(self.cases).withColumnRenamed("brand_clean", "name"), self.marks))

    @cached_property
    def path_a1(self) -> DataFrame:
        return stored(match_owners(unique_plaintiffs(self.cases).withColumnRenamed("plaintiff_clean", "name"), self.marks, mode="v1"))

    @cached_property
    def path_b1(self) -> DataFrame:
        return stored(match_marks(unique_brands(self.cases).withColumnRenamed("brand_clean", "name"), self.marks, mode="v1"))

    @cached_property
    def patent_records(self) -> DataFrame:
        """Grant records in XML: two orders of a number, every fourth a design, some without a number."""
        return self.spark.sql(PATENTS, **{t: self.table(t) for t in ("orders", "customer", "nation", "lineitem")})

    @cached_property
    def matched(self) -> DataFrame:
        return stored(resolve_companies(self.cases, self.owners_a, self.owners_b))

    @cached_property
    def registry(self) -> dict[str, DataFrame]:
        return {
            "trademarks": self.view("v_trademarks"),
            "owners": self.view("v_owners"),
            "status": self.status,
            "classes": self.view("v_classes"),
            "nice": self.view("v_nice"),
            "statements": self.view("v_statements"),
        }

    @cached_property
    def companies(self) -> DataFrame:
        return resolved_companies(self.matched)

    @cached_property
    def detail_parts(self) -> tuple[DataFrame, ...]:
        return detail_parts(self.companies, **self.registry)

    @cached_property
    def details(self) -> DataFrame:
        return collect_brands(self.companies, **self.registry)

    @cached_property
    def detail_rows(self) -> DataFrame:
        """Sheet rows of brand details."""
        return self.spark.sql(
            """SELECT p.p_brand AS real_company, concat('"', p.p_name, '"') AS brand_name, CAST(p.p_partkey AS STRING) AS serial_number,
                      ' ' AS registration_number, concat(CASE WHEN p.p_partkey % 3 = 0 THEN 'dead' ELSE 'live' END, '/x') AS status,
                      concat('IC ', CAST(p.p_size AS STRING)) AS nice_class, CAST(NULL AS STRING) AS nice_class_cn,
                      CAST(NULL AS STRING) AS nice_class_en, p.p_type AS goods_services FROM {part} p""",
            part=self.table("part"),
        )

