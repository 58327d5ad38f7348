import io
import os
import tarfile
import tracemalloc
import zipfile

import pytest

from brandspark.operators import patents
from brandspark.sources import archives
from brandspark.sources.readers import read_cases, read_rows, read_zipped_case_files, write_report, write_table, zipped_case_files


def pieces(data, size):
    return (data[k : k + size] for k in range(0, len(data), size))


XML = b"<?xml version='1.0'?><root><case-file a='1'>\n<x>1</x></case-file>junk<case-files/><other>o</other></root><?xml?><root2><case-file>\xc3\xa9</case-file></root2>"


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_records_of_several_roots_and_kinds(size):
    assert list(archives.records(pieces(XML, size), ("case-file",))) == [b"<case-file a='1'>\n<x>1</x></case-file>", b"<case-file>\xc3\xa9</case-file>"]
    assert len(list(archives.records(pieces(XML, size), ("case-file", "other")))) == 3


def _archive(data, method=zipfile.ZIP_DEFLATED, stream=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        with z.open(zipfile.ZipInfo("a.xml") if stream else "a.xml", "w") as f:
            f.write(data)
        z.writestr("b.xml", b"<case-file>second member</case-file>")
    return out.getvalue()


@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
@pytest.mark.parametrize("size", [3, 4096])
def test_first_member_equals_zipfile(method, size):
    data = os.urandom(20_000) + b"\n" * 30_000
    assert b"".join(archives.first_member(pieces(_archive(data, method), size))) == data


def test_first_member_needs_bounded_memory():
    def document():
        yield b"<root>"
        for k in range(40_000):
            yield b"<case-file>" + str(k).encode() * 200 + b"</case-file>\n"

    whole = _archive(b"".join(document()))
    tracemalloc.start()
    n = sum(1 for _ in archives.records(archives.first_member(pieces(whole, 1 << 16)), ("case-file",)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 40_000 and peak < 30e6  # of some 40 MB


def test_bytes_of_archives_come_back_whole(spark, tmp_path):
    samples = {"a": os.urandom(300_000), "b": b"\n\n\n", "c": b"x", "d": b"a\nb", "e": b"a\nb\n", "f": b"\r\n\r" * 1000}
    for name, data in samples.items():
        (tmp_path / name).write_bytes(data)

    def join(batches):
        import pyarrow as pa

        for path, chunks in archives._files(batches):
            yield pa.RecordBatch.from_pylist([{"path": path.rsplit("/", 1)[-1], "data": b"".join(chunks)}])

    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = archives.archive_runs(spark, str(tmp_path)).mapInArrow(join, "path string, data binary").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.path: bytes(r.data) for r in rows} == samples


def test_broken_archives(spark, tmp_path):
    (tmp_path / "good.zip").write_bytes(_archive(b"<case-file><serial-number>1</serial-number></case-file>"))
    (tmp_path / "bad.zip").write_bytes(b"this is none")
    rows = zipped_case_files(spark, str(tmp_path)).collect()
    assert {(r.source_file, r["serial-number"], r.error is None) for r in rows} == {("good.zip", "1", True), ("bad.zip", None, False)}
    assert read_zipped_case_files(spark, str(tmp_path / "good.zip")).count() == 1
    with pytest.raises(Exception, match="bad.zip"):
        read_zipped_case_files(spark, str(tmp_path)).collect()


DESIGN = """<?xml version="1.0"?><!DOCTYPE us-patent-grant SYSTEM "x.dtd" [ ]><us-patent-grant lang="EN"><us-bibliographic-data-grant>
<publication-reference><document-id><country>US</country><doc-number>D1034980</doc-number><kind>S1</kind><date>20240709</date></document-id></publication-reference>
<application-reference appl-type="design"><document-id><country>US</country><doc-number>29749819</doc-number><date>20200831</date></document-id></application-reference>
<us-term-of-grant><length-of-grant>15</length-of-grant></us-term-of-grant>
<classification-locarno><edition>14</edition><main-classification>2402</main-classification></classification-locarno>
<classification-national><country>US</country><main-classification>D24135</main-classification></classification-national>
<invention-title id="d0e43">Mask &amp; <i>cup</i></invention-title>
<us-references-cited><us-citation><patcit num="00001"><document-id><country>US</country><doc-number>1234567</doc-number><kind>A</kind></document-id></patcit><category>cited by examiner</category></us-citation>
<us-citation><nplcit num="2"><othercit>A book.</othercit></nplcit><category>cited by applicant</category></us-citation></us-references-cited>
<number-of-claims>1</number-of-claims><figures><number-of-drawing-sheets>7</number-of-drawing-sheets><number-of-figures>9</number-of-figures></figures>
<us-parties><inventors><inventor sequence="001"><addressbook><last-name>Doe</last-name><first-name>Jo</first-name><address><city>Oslo</city><country>NO</country></address></addressbook></inventor></inventors></us-parties>
<assignees><assignee><addressbook><orgname>Mask Inc.</orgname><address><city>Reno</city><state>NV</state><country>US</country></address></addressbook></assignee></assignees>
</us-bibliographic-data-grant></us-patent-grant>"""
UTILITY = """<us-patent-grant><us-bibliographic-data-grant>
<publication-reference><document-id><doc-number>12034149</doc-number><kind>B2</kind><date>20240709</date></document-id></publication-reference>
<application-reference appl-type="utility"><document-id><doc-number>17000000</doc-number><date>20210230</date></document-id></application-reference>
<us-term-of-grant><us-term-extension>120</us-term-extension></us-term-of-grant>
<classifications-cpc><main-cpc><classification-cpc><section>H</section><class>01</class><subclass>M</subclass><main-group>4</main-group><subgroup>364</subgroup></classification-cpc></main-cpc>
<further-cpc><classification-cpc><section>H</section><class>01</class><subclass>M</subclass><main-group>4</main-group><subgroup>62</subgroup></classification-cpc></further-cpc></classifications-cpc>
<invention-title>Cell</invention-title><us-parties><inventors><inventor><addressbook><last-name>Roe</last-name></addressbook></inventor></inventors></us-parties>
<assignees><assignee><addressbook><last-name>Roe</last-name><first-name>Al</first-name></addressbook></assignee></assignees>
</us-bibliographic-data-grant><abstract id="a"><p num="1">A cell with <b>two</b> parts.</p></abstract></us-patent-grant>"""


def _tar(path, **zips):
    with tarfile.open(path, "w") as tar:
        for name, files in zips.items():
            inner = io.BytesIO()
            with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
                for f, data in files.items():
                    z.writestr(f, data)
            member = tarfile.TarInfo(f"I20240709/{name.replace('__', '/')}.ZIP")
            member.size = len(inner.getvalue())
            tar.addfile(member, io.BytesIO(inner.getvalue()))
        broken = tarfile.TarInfo("I20240709/UTIL/BROKEN.ZIP")
        broken.size = 5
        tar.addfile(broken, io.BytesIO(b"no zi"))


def test_patents_of_a_small_archive(spark, tmp_path):
    _tar(
        tmp_path / "I20240709.tar",
        DESIGN__USD1={"D/USD1.XML": DESIGN, "D/D00001.TIF": b"i", "D/D00000.TIF": b"i"},
        UTIL__US2={"U/US2.XML": UTILITY + "\n" + DESIGN.replace("Mask &amp;", "Later") + "<us-patent-grant><broken/></us-patent-grant>", "U/U00001.TIF": b"i"},
        UTIL__US3_SUPP={"S.XML": UTILITY.replace("12034149", "99")},
    )
    records = patents.read_patent_archives(spark, str(tmp_path / "I20240709.tar"))
    t = {name: sorted(map(tuple, df.collect()), key=str) for name, df in patents.load_patents(records).items()}
    import datetime

    day = datetime.date(2024, 7, 9)
    assert t["grants"] == [
        ("12034149", "B2", "17000000", "utility", "Cell", day, None, "A cell with two parts.", None, None, None, None, 120, "I20240709.tar"),
        ("D1034980", "S1", "29749819", "design", "Mask & cup", day, datetime.date(2020, 8, 31), None, 1, 9, 7, 15, None, "I20240709.tar"),
    ]
    assert t["assignees"] == [("12034149", None, "Al", "Roe", None, None, None), ("D1034980", "Mask Inc.", None, None, "Reno", "NV", "US")]
    assert t["inventors"] == [("12034149", None, "Roe", None, None, None), ("D1034980", "Jo", "Doe", "Oslo", None, "NO")]
    assert t["classifications"] == [("12034149", "cpc", "H01M 4/364", True), ("12034149", "cpc", "H01M 4/62", False), ("D1034980", "locarno", "2402", True), ("D1034980", "uspc", "D24135", True)]
    assert t["citations"] == [("D1034980", "1234567", "US", "A", "cited by examiner")]
    assert t["images"] == [("D1034980", n, f"design_images/D1034980/{n}") for n in ("D00000.TIF", "D00001.TIF")]
    assert tuple(patents.load_errors(records).first()) == ("I20240709.tar", 5, 3, 2)  # the broken record, and the broken member


def test_records_are_parsed_once(spark):
    records = spark.createDataFrame([("<us-patent-grant><us-bibliographic-data-grant><publication-reference><document-id><doc-number>D1</doc-number></document-id></publication-reference></us-bibliographic-data-grant></us-patent-grant>",), ("<broken",), (None,)], "record string")
    named = patents.parse_patents(records).filter("patent_number IS NOT NULL")
    assert [r.patent_number for r in named.collect()] == ["D1"] and patents.parse_patents(records).count() == 3
    assert named._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 1


def test_children_of_new_patents_replace_what_is_there(spark):
    old = spark.createDataFrame([("1", "a"), ("2", "b")], "patent_number string, orgname string")
    delta = spark.createDataFrame([("2", "c"), ("3", "d"), ("1", "e")], "patent_number string, orgname string")
    new = spark.createDataFrame([("2",), ("3",)], "patent_number string")
    assert sorted(map(tuple, patents.insert_children(old, delta, new).collect())) == [("1", "a"), ("2", "c"), ("3", "d")]


def test_sheets_and_tables(spark, tmp_path):
    (tmp_path / "cases.csv").write_text('date_filed,case_number,x\n2024-01-01,1,"two\nlines"\n,  ,blank\n2024-01-02,2\n', encoding="utf-8")
    cases = read_cases(spark, str(tmp_path / "cases.csv"))
    assert len(cases.columns) == 20
    assert [(r.case_number, r.case_name, r.court) for r in cases.orderBy("case_number").collect()] == [("1", "two\nlines", None), ("2", None, None)]
    rows = read_rows(spark, str(tmp_path / "cases.csv"), ("a", "b"))
    write_table(rows, str(tmp_path / "t"), ("b",))
    write_table(rows.limit(1), str(tmp_path / "t"), ("b",))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_report_keeps_its_order(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 11).alias("d"), "id")
    want = sorted(((r.k, r.d, r.id) for r in df.collect()), key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    write_report(df, str(tmp_path / "r"), [F.desc("k"), F.asc_nulls_last("d")])
    got = spark.read.option("header", True).csv(str(tmp_path / "r"), schema="k long, d long, id long, place long").orderBy("place").collect()
    assert [(r.k, r.d, r.id) for r in got] == want and [r.place for r in got] == list(range(1, 1001))
    lines = [line for p in sorted((tmp_path / "r").glob("part-*")) for line in p.read_text().splitlines()[1:]]
    assert [int(x.rsplit(",", 1)[1]) for x in lines] == list(range(1, 1001))  # the files follow each other
