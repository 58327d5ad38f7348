import zipfile

from brandspark.operators.registry import file_load_stats, load_registry
from brandspark.sources.readers import read_case_files, read_zipped_case_files
from brandspark.operators.keys import upsert, upsert_children
from brandspark.sources.bucketed import listed
from brandspark.streaming import ingest
from brandspark.streaming.ingest import ingest_daily

RECORD = """<case-file><serial-number>{0}</serial-number><case-file-header><mark-identification>{1}</mark-identification>
<status-code>700</status-code><filing-date>20240105</filing-date><trademark-in>T</trademark-in></case-file-header>
<classifications><classification><international-code>025</international-code></classification></classifications>
<case-file-statements><case-file-statement><type-code>GS0251</type-code><text>Shirts</text></case-file-statement></case-file-statements>
<case-file-owners><case-file-owner><party-name>{1} Inc.</party-name></case-file-owner></case-file-owners></case-file>
"""


def _zip(path, *records):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.xml", "<root>\n" + "".join(RECORD.format(*r) for r in records) + "</root>")


def test_load_from_xml_and_zip(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<root>\n" + RECORD.format(1, "ONE") + RECORD.format("x", "BAD") + "</root>")
    tables = load_registry(read_case_files(spark, str(tmp_path / "a.xml")))
    row = tables["trademarks"].first()
    assert (row.serial_number, row.mark_identification, row.is_trademark, str(row.filing_date)) == (1, "ONE", True, "2024-01-05")
    _zip(tmp_path / "apc240101.zip", (1, "OLD"), (1, "NEW"), ("y", "BAD"))
    raw = read_zipped_case_files(spark, str(tmp_path / "apc240101.zip"))
    tables = load_registry(raw)
    assert [r.mark_identification for r in tables["trademarks"].collect()] == ["NEW"]
    assert [r.party_name for r in tables["owners"].collect()] == ["NEW Inc."]
    assert tuple(file_load_stats(raw).first())[1:] == (3, 2, 1)


def test_daily_stream_replaces_serial_numbers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _zip(folder / "apc240101.zip", (1, "OLD"), (2, "TWO"))
    seen = []
    run = lambda: ingest_daily(spark, str(folder), str(tmp_path / "cp"), str(tmp_path / "v"), seen.append).awaitTermination()
    run()
    assert {r.mark_identification for r in seen[-1]["trademarks"].collect()} == {"OLD", "TWO"}
    run()
    assert len(seen) == 1


def test_second_run_keeps_what_the_first_took_in(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    seen = []
    run = lambda: ingest_daily(spark, str(folder), str(tmp_path / "cp"), str(tmp_path / "v"), seen.append).awaitTermination()
    _zip(folder / "apc240101.zip", (1, "OLD"), (2, "TWO"))
    run()
    _zip(folder / "apc240102.zip", (1, "NEW"), (3, "THREE"))
    (tmp_path / "v" / "data" / "v000001" / "owners" / "bucket=3").mkdir(parents=True)  # left by a run that was cut off
    run()
    assert len(seen) == 2
    assert sorted(r.mark_identification for r in seen[-1]["trademarks"].collect()) == ["NEW", "THREE", "TWO"]
    assert sorted(r.party_name for r in seen[-1]["owners"].collect()) == ["NEW Inc.", "THREE Inc.", "TWO Inc."]
    assert seen[-1]["classes"].count() == 3
    (tmp_path / "v" / "manifests" / "v000001.json").unlink()  # not complete: the version before it is in force
    before = ingest.read_registry(ingest.store(spark, str(tmp_path / "v")))
    assert sorted(r.mark_identification for r in before["trademarks"].collect()) == ["OLD", "TWO"]


def test_last_record_of_a_serial_in_one_file_wins(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<root>\n" + "".join(RECORD.format(k % 50, f"MARK {k}") for k in range(400)) + "</root>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = read_case_files(spark, str(tmp_path / "a.xml"))
        places = raw.select("position", "`serial-number`").orderBy("position").collect()
        assert [int(r[1]) for r in places] == [k % 50 for k in range(400)] and len({r[0] for r in places}) == 400
        tables = load_registry(raw)
        assert {r.serial_number: r.mark_identification for r in tables["trademarks"].collect()} == {k: f"MARK {350 + k}" for k in range(50)}
        assert {r.party_name for r in tables["owners"].collect()} == {f"MARK {350 + k} Inc." for k in range(50)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _files(root):
    return {str(p.relative_to(root)) for p in root.glob("data/v*/*/bucket=*")}


def test_small_day_rewrites_its_buckets_only(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "v"
    folder.mkdir()
    tables, seen = ingest.store(spark, str(root), buckets=16), []
    run = lambda: ingest_daily(spark, str(folder), str(tmp_path / "cp"), str(root), seen.append, buckets=16).awaitTermination()
    _zip(folder / "apc240101.zip", *[(k, f"MARK {k}") for k in range(60)])
    run()
    first = _files(root)
    _zip(folder / "apc240102.zip", (7, "SEVEN"), (900, "NEW"))
    run()
    new = {f for f in _files(root) if "/v000001/" in f or f.startswith("data/v000001")}
    touched = tables.touched(spark.createDataFrame([(7,), (900,)], "serial_number long"))
    assert {f.rsplit("=")[-1] for f in new} == {str(k) for k in touched} and len(touched) == 2
    assert first <= _files(root)  # the version before is kept whole
    _zip(folder / "apc240103.zip", (7, "SEVEN 3"))
    run()
    names = {r.serial_number: r.mark_identification for r in seen[-1]["trademarks"].collect()}
    assert names == {k: f"MARK {k}" for k in range(60)} | {7: "SEVEN 3", 900: "NEW"}
    assert {r.party_name for r in seen[-1]["owners"].filter("serial_number = 7").collect()} == {"SEVEN 3 Inc."}
    assert listed(spark, f"{root}/manifests") == ["v000001.json", "v000002.json"]
    own = tables.touched(spark.createDataFrame([(7,)], "serial_number long"))[0]
    held = {f for f in _files(root) if f.endswith(f"bucket={own}")}
    assert {f.split("/")[1] for f in held} == {"v000001", "v000002"}  # older ones of this bucket are gone


def test_ledger_counts_and_failures(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "v"
    folder.mkdir()
    seen = []
    run = lambda: ingest_daily(spark, str(folder), str(tmp_path / "cp"), str(root), seen.append, buckets=4).awaitTermination()
    _zip(folder / "apc240101.zip", (1, "ONE"), ("x", "BAD"), (2, "TWO"))
    _zip(folder / "apc240102.zip", *[(k, f"MARK {k}") for k in range(10, 400)])
    whole = (folder / "apc240102.zip").read_bytes()
    (folder / "apc240102.zip").write_bytes(whole[: len(whole) // 2])
    (folder / "apc240103.zip").write_bytes(b"no archive at all")
    with zipfile.ZipFile(folder / "apc240104.zip", "w"):
        pass
    run()
    row = lambda r: (r.source_file, r.status, r.records_total, r.records_inserted, r.records_errored)
    rows = {r.source_file: r for r in seen[-1]["ledger"].collect()}
    assert row(rows["apc240101.zip"]) == ("apc240101.zip", "completed", 3, 2, 1)
    assert rows["apc240102.zip"].status == rows["apc240103.zip"].status == "failed" and rows["apc240103.zip"].error_message
    assert rows["apc240102.zip"].records_inserted == 0
    assert row(rows["apc240104.zip"]) == ("apc240104.zip", "completed", 0, 0, 0)
    assert {r.serial_number for r in seen[-1]["trademarks"].collect()} == {1, 2}
    tables = ingest.store(spark, str(root), 4)
    assert [p.rsplit("/", 1)[-1] for p in ingest.failed_files(tables)] == ["apc240102.zip", "apc240103.zip"]
    (folder / "apc240102.zip").write_bytes(whole)  # mended in place; taken with the next new file
    _zip(folder / "apc240105.zip", (3, "THREE"))
    run()
    assert {r.serial_number for r in seen[-1]["trademarks"].collect()} == {1, 2, 3, *range(10, 400)}
    assert [p.rsplit("/", 1)[-1] for p in ingest.failed_files(tables)] == ["apc240103.zip"]
    assert ingest.read_ledger(tables).count() == 4 + 3


def test_batch_that_was_cut_off_is_loaded_again(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "v"
    folder.mkdir()
    tables = ingest.store(spark, str(root), 8)
    _zip(folder / "apc240101.zip", (1, "ONE"), (2, "TWO"))
    ingest.load_archives(tables, [str(folder / "apc240101.zip")], 0)
    _zip(folder / "apc240102.zip", (1, "ONE B"), (3, "THREE"))
    ingest.load_archives(tables, [str(folder / "apc240102.zip")], 1)
    (root / "manifests" / "v000001.json").unlink()
    assert ingest.read_ledger(tables).count() == 1
    ingest.load_archives(tables, [str(folder / "apc240102.zip")], 1)
    assert {r.mark_identification for r in ingest.read_registry(tables)["trademarks"].collect()} == {"ONE B", "TWO", "THREE"}


def test_children_follow_their_parents_as_in_a_plain_upsert(spark, sf):
    parts = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey AS serial_number", "l_partkey AS code", "l_linenumber AS n")
    base, delta = parts.filter("n <= 2"), parts.filter("n = 3 AND serial_number % 5 = 0")
    parents = delta.select("serial_number").distinct()
    got = upsert_children(base, parents, delta, "serial_number")
    gone = {r[0] for r in parents.collect()}
    want = [tuple(r) for r in base.collect() if r[0] not in gone] + [tuple(r) for r in delta.collect()]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert upsert(parents, parents, ["serial_number"], ["serial_number"]).count() == len(gone)
