import re

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from ledgerloom.config import Source
from ledgerloom.sources import xml
from tests import fixtures

SPARK_ERRORS = (PySparkException, Py4JJavaError)


def source(path, **options):
    return Source("any", "xml", str(path), options)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"splittable": "false"}])
def test_period_elements(spark, tmp_path, options):
    path = tmp_path / "p.xml"
    path.write_text(
        '<xbrl xmlns="http://example.org"><entity><identifier> C1 </identifier>'
        '<financials period="CY"><revenue>10</revenue><profit>3</profit></financials>'
        "<financials><revenue/></financials></entity>"
        "<entity><identifier>C2</identifier></entity>"
        '<entity><financials period="PY"><revenue> 7 </revenue></financials></entity></xbrl>'
    )
    assert rows(xml.read_periods(spark, source(path, **options))) == sorted([
        ("C1", "CY", "10", "3", "p.xml"),
        ("C1", "UNKNOWN", None, None, "p.xml"),
        (None, "PY", "7", None, "p.xml"),
    ], key=str)


@pytest.mark.parametrize("options", [{}, {"splittable": "false"}])
def test_companies_without_details_give_no_row(spark, tmp_path, options):
    path = tmp_path / "c.xml"
    path.write_text(
        "<Companies><Company><CompanyID>1</CompanyID><Details><Name>A</Name><Financials>"
        "<Revenue>5</Revenue><Year>2023</Year></Financials></Details></Company>"
        "<Company><CompanyID>2</CompanyID></Company>"
        "<Company><CompanyID>3</CompanyID><Details><Name>C</Name></Details></Company>"
        "<Company><CompanyID>4</CompanyID><Details><Financials><Year>2020</Year></Financials>"
        "</Details></Company></Companies>"
    )
    assert rows(xml.read_companies(spark, source(path, **options))) == sorted([
        ("1", "A", "5", "2023", "c.xml"), ("4", None, None, "2020", "c.xml"),
    ], key=str)


def test_one_line_file_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "big.xml"
    fixtures.write_period_xml(path, n=400)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    try:
        df = xml.read_periods(spark, source(path))
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 800
        assert df.select("company_id").distinct().count() == 400
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("options", [{}, {"prefix": "x"}, {"splittable": "false"}])
def test_prefixed_tags(spark, tmp_path, options):
    """The root's prefix is found without an option."""
    path = tmp_path / "x.xml"
    fixtures.write_period_xml(path, n=5, prefix="x")
    assert xml.read_periods(spark, source(path, **options)).count() == 10


@pytest.mark.parametrize("head,prefix", [
    ("<a>", None), ("<x:a y:b='1'>", "x"), ("<?xml version='1.0'?>\n<!-- <y:b> -->\n<x-1:a>", "x-1"), ("\ufeff <a xmlns:x='u'><x:b>", None),
    ("<!DOCTYPE x:a [<!ELEMENT y:b ANY>]><x:a>", "x"), ("<!DOCTYPE a><p:a/>", "p"), ("", None), ("no xml", None)])
def test_prefix_of_the_root(head, prefix):
    assert xml.root_prefix(head) == prefix


def test_files_with_other_prefixes_are_an_error(spark, tmp_path):
    for name, prefix in (("a", None), ("b", "x")):
        fixtures.write_period_xml(tmp_path / f"{name}.xml", n=3, prefix=prefix)
    with pytest.raises(SPARK_ERRORS, match="prefix"):
        xml.read_periods(spark, source(tmp_path)).collect()
    assert xml.read_periods(spark, source(tmp_path, splittable="false")).count() == 12


def test_equal_file_names_in_several_folders(spark, tmp_path):
    for year, n in (("2023", 3), ("2024", 4)):
        (tmp_path / year).mkdir()
        fixtures.write_period_xml(tmp_path / year / "periods.xml", n=n)
    assert xml.read_periods(spark, source(tmp_path / "*" / "periods.xml")).count() == 14
    # A missing end is not made up for by another file of that name.
    (tmp_path / "2025").mkdir()
    (tmp_path / "2025" / "periods.xml").write_text("<xbrl><entity><identifier>C1</identifier></entity>")
    (tmp_path / "2026").mkdir()
    (tmp_path / "2026" / "periods.xml").write_text("<entity><identifier>C1</identifier></entity></xbrl>")
    with pytest.raises(SPARK_ERRORS, match="ends too early"):
        xml.read_periods(spark, source(tmp_path / "*" / "periods.xml")).collect()


def run_batch(spark, folder, files, name="xbrl_xml", **options):
    from datetime import datetime

    from ledgerloom.config import RunConfig
    from ledgerloom.plans import batch
    from ledgerloom.sinks import Warehouse

    warehouse = Warehouse(spark, str(folder / "wh"))
    result = batch.run(spark, RunConfig((Source(name, "xml", str(files), options),)), warehouse, "b1", datetime(2024, 1, 1))
    return warehouse, result


@pytest.mark.parametrize("options", [{}, {"splittable": "false"}])
def test_a_batch_reads_documents_once(spark, tmp_path, options, monkeypatch):
    """Rows and marks come from one pass; marks are neither rows nor rejects."""
    from ledgerloom import schemas
    from ledgerloom.plans import batch

    calls, real = [], xml._chunks
    monkeypatch.setattr(xml, "_chunks", lambda *a: calls.append(1) or real(*a))
    (tmp_path / "in" / "a").mkdir(parents=True)
    fixtures.write_period_xml(tmp_path / "in" / "p.xml", n=4, prefix="x")
    fixtures.write_period_xml(tmp_path / "in" / "a" / "p.xml", n=2, prefix="x")
    warehouse, result = run_batch(spark, tmp_path, f"{tmp_path}/in/{{p.xml,a/p.xml}}", **options)
    assert (result.failed, result.staged, result.rejected, len(calls)) == ({}, 12, 0, 1)
    raw = warehouse.read("raw/xml_xbrl_data", schemas.RAW_PERIOD_XML)
    assert raw.count() == 12 and raw.where("company_id is null").count() == 0
    assert warehouse.read(batch.REJECTS, schemas.REJECT_LOG).count() == 0


@pytest.mark.parametrize("text,problem", [
    ("<xbrl><entity><identifier>C1</identifier><financials><revenue>1</revenue></financials></entity>", "ends too early"),
    ("<entity><identifier>C1</identifier><financials><revenue>1</revenue></financials></entity>", "without a root"),
    ("<xbrl><g><entity><identifier>C1</identifier></entity></g></xbrl>", "below another element"),
])
def test_a_broken_document_leaves_no_rows_of_a_batch(spark, tmp_path, text, problem):
    from ledgerloom import schemas

    (tmp_path / "b.xml").write_text(text)
    warehouse, result = run_batch(spark, tmp_path, tmp_path / "b.xml")
    assert problem in result.failed["xbrl_xml"] and result.staged == 0
    assert warehouse.read("raw/xml_xbrl_data", schemas.RAW_PERIOD_XML).count() == 0


@pytest.mark.parametrize("body", [
    "<!-- <entity><identifier>C0</identifier></entity> -->",
    "<entity><identifier>C0</identifier></entity >",
])
def test_text_that_cannot_be_split_is_an_error(spark, tmp_path, body):
    path = tmp_path / "odd.xml"
    path.write_text(f"<xbrl>{body}<entity><identifier>C1</identifier></entity></xbrl>")
    with pytest.raises(SPARK_ERRORS, match="splittable=false"):
        xml.read_periods(spark, source(path)).collect()


@pytest.mark.parametrize("options", [{}, {"splittable": "false"}])
def test_broken_xml_fails(spark, tmp_path, options):
    path = tmp_path / "broken.xml"
    path.write_text("<xbrl><entity><identifier>C1</x></entity></xbrl>")
    with pytest.raises(SPARK_ERRORS):
        xml.read_periods(spark, source(path, **options)).collect()


@pytest.mark.parametrize("options", [{}, {"splittable": "false"}])
@pytest.mark.parametrize("text", [
    "<xbrl><entity><identifier>C1</identifier></entity>",
    "<xbrl><entity><identifier>C1</identifier></entity><entity><identifier>C2</identifier>",
    "<xbrl><entity><identifier>C1</identifier></entity><ent",
])
def test_a_document_that_ends_too_early_fails(spark, tmp_path, options, text):
    path = tmp_path / "cut.xml"
    path.write_text(text)
    with pytest.raises(SPARK_ERRORS):
        xml.read_periods(spark, source(path, **options)).collect()


def test_elements_below_other_elements_are_an_error(spark, tmp_path):
    path = tmp_path / "deep.xml"
    path.write_text("<xbrl><entity><identifier>C1</identifier></entity><g><entity><identifier>C2</identifier></entity></g></xbrl>")
    with pytest.raises(SPARK_ERRORS, match="below another element"):
        xml.read_periods(spark, source(path)).collect()


@pytest.mark.parametrize("options", [{}, {"splittable": "false"}])
def test_the_first_of_repeated_children_counts(spark, tmp_path, options):
    path = tmp_path / "r.xml"
    path.write_text(
        "<?xml version='1.0'?><!-- <entity> --><xbrl><!-- a note --><other><x/></other><entity><identifier>1</identifier><identifier>2</identifier>"
        "<financials period='CY'><!-- <entity><revenue>7</revenue> --><revenue>1</revenue><revenue>9</revenue></financials></entity></xbrl>\n<!-- end -->\n")
    assert rows(xml.read_periods(spark, source(path, **options))) == [("1", "CY", "1", None, "r.xml")]


def test_other_encodings_need_the_unsplit_reader(spark, tmp_path):
    path = tmp_path / "e.xml"
    path.write_bytes(
        '<?xml version="1.0" encoding="ISO-8859-1"?><Companies><Company><CompanyID>1</CompanyID><Details><Name>Café</Name>'
        "<Financials/></Details></Company></Companies>".encode("latin-1"))
    with pytest.raises(SPARK_ERRORS, match="iso-8859-1"):
        xml.read_companies(spark, source(path)).collect()


@pytest.mark.parametrize("text", ["<xbrl></xbrl>", "<xbrl/>", "<xbrl><note/></xbrl>\n", ""])
def test_documents_without_elements_give_no_row(spark, tmp_path, text):
    path = tmp_path / "none.xml"
    path.write_text(text)
    assert xml.read_periods(spark, source(path)).count() == 0


def test_plain_elements_are_told_without_a_pattern(spark):
    chunks = ["<entity><a>1</a>", "\n<entity>x", " \t\r\n<entity>", "<entity/>", "<entity a='1'>x", "<entity>a<entity>b", "<entity>an entity",
              "<entity>a<n:entity >b", "x<entity>", "<entity", "", "<Entity>x", "</xbrl>", " <entity>x", None]
    found = spark.createDataFrame([(c,) for c in chunks], "chunk string").select(
        "chunk", xml._plainly_alone("entity", "entity").alias("plain"), xml._alone("entity", "entity").alias("alone")).collect()
    pattern = [c is not None and bool(re.match(r"\s*<entity[\s>]", c, re.A)) and len(re.findall(r"<(?:[^<>/\s:]+:)?entity[\s>]", c)) == 1 for c in chunks]
    assert [bool(r.alone) for r in found] == pattern
    assert [r.chunk for r in found if r.plain] == chunks[:3]
