import csv
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.config import Source
from ledgerloom.sources import sectioned_csv as sc
from tests import fixtures

COLUMNS = ("company_id", "profit", "year", "remarks")

SPARK_ERRORS = (PySparkException, Py4JJavaError)


def source(path, **options):
    return Source("any", "csv", str(path), options)


def walk(path):
    """The plain reading of a file, top to bottom: rows with table number, metadata."""
    rows, metadata = [], []
    places, table, filled = None, -1, False
    with open(path, newline="") as handle:
        for record in csv.reader(handle):
            cells = [c.strip() for c in record]
            lowered = [c.lower() for c in cells]
            if not any(cells):
                if filled:
                    places, filled = None, False
            elif set(lowered) & set(sc.METADATA_LABELS):
                shown = [c for c in cells if c]
                if len(shown) > 1:
                    metadata.append((shown[0], shown[1]))
            elif len(set(lowered) & set(COLUMNS)) > 1:
                places, filled = {c: i for i, c in enumerate(lowered)}, False
            elif places is not None:
                table += not filled
                filled = True
                rows.append(tuple(
                    (cells[places[c]] or None) if c in places and places[c] < len(cells) else None
                    for c in COLUMNS
                ) + (table,))
    return sorted(rows, key=str), sorted(metadata, key=str)


def check(spark, path, **options):
    given = source(path, **options)
    rows, metadata = walk(path)
    got = sc.read_tables(spark, given).drop("source_file").collect()
    assert sorted((tuple(r) for r in got), key=str) == rows
    got = sc.read_metadata(spark, given).drop("source_file").collect()
    assert sorted((tuple(r) for r in got), key=str) == metadata
    return rows, metadata


def test_two_tables(spark, tmp_path):
    path = tmp_path / "a b+%20.csv"
    fixtures.write_csv(path)
    rows, metadata = check(spark, path)
    assert [sum(r[4] == t for r in rows) for t in (0, 1)] == [80, 20] and len(metadata) == 3
    names = sc.read_tables(spark, source(path)).select("source_file").distinct().collect()
    assert [r[0] for r in names] == ["a b+%20.csv"]


PIECES = [
    ",company_id,profit,year,remarks", "Year, REMARKS ,company_id,profit,", "profit,year",
    "company_id,year,company_id,profit", "", ",,", " , ", '"",""', ",entity name , X ,",
    "period end date", 'C1,"6,extra",2020,r|x', '"C""2",5,"x""y"z,', "C3", "C4,1,2,3,4,5,6",
    "year", "\tC5 ,7,,", 'C6,a"b,"",""""',
]


#: Pieces of records: cells that begin in one line and end in another, or never.
BROKEN = ['C7,"6', 'x",2021,"', '"', 'a"b,"c', '",",', '"" "",', '"q""', ',"company_id', 'year",3', '"\r', "one\rtwo,3", 'C8,"a\r\rb",1,2']


def random_file(rnd, path, pieces):
    lines = rnd.choices(pieces, k=rnd.randint(0, 40))
    path.write_bytes("".join(line + rnd.choice(["\r\n", "\n"]) for line in lines).encode()[: None if rnd.random() < 0.5 else -1])


@pytest.mark.parametrize("pieces,options", [(PIECES, {}), (PIECES, {"multiline_cells": "false"}), (PIECES + BROKEN, {}), (PIECES[:6] + BROKEN, {})])
def test_random_files(spark, tmp_path, pieces, options):
    rnd = random.Random(11)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for n in range(12):
            path = tmp_path / f"{n}.csv"
            random_file(rnd, path, pieces)
            # From one line per block to the whole file in one.
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(rnd.choice([5, 30, 90, 10_000])))
            check(spark, path, **options)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_cell_with_line_breaks(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_bytes(b'company_id,profit,remarks\r\nC1,5,"one\r\ntwo ""2"" , x"\r\nC2,6,z\r\n\r\nq,1,2\r\n')
    rows, _ = check(spark, path)
    assert [r[3] for r in rows] == ['one\r\ntwo "2" , x', "z"]
    with pytest.raises(SPARK_ERRORS, match="multiline_cells"):
        sc.read_tables(spark, source(path, multiline_cells="false")).collect()


def test_a_quote_that_never_closes_is_an_error(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text('company_id,profit\nC1,"5\n' + "C2,6,some more text\n" * 9000)
    with pytest.raises(SPARK_ERRORS, match="not closed"):
        sc.read_tables(spark, source(path)).collect()


def test_a_compressed_file_is_shared_by_many_groups(spark, tmp_path, monkeypatch):
    """Blocks of a few lines of one gzip file, cells over several lines among them: the same as the plain file."""
    import gzip

    from ledgerloom.sources import ordered_text

    monkeypatch.setattr(ordered_text, "LINES", 7)
    rnd = random.Random(3)
    for n in range(4):
        plain = tmp_path / f"{n}.csv"
        random_file(rnd, plain, PIECES + BROKEN)
        (tmp_path / f"{n}.csv.gz").write_bytes(gzip.compress(plain.read_bytes()))
        read = {p: sorted(map(tuple, sc.read_tables(spark, source(p)).drop("source_file").collect()), key=str) for p in (plain, f"{plain}.gz")}
        assert read[plain] == read[f"{plain}.gz"] == walk(plain)[0]
    lines = ordered_text.ordered_lines(spark, f"{tmp_path}/*.gz")
    assert lines.groupBy("file", "block").count().agg(F.max("count")).first()[0] == 7
    assert lines.select("file", "block").distinct().count() > 4


def test_several_files_are_separate(spark, tmp_path):
    for name in ("a", "b"):
        fixtures.write_csv(tmp_path / f"{name}.csv")
    counts = sc.read_tables(spark, source(tmp_path)).groupBy("source_file", "table_index").count()
    assert sorted(tuple(r) for r in counts.collect()) == [
        ("a.csv", 0, 80), ("a.csv", 1, 20), ("b.csv", 0, 80), ("b.csv", 1, 20)]


def test_lines_are_read_and_shuffled_once(spark, tmp_path):
    fixtures.write_csv(tmp_path / "a.csv")
    df = sc.read_tables(spark, source(tmp_path / "a.csv")).where(F.col("year").isNotNull())
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_cells_of_plain_data_are_left_to_the_branch_that_needs_them(spark):
    lines = ['company_id,year', '"C1, x",1998', '"","",', 'C2,1999', '',  None]
    frame = spark.createDataFrame([("f", 0, k, line) for k, line in enumerate(lines)], "file string, block long, pos long, line string")
    found = {r.pos: r for r in sc.classify(frame).collect()}
    assert [found[k].kind for k in range(6)] == ["header", "data", "blank", "data", "blank", "data"]
    assert [found[k].cells for k in range(6)] == [["company_id", "year"], None, ["", "", ""], None, [""], None]
    rows = sc.data_rows(frame.where("pos < 5 AND pos <> 2")).select("company_id", "year").collect()
    assert {tuple(r) for r in rows} == {("C1, x", "1998"), ("C2", "1999")}


def test_line_ends(spark):
    lines = ["a\n", "a\r", "a\r\n", "a\n\r", "a\n\n", "\r\n", "\n", "", "a", None]
    frame = spark.createDataFrame([(x,) for x in lines], "line string").select(sc._without_end(F.col("line")))
    assert [r[0] for r in frame.collect()] == ["a", "a", "a", "a\n", "a\n", "", "", "", "a", None]
