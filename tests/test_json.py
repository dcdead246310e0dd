import json as pyjson
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.config import Source
from ledgerloom.sources import json

WAYS = [{}, {"lines": "true"}]

SPARK_ERRORS = (PySparkException, Py4JJavaError)


def write(path, records, options):
    lines = "lines" in options
    path.write_text("\n".join(map(pyjson.dumps, records)) if lines else pyjson.dumps(records, indent=1))
    return Source("any", "json", str(path), options)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("options", WAYS)
def test_nested(spark, tmp_path, options):
    def record(i, details):
        return {"company": {"company_id": i, "details": details}}

    records = [
        record("C1", {"year": 2023, "financials": {"revenue": 1.5, "currency": "eur"}}),
        record("C2", {"year": "0", "financials": {"revenue": 0, "currency": ""}}),
        record("C3", {"year": 0, "financials": {"revenue": "0"}}),
        record(7, {"year": True, "financials": {}}),
        record("C5", {"financials": None}),
        record("C6", None),
        record("C7", [1]),
        record("C8", {"year": 100.0, "financials": {"revenue": [], "currency": False}}),
        {"company": {"company_id": "C9"}},
        {"company": None}, {"company": "text"}, {"other": 1},
    ]
    source = write(tmp_path / "n.json", records, options)
    assert rows(json.read_nested(spark, source)) == sorted([
        ("C1", "2023", "1.5", "eur", "n.json"),
        ("C2", "0", None, None, "n.json"),
        ("C3", None, "0", None, "n.json"),
        ("7", "True", None, None, "n.json"),
        ("C8", "100.0", None, None, "n.json"),
        ("C9", None, None, None, "n.json"),
        (None, None, None, None, "n.json"),
    ], key=str)


@pytest.mark.parametrize("options", WAYS)
def test_periods(spark, tmp_path, options):
    records = [
        {"company_id": "A", "financials": {"CY": {"revenue": 5}, "PY": {"revenue": 4}, "XY": {}}},
        {"company_id": "B", "financials": {"CY": {"revenue": 0}}},
        {"company_id": "C", "financials": {"CY": {"revenue": 1}, "PY": None}},
        {"company_id": "D", "financials": {"CY": None, "PY": {"revenue": 1}}},
        {"company_id": "E"},
        {"company_id": "F", "financials": None},
    ]
    source = write(tmp_path / "p.json", records, options)
    assert rows(json.read_periods(spark, source)) == sorted([
        ("A", "CY", "5", "p.json"), ("A", "PY", "4", "p.json"),
        ("B", "CY", None, "p.json"), ("B", "PY", None, "p.json"),
        ("C", "CY", "1", "p.json"),
        ("E", "CY", None, "p.json"), ("E", "PY", None, "p.json"),
    ], key=str)


@pytest.mark.parametrize("options", WAYS)
def test_broken_json_fails(spark, tmp_path, options):
    path = tmp_path / "b.json"
    path.write_text('[{"company": {"company_id": "C1"}}, {"company": ')
    with pytest.raises(SPARK_ERRORS):
        json.read_nested(spark, Source("any", "json", str(path), options)).collect()


def test_splitting_random_arrays(spark, tmp_path):
    rnd = random.Random(5)

    def value(depth=0):
        kind = rnd.random()
        if kind < 0.4:
            return rnd.choice(["a", "}", "{", "\\", '"', '\\"}', "é{", '}{"', "", "x\ny", "[,]"])
        if kind < 0.6 or depth > 2:
            return rnd.choice([None, True, 1.5, -3])
        if kind < 0.75:
            return [value(depth + 1) for _ in range(rnd.randint(0, 3))]
        return {rnd.choice(["k", "}", "a{", 'q"']): value(depth + 1) for _ in range(rnd.randint(0, 3))}

    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for n in range(12):
            records = [
                rnd.choice(["x}{", 5, None, [1], "[", [{"a": 5}, [{}]], []]) if rnd.random() < 0.3
                else {"company": value(), "z": value()}
                for _ in range(rnd.randint(0, 10))
            ]
            path = tmp_path / f"{n}.json"
            path.write_text(pyjson.dumps(records, indent=rnd.choice([None, 2])))
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(rnd.choice([7, 16, 40, 1000])))
            found = json.read_elements(spark, Source("any", "json", str(path)))
            got = [pyjson.loads(r.text) for r in found.selectExpr("to_json(element) as text").collect()]
            shown = [sorted(pyjson.dumps(r, sort_keys=True) for r in x) for x in (got, records)]
            assert shown[0] == shown[1], path.read_text()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_list_that_ends_too_early_is_an_error(spark, tmp_path):
    path = tmp_path / "odd.json"
    path.write_text('[{"a":1},{"a":5')
    with pytest.raises(SPARK_ERRORS):
        json.read_elements(spark, Source("any", "json", str(path))).collect()


@pytest.mark.parametrize("options", WAYS)
def test_one_bad_element_leaves_the_others(spark, tmp_path, options):
    records = [{"company": {"company_id": "C1"}}, 5, None, "}", [{"company": {"company_id": "no"}}],
               {"company": {"company_id": "C2", "details": None}}, {"company": {"company_id": "C3"}}, [], True]
    source = write(tmp_path / "m.json", records, options)
    assert rows(json.read_nested(spark, source)) == [
        ("C1", None, None, None, "m.json"), ("C3", None, None, None, "m.json")]
    rejects = rows(json.nested_rejects(spark, source))
    assert rejects == sorted(
        [(pyjson.dumps(r, separators=(",", ":")), json.NO_OBJECT, "m.json") for r in (5, None, "}", records[4], [], True)]
        + [(pyjson.dumps(records[5], separators=(",", ":")), json.UNUSABLE, "m.json")], key=str)


@pytest.mark.parametrize("text,data", [
    ('{"company": {"company_id": "C1"}}\n', '{"source_file":"t.json"}'), ('{"a": [{"company": {}}, {}], "b": "}"}', '{"source_file":"t.json"}'),
    ("", None), (" \n", None), ("[]", None), ("5", "5"), ('"a } b"', '{"source_file":"t.json"}')])
def test_files_without_a_list(spark, tmp_path, text, data):
    path = tmp_path / "t.json"
    path.write_text(text)
    source = Source("any", "json", str(path))
    assert json.read_nested(spark, source).count() == 0
    rejects = [(r.record_data, r.rejection_reason) for r in json.nested_rejects(spark, source).collect()]
    assert rejects == ([(data, json.NO_LIST)] if data else [])


def small_blocks(spark, size):
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))


def usual_blocks(spark):
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_random_lines_are_found_without_an_option(spark, tmp_path):
    """Files of one value per line, in blocks of a few bytes: the same elements as line by line."""
    rnd = random.Random(7)
    values = ["}", "{", '"', "\\", "é{", "x\ny", 5, None, [1, {"a": "}"}], [], {"company": {"company_id": "}{"}}, {}]
    try:
        for n in range(12):
            records = [{"company": {"company_id": rnd.choice(values[:6]), "z": rnd.choice(values)}} if rnd.random() < 0.6 else rnd.choice(values)
                       for _ in range(rnd.randint(2, 12))] + [{"a": 1}, {"b": 2}]
            text = "".join(pyjson.dumps(r) + rnd.choice(["\n", "\r\n", "\n \n"]) for r in records)
            path = tmp_path / f"{n}.json"
            path.write_bytes((text if rnd.random() < 0.5 else text.rstrip()).encode())
            small_blocks(spark, rnd.choice([7, 16, 40, 1000]))
            found = json.read_elements(spark, Source("any", "json", str(path)))
            got = sorted(pyjson.dumps(pyjson.loads(r.text), sort_keys=True) for r in found.where("not no_list").selectExpr("to_json(element) as text").collect())
            assert got == sorted(pyjson.dumps(r, sort_keys=True) for r in records), text
    finally:
        usual_blocks(spark)


@pytest.mark.parametrize("text", ['{"a":1}\n{"b":2', '{"a":1}\n{"b":{"c":2}', '{"a":1}\n[{"b":2}', '{"a":{"b":1}', '{"a":1}\n}', "hello", '{"a":1}\nhello'])
def test_lines_that_are_broken_fail(spark, tmp_path, text):
    path = tmp_path / "b.json"
    path.write_text(text)
    with pytest.raises(SPARK_ERRORS):
        json.read_elements(spark, Source("any", "json", str(path))).collect()


def test_a_compressed_list_is_shared_by_many_groups(spark, tmp_path, monkeypatch):
    import gzip

    from ledgerloom.sources import ordered_text

    monkeypatch.setattr(ordered_text, "LINES", 50)
    records = [{"company": {"company_id": f"C{i}"}} for i in range(1000)]
    (tmp_path / "l.json.gz").write_bytes(gzip.compress(pyjson.dumps(records).encode()))
    (tmp_path / "n.json.gz").write_bytes(gzip.compress("\n".join(map(pyjson.dumps, records)).encode()))
    found = json.read_nested(spark, Source("any", "json", str(tmp_path))).groupBy("source_file").agg(F.countDistinct("company_id"))
    assert sorted(map(tuple, found.collect())) == [("l.json.gz", 1000), ("n.json.gz", 1000)]
    assert ordered_text.ordered_lines(spark, f"{tmp_path}/l.json.gz", "}").select("block").distinct().count() == 41


def test_a_large_object_is_not_gathered(spark, tmp_path):
    """No group holds more than one piece of a file that is one object, nor more than one line's of lines."""
    from ledgerloom.sources.json_split import read_elements

    (tmp_path / "o.json").write_text(pyjson.dumps({"all": [{"company": {"company_id": f"C{i}"}} for i in range(500)]}))
    (tmp_path / "l.json").write_text("".join(pyjson.dumps({"company": {"company_id": f"C{i}"}}) + "\n" for i in range(500)))
    small_blocks(spark, 2000)
    try:
        runs = read_elements(spark, str(tmp_path)).collect()
        assert max(len(r.text or "") for r in runs) < 50
        assert [r.text for r in runs if r.shape == "object"] == [None]
        assert sum(r.shape == "lines" and r.text.strip() != "" for r in runs) == 500
    finally:
        usual_blocks(spark)


def test_files_of_several_shapes_in_one_source(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"company": {"company_id": "A"}}, 7]')
    (tmp_path / "b.json").write_text('{"company": {"company_id": "B"}}\n{"company": null}\n{"company": {"company_id": "C"}}\n')
    (tmp_path / "c.json").write_text('{"company": {"company_id": "D"}}')
    found = json.read_nested_outcomes(spark, Source("any", "json", str(tmp_path)))
    assert sorted((r.company_id or "", r.source_file, r.rejection_reason or "") for r in found.collect()) == sorted([
        ("A", "a.json", ""), ("", "a.json", json.NO_OBJECT), ("B", "b.json", ""), ("", "b.json", json.UNUSABLE), ("C", "b.json", ""),
        ("", "c.json", json.NO_LIST)])


def test_outcomes_of_periods(spark, tmp_path):
    records = [{"company_id": "C", "financials": {"CY": {"revenue": 1}, "PY": None}}, {"company_id": "D", "financials": {"CY": None}}, 4]
    source = write(tmp_path / "p.json", records, {})
    found = json.read_period_outcomes(spark, source)
    assert sorted((r.company_id, r.period, r.revenue, r.rejection_reason) for r in found.where("company_id is not null").collect()) == [
        ("C", "CY", "1", None)]
    rejects = {(r.record_data, r.rejection_reason) for r in json.rejects_of(found).collect()}
    assert rejects == {(pyjson.dumps(records[0], separators=(",", ":")), json.UNUSABLE), (pyjson.dumps(records[1], separators=(",", ":")), json.UNUSABLE),
                       ("4", json.NO_OBJECT)}


def test_a_batch_parses_its_files_once(spark, tmp_path, monkeypatch):
    """One pass gives rows and rejects: a second call of the reader would read other records."""
    from datetime import datetime

    from ledgerloom import schemas
    from ledgerloom.config import RunConfig
    from ledgerloom.plans import batch
    from ledgerloom.sinks import Warehouse

    calls = []
    real = json.read_elements
    monkeypatch.setattr(json, "read_elements", lambda *a: calls.append(1) or real(*a))
    source = write(tmp_path / "n.json", [{"company": {"company_id": "A"}}, 5, {"company": None}], {})
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    result = batch.run(spark, RunConfig((Source("financials_json", "json", source.path),)), warehouse, "b1", datetime(2024, 1, 1))
    assert result.failed == {} and result.staged == 1 and result.unusable == {"financials_json": 2} and len(calls) == 1
    raw = warehouse.read("raw/json_financials_data", schemas.RAW_NESTED_JSON)
    assert [r.company_id for r in raw.collect()] == ["A"]
    assert warehouse.read(batch.REJECTS, schemas.REJECT_LOG).count() == 2


def test_one_list_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "big.json"
    path.write_text(pyjson.dumps([{"company": {"company_id": f"C{i}"}} for i in range(2000)]))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        from ledgerloom.sources.ordered_text import ordered_lines
        assert ordered_lines(spark, str(path), "}").rdd.getNumPartitions() > 10
        assert json.read_nested(spark, Source("any", "json", str(path))).count() == 2000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_repeated_keys_and_rejects_in_a_batch(spark, tmp_path):
    from datetime import datetime

    from ledgerloom import schemas
    from ledgerloom.config import RunConfig
    from ledgerloom.plans import batch
    from ledgerloom.sinks import Warehouse

    path = tmp_path / "r.json"
    path.write_text('[{"company_id": "A", "company_id": "B", "financials": {"CY": {"revenue": 1}, "PY": {"revenue": 2}}}, 7]')
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    result = batch.run(spark, RunConfig((Source("period_json", "json", str(path)),)), warehouse, "b1", datetime(2024, 1, 1))
    assert result.failed == {} and result.staged == 2
    assert (result.rejected, result.unusable) == (1, {"period_json": 1})
    (entry,) = warehouse.read(batch.REJECTS, schemas.REJECT_LOG).collect()
    assert (entry.record_data, entry.rejection_reason) == ("7", json.NO_OBJECT)
    assert {r.company_id for r in warehouse.read(batch.FINANCIALS, schemas.STAGED_FINANCIALS).collect()} == {"B"}


def test_blocks_are_dealt_into_many_parts(spark):
    """A task sorts a small share of a source, however few partitions the session shuffles into (here 8)."""
    from ledgerloom.sources import ordered_text
    from ledgerloom.sources.json_split import split_elements

    pieces = spark.range(4000).selectExpr("'f' AS file", "id div 4 AS block", "id AS pos", "',{\"a\":' || id AS line")
    runs = split_elements(pieces, top=0)
    assert "REPARTITION_BY_NUM" in runs._jdf.queryExecution().executedPlan().toString()
    dealt = ordered_text.dealt(pieces.select("file", "block"))
    assert dealt.select(F.spark_partition_id()).distinct().count() > 100
    assert {r.text for r in runs.collect()} == {f',{{"a":{k}}}' for k in range(4000)}
