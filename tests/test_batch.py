import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.config import RunConfig, Source, load_config
from ledgerloom.plans import batch
from ledgerloom.sinks import DimensionStore, Warehouse
from ledgerloom.sources import reader_for
from tests import fixtures


def config(files, tmp_path, *extra, **settings):
    sources = tuple(Source(name, kind, path) for name, (kind, path) in files.items()) + extra
    return RunConfig(sources, reject_path=str(tmp_path / "rejects"), **settings)


def facts(warehouse):
    return warehouse.read(batch.FACTS, schemas.FINANCIAL_FACT)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Three batches: first load, the same files again, and one renamed company."""
    tmp_path = tmp_path_factory.mktemp("warehouse")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    files = fixtures.write_all(tmp_path / "in")
    bad = (Source("other_json", "json", "nowhere"), Source("sheet", "xls", "nowhere"))
    results = [batch.run(spark, config(files, tmp_path, *bad), warehouse, "b1", datetime(2024, 1, 1))]
    results.append(batch.run(spark, config(files, tmp_path), warehouse, "b2", datetime(2024, 1, 2)))
    files = fixtures.write_all(tmp_path / "in", renamed=(3,))
    results.append(
        batch.run(spark, config(files, tmp_path), warehouse, "b3", datetime(2024, 1, 3), null_safe=True)
    )
    return tmp_path, warehouse, files, results


def test_first_load(loaded):
    _, warehouse, _, (first, *_) = loaded
    assert (first.status, first.staged, first.rejected, first.facts, first.unresolved) == (
        "SUCCESS", 497, 3, 497, 0)
    assert first.dimension == {"new_inserts": 100, "updates": 0, "unchanged": 0}
    assert first.quality == {
        "total_input": 500, "total_passed": 497, "total_rejected": 3,
        "MISSING_COMPANY_ID": 1, "INVALID_YEAR": 2, "INVALID_PROFIT": 0}
    assert list(first.failed) == ["other_json"]


def test_rerun_repeats_only_facts_without_period(loaded):
    _, _, _, (_, second, third) = loaded
    assert second.facts == 297
    assert second.dimension == {"new_inserts": 0, "updates": 0, "unchanged": 100}
    assert third.facts == 0
    assert third.dimension == {"new_inserts": 0, "updates": 1, "unchanged": 99}


def test_tables(spark, loaded):
    tmp_path, warehouse, _, _ = loaded
    staged = warehouse.read(batch.FINANCIALS, schemas.STAGED_FINANCIALS, "b1", "complex_csv")
    assert int(staged.agg({"profit": "sum"}).first()[0]) == sum(
        100 + i for i in range(1, 101) if i not in (11, 15, 26))
    assert warehouse.read("raw/csv_metadata", schemas.RAW_CSV_METADATA).where("batch_id = 'b1'").count() == 3
    assert warehouse.read("raw/csv_data", schemas.RAW_CSV).count() == 300
    rejects = warehouse.read(batch.REJECTS, schemas.REJECT_LOG).where("batch_id = 'b1'")
    assert sorted(r.rejection_reason for r in rejects.collect()) == [
        "INVALID_YEAR(20X3); ", "INVALID_YEAR(20x3); ", "MISSING_COMPANY_ID; "]
    written = spark.read.option("header", True).csv(f"{tmp_path}/rejects/reject_complex_csv_20240101_000000.csv")
    assert written.count() == 3 and "_dq_reason" in written.columns
    companies = warehouse.read(batch.COMPANIES, schemas.STAGED_COMPANIES).where("batch_id = 'b1'")
    assert companies.count() == 100


def test_dimension_keeps_history(loaded):
    _, warehouse, _, _ = loaded
    versions = DimensionStore(warehouse).read()
    assert versions.count() == 101 and versions.where("is_current").count() == 100
    renamed = versions.where("company_id = 'C003'").orderBy("valid_from").collect()
    assert [r.company_name for r in renamed] == ["COMPANY_3", "RENAMED_3"]
    assert renamed[0].valid_to == renamed[1].valid_from
    assert renamed[1].dim_company_sk == 101


def test_views(spark, loaded):
    _, warehouse, _, _ = loaded
    batch.views(warehouse)
    lost = facts(warehouse).where("company_id = 'C003'").count()
    assert spark.table("v_company_financials_summary").count() == 794 - lost
    assert spark.table("v_company_history").count() == 101


def test_run_log(loaded):
    _, warehouse, _, _ = loaded
    runs = {r.run_id: r for r in warehouse.runs().collect()}
    assert {r.status for r in runs.values()} == {"SUCCESS"} and len(runs) == 3
    assert runs["b1"].failed_sources == "['other_json']" and runs["b1"].records_rejected == 3


def test_retried_batch_replaces_itself(spark, loaded):
    tmp_path, warehouse, files, _ = loaded
    before = facts(warehouse).count()
    again = batch.run(
        spark, config(files, tmp_path), warehouse, "b3", datetime(2024, 1, 3), null_safe=True)
    assert again.facts == 0 and facts(warehouse).count() == before
    assert again.dimension["unchanged"] == 100
    assert warehouse.read("raw/csv_data", schemas.RAW_CSV).count() == 300


def test_unfinished_dimension_load_is_ignored(spark, loaded):
    _, warehouse, _, _ = loaded
    store = DimensionStore(warehouse)
    version = store.latest().version + 1
    store._materialize(store.read().limit(5), "closed", version)
    store._materialize(store.read().limit(5).withColumn("bucket", F.lit(0)), "current", version, "bucket")
    assert store.read().count() == 101
    assert store.current().where("is_current").count() == 100


def test_all_reasons_or_only_those_of_valid_rows(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("company_id,profit,year\n,1,20x3\nC1,2,2023\n")
    source = Source("complex_csv", "csv", str(path))
    for every, reason in ((False, "MISSING_COMPANY_ID; "), (True, "MISSING_COMPANY_ID; INVALID_YEAR(20x3); ")):
        warehouse = Warehouse(spark, str(tmp_path / f"wh{every}"))
        batch.run(spark, RunConfig((source,)), warehouse, "b1", datetime(2024, 1, 1), all_reasons=every)
        assert [r.rejection_reason for r in warehouse.read(batch.REJECTS, schemas.REJECT_LOG).collect()] == [reason]


def test_failed_load_is_recorded(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    fixtures.write_company_xml(tmp_path / "c.xml", n=2)
    source = Source("hierarchical_xml", "xml", str(tmp_path / "c.xml"))

    def fail(*args):
        raise RuntimeError("no space")

    monkeypatch.setattr(batch, "load_dimension", fail)
    with pytest.raises(RuntimeError):
        batch.run(spark, RunConfig((source,)), warehouse, "b1", datetime(2024, 1, 1))
    (run,) = warehouse.runs().collect()
    assert (run.status, run.error_message) == ("FAILED", "no space")


def test_nothing_to_load(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    result = batch.run(spark, RunConfig(()), warehouse, at=datetime(2024, 1, 1))
    assert result.status == "SUCCESS" and result.facts == 0
    assert result.batch_id.startswith("ETL_20240101_000000_")


def test_truncate(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    row = spark.createDataFrame([("C1", "A")], "company_id string, company_name string")
    from ledgerloom.operators.conform import stage_companies
    assert warehouse.write(stage_companies(row, "b1"), batch.COMPANIES, "b1", "s") == 1
    warehouse.truncate(batch.COMPANIES, schemas.STAGED_COMPANIES)
    assert warehouse.read(batch.COMPANIES, schemas.STAGED_COMPANIES).count() == 0


def test_config_file(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({
        "sources": [{"name": "xbrl_xml", "type": "xml", "path": "p", "options": {"prefix": "x"}}],
        "currency_rates": {"USD": 1, "EUR": 1.1}, "pipeline": {"reject_path": "r", "batch_id_prefix": "X"}}))
    got = load_config(str(path))
    assert got.sources[0].options == {"prefix": "x"} and got.rates["EUR"] == 1.1
    assert (got.reject_path, got.batch_prefix) == ("r", "X")


def test_dispatch():
    assert reader_for(Source("any_name", "csv", "p")).raw_table == "raw/csv_data"
    assert reader_for(Source("x", "xls", "p")) is None
    with pytest.raises(ValueError):
        reader_for(Source("x", "xml", "p"))


def test_duplicates_are_counted_per_source(loaded):
    _, _, _, (first, *_) = loaded
    assert set(first.duplicates) == {"xbrl_xml", "hierarchical_xml", "financials_json", "period_json", "complex_csv"}
    assert sum(first.duplicates.values()) == 0


def test_known_facts_are_read_from_the_folders_of_the_sources(loaded):
    _, warehouse, _, _ = loaded
    known = warehouse.read(batch.FACTS, schemas.FINANCIAL_FACT, sources=["complex_csv"])
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan or "(source" in plan.split("PartitionFilters")[1]
    assert 0 < known.count() < facts(warehouse).count()


def test_the_report_is_taken_while_raw_is_written(spark, tmp_path, monkeypatch):
    """No job of its own: the counts are those of a report on what was stored."""
    from ledgerloom.operators import quality

    stored, real = {}, quality.quality_report
    monkeypatch.setattr(quality, "quality_report", lambda *a: (_ for _ in ()).throw(AssertionError("a job of its own")))
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    csv = csv_source(tmp_path, "company_id,profit,year\nC1,2,2023\n,1,2023\nC2,x,2023\nC3,1,20x3\n").sources
    (tmp_path / "n.json").write_text('[{"company": {"company_id": "A"}}, 5, {"company": {"company_id": " "}}, {"company": null}]')
    config = RunConfig((*csv, Source("financials_json", "json", str(tmp_path / "n.json"))))
    result = batch.run(spark, config, warehouse, "b1", datetime(2024, 1, 1))
    assert result.failed == {} and result.unusable == {"financials_json": 2}
    for table, schema, name in (("raw/csv_data", schemas.RAW_CSV, "complex_csv"), ("raw/json_financials_data", schemas.RAW_NESTED_JSON, "financials_json")):
        stored[name] = real(warehouse.read(table, schema, "b1", name)).first().asDict()
    assert result.quality == {k: sum(r.get(k, 0) for r in stored.values()) for k in {k for r in stored.values() for k in r}}
    assert result.quality["total_input"] == 6 and result.quality["total_rejected"] == 3


def files_read(df):
    """Files that the scans of a query opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_key_summaries_name_the_folders_that_may_hold_a_key(spark, tmp_path):
    """Of three batches only that with a key of the new rows is read; without its summary a batch is always read."""
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    header = "company_id,profit,year\n"

    def load(batch_id, file, lines, **options):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / file).write_text(header + lines)
        config = RunConfig((Source("complex_csv", "csv", str(tmp_path / "in" / file)),))
        return batch.run(spark, config, warehouse, batch_id, datetime(2024, 1, 1), null_safe=True, **options)

    assert load("b1", "a.csv", "C1,1,2023\nC2,1,2023\n").facts == 2
    assert load("b2", "b.csv", "C1,1,2023\n").facts == 1
    assert load("b3", "a.csv", "C3,1,2023\n").facts == 1
    columns = T.StructType([*schemas.STAGED_FINANCIALS, T.StructField("source", T.StringType())])
    def staged(company, file):
        values = {"company_id": company, "source_file": file, "source": "complex_csv"}
        return spark.createDataFrame([tuple(values.get(n) for n in columns.names)], columns)

    def folders(company, file):
        return batch.known_folders(warehouse, staged(company, file), ["complex_csv"], "b9", null_safe=True)

    assert folders("C1", "a.csv") == [("b1", "complex_csv")]
    assert folders("C3", "a.csv") == [("b3", "complex_csv")]
    assert folders("C3", "b.csv") == folders("C1", "c.csv") == []
    read = warehouse.read(batch.FACTS, schemas.FINANCIAL_FACT, folders=folders("C1", "a.csv"))
    assert files_read(read) == 1 and {r.batch_id for r in read.collect()} == {"b1"}
    assert files_read(warehouse.read(batch.FACTS, schemas.FINANCIAL_FACT)) == 3
    assert warehouse.read(batch.FACTS, schemas.FINANCIAL_FACT, folders=[]).count() == 0
    # The same key again is known, wherever it lies; a batch that runs again doesn't know its own.
    assert load("b4", "a.csv", "C1,1,2023\nC3,1,2023\nC4,1,2023\n").facts == 1
    assert load("b4", "a.csv", "C1,1,2023\nC3,1,2023\nC4,1,2023\n").facts == 1
    warehouse.drop(batch.FACT_KEYS, "b2")
    assert ("b2", "complex_csv") in folders("C9", "z.csv")
    # Without null_safe a row without a period is never known, so nothing needs to be read.
    assert batch.known_folders(warehouse, staged("C1", "a.csv"), ["complex_csv"], "b9") == [("b2", "complex_csv")]


def test_first_commit_that_died_counts_as_none(spark, tmp_path):
    store = DimensionStore(Warehouse(spark, str(tmp_path / "wh")))
    (tmp_path / "wh/dwh/dim_company/commits/version=1").mkdir(parents=True)
    assert (store.latest().version, store.latest().max_sk) == (0, 0)
    assert store.read().count() == 0


def names(spark, **named):
    return spark.createDataFrame(list(named.items()), "company_id string, company_name string")


def bucket_files(root):
    """Every data file of the open versions, with its time of change."""
    return {str(f.relative_to(root)): f.stat().st_mtime_ns for f in (root / "current").rglob("*.parquet")}


def test_a_load_rewrites_only_the_buckets_it_changes(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    store, root = DimensionStore(warehouse, buckets=8), tmp_path / "wh/dwh/dim_company"

    def load(batch_id, day, **named):
        at = datetime(2024, 1, day)
        return store.apply(names(spark, **named), batch_id, batch.moment(at), at)

    first = {f"C{i}": f"N{i}" for i in range(100)}
    assert load("b1", 1, **first) == {"new_inserts": 100, "updates": 0, "unchanged": 0}
    before = bucket_files(root)
    assert load("b2", 2, C7="other", C8="N8") == {"new_inserts": 0, "updates": 1, "unchanged": 1}
    after = bucket_files(root)
    assert before.items() <= after.items()
    new = {name.split("/")[2] for name in set(after) - set(before)}
    assert len(new) == 1 and all(name.split("/")[1] == "version=2" for name in set(after) - set(before))
    held = store.latest().held
    assert sorted(held) == list(range(8)) and sorted(held.values()) == [1] * 7 + [2]
    # Nothing changes: no new version, and no files of the attempt.
    assert load("b3", 3, C7="other", C9="N9")["unchanged"] == 2
    assert store.latest().version == 2 and bucket_files(root) == after
    assert not any((root / part).exists() and list((root / part).iterdir()) for part in ("incoming", "decisions"))
    # Earlier versions can be read until they are removed; those in use stay.
    assert {r.company_name for r in store.current(1).where("company_id = 'C7'").collect()} == {"N7"}
    assert store.expire(keep=2) == []
    assert store.expire() == [f"version=1/{new.pop()}"]
    assert store.current().count() == 100 and store.read().count() == 101
    assert {r.company_name for r in store.current().where("company_id in ('C7', 'C9')").collect()} == {"other", "N9"}
    assert load("b4", 4, C7="third", new="x") == {"new_inserts": 1, "updates": 1, "unchanged": 0}
    versions = store.read().where("company_id = 'C7'").orderBy("valid_from").collect()
    assert [v.company_name for v in versions] == ["N7", "other", "third"]
    assert [v.is_current for v in versions] == [False, False, True]
    assert store.read().select("dim_company_sk").distinct().count() == 103


def test_a_load_reads_the_buckets_of_its_companies(spark, tmp_path):
    store = DimensionStore(Warehouse(spark, str(tmp_path / "wh")), buckets=16)
    at = datetime(2024, 1, 1)
    store.apply(names(spark, **{f"C{i}": "x" for i in range(200)}), "b1", batch.moment(at), at)
    read = store._current(store.latest(), [3])
    assert len(read.inputFiles()) == 1 and 0 < read.count() < 40
    # The number of buckets is that of the stored dimension.
    again = DimensionStore(store.warehouse, buckets=4)
    again.apply(names(spark, C1="y"), "b2", batch.moment(at), at)
    assert again.latest().buckets == 16 and again.current().count() == 200
    with pytest.raises(ValueError):
        DimensionStore(store.warehouse, buckets=0)


def csv_source(tmp_path, text):
    path = tmp_path / "t.csv"
    path.write_text(text)
    return RunConfig((Source("complex_csv", "csv", str(path)),))


def test_clean_rerun_clears_the_rejects_and_counts_duplicates(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    header = "company_id,profit,year\n"
    batch.run(spark, csv_source(tmp_path, header + ",1,2023\nC1,2,2023\n"), warehouse, "b1", datetime(2024, 1, 1))
    assert warehouse.read(batch.REJECTS, schemas.REJECT_LOG).count() == 1
    config = csv_source(tmp_path, header + "C1,2,2023\nC1,2,2023\n")
    result = batch.run(spark, config, warehouse, "b1", datetime(2024, 1, 1))
    assert warehouse.read(batch.REJECTS, schemas.REJECT_LOG).count() == 0
    assert result.duplicates == {"complex_csv": 1}


def test_nothing_new_leaves_no_fact_folder(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    config = csv_source(tmp_path, "company_id,profit,year\nC1,2,2023\n")
    assert batch.run(spark, config, warehouse, "b1", datetime(2024, 1, 1), null_safe=True).facts == 1
    assert batch.run(spark, config, warehouse, "b2", datetime(2024, 1, 2), null_safe=True).facts == 0
    assert not (tmp_path / "wh" / batch.FACTS / "batch_id=b2").exists()


def test_run_log_that_fails_neither_stops_nor_hides(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))

    def fail(*args):
        raise RuntimeError("no log")

    monkeypatch.setattr(Warehouse, "log_run", fail)
    assert batch.run(spark, RunConfig(()), warehouse, at=datetime(2024, 1, 1)).status == "SUCCESS"
    monkeypatch.setattr(batch, "load_dimension", lambda *a: (_ for _ in ()).throw(ValueError("the real error")))
    with pytest.raises(ValueError, match="the real error"):
        batch.run(spark, RunConfig(()), warehouse, at=datetime(2024, 1, 1))


def test_errors_are_kept_whole():
    text = "first line\n" + "x" * 5000
    assert batch.error_text(RuntimeError(text)) == text
    assert batch.error_text(RuntimeError()) == "RuntimeError"


def test_missing_company_id_is_an_error(spark):
    from ledgerloom.operators.conform import required, stage_companies
    rows = stage_companies(spark.createDataFrame([("A",)], "company_name string").selectExpr("*", "cast(null as string) as company_id"), "b1")
    assert required(rows, "company_id").count() >= 0
    staged = spark.createDataFrame([("C1",), (None,)], "company_id string")
    with pytest.raises(Exception, match="company_id is NULL"):
        required(staged, "company_id").collect()
