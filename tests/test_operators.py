import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import DEFAULT_RATES, DEFAULT_RULES, MappingRule, collect_rules, read_rules, rules_by_field
from ledgerloom.operators import conform, facts, keys, mapping, quality, scd2
from ledgerloom.plans import dates, views
from ledgerloom.plans.shapes import shape
from ledgerloom.schemas import STAGED_FINANCIALS


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


def moment(text):
    return F.lit(text).cast("timestamp")


# Mapping


def test_direct_integers(spark):
    df = spark.createDataFrame([("12.7",), ("20x3",), (" 7 ",), ("",), (None,), ("-3",)], "v string")
    got = mapping.apply_rules(df, [MappingRule("v", "n", "direct", "int")], {})
    assert column(got, "n") == [12, None, 7, None, None, -3]
    assert got.columns == ["v", "n"]


def test_split_comma(spark):
    df = spark.createDataFrame([("692,extra",), ("12.75",), ("-5",), (" 7",), (None,)], "v string")
    got = mapping.apply_rules(df, [MappingRule("v", "v", "split_comma", "numeric")], {})
    assert column(got, "v") == [692.0, 12.0, None, None, None]


def test_currency(spark):
    df = spark.createDataFrame(
        [("100", "EUR"), ("100", "eur"), ("100", "JPY"), ("100", None), ("x", "EUR"), ("10.555", "USD")],
        "revenue string, currency string",
    )
    rule = [MappingRule("revenue", "usd", "currency_convert", "numeric")]
    want = [108.0, 108.0, 100.0, 100.0, None, 10.56]
    assert column(mapping.apply_rules(df, rule, DEFAULT_RATES), "usd") == want
    assert column(mapping.apply_rules(df, rule, {"eur": 2.0}), "usd")[0] == 100.0
    assert column(mapping.apply_rules(df, rule, {}), "usd")[0] == 100.0
    bare = mapping.apply_rules(df.drop("currency"), rule, DEFAULT_RATES)
    assert column(bare, "usd")[-1] == 10.555
    table = spark.createDataFrame(list(DEFAULT_RATES.items()), "currency string, rate double")
    joined = mapping.convert_with_rate_table(df, table, target="usd")
    assert rows(joined, "usd") == sorted(((v,) for v in want), key=str)


def test_rules_are_applied_in_order(spark):
    df = spark.createDataFrame([("a", "current")], "name string, p string")
    rules = [
        MappingRule("name", "loud", "upper", "varchar"),
        MappingRule("loud", "copy", "no_such", "varchar"),
        MappingRule("p", "first", "upper", "varchar"),
        MappingRule("p", "period", "map_cy_py", "varchar"),
        MappingRule("absent", "x", "direct", "int"),
    ]
    got = mapping.apply_rules(df, rules, {}).first().asDict()
    assert got == {"name": "a", "p": "current", "loud": "A", "copy": "A", "period": "CY"}
    assert list(rules_by_field(rules)) == ["name", "loud", "p", "absent"]


def test_own_transformation(spark):
    df = spark.createDataFrame([("a",)], "v string")
    twice = {**mapping.TRANSFORMATIONS, "twice": lambda d, s, r, x: F.concat(F.col(s), F.col(s))}
    got = mapping.apply_rules(df, [MappingRule("v", "w", "twice", "varchar")], {}, transformations=twice)
    assert got.first()["w"] == "aa"


def test_rule_table(spark, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text("source_field,target_column,transformation,datatype\n" + "".join(
        f"{r.source_field},{r.target_column},{r.transformation},{r.datatype}\n" for r in DEFAULT_RULES
    ))
    assert collect_rules(read_rules(spark, str(path))) == DEFAULT_RULES


def test_shapes(spark):
    csv = spark.createDataFrame(
        [("C1", "692,extra", "2023", "r", 0)],
        "company_id string, profit string, year string, remarks string, table_index int",
    )
    got = shape(csv, "complex_csv", DEFAULT_RULES, DEFAULT_RATES)
    assert got.columns == ["company_id", "profit", "year"] and got.first()["profit"] == 692.0
    companies = spark.createDataFrame(
        [("C1", "Acme", "5", "2023")], "company_id string, company_name string, revenue string, year string"
    )
    got = shape(companies, "hierarchical_xml", DEFAULT_RULES, DEFAULT_RATES).first().asDict()
    assert got == {"company_id": "C1", "company_name": "ACME", "revenue": 5.0, "year": 2023, "revenue_usd": 5.0}
    assert shape(csv, "unheard_of", DEFAULT_RULES, DEFAULT_RATES).columns == csv.columns
    same = shape(csv, "complex_csv", DEFAULT_RULES, DEFAULT_RATES, rules_everywhere=True)
    assert same.select("company_id", "profit").first() == ("C1", 692.0)


# Quality


DIRTY = [
    (None, "2023", "1"), ("  ", "20x3", "1"), ("C1", "20X3", "1"), ("C2", " 2023", "1"),
    ("C3", None, "-5"), ("C4", " ", "x"), ("C5", "2023", "5,extra"),
]


def dirty(spark):
    return spark.createDataFrame(DIRTY, "company_id string, year string, profit string")


def test_validate(spark):
    valid, rejected = quality.validate(dirty(spark))
    assert rows(valid, "company_id") == [("C3",), ("C4",), ("C5",)]
    assert valid.columns == ["company_id", "year", "profit"]
    assert rows(rejected, quality.REASON) == sorted([
        ("MISSING_COMPANY_ID; ",), ("MISSING_COMPANY_ID; INVALID_YEAR(20x3); ",),
        ("INVALID_YEAR(20X3); ",), ("INVALID_YEAR( 2023); ",),
    ])
    assert set(column(rejected, quality.STATUS)) == {"REJECTED"}


def test_reported_codes_limit_the_text_only(spark):
    _, rejected = quality.validate(dirty(spark), reported=["MISSING_COMPANY_ID"])
    assert rejected.count() == 4
    assert rows(rejected, quality.REASON)[-1] == ("MISSING_COMPANY_ID; ",)


def test_report_counts_the_first_failing_rule(spark):
    assert quality.quality_report(dirty(spark)).first().asDict() == {
        "total_input": 7, "total_passed": 3, "total_rejected": 4,
        "MISSING_COMPANY_ID": 2, "INVALID_YEAR": 2, "INVALID_PROFIT": 2,
    }


def test_rules_without_their_column_do_not_apply(spark):
    valid, rejected = quality.validate(dirty(spark).drop("year", "company_id"))
    assert valid.count() == 7 and rejected.count() == 0
    assert quality.quality_report(dirty(spark).select("profit")).columns == [
        "total_input", "total_passed", "total_rejected", "INVALID_PROFIT"]


def test_reject_log(spark):
    _, rejected = quality.validate(dirty(spark))
    log = quality.reject_log(rejected, "src", "b1", moment("2024-01-01"))
    assert rows(log, "record_data")[-1] == ('{"year":"2023","profit":"1"}',)
    assert rows(log.select("source_file", "severity", "batch_id").distinct()) == [("src", "ERROR", "b1")]
    assert quality.code_counts(log).first().asDict() == {"missing_company_id": 2, "invalid_year": 3}


def test_remove_duplicates(spark):
    df = spark.createDataFrame(
        [("a", None, 2), ("a", None, 1), ("a", "x", 3), (None, None, 4), (None, None, None)],
        "k string, y string, v int",
    )
    assert rows(quality.remove_duplicates(df, ["k", "y"])) == sorted(
        [("a", None, 1), ("a", "x", 3), (None, None, 4)], key=str)
    assert quality.remove_duplicates(df, ["nope"]).count() == 5
    plan = quality.remove_duplicates(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once per task before the shuffle, once after


# Conform


def test_conform(spark):
    df = spark.createDataFrame([("C1", "12.345", "20x3")], "company_id string, revenue string, year string")
    got = conform.stage_financials(df, "b1", moment("2024-01-01"))
    assert [f.dataType for f in got.schema] == [f.dataType for f in STAGED_FINANCIALS]
    assert got.columns == STAGED_FINANCIALS.names
    row = got.first()
    assert (str(row.revenue), row.year, row.source_file, row.batch_id) == ("12.35", None, "unknown", "b1")


def test_amounts_that_do_not_fit_stop_the_load(spark):
    df = spark.createDataFrame([("C1", "1e17")], "company_id string, revenue string")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range|cannot be represented"):
        conform.stage_financials(df, "b1").collect()


def test_stage_companies(spark):
    df = spark.createDataFrame(
        [("C1", None, "b"), ("C1", "A", "c"), (None, "X", "a")],
        "company_id string, company_name string, source_file string",
    )
    assert rows(conform.stage_companies(df, "b1").select("company_id", "company_name", "source_file")) == [
        ("C1", "A", "c")]
    assert conform.stage_companies(df.select("source_file"), "b1") is None


def test_stack_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    assert rows(conform.stack([a, b])) == sorted([(1, None), (None, 2)], key=str)


# Keys and dimension


def test_keys_are_dense_and_repeatable(spark):
    ids = spark.range(5000).select(F.concat(F.lit("C"), "id").alias("company_id"))
    keyed = keys.assign_keys(ids, "company_id", "sk", taken=10)
    assert sorted(column(keyed, "sk")) == list(range(11, 5011))
    again = keys.assign_keys(ids.repartition(13), "company_id", "sk", taken=10)
    assert keyed.exceptAll(again).count() == 0
    assert sorted(column(keys.assign_keys(ids, "company_id", "sk"), "sk"))[0] == 1
    used = spark.createDataFrame([(7,), (3,)], "sk bigint")
    assert min(column(keys.assign_keys(ids, "company_id", "sk", taken=used), "sk")) == 8
    assert min(column(keys.assign_keys(ids, "company_id", "sk", taken=used.where("sk > 9")), "sk")) == 1


def step(stored, batch, now):
    """The dimension as a plain list: dicts without keys."""
    current = {v["id"]: v for v in stored if v["open"]}
    for company, name in batch.items():
        old = current.get(company)
        if old is not None and (name is None or name == old["name"]):
            continue
        if old is not None:
            old.update(open=False, end=now)
        stored.append({"id": company, "name": name, "start": now, "end": scd2.OPEN_END, "open": True})


def test_random_batches_against_plain_rules(spark):
    rnd = random.Random(3)
    empty = spark.createDataFrame([], scd2.COMPANY_DIMENSION)
    stored, dimension = [], empty
    for day in range(1, 4):
        batch = {
            f"C{i}": rnd.choice([None, "A", "B", "C"]) for i in rnd.sample(range(12), rnd.randint(3, 9))
        }
        now = f"2024-01-0{day} 00:00:00"
        step(stored, batch, now)
        incoming = spark.createDataFrame(
            [*batch.items(), (None, "X")], "company_id string, company_name string"
        )
        result = scd2.apply_scd2(dimension, incoming, moment(now)).collect()
        dimension = spark.createDataFrame(result, scd2.COMPANY_DIMENSION)
        shown = dimension.select(
            "company_id", "company_name", F.col("valid_from").cast("string"),
            F.col("valid_to").cast("string"), "is_current",
        )
        assert rows(shown) == sorted(
            ((v["id"], v["name"], v["start"], v["end"], v["open"]) for v in stored), key=str)
        assert sorted(column(dimension, "dim_company_sk")) == list(range(1, len(stored) + 1))
    replay = scd2.stats(scd2.classify(scd2.current(dimension), incoming)).first()
    assert (replay.new_inserts, replay.updates, replay.unchanged) == (0, 0, len(batch))


def test_stored_null_name_is_replaced(spark):
    dimension = scd2.apply_scd2(
        spark.createDataFrame([], scd2.COMPANY_DIMENSION),
        spark.createDataFrame([("C1", None)], "company_id string, company_name string"),
        moment("2024-01-01"),
    )
    named = spark.createDataFrame([("C1", "A")], "company_id string, company_name string")
    assert scd2.stats(scd2.classify(scd2.current(dimension), named)).first().updates == 1


def test_earlier_source_wins(spark):
    def frame(*pairs):
        return spark.createDataFrame(pairs, "company_id string, company_name string")

    got = scd2.company_input([frame(("C1", "Z"), (None, "N")), frame(("C1", "A"), ("C2", "B"))])
    assert rows(got) == [("C1", "Z"), ("C2", "B")]


def test_as_of_is_half_open(spark):
    dimension = spark.createDataFrame(
        [(1, "C1", "Old", "2024-01-01", "2024-02-01", False), (2, "C1", "New", "2024-02-01", "9999-12-31", True)],
        "dim_company_sk bigint, company_id string, company_name string, valid_from string, valid_to string, is_current boolean",
    ).withColumns({c: F.col(c).cast("timestamp") for c in ("valid_from", "valid_to")})
    events = spark.createDataFrame(
        [("C1", d) for d in ("2023-12-31", "2024-01-01", "2024-01-31", "2024-02-01")] + [("C9", "2024-01-01")],
        "company_id string, day string",
    )
    got = scd2.as_of(events, dimension, "day")
    assert rows(got, "company_id", "day", "name_at_time") == sorted([
        ("C1", "2023-12-31", None), ("C1", "2024-01-01", "Old"), ("C1", "2024-01-31", "Old"),
        ("C1", "2024-02-01", "New"), ("C9", "2024-01-01", None)], key=str)
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


# Facts


KEYED = "company_id string, period_type string, source_file string, n int"


def keyed(spark, *items):
    return spark.createDataFrame([(*k, i) for i, k in enumerate(items)], KEYED)


@pytest.mark.parametrize("scope", [None, "source_file"])
def test_incremental(spark, scope):
    new = keyed(spark, ("a", "CY", "f"), ("a", None, "f"), ("b", "CY", "f"), ("c", None, None))
    old = keyed(spark, ("a", "CY", "f"), ("a", "CY", "f"), ("a", None, "f"), ("c", None, None))
    assert sorted(column(facts.incremental(new, old, scope=scope), "n")) == [1, 2, 3]
    safe = facts.incremental(new, old, null_safe=True, scope=scope)
    assert column(safe, "n") == [2]
    assert "NestedLoop" not in safe._jdf.queryExecution().executedPlan().toString()


def test_resolution(spark):
    staged = spark.createDataFrame([("a",), ("b",), ("a",)], "company_id string")
    stored = spark.createDataFrame([("a", 5)], "company_id string, dim_company_sk bigint")
    got = facts.project_fact(facts.resolve_keys(staged, stored), "b1")
    assert facts.resolution_counts(got).first().asDict() == {"total": 3, "resolved": 2, "unresolved": 1}


# Views and dates


def warehouse(spark):
    dimension = spark.createDataFrame(
        [(1, "A", "Ann", True), (2, "B", "Bob", False), (3, "B", "Bobby", True), (4, "D", "Dee", True)],
        "dim_company_sk bigint, company_id string, company_name string, is_current boolean",
    )
    items = [
        (1, "A", "CY", 2024, 150.0, "f"), (1, "A", "CY", 2024, 90.0, "f"), (1, "A", "PY", 2023, 100.0, "f"),
        (1, "A", "PY", 2023, 80.0, "f"), (1, "A", "CY", 2024, 5.0, "g"), (1, "A", "PY", 2023, 0.0, "h"),
        (2, "B", "CY", 2024, 7.0, "f"), (3, "B", "PY", 2023, 7.0, "f"), (None, "Z", "CY", 2024, 7.0, "f"),
    ]
    rows_ = [(*i, i[4], None, None, None) for i in items]
    schema = (
        "dim_company_sk bigint, company_id string, period_type string, year int, revenue_usd double, "
        "source_file string, revenue double, profit double, currency string, load_timestamp timestamp"
    )
    return spark.createDataFrame(rows_, schema), dimension


def test_summary(spark):
    facts_, dimension = warehouse(spark)
    assert views.company_summary(facts_, dimension).count() == 7
    assert views.company_summary(facts_, dimension, by="business_key").count() == 8
    with pytest.raises(ValueError):
        views.company_summary(facts_, dimension, by="name")


def test_revenue_comparison(spark):
    facts_, dimension = warehouse(spark)
    got = views.revenue_comparison(facts_, dimension)
    assert rows(got, "company_id", "cy_revenue_usd", "py_revenue_usd", "revenue_growth_pct", "cy_year") == sorted([
        ("A", 150.0, 100.0, 50.0, 2024), ("A", 150.0, 80.0, 87.5, 2024),
        ("A", 90.0, 100.0, -10.0, 2024), ("A", 90.0, 80.0, 12.5, 2024),
        ("A", 5.0, None, None, 2024), ("B", None, None, None, None), ("D", None, None, None, None),
    ], key=str)


def test_growth_needs_a_positive_previous_year(spark):
    facts_, dimension = warehouse(spark)
    zero = facts_.where("source_file = 'h'").withColumn("period_type", F.lit("CY")).unionByName(
        facts_.where("source_file = 'h'"))
    assert column(views.revenue_comparison(zero, dimension.where("company_id = 'A'")), "revenue_growth_pct") == [None]


def test_views_by_name(spark):
    facts_, dimension = warehouse(spark)
    stamped = dimension.withColumns({c: moment("2024-01-01") for c in ("valid_from", "valid_to", "updated_at")})
    views.register_views(facts_, stamped)
    assert spark.sql("select count(*) from v_company_financials_summary").first()[0] == 7
    labels = spark.sql("select record_status, count(*) from v_company_history group by 1")
    assert rows(labels) == [("Active", 3), ("Historical", 1)]
    assert spark.sql("select count(*) from v_revenue_comparison").first()[0] == 7


def test_dates(spark):
    days = dates.date_dimension(spark)
    assert days.count() == 2557 and days.where("is_weekend").count() == 730
    first = days.orderBy("full_date").first()
    assert (first.dim_date_sk, first.day_of_week, first.month_name) == (1, 2, "January  ")


def test_a_thousand_rules_are_planned_at_once(spark):
    import time

    rules = [MappingRule("a", "a", "direct", "int")] + [
        MappingRule(f"c{i}", f"t{i}", "upper", "varchar") for i in range(1000)]
    df = spark.range(1).selectExpr("id as a", *(f"'x{i}' as c{i}" for i in range(1000)))
    began = time.perf_counter()
    mapped = mapping.apply_rules(df, rules, {})
    assert time.perf_counter() - began < 5
    assert mapped.first()["t999"] == "X999"


def test_rules_see_what_earlier_rules_wrote(spark):
    df = spark.createDataFrame([("5,x", "eur", "q")], "profit string, code string, other string")
    rules = [
        MappingRule("code", "currency", "upper", "varchar"), MappingRule("profit", "amount", "split_comma", "numeric"),
        MappingRule("amount", "usd", "currency_convert", "numeric"), MappingRule("other", "amount", "direct", "varchar")]
    row = mapping.apply_rules(df, rules, {"EUR": 2.0}).first()
    assert (row.currency, row.usd, row.amount) == ("EUR", 10.0, "q")


def test_key_prefix_length_changes_no_key(spark):
    df = spark.range(500).selectExpr("cast(id as string) as id")
    found = [sorted(map(tuple, keys.assign_keys(df, "id", "sk", prefix_length=n).collect())) for n in (1, 3, 4)]
    assert found[0] == found[1] == found[2]
    with pytest.raises(ValueError):
        keys.assign_keys(df, "id", "sk", prefix_length=5)
