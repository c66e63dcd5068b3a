import datetime as dt

import pytest

from larder.operators import quality as q
from larder.operators import staging


@pytest.fixture(scope="module")
def tables(spark):
    products = spark.createDataFrame(
        [("s1", 1.0, "A"), ("s2", -1.0, "B"), ("s2", None, "Z"), (None, 2.0, None)],
        "sku string, unit_cost double, abc_class string",
    )
    sales = spark.createDataFrame(
        [("s1", 5), ("s9", 1), ("s9", 2), (None, 3)], "sku string, units_sold int"
    )
    return {"products": products, "sales": sales, "carriers": None}


def results(tables, *rules):
    rows = q.run_rules(tables, rules).where("check <> 'exists'").collect()
    return {(r.table, r.check): (r.passed, r.bad_rows) for r in rows}


def test_rule_kinds(tables):
    got = results(
        tables,
        q.min_rows("products", 4),
        q.min_rows("sales", 5),
        q.nulls("products", "unit_cost", 0.25),
        q.nulls("products", "sku"),
        q.unique("products", "sku"),
        q.in_range("products", "unit_cost", low=0, high=1.5),
        q.in_range("sales", "units_sold", low=0),
        q.accepted("products", "abc_class", ("A", "B")),
        q.references("sales", "sku", "products", "sku"),
        q.satisfies("sales", "small", "units_sold < 5"),
    )
    assert got == {
        ("products", "min_rows"): (True, 0),
        ("sales", "min_rows"): (False, 0),
        ("products", "nulls:unit_cost"): (True, 1),
        ("products", "nulls:sku"): (False, 1),
        ("products", "unique:sku"): (False, 2),
        ("products", "range:unit_cost"): (False, 2),
        ("sales", "range:units_sold"): (True, 0),
        ("products", "accepted:abc_class"): (False, 1),
        ("sales", "foreign_key:sku"): (False, 2),
        ("sales", "expression:small"): (False, 1),
    }


def test_absent_tables_are_reported(tables):
    rows = q.run_rules(tables, (q.unique("carriers", "id"),)).collect()
    assert {(r.table, r.passed) for r in rows} == {
        ("products", True), ("sales", True), ("carriers", False),
    }
    summary = q.rule_summary(q.run_rules(tables, ())).first()
    assert (summary.passed, summary.failed, summary.all_passed) == (2, 1, False)


def test_rules_of_a_table_share_one_scan(tables):
    rules = [q.nulls("products", c) for c in ("sku", "unit_cost", "abc_class")]
    plan = q._table_results("products", tables["products"], rules)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") == 1


def test_empty_table_has_no_null_share(spark):
    empty = spark.createDataFrame([], "x int")
    got = results({"t": empty}, q.nulls("t", "x"))
    assert got == {("t", "nulls:x"): (True, 0)}
    assert q.profile(empty).count() == 0


@pytest.mark.parametrize("exact", [True, False])
def test_profile(tables, exact):
    rows = {r.column: r for r in q.profile(tables["products"], exact).collect()}
    assert (rows["sku"].null_count, rows["sku"].null_pct, rows["sku"].unique_count) == (1, 25.0, 2)
    assert rows["unit_cost"].type == "double"


def test_completeness(spark):
    df = spark.createDataFrame([(1, 3), (None, None)], "a int, b int")
    assert q.completeness(df).first().completeness == 0.5


def test_duplicates_keep_every_copy(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "id int, v string")
    assert sorted(r.v for r in q.duplicated_rows(df, ["id"]).collect()) == ["b", "c"]
    row = q.duplicate_share(df, ["id"]).first()
    assert (row.total_rows, row.surplus_rows, row.within_limit) == (4, 1, False)


def test_deduplication_is_repeatable(spark):
    rows = [(i % 3, i % 7, f"v{i}") for i in range(60)]
    picks = {
        tuple(sorted(map(tuple, q.deduplicate(
            spark.createDataFrame(rows, "k int, o int, v string").repartition(n), ["k"], ["o"]
        ).collect())))
        for n in (1, 5)
    }
    assert picks == {((0, 0, "v0"), (1, 0, "v28"), (2, 0, "v14"))}


def test_severity_and_samples(spark):
    df = spark.createDataFrame([(i, None if i < 2 else i) for i in range(10)], "id int, x int")
    row = q.issue_summary({"t": df}).first()
    assert (row["column"], row.null_pct, row.severity) == ("x", 20.0, "HIGH")
    assert [r.id for r in q.null_samples(df, "x", ["id"], 1).collect()] == [0]


def test_order_status(spark):
    d = dt.date
    rows = [
        (1, d(2024, 1, 1), d(2024, 1, 31), d(2024, 2, 2)),
        (2, d(2024, 1, 1), d(2024, 1, 31), None),
        (3, d(2025, 1, 1), d(2025, 1, 31), None),
    ]
    df = spark.createDataFrame(
        rows, "po_id int, order_date date, expected_date date, actual_date date"
    )
    got = [(r.status, r.delay_days) for r in
           staging.with_order_status(df, "2024-06-01").orderBy("po_id").collect()]
    assert got == [("DELIVERED", 2), ("IN_TRANSIT", None), ("PLANNED", None)]


def test_reliability_tiers(spark):
    scores = [0.95, 0.85, 0.70, 0.1, None]
    df = spark.createDataFrame([(s,) for s in scores], "reliability_score double")
    got = [r.reliability_tier for r in staging.stage_suppliers(df).collect()]
    assert got == ["Excellent", "Good", "Fair", "Poor", "Poor"]
