"""Key contracts of several tables in one pass, against the single checks."""

import pytest
from pyspark.sql import functions as F

from lamina.operators import checks


def verdicts(summary):
    return {(r["check"], r["table_name"], r["column_name"]): (r["violations"], r["status"]) for r in summary.collect()}


@pytest.fixture(scope="module")
def tables(spark):
    child = [(1, 1, "a"), (1, 2, "a"), (2, 3, None), (None, 3, "b"), (None, 3, "b"), (7, 9, "c")] + [(8, i, "hot") for i in range(50)]
    return {
        "child": spark.createDataFrame(child, "k int, n int, t string"),
        "parent": spark.createDataFrame([(1, "a"), (2, "b"), (None, "x"), (2, "b")], "id long, name string"),
    }


def test_every_key_contract_as_the_checks_say(tables):
    child, parent = tables["child"], tables["parent"]
    got = verdicts(checks.run_checks(tables, [
        checks.unique("child", child, "k", checks.WARN),
        checks.unique("child", child, "n"),
        checks.unique_combo("child", child, ["n", "t"]),
        checks.unique_combo("child", child, ["k"]),
        checks.relationship("child", child, parent, "k", parent_key="id"),
        checks.relationship("child", child, parent, "t", checks.WARN, parent_key="name"),
        checks.unique("parent", parent, "id"),
        checks.unique("parent", parent, "name", checks.WARN),
        checks.not_null("parent", "id"),
    ]))
    single = {
        ("unique", "child", "k"): checks.check_unique(child, "k").count(),
        ("unique", "child", "n"): checks.check_unique(child, "n").count(),
        ("unique_combination_of_columns", "child", "n,t"): checks.check_unique_combo(child, ["n", "t"]).count(),
        ("unique_combination_of_columns", "child", "k"): checks.check_unique_combo(child, ["k"]).count(),
        ("relationships", "child", "k"): checks.check_relationship(child, parent, "k", "id").agg(F.sum("n_rows")).first()[0],
        ("relationships", "child", "t"): checks.check_relationship(child, parent, "t", "name").agg(F.sum("n_rows")).first()[0],
        ("unique", "parent", "id"): 1,
        ("unique", "parent", "name"): 1,
        ("not_null", "parent", "id"): 1,
    }
    assert {k: v for k, (v, _) in got.items()} == single
    assert single[("relationships", "child", "k")] == 51 and single[("relationships", "child", "t")] == 51
    assert got[("unique", "child", "k")][1] == "warn" and got[("relationships", "child", "k")][1] == "error"


def test_empty_tables_hold(spark, tables):
    none = {n: df.limit(0) for n, df in tables.items()}
    contracts = [checks.unique("child", none["child"], "k"), checks.relationship("child", none["child"], none["parent"], "k", parent_key="id")]
    assert {v for v, _ in verdicts(checks.run_checks(none, contracts)).values()} == {0}
    lost = checks.relationship("child", tables["child"], none["parent"], "k", parent_key="id")
    assert verdicts(checks.run_checks(tables, [lost])) == {("relationships", "child", "k"): (54, "error")}


def test_at_most_two_scans_a_table(spark):
    lines, orders = (spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("lineitem", "orders"))
    summary = checks.run_checks({"l": lines, "o": orders}, [
        checks.unique("l", lines, "l_orderkey"), checks.unique_combo("l", lines, ["l_orderkey", "l_linenumber"]),
        checks.unique("l", lines, "l_partkey"), checks.relationship("l", lines, orders, "l_orderkey", parent_key="o_orderkey"),
        checks.unique("o", orders, "o_orderkey"), checks.relationship("o", orders, lines, "o_orderkey", parent_key="l_orderkey"),
        checks.not_null("l", "l_tax"), checks.not_null("o", "o_custkey"), checks.in_range("l", "l_quantity", 0, 50),
    ])
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 2 and plan.count("orders.parquet") == 2
    assert plan.count("Join") == 0 and plan.count("Expand") == 2


def test_keys_move_once(spark, tables):
    """Uniqueness and references of two tables: one shuffle by key, in which both tables' keys meet."""
    child, parent = tables["child"], tables["parent"]
    summary = checks.run_checks(tables, [
        checks.unique("child", child, "k", checks.WARN),
        checks.unique_combo("child", child, ["k", "n"]),
        checks.relationship("child", child, child.select(F.col("n").alias("k")), "k"),
        checks.relationship("child", child, parent, "k", parent_key="id"),
        checks.unique("parent", parent, "id"),
    ])
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert [r["violations"] for r in summary.collect()] == [2, 1, 0, 51, 1]
