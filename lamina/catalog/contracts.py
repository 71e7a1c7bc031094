"""Contract checks over the shared tables: violating rows, summary and freshness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalog.base import query, table
from lamina.operators import checks


def flagged_lines(spark: SparkSession, sf: str) -> DataFrame:
    flag = F.when(F.col("l_partkey") % 50 != 0, F.col("l_returnflag")).alias("flag")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", flag
    )


FLAGGED = """
    with f as (select l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount,
        case when l_partkey % 50 <> 0 then l_returnflag end as flag from lineitem)
"""


@query(
    "check_unique",
    "select l_orderkey, count(*) as n_rows from lineitem group by l_orderkey having count(*) > 1",
)
def unique(spark, sf):
    return checks.check_unique(table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "check_unique_nulls",
    FLAGGED + """
    , g as (select flag || l_orderkey as k from f) select k, count(*) as n_rows from g
    where k is not null group by k having count(*) > 1
    """,
)
def unique_nulls(spark, sf):
    keyed = flagged_lines(spark, sf).select(F.concat("flag", F.col("l_orderkey").cast("string")).alias("k"))
    return checks.check_unique(keyed, "k")


@query(
    "check_unique_combo",
    FLAGGED + """
    , g as (select case when l_orderkey % 2 = 0 then l_orderkey end as k, l_linenumber from f)
    select k, l_linenumber, count(*) as n_rows from g group by all having count(*) > 1
    """,
)
def unique_combo(spark, sf):
    keyed = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 2 == 0, F.col("l_orderkey")).alias("k"), "l_linenumber"
    )
    return checks.check_unique_combo(keyed, ["k", "l_linenumber"])


@query("check_not_null", FLAGGED + "select l_orderkey, l_linenumber, flag from f where flag is null")
def not_null(spark, sf):
    return checks.check_not_null(flagged_lines(spark, sf), "flag").select("l_orderkey", "l_linenumber", "flag")


@query(
    "check_accepted_values",
    FLAGGED + "select l_orderkey, l_linenumber, flag from f where flag not in ('A', 'N')",
)
def accepted_values(spark, sf):
    bad = checks.check_accepted(flagged_lines(spark, sf), "flag", ["A", "N"])
    return bad.select("l_orderkey", "l_linenumber", "flag")


@query(
    "check_relationship",
    """
    select l_orderkey, count(*) as n_rows from lineitem
    where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P') group by l_orderkey
    """,
)
def relationship(spark, sf):
    open_orders = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    return checks.check_relationship(table(spark, sf, "lineitem"), open_orders, "l_orderkey", "o_orderkey")


@query(
    "check_accepted_range",
    "select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity not between 2 and 49",
)
def accepted_range(spark, sf):
    bad = checks.check_range(table(spark, sf, "lineitem"), "l_quantity", 2, 49)
    return bad.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "check_expression",
    FLAGGED + """
    select l_orderkey, l_linenumber, flag, l_extendedprice from f
    where l_quantity >= 40 and flag = 'A' and l_extendedprice > 50000
    """,
)
def expression(spark, sf):
    bad = checks.check_expr(
        flagged_lines(spark, sf), "not (flag = 'A' and l_extendedprice > 50000)", "l_quantity >= 40"
    )
    return bad.select("l_orderkey", "l_linenumber", "flag", "l_extendedprice")


@query(
    "check_freshness",
    """
    with a as (select max(ts) as newest, timestamp '2024-02-20 00:00:00' as now from events),
    b as (select (floor(epoch(now)) - floor(epoch(newest))) / 86400.0 as age from a)
    select 'freshness' as "check", 'events' as table_name, 'ts' as column_name,
        case when age > 30 then 'error' when age > 14 then 'warn' else 'error' end as severity,
        cast(age > 14 as bigint) as violations,
        case when age > 30 then 'error' when age > 14 then 'warn' else 'pass' end as status from b
    """,
)
def freshness(spark, sf):
    return checks.check_freshness(table(spark, sf, "events"), "ts", "events", dt.datetime(2024, 2, 20))


@query(
    "checks_summary",
    FLAGGED + """
    , c("check", table_name, column_name, severity, violations) as (
        select 'unique', 'lineitem', 'l_orderkey', 'warn', count(*) from
            (select l_orderkey from lineitem group by l_orderkey having count(*) > 1)
        union all select 'unique', 'orders', 'o_orderkey', 'error', count(*) from
            (select o_orderkey from orders group by o_orderkey having count(*) > 1)
        union all select 'unique_combination_of_columns', 'lineitem', 'l_orderkey,l_linenumber', 'warn', count(*) from
            (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
        union all select 'relationships', 'lineitem', 'l_orderkey', 'error', count(*) from lineitem
            where l_orderkey not in (select o_orderkey from orders)
        union all select 'not_null', 'lineitem', 'flag', 'error', count(*) from f where flag is null
        union all select 'not_null', 'orders', 'o_custkey', 'error', count(*) from orders where o_custkey is null
        union all select 'accepted_values', 'lineitem', 'flag', 'warn', count(*) from f where flag not in ('A', 'N')
        union all select 'accepted_range', 'lineitem', 'l_quantity', 'error', count(*) from f
            where l_quantity not between 0 and 50
        union all select 'accepted_range', 'lineitem', 'l_discount', 'error', count(*) from f where l_discount > 0.05
        union all select 'expression_is_true', 'lineitem', 'not (flag = ''A'' and l_extendedprice > 50000)', 'error',
            count(*) from f where l_quantity >= 40 and flag = 'A' and l_extendedprice > 50000)
    select *, case when violations = 0 then 'pass' else severity end as status from c
    """,
)
def summary(spark, sf):
    lines, orders = flagged_lines(spark, sf), table(spark, sf, "orders")
    keys = orders.select(F.col("o_orderkey").alias("l_orderkey"))
    contracts = [
        checks.unique("lineitem", lines, "l_orderkey", checks.WARN),
        checks.unique("orders", orders, "o_orderkey"),
        checks.unique_combo("lineitem", lines, ["l_orderkey", "l_linenumber"], checks.WARN),
        checks.relationship("lineitem", lines, keys, "l_orderkey"),
        checks.not_null("lineitem", "flag"),
        checks.not_null("orders", "o_custkey"),
        checks.accepted("lineitem", "flag", ["A", "N"], checks.WARN),
        checks.in_range("lineitem", "l_quantity", 0, 50),
        checks.in_range("lineitem", "l_discount", None, 0.05),
        checks.is_true("lineitem", "not (flag = 'A' and l_extendedprice > 50000)", "l_quantity >= 40"),
    ]
    return checks.run_checks({"lineitem": lines, "orders": orders}, contracts)


@query(
    "key_contracts",
    """
    with c("check", table_name, column_name, severity, violations) as (
        select 'unique', 'lineitem', 'l_partkey', 'warn', count(*) from
            (select l_partkey from lineitem group by l_partkey having count(*) > 1)
        union all select 'unique_combination_of_columns', 'lineitem', 'l_orderkey,l_linenumber', 'error', count(*) from
            (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
        union all select 'relationships', 'lineitem', 'l_orderkey', 'error', count(*) from lineitem
            where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')
        union all select 'relationships', 'lineitem', 'l_suppkey', 'error', count(*) from lineitem
            where l_suppkey not in (select s_suppkey from supplier)
        union all select 'unique', 'orders', 'o_custkey', 'warn', count(*) from
            (select o_custkey from orders where o_orderstatus <> 'P' group by o_custkey having count(*) > 1)
        union all select 'relationships', 'orders', 'o_custkey', 'error', count(*) from orders
            where o_orderstatus <> 'P' and o_custkey not in (select c_custkey from customer))
    select *, case when violations = 0 then 'pass' else severity end as status from c
    """,
)
def key_contracts(spark, sf):
    """Keys and references of three tables: a scan of each, whatever the number of contracts."""
    lines, customers, suppliers = (table(spark, sf, n) for n in ("lineitem", "customer", "supplier"))
    orders = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    contracts = [
        checks.unique("lineitem", lines, "l_partkey", checks.WARN),
        checks.unique_combo("lineitem", lines, ["l_orderkey", "l_linenumber"]),
        checks.relationship("lineitem", lines, orders, "l_orderkey", parent_key="o_orderkey"),
        checks.relationship("lineitem", lines, suppliers, "l_suppkey", parent_key="s_suppkey"),
        checks.unique("orders", orders, "o_custkey", checks.WARN),
        checks.relationship("orders", orders, customers, "o_custkey", parent_key="c_custkey"),
    ]
    return checks.run_checks({"lineitem": lines, "orders": orders}, contracts)
