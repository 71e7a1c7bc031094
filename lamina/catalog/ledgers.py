"""Partition bookkeeping over orders by month."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalog.base import query, table
from lamina.operators import ledger


def dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").withColumns(
        {"annee": F.year("o_orderdate"), "mois": F.month("o_orderdate")}
    )


def announced(spark: SparkSession, sf: str) -> DataFrame:
    """What a source would announce: the true count, one more in June, none in November."""
    counted = dated_orders(spark, sf).groupBy("annee", "mois").agg(F.count(F.lit(1)).alias("n"))
    said = F.when(F.col("mois") == 6, F.col("n") + 1).when(F.col("mois") == 11, F.lit(0)).otherwise(F.col("n"))
    return counted.select("annee", "mois", said.cast("bigint").alias("annonces"))


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Months from a quarter before the first order to the last order."""
    bounds = table(spark, sf, "orders").agg(
        F.add_months(F.to_date(F.min("o_orderdate")), -3).alias("a"), F.to_date(F.max("o_orderdate")).alias("z")
    )
    return ledger.expand_months(bounds, F.col("a"), F.col("z"))


def written(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger of the months written so far: those before 2000."""
    done = dated_orders(spark, sf).filter(F.col("o_orderdate") < "2000-01-01")
    return ledger.completeness(done, announced(spark, sf))


LEDGER = """
    with cal as (
        select cast(year(d) as integer) as annee, cast(month(d) as integer) as mois, cast(d as date) as premier_jour,
            last_day(cast(d as date)) as dernier_jour
        from (select unnest(generate_series(date_trunc('month', min(o_orderdate) - interval 3 months),
            date_trunc('month', max(o_orderdate)), interval 1 month)) as d from orders)),
    counted as (select cast(year(o_orderdate) as integer) as annee, cast(month(o_orderdate) as integer) as mois,
        count(*) as n from orders group by all),
    announced as (select annee, mois, case mois when 6 then n + 1 when 11 then 0 else n end as annonces from counted),
    ledger as (select annee, mois, n as rows_written, annonces as rows_announced_by_source, n = annonces as is_complete
        from counted join announced using (annee, mois) where annee < 2000)
"""


@query("month_calendar", LEDGER + "select * from cal")
def month_calendar(spark, sf):
    return calendar(spark, sf)


EVERY_MONTH = LEDGER + """
    , whole as (select annee, mois, n as rows_written, annonces as rows_announced_by_source, n = annonces as is_complete
        from counted join announced using (annee, mois))
"""


def whole_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.completeness(dated_orders(spark, sf), announced(spark, sf))


@query("completeness", EVERY_MONTH + "select * from whole")
def completeness(spark, sf):
    return whole_ledger(spark, sf)


@query(
    "work_list",
    LEDGER + """
    select cal.*, annonces from cal join announced using (annee, mois) where annonces > 0
        and (annee, mois) not in (select (annee, mois) from ledger where is_complete)
    """,
)
def work_list(spark, sf):
    return ledger.work_list(calendar(spark, sf), written(spark, sf), announced(spark, sf))


@query(
    "work_list_capped",
    LEDGER + """
    select annee, mois from cal join announced using (annee, mois) where annonces > 0 order by annee, mois limit 10
    """,
)
def work_list_capped(spark, sf):
    todo = ledger.work_list(calendar(spark, sf), written(spark, sf), announced(spark, sf), force=True, cap=10)
    return todo.select("annee", "mois")


STATUS = LEDGER + """
    , report as (select annee, mois, rows_written, rows_announced_by_source,
        case when is_complete is null then 'absente' when is_complete then 'ok' else 'INCOMPLÈTE' end as etat
        from cal left join ledger using (annee, mois))
"""


@query("status_report", STATUS + "select * from report")
def status_report(spark, sf):
    return ledger.status(calendar(spark, sf), written(spark, sf))


@query(
    "status_totals",
    STATUS + """
    select cast(sum(rows_written) as bigint) as total_local, count(*) filter (where etat = 'absente') as partitions_absentes
    from report
    """,
)
def status_totals(spark, sf):
    return ledger.status_totals(ledger.status(calendar(spark, sf), written(spark, sf)))


@query(
    "load_report",
    EVERY_MONTH + """
    select count(*) as partitions_ecrites, cast(sum(rows_written) as bigint) as total_rows,
        list(printf('annee=%04d/mois=%02d', annee, mois) order by annee, mois) filter (where not is_complete) as incomplete
    from whole
    """,
)
def load_report(spark, sf):
    return ledger.load_report(whole_ledger(spark, sf).withColumn("partition", ledger.partition_name()))


@query(
    "rolling_months",
    """
    with d as (select unnest(generate_series(date_trunc('month', max(o_orderdate)) - interval 3 months,
        date_trunc('month', max(o_orderdate)), interval 1 month)) as d from orders)
    select cast(year(d) as integer) as annee, cast(month(d) as integer) as mois, cast(d as date) as premier_jour,
        last_day(cast(d as date)) as dernier_jour from d
    """,
)
def rolling_months(spark, sf):
    latest = table(spark, sf, "orders").agg(F.to_date(F.max("o_orderdate")).alias("run"))
    return ledger.rolling_months(F.col("run"), latest)


@query(
    "month_slice",
    """
    select o_orderkey, cast(o_orderdate as date) as day from orders
    where o_orderdate >= timestamp '1996-02-01' and o_orderdate < timestamp '1996-03-01'
    """,
)
def month_slice(spark, sf):
    dated = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return ledger.month_slice(dated, "day", 1996, 2)
