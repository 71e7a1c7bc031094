"""Marts, roll-ups and analytical questions over orders, customers and line items."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalog.base import plain, query, sql_rate, sql_round, table
from lamina.functions.bands import band, display_rank
from lamina.functions.codes import name_or_unknown
from lamina.functions.measures import ratio
from lamina.operators import analysis
from lamina.operators.marts import Summary, label_flags, rollup_rate, summarise, top_k, with_rates
from lamina.operators.quantiles import exact_quantiles, fenced_quantiles

CLASSES = ["1", "2", "3", "4", "5"]


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the place of their customer; every measure is null here and there."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    k = F.col("o_orderkey")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey",
        F.when(F.col("c_custkey") % 40 != 0, F.col("c_nationkey")).alias("place"),
        F.year("o_orderdate").alias("annee"),
        F.substring("o_orderpriority", 1, 1).alias("class"),
        F.col("o_orderstatus").alias("status"),
        F.col("c_mktsegment").alias("segment"),
        F.when(k % 10 != 0, F.col("o_totalprice") / 100).alias("use"),
        F.when(k % 15 != 0, F.lit(20) + k % 130).alias("size"),
        F.when(k % 12 != 0, F.col("o_totalprice") / 50).alias("cost"),
    )


FACTS = """
    with f as (select o_orderkey, case when c_custkey % 40 <> 0 then c_nationkey end as place,
        cast(year(o_orderdate) as integer) as annee, o_orderpriority[1] as class, o_orderstatus as status,
        c_mktsegment as segment,
        case when o_orderkey % 10 <> 0 then o_totalprice / 100 end as use,
        case when o_orderkey % 15 <> 0 then 20 + o_orderkey % 130 end as size,
        case when o_orderkey % 12 <> 0 then o_totalprice / 50 end as cost
        from orders join customer on o_custkey = c_custkey)
"""

FLAGS_SQL = """
    count(*) as nb_dpe, count(*) filter (where class in ('1', '2')) as nb_urgent,
    count(*) filter (where status = 'F') as nb_done,
    count(*) filter (where class = '1') as nb_class_1, count(*) filter (where class = '2') as nb_class_2,
    count(*) filter (where class = '3') as nb_class_3, count(*) filter (where class = '4') as nb_class_4,
    count(*) filter (where class = '5') as nb_class_5
"""
MEANS_SQL = f"""
    {sql_round('avg(use)', 1)} as use_mean, {sql_round('avg(size)', 1)} as size_mean, {sql_round('avg(cost)', 0)} as cost_mean
"""
MEDIAN_SQL = f"{sql_round('quantile_cont(use, 0.5)', 1)} as use_median"
RATES_SQL = f"{sql_rate('nb_urgent', 'nb_dpe')} as urgent_pct, {sql_rate('nb_done', 'nb_dpe')} as done_pct"
COST_PER_SIZE_SQL = """
    case when size_mean <> 0 then cast((20 * 10 * cast(cost_mean as hugeint) + cast(round(size_mean * 10) as hugeint))
        // (2 * cast(round(size_mean * 10) as hugeint)) as double) / 10.0 end as cost_per_size
"""


def summary(medians: bool = True, **more) -> Summary:
    return Summary(
        flags={
            "nb_urgent": F.col("class").isin("1", "2"),
            "nb_done": F.col("status") == "F",
            **label_flags("class", CLASSES, "nb_class_"),
            **more.get("flags", {}),
        },
        means={"use_mean": ("use", 1), "size_mean": ("size", 1), "cost_mean": ("cost", 0)},
        medians={"use_median": ("use", 1)} if medians else {},
        spans=more.get("spans", {}),
    )


RATES = {"urgent_pct": "nb_urgent", "done_pct": "nb_done"}


def by_place_and_year(spark: SparkSession, sf: str) -> DataFrame:
    return with_rates(summarise(facts(spark, sf), ["place", "annee"], summary()), RATES)


PLACE_YEAR = FACTS + f"""
    , a as (select place, annee, {FLAGS_SQL}, {MEANS_SQL}, {MEDIAN_SQL} from f group by place, annee)
    , m as (select *, {RATES_SQL} from a)
"""


@query(
    "mart_by_key_year",
    PLACE_YEAR + "select m.*, n_name, n_regionkey from m left join nation on place = n_nationkey",
)
def mart_by_key_year(spark, sf):
    nations = table(spark, sf, "nation")
    mart = by_place_and_year(spark, sf)
    return plain(mart.join(nations, mart.place == nations.n_nationkey, "left").drop("n_nationkey"))


@query(
    "mart_by_parent",
    FACTS + f"""
    , g as (select f.*, case when n_regionkey = 3 then null else n_regionkey end as parent
        from f join nation on place = n_nationkey)
    , a as (select parent, min(annee) as annee_min, max(annee) as annee_max, {FLAGS_SQL},
        count(*) filter (where segment = 'HOUSEHOLD') as nb_household, {MEANS_SQL}, {MEDIAN_SQL} from g group by parent)
    , centre as (select n_regionkey, count(*) as n_places, {sql_round('avg(n_nationkey * 10)', 3)} as mid
        from nation where n_nationkey % 4 <> 0 and n_regionkey <> 3 group by n_regionkey)
    select a.*, {RATES_SQL}, {sql_rate('nb_household', 'nb_dpe')} as household_pct, {COST_PER_SIZE_SQL},
        n_places, mid, case when parent is null then 'Département non déterminé'
            else coalesce(r_name, 'Inconnu (' || parent || ')') end as name, coalesce(r_regionkey < 2, false) as mainland
    from a left join centre on parent = centre.n_regionkey left join (select * from region where r_regionkey <> 4)
        on parent = r_regionkey
    """,
)
def mart_by_parent(spark, sf):
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    parents = nations.select(
        F.col("n_nationkey").alias("place"),
        F.when(F.col("n_regionkey") != 3, F.col("n_regionkey")).alias("parent"),
    )
    spec = summary(
        flags={"nb_household": F.col("segment") == "HOUSEHOLD"},
        spans={"annee_min": ("min", "annee"), "annee_max": ("max", "annee")},
    )
    counted = summarise(facts(spark, sf).join(parents, "place"), ["parent"], spec)
    rated = with_rates(counted, {**RATES, "household_pct": "nb_household"}).withColumn(
        "cost_per_size", ratio(F.col("cost_mean"), F.col("size_mean"))
    )
    middle = (
        nations.filter((F.col("n_nationkey") % 4 != 0) & (F.col("n_regionkey") != 3))
        .groupBy(F.col("n_regionkey").alias("parent"))
        .agg(F.count(F.lit(1)).alias("n_places"), F.round(F.avg(F.col("n_nationkey") * 10), 3).alias("mid"))
    )
    reference = regions.filter("r_regionkey <> 4").withColumn("parent", F.col("r_regionkey"))
    named = rated.join(middle, "parent", "left").join(reference, "parent", "left")
    return plain(
        named.withColumns(
            {
                "name": name_or_unknown(F.col("r_name"), F.col("parent").cast("string")),
                "mainland": F.coalesce(F.col("r_regionkey") < 2, F.lit(False)),
            }
        ).drop("r_name", "r_regionkey")
    )


PROFILE_EDGES, PROFILE_BANDS = [50, 80, 110], ["under 50", "50-79", "80-109", "110 and over"]


@query(
    "mart_profile",
    FACTS + f"""
    , g as (select *, case when size is null then 'unknown' when size < 50 then 'under 50' when size < 80 then '50-79'
        when size < 110 then '80-109' else '110 and over' end as band from f)
    , a as (select segment, band, {FLAGS_SQL}, {MEANS_SQL} from g group by segment, band)
    select *, {RATES_SQL}, {COST_PER_SIZE_SQL}, cast(case band when 'under 50' then 1 when '50-79' then 2
        when '80-109' then 3 when '110 and over' then 4 else 99 end as integer) as band_rank from a
    """,
)
def mart_profile(spark, sf):
    banded = facts(spark, sf).withColumn("band", band(F.col("size"), PROFILE_EDGES, PROFILE_BANDS, "unknown"))
    rated = with_rates(summarise(banded, ["segment", "band"], summary(medians=False)), RATES)
    return plain(
        rated.withColumns(
            {
                "cost_per_size": ratio(F.col("cost_mean"), F.col("size_mean")),
                "band_rank": display_rank(F.col("band"), PROFILE_BANDS, 99),
            }
        ).orderBy("segment", "band_rank")
    )


# --- roll-ups and questions --------------------------------------------------


@query(
    "rollup_rate",
    PLACE_YEAR + f"""
    , s as (select annee, cast(sum(nb_urgent) as bigint) as nb_urgent, cast(sum(nb_dpe) as bigint) as nb_dpe
        from m group by annee)
    select *, {sql_rate('nb_urgent', 'nb_dpe')} as urgent_pct from s
    """,
)
def rollup(spark, sf):
    counted = summarise(facts(spark, sf), ["place", "annee"], summary(medians=False))
    return plain(rollup_rate(counted, ["annee"], "nb_urgent", "nb_dpe", "urgent_pct"))


@query(
    "top_k_rate",
    PLACE_YEAR + "select place, annee, urgent_pct from m order by urgent_pct desc, place nulls first, annee limit 15",
)
def top_rates(spark, sf):
    counted = with_rates(summarise(facts(spark, sf), ["place", "annee"], summary(medians=False)), RATES)
    return plain(top_k(counted, "urgent_pct", 15, ["place", "annee"]).select("place", "annee", "urgent_pct"))


@query("rate_corr", PLACE_YEAR + "select round(corr(urgent_pct, done_pct), 4) as r from m")
def rate_corr(spark, sf):
    counted = with_rates(summarise(facts(spark, sf), ["place", "annee"], summary(medians=False)), RATES)
    return analysis.rate_correlation(counted, "urgent_pct", "done_pct")


@query(
    "extreme_ratio",
    PLACE_YEAR + """
    , e as (select cast(round(max(urgent_pct) * 100) as hugeint) as h, cast(round(min(urgent_pct) * 100) as hugeint) as l
        from m)
    select h / 100.0 as highest, l / 100.0 as lowest,
        case when l <> 0 then cast((200 * h + l) // (2 * l) as double) / 100.0 end as factor from e
    """,
)
def extremes(spark, sf):
    counted = with_rates(summarise(facts(spark, sf), ["place", "annee"], summary(medians=False)), RATES)
    return plain(analysis.extreme_ratio(counted, "urgent_pct"))


@query(
    "filtered_totals",
    PLACE_YEAR + """
    select cast(sum(nb_dpe) as bigint) as nb_dpe, cast(sum(nb_urgent) as bigint) as nb_urgent from m where place < 20
    """,
)
def totals(spark, sf):
    counted = summarise(facts(spark, sf), ["place", "annee"], summary(medians=False))
    return analysis.filtered_totals(counted, F.col("place") < 20, ["nb_dpe", "nb_urgent"])


@query(
    "rate_by_kind",
    FACTS + f"""
    , a as (select segment, count(*) as nb_dpe, count(*) filter (where class in ('1', '2')) as nb_urgent
        from f where annee >= 1998 group by segment)
    select *, {sql_rate('nb_urgent', 'nb_dpe')} as urgent_pct from a
    """,
)
def rate_by_kind(spark, sf):
    spec = Summary(flags={"nb_urgent": F.col("class").isin("1", "2")})
    recent = facts(spark, sf).filter(F.col("annee") >= 1998)
    return plain(with_rates(summarise(recent, ["segment"], spec), {"urgent_pct": "nb_urgent"}))


@query(
    "cost_per_size",
    FACTS + f"""
    select class, {sql_round('sum(cost) / sum(size)', 1)} as cout_par_m2 from f
    where cost is not null and size is not null group by class
    """,
)
def cost_per_size(spark, sf):
    return plain(analysis.cost_per_size(facts(spark, sf), "class", "cost", "size"))


@query(
    "label_anomalies",
    """
    select count(*) as n_rows, min(l_quantity) as smallest, max(l_quantity) as largest from lineitem
    where l_returnflag = 'A' and l_extendedprice > 1000 and l_quantity < 40
    """,
)
def anomalies(spark, sf):
    lines = table(spark, sf, "lineitem")
    return analysis.label_anomalies(lines, "l_returnflag", "l_extendedprice", "l_quantity", "A", 1000, 40)


@query(
    "mart_of_medians",
    FACTS + f"""
    select segment, {FLAGS_SQL}, {MEANS_SQL}, {MEDIAN_SQL}, {sql_round('quantile_cont(size, 0.5)', 1)} as size_median,
        {sql_round('quantile_cont(cost, 0.5)', 0)} as cost_median from f group by segment
    """,
)
def mart_of_medians(spark, sf):
    """Few large groups, three medians: one scan, and no task with a group's values."""
    medians = {"use_median": ("use", 1), "size_median": ("size", 1), "cost_median": ("cost", 0)}
    return plain(summarise(facts(spark, sf), ["segment"], replace(summary(), medians=medians)))


# --- quantiles and shares ----------------------------------------------------

QUANTILES = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}


def quantile_sql(column: str) -> str:
    return ", ".join(f"{sql_round(f'quantile_cont({column}, {p})', 4)} as {n}" for n, p in QUANTILES.items())


def rounded(df: DataFrame) -> DataFrame:
    names = {n: F.round(F.col(n).cast("decimal(20,6)"), 4).cast("double") for n in QUANTILES}
    return df.withColumns(names)


@query("score_quantiles", f"select {quantile_sql('value')} from events")
def score_quantiles(spark, sf):
    return rounded(analysis.score_quantiles(table(spark, sf, "events"), "value"))


@query(
    "group_quantiles",
    f"select l_returnflag, l_linestatus, {quantile_sql('l_extendedprice')} from lineitem group by all",
)
def group_quantiles(spark, sf):
    lines = table(spark, sf, "lineitem")
    return rounded(exact_quantiles(lines, ["l_returnflag", "l_linestatus"], "l_extendedprice", QUANTILES))


@query(
    "fenced_group_quantiles",
    f"""
    with f as (select case when l_suppkey % 3 = 0 then null else l_returnflag end as flag, l_extendedprice from lineitem)
    select flag, {quantile_sql('l_extendedprice')} from f group by flag
    """,
)
def fenced_groups(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_suppkey") % 3 != 0, F.col("l_returnflag")).alias("flag"), "l_extendedprice"
    )
    return rounded(fenced_quantiles(lines, ["flag"], "l_extendedprice", QUANTILES, small_group=500))


@query("fenced_score_quantiles", f"select {quantile_sql('l_extendedprice')} from lineitem")
def fenced_scores(spark, sf):
    return rounded(fenced_quantiles(table(spark, sf, "lineitem"), [], "l_extendedprice", QUANTILES, small_group=500))


@query(
    "share_above",
    f"""
    with c as (select count(*) as n_rows, count(*) filter (where value >= 30) as n_match from events)
    select *, {sql_rate('n_match', 'n_rows')} as part_pct from c
    """,
)
def share_above(spark, sf):
    return plain(analysis.share_where(table(spark, sf, "events"), F.col("value") >= 30))


@query(
    "status_share",
    f"""
    with c as (select event_type, count(*) as n_rows, (select count(*) from events) as total from events group by event_type)
    select event_type, n_rows, {sql_rate('n_rows', 'total')} as part_pct from c
    """,
)
def shares(spark, sf):
    return plain(analysis.status_share(table(spark, sf, "events"), "event_type"))


@query(
    "dirty_measures",
    f"""
    with d as (select l_suppkey % 6 as kind, l_quantity as size, case l_suppkey % 6 when 0 then 1e15 when 1 then 1e300
        when 2 then cast('NaN' as double) when 3 then cast('inf' as double) when 4 then null else l_extendedprice end as cost
        from lineitem),
    a as (select kind, avg(cost) as m, quantile_cont(cost, 0.5) as q, max(size) as s, count(*) as nb_dpe from d group by kind)
    select kind, nb_dpe, case kind when 5 then {sql_round('m', 1)} when 0 then m end as cost_mean,
        case kind when 5 then {sql_round('q', 1)} when 0 then q end as cost_median from a
    """.replace("cast(round(cast(m", "cast(round(try_cast(m").replace("cast(round(cast(q", "cast(round(try_cast(q"),
)
def dirty_measures(spark, sf):
    """A measure that no rule has cleaned: too large, without end, not a number, missing."""
    kind, price = F.col("l_suppkey") % 6, F.col("l_extendedprice")
    cost = (
        F.when(kind == 0, 1e15).when(kind == 1, 1e300).when(kind == 2, float("nan")).when(kind == 3, float("inf"))
        .when(kind == 5, price)
    )
    rows = table(spark, sf, "lineitem").select(kind.alias("kind"), cost.alias("cost"))
    return plain(summarise(rows, ["kind"], Summary(means={"cost_mean": ("cost", 1)}, medians={"cost_median": ("cost", 1)})))
