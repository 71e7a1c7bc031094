"""Names, types, dedup, supersession, bands, codes and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalog.base import plain, query, sql_rate, sql_round, table
from lamina.functions import fixed
from lamina.functions.bands import band, display_label, display_rank, member, still_valid
from lamina.functions.codes import derive_parent, name_or_unknown, repair_code
from lamina.functions.measures import product_round
from lamina.operators.analysis import key_uniqueness, predecessor_shares
from lamina.operators.clean import (
    cast_columns,
    dedup_latest,
    mark_superseded,
    normalise_names,
    orphan_references,
    project_present,
    referenced_keys,
    rename,
)
from lamina.operators.geo import reproject
from lamina.operators.labels import centroids, label_frequency, mode_label
from lamina.operators.marts import centres
from lamina.operators.quality import status_flags

DAY = "yyyy-MM-dd"


def orders_as_text(spark: SparkSession, sf: str) -> DataFrame:
    """Orders rendered as text, with unreadable, padded and odd spellings."""
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", DAY)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(k % 97 == 0, F.lit("non renseigné"))
        .when(k % 89 == 0, F.concat(F.lit("  "), day, F.lit(" ")))
        .when(k % 83 == 0, F.date_format("o_orderdate", "yyyy/MM/dd"))
        .when(k % 79 == 0, F.date_format("o_orderdate", "yyyy-M-d"))
        .otherwise(day)
        .alias("order_day"),
        F.when(k % 97 == 0, F.lit("non renseigné"))
        .when(k % 89 == 0, F.concat(F.lit(" "), F.col("o_totalprice").cast("string"), F.lit("  ")))
        .when(k % 83 == 0, F.lit(""))
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("price"),
        F.when(k % 97 == 0, F.lit("1e3"))
        .when(k % 7 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .when(k % 11 == 0, F.concat(F.lit(" -"), F.col("o_custkey").cast("string"), F.lit(".9 ")))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer"),
    )


@query(
    "text_typing",
    """
    select o_orderkey,
        case when o_orderkey % 97 = 0 then null
             when o_orderkey % 89 <> 0 and o_orderkey % 83 = 0 then null
             when o_orderkey % 89 <> 0 and o_orderkey % 79 = 0 and (month(o_orderdate) < 10 or day(o_orderdate) < 10) then null
             else cast(o_orderdate as date) end as order_day,
        case when o_orderkey % 97 = 0 then null
             when o_orderkey % 89 <> 0 and o_orderkey % 83 = 0 then null else o_totalprice end as price,
        cast(case when o_orderkey % 97 = 0 then null
             when o_orderkey % 7 = 0 then o_custkey
             when o_orderkey % 11 = 0 then -o_custkey else o_custkey end as integer) as customer
    from orders
    """,
)
def text_typing(spark, sf):
    return cast_columns(orders_as_text(spark, sf), ["order_day"], ["price"], ["customer", "not_there"])


@query("name_repair", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def name_repair(spark, sf):
    broken = ["c custkey", " c_name ", "c  nationkey", "c_acctbal", "c\tmktsegment"]
    return normalise_names(table(spark, sf, "customer").toDF(*broken))


@query("projection_by_presence", "select o_custkey, o_orderkey from orders")
def projection_by_presence(spark, sf):
    return project_present(table(spark, sf, "orders"), ["o_custkey", "absent", "o_orderkey"])


LINE_COLUMNS = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
LINE_ORDER = (
    "l_shipdate desc, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
)


def line_order() -> list:
    return [F.desc_nulls_last("l_shipdate")] + [F.asc(c.strip()) for c in LINE_ORDER.split(",")[1:]]


@query(
    "dedup_latest",
    f"""
    select {LINE_COLUMNS}, cast(l_shipdate as date) as ship_day from (
        select *, row_number() over (partition by l_orderkey, l_linenumber order by {LINE_ORDER}) as rn from lineitem)
    where rn = 1
    """,
)
def dedup(spark, sf):
    once = dedup_latest(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], line_order())
    return once.withColumn("ship_day", F.to_date("l_shipdate")).drop("l_shipdate")


@query(
    "dedup_null_keys",
    f"""
    with keyed as (select *, case when l_orderkey % 3 = 0 then null else l_orderkey end as k from lineitem)
    select k, {LINE_COLUMNS} from keyed where k is null
    union all
    select k, {LINE_COLUMNS} from (
        select *, row_number() over (partition by k order by l_shipdate desc, l_linenumber, {LINE_ORDER}) as rn
        from keyed where k is not null) where rn = 1
    """,
)
def dedup_null_keys(spark, sf):
    keyed = table(spark, sf, "lineitem").withColumn("k", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey")))
    order = [F.desc("l_shipdate"), F.asc("l_linenumber"), *line_order()]
    return dedup_latest(keyed, ["k"], order, keep_null_keys=True).drop("l_shipdate")


def orders_with_references(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.when(k % 211 == 0, F.concat(F.lit(" "), k.cast("string"))).otherwise(k.cast("string")).alias("k"),
        F.when(k % 500 == 0, k.cast("string"))
        .when(k % 12 == 0, F.concat((k - 1).cast("string"), F.lit(" ")))
        .when(k % 35 == 0, F.concat(F.lit("old"), (k % 700).cast("string")))
        .when(k % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit(" "))
        .alias("replaces"),
        "o_orderstatus",
    )


REFERENCES = """
    with src as (
        select case when o_orderkey % 211 = 0 then ' ' else '' end || o_orderkey as k, o_orderkey,
            case when o_orderkey % 500 = 0 then cast(o_orderkey as varchar)
                 when o_orderkey % 12 = 0 then cast(o_orderkey - 1 as varchar)
                 when o_orderkey % 35 = 0 then 'old' || (o_orderkey % 700) end as ref
        from orders),
    refs as (select distinct ref from src where ref is not null)
"""


@query(
    "mark_superseded",
    REFERENCES + "select k, cast(o_orderkey as varchar) in (select ref from refs) as est_remplace from src",
)
def superseded(spark, sf):
    return mark_superseded(orders_with_references(spark, sf), "k", "replaces").select("k", "est_remplace")


@query("referenced_keys", REFERENCES + "select ref from refs")
def referenced(spark, sf):
    return referenced_keys(orders_with_references(spark, sf), "replaces", "ref")


@query(
    "orphan_references",
    REFERENCES + """
    select ref as reference, count(*) as n_rows from src
    where ref is not null and ref not in (select cast(o_orderkey as varchar) from orders) group by ref
    """,
)
def orphans(spark, sf):
    return orphan_references(orders_with_references(spark, sf), "k", "replaces")


@query(
    "predecessor_shares",
    REFERENCES + f"""
    , c as (select count(*) as n_rows, count(*) filter (where ref is not null) as n_naming,
        count(*) filter (where cast(o_orderkey as varchar) in (select ref from refs)) as n_superseded from src)
    select n_rows, n_naming, n_superseded, {sql_rate('n_naming', 'n_rows')} as naming_pct,
        {sql_rate('n_superseded', 'n_rows')} as superseded_pct from c
    """,
)
def predecessors(spark, sf):
    return plain(predecessor_shares(orders_with_references(spark, sf), "k", "replaces"))


@query("key_uniqueness", "select count(*) as n_rows, count(distinct l_orderkey) as n_keys from lineitem")
def uniqueness(spark, sf):
    return key_uniqueness(table(spark, sf, "lineitem"), "l_orderkey")


# --- flags, bands, dates -----------------------------------------------------


@query(
    "status_flags",
    """
    select event_id,
        event_type in ('click', 'view') as geocodage_fiable,
        event_type in ('click', 'view') and value >= 20 as geocodage_precis
    from events
    """,
)
def statuses(spark, sf):
    status = (
        F.when(F.col("event_type") == "click", F.lit("adresse géocodée ban à l'adresse"))
        .when(F.col("event_type") == "view", F.lit(" Adresse Géocodée ban à la rue"))
        .when(F.col("event_type") == "error", F.lit("adresse non géocodée ban car aucune correspondance"))
    )
    return status_flags(table(spark, sf, "events").withColumn("status", status), "status", "value", 20.0).select(
        "event_id", "geocodage_fiable", "geocodage_precis"
    )


@query(
    "bands",
    """
    select p_partkey,
        case when p_size is null or p_size >= 40 then '130 m2 et plus' when p_size < 10 then 'moins de 30 m2'
             when p_size < 20 then '30 a 60 m2' when p_size < 30 then '60 a 90 m2' else '90 a 130 m2' end as size_band,
        case when p_partkey % 9 = 0 then 'inconnue' when 1930 + p_partkey % 95 < 1948 then 'avant 1948'
             when 1930 + p_partkey % 95 < 1975 then '1948-1974' when 1930 + p_partkey % 95 < 1989 then '1975-1988'
             when 1930 + p_partkey % 95 < 2001 then '1989-2000' when 1930 + p_partkey % 95 < 2013 then '2001-2012'
             else '2013 et apres' end as age_band
    from part
    """,
)
def bands(spark, sf):
    built = F.when(F.col("p_partkey") % 9 != 0, F.lit(1930) + F.col("p_partkey") % 95)
    return table(spark, sf, "part").select(
        "p_partkey",
        band(F.col("p_size"), [10, 20, 30, 40], fixed.SIZE_LABELS).alias("size_band"),
        band(built, fixed.AGE_EDGES, fixed.AGE_LABELS, fixed.AGE_UNKNOWN).alias("age_band"),
    )


@query(
    "label_and_rank",
    """
    with b as (select p_partkey, case p_partkey % 8 when 0 then 'avant 1948' when 1 then '1948-1974'
        when 2 then '1975-1988' when 3 then '1989-2000' when 4 then '2001-2012' when 5 then '2013 et apres'
        when 6 then 'inconnue' end as band from part)
    select p_partkey,
        case band when '2013 et apres' then '2013 et après' when 'inconnue' then 'Période inconnue' else band end as label,
        cast(case when p_partkey % 8 < 6 then p_partkey % 8 + 1 else 99 end as integer) as rank
    from b
    """,
)
def label_and_rank(spark, sf):
    names = F.array(*[F.lit(v) for v in [*fixed.AGE_LABELS, fixed.AGE_UNKNOWN]])
    band_of = F.get(names, (F.col("p_partkey") % 8).cast("int"))
    return table(spark, sf, "part").select("p_partkey", band_of.alias("band")).select(
        "p_partkey",
        display_label(F.col("band"), fixed.AGE_DISPLAY).alias("label"),
        display_rank(F.col("band"), fixed.AGE_LABELS, fixed.UNKNOWN_RANK).alias("rank"),
    )


@query(
    "class_flags",
    """
    select l_orderkey, l_linenumber, l_returnflag,
        case when l_partkey % 10 <> 0 then l_returnflag in ('R', 'A') end as is_ra,
        case when l_partkey % 10 <> 0 then l_returnflag = 'N' end as is_n
    from lineitem
    """,
)
def class_flags(spark, sf):
    flag = F.when(F.col("l_partkey") % 10 != 0, F.col("l_returnflag"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        member(flag, ["R", "A"]).alias("is_ra"), member(flag, ["N"]).alias("is_n"),
    )


@query(
    "date_parts",
    """
    select o_orderkey, cast(year(o_orderdate) as integer) as annee, cast(month(o_orderdate) as integer) as mois from orders
    """,
)
def date_parts(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("annee"), F.month("o_orderdate").alias("mois")
    )


@query(
    "still_valid",
    """
    select o_orderkey, case when o_orderkey % 10 <> 0 then cast(o_orderdate as date) >= date '1998-06-15' end as valid
    from orders
    """,
)
def validity(spark, sf):
    end = F.when(F.col("o_orderkey") % 10 != 0, F.to_date("o_orderdate"))
    as_of = F.lit("1998-06-15").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", still_valid(end, as_of).alias("valid"))


# --- renames, measures, codes ------------------------------------------------


@query(
    "staging_rename",
    "select l_orderkey as order_id, l_quantity as size_m2, l_extendedprice as use_kwh, l_returnflag as label from lineitem",
)
def staging_rename(spark, sf):
    names = {"l_orderkey": "order_id", "l_quantity": "size_m2", "l_extendedprice": "use_kwh", "l_returnflag": "label"}
    return rename(table(spark, sf, "lineitem"), names)


@query(
    "fact_measure",
    f"""
    select l_orderkey, l_linenumber,
        case when l_partkey % 10 <> 0 then {sql_round('l_quantity * l_extendedprice', 0)} end as total_use
    from lineitem
    """,
)
def fact_measure(spark, sf):
    size = F.when(F.col("l_partkey") % 10 != 0, F.col("l_quantity"))
    total = product_round(size, F.col("l_extendedprice")).alias("total_use")
    return plain(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", total))


def coded_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with place codes of every kind, some of them unusable."""
    k = F.col("c_custkey")
    tail = F.lpad(k.cast("string"), 3, "0")
    digits = F.lpad((k % 99).cast("string"), 2, "0")
    code = (
        F.when(k % 23 == 0, F.lit("RENNES"))
        .when(k % 19 == 0, F.concat(F.lit("old  "), digits, tail))
        .when(k % 17 == 0, F.concat(F.lit("2A"), tail))
        .when(k % 13 == 0, F.concat(F.lit("97"), tail))
        .when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(digits, tail))
    )
    given = F.when(k % 5 == 0, F.lit("GIVEN"))
    return table(spark, sf, "customer").select("c_custkey", "c_name", code.alias("code"), given.alias("given"))


CODED = """
    with parts as (select c_custkey, c_name,
        lpad(cast(c_custkey as varchar), 3, '0') as tail, lpad(cast(c_custkey % 99 as varchar), 2, '0') as digits
        from customer),
    coded as (select c_custkey, c_name, case when c_custkey % 5 = 0 then 'GIVEN' end as given,
        case when c_custkey % 23 = 0 then 'RENNES' when c_custkey % 19 = 0 then 'old  ' || digits || tail
             when c_custkey % 17 = 0 then '2A' || tail when c_custkey % 13 = 0 then '97' || tail
             when c_custkey % 11 = 0 then null else digits || tail end as code from parts),
    repaired as (select *, case when code like 'old%' then ltrim(substr(code, 4)) else code end as r from coded)
"""


@query("code_repair", CODED + "select c_custkey, r as code from repaired")
def code_repair(spark, sf):
    return coded_customers(spark, sf).select("c_custkey", repair_code(F.col("code")).alias("code"))


@query(
    "parent_code",
    CODED + """
    select c_custkey, coalesce(given, case
        when r[1] = '9' and r[2] in ('7', '8') and r[3] between '0' and '9' then r[1:3]
        when r[1:2] in ('2A', '2B') then r[1:2]
        when try_cast(r[1:2] as integer) between 1 and 95 and r[1:2] <> '20' and r[1:1] between '0' and '9' then r[1:2]
        end) as parent
    from repaired
    """,
)
def parent_code(spark, sf):
    return coded_customers(spark, sf).select(
        "c_custkey", derive_parent(F.col("code"), F.col("given")).alias("parent")
    )


@query(
    "name_or_unknown",
    CODED + """
    select c_custkey, case when c_custkey % 4 = 0 then c_name when code is not null then 'Inconnu (' || code || ')'
        else 'Département non déterminé' end as name from coded
    """,
)
def fallback_name(spark, sf):
    name = F.when(F.col("c_custkey") % 4 == 0, F.col("c_name"))
    return coded_customers(spark, sf).select("c_custkey", name_or_unknown(name, F.col("code")).alias("name"))


# --- labels and points -------------------------------------------------------


@query(
    "label_frequency",
    "select c_nationkey, c_mktsegment, count(*) as occurrences from customer group by all",
)
def frequencies(spark, sf):
    return label_frequency(table(spark, sf, "customer"), "c_nationkey", ["c_mktsegment"])


@query(
    "mode_label",
    """
    with c as (select l_suppkey, case when l_partkey % 3 = 0 then null else l_returnflag end as flag, l_linestatus,
        count(*) as occurrences from lineitem group by all)
    select l_suppkey, flag, l_linestatus, occurrences from (select *, row_number() over (
        partition by l_suppkey order by occurrences desc, flag nulls last, l_linestatus nulls last) as rn from c)
    where rn = 1
    """,
)
def modes(spark, sf):
    flag = F.when(F.col("l_partkey") % 3 != 0, F.col("l_returnflag"))
    flagged = table(spark, sf, "lineitem").withColumn("flag", flag)
    return mode_label(flagged, "l_suppkey", ["flag", "l_linestatus"])


def located_customers(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal",
        F.when(k % 20 != 0, F.lit(100000) + k * 611).alias("x"),
        (F.lit(6100000) + (k % 997) * 1100).alias("y"),
    )


LOCATED = """
    with p as (select c_custkey, c_nationkey, c_acctbal, case when c_custkey % 20 <> 0 then 100000 + 611 * c_custkey end as x,
        6100000 + 1100 * (c_custkey % 997) as y from customer),
    centroids as (select c_nationkey, avg(x) as cx, avg(y) as cy, count(*) as n from p
        where c_acctbal > 0 and x is not null and y is not null group by c_nationkey)
"""


def nation_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return centroids(located_customers(spark, sf), "c_nationkey", "x", "y", F.col("c_acctbal") > 0, "cx", "cy", "n")


@query(
    "centroid",
    LOCATED + f"select c_nationkey, {sql_round('cx', 3)} as cx, {sql_round('cy', 3)} as cy, n from centroids",
)
def centroid(spark, sf):
    points = nation_centroids(spark, sf)
    return points.withColumns({c: F.round(F.col(c).cast("decimal(20,6)"), 3).cast("double") for c in ("cx", "cy")})


@query(
    "centre_unweighted",
    LOCATED + f"""
    select cast(c_nationkey % 5 as integer) as region, count(*) as nb_communes, {sql_round('avg(cx)', 3)} as cx,
        {sql_round('avg(cy)', 3)} as cy from centroids group by 1
    """,
)
def centre(spark, sf):
    points = nation_centroids(spark, sf).withColumn("region", (F.col("c_nationkey") % 5).cast("int"))
    middle = centres(points, "region", "cx", "cy")
    return middle.withColumns({c: F.round(F.col(c).cast("decimal(20,6)"), 3).cast("double") for c in ("cx", "cy")})


@query(
    "reproject",
    """
    with k as (select c_custkey, cast(100000 + 611 * c_custkey as double) as x,
        cast(6100000 + 1100 * (c_custkey % 997) as double) as y,
        cast('0.08181919104281579' as double) as e, cast('0.7256077650532695' as double) as n,
        cast('1.8428979224021063' as double) as f, cast('6055612.049875985' as double) as r0 from customer),
    s as (select *, x - 700000 as dx, r0 - (y - 6600000) as dy from k),
    r as (select *, pi() / 2 - 2 * atan(pow(sqrt(dx * dx + dy * dy) / (cast(6378137 as double) * f), 1 / n)) as chi,
        3 + degrees(atan2(dx, dy) / n) as lon from s),
    g as (select c_custkey, lon, degrees(chi
        + (pow(e, 2) / 2 + 5 * pow(e, 4) / 24 + pow(e, 6) / 12 + 13 * pow(e, 8) / 360) * sin(2 * chi)
        + (7 * pow(e, 4) / 48 + 29 * pow(e, 6) / 240 + 811 * pow(e, 8) / 11520) * sin(4 * chi)
        + (7 * pow(e, 6) / 120 + 81 * pow(e, 8) / 1120) * sin(6 * chi)
        + (4279 * pow(e, 8) / 161280) * sin(8 * chi)) as lat from r),
    h as (select c_custkey, round(lat, 6) as lat, round(lon, 6) as lon from g)
    select c_custkey,
        case when lat between 41 and 51.5 and lon between -5.5 and 10 then lat end as latitude,
        case when lat between 41 and 51.5 and lon between -5.5 and 10 then lon end as longitude
    from h
    """,
)
def reprojected(spark, sf):
    k = F.col("c_custkey")
    planar = table(spark, sf, "customer").select(
        k, (F.lit(100000) + k * 611).alias("x"), (F.lit(6100000) + (k % 997) * 1100).alias("y")
    )
    return reproject(planar, "x", "y").select("c_custkey", "latitude", "longitude")
