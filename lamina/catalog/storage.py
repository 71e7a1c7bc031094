"""Sources and sinks: every query writes a whole table to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalog.base import query, sql_located, table
from lamina.catalog.ledgers import announced, calendar, dated_orders
from lamina.catalog.ruling import ITEMS, METRICS, long_metrics, prepared
from lamina.functions import fixed
from lamina.operators.geo import reproject
from lamina.operators.ledger import manifest, only_months
from lamina.operators.quality import reject_rows
from lamina.plans.backfill import backfill
from lamina.plans.flow import Lake, load_bronze, read_ledger, read_months, read_silver, read_strays
from lamina.plans.incremental import update_silver
from lamina.sources.exports import Export, export_all, export_csv, export_parquet, export_schema
from lamina.sources.landing import read_landing
from lamina.sources.shared import shared_path
from lamina.sources.tables import read_reference, read_table, write_metrics, write_partitions, year_window
from lamina.sources.warehouse import load_table, parquet_sink

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


@query(
    "landing_csv",
    """
    select lpad(cast(c_custkey as varchar), 6, '0') as c_custkey,
        case when c_custkey % 10 = 0 then null else c_mktsegment || ', "' || c_name || '"' end as c_label,
        case when c_custkey % 2 = 0 then cast(c_nationkey as varchar) end as c_nation_key, cast(null as varchar) as absent
    from customer
    """,
)
def landing_csv(spark, sf):
    """Two groups of files with other columns, in another order, under other spellings."""
    path = shared_path(spark, "landing")
    customers = table(spark, sf, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("c_custkey"),
        F.when(F.col("c_custkey") % 20 == 0, F.lit("n/a"))
        .when(F.col("c_custkey") % 10 == 0, F.lit(""))
        .otherwise(F.concat("c_mktsegment", F.lit(', "'), "c_name", F.lit('"')))
        .alias("c_label"),
        F.col("c_nationkey").cast("string").alias("c_nation key"),
        "c_acctbal",
    )
    even = F.col("c_custkey").cast("bigint") % 2 == 0
    for rows in (
        customers.filter(even),
        customers.filter(~even).select("c_acctbal", "c_label", "c_custkey"),
    ):
        rows.write.mode("append").option("header", True).option("escape", '"').csv(path)
    return read_landing(spark, path, ["c_custkey", "c_label", "c_nation_key", "absent"])


@query(
    "roundtrip_partitions",
    """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, cast(year(o_orderdate) as integer) as annee,
        cast(month(o_orderdate) as integer) as mois from orders
    """,
)
def roundtrip_partitions(spark, sf):
    """Whole table, then one year again: nothing is doubled, other months stay."""
    path = shared_path(spark, "bronze")
    rows = dated_orders(spark, sf).select(*ORDER_COLUMNS, "annee", "mois")
    write_partitions(rows, path, ["annee", "mois"], "static")
    write_partitions(rows.filter("annee = 1997"), path, ["annee", "mois"], "dynamic")
    return read_table(spark, path, rows.schema)


@query(
    "text_partition_codes",
    """
    select o_orderkey, lpad(cast(o_custkey % 12 as varchar), 2, '0') as region from orders
    """,
)
def text_partition_codes(spark, sf):
    """Partition codes with leading zeros stay text; an absent key is ignored."""
    path = shared_path(spark, "codes")
    code = F.lpad((F.col("o_custkey") % 12).cast("string"), 2, "0").alias("region")
    rows = table(spark, sf, "orders").select("o_orderkey", code)
    write_partitions(rows, path, ["region", "absent"], "static")
    return read_table(spark, path, rows.schema)


@query(
    "year_window",
    """
    select o_orderkey, o_totalprice, cast(year(o_orderdate) as integer) as annee from orders
    where year(o_orderdate) >= 1999
    """,
)
def window_on_partitions(spark, sf):
    path = shared_path(spark, "years")
    rows = dated_orders(spark, sf).select("o_orderkey", "o_totalprice", "annee")
    write_partitions(rows, path, ["annee"], "static")
    return year_window(read_table(spark, path, rows.schema), 1999, "annee")


@query(
    "partition_manifest",
    """
    select cast(year(o_orderdate) as integer) as annee, cast(month(o_orderdate) as integer) as mois,
        printf('annee=%04d/mois=%02d', year(o_orderdate), month(o_orderdate)) as partition, count(*) as rows_written,
        case month(o_orderdate) when 6 then count(*) + 1 when 11 then 0 else count(*) end as rows_announced_by_source,
        month(o_orderdate) not in (6, 11) as is_complete, true as has_files, true as files_in_order,
        'o_orderdate:' || year(o_orderdate) as source_filter
    from orders group by year(o_orderdate), month(o_orderdate)
    """,
)
def partition_manifest(spark, sf):
    path = shared_path(spark, "manifest")
    rows = dated_orders(spark, sf).select("o_orderkey", "annee", "mois")
    write_partitions(rows, path, ["annee", "mois"], "static")
    asked = F.concat(F.lit("o_orderdate:"), F.col("annee").cast("string"))
    record = manifest(read_table(spark, path, rows.schema), announced(spark, sf), asked)
    in_order = F.col("files") == F.array_sort(F.array_distinct("files"))
    return record.withColumns({"has_files": F.size("files") > 0, "files_in_order": in_order}).drop("files", "ingested_at_utc")


MONTHS = ((1996, 2), (1996, 3))


@query(
    "incremental_loads",
    """
    with o as (select o_orderkey, year(o_orderdate) as y, month(o_orderdate) as m, o_orderkey % 40 = 0 as undated,
        year(o_orderdate) = 1996 and month(o_orderdate) = 2 and o_orderkey % 3 = 0 as late from orders)
    select cast(o_orderkey as varchar) as numero_dpe, cast(case when not undated then y end as integer) as annee,
        cast(case when not undated then m end as integer) as mois,
        case when undated or y <> 1996 or m not in (2, 3) or late then 'hors_chargement' else 'bronze' end as destination,
        case when late or (y = 1996 and m = 3) then 'second' else 'first' end as chargement
    from o
    """,
)
def incremental_loads(spark, sf):
    """Orders as text, landed in two loads of a month each: the first with all other months'
    rows in it, the second with a few late rows of the first's month, both with undated rows.
    """
    lake = Lake(shared_path(spark, "lake"))
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    month = F.date_format(day, "yyyy-MM")
    orders = table(spark, sf, "orders").select(
        k.cast("string").alias("numero_dpe"),
        F.when(k % 40 == 0, F.lit("")).otherwise(F.date_format(day, "yyyy-MM-dd")).alias(fixed.PARTITION_DATE),
        ((month == "1996-03") | ((month == "1996-02") & (k % 3 == 0))).alias("second"),
    )
    loads = {"first": ~F.col("second"), "second": F.col("second")}
    for (name, rows), (year, m) in zip(loads.items(), MONTHS):
        landing = f"{lake.root}/landing/{name}"
        orders.filter(rows).drop("second").write.option("header", True).csv(landing)
        said = spark.createDataFrame([(year, m, 0)], "annee int, mois int, annonces long")
        load_bronze(spark, lake, landing, said, F.lit(name), name)
    keep = ["numero_dpe", "annee", "mois"]
    inside = read_months(spark, lake).select(
        *keep, F.lit("bronze").alias("destination"), F.when(F.col("mois") == 2, "first").otherwise("second").alias("chargement")
    )
    outside = read_strays(spark, lake)
    return inside.unionByName(outside.select(*keep, F.lit("hors_chargement").alias("destination"), "chargement"))


@query(
    "incremental_silver",
    """
    with o as (select o_orderkey as k, case when year(o_orderdate) = 1997 and month(o_orderdate) = 1 and o_orderkey % 3 = 0
        then 1999 else year(o_orderdate) end as y from orders),
    s as (select o.*, k in (select k + 1 from o where k % 20 = 0) as superseded from o)
    select cast(k as varchar) as numero_dpe, cast(y as integer) as annee_etablissement,
        lpad(cast(k % 12 as varchar), 2, '0') as code_region_ban,
        case when superseded then 'remplace_par_dpe_recent' when k % 50 = 0 then 'surface_invalide' end as motif_rejet
    from s
    """,
)
def incremental_silver(spark, sf):
    """Silver of all orders, then of two months landed anew: a third of one month's keys moved to the other."""
    lake = Lake(shared_path(spark, "lake"))
    k = F.col("o_orderkey")
    orders = dated_orders(spark, sf).withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    moved = (F.col("annee") == 1997) & (F.col("mois") == 1) & (k % 3 == 0)
    again = orders.filter("(annee = 1997 or annee = 1999) and mois = 1").withColumn("day", F.when(moved, "1999-01-15").otherwise(F.col("day")))
    months = orders.select("annee", "mois").distinct()
    for name, rows, asked in (("all", orders, months), ("again", again, months.filter("annee in (1997, 1999) and mois = 1"))):
        rows.select(
            k.cast("string").alias("numero_dpe"),
            F.when(k % 20 == 0, (k + 1).cast("string")).otherwise("").alias("numero_dpe_remplace"),
            F.col("day").alias("date_etablissement_dpe"),
            F.when(moved, "2001-01-01").otherwise("2000-01-01").alias("date_derniere_modification_dpe"),
            F.lit("D").alias("etiquette_dpe"),
            F.lit("05061").alias("code_insee_ban"),
            F.lpad((k % 12).cast("string"), 2, "0").alias("code_region_ban"),
            F.when(k % 50 == 0, "0").otherwise("80").alias("surface_habitable_logement"),
            F.lit("200").alias("conso_5 usages_par_m2_ep"),
        ).write.option("header", True).csv(f"{lake.root}/landing/{name}")
        load_bronze(spark, lake, f"{lake.root}/landing/{name}", asked.withColumn("annonces", F.lit(0)), F.lit(name), name)
        update_silver(spark, lake, F.lit("2002-01-01").cast("date"))
    current, rejects = read_silver(spark, lake)
    keep = ["numero_dpe", "annee_etablissement", "code_region_ban"]
    return current.select(*keep, F.lit(None).cast("string").alias("motif_rejet")).unionByName(rejects.select(*keep, "motif_rejet"))


class OrderMonths:
    """A source whose months are those of the orders."""

    def __init__(self, spark: SparkSession, sf: str):
        self.said = announced(spark, sf)
        self.orders = dated_orders(spark, sf).select(
            F.col("o_orderkey").alias("numero_dpe"), F.date_format("o_orderdate", "yyyy-MM-dd").alias(fixed.PARTITION_DATE), "annee", "mois"
        )

    def announced(self, calendar: DataFrame) -> DataFrame:
        return calendar.join(self.said, ["annee", "mois"])

    def land(self, months, folder: str) -> None:
        only_months(self.orders, months).drop("annee", "mois").write.option("header", True).csv(folder)

    def filter_of(self):
        return F.concat_ws("-", "annee", "mois")


@query(
    "backfill_months",
    """
    with c as (select cast(year(o_orderdate) as integer) as annee, cast(month(o_orderdate) as integer) as mois, count(*) as n
        from orders group by all),
    a as (select *, case mois when 6 then n + 1 when 11 then 0 else n end as said from c)
    select annee, mois, n as rows_written, said as rows_announced_by_source, n = said as is_complete from a where said > 0
    """,
)
def backfill_months(spark, sf):
    """All months of the orders, in a run that is capped and one that takes up the rest."""
    lake = Lake(shared_path(spark, "lake"))
    months, source = calendar(spark, sf), OrderMonths(spark, sf)
    backfill(spark, lake, source, months, cap=30, batch=30, stop_on_failure=True)
    backfill(spark, lake, source, months, batch=60, stop_on_failure=True)
    return read_ledger(spark, lake).select("annee", "mois", "rows_written", "rows_announced_by_source", "is_complete")


@query(
    "rejects_roundtrip",
    ITEMS + """
    select item, cast(year(shipped) as integer) as annee,
        case when est_remplace then 'remplace_par_dpe_recent' else motif_rejet end as motif_rejet
    from prep where not est_valide or est_remplace
    """,
)
def rejects_roundtrip(spark, sf):
    path = shared_path(spark, "rejects")
    rows = reject_rows(prepared(spark, sf).withColumn("annee", F.year("shipped")), ["item", "annee"])
    write_partitions(rows, path, ["annee"], "static")
    return read_table(spark, path, rows.schema)


@query("metrics_roundtrip", METRICS + "select metrique, valeur, true as stamped from metrics")
def metrics_roundtrip(spark, sf):
    path = shared_path(spark, "metrics")
    write_metrics(long_metrics(spark, sf), path)
    stored = spark.read.parquet(path)
    return stored.select("metrique", "valeur", F.col("execute_le").isNotNull().alias("stamped"))


@query(
    "warehouse_load",
    """
    select o_orderkey, o_custkey, o_totalprice, cast(year(o_orderdate) as integer) as annee_etablissement,
        (select count(*) from orders where year(o_orderdate) >= 1998) as n_loaded
    from orders where year(o_orderdate) >= 1998
    """,
)
def warehouse_load(spark, sf):
    path = shared_path(spark, "warehouse")
    rows = table(spark, sf, "orders").withColumn("annee_etablissement", F.year("o_orderdate"))
    keep = ["o_orderkey", "o_custkey", "o_totalprice", "not_there", "annee_etablissement"]
    loaded = load_table(rows, parquet_sink(path), keep, since=1998)
    return spark.read.parquet(path).withColumn("n_loaded", F.lit(loaded).cast("bigint"))


@query(
    "reference_csv",
    "select lpad(cast(n_nationkey as varchar), 2, '0') as code, n_name as name, n_regionkey < 2 as mainland from nation",
)
def reference_csv(spark, sf):
    path = shared_path(spark, "reference")
    nations = table(spark, sf, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"),
        F.col("n_name").alias("name"),
        (F.col("n_regionkey") < 2).alias("mainland"),
    )
    export_csv(nations, path)
    return read_reference(spark, path, "code string, name string, mainland boolean")


DECLARED = [
    ("o_orderkey", "bigint"), ("o_custkey", "integer"), ("o_totalprice", "double precision"),
    ("o_orderdate", "date"), ("o_orderstatus", "character varying"), ("o_orderpriority", "money"),
]


def untyped_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*[F.col(n).cast("string").alias(n) for n, _ in DECLARED])


@query(
    "export_parquet_declared",
    """
    select o_orderkey, cast(o_custkey as integer) as o_custkey, o_totalprice, cast(o_orderdate as date) as o_orderdate,
        o_orderstatus, o_orderpriority from orders
    """,
)
def export_declared(spark, sf):
    path = shared_path(spark, "export")
    export_parquet(untyped_orders(spark, sf), path, DECLARED)
    return spark.read.schema(export_schema(DECLARED)).parquet(path)


@query(
    "export_selection",
    """
    select 'facts' as name, count(*) as n_rows, count(*) as n_stored, cast(0 as bigint) as n_located,
        cast(null as double) as south, cast(null as double) as east from orders
    union all
    select 'places', count(*), count(*), count(latitude), min(latitude), max(longitude) from """
    + sql_located(
        "(select case when c_custkey % 2 = 0 then 650000 + c_custkey % 1000 else -9000000 end as x, 6800000 as y from customer)",
        "1", "x", "y",
    ),
)
def export_selection(spark, sf):
    """Two tables of three, one of them with coordinates; every second point is off the map."""
    root = shared_path(spark, "exports")
    k = F.col("c_custkey")
    places = table(spark, sf, "customer").select(
        k,
        F.when(k % 2 == 0, F.lit(650000) + k % 1000).otherwise(F.lit(-9000000)).alias("centroide_x_lambert93"),
        F.lit(6800000).alias("centroide_y_lambert93"),
    )
    tables = {
        "places": Export(places, "csv", reproject=True),
        "facts": Export(untyped_orders(spark, sf), "parquet", fields=DECLARED),
        "unused": Export(places, "csv"),
    }
    rows = export_all(tables, root, ["facts", "places"])
    header = "c_custkey long, centroide_x_lambert93 long, centroide_y_lambert93 long, latitude double, longitude double"
    stored = {
        "facts": spark.read.parquet(f"{root}/facts").withColumns(
            {n: F.lit(None).cast("double") for n in ("latitude", "longitude")}
        ),
        "places": spark.read.schema(header).option("header", True).csv(f"{root}/places"),
    }
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("n_stored"),
            F.count("latitude").alias("n_located"),
            F.min("latitude").alias("south"),
            F.max("longitude").alias("east"),
        ).withColumns({"name": F.lit(n), "n_rows": F.lit(rows[n]).cast("bigint")})
        for n, df in stored.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "export_csv_coordinates",
    "select * from " + sql_located(
        "(select c_custkey, c_name, case when c_custkey % 2 = 0 then 650000.0 + c_custkey end as x, 6800000.0 as y from customer)",
        "c_custkey, c_name", "x", "y",
    ),
)
def export_csv_coordinates(spark, sf):
    path = shared_path(spark, "csv")
    k = F.col("c_custkey")
    points = table(spark, sf, "customer").select(
        k, "c_name",
        F.when(k % 2 == 0, F.lit(650000.0) + k).alias("centroide_x_lambert93"),
        F.lit(6800000.0).alias("centroide_y_lambert93"),
    )
    export_csv(reproject(points), path)
    header = "c_custkey long, c_name string, centroide_x_lambert93 double, centroide_y_lambert93 double, " \
             "latitude double, longitude double"
    stored = spark.read.schema(header).option("header", True).option("escape", '"').csv(path)
    return stored.select("c_custkey", "c_name", "latitude", "longitude")
