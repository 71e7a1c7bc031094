"""Reject motives, the current/rejects split and the run metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalog.base import query, sql_rate, table
from lamina.operators.clean import mark_superseded
from lamina.operators.quality import (
    RuleColumns,
    apply_quality,
    current,
    metrics_of,
    reject_histogram,
    reject_rows,
    run_counters,
    split,
    standard_rules,
    tally,
    with_share,
)

COLUMNS = RuleColumns(key="item", label="label", date="shipped", place="place", size="size", use="use")


def items(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with blank keys, missing labels and dates, and values out of range."""
    order, line, part, supplier = (F.col(f"l_{n}") for n in ("orderkey", "linenumber", "partkey", "suppkey"))
    return table(spark, sf, "lineitem").select(
        F.when(order % 197 == 0, F.lit(" ")).otherwise(F.concat_ws("-", order, line)).alias("item"),
        F.when((order * 7 + line) % 12 == 0, F.concat_ws("-", order - 1, line)).alias("replaces"),
        F.when(part % 31 != 0, F.col("l_returnflag")).alias("label"),
        F.when(part % 37 != 0, F.to_date("l_shipdate")).alias("shipped"),
        F.when(supplier % 10 == 0, F.lit("  ")).otherwise(supplier.cast("string")).alias("place"),
        F.when(part % 41 == 0, F.lit(None)).when(part % 43 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("size"),
        F.when(part % 47 == 0, F.lit(-1.0)).otherwise(F.col("l_extendedprice")).alias("use"),
        (supplier % 4 < 2).alias("geocodage_fiable"),
    )


def prepared(spark: SparkSession, sf: str, null_label: str = "pass") -> DataFrame:
    rules = standard_rules(COLUMNS, ["A", "N"], null_label, max_size=45, max_use=90000)
    return mark_superseded(apply_quality(items(spark, sf), rules), "item", "replaces")


def items_sql(null_label: str) -> str:
    return f"""
    with src as (
        select case when l_orderkey % 197 = 0 then ' ' else l_orderkey || '-' || l_linenumber end as item,
            case when (l_orderkey * 7 + l_linenumber) % 12 = 0 then (l_orderkey - 1) || '-' || l_linenumber end as replaces,
            case when l_partkey % 31 <> 0 then l_returnflag end as label,
            case when l_partkey % 37 <> 0 then cast(l_shipdate as date) end as shipped,
            case when l_suppkey % 10 = 0 then '  ' else cast(l_suppkey as varchar) end as place,
            case when l_partkey % 41 = 0 then null when l_partkey % 43 = 0 then 0 else l_quantity end as size,
            case when l_partkey % 47 = 0 then -1 else l_extendedprice end as use,
            l_suppkey % 4 < 2 as geocodage_fiable
        from lineitem),
    refs as (select distinct replaces from src where replaces is not null),
    prep as (select *, motif_rejet is null as est_valide from (
        select src.*, refs.replaces is not null as est_remplace,
            case when trim(item) = '' then 'identifiant_absent'
                 when {null_label} then 'etiquette_dpe_invalide'
                 when shipped is null then 'date_etablissement_absente'
                 when trim(place) = '' then 'commune_absente'
                 when size is null or size <= 0 then 'surface_invalide'
                 when size > 45 then 'surface_aberrante'
                 when use < 0 then 'consommation_invalide'
                 when use > 90000 then 'consommation_aberrante' end as motif_rejet
        from src left join refs on trim(src.item) = refs.replaces))
    """


ITEMS = items_sql("label = 'R'")
COUNTERS = """
    counters as (select count(*) as apres_deduplication, count(*) filter (where est_remplace) as remplaces,
        count(*) filter (where not est_valide) as rejetes,
        count(*) filter (where est_valide and not est_remplace) as retenus,
        count(*) filter (where est_valide and not geocodage_fiable) as geocodage_non_fiable from prep)
"""


@query("reject_reasons", ITEMS + "select item, shipped, size, use, motif_rejet, est_valide from prep")
def reasons(spark, sf):
    return prepared(spark, sf).select("item", "shipped", "size", "use", "motif_rejet", "est_valide")


@query(
    "reject_reasons_strict_label",
    items_sql("label = 'R' or label is null") + "select item, size, use, motif_rejet from prep",
)
def strict_reasons(spark, sf):
    return prepared(spark, sf, "reject").select("item", "size", "use", "motif_rejet")


@query(
    "reject_histogram",
    ITEMS + "select motif_rejet, count(*) as n from prep where motif_rejet is not null group by motif_rejet",
)
def histogram(spark, sf):
    return reject_histogram(prepared(spark, sf))


@query("run_counters", ITEMS + ", " + COUNTERS + "select * from counters")
def counters(spark, sf):
    return run_counters(prepared(spark, sf))


def long_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics_of(tally(prepared(spark, sf)))


METRICS = ITEMS + ", " + COUNTERS + """,
    metrics as (
        unpivot (select apres_deduplication as lignes_bronze, * from counters) on columns(*) into name metrique value valeur
        union all select 'motif_' || motif_rejet, count(*) from prep where motif_rejet is not null group by motif_rejet)
"""


@query("metrics_long", METRICS + "select metrique, valeur from metrics")
def metrics_long(spark, sf):
    return long_metrics(spark, sf)


@query(
    "metrics_share",
    METRICS + f""", w as (select max(valeur) as total from metrics where metrique = 'lignes_bronze')
    select metrique, valeur, printf('%.2f', {sql_rate('valeur', 'total')}) || '%' as part from metrics, w
    """,
)
def metrics_share(spark, sf):
    return with_share(long_metrics(spark, sf))


@query(
    "current_rows",
    ITEMS + "select item, label, shipped, place, size, use from prep where est_valide and not est_remplace",
)
def current_rows(spark, sf):
    return current(prepared(spark, sf)).select("item", "label", "shipped", "place", "size", "use")


@query(
    "reject_rows",
    ITEMS + """
    select item, shipped, case when est_remplace then 'remplace_par_dpe_recent' else motif_rejet end as motif_rejet
    from prep where not est_valide or est_remplace
    """,
)
def rejected(spark, sf):
    return reject_rows(prepared(spark, sf), ["item", "shipped"])


@query(
    "disjoint_split",
    ITEMS + """
    select est_valide and not est_remplace as kept, count(*) as n_rows from prep group by 1
    """,
)
def disjoint(spark, sf):
    kept, dropped = split(prepared(spark, sf))
    return kept.select(F.lit(True).alias("kept")).unionAll(dropped.select(F.lit(False).alias("kept"))).groupBy(
        "kept"
    ).agg(F.count(F.lit(1)).alias("n_rows"))
