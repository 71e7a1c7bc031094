"""The certificate medallion itself, on text rows derived from the shared tables.

Every line item, with its order and customer, is rendered as one bronze certificate:
all text, with padded and missing keys, unreadable dates, numbers with units wrong,
unknown labels and unusable place codes.  The plans then run as they would on a lake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.catalog.base import plain, query, sql_located, sql_rate, sql_round, table
from lamina.functions import fixed
from lamina.operators import analysis
from lamina.operators.checks import run_checks
from lamina.operators.geo import reproject
from lamina.operators.marts import rollup_rate, top_k
from lamina.plans import gold, silver
from lamina.plans.contracts import fact_contracts, mart_contracts
from lamina.plans.reference import builtin_reference
from lamina.sources.shared import materialise

AS_OF = "2008-06-15"


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders, customers = (table(spark, sf, n) for n in ("lineitem", "orders", "customer"))
    # Customers meet the orders first: where they are too many to broadcast, only orders move for them, not line items.
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
    # Both sides grow with the data, so neither may be broadcast however small it is in a test.
    rows = lines.join(placed.hint("merge"), lines.l_orderkey == orders.o_orderkey)
    return rows.selectExpr(
        "concat(if(l_orderkey % 211 = 0, ' ', ''), l_orderkey, '-', l_linenumber) as numero_dpe",
        """case when (l_orderkey * 7 + l_linenumber) % 12 = 0 then concat(l_orderkey - 1, '-', l_linenumber)
                when l_orderkey % 500 = 0 then concat(l_orderkey, '-', l_linenumber) else '' end
                as numero_dpe_remplace""",
        "if(l_partkey % 89 = 0, 'non renseigné', cast(cast(o_orderdate as date) as string)) as date_etablissement_dpe",
        "cast(date_add(cast(o_orderdate as date), cast(l_suppkey % 30 as int)) as string) as date_reception_dpe",
        """if(l_partkey % 83 = 0, '', concat(' ', cast(cast(l_shipdate as date) as string), ' '))
                as date_derniere_modification_dpe""",
        "cast(add_months(o_orderdate, 120) as string) as date_fin_validite_dpe",
        """case when l_partkey % 101 = 0 then 'Z' when l_partkey % 103 = 0 then null
                else substr('ABCDEFG', cast(l_quantity as int) % 7 + 1, 1) end as etiquette_dpe""",
        "if(l_partkey % 59 = 0, null, substr('ABCDEFG', l_linenumber % 7 + 1, 1)) as etiquette_ges",
        f"""case when c_custkey % 301 = 0 then ' ' when c_custkey % 97 = 0 then 'RENNES'
                else concat(if(c_custkey % 50 = 0, 'old', ''), {AREA}, lpad(c_custkey % 40, 3, '0')) end
                as code_insee_ban""",
        "concat('VILLE ', c_mktsegment) as nom_commune_ban",
        f"if(c_custkey % 17 = 0, null, {AREA}) as code_departement_ban",
        "lpad(c_nationkey % 5 + 1, 2, '0') as code_region_ban",
        """if(l_partkey % 71 = 0, null, cast(300000 + c_custkey * 7919 % 600000 + l_suppkey as string))
                as coordonnee_cartographique_x_ban""",
        "cast(6200000 + c_custkey * 104729 % 700000 + l_linenumber * 10 as string) as coordonnee_cartographique_y_ban",
        """case l_suppkey % 4 when 0 then "adresse géocodée ban à l'adresse" when 1 then ' Adresse Géocodée ban à la rue'
                when 2 then 'adresse non géocodée ban car aucune correspondance' end as statut_geocodage""",
        "concat('0.', lpad(l_partkey % 100, 2, '0')) as score_ban",
        """case when l_partkey % 53 = 0 then null when l_linestatus = 'F' then 'maison' else 'appartement' end
                as type_batiment""",
        "if(l_partkey % 47 = 0, '', concat(1900 + l_partkey % 125, if(l_partkey % 2 = 0, '.0', ''))) as annee_construction",
        """case when l_partkey % 97 = 0 then '5000' when l_partkey % 91 = 0 then '0'
                else cast(l_quantity * 2.5 + l_partkey % 40 as string) end as surface_habitable_logement""",
        """case when l_partkey % 107 = 0 then '35000' when l_partkey % 109 = 0 then '-1'
                else concat(l_partkey * 37 % 600, '.', l_suppkey % 10) end as conso_5_usages_par_m2_ep""",
        "concat(l_partkey * 29 % 500, '.5') as conso_5_usages_par_m2_ef",
        "if(l_partkey % 61 = 0, 'n/a', cast(l_partkey * 7 % 90 as string)) as emission_ges_5_usages_par_m2",
        "cast(300 + l_partkey * 13 % 4000 as string) as cout_total_5_usages",
        "cast(200 + l_partkey * 11 % 3000 as string) as cout_chauffage",
        "cast(l_partkey * 3 % 500 as string) as cout_ecs",
        "concat('energie ', l_partkey % 5) as type_energie_principale_chauffage",
        "concat('energie ', l_partkey % 3) as type_energie_principale_ecs",
        "concat('ventilation ', l_suppkey % 3) as type_ventilation",
        "concat('isolation ', l_suppkey % 4) as qualite_isolation_enveloppe",
        "'0.5' as ubat_w_par_m2_k",
        "concat_ws('/', l_partkey, l_suppkey, cast(l_quantity as int)) as identifiant_ban",
    )


AREA = "case c_nationkey when 3 then '2A' when 4 then '97' else lpad(cast(c_nationkey + 1 as string), 2, '0') end"


# What the rules, the dimensions and the marts read of a bronze row.
MART_SOURCES = [
    "numero_dpe", "numero_dpe_remplace", "date_etablissement_dpe", "date_reception_dpe",
    "date_derniere_modification_dpe", "date_fin_validite_dpe", "identifiant_ban", "etiquette_dpe", "etiquette_ges",
    "code_insee_ban", "nom_commune_ban", "code_departement_ban", "code_region_ban",
    "coordonnee_cartographique_x_ban", "coordonnee_cartographique_y_ban", "statut_geocodage", "score_ban",
    "type_batiment", "annee_construction", "surface_habitable_logement", "conso_5_usages_par_m2_ep",
    "emission_ges_5_usages_par_m2", "cout_total_5_usages", "cout_chauffage",
]


# What dedup, supersession and the rules read of a bronze row.
RULE_SOURCES = [
    "numero_dpe", "numero_dpe_remplace", "date_etablissement_dpe", "date_reception_dpe",
    "date_derniere_modification_dpe", "identifiant_ban", "etiquette_dpe", "code_insee_ban",
    "surface_habitable_logement", "conso_5_usages_par_m2_ep",
]
# What the flags and bands read besides; null in queries that return none of what follows from it.
FLAG_SOURCES = ["date_fin_validite_dpe", "statut_geocodage", "score_ban", "annee_construction"]
PROFILE_SOURCES = [*RULE_SOURCES, "annee_construction", "type_batiment", "emission_ges_5_usages_par_m2", "cout_total_5_usages"]
STAR_SOURCES = [c for c in MART_SOURCES if c not in {"date_fin_validite_dpe", "cout_chauffage"}]


# What the rules and the facts read of a bronze row.
FACT_SOURCES = [
    *[c for c in MART_SOURCES if c not in {
        "nom_commune_ban", "code_departement_ban", "code_region_ban",
        "coordonnee_cartographique_x_ban", "coordonnee_cartographique_y_ban",
    }],
    "conso_5_usages_par_m2_ef", "cout_ecs", "type_energie_principale_chauffage", "type_energie_principale_ecs",
    "type_ventilation", "qualite_isolation_enveloppe", "ubat_w_par_m2_k",
]


def prepared(spark: SparkSession, sf: str, columns: list[str] | None = None) -> DataFrame:
    order = [
        F.desc_nulls_last("date_derniere_modification_dpe"),
        F.desc_nulls_last("date_reception_dpe"),
        F.asc("identifiant_ban"),
    ]
    rows = bronze(spark, sf)
    if columns is not None:
        unread = [F.lit(None).cast("string").alias(c) for c in FLAG_SOURCES if c not in columns]
        rows = rows.select(*columns, *unread)
    return silver.prepare(rows, F.lit(AS_OF).cast("date"), order=order, n_rows=table(spark, sf, "lineitem").count())


def staged(spark: SparkSession, sf: str, columns: list[str] | None = None) -> DataFrame:
    """Warehouse slice under its warehouse names; columns no line item has are null."""
    wide = silver.current_rows(prepared(spark, sf, columns))
    missing = [c for c in fixed.WAREHOUSE_COLUMNS if c not in wide.columns]
    return gold.staging(wide.withColumns({c: F.lit(None).cast("string") for c in missing}))


PREPARED = f"""
    with typed as (
        select case when l_orderkey % 211 = 0 then ' ' else '' end || l_orderkey || '-' || l_linenumber as numero,
            case when (l_orderkey * 7 + l_linenumber) % 12 = 0 then (l_orderkey - 1) || '-' || l_linenumber
                 when l_orderkey % 500 = 0 then l_orderkey || '-' || l_linenumber end as remplace,
            case when l_partkey % 89 <> 0 then cast(o_orderdate as date) end as etabli,
            cast(o_orderdate + to_days(cast(l_suppkey % 30 as integer)) as date) as recu,
            case when l_partkey % 83 <> 0 then cast(l_shipdate as date) end as modifie,
            cast(o_orderdate + interval 120 months as date) as fin,
            case when l_partkey % 101 = 0 then 'Z' when l_partkey % 103 = 0 then null
                 else substr('ABCDEFG', cast(l_quantity as integer) % 7 + 1, 1) end as etiquette_dpe,
            case when l_partkey % 59 <> 0 then substr('ABCDEFG', l_linenumber % 7 + 1, 1) end as etiquette_ges,
            case when c_custkey % 301 = 0 then ' ' when c_custkey % 97 = 0 then 'RENNES'
                 else case when c_custkey % 50 = 0 then 'old' else '' end || area
                    || lpad(cast(c_custkey % 40 as varchar), 3, '0') end as code_commune,
            'VILLE ' || c_mktsegment as nom_commune,
            case when c_custkey % 17 <> 0 then area end as code_departement,
            lpad(cast(c_nationkey % 5 + 1 as varchar), 2, '0') as code_region,
            case when l_partkey % 71 <> 0 then 300000 + c_custkey * 7919 % 600000 + l_suppkey end as x,
            6200000 + c_custkey * 104729 % 700000 + l_linenumber * 10 as y,
            l_suppkey % 4 in (0, 1) as fiable, l_suppkey % 4 in (0, 1) and l_partkey % 100 >= 64 as precis,
            case when l_partkey % 53 = 0 then null when l_linestatus = 'F' then 'maison' else 'appartement' end as type_batiment,
            case when l_partkey % 47 <> 0 then cast(1900 + l_partkey % 125 as integer) end as construit,
            case when l_partkey % 97 = 0 then 5000 when l_partkey % 91 = 0 then 0
                 else cast(l_quantity * 2.5 + l_partkey % 40 as double) end as surface,
            case when l_partkey % 107 = 0 then 35000 when l_partkey % 109 = 0 then -1
                 else cast((l_partkey * 37 % 600) || '.' || (l_suppkey % 10) as double) end as ep,
            cast(l_partkey * 29 % 500 + 0.5 as double) as ef,
            case when l_partkey % 61 <> 0 then cast(l_partkey * 7 % 90 as double) end as ges,
            cast(300 + l_partkey * 13 % 4000 as double) as cout,
            cast(200 + l_partkey * 11 % 3000 as double) as cout_chauffage,
            cast(l_partkey * 3 % 500 as double) as cout_ecs,
            'energie ' || (l_partkey % 5) as energie_chauffage, 'energie ' || (l_partkey % 3) as energie_ecs,
            'ventilation ' || (l_suppkey % 3) as type_ventilation, 'isolation ' || (l_suppkey % 4) as qualite_isolation_enveloppe,
            l_partkey || '/' || l_suppkey || '/' || cast(l_quantity as integer) as ident
        from lineitem join orders on l_orderkey = o_orderkey
        join (select *, case c_nationkey when 3 then '2A' when 4 then '97'
            else lpad(cast(c_nationkey + 1 as varchar), 2, '0') end as area from customer) on o_custkey = c_custkey),
    once as (select * from (select *, row_number() over (partition by numero
        order by modifie desc nulls last, recu desc nulls last, ident) as rn from typed) where rn = 1),
    refs as (select distinct remplace as ref from once where remplace is not null),
    prep as (select *, motif_rejet is null as est_valide,
            etiquette_dpe in ('F', 'G') as est_passoire_thermique, etiquette_dpe in ('A', 'B') as est_performant,
            cast(year(etabli) as integer) as annee_etablissement, cast(month(etabli) as integer) as mois_etablissement,
            case when surface < 30 then 'moins de 30 m2' when surface < 60 then '30 a 60 m2'
                 when surface < 90 then '60 a 90 m2' when surface < 130 then '90 a 130 m2' else '130 m2 et plus' end as tranche_surface,
            case when construit is null then 'inconnue' when construit < 1948 then 'avant 1948' when construit < 1975 then '1948-1974'
                 when construit < 1989 then '1975-1988' when construit < 2001 then '1989-2000'
                 when construit < 2013 then '2001-2012' else '2013 et apres' end as tranche_age_batiment,
            fin >= date '{AS_OF}' as encore_valide
        from (select once.*, ref is not null as est_remplace,
            case when etiquette_dpe = 'Z' then 'etiquette_dpe_invalide'
                 when etabli is null then 'date_etablissement_absente' when trim(code_commune) = '' then 'commune_absente'
                 when surface <= 0 then 'surface_invalide' when surface > 1000 then 'surface_aberrante'
                 when ep < 0 then 'consommation_invalide' when ep > 2000 then 'consommation_aberrante' end as motif_rejet
            from once left join refs on trim(numero) = ref)),
    cur as (select * from prep where est_valide and not est_remplace)
"""


@query(
    "certificates_prepared",
    PREPARED + """
    select numero as numero_dpe, etabli as date_etablissement_dpe, modifie as date_derniere_modification_dpe,
        etiquette_dpe, surface as surface_habitable_logement, ep as conso_5_usages_par_m2_ep,
        construit as annee_construction, est_remplace, motif_rejet, est_valide, fiable as geocodage_fiable,
        precis as geocodage_precis, est_passoire_thermique, est_performant, annee_etablissement,
        mois_etablissement, tranche_surface, tranche_age_batiment, encore_valide as dpe_encore_valide from prep
    """,
)
def certificates_prepared(spark, sf):
    return prepared(spark, sf, MART_SOURCES).select(
        "numero_dpe", "date_etablissement_dpe", "date_derniere_modification_dpe", "etiquette_dpe",
        "surface_habitable_logement", "conso_5_usages_par_m2_ep", "annee_construction", "est_remplace",
        "motif_rejet", "est_valide", "geocodage_fiable", "geocodage_precis", "est_passoire_thermique",
        "est_performant", "annee_etablissement", "mois_etablissement", "tranche_surface",
        "tranche_age_batiment", "dpe_encore_valide",
    )


@query(
    "certificates_rejected",
    PREPARED + """
    select numero as numero_dpe, etabli as date_etablissement_dpe, code_region as code_region_ban, annee_etablissement,
        case when est_remplace then 'remplace_par_dpe_recent' else motif_rejet end as motif_rejet
    from prep where not est_valide or est_remplace
    """,
)
def certificates_rejected(spark, sf):
    return silver.rejected_rows(prepared(spark, sf, [*RULE_SOURCES, "code_region_ban"]))


@query(
    "certificates_metrics",
    PREPARED + """
    select 'lignes_bronze' as metrique, count(*) as valeur from typed
    union all select 'apres_deduplication', count(*) from prep
    union all select 'remplaces', count(*) from prep where est_remplace
    union all select 'rejetes', count(*) from prep where not est_valide
    union all select 'retenus', count(*) from cur
    union all select 'geocodage_non_fiable', count(*) from prep where est_valide and not fiable
    union all select 'motif_' || motif_rejet, count(*) from prep where motif_rejet is not null group by motif_rejet
    """,
)
def certificates_metrics(spark, sf):
    return silver.metrics(bronze(spark, sf), prepared(spark, sf, [*RULE_SOURCES, "statut_geocodage"]))


@query(
    "certificates_fact",
    PREPARED + f"""
    select numero as cle_dpe, code_commune, annee_etablissement, mois_etablissement, etabli as date_etablissement,
        etiquette_dpe, etiquette_ges, type_batiment, tranche_age_batiment, tranche_surface, energie_chauffage,
        energie_ecs, type_ventilation, qualite_isolation_enveloppe, est_passoire_thermique, est_performant,
        encore_valide as dpe_encore_valide, fiable as geocodage_fiable, surface as surface_m2,
        ep as conso_ep_kwh_m2_an, ef as conso_ef_kwh_m2_an, ges as emission_ges_kg_m2_an,
        cast(0.5 as double) as coefficient_ubat, cout as cout_annuel_total_eur,
        cout_chauffage as cout_annuel_chauffage_eur, cout_ecs as cout_annuel_ecs_eur,
        {sql_round('surface * ep', 0)} as conso_ep_totale_kwh_an, construit as annee_construction
    from cur
    """,
)
def certificates_fact(spark, sf):
    return plain(gold.fact(staged(spark, sf, FACT_SOURCES)))


DIMENSION = PREPARED + """
    , named as (select code_commune, nom_commune, code_departement, code_region, row_number() over (
            partition by code_commune order by count(*) desc, nom_commune nulls last, code_departement nulls last,
            code_region nulls last) as rn
        from cur group by code_commune, nom_commune, code_departement, code_region)
    , points as (select code_commune, avg(x) as cx, avg(y) as cy, count(*) as n from cur
        where precis and x is not null group by code_commune)
    , repaired as (select *, case when code_commune like 'old%' then substr(code_commune, 4) else code_commune end as r
        from named where rn = 1)
    , dim as (select r.code_commune, nom_commune, coalesce(code_departement, case
            when r.r[1] = '9' and r.r[2] in ('7', '8') then r.r[1:3] when r.r[1:2] in ('2A', '2B') then r.r[1:2]
            when r.r <> 'RENNES' and r.r[1:2] not in ('20', '00', '96') then r.r[1:2] end) as code_departement,
        code_region, cx, cy, coalesce(n, 0) as n_points
        from repaired r left join points using (code_commune))
"""


def rounded_points(df: DataFrame, x: str = gold.X, y: str = gold.Y) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("decimal(20,6)"), 3).cast("double") for c in (x, y)})


@query(
    "certificates_dim_commune",
    DIMENSION + f"""
    select code_commune, nom_commune, code_departement, code_region, {sql_round('cx', 3)} as centroide_x_lambert93,
        {sql_round('cy', 3)} as centroide_y_lambert93, n_points as nb_points_geocodes_precis from dim
    """,
)
def certificates_dim(spark, sf):
    return rounded_points(gold.dim_commune(staged(spark, sf, MART_SOURCES)))


COUNTS = """
    count(*) as nb_dpe, count(*) filter (where est_passoire_thermique) as nb_passoires,
    count(*) filter (where est_performant) as nb_logements_performants
"""
LABEL_COUNTS = ", ".join(
    f"count(*) filter (where etiquette_dpe = '{label}') as nb_etiquette_{label.lower()}" for label in fixed.LABELS
)
MEANS = f"""
    {sql_round('avg(ep)', 1)} as conso_ep_moyenne, {sql_round('avg(ges)', 1)} as emission_ges_moyenne,
    {sql_round('avg(surface)', 1)} as surface_moyenne_m2, {sql_round('avg(cout)', 0)} as cout_annuel_moyen_eur
"""
MEDIAN = f"{sql_round('quantile_cont(ep, 0.5)', 1)} as conso_ep_mediane"
RATES = f"""
    {sql_rate('nb_passoires', 'nb_dpe')} as taux_passoires_pct,
    {sql_rate('nb_logements_performants', 'nb_dpe')} as taux_performants_pct
"""
PER_M2 = """
    case when surface_moyenne_m2 <> 0 then cast((200 * cast(cout_annuel_moyen_eur as hugeint)
        + cast(round(surface_moyenne_m2 * 10) as hugeint)) // (2 * cast(round(surface_moyenne_m2 * 10) as hugeint)) as double)
        / 10.0 end as cout_annuel_par_m2_eur
"""


# What the dimension, the marts and the fact contracts read of the slice.
STAR_COLUMNS = [
    "cle_dpe", "code_commune", "nom_commune", "code_departement", "code_region", "coord_x_lambert93",
    "coord_y_lambert93", "geocodage_precis", "annee_etablissement", "type_batiment", "tranche_age_batiment",
    "etiquette_dpe", "etiquette_ges", "est_passoire_thermique", "est_performant", "surface_m2",
    "conso_ep_kwh_m2_an", "emission_ges_kg_m2_an", "cout_annuel_total_eur",
]


def stars(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Facts and dimension, each read back from files as the marts find them."""
    facts = materialise(staged(spark, sf, STAR_SOURCES).select(*STAR_COLUMNS), "facts")
    return facts, materialise(gold.dim_commune(facts), "dim")


@query(
    "certificates_mart_commune",
    DIMENSION + f"""
    , a as (select code_commune, annee_etablissement, {COUNTS}, {LABEL_COUNTS}, {MEANS}, {MEDIAN} from cur
        group by code_commune, annee_etablissement)
    select a.*, {RATES}, nom_commune, code_departement, code_region, {sql_round('cx', 3)} as centroide_x_lambert93,
        {sql_round('cy', 3)} as centroide_y_lambert93 from a left join dim using (code_commune)
    """,
)
def certificates_mart_commune(spark, sf):
    return plain(rounded_points(gold.mart_commune(*stars(spark, sf))))


AREA_NAMES = """
    , ref(code_departement, nom_departement, nom_region, est_metropole) as (values
        ('01', 'Ain', 'Auvergne-Rhône-Alpes', true), ('02', 'Aisne', 'Hauts-de-France', true),
        ('03', 'Allier', 'Auvergne-Rhône-Alpes', true), ('06', 'Alpes-Maritimes', 'Provence-Alpes-Côte d''Azur', true),
        ('07', 'Ardèche', 'Auvergne-Rhône-Alpes', true), ('08', 'Ardennes', 'Grand Est', true),
        ('09', 'Ariège', 'Occitanie', true), ('10', 'Aube', 'Grand Est', true), ('11', 'Aude', 'Occitanie', true),
        ('12', 'Aveyron', 'Occitanie', true), ('13', 'Bouches-du-Rhône', 'Provence-Alpes-Côte d''Azur', true),
        ('14', 'Calvados', 'Normandie', true), ('15', 'Cantal', 'Auvergne-Rhône-Alpes', true),
        ('16', 'Charente', 'Nouvelle-Aquitaine', true), ('17', 'Charente-Maritime', 'Nouvelle-Aquitaine', true),
        ('18', 'Cher', 'Centre-Val de Loire', true), ('19', 'Corrèze', 'Nouvelle-Aquitaine', true),
        ('21', 'Côte-d''Or', 'Bourgogne-Franche-Comté', true), ('22', 'Côtes-d''Armor', 'Bretagne', true),
        ('23', 'Creuse', 'Nouvelle-Aquitaine', true), ('24', 'Dordogne', 'Nouvelle-Aquitaine', true),
        ('25', 'Doubs', 'Bourgogne-Franche-Comté', true), ('2A', 'Corse-du-Sud', 'Corse', true))
"""
DEPARTMENT = DIMENSION + AREA_NAMES + f"""
    , ctr as (select code_departement, count(*) as nb_communes, {sql_round('avg(cx)', 3)} as centroide_x_lambert93,
        {sql_round('avg(cy)', 3)} as centroide_y_lambert93 from dim where cx is not null group by code_departement)
    , b as (select dim.code_departement, min(annee_etablissement) as annee_min, max(annee_etablissement) as annee_max,
            {COUNTS}, {LABEL_COUNTS}, count(*) filter (where type_batiment = 'maison') as nb_maisons,
            count(*) filter (where type_batiment = 'appartement') as nb_appartements, {MEANS}, {MEDIAN}
        from cur join dim using (code_commune) group by dim.code_departement)
    , dept as (select b.*, {RATES}, {sql_rate('nb_maisons', 'nb_dpe')} as part_maisons_pct, {PER_M2}, nb_communes,
            centroide_x_lambert93, centroide_y_lambert93, nom_region, coalesce(est_metropole, false) as est_metropole,
            case when nom_departement is not null then nom_departement
                 when b.code_departement is not null then 'Inconnu (' || b.code_departement || ')'
                 else 'Département non déterminé' end as nom_departement
        from b left join ctr using (code_departement) left join ref using (code_departement))
"""


def department(spark: SparkSession, sf: str) -> DataFrame:
    return gold.mart_departement(*stars(spark, sf), builtin_reference(spark))


@query("certificates_mart_departement", DEPARTMENT + "select * from dept")
def certificates_mart_departement(spark, sf):
    return plain(rounded_points(department(spark, sf)))


PROFILE = PREPARED + f"""
    , a as (select type_batiment, tranche_age_batiment, {COUNTS}, {MEANS} from cur
        where type_batiment is not null group by type_batiment, tranche_age_batiment)
    , profile as (select a.*, {RATES}, {PER_M2},
        case tranche_age_batiment when '2013 et apres' then '2013 et après' when 'inconnue' then 'Période inconnue'
            else tranche_age_batiment end as periode_construction,
        cast(case tranche_age_batiment when 'avant 1948' then 1 when '1948-1974' then 2 when '1975-1988' then 3
            when '1989-2000' then 4 when '2001-2012' then 5 when '2013 et apres' then 6 else 99 end as integer) as ordre_periode
        from a)
"""


def profile(spark: SparkSession, sf: str) -> DataFrame:
    return gold.mart_profil(gold.fact(staged(spark, sf, PROFILE_SOURCES)))


@query("certificates_mart_profil", PROFILE + "select * from profile")
def certificates_mart_profil(spark, sf):
    return plain(profile(spark, sf).orderBy("type_batiment", "ordre_periode"))


# --- the published questions over the marts ----------------------------------


@query(
    "certificates_map",
    DEPARTMENT
    + "select code_departement, nb_dpe, taux_passoires_pct, latitude, longitude from "
    + sql_located("dept", "*", "centroide_x_lambert93", "centroide_y_lambert93")
    + "where est_metropole order by taux_passoires_pct desc, code_departement limit 15",
)
def certificates_map(spark, sf):
    placed = reproject(rounded_points(department(spark, sf))).filter("est_metropole")
    best = top_k(placed, "taux_passoires_pct", 15, ["code_departement"])
    return plain(best.select("code_departement", "nb_dpe", "taux_passoires_pct", "latitude", "longitude"))


@query(
    "certificates_national_totals",
    DEPARTMENT + """
    select cast(sum(nb_dpe) as bigint) as nb_dpe, cast(sum(nb_passoires) as bigint) as nb_passoires
    from dept where est_metropole
    """,
)
def certificates_totals(spark, sf):
    return analysis.filtered_totals(department(spark, sf), F.col("est_metropole"), ["nb_dpe", "nb_passoires"])


@query(
    "certificates_house_correlation",
    DEPARTMENT + "select round(corr(part_maisons_pct, taux_passoires_pct), 4) as r from dept where est_metropole",
)
def certificates_correlation(spark, sf):
    mart = department(spark, sf).filter("est_metropole")
    return analysis.rate_correlation(mart, "part_maisons_pct", "taux_passoires_pct")


def rate_sql(key: str, where: str = "true") -> str:
    return PROFILE + f"""
        , s as (select {key}, cast(sum(nb_passoires) as bigint) as nb_passoires, cast(sum(nb_dpe) as bigint) as nb_dpe
            from profile where {where} group by {key})
        select *, {sql_rate('nb_passoires', 'nb_dpe')} as taux_passoires_pct from s
    """


@query("certificates_rate_by_type", rate_sql("type_batiment"))
def certificates_rate_by_type(spark, sf):
    rows = profile(spark, sf)
    return plain(rollup_rate(rows, ["type_batiment"], "nb_passoires", "nb_dpe", "taux_passoires_pct"))


@query("certificates_rate_by_age", rate_sql("periode_construction"))
def certificates_rate_by_age(spark, sf):
    rows = profile(spark, sf)
    return plain(rollup_rate(rows, ["periode_construction"], "nb_passoires", "nb_dpe", "taux_passoires_pct"))


@query(
    "certificates_new_houses",
    PROFILE + f"""
    , s as (select type_batiment, cast(sum(nb_logements_performants) as bigint) as nb_logements_performants,
            cast(sum(nb_dpe) as bigint) as nb_dpe
        from profile where type_batiment = 'maison' and tranche_age_batiment = '2013 et apres' group by type_batiment)
    select *, {sql_rate('nb_logements_performants', 'nb_dpe')} as taux_performants_pct from s
    """,
)
def certificates_new_houses(spark, sf):
    new = profile(spark, sf).filter("type_batiment = 'maison' and tranche_age_batiment = '2013 et apres'")
    return plain(
        rollup_rate(new, ["type_batiment"], "nb_logements_performants", "nb_dpe", "taux_performants_pct")
    )


@query(
    "certificates_heating_cost",
    PREPARED + f"""
    select etiquette_dpe, {sql_round('sum(cout_chauffage) / sum(surface)', 1)} as cout_par_m2 from cur group by etiquette_dpe
    """,
)
def certificates_heating_cost(spark, sf):
    facts = gold.fact(staged(spark, sf, [*RULE_SOURCES, "cout_chauffage"]))
    return plain(analysis.cost_per_size(facts, "etiquette_dpe", "cout_annuel_chauffage_eur", "surface_m2"))


@query(
    "certificates_extreme_ratio",
    DEPARTMENT + """
    , e as (select cast(round(max(taux_passoires_pct) * 100) as hugeint) as h,
        cast(round(min(taux_passoires_pct) * 100) as hugeint) as l from dept where est_metropole)
    select h / 100.0 as highest, l / 100.0 as lowest,
        case when l <> 0 then cast((200 * h + l) // (2 * l) as double) / 100.0 end as factor from e
    """,
)
def certificates_extremes(spark, sf):
    mart = department(spark, sf).filter("est_metropole")
    return plain(analysis.extreme_ratio(mart, "taux_passoires_pct"))


@query(
    "certificates_anomalies",
    PREPARED + """
    select count(*) as n_rows, min(surface) as smallest, max(surface) as largest from cur
    where etiquette_dpe = 'A' and ep > 100 and surface < 40
    """,
)
def certificates_anomalies(spark, sf):
    facts = gold.fact(staged(spark, sf, RULE_SOURCES))
    return analysis.label_anomalies(facts, "etiquette_dpe", "conso_ep_kwh_m2_an", "surface_m2")


@query(
    "certificates_contracts",
    DEPARTMENT + """
    , checks("check", column_name, severity, violations) as (
        select 'expression_is_true', 'not (etiquette_dpe = ''A'' and conso_ep_kwh_m2_an > 100)', 'error',
            count(*) filter (where surface >= 40 and etiquette_dpe = 'A' and ep > 100) from cur
        union all select 'unique', 'cle_dpe', 'warn', count(*) from (select numero from cur group by numero having count(*) > 1)
        union all select 'not_null', 'cle_dpe', 'error', count(*) filter (where numero is null) from cur
        union all select 'not_null', 'code_commune', 'error', count(*) filter (where code_commune is null) from cur
        union all select 'relationships', 'code_commune', 'error', count(*) from cur
            where code_commune not in (select code_commune from dim)
        union all select 'not_null', 'etiquette_dpe', 'error', count(*) filter (where etiquette_dpe is null) from cur
        union all select 'accepted_values', 'etiquette_dpe', 'error',
            count(*) filter (where etiquette_dpe not in ('A','B','C','D','E','F','G')) from cur
        union all select 'accepted_values', 'etiquette_ges', 'warn',
            count(*) filter (where etiquette_ges not in ('A','B','C','D','E','F','G')) from cur
        union all select 'not_null', 'surface_m2', 'error', count(*) filter (where surface is null) from cur
        union all select 'accepted_range', 'surface_m2', 'error',
            count(*) filter (where surface not between 0 and 1000) from cur
        union all select 'accepted_range', 'conso_ep_kwh_m2_an', 'error',
            count(*) filter (where ep not between 0 and 2000) from cur
        union all select 'not_null', 'est_passoire_thermique', 'error',
            count(*) filter (where est_passoire_thermique is null) from cur)
    select *, 'fct_dpe' as table_name, case when violations = 0 then 'pass' else severity end as status from checks
    """,
)
def certificates_contracts(spark, sf):
    facts, communes = stars(spark, sf)
    tables = {"fct_dpe": facts, "dim_commune": communes}
    return run_checks({"fct_dpe": facts}, fact_contracts(tables))


@query(
    "certificates_mart_contracts",
    DEPARTMENT + PROFILE.replace(PREPARED, "") .replace(", a as (select type_batiment", ", pa as (select type_batiment")
    .replace("select a.*", "select pa.*").replace("from a)", "from pa)") + f"""
    , com as (select code_commune, annee_etablissement, nb_dpe, {sql_rate('nb_passoires', 'nb_dpe')} as taux_passoires_pct from (
        select code_commune, annee_etablissement, {COUNTS} from cur group by code_commune, annee_etablissement))
    select table_name, status, count(*) as n_checks, cast(sum(violations) as bigint) as violations from (
        select t as table_name, case when v = 0 then 'pass' else 'error' end as status, v as violations from (
            select 'mart_performance_commune' as t, unnest([
                (select count(*) filter (where code_commune is null) from com),
                (select count(*) filter (where taux_passoires_pct not between 0 and 100) from com),
                (select count(*) filter (where nb_dpe is null) from com)]) as v
            union all select 'mart_performance_departement', unnest([
                (select count(*) - count(distinct coalesce(code_departement, '?')) from dept),
                (select count(*) filter (where nb_etiquette_a + nb_etiquette_b + nb_etiquette_c + nb_etiquette_d
                    + nb_etiquette_e + nb_etiquette_f + nb_etiquette_g <> nb_dpe) from dept),
                (select count(*) filter (where nb_etiquette_f + nb_etiquette_g <> nb_passoires) from dept),
                (select count(*) filter (where nb_etiquette_a + nb_etiquette_b <> nb_logements_performants) from dept),
                (select count(*) from (select code_departement from dept where code_departement is not null
                    group by code_departement having count(*) > 1)),
                (select count(*) filter (where nom_departement is null) from dept),
                (select count(*) filter (where est_metropole is null) from dept),
                (select count(*) filter (where taux_passoires_pct is null) from dept),
                (select count(*) filter (where taux_passoires_pct not between 0 and 100) from dept),
                (select count(*) filter (where taux_performants_pct not between 0 and 100) from dept),
                (select count(*) filter (where nb_dpe is null) from dept)])
            union all select 'mart_profil_batiment', unnest([
                (select count(*) from (select 1 from profile group by type_batiment, tranche_age_batiment having count(*) > 1)),
                (select count(*) filter (where type_batiment is null) from profile),
                (select count(*) filter (where type_batiment not in ('maison', 'appartement')) from profile),
                (select count(*) filter (where tranche_age_batiment is null) from profile),
                (select count(*) filter (where taux_passoires_pct not between 0 and 100) from profile),
                (select count(*) filter (where nb_dpe is null) from profile)])))
    group by table_name, status
    """,
)
def certificates_mart_contracts(spark, sf):
    facts, communes = stars(spark, sf)
    tables = {
        "mart_performance_commune": gold.mart_commune(facts, communes),
        "mart_performance_departement": gold.mart_departement(facts, communes, builtin_reference(spark)),
        "mart_profil_batiment": gold.mart_profil(facts),
    }
    tables = {n: materialise(df, n) for n, df in tables.items()}
    summary = run_checks(tables, mart_contracts(tables))
    return summary.groupBy("table_name", "status").agg(
        F.count(F.lit(1)).alias("n_checks"), F.sum("violations").alias("violations")
    )
