"""Silver to gold: staging names, the fact table, the place dimension and the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.functions.bands import display_label, display_rank
from lamina.functions.codes import derive_parent, name_or_unknown
from lamina.functions.measures import product_round, ratio
from lamina.operators.clean import project_present, rename
from lamina.operators.labels import described_points
from lamina.operators.marts import Summary, centres, label_flags, summarise, with_rates

X, Y = "centroide_x_lambert93", "centroide_y_lambert93"

MEANS = {
    "conso_ep_moyenne": ("conso_ep_kwh_m2_an", 1),
    "emission_ges_moyenne": ("emission_ges_kg_m2_an", 1),
    "surface_moyenne_m2": ("surface_m2", 1),
    "cout_annuel_moyen_eur": ("cout_annuel_total_eur", 0),
}
MEDIANS = {"conso_ep_mediane": ("conso_ep_kwh_m2_an", 1)}
RATES = {"taux_passoires_pct": "nb_passoires", "taux_performants_pct": "nb_logements_performants"}


def _flags(by_label: bool) -> dict:
    flags = {
        "nb_passoires": F.col("est_passoire_thermique"),
        "nb_logements_performants": F.col("est_performant"),
    }
    return {**flags, **label_flags("etiquette_dpe", fixed.LABELS, "nb_etiquette_")} if by_label else flags


def staging(silver: DataFrame) -> DataFrame:
    """The warehouse columns under their warehouse names; no other logic."""
    present = project_present(silver, fixed.WAREHOUSE_COLUMNS)
    return rename(present, {n: fixed.WAREHOUSE_NAMES[n] for n in present.columns})


def fact(staged: DataFrame) -> DataFrame:
    """One row per certificate, with its absolute consumption."""
    return staged.select(
        *fixed.FACT_COLUMNS,
        product_round(F.col("surface_m2"), F.col("conso_ep_kwh_m2_an")).alias("conso_ep_totale_kwh_an"),
        "annee_construction",
    )


def dim_commune(staged: DataFrame) -> DataFrame:
    """One row per place: most frequent description, parent code and centroid.

    One pass over the facts: counts and sums per place and description, from which both
    the most frequent description and the centroid follow.
    """
    placed = staged.filter(F.col("code_commune").isNotNull())
    return described_points(
        placed, "code_commune", ["nom_commune", "code_departement", "code_region"],
        "coord_x_lambert93", "coord_y_lambert93", F.col("geocodage_precis"), X, Y, "nb_points",
    ).select(
        "code_commune",
        "nom_commune",
        derive_parent(F.col("code_commune"), F.col("code_departement")).alias("code_departement"),
        "code_region",
        X,
        Y,
        F.coalesce("nb_points", F.lit(0)).alias("nb_points_geocodes_precis"),
    )


def mart_commune(facts: DataFrame, communes: DataFrame) -> DataFrame:
    """Place x year; the dimension joins the aggregate, never the facts."""
    keys = ["code_commune", "annee_etablissement"]
    spec = Summary(flags=_flags(True), means=MEANS, medians=MEDIANS)
    rated = with_rates(summarise(facts, keys, spec), RATES)
    described = communes.select("code_commune", "nom_commune", "code_departement", "code_region", X, Y)
    return rated.join(described, "code_commune", "left")


def mart_departement(facts: DataFrame, communes: DataFrame, reference: DataFrame) -> DataFrame:
    """Parent area, all years; a null code keeps its row and stays without a reference."""
    parents = communes.select("code_commune", "code_departement")
    used = ["code_commune", "annee_etablissement", "etiquette_dpe", "type_batiment", "est_passoire_thermique",
            "est_performant", *[c for c, _ in MEANS.values()]]
    spec = Summary(
        spans={"annee_min": ("min", "annee_etablissement"), "annee_max": ("max", "annee_etablissement")},
        flags={
            **_flags(True),
            "nb_maisons": F.col("type_batiment") == "maison",
            "nb_appartements": F.col("type_batiment") == "appartement",
        },
        means=MEANS,
        medians=MEDIANS,
    )
    counted = summarise(facts.select(*used).join(parents, "code_commune"), ["code_departement"], spec)
    rated = with_rates(counted, {**RATES, "part_maisons_pct": "nb_maisons"}).withColumn(
        "cout_annuel_par_m2_eur", ratio(F.col("cout_annuel_moyen_eur"), F.col("surface_moyenne_m2"))
    )
    middle = centres(communes, "code_departement", X, Y)
    named = rated.join(middle, "code_departement", "left").join(reference, "code_departement", "left")
    named = named.withColumns(
        {
            "nom_departement": name_or_unknown(F.col("nom_departement"), F.col("code_departement")),
            "est_metropole": F.coalesce("est_metropole", F.lit(False)),
        }
    )
    first = ["code_departement", "nom_departement", "nom_region", "est_metropole"]
    last = ["nb_communes", X, Y]
    return named.select(*first, *[c for c in named.columns if c not in first + last], *last)


def mart_profil(facts: DataFrame) -> DataFrame:
    """Building type x construction band, with a display label and a chronological rank."""
    keys = ["type_batiment", "tranche_age_batiment"]
    kept = facts.filter(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
    rated = with_rates(summarise(kept, keys, Summary(flags=_flags(False), means=MEANS)), RATES)
    band = F.col("tranche_age_batiment")
    return rated.withColumns(
        {
            "periode_construction": display_label(band, fixed.AGE_DISPLAY),
            "ordre_periode": display_rank(band, fixed.AGE_LABELS, fixed.UNKNOWN_RANK),
            "cout_annuel_par_m2_eur": ratio(F.col("cout_annuel_moyen_eur"), F.col("surface_moyenne_m2")),
        }
    )
