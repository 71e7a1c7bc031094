"""The declared contracts of the medallion tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from lamina.functions import fixed
from lamina.operators.checks import (
    WARN,
    Contract,
    accepted,
    in_range,
    is_true,
    not_null,
    relationship,
    unique,
    unique_combo,
)

Contracts = list[Contract]


def source_contracts(t: Mapping[str, DataFrame]) -> Contracts:
    return [
        # The source itself publishes a key twice now and then: reported, not blocking.
        unique("dpe_courant", t["dpe_courant"], "numero_dpe", WARN),
        not_null("dpe_courant", "numero_dpe"),
        not_null("dpe_courant", "etiquette_dpe"),
        accepted("dpe_courant", "etiquette_dpe", fixed.LABELS),
        not_null("dpe_courant", "code_insee_ban"),
        not_null("dpe_rejets", "motif_rejet"),
    ]


def fact_contracts(t: Mapping[str, DataFrame]) -> Contracts:
    name = "fct_dpe"
    return [
        # Below 40 m2 fixed uses weigh too much for label and intensity to agree.
        is_true(name, "not (etiquette_dpe = 'A' and conso_ep_kwh_m2_an > 100)", "surface_m2 >= 40"),
        unique(name, t[name], "cle_dpe", WARN),
        not_null(name, "cle_dpe"),
        not_null(name, "code_commune"),
        relationship(name, t[name], t["dim_commune"], "code_commune"),
        not_null(name, "etiquette_dpe"),
        accepted(name, "etiquette_dpe", fixed.LABELS),
        accepted(name, "etiquette_ges", fixed.LABELS, WARN),
        not_null(name, "surface_m2"),
        in_range(name, "surface_m2", 0, fixed.MAX_SIZE),
        in_range(name, "conso_ep_kwh_m2_an", 0, fixed.MAX_USE),
        not_null(name, "est_passoire_thermique"),
    ]


def dimension_contracts(t: Mapping[str, DataFrame]) -> Contracts:
    return [
        unique("dim_commune", t["dim_commune"], "code_commune"),
        not_null("dim_commune", "code_commune"),
        not_null("dim_commune", "nom_commune"),
        unique("ref_departement", t["ref_departement"], "code_departement"),
        not_null("ref_departement", "code_departement"),
        not_null("ref_departement", "nom_departement"),
    ]


def mart_contracts(t: Mapping[str, DataFrame]) -> Contracts:
    commune, area, profile = "mart_performance_commune", "mart_performance_departement", "mart_profil_batiment"
    labels = " + ".join(f"nb_etiquette_{label.lower()}" for label in fixed.LABELS)
    return [
        not_null(commune, "code_commune"),
        in_range(commune, "taux_passoires_pct", 0, 100),
        not_null(commune, "nb_dpe"),
        unique_combo(area, t[area], ["code_departement"]),
        is_true(area, f"{labels} = nb_dpe"),
        is_true(area, "nb_etiquette_f + nb_etiquette_g = nb_passoires"),
        is_true(area, "nb_etiquette_a + nb_etiquette_b = nb_logements_performants"),
        unique(area, t[area], "code_departement"),
        not_null(area, "nom_departement"),
        not_null(area, "est_metropole"),
        not_null(area, "taux_passoires_pct"),
        in_range(area, "taux_passoires_pct", 0, 100),
        in_range(area, "taux_performants_pct", 0, 100),
        not_null(area, "nb_dpe"),
        unique_combo(profile, t[profile], ["type_batiment", "tranche_age_batiment"]),
        not_null(profile, "type_batiment"),
        accepted(profile, "type_batiment", ["maison", "appartement"]),
        not_null(profile, "tranche_age_batiment"),
        in_range(profile, "taux_passoires_pct", 0, 100),
        not_null(profile, "nb_dpe"),
    ]


def all_contracts(t: Mapping[str, DataFrame]) -> Contracts:
    """The 44 contracts, over tables given by name."""
    return source_contracts(t) + fact_contracts(t) + dimension_contracts(t) + mart_contracts(t)
