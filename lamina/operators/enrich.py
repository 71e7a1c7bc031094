"""Derived dimensions of the silver layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.functions.bands import band, member, still_valid


@dataclass(frozen=True)
class EnrichColumns:
    label: str = "etiquette_dpe"
    date: str = "date_etablissement_dpe"
    size: str = "surface_habitable_logement"
    built: str = "annee_construction"
    end: str = "date_fin_validite_dpe"


def enrich(df: DataFrame, as_of: Column | None = None, columns: EnrichColumns = EnrichColumns()) -> DataFrame:
    """Label flags, year and month, surface and age bands, validity on ``as_of``."""
    return df.withColumns(
        {
            "est_passoire_thermique": member(F.col(columns.label), fixed.SIEVE_LABELS),
            "est_performant": member(F.col(columns.label), fixed.EFFICIENT_LABELS),
            "annee_etablissement": F.year(columns.date),
            "mois_etablissement": F.month(columns.date),
            "tranche_surface": band(F.col(columns.size), fixed.SIZE_EDGES, fixed.SIZE_LABELS),
            "tranche_age_batiment": band(
                F.col(columns.built), fixed.AGE_EDGES, fixed.AGE_LABELS, fixed.AGE_UNKNOWN
            ),
            "dpe_encore_valide": still_valid(F.col(columns.end), as_of),
        }
    )
