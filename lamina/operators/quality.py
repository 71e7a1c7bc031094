"""Reject motives, the current/rejects split, run counters and the metrics table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.functions.bands import first_match
from lamina.functions.codes import geocoded, geocoded_precisely
from lamina.functions.measures import rate

Rule = tuple[Column, str]


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


@dataclass(frozen=True)
class RuleColumns:
    """Which columns the standard reject rules look at."""

    key: str = "numero_dpe"
    label: str = "etiquette_dpe"
    date: str = "date_etablissement_dpe"
    place: str = "code_insee_ban"
    size: str = "surface_habitable_logement"
    use: str = "conso_5_usages_par_m2_ep"


def standard_rules(
    columns: RuleColumns = RuleColumns(),
    labels: Sequence[str] = fixed.LABELS,
    null_label: str = "pass",
    max_size: float = fixed.MAX_SIZE,
    max_use: float = fixed.MAX_USE,
) -> list[Rule]:
    """The eight reject rules, first match wins.

    A null label passes the label rule, since "not in the list" is unknown for null;
    ``null_label="reject"`` makes it fail instead.
    """
    if null_label not in ("pass", "reject"):
        raise ValueError("null_label must be 'pass' or 'reject'")
    label, size, use = F.col(columns.label), F.col(columns.size), F.col(columns.use)
    bad_label = ~label.isin(list(labels))
    if null_label == "reject":
        bad_label = label.isNull() | bad_label
    return [
        (blank(F.col(columns.key)), fixed.MOTIVE_KEY),
        (bad_label, fixed.MOTIVE_LABEL),
        (F.col(columns.date).isNull(), fixed.MOTIVE_DATE),
        (blank(F.col(columns.place)), fixed.MOTIVE_PLACE),
        (size.isNull() | (size <= 0), fixed.MOTIVE_SIZE_INVALID),
        (size > max_size, fixed.MOTIVE_SIZE_ABERRANT),
        (use.isNull() | (use < 0), fixed.MOTIVE_USE_INVALID),
        (use > max_use, fixed.MOTIVE_USE_ABERRANT),
    ]


def reject_reason(rules: Sequence[Rule]) -> Column:
    """Motive of the first rule that holds, null if none does."""
    return first_match(rules, F.lit(None).cast("string"))


def apply_quality(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``motif_rejet`` and the validity flag ``est_valide``."""
    return df.withColumn("motif_rejet", reject_reason(rules)).withColumn(
        "est_valide", F.col("motif_rejet").isNull()
    )


def status_flags(df: DataFrame, status: str, score: str, threshold: float = fixed.PRECISE_SCORE) -> DataFrame:
    """Adds ``geocodage_fiable`` and ``geocodage_precis``, both never null."""
    return df.withColumns(
        {
            "geocodage_fiable": geocoded(F.col(status)),
            "geocodage_precis": geocoded_precisely(F.col(status), F.col(score), threshold),
        }
    )


def current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("est_valide") & ~F.col("est_remplace"))


def rejects(df: DataFrame) -> DataFrame:
    """Complement of ``current``: both flags are never null."""
    return df.filter(~F.col("est_valide") | F.col("est_remplace"))


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return current(df), rejects(df)


def reject_motive() -> Column:
    """Being superseded wins over the quality motive."""
    return F.when(F.col("est_remplace"), F.lit(fixed.MOTIVE_SUPERSEDED)).otherwise(F.col("motif_rejet"))


def reject_rows(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Audit projection of the rejected rows: the listed columns and the motive."""
    return rejects(df).select(*keep, reject_motive().alias("motif_rejet"))


def tally(df: DataFrame) -> DataFrame:
    """Rows per motive and flags: one pass over the prepared rows, a few dozen rows out."""
    flags = ["motif_rejet", "est_valide", "est_remplace", "geocodage_fiable"]
    return df.groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))


def metrics_of(counted: DataFrame, bronze_rows: Column | None = None) -> DataFrame:
    """The long metrics table from a ``tally``: every counter, also at 0, and every motive.

    ``bronze_rows`` is the number of rows before dedup; without it, those of the tally.
    """
    n, valid, superseded = F.col("n"), F.col("est_valide"), F.col("est_remplace")
    counters = {
        "apres_deduplication": F.lit(True),
        "remplaces": superseded,
        "rejetes": ~valid,
        "retenus": valid & ~superseded,
        "geocodage_non_fiable": valid & ~F.col("geocodage_fiable"),
    }
    if bronze_rows is None:
        counters = {"lignes_bronze": F.lit(True), **counters}

    def entry(name: Column, value: Column) -> Column:
        return F.struct(name.alias("metrique"), value.cast("bigint").alias("valeur"))

    entries = [entry(F.lit(m), F.when(cond, n).otherwise(F.lit(0))) for m, cond in counters.items()]
    motive = entry(F.concat(F.lit(fixed.METRIC_MOTIVE_PREFIX), F.col("motif_rejet")), n)
    listed = counted.select(F.inline(F.array(*entries, motive))).filter("metrique is not null")
    fixed_rows = [entry(F.lit(m), F.lit(0)) for m in counters]
    if bronze_rows is not None:
        fixed_rows.append(entry(F.lit("lignes_bronze"), bronze_rows))
    start = counted.sparkSession.range(1).select(F.inline(F.array(*fixed_rows)))
    return listed.unionByName(start).groupBy("metrique").agg(F.sum("valeur").alias("valeur"))


def run_counters(df: DataFrame) -> DataFrame:
    """One row of counters from one pass over the prepared rows."""
    valid, superseded = F.col("est_valide"), F.col("est_remplace")
    return df.agg(
        F.count(F.lit(1)).alias("apres_deduplication"),
        F.count_if(superseded).alias("remplaces"),
        F.count_if(~valid).alias("rejetes"),
        F.count_if(valid & ~superseded).alias("retenus"),
        F.count_if(valid & ~F.col("geocodage_fiable")).alias("geocodage_non_fiable"),
    )


def reject_histogram(df: DataFrame) -> DataFrame:
    """Rows per quality motive, most frequent first."""
    counted = df.filter(F.col("motif_rejet").isNotNull()).groupBy("motif_rejet").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "motif_rejet")


def with_share(metrics: DataFrame, total: str = "lignes_bronze") -> DataFrame:
    """Adds each value's percentage of the ``total`` metric as text, ``-`` when it is 0."""
    here = F.when(F.col("metrique") == total, F.col("valeur"))
    share = rate(F.col("valeur"), F.max(here).over(Window.partitionBy()))  # one row per metric
    return metrics.withColumn("part", F.coalesce(F.concat(share.cast("string"), F.lit("%")), F.lit("-")))
