"""Bronze to silver: typed, deduplicated, superseded-flagged, ruled and enriched rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import fixed
from lamina.operators.clean import (
    cast_columns,
    dedup_latest,
    mark_listed,
    mark_written,
    normalise_names,
    referenced_keys,
    row_fingerprint,
    superseded_as_written,
)
from lamina.operators.enrich import enrich
from lamina.operators.quality import (
    Rule,
    apply_quality,
    current,
    metrics_of,
    reject_rows,
    standard_rules,
    status_flags,
    tally,
)
from lamina.sources.shared import finer_tasks, materialise, materialise_by_key
from lamina.sources.tables import bronze_schema, write_metrics, write_partitions

CURRENT_KEYS = ("code_region_ban", "annee_etablissement")
# What deals rows without a key over the partitions; the rules read these columns anyway.
KEYLESS_SPREAD = ("date_etablissement_dpe", "code_insee_ban", "surface_habitable_logement", "conso_5_usages_par_m2_ep")
REJECT_KEYS = ("annee_etablissement",)
REJECT_COLUMNS = ("numero_dpe", "date_etablissement_dpe", "code_region_ban", "annee_etablissement")


def typed(bronze: DataFrame) -> DataFrame:
    return cast_columns(normalise_names(bronze), fixed.DATE_COLUMNS, fixed.DOUBLE_COLUMNS, fixed.INT_COLUMNS)


def latest_order(df: DataFrame) -> list[Column]:
    """Last modified, then last received; the row fingerprint settles ties for good."""
    return [
        F.desc_nulls_last("date_derniere_modification_dpe"),
        F.desc_nulls_last("date_reception_dpe"),
        row_fingerprint(df),
    ]


def latest(bronze: DataFrame, order: Sequence[Column] | None = None, keep_null_keys: bool = False) -> DataFrame:
    """Typed rows, the latest version of every key."""
    rows = typed(bronze)
    return dedup_latest(rows, [fixed.PRIMARY_KEY], order or latest_order(rows), keep_null_keys)


def prepare(
    bronze: DataFrame,
    as_of: Column | None = None,
    rules: Sequence[Rule] | None = None,
    order: Sequence[Column] | None = None,
    keep_null_keys: bool = False,
    work: str | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Every bronze key once, with its flags and motive; rejects nothing yet.

    Dedup comes before supersession, so that an outdated version of a row supersedes
    nothing, and both come before the quality rules.

    The deduplicated rows are written to the shared folder, or to ``work``: bronze is read and shuffled
    once, however many outputs follow.  They lie in buckets of their key, and the keys
    that are superseded follow from two columns of that table and are stored too: marking
    the wide rows neither shuffles nor sorts them again, however long that list is.  The
    rules and dimensions on top are plain expressions, cheaper to repeat than to store.

    The number of buckets follows the rows of bronze.  They are counted, which a stored table answers from
    its footers; ``n_rows`` says about how many there are where counting would compute them.
    """
    key, replaces = fixed.PRIMARY_KEY, "numero_dpe_remplace"
    rows = latest(bronze, order, keep_null_keys)
    with finer_tasks(bronze.sparkSession, rows=bronze.count() if n_rows is None else n_rows):
        if keep_null_keys:  # there may be any number of rows without a key, which one bucket must not hold
            once = materialise(rows, "latest", work)
            replaced = materialise(referenced_keys(once, replaces), "superseded", work)
            marked = mark_listed(once, key, replaced, spread=[c for c in KEYLESS_SPREAD if c in once.columns])
        else:
            once = materialise_by_key(rows, "latest", key, work)
            replaced = materialise(superseded_as_written(once, key, replaces), "superseded", work)
            marked = mark_written(once, key, replaced)
    return judge(marked, as_of, rules)


def judge(marked: DataFrame, as_of: Column | None = None, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Motives, flags and dimensions of deduplicated, marked rows."""
    ruled = apply_quality(marked, standard_rules() if rules is None else rules)
    return enrich(status_flags(ruled, "statut_geocodage", "score_ban"), as_of)


def silver_schemas(spark: SparkSession) -> tuple[T.StructType, T.StructType]:
    """Schemas of the current and the rejects table, known even while a table is empty."""
    empty = typed(spark.createDataFrame([], bronze_schema())).withColumn("est_remplace", F.lit(False))
    judged = judge(empty)
    return current_rows(judged).schema, rejected_rows(judged).schema


def current_rows(prepared: DataFrame) -> DataFrame:
    return current(prepared).drop("motif_rejet", "est_valide")


def rejected_rows(prepared: DataFrame) -> DataFrame:
    return reject_rows(prepared, REJECT_COLUMNS)


def metrics(bronze: DataFrame, prepared: DataFrame) -> DataFrame:
    """Bronze rows, the run counters and the motives, as one long table, from one pass over each."""
    return metrics_of(tally(prepared), bronze.agg(F.count(F.lit(1)).alias("lignes_bronze")).scalar())


@dataclass(frozen=True)
class SilverPaths:
    current: str
    rejects: str
    metrics: str
    work: str | None = None

    @classmethod
    def under(cls, root: str) -> SilverPaths:
        return cls(f"{root}/dpe_courant", f"{root}/dpe_rejets", f"{root}/metrics", f"{root}/work")


def build_silver(
    bronze: DataFrame,
    paths: SilverPaths,
    as_of: Column | None = None,
    overwrite: str = "static",
) -> DataFrame:
    """Writes the current rows, the rejects and the metrics of one run; returns the prepared rows.

    Each output reads only the columns it needs of the stored, deduplicated rows.
    """
    prepared = prepare(bronze, as_of, work=paths.work)
    write_partitions(current_rows(prepared), paths.current, CURRENT_KEYS, overwrite)
    write_partitions(rejected_rows(prepared), paths.rejects, REJECT_KEYS, overwrite)
    write_metrics(metrics(bronze, prepared), paths.metrics)
    return prepared
