"""Silver kept up to date from the months that changed, without rebuilding it.

A state table holds a narrow row per key of the last run (its reference, verdicts and place
in silver) and the folders of bronze that the run read.  Months whose folder differs have
changed.  Their keys, as they are now and as the state knows them, are deduplicated anew
over all of bronze; references are compared as two narrow columns, and keys that begin or
cease to be superseded are affected too.  Only the silver partitions that hold an affected
key, or will hold it, are rewritten: such a key leaves its old place when it moves.  Other
partitions keep their files.

The state is written last, by a version that exists once it is complete.  A run that stops
before has changed nothing that the next one doesn't do again in full.  Validity on a day
(``as_of``) is judged when a row is written, so that rows of untouched partitions keep the
answer of the run that wrote them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators.clean import mark_listed, superseded_keys
from lamina.operators.ledger import MONTH
from lamina.operators.quality import metrics_of, tally
from lamina.plans.flow import Lake, read_bronze, read_silver
from lamina.plans.silver import CURRENT_KEYS, KEYLESS_SPREAD, REJECT_KEYS, build_silver, current_rows, judge, latest, rejected_rows
from lamina.sources.shared import materialise
from lamina.sources.snapshots import LOAD, Versions
from lamina.sources.tables import write_metrics, write_partitions

KEY, REPLACES = fixed.PRIMARY_KEY, "numero_dpe_remplace"
PLACE = ("code_region_ban", "annee_etablissement")
VERDICTS = ("motif_rejet", "est_valide", "est_remplace", "geocodage_fiable")
SPREAD = ("annee", "mois", *PLACE)


@dataclass(frozen=True)
class Updated:
    """What an update found and rewrote."""

    months: list[tuple[int | None, int | None]]
    keys: int
    current: list[tuple]
    rejects: list[tuple]


def state(lake: Lake) -> Versions:
    return Versions(lake.path("silver", "state"), ("basis", "keys"))


def narrow(prepared: DataFrame) -> DataFrame:
    return prepared.select(KEY, REPLACES, *MONTH, *PLACE, *VERDICTS)


def basis(spark: SparkSession, lake: Lake, version: int) -> DataFrame:
    """The folders that a version of bronze reads: by month, and without one for undated rows."""
    strays = lake.months.stray_records(spark, version).filter("sans_date > 0")
    undated = strays.select(*[F.lit(None).cast("int").alias(k) for k in MONTH], LOAD)
    ledger = lake.months.records(spark, version)
    return undated if ledger is None else ledger.select(*[F.col(k).cast("int").alias(k) for k in MONTH], LOAD).unionByName(undated)


def rebuild_silver(spark: SparkSession, lake: Lake, as_of: Column | None = None) -> None:
    """Builds silver as a whole and records what updates start from."""
    at = lake.months.version(spark)
    prepared = build_silver(read_bronze(spark, lake, at), lake.silver, as_of, "static")
    state(lake).put(spark, {"basis": basis(spark, lake, at), "keys": narrow(prepared)})


def update_silver(spark: SparkSession, lake: Lake, as_of: Column | None = None) -> Updated | None:
    """Brings silver to the current version of bronze; None if it was built as a whole."""
    known = state(lake).read(spark)
    if known is None:
        rebuild_silver(spark, lake, as_of)
        return None
    at = lake.months.version(spark)
    now, before = basis(spark, lake, at), known["basis"]
    differing = now.exceptAll(before).unionByName(before.exceptAll(now)).select(*MONTH).distinct()
    months = [tuple(r) for r in differing.collect()]  # a row per month
    if not months:
        return Updated([], 0, [], [])
    bronze, old = read_bronze(spark, lake, at), known["keys"]
    changed = _among(months, MONTH)
    own = materialise(bronze.filter(changed).select(KEY).unionByName(old.filter(changed).select(KEY)).distinct(), "changed")
    once = materialise(latest(_with(bronze, own)), "latest-changed")
    fresh = narrow(judge(once.withColumn("est_remplace", F.lit(False)), as_of)).withColumn("_was", F.lit(None).cast("boolean"))
    kept = _without(old, own).withColumn("_was", F.col("est_remplace"))
    keys = materialise(kept.unionByName(fresh).drop("est_remplace"), "keys")
    replaced = materialise(superseded_keys(keys, KEY, REPLACES), "superseded")
    marked = materialise(mark_listed(keys, KEY, replaced, spread=SPREAD), "marked")
    turned = materialise(marked.filter(F.col("_was") != F.col("est_remplace")).select(KEY), "turned")
    affected = materialise(own.unionByName(turned), "affected")
    rows = once.unionByName(latest(_with(bronze, turned)))
    judged = materialise(judge(mark_listed(rows, KEY, replaced, spread=[c for c in KEYLESS_SPREAD if c in rows.columns]), as_of), "judged")

    left = _with(old, affected)
    at_places = {}
    stored = dict(zip(("current", "rejects"), read_silver(spark, lake)))
    for name, parts, new in (("current", CURRENT_KEYS, current_rows(judged)), ("rejects", REJECT_KEYS, rejected_rows(judged))):
        gone = (F.col("est_valide") & ~F.col("est_remplace")) == F.lit(name == "current")
        touched = left.filter(gone).select(*parts).unionByName(new.select(*parts)).distinct().collect()  # partitions
        at_places[name] = sorted(map(tuple, touched), key=str)
        _rewrite(spark, getattr(lake.silver, name), stored[name], parts, at_places[name], new, affected, name)
    done = marked.drop("_was")
    write_metrics(metrics_of(tally(done), bronze.agg(F.count(F.lit(1)).alias("n")).scalar()), lake.silver.metrics)
    state(lake).put(spark, {"basis": now, "keys": done})
    return Updated(months, affected.count(), at_places["current"], at_places["rejects"])


def _rewrite(
    spark: SparkSession, path: str, stored: DataFrame, parts: Sequence[str], places: list[tuple], new: DataFrame, affected: DataFrame, name: str
) -> None:
    """Writes the touched partitions: what they held of other keys, and the affected keys' rows."""
    if not places:
        return
    staying = _without(stored.filter(_among(places, parts)), affected)
    full = materialise(staying.unionByName(new.select(*stored.columns)), name)
    write_partitions(full, path, parts, "dynamic")
    filled = {tuple(r) for r in full.select(*parts).distinct().collect()}  # partitions
    for place in places:
        if place not in filled:
            Versions.drop_partition(spark, path, dict(zip(parts, place)))


def _among(values: Sequence[tuple], columns: Sequence[str]) -> Column:
    """Whether the columns have one of the values, null being a value; prunes partitions."""
    wanted = F.lit(False)
    for value in values:
        here = F.lit(True)
        for c, v in zip(columns, value):
            here = here & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        wanted = wanted | here
    return F.coalesce(wanted, F.lit(False))


def _with(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys.toDF("_key"), F.col(KEY).eqNullSafe(F.col("_key")), "left_semi")


def _without(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys.toDF("_key"), F.col(KEY).eqNullSafe(F.col("_key")), "left_anti")
