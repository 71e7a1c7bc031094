"""Name repair, safe typing, latest-version dedup and supersession marks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.functions.casts import text_date, text_double, text_int


# Begins the probe of a row without a key; no trimmed key begins so.
NOT_A_KEY = "\u0000 "
SPREAD = 4


def repaired(name: str) -> str:
    return re.sub(r"\s+", "_", name.strip())


def normalise_names(df: DataFrame) -> DataFrame:
    """Columns renamed so that no name holds white space; data is untouched."""
    names = [repaired(n) for n in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after repair: {clashes}")
    return df if names == df.columns else df.toDF(*names)


def project_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order; all columns if none does."""
    kept = [n for n in names if n in df.columns]
    return df.select(*kept) if kept else df


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Projection onto the mapped columns under their new names."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def cast_columns(
    df: DataFrame,
    dates: Sequence[str] = (),
    doubles: Sequence[str] = (),
    ints: Sequence[str] = (),
) -> DataFrame:
    """Safe casts of the listed columns that exist, in one projection."""
    casts = {**{n: text_date for n in dates}, **{n: text_double for n in doubles}, **{n: text_int for n in ints}}
    return df.select(*[casts[n](F.col(n)).alias(n) if n in casts else F.col(n) for n in df.columns])


def row_fingerprint(df: DataFrame) -> Column:
    """Hash of the whole row: breaks ties the same way in every (re)computation."""
    return F.xxhash64(*[F.col(n) for n in sorted(df.columns)])


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    keep_null_keys: bool = False,
) -> DataFrame:
    """First row per key in ``order``.

    The ``row_number() == 1`` shape lets Spark cut every map task to one row per key
    before the shuffle, so a hot key costs one row per task and not its whole group.
    ``order`` should end in a full tie-break (see ``row_fingerprint``).

    Null keys form one group, like any other value.  With ``keep_null_keys`` rows
    whose keys are all null bypass the window, each one kept.
    """
    if keep_null_keys:
        keyless = F.lit(True)
        for k in keys:
            keyless = keyless & F.col(k).isNull()
        return dedup_latest(df.filter(~keyless), keys, order).unionByName(df.filter(keyless))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).drop("_rank")


def referenced_keys(df: DataFrame, replaces: str, name: str = "_replaced") -> DataFrame:
    """Distinct non-blank trimmed values of ``replaces``."""
    refs = df.select(F.trim(F.col(replaces)).alias(name))
    return refs.filter(F.col(name).isNotNull() & (F.col(name) != "")).distinct()


def superseded_keys(df: DataFrame, key: str, replaces: str, name: str = "_replaced") -> DataFrame:
    """Referenced keys that some row really has: a join of two single columns.

    An inner join of distinct sides, because Spark would move a semi join below the
    ``distinct`` and let every reference of a hot key through the join.
    """
    known = df.select(F.trim(F.col(key)).alias(name)).distinct()
    return referenced_keys(df, replaces, name).join(known, name)


def without_match(counted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of an aggregate whose ``key`` is not in the distinct ``known``.

    An outer join and a null filter, because Spark would move an anti join below the
    aggregate that is there to shrink a hot key to one row.
    """
    marked = known.withColumn("_known", F.lit(True))
    return counted.join(marked, key, "left").filter(F.col("_known").isNull()).drop("_known")


def mark_listed(
    df: DataFrame, key: str, listed: DataFrame, flag: str = "est_remplace", spread: Sequence[str] | None = None
) -> DataFrame:
    """Flag rows whose trimmed key is in the only column of ``listed``, which is distinct.

    No side is hinted: the list is broadcast if Spark finds it small enough, else the
    join is sort-merge and AQE splits an oversized left partition.  Null and blank keys
    match nothing, however many there are: a hash of the columns ``spread`` (a few others,
    unless given; not all, so that scans stay narrow) deals them over all partitions.
    """
    others = [c for c in df.columns if c != key][:SPREAD] if spread is None else list(spread)
    marks = listed.toDF("_listed")
    trimmed = F.trim(F.col(key))
    apart = F.concat(F.lit(NOT_A_KEY), F.xxhash64(*others).cast("string") if others else F.lit(""))
    probe = F.when(trimmed.isNull() | (trimmed == ""), apart).otherwise(trimmed)
    joined = df.join(marks, probe == F.col("_listed"), "left")
    return joined.withColumn(flag, F.col("_listed").isNotNull()).drop("_listed")


def superseded_as_written(df: DataFrame, key: str, replaces: str, name: str = "_replaced") -> DataFrame:
    """Distinct keys, untrimmed as rows write them, whose trimmed form is referenced; also references no row has.

    A reference is itself the key of the rows that write it without padding.  Only keys
    that are written with padding must be looked up by their trimmed form, so that the
    other keys are neither shuffled nor collected in memory.
    """
    refs = referenced_keys(df, replaces, name)
    padded = df.select(F.col(key).alias("_written"), F.trim(F.col(key)).alias(name))
    padded = padded.filter(F.col("_written") != F.col(name)).distinct()
    return refs.unionByName(padded.join(refs, name).select(F.col("_written").alias(name)))


def mark_written(df: DataFrame, key: str, listed: DataFrame, flag: str = "est_remplace") -> DataFrame:
    """Flag rows whose ``key`` is, as written, in the only column of ``listed``, which is distinct.

    For rows stored in buckets of ``key`` (``materialise_by_key``): they are neither shuffled nor
    sorted, because each bucket meets its part of the list as a hash table.
    """
    marks = listed.toDF("_listed").hint("shuffle_hash")
    joined = df.join(marks, F.col(key) == F.col("_listed"), "left")
    return joined.withColumn(flag, F.col("_listed").isNotNull()).drop("_listed")


def mark_superseded(df: DataFrame, key: str, replaces: str, flag: str = "est_remplace") -> DataFrame:
    """Flag rows whose trimmed key is referenced by the ``replaces`` column of any row.

    ``df`` is planned twice, so it should be a scan or cheap; for wide rows that took a
    shuffle to make, store them first and pass stored ``superseded_keys`` to
    ``mark_listed``.
    """
    return mark_listed(df, key, referenced_keys(df, replaces), flag)


def orphan_references(df: DataFrame, key: str, replaces: str) -> DataFrame:
    """References that match no key, with the number of rows that carry them.

    References are counted first, so a hot one reaches the join as a single row.
    """
    refs = df.select(F.trim(F.col(replaces)).alias("reference"))
    refs = refs.filter(F.col("reference").isNotNull() & (F.col("reference") != ""))
    counted = refs.groupBy("reference").agg(F.count(F.lit(1)).alias("n_rows"))
    known = df.select(F.trim(F.col(key)).alias("reference")).distinct()
    return without_match(counted, known, "reference")
