"""Declared data contracts: violating rows, a summary table and a gate.

Row-level contracts of one table are evaluated together in a single scan of it, with
the columns they need and nothing else.  The contracts about keys (uniqueness, references)
of one table, as child or as parent, share a second scan, and all tables share one aggregation
by their keys, which shrinks a hot key to a row per task before anything moves.
References need no join: the keys of child and parent are counted side by side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.operators.clean import without_match

WARN, ERROR, PASS = "warn", "error", "pass"


class ContractError(Exception):
    """At least one contract of severity ``error`` is broken."""


# --- violating rows ----------------------------------------------------------


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are ignored."""
    return _repeated(df.filter(F.col(column).isNotNull()), [column])


def check_unique_combo(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; nulls are equal to each other."""
    return _repeated(df, columns)


def _repeated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_relationship(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys without a parent, with their row counts; null keys pass."""
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_key or key).alias(key)).distinct()
    return without_match(counted, known, key)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(null_value(column))


def check_accepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(unaccepted(column, values))


def check_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.filter(out_of_range(column, low, high))


def check_expr(df: DataFrame, expression: str | Column, where: str | Column | None = None) -> DataFrame:
    return df.filter(untrue(expression, where))


# --- violation conditions of the row-level contracts (never null) ------------


def null_value(column: str) -> Column:
    return F.col(column).isNull()


def unaccepted(column: str, values: Sequence[str]) -> Column:
    return F.coalesce(~F.col(column).isin(list(values)), F.lit(False))


def out_of_range(column: str, low: float | None = None, high: float | None = None) -> Column:
    """Outside the inclusive range; null passes."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < F.lit(low))
    if high is not None:
        bad = bad | (F.col(column) > F.lit(high))
    return F.coalesce(bad, F.lit(False))


def untrue(expression: str | Column, where: str | Column | None = None) -> Column:
    """The expression is false; unknown passes, as do rows outside ``where``."""
    holds = F.expr(expression) if isinstance(expression, str) else expression
    bad = ~holds
    if where is not None:
        bad = (F.expr(where) if isinstance(where, str) else where) & bad
    return F.coalesce(bad, F.lit(False))


# --- contracts ---------------------------------------------------------------


@dataclass(frozen=True)
class RowContract:
    """Holds when no row meets ``violation``."""

    check: str
    table: str
    column: str
    violation: Column
    severity: str = ERROR


@dataclass(frozen=True)
class GroupContract:
    """Holds when ``violations`` is empty; a row counts ``weight`` if that is named."""

    check: str
    table: str
    column: str
    violations: DataFrame
    severity: str = ERROR
    weight: str | None = None


@dataclass(frozen=True)
class KeyContract:
    """Holds when no key of ``rows`` repeats or, with a ``parent``, when each key is one of the parent's.

    Null keys pass, unless ``null_counts``.  Violations are repeated keys, or rows without a parent.
    """

    check: str
    table: str
    column: str
    rows: DataFrame
    keys: tuple[str, ...]
    severity: str = ERROR
    null_counts: bool = False
    parent: DataFrame | None = None
    parent_key: str | None = None


Contract = RowContract | GroupContract | KeyContract


def unique(table: str, df: DataFrame, column: str, severity: str = ERROR) -> KeyContract:
    return KeyContract("unique", table, column, df, (column,), severity)


def unique_combo(table: str, df: DataFrame, columns: Sequence[str], severity: str = ERROR) -> KeyContract:
    return KeyContract("unique_combination_of_columns", table, ",".join(columns), df, tuple(columns), severity, null_counts=True)


def relationship(
    table: str, child: DataFrame, parent: DataFrame, key: str, severity: str = ERROR, parent_key: str | None = None
) -> KeyContract:
    return KeyContract("relationships", table, key, child, (key,), severity, parent=parent, parent_key=parent_key or key)


def not_null(table: str, column: str, severity: str = ERROR) -> RowContract:
    return RowContract("not_null", table, column, null_value(column), severity)


def accepted(table: str, column: str, values: Sequence[str], severity: str = ERROR) -> RowContract:
    return RowContract("accepted_values", table, column, unaccepted(column, values), severity)


def in_range(table: str, column: str, low: float | None, high: float | None, severity: str = ERROR) -> RowContract:
    return RowContract("accepted_range", table, column, out_of_range(column, low, high), severity)


def is_true(table: str, expression: str, where: str | None = None, severity: str = ERROR) -> RowContract:
    return RowContract("expression_is_true", table, expression, untrue(expression, where), severity)


# --- summary and gate --------------------------------------------------------


def status_of(violations: Column, severity: Column) -> Column:
    return F.when(violations == 0, F.lit(PASS)).otherwise(severity)


def run_checks(tables: Mapping[str, DataFrame], contracts: Sequence[Contract]) -> DataFrame:
    """``(check, table_name, column_name, severity, violations, status)``, one row per contract."""
    parts = [_row_summary(df, [c for c in contracts if isinstance(c, RowContract) and c.table == name])
             for name, df in tables.items()
             if any(isinstance(c, RowContract) and c.table == name for c in contracts)]
    keyed = [c for c in contracts if isinstance(c, KeyContract)]
    parts += [_key_summary(keyed)] if keyed else []
    parts += [_group_summary(c) for c in contracts if isinstance(c, GroupContract)]
    missing = {c.table for c in contracts if isinstance(c, RowContract)} - set(tables)
    if missing:
        raise ValueError(f"contracts on tables that were not given: {sorted(missing)}")
    summary = reduce(DataFrame.unionByName, parts)
    return summary.withColumn("status", status_of(F.col("violations"), F.col("severity")))


def _row_summary(df: DataFrame, contracts: Sequence[RowContract]) -> DataFrame:
    """All row contracts of one table from one aggregation, turned into rows."""
    counted = df.agg(*[F.count_if(c.violation).alias(f"_{i}") for i, c in enumerate(contracts)])
    return _as_rows(counted, contracts)


def _as_rows(counted: DataFrame, contracts: Sequence[Contract]) -> DataFrame:
    """A row per contract from one row of counts, ``_0`` and so on."""
    entries = [
        F.struct(
            F.lit(c.check).alias("check"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.severity).alias("severity"),
            F.col(f"_{i}").alias("violations"),
        )
        for i, c in enumerate(contracts)
    ]
    return counted.select(F.inline(F.array(*entries)))


def _key_summary(contracts: Sequence[KeyContract]) -> DataFrame:
    """All key contracts, each table scanned once, from one aggregation by every key that is asked for.

    A reference's child and parent keys meet under one ``domain``, which a uniqueness contract on the
    same child key shares.  Keys move once: what is summed after that are verdicts, not keys.
    """
    domains = []  # per contract: (table, keys, types, parent and its key)
    for c in contracts:
        types = tuple(c.rows.select(*c.keys).schema[i].dataType for i in range(len(c.keys)))
        if c.parent is not None:
            types = (c.rows.select(*c.keys).union(c.parent.select(c.parent_key)).schema[0].dataType,)
        domains.append((id(c.rows), c.keys, types, None if c.parent is None else (id(c.parent), c.parent_key)))
    shared: list[tuple] = []
    for d in sorted(set(domains), key=lambda d: (d[3] is None, domains.index(d))):
        # A domain with a parent serves for uniqueness too.
        if d[3] is not None or not any(d[:3] == other[:3] for other in shared):
            shared.append(d)
    uses = [next(i for i, other in enumerate(shared) if d == other or (d[3] is None and d[:3] == other[:3])) for d in domains]
    # Keys of one type share columns.
    slots = [[f"_{t.simpleString()}_{[*types[:j]].count(t)}" for j, t in enumerate(types)] for _, _, types, _ in shared]
    kinds = {n: t for names, (_, _, types, _) in zip(slots, shared) for n, t in zip(names, types)}
    frames = {id(df): df for c in contracts for df in (c.rows, c.parent) if df is not None}

    def entry(i: int, keys: Sequence[str], child: bool) -> Column:
        given = dict(zip(slots[i], keys))
        return F.struct(
            F.lit(i).alias("_domain"),
            *[(F.col(f"`{given[n]}`") if n in given else F.lit(None)).cast(t).alias(n) for n, t in kinds.items()],
            F.lit(child).alias("_child"),
        )

    parts = []
    for at, df in frames.items():
        asked = [entry(i, keys, True) for i, (t, keys, _, _) in enumerate(shared) if t == at]
        asked += [entry(i, (parent[1],), False) for i, (_, _, _, parent) in enumerate(shared) if parent and parent[0] == at]
        names = [f"_{i}" for i in range(len(asked))]
        rows = df.select(*[e.alias(n) for n, e in zip(names, asked)]).unpivot([], names, "_from", "_key")
        parts.append(rows.select("_key.*"))
    children, parents = F.count_if(F.col("_child")), F.count_if(~F.col("_child"))
    met = reduce(DataFrame.unionByName, parts).groupBy("_domain", *[f"`{n}`" for n in kinds]).agg(
        children.alias("_children"), parents.alias("_parents")
    )
    counts = []
    for i, (c, at) in enumerate(zip(contracts, uses)):
        mine = F.col("_domain") == at
        if not c.null_counts:
            for n in slots[at]:
                mine = mine & F.col(f"`{n}`").isNotNull()
        if c.parent is None:
            counts.append(F.count_if(mine & (F.col("_children") > 1)).alias(f"_{i}"))
        else:
            lost = F.when(mine & (F.col("_parents") == 0), F.col("_children"))
            counts.append(F.coalesce(F.sum(lost), F.lit(0).cast("bigint")).alias(f"_{i}"))
    return _as_rows(met.agg(*counts), contracts)


def _group_summary(c: GroupContract) -> DataFrame:
    n = F.count(F.lit(1)) if c.weight is None else F.coalesce(F.sum(c.weight), F.lit(0).cast("bigint"))
    return c.violations.agg(n.alias("violations")).select(
        F.lit(c.check).alias("check"),
        F.lit(c.table).alias("table_name"),
        F.lit(c.column).alias("column_name"),
        F.lit(c.severity).alias("severity"),
        "violations",
    )


def check_freshness(
    df: DataFrame,
    column: str,
    table: str,
    as_of: dt.datetime | Column,
    warn_days: int = 14,
    error_days: int = 30,
) -> DataFrame:
    """Age in days of the newest ``column``: warns past one limit, fails past the other.

    A table without any date is as stale as can be.
    """
    now = F.lit(as_of) if isinstance(as_of, dt.datetime) else as_of
    newest = df.agg(F.max(F.col(column).cast("timestamp")).alias("newest"))
    age = (F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("newest"))) / F.lit(86400.0)
    late = F.when(F.col("newest").isNull() | (age > error_days), F.lit(ERROR)).when(age > warn_days, F.lit(WARN))
    return newest.select(
        F.lit("freshness").alias("check"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.coalesce(late, F.lit(ERROR)).alias("severity"),
        late.isNotNull().cast("bigint").alias("violations"),
        F.coalesce(late, F.lit(PASS)).alias("status"),
    )


def gate(summary: DataFrame) -> list:
    """Summary rows, at most one per contract; raises if an ``error`` contract is broken."""
    rows = summary.collect()
    broken = [r for r in rows if r["status"] == ERROR]
    if broken:
        raise ContractError("; ".join(f"{r['check']} on {r['table_name']}.{r['column_name']}: "
                                      f"{r['violations']}" for r in broken))
    return rows
