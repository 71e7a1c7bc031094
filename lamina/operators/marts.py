"""Pre-aggregated summaries: counts by flag and label, means, medians, rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.functions.measures import avg_round, rate, round_exact
from lamina.operators.quantiles import at_rank, exact_quantiles, join_groups, ranked_in_ranges


@dataclass(frozen=True)
class Summary:
    """What to measure per group.

    ``flags`` maps an output name to the condition counted; ``means`` and ``medians``
    map an output name to (column, digits); ``spans`` maps an output name to
    ("min" | "max", column).
    """

    flags: Mapping[str, Column] = field(default_factory=dict)
    means: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    medians: Mapping[str, tuple[str, int]] = field(default_factory=dict)
    spans: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    total: str = "nb_dpe"


def label_flags(column: str, labels: Sequence[str], prefix: str) -> dict[str, Column]:
    """One counted condition per label."""
    return {f"{prefix}{label.lower()}": F.col(column) == F.lit(label) for label in labels}


def summarise(df: DataFrame, keys: Sequence[str], spec: Summary, method: str = "ranges") -> DataFrame:
    """One row per group with the measures of ``spec``, from one pass over ``df``.

    Plain measures come from hash aggregation with a map-side partial step, so a hot
    group costs no more than any other.  With medians, the same aggregation also counts
    the values of each median's column per group (grouping sets), and all medians are
    read off these counts together by distributed rank selection.  ``method`` ("counts",
    "state", "fenced") takes each median from ``exact_quantiles`` instead, which reads
    ``df`` again, so it should then be a scan or stored.
    """
    if spec.medians and method == "ranges":
        return _with_medians(df, keys, spec)
    out = df.groupBy(*keys).agg(*_measures(spec))
    for name, (column, digits) in spec.medians.items():
        median = exact_quantiles(df, keys, column, {name: 0.5}, method)
        out = join_groups(out, median.withColumn(name, round_exact(F.col(name), digits)), keys)
    return out


_PICK = {"min": F.min, "max": F.max}


def _measures(spec: Summary) -> list[Column]:
    aggs = [_PICK[how](c).alias(n) for n, (how, c) in spec.spans.items()]
    aggs.append(F.count(F.lit(1)).alias(spec.total))
    aggs += [F.count_if(cond).alias(n) for n, cond in spec.flags.items()]
    return aggs + [avg_round(F.col(c), d).alias(n) for n, (c, d) in spec.means.items()]


def _with_medians(df: DataFrame, keys: Sequence[str], spec: Summary) -> DataFrame:
    """All measures from one aggregation by group, and by group and value of each median's column."""
    columns = {f"_v{i}": column for i, (column, _) in enumerate(spec.medians.values())}
    given = df.withColumns({n: F.col(column).cast("double") for n, column in columns.items()})
    sets = [list(keys), *([*keys, n] for n in columns)]
    # The measure's number: 0 for the group's own row.
    absent = [F.grouping(n) for n in columns]
    number = F.lit(0)
    for i, unused in enumerate(absent, 1):
        number = F.when(unused == 0, F.lit(i)).otherwise(number)
    plain = _measures(spec)
    names = [spec.total if n is None else n for n in (*spec.spans, None, *spec.flags, *spec.means)]
    counted = given.groupingSets(sets, *keys, *columns).agg(
        number.alias("_m"), F.coalesce(*columns).alias("_v"), F.count(F.lit(1)).alias("_c"), *plain
    )
    own = F.col("_m") == 0
    narrow = counted.select(*keys, "_m", "_v", "_c", *[F.when(own, F.col(n)).alias(n) for n in names])
    ranked = ranked_in_ranges(narrow, [*keys, "_m"], [0.5], names)
    medians = [
        round_exact(at_rank(0.5, F.col("_m") == i), digits).alias(n)
        for i, (n, (_, digits)) in enumerate(spec.medians.items(), 1)
    ]
    return ranked.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names], *medians)


def with_rates(df: DataFrame, rates: Mapping[str, str], total: str = "nb_dpe") -> DataFrame:
    """Adds percentages of ``total``: output name to counted column."""
    return df.withColumns({n: rate(F.col(part), F.col(total)) for n, part in rates.items()})


def rollup_rate(df: DataFrame, keys: Sequence[str], part: str, total: str, name: str, digits: int = 2) -> DataFrame:
    """Rate of a coarser group as the ratio of the sums, never a mean of rates."""
    summed = df.groupBy(*keys).agg(F.sum(part).alias(part), F.sum(total).alias(total))
    return summed.withColumn(name, rate(F.col(part), F.col(total), digits))


def centres(df: DataFrame, key: str, x: str, y: str, n: str = "nb_communes") -> DataFrame:
    """Unweighted mean of the located points per parent, and how many there were."""
    return df.filter(F.col(x).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias(n), F.avg(x).alias(x), F.avg(y).alias(y)
    )


def top_k(df: DataFrame, column: str, k: int, tiebreak: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the highest ``column``; each task sends only its own best ``k``."""
    return df.orderBy(F.desc_nulls_last(column), *tiebreak).limit(k)
