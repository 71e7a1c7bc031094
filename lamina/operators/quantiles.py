"""Exact interpolated quantiles that hold when one group has most of the rows.

Four methods give the same answers; the caller chooses, and only ``fenced`` runs jobs while
a plan is built:

``ranges`` (the default) is a distributed rank selection.  Each group's distinct values are
counted, map-side first, and partitioned by ranges of (group, value), whose bounds Spark
samples from the counts, so that a large group lies in many ranges and small ones share one.  Counts per
range and their prefix sums tell which range holds a rank, and only that range's values
are ranked.  No task holds more values than a range, and the input is read once: counts
and values come from one shuffle.

``counts`` reads the ranks off running counts of a whole group, whose distinct values are
sorted in one task.  For groups of a modest size; it has one shuffle less.

``state`` is Spark's ``percentile``: one aggregation, but the distinct values of a group are
kept in the memory of a task.  For columns with a known, modest number of values.

``fenced`` needs no sampled bounds.  Approximate
quantiles give a fence on each side of a target rank, one aggregation counts exactly what
lies outside and keeps only the distinct values between, and a second fence inside the
first makes what is left a few millionths of the group.  Approximation only decides how
much is kept, never the answer: ranks are exact counts, and a rank that does not fall on a
kept value stops the query.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from lamina.sources.shared import materialise

METHODS = ("ranges", "counts", "state", "fenced")
ACCURACY = 10_000
MARGIN = 0.001
STEPS = 1000


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    method: str = "ranges",
    small_group: int = 10_000,
) -> DataFrame:
    """One row per group with a column per named probability (null without values)."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if method == "fenced":
        return fenced_quantiles(df, keys, value, probs, small_group)
    if method == "state":
        found = df.groupBy(*keys).agg(F.percentile(F.col(value), list(probs.values())).alias("_q"))
        return found.select(*keys, *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(probs)])
    counted = df.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranked = with_ranks(counted, keys) if method == "counts" else ranked_in_ranges(counted, keys, list(probs.values()))
    return ranked.groupBy(*keys).agg(*[at_rank(p).alias(n) for n, p in probs.items()])


# A common table expression that is used twice and not deterministic (it numbers the ranges) is computed once, and
# its last shuffle is shared.  That one brings together what the counts and the ranks need: a group's rows of a range.
RANGES = """
with ranged as (
  select /*+ repartition({keys} _part) */ * from (
    select {keys} {own_carried} _v, spark_partition_id() as _part, if(_v is null, 0L, _c) as _known
    from (select /*+ repartition_by_range({n}, {keys} _v) */ * from {{counted}}))),
parts as (select {keys} _part, sum(_known) as _rows from ranged group by {keys} _part),
starts as (
  select *, sum(_rows) over ({by_keys}) as _n,
    coalesce(sum(_rows) over ({by_keys} order by _part rows between unbounded preceding and 1 preceding), 0L) as _start
  from parts),
holding as (select * from starts where _n = 0 or {held})
select {own_keys} {carried} l._v, h._n, l._known,
  h._start + sum(l._known) over (partition by {own_keys} l._part order by l._v rows unbounded preceding) as _to
from ranged l join holding h on l._part = h._part {same_keys}
"""


def ranked_in_ranges(
    counted: DataFrame, keys: Sequence[str], probs: Sequence[float], carried: Sequence[str] = ()
) -> DataFrame:
    """The values (``_v``, ``_c`` rows of each) of those ranges that hold a quantile's rank, with their ranks.

    Adds ``_from``, ``_to`` and ``_n`` as ``with_ranks`` does.  Groups without values keep their
    rows, and so do the columns named in ``carried``.
    """
    names = {k: f"_k{i}" for i, k in enumerate(keys)} | {c: f"_a{i}" for i, c in enumerate(carried)}
    inner = [names[k] for k in keys]
    held = " or ".join(
        f"({rank}((_n - 1) * {p!r}D) >= _start and {rank}((_n - 1) * {p!r}D) < _start + _rows)"
        for p in sorted(set(probs)) for rank in ("floor", "ceil")
    )
    text = RANGES.format(
        n=int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        keys="".join(f"{k}, " for k in inner),
        own_keys="".join(f"l.{k}, " for k in inner),
        by_keys=f"partition by {', '.join(inner)}" if inner else "",
        same_keys="".join(f" and l.{k} <=> h.{k}" for k in inner),
        own_carried="".join(f"{names[c]}, " for c in carried),
        carried="".join(f"l.{names[c]}, " for c in carried),
        held=held or "false",
    )
    plain = counted.select(*[F.col(f"`{k}`").alias(n) for k, n in names.items()], "_v", "_c")
    found = counted.sparkSession.sql(text, counted=plain)
    back = [F.col(n).alias(k) for k, n in names.items()]
    return found.select(*back, "_v", "_n", (F.col("_to") - F.col("_known")).alias("_from"), "_to")


def with_ranks(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the ranks [_from, _to) of each (group, ``_v``) of ``_c`` rows, and the group's ``_n`` values.

    Null values have no ranks.
    """
    known = F.when(F.col("_v").isNotNull(), F.col("_c")).otherwise(F.lit(0))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counted.withColumns({"_to": F.sum(known).over(upto), "_n": F.sum(known).over(group)}).withColumn(
        "_from", F.col("_to") - known
    )


def at_rank(prob: float, where: Column | None = None) -> Column:
    """Aggregate of a group's ranked values (those that meet ``where``): the interpolated quantile.

    A rank without a value stops the query.
    """
    here = F.lit(True) if where is None else where
    position = F.when(here & (F.col("_n") > 0), (F.col("_n") - 1) * F.lit(prob))

    def value_at(rank: Column) -> Column:
        return F.max(F.when(here & (rank >= F.col("_from")) & (rank < F.col("_to")), F.col("_v")))

    low_rank, high_rank = F.floor(position), F.ceil(position)
    low, high, at = value_at(low_rank), value_at(high_rank), F.max(position)
    lost = at.isNotNull() & (low.isNull() | high.isNull())
    between = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
    missing = F.raise_error(F.lit("a quantile rank has no value")).cast("double")
    return F.when(lost, missing).when(low == high, low).otherwise(between)


def fenced_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    small_group: int = 10_000,
) -> DataFrame:
    """Quantiles by two rounds of fencing.

    ``df`` is planned three times, so it should be a scan or stored.  The fences, a row per
    group, are stored: Spark then knows their size and broadcasts them if they are small, so that
    rows stay where they are.  Without that it would shuffle and sort all rows by their group.
    """
    names = list(probs)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    valid = rows.filter(F.col("_v").isNotNull())

    first = _stored(_first_fences(valid, keys, probs, small_group), keys)
    second = _stored(_second_fences(_attach(valid, first, keys), keys, probs, small_group), keys)
    kept = _kept_values(_attach(valid, second, keys), keys, len(names))
    found = _pick(kept, keys, probs)
    if not keys:
        return found
    # Groups without any value get their null row back.
    groups = df.groupBy(*keys).agg(F.count(value).alias("_n")).filter(F.col("_n") == 0).drop("_n")
    return found.unionByName(groups, allowMissingColumns=True)


def _stored(fences: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fences of groups are stored; those of the whole table are read at once (see ``_attach``)."""
    return materialise(fences, "fences") if keys else fences


def _attach(rows: DataFrame, fences: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Puts each group's fences beside its rows.

    Without keys the fences are a single row of fixed width and become literals, which
    also lets them reach the scan as filters.
    """
    if not keys:
        row: Row = fences.first()
        types = dict(fences.dtypes)
        return rows.select("*", *[F.lit(row[n]).cast(types[n]).alias(n) for n in fences.columns])
    return join_groups(rows, fences, keys)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group keys, where a null key matches a null key."""
    renamed = right.select(*[F.col(n).alias(f"_r_{n}" if n in keys else n) for n in right.columns])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _first_fences(valid: DataFrame, keys: Sequence[str], probs: Mapping[str, float], small: int) -> DataFrame:
    """Approximate values a little below and above each probability; open for small groups."""
    wanted = [p for prob in probs.values() for p in (max(0.0, prob - MARGIN), min(1.0, prob + MARGIN))]
    sketch = valid.groupBy(*keys).agg(
        F.count("_v").alias("_n"), F.percentile_approx("_v", wanted, ACCURACY).alias("_s")
    )
    narrow = F.col("_n") > F.lit(small)
    fences = []
    for i, prob in enumerate(probs.values()):
        low = narrow if prob > MARGIN else F.lit(False)
        high = narrow if prob < 1 - MARGIN else F.lit(False)
        fences.append(F.when(low, F.get("_s", F.lit(2 * i))).alias(f"_lo{i}"))
        fences.append(F.when(high, F.get("_s", F.lit(2 * i + 1))).alias(f"_hi{i}"))
    return sketch.select(*keys, "_n", *fences)


def _below(i: int) -> Column:
    return F.coalesce(F.col("_v") < F.col(f"_lo{i}"), F.lit(False))


def _above(i: int) -> Column:
    return F.coalesce(F.col("_v") > F.col(f"_hi{i}"), F.lit(False))


def _inside(i: int) -> Column:
    return ~_below(i) & ~_above(i)


def _grid() -> Column:
    """0, 1/STEPS, ... 1 as one constant: a thousand literals would slow planning down."""
    return F.split(F.lit(",".join(str(i / STEPS) for i in range(STEPS + 1))), ",").cast("array<double>")


def _second_fences(rows: DataFrame, keys: Sequence[str], probs: Mapping[str, float], small: int) -> DataFrame:
    """Exact counts around the first fences, and a finer fence inside them.

    The finer fence is taken only where the target ranks are known to lie inside and
    there is still much to cut away.
    """
    aggs = [F.first("_n").alias("_n")]
    for i in range(len(probs)):
        aggs += [
            F.first(f"_lo{i}").alias(f"_lo{i}"),
            F.first(f"_hi{i}").alias(f"_hi{i}"),
            F.count_if(_below(i)).alias(f"_b{i}"),
            F.count_if(_inside(i)).alias(f"_m{i}"),
            F.percentile_approx(F.when(_inside(i), F.col("_v")), _grid(), ACCURACY).alias(f"_g{i}"),
        ]
    counted = rows.groupBy(*keys).agg(*aggs)
    fences = []
    for i, prob in enumerate(probs.values()):
        low_rank, high_rank = _ranks(F.col("_n"), prob)
        start, size = F.col(f"_b{i}"), F.col(f"_m{i}")
        hit = (low_rank >= start) & (high_rank < start + size) & (size > F.lit(small))
        steps = F.lit(STEPS)
        low_step = F.floor((low_rank - start) / size * steps).cast("int") - 1
        high_step = F.ceil((high_rank + 1 - start) / size * steps).cast("int") + 1
        low = F.when(hit & (low_step > 0), F.get(f"_g{i}", low_step)).otherwise(F.col(f"_lo{i}"))
        high = F.when(hit & (high_step < steps), F.get(f"_g{i}", high_step)).otherwise(F.col(f"_hi{i}"))
        # A rank outside its first fence opens that side again.
        fences.append(F.when(low_rank >= start, low).alias(f"_lo{i}"))
        fences.append(F.when(high_rank < start + size, high).alias(f"_hi{i}"))
    return counted.select(*keys, "_n", *fences)


def _ranks(n: Column, prob: float) -> tuple[Column, Column]:
    """0-based ranks of the two values that the quantile lies between."""
    position = (n - 1) * F.lit(prob)
    return F.floor(position), F.ceil(position)


def _kept_values(rows: DataFrame, keys: Sequence[str], n_probs: int) -> DataFrame:
    """Distinct values inside a fence with their counts; one row per stretch outside."""
    any_inside = F.lit(False)
    stretch = F.lit(0)
    for i in range(n_probs):
        any_inside = any_inside | _inside(i)
        stretch = stretch + _above(i).cast("int")
    marked = rows.select(*keys, "_n", "_v", stretch.alias("_stretch"), F.when(any_inside, F.col("_v")).alias("_key"))
    return marked.groupBy(*keys, "_n", "_stretch", "_key").agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
    )


def _pick(kept: DataFrame, keys: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    # Without keys this window is one task's; the fences bound its rows.
    w = Window.partitionBy(*keys).orderBy("_min", "_max").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = kept.withColumn("_to", F.sum("_c").over(w)).withColumn("_from", F.col("_to") - F.col("_c"))

    def value_at(rank: Column) -> Column:
        here = (rank >= F.col("_from")) & (rank < F.col("_to"))
        known = F.when(F.col("_min") == F.col("_max"), F.col("_min")).otherwise(
            F.raise_error(F.lit("a quantile rank fell outside its fence")).cast("double")
        )
        return F.max(F.when(here, known))

    aggs = [F.first("_n").alias("_n")]
    for i, prob in enumerate(probs.values()):
        low_rank, high_rank = _ranks(F.col("_n"), prob)
        aggs += [value_at(low_rank).alias(f"_l{i}"), value_at(high_rank).alias(f"_h{i}")]
    picked = ranked.groupBy(*keys).agg(*aggs)
    out = []
    for i, (name, prob) in enumerate(probs.items()):
        position = (F.col("_n") - 1) * F.lit(prob)
        low_rank, high_rank = _ranks(F.col("_n"), prob)
        low, high = F.col(f"_l{i}"), F.col(f"_h{i}")
        between = (high_rank - position) * low + (position - low_rank) * high
        out.append(F.when(low == high, low).otherwise(between).alias(name))
    return picked.select(*keys, *out)
