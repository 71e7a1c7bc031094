"""Exact quantiles: both ways against a sort, with hot groups, ties and nulls."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lamina.operators.marts import Summary, summarise
from lamina.operators.quantiles import METHODS, exact_quantiles, fenced_quantiles, ranked_in_ranges

PROBS = {"lo": 0.0, "p1": 0.01, "p50": 0.5, "p90": 0.9, "hi": 1.0}


def expected(values, p):
    values = sorted(values)
    position = (len(values) - 1) * p
    low, high = math.floor(position), math.ceil(position)
    return values[low] + (position - low) * (values[high] - values[low])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    hot = [("hot", rng.lognormvariate(3, 2)) for _ in range(30000)]
    tied = [("tied", float(rng.randrange(3))) for _ in range(8000)]
    small = [(None, float(v)) for v in range(4)] + [("one", 5.0), ("one", None), ("none", None)]
    return hot + tied + small


def check(found, rows):
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).extend([] if v is None else [v])
    assert {r["k"] for r in found} == set(groups)
    for r in found:
        for name, p in PROBS.items():
            if groups[r["k"]]:
                assert r[name] == pytest.approx(expected(groups[r["k"]], p), rel=1e-12), (r["k"], name)
            else:
                assert r[name] is None


@pytest.mark.parametrize("method", METHODS)
def test_methods_agree(spark, rows, method):
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    check(exact_quantiles(df, ["k"], "v", PROBS, method, small_group=100).collect(), rows)


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.range(1), [], "id", PROBS, "guess")


@pytest.mark.parametrize("small", [10, 10**6])
def test_whole_column(spark, rows, small):
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    values = [v for _, v in rows if v is not None]
    found = fenced_quantiles(df, [], "v", PROBS, small_group=small).first()
    for name, p in PROBS.items():
        assert found[name] == pytest.approx(expected(values, p), rel=1e-12)


def test_fenced_plan_never_holds_a_whole_group(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    plan = fenced_quantiles(df, ["k"], "v", PROBS, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan.replace("percentile_approx(", "")
    assert "collect_list" not in plan


@pytest.mark.parametrize("method", ["state", "fenced"])
def test_summary_is_the_same_by_each_method(spark, rows, method):
    df = spark.createDataFrame(rows, "k string, v double").withColumn("w", F.lit(1.25))
    spec = Summary(flags={"big": F.col("v") > 10}, means={"m": ("w", 1)}, medians={"med": ("v", 1)})
    small, large = summarise(df, ["k"], spec), summarise(df, ["k"], spec, method)
    assert small.columns == large.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert {r["k"]: r["nb_dpe"] for r in large.collect()} == {"hot": 30000, "tied": 8000, None: 4, "one": 2, "none": 1}


def test_no_job_runs_while_a_summary_is_planned(spark):
    spec = Summary(means={"m": ("v", 1)}, medians={"med": ("v", 1)})
    df = spark.range(1000).selectExpr("id % 3 as k", "cast(id as double) as v")
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        planned = summarise(df, ["k"], spec)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
        assert planned.count() == 3
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture
def uncoalesced(spark):
    """Keeps every shuffle partition, so that small tables lie in many ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_ranges_of_a_hot_group(spark, rows, uncoalesced):
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    check(exact_quantiles(df, ["k"], "v", PROBS).collect(), rows)
    values = [v for _, v in rows if v is not None]
    found = exact_quantiles(df, [], "v", PROBS).first()
    assert all(found[n] == pytest.approx(expected(values, p), rel=1e-12) for n, p in PROBS.items())


def test_no_range_holds_a_hot_group(spark, rows, uncoalesced):
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    counted = df.groupBy("k", F.col("v").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    held = ranked_in_ranges(counted, ["k"], [0.5]).filter("k = 'hot'").count()
    assert 0 < held < 30000 / 5


def test_ranges_without_rows(spark):
    empty = spark.createDataFrame([], "k string, v double")
    assert exact_quantiles(empty, ["k"], "v", PROBS).count() == 0
    assert [r.asDict() for r in exact_quantiles(empty, [], "v", PROBS).collect()] == [dict.fromkeys(PROBS)]
    odd = exact_quantiles(empty.toDF("a key", "v"), ["a key"], "v", PROBS)
    assert odd.columns == ["a key", *PROBS]


def test_several_medians_from_one_scan(spark, uncoalesced):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    spec = Summary(
        flags={"a": F.col("l_returnflag") == "A"}, means={"m": ("l_quantity", 1)}, spans={"lo": ("min", "l_tax")},
        medians={"price": ("l_extendedprice", 1), "size": ("l_quantity", 1)},
    )
    one_pass, apart = summarise(lines, ["l_suppkey"], spec), summarise(lines, ["l_suppkey"], spec, "state")
    assert one_pass.columns == apart.columns
    assert sorted(map(str, one_pass.collect())) == sorted(map(str, apart.collect()))
    final = one_pass._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 1


def test_fences_of_groups_come_to_the_rows(spark, rows):
    """Spark knows how small the fences are, and shuffles no rows to their group's fence."""
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "65536")
    try:
        found = fenced_quantiles(df, ["k"], "v", PROBS, small_group=100)
        plan = found._jdf.queryExecution().executedPlan().toString()
        check(found.collect(), rows)
    finally:
        spark.conf.set(threshold, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
