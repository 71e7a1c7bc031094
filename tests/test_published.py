"""Published figures, copied as numbers: coordinates, rates and costs must come out the same."""

import pytest
from pyspark.sql import functions as F

from lamina.functions.measures import rate, ratio
from lamina.operators.analysis import extreme_ratio
from lamina.operators.geo import reproject
from lamina.operators.marts import rollup_rate
from lamina.plans.reference import builtin_reference

POINTS = [
    (877590.4682209005, 6560998.786228255, 46.125511, 5.30023),
    (736156.0008737607, 6938626.6818053555, 49.545896, 3.499377),
    (689493.5263652642, 6586410.405691859, 46.377549, 2.863307),
]

# type, band, certificates, sieves, efficient, % sieves, % efficient, surface, cost, cost per m2
PROFILE = [
    ("appartement", "1948-1974", 1177057, 66473, 55194, "5.65", "4.69", 61.0, 1137, "18.6"),
    ("appartement", "1975-1988", 496916, 8429, 29419, "1.70", "5.92", 62.7, 1084, "17.3"),
    ("appartement", "1989-2000", 352330, 1433, 13066, "0.41", "3.71", 56.8, 973, "17.1"),
    ("appartement", "2001-2012", 359617, 513, 27752, "0.14", "7.72", 56.9, 872, "15.3"),
    ("appartement", "2013 et apres", 411843, 61, 93338, "0.01", "22.66", 55.5, 599, "10.8"),
    ("appartement", "avant 1948", 343003, 50445, 8798, "14.71", "2.56", 51.4, 1289, "25.1"),
    ("appartement", "inconnue", 2461956, 220144, 143415, "8.94", "5.83", 55.2, 1157, "21.0"),
    ("maison", "1948-1974", 307995, 73721, 13560, "23.94", "4.40", 108.4, 2755, "25.4"),
    ("maison", "1975-1988", 211232, 9936, 12524, "4.70", "5.93", 108.5, 2177, "20.1"),
    ("maison", "1989-2000", 135629, 1194, 10458, "0.88", "7.71", 105.4, 1814, "17.2"),
    ("maison", "2001-2012", 178051, 260, 25051, "0.15", "14.07", 105.8, 1573, "14.9"),
    ("maison", "2013 et apres", 110824, 28, 66946, "0.03", "60.41", 102.4, 913, "8.9"),
    ("maison", "avant 1948", 184962, 41679, 7613, "22.53", "4.12", 112.0, 2737, "24.4"),
    ("maison", "inconnue", 1272772, 222582, 101866, "17.49", "8.00", 110.0, 2484, "22.6"),
]


@pytest.fixture(scope="module")
def profile(spark):
    names = "kind string, band string, n long, sieves long, good long, sieve_pct string, good_pct string, " \
            "size double, cost long, per_m2 string"
    return spark.createDataFrame(PROFILE, names)


def test_coordinates(spark):
    df = spark.createDataFrame(POINTS, "x double, y double, lat double, lon double")
    for r in reproject(df, "x", "y").collect():
        assert (r["latitude"], r["longitude"]) == (r["lat"], r["lon"])


def test_points_off_the_map_keep_their_row(spark):
    df = spark.createDataFrame([(None, 1.0), (-9e6, 6.8e6), (700000.0, 6600000.0)], "x double, y double")
    assert [tuple(r[2:]) for r in reproject(df, "x", "y").collect()] == [(None, None), (None, None), (46.5, 3.0)]


def test_rates_and_costs(profile):
    out = profile.select(
        "sieve_pct", "good_pct", "per_m2",
        rate(F.col("sieves"), F.col("n")).cast("string").alias("a"),
        rate(F.col("good"), F.col("n")).cast("string").alias("b"),
        ratio(F.col("cost"), F.col("size")).cast("string").alias("c"),
    )
    for r in out.collect():
        assert (r["a"], r["b"], r["c"]) == (r["sieve_pct"], r["good_pct"], r["per_m2"])


def test_rates_roll_up_as_ratios_of_sums(profile):
    found = {r["kind"]: str(r["pct"]) for r in rollup_rate(profile, ["kind"], "sieves", "n", "pct", 1).collect()}
    assert found == {"appartement": "6.2", "maison": "14.5"}
    total = rollup_rate(profile, [], "sieves", "n", "pct").first()
    assert (total["n"], total["sieves"]) == (8004187, 696898)


def test_empty_denominators_are_null(spark):
    df = spark.sql("select 1L as a, 0L as b")
    assert tuple(df.select(rate(F.col("a"), F.col("b")), ratio(F.col("a"), F.col("b"))).first()) == (None, None)
    assert extreme_ratio(df, "b").first()["factor"] is None


def test_builtin_reference(spark):
    ref = builtin_reference(spark)
    assert (ref.count(), ref.filter("est_metropole").count()) == (108, 96)
    assert ref.select("code_departement").distinct().count() == 108
