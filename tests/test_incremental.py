"""Silver after updates against silver built as a whole, and months loaded after a stop."""

import datetime as dt
import os
import random

import pytest
from builders import HEADER, certificate, land
from pyspark.sql import functions as F

from lamina.plans.backfill import backfill, months_between, progress, refresh
from lamina.plans.flow import Lake, load_bronze, read_bronze, read_silver
from lamina.plans.incremental import rebuild_silver, update_silver
from lamina.plans.silver import SilverPaths, build_silver, silver_schemas

def as_of():
    return F.lit(dt.date(2024, 6, 1))


def load(spark, lake, folder, rows, *months):
    land(folder, "page.csv", "\n".join([HEADER, *rows]) + "\n")
    said = spark.createDataFrame([(y, m, 1) for y, m in months], "annee int, mois int, annonces long")
    load_bronze(spark, lake, str(folder), said, F.lit("q"), folder.name.split("-")[0])


def files(path):
    return {
        os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def silver_rows(spark, lake):
    return [sorted(map(str, df.collect())) for df in read_silver(spark, lake)]


def whole(spark, lake, root):
    """Current rows, rejects and metrics as a full build of the same bronze writes them."""
    paths = SilverPaths.under(str(root))
    build_silver(read_bronze(spark, lake), paths, as_of())
    tables = [spark.read.schema(s).parquet(p) for s, p in zip(silver_schemas(spark), (paths.current, paths.rejects))]
    metrics = {r["metrique"]: r["valeur"] for r in spark.read.parquet(paths.metrics).collect()}
    return [sorted(map(str, df.collect())) for df in tables], metrics


def test_a_moved_key_leaves_no_copy_and_others_keep_their_files(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    early = [certificate("A", day="2023-05-01", modified="2023-05-02"), certificate("B", day="2023-05-03"),
             certificate("OLD", day="2023-05-04"), certificate("BAD", day="2023-05-05", size="0"), certificate("U", day="?")]
    load(spark, lake, tmp_path / "m5", early, (2023, 5))
    load(spark, lake, tmp_path / "m7", [certificate("C", day="2022-07-01")], (2022, 7))
    assert update_silver(spark, lake, as_of()) is None
    before = files(lake.silver.current), files(lake.silver.rejects)
    nothing = update_silver(spark, lake, as_of())
    assert (nothing.months, nothing.keys) == ([], 0) and (files(lake.silver.current), files(lake.silver.rejects)) == before
    # A moves to 2024, NEW supersedes OLD of an unchanged month.
    late = [certificate("A", day="2024-01-05", modified="2024-01-06"), certificate("NEW", day="2024-01-07", replaced="OLD")]
    load(spark, lake, tmp_path / "m1", late, (2024, 1))
    found = update_silver(spark, lake, as_of())
    assert found.months == [(2024, 1)] and found.keys == 3
    assert {p[1] for p in found.current} == {2023, 2024} and found.rejects == [(2023,)]
    after = files(lake.silver.current)
    assert {f: t for f, t in after.items() if "2022" in f} == {f: t for f, t in before[0].items() if "2022" in f}
    expected, metrics = whole(spark, lake, tmp_path / "whole")
    assert silver_rows(spark, lake) == expected
    assert {r["metrique"]: r["valeur"] for r in spark.read.parquet(lake.silver.metrics).collect()} == metrics
    # The last row of a year goes: its partition goes with it.
    load(spark, lake, tmp_path / "m7-again", [certificate("C", day="2024-02-01"), certificate("D", day="2022-07-09", place="")], (2022, 7))
    load(spark, lake, tmp_path / "m2", [certificate("C", day="2024-02-01")], (2024, 2))
    update_silver(spark, lake, as_of())
    assert not any("2022" in f for f in files(lake.silver.current))
    assert silver_rows(spark, lake) == whole(spark, lake, tmp_path / "whole2")[0]


@pytest.mark.parametrize("seed", [1])
def test_updates_equal_a_rebuild(spark, tmp_path, seed):
    rng, lake = random.Random(seed), Lake(str(tmp_path / "lake"))
    keys = [f"K{i}" for i in range(12)] + ["", " K1"]

    def some(year, month):
        return [
            certificate(
                rng.choice(keys), rng.choice([*keys, "", ""]), rng.choice([f"{year}-{month:02d}-0{rng.randint(1, 9)}", "?", "2021-01-01"]),
                f"2024-0{rng.randint(1, 9)}-01", rng.choice("ADG"), rng.choice(["05061", "75056"]), size=rng.choice(["80", "80", "0"]),
            )
            for _ in range(rng.randint(1, 8))
        ]

    months = [(2023, 1), (2023, 2), (2024, 1)]
    for step in range(3):
        for year, month in rng.sample(months, 2 if step else 3):
            load(spark, lake, tmp_path / f"{year}{month}-{step}", some(year, month), (year, month))
        if step == 0:
            rebuild_silver(spark, lake, as_of())
        else:
            update_silver(spark, lake, as_of())
    expected, metrics = whole(spark, lake, tmp_path / "whole")
    assert silver_rows(spark, lake) == expected
    assert {r["metrique"]: r["valeur"] for r in spark.read.parquet(lake.silver.metrics).collect()} == metrics


def test_an_update_that_stops_is_done_again(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path / "lake"))
    load(spark, lake, tmp_path / "m5", [certificate("A", day="2023-05-01"), certificate("B", day="2023-05-02")], (2023, 5))
    rebuild_silver(spark, lake, as_of())
    load(spark, lake, tmp_path / "m1", [certificate("A", day="2024-01-05", modified="2024-05-01"), certificate("X", day="2024-01-06", size="0")], (2024, 1))

    def stop(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr("lamina.plans.incremental.write_metrics", stop)
        with pytest.raises(RuntimeError):
            update_silver(spark, lake, as_of())
    assert update_silver(spark, lake, as_of()).months == [(2024, 1)]
    assert silver_rows(spark, lake) == whole(spark, lake, tmp_path / "whole")[0]


class Pages:
    """A source of made-up months: months by number of rows; some of them break."""

    def __init__(self, spark, rows, broken=()):
        self.spark, self.rows, self.broken, self.landed = spark, rows, set(broken), []

    def announced(self, calendar):
        said = self.spark.createDataFrame([(*m, n) for m, n in self.rows.items()], "annee int, mois int, annonces long")
        return calendar.join(said, ["annee", "mois"])

    def land(self, months, folder):
        self.landed += months
        if self.broken & set(months):
            raise OSError("no answer")
        lines = [certificate(f"{y}{m}-{i}", day=f"{y}-{m:02d}-0{i + 1}") for y, m in months for i in range(self.rows[y, m])]
        os.makedirs(folder)
        with open(f"{folder}/page.csv", "w") as f:
            f.write("\n".join([HEADER, *lines]) + "\n")

    def filter_of(self):
        return F.concat_ws("-", "annee", "mois")


def test_a_rerun_loads_only_what_is_missing(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    source = Pages(spark, {(2024, 1): 2, (2024, 2): 1, (2024, 3): 0, (2024, 4): 3}, broken=[(2024, 2)])
    calendar = months_between(spark, dt.date(2024, 1, 1), dt.date(2024, 5, 31))
    first = backfill(spark, lake, source, calendar)
    assert first.loaded == [(2024, 1), (2024, 4)] and first.failed == {(2024, 2): "OSError: no answer"}
    state = {r["mois"]: (r["etat"], r["passages"], r["derniere_erreur"]) for r in progress(spark, lake, calendar).collect()}
    assert state == {
        1: ("ok", 1, None), 2: ("absente", 1, "OSError: no answer"), 3: ("absente", 0, None), 4: ("ok", 1, None), 5: ("absente", 0, None),
    }
    source.broken, source.landed = set(), []
    assert backfill(spark, lake, source, calendar).loaded == source.landed == [(2024, 2)]
    assert backfill(spark, lake, source, calendar).loaded == []
    source.landed = []
    again = refresh(spark, lake, source, F.lit(dt.date(2024, 4, 9)), n=2, batch=2)
    assert again.loaded == source.landed == [(2024, 2), (2024, 4)]
    assert read_bronze(spark, lake).count() == 6
    source.broken = {(2024, 1)}
    with pytest.raises(OSError):
        backfill(spark, lake, source, calendar, force=True, cap=1, stop_on_failure=True)
    assert {r["mois"]: r["passages"] for r in progress(spark, lake, calendar).collect()} == {1: 2, 2: 3, 3: 0, 4: 2, 5: 0}
