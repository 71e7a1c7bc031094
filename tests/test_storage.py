"""Sources, sinks, the ledger and the whole flow on a small lake."""

import datetime as dt
import gzip

import pytest
from builders import HEADER, certificate, land
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.operators import ledger
from lamina.operators.checks import ContractError, check_freshness, gate, is_true, not_null, run_checks, unique
from lamina.plans.flow import Lake, load_bronze, load_warehouse, read_bronze, read_ledger, read_months, read_silver, read_strays, run
from lamina.plans.reference import builtin_reference
from lamina.sources import exports, snapshots
from lamina.sources.landing import file_headers, file_ranges, read_by_spark, read_landing
from lamina.sources.shared import shared_path
from lamina.sources.tables import dropped_by_window, read_table, write_partitions, year_window
from lamina.sources.warehouse import jdbc_sink, load_table, write_parallelism


# --- landing -----------------------------------------------------------------


def test_byte_order_mark_and_quotes(spark, tmp_path):
    land(tmp_path / "in", "a.csv", '"numero_dpe","etiquette_dpe"\n"A1","D"\n"A2",""\n')
    found = read_landing(spark, str(tmp_path / "in"), ["numero_dpe", "etiquette_dpe"])
    assert sorted(map(tuple, found.collect())) == [("A1", "D"), ("A2", None)]


def test_headers_in_other_orders_and_spellings(spark, tmp_path):
    folder = tmp_path / "in"
    land(folder, "a.csv", '"numero_dpe","conso_5 usages_par_m2_ef"\n"A1","73"\n')
    land(folder, "b.csv", "conso_5_usages_par_m2_ef,numero_dpe,unused\n74,A2,x\n", bom=False)
    land(folder, "empty.csv", "", bom=False)
    land(folder, "blank.csv", "  \n")
    land(folder, "header_only.csv", "numero_dpe\n")
    found = read_landing(spark, str(folder), ["numero_dpe", "conso_5_usages_par_m2_ef", "id_rnb"])
    assert sorted(map(tuple, found.collect())) == [("A1", "73", None), ("A2", "74", None)]


def test_codes_stay_as_they_are(spark, tmp_path):
    land(tmp_path / "in", "a.csv", "numero_dpe,surface_habitable_logement\n01,75.50\n02,n/a\n")
    found = read_landing(spark, str(tmp_path / "in"), ["numero_dpe", "surface_habitable_logement"])
    assert sorted(map(tuple, found.collect())) == [("01", "75.50"), ("02", None)]


@pytest.mark.parametrize("split", [23, 64, 1000])
def test_ranges_of_a_file_hold_each_row_once(spark, tmp_path, split):
    folder = tmp_path / "in"
    land(folder, "a.csv", "k,v\r\n" + "".join(f'{i},"{"x" * (i % 40)}, ""q"""\r\n' for i in range(60)) + "60,last")
    land(folder, "b.csv", "v,k\ny,100\n\nz,101\n", bom=False)
    files = [str(folder / n) for n in ("a.csv", "b.csv")]
    assert sum(end - start for task in file_ranges(files, split) for _, start, end in task) == sum(
        (folder / n).stat().st_size for n in ("a.csv", "b.csv")
    )
    found = {r["k"]: r["v"] for r in read_landing(spark, str(folder), ["k", "v"], split_bytes=split).collect()}
    assert found == {**{str(i): f'{"x" * (i % 40)}, "q"' for i in range(60)}, "60": "last", "100": "y", "101": "z"}


def test_landed_files_are_one_branch_and_read_as_spark_reads_them(spark, tmp_path):
    folder = tmp_path / "in"
    for i in range(5):
        land(folder, f"{i}.csv", f"k,c{i} x,unused\n{i},,u\n\"{i}b\",\"\",\n", bom=i % 2 == 0)
    (folder / "5.csv.gz").write_bytes(gzip.compress(b"c1 x,k\n7,zipped\n"))
    names = ["k", "c0_x", "c1_x", "absent"]
    found = read_landing(spark, str(folder), names)
    assert sorted(map(str, found.collect())) == sorted(
        str(r) for r in read_landing_by_spark(spark, str(folder), names).collect()
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Union" not in plan and "FileScan" not in plan


def read_landing_by_spark(spark, path, names):
    found = read_by_spark(spark, path, names)
    return found.select(*[F.nullif(F.col(n), F.lit("")).alias(n) for n in names])


def test_broken_rows_and_clashing_names_stop_a_load(spark, tmp_path):
    land(tmp_path / "in", "a.csv", "k,v\n1,2,3\n")
    with pytest.raises(Exception, match="Expected 2 columns"):
        read_landing(spark, str(tmp_path / "in"), ["k"]).collect()
    land(tmp_path / "clash", "a.csv", "a b,a_b\n1,2\n")
    with pytest.raises(Exception, match="clash after repair"):
        read_landing(spark, str(tmp_path / "clash"), ["a_b"]).collect()


def test_nothing_landed(spark, tmp_path):
    land(tmp_path / "in", "a.csv", "", bom=False)
    assert read_landing(spark, str(tmp_path / "in"), ["numero_dpe"]).count() == 0


def test_bronze_columns_are_unique_and_hold_the_keys():
    assert len(set(fixed.BRONZE_COLUMNS)) == len(fixed.BRONZE_COLUMNS) == 66
    assert {fixed.PRIMARY_KEY, fixed.PARTITION_DATE, "date_derniere_modification_dpe"} <= set(fixed.BRONZE_COLUMNS)
    assert len(fixed.WAREHOUSE_COLUMNS) == 40


# --- tables ------------------------------------------------------------------


def test_dynamic_overwrite_keeps_other_partitions_and_static_does_not(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("A", 2023), ("B", 2024)], "k string, annee int")
    write_partitions(rows, path, ["annee"])
    write_partitions(rows.filter("annee = 2024").withColumn("k", F.lit("C")), path, ["annee", "absent"])
    assert {r["k"] for r in read_table(spark, path).collect()} == {"A", "C"}
    write_partitions(rows.filter("annee = 2024"), path, ["annee"], "static")
    assert {r["k"] for r in read_table(spark, path).collect()} == {"B"}


def test_window_never_sees_null_years(spark):
    rows = spark.createDataFrame([("A", 2024), ("B", None), ("C", 2020)], "k string, annee_etablissement int")
    assert [r["k"] for r in year_window(rows, 2024).collect()] == ["A"]
    assert dropped_by_window(rows).first()["n_rows"] == 1
    assert year_window(rows, None).count() == 3
    assert year_window(rows.select("k"), 2024).count() == 3


def test_shared_path_follows_the_session(spark):
    assert shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_path(spark, "x") != shared_path(spark, "x")


@pytest.mark.parametrize(
    ("rows", "writers"), [(0, 1), (499_999, 1), (500_000, 2), (1_200_000, 3), (10**9, 8)]
)
def test_write_parallelism(rows, writers):
    assert write_parallelism(rows) == writers


def test_load_goes_through_the_sink_with_bounded_writers(spark):
    seen = {}

    def sink(df):
        seen["partitions"], seen["columns"] = df.rdd.getNumPartitions(), df.columns

    rows = spark.range(0, 100, 1, 5).withColumn("annee_etablissement", F.lit(2020) + (F.col("id") % 10).cast("int"))
    sink.max_writers = 8
    assert load_table(rows, sink, ["id", "nope"], since=2025, rows_per_part=20) == 50
    assert seen == {"partitions": 3, "columns": ["id"]}


def test_jdbc_sink_asks_for_a_batched_truncating_overwrite():
    calls = {}

    class Writer:
        def mode(self, m):
            calls["mode"] = m
            return self

        def option(self, k, v):
            calls[k] = v
            return self

        def jdbc(self, url, table, properties):
            calls["jdbc"] = (url, table, properties)

    class Frame:
        write = Writer()

    jdbc_sink("jdbc:x", "silver.t", {"user": "u"})(Frame())
    assert calls == {"mode": "overwrite", "truncate": True, "batchsize": 10000, "jdbc": ("jdbc:x", "silver.t", {"user": "u"})}


def test_declared_types_and_row_check(spark, tmp_path, monkeypatch):
    fields = [("code", "character varying"), ("n", "smallint"), ("x", "numeric"), ("t", "timestamp with time zone"), ("u", "money")]
    schema = exports.export_schema(fields)
    assert [f.dataType.simpleString() for f in schema] == ["string", "smallint", "double", "timestamp", "string"]
    rows = spark.range(7).select(F.lit("2A").alias("code"), F.col("id").alias("n"))
    assert exports.export_parquet(rows, str(tmp_path / "p"), fields[:2]) == 7
    assert spark.read.parquet(str(tmp_path / "p")).dtypes == [("code", "string"), ("n", "smallint")]

    class Wrong:
        get = {"n": 8}

    monkeypatch.setattr(exports, "_observed", lambda df: (df, Wrong()))
    with pytest.raises(exports.ExportMismatch):
        exports.export_parquet(rows, str(tmp_path / "q"))


def test_unknown_export_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        exports.export_all({"a": exports.Export(spark.range(1), "csv")}, str(tmp_path), ["b"])


# --- ledger ------------------------------------------------------------------


def months(df):
    return [(r["annee"], r["mois"]) for r in df.orderBy("annee", "mois").collect()]


def test_months_cover_both_ends(spark):
    found = ledger.month_calendar(spark, dt.date(2021, 11, 1), dt.date(2022, 2, 15))
    assert months(found) == [(2021, 11), (2021, 12), (2022, 1), (2022, 2)]
    leap = ledger.month_calendar(spark, dt.date(2024, 2, 10), dt.date(2024, 2, 10)).first()
    assert (leap["premier_jour"], leap["dernier_jour"]) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert ledger.month_calendar(spark, dt.date(2024, 2, 1), dt.date(2024, 1, 1)).count() == 0


def test_rolling_window(spark):
    found = ledger.rolling_months(F.lit(dt.date(2024, 2, 29)), spark.range(1))
    assert months(found) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]


def test_work_list_and_status(spark):
    calendar = ledger.month_calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 4, 30))
    announced = spark.createDataFrame([(2024, 1, 2), (2024, 2, 5), (2024, 3, 0), (2024, 4, 1)], "annee int, mois int, annonces long")
    rows = spark.createDataFrame([(2024, 1), (2024, 1), (2024, 2)], "annee int, mois int")
    done = ledger.completeness(rows, announced)
    assert months(ledger.work_list(calendar, done, announced)) == [(2024, 2), (2024, 4)]
    assert months(ledger.work_list(calendar, done, announced, force=True, cap=2)) == [(2024, 1), (2024, 2)]
    report = ledger.status(calendar, done)
    assert [r["etat"] for r in report.orderBy("mois").collect()] == ["ok", "INCOMPLÈTE", "absente", "absente"]
    assert tuple(ledger.status_totals(report).first()) == (3, 2)


# --- checks ------------------------------------------------------------------


def test_gate_stops_on_errors_only(spark):
    rows = spark.createDataFrame([(1, None), (1, 2)], "k int, v int")
    soft = run_checks({"t": rows}, [unique("t", rows, "k", "warn"), is_true("t", "v > 0"), not_null("t", "k")])
    assert {(r["check"], r["status"]) for r in gate(soft)} == {
        ("unique", "warn"), ("expression_is_true", "pass"), ("not_null", "pass"),
    }
    with pytest.raises(ContractError):
        gate(run_checks({"t": rows}, [not_null("t", "v")]))


@pytest.mark.parametrize(("days", "status"), [(14, "pass"), (15, "warn"), (31, "error")])
def test_freshness(spark, days, status):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1),), (None,)], "d date")
    now = dt.datetime(2024, 1, 1) + dt.timedelta(days=days)
    assert check_freshness(rows, "d", "t", now).first()["status"] == status
    assert check_freshness(rows.filter("d is null"), "d", "t", now).first()["status"] == "error"


# --- end to end --------------------------------------------------------------

def load(spark, lake, folder, rows, announced):
    land(folder, "page.csv", "\n".join([HEADER, *rows]) + "\n")
    said = spark.createDataFrame(announced, "annee int, mois int, annonces long")
    return load_bronze(spark, lake, str(folder), said, F.lit("q")).first()


def test_whole_flow(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    march = [
        certificate("A", modified="2024-03-11", label="F"), certificate("A", modified="2024-04-01", label="G"),
        certificate("OLD"), certificate("NEW", replaced="OLD", label="B", size="100", use="60"),
        certificate("BAD", size="0"), certificate("NOCODE", place="old05061", dept=""),
    ]
    first = load(spark, lake, tmp_path / "m3", march, [(2024, 3, 6)])
    assert (first["partitions_ecrites"], first["total_rows"], first["incomplete"]) == (1, 6, [])
    second = load(spark, lake, tmp_path / "m4", [certificate("APRIL", day="2024-04-02", place="RENNES", dept="")], [(2024, 4, 3)])
    assert (second["total_rows"], second["incomplete"]) == (1, ["annee=2024/mois=04"])
    again = load(spark, lake, tmp_path / "m3", march, [(2024, 3, 6)])
    assert again["total_rows"] == 6
    assert read_bronze(spark, lake).count() == 7
    assert spark.read.parquet(lake.ledger).count() == 2

    as_of = F.lit(dt.date(2024, 6, 1))
    rows = run(spark, with_missing(spark, lake), builtin_reference(spark), as_of)
    assert rows.exported == {
        "dim_commune": 3, "mart_performance_commune": 3, "mart_performance_departement": 2,
        "mart_profil_batiment": 1, "fct_dpe": 4,
    }
    current, rejects = read_silver(spark, lake)
    assert {r["numero_dpe"]: r["code_region_ban"] for r in current.collect()} == dict.fromkeys(["A", "NEW", "NOCODE", "APRIL"], "01")
    assert {r["numero_dpe"]: r["motif_rejet"] for r in rejects.collect()} == {
        "OLD": "remplace_par_dpe_recent", "BAD": "surface_invalide",
    }
    area = {r["code_departement"]: r for r in spark.read.parquet(lake.path("gold", "mart_performance_departement")).collect()}
    assert (area["05"]["nom_departement"], area["05"]["est_metropole"], area["05"]["nb_dpe"]) == ("Hautes-Alpes", True, 3)
    assert (str(area["05"]["taux_passoires_pct"]), str(area["05"]["conso_ep_mediane"])) == ("33.33", "200.0")
    assert area[None]["nom_departement"] == "Département non déterminé"
    located = spark.read.option("header", True).csv(lake.path("exports/report", "mart_performance_departement"))
    point = located.filter("code_departement = '05'").first()
    assert (round(float(point["latitude"]), 1), round(float(point["longitude"]), 1)) == (44.5, 6.1)
    assert rows.loaded == {"dpe_courant": 4, "dpe_rejets": 2} and rows.outside_window == {}
    assert rows.shares["lignes_bronze"] == "100.00%" and rows.shares["retenus"] == "57.14%"
    assert [c["check"] for c in rows.checks].count("freshness") == 1
    again = run(spark, lake, builtin_reference(spark), as_of, since=2024)
    assert again.exported == rows.exported and again.outside_window == {"dpe_courant": 0, "dpe_rejets": 0}
    assert load_warehouse(spark, lake, since=2025) == {"dpe_courant": 0, "dpe_rejets": 0}


def with_missing(spark, lake):
    """The landed pages carry few of the bronze columns; the others read as null."""
    assert set(fixed.BRONZE_COLUMNS) <= set(read_bronze(spark, lake).columns)
    return lake


def test_broken_contract_stops_before_the_exports(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    load(spark, lake, tmp_path / "in", [certificate("N", label="")], [(2024, 3, 1)])
    with pytest.raises(ContractError):
        run(spark, lake, builtin_reference(spark))
    assert not (tmp_path / "lake" / "exports").exists()


def test_a_load_never_replaces_rows_of_another(spark, tmp_path):
    """February, then March with a stray February row; both with an undated row."""
    lake = Lake(str(tmp_path / "lake"))
    february = [certificate(k, day="2024-02-03") for k in "ABC"]
    first = load(spark, lake, tmp_path / "m2", [*february, certificate("U1", day="?")], [(2024, 2, 3)])
    assert (first["total_rows"], first["incomplete"], first["hors_chargement"], first["sans_date"]) == (3, [], 0, 1)
    march = [certificate("M"), certificate("STRAY", day="2024-02-09"), certificate("U2", day="")]
    for _ in range(2):  # a load of the same months replaces itself
        second = load(spark, lake, tmp_path / "m3", march, [(2024, 3, 1)])
        assert (second["total_rows"], second["incomplete"], second["hors_chargement"], second["sans_date"]) == (1, [], 1, 1)
    assert {r["numero_dpe"] for r in read_bronze(spark, lake).collect()} == {"A", "B", "C", "M", "U1", "U2"}
    recorded = {r["mois"]: (r["rows_written"], r["is_complete"]) for r in spark.read.parquet(lake.ledger).collect()}
    assert recorded == {2: (3, True), 3: (1, True)}
    run(spark, lake, builtin_reference(spark), F.lit(dt.date(2024, 6, 1)), since=2024)
    _, rejects = read_silver(spark, lake)
    assert {r["numero_dpe"]: r["motif_rejet"] for r in rejects.collect()} == {"U1": "date_etablissement_absente", "U2": "date_etablissement_absente"}


def seen(spark, lake):
    """Months as a reader finds them: rows by month from bronze, and from the ledger."""
    rows = {r["mois"]: r["count"] for r in read_months(spark, lake).groupBy("mois").count().collect()}
    found = read_ledger(spark, lake)
    return rows, {} if found is None else {r["mois"]: r["rows_written"] for r in found.collect()}


@pytest.mark.parametrize("fails", ["put", "strays", "ledger"])
def test_a_load_that_fails_between_its_writes_changes_nothing(spark, tmp_path, monkeypatch, fails):
    lake = Lake(str(tmp_path / "lake"))
    assert seen(spark, lake) == ({}, {})
    load(spark, lake, tmp_path / "m2", [certificate("A", day="2024-02-03"), certificate("U", day="?")], [(2024, 2, 1)])
    before = seen(spark, lake)
    assert before == ({2: 1}, {2: 1})

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    late = [certificate(k, day="2024-02-04") for k in "BC"] + [certificate("M")]
    with monkeypatch.context() as m:
        if fails == "put":  # the rows are written, the rest is not
            m.setattr("lamina.plans.flow.manifest", stop)
        elif fails == "strays":
            m.setattr("lamina.plans.flow.next_strays", stop)
        else:  # the files of the next version are there, but not its marker
            m.setattr(snapshots, "_delete", stop)
        with pytest.raises(RuntimeError):
            load(spark, lake, tmp_path / "m3", late, [(2024, 2, 2), (2024, 3, 1)])
    if fails == "ledger":
        assert (tmp_path / "lake/bronze/ledger/version=2/_SUCCESS").exists()
        assert seen(spark, lake) == ({2: 2, 3: 1}, {2: 2, 3: 1})  # committed before it stopped
        (tmp_path / "lake/bronze/ledger/version=2/_SUCCESS").unlink()
    assert seen(spark, lake) == before
    assert {r["numero_dpe"] for r in read_bronze(spark, lake).collect()} == {"A", "U"}
    report = load(spark, lake, tmp_path / "m3", late, [(2024, 2, 2), (2024, 3, 1)])
    assert (report["total_rows"], report["incomplete"]) == (3, [])
    assert seen(spark, lake) == ({2: 2, 3: 1}, {2: 2, 3: 1})
    assert {r["numero_dpe"] for r in read_bronze(spark, lake).collect()} == {"B", "C", "M", "U"}
    # U's folder is still named, for its stray.
    assert len(lake.months.vacuum(spark)) == 1
    assert {r["numero_dpe"] for r in read_bronze(spark, lake).collect()} == {"B", "C", "M", "U"}


def test_two_loads_from_one_version_conflict(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    load(spark, lake, tmp_path / "m2", [certificate("A", day="2024-02-03")], [(2024, 2, 1)])
    table = lake.months
    with pytest.raises(snapshots.VersionConflict):
        table.commit(spark, 0, table.records(spark), table.stray_records(spark))
    assert seen(spark, lake) == ({2: 1}, {2: 1})


def test_first_lines_without_reading_on(spark, tmp_path):
    """Small files share a task, a large one is split over several."""
    for i in range(5):
        (tmp_path / f"{i}.csv").write_text(f"h{i},x\n" + "1,2\n" * 10)
    (tmp_path / "big.csv").write_text("hb,x\n" + "1,2\n" * 60_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        found = {r["file"].rsplit("/", 1)[1]: r["header"] for r in file_headers(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {**{f"{i}.csv": f"h{i},x" for i in range(5)}, "big.csv": "hb,x"}


def test_stray_rows_are_not_gathered_to_name_their_load(spark, tmp_path):
    """The names are broadcast; the rows, of which any number may be stray, stay where they are."""
    lake = Lake(str(tmp_path / "lake"))
    load(spark, lake, tmp_path / "m2", [certificate("S", day="2024-01-03"), certificate("U", day="?")], [(2024, 2, 1)])
    rows = read_strays(spark, lake)
    assert sorted((r["chargement"], r["numero_dpe"]) for r in rows.collect()) == [("2024-02", "S"), ("2024-02", "U")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan
