"""The silver chain on hand-made rows: names, types, dedup, supersession, rules, bands."""

import datetime as dt

import pytest
from builders import row
from pyspark.sql import functions as F

from lamina.functions import fixed
from lamina.functions.casts import text_date
from lamina.operators.clean import (
    dedup_latest,
    mark_superseded,
    mark_written,
    normalise_names,
    superseded_as_written,
    superseded_keys,
)
from lamina.operators.quality import standard_rules
from lamina.plans.silver import current_rows, latest, metrics, prepare, rejected_rows, typed
from lamina.sources.shared import finer_tasks


def by_key(df, *columns):
    return {r["numero_dpe"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]]
            for r in df.select("numero_dpe", *columns).collect()}


def test_broken_names_are_repaired_and_data_kept(bronze):
    df = bronze(row()).withColumns(
        {"conso_5 usages_par_m2_ef": F.lit("73"), "emission_ges_5_usages par_m2": F.lit("5")}
    )
    out = normalise_names(df)
    assert not [c for c in out.columns if " " in c]
    assert out.first()["conso_5_usages_par_m2_ef"] == "73"
    assert out.first()["emission_ges_5_usages_par_m2"] == "5"


def test_clean_names_are_left_alone(bronze):
    df = bronze(row())
    assert normalise_names(df).columns == df.columns


def test_names_that_would_clash_are_refused(spark):
    with pytest.raises(ValueError):
        normalise_names(spark.range(1).select(F.lit(1).alias("a b"), F.lit(2).alias("a_b")))


def test_typing(bronze):
    out = typed(bronze(row(size="75.5")))
    types = dict(out.dtypes)
    assert types["date_etablissement_dpe"] == "date"
    assert types["surface_habitable_logement"] == "double"
    assert types["annee_construction"] == "int"
    assert out.first()["surface_habitable_logement"] == 75.5


def test_unreadable_number_is_null(bronze):
    assert typed(bronze(row(size="non renseigné"))).first()["surface_habitable_logement"] is None


@pytest.mark.parametrize(
    ("text", "value"),
    [("1948.0", 1948), ("1948.9", 1948), (" 1948 ", 1948), ("1e3", None), ("-3.2", -3), (".5", 0), ("abc", None), ("", None)],
)
def test_int_casts(bronze, text, value):
    assert typed(bronze(row(), annee_construction=text)).first()["annee_construction"] == value


@pytest.mark.parametrize(
    ("text", "value"),
    [("2024-05-12", dt.date(2024, 5, 12)), (" 2024-05-12 ", dt.date(2024, 5, 12)), ("2024-5-12", None), ("2024-02-30", None)],
)
def test_date_casts(bronze, text, value):
    assert typed(bronze(row(day=text))).first()["date_etablissement_dpe"] == value


def test_latest_version_is_kept(bronze):
    df = bronze(row("A1", modified="2024-05-12", label="D"), row("A1", modified="2024-09-30", label="C"))
    assert [r["etiquette_dpe"] for r in latest(df).collect()] == ["C"]


def test_unmodified_versions_come_last_and_ties_are_stable(bronze):
    df = bronze(row("A", modified=None, label="A"), row("A", label="B"), row("B", label="C"), row("B", label="D"))
    first = by_key(latest(df), "etiquette_dpe")
    assert first["A"] == "B"
    assert by_key(latest(df.repartition(3)), "etiquette_dpe") == first


def test_null_keys_are_one_row_unless_kept(bronze):
    df = bronze(row(None, label="A"), row(None, label="B"), row("X"))
    assert latest(df).count() == 2
    kept = prepare(df, keep_null_keys=True)
    assert kept.filter(F.col("motif_rejet") == fixed.MOTIVE_KEY).count() == 2
    assert kept.count() == 3


def test_dedup_is_on_the_raw_key_and_supersession_on_the_trimmed_one(bronze):
    df = prepare(bronze(row("A1"), row(" A1"), row("B", replaced="A1 ")))
    assert by_key(df, "est_remplace") == {"A1": True, " A1": True, "B": False}


def test_replaced_row_is_marked(bronze):
    df = mark_superseded(bronze(row("OLD"), row("NEW", replaced="OLD")), "numero_dpe", "numero_dpe_remplace")
    assert by_key(df, "est_remplace") == {"OLD": True, "NEW": False}


def test_chain_of_three_keeps_only_the_last(bronze):
    df = prepare(bronze(row("A"), row("B", replaced="A"), row("C", replaced="B")))
    assert [r["numero_dpe"] for r in current_rows(df).collect()] == ["C"]


def test_self_reference_marks_itself_and_invalid_rows_supersede(bronze):
    df = prepare(bronze(row("S", replaced="S"), row("A"), row("BAD", replaced="A", size="0")))
    assert by_key(df, "est_remplace") == {"S": True, "A": True, "BAD": False}


def test_only_existing_keys_count_as_superseded(bronze):
    df = bronze(row("A"), row("B", replaced="GONE"), row("C", replaced=" A "), row("D", replaced=None))
    assert [r[0] for r in superseded_keys(df, "numero_dpe", "numero_dpe_remplace").collect()] == ["A"]


def test_reject_motives(bronze):
    df = prepare(
        bronze(
            row("OK"), row("ZERO", size="0"), row("HUGE", size="5000"), row("LABEL", label="Z"), row("PLACE", place=" "),
            row("DAY", day="soon"), row(" "), row("EDGE", size="1000"), row("NAN", size="NaN"), row("NOSIZE", size=""),
        )
    )
    assert by_key(df, "motif_rejet") == {
        "OK": None, "ZERO": "surface_invalide", "HUGE": "surface_aberrante", "LABEL": "etiquette_dpe_invalide",
        "PLACE": "commune_absente", "DAY": "date_etablissement_absente", " ": "identifiant_absent",
        "EDGE": None, "NAN": "surface_aberrante", "NOSIZE": "surface_invalide",
    }


@pytest.mark.parametrize(
    ("use", "motive"),
    [("35000", "consommation_aberrante"), ("-1", "consommation_invalide"), ("", "consommation_invalide"), ("2000", None)],
)
def test_use_rules(bronze, use, motive):
    assert prepare(bronze(row(), conso_5_usages_par_m2_ep=use)).first()["motif_rejet"] == motive


def test_null_label_passes_by_default_and_fails_on_demand(bronze):
    df = bronze(row("N", label=None))
    default = prepare(df).first()
    assert default["est_valide"] and default["est_passoire_thermique"] is None
    assert prepare(df, rules=standard_rules(null_label="reject")).first()["motif_rejet"] == fixed.MOTIVE_LABEL


@pytest.mark.parametrize(
    ("status", "score", "reliable", "precise"),
    [
        ("adresse non géocodée ban car aucune correspondance", "0.95", False, False),
        ("adresse géocodée ban à l'adresse", "0.42", True, False),
        ("adresse géocodée ban à l'adresse", "0.64", True, True),
        (" Adresse Géocodée ban", None, True, False),
        (None, "0.95", False, False),
    ],
)
def test_geocoding_flags(bronze, status, score, reliable, precise):
    out = prepare(bronze(row(), statut_geocodage=status, score_ban=score)).first()
    assert (out["geocodage_fiable"], out["geocodage_precis"], out["est_valide"]) == (reliable, precise, True)


def test_enrichment(bronze):
    out = prepare(bronze(row("G", label="G"), row("A", label="A")), F.lit(dt.date(2030, 1, 1)))
    assert by_key(out, "est_passoire_thermique", "est_performant") == {"G": (True, False), "A": (False, True)}
    one = out.first()
    assert (one["tranche_age_batiment"], one["tranche_surface"]) == ("1975-1988", "60 a 90 m2")
    assert (one["annee_etablissement"], one["mois_etablissement"], one["dpe_encore_valide"]) == (2024, 5, True)


def test_missing_surface_and_year_bands(bronze):
    out = prepare(bronze(row(size=None), ), F.lit(dt.date(2035, 1, 2))).first()
    assert (out["tranche_surface"], out["dpe_encore_valide"]) == ("130 m2 et plus", False)
    assert prepare(bronze(row(), annee_construction=None)).first()["tranche_age_batiment"] == "inconnue"


def test_chain_is_repeatable_and_splits_without_overlap(bronze):
    df = bronze(
        row("A1"), row("A1"), row("OLD"), row("NEW", replaced="OLD"), row("BAD", size="0"), code_region_ban="01"
    )
    first, second = prepare(df), prepare(df)
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
    kept, dropped = by_key(current_rows(first), "etiquette_dpe"), by_key(rejected_rows(first), "motif_rejet")
    assert set(kept) == {"A1", "NEW"}
    assert dropped == {"OLD": "remplace_par_dpe_recent", "BAD": "surface_invalide"}


def test_metrics(bronze):
    df = bronze(row("A"), row("A"), row("OLD", size="0"), row("NEW", replaced="OLD"))
    found = {r["metrique"]: r["valeur"] for r in metrics(df, prepare(df)).collect()}
    assert found == {
        "lignes_bronze": 4, "apres_deduplication": 3, "remplaces": 1, "rejetes": 1, "retenus": 2,
        "geocodage_non_fiable": 0, "motif_surface_invalide": 1,
    }


def test_metrics_of_nothing_are_zero(bronze):
    df = bronze(row()).filter("false")
    assert {r["valeur"] for r in metrics(df, prepare(df)).collect()} == {0}


def test_dedup_with_one_hot_key_sends_one_row_per_task(spark):
    df = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    once = dedup_latest(df, ["k"], [F.desc("v")])
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert once.count() == 20001
    assert once.filter("k is null").first()["v"] == 29997


def test_marks_neither_shuffle_nor_sort_the_wide_rows(spark, bronze):
    """Even where the list of superseded keys is too long to broadcast, and when their partitions are many."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = prepare(bronze(row("A"), row(" A"), row("B", replaced="A "), row(None), row(" ", replaced="GONE")))
        assert by_key(df, "est_remplace") == {"A": True, " A": True, "B": False, None: False, " ": False}
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "Sort [" not in text
        assert text.count("Exchange") == 1 and "Bucketed: true" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("lamina_")]


def test_only_padded_keys_are_looked_up(spark):
    keys = [("A", None), (" A", " B"), ("A ", "A"), ("B", "C "), ("", " "), (None, "A")]
    df = spark.createDataFrame(keys, "k string, r string")
    listed = [r[0] for r in superseded_as_written(df, "k", "r").collect()]
    assert sorted(listed) == [" A", "A", "A ", "B", "C"]
    marked = {r["k"]: r["est_remplace"] for r in mark_written(df, "k", superseded_as_written(df, "k", "r")).collect()}
    assert marked == {"A": True, " A": True, "A ": True, "B": True, "": False, None: False}


@pytest.mark.parametrize("text", ["2024-05-1T", "2024-05-1\t", "2024-05", "2024-05- 1", "+024-05-01", "2024-13-01", "２０２４-05-01", "soon"])
def test_text_that_only_a_lenient_cast_reads_is_no_date(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(text_date(F.col("t"))).first()[0] is None


def test_dates_are_read_without_a_formatter(spark):
    df = spark.createDataFrame([("2024-05-12", "12/05/2024"), (" 0001-01-01 ", "")], "t string, u string")
    found = df.select(text_date(F.col("t")).alias("t"), text_date(F.col("u"), "dd/MM/yyyy").alias("u"))
    assert [tuple(r) for r in found.collect()] == [(dt.date(2024, 5, 12),) * 2, (dt.date(1, 1, 1), None)]
    text = df.select(text_date(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "gettimestamp" not in text.lower() and "to_date" not in text


def test_wide_stages_read_small_parts(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    for given, wanted in ((before, "16m"), ("1m", "1m")):
        spark.conf.set(key, given)
        with finer_tasks(spark):
            assert spark.conf.get(key) == wanted
        assert spark.conf.get(key) == given
    spark.conf.set(key, before)


@pytest.mark.parametrize("keep_null_keys", [False, True])
def test_buckets_follow_the_rows_and_not_the_session(spark, bronze, monkeypatch, tmp_path, keep_null_keys):
    """No window, sort or bucket of the stored rows holds more than its share, however many rows there are."""
    monkeypatch.setattr("lamina.sources.shared.TASK_ROWS", 50, raising=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = bronze(row()).drop("numero_dpe", "numero_dpe_remplace").crossJoin(spark.range(2000))
        rows = rows.selectExpr("*", "concat('K', id) numero_dpe", "if(id % 4 = 0, concat('K', id + 1), null) numero_dpe_remplace").drop("id")
        df = prepare(rows, keep_null_keys=keep_null_keys, work=str(tmp_path))
        assert (df.count(), df.filter("est_remplace").count()) == (2000, 500)
        stored = spark.read.parquet(f"{tmp_path}/latest").groupBy(F.input_file_name()).count()
        assert stored.agg(F.max("count")).first()[0] < 120
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_partitions_come_with_small_parts_of_files(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(k) for k in keys]
    with finer_tasks(spark, rows=100_000_000):
        assert [spark.conf.get(k) for k in keys] == ["16m", "763"]
    assert [spark.conf.get(k) for k in keys] == before


def test_queries_prepare_only_what_they_read(spark, monkeypatch):
    """Columns that no rule and no result of a query needs are not rendered, shuffled and stored."""
    from lamina.catalog import certificates

    plans, prepare = [], certificates.silver.prepare

    def noted(bronze, *args, **kwargs):
        plans.append(bronze._jdf.queryExecution().optimizedPlan().toString())
        return prepare(bronze, *args, **kwargs)

    monkeypatch.setattr(certificates.silver, "prepare", noted)
    for query in (certificates.certificates_rejected, certificates.certificates_new_houses, certificates.certificates_heating_cost):
        query(spark, "/root/testdata/sf0.001")
    assert len(plans) == 3 and not [p for p in plans if "VILLE " in p or "concat(0., lpad" in p]
