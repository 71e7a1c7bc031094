"""Physical plans: what must reach the scan and what must not be shuffled or broadcast."""

from pyspark.sql import functions as F

from lamina.catalog.cleaning import orders_with_references
from lamina.catalog.registry import load
from lamina.operators import checks
from lamina.operators.clean import mark_superseded, orphan_references, superseded_keys
from lamina.operators.geo import reproject
from lamina.operators.labels import mode_label
from lamina.operators.ledger import only_months
from lamina.operators.marts import Summary, summarise, top_k
from lamina.sources.tables import write_partitions, year_window

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_year_window_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = table(spark, "orders").select("o_orderkey", F.year("o_orderdate").alias("annee"))
    write_partitions(rows, path, ["annee"])
    text = plan(year_window(spark.read.parquet(path), 1999, "annee").select("o_orderkey"))
    assert "PartitionFilters: [isnotnull(annee" in text
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_row_contracts_share_one_scan(spark):
    lines = table(spark, "lineitem")
    contracts = [checks.not_null("l", "l_orderkey"), checks.in_range("l", "l_quantity", 0, 50),
                 checks.accepted("l", "l_returnflag", ["A", "N", "R"])]
    text = plan(checks.run_checks({"l": lines}, contracts))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in text


def test_reprojection_stays_in_the_jvm(spark):
    df = spark.range(5).select(F.lit(700000.0).alias("x"), F.lit(6600000.0).alias("y"))
    text = plan(reproject(df, "x", "y"))
    assert "Python" not in text and "Exchange" not in text


def test_mode_label_ranks_counts_with_an_early_limit(spark):
    text = plan(mode_label(table(spark, "customer"), "c_nationkey", ["c_mktsegment"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("HashAggregate") == 2


def test_top_k_keeps_k_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(top_k(table(spark, "orders"), "o_totalprice", 15, ["o_orderkey"]))


def test_orphans_are_counted_before_the_join(spark):
    text = plan(orphan_references(orders_with_references(spark, SF), "k", "replaces"))
    assert text.index("LeftOuter") < text.index("HashAggregate")


def test_references_are_distinct_before_the_join(spark):
    text = plan(superseded_keys(orders_with_references(spark, SF), "k", "replaces"))
    assert text.index("Inner") < text.index("HashAggregate")


def test_child_keys_are_counted_before_the_join(spark):
    text = plan(checks.check_relationship(table(spark, "lineitem"), table(spark, "orders"), "l_orderkey", "o_orderkey"))
    assert text.index("LeftOuter") < text.index("HashAggregate")


def test_summary_is_one_aggregation(spark):
    spec = Summary(flags={"a": F.col("l_returnflag") == "A"}, means={"m": ("l_quantity", 1)}, medians={"d": ("l_tax", 1)})
    found = summarise(table(spark, "lineitem"), ["l_suppkey"], spec)
    found.collect()
    text = plan(found).split("== Initial Plan ==")[0]  # as it ran, with shared shuffles
    assert text.count("ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_tax:double,l_returnflag:string>") == 1
    # By (group, value), by ranges of these, by group and range; then only counts of ranges and the result.
    own = "\n".join(line for line in text.splitlines() if "ReusedExchange" not in line)
    assert text.count("ReusedExchange") == 1
    assert own.count("Exchange rangepartitioning") == 1 and own.count("REPARTITION_BY_COL") == 1
    assert own.count("Exchange hashpartitioning") == 4


def test_no_python_in_any_operator_module():
    from pathlib import Path

    import lamina

    for path in Path(lamina.__file__).parent.rglob("*.py"):
        if "llm" in path.parts:
            continue
        text = path.read_text()
        for word in ("pandas_udf", "applyInPandas", "mapInPandas", "F.udf", ".rdd", "crossJoin", "localCheckpoint"):
            assert word not in text, (path, word)


def test_rows_without_a_key_are_spread(spark):
    """A third of the rows have a blank key: none is left to the partition of the blank."""
    rows = spark.range(9000).selectExpr(
        "case when id % 3 = 0 then ' ' when id % 3 = 1 and id % 2 = 0 then null else cast(id as string) end as k",
        "cast(id + 1 as string) as replaces", "id as other",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = mark_superseded(rows, "k", "replaces")
        sizes = [n for n, in marked.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert len(sizes) > 1 and max(sizes) < 2 * min(sizes)
        assert marked.filter("(k is null or trim(k) = '') and est_remplace").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_metrics_read_their_rows_once(spark):
    text = plan(load()[0]["metrics_share"](spark, SF))
    assert text.count("Scan parquet") <= 2


def test_ledger_of_a_load_prunes_other_months(spark, tmp_path):
    months = spark.range(24).selectExpr("id", "cast(2023 + id div 12 as int) as annee", "cast(id % 12 + 1 as int) as mois")
    months.write.partitionBy("annee", "mois").parquet(str(tmp_path / "t"))
    text = plan(only_months(spark.read.parquet(str(tmp_path / "t")), [(2024, 3)]).groupBy("annee").count())
    assert "annee" in text.split("PartitionFilters: [")[1].split("]")[0] and "= 2024" in text
