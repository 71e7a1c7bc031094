import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from lamina.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def bronze(spark):
    """Builds bronze rows from (key, replaced key, date, modified, received, label, place, size)."""
    from pyspark.sql import functions as F

    names = [
        "numero_dpe", "numero_dpe_remplace", "date_etablissement_dpe", "date_derniere_modification_dpe",
        "date_reception_dpe", "etiquette_dpe", "code_insee_ban", "surface_habitable_logement",
    ]
    constants = {
        "conso_5_usages_par_m2_ep": "150",
        "score_ban": "0.95",
        "statut_geocodage": "adresse géocodée ban à l'adresse",
        "date_fin_validite_dpe": "2035-01-01",
        "annee_construction": "1980",
    }

    def build(*rows, **overrides):
        df = spark.createDataFrame(list(rows), ", ".join(f"{n} string" for n in names))
        values = {**constants, **overrides}
        return df.withColumns({n: F.lit(v).cast("string") for n, v in values.items()})

    return build
