import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, lang, source)."""

    def build(*rows):
        full = [(i, t, *(rest or (None, None)), None if t is None else len(t)) for i, t, *rest in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def corpus(spark):
    """The whole smallest documents table, with awkward rows added."""
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    long = "wort " * 30_000
    odd = [
        (9001, None, None, None, None), (9002, "", "en", "", 0), (9003, " \t\n", None, "src1", 3), (9004, long, "de", "src1", len(long)),
        (9005, "a b", "en", None, 3), (9006, "a  b", "en", None, 4), (9007, "a b", "en", "zz", 3), (9008, "ß É 字  x", None, "src0", 7),
    ]
    return df.unionByName(spark.createDataFrame(odd, DOCUMENTS)).cache()


@pytest.fixture(scope="session")
def corpus_rows(corpus):
    return [(r["doc_id"], r["text"]) for r in corpus.collect()]


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names operators use inside or return."""

    def add(df, *names):
        from pyspark.sql import functions as F

        for n in names or ("size", "shard", "slot", "bucket", "place", "fingerprint", "hash", "content", "length", "n"):
            if n not in df.columns:
                df = df.withColumn(n, F.lit("x"))
        return df

    return add
