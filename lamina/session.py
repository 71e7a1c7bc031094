"""Session options that the library's wide plans run best with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The JVM never compiles a method of more than 8000 bytes of bytecode, while Spark by
# default accepts generated methods of up to 65535.  A projection that casts dozens of
# text columns lands in between and would run interpreted, several times slower than
# the same projection split into small methods, which is what Spark does beyond the
# limit set here.
#
# A join followed by an aggregation on the same keys needs no shuffle in between, and
# for its sake Spark leaves a skewed join partition whole.  Splitting it and shuffling
# the partial aggregates is far cheaper than one task with a third of the rows.
OPTIONS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in OPTIONS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
