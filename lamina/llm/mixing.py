"""Mixing sources to target weights by a low-discrepancy schedule.

Slot ``t`` of the schedule has the point ``frac((t + 1) * golden ratio)``, which falls into
one source's interval of the cumulative target shares; so any stretch of the schedule
holds the sources nearly in proportion.  A source's slots are ranked, and its ``k``-th
slot reads the ``k``-th block of equally many words from the source's documents, shuffled
and repeated as often as its target needs.  The counts of the schedule are off by a few
blocks at most; closing slots at its end, and a short last block, bring every source to
its target exactly (rounded to words).

Targets: sources in code point order, null last, weigh 5, 2, 1, repeating.  They share
all words of the corpus, no source gets more than ``MAX_EPOCHS`` times its own words, and
what it can't take is shared by the others' weights until none is above.

The shuffle orders a source's documents by a seeded hash of doc_id, so reruns agree.
Repeated rows are interchangeable.  A document without words (null text, empty text)
takes nothing.  An empty table gives no rows; other columns are ignored.

Nothing is collected.  Documents are numbered in buckets of a source, and bucket totals
are summed up before, so that no window spans a source's documents; the same holds for
the slots of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import fresh, n_words, store

# The weights of the sources in turn, and the golden ratio's fraction.
WEIGHTS = (5, 2, 1)
GOLDEN = 0.6180339887498949
MAX_EPOCHS = 3
BLOCK_WORDS = 1024
# Buckets of a source's shuffled documents.
BUCKETS = 4096
# Slots that are ranked together.
CHUNK = 1 << 16
# Cells of the unit interval by which slots meet the sources' intervals.
CELLS = 1024


def targets(sizes: DataFrame) -> DataFrame:
    """Adds ``target`` and the source's number to (source, source_size), one row per source.

    Sources are capped in the order of their size per weight: a source is capped if the
    rate that the remaining words and weights give would put it above its cap.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())  # one row per source
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("number") % len(WEIGHTS)) + 1)
    rows = (
        sizes.withColumn("number", (F.row_number().over(by_name) - 1).cast("int"))
        .withColumn("weight", weight.cast("double"))
        .withColumn("cap", (F.col("source_size") * MAX_EPOCHS).cast("double"))
    )
    by_room = W.orderBy(F.col("cap") / F.col("weight"), "number")
    before, rest = by_room.rowsBetween(W.unboundedPreceding, -1), by_room.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("rate", left / F.sum("weight").over(rest))
    open_ = F.col("rate") * F.col("weight") < F.col("cap")
    final = F.min_by("rate", F.when(open_, F.col("cap") / F.col("weight"))).over(everything)
    return rows.withColumn(
        "target", F.least(F.col("cap"), F.coalesce(final * F.col("weight"), F.col("cap")))
    ).select("source", "source_size", "number", "target", F.round("target").cast("long").alias("quota"))


def schedule(mix: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots: (slot, number, block, words).  ``block`` counts a source's slots from 0."""
    spark = mix.sparkSession
    total = mix.agg(F.sum("quota")).first()[0] or 0  # one number
    n_slots = -(-total // block_words)
    share = F.col("quota") / F.lit(float(max(total, 1)))
    upto = F.sum(share).over(W.orderBy("number"))
    cells = (
        mix.filter("quota > 0")
        .select("number", "quota", (upto - share).alias("low"), upto.alias("high"))
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.floor(F.col("high") * CELLS))))
    )
    point = (F.col("slot") + 1) * F.lit(GOLDEN)
    slots = spark.range(n_slots).withColumnRenamed("id", "slot").withColumn("point", point - F.floor(point))
    drawn = (
        slots.withColumn("cell", F.floor(F.col("point") * CELLS))
        .join(cells, "cell")
        .filter((F.col("low") <= F.col("point")) & (F.col("point") < F.col("high")))
        .select("slot", "number", "quota", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    )
    tally = drawn.groupBy("number", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("number").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = tally.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = W.partitionBy("number", "chunk").orderBy("slot")
    ranked = (
        drawn.withColumn("k", F.row_number().over(inside) - 1)
        .join(starts, ["number", "chunk"])
        .select("slot", "number", "quota", (F.col("k") + F.col("start")).alias("block"))
    )
    given = tally.groupBy("number").agg(F.sum("n").alias("given"))
    needed = F.ceil(F.col("quota") / F.lit(block_words))
    closing = (
        mix.join(given, "number", "left")
        .withColumn("given", F.coalesce("given", F.lit(0)))
        .filter(F.col("given") < needed)
        .withColumn("block", F.explode(F.sequence(F.col("given"), needed - 1)))
        .select(F.lit(n_slots).alias("slot"), "number", "quota", "block")
    )
    words = F.least(F.lit(block_words).cast("long"), F.col("quota") - F.col("block") * block_words)
    return ranked.unionByName(closing).withColumn("words", words).filter("words > 0").drop("quota")


def laid_out(sized: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds bucket, place in it and the first word's place in the source's shuffled stream."""
    mixed = F.xxhash64(F.lit("mix"), "doc_id")
    rows = sized.withColumns({"mixed": mixed, "bucket": F.pmod(F.shiftright(mixed, 20), F.lit(buckets))})
    totals = rows.groupBy("number", "bucket").agg(F.sum("size").alias("n"))
    earlier = W.partitionBy("number").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = W.partitionBy("number", "bucket").orderBy("mixed", "doc_id", "size")
    return (
        rows.withColumns({"place": F.row_number().over(inside), "upto": F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0))})
        .join(starts, ["number", "bucket"])
        .withColumn("first_word", F.col("start") + F.col("upto") - F.col("size"))
        .drop("mixed", "start", "upto")
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, size: Column | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    narrow = store(docs.select("doc_id", "source", (n_words() if size is None else size).alias("size")), "sizes")
    plan = store(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    slots = store(schedule(plan, block_words), "schedule").select("number", "block", "words")
    known = narrow.withColumn("no_source", F.col("source").isNull()).fillna({"source": ""}).join(
        plan.withColumn("no_source", F.col("source").isNull()).fillna({"source": ""}), ["source", "no_source"]
    )
    placed = laid_out(known.withColumn("source", F.when(~F.col("no_source"), F.col("source"))).drop("no_source"))
    # A document lies once in each epoch of its source's stream.
    epochs = F.greatest(F.lit(1), F.ceil(F.col("quota") / F.greatest(F.col("source_size"), F.lit(1)))).cast("long")
    start = F.col("epoch") * F.col("source_size") + F.col("first_word")
    pieces = (
        placed.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)))
        .withColumns({"start": start, "end": start + F.col("size")})
        .withColumn(
            "block",
            F.explode(
                F.sequence(F.floor(F.col("start") / block_words), F.floor(F.greatest("start", F.col("end") - 1) / block_words))
            ),
        )
    )
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("end"), F.col("block") * block_words + F.col("words"))
    key = ["number", "bucket", "place", "doc_id", "source", "size", "source_size", "target"]
    return (
        pieces.join(slots, ["number", "block"], "left")
        .withColumn("got", F.when(F.col("words").isNull(), 0).otherwise(F.greatest(F.lit(0).cast("long"), high - low)))
        .groupBy(key)
        .agg(F.sum("got").alias("taken"))
        .drop("number", "bucket", "place")
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents of the mix, repeated as often as it takes them.

    A document that the mix takes ``x`` times its words is written ``x`` times, rounded; only
    one at the end of its source's quota isn't a whole number.  Rows that repeat doc_id,
    source and size share what they got.
    """
    id_, source_, size_, copies_, copy_ = (fresh(n, docs.columns) for n in ("id", "origin", "size", "copies", "copy"))
    got = (
        mix(docs, block_words)
        .filter("size > 0")
        .groupBy("doc_id", "source", "size")
        .agg(F.round(F.avg(F.col("taken") / F.col("size"))).cast("int").alias(copies_))
        .filter(F.col(copies_) > 0)
        .select(F.col("doc_id").alias(id_), F.col("source").alias(source_), F.col("size").alias(size_), copies_)
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col(id_))
        & F.col("source").eqNullSafe(F.col(source_))
        & (n_words() == F.col(size_))
    )
    return (
        docs.join(got, same)
        .withColumn(copy_, F.explode(F.sequence(F.lit(1), F.col(copies_))))
        .select(*docs.columns)
    )
