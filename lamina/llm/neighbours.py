"""Approximate nearest neighbours by adaptive dimension scan in probed lists.

An index of lists is fitted on a bounded sample of different vectors that take part: k-means centroids (about the root of the
number of vectors, at most ``MAX_LISTS``), a random rotation, and the number of lists to
probe, which is the least that reaches ``recall`` on the sample itself.  Every vector is
indexed: it goes to the list of its nearest centroid, and lists are cut into blocks of
bounded size, so that a list with a third of all vectors is many tasks' work.

A query probes its nearest lists.  In a block, vectors are rotated and scanned in column
blocks: after each, the squared distance so far, scaled up to all dimensions, is held
against the tenth best known, with a margin that shrinks as more dimensions are seen (a
hypothesis test: a rotated vector's coordinates are a random sample of it).  What fails
is abandoned, what survives all columns gets its exact distance in double precision on the
original vectors.

Vectors that are null, zero, of another length than the most frequent one, or
hold null or non-finite components take no part.  Rows that repeat a vec_id are rows of
their own, but none is a candidate for a query of that id; a repeated query row counts
once.  Ties go to the smaller vec_id.  A null vec_id takes no part.  Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import prepare, store

SAMPLE = 20_000
MAX_LISTS = 4096
ROUNDS = 8
# Rows of one block of a list, and queries that meet it in one task.
BLOCK_ROWS = 4096
COLUMNS = 16
# Margin of the test in standard deviations of a partial distance.
MARGIN = 2.1
SEED = 20


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray
    rotation: np.ndarray
    probes: int

    @property
    def dims(self) -> int:
        return self.centroids.shape[1]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None], 0)


def vectors(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their vectors."""
    rows = column.to_pylist()
    dims = dims or max((len(r) for r in rows if r is not None), default=0)
    at = [i for i, r in enumerate(rows) if r is not None and len(r) == dims and None not in r]
    found = np.array([rows[i] for i in at], dtype=np.float64).reshape(len(at), dims)
    good = np.isfinite(found).all(axis=1) & (found != 0).any(axis=1)
    return np.array(at, dtype=np.int64)[good], found[good]


def fit(sample: np.ndarray, n: int, recall: float = 0.95, k: int = 10, max_lists: int = MAX_LISTS) -> Index:
    """Lists for ``n`` vectors of which ``sample`` is a part."""
    rng = np.random.default_rng(SEED)
    lists = int(max(1, min(max_lists, round(n**0.5), len(sample))))
    centroids = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(ROUNDS):
        nearest = squared(sample, centroids).argmin(axis=1)
        sums, counts = np.zeros_like(centroids), np.bincount(nearest, minlength=lists)
        np.add.at(sums, nearest, sample)
        centroids = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centroids)
    rotation, _ = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))
    return Index(centroids, rotation, _probes(sample, centroids, recall, k, rng))


def _probes(sample, centroids, recall, k, rng) -> int:
    """The least number of lists that finds ``recall`` of the sample's own neighbours."""
    queries = sample[rng.choice(len(sample), min(200, len(sample)), replace=False)]
    distance = squared(queries, sample)
    near = np.argsort(distance, axis=1, kind="stable")[:, 1 : k + 1]  # the first is the query itself, or its equal
    if not near.size:
        return len(centroids)
    order = np.argsort(np.argsort(squared(queries, centroids), axis=1), axis=1)
    needed = np.take_along_axis(order, squared(sample, centroids).argmin(axis=1)[near], axis=1).ravel()
    return int(min(len(centroids), np.quantile(needed, recall, method="higher") + 1))


def scan(query: np.ndarray, turned_query: np.ndarray, block: np.ndarray, turned: np.ndarray, ids: np.ndarray, own: int, k: int):
    """The k nearest rows of a block (their places and exact distances)."""
    d = block.shape[1]
    rows = np.flatnonzero(ids != own)
    first = rows[: max(4 * k, 64)]
    exact = np.sqrt(((block[first] - query) ** 2).sum(axis=1))
    limit = np.partition(exact, k - 1)[k - 1] ** 2 if len(first) >= k else np.inf
    alive, sums = rows[len(first) :], np.zeros(len(rows) - len(first))
    for at in range(0, d, COLUMNS):
        upto = min(d, at + COLUMNS)
        sums = sums + ((turned[alive, at:upto] - turned_query[at:upto]) ** 2).sum(axis=1)
        # At the end the margin is only for rounding.
        slack = 1 + MARGIN * np.sqrt(2 * (1 - upto / d) / upto) if upto < d else 1 + 1e-9
        stays = sums * (d / upto) <= limit * slack**2
        alive, sums = alive[stays], sums[stays]
    found = np.concatenate([first, alive])
    distance = np.concatenate([exact, np.sqrt(((block[alive] - query) ** 2).sum(axis=1))])
    best = np.lexsort((ids[found], distance))[:k]
    return found[best], distance[best]


def sampled(rows: DataFrame, dims: int, n: int, most: int) -> np.ndarray:
    """Different vectors among ``n`` rows, the same in each run; tasks pass on about twice as many as are taken.

    Copies are in the sample together or not at all, so a share that copies leave empty is widened.
    """
    slots, share = 1 << 30, min(1.0, 2 * most / n)
    place = F.pmod(F.xxhash64("vector"), F.lit(slots))
    while True:
        found = rows.select("vector").filter(place < int(slots * share) + 1).distinct().orderBy(place, "vector").limit(most)
        column = found.toArrow().column(0)
        if len(column) >= min(most, 1000) or share >= 1:
            return vectors(column.combine_chunks(), dims)[1]
        share = min(1.0, 16 * share)


LISTED = "vec_id long, list int, vector binary"


def nearest(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    recall: float = 0.95,
    block_rows: int = BLOCK_ROWS,
    sample_rows: int = SAMPLE,
) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of each query's k nearest found."""
    spark = table.sparkSession
    prepare(spark)
    rows = table.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("is_query")
    )
    good = "forall(vector, x -> x is not null and abs(x) < double('infinity')) and exists(vector, x -> x <> 0)"
    lengths = rows.filter(good).groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vector") == most["dims"]).filter(good)
    sample = sampled(rows, most["dims"], most["n"], sample_rows)
    index = fit(sample, most["n"], recall, k)
    shared = spark.sparkContext.broadcast(astuple(index))  # at most MAX_LISTS centroids
    listed = store(
        rows.select("vec_id", "vector", "is_query").mapInArrow(_to_lists(shared), LISTED + ", is_query boolean"), "lists"
    )
    counts = {r["list"]: r["n"] for r in listed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per list
    # Rows of the query's own id are no candidates, however many there are.
    repeated = listed.groupBy("vec_id").agg(F.count(F.lit(1)).alias("own")).filter("own > 1")
    asked = listed.filter("is_query").select("vec_id", "vector").distinct().join(repeated, "vec_id", "left")
    probed = store(asked.mapInArrow(_probed(shared, counts, k), LISTED), "probes")
    asking = {r["list"]: r["n"] for r in probed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = spark.createDataFrame(
        [(i, -(-n // block_rows), -(-asking[i] // block_rows)) for i, n in counts.items() if i in asking],
        "list int, blocks int, query_blocks int",
    )
    salt = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(1 << 30))
    sides = []
    for side, own, other in ((listed.drop("is_query"), "blocks", "query_blocks"), (probed, "query_blocks", "blocks")):
        meeting = (
            side.join(F.broadcast(sizes), "list")  # a row per list
            .withColumn(own[:-1], (salt % F.col(own)).cast("int"))
            .withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        )
        sides.append(meeting.select("list", "block", "query_block", "vec_id", "vector").groupBy("list", "block", "query_block"))
    best = sides[0].cogroup(sides[1]).applyInArrow(_scanned(shared, k), "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _binary(found: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in found], pa.binary())


def _matrix(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float64).reshape(-1, dims)


def _to_lists(shared):
    def run(batches):
        index = Index(*shared.value)
        for b in batches:
            at, found = vectors(b.column(1), index.dims)
            lists = squared(found, index.centroids).argmin(axis=1).astype(np.int32) if len(at) else np.array([], np.int32)
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), pa.array(lists), _binary(found), b.column(2).take(take)], ["vec_id", "list", "vector", "is_query"]
            )

    return run


def _probed(shared, counts: dict[int, int], k: int):
    """Each query once for each list that it probes: so many lists, and more until they hold enough besides its own rows."""

    def run(batches):
        index = Index(*shared.value)
        held = np.array([counts.get(i, 0) for i in range(len(index.centroids))])
        for b in batches:
            if not b.num_rows:
                continue
            order = np.argsort(squared(_matrix(b.column(1), index.dims), index.centroids), axis=1, kind="stable")
            own = b.column(2).fill_null(1).to_numpy()
            enough = (np.cumsum(held[order], axis=1) < 2 * k + own[:, None]).sum(axis=1) + 1
            n = np.minimum(np.maximum(index.probes, enough), order.shape[1])
            for a in range(0, b.num_rows, 64):
                rows = np.repeat(np.arange(a, min(a + 64, b.num_rows)), n[a : a + 64])
                lists = np.concatenate([order[i, : n[i]] for i in range(a, min(a + 64, b.num_rows))]).astype(np.int32)
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), pa.array(lists), b.column(1).take(take)], ["vec_id", "list", "vector"]
                )

    return run


def _scanned(shared, k: int):
    def run(block: pa.Table, queries: pa.Table) -> pa.Table:
        index = Index(*shared.value)
        found: tuple[list, list, list] = ([], [], [])
        if block.num_rows and queries.num_rows:
            ids, data = block.column("vec_id").to_numpy(), _matrix(block.column("vector"), index.dims)
            asked = _matrix(queries.column("vector"), index.dims)
            turned, turned_queries = data @ index.rotation, asked @ index.rotation
            for own, query, turned_query in zip(queries.column("vec_id").to_pylist(), asked, turned_queries):
                at, distance = scan(query, turned_query, data, turned, ids, own, k)
                found[0].extend([own] * len(at))
                found[1].extend(ids[at].tolist())
                found[2].extend(distance.tolist())
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(found, types)], names=["query_id", "vec_id", "score"])

    return run
