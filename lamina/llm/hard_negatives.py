"""Hard-negative mining in a multiway hyperplane tree with sibling ranges (GNAT style).

Vectors are floored to integers (``scale`` times a component), so that scores, the inner
products, are exact.  An added coordinate, the root of what a squared norm lacks to the
largest one, puts all rows on one sphere; there the score of a row is a falling function of
its Euclidean distance from the anchor, and a window of scores is an annulus.

A node of the tree has some split points; a row belongs to the nearest one's subtree.  Each
split point keeps the least and greatest distance from itself to the rows of every sibling
subtree.  An anchor looking into an annulus eliminates a sibling when, by the triangle
inequality, no row at such a distance from the split point can lie in the annulus.  Leaves
are scanned exactly, so results are exact whatever the tree eliminates.

The upper tree is grown on a bounded sample (``SAMPLE``, ``SAMPLE_BYTES``); its ranges are
taken over all rows.  Its leaves are cells; a task grows the rest of the tree for a block of
at most ``BLOCK_ROWS`` rows of a cell, so that a cell with a third of all rows (copies) is
many tasks' work.  An anchor visits its own cell first; what it finds there bounds the
annulus with which it visits the cells that are left: once for its positives, with one
window, and once for its negatives, with a window per positive.

Rows with a null id, label or vector, an empty vector, or null or non-finite components
take no part, nor do those of another length than the most frequent one (of two, the
longer).  Rows that share the anchor's id are neither its positives nor its negatives;
repeated anchor rows of equal vector and label count once, other repeated rows are rows of
their own.  Ties go to the smaller id.  A positive whose score is negative has no window.
Rows of a norm from 2^31 on take no part either: 64 bits don't hold their scores.  Other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import prepare, store

ARITY = 16
SAMPLE, SAMPLE_BYTES = 8192, 64 << 20
CELL_ROWS, MAX_CELLS = 2048, 1024
BLOCK_ROWS, LEAF_ROWS, QUERY_ROWS = 4096, 256, 2048
SEED = 12
# An open end of a window; scores are below it.
OPEN = 1 << 62
LARGEST = float(1 << 31)
# Rounding of a distance, as a part of the sphere's radius.
SLACK = 1e-6


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None], 0))


@dataclass
class Node:
    """Split points, the ranges of distances from each (row) to each subtree (column), and children: a node, or ~leaf."""

    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list[int]


class Tree:
    def __init__(self, nodes: list[Node], leaves: int):
        self.nodes, self.leaves = nodes, leaves

    def state(self) -> tuple:
        return [(n.points, n.low, n.high, n.children) for n in self.nodes], self.leaves

    @classmethod
    def of(cls, state: tuple) -> Tree:
        return cls([Node(*n) for n in state[0]], state[1])

    @classmethod
    def grown(cls, rows: np.ndarray, leaf_rows: int) -> tuple[Tree, np.ndarray]:
        """A tree over the rows, with their ranges, and each row's leaf."""
        rng = np.random.default_rng(SEED)
        tree, leaf = cls([], 0), np.zeros(len(rows), dtype=np.int32)

        def grow(at: np.ndarray) -> int:
            points = _split_points(rows[at], min(ARITY, -(-len(at) // leaf_rows)), rng) if len(at) > leaf_rows else None
            far = None if points is None else distances(rows[at], points)
            # Rows that the split points don't tell apart stay together.
            if far is None or len(np.unique(far.argmin(axis=1))) < 2:
                leaf[at] = tree.leaves
                tree.leaves += 1
                return ~(tree.leaves - 1)
            nearest = far.argmin(axis=1)
            node = Node(points, *_ranges(far, nearest), [])
            tree.nodes.append(node)
            number = len(tree.nodes) - 1
            for j in range(len(points)):
                node.children.append(grow(at[nearest == j]))
            return number

        grow(np.arange(len(rows)))
        return tree, leaf

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """Each row's leaf, and the ranges of these rows in each node that they pass."""
        leaf, ranges = np.zeros(len(rows), dtype=np.int32), {}
        todo = [(0, np.arange(len(rows)))] if self.nodes else []
        while todo:
            number, at = todo.pop()
            node = self.nodes[number]
            far = distances(rows[at], node.points)
            nearest = far.argmin(axis=1)
            ranges[number] = _ranges(far, nearest)
            for j, child in enumerate(node.children):
                here = at[nearest == j]
                if not len(here):
                    continue
                if child < 0:
                    leaf[here] = ~child
                else:
                    todo.append((child, here))
        return leaf, ranges

    def reach(self, anchors: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Which leaves can hold a row between ``near`` and ``far`` from an anchor."""
        out = np.zeros((len(anchors), max(1, self.leaves)), dtype=bool)
        wanted = np.flatnonzero(far >= near)
        if not self.nodes:
            out[wanted] = True
            return out
        todo = [(0, wanted)]
        while todo:
            number, at = todo.pop()
            node = self.nodes[number]
            d = distances(anchors[at], node.points)
            least = np.maximum(np.maximum(d - far[at, None], near[at, None] - d), 0)
            most = d + far[at, None]
            stays = ((least[:, :, None] <= node.high[None]) & (most[:, :, None] >= node.low[None])).all(axis=1)
            for j, child in enumerate(node.children):
                here = at[stays[:, j]]
                if not len(here):
                    continue
                if child < 0:
                    out[here, ~child] = True
                else:
                    todo.append((child, here))
        return out


def _split_points(rows: np.ndarray, n: int, rng) -> np.ndarray | None:
    """Up to ``n`` rows far from each other; none if the candidates are all alike."""
    if n < 2:
        return None
    candidates = rows[rng.choice(len(rows), min(len(rows), 3 * n), replace=False)]
    chosen, nearest = [0], distances(candidates, candidates[:1])[:, 0]
    while len(chosen) < n:
        following = int(nearest.argmax())
        if (candidates[following] == candidates[chosen]).all(axis=1).any():
            break
        chosen.append(following)
        nearest = np.minimum(nearest, distances(candidates, candidates[following : following + 1])[:, 0])
    return candidates[chosen] if len(chosen) > 1 else None


def _ranges(far: np.ndarray, nearest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = far.shape[1]
    low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    for j in range(k):
        mine = far[nearest == j]
        if len(mine):
            low[:, j], high[:, j] = mine.min(axis=0), mine.max(axis=0)
    return low, high


def on_sphere(rows: np.ndarray, top: float) -> np.ndarray:
    """Rows with the coordinate that lifts them to squared norm ``top``."""
    return np.column_stack([rows, np.sqrt(np.maximum(top - (rows**2).sum(axis=1), 0))])


def annuli(anchors: np.ndarray, low: np.ndarray, high: np.ndarray, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Distances on the sphere that hold the windows [low, high] (a row per anchor, a column per window)."""
    low, high = low.astype(np.float64), high.astype(np.float64)
    used = low <= high
    reach = (anchors**2).sum(axis=1) + top
    most = np.where(used, high, -np.inf).max(axis=1, initial=-np.inf)
    least = np.where(used, low, np.inf).min(axis=1, initial=np.inf)
    slack = SLACK * np.sqrt(reach) + SLACK
    near = np.sqrt(np.maximum(reach - 2 * np.minimum(most, OPEN), 0)) - slack
    far = np.sqrt(np.maximum(reach - 2 * np.maximum(least, -OPEN), 0)) + slack
    return np.where(used.any(axis=1), np.maximum(near, 0), np.inf), np.where(used.any(axis=1), far, -np.inf)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integers: in doubles while they hold them, else in whole numbers."""
    largest = np.sqrt((a**2).sum(axis=1).max(initial=0)) * np.sqrt((b**2).sum(axis=1).max(initial=0))
    if largest < 1 << 52:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in r] for r in m], dtype=object).reshape(m.shape) for m in (a, b)]
    return whole[0] @ whole[1].T


def first_of(place: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The first k of each place: higher scores first, ties by smaller id."""
    order = np.lexsort((ids, -scores, place))
    starts = np.flatnonzero(np.r_[True, place[order][1:] != place[order][:-1]]) if len(order) else np.array([], int)
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[nth < k]


ROW = "vec_id long, label string, vector binary, is_anchor boolean"
FOUND = "anchor_id long, ref long, slot int, vec_id long, score long"


def mine(
    table: DataFrame,
    is_anchor: Column,
    label: Column | str = "label",
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 5,
    percent: int = 80,
    cell_rows: int = CELL_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Each anchor's positives (best rows of its label) and for each the best rows of other labels that score
    between ``percent`` of the positive's score and that score."""
    spark = table.sparkSession
    prepare(spark)
    own = F.col(label) if isinstance(label, str) else label
    given = table.select(
        F.col(key).cast("long").alias("vec_id"), own.cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).filter("vec_id is not null and label is not null and size(vector) > 0")
    valid = store(given.mapInArrow(_floored(scale), ROW + ", dims int, norm double"), "vectors")
    by_length = valid.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top"))
    most = by_length.orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return spark.createDataFrame([], RESULT)
    dims, n, top = most["dims"], most["n"], most["top"]
    rows = valid.filter(F.col("dims") == dims).drop("dims", "norm")
    search = Search(rows, dims, n, top, cell_rows, block_rows)

    ahead = W.partitionBy("anchor_id", "ref", "slot").orderBy(F.desc("score"), "vec_id")

    def first(found: DataFrame, k: int) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(ahead)).filter(F.col("rank") <= k)

    def searched(asked: DataFrame, k: int, name: str) -> DataFrame:
        """The first k rows of every window, from the anchor's own cell and then from the others."""
        near = store(first(search.visit(asked, k, True), k), f"{name}-own")
        full = near.filter(F.col("rank") == k).groupBy("anchor_id", "ref").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth")
        )
        tighter = F.expr("transform(low, (x, i) -> greatest(x, coalesce(kth[i], x)))")
        bounded = asked.join(full, ["anchor_id", "ref"], "left").withColumn("low", tighter).drop("kth")
        return store(first(near.drop("rank").unionByName(search.visit(bounded, k, False)), k), name)

    ref = F.xxhash64("label", "vector").alias("ref")
    anchors = search.placed.filter("is_anchor").select(F.col("vec_id").alias("anchor_id"), ref, "label", "vector", "cell").distinct()
    open_window = [F.array(F.lit(x)).alias(c) for c, x in (("low", -OPEN), ("high", OPEN))]
    positives = searched(anchors.select("*", F.lit(True).alias("same"), *open_window), n_positives, "positives")
    windows = positives.groupBy("anchor_id", "ref").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("high")
    )
    # Rounded up; above its positive's score, an empty window, where that is negative.
    low = F.expr(f"transform(high, s -> (s * {percent} + 99) div 100)")
    asked = anchors.join(windows, ["anchor_id", "ref"]).select("*", F.lit(False).alias("same"), low.alias("low"))
    negatives = searched(asked, n_negatives, "negatives")
    paired = positives.select(
        "anchor_id", "ref", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return negatives.join(paired, ["anchor_id", "ref", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Search:
    """The tree over all rows, and visits to its cells."""

    def __init__(self, rows: DataFrame, dims: int, n: int, top: float, cell_rows: int, block_rows: int):
        spark = rows.sparkSession
        self.dims, self.top, self.block_rows = dims, top, block_rows
        wanted = max(2, min(SAMPLE, SAMPLE_BYTES // (8 * dims)))
        # Copies are in the sample together or not at all, and count once.
        slots = 1 << 30
        share = min(slots, 2 * slots * wanted // n + 1)
        place = F.pmod(F.xxhash64("vector"), F.lit(slots))
        found = rows.select("vector").filter(place < share).distinct().orderBy(place, "vector").limit(wanted).collect()
        sample = on_sphere(_matrix([r["vector"] for r in found], dims), top)
        cells = max(1, min(MAX_CELLS, -(-n // cell_rows)))
        tree, _ = Tree.grown(sample, max(1, -(-len(sample) // cells)))
        shared = spark.sparkContext.broadcast(tree.state())
        self.placed = store(rows.mapInArrow(_to_cells(shared, dims, top), ROW + ", cell int, row long"), "cells")
        # A row for each two siblings of the tree.
        ranges = rows.select("vector").mapInArrow(_measured(shared, dims, top), "node int, i int, j int, low double, high double")
        for node in tree.nodes:
            node.low[:], node.high[:] = np.inf, -np.inf
        for r in ranges.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            node = tree.nodes[r["node"]]
            node.low[r["i"], r["j"]], node.high[r["i"], r["j"]] = r["low"], r["high"]
        self.tree = spark.sparkContext.broadcast(tree.state())  # at most MAX_CELLS split points a level, and SAMPLE in all
        self.counts = _counts(self.placed)

    def visit(self, asked: DataFrame, k: int, own: bool) -> DataFrame:
        """The first k rows of each window in each block of the cells that an anchor must see."""
        spark = asked.sparkSession
        schema = "cell int, anchor_id long, ref long, label string, vector binary, same boolean, low array<long>, high array<long>"
        columns = ["cell", "anchor_id", "ref", "label", "vector", "same", "low", "high"]
        routed = store(asked.select(*columns).mapInArrow(_routed(self.tree, self.dims, self.top, own), schema), "routes")
        asking = _counts(routed)
        sizes = spark.createDataFrame(
            [(c, -(-n // self.block_rows), -(-asking[c] // QUERY_ROWS)) for c, n in self.counts.items() if c in asking],
            "cell int, blocks int, query_blocks int",
        )
        sides = []
        for side, name, mine, other in (
            (self.placed.drop("is_anchor"), "vec_id", "blocks", "query_blocks"),
            (routed, "anchor_id", "query_blocks", "blocks"),
        ):
            salt = F.col("row") if name == "vec_id" else F.pmod(F.xxhash64(name, "ref"), F.lit(1 << 30))
            met = (
                side.join(F.broadcast(sizes), "cell")  # a row per cell
                .withColumn(mine[:-1], (salt % F.col(mine)).cast("int"))
                .withColumn(other[:-1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            )
            sides.append(met.select(*side.columns, "block", "query_block").groupBy("cell", "block", "query_block"))
        return sides[0].cogroup(sides[1]).applyInArrow(_visited(self.dims, self.top, k), FOUND)


def _counts(table: DataFrame) -> dict[int, int]:
    return {r["cell"]: r["n"] for r in table.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per cell


def _matrix(column, dims: int) -> np.ndarray:
    rows = column if isinstance(column, list) else column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=np.float64).reshape(-1, dims)


def _floored(scale: int):
    def run(batches):
        for b in batches:
            at, found = [], []
            for i, row in enumerate(b.column(2).to_pylist()):
                if None not in row:
                    v = np.floor(scale * np.array(row, dtype=np.float64))
                    if np.isfinite(v).all() and np.abs(v).max() < LARGEST and (v**2).sum() < LARGEST**2:
                        at.append(i)
                        found.append(v)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(take), b.column(1).take(take), pa.array([v.tobytes() for v in found], pa.binary()),
                    b.column(3).take(take), pa.array([len(v) for v in found], pa.int32()),
                    pa.array([float((v**2).sum()) for v in found], pa.float64()),
                ],
                ["vec_id", "label", "vector", "is_anchor", "dims", "norm"],
            )

    return run


def _to_cells(shared, dims: int, top: float):
    def run(batches):
        tree, n = Tree.of(shared.value), 0
        for b in batches:
            cells, _ = tree.place(on_sphere(_matrix(b.column(2), dims), top))
            # Numbers deal equal rows over blocks.
            added = [pa.array(cells, pa.int32()), pa.array(np.arange(n, n + len(cells)), pa.int64())]
            n += len(cells)
            yield pa.RecordBatch.from_arrays([*b.columns, *added], [*b.schema.names, "cell", "row"])

    return run


def _measured(shared, dims: int, top: float):
    """Ranges over all rows of a task."""

    def run(batches):
        tree, found = Tree.of(shared.value), {}
        for b in batches:
            for number, (low, high) in tree.place(on_sphere(_matrix(b.column(0), dims), top))[1].items():
                if number in found:
                    low, high = np.minimum(found[number][0], low), np.maximum(found[number][1], high)
                found[number] = low, high
        rows = [
            (number, i, j, low[i, j], high[i, j])
            for number, (low, high) in found.items()
            for i, j in zip(*np.nonzero(np.isfinite(low)))
        ]
        columns = zip(*rows) if rows else ([],) * 5
        types = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["node", "i", "j", "low", "high"])

    return run


def _windows(table) -> tuple[np.ndarray, np.ndarray]:
    """Bounds by anchor and slot; anchors with fewer windows get empty ones."""
    low, high = (table.column(c).to_pylist() for c in ("low", "high"))
    slots = max(map(len, low), default=0)
    shape = (len(low), slots)
    return (
        np.array([r + [1] * (slots - len(r)) for r in low], dtype=np.int64).reshape(shape),
        np.array([r + [0] * (slots - len(r)) for r in high], dtype=np.int64).reshape(shape),
    )


def _routed(shared, dims: int, top: float, own: bool):
    def run(batches):
        tree = Tree.of(shared.value)
        for b in batches:
            if not b.num_rows:
                continue
            cells = b.column(0).to_numpy()
            if own:
                yield b
                continue
            for a in range(0, b.num_rows, 64):
                part = b.slice(a, 64)
                anchors = _matrix(part.column(4), dims)
                # An anchor's own point lies off the sphere: its added coordinate is 0.
                lifted = np.column_stack([anchors, np.zeros(len(anchors))])
                reach = tree.reach(lifted, *annuli(anchors, *_windows(part), top))
                reach[np.arange(len(anchors)), cells[a : a + 64]] = False
                at, cell = np.nonzero(reach)
                moved = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), *moved.columns[1:]], b.schema.names)

    return run


def _visited(dims: int, top: float, k: int):
    schema = pa.schema([("anchor_id", pa.int64()), ("ref", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return schema.empty_table()
        block = block.sort_by("vec_id")
        ids, rows = block.column("vec_id").to_numpy(), _matrix(block.column("vector"), dims)
        codes: dict[str, int] = {}
        labels = np.array([codes.setdefault(x, len(codes)) for x in block.column("label").to_pylist()])
        anchors, names = _matrix(asked.column("vector"), dims), asked.column("anchor_id").to_numpy()
        own = np.array([codes.get(x, -1) for x in asked.column("label").to_pylist()])
        same = asked.column("same").to_numpy()
        low, high = _windows(asked)
        tree, leaf = Tree.grown(on_sphere(rows, top), LEAF_ROWS)
        reach = tree.reach(np.column_stack([anchors, np.zeros(len(anchors))]), *annuli(anchors, low, high, top))
        places, partners, scores = [], [], []
        for n in range(tree.leaves):
            asking, here = np.flatnonzero(reach[:, n]), np.flatnonzero(leaf == n)
            if not len(asking):
                continue
            score = inner(anchors[asking], rows[here])
            fits = ((labels[here][None] == own[asking, None]) == same[asking, None]) & (ids[here][None] != names[asking, None])
            for slot in range(low.shape[1]):
                good = fits & (score >= low[asking, slot, None]) & (score <= high[asking, slot, None])
                # Rows lie in the order of their ids, so a stable sort settles ties.
                order = np.argsort(np.where(good, -score, OPEN), axis=1, kind="stable")[:, :k]
                row, column = np.nonzero(np.take_along_axis(good, order, axis=1))
                at = order[row, column]
                places.append(asking[row] * low.shape[1] + slot)
                partners.append(ids[here[at]])
                scores.append(score[row, at])
        if not places:
            return schema.empty_table()
        place, partner, score = (np.concatenate(x) for x in (places, partners, scores))
        best = first_of(place, partner, score, k)
        at, slot = place[best] // max(1, low.shape[1]), place[best] % max(1, low.shape[1])
        refs = asked.column("ref").to_numpy()
        columns = (names[at], refs[at], slot, partner[best], score[best])
        return pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return run
