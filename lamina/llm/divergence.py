"""Source divergence audit: how far each source's use of terms is from the other sources of its language.

Single-pass in-memory indexing.  A task reads documents once and keeps postings of the
block in memory: occurrences and documents per (term, language, source).  When the block
holds ``BLOCK_POSTINGS`` of them it is spilled as a term-sorted run, cut by the hash of the
term into shards.  The runs of a shard meet in one task, which merges them chunk by chunk,
by a heap on the terms, into whole frequencies; runs that exceed ``MERGE_BYTES`` are merged
into one longer run on the task's disk first, so memory holds whatever the number of runs.  Terms in too few documents end there; the rest is stored.

With all totals known, p = 1 + floor(10^9 (count + 5) / (N + 5 V)) of a term in a group is
exact (decimals in Spark).  A pair's sum over all V terms is V |p0 - q0| for terms that
neither source has (p0, q0: the values at count 0), plus corrections for terms that one or
both have.  Corrections are streamed over buckets of terms: a source's postings are
compared with each other source's p0 by prefix sums, and only terms that both have are
met pair by pair, within a bucket's task, which gives one sum per pair of sources.  Sources
are cut into tiles of ``TILE``, and buckets hold about ``BUCKET_POSTINGS`` postings, so that
a task's memory is bounded; the number of pairs of sources of a language is the result's
own size.

A hot language or source costs no task more: blocks are cut by size, shards and buckets by
the hash of the term.  Null text, language and source read as ''.  Repeated rows are
documents of their own.  Documents without terms still make their group occur; a language
without kept terms has pairs of value 0 and no terms.  Ties rank by the item's UTF-8 bytes.
Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import pickle
import tempfile
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import prepare, store

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
SCALE, PRIOR = 1_000_000_000, 5
# Postings of a block in memory, bytes of runs that a merging task holds, postings of a chunk of a run.
BLOCK_POSTINGS = 2_000_000
MERGE_BYTES = 48 << 20
CHUNK_POSTINGS = 1 << 14
LEAST_SHARDS, MAX_SHARDS = 64, 2048
BUCKET_POSTINGS = 1 << 18
TILE = 512
# Pairs of postings that are met at once; their sums stay exact in double precision.
PAIRS = 1 << 20
# Terms are letters (A-Z become a-z) and all bytes of other scripts.
FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass
class Postings:
    """Sorted terms, how many postings each has, and the postings: group, occurrences, documents.

    Groups are (language, source) by number.
    """

    terms: pa.BinaryArray
    sizes: np.ndarray
    names: list[tuple[bytes, bytes]]
    group: np.ndarray
    counts: np.ndarray
    documents: np.ndarray

    def part(self, start: int, end: int) -> Postings:
        """The terms from ``start`` to ``end``."""
        a, b = int(self.sizes[:start].sum()), int(self.sizes[:end].sum())
        return Postings(
            self.terms[start:end], self.sizes[start:end], self.names, self.group[a:b], self.counts[a:b], self.documents[a:b]
        )

    def chunks(self, most: int = CHUNK_POSTINGS) -> Iterator[Postings]:
        """Parts of about ``most`` postings."""
        upto, start = np.cumsum(self.sizes), 0
        while start < len(self.sizes):
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, side="right")))
            yield self.part(start, end)
            start = end

    @property
    def bytes(self) -> int:
        return 500 + self.terms.nbytes + 8 * len(self.sizes) + 24 * len(self.group)


def merged(parts: list[Postings]) -> Postings:
    """Parts as one: each term once, each of its groups once, with the counts added."""
    coded = pa.concat_arrays([p.terms for p in parts]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    numbers: dict[tuple[bytes, bytes], int] = {}
    mapped = [np.array([numbers.setdefault(n, len(numbers)) for n in p.names], dtype=np.int64)[p.group] for p in parts]
    term = np.repeat(rank[coded.indices.to_numpy()], np.concatenate([p.sizes for p in parts]))
    key = term * max(1, len(numbers)) + np.concatenate(mapped)
    sums = [np.concatenate([p.counts for p in parts]), np.concatenate([p.documents for p in parts])]
    key, counts, documents = _added(key, *sums)
    term, group = np.divmod(key, max(1, len(numbers)))
    return Postings(
        coded.dictionary.take(pa.array(order)), np.bincount(term, minlength=len(order)), list(numbers), group, counts, documents
    )


def _added(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of the values of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.array([], dtype=np.int64)
    return key[starts], *(np.add.reduceat(v[order], starts) if len(starts) else v for v in values)


def block_of(batch: pa.RecordBatch) -> Postings | None:
    """Postings of a batch of (language, source, text), all binary."""
    lang, source, text = (c.dictionary_encode() if i < 2 else c for i, c in enumerate(batch.columns))
    _, offsets, data = text.buffers()
    # Folding keeps lengths, so that the whole batch is folded at once.
    folded = pa.py_buffer(data.to_pybytes().translate(FOLDED)) if data is not None else pa.py_buffer(b"")
    split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(text), [None, offsets, folded], 0, text.offset))
    coded = split.flatten().cast(pa.binary()).dictionary_encode()
    blank = pc.index(coded.dictionary, b"").as_py()
    term = coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(text)), np.diff(split.offsets.to_numpy()))
    used = term != blank
    n = max(1, len(coded.dictionary))
    # Once for each document and term, then for each group and term.
    key, counts = _added((doc * n + term)[used], np.ones(int(used.sum()), dtype=np.int64))
    if not len(key):
        return None
    doc, term = np.divmod(key, n)
    names = [(a, b) for a in lang.dictionary.to_pylist() for b in source.dictionary.to_pylist()]
    group = lang.indices.to_numpy()[doc].astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()[doc]
    present, group = np.unique(group, return_inverse=True)
    key, counts, documents = _added(term * len(present) + group, counts, np.ones(len(key), dtype=np.int64))
    term, group = np.divmod(key, len(present))
    sizes = np.bincount(term, minlength=n)
    return Postings(coded.dictionary.filter(pa.array(sizes > 0)), sizes[sizes > 0], [names[i] for i in present], group, counts, documents)


RUN = pa.schema([
    ("shard", pa.int32()), ("run", pa.string()), ("chunk", pa.int32()), ("terms", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())),
    ("langs", pa.list_(pa.binary())), ("sources", pa.list_(pa.binary())), ("groups", pa.list_(pa.int64())),
    ("counts", pa.list_(pa.int64())), ("documents", pa.list_(pa.int64())),
])
RUN_FIELDS = (
    "shard int, run string, chunk int, terms array<binary>, sizes array<bigint>, langs array<binary>, sources array<binary>, "
    "groups array<bigint>, counts array<bigint>, documents array<bigint>"
)


def run_rows(block: list[Postings], shards: int, run: str) -> Iterator[pa.RecordBatch]:
    """A block as a term-sorted run: chunks by the hash of the term."""
    whole = merged(block)
    shard = np.array([zlib.crc32(t) % shards for t in whole.terms.to_pylist()], dtype=np.int64)
    order = np.argsort(shard, kind="stable")
    starts = np.cumsum(whole.sizes) - whole.sizes
    sizes = whole.sizes[order]
    at = np.repeat(starts[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    dealt = Postings(whole.terms.take(pa.array(order)), sizes, whole.names, whole.group[at], whole.counts[at], whole.documents[at])
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = []
    for i in range(shards):
        for chunk in dealt.part(int(bounds[i]), int(bounds[i + 1])).chunks():
            used, group = np.unique(chunk.group, return_inverse=True)
            names = [chunk.names[n] for n in used]
            langs, sources = ([n[k] for n in names] for k in range(2))
            rows.append((i, run, len(rows), chunk.terms, chunk.sizes, langs, sources, group, chunk.counts, chunk.documents))
            if len(rows) % 64 == 0:
                yield _batch(rows[-64:])
    if len(rows) % 64:
        yield _batch(rows[-(len(rows) % 64) :])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = []
    for values, kind in zip(zip(*rows), RUN.types):
        if pa.types.is_list(kind):
            parts = [v if isinstance(v, pa.Array) else pa.array(v, kind.value_type) for v in values]
            offsets = pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())
            columns.append(pa.ListArray.from_arrays(offsets, pa.concat_arrays(parts)))
        else:
            columns.append(pa.array(values, kind))
    return pa.RecordBatch.from_arrays(columns, schema=RUN)


def _blocks(shards: int, block_postings: int):
    """Documents to the chunks of term-sorted runs."""

    def run(batches):
        block, held, runs, task = [], 0, 0, TaskContext.get().partitionId()
        for b in batches:
            found = block_of(b)
            if found is not None:
                block.append(found)
                held += len(found.group)
            if held >= block_postings:
                yield from run_rows(block, shards, f"{task:08d}-{runs:06d}")
                block, held, runs = [], 0, runs + 1
        if block:
            yield from run_rows(block, shards, f"{task:08d}-{runs:06d}")

    return run


def heap_merged(runs: Iterable[Iterable[Postings]]) -> Iterator[Postings]:
    """Term-sorted runs as one run; terms are complete in what it yields.

    The heap holds the runs by the last term of their chunk in memory.  Up to the least of
    these, leaving out runs that have no further chunk, all runs' terms are at hand.
    """
    heads: dict[int, Postings] = {}
    following: dict[int, Postings | None] = {}
    sources = dict(enumerate(map(iter, runs)))
    bounds: list[tuple[bytes, int]] = []

    def load(i: int, head: Postings | None) -> None:
        if head is None:
            heads.pop(i, None)
            return
        heads[i], following[i] = head, next(sources[i], None)
        if following[i] is not None:
            heapq.heappush(bounds, (head.terms[-1].as_py(), i))

    for i in sources:
        load(i, next(sources[i], None))
    while heads:
        bound = bounds[0][0] if bounds else None
        parts = []
        for i, head in list(heads.items()):
            upto = len(head.terms) if bound is None else bisect_right(head.terms, bound, key=lambda t: t.as_py())
            if upto:
                parts.append(head.part(0, upto))
            heads[i] = head.part(upto, len(head.terms))
        while bounds and bounds[0][0] == bound:
            heapq.heappop(bounds)
        for i, head in list(heads.items()):
            if not len(head.terms):
                load(i, following[i])
        yield merged(parts)


class Runs:
    """Runs of one shard as they arrive; beyond ``limit`` bytes they are merged into a run on the task's disk."""

    def __init__(self, limit: int):
        self.limit, self.bytes = limit, 0
        self.held: dict[str, list[Postings]] = {}
        self.spilled: list = []

    def add(self, run: str, chunk: Postings) -> None:
        if self.bytes > self.limit and run not in self.held:
            self.spill()
        self.held.setdefault(run, []).append(chunk)
        self.bytes += chunk.bytes

    def spill(self) -> None:
        file = tempfile.TemporaryFile()
        for part in heap_merged(self.held.values()):
            for chunk in part.chunks():
                pickle.dump(chunk.__dict__, file, pickle.HIGHEST_PROTOCOL)
        self.spilled.append(file)
        self.held, self.bytes = {}, 0

    @staticmethod
    def _read(file) -> Iterator[Postings]:
        file.seek(0)
        while True:
            try:
                yield Postings(**pickle.load(file))
            except EOFError:
                file.close()
                return

    def merged(self) -> Iterator[Postings]:
        return heap_merged([*map(self._read, self.spilled), *self.held.values()])


FREQUENCIES = "lang binary, term binary, total long, source binary, count long"


def _frequencies(least: int, merge_bytes: int):
    """Chunks, sorted by shard and run, to the postings of terms in enough documents of their language."""

    def kept(runs: Runs) -> Iterator[pa.RecordBatch]:
        for found in runs.merged():
            langs = {lang: i for i, lang in enumerate(dict.fromkeys(lang for lang, _ in found.names))}
            lang = np.array([langs[n[0]] for n in found.names], dtype=np.int64)[found.group]
            term = np.repeat(np.arange(len(found.sizes)), found.sizes)
            key = term * max(1, len(langs)) + lang
            distinct, documents, totals = _added(key, found.documents, found.counts)
            at = np.searchsorted(distinct, key)
            stays = np.flatnonzero(documents[at] >= least)
            if len(stays):
                names = [pa.array([n[k] for n in found.names], pa.binary()).take(pa.array(found.group[stays])) for k in range(2)]
                yield pa.RecordBatch.from_arrays(
                    [
                        names[0], found.terms.take(pa.array(term[stays])), pa.array(totals[at][stays]), names[1],
                        pa.array(found.counts[stays]),
                    ],
                    ["lang", "term", "total", "source", "count"],
                )

    def run(batches):
        shard, runs = None, Runs(merge_bytes)
        for b in batches:
            own = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, (at, name) in enumerate(zip(*own)):
                if at != shard:
                    yield from kept(runs)
                    shard, runs = at, Runs(merge_bytes)
                terms, sizes, langs, sources, *postings = (b.column(k)[i].values for k in range(3, 10))
                arrays = [v.to_numpy() for v in postings]
                runs.add(name, Postings(terms, sizes.to_numpy(), list(zip(langs.to_pylist(), sources.to_pylist())), *arrays))
        yield from kept(runs)

    return run


def index(
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    block_postings: int = BLOCK_POSTINGS,
    merge_bytes: int = MERGE_BYTES,
    shards: int | None = None,
) -> DataFrame:
    """Occurrences of each kept term by language and source, with the language's total."""
    prepare(docs.sparkSession)
    read = docs.select(*[F.coalesce(c, F.lit("")).cast("binary").alias(c) for c in ("lang", "source", "text")])
    asked = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = shards or min(MAX_SHARDS, max(LEAST_SHARDS, asked))
    runs = read.mapInArrow(_blocks(shards, block_postings), RUN_FIELDS)
    dealt = runs.repartition(shards, "shard").sortWithinPartitions("shard", "run", "chunk")
    found = store(dealt.mapInArrow(_frequencies(least, merge_bytes), FREQUENCIES), "frequencies")
    return found.select(*[F.col(c).cast("string").alias(c) if t == "binary" else F.col(c) for c, t in found.dtypes])


def weight(count: Column, total: Column) -> Column:
    """1 + floor(10^9 (count + 5) / total), exact."""
    scaled = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", scaled, total.cast("decimal(20,0)")) + 1


def groups_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Every (lang, source) with its number in the language and the totals that weights are shares of."""
    occurring = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = found.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    terms = found.groupBy("lang", "term").agg(F.first("total").alias("total"))
    whole = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("whole"))
    zero = F.lit(0).cast("long")
    out = occurring.join(own, ["lang", "source"], "left").join(whole, "lang", "left")
    out = out.withColumns({c: F.coalesce(c, zero) for c in ("n", "v", "whole")})
    return out.select(
        "lang",
        "source",
        (F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1).alias("number"),
        "v",
        (F.col("n") + PRIOR * F.col("v")).alias("share_of"),
        (F.col("whole") + PRIOR * F.col("v")).alias("lang_share_of"),
    )


def audit(
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    tile: int = TILE,
    bucket_postings: int = BUCKET_POSTINGS,
    **options,
) -> DataFrame:
    """lang, source, part, item, value, rank: each source's distance to the others, and its most overused terms."""
    found = index(docs, least, **options)
    groups = store(groups_of(docs, found), "groups")
    weighed = found.join(groups, ["lang", "source"]).withColumn("p", weight(F.col("count"), F.col("share_of")))
    out = pair_values(weighed, groups, tile, bucket_postings, found.count()).unionByName(term_values(weighed, top))
    return out.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))


def term_values(weighed: DataFrame, top: int) -> DataFrame:
    q = weight(F.col("total"), F.col("lang_share_of"))
    over = weighed.select("lang", "source", F.col("term").alias("item"), (F.col("p") - q).alias("value")).filter("value > 0")
    ranked = over.withColumn("rank", F.row_number().over(_order())).filter(F.col("rank") <= top)
    return ranked.withColumn("part", F.lit("term"))


def _order():
    return W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")


def pair_values(weighed: DataFrame, groups: DataFrame, tile: int, bucket_postings: int, postings: int) -> DataFrame:
    """The summed differences of every ordered pair of sources of a language."""
    buckets = max(1, -(-postings // bucket_postings))
    base = F.when(F.col("v") > 0, weight(F.lit(0).cast("long"), F.col("share_of"))).otherwise(F.lit(0).cast("long"))
    known = groups.withColumn("base", base)
    tiles = groups.groupBy("lang").agg((F.floor(F.max("number") / tile) + 1).cast("int").alias("tiles"))
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
    # Marker rows tell each bucket all sources, also those without a posting in it.
    posting = weighed.select("lang", "number", bucket.alias("bucket"), "term", "p")
    used = posting.select("lang", "bucket").distinct()
    marker = known.join(used, "lang").select(
        "lang", "number", "bucket", F.lit(None).cast("string").alias("term"), F.col("base").alias("p")
    )
    own = F.floor(F.col("number") / tile).cast("int")
    dealt = (
        posting.unionByName(marker)
        .join(tiles, "lang")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "lang", "bucket", F.least(own, "other").alias("first"), F.greatest(own, "other").alias("second"), "number", "term", "p"
        )
    )
    parts = dealt.groupBy("lang", "bucket", "first", "second").applyInArrow(_corrections(tile), "lang string, a int, b int, value long")
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = summed.unionByName(summed.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    left = known.select("lang", "source", F.col("number").alias("a"), "v", F.col("base").alias("p0"))
    right = known.select("lang", F.col("source").alias("item"), F.col("number").alias("b"), F.col("base").alias("q0"))
    pairs = left.join(right, "lang").filter("a <> b").join(both, ["lang", "a", "b"], "left")
    value = F.col("v") * F.abs(F.col("p0") - F.col("q0")) + F.coalesce("value", F.lit(0).cast("long"))
    out = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    return out.withColumn("rank", F.row_number().over(_order()))


def corrections(number: np.ndarray, term: np.ndarray, p: np.ndarray, base: np.ndarray) -> np.ndarray:
    """For each two sources: the sum of |p - q| - |p0 - q0| over the terms that either has.

    ``number``, ``term`` and ``p`` are postings; ``base`` is p0 by source.
    """
    n = len(base)
    gap = np.abs(base[:, None] - base[None])
    out = np.zeros((n, n), dtype=np.int64)
    order = np.lexsort((p, number))
    starts = np.searchsorted(number[order], np.arange(n + 1))
    for a in range(n):
        mine = p[order[starts[a] : starts[a + 1]]]
        if len(mine):
            upto = np.concatenate([[0], np.cumsum(mine)])
            at = np.searchsorted(mine, base)
            one_sided = base * at - upto[at] + (upto[-1] - upto[at]) - base * (len(mine) - at) - len(mine) * gap[a]
            out[a] += one_sided
            out[:, a] += one_sided
    order = np.lexsort((number, term))
    number, term, p = number[order], term[order], p[order]
    # Each posting meets those after it of the same term, some at a time.
    after = np.searchsorted(term, term, side="right") - np.arange(len(term)) - 1
    upto = np.cumsum(after)
    at = 0
    while at < len(term):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
        k = after[at:end]
        left = np.repeat(np.arange(at, end), k)
        right = np.arange(len(left)) - np.repeat(np.cumsum(k) - k, k) + left + 1
        a, b = number[left], number[right]
        both = np.abs(p[left] - p[right]) - np.abs(p[left] - base[b]) - np.abs(base[a] - p[right]) + gap[a, b]
        sums = np.bincount(a * n + b, weights=both, minlength=n * n).astype(np.int64).reshape(n, n)
        out += sums + sums.T
        at = end
    np.fill_diagonal(out, 0)
    return out


def _corrections(tile: int):
    schema = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        lang, _, first, second = (k.as_py() for k in key)
        number, p = rows.column("number").to_numpy().astype(np.int64), rows.column("p").to_numpy()
        coded = rows.column("term").combine_chunks().dictionary_encode()
        marks = rows.column("term").is_null().to_numpy()
        sources = np.sort(number[marks])
        at = np.searchsorted(sources, number)
        base = np.empty(len(sources), dtype=np.int64)
        base[at[marks]] = p[marks]
        term = coded.indices.fill_null(0).to_numpy()
        sums = corrections(at[~marks], term[~marks], p[~marks], base)
        # Two tiles: only pairs across them.  One: each pair once.
        tiles = sources // tile
        wanted = np.triu(sums != 0) & (tiles[:, None] == first) & (tiles[None] == second)
        a, b = np.nonzero(wanted)
        columns = [pa.array([lang] * len(a), pa.string()), pa.array(sources[a], pa.int32()), pa.array(sources[b], pa.int32())]
        return pa.table([*columns, pa.array(sums[a, b], pa.int64())], schema=schema)

    return run
