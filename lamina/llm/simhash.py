"""SimHash near-duplicates by multi-index hashing.

A fingerprint bit is 1 if it is set in over half the hashes of a document's word
shingles.  Fingerprints at most ``max_bits`` apart are linked, and linked ones form a
component.

The fingerprint is cut into segments, and a table is kept for each.  If two
fingerprints are near, then in at least one segment they are very near (pigeonhole), so
each fingerprint enumerates the small Hamming ball around each of its segments, meets
there those that have or enumerate the same value, and the complete distance is verified.
Of a ball of radius 1 only the values with a bit more are enumerated: of two values one
bit apart, one is the other with a bit more.

Meeting places are groups of rows with the same (segment, value).  A task works through
a group by a search that tests each fingerprint against those not reached yet and gives
out one link per fingerprint reached, never all pairs; equal fingerprints are one node.
Components come from the links: tasks reduce parts of them to forests, and several parts are
joined by rounds of joins, written after each round.

A scheme with ``least_similarity`` takes near fingerprints as candidates only: they are
linked if the Jaccard similarity of their documents' complete shingle sets reaches it.  A place
names the near pairs that meet nowhere before.  One with more than ``PAIRS_A_ROW`` a row gives out links
that join them, and the groups of such links are compared in blocks: a task has the sets of two
blocks, compares every candidate that no verified link has joined yet, and gives out a link per
fingerprint reached.  So every candidate is either verified or joined already, and no step makes
rows by the square of a group; comparisons in a dense group still are its square.
Equal fingerprints are one node here too.

Shingles shorter than the document's words: the whole sequence is one.  A document
without words (null, empty, white space) has fingerprint zero, linked like any other.
Repeated rows have one component; a component's id is its smallest doc_id, null only if
all are.  Other columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import fresh, prepare, store, text_bytes

SEED = 42


@dataclass(frozen=True)
class Scheme:
    """What is fingerprinted, and which segments find neighbours.

    ``segments``: (first bit, width, ball radius 0 or 1).  ``least_similarity``: Jaccard
    similarity of the shingle sets that a link must have, 0 for none.
    """

    shingle: int
    words64: int
    max_bits: int
    segments: tuple[tuple[int, int, int], ...]
    least_similarity: float = 0.0


# Distance at most 2: if the halves are 1 and 1 apart, the first is found in its ball;
# otherwise one of them is equal.
NEAR_EXACT = Scheme(3, 1, 2, ((0, 32, 1), (32, 32, 0)))

# Similarity of 0.8 on five-word shingles.  Two sets of that Jaccard similarity and equal
# size are 27 degrees apart and differ in 0.151 of the bits, 39 of 256 with a standard deviation of
# 6; 60 are allowed, and what they let through below 0.8 is turned away by the sets.  One of sixteen
# segments is at most one bit apart for 99.5 % of the pairs at 0.8.
SIMILAR = Scheme(5, 4, 60, tuple((16 * i, 16, 1) for i in range(16)), 0.8)


def shingle_hashes(words: list[bytes], k: int) -> np.ndarray:
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], dtype=np.uint64)
    text = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: len(words) - k + 1].tolist()
    digest, view = xxhash.xxh64_intdigest, memoryview(text)
    found = [digest(view[a:b], SEED) for a, b in zip(starts, (ends[k - 1 :] - 1).tolist())]
    return np.array(found, dtype=np.uint64)


def mixed(h: np.ndarray, by: int) -> np.ndarray:
    """Further 64 bits of a hash (a bijective mix of it with a constant)."""
    with np.errstate(over="ignore"):
        z = h + np.uint64((0x9E3779B97F4A7C15 * by) % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def majority(h: np.ndarray) -> int:
    """64 bits, each set if it is in over half of the hashes."""
    n = len(h)
    if not n:
        return 0
    data = h.astype("<u8").view(np.uint8).reshape(n, 8)
    if n > 64:  # counts of byte values, in place of bits
        flat = data.astype(np.int64) + np.arange(0, 2048, 256)
        counts = np.bincount(flat.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    else:
        counts = np.unpackbits(data, axis=1, bitorder="little").sum(axis=0, dtype=np.int64).reshape(8, 8)
    return int.from_bytes(np.packbits(2 * counts.ravel() > n, bitorder="little").tobytes(), "little")


def fingerprint(data: bytes, scheme: Scheme) -> list[int]:
    return _majorities(hashes_of(data, scheme), scheme)


def hashes_of(data: bytes, scheme: Scheme) -> np.ndarray:
    return shingle_hashes(data.lower().split(), scheme.shingle)  # on bytes, lower() is A-Z only


def _majorities(h: np.ndarray, scheme: Scheme) -> list[int]:
    return [majority(h if i == 0 else mixed(h, i)) for i in range(scheme.words64)]


def fingerprints(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id and fingerprint, as 16 hex digits for each 64 bits; text_hash if links are verified."""
    prepare(docs.sparkSession)
    more = ["text_hash"] if scheme.least_similarity else []

    def run(batches):
        for b in batches:
            prints = [_hex(fingerprint(t, scheme)) for t in b.column(1).to_pylist()]
            columns = [b.column(0), pa.array(prints, pa.string()), *b.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", *more])

    text, text_hash = text_bytes(), F.xxhash64(text_bytes()).alias("text_hash")
    read = docs.select(F.col("doc_id").cast("long"), text.alias("text"), *([text_hash] if more else []))
    return read.mapInArrow(run, "doc_id long, fingerprint string" + "".join(f", {c} long" for c in more))


def _hex(words: list[int]) -> str:
    return "".join(f"{x:016x}" for x in words)


def _words(prints: list[bytes], words64: int) -> np.ndarray:
    """One row of 64-bit words per fingerprint, whatever may follow it."""
    return np.frombuffer(b"".join(prints), dtype=">u8").astype(np.uint64).reshape(len(prints), -1)[:, :words64]


def balls(scheme: Scheme):
    """The meeting places (segment, value) of each fingerprint, which goes there as bytes."""

    def run(batches):
        for b in batches:
            prints = [bytes.fromhex(p) for p in b.column(0).to_pylist()]
            if not prints:
                continue
            sent = pa.array(prints, pa.binary())
            words, places, rows = _words(prints, scheme.words64), [], []
            for s, (first, width, radius) in enumerate(scheme.segments):
                value = (words[:, first // 64] >> np.uint64(first % 64)) & np.uint64((1 << width) - 1)
                tag = np.uint64(s << width)
                places.append(value | tag)
                rows.append(np.arange(len(prints)))
                for bit in range(width if radius else 0):
                    without = np.flatnonzero((value >> np.uint64(bit)) & np.uint64(1) == 0)
                    places.append(value[without] | np.uint64(1 << bit) | tag)
                    rows.append(without)
            at = np.concatenate(rows)
            column = sent.take(pa.array(at))
            place = pa.array(np.concatenate(places).astype(np.int64))
            step = 50_000
            for i in range(0, len(at), step):
                yield pa.RecordBatch.from_arrays([place.slice(i, step), column.slice(i, step)], ["place", "fingerprint"])

    return run


# Near pairs of a place that are named one by one, for each of its rows.
PAIRS_A_ROW = 2
# Fingerprints, and bytes of their shingle sets, in a block of a dense group.
BLOCK_ROWS, BLOCK_BYTES = 4096, 16 << 20
# Links that one task reduces to a forest.
FOREST_LINKS = 200_000
# Rows of a group whose distances are taken all at once; most groups are small and have no link.
AT_ONCE = 256


def spanning_links(words: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join all rows within ``max_bits`` of each other, one per row reached."""
    if len(words) <= AT_ONCE:
        near = np.bitwise_count(words[:, None] ^ words[None]).sum(axis=2, dtype=np.int16) <= max_bits
        linked = np.flatnonzero(near.sum(axis=1) > 1)
        if not len(linked):
            return []
        return [(int(linked[a]), int(linked[b])) for a, b in _search(words[linked], max_bits)]
    return _search(words, max_bits)


def _search(words: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    links, left = [], np.arange(len(words))
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            here = frontier.pop()
            near = np.bitwise_count(words[left] ^ words[here]).sum(axis=1) <= max_bits
            found = left[near].tolist()
            links += [(int(here), f) for f in found]
            frontier += found
            left = left[~near]
    return links


def _groups(batches):
    """Each place that has several fingerprints, and these."""
    place, held = None, []
    for b in batches:
        places = b.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(places)) + 1).tolist(), len(places)]
        column = b.column(1)
        for a, z in zip(cuts, cuts[1:]):
            if a == z:
                continue
            if places[a] != place:
                if sum(map(len, held)) > 1:
                    yield place, [p for c in held for p in c.to_pylist()]
                place, held = places[a], []
            held.append(column.slice(a, z - a))
    if sum(map(len, held)) > 1:
        yield place, [p for c in held for p in c.to_pylist()]


def met(scheme: Scheme):
    """Links between the fingerprints of each place; rows come sorted by place."""

    def run(batches):
        out: list[tuple[bytes, bytes]] = []
        for _, prints in _groups(batches):
            for a, z in spanning_links(_words(prints, scheme.words64), scheme.max_bits):
                out.append((min(prints[a], prints[z]), max(prints[a], prints[z])))
            if len(out) > 20_000:
                yield _hex_links(out)
                out = []
        if out:
            yield _hex_links(out)

    return run


def first_places(one: np.ndarray, other: np.ndarray, scheme: Scheme) -> np.ndarray:
    """The first place where the rows of each pair meet, -1 if they don't."""
    places = np.full(max(len(one), len(other)), -1, dtype=np.int64)
    for s, (first, width, radius) in reversed(list(enumerate(scheme.segments))):
        a, b = ((w[:, first // 64] >> np.uint64(first % 64)) & np.uint64((1 << width) - 1) for w in (one, other))
        bits = np.bitwise_count(a ^ b)
        meets = bits <= radius
        if radius:  # both with a bit more
            meets |= (bits == 2) & (np.bitwise_count((a ^ b) & a) == 1)
        places = np.where(meets, (a | b | np.uint64(s << width)).astype(np.int64), places)
    return places


def named_here(words: np.ndarray, place: int, scheme: Scheme) -> tuple[list, bool]:
    """The near pairs that meet here first, or links that join them if there are too many, and whether there are."""
    most, found = PAIRS_A_ROW * len(words), []
    if len(words) <= AT_ONCE:
        near = np.bitwise_count(words[:, None] ^ words[None]).sum(axis=2, dtype=np.int16) <= scheme.max_bits
        if np.count_nonzero(near) == len(words):
            return [], False
        pairs = np.argwhere(np.triu(near, 1))
        found = pairs[first_places(words[pairs[:, 0]], words[pairs[:, 1]], scheme) == place].tolist()
        return (found, False) if len(found) <= most else (_forest(found), True)
    for i in range(len(words) - 1):
        near = i + 1 + np.flatnonzero(np.bitwise_count(words[i + 1 :] ^ words[i]).sum(axis=1) <= scheme.max_bits)
        if len(near):
            found += [(i, j) for j in near[first_places(words[near], words[i : i + 1], scheme) == place].tolist()]
        if len(found) > most:
            return spanning_links(words, scheme.max_bits), True
    return found, False


def _forest(pairs) -> list:
    """The pairs that join rows no earlier one joins."""
    top: dict[int, int] = {}
    links = []
    for pair in pairs:
        a, b = pair
        while a in top:
            a = top[a]
        while b in top:
            b = top[b]
        if a != b:
            top[b] = a
            links.append(pair)
    return links


def met_closely(scheme: Scheme):
    """The near pairs of each place that meet there first, or links that join them where they are too many (``dense``)."""

    def run(batches):
        out: list[tuple[bytes, bytes, bool]] = []
        for place, prints in _groups(batches):
            pairs, dense = named_here(_words(prints, scheme.words64), place, scheme)
            for a, z in pairs:
                out.append((min(prints[a], prints[z]), max(prints[a], prints[z]), dense))
            if len(out) > 20_000:
                yield _candidates(out)
                out = []
        if out:
            yield _candidates(out)

    return run


def _candidates(rows):
    low, high, dense = zip(*rows)
    links = _hex_links(zip(low, high))
    return pa.RecordBatch.from_arrays([*links.columns, pa.array(dense, pa.bool_())], ["low", "high", "dense"])


def _hex_links(pairs):
    return _links([(low.hex(), high.hex()) for low, high in pairs])


def _links(pairs):
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*pairs)], ["low", "high"])


def links(nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs (low, high) of near fingerprints, enough to connect every component."""
    return _meetings(nodes, scheme, met(scheme), "low string, high string")


def _meetings(nodes: DataFrame, scheme: Scheme, pairs, schema: str) -> DataFrame:
    return (
        nodes.select("fingerprint").mapInArrow(balls(scheme), "place long, fingerprint binary")
        .repartition("place")
        .sortWithinPartitions("place")
        .mapInArrow(pairs, schema)
        .distinct()
    )


def shingle_sets(docs: DataFrame, printed: DataFrame, pairs: DataFrame, scheme: Scheme) -> DataFrame:
    """(fingerprint, shingles): the different shingle sets of each fingerprint in the pairs, as sorted hashes."""
    ends = pairs.select(F.col("low").alias("fingerprint")).unionByName(pairs.select(F.col("high").alias("fingerprint"))).distinct()
    wanted = store(printed.join(ends, "fingerprint").select("fingerprint", "text_hash").distinct(), "wanted-texts")

    def run(batches):
        done: set[bytes] = set()
        for b in batches:
            rows = []
            for print_, text in zip(*(b.column(i).to_pylist() for i in range(2))):
                name = xxhash.xxh3_128_digest(text)
                if name in done:
                    continue
                h = hashes_of(text, scheme)
                if _hex(_majorities(h, scheme)) == print_:  # else another text with the same hash
                    done.add(name)
                    rows.append((print_, np.unique(h).tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.binary()))], ["fingerprint", "shingles"]
                )

    texts = docs.select(F.xxhash64(text_bytes()).alias("text_hash"), text_bytes().alias("text"))
    return texts.join(wanted, "text_hash").select("fingerprint", "text").mapInArrow(run, "fingerprint string, shingles binary").distinct()


def similar_pairs(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (low, high) whose shingle sets have a Jaccard similarity of ``least`` or more."""

    def run(batches):
        for b in batches:
            found = []
            for low, high, one, two in zip(*(b.column(i).to_pylist() for i in range(4))):
                one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                if both / max(1, len(one) + len(two) - both) >= least:
                    found.append((low, high))
            if found:
                yield _links(found)

    sides = [sets.select(F.col("fingerprint").alias(end), F.col("shingles").alias(f"{end}_shingles")) for end in ("low", "high")]
    joined = pairs.join(sides[0], "low").join(sides[1], "high")
    return joined.select("low", "high", "low_shingles", "high_shingles").mapInArrow(run, "low string, high string").distinct()


def similar_in(words: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, scheme: Scheme) -> list[tuple[int, int]]:
    """Links that join all similar candidates of a block (one side), or of two blocks, one row of each."""
    _, labels = np.unique(words, axis=0, return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    here = np.zeros(len(ids), dtype=np.int32)
    least, links = scheme.least_similarity, []
    two = np.flatnonzero(sides == sides.max())
    alone = len(two) == len(sides)
    for i in range(len(sides)) if alone else np.flatnonzero(sides != sides.max()).tolist():
        at = two[i + 1 :] if alone else two
        at = at[(labels[at] != labels[i]) & (sizes[at] > 0)]
        at = at[np.bitwise_count(words[at] ^ words[i]).sum(axis=1) <= scheme.max_bits]
        fits = (1 + least) * np.minimum(sizes[at], sizes[i]) >= least * (sizes[at] + sizes[i]) - 1e-6
        at = at[fits & (first_places(words[at], words[i : i + 1], scheme) >= 0)]
        if not len(at):
            continue
        own = ids[ends[i] - sizes[i] : ends[i]]
        here[own] = 1
        taken = here[np.concatenate([ids[ends[j] - sizes[j] : ends[j]] for j in at.tolist()])]
        both = np.add.reduceat(taken, np.cumsum(sizes[at]) - sizes[at])
        here[own] = 0
        for j in at[both / np.maximum(1, sizes[at] + sizes[i] - both) >= least].tolist():
            if labels[j] != labels[i]:
                links.append((i, j))
                labels[labels == labels[j]] = labels[i]
    return links


def similar_in_groups(groups: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs (low, high) that join all similar candidates within groups (node, root), each compared in blocks."""
    members = store(sets.join(groups.withColumnRenamed("node", "fingerprint"), "fingerprint"), "members")
    n, held = F.count(F.lit(1)), F.sum(F.length("shingles"))
    blocks = members.groupBy("root").agg(F.ceil(F.greatest(n / BLOCK_ROWS, held / BLOCK_BYTES, F.lit(1))).cast("int").alias("blocks"))
    own, other = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.join(blocks, "root").select("root", "fingerprint", "shingles", own.alias("own"), other.alias("other"))

    def run(batches):
        key, held = None, []

        def close():
            if len(held) < 2:
                return None
            prints = [bytes.fromhex(h[0]) for h in held]
            found = [np.frombuffer(h[1], np.uint64) for h in held]
            links = similar_in(_words(prints, scheme.words64), found, np.array([h[2] for h in held]), scheme)
            return _hex_links([(min(prints[a], prints[z]), max(prints[a], prints[z])) for a, z in links]) if links else None

        for b in batches:
            for root, one, two, *row in zip(*(b.column(i).to_pylist() for i in range(6))):
                if (root, one, two) != key:
                    if (out := close()) is not None:
                        yield out
                    key, held = (root, one, two), []
                held.append(row)
        if (out := close()) is not None:
            yield out

    pair = ["root", "one", "two"]
    return (
        dealt.select("root", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "fingerprint", "shingles", "own")
        .repartition(*pair)
        .sortWithinPartitions(*pair)
        .mapInArrow(run, "low string, high string")
        .distinct()
    )


def verified_links(docs: DataFrame, printed: DataFrame, nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs (low, high) whose similarity is verified, enough to connect every component of the verified candidates."""
    candidates = store(_meetings(nodes, scheme, met_closely(scheme), "low string, high string, dense boolean"), "candidates")
    sets = store(shingle_sets(docs, printed, candidates, scheme), "shingle-sets")
    dense = candidates.filter("dense").select("low", "high")
    single = similar_pairs(candidates.filter("not dense").select("low", "high"), sets, scheme.least_similarity)
    if dense.isEmpty():
        return single
    return single.unionByName(similar_in_groups(components(dense), sets, scheme))


def forests(batches):
    """Each node of the links with the smallest node they join it to, in bounded parts."""
    parent: dict[str, str] = {}

    def top(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def roots():
        rows = [(x, r) for x in list(parent) if (r := top(x)) != x]
        for i in range(0, len(rows), 20_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[i : i + 20_000])], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
        if len(parent) > 2 * FOREST_LINKS:
            yield from roots()
            parent.clear()
    yield from roots()


def components(pairs: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """(node, root) for every node of stored pairs; the root is the component's smallest node.

    First, tasks reduce parts of the pairs to forests of stars.  If there are several parts,
    rounds join them: each round, every node points its neighbours (large star), then its smaller ones (small
    star), at the smallest of them.  Rounds grow with the logarithm of the longest path.
    Minima are aggregated before they are joined back, so a node with very many neighbours
    is never gathered.
    """
    edges = pairs.select(F.col(low).alias("a"), F.col(high).alias("b")).filter("a <> b")
    parts = max(1, -(-edges.count() // FOREST_LINKS))
    edges = store(edges.coalesce(parts).mapInArrow(forests, "a string, b string"), "forests")
    before = None
    while parts > 1:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        edges = (  # large star
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()
        )
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        small = edges.join(least, "a")  # small star
        edges = store(
            small.select(F.col("b").alias("a"), F.col("least").alias("b"))
            .filter("a <> b")
            .unionByName(least.select("a", F.col("least").alias("b")))
            .distinct(),
            "stars",
        )
        state = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, scheme: Scheme = NEAR_EXACT) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    printed = store(fingerprints(docs, scheme), "fingerprints")
    nodes = store(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "nodes")
    found = store(verified_links(docs, printed, nodes, scheme) if scheme.least_similarity else links(nodes, scheme), "links")
    roots = components(found).select(F.col("node").alias("fingerprint"), "root")
    linked = store(nodes.join(roots, "fingerprint"), "linked")
    smallest = store(linked.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    of = linked.join(smallest, "root").select("fingerprint", "component_id")
    # Most fingerprints have no link and are their own component.
    every = store(
        nodes.join(of, "fingerprint", "left").select(
            "fingerprint", F.when(F.col("component_id").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id")
        ),
        "components",
    )
    return printed.join(every, "fingerprint").select("doc_id", "fingerprint", "component_id")


def kept_documents(docs: DataFrame, scheme: Scheme = SIMILAR) -> DataFrame:
    """The documents of which each group of near copies has the one with the smallest doc_id.

    Rows that repeat that doc_id are all kept; a group whose doc_ids are all null is kept whole.
    """
    id_, nameless_ = fresh("dropped", docs.columns), fresh("nameless", docs.columns)
    dropped = (
        near_duplicates(docs, scheme)
        .filter("doc_id <> component_id or (doc_id is null and component_id is not null)")
        .select(F.coalesce("doc_id", F.lit(-1)).alias(id_), F.col("doc_id").isNull().alias(nameless_))
        .distinct()
    )
    same = (F.coalesce("doc_id", F.lit(-1)) == F.col(id_)) & (F.col("doc_id").isNull() == F.col(nameless_))
    return docs.join(dropped, same, "left_anti")
