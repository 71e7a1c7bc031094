"""Substring deduplication with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words of one document.  A word is removed if a window
covers it whose words also start earlier: in a document with a smaller doc_id, or before
in the same one.  Windows are judged on the input, not on what is left.

Searching each document in every shard's index would grow with the square of the corpus.
So shards are made of windows that can be equal.  A window is named by its minimizer: of
its runs of ``GRAM`` words the one with the least hash.  Equal windows have equal minimizers,
and neighbouring windows mostly share theirs, so a document falls into short segments.

1. Segments whose minimizer occurs once in the corpus can't repeat and are dropped.  They meet by
   minimizer in one shuffle.  Those whose minimizer occurs again in the batch that reads them are
   known to repeat: they are dealt by document, and one witness a batch goes to the meeting.
2. Of the others, equal segments are collapsed to the first (in the task that reads them,
   then in its shard), so a passage in a third of all documents is one segment.
3. Different segments with the same minimizer meet in a shard.  There an FM-index of them
   is built, and every window is searched backwards in it; an interval of more than one
   suffix reports the places with the same words, of which the first counts.
4. Each occurrence of a segment is compared with the first place of each of its windows.

A minimizer with more than ``SPLIT`` different segments (a phrase in very many contexts) would
make a shard too large for one task.  Its windows are looked up by an aggregation over
their own hashes of 128 bits instead, an exact way that needs no index.

Words are runs of [^\\x20\\x09-\\x0D]+.  A null text has none.  A null doc_id comes after
all others.  Rows that repeat a doc_id are told apart by a hash of their text and ordered by
it; rows that repeat both are one document and have the same result each.  Other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import WHITE, prepare, store, text_bytes
from lamina.llm.fm_index import FMIndex

WINDOW = 20
GRAM = 6
SPLIT = 20_000
# Words of one FM-index, unless one minimizer's segments have more.
SHARD_WORDS = 1 << 20
LAST_ID = (1 << 63) - 1
# A segment's place in one number: first window, number of windows.
COUNT_BITS = 6
_FACTOR, _MIX, _BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0x100000001B3
# Bytes of a text that are hashed at once.
PIECE = 1 << 18


class WordHashes:
    """A hash of each word of a text, from running sums over its bytes.

    With ``B`` odd, a word's polynomial sum(byte * B**place) comes from two running sums,
    and is moved to place 0 by the inverse of ``B``; all modulo 2**64.
    """

    def __init__(self):
        white = np.zeros(256, dtype=bool)
        white[list(WHITE.encode())] = True
        self.white = white
        with np.errstate(over="ignore"):
            self.powers, self.inverse = (
                np.cumprod(np.array([1] + [b] * PIECE, dtype=np.uint64), dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64))
            )

    def __call__(self, text: bytes) -> np.ndarray:
        found, at = [], 0
        while at < len(text):
            upto = at + PIECE
            if upto < len(text):  # cut at white space
                white = np.flatnonzero(self.white[np.frombuffer(text, np.uint8, PIECE, at)])
                if not len(white):
                    return self._slow(text)
                upto = at + int(white[-1]) + 1
            found.append(self._piece(np.frombuffer(text[at:upto], dtype=np.uint8)))
            at = upto
        return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)

    def _piece(self, data: np.ndarray) -> np.ndarray:
        inside = np.concatenate([[False], ~self.white[data], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], dtype=np.uint64, out=sums[1:])
            h = (sums[ends] - sums[starts]) * self.inverse[starts]
            h ^= h >> np.uint64(29)
            return h * np.uint64(_FACTOR)

    def _slow(self, text: bytes) -> np.ndarray:
        """For texts with a word longer than a piece."""
        return np.array([xxhash.xxh64_intdigest(w) for w in text.split()], dtype=np.uint64)


def minimizers(h: np.ndarray, window: int, gram: int) -> np.ndarray:
    """First window, number of windows and minimizer of each segment of a document of hashed words."""
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros((3, 0), dtype=np.int64)
    with np.errstate(over="ignore"):
        grams = h[: len(h) - gram + 1].copy()
        for i in range(1, gram):
            grams *= np.uint64(_FACTOR)
            grams += h[i : len(h) - gram + 1 + i]
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(_MIX)
        grams ^= grams >> np.uint64(32)
    # The least of each window, by half the hash, then the leftmost: minima of twice as many each time.
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    reach, width = window - gram + 1, 1
    while 2 * width <= reach:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < reach:
        least = np.minimum(least[: -(reach - width)], least[reach - width :])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    counts = np.diff(np.concatenate([cuts, [n]]))
    return np.stack([cuts, counts, grams[at[cuts]].view(np.int64)])


def documents(docs: DataFrame) -> DataFrame:
    text = text_bytes()
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        F.xxhash64(text).alias("version"),  # tells rows of one id apart
        text.alias("text"),
    )


def compressed(texts: DataFrame) -> DataFrame:
    """Texts as they travel: whole, in half the bytes that shuffle blocks would take."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for b in batches:
            packed = pa.array([packer.compress(t) for t in b.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed], ["id", "version", "packed"])

    return texts.mapInArrow(run, "id long, version long, packed binary")


def _pack(start, count):
    return (start << COUNT_BITS) | count


def _unpack(place):
    return place >> COUNT_BITS, place & ((1 << COUNT_BITS) - 1)


def _fields(lists: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lengths of lists of structs, null as empty, and the structs' fields, all lists in one."""
    lengths = lists.value_lengths().fill_null(0).to_numpy()
    return lengths, [f.to_numpy() for f in lists.flatten().flatten()]


SEGMENTS = "gram long, id long, version long, place long"


def segments_of(window: int, gram: int):
    """(minimizer, id, version, place) of every segment.

    Places are negative (``~place``) where the minimizer repeats in the batch, which then also has a
    witness for it: a row without a place.
    """

    def run(batches):
        hashes = WordHashes()
        for b in batches:
            grams, ids, versions, places = [], [], [], []
            for doc, version, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                start, count, found = minimizers(hashes(text), window, gram)
                grams.append(found)
                ids.append(np.full(len(found), doc))
                versions.append(np.full(len(found), version))
                places.append(_pack(start, count))
            if not grams:
                continue
            found, of, times = np.unique(np.concatenate(grams).astype(np.int64), return_inverse=True, return_counts=True)
            place, seen = np.concatenate(places).astype(np.int64), found[times > 1]
            place = np.where(times[of] > 1, ~place, place)
            rows = [found[of], *(np.concatenate(c).astype(np.int64) for c in (ids, versions)), place]
            columns = [pa.array(np.concatenate([c, seen if i == 0 else np.zeros(len(seen), np.int64)])) for i, c in enumerate(rows[:3])]
            columns.append(pa.concat_arrays([pa.array(place), pa.nulls(len(seen), pa.int64())]))
            for a in range(0, len(columns[0]), 50_000):
                yield pa.RecordBatch.from_arrays([c.slice(a, 50_000) for c in columns], ["gram", "id", "version", "place"])

    return run


def again(batches):
    """The segments whose minimizer occurs again; rows come sorted by minimizer."""
    last, last_row, passed = None, None, True
    for b in batches:
        if not b.num_rows:
            continue
        grams = b.column(0).to_numpy()
        places = b.column(3).fill_null(0).to_numpy()
        witness = b.column(3).is_null().to_numpy(zero_copy_only=False)
        same = grams[1:] == grams[:-1]
        before = np.concatenate([[last == grams[0]], same])
        after = np.concatenate([same, [False]])
        if before[0] and not passed:
            yield last_row
        kept = np.flatnonzero(~witness & (before | after | (places < 0)))
        last, last_row = grams[-1], b.slice(b.num_rows - 1)
        passed = bool(before[-1] or witness[-1] or places[-1] < 0)
        if len(kept):
            places = np.where(places < 0, ~places, places)
            columns = [c.take(pa.array(kept)) for c in b.columns[:3]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(places[kept])], ["gram", "id", "version", "place"])


def repeated_segments(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """The segments whose minimizer occurs more than once in the corpus."""
    every = texts.mapInArrow(segments_of(window, gram), SEGMENTS)
    deal = F.when(F.col("place") < 0, F.xxhash64("id", "version")).otherwise(F.col("gram"))
    return every.repartition(deal).sortWithinPartitions("gram").mapInArrow(again, SEGMENTS)


OCCURRENCE = "segment binary, shard long, id long, version long, start int, windows int, content binary"
# Bytes of different contents that a task gathers before it passes them on.
GATHERED = 64 << 20


def named(content: bytes) -> bytes:
    return xxhash.xxh3_128_digest(content)


def occurrences(window: int):
    """The repeated segments of each document, and each content with its first place in the task.

    Places have no content, and contents neither windows nor a name, which follows from them.
    """

    def run(batches):
        first: dict[bytes, list] = {}
        held = 0
        for b in batches:
            lengths, (grams, places) = _fields(b.column(3))
            starts, counts = _unpack(places)
            found = zip(grams.tolist(), starts.tolist(), (starts + counts + window - 1).tolist())
            names = []
            for doc, version, packed, n in zip(*(b.column(i).to_pylist() for i in range(3)), lengths.tolist()):
                words = zstandard.decompress(packed).split()
                for gram, start, end in itertools.islice(found, n):
                    content = b" ".join(words[start:end])
                    name, place = named(content), (doc, version, start)
                    names.append(name)
                    known = first.get(name)
                    if known is None:
                        first[name] = [gram, place, content]
                        held += len(content) + 200
                    elif place < known[1]:
                        known[1] = place
            if names:
                ids, versions = (np.repeat(b.column(i).to_numpy(), lengths) for i in (0, 1))
                yield _occurrences(names, None, ids, versions, starts, counts, None)
            if held > GATHERED:
                yield from _contents(first)
                first, held = {}, 0
        yield from _contents(first)

    return run


def _contents(first: dict[bytes, list]):
    rows = [(gram, *place, content) for gram, place, content in first.values()]
    for i in range(0, len(rows), 20_000):
        grams, ids, versions, starts, contents = zip(*rows[i : i + 20_000])
        yield _occurrences(None, grams, ids, versions, starts, [0] * len(ids), contents)


def _occurrences(*columns):
    types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
    n = len(columns[2])
    return pa.RecordBatch.from_arrays(
        [pa.nulls(n, t) if c is None else pa.array(c).cast(t) if isinstance(c, np.ndarray) else pa.array(c, t) for c, t in zip(columns, types)],
        ["segment", "shard", "id", "version", "start", "windows", "content"],
    )


PLACE = "struct<id: long, version: long, start: int>"
KNOWN = f"segment binary, own {PLACE}, first array<{PLACE}>, crowded boolean"


def first_places(segments: list[tuple[bytes, int, int, int, bytes]], window: int) -> list[tuple]:
    """(name, own place, first place of each window, False) of segments (name, id, version, start, content).

    Places are None where every window is first in its own segment.
    """
    words = b" ".join(s[4] for s in segments).split()
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
    ends = np.cumsum([s[4].count(b" ") + 1 for s in segments])
    texts = np.split(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), ends[:-1])
    index = FMIndex(texts, len(numbers))
    counts = np.array([len(t) - window + 1 for t in texts])
    of = np.repeat(np.arange(len(segments)), counts)
    offset = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    low, high = index.intervals(index.first[of] + offset, window)
    ids, versions, starts = (np.array([s[i] for s in segments])[of] for i in (1, 2, 3))
    starts = starts + offset
    first = np.arange(len(of))
    again = np.flatnonzero(high - low > 1)
    order = again[np.lexsort((starts[again], versions[again], ids[again], low[again]))]
    if len(order):
        begins = np.concatenate([[True], low[order][1:] != low[order][:-1]])
        first[order] = order[np.flatnonzero(begins)][np.cumsum(begins) - 1]
    ends = np.cumsum(counts)
    moved = np.add.reduceat(first != np.arange(len(of)), ends - counts) > 0
    fields = ids[first], versions[first], starts[first]

    def places(begin: int, end: int) -> list[dict]:
        return [{"id": a, "version": b, "start": c} for a, b, c in zip(*(f[begin:end].tolist() for f in fields))]

    return [
        (s[0], s[1:4], places(e - n, e) if m else None, False)
        for s, n, e, m in zip(segments, counts.tolist(), ends.tolist(), moved.tolist())
    ]


def searched(window: int, shard_words: int, split: int):
    """Index and search of the shards of a partition, whose rows come sorted by shard.

    A segment that is alone in its shard has no other with its words.  The segments of a
    shard with more than ``split`` different ones are passed on as they come.
    """

    def run(batches):
        held, size, group, shard, crowded = [], 0, {}, None, False

        def close():
            """The group's segments to the index, or as they are; nothing of a crowded one is left."""
            nonlocal size
            if len(group) > 1:
                held.extend((named(content), *place, content) for content, place in group.items())
                size += sum(map(len, group)) // 6
                return []
            return [(named(content), place, None, False) for content, place in group.items()]

        for b in batches:
            out = []
            for of, doc, version, start, content in zip(*(b.column(i).to_pylist() for i in range(5))):
                if of != shard:
                    out += close()
                    shard, group, crowded = of, {}, False
                    if size > shard_words:
                        out += first_places(held, window)
                        held, size = [], 0
                place = (doc, version, start)
                if crowded:
                    out.append((named(content), place, None, True))
                elif content not in group:
                    group[content] = place
                    if len(group) > split:
                        out += [(named(c), p, None, True) for c, p in group.items()]
                        group, crowded = {}, True
                elif place < group[content]:
                    group[content] = place
            if out:
                yield _known(out)
        out = close() + (first_places(held, window) if held else [])
        if out:
            yield _known(out)

    return run


def _known(rows):
    place = pa.struct([("id", pa.int64()), ("version", pa.int64()), ("start", pa.int32())])
    named = [(n, dict(zip(("id", "version", "start"), own)), first, crowded) for n, own, first, crowded in rows]
    types = (pa.binary(), place, pa.list_(place), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*named), types)], ["segment", "own", "first", "crowded"])


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _kept(window: int, with_text: bool):
    def run(batches):
        for b in batches:
            rows = []
            lengths, (starts, windows) = _fields(b.column(2))
            stops, ends = starts + windows + (window - 1), np.cumsum(lengths).tolist()
            for doc, packed, n, end in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), lengths.tolist(), ends):
                words = zstandard.decompress(packed).split()
                kept = words
                if n:
                    runs, edges = slice(end - n, end), len(words) + 1
                    gone = np.bincount(starts[runs], minlength=edges) - np.bincount(stops[runs], minlength=edges)
                    left = np.cumsum(gone)[:-1] == 0
                    kept = [w for w, k in zip(words, left.tolist()) if k]
                data = b" ".join(kept)
                row = (None if doc == LAST_ID else doc, len(words), len(words) - len(kept), hashlib.sha256(data).hexdigest())
                rows.append((*row, data.decode()) if with_text else row)
            if rows:
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names[: len(rows[0])])

    return run


def with_names(batches):
    for b in batches:
        names = pa.array([named(c) for c in b.column(0).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([names, b.column(0)], ["segment", "content"])


WINDOWS = "name binary, segment binary, offset int, id long, version long, start int"


def single_windows(window: int):
    """The windows of segments, each by a hash of 128 bits of its words."""

    def run(batches):
        for b in batches:
            rows = []
            for segment, doc, version, start, content in zip(*(b.column(i).to_pylist() for i in range(5))):
                words = content.split()
                for i in range(len(words) - window + 1):
                    name = xxhash.xxh3_128_digest(b" ".join(words[i : i + window]))
                    rows.append((name, segment, i, doc, version, start + i))
            if rows:
                types = (pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
                names = [f.split()[0] for f in WINDOWS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def by_windows(segments: DataFrame, window: int) -> DataFrame:
    """``KNOWN`` of segments (segment, own, content), by an aggregation over their windows."""
    windows = segments.select("segment", "own.id", "own.version", "own.start", "content").mapInArrow(single_windows(window), WINDOWS)
    first = windows.groupBy("name").agg(F.min(F.struct("id", "version", "start")).alias("place"))
    listed = windows.select("name", "segment", "offset").join(first, "name")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "place")))
    places = listed.groupBy("segment").agg(F.transform(ordered, lambda x: x["place"]).alias("first"))
    return segments.select("segment", "own").join(places, "segment").withColumn("crowded", F.lit(False))


def deduplicated(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, split: int = SPLIT, shard_words: int = SHARD_WORDS, with_text: bool = False
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and the kept words if asked for."""
    prepare(docs.sparkSession)
    texts = documents(docs)
    # A document's repeated segments: bounded by its words.
    found = (
        repeated_segments(texts, window, gram)
        .groupBy("id", "version")
        .agg(F.collect_set(F.struct("gram", "place")).alias("found"))
    )
    repeated = store(
        compressed(texts).join(found, ["id", "version"]).select("id", "version", "packed", "found").mapInArrow(occurrences(window), OCCURRENCE),
        "occurrences",
        compression="zstd",
    )
    contents = repeated.filter("content is not null")
    looked_up = store(
        contents.select("shard", "id", "version", "start", "content")
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(searched(window, shard_words, split), KNOWN),
        "looked-up",
        compression="zstd",
    )
    known = looked_up.filter("not crowded")
    crowded = looked_up.filter("crowded").groupBy("segment").agg(F.min("own").alias("own"))
    if not crowded.isEmpty():  # else its joins would shuffle all contents for nothing
        texts_of = contents.select("content").mapInArrow(with_names, "segment binary, content binary")
        texts_of = texts_of.groupBy("segment").agg(F.max("content").alias("content"))
        known = known.unionByName(by_windows(crowded.join(texts_of, "segment"), window))
    known = known.drop("crowded")
    # Runs of windows that start earlier elsewhere: the whole segment, or single windows of its first place.
    here = F.struct("id", "version", "start")
    single = F.transform(
        F.coalesce("first", F.array().cast(f"array<{PLACE}>")),
        lambda place, i: F.when(
            place < F.struct("id", "version", (F.col("start") + i).alias("start")),
            F.struct((F.col("start") + i).alias("start"), F.lit(1).alias("windows")),
        ),
    )
    runs = F.when(here > F.col("own"), F.array(F.struct("start", "windows"))).otherwise(F.filter(single, lambda r: r.isNotNull()))
    removed = (
        repeated.filter("content is null")
        .select("segment", "id", "version", "start", "windows")
        .join(known, "segment")
        .select("id", "version", runs.alias("runs"))
        .filter(F.size("runs") > 0)
        .groupBy("id", "version")
        .agg(F.flatten(F.collect_set("runs")).alias("removed"))
    )
    joined = compressed(texts).join(removed, ["id", "version"], "left")
    result = RESULT + (", kept string" if with_text else "")
    return joined.select("id", "packed", "removed").mapInArrow(_kept(window, with_text), result)
