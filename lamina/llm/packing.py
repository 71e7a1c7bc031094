"""Best-fit decreasing packing of tokenised documents.

A document is its token ids and an end id.  One longer than a sequence is cut into full
pieces, of which the first may be shorter; full pieces fill a sequence of their own, and
the rest is packed best fit decreasing: longest first, each into the open sequence with
the least room that is enough.

Lengths are whole numbers up to the sequence length, so the packing depends on nothing
but the number of pieces of each length: a histogram of fixed size.  From it, runs of
equal pieces are placed together, exactly as placing them one after the other would.
Open sequences stand in a segment tree over remaining capacities, which finds the
tightest one in logarithmic time; those with equal room are kept as ranges of numbers.
The plan of runs is of fixed order too, and each piece finds its place in it by its rank
among the pieces of its length.  Ranks are counted in buckets, so that no window spans a
length that a third of the pieces share.

A null text is an empty one: a document of the end id alone.  Repeated rows are pieces
like others; ties are interchangeable.  Other columns are ignored, and an empty table
gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lamina.llm.common import prepare, store

SEQUENCE = 2048
END_ID = 0
# Buckets in which the pieces of a length are ranked.
BUCKETS = 512
# Bytes of a task's table of known chunks, after which it starts afresh.
KNOWN_BYTES = 128 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Rooms:
    """Segment tree over capacities: the smallest non-empty capacity that is large enough."""

    def __init__(self, capacity: int):
        self.width = 1 << (capacity + 1 - 1).bit_length() if capacity else 1
        while self.width < capacity + 1:
            self.width *= 2
        self.count = [0] * (2 * self.width)  # ranges at or below a node
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, first: int, n: int) -> None:
        self.ranges[room].append((first, n))
        self._count(room, 1)

    def take(self, room: int) -> tuple[int, int]:
        self._count(room, -1)
        return self.ranges[room].pop()

    def _count(self, room: int, by: int) -> None:
        i = room + self.width
        while i:
            self.count[i] += by
            i //= 2

    def tightest(self, need: int) -> int | None:
        """The least capacity of ``need`` or more that an open sequence has."""
        i = need + self.width
        if self.count[i]:
            return need
        while i > 1 and (i % 2 or not self.count[i + 1]):
            i //= 2
        if i <= 1:
            return None
        i += 1
        while i < self.width:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.width


def best_fit_plan(histogram: dict[int, int], capacity: int = SEQUENCE) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, rank of the first piece, pieces a sequence, first sequence, offset there).

    A run's pieces go, so many to each, to sequences of consecutive numbers.  Also returns
    the number of sequences.
    """
    rooms, opened, runs = Rooms(capacity), 0, []
    for length in sorted((n for n, k in histogram.items() if k), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, per = capacity, capacity // length
                first, n = opened, -(-left // per)
                opened += n
            else:
                per = room // length
                first, n = rooms.take(room)
            full = min(n, left // per)
            if full:
                runs.append((length, rank, per, first, capacity - room))
                rank, left = rank + full * per, left - full * per
                if room - per * length:
                    rooms.add(room - per * length, first, full)
            if full < n and left:  # here fewer than fill one
                runs.append((length, rank, left, first + full, capacity - room))
                rooms.add(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if full < n:
                rooms.add(room, first + full, n - full)
    return runs, opened


# A chunk boundary before a space is one between the tokenizer's words unless white space
# touches the space.
TOUCHING = re.compile(r"\s\s")
# Fixed value: the split pattern of byte-level vocabularies of this family.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(path: str) -> tuple[dict[bytes, int], list[str]]:
    """Tokens of a byte-level BPE file, whose ids follow the order of its merges, and its special strings."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocab, special = file["model"]["vocab"], [t["content"] for t in file.get("added_tokens", ())]
    # Such files write printable bytes as themselves and the others as code points from 256.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = (b for b in range(256) if b not in shown)
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}, special


class Ids:
    """Token ids of texts as little-endian bytes, with a table of the chunks seen.

    Words of a text are never merged across the boundary before a space that stands
    between two other characters, so a text's ids are those of its chunks, put together;
    texts with touching white space are encoded whole, and texts that spell a special token
    by the tokenizer itself.  Unknown chunks are encoded in one call, by a coder of the same
    vocabulary that is several times faster on text without repeats, and taken apart again
    by the lengths of their tokens.
    """

    def __init__(self, path: str):
        ranks, self.special = vocabulary(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.coder = tiktoken.Encoding("packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.bytes = 0

    def _learn(self, chunks: list[str]) -> None:
        """Adds chunks, each to be preceded by a space and without one in itself."""
        ids = np.frombuffer(self._ids(" " + " ".join(chunks)), dtype="<u4")
        ends = np.cumsum(self.lengths[ids])
        upto = np.searchsorted(ends, np.cumsum([1 + len(c.encode()) for c in chunks]), "left") + 1
        data, at = ids.tobytes(), 0
        for chunk, i in zip(chunks, upto.tolist()):
            self.known[chunk] = data[4 * at : 4 * i]
            self.bytes += 200 + 4 * len(chunk) + 4 * (i - at)
            at = i

    def _whole(self, text: str) -> bytes:
        return self._by_tokenizer(text) if any(x in text for x in self.special) else self._ids(text)

    def _by_tokenizer(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _ids(self, text: str) -> bytes:
        try:
            return self.coder.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        except ValueError:
            # Its pattern gives up on very long runs of white space.
            return self._by_tokenizer(text)

    def _by_itself(self, text: str) -> bool:
        touching = text[:1].isspace() or text[-1:].isspace() or TOUCHING.search(text)
        return bool(touching) or any(x in text for x in self.special)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if self._by_itself(t) else t.split(" ") for t in texts]
        words = set()
        for s in split:
            if s:
                words.update(s[1:])
        if self.bytes > KNOWN_BYTES:
            self.known.clear()
            self.bytes = 0
        if new := list(words.difference(self.known)):
            self._learn(new)
        find = self.known.__getitem__
        return [
            self._whole(t) if s is None else self._whole(s[0]) + b"".join(map(find, s[1:]))
            for t, s in zip(texts, split)
        ]


def tokenised(path: str, sequence: int):
    end = np.array([END_ID], dtype="<u4").tobytes()
    names, types = zip(*((f.split()[0], {"long": pa.int64(), "int": pa.int32()}[f.split()[1]]) for f in PIECES.split(", ")))

    def run(batches):
        ids = Ids(path)
        for b in batches:
            rows: list[tuple] = []
            docs = b.column(0).to_pylist()
            for doc_id, data in zip(docs, ids.encode([t or "" for t in b.column(1).to_pylist()])):
                data += end
                n, at = len(data) // 4, 0
                for piece in range(-(-n // sequence)):
                    upto = (n - 1) % sequence + 1 + piece * sequence
                    rows.append((doc_id, piece, at, upto - at, zlib.crc32(data[4 * at : 4 * upto])))
                    at = upto
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], list(names))

    return run


def pieces_of(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenised(tokenizer_path, sequence), PIECES)


def packed(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to stored pieces."""
    spark = pieces.sparkSession
    ranked = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS)).cast("int"))
    tally = store(ranked.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `sequence` rows
    runs, _ = best_fit_plan(histogram, sequence)
    earlier = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = tally.withColumn("start_rank", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    fields = "first_rank long, per long, first_sequence long, base long"
    by_length: dict[int, list] = {}
    for length, *run in runs:
        by_length.setdefault(length, []).append(tuple(run))
    plan = spark.createDataFrame(list(by_length.items()), f"length long, runs array<struct<{fields}>>")
    # The plan's last run that begins at or before the rank.
    run = F.element_at(F.filter("runs", lambda r: r["first_rank"] <= F.col("rank")), -1)
    step = F.col("rank") - F.col("run.first_rank")
    return (
        ranked.withColumn("in_bucket", F.row_number().over(inside) - 1)
        .join(starts, ["length", "bucket"])
        .withColumn("rank", F.col("start_rank") + F.col("in_bucket"))
        .join(F.broadcast(plan), "length")  # at most `sequence` rows
        .withColumn("run", run)
        .withColumn("sequence_id", F.col("run.first_sequence") + F.floor(step / F.col("run.per")))
        .withColumn("offset", F.col("run.base") + (step % F.col("run.per")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece, with its sequence and its place there."""
    return packed(store(pieces_of(docs, tokenizer_path, sequence), "pieces"), sequence)
