"""Exact deduplication by Grace hashing, in two rounds.

Records are partitioned by a hash of their content, and a partition too large for
memory is partitioned again into spill files, recursively with other bits of the hash,
until each bucket fits an open-addressing table.  The table compares complete contents;
the hash only finds the place to look.

Round one runs in the tasks that read the records and keeps one content per task and
class, so that a class with a third of all rows costs one row per task afterwards.
Round two deals these contents by hash and merges them.  Members find their class by a
narrow join on a number that round one has given.

Two texts are equal if they are identical after all white space of [\\x20\\x09-\\x0D] is
deleted.  Null counts as empty; empty texts form one class.  Of a class, the row with
the most code points in the original text stays, then the smallest doc_id (null last).
Of repeated rows with the same doc_id one stays.  Other columns are ignored.
"""

from __future__ import annotations

import ast
import hashlib
import itertools
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import WHITE, prepare, store, text_bytes

# Bytes of distinct content that one table may hold before its bucket is split.
TABLE_BYTES = 96 << 20
FANOUT = 16
# Bits of the hash used by a split; once they are used up, equal hashes remain and are
# compared in one table.
SPLIT_BITS = 4
HASH_BITS = 64


class ContentTable:
    """Open addressing with linear probing over complete contents."""

    def __init__(self, capacity: int = 1024):
        self.places = [-1] * capacity
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.nbytes = 0

    def find(self, h: int, content: bytes) -> tuple[int, bool]:
        """The content's number and whether it is new."""
        mask = len(self.places) - 1
        i = (h ^ (h >> 32)) & mask
        while (n := self.places[i]) >= 0:
            if self.hashes[n] == h and self.contents[n] == content:
                return n, False
            i = (i + 1) & mask
        n = self.places[i] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.nbytes += len(content)
        if 2 * len(self.contents) > len(self.places):
            self._rehash(4 * len(self.places))
        return n, True

    def _rehash(self, capacity: int) -> None:
        self.places, mask = [-1] * capacity, capacity - 1
        for n, h in enumerate(self.hashes):
            i = (h ^ (h >> 32)) & mask
            while self.places[i] >= 0:
                i = (i + 1) & mask
            self.places[i] = n


class Spill:
    """Length-prefixed records of one bucket in a file that goes with its handle."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()

    def write(self, h: int, content: bytes, payload: tuple) -> None:
        note = repr(payload).encode()
        for n in (h, len(content), len(note)):
            self.file.write(n.to_bytes(8, "little"))
        self.file.write(content)
        self.file.write(note)

    def read(self) -> Iterator[tuple[int, bytes, tuple]]:
        self.file.seek(0)
        while head := self.file.read(24):
            h, n, m = (int.from_bytes(head[i : i + 8], "little") for i in (0, 8, 16))
            yield h, self.file.read(n), ast.literal_eval(self.file.read(m).decode())
        self.file.close()


def grace_classes(
    records: Iterable[tuple[int, bytes, tuple]], table_bytes: int = TABLE_BYTES, used_bits: int = 0
) -> Iterator[tuple[int, bytes | None, tuple, tuple[int, int]]]:
    """For each record (hash, content, payload): its hash, its content if it is the first of
    its class, its payload and the number of its class.

    While the table has room, records are classed as they come.  Once it is full, what it
    doesn't know goes to spill files by the next bits of the hash, which are worked off
    one after the other in the same way.
    """
    table, spills, bucket = ContentTable(), None, 0
    stack: list[tuple[Iterable, int]] = [(records, used_bits)]
    while stack:
        rows, bits = stack.pop()
        table, spills = ContentTable(), None
        for h, content, payload in rows:
            if spills is not None:
                known = _known(table, h, content)
                if known is None:
                    part = (h >> max(0, HASH_BITS - SPLIT_BITS - bits)) % FANOUT
                    if part not in spills:
                        spills[part] = Spill()
                    spills[part].write(h, content, payload)
                    continue
                yield h, None, payload, (bucket, known)
                continue
            n, new = table.find(h, content)
            yield h, content if new else None, payload, (bucket, n)
            if table.nbytes > table_bytes and bits < HASH_BITS:
                spills = {}
        bucket += 1
        if spills:
            stack += [(s.read(), bits + SPLIT_BITS) for s in spills.values()]


def _known(table: ContentTable, h: int, content: bytes) -> int | None:
    mask = len(table.places) - 1
    i = (h ^ (h >> 32)) & mask
    while (n := table.places[i]) >= 0:
        if table.hashes[n] == h and table.contents[n] == content:
            return n
        i = (i + 1) & mask
    return None


LOCAL = "doc_id long, points long, row_id long, class_id long, text_sha256 string, hash long, content binary"
CLASS = "class_id long, root long"


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def local_classes(table_bytes: int):
    """Round one: classes within a task.  The first record of each carries its content."""
    delete = WHITE.encode()

    def run(batches):
        task = TaskContext.get().partitionId() << 36  # stored with its rows, so that a rerun elsewhere changes nothing
        seen = itertools.count(task)
        numbers: dict[tuple[int, int], int] = {}

        def records():
            for b in batches:
                for doc_id, points, data in zip(*(b.column(i).to_pylist() for i in range(3))):
                    content = data.translate(None, delete)
                    yield xxhash.xxh64_intdigest(content), content, (doc_id, points, next(seen), hashlib.sha256(content).hexdigest())

        rows, held = [], 0
        for h, content, (doc_id, points, row_id, sha), of in grace_classes(records(), table_bytes):
            rows.append((doc_id, points, row_id, task | numbers.setdefault(of, len(numbers)), sha, _signed(h), content))
            held += len(content or b"") + 200
            if held > 8 << 20:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    return run


def _batch(rows):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = ["doc_id", "points", "row_id", "class_id", "text_sha256", "hash", "content"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def merged_classes(table_bytes: int):
    """Round two: the tasks' classes with the same content get one root."""

    def run(batches):
        roots: dict[tuple[int, int], int] = {}

        def records():
            for b in batches:
                for h, content, class_id in zip(*(b.column(i).to_pylist() for i in range(3))):
                    yield h % (1 << 64), content, (class_id,)

        out: tuple[list, list] = ([], [])
        for _, _, (class_id,), of in grace_classes(records(), table_bytes):
            out[0].append(class_id)
            out[1].append(roots.setdefault(of, class_id))
            if len(out[0]) >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["class_id", "root"])
                out = ([], [])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["class_id", "root"])

    return run


def duplicate_classes(
    docs: DataFrame, text: str | Column = "text", key: str = "doc_id", table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_points."""
    prepare(docs.sparkSession)
    column = F.col(text) if isinstance(text, str) else text
    narrow = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.length(column), F.lit(0)).cast("long").alias("points"),
        text_bytes(column).alias("content"),
    )
    local = store(narrow.mapInArrow(local_classes(table_bytes), LOCAL), "local-classes")
    roots = (
        local.filter(F.col("content").isNotNull())
        .select("hash", "content", "class_id")
        .repartition("hash")
        .mapInArrow(merged_classes(table_bytes), CLASS)
    )
    # The row that stays, found from one row per task and class.
    rank = F.struct((-F.col("points")).alias("short"), F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_id")
    tallies = local.groupBy("class_id").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("n"))
    per_class = tallies.join(roots, "class_id")
    per_root = per_class.groupBy("root").agg(F.min("best").alias("best"), F.sum("n").alias("group_size"))
    verdicts = store(
        per_class.select("class_id", "root")
        .join(per_root, "root")
        .select("class_id", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row"), "group_size"),
        "classes",
    )
    return local.join(verdicts, "class_id").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"),
        "text_sha256",
        F.col("points").alias("n_points"),
    )
