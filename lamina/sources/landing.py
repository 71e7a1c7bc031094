"""Landed CSV files, read as text whatever the order and spelling of their columns.

``read_landing`` deals files, and ranges of large ones, to tasks.  A task takes the header of
its file and then the rows, so that the bytes are read once and the plan has one branch,
however many different headers there are.  (The same as a Python data source would start
three more kinds of Python process per session, which costs more than reading does.)
"""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pa_csv
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.functions import fixed
from lamina.operators.clean import normalise_names, project_present, repaired

# The reader travels with the plan: executors need no copy of the library.
for _module in (__name__, repaired.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_module])

BOM = "\ufeff"


def first_lines() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Passes on the first line of each file that begins in a task.

    Lines of a file come in order.  A split that does not reach its file's end fills its
    task, so a task that begins with one has no other file and stops after a batch.
    """

    def run(batches):
        seen: set[str] = set()
        for batch in batches:
            lines, files, starts, lengths, sizes = (batch.column(i) for i in range(5))
            rows: tuple[list[str], list[str]] = ([], [])
            named = files.dictionary_encode()
            for i, file in enumerate(named.dictionary.to_pylist()):
                at = pc.index(named.indices, pa.scalar(i, named.indices.type)).as_py()
                if file not in seen and starts[at].as_py() == 0:
                    rows[0].append(file)
                    rows[1].append(lines[at].as_py())
                seen.add(file)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in rows], ["file", "header"])
            if batch.num_rows and len(seen) == 1 and starts[0].as_py() + lengths[0].as_py() < sizes[0].as_py():
                return

    return run


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """``(file, header)`` of every file that has a first line.

    Tasks pass over their lines without sorting or shuffling them.
    """
    meta = [F.col(f"_metadata.{n}").alias(n) for n in ("file_path", "file_block_start", "file_block_length", "file_size")]
    first = spark.read.text(path).select("value", *meta).mapInArrow(first_lines(), "file string, header string")
    clean = F.trim(F.regexp_replace(F.col("header"), f"^{BOM}", ""))
    return first.select("file", clean.alias("header")).filter(F.col("header") != "")


# Stores that tasks reach without Spark; files of others are read by Spark itself.
STORES = ("", "file", "hdfs", "s3", "s3a", "gs")
SPLIT_BYTES = 128 << 20
PACKED = (".gz", ".bz2", ".zst", ".lz4")


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^s3a:", "s3:", path)) if ":" in path else (fs.LocalFileSystem(), path)


def file_ranges(files: Sequence[str], split_bytes: int = SPLIT_BYTES) -> list[list[tuple[str, int, int]]]:
    """(file, start, end) by task: small files share one; large ones are cut, unless they are compressed."""
    tasks: list[list[tuple[str, int, int]]] = []
    room = 0
    for path in sorted(files):
        store, at = _opened(path)
        size = store.get_file_info(at).size or 0
        step = max(size, 1) if path.endswith(PACKED) else split_bytes
        for start in range(0, size, step):
            end = min(size, start + step)
            if not tasks or room < end - start:
                tasks.append([])
                room = split_bytes
            tasks[-1].append((path, start, end))
            room -= end - start
    return tasks


class Lines(io.RawIOBase):
    """The lines that begin in a range of a file; the last one is read beyond the end."""

    def __init__(self, file, start: int, end: int):
        self.file, self.left, self.ended = file, end - start, False

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self._next(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def _next(self, n: int) -> bytes:
        if self.left > 0:
            data = self.file.read(min(self.left, n))
            self.left = self.left - len(data) if data else 0
            if self.left == 0 and data.endswith(b"\n"):
                self.ended = True
            return data
        data = b"" if self.ended else self.file.read(n)
        at = data.find(b"\n")
        self.ended = self.ended or not data or at >= 0
        return data if at < 0 else data[: at + 1]


def _line(file) -> bytes:
    """The file's next line, with its end."""
    parts, at = [], file.tell()
    while data := file.read(1 << 14):
        if (end := data.find(b"\n")) >= 0:
            parts.append(data[: end + 1])
            break
        parts.append(data)
    line = b"".join(parts)
    file.seek(at + len(line))
    return line


def read_range(path: str, start: int, end: int, columns: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The wanted columns of the rows that begin in a range of a file; null where the file hasn't a column."""
    store, at = _opened(path)
    if path.endswith(PACKED):
        file = io.BytesIO(store.open_input_stream(at, compression="detect").read())
        start, end = 0, file.getbuffer().nbytes
    else:
        file = store.open_input_file(at)
    with file:
        first = _line(file)
        header = first.decode("utf-8-sig").strip()
        if not header:
            return
        names = [repaired(n) for n in next(csv.reader([header]))]
        clashes = sorted({n for n in names if names.count(n) > 1})
        if clashes:
            raise ValueError(f"column names clash after repair in {path}: {clashes}")
        begin = len(first)
        if start > begin:
            # A line that begins before the range belongs to the range before it.
            file.seek(start - 1)
            _line(file)
            begin = file.tell()
        lines = io.BufferedReader(Lines(file, begin, end), 1 << 20)
        if begin >= end or not lines.peek(1):
            return
        numbered = [f"c{i}" for i in range(len(names))]
        read = pa_csv.open_csv(
            lines,
            pa_csv.ReadOptions(use_threads=False, column_names=numbered, block_size=4 << 20),
            pa_csv.ParseOptions(double_quote=True, newlines_in_values=False),
            pa_csv.ConvertOptions(
                column_types=dict.fromkeys(numbered, pa.string()), null_values=[""], strings_can_be_null=True,
                quoted_strings_can_be_null=False, include_columns=[numbered[names.index(c)] for c in columns if c in names] or None,
            ),
        )
        for batch in read:
            found = {n: batch.column(c) for n, c in zip(names, numbered) if c in batch.schema.names}
            arrays = [found[c] if c in found else pa.nulls(batch.num_rows, pa.string()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, list(columns))


def read_landing(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = fixed.BRONZE_COLUMNS,
    null_spellings: Sequence[str] = fixed.NULL_SPELLINGS,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """The listed columns as text, from CSV files whose headers may differ.

    Columns are brought together by repaired name; those that a file hasn't are null.  The
    driver holds one entry per file, as Spark's own file listing does.
    """
    files = spark.read.text(path).inputFiles()
    stores = {f.partition(":")[0] if ":" in f else "" for f in files}
    merged = _read_by_ranges(spark, files, columns, split_bytes) if stores <= set(STORES) else read_by_spark(spark, path, columns)
    nulls = list(null_spellings)
    return merged.select(*[F.when(~F.col(n).isin(nulls), F.col(n)).alias(n) for n in columns])


def _text(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in columns])


def _read_by_ranges(spark: SparkSession, files: Sequence[str], columns: Sequence[str], split_bytes: int) -> DataFrame:
    """A row for each task's ranges; the driver holds no more than Spark's own listing does."""
    tasks = [(r,) for r in file_ranges(files, split_bytes)]
    if not tasks:
        return spark.createDataFrame([], _text(columns))
    dealt = spark.createDataFrame(tasks, "ranges array<struct<file:string,start:long,end:long>>")
    many = len(tasks) > spark.sparkContext.defaultParallelism
    dealt = dealt.repartition(len(tasks)) if many else dealt.coalesce(len(tasks))
    return dealt.mapInArrow(_ranges_read(list(columns)), _text(columns))


def _ranges_read(columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            for ranges in batch.column(0).to_pylist():
                for r in ranges:
                    yield from read_range(r["file"], r["start"], r["end"], columns)

    return run


def read_by_spark(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """For stores that only Spark reads: one scan per distinct header, after a pass for the headers."""
    groups: dict[str, list[str]] = {}
    for row in file_headers(spark, path).toLocalIterator():
        groups.setdefault(row["header"], []).append(row["file"])
    if len(groups) == 1:
        parts = [_read_group(spark, path, next(iter(groups)))]
    else:
        parts = [_read_group(spark, sorted(files), header) for header, files in sorted(groups.items())]
    parts = [project_present(normalise_names(p), columns) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, spark.createDataFrame([], _text(columns)))


def _read_group(spark: SparkSession, paths: str | list[str], header: str) -> DataFrame:
    names = next(csv.reader([header]))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.option("escape", '"').option("mode", "FAILFAST").csv(paths)
