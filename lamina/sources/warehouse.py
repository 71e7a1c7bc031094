"""Loading a relational warehouse, or any other sink, from a lake table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from lamina.functions import fixed
from lamina.operators.clean import project_present
from lamina.sources.tables import year_window

Sink = Callable[[DataFrame], None]


def write_parallelism(
    rows: int, max_parts: int = fixed.MAX_WRITERS, rows_per_part: int = fixed.ROWS_PER_WRITER
) -> int:
    """Number of writers: one per ``rows_per_part``, at least 1 and at most ``max_parts``."""
    return max(1, min(max_parts, rows // rows_per_part + 1))


def warehouse_slice(df: DataFrame, columns: Sequence[str] = (), since: int | None = None) -> DataFrame:
    """Window, then projection: both reach the scan."""
    return project_present(year_window(df, since), columns)


def load_table(
    df: DataFrame,
    sink: Sink,
    columns: Sequence[str] = (),
    since: int | None = None,
    max_parts: int | None = None,
    rows_per_part: int = fixed.ROWS_PER_WRITER,
) -> int:
    """Writes the slice through ``sink``; returns the rows.

    The count reads no column data from Parquet.  Every task writes, without a shuffle,
    unless the sink bounds its writers or ``max_parts`` does.
    """
    part = warehouse_slice(df, columns, since)
    rows = part.count()
    bound = max_parts or getattr(sink, "max_writers", None)
    sink(part.repartition(write_parallelism(rows, bound, rows_per_part)) if bound else part)
    return rows


def jdbc_sink(
    url: str, table: str, properties: Mapping[str, str], batch: int = fixed.JDBC_BATCH, max_writers: int = fixed.MAX_WRITERS
) -> Sink:
    """Batched overwrite that truncates and so keeps the table, its indexes and grants.

    ``max_writers`` is the number of connections that the receiving database stands.
    """

    def write(df: DataFrame) -> None:
        writer = df.write.mode("overwrite").option("truncate", True).option("batchsize", batch)
        writer.jdbc(url, table, properties=dict(properties))

    write.max_writers = max_writers
    return write


def parquet_sink(path: str) -> Sink:
    def write(df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(path)

    return write
