"""Categorical expressions: bands, memberships, labels and ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(c: Column, edges: Sequence[float], labels: Sequence[str], null_label: str | None = None) -> Column:
    """Left-closed band of ``c``; ``labels`` has one more entry than ``edges``.

    Without ``null_label`` a null falls into the last band, like any value that is
    not below an edge.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("labels must have one more entry than edges")
    branches = [(c < F.lit(edge), label) for edge, label in zip(edges, labels)]
    if null_label is not None:
        branches.insert(0, (c.isNull(), null_label))
    return first_match(branches, F.lit(labels[-1]))


def first_match(branches: Sequence[tuple[Column, str]], otherwise: Column) -> Column:
    """Text of the first branch whose condition is true."""
    if not branches:
        return otherwise
    (condition, label), *rest = branches
    chain = reduce(lambda acc, b: acc.when(b[0], F.lit(b[1])), rest, F.when(condition, F.lit(label)))
    return chain.otherwise(otherwise)


def member(c: Column, values: Sequence[str]) -> Column:
    """Membership flag; null stays null."""
    return c.isin(list(values))


def display_label(c: Column, labels: Mapping[str, str]) -> Column:
    """Replacement label where one is declared, the value itself elsewhere."""
    return first_match([(c == F.lit(k), v) for k, v in labels.items()], c)


def display_rank(c: Column, ordered: Sequence[str], unknown: int) -> Column:
    """1-based position of ``c`` in ``ordered``, ``unknown`` when absent or null."""
    position = F.array_position(F.array(*[F.lit(v) for v in ordered]), c).cast("int")
    return F.when(position > 0, position).otherwise(F.lit(unknown))


def still_valid(end: Column, as_of: Column | None = None) -> Column:
    """End date on or after the day asked; null stays null."""
    return end >= (F.current_date() if as_of is None else as_of)
