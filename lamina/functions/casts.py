"""Casts that turn unreadable text into null instead of failing the query."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


ISO_DAY = "yyyy-MM-dd"


def text_date(c: Column, pattern: str = ISO_DAY) -> Column:
    """Date in exactly ``pattern`` after trimming; anything else is null.

    For the default pattern, the shape is checked and Spark's own cast reads the digits: a
    formatter is slower, and slowest where it fails.  The cast alone would also take a
    month, a time or a single digit (``2024-05``, ``2024-05-1T``, ``2024-5-1``).
    """
    text = F.trim(c)
    if pattern != ISO_DAY:
        return F.try_to_date(text, pattern)
    dashes = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    shaped = (F.length(text) == 10) & dashes & F.substring(text, 10, 1).between("0", "9")
    return F.when(shaped, text.try_cast("date"))


def text_double(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def text_int(c: Column) -> Column:
    """Integer of a trimmed text; a decimal part is cut off (``1948.0`` is 1948).

    A zero is put before the digits so that ``.5`` becomes 0; exponents stay null.
    """
    whole = F.regexp_replace(F.trim(c), r"^([+-]?)([0-9]*)\.[0-9]*$", "$10$2")
    return whole.try_cast("int")
