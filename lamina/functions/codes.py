"""Place-code expressions: repair, parent derivation and fallback names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamina.functions import fixed


def repair_code(c: Column) -> Column:
    """Code without a leading ``old`` marker."""
    return F.regexp_replace(c, fixed.OLD_CODE_PATTERN, "")


def derive_parent(code: Column, given: Column) -> Column:
    """Given parent code, or the one that the (repaired) child code starts with."""
    fixed_code = repair_code(code)
    derived = F.when(fixed_code.rlike(fixed.OVERSEAS_CODE_PATTERN), F.left(fixed_code, F.lit(3))).when(
        fixed_code.rlike(fixed.CORSICA_CODE_PATTERN) | fixed_code.rlike(fixed.MAINLAND_CODE_PATTERN),
        F.left(fixed_code, F.lit(2)),
    )
    return F.coalesce(given, derived)


def name_or_unknown(name: Column, code: Column) -> Column:
    """Reference name, else the code in words, else a fixed text."""
    by_code = F.concat(F.lit(fixed.UNKNOWN_PARENT), code, F.lit(")"))
    return F.coalesce(name, by_code, F.lit(fixed.UNDETERMINED_PARENT))


def geocoded(status: Column) -> Column:
    """The source says that the address was matched; null counts as no."""
    return F.coalesce(F.lower(F.trim(status)).startswith(fixed.GEOCODED_PREFIX), F.lit(False))


def geocoded_precisely(status: Column, score: Column, threshold: float = fixed.PRECISE_SCORE) -> Column:
    """Matched, and with a score of at least ``threshold``; null counts as no."""
    return F.coalesce(geocoded(status) & (score >= F.lit(threshold)), F.lit(False))
