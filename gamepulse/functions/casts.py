"""Strict text-to-number casts that yield null for anything malformed, never an error."""

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_TEXT = r"^[+-]?[0-9]+\z"


def _text(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_int(c: Column | str) -> Column:
    """32-bit integer; blanks around the digits and overflow give null."""
    c = _text(c)
    return F.when(c.rlike(INT_TEXT), c.try_cast("int"))


def blank_as_zero_int(c: Column | str) -> Column:
    c = _text(c)
    return F.when(c == "", F.lit(0)).otherwise(strict_int(c))


def strict_double(c: Column | str) -> Column:
    return _text(c).try_cast("double")


def blank_as_zero_double(c: Column | str) -> Column:
    c = _text(c)
    return F.when(c == "", F.lit(0.0)).otherwise(strict_double(c))


def money(c: Column | str) -> Column:
    """Amounts are held as decimal(18,2), so sums do not depend on row order."""
    return _text(c).try_cast("decimal(18,2)")
