"""Conversions that give NULL for a value without such a form.

``try_cast`` alone raises and catches an exception for every bad value, which made a column of
bad values thirty times slower than one of good ones. Values are therefore tested before.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts of whole and of floating-point numbers, and bounds of the whole types.
WHOLE_TEXT = r"^\s*[+-]?\d+\s*$"
NUMBER_TEXT = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|nan|inf|infinity)\s*$"
WHOLE_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
SAME_AS = {"byte": "tinyint", "short": "smallint", "integer": "int", "long": "bigint"}


def safe_cast(value: Column, source: T.DataType, target: str) -> Column:
    """``value`` of type ``source`` as ``target``; NULL where it has no such form, which includes
    a number that would lose its fraction."""
    target = SAME_AS.get(target.lower(), target.lower())
    if isinstance(source, T.StringType) and target in WHOLE_BITS:
        return F.when(value.rlike(WHOLE_TEXT), value.try_cast(target))
    if isinstance(source, T.StringType) and target in ("double", "float"):
        return F.when(value.rlike(NUMBER_TEXT), value.try_cast(target))
    if isinstance(source, T.NumericType) and target in WHOLE_BITS:
        bound = 2 ** (WHOLE_BITS[target] - 1)
        fits = value.between(-bound, bound - 1)
        if isinstance(source, T.FractionalType):
            fits = fits & (value == F.floor(value))
        return F.when(fits, value.try_cast(target))
    return value.try_cast(target)
