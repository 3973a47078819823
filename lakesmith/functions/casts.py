"""Column builders for the cast rules.

Numeric parsing is guarded by a text pattern before ``try_cast`` because
Spark accepts forms such as ``'1d'`` that a plain numeric reader rejects.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted numeric spellings.
INT_TEXT = r"^\s*[+-]?\d+\s*$"
NUM_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
SPECIAL_NUMBERS = ["inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan", "+nan", "-nan"]

#: Whole numbers beyond 64 bits, digit by digit.
WIDE = T.DecimalType(38, 0)

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def kind_of(dt: T.DataType) -> str:
    """Coarse kind used by profiling and rule generation."""
    if isinstance(dt, INTEGRAL_TYPES):
        return "integer"
    if isinstance(dt, T.DecimalType) and dt.scale == 0:
        return "wide" if dt.precision > 18 else "integer"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(dt, T.StringType):
        return "text"
    return "other"


def is_number_text(c: Column) -> Column:
    """Text that a plain numeric reader accepts (digits, or inf/nan spellings)."""
    return c.rlike(NUM_TEXT) | F.lower(F.trim(c)).isin(SPECIAL_NUMBERS)


def to_double(c: Column, dt: T.DataType) -> Column:
    """Numeric reading of any column; unparsable text and NaN become null."""
    k = kind_of(dt)
    if k == "text":
        d = F.when(is_number_text(c), F.trim(c).try_cast("double"))
    elif k in ("integer", "wide", "float", "boolean"):
        d = c.cast("double")
    elif k == "datetime":
        d = (F.unix_micros(c.cast("timestamp")) * F.lit(1000)).cast("double")
    else:
        d = F.lit(None).cast("double")
    return F.nanvl(d, F.lit(None).cast("double"))


def fraction_count(c: Column, dt: T.DataType) -> Column:
    """Aggregate: values that are no whole numbers of 64 bits (integer-cast guard,
    Q3); a column with any keeps its type, so no digit is lost."""
    if kind_of(dt) == "wide":
        return F.count_if(c.isNotNull() & to_long(c, dt).isNull())
    d = to_double(c, dt)
    return F.count_if(d.isNotNull() & ((d != F.floor(d)) | F.isnan(d - d) | to_long(c, dt).isNull()))


def to_long(c: Column, dt: T.DataType) -> Column:
    """Integer reading; only valid when the column holds no fractions."""
    k = kind_of(dt)
    if k == "integer":
        return c.cast("long")
    if k == "wide":
        return c.try_cast("long")
    if k == "text":
        exact = F.when(c.rlike(INT_TEXT), F.trim(c).try_cast("long"))
        return F.coalesce(exact, to_double(c, dt).try_cast("long"))
    return to_double(c, dt).try_cast("long")


def wide_misfits(c: Column, dt: T.DataType) -> Column:
    """Aggregate: numbers that are no whole ones of up to 38 digits; a column
    with any keeps its type."""
    if kind_of(dt) in ("integer", "wide"):
        return F.count_if(F.lit(False))
    d = to_double(c, dt)
    return F.count_if(d.isNotNull() & ((d != F.rint(d)) | F.isnan(d - d) | to_wide(c, dt).isNull()))


def to_wide(c: Column, dt: T.DataType) -> Column:
    """Whole numbers of up to 38 digits, every digit kept; only valid when the
    column holds no fractions."""
    k = kind_of(dt)
    if k in ("integer", "wide"):
        return c.cast(WIDE)
    if k == "text":
        exact = F.when(c.rlike(INT_TEXT), F.trim(c).try_cast(WIDE))
        return F.coalesce(exact, to_double(c, dt).try_cast(WIDE))
    return to_double(c, dt).try_cast(WIDE)


def to_text(c: Column, dt: T.DataType, integral_as_int: bool = False) -> Column:
    """Text reading; null stays null.  Whole doubles may print without '.0' (Q10)."""
    k = kind_of(dt)
    if k == "text":
        return c
    if k == "boolean":
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if k == "float" and integral_as_int:
        return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")
