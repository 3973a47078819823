"""Common types of columns that meet in a join or a union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions.casts import INTEGRAL_TYPES, kind_of

#: Digits of the longest exact number.
MOST_DIGITS = 38


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest of the usual types that holds the values of both."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, INTEGRAL_TYPES) and isinstance(b, INTEGRAL_TYPES):
        return T.LongType()
    kinds = {kind_of(a), kind_of(b)}
    if kinds <= {"integer", "wide", "float"}:
        exact = [_exact(t) for t in (a, b)]
        if None in exact:
            return T.DoubleType()
        whole, scale = (max(x) for x in zip(*exact))
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else T.DoubleType()
    if kinds == {"datetime"}:
        return T.TimestampNTZType() if T.TimestampNTZType() in (a, b) else T.TimestampType()
    return T.StringType()


def _exact(dt: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number type."""
    if isinstance(dt, INTEGRAL_TYPES):
        return 19, 0
    return (dt.precision - dt.scale, dt.scale) if isinstance(dt, T.DecimalType) else None


def as_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    return c if have == want else c.cast(want)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name, missing columns null.  Names that differ only in
    case are one column (the first spelling); types are brought together."""
    names: dict[str, str] = {}
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            key = f.name.lower()
            names.setdefault(key, f.name)
            types[key] = common_type(types[key], f.dataType) if key in types else f.dataType
    aligned = []
    for df in frames:
        own = {f.name.lower(): f for f in df.schema.fields}
        aligned.append(df.select(*[
            (as_type(F.col(f"`{own[k].name}`"), own[k].dataType, types[k]) if k in own else F.lit(None).cast(types[k]))
            .alias(name) for k, name in names.items()]))
    return reduce(DataFrame.unionByName, aligned)
