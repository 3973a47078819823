"""Date standardisation.

The first of ten formats that parses at least one row is chosen for the
whole column; rows in other formats become null.  If none parses, a
generic cast is used.  The choice is one minimum, computed in the same
aggregate as every other statistic of the stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesmith.functions.casts import kind_of

# The ten accepted date formats, in trial order, as
# (strptime spelling, Spark pattern).  Single-letter month/day/hour fields
# accept both padded and unpadded numbers, as strptime does.
DATE_FORMATS = [
    ("%Y-%m-%d", "yyyy-M-d"),
    ("%d/%m/%Y", "d/M/yyyy"),
    ("%m/%d/%Y", "M/d/yyyy"),
    ("%Y%m%d", "yyyyMMdd"),
    ("%d-%b-%Y", "d-MMM-yyyy"),
    ("%d-%B-%Y", "d-MMMM-yyyy"),
    ("%Y-%m-%dT%H:%M:%S", "yyyy-M-d'T'H:m:s"),
    ("%Y-%m-%d %H:%M:%S", "yyyy-M-d H:m:s"),
    ("%m-%d-%Y", "M-d-yyyy"),
    ("%d.%m.%Y", "d.M.yyyy"),
]

# The text shape of each format.  A value of another shape cannot parse,
# so it is rejected by a cheap pattern test instead of a failed parse
# (failed parses are an order of magnitude slower than successful ones).
_D2, _Y4 = r"\d{1,2}", r"\d{4}"
DATE_SHAPES = [
    rf"^{_Y4}-{_D2}-{_D2}$",
    rf"^{_D2}/{_D2}/{_Y4}$",
    rf"^{_D2}/{_D2}/{_Y4}$",
    r"^\d{8}$",
    rf"^{_D2}-\p{{L}}{{3}}-{_Y4}$",
    rf"^{_D2}-\p{{L}}+-{_Y4}$",
    rf"^{_Y4}-{_D2}-{_D2}T{_D2}:{_D2}:{_D2}$",
    rf"^{_Y4}-{_D2}-{_D2} {_D2}:{_D2}:{_D2}$",
    rf"^{_D2}-{_D2}-{_Y4}$",
    rf"^{_D2}\.{_D2}\.{_Y4}$",
]


def parse_with(s: Column, i: int) -> Column:
    """Parse text ``s`` with format ``i`` to a wall-clock timestamp (no time
    zone, like the parsed values of a plain date reader); null when it does not fit."""
    parsed = F.try_to_timestamp(s, F.lit(DATE_FORMATS[i][1])).cast("timestamp_ntz")
    return F.when(s.rlike(DATE_SHAPES[i]), parsed)


def needs_format_choice(dt: T.DataType) -> bool:
    return kind_of(dt) != "datetime"


def first_format_agg(c: Column, name: str) -> Column:
    """The first format that parses any row: the least, over the rows, of the
    first format that parses the row (tests stop at the first hit)."""
    s = c.cast("string")
    fits = F.when(F.lit(False), -1)
    for i in range(len(DATE_FORMATS)):
        fits = fits.when(parse_with(s, i).isNotNull(), i)
    return F.min(fits).alias(name)


def parse_dates(c: Column, dt: T.DataType, fmt_index: int | None) -> Column:
    """Apply the chosen format; an existing timestamp column is unchanged."""
    if kind_of(dt) == "datetime":
        return c.cast("timestamp_ntz") if isinstance(dt, T.DateType) else c
    s = c.cast("string")
    if fmt_index is None:
        return s.try_cast("timestamp_ntz")
    return parse_with(s, fmt_index)


def parsed_type(dt: T.DataType) -> T.DataType:
    """Type of ``parse_dates`` output for an input of type ``dt``."""
    if kind_of(dt) == "datetime" and not isinstance(dt, T.DateType):
        return dt
    return T.TimestampNTZType()
