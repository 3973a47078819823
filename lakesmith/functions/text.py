"""Text standardisation (V13-V15) and whitespace handling shared with search."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a plain ``str.split()`` / ``str.strip()``
# treat as whitespace (ASCII controls, file/group/record/unit separators,
# NEL and every Unicode space separator).
WS_CLASS = r"[\t\n\x0b\x0c\r\x1c-\x1f\x85\p{Z}]"
# Fixed value: the same characters listed one by one (Zs, Zl, Zp spelled out).
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c: Column) -> Column:
    """Trim all whitespace at both ends (``F.trim`` only removes spaces).

    ``btrim`` with the character set looks at the ends only, where a regex
    would scan the whole text for a trailing run.
    """
    return F.btrim(c, F.lit(WS_CHARS))


def split_ws(c: Column) -> Column:
    """Whitespace tokens; empty edge tokens are dropped."""
    return F.filter(F.split(c, f"{WS_CLASS}+"), lambda t: t != F.lit(""))


def title_case(c: Column) -> Column:
    """Capital after any non-letter: ``o'neil-smith 3rd`` -> ``O'Neil-Smith 3Rd``."""
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.when(c.isNotNull(), F.array_join(F.transform(parts, F.initcap), ""))


def lower(c: Column) -> Column:
    return F.lower(c)


def upper(c: Column) -> Column:
    return F.upper(c)
