"""The rule-text vocabulary.

Rule logic is free text matched by keyword.  Plain substring tests fire on
words such as "updated", "context" or "account", so every keyword here
needs a leading word boundary (and a closed set of endings).  Precedence
inside each group is first match wins, in the order listed.  Every text
the rule generators emit must still be recognised (tested).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

_F = re.IGNORECASE

# Keyword patterns per rule effect.
TEXT_FORMAT = re.compile(r"\btext format\b", _F)
CONVERT = re.compile(r"\bconvert\w*\b", _F)
TEXT = re.compile(r"\btext\b", _F)
INTEGER = re.compile(r"\bintegers?\b|\bwhole numbers?\b", _F)
INTEGER_SILVER = re.compile(r"\bintegers?\b", _F)
WIDE = re.compile(r"\bwide (integers?|whole numbers?)\b", _F)
FLOAT = re.compile(r"\b(float|decimal|numeric)\b", _F)
DATE = re.compile(r"\bdates?\b|\bdatetime\b", _F)
DEDUP = re.compile(r"\bdeduplic\w*", _F)
DROP_NULL = re.compile(r"\b(drop|remove) nulls?\b", _F)
FILL_NULL = re.compile(r"\bfill nulls?\b", _F)
MEAN = re.compile(r"\bmean\b", _F)
MEDIAN = re.compile(r"\bmedian\b", _F)
MODE = re.compile(r"\bmode\b", _F)
DEFAULT = re.compile(r"\bdefault\b", _F)
LOWER = re.compile(r"\blowercase\b", _F)
UPPER = re.compile(r"\buppercase\b", _F)
TITLE = re.compile(r"\btitle case\b", _F)
STRIP = re.compile(r"\b(strip|trim)\b", _F)
GROUP_BY = re.compile(r"\bgroup by\b", _F)
SUM = re.compile(r"\bsum(s|med)?\b", _F)
AVG = re.compile(r"\b(average|avg|mean)\b", _F)
COUNT = re.compile(r"\bcounts?\b", _F)
MAX = re.compile(r"\bmax(imum)?\b", _F)
MIN = re.compile(r"\bmin(imum)?\b", _F)

LOAD_TIME_TARGETS = {"_load_timestamp", "load_timestamp"}
SOURCE_FILE_TARGETS = {"_source_file", "source_file"}


def bronze_cast(logic: str) -> str | None:
    """'text' | 'wide' | 'integer' | 'float' | 'date' | None (first match)."""
    if TEXT_FORMAT.search(logic) or (CONVERT.search(logic) and TEXT.search(logic)):
        return "text"
    if WIDE.search(logic):
        return "wide"
    if INTEGER.search(logic):
        return "integer"
    if FLOAT.search(logic):
        return "float"
    if DATE.search(logic):
        return "date"
    return None


@dataclass
class SilverOps:
    """What one Silver rule asks for, in execution order."""
    dedup: bool = False
    nulls: str | None = None      # drop | mean | median | mode | blank
    cast: str | None = None       # date | wide | integer | float | text
    case: str | None = None       # lower | upper | title
    strip: bool = False
    recognised: bool = field(default=False)


def silver_ops(logic: str) -> SilverOps:
    ops = SilverOps()
    if DEDUP.search(logic):
        ops.dedup = True
        ops.recognised = True
        return ops
    fill = FILL_NULL.search(logic)
    if DROP_NULL.search(logic):
        ops.nulls = "drop"
    elif fill and MEAN.search(logic):
        ops.nulls = "mean"
    elif fill and MEDIAN.search(logic):
        ops.nulls = "median"
    elif fill and MODE.search(logic):
        ops.nulls = "mode"
    elif fill or DEFAULT.search(logic):
        ops.nulls = "blank"
    if DATE.search(logic):
        ops.cast = "date"
    elif WIDE.search(logic):
        ops.cast = "wide"
    elif INTEGER_SILVER.search(logic):
        ops.cast = "integer"
    elif FLOAT.search(logic):
        ops.cast = "float"
    elif TEXT.search(logic):
        ops.cast = "text"
    if LOWER.search(logic):
        ops.case = "lower"
    elif UPPER.search(logic):
        ops.case = "upper"
    elif TITLE.search(logic):
        ops.case = "title"
    ops.strip = bool(STRIP.search(logic))
    ops.recognised = bool(ops.nulls or ops.cast or ops.case or ops.strip)
    return ops


def gold_agg(logic: str) -> str | None:
    """'sum' | 'avg' | 'count' | 'max' | 'min' | None (first match)."""
    if SUM.search(logic):
        return "sum"
    if AVG.search(logic):
        return "avg"
    if COUNT.search(logic):
        return "count"
    if MAX.search(logic):
        return "max"
    if MIN.search(logic):
        return "min"
    return None


def rule_status(layer: str, target: str, logic: str) -> str:
    """'recognised' or 'unrecognised' (unrecognised text is a no-op, Q14)."""
    if layer == "bronze":
        if target.lower() in LOAD_TIME_TARGETS | SOURCE_FILE_TARGETS:
            return "recognised"
        return "recognised" if bronze_cast(logic) else "unrecognised"
    if layer == "silver":
        if target.startswith("pk_"):
            return "recognised"
        return "recognised" if silver_ops(logic).recognised else "unrecognised"
    if target == "pk_gold_id" or GROUP_BY.search(logic) or gold_agg(logic):
        return "recognised"
    return "recognised" if re.search(r"\bpassthrough\b|\bdirect\b", logic, _F) else "unrecognised"
