"""Secret scan (operator 4), DataFrame expressions only.

Fixed patterns give the base spans: assignments, access keys, long hex runs.
The method adds spans by entropy: candidate strings (runs of key
characters with a digit or mixed case) are scanned with a sliding window whose character
counts are kept incrementally: one step adds the entering character, takes off
the leaving one and corrects the sum of c*log2(c) by the two changed terms.
Windows whose Shannon entropy reaches the threshold of the candidate's
character class are merged to spans.  An allow-list suppresses candidates that
are known not to be secrets (identifiers, dates, numbers, samples).

Everything is computed inside the row: no shuffle, no join, no Python.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import col, kept_columns, let, text_of

# Base patterns, in the order of their kinds.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64", "entropy_letters")

#: Entropy windows: length, and least bits a character by class.
WINDOW = 16
THRESHOLDS = {"entropy_hex": 2.75, "entropy_alnum": 3.5, "entropy_base64": 3.6, "entropy_letters": 3.6}
_KEY = "A-Za-z0-9+/_-"
#: At least a window of key characters, not in the middle of a run, with a digit or changing case twice.
CANDIDATE = rf"(?<![{_KEY}])(?=[A-Za-z+/_-]*+[0-9]|(?:[a-z+/_-]*+[A-Z]++[A-Z+/_-]*+[a-z]){{2}})[{_KEY}]{{{WINDOW},}}+={{0,2}}"
#: Window starts scanned in one go: a long candidate is cut into such blocks, so the work grows with its length only.
BLOCK = 1024
#: Counts in one number.
PACKED = 12
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="

_WORD, _SAMPLE = "(?:[A-Z]?[a-z]{1,14}|[A-Z]{1,15})", "(?:EXAMPLE|example|XXXX|xxxx|0123456789|abcdefghij)"
#: Candidates that are no secrets (whole candidate).  Groups never give back what they took (they could not
#: match otherwise anyway), so the engine neither recurses nor tries again on long runs.
ALLOWED = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUID
    r"[0-9/_+-]++=*",  # numbers, dates, phone numbers
    r"(?:[A-Za-z]++[/_+-]++)++[0-9]{1,6}",  # words with a number at the end
    rf"(?:[A-Za-z]*+[/_+-]++)*+[0-9]{{1,4}}(?:[/_+-]++(?:{_WORD}|[0-9]{{1,4}}))*+",  # dated paths and slugs
    rf"{_WORD}(?:[/_+-]++{_WORD})*+",  # paths and names of plain words
    rf"(?!(?:.*/)?(?![^/]*{_SAMPLE})[^/]{{{WINDOW}}}).*{_SAMPLE}.*",  # samples; no part without a mark holds a window
)
ADDED = ["spans"]
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def matches(text: Column, regex: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, value)."""
    # the text between the matches and the matches themselves give all offsets
    gaps, hits = F.split(text, regex, -1), F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    values = hits if group == 0 else F.regexp_extract_all(text, F.lit(regex), F.lit(group))
    parts = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
    zero = F.struct(F.lit(0).alias("at"), F.lit(None).cast("array<struct<start:int,end:int,value:string>>").alias("out"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        found = F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
        return F.struct(F.coalesce(end, start).alias("at"),
                        F.when(x["hit"].isNull(), acc["out"]).otherwise(
                            F.concat(F.coalesce(acc["out"], none), found)).alias("out"))

    return F.coalesce(F.aggregate(parts, zero, step, lambda acc: acc["out"]), none)


def _of_kind(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"),
                                                 m["end"].alias("end"), F.lit(kind).alias("kind")))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns; a text without a long enough match costs one test per pattern."""
    none = F.array().cast(_SPAN)
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.char_length(m["value"]) >= ASSIGN_MIN)
    # Runs are maximal, so asking for the length in the pattern finds the same matches.
    access, hexes = (matches(text, regex) for regex in (f"{ACCESS[:-1]}{{{ACCESS_MIN - 4},}}", f"{HEX[:-1]}{{{HEX_MIN},}}"))
    return F.concat(F.when(text.rlike(ASSIGN), _of_kind(assign, "assign")).otherwise(none),
                    F.when(text.contains("AKIA"), _of_kind(access, "access")).otherwise(none),
                    F.when(text.rlike(f"{HEX[:-1]}{{{HEX_MIN},}}"), _of_kind(hexes, "hex")).otherwise(none))


def _class_of(value: Column) -> Column:
    return (F.when(value.rlike("^[0-9a-fA-F]+$"), "entropy_hex").when(value.rlike("^[A-Za-z]+$"), "entropy_letters")
            .when(value.rlike("^[A-Za-z0-9]+$"), "entropy_alnum").otherwise("entropy_base64"))


def _hot_windows(value: Column, threshold: Column) -> Column:
    """Merged (start, end) of the windows of ``value`` whose entropy reaches ``threshold``."""
    firsts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.char_length(value) - WINDOW), F.lit(BLOCK))
    found = F.flatten(F.transform(firsts, lambda at: F.transform(
        _hot_in_block(F.substr(value, at + 1, F.lit(BLOCK + WINDOW - 1)), threshold),
        lambda w: F.struct((at + w["start"]).alias("start"), (at + w["end"]).alias("end")))))

    def joined(spans: Column) -> Column:  # blocks may end and begin inside one span; both ends ascend
        opens = F.filter(spans, lambda w, i: (i == 0) | (w["start"] > F.get(spans, i - 1)["end"]))
        closes = F.filter(spans, lambda w, i: (i == F.size(spans) - 1) | (F.get(spans, i + 1)["start"] > w["end"]))
        return F.zip_with(opens, closes, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))

    return let(found, joined)


def _word(code: Column) -> Column:
    return F.floor(code / PACKED).cast("int")


def _bit(code: Column) -> Column:
    return (code % PACKED * 5).cast("int")


def _hot_in_block(value: Column, threshold: Column) -> Column:
    logs = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    none = F.array().cast("array<struct<start:int,end:int>>")
    # the counts of twelve characters share a number, five bits each: a window's counts reach 16
    zero = F.struct(F.array_repeat(F.lit(0).cast("long"), len(ALPHABET) // PACKED + 1).alias("counts"), F.lit(0.0).alias("total"),
                    none.alias("spans"))

    def count(counts: Column, code: Column) -> Column:
        return F.call_function("shiftright", F.get(counts, _word(code)), _bit(code)).bitwiseAND(31).cast("int")

    def one(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), _bit(code))

    def step(codes: Column, acc: Column, i: Column) -> Column:
        enter, leave = codes[i], F.when(i >= WINDOW, codes[i - WINDOW]).otherwise(-1)
        gone = F.greatest(leave, F.lit(0))
        had = count(acc["counts"], enter)
        left = count(acc["counts"], gone) + (enter == leave).cast("int")
        total = (acc["total"] + F.get(logs, had + 1) - F.get(logs, had)
                 + F.when(i >= WINDOW, F.get(logs, left - 1) - F.get(logs, left)).otherwise(0.0))
        nothing = F.lit(0).cast("long")
        counts = F.transform(acc["counts"], lambda c, k: c + F.when(k == _word(enter), one(enter)).otherwise(nothing)
                             - F.when((leave >= 0) & (k == _word(gone)), one(gone)).otherwise(nothing))
        # entropy of the window = log2(W) - total / W
        hot = (i >= WINDOW - 1) & (math.log2(WINDOW) - total / WINDOW >= threshold - 1e-9)
        start, spans = i - (WINDOW - 1), acc["spans"]
        last = F.try_element_at(spans, F.lit(-1))
        own = F.array(F.struct(start.alias("start"), (i + 1).alias("end")))
        wider = F.array(F.struct(last["start"].alias("start"), (i + 1).alias("end")))
        joined = F.when((F.size(spans) > 0) & (last["end"] >= start),
                        F.concat(F.slice(spans, 1, F.size(spans) - 1), wider)).otherwise(F.concat(spans, own))
        return F.struct(counts.alias("counts"), total.alias("total"), F.when(hot, joined).otherwise(spans).alias("spans"))

    codes = F.transform(F.split(value, ""), lambda ch: F.instr(F.lit(ALPHABET), ch) - 1)
    return let(codes, lambda known: F.aggregate(F.sequence(F.lit(0), F.char_length(value) - 1), zero,
                                                lambda acc, i: step(known, acc, i), lambda acc: acc["spans"]))


def entropy_spans(text: Column, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """Spans of high entropy inside candidate strings that the allow-list passes."""
    permitted = "^(?:" + "|".join(allowed) + ")$" if allowed else r"^(?!)$"
    candidates = F.filter(matches(text, CANDIDATE), lambda m: ~m["value"].rlike(permitted))

    def scan(m: Column) -> Column:
        def of_kind(kind: Column) -> Column:
            level, rank = F.lit(9.0), F.lit(len(KINDS))
            for name, bits in THRESHOLDS.items():
                level, rank = F.when(kind == name, bits).otherwise(level), F.when(kind == name, KINDS.index(name)).otherwise(rank)
            return F.transform(_hot_windows(m["value"], level), lambda w: F.struct(
                (m["start"] + w["start"]).alias("start"), rank.alias("rank"), (m["start"] + w["end"]).alias("end"),
                kind.alias("kind")))
        return let(_class_of(m["value"]), of_kind)  # the class of a candidate is found once, not at every step

    return F.when(text.rlike(CANDIDATE), F.flatten(F.transform(candidates, scan))).otherwise(F.array().cast(_SPAN))


def find_secrets(docs: DataFrame, text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` plus ``spans``: an array of (start, rank, end, kind) by start, then kind.

    Base spans always stay; an entropy span inside a base span says nothing new
    and is left out.  Null and empty texts have no spans; repeated rows each
    get theirs; an empty table gives an empty result.  An input column named
    spans is replaced.
    """
    text = text_of(text_col)
    keep = kept_columns(docs, ADDED)
    rows = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(keep)], base_spans(text).alias("base"),
                       entropy_spans(text, allowed).alias("more"))
    new = F.filter("more", lambda e: ~F.exists("base", lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"])))
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)],
                       F.array_sort(F.concat("base", new)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[secret]", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (overlapping spans together); null texts stay null."""
    rows = find_secrets(docs.drop("spans"), text_col, allowed)
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col(f"`{text_col}`")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(
            acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("spans", zero, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return rows.withColumn(text_col, F.when(F.size("spans") > 0, clean).otherwise(text)).select(
        *[col(c) for c in docs.columns if c.lower() != "spans"])
