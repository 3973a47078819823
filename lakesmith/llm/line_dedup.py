"""Line deduplication (operator 8), DataFrame operations only.

A document is a sequence of line ids.  The suffixes of all sequences are
ranked by prefix doubling: the rank of a line comes from the order of the line
digests, and the rank of the first k + j lines of a suffix from the pair (rank
of its first k lines, rank of the k lines that begin j further on).  Suffixes
with equal rank at depth k are an interval of the suffix order whose common
prefix has k lines or more: a repeated run.  Inside an interval the first suffix
by (document, line) is the original, the others are later copies.

A run counts if it has ``min_lines`` lines, ``min_words`` words or is a whole
document.  Longer runs are unions of their windows of ``min_lines`` lines, so
the intervals at depths 1 to ``min_lines`` find every maximal run: depth
``min_lines`` decides by length, the depths above it in the tree decide by words
or for whole documents.  Neighbouring deleted lines form the maximal runs.

Scale.  Only ranks that occur twice stay active; a window whose continuation
is inactive is unique and drops out, so the table shrinks every round.  Ranks
are numbered by a range shuffle of the distinct pairs with per-range offsets
(no single task).  Counts and firsts are combinable, hot lines meet only in
joins that adaptive execution may split, and texts are shuffled once, at the
end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesmith.llm.common import col, document_key, kept_columns, let, staged, text_of
from lakesmith.operators.keys import number_rows

#: Shortest repeated run: lines with content, or words.
MIN_LINES, MIN_WORDS = 3, 50
ADDED = ["n_lines", "n_removed", "runs", "kept_text"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _with_content(lines: Column) -> Column:
    """Numbers of the lines that are not blank."""
    return let(lines, lambda all_lines: F.filter(
        F.sequence(F.lit(0), F.size(all_lines) - 1), lambda i: F.trim(F.get(all_lines, i)) != ""))


def _ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """(id, th, line, rank): rank of the columns ``by`` in their order, for
    values that occur at least twice; the other rows are unique and leave."""
    repeated = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*by)
    ranks = number_rows(repeated, "rank", by)
    return staged(rows.join(ranks, by).select("id", "th", "line", "need", "rank"), "line-ranks")


def _followed(active: DataFrame, k: int) -> DataFrame:
    """Pairs (a, b) of the rank at a line and the rank ``k`` lines on."""
    ahead = Window.partitionBy("id", "th").orderBy("line").rangeBetween(k, k)
    return active.select("id", "th", "line", "need", F.col("rank").alias("a"), F.first("rank").over(ahead).alias("b")).where(
        "b is not null")


def _needed(lines: Column, at: Column, min_lines: int, min_words: int) -> Column:
    """The least number of lines with which a run that begins ``at`` counts."""
    need = F.lit(min_lines)
    for k in range(min_lines - 1, 0, -1):
        words = F.aggregate(F.slice(lines, at + 1, k), F.lit(0), lambda n, x: n + x["w"])
        need = F.when((words >= min_words) | ((at == 0) & (F.size(lines) == k)), k).otherwise(need)
    return need


def repeated_windows(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, text_col: str = "text",
                     id_col: str = "doc_id") -> dict[int, DataFrame]:
    """By depth (1 to ``min_lines`` lines): (id, th, line, need, rank) of every
    window of so many lines with content that occurs at least twice.  Equal
    ranks are equal windows, ranks follow the suffix order; ``line`` counts
    lines with content from 0; runs from there count from ``need`` lines on."""
    text = text_of(text_col)
    lines = F.filter(_lines(text), lambda x: F.trim(x) != "")
    digests = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"),
                                                    F.regexp_count(x, F.lit("[^ \t\r]+")).alias("w")))
    narrow = docs.select(*document_key(id_col, text_col), digests.alias("d")).where(F.size("d") > 0)
    # rows that repeat id and text are one document
    narrow = staged(narrow.groupBy("__id", "__th").agg(F.first("d").alias("d")), "line-digests")
    places = F.transform("d", lambda x, i: F.struct(x["h"].alias("h"), x["g"].alias("g"), i.alias("line"),
                                                    _needed(F.col("d"), i, min_lines, min_words).alias("need")))
    rows = narrow.select(F.col("__id").alias("id"), F.col("__th").alias("th"), F.inline(places))
    found = {1: _ranked(rows, ["h", "g"])}
    for depth in range(2, min_lines + 1):
        half = 1 << (depth - 1).bit_length() - 1  # the longest power of two below
        found[depth] = _ranked(_followed(found[half], depth - half), ["a", "b"])
    return found


def removed_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, text_col: str = "text",
                  id_col: str = "doc_id") -> DataFrame:
    """(id, th, removed): numbers of the lines with content that a later copy covers."""
    place = F.struct("id", "th", "line")
    covered = []
    for depth, active in repeated_windows(docs, min_lines, min_words, text_col, id_col).items():
        counts = F.col("need") <= depth
        # only intervals with a run that counts; the original need not be one itself (it may be no whole document)
        firsts = active.groupBy("rank").agg(F.min(place).alias("first"), F.bool_or(counts).alias("any")).where("any").drop("any")
        later = active.where(counts).join(firsts, "rank").where(place > F.col("first"))
        covered.append(later.select("id", "th", F.explode(F.sequence("line", F.col("line") + (depth - 1))).alias("line")))
    return reduce(DataFrame.unionByName, covered).groupBy("id", "th").agg(F.collect_set("line").alias("removed"))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, text_col: str = "text",
                id_col: str = "doc_id") -> DataFrame:
    """``docs`` plus ``n_lines``, ``n_removed``, ``runs`` (maximal removed runs)
    and ``kept_text``.

    A line with content is removed if it lies in a run of such lines that also
    starts earlier: in a document with a smaller (id, text digest), or further up
    in the same one (null ids come first).  The run must have ``min_lines``
    lines, ``min_words`` words, or be the whole later document.  Runs are
    judged on the input.  Blank lines are not part of the sequences and stay.
    A null text stays null with no lines removed; repeated rows of one document each get the same result; an
    empty table gives an empty result.  Input columns named like the added
    ones are replaced.
    """
    keep = kept_columns(docs, ADDED)
    gone = removed_lines(docs, min_lines, min_words, text_col, id_col)
    rows = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(keep)], *document_key(id_col, text_col),
                       col(text_col).cast("string").alias("text"))
    joined = rows.join(gone, F.col("__id").eqNullSafe(F.col("id")) & (F.col("__th") == F.col("th")), "left")
    lines = _lines(F.col("text"))
    # numbers among the lines with content become numbers among all lines
    gone_of = let(_with_content(lines), lambda full: F.transform("removed", lambda p: F.get(full, p)))
    marked = joined.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")).withColumn(
        "gone", F.when(F.col("removed").isNotNull(), gone_of))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    clean = let(lines, lambda all_lines: F.array_join(F.transform(kept, lambda i: F.get(all_lines, i)), "\n"))
    # a run starts at a removed line whose predecessor with content stays
    starts = F.aggregate(F.array_sort("removed"), F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n")),
                         lambda a, p: F.struct(p.alias("last"), (a["n"] + (p != a["last"] + 1).cast("int")).alias("n")),
                         lambda a: a["n"])
    return marked.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "n_lines",
        F.greatest(F.coalesce(F.size("gone"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(starts, F.lit(0)).cast("long").alias("runs"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(clean).alias("kept_text"))
