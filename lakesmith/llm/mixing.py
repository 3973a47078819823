"""Mixing sources to target weights (operator 2), DataFrame operations only.

Documents fall into cells (source, language, topic) that hold token counts.
Iterative proportional fitting rakes the cells' weights: each round scales
them to the source targets, then the language targets, then the topic targets.
The fitted weight of a cell over its tokens is the rate at which its documents
enter the mix; dividing by the largest rate calibrates it to a probability, so
the sample meets all three marginals in expectation without repeating a
document.  A document is drawn where a hash of its id and text is below that
probability: the same rows are drawn whatever the partitioning, and a lost
task draws the same ones again.

Documents are aggregated to cells map-side, so a hot source costs nothing; the
marginal sums are combinable too.  Cells are written per round, which keeps
the plan short; the final join reads them from files, so Spark broadcasts them
only if their size is under its threshold and joins them by shuffle beyond.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import col, kept_columns, staged, text_of

ROUNDS = 10
#: Default targets are the corpus' own token shares to this power: small groups gain.
TEMPER = 0.9
SEED = 11
MARGINS = ("source", "lang", "topic")
#: Category of a null source, language or topic.
NONE = "(none)"
ADDED = ["topic", "n_tokens", "probability", "sampled"]


def topic_of(text: Column) -> Column:
    """Topic by surface signs: license text, assignments, addresses, else prose."""
    return (F.when(text.contains("icense"), "legal").when(text.contains("="), "technical")
            .when(text.contains("@"), "contact").otherwise("prose"))


def token_count(text: Column) -> Column:
    """Runs of other characters than blank, tab and line breaks."""
    return F.regexp_count(text, F.lit("[^ \t\n\r]+")).cast("long")


def _targets(cells: DataFrame, margin: str, shares: Mapping[str, float] | None) -> DataFrame:
    """(value, share) of one margin; shares add up to 1 over the values that occur."""
    sums = cells.groupBy(F.col(margin).alias("v")).agg(F.sum("tokens").alias("n"))
    if shares is None:
        raw = sums.select("v", F.pow("n", F.lit(TEMPER)).alias("s"))
    else:
        given = F.create_map(*[F.lit(x) for kv in shares.items() for x in (kv[0], float(kv[1]))]) if shares else None
        raw = sums.select("v", (F.coalesce(given[F.col("v")], F.lit(0.0)) if given is not None else F.lit(0.0)).alias("s"))
    whole = raw.agg(F.sum("s")).scalar()
    return raw.select(F.col("v").alias(margin), F.when(whole > 0, F.col("s") / whole).otherwise(0.0).alias(f"t_{margin}"))


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, lang, topic, tokens > 0) plus ``weight``: token shares
    fitted to the targets.  ``targets`` maps a margin to {value: share}; a
    margin without targets takes the tempered shares of the corpus.  Values
    that don't occur are left out and the rest scaled up; a value without a
    target gets weight 0."""
    for margin in MARGINS:
        cells = cells.join(_targets(cells, margin, (targets or {}).get(margin)), margin)
    cells = staged(cells.withColumn("weight", F.col("tokens").cast("double")), "mixing-cells")
    for _ in range(rounds):
        for margin in MARGINS:
            sums = cells.groupBy(F.col(margin).alias("v")).agg(F.sum("weight").alias("w"))
            cells = cells.join(sums, F.col(margin) == F.col("v")).withColumn(
                "weight", F.when(F.col("w") > 0, F.col("weight") * F.col(f"t_{margin}") / F.col("w")).otherwise(0.0)
            ).drop("v", "w")
        cells = staged(cells, "mixing-cells")
    return cells


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, rounds: int = ROUNDS,
        seed: int = SEED) -> DataFrame:
    """All rows and columns of ``docs`` plus ``topic``, ``n_tokens``,
    ``probability`` and ``sampled``.

    Null sources and languages are a category of their own; a null or empty
    text counts as one token.  A string column ``topic`` in the input is used
    as it is, other input columns named like the added ones are replaced.
    Repeated rows are drawn alike; an empty table gives an empty result.
    """
    own = next((c for c, kind in docs.dtypes if c.lower() == "topic" and kind == "string"), None)
    keep = kept_columns(docs, ADDED)
    text = text_of()
    rows = docs.select(
        *[col(c).alias(f"c{i}") for i, c in enumerate(keep)],
        *[F.coalesce(col(c).cast("string"), F.lit(NONE)).alias(c) for c in ("source", "lang")],
        F.coalesce(col(own) if own else topic_of(text), F.lit(NONE)).alias("topic"),
        token_count(text).alias("n_tokens"), _uniform(seed).alias("u"))
    cells = rows.groupBy(*MARGINS).agg(F.sum(F.greatest("n_tokens", F.lit(1))).alias("tokens"))
    fitted = rake(staged(cells, "mixing-counts"), targets, rounds).withColumn("rate", F.col("weight") / F.col("tokens"))
    most = fitted.agg(F.max("rate")).scalar()
    chances = staged(fitted.select(*MARGINS, F.when(most > 0, F.col("rate") / most).otherwise(0.0).alias("probability")),
                     "mixing-chances")
    return rows.join(chances, list(MARGINS)).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "topic", "n_tokens", "probability",
        (F.col("u") < F.col("probability")).alias("sampled"))


def _uniform(seed: int) -> Column:
    """52 hash bits of seed, id and text as a number in [0, 1)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                            F.md5(text_of().cast("binary"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / 2.0 ** 52


def sample_to_targets(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None,
                      rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """The drawn documents; same columns as ``docs``."""
    used = ["doc_id", "text", "source", "lang", *[c for c in docs.columns if c.lower() == "topic"]]
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("__row"), *[col(c) for c in used])
    return mix(rows, targets, rounds, seed).where("sampled").select("__row.*")
