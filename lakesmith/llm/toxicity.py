"""Toxicity score: boosted trees over dense text features (operator 6).

Training happens on a bounded sample of labelled rows (``TRAIN_ROWS``, taken by
a hash order, so it is the same every time); scoring covers every document.
Labelled rows whose ``crc32(doc_id) mod 5`` is 0 are held out.  The others form
four folds by the same remainder.  The lexicon (a short fixed list plus words
and word beginnings that mark toxic texts) is learned on all four; a training
row's own features use a lexicon learned without its fold, so the trees do not
see densities that were fitted to the row itself.  Folds 1 to 3 fit the trees,
fold 4 the isotonic calibration.

Features of a text: lexicon densities, the densest stretch, hits near second
person pronouns, capitals, punctuation and obfuscation.  Label, language,
source and id are never features.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import checkpointed, col, kept_columns, staged, text_of

#: Bound of the labelled rows used for fitting.
TRAIN_ROWS = 20_000
#: Bound of the lexicon, and how often an entry must occur in toxic texts (texts, share).
LEXICON_ENTRIES, LEXICON_TEXTS, LEXICON_SHARE, LEXICON_ODDS = 400, 4, 0.01, 8.0
FOLDS = 5
#: Counts that a task holds before it passes them on.
COUNTED_AT_ONCE = 50_000
WINDOW, NEAR = 20, 5
ADDED = ["score", "predicted"]

# Second-person pronouns of the four languages of the corpus.
SECOND_PERSON = frozenset("""you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine
ihr euch euer sie usted ustedes ti tú vosotros vuestro""".split())
# Characters that stand for letters in disguised words.
LEET = str.maketrans("013457@$!|", "oieastasii")

# Common insults, known before any label is read.
SEED_WORDS = """idiot moron stupid dumb loser pathetic scum worthless clown trash disgusting fool imbecile jerk
garbage filth vermin trottel dummkopf abschaum connard crétin imbécile salaud idiota estúpido imbécil basura""".split()
SEED_WEIGHT = 2.0

_WORD = re.compile(r"[^\W_]+(?:[@$!|*'][^\W_]+)*")
_SPACED = re.compile(r"\b(?:[^\W\d_][ .\-*_]){3,}[^\W\d_]\b")
_REPEAT = re.compile(r"([^\W\d_])\1{2,}")
_PUNCT = re.compile(r"[^\w\s]")
FEATURES = ["density", "weight", "densest", "near_you", "second_person", "capitals", "capital_words",
            "exclaims", "punctuation", "disguised", "disguised_hits", "spaced", "repeats", "log_words"]


def units(word: str) -> tuple[str, ...]:
    """What the lexicon may know of a word: itself and its beginnings of four and five letters."""
    return (word, word[:4] + "*", word[:5] + "*") if len(word) > 5 else (word, word[:4] + "*")


def text_features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """The ``FEATURES`` of one whole text; zeros for a null or empty one."""
    text = text or ""
    words = _WORD.findall(text.lower())
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    get = lexicon.get
    hits, weight, disguised, disguised_hits, you = [], 0.0, 0, 0, []
    for i, w in enumerate(words):
        if w in SECOND_PERSON:
            you.append(i)
        if not w.isalpha():
            if any(ch.isalpha() for ch in w):
                disguised += 1
                w = w.translate(LEET).replace("*", "").replace("'", "")
                if get(w) or get(w[:4] + "*") or get(w[:5] + "*"):
                    disguised_hits += 1
            else:
                continue
        v = get(w) or get(w[:5] + "*") or get(w[:4] + "*")
        if v:
            hits.append(i)
            weight += v
    densest, low = 0, 0
    for high, i in enumerate(hits):
        while i - hits[low] >= WINDOW:
            low += 1
        densest = max(densest, high - low + 1)
    near, j = 0, 0
    for i in hits:
        while j < len(you) and you[j] < i - NEAR:
            j += 1
        near += j < len(you) and you[j] <= i + NEAR
    chars = len(text)
    return [len(hits) / n, weight / n, densest / WINDOW, near / n, len(you) / n,
            sum(map(str.isupper, text)) / chars, sum(1 for w in text.split() if len(w) > 2 and w.isupper()) / n,
            (text.count("!") + text.count("?")) / n, len(_PUNCT.findall(text)) / chars,
            disguised / n, disguised_hits / n, len(_SPACED.findall(text)) / n,
            len(_REPEAT.findall(text)) / n, math.log1p(n)]


def features(text: Column, lexicon: dict[str, float]) -> Column:
    @F.arrow_udf("array<double>")
    def compute(texts: pa.Array) -> pa.Array:  # one text at a time becomes a Python string
        return pa.array([text_features(t.as_py(), lexicon) for t in texts], pa.list_(pa.float64()))
    return compute(text)


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """All rows and columns of ``docs`` plus ``score`` (0 to 1) and
        ``predicted`` (1 from 0.5).  Null texts count as empty; input columns
        so named are replaced; an empty table gives an empty result."""
        keep = kept_columns(docs, ADDED)
        rows = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(keep)])
        text = F.col(f"c{keep.index(text_col)}")  # the text passes through once
        if self.trees is None:
            scored = rows.withColumn("__score", F.lit(self.constant))
        else:
            scored = _raw_scores(self.trees, rows.withColumn("__f", features(text, self.lexicon)))
            if self.calibration is not None:
                # the steps of the isotonic fit are ties; a trace of the raw score orders inside them
                scored = self.calibration.transform(scored).withColumn(
                    "__score", F.col("__score") + 1e-4 * (F.col("__raw") - F.col("__score")))
            else:
                scored = scored.withColumn("__score", F.col("__raw"))
        score = F.least(F.greatest(F.col("__score").cast("double"), F.lit(0.0)), F.lit(1.0))
        return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], score.alias("score"),
                             (score >= 0.5).cast("int").alias("predicted"))


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.pmod(F.crc32(col(id_col).cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, seed: int = 17) -> ToxicityModel:
    """Fit on at most ``train_rows`` labelled documents outside the held-out fold.

    Labels repeated for an id count as toxic if any is; null labels and null
    ids are no training rows; of equal training texts one is used.  Without
    training rows every score is 0; with one class, or no row left for the
    trees, it is the share of toxic rows.
    """
    chosen = (labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
              .agg((F.max("toxic") > 0).cast("double").alias("label")).withColumn("fold", fold())
              .where("fold <> 0").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(train_rows))
    # at most train_rows narrow rows: a proven bound, so documents are not shuffled for it
    rows = (docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
            .select("label", "fold", "text"))
    train = staged(rows, "toxicity-train").dropDuplicates(["text"]).repartition(8)
    shares = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    share = shares.get(1.0, 0) / max(1, sum(shares.values()))
    lexicons = learn_lexicons(train)
    parts = [train.where(F.col("fold") == k).select("label", "fold", features(F.col("text"), lexicons[k]).alias("__f"))
             for k in range(1, FOLDS)]
    rows = reduce(DataFrame.unionByName, parts)
    rows = checkpointed(rows.select("label", "fold", array_to_vector("__f").alias("__v")))
    lexicon = lexicons[0]
    if rows.where("fold < 4").select("label").distinct().count() < 2:
        return ToxicityModel(lexicon, None, None, share)
    trees = GBTClassifier(featuresCol="__v", labelCol="label", maxIter=15, maxDepth=3, stepSize=0.3,
                          minInstancesPerNode=5, maxBins=32, seed=seed).fit(rows.where("fold < 4").coalesce(2))
    calibrating = _raw_scores(trees, rows.where("fold = 4")).select("label", "__raw")
    calibration = None
    if calibrating.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(featuresCol="__raw", labelCol="label", predictionCol="__score").fit(
            calibrating.coalesce(2))
    return ToxicityModel(lexicon, trees, calibration, share)


def _raw_scores(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    if "__v" not in rows.columns:
        rows = rows.withColumn("__v", array_to_vector("__f"))
    return trees.transform(rows).withColumn("__raw", vector_to_array("probability")[1])


def learn_lexicons(train: DataFrame) -> list[dict[str, float]]:
    """Lexicons of (label, fold, text) rows: 0 from all folds, k from all but fold k.

    An entry occurs far more often in toxic training texts; its value is the
    log odds.  Texts count once per unit.  At most ``LEXICON_ENTRIES`` each,
    besides the fixed words that the rows don't contradict.
    """
    folds = range(1, FOLDS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            labels, fold_nos = batch.column("label").to_pylist(), batch.column("fold").to_pylist()
            for label, fold_no, text in zip(labels, fold_nos, batch.column("text")):
                for u in {u for w in set(_WORD.findall(text.as_py().lower())) if w.isalpha() for u in units(w)}:
                    seen[u, int(label), int(fold_no)] += 1
                if len(seen) > COUNTED_AT_ONCE:
                    yield packed(seen)
                    seen.clear()
        yield packed(seen)

    def packed(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in seen], kind) for i, kind in enumerate((pa.string(), pa.int32(), pa.int32()))]
            + [pa.array(list(seen.values()), pa.int64())], ["unit", "toxic", "fold", "n"])

    sizes = {(int(r["label"]), r["fold"]): r["count"] for r in train.groupBy("label", "fold").count().collect()}
    cells = [F.sum(F.when((F.col("toxic") == t) & (F.col("fold") == k), F.col("n")).otherwise(0)).alias(f"n{t}{k}")
             for t in (0, 1) for k in folds]
    counted = checkpointed(train.select("label", "fold", "text").mapInArrow(
        count, "unit string, toxic int, fold int, n long").groupBy("unit").agg(*cells))
    seed_rows = counted.where(F.col("unit").isin(SEED_WORDS)).collect()
    out = []
    for left_out in range(FOLDS):
        used = [k for k in folds if k != left_out]
        toxic = sum(sizes.get((1, k), 0) for k in used)
        texts = reduce(lambda a, b: a + b, [F.col(f"n1{k}") for k in used])
        odds = _odds(used, sizes)
        strong = counted.where((texts >= max(LEXICON_TEXTS, LEXICON_SHARE * toxic)) & (odds >= math.log(LEXICON_ODDS)))
        best = strong.orderBy((odds * F.sqrt(texts)).desc(), "unit").limit(LEXICON_ENTRIES).select("unit", odds.alias("odds")).collect()
        seeds = dict.fromkeys(SEED_WORDS, SEED_WEIGHT)
        for r in seed_rows:
            a, b = (sum(r[f"n{t}{k}"] for k in used) for t in (1, 0))
            clean = sum(sizes.get((0, k), 0) for k in used)
            if math.log((a + 0.5) / (toxic + 1)) < math.log((b + 0.5) / (clean + 1)):
                seeds.pop(r["unit"], None)
        out.append(seeds | {r["unit"]: r["odds"] for r in best})
    return out


def _odds(used: list[int], sizes: dict[tuple[int, int], int]) -> Column:
    a, b = (reduce(lambda x, y: x + y, [F.col(f"n{t}{k}") for k in used]) for t in (1, 0))
    toxic, clean = (sum(sizes.get((t, k), 0) for k in used) for t in (1, 0))
    return F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (clean + 1))
