"""Quality score: kernel ridge by random Fourier features (operator 12).

A document is described by ``STATISTICS`` of its whole text.  Cosines of random
projections of the standardised statistics approximate a Gaussian kernel
(Rahimi and Recht), so kernel ridge regression becomes a linear one: each task
sums the normal equations of its rows, the sums are added on Spark, and the
driver solves one system whose size is the number of features.  Isotonic
regression on rows that the ridge has not seen turns its output into a
probability.

Fitting uses a bounded sample of labelled rows (``TRAIN_ROWS``, by hash order);
scoring covers every document.  Rows with crc32(doc_id) mod 5 = 0 are held out;
remainders 1 to 3 fit the ridge, 4 the calibration.  Label, language, source
and id are never features.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesmith.llm.common import col, kept_columns, staged, text_of

#: Bound of the labelled rows used for fitting.
TRAIN_ROWS = 20_000
#: Random features, kernel width in standard deviations a statistic, ridge penalty a row.
COSINES, WIDTH, PENALTY = 256, 1.0, 1e-4
#: Standardised statistics beyond this count as this.
FARTHEST = 4.0
FOLDS, GOOD = 5, 0.3
ADDED = ["score", "predicted"]

STATISTICS = ["log_words", "word_length", "word_spread", "short_words", "long_words", "different_words", "commonest_word",
              "different_pairs", "doubled_words", "capital_words", "title_words", "bare_marks", "marked_ends", "letters", "capitals",
              "digits", "stops", "cries", "symbols", "blanks", "other_bytes", "line_words", "repeated_lines", "packed",
              "sentence_words"]

# Bytes of each kind.
_UPPER, _LOWER, _DIGITS = range(65, 91), range(97, 123), range(48, 58)
_STOPS, _CRIES, _BLANKS = b".,;:", b"!?", b" \t\n\r"
_SYMBOLS = b"#$%&*+/<=>@\\^_`{|}~[]()"
#: Row k adds up the bytes of kind k.
_KINDS = np.zeros((8, 256))
for _k, _bytes in enumerate(([*_UPPER, *_LOWER], _UPPER, _DIGITS, _STOPS, _CRIES, _SYMBOLS, _BLANKS, range(128, 256))):
    _KINDS[_k, list(_bytes)] = 1.0


def text_statistics(text: str | None) -> list[float]:
    """The ``STATISTICS`` of one whole text; zeros for a null or blank one."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    data = text.encode("utf-8", "replace")
    kinds = _KINDS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data)
    sizes = np.fromiter(map(len, words), np.int64, n)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x]
    ends = sum(not w[-1].isalnum() for w in words)
    bare = sum(not any(map(str.isalnum, w)) for w, k in seen.items() for _ in range(k) if len(w) < 4)
    stops = sum(w[-1] in ".!?" for w in words)
    return [math.log1p(n), float(sizes.mean()), float(sizes.std()), float((sizes <= 3).mean()), float((sizes > 12).mean()),
            len(seen) / n, max(seen.values()) / n, len(set(zip(words, words[1:]))) / n, sum(map(eq, words, words[1:])) / n,
            sum(k for w, k in seen.items() if len(w) > 1 and w.isupper()) / n,
            sum(k for w, k in seen.items() if w.istitle()) / n, bare / n, ends / n, *kinds.tolist(),
            math.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)),
            len(zlib.compress(data, 1)) / len(data), math.log1p(n / (1 + stops))]


@dataclass(frozen=True)
class Kernel:
    """Standardisation and random projections; fixed by the seed and the moments."""
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @staticmethod
    def draw(mean: np.ndarray, scale: np.ndarray, cosines: int, width: float, seed: int) -> Kernel:
        rng = np.random.default_rng(seed)
        spread = width * math.sqrt(len(mean))
        return Kernel(mean, scale, rng.normal(0.0, 1.0 / spread, (len(mean), cosines)), rng.uniform(0, 2 * math.pi, cosines))

    def features(self, statistics: np.ndarray) -> np.ndarray:
        """A constant and the cosines, one row per row."""
        x = np.clip((statistics - self.mean) / self.scale, -FARTHEST, FARTHEST)
        z = np.cos(x @ self.directions + self.phases) * math.sqrt(2.0 / len(self.phases))
        return np.c_[np.ones(len(z)), z]


@dataclass(frozen=True)
class QualityModel:
    """``kernel`` is None where the training rows held one class or none."""
    kernel: Kernel | None
    weights: np.ndarray | None
    steps: tuple[np.ndarray, np.ndarray] | None
    constant: float

    def raw(self, statistics: np.ndarray) -> np.ndarray:
        # rounded, so that the rows of a batch cannot show in the last digits of a score
        return np.round(np.clip(self.kernel.features(statistics) @ self.weights, 0.0, 1.0), 10)

    def probability(self, statistics: np.ndarray) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(statistics), self.constant)
        raw = self.raw(statistics)
        if self.steps is None:
            return raw
        fitted = np.interp(raw, *self.steps)
        # the steps of the isotonic fit are ties; a trace of the ridge output orders inside them
        return np.clip(fitted + 1e-4 * (raw - fitted), 0.0, 1.0)

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """All rows and columns of ``docs`` plus ``score`` (0 to 1) and
        ``predicted`` (1 from 0.3).  Null texts count as empty; input columns
        so named are replaced; an empty table gives an empty result."""
        keep = kept_columns(docs, ADDED)
        model = self

        @F.arrow_udf("double")
        def judge(texts: pa.Array) -> pa.Array:
            return pa.array(model.probability(_statistics(texts)), pa.float64())

        score = F.lit(self.constant) if self.kernel is None else judge(col(text_col).cast("string"))
        return docs.select(*[col(c) for c in keep], score.alias("score")).withColumn(
            "predicted", (F.col("score") >= GOOD).cast("int"))


def _statistics(texts: pa.Array) -> np.ndarray:
    # one text at a time becomes a Python string
    return np.array([text_statistics(t.as_py()) for t in texts], np.float64).reshape(-1, len(STATISTICS))


def statistics(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def compute(texts: pa.Array) -> pa.Array:
        return pa.array(list(_statistics(texts)), pa.list_(pa.float64()))
    return compute(text)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.pmod(F.crc32(col(id_col).cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def normal_equations(rows: DataFrame, kernel: Kernel) -> tuple[np.ndarray, np.ndarray, int]:
    """Z'Z, Z'y and the row count of (s: statistics, label) rows: each task adds
    up its own rows, Spark adds up the tasks.  The sums have (cosines + 1)^2 cells."""
    size = len(kernel.phases) + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            z = kernel.features(np.array(batch.column("s").to_pylist(), np.float64).reshape(batch.num_rows, -1))
            z = np.c_[z, batch.column("label").to_numpy()]
            total += z.T @ z
        i, j = np.triu_indices(size + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i * (size + 1) + j), pa.array(total[i, j])], ["cell", "v"])

    cells = rows.select("s", "label").mapInArrow(add, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    total = np.zeros((size + 1) ** 2)
    total[cells.column("cell").to_numpy()] = cells.column("v").to_numpy()
    total = total.reshape(size + 1, size + 1)
    total = total + np.triu(total, 1).T  # one triangle came
    return total[:size, :size], total[:size, size], int(round(total[0, 0]))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, cosines: int = COSINES, width: float = WIDTH,
        penalty: float = PENALTY, seed: int = 23) -> QualityModel:
    """Fit on at most ``train_rows`` labelled documents outside the held-out fold.

    Labels repeated for an id count as good if all are; null labels and null ids
    are no training rows; of equal training texts one is used.  Without training
    rows every score is 1; with one class, or no row left for the ridge, it is
    the share of good rows; without both classes in fold 4 the ridge output
    itself is the score.
    """
    chosen = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
              .agg((F.min("quality") > 0).cast("double").alias("label")).withColumn("fold", fold())
              .where("fold <> 0").orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(train_rows))
    # at most train_rows narrow rows: a proven bound, so documents are not shuffled for it
    found = (docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
             .select("label", "fold", F.xxhash64("text").alias("h"), statistics(F.col("text")).alias("s")))
    train = staged(found.dropDuplicates(["h"]).drop("h"), "quality-train")
    shares = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    share = shares.get(1.0, 0) / sum(shares.values()) if shares else 1.0
    fitting, calibrating = train.where("fold < 4"), train.where("fold = 4")
    if fitting.select("label").distinct().count() < 2:
        return QualityModel(None, None, None, share)
    moments = [(r["m"], r["d"]) for r in fitting.select(F.posexplode("s").alias("i", "x")).groupBy("i").agg(
        F.avg("x").alias("m"), F.stddev_pop("x").alias("d")).orderBy("i").collect()]
    mean, deviation = (np.array(x) for x in zip(*moments))
    kernel = Kernel.draw(mean, np.where(deviation > 1e-9, deviation, 1.0), cosines, width, seed)
    gram, right, n = normal_equations(fitting, kernel)
    ridge = np.diag(np.r_[0.0, np.full(cosines, penalty * n)])
    model = QualityModel(kernel, np.linalg.solve(gram + ridge, right), None, share)
    if calibrating.select("label").distinct().count() < 2:
        return model

    @F.arrow_udf("double")
    def raw(s: pa.Array) -> pa.Array:
        return pa.array(model.raw(np.array(s.to_pylist(), np.float64).reshape(len(s), -1)), pa.float64())

    curve = IsotonicRegression(featuresCol="raw", labelCol="label").fit(calibrating.select("label", raw("s").alias("raw")).coalesce(2))
    steps = (curve.boundaries.toArray(), curve.predictions.toArray())
    return QualityModel(kernel, model.weights, steps, share)
