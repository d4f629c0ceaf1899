"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise sum is
1/2 * sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so a text is scored in time
linear in its distinct words, whatever the number of pairs.

Features are made by Spark's functions on the executors' JVMs: hashed word counts
scaled to length one, shares of characters, words and lines, and the logarithm of
n_chars. Spark ML's FMClassifier fits the weights on at most about ``TRAIN_ROWS``
labelled rows, taken by a hash of id and text (below that number: on all). The
model has a fixed size (``WORDS`` + statistics, ``FACTORS`` factors).

Defined results: null and empty texts are scored by their statistics, all zero. A
missing n_chars counts as 0. Rows of one doc_id with several labels teach each of
them. If the training rows have one class only, every score is its label; without
training rows it is 0.5. Very long texts are used whole. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import ElementwiseProduct, HashingTF, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.common import id_crc, materialize, shielded, small_batches

WORDS, FACTORS = 1 << 11, 4
# Bound of the training sample (rows), and steps of the solver.
TRAIN_ROWS, STEPS, STEP_SIZE = 10_000, 60, 0.1
THRESHOLD = 0.3
# Statistics and the factors that bring their usual spread to about one; what is left out by each pattern is counted.
_SHARES = {"upper": r"[^\p{Lu}]+", "digit": r"[^0-9]+", "symbol": r"[\p{L}\p{N}\s]+", "line": r"[^\n]+"}
_SCALE = {"upper": 5.0, "digit": 10.0, "symbol": 10.0, "line": 20.0, "word_length": 2.0, "distinct_words": 3.0, "repeated": 5.0,
          "distinct_lines": 2.0, "long_text": 0.1, "meta_chars": 0.1}
STATS = list(_SCALE)
# Columns that with_features makes on its way; callers may have columns of these names.
WORKING = ["features", "_text", "_meta", "_words", "_lines", "_n", "_counts", "_unit", "_scaled", *[f"_{s}" for s in STATS]]
# Weight of the word vector beside the statistics.
WORD_SCALE = 0.1


def with_features(docs: DataFrame) -> DataFrame:
    """Adds ``features``: hashed words, then the statistics, scaled to a spread of about 1."""
    text = F.coalesce("text", F.lit(""))
    n_chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    rows = docs.withColumns({"_text": text, "_meta": F.coalesce(n_chars, F.lit(0.0))})
    rows = rows.withColumns({"_words": F.array_remove(F.split(F.lower("_text"), r"[^\p{L}\p{N}]+"), ""), "_lines": F.split("_text", "\n"),
                             "_n": F.greatest(F.length("_text"), F.lit(1))})
    stats = {s: F.length(F.regexp_replace("_text", p, "")) / F.col("_n") for s, p in _SHARES.items()}
    n_words = F.greatest(F.size("_words"), F.lit(1))
    empty = F.length("_text") == 0
    again = F.zip_with("_words", F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))), lambda a, b: (a == b).cast("int"))
    stats |= {"word_length": F.least(F.col("_n") / n_words / 20, F.lit(1.0)),
              "repeated": F.aggregate(again, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0))) / n_words, "distinct_words": F.size(F.array_distinct("_words")) / n_words,
              "distinct_lines": F.size(F.array_distinct("_lines")) / F.size("_lines"), "long_text": F.log1p(F.length("_text")),
              "meta_chars": F.log1p(F.greatest("_meta", F.lit(0.0)))}
    rows = rows.withColumns({f"_{s}": F.when(empty & F.lit(s != "meta_chars"), 0.0).otherwise(c * _SCALE[s]).cast("double") for s, c in stats.items()})
    rows = HashingTF(numFeatures=WORDS, inputCol="_words", outputCol="_counts").transform(rows)
    rows = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit").transform(rows)
    rows = ElementwiseProduct(scalingVec=Vectors.dense([WORD_SCALE] * WORDS), inputCol="_unit", outputCol="_scaled").transform(rows)
    rows = VectorAssembler(inputCols=["_scaled", *[f"_{s}" for s in STATS]], outputCol="features").transform(rows)
    return rows.select(*docs.columns, "features")


class Model:
    """Weights of a fitted machine, or a constant score."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray, constant: float | None = None) -> None:
        self.bias, self.linear, self.factors, self.constant = bias, linear, factors, constant

    def raw(self, index: list[np.ndarray], value: list[np.ndarray]) -> np.ndarray:
        """w0 + linear part + pairwise part by the sum of squares, of rows in sparse form."""
        n = np.array([len(i) for i in index], np.int64)
        out = np.full(len(n), self.bias)
        some = np.flatnonzero(n)
        if len(some):
            i, x = np.concatenate(index), np.concatenate(value)
            at = np.cumsum(n[some]) - n[some]
            vx = self.factors[i] * x[:, None]
            total = np.add.reduceat(vx, at, axis=0)
            squares = np.add.reduceat(vx * vx, at, axis=0)
            out[some] += np.add.reduceat(self.linear[i] * x, at) + 0.5 * (total * total - squares).sum(axis=1)
        return out


def draw(rows: DataFrame, share: float) -> DataFrame:
    """About ``share`` of the rows, by a hash of id and text in 63 bits, so that small shares aren't rounded."""
    if share >= 1:
        return rows
    row = F.xxhash64(F.lit(7), *[c for c in ("doc_id", "text") if c in rows.columns])  # copies of a text have ids of their own
    return rows.where(F.shiftrightunsigned(row, 1) < F.lit(int(share * (1 << 63))))


def train(labelled: DataFrame, max_rows: int = TRAIN_ROWS) -> Model:
    """Fits on rows with text, n_chars and a 0/1 ``label``."""
    rows = labelled.where("label IN (0, 1)")
    n = rows.count()
    share = min(1.0, max_rows / max(n, 1))
    sample = materialize(with_features(draw(rows, share).select("text", "n_chars", F.col("label").cast("double").alias("label"))).select("features", "label"), "fm-train")
    classes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(classes) < 2:
        return Model(0.0, np.zeros(0), np.zeros((0, 0)), next(iter(classes), 0.5))
    data = sample.coalesce(sample.sparkSession.sparkContext.defaultParallelism).persist()
    fm = FMClassifier(factorSize=FACTORS, maxIter=STEPS, stepSize=STEP_SIZE, regParam=1e-4, seed=11, tol=1e-6).fit(data)
    data.unpersist()
    return Model(float(fm.intercept), fm.linear.toArray(), fm.factors.toArray())


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``score`` between 0 and 1."""
    if model.constant is not None:
        return docs.withColumn("score", F.lit(float(model.constant)))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for part in batches:
            raw = []
            for at in range(0, len(part), 512):
                value = [np.asarray(v, np.float64) for v in part["values"].iloc[at:at + 512]]
                index = [np.arange(len(v)) if i is None else np.asarray(i, np.int64)
                         for i, v in zip(part["indices"].iloc[at:at + 512], value, strict=True)]
                raw.append(model.raw(index, value))
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.concatenate(raw), -700, 700))) if raw else np.zeros(0))

    parts = F.unwrap_udt("features")
    rows, back = shielded(small_batches(docs), WORKING)
    return (with_features(rows).withColumn("score", score(F.struct(parts["indices"].alias("indices"), parts["values"].alias("values"))))
            .drop("features").withColumnsRenamed(back))


def held_out() -> Column:
    return F.pmod(id_crc(), F.lit(5)) == 0


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    marks = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label"))
    labelled = docs.where(~held_out()).join(marks, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "n_chars", "label")
    model = train(labelled)
    scored = with_score(docs.select("doc_id", "text", "n_chars"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
