"""Scalar column expressions (X1-X9) and the SQL-registered loss (K2).

All are built-in Spark expressions, so they stay inside whole-stage code
generation; the reference's Python UDFs for the same values are not needed.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results:
# epsilon added inside the log of the LR loss, and the clip bound of the
# RF loss (p limited to [1e-15, 1 - 1e-15]).
LOG_EPSILON = 1e-16
CLIP_EPSILON = 1e-15


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sigmoid(x) -> Column:
    """1 / (1 + exp(-x)); overflow of exp gives 0, not an error."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def log_loss_eps(label, prob, eps: float = LOG_EPSILON) -> Column:
    """-ln(p + eps) when label > 0, else -ln(1 - p + eps)."""
    p = _c(prob)
    return (F.when(_c(label) > 0, -F.log(p + F.lit(eps)))
            .otherwise(-F.log(F.lit(1.0) - p + F.lit(eps))))


def clip(prob, eps: float = CLIP_EPSILON) -> Column:
    return F.least(F.greatest(_c(prob), F.lit(eps)), F.lit(1.0 - eps))


def log_loss_clipped(label, prob, eps: float = CLIP_EPSILON) -> Column:
    """Clipped log loss of P(class 1); label == 1 selects -ln(p)."""
    p = clip(prob, eps)
    return F.when(_c(label) == 1, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p))


def vector_element(vec, i: int) -> Column:
    """Element i of an ML vector, null when out of range. A sparse vector isn't made dense."""
    v = F.unwrap_udt(_c(vec))
    at = F.array_position(v["indices"], int(i))
    sparse = F.when(F.lit(int(i)) < v["size"], F.when(at > 0, F.get(v["values"], (at - 1).cast("int"))).otherwise(0.0)) if i >= 0 else F.lit(None).cast("double")
    return F.when(v["type"] == 0, sparse).otherwise(F.get(v["values"], int(i)))


def odds(weight) -> Column:
    """Log-odds to odds."""
    return F.exp(_c(weight))


def binarize(label) -> Column:
    """1 when label > 0, otherwise 0 (null included)."""
    return F.when(_c(label) > 0, F.lit(1)).otherwise(F.lit(0))


def register_sql_functions(spark: SparkSession) -> None:
    """K2: ``log_loss(label, p)`` and ``sigmoid(x)`` as SQL functions, without
    a Python worker."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION log_loss(label DOUBLE, p DOUBLE) RETURNS DOUBLE "
        f"RETURN CASE WHEN label = 1 THEN -ln(least(greatest(p, {CLIP_EPSILON}), 1 - {CLIP_EPSILON})) "
        f"ELSE -ln(1 - least(greatest(p, {CLIP_EPSILON}), 1 - {CLIP_EPSILON})) END")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION sigmoid(x DOUBLE) RETURNS DOUBLE "
        "RETURN 1.0 / (1.0 + exp(-x))")
