"""Model metrics as single aggregates.

The reference runs four or six separate SQL counts, pulls the base rate to
the driver and feeds it back as a literal, and scores log loss with Python
UDFs. Here each report is one aggregate over the scored table, with
built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.functions.scalar import LOG_EPSILON, log_loss_clipped, log_loss_eps
from clicklens.operators.ordered import BUCKET, order_keys, range_buckets, with_previous


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """A16 + A17 in one pass: TP, TN, FP, FN, positives, negatives, and
    precision / recall in percent (null when the denominator is 0).

    A row without a prediction is in none of the four counts; ``positives`` and
    ``negatives`` count all rows with that label.
    """
    y = F.col(label).cast("int")
    p = F.col(prediction).cast("int")
    agg = scored.agg(
        F.count_if((y == 1) & (p == 1)).cast("bigint").alias("tp"),
        F.count_if((y == 0) & (p == 0)).cast("bigint").alias("tn"),
        F.count_if((y == 0) & (p == 1)).cast("bigint").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("bigint").alias("fn"),
        F.count_if(y == 1).cast("bigint").alias("positives"),
        F.count_if(y == 0).cast("bigint").alias("negatives"))
    return agg.select(
        "*",
        F.round(F.try_divide(F.col("tp") * 100.0, F.col("tp") + F.col("fp")), 6).alias("precision_pct"),
        F.round(F.try_divide(F.col("tp") * 100.0, F.col("tp") + F.col("fn")), 6).alias("recall_pct"))


def baseline_log_loss(train: DataFrame, label: str = "label", eps: float = LOG_EPSILON) -> DataFrame:
    """M5: log loss of predicting the base rate for every row.

    Mean of X1 with a constant p equals rate * -ln(p+eps) + (1-rate) *
    -ln(1-p+eps); computed in one aggregate instead of a driver round trip.
    Output: ``rows, base_rate, baseline_log_loss``.
    """
    y = F.col(label)
    agg = train.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                    F.avg(y.cast("double")).alias("p"),
                    F.avg((y > 0).cast("double")).alias("rate"))
    loss = (F.col("rate") * -F.log(F.col("p") + F.lit(eps))
            + (F.lit(1.0) - F.col("rate")) * -F.log(F.lit(1.0) - F.col("p") + F.lit(eps)))
    return agg.select("rows", F.round("p", 6).alias("base_rate"), F.round(loss, 6).alias("baseline_log_loss"))


def mean_log_loss(scored: DataFrame, label: str = "label", prob: str = "prob") -> DataFrame:
    """M6: per-row clipped loss (X2) averaged. Output: ``rows, log_loss``."""
    return scored.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                      F.round(F.avg(log_loss_clipped(label, prob)), 6).alias("log_loss"))


def residuals(scored: DataFrame, label: str = "label", score: str = "prob") -> DataFrame:
    """Label minus score per row (appends ``residual``)."""
    return scored.withColumn("residual", F.col(label).cast("double") - F.col(score).cast("double"))


def durbin_watson(scored: DataFrame, order_col: str | list[str], label: str = "label", score: str = "prob",
                  n_buckets: int | None = None) -> DataFrame:
    """sum((e_t - e_{t-1})^2) / sum(e_t^2), e = label - score, rows in
    ``order_col`` order (an explicit key; Spark output has no row order).

    Output: ``rows, dw``.
    """
    e = F.col(label).cast("double") - F.col(score).cast("double")
    prev = with_previous(scored.select(*order_keys(order_col), e.alias("__e")), "__e", order_col, "__e_prev",
                         n_buckets=n_buckets)
    diff2 = F.pow(F.col("__e") - F.col("__e_prev"), 2)
    return prev.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                    F.round(F.sum(diff2) / F.sum(F.col("__e") * F.col("__e")), 6).alias("dw"))


def auroc(scored: DataFrame, label: str = "label", score: str = "prob",
          n_buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve, exact and tie-aware (Mann-Whitney).

    AUC = sum over positives of (negatives scored lower + half the negatives
    tied) / (P * N). Rows are first reduced to one row per distinct score;
    the running count of negatives is then taken per score range, with the
    range totals carried over a table of one row per range. No window runs
    over the whole table in one task.
    Output: ``positives, negatives, auroc``.
    """
    y = F.col(label).cast("int")
    s = F.col(score).cast("double")
    rows = scored.select(s.alias("s"), y.alias("y")).filter(F.col("y").isin(0, 1) & F.col("s").isNotNull())
    per = rows.groupBy("s").agg(F.count_if(F.col("y") == 1).alias("pos"),
                                F.count_if(F.col("y") == 0).alias("neg"))
    per = range_buckets(per, "s", n_buckets, bounds_from=rows)
    within = F.coalesce(F.sum("neg").over(
        Window.partitionBy(BUCKET).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.withColumn("__below_in", within)
    totals = per.groupBy(BUCKET).agg(F.sum("neg").alias("__bneg"))
    carry = totals.select(BUCKET, F.coalesce(F.sum("__bneg").over(
        Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__below_b"))
    per = per.join(F.broadcast(carry), BUCKET)
    below = F.col("__below_b") + F.col("__below_in")
    agg = per.agg(F.sum("pos").cast("bigint").alias("positives"),
                  F.sum("neg").cast("bigint").alias("negatives"),
                  F.sum(F.col("pos") * (below + F.col("neg") * 0.5)).alias("__num"))
    return agg.select("positives", "negatives",
                      F.round(F.try_divide(F.col("__num"), F.col("positives") * F.col("negatives")), 6)
                      .alias("auroc"))


def scored_summary(scored: DataFrame, label: str = "label", prob: str = "prob",
                   prediction: str = "prediction") -> DataFrame:
    """M6 + X1 + A16 + A17 fused: every per-row metric of a scored table in
    one aggregate (one scan instead of one job per number).

    Output (one row): ``rows, log_loss_eps, log_loss, tp, tn, fp, fn,
    positives, negatives, precision_pct, recall_pct``.
    """
    y = F.col(label).cast("int")
    p = F.col(prediction).cast("int")
    agg = scored.agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.avg(log_loss_eps(label, prob)).alias("log_loss_eps"),
        F.avg(log_loss_clipped(label, prob)).alias("log_loss"),
        F.count_if((y == 1) & (p == 1)).cast("bigint").alias("tp"),
        F.count_if((y == 0) & (p == 0)).cast("bigint").alias("tn"),
        F.count_if((y == 0) & (p == 1)).cast("bigint").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("bigint").alias("fn"),
        F.count_if(y == 1).cast("bigint").alias("positives"),
        F.count_if(y == 0).cast("bigint").alias("negatives"))
    return agg.select(
        "*",
        F.try_divide(F.col("tp") * 100.0, F.col("tp") + F.col("fp")).alias("precision_pct"),
        F.try_divide(F.col("tp") * 100.0, F.col("tp") + F.col("fn")).alias("recall_pct"))
