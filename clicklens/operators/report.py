"""Coefficient and model reports.

Inputs are coefficient tables: one row per model feature. With absolute
thresholds the features grow with the impressions, so ranks and positions come
from a distributed sort, not from a window over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.functions.scalar import odds
from clicklens.operators.ordered import global_cumsum, global_position
from clicklens.schema import STASH_PREFIX, VECTOR_SUFFIX
from clicklens.sources.io import written

# Fixed values that must equal the reference's for equal results: the
# window of the weight-against-odds view (weights in [-1, 1], odds in
# [0.4, 3]) and the "large weight" bound of 1.
LINEARITY_WEIGHTS = (-1.0, 1.0)
LINEARITY_ODDS = (0.4, 3.0)
LARGE_WEIGHT = 1.0


def with_average_rank(coef: DataFrame, weight: str = "coeff", rank_col: str = "rank") -> DataFrame:
    """Rank with the largest weight first; tied rows share the mean of
    their positions (pandas ``rank(ascending=False)``). One row per distinct
    weight is sorted; the rows before it are a running sum of the ties. The
    table is written first, as ranks and rows both read it."""
    coef = written(coef, "coefficients")
    ties = coef.groupBy(F.col(weight).alias("__w")).agg(F.count(F.lit(1)).alias("__ties"))
    before, _ = global_cumsum(ties, "__ties", F.desc("__w"))
    ranks = before.select("__w", (F.col("__before") + 1 + (F.col("__ties") - 1) / F.lit(2.0)).alias(rank_col))
    return coef.join(ranks, F.col(weight).eqNullSafe(F.col("__w"))).drop("__w")


def coefficient_report(coef: DataFrame, feature: str = "feature", weight: str = "coeff") -> DataFrame:
    """M9: odds (X5) and average rank of each coefficient.

    Output: ``feature, coeff, odds, rank``.
    """
    ranked = with_average_rank(coef.select(F.col(feature).alias("feature"), F.col(weight).alias("coeff")))
    return ranked.select("feature", "coeff", odds(F.col("coeff")).alias("odds"), "rank")


def top_bottom(coef: DataFrame, k: int = 10, feature: str = "feature", weight: str = "coeff") -> DataFrame:
    """The k largest and k smallest weights (ties by feature name).

    Output: ``direction, position, feature, coeff``.
    """
    w_top = Window.orderBy(F.desc(weight), F.asc(feature))
    w_bot = Window.orderBy(F.asc(weight), F.asc(feature))
    top = (coef.withColumn("position", F.row_number().over(w_top)).filter(F.col("position") <= k)
           .withColumn("direction", F.lit("largest")))
    bot = (coef.withColumn("position", F.row_number().over(w_bot)).filter(F.col("position") <= k)
           .withColumn("direction", F.lit("smallest")))
    return top.unionByName(bot).select("direction", F.col("position").cast("int"),
                                       F.col(feature).alias("feature"), F.col(weight).alias("coeff"))


def stash_feature_names(string_cols: Sequence[str], sentinels: dict) -> list[str]:
    """Exact names of stash features: ``<col>v_stash_<col>`` for strings and
    ``<col>v_<sentinel>`` for numerics (D9: no substring match)."""
    names = [f"{c}{VECTOR_SUFFIX}_{STASH_PREFIX}{c}" for c in string_cols]
    names += [f"{c}{VECTOR_SUFFIX}_{s}" for c, s in sentinels.items()]
    return names


def stash_report(coef: DataFrame, stash_names: Sequence[str], feature: str = "feature",
                 weight: str = "coeff") -> DataFrame:
    """M10 (+ P12, U3): weights and odds of the stash features, with a flag
    for weights above 1. The name list is short, so it is an ``isin``.

    Output: ``feature, coeff, odds, large``.
    """
    st = coef.filter(F.col(feature).isin(list(stash_names)))
    return st.select(F.col(feature).alias("feature"), F.col(weight).alias("coeff"),
                     odds(F.col(weight)).alias("odds"), (F.col(weight) > LARGE_WEIGHT).alias("large"))


def coef_share(coef: DataFrame, weight: str = "coeff") -> DataFrame:
    """Count and share of weights above 1. Output: ``features, large, share``."""
    return coef.agg(F.count(F.lit(1)).cast("bigint").alias("features"),
                    F.count_if(F.col(weight) > LARGE_WEIGHT).cast("bigint").alias("large"),
                    F.avg((F.col(weight) > LARGE_WEIGHT).cast("double")).alias("share"))


def linearity_view(coef: DataFrame, weight: str = "coeff", weight_step: float = 0.1,
                   odds_step: float = 0.2) -> DataFrame:
    """The data behind the weight-against-odds plot: weights in [-1, 1]
    and odds in [0.4, 3], counted on a grid.

    Output: ``weight_bin, odds_bin, features``.
    """
    o = odds(F.col(weight))
    lo_w, hi_w = LINEARITY_WEIGHTS
    lo_o, hi_o = LINEARITY_ODDS
    inside = coef.filter(F.col(weight).between(lo_w, hi_w) & o.between(lo_o, hi_o))
    return inside.groupBy(
        F.floor(F.col(weight) / F.lit(weight_step)).cast("int").alias("weight_bin"),
        F.floor(o / F.lit(odds_step)).cast("int").alias("odds_bin"),
    ).agg(F.count(F.lit(1)).cast("bigint").alias("features"))


def sorted_curve(coef: DataFrame, stash_names: Sequence[str], feature: str = "feature",
                 weight: str = "coeff") -> DataFrame:
    """Weights sorted ascending against position, stash points marked.

    Output: ``position, feature, coeff, odds, is_stash``.
    """
    placed, _ = global_position(coef, F.asc(weight), F.asc(feature))
    return placed.select((F.col("__pos") + 1).cast("int").alias("position"), F.col(feature).alias("feature"),
                       F.col(weight).alias("coeff"), odds(F.col(weight)).alias("odds"),
                       F.col(feature).isin(list(stash_names)).alias("is_stash"))


def model_comparison(metrics: DataFrame) -> DataFrame:
    """One row per model from the long metric table of the jobs
    (``model, split, metric, value``): width, baseline loss, test loss,
    final train loss (LR), AUROC and the lift of the test loss over the baseline.

    Output: ``model, width, baseline_log_loss, train_loss, test_log_loss, auroc, lift``.
    The pivot runs over a handful of metric rows per model.
    """
    pick = (F.when(F.col("metric").isin("width", "baseline_log_loss", "final_objective"), F.col("value"))
            .when(F.col("split") == "test", F.col("value")))
    wide = metrics.groupBy("model").pivot("metric", ["width", "baseline_log_loss", "final_objective", "log_loss", "auroc"]) \
        .agg(F.max(pick))
    return wide.select(
        "model", F.col("width").cast("bigint").alias("width"), "baseline_log_loss",
        F.col("final_objective").alias("train_loss"), F.col("log_loss").alias("test_log_loss"), "auroc",
        F.round((F.col("baseline_log_loss") - F.col("log_loss")) / F.col("baseline_log_loss"), 6).alias("lift"))
