"""End-to-end jobs: the reference's three workflows as Spark plans.

* one-hot LR: stash + index + one-hot (fitted on train only), LR, metrics;
* hashed LR: feature hashing, LR, metrics;
* random forest: imputed numerics + one-hot, minority oversampling, RF,
  clipped loss of P(click), AUROC, importances.

A row is positive if its label is above zero, in training and test alike.
Splits are by md5 of the row key, so train and scoring jobs agree on the
split whatever the input partitioning. Every metric is one aggregate; the
metric table is a union of one-row aggregates, evaluated lazily.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.operators import features as fe
from clicklens.operators import metrics, models, split
from clicklens.sources.io import written

HASH_WIDTH = 1 << 18
# Split salt of the model jobs, so the split is independent of any other
# rule on md5(key) in the data (the signal fixture draws its noise that way).
SPLIT_SALT = "split:"


@dataclass
class JobResult:
    name: str
    metrics: DataFrame
    scored: DataFrame
    model: object = None
    encoded_train: DataFrame | None = None
    extras: dict = field(default_factory=dict)


def _long_metrics(name: str, split_name: str, one_row: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A one-row aggregate as ``model, split, metric, value`` rows."""
    typed = one_row.select(*[F.col(c).cast("double").alias(c) for c in cols])
    long = typed.unpivot([], list(cols), "metric", "value")
    return long.select(F.lit(name).alias("model"), F.lit(split_name).alias("split"), "metric", "value")


def _common_metrics(name: str, train: DataFrame, scored: DataFrame, label: str,
                    train_loss: float | None, width: int | None = None) -> DataFrame:
    """Baseline on train; every per-row test metric in one fused aggregate
    over the written scored rows; AUROC by its own rank-sum plan."""
    spark = scored.sparkSession
    base = metrics.baseline_log_loss(train, label)
    summary = metrics.scored_summary(scored, label, "prob", "prediction")
    auc = metrics.auroc(scored, label, "prob")
    out = (_long_metrics(name, "train", base, ["rows", "base_rate", "baseline_log_loss"])
           .unionByName(_long_metrics(name, "test", summary,
                                      ["rows", "log_loss_eps", "log_loss", "precision_pct", "recall_pct",
                                       "tp", "fp", "tn", "fn"]))
           .unionByName(_long_metrics(name, "test", auc, ["auroc"])))
    extra = []
    if train_loss is not None:
        extra.append((name, "train", "final_objective", float(train_loss)))
    if width is not None:
        extra.append((name, "train", "width", float(width)))
    if extra:
        out = out.unionByName(spark.createDataFrame(
            extra, "model string, split string, metric string, value double"))
    return out


def _written_scores(scored: DataFrame, key: str) -> DataFrame:
    """Keep only what the metrics read and write it: the fused summary and
    the AUROC plan then share one evaluation of the model over the test rows."""
    keep = [c for c in (key, "label", "prob", "prediction", "rawPrediction") if c in scored.columns]
    return written(scored.select(*keep), "scored")


@dataclass
class Fit:
    """A fitted model with its frames; nothing is scored yet. ``train`` and ``test`` hold ``label``."""

    name: str
    model: object
    train: DataFrame
    train_x: DataFrame
    test_x: DataFrame
    encoder: object = None


def evaluated(fit: Fit, key: str) -> JobResult:
    """Scores the test rows once, written, and lays the metrics over them."""
    scored = _written_scores(models.score(fit.model, fit.test_x), key)
    loss = fit.model.summary.objectiveHistory[-1] if isinstance(fit.model, models.LogisticRegressionModel) else None
    m = _common_metrics(fit.name, fit.train, scored, "label", loss, fit.model.numFeatures)
    return JobResult(fit.name, m, scored, fit.model, fit.train_x, {"encoder": fit.encoder})


def _labelled_parts(data: DataFrame, key: str, label: str, fractions) -> list[DataFrame]:
    parts = split.split_frames(data, key, fractions, SPLIT_SALT)
    return [p.withColumn("label", (F.col(label) > 0).cast("int")) for p in parts]


def onehot_fit(df: DataFrame, key: str, label: str, cols: Sequence[str], threshold,
               sentinels: Mapping[str, int] | None = None, *, fractions=(0.8, 0.2),
               max_iter: int = models.LR_MAX_ITER, reg_param: float = 0.0, share: float | None = None, **params) -> Fit:
    """Stash + one-hot encoding fitted on the training split, then LR."""
    train, test = _labelled_parts(df.filter(F.col(label).isNotNull()), key, label, fractions)
    enc = fe.StashEncoder(cols, threshold, sentinels, share=share).fit(train)
    train_x, test_x = enc.transform(train), enc.transform(test)
    model = models.train_lr(train_x, max_iter=max_iter, reg_param=reg_param, **params)
    return Fit("onehot_lr", model, train, train_x, test_x, enc)


def onehot_lr(df: DataFrame, key: str, label: str, cols: Sequence[str], threshold,
              sentinels: Mapping[str, int] | None = None, **params) -> JobResult:
    """:func:`onehot_fit`, then its metrics."""
    return evaluated(onehot_fit(df, key, label, cols, threshold, sentinels, **params), key)


def hashed_fit(df: DataFrame, key: str, label: str, cols: Sequence[str], categorical: Sequence[str], *,
               width: int = HASH_WIDTH, fractions=(0.8, 0.2), max_iter: int = models.LR_MAX_ITER,
               reg_param: float = 0.0) -> Fit:
    """Hashed features, then LR (null labels dropped first, D7)."""
    hashed = fe.hash_features(df.filter(F.col(label).isNotNull()), cols, width, categorical_cols=categorical)
    train, test = _labelled_parts(hashed, key, label, fractions)
    return Fit("hashed_lr", models.train_lr(train, max_iter=max_iter, reg_param=reg_param), train, train, test)


def hashed_lr(df: DataFrame, key: str, label: str, cols: Sequence[str],
              categorical: Sequence[str], **params) -> JobResult:
    """:func:`hashed_fit`, then its metrics."""
    return evaluated(hashed_fit(df, key, label, cols, categorical, **params), key)


def forest_frames(df: DataFrame, key: str, label: str, numeric: Sequence[str], categorical: Sequence[str],
                  threshold, fractions=(0.7, 0.3)) -> tuple[DataFrame, DataFrame, object]:
    """Training and test frames of a forest and their encoder: numerics imputed (NaN is refused
    by the learner), categoricals stashed and one-hot encoded."""
    data = df.filter(F.col(label).isNotNull()).withColumn(label, (F.col(label) > 0).cast("int"))
    data = fe.impute_numeric(data, numeric, sentinel=-1)
    flags = [c + "_missing" for c in numeric]
    train, test = split.split_frames(data, key, fractions, SPLIT_SALT)
    enc = fe.StashEncoder(categorical, threshold).fit(train)
    inputs = [F.col(c).cast("double").alias(c) for c in numeric] + [F.col(c).cast("double").alias(c) for c in flags]
    parts = [enc.transform(part.select(key, label, *categorical, *inputs), extra_inputs=list(numeric) + flags)
             .withColumn("label", F.col(label).cast("double")) for part in (train, test)]
    return parts[0], parts[1], enc


def random_forest(df: DataFrame, key: str, label: str, numeric: Sequence[str],
                  categorical: Sequence[str], threshold, *, fractions=(0.7, 0.3), times: int = 2,
                  **params) -> JobResult:
    """Encode, train and score a forest, the minority class copied ``times`` more times in the
    training split only. ``params`` go to :func:`models.train_rf`."""
    train_x, test_x, enc = forest_frames(df, key, label, numeric, categorical, threshold, fractions)
    model = models.train_rf(split.oversample(train_x, "label", 1.0, times), **params)
    return evaluated(Fit("random_forest", model, train_x, train_x, test_x, enc), key)
