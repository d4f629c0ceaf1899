"""Model training, scoring and model-derived tables (M1-M4, M7, M8, M11,
M13, S10).

Training is Spark ML's own distributed work (L-BFGS gradients by tree
aggregation; forests by level-wise histogram aggregation). Around it:
the training frame is persisted once (MEMORY_AND_DISK, so a lost executor
recomputes its blocks), scoring stays in JVM expressions, and the tables
pulled from a fitted model (coefficients, importances, loss history) are
bounded by the feature width, not by the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.classification import (LogisticRegression, LogisticRegressionModel,
                                       RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.operators.features import feature_catalog, vector_rows
from clicklens.session import ensure_checkpoint_dir
from clicklens.sources.io import table_from_rows

# Fixed values that must equal the reference's for equal results:
# LR with 10 iterations, no standardisation, elastic net 0, decision
# threshold 0.45; RF with 40 trees, depth 5, 32 bins.
LR_MAX_ITER = 10
LR_THRESHOLD = 0.45
RF_TREES = 40
RF_DEPTH = 5
RF_BINS = 32


# Bytes of a task's part of a forest's rows: Spark ML holds each row as one int a feature and one a tree.
TREE_BYTES = 64 << 20


def spread_for_trees(data: DataFrame, features_col: str, trees: int) -> DataFrame:
    """The training frame of a forest, in so many partitions that each task reads about ``TREE_BYTES``
    at a level, whatever the number of rows and features; a frame below that stays as it is."""
    one = data.select(features_col).first()
    if one is None or one[0] is None:
        return data
    size = data.count() * (len(one[0]) + trees) * 4
    return data if size <= TREE_BYTES else data.repartition(max(-(-size // TREE_BYTES), data.sparkSession.sparkContext.defaultParallelism))


def _training_frame(train: DataFrame, features_col: str, label_col: str, persist: bool):
    """Features + double label, persisted so the iterations do not recompute
    the encoding. (Repartitioning small inputs to all cores was measured
    slower at the test sizes: it plans the encoded frame twice and adds a
    shuffle; large inputs already have many partitions.)"""
    data = train.select(features_col, F.col(label_col).cast("double").alias(label_col))
    if persist:
        data = data.persist(StorageLevel.MEMORY_AND_DISK)
    return data, persist


def train_lr(train: DataFrame, features_col: str = "features", label_col: str = "label", *,
             max_iter: int = LR_MAX_ITER, reg_param: float = 0.0, elastic_net: float = 0.0,
             threshold: float = LR_THRESHOLD, standardization: bool = False, tol: float = 1e-6,
             aggregation_depth: int = 2, max_block_mb: float = 1.0,
             persist: bool = True) -> LogisticRegressionModel:
    """M1: logistic regression; ``reg_param`` is explicit (the reference's
    "ridge" ran with 0). Rows are stacked into blocks of ``max_block_mb``
    for the gradient pass."""
    lr = LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=max_iter,
                            regParam=reg_param, elasticNetParam=elastic_net, threshold=threshold,
                            standardization=standardization, tol=tol,
                            aggregationDepth=aggregation_depth, maxBlockSizeInMB=max_block_mb)
    data, keep = _training_frame(train, features_col, label_col, persist)
    try:
        return lr.fit(data)
    finally:
        if keep:
            data.unpersist()


def train_rf(train: DataFrame, features_col: str = "features", label_col: str = "label", *,
             num_trees: int = RF_TREES, max_depth: int = RF_DEPTH, max_bins: int = RF_BINS,
             seed: int = 1, checkpoint_interval: int = 10, bootstrap: bool = True,
             feature_subset: str = "auto") -> RandomForestClassificationModel:
    """M2: random forest. Node-id caching with checkpoints to the shared
    checkpoint folder keeps deep lineages short. One tree without ``bootstrap``
    over ``feature_subset="all"`` is the exact histogram split search."""
    ensure_checkpoint_dir(train.sparkSession)
    rf = RandomForestClassifier(featuresCol=features_col, labelCol=label_col, numTrees=num_trees,
                                maxDepth=max_depth, maxBins=max_bins, seed=seed, bootstrap=bootstrap,
                                featureSubsetStrategy=feature_subset,
                                cacheNodeIds=True, checkpointInterval=checkpoint_interval)
    data, _ = _training_frame(spread_for_trees(train, features_col, num_trees), features_col, label_col, True)
    try:
        return rf.fit(data)
    finally:
        data.unpersist()


def score(model, df: DataFrame, prob_col: str = "prob", positive_index: int = 1) -> DataFrame:
    """M3 + M4: add prediction, rawPrediction, probability, and P(class 1)
    as a plain double (D3: always the positive class)."""
    out = model.transform(df)
    return out.withColumn(prob_col, F.get(vector_to_array(F.col("probability")), int(positive_index)))


def training_curve(model: LogisticRegressionModel, spark: SparkSession, name: str = "lr") -> DataFrame:
    """M7: objective value per iteration (from the solver, not from logs).

    Output: ``model, iteration, loss``.
    """
    hist = list(model.summary.objectiveHistory)
    return table_from_rows(spark, [(name, i, float(v)) for i, v in enumerate(hist)],
                           "model string, iteration int, loss double")


def _named(values: DataFrame, catalog: DataFrame, name: str, value: str) -> DataFrame:
    own = F.coalesce(F.col("name"), F.concat(F.lit("f"), F.col("idx").cast("string")))
    return values.join(catalog, "idx", "left").select("idx", own.alias(name), value)


def coefficient_table(model: LogisticRegressionModel, encoded: DataFrame,
                      features_col: str = "features", catalog: DataFrame | None = None) -> DataFrame:
    """M8: (feature, coeff) with names from the vector metadata (F8), or from ``catalog``
    (``idx, name``, see ``StashEncoderModel.catalog``) for vectors without.

    Output: ``idx, feature, coeff``. Width-bounded on both sides.
    """
    values = vector_rows(encoded.sparkSession, model.coefficients, "coeff")
    return _named(values, catalog if catalog is not None else feature_catalog(encoded, features_col), "feature", "coeff")


def feature_importance(model: RandomForestClassificationModel, encoded: DataFrame,
                       features_col: str = "features", catalog: DataFrame | None = None) -> DataFrame:
    """Importance per feature, descending; names as in :func:`coefficient_table`.
    Output: ``idx, name, score``."""
    values = vector_rows(encoded.sparkSession, model.featureImportances, "score")
    return _named(values, catalog if catalog is not None else feature_catalog(encoded, features_col), "name", "score").orderBy(F.desc("score"), "idx")


def grid_search(train: DataFrame, features_col: str = "features", label_col: str = "label", *,
                reg_params: Sequence[float] = (0.0, 0.01), elastic_nets: Sequence[float] = (0.0, 1.0),
                max_iter: int = LR_MAX_ITER, train_ratio: float = 0.8, seed: int = 7):
    """L1 against L2 and regularisation strength, scored on a held-out
    part by area under ROC. Returns the fitted ``TrainValidationSplitModel``
    and a table ``reg_param, elastic_net, auroc``."""
    lr = LogisticRegression(featuresCol=features_col, labelCol=label_col, maxIter=max_iter,
                            standardization=False, threshold=LR_THRESHOLD)
    grid = (ParamGridBuilder().addGrid(lr.regParam, list(reg_params))
            .addGrid(lr.elasticNetParam, list(elastic_nets)).build())
    ev = BinaryClassificationEvaluator(labelCol=label_col, metricName="areaUnderROC")
    tvs = TrainValidationSplit(estimator=lr, estimatorParamMaps=grid, evaluator=ev,
                               trainRatio=train_ratio, seed=seed)
    data = train.select(features_col, F.col(label_col).cast("double").alias(label_col)) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = tvs.fit(data)
    finally:
        data.unpersist()
    rows = [(float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(m))
            for p, m in zip(grid, fitted.validationMetrics)]
    table = train.sparkSession.createDataFrame(
        rows, T.StructType([T.StructField("reg_param", T.DoubleType()),
                            T.StructField("elastic_net", T.DoubleType()),
                            T.StructField("auroc", T.DoubleType())]))
    return fitted, table


def fit_grid(train: DataFrame, test: DataFrame, candidates: Sequence[tuple[dict, object]],
             label_col: str = "label") -> DataFrame:
    """M13 for any learner: estimators (with their parameters as a dict) fitted on one shared
    training frame and scored on one test frame by area under ROC.

    Both frames are encoded and split by the caller, once, and kept while the grid runs.
    Output: the parameters, ``auroc``; one row a candidate.
    """
    ensure_checkpoint_dir(train.sparkSession)
    forests = [(est.getFeaturesCol(), est.getNumTrees()) for _, est in candidates if est.hasParam("numTrees")]
    if forests:
        features, trees = max(forests, key=lambda f: f[1])
        train = spread_for_trees(train, features, trees)
    frames = [f.withColumn(label_col, F.col(label_col).cast("double")).persist(StorageLevel.MEMORY_AND_DISK) for f in (train, test)]
    try:
        rows = [(*params.values(), evaluator_auroc(est.fit(frames[0]).transform(frames[1]), label_col)) for params, est in candidates]
    finally:
        for f in frames:
            f.unpersist()
    return train.sparkSession.createDataFrame(rows, [*candidates[0][0], "auroc"])


def evaluator_auroc(scored: DataFrame, label_col: str = "label", raw_col: str = "rawPrediction") -> float:
    """A19 through Spark ML (binned curve); the exact rank-sum form is
    ``metrics.auroc``."""
    ev = BinaryClassificationEvaluator(labelCol=label_col, rawPredictionCol=raw_col,
                                       metricName="areaUnderROC", numBins=0)
    return float(ev.evaluate(scored.withColumn(label_col, F.col(label_col).cast("double"))))
