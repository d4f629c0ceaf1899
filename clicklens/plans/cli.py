"""Command line for the reference's batch scripts, one subcommand each.

    python -m clicklens.plans.cli convert   --input 'raw/part-*' --output imp.parquet
    python -m clicklens.plans.cli encode    --input imp.parquet --output ohe.parquet --threshold 10000
    python -m clicklens.plans.cli train-lr  --input ohe.parquet --coefficients coef.csv
    python -m clicklens.plans.cli train-lr-hashed --input imp.parquet
    python -m clicklens.plans.cli train-rf  --input ohe_rf.parquet --model rf --predictions pred.parquet
    python -m clicklens.plans.cli score-rf  --input ohe_rf.parquet --model rf --predictions pred2.parquet

The session comes from ``spark-submit`` (``SparkSession.builder.getOrCreate``);
nothing here sets cluster resources. Splits are by md5 of a key column, or
of a hash of the whole row when the log has no key, so ``train-rf`` and
``score-rf`` agree on the test rows. Metrics are printed as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklens.functions import scalar
from clicklens.operators import features as fe
from clicklens.operators import metrics, models, split
from clicklens.schema import CtrSchema, reference_tsv_schema
from clicklens.session import scratch_scope
from clicklens.sources import io

ROW_KEY = "__row_key"


def _roles(df: DataFrame, label: str, numeric: str | None, categorical: str | None, key: str | None = None) -> CtrSchema:
    cols = [c for c in df.columns if c not in (label, key) and not c.startswith("__")]
    num = numeric.split(",") if numeric else [c for c, t in df.dtypes if c in cols and t in ("int", "bigint")]
    cat = categorical.split(",") if categorical else [c for c, t in df.dtypes if c in cols and t == "string"]
    return CtrSchema(label=label, numeric=tuple(num), categorical=tuple(cat))


def _with_key(df: DataFrame, key: str | None) -> tuple[DataFrame, str]:
    """The given key, or a hash of the whole row (vectors included): equal
    rows share a split, and every job computes the same split."""
    if key:
        return df, key
    return df.withColumn(ROW_KEY, F.xxhash64(*[F.col(c) for c in df.columns])), ROW_KEY


def _emit(payload: dict) -> None:
    print(json.dumps(payload, default=float))


def _summary(scored: DataFrame, label: str) -> dict:
    row = metrics.scored_summary(scored, label, "prob", "prediction").first().asDict()
    row.update(metrics.auroc(scored, label, "prob").first().asDict())
    return row


def cmd_convert(spark: SparkSession, a) -> None:
    """Text to Parquet: headerless TSV under the impression-log schema, with
    the row-count and per-column check of the conversion."""
    schema = reference_tsv_schema()
    raw = io.read_tsv(spark, a.input, schema, strict=a.strict)
    io.write_parquet(raw, a.output, mode="overwrite")
    back = io.read_parquet(spark, a.output)
    check = io.round_trip_check(raw, back).filter(~F.col("equal")).count()
    _emit({"step": "convert", "rows": back.count(), "columns_with_differences": check})


def cmd_encode(spark: SparkSession, a) -> None:
    """Encoding step: stash rare values (numerics as categories with
    sentinels, or kept raw for trees) and write the assembled vectors. With a key, the
    encoder is fitted on the rows that the training step will train on (same key and
    fraction), so no test row counts; without one, on all rows."""
    df = io.read_parquet(spark, a.input)
    roles = _roles(df, a.label, a.numeric, a.categorical, a.key)
    if a.numeric_raw:
        cats = list(roles.categorical)
        df = fe.impute_numeric(df, roles.numeric, sentinel=-1)
        extra = list(roles.numeric) + [c + "_missing" for c in roles.numeric]
        df = df.select(*[F.col(c).cast("double").alias(c) if c in extra else F.col(c) for c in df.columns])
        sentinels = {}
    else:
        cats = list(roles.numeric) + list(roles.categorical)
        extra = []
        sentinels = {c: roles.numeric_sentinel(c) for c in roles.numeric}
    fit_on = split.split_frames(df.filter(F.col(a.label).isNotNull()), a.key, (a.train_fraction, 1 - a.train_fraction))[0] if a.key else df
    enc = fe.StashEncoder(cats, a.threshold, sentinels).fit(fit_on)
    out = enc.transform(df, extra_inputs=extra)
    if a.numeric_raw:
        out = fe.label_index(out.filter(F.col(a.label).isNotNull()), a.label, "label")
    io.write_parquet(out, a.output, mode="overwrite")
    width = out.schema["features"].metadata.get("ml_attr", {}).get("num_attrs")
    _emit({"step": "encode", "width": width, "columns": len(cats), "fitted_on": "train" if a.key else "all"})


def _lr(spark: SparkSession, data: DataFrame, a, name: str) -> tuple:
    data, key = _with_key(data.filter(F.col(a.label).isNotNull()), a.key)
    train, test = split.split_frames(data, key, (a.train_fraction, 1 - a.train_fraction))
    train = train.withColumn("labels", (F.col(a.label) > 0).cast("int"))
    test = test.withColumn("labels", (F.col(a.label) > 0).cast("int"))
    base = metrics.baseline_log_loss(train, "labels").first().asDict()
    model = models.train_lr(train, "features", "labels", max_iter=a.max_iter, reg_param=a.reg_param,
                            elastic_net=a.elastic_net, threshold=a.decision_threshold)
    scored = io.written(models.score(model, test).select("labels", "prob", "prediction"), "scored")
    out = {"step": name, **{f"train_{k}": v for k, v in base.items()}, **_summary(scored, "labels"),
           "objective_history": list(model.summary.objectiveHistory)}
    return model, train, out


def cmd_train_lr(spark: SparkSession, a) -> None:
    """One-hot LR: metrics and the coefficient table."""
    data = io.read_parquet(spark, a.input, [a.label, "features"] + ([a.key] if a.key else []))
    model, train, out = _lr(spark, data, a, "train-lr")
    if a.coefficients:
        coef = models.coefficient_table(model, train).select("feature", "coeff")
        io.write_csv_single(coef, a.coefficients)
    _emit(out)


def cmd_hash(spark: SparkSession, a) -> None:
    """Store job for hashed features: 2^18 slots by default, label kept."""
    df = io.read_parquet(spark, a.input)
    roles = _roles(df, a.label, a.numeric, a.categorical)
    hashed = fe.hash_features(df, roles.features, a.num_features, categorical_cols=list(roles.categorical))
    io.write_parquet(hashed.select(a.label, *([a.key] if a.key else []), "features"), a.output, mode="overwrite")
    _emit({"step": "hash", "slots": a.num_features, "columns": len(roles.features)})


def cmd_train_lr_hashed(spark: SparkSession, a) -> None:
    """Hashed LR: 2^18 hashed features by default, straight from the raw table."""
    df = io.read_parquet(spark, a.input)
    roles = _roles(df, a.label, a.numeric, a.categorical)
    hashed = fe.hash_features(df, roles.features, a.num_features, categorical_cols=list(roles.categorical))
    _, _, out = _lr(spark, hashed, a, "train-lr-hashed")
    _emit(out)


def _rf_split(spark: SparkSession, a) -> tuple[DataFrame, DataFrame]:
    data = io.read_parquet(spark, a.input).filter(F.col("label").isNotNull())
    data, key = _with_key(data, a.key)
    return split.split_frames(data, key, (a.train_fraction, 1 - a.train_fraction))


def _rf_scores(model, test: DataFrame) -> DataFrame:
    scored = models.score(model, test)
    return io.written(scored.select("label", "prediction", "rawPrediction", "probability", "prob",
                                    scalar.log_loss_clipped("label", "prob").alias("log_loss")), "scored")


def cmd_train_rf(spark: SparkSession, a) -> None:
    """Forest training: oversample clicks, fit the forest, score, save model and
    predictions."""
    train, test = _rf_split(spark, a)
    balanced = split.oversample(train, "label", 1.0, a.times)
    model = models.train_rf(balanced, num_trees=a.trees, max_depth=a.depth, max_bins=a.bins, seed=a.seed)
    model.write().overwrite().save(a.model)
    scored = _rf_scores(model, test)
    if a.predictions:
        io.write_parquet(scored, a.predictions, mode=a.mode)
    _emit({"step": "train-rf", **_summary(scored, "label")})


def cmd_score_rf(spark: SparkSession, a) -> None:
    """Forest scoring: load the saved forest, score the same test rows."""
    _, test = _rf_split(spark, a)
    model = RandomForestClassificationModel.load(a.model)
    scored = _rf_scores(model, test)
    if a.predictions:
        io.write_parquet(scored, a.predictions, mode=a.mode)
    _emit({"step": "score-rf", **_summary(scored, "label"),
           "evaluator_auroc": models.evaluator_auroc(scored, "label")})


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="clicklens")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(s, label="y"):
        s.add_argument("--input", required=True)
        s.add_argument("--label", default=label)
        s.add_argument("--key", default=None, help="unique key column; default: hash of the row")
        s.add_argument("--numeric", default=None, help="comma list; default: integer columns")
        s.add_argument("--categorical", default=None, help="comma list; default: string columns")
        s.add_argument("--train-fraction", type=float, default=0.8)

    def doc(fn):
        text = " ".join((fn.__doc__ or "").split())
        return text.split(". ")[0].rstrip(".") + "."

    s = sub.add_parser("convert", help=doc(cmd_convert))
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--strict", action="store_true")
    s.set_defaults(fn=cmd_convert)

    s = sub.add_parser("encode", help=doc(cmd_encode))
    common(s)
    s.add_argument("--output", required=True)
    s.add_argument("--threshold", type=int, default=10_000)
    s.add_argument("--numeric-raw", action="store_true", help="random-forest layout")
    s.set_defaults(fn=cmd_encode)

    s = sub.add_parser("hash", help=doc(cmd_hash))
    common(s)
    s.add_argument("--output", required=True)
    s.add_argument("--num-features", type=int, default=1 << 18)
    s.set_defaults(fn=cmd_hash)

    for name, fn in (("train-lr", cmd_train_lr), ("train-lr-hashed", cmd_train_lr_hashed)):
        s = sub.add_parser(name, help=doc(fn))
        common(s)
        s.add_argument("--max-iter", type=int, default=models.LR_MAX_ITER)
        s.add_argument("--reg-param", type=float, default=0.0)
        s.add_argument("--elastic-net", type=float, default=0.0)
        s.add_argument("--decision-threshold", type=float, default=models.LR_THRESHOLD)
        s.add_argument("--coefficients", default=None)
        s.add_argument("--num-features", type=int, default=1 << 18)
        s.set_defaults(fn=fn)

    for name, fn in (("train-rf", cmd_train_rf), ("score-rf", cmd_score_rf)):
        s = sub.add_parser(name, help=doc(fn))
        common(s, label="label")
        s.set_defaults(train_fraction=0.7)
        s.add_argument("--model", required=True)
        s.add_argument("--predictions", default=None)
        s.add_argument("--mode", default="errorifexists")
        s.add_argument("--times", type=int, default=2)
        s.add_argument("--trees", type=int, default=models.RF_TREES)
        s.add_argument("--depth", type=int, default=models.RF_DEPTH)
        s.add_argument("--bins", type=int, default=models.RF_BINS)
        s.add_argument("--seed", type=int, default=1)
        s.set_defaults(fn=fn)
    return p


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"clicklens-{args.cmd}").getOrCreate()
    with scratch_scope(spark):
        args.fn(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
