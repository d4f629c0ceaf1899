"""The reference's script chain through the command line, on a TSV in the
reference layout built from the test tables."""

import json
import os

from pyspark.sql import functions as F

from clicklens import fixtures as fx
from clicklens.plans import cli
from clicklens.schema import reference_tsv_schema
from clicklens.session import scratch_path
from clicklens.sources import io
from conftest import SF_CHECK


def _reference_layout(spark):
    imp = fx.signal_impressions(spark, SF_CHECK)
    schema = reference_tsv_schema()
    src = {"n1": "n1", "n2": "n2", "n3": "n3", "n4": "n4", "n5": "n5",
           "cat13": "cat1", "cat14": "cat2", "cat15": "cat3", "cat16": "cat4"}
    cols = [F.col(src[f.name]).cast(f.dataType).alias(f.name) if f.name in src
            else (F.col("y") if f.name == "y" else F.lit(None).cast(f.dataType).alias(f.name))
            for f in schema.fields]
    return imp.select(*cols)


def _run(capsys, argv):
    cli.main(argv)
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_script_chain(spark, capsys):
    raw = scratch_path(spark, "raw")
    io.write_tsv(_reference_layout(spark), raw)
    pq = scratch_path(spark, "pq")
    conv = _run(capsys, ["convert", "--input", f"{raw}/part-*", "--output", pq])
    assert conv["columns_with_differences"] == 0 and conv["rows"] > 0

    ohe = scratch_path(spark, "ohe")
    enc = _run(capsys, ["encode", "--input", pq, "--output", ohe, "--threshold", "10"])
    assert enc["width"] > 0 and enc["fitted_on"] == "all"
    coef = scratch_path(spark, "coef")
    lr = _run(capsys, ["train-lr", "--input", ohe, "--coefficients", coef])
    assert lr["log_loss"] < lr["train_baseline_log_loss"] + 0.05
    assert spark.read.csv(coef).count() == enc["width"]

    stored = scratch_path(spark, "hashed")
    _run(capsys, ["hash", "--input", pq, "--output", stored, "--num-features", "4096"])
    from_store = _run(capsys, ["train-lr", "--input", stored])
    hashed = _run(capsys, ["train-lr-hashed", "--input", pq, "--num-features", "4096"])
    assert hashed["log_loss"] < hashed["train_baseline_log_loss"]
    assert from_store["train_rows"] > 0 and abs(from_store["log_loss"] - hashed["log_loss"]) < 0.1

    rf_in = scratch_path(spark, "ohe_rf")
    _run(capsys, ["encode", "--input", pq, "--output", rf_in, "--threshold", "10", "--numeric-raw"])
    model = scratch_path(spark, "rf")
    trained = _run(capsys, ["train-rf", "--input", rf_in, "--model", model, "--trees", "10"])
    scored = _run(capsys, ["score-rf", "--input", rf_in, "--model", model,
                           "--predictions", scratch_path(spark, "pred")])
    assert abs(trained["log_loss"] - scored["log_loss"]) < 1e-12
    assert scored["auroc"] > 0.8


def test_steps_leave_no_scratch_and_encoders_fit_on_training_rows(spark, capsys, tmp_path):
    from clicklens.session import ensure_checkpoint_dir

    fx.signal_impressions(spark, SF_CHECK).write.parquet(str(tmp_path / "imp"))
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    one = _run(capsys, ["encode", "--input", str(tmp_path / "imp"), "--output", str(tmp_path / "x"), "--threshold", "40", "--key", "id"])
    every = _run(capsys, ["encode", "--input", str(tmp_path / "imp"), "--output", str(tmp_path / "y"), "--threshold", "40", "--numeric", "n1,n2,n3,n4,n5"])
    assert one["fitted_on"] == "train" and one["width"] < every["width"]
    lr = _run(capsys, ["train-lr", "--input", str(tmp_path / "x"), "--key", "id", "--max-iter", "3"])
    assert lr["train_rows"] > 0 and set(os.listdir(folder)) == before
