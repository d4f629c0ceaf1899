"""Scoring new impressions as a stream with a saved, stateless pipeline.

The reference has no streaming; its notes suggest using the hashed model on
new traffic. A hashed pipeline (``FeatureHasher`` + LR) needs no state
across rows, so a stream is scored by the same ``transform`` as a batch.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clicklens.operators.models import score


def read_impression_stream(spark: SparkSession, path: str, schema: T.StructType,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files arriving under ``path`` as a streaming DataFrame."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.parquet(path)


def score_stream(stream: DataFrame, model_path: str, keep: list[str] | None = None) -> DataFrame:
    """Apply a saved pipeline to a stream; adds ``prob`` (P(click))."""
    model = PipelineModel.load(model_path)
    scored = score(model, stream)
    cols = (keep or []) + ["prediction", "prob"]
    return scored.select(*cols)


def write_scores(scored: DataFrame, sink_path: str, checkpoint_path: str,
                 available_now: bool = True) -> StreamingQuery:
    """Append scores as Parquet with a checkpoint on the shared file system
    (exactly-once file sink; restart resumes from the checkpoint)."""
    w = (scored.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(sink_path)
