"""Scoring a stream with fitted, row-wise steps.

The fitted preparation (imputer literals, clip bounds, time features,
encoder codes, scaler literals) and Spark ML models are plain
projections, so they apply unchanged to a streaming DataFrame. Fits stay
batch-only: they are aggregates over a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import scratch_path


def read_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def score_stream(stream: DataFrame, preparation=None, model=None, keep: list[str] | None = None) -> DataFrame:
    """Apply a fitted ``PreparationModel`` and/or a Spark ML model to a stream."""
    out = preparation.transform(stream) if preparation is not None else stream
    if model is not None:
        out = model.transform(out).drop("features")
    return out.select(*keep) if keep else out


def write_stream(scored: DataFrame, path: str, checkpoint: str | None = None, fmt: str = "parquet",
                 once: bool = True) -> StreamingQuery:
    """Write to files with a checkpoint on shared storage (restartable after executor loss)."""
    spark = scored.sparkSession
    w = (scored.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-ckpt")))
    w = w.trigger(availableNow=True) if once else w
    return w.start(path)
