"""Incremental prediction: new query files are answered in micro-batches by the batch predictor."""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..config import RECORD_COLUMNS, Settings
from ..operators.trees import Trees
from ..plans import predict, train
from ..sources.tsv import FORMAT


def answer(rows: DataFrame, targets: DataFrame, posted: DataFrame, model: Trees, calibrator: IsotonicRegressionModel | None, threshold: float, settings: Settings, strategy: str = "base") -> DataFrame:
    """(s1, matched) of raw query records."""
    queries = train.queries_of(rows, settings.limits.prefix_length)
    pairs = predict.candidates(queries, targets, posted, settings, strategy)
    return predict.output_lists(queries, predict.decide(predict.score_pairs(pairs, model, calibrator), threshold, settings))[0]


def start(spark: SparkSession, folder: str, out: str, checkpoint: str, files_per_batch: int = 100, **parts) -> StreamingQuery:
    """Answer the TSV files that appear in ``folder``; each batch replaces its own folder, so a repeat does no harm."""
    schema = StructType([StructField(c, StringType()) for c in RECORD_COLUMNS])
    rows = spark.readStream.schema(schema).options(**FORMAT).option("maxFilesPerTrigger", files_per_batch).csv(folder).na.fill("")

    def write(batch: DataFrame, number: int) -> None:
        answer(batch, **parts).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
