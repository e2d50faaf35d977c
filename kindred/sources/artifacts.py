"""What training leaves behind: model, calibrator, threshold, report."""

from __future__ import annotations

import json

from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import SparkSession

from ..config import Decision, Settings
from ..operators.trees import Trees
from . import tsv


def write_text(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def save_model(model: Trees, settings: Settings) -> None:
    write_text(SparkSession.active(), settings.artifact("model"), model.to_json())


def load_model(settings: Settings) -> Trees:
    return Trees.from_json(read_text(SparkSession.active(), settings.artifact("model")))


def save_calibrator(calibrator: IsotonicRegressionModel | None, settings: Settings) -> None:
    if calibrator is not None:
        calibrator.write().overwrite().save(settings.artifact("calibrator"))


def load_calibrator(spark: SparkSession, settings: Settings) -> IsotonicRegressionModel | None:
    """None if there is none or it can't be read: scores then stay as they are."""
    path = settings.artifact("calibrator")
    if not tsv.exists(spark, path):
        return None
    try:
        return IsotonicRegressionModel.load(path)
    except Exception:  # whatever is wrong with the file
        return None


def save_threshold(spark: SparkSession, threshold: float, settings: Settings) -> None:
    write_text(spark, settings.artifact("threshold.json"), json.dumps({"probability_threshold": threshold}))


def load_threshold(spark: SparkSession, settings: Settings) -> float:
    """The default of the settings if the file is missing or bad."""
    path = settings.artifact("threshold.json")
    try:
        return float(json.loads(read_text(spark, path))["probability_threshold"]) if tsv.exists(spark, path) else settings.decision.threshold
    except (ValueError, KeyError, TypeError):
        return Decision().threshold


def save_report(spark: SparkSession, report: dict, settings: Settings, top: int = 15) -> None:
    """The report as JSON and as text with the most important features."""
    write_text(spark, settings.artifact("training_report.json"), json.dumps(report, indent=2))
    plain = [f"{k}: {v}" for k, v in report.items() if not isinstance(v, (list, dict))]
    plain += [f"confusion {k}: {v}" for k, v in report["confusion_matrix"].items()]
    plain += [f"importance {name}: {gain:.6g}" for name, gain in report["feature_importance"][:top]]
    write_text(spark, settings.artifact("training_report.txt"), "\n".join(plain) + "\n")
