"""Tables that a plan reads more than once, written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a temporary folder in local mode, else ValueError."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = known.get() if known.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="kindred-checkpoints-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows written as Parquet and read again: lineage ends here, and a lost executor costs no earlier step."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kindred-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
