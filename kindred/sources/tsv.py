"""Tab-separated sources and sinks: every field is a string, and an empty one is not null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..config import RECORD_COLUMNS

TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")
FORMAT = {"sep": "\t", "header": True, "quote": '"', "escape": '"', "multiLine": True, "encoding": "UTF-8"}


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The named columns in this order; ``NA`` is text, quotes may hold tabs and newlines."""
    names = header(spark, path)
    if missing := [c for c in columns if c not in names]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    schema = StructType([StructField(n, StringType()) for n in names])
    return spark.read.schema(schema).options(**FORMAT).csv(path).na.fill("").select(*columns)


def header(spark: SparkSession, path: str) -> list[str]:
    line = spark.read.text(path).limit(1).collect()
    return [n.strip('"') for n in line[0][0].lstrip("﻿").split("\t")] if line else []


def check_header(spark: SparkSession, path: str, columns: tuple[str, ...] = RECORD_COLUMNS) -> None:
    """ValueError unless the file has exactly these columns in this order."""
    if (found := header(spark, path)) != list(columns):
        raise ValueError(f"{path} has the columns {found}, not {list(columns)}")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def require(spark: SparkSession, *paths: str) -> None:
    if missing := [p for p in paths if not exists(spark, p)]:
        raise FileNotFoundError(", ".join(missing))


def read_records(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Source records; ``strict`` wants the header to be exact."""
    require(spark, path)
    if strict:
        check_header(spark, path)
    return read_tsv(spark, path, RECORD_COLUMNS)


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """One row for each query: of repeated ones the last in the file counts."""
    require(spark, path)
    rows = read_tsv(spark, path, TRUTH_COLUMNS).withColumn("__ordinal", F.monotonically_increasing_id())
    return rows.groupBy(TRUTH_COLUMNS[0]).agg(F.max_by(TRUTH_COLUMNS[1], "__ordinal").alias(TRUTH_COLUMNS[1]))


def write_lists(lists: DataFrame, path: str, columns: tuple[str, str], order: str | None = None) -> None:
    """(s1, list) as TSV with a header; ``order`` sorts the rows, which costs a range shuffle."""
    rows = lists.orderBy(order) if order else lists
    rows.toDF(*columns).write.mode("overwrite").options(sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="").csv(path)
