"""The target index: normalised records, their token postings and document frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import text as T

RECORDS, POSTINGS, STATS = "records", "postings", "token_stats"


def union_sources(sources: dict[int, DataFrame]) -> DataFrame:
    """The sources under one another, each with its number."""
    out = None
    for number, rows in sorted(sources.items()):
        rows = rows.withColumn("source", F.lit(number).cast("int"))
        out = rows if out is None else out.unionByName(rows)
    return out


def normalized(rows: DataFrame, prefix_length: int = 6) -> DataFrame:
    """entity_id, country, name, address and the prefix keys of raw records; other columns are kept."""
    rows = rows.withColumns({"name": T.normalize_name("business_name"), "address": T.normalize_address("business_address")}).drop("business_name", "business_address")
    return rows.withColumns({"name_prefix": T.prefix_key("name", prefix_length), "addr_prefix": T.prefix_key("address", prefix_length)})


def records(targets: DataFrame, prefix_length: int = 6) -> DataFrame:
    """Indexed records with rid, a number that grows in source and file order.

    rid need not be dense: it is an identity and the order among equals, nothing else. Rows
    that bring an ``ordinal`` are numbered by it; files are numbered by Spark in read order.
    """
    rows = targets
    ordinal = F.col("ordinal") if "ordinal" in rows.columns else F.monotonically_increasing_id()
    rows = rows.withColumn("rid", F.col("source").cast("long") * F.lit(1 << 56) + ordinal)
    return normalized(rows, prefix_length).select("rid", "entity_id", "source", "country", "name", "address", "name_prefix", "addr_prefix")


def postings(indexed: DataFrame) -> DataFrame:
    """(kind, country, tok, rid): the distinct tokens of names and addresses, one row each."""

    def of(kind: str, column: str) -> DataFrame:
        return indexed.select(F.lit(kind).alias("kind"), "country", F.explode(T.tokens(column)).alias("tok"), "rid")

    return of("name", "name").unionAll(of("addr", "address"))


def token_stats(posted: DataFrame) -> DataFrame:
    """(kind, tok, df): in how many records a token stands."""
    return posted.groupBy("kind", "tok").agg(F.count("*").alias("df"))


def duplicate_ids(indexed: DataFrame) -> DataFrame:
    return indexed.groupBy("entity_id").agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def is_built(spark: SparkSession, path: str) -> bool:
    """Whether a complete table lies there: a write that broke off leaves no _SUCCESS."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def build_index(spark: SparkSession, settings: Settings, split: str, sources: dict[int, DataFrame], rebuild: bool = False) -> str:
    """Write the index of a split and return its folder; a complete one is reused unless ``rebuild``.

    ValueError if an entity id stands twice.
    """
    folder = settings.index(split)
    if not rebuild and all(is_built(spark, f"{folder}/{t}") for t in (RECORDS, POSTINGS, STATS)):
        return folder
    records(union_sources(sources), settings.limits.prefix_length).write.mode("overwrite").parquet(f"{folder}/{RECORDS}")
    indexed = spark.read.parquet(f"{folder}/{RECORDS}")
    if twice := duplicate_ids(indexed).take(3):
        clear_index(spark, settings, split)
        raise ValueError(f"entity ids stand twice: {', '.join(str(r[0]) for r in twice)}")
    postings(indexed).write.mode("overwrite").parquet(f"{folder}/{POSTINGS}")
    token_stats(spark.read.parquet(f"{folder}/{POSTINGS}")).write.mode("overwrite").parquet(f"{folder}/{STATS}")
    return folder


def clear_index(spark: SparkSession, settings: Settings, split: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(settings.index(split))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def read_index(spark: SparkSession, settings: Settings, split: str) -> tuple[DataFrame, DataFrame]:
    folder = settings.index(split)
    return spark.read.parquet(f"{folder}/{RECORDS}"), spark.read.parquet(f"{folder}/{POSTINGS}")


def row_count(indexed: DataFrame) -> int:
    return indexed.count()
