"""Business directories made of the driver's tables: inputs for queries and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import index
from ..sources.staging import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corrupted_directory(spark: SparkSession, sf_dir: str) -> tuple[dict[int, DataFrame], DataFrame]:
    """Three sources of one directory with stated corruptions, and the truth (s1, entity_id, same_country).

    A business is a customer, named by the part of the same number and its market segment.
    """
    key = F.col("c_custkey")
    # Small files of very many short rows: a stated number of partitions keeps what follows from one task.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").repartition(n, "c_custkey")
    base = base.join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    base = base.join(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type").repartition(n, "p_partkey"), key == F.col("p_partkey"))
    name = F.concat_ws(" ", "p_name", "p_brand", "c_mktsegment")
    address = F.concat_ws(" ", key.cast("string"), F.col("p_type"), F.lit("Street"), F.col("n_name"), (key + 10000).cast("string"))
    base = base.select(key.cast("long").alias("ordinal"), name.alias("name"), address.alias("address"), F.col("n_name").alias("nation"), F.col("n_nationkey"))
    record = lambda n, name, address, country: [F.concat(F.lit(f"S{n}-"), "ordinal").alias("entity_id"), name.alias("business_name"), address.alias("business_address"), country.alias("country"), "ordinal"]
    nation = F.col("nation")
    one = base.select(*record(1, F.col("name"), F.col("address"), nation))
    suffix = F.element_at(F.array(F.lit(" Ltd"), F.lit(" Pvt. Ltd."), F.lit(" & Co")), (F.col("ordinal") % 3 + 1).cast("int"))
    two = base.where("ordinal % 2 = 0").select(*record(2, F.concat(F.upper("name"), suffix), F.replace(F.col("address"), F.lit("Street"), F.lit("St.")), nation))
    at = (F.col("ordinal") % 5 + 2).cast("int")
    dropped = F.concat(F.substring(F.col("name"), F.lit(1), at - 1), F.substring(F.col("name"), at + 1, F.length("name")))
    w = F.split(dropped, " ")
    swapped = F.when(F.col("ordinal") % 7 == 0, F.array_join(F.concat(F.array(w[1], w[0]), F.slice(w, F.lit(3), F.greatest(F.size(w) - 2, F.lit(0)))), " ")).otherwise(dropped)
    shorter = F.when(F.col("ordinal") % 4 == 0, F.regexp_replace("address", r"^\d+ ", "")).otherwise(F.col("address"))
    neighbour = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("next_nation"))
    moved = base.join(neighbour, (F.col("n_nationkey") + 1) % 25 == F.col("k"))
    elsewhere = F.when(F.col("ordinal") % 25 == 0, F.col("next_nation")).otherwise(nation)
    three = moved.where("ordinal % 3 = 0").select(*record(3, swapped, shorter, elsewhere))
    pairs = [x.select(F.concat(F.lit("S1-"), "ordinal").alias("s1"), "entity_id", F.col("country").alias("c2"), "ordinal") for x in (two, three)]
    truth = pairs[0].unionAll(pairs[1]).join(one.select("ordinal", F.col("country").alias("c1")), "ordinal")
    return {1: one, 2: two, 3: three}, truth.select("s1", "entity_id", (F.col("c1") == F.col("c2")).cast("int").alias("same_country"))


def directory(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(queries, targets) of the directory, whole fields: normalised queries, and indexed records."""
    sources = corrupted_directory(spark, sf_dir)[0]
    return index.normalized(sources[1]).withColumnRenamed("entity_id", "s1"), index.records(index.union_sources({n: sources[n] for n in (2, 3)}))


def indexed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``directory`` written once, as the index is, for plans that read it more than once."""
    queries, targets = directory(spark, sf_dir)
    return staged(queries, "queries"), staged(targets, "records")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1, entity_id) of the directory."""
    return corrupted_directory(spark, sf_dir)[1].select("s1", "entity_id")
