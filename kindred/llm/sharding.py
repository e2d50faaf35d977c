"""Sharding by a two-pass external shuffle.

Pass one scatters the rows into memory-sized buckets by a seeded hash; pass two shuffles
every bucket by itself (Fisher-Yates) and writes it. The shard follows from doc_id and the
number of shards alone (jump consistent hash), so one more shard takes rows only into itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import in_arrow

BUCKET_BYTES = 32 << 20
#: Rows of (bucket, start), 12 bytes each, that are broadcast at most; more are joined by a shuffle.
BROADCAST_BUCKETS = 200_000


def jump(key: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash (Lamping and Veach 2014) of 64-bit keys, all at once."""
    key = key.astype(np.uint64, copy=True)
    held, at = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
    while (live := at < shards).any():
        held[live] = at[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        at[live] = ((held[live] + 1) * (float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
    return held


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A permutation of n rows: from the last place down, each swaps with a place at or before it."""
    order = list(range(n))
    draws = np.random.Generator(np.random.PCG64(seed)).random(n)
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def key_of(doc_id: Column, seed: int) -> Column:
    """The seeded key of a doc_id; all null ids have one key, and so one shard."""
    return F.xxhash64(doc_id, F.lit(seed))


def scattered(docs: DataFrame, shards: int, seed: int, doc_id: str, text: str, per_shard: int) -> DataFrame:
    """All columns of the rows with __shard, __grown and __bucket: the seeded hashes, row by row."""
    columns = docs.columns
    held = docs.select(*columns, key_of(F.col(doc_id), seed).alias("__key"))

    def place(batches):
        for batch in batches:
            key = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
            shard, grown = (pa.array(jump(key, n).astype(np.int32)) for n in (shards, shards + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, shard, grown], names=[*columns, "__key", "__shard", "__grown"])

    placed = in_arrow(held, place, f"{fields_of(docs)}, __key long, __shard int, __grown int")
    # The hash that spreads a shard over its buckets takes the text in: rows that share an id spread too.
    spread = F.pmod(F.xxhash64("__key", F.col(text), F.lit(seed + 1)), F.lit(per_shard)).cast("int")
    return placed.withColumn("__bucket", F.col("__shard") * F.lit(per_shard) + spread).drop("__key")


def fields_of(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def sharded(docs: DataFrame, shards: int = 16, seed: int = 7, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of the rows with __shard, __grown and __slot, gapless from 0 in each shard.

    The number of buckets of a shard follows from the bytes of all rows, so a bucket fits
    one task's memory at any size of input. Within a bucket the rows are sorted before they
    are shuffled, so a task that runs again gives the same order. The buckets of a shard
    stand one after another, by the counts of rows in each. Null texts stay null, null ids
    share a shard, equal rows are kept as often as they occur, no rows give no rows.
    """
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()[0] or 0
    per_shard = max(1, -(-total // (shards * bucket_bytes)))
    ids = scattered(docs.select(doc_id, text), shards, seed, doc_id, text, per_shard)
    counts = ids.groupBy("__shard", "__bucket").agg(F.count("*").alias("__n"))
    before = W.partitionBy("__shard").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    if shards * per_shard <= BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    rows = scattered(docs, shards, seed, doc_id, text, per_shard).join(starts, "__bucket")

    columns = docs.columns

    def shuffle(table: pa.Table) -> pa.Table:
        number = table.column("__bucket")[0].as_py()
        order = pc.sort_indices(pa.table({"a": table.column(doc_id), "b": table.column(text)}), sort_keys=[("a", "ascending"), ("b", "ascending")])
        table = table.take(order).take(pa.array(fisher_yates(table.num_rows, seed * 1_000_003 + number)))
        slots = table.column("__start")[0].as_py() + np.arange(table.num_rows, dtype=np.int64)
        return table.select([*columns, "__shard", "__grown"]).append_column("__slot", pa.array(slots))

    return rows.groupBy("__bucket").applyInArrow(shuffle, f"{fields_of(docs)}, __shard int, __grown int, __slot long")


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 7, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the shards as Parquet folders __shard=N: a file holds whole buckets, its rows in the order of __slot.

    The files of a shard hold ranges of slots one after another, so no task needs a whole shard.
    """
    out = sharded(docs, shards, seed, doc_id, text)
    out.sortWithinPartitions("__shard", "__slot").write.partitionBy("__shard").parquet(path)


def shard_report(docs: DataFrame, shards: int = 16, seed: int = 7, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    raw = F.coalesce(F.col(text), F.lit(""))
    out = sharded(docs.select(doc_id, text), shards, seed, doc_id, text)
    return out.select(F.col(doc_id).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot"), F.col("__grown").alias("grown_shard"))
