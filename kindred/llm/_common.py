"""What the operators of this package share: staged tables, row keys and Arrow mapping."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: In force while a table is written: it replaces the step's shuffle files, and Python gets whole
#: texts in batches that a worker can hold several times over.
ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", ROWS: "1000"}
LIBC = ctypes.CDLL(None)
#: Arrow's own allocator keeps what it has freed; malloc gives it back when it is trimmed.
pa.set_memory_pool(pa.system_memory_pool())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Where it is unset, a temporary folder is made and set in local mode (tests); on a cluster
    that would be a folder of one machine, so it is a ValueError there.
    """
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


def give_back(spark: SparkSession) -> None:
    """Have the executors collect garbage: heaps grow with what many short steps leave behind.

    A full collection shrinks the heap and frees the buffers outside it that only dead objects hold. A task for each
    core; an executor that gets none goes on as it was.
    """
    n = max(1, spark.sparkContext.defaultParallelism)
    spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).write.format("noop").mode("overwrite").save()


class Workspace:
    """Intermediate tables as Parquet in the shared folder.

    Writing a table cuts its lineage: a lost executor costs the tasks of the running
    step, not those of the steps before it. ``drop`` frees a table that nothing reads
    any more; what a returned DataFrame still reads stays until the folder is emptied.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{self.root}/{self.count:03d}-{label}"
        self.count += 1
        held = {name: self.spark.conf.get(name, None) for name in WRITING}
        for name, value in WRITING.items():
            self.spark.conf.set(name, value)
        try:
            df.write.parquet(path)
        finally:
            for name, value in held.items():
                if value is None:
                    self.spark.conf.unset(name)
                else:
                    self.spark.conf.set(name, value)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._kindred_path = path
        return out

    def drop(self, *saved: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in saved:
            path = jvm.org.apache.hadoop.fs.Path(df._kindred_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _trim() -> None:
    """Give back what a task's batches took: a worker process outlives its tasks."""
    pa.default_memory_pool().release_unused()
    if hasattr(LIBC, "malloc_trim"):
        LIBC.malloc_trim(0)


def in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow for texts of any length.

    Where the session has Spark's own number of rows a batch, it is set to one whose texts a
    worker can hold several times over.
    """
    conf = df.sparkSession.conf
    if conf.get(ROWS) == "10000":
        conf.set(ROWS, WRITING[ROWS])

    def run(batches):
        yield from fn(batches)
        _trim()

    return df.mapInArrow(run, schema)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``in_arrow`` for a function of one batch that yields batches."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return in_arrow(df, run, schema)


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast: the driver would build a table that grows with the rows, and files are small."""
    return df.hint("merge")


def utf8(column: Column | str) -> Column:
    """The bytes of a text; those of a null text are empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def id_lists(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    """array<int> of token ids, list i being those from ends[i] to ends[i + 1]."""
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32)))


def keyed(docs: DataFrame, ws: Workspace, doc_id: str = "doc_id", text: str = "text", key: str = "__k_row") -> DataFrame:
    """The documents with a unique long key in the order of doc_id.

    The key is doc_id itself while that is unique and never null (checked over all
    rows on the id column alone). Otherwise the rows are written once in the order
    (doc_id, text), nulls last, and numbered in it, so equal ids keep their order.
    """
    twice = docs.groupBy(doc_id).count().where((F.col("count") > 1) | F.col(doc_id).isNull())
    if dict(docs.dtypes)[doc_id] in ("bigint", "int", "smallint", "tinyint") and twice.isEmpty():
        return docs.withColumn(key, F.col(doc_id).cast("long"))
    order = [F.col(doc_id).asc_nulls_last(), F.col(text).asc_nulls_last()]
    numbered = docs.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(key, F.monotonically_increasing_id())
    return ws.save(numbered, "keyed")
