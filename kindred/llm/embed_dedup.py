"""Embedding near-duplicates by cross-polytope hashing (Andoni et al. 2015).

A unit vector is rotated by random signs and fast Hadamard transforms, and hashed to the
nearest of the 2d signed axes. A table's bucket is the hashes of two rotations; besides its
own bucket a vector probes those of its next-nearest axes. Candidate pairs that share a
label and a bucket are verified by their cosine in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Workspace, in_arrow
from ._graph import components

TABLES, PROBES, SEED = 8, 4, 11


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        pairs = x.reshape(n, width // (2 * step), 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, width)
        step *= 2
    return x


def rotate(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1])) / np.sqrt(x.shape[1])
    return x


def codes(units: np.ndarray, tables: int = TABLES, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """Bucket numbers of unit vectors, shape (rows, tables, 1 + probes); the first is the own bucket."""
    n, dim = units.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = units
    rng = np.random.Generator(np.random.PCG64(seed * 100_003 + dim))
    out = np.zeros((n, tables, 1 + probes), np.int64)
    rows = np.arange(n)[:, None]
    for t in range(tables):
        axes, gaps = [], []
        for _ in range(2):
            turned = rotate(padded, rng)
            near = np.argsort(-np.abs(turned), axis=1, kind="stable")[:, : 1 + probes]
            size = np.abs(turned)[rows, near]
            axes.append(near * 2 + (turned[rows, near] < 0))
            gaps.append(size[:, :1] - size)
        own = axes[0][:, 0] * 2 * width + axes[1][:, 0]
        # One of the two axes changed, in order of the distance given up.
        others = np.concatenate([axes[0][:, 1:] * 2 * width + axes[1][:, :1], axes[0][:, :1] * 2 * width + axes[1][:, 1:]], axis=1)
        loss = np.concatenate([gaps[0][:, 1:], gaps[1][:, 1:]], axis=1)
        best = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        out[:, t, 0] = own
        out[:, t, 1:] = others[rows, best]
    return out


def unit_rows(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def near_duplicates(vectors: DataFrame, limit: float = 0.98, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors are compared if their labels are equal and not null and they have the same
    length. A vector that is null, empty or zero, or holds a null or a non-finite component,
    links with nothing, nor does a row without an id: its component is its own id. Equal
    vectors of a label are one class (linked with each other, cosine 1), which is searched
    once; a row's links are its class's other rows and all rows of the linked classes.
    Repeated rows count as often as they occur, and rows that share an id but not the vector
    are rows of their own.
    """
    ws = Workspace(vectors.sparkSession, "embed")
    values = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), values.alias("v"))
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    classes = ws.save(rows.where("ok").groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n")).withColumn("c", F.monotonically_increasing_id()), "classes")
    label_type = dict(classes.dtypes)["label"]

    def hashed(batches):
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)])
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                units = unit_rows(flat[(starts[at][:, None] + np.arange(dim)).reshape(-1)], int(dim))
                found = codes(units, tables, probes)
                many = tables * (1 + probes)
                owns = np.zeros(found.shape, bool)
                owns[:, :, 0] = True
                spots = np.broadcast_to(np.arange(tables)[None, :, None], found.shape)
                ids = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(ids.take(pa.array(np.repeat(np.arange(len(at)), many)))), batch.column(1).take(ids.take(pa.array(np.repeat(np.arange(len(at)), many)))), pa.array(np.full(len(at) * many, dim, np.int32)), pa.array(spots.reshape(-1).astype(np.int32)), pa.array(found.reshape(-1)), pa.array(owns.reshape(-1))],
                    names=["c", "label", "dim", "tab", "bucket", "own"],
                )

    probed = ws.save(in_arrow(classes.select("c", "label", "v"), hashed, f"c long, label {label_type}, dim int, tab int, bucket long, own boolean"), "buckets")
    key = ["label", "dim", "tab", "bucket"]
    # A bucket of one own vector and no other probe makes no pair: only buckets with two or more meet.
    own = probed.where("own").select(*key, F.col("c").alias("a"))
    met = probed.select(*key, F.col("c").alias("b")).join(own, key).where(F.col("a") != F.col("b"))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda x: classes.select(F.col("c").alias(x), F.col("v").alias(f"v{x}"), F.col("n").alias(f"n{x}"))
    full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "va", "vb")

    def verified(batches):
        for batch in batches:
            dims = np.diff(batch.column(4).offsets.to_numpy())
            for dim in np.unique(dims):
                part = batch.take(pa.array(np.flatnonzero(dims == dim)))
                x, y = (unit_rows(part.column(i).flatten().to_numpy(), int(dim)) for i in (4, 5))
                near = part.take(pa.array(np.flatnonzero((x * y).sum(axis=1) >= limit)))
                yield pa.RecordBatch.from_arrays([near.column(i) for i in range(4)], names=["a", "b", "na", "nb"])

    links = ws.save(in_arrow(full, verified, "a long, b long, na long, nb long"), "links")
    roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), ws)
    others = links.select(F.col("a").alias("c"), F.col("nb").alias("m")).unionAll(links.select("b", "na")).groupBy("c").agg(F.sum("m").alias("m"))
    rooted = classes.join(others, "c", "left").join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = rooted.join(smallest, "root").select("label", "v", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"), "component_id")
    per_class = ws.save(per_class, "by-class")
    fine = rows.where("ok").join(per_class, ["label", "v"]).select("vec_id", "n_links", "component_id")
    rest = rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return fine.unionAll(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
