"""Quality classification by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are trigrams of character classes, hashed byte trigrams and repeats of a word
right after itself. A bounded sample of labelled texts gives the term weights, the latent
space (truncated SVD) and the voters; those are broadcast. Every document is projected, its
cosines with all voters are computed in blocks, and the nearest vote by similarity.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import map_arrow, utf8

#: Labelled rows of each label that are used at most: the bound of what is collected and broadcast.
SAMPLE = 1000
RANK, NEIGHBOURS, POWER, LIMIT = 48, 25, 6, 0.3
HASHED = 2048
#: One term stands for all repeats of a word, against thousands for the rest.
REPEATS = 4
BLOCK = 1 << 20

CLASSES = np.full(256, 10, np.int64)
for _n, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r\t", b".", b",;:", b"!?", b"|", b"#$%&*@^~+=<>_")):
    CLASSES[list(_chars)] = _n
CLASSES[128:] = 0  # letters outside ASCII count with the lower-case ones
KINDS = 11
TERMS = KINDS**3 + HASHED + 1


class Model(NamedTuple):
    weights: np.ndarray  # of the terms
    basis: np.ndarray  # terms x rank
    voters: np.ndarray  # voters x rank, unit rows
    labels: np.ndarray  # 0.0 or 1.0
    prior: float


def terms(raw: bytes) -> np.ndarray:
    """Damped term counts of a whole text (float32, TERMS long); all zero for an empty text."""
    counts = np.zeros(TERMS, np.int64)
    for at in range(0, max(0, len(raw) - 2), BLOCK):
        data = np.frombuffer(raw, np.uint8, min(len(raw) - at, BLOCK + 2), at)
        kinds = CLASSES[data]
        counts[: KINDS**3] += np.bincount((kinds[:-2] * KINDS + kinds[1:-1]) * KINDS + kinds[2:], minlength=KINDS**3)
        wide = data.astype(np.uint32)
        hashed = ((wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]) * np.uint32(2654435761)) >> np.uint32(32 - 11)
        counts[KINDS**3 : -1] += np.bincount(hashed, minlength=HASHED)
    words = raw.split()
    counts[-1] = sum(map(bytes.__eq__, words, words[1:]))
    out = counts / max(1, len(raw)) * 1000
    out = np.log1p(out).astype(np.float32)
    out[-1] *= REPEATS
    return out


def project(rows: np.ndarray, model: Model) -> np.ndarray:
    x = rows * model.weights
    size = np.linalg.norm(x, axis=1, keepdims=True)
    x = (x / np.where(size > 0, size, 1)) @ model.basis
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def fit(rows: np.ndarray, labels: np.ndarray, rank: int = RANK, seed: int = 5) -> Model:
    """The latent space of the sample by randomised SVD, with the sample's vectors as voters."""
    held = (rows > 0).sum(axis=0)
    weights = (np.log((1 + len(rows)) / (1 + held)) + 1).astype(np.float32)
    x = rows * weights
    size = np.linalg.norm(x, axis=1, keepdims=True)
    x /= np.where(size > 0, size, 1)
    rng = np.random.Generator(np.random.PCG64(seed))
    rank = max(1, min(rank, *x.shape))
    sketch = x @ rng.standard_normal((x.shape[1], min(x.shape[1], rank + 16))).astype(np.float32)
    for _ in range(4):
        sketch, _ = np.linalg.qr(sketch)
        sketch = x @ (x.T @ sketch)
    q, _ = np.linalg.qr(sketch)
    _, _, right = np.linalg.svd(q.T @ x, full_matrices=False)
    model = Model(weights, np.ascontiguousarray(right[:rank].T), np.zeros((0, rank)), labels.astype(np.float64), float(labels.mean()))
    return model._replace(voters=project(rows, model))


def vote(model: Model, rows: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Scores from 0 to 1; a text without terms has the prior. Voters as near as the last one chosen vote too.

    Cosines are rounded to five places, so that the batch that a text comes in doesn't tell.
    """
    near = np.round((project(rows, model) @ model.voters.T).astype(np.float64), 5)
    k = min(neighbours, near.shape[1])
    last = np.partition(near, -k, axis=1)[:, -k, None]
    weight = np.where(near >= last, np.maximum(near, 0), 0) ** POWER
    total = weight.sum(axis=1)
    return np.where(total > 0, (weight @ model.labels) / np.where(total > 0, total, 1), model.prior)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model | None:
    """A model of at most ``sample`` labelled rows of each label, chosen by a hash of the id.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out. Null labels and ids are left out, of several
    labels of an id the least counts, and of several texts one. Without any
    labelled row there is no model, and every score is 0.5.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id))).select(F.col(doc_id).alias("__k_id"), F.col(label).cast("int").alias("__k_label"))
    known = known.groupBy("__k_id").agg(F.min("__k_label").alias("__k_label"))
    order = [F.xxhash64("__k_id", F.lit("sample")), F.col("__k_id")]
    chosen = [known.where(F.col("__k_label") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    rows = docs.select(F.col(doc_id).alias("id"), utf8(text).alias("raw")).join(F.broadcast(chosen[0].unionAll(chosen[1])), F.col("id") == F.col("__k_id"))

    def of(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([terms(r).tobytes() for r in batch.column(2).to_pylist()], pa.binary())], names=["id", "label", "terms"])

    kind = dict(docs.dtypes)[doc_id]
    found = map_arrow(rows.select("id", F.col("__k_label").alias("label"), "raw"), of, f"id {kind}, label int, terms binary")
    got = found.groupBy("id").agg(F.min(F.struct("label", "terms")).alias("row")).select("id", "row.*").orderBy("id").toArrow()
    if not got.num_rows:
        return None
    matrix = np.stack([np.frombuffer(t.as_buffer(), np.float32) for t in got.column("terms")])
    return fit(matrix, got.column("label").to_numpy())


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def scored(docs: DataFrame, model: Model | None, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and __k_score of every row. Null and empty texts have the sample's share of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    held = [(n, t) for n, t in docs.dtypes if n in keep]
    names = [n for n, _ in held]
    at = names.index(text) if text in names else len(names)

    def of(batch: pa.RecordBatch):
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            raw = [r or b"" for r in part.column(at).cast(pa.binary()).to_pylist()]
            scores = np.full(len(raw), 0.5) if sent.value is None else vote(sent.value, np.stack([terms(r) for r in raw]))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(np.clip(scores, 0, 1))], names=[*names, "__k_score"])

    columns = [F.col(f"`{n}`") for n in names] + ([] if text in names else [F.col(text)])
    return map_arrow(docs.select(*columns), of, ", ".join(f"`{n}` {t}" for n, t in held) + ", __k_score double")


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: float = LIMIT) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 from ``limit`` on)."""
    model = train(docs, labels, doc_id, text)
    out = scored(docs.select(doc_id, text), model, [doc_id], text)
    held = F.coalesce(held_out(F.col(doc_id)), F.lit(False))
    return out.select(F.col(doc_id).alias("doc_id"), held.alias("held_out"), F.col("__k_score").alias("score"), (F.col("__k_score") >= limit).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: float = LIMIT) -> DataFrame:
    """The rows that the classifier doesn't reject, with all their columns."""
    model = train(docs, labels, doc_id, text)
    out = scored(docs, model, docs.columns, text)
    return out.where(F.col("__k_score") >= limit).select(*docs.columns)
