"""Suffix-array dedup by distributed prefix doubling.

Suffixes are ranked by growing prefixes, and a suffix leaves as soon as its rank is unique or
its prefix has passed the threshold. Ranks are 64-bit names: the name of 2h bytes is made of
the names of the two halves of h bytes (1, 2, 4, 8, 16, 32). Sorting a pair for every byte
of a corpus would cost many times the corpus in shuffled data, so of every run of windows of
the threshold's length only one position is sent: the smallest name of GRAM bytes in the
window, which is the same place in equal windows wherever they stand. Spark then sorts

1. (name of GRAM bytes, position): unique names leave;
2. (name, name of the whole stretch of windows that share the position): equal stretches are
   resolved at once, all but their first are repeats;
3. (name of GRAM and HALF more bytes, position), to the right and to the left, for the first
   of each kind of stretch: one of the two is in every window, so what is unique both ways leaves;
4. (name of the threshold's bytes, position) of the single windows that are left, where a
   repeat begins or ends, two digests of 64 bits each.

Names from step 2 on are digests of the bytes themselves. Every pair of equal windows meets in
one of these steps, so the result is exact.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._common import Workspace, in_arrow, keyed, utf8

THRESHOLD, GRAM = 100, 32
#: Bytes that are ranked at once: bounds a task's memory, and longer texts go in overlapping parts.
CHUNK = 1 << 18
#: Windows that are compared with each other before they are sent.
WINDOWS = 100_000
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= C
    x ^= x >> np.uint64(29)
    return x


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * A
    x += right * B
    return _mix(x)


LETTERS = _mix(_mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * A))


def names(data: np.ndarray) -> np.ndarray:
    """The name of the GRAM bytes at every position that has them, by doubling."""
    x, h = LETTERS[data], 1
    while h < GRAM:
        x = _join(x[:-h], x[h:])
        h *= 2
    return x


def anchors(data: np.ndarray, starts: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, ...]:
    """Of bytes that hold texts one after another (starts, and the end last): for each run of
    windows with the same chosen position its text, that position, first and last window and
    the position's name. Positions are those in ``data``.
    """
    empty = np.zeros(0, np.int64)
    n = len(data)
    if n < threshold:
        return empty, empty, empty, empty, empty.astype(np.uint64)
    gram = names(data)
    span = threshold - GRAM + 1
    # The leftmost smallest name: position in the low bits, so that ties go left. As many bits in
    # every part, so that equal windows compare the same bits of their names wherever they stand.
    low = np.uint64((2 * CHUNK + THRESHOLD).bit_length())
    order = (gram >> low << low) | np.arange(len(gram), dtype=np.uint64)
    blocks = -(-len(order) // span)
    table = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    table[: len(order)] = order
    table = table.reshape(blocks, span)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - threshold + 1
    chosen = (np.minimum(back[:windows], ahead[span - 1 : span - 1 + windows]) & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    # Windows that reach into the next text don't count.
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes)), np.maximum(sizes - threshold + 1, 0))
    first = np.repeat(starts[:-1], np.maximum(sizes - threshold + 1, 0))
    counts = np.maximum(sizes - threshold + 1, 0)
    window = first + np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    chosen = chosen[window]
    new = np.ones(len(window), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    last = window[np.append(at[1:], len(window)) - 1] if len(at) else empty
    lo, place, text = window[at], chosen[at], text[at]
    return text, place, lo, last, gram[place]


def _chunks(batch: pa.RecordBatch, threshold: int):
    """The batch's texts joined up to CHUNK bytes: (keys, offsets in the texts, starts, bytes)."""
    keys, offsets, parts, size = [], [], [], 0
    for key, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
        raw = raw.as_py()
        for at in range(0, max(1, len(raw) - threshold + 1), CHUNK):
            part = raw[at : at + CHUNK + threshold - 1]
            if len(part) < threshold:
                continue
            keys.append(key)
            offsets.append(at)
            parts.append(part)
            size += len(part)
            if size >= CHUNK:
                yield np.array(keys), np.array(offsets), np.cumsum([0, *map(len, parts)]), np.frombuffer(b"".join(parts), np.uint8)
                keys, offsets, parts, size = [], [], [], 0
    if parts:
        yield np.array(keys), np.array(offsets), np.cumsum([0, *map(len, parts)]), np.frombuffer(b"".join(parts), np.uint8)


def spans(rows: DataFrame, ws: Workspace, threshold: int = THRESHOLD, text: str = "text", key: str = "__k_row") -> DataFrame:
    """(doc, spans): the byte ranges [start, end) to remove of every text that has any, sorted, not merged."""
    raw = rows.where(F.octet_length(text) >= threshold).select(F.col(key).alias("doc"), utf8(text).alias("raw"))

    half = (threshold - GRAM) // 2

    def positions(batches):
        for batch in batches:
            for keys, offsets, starts, data in _chunks(batch, threshold):
                t, place, lo, last, name = anchors(data, starts, threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[t]), pa.array(lo + offsets[t] - starts[t]), pa.array(((place - lo) << 16 | last - lo).astype(np.int32)), pa.array(name.view(np.int64))], names=["doc", "lo", "shape", "name"]
                )

    found = ws.save(in_arrow(raw, positions, "doc long, lo long, shape int, name long"), "positions")
    repeated = found.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("name")
    live = ws.save(found.join(repeated, "name", "left_semi").select("doc", "lo", "shape"), "live")
    ws.drop(found)

    def ranks(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                docs, los, shapes, names_, stretches, rights, lefts = [], [], [], [], [], [], []
                for doc, raw, stops in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2)):
                    lo, shape = (c.to_numpy(zero_copy_only=False) for c in stops.values.flatten())
                    docs.append(np.full(len(lo), doc))
                    los.append(lo)
                    shapes.append(shape)
                    for first, back, more in zip(lo.tolist(), (shape >> 16).tolist(), (shape & 0xFFFF).tolist()):
                        place, end = first + back, first + more + threshold
                        names_.append(digest(raw[place : place + GRAM]))
                        stretches.append(digest(raw[first:end], back + 1))
                        rights.append(digest(raw[place : place + GRAM + half]) if place + GRAM + half <= end else 0)
                        lefts.append(digest(raw[place - half : place + GRAM]) if back >= half else 0)
                longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (names_, stretches, rights, lefts)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(docs)), pa.array(np.concatenate(los)), pa.array(np.concatenate(shapes)), *longs], names=["doc", "lo", "shape", "name", "stretch", "right", "left"])

    stops = live.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("lo", "shape"))).alias("stops"))
    ranked = in_arrow(raw.join(stops, "doc").select("doc", "raw", "stops"), ranks, "doc long, lo long, shape int, name long, stretch long, right long, left long")
    ranked = ws.save(ranked, "ranked")
    ws.drop(live)

    kinds = ranked.groupBy("name", "stretch").agg(F.min(F.struct("doc", "lo", "shape")).alias("first"), F.count("*").alias("n"), F.min("right").alias("right"), F.min("left").alias("left"))
    kinds = ws.save(kinds, "stretches")
    more = F.col("shape").bitwiseAND(F.lit(0xFFFF))
    whole = ranked.join(kinds.where(F.col("n") > 1).select("name", "stretch", "first"), ["name", "stretch"]).where((F.col("doc") != F.col("first.doc")) | (F.col("lo") != F.col("first.lo")))
    whole = ws.save(whole.select("doc", F.col("lo").alias("start"), (F.col("lo") + more + threshold).alias("end")), "whole")
    ws.drop(ranked)

    def shared(side: str) -> DataFrame:
        again = kinds.where(F.col(side) != 0).groupBy("name", side).agg(F.count("*").alias("k")).where(F.col("k") > 1).select("name", side)
        return kinds.where(F.col(side) != 0).join(again, ["name", side], "left_semi").select("first.*")

    pivot = F.col("lo") + F.shiftright("shape", 16) - F.lit(half)
    right = shared("right").select("doc", F.greatest("lo", pivot).alias("lo"), (F.col("lo") + more).alias("to"))
    left = shared("left").select("doc", "lo", F.least(F.col("lo") + more, pivot).alias("to"))
    runs = right.unionAll(left).where(F.col("lo") <= F.col("to")).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("lo", "to"))).alias("runs"))
    texts = raw.join(runs, "doc").select("doc", "raw", "runs")

    def combined(docs: list, starts: list, digests: bytearray) -> pa.RecordBatch:
        """The windows with a mark at those that this batch has earlier already (they need no further comparison)."""
        doc, lo = np.array(docs, np.int64), np.array(starts, np.int64)
        one, two = np.frombuffer(bytes(digests), np.int64).reshape(-1, 2).T
        order = np.lexsort((lo, doc, two, one))
        later = np.zeros(len(doc), bool)
        later[order[1:]] = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo), pa.array(np.ascontiguousarray(one)), pa.array(np.ascontiguousarray(two)), pa.array(later)], names=["doc", "lo", "w1", "w2", "later"])

    def windows(batches):
        digest = xxhash.xxh3_128_digest
        docs, starts, digests = [], [], bytearray()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    raw, done = row["raw"], -1
                    for run in row["runs"]:
                        for s in range(max(run["lo"], done + 1), run["to"] + 1):
                            digests += digest(raw[s : s + threshold])
                            starts.append(s)
                            done = s
                    docs.extend([row["doc"]] * (len(starts) - len(docs)))
                if len(starts) >= WINDOWS:
                    yield combined(docs, starts, digests)
                    docs, starts, digests = [], [], bytearray()
        if starts:
            yield combined(docs, starts, digests)

    # What is known to be later is dealt out by itself, so that a passage in very many texts meets once a batch.
    single = in_arrow(texts, windows, "doc long, lo long, w1 long, w2 long, later boolean")
    single = single.withColumn("deal", F.when(F.col("later"), F.xxhash64("doc", "lo")).otherwise(F.lit(0)))
    place = F.row_number().over(W.partitionBy("w1", "w2", "deal").orderBy("doc", "lo"))
    later = single.withColumn("place", place).where(F.col("later") | (F.col("place") > 1))
    later = ws.save(later.select("doc", F.col("lo").alias("start"), (F.col("lo") + threshold).alias("end")), "later")
    out = whole.unionAll(later).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    out = ws.save(out, "spans")
    ws.drop(kinds, whole, later)
    return out


def merged(ranges: list[dict]) -> list[tuple[int, int]]:
    """Sorted ranges as maximal runs; ranges that touch are one."""
    out: list[list[int]] = []
    for r in ranges:
        if out and r["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["end"])
        else:
            out.append([r["start"], r["end"]])
    return [(a, b) for a, b in out]


def cut(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for start, end in runs:
        kept.append(raw[at:start])
        at = end
    kept.append(raw[at:])
    return b"".join(kept)


def with_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """All rows and columns, the row key __k_row and __k_spans: the ranges to remove, or null."""
    ws = Workspace(docs.sparkSession, "suffix")
    rows = keyed(docs, ws, doc_id, text)
    found = spans(rows, ws, threshold, text).withColumnRenamed("doc", "__k_doc").withColumnRenamed("spans", "__k_spans")
    return rows.join(found, F.col("__k_row") == F.col("__k_doc"), "left").drop("__k_doc")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty, and a text under the threshold loses nothing. Rows are ordered by
    doc_id (nulls last, then by text), so of repeated rows the first is the earlier one and
    stays. Texts are judged on the input, at any length.
    """
    kind = dict(docs.dtypes)[doc_id]
    rows = with_spans(docs, doc_id, text, threshold).select(F.col(doc_id).alias("doc_id"), utf8(text).alias("raw"), F.col("__k_spans").alias("spans"))

    def of(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                size, gone, count, digest = [], [], [], []
                for raw, ranges in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    runs = merged(ranges or [])
                    size.append(len(raw))
                    gone.append(sum(b - a for a, b in runs))
                    count.append(len(runs))
                    digest.append(hashlib.sha256(cut(raw, runs)).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in (size, gone, count)), pa.array(digest, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return in_arrow(rows, of, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The documents with later repeats of ``threshold`` bytes cut out of their texts.

    A cut inside a character of several bytes takes the rest of that character too, so texts
    stay valid. Rows whose text is empty after a cut are kept; null texts stay null.
    """
    held = with_spans(docs, doc_id, text, threshold)
    columns = docs.columns
    rows = held.select(*columns, "__k_spans")
    at = columns.index(text)

    def of(batches):
        for batch in batches:
            new = [raw if raw is None or not ranges else cut(raw.encode(), merged(ranges)).decode("utf-8", "ignore") for raw, ranges in zip(batch.column(at).to_pylist(), batch.column(len(columns)).to_pylist())]
            arrays = [pa.array(new, pa.string()) if i == at else batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return in_arrow(rows, of, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes))
