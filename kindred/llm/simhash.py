"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two 32-bit segments. Two fingerprints that differ in at most
two bits either agree in the low segment or differ in at most one bit of the high one,
so the Hamming ball of radius one around the high segment (33 values) and the low
segment itself are the probes. They are looked up in the table of segment values, and
every match is verified on all 64 bits.

A segment value that very many different fingerprints share would make all pairs of
them candidates. Such a bucket stands in the table as one marker row, and every
fingerprint that probes it is linked through its full ball instead: two fingerprints
differ in at most two bits exactly if their 64-bit balls of radius one meet, and at
most 65 fingerprints can share a ball point. That is exact, linear in the number of
fingerprints, and needs no cap.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import Workspace, in_arrow, keyed, map_arrow, merged, utf8
from ._graph import components

RADIUS = 2
BLOCK = 1 << 16


def fingerprint(raw: bytes, width: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, as an unsigned integer.

    A-Z are lower-cased, words end at ASCII white space, shingles count as often as they
    occur. Fewer words than ``width`` make one shingle; no word makes fingerprint zero.
    """
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - width + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        to = min(n, at + BLOCK)
        hashes = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at:to], ends[at + width - 1 : to + width - 1])], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(key, fp long): the fingerprint of every row, null and empty texts included (zero)."""
    kind = dict(docs.dtypes)[key]

    def of(batch: pa.RecordBatch):
        seen: dict[bytes, int] = {}
        out = []
        for raw in batch.column(1).to_pylist():
            if (fp := seen.get(raw)) is None:
                fp = seen[raw] = fingerprint(raw, width)
            out.append(fp)
        fps = pa.array(np.array(out, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), fps], names=["id", "fp"])

    return map_arrow(docs.select(F.col(key).alias("id"), utf8(text).alias("raw")), of, f"id {kind}, fp long")


def link_fingerprints(fps: DataFrame, bucket: int = 64) -> DataFrame:
    """(u, v) links that join exactly the distinct fingerprints within RADIUS bits.

    Where a bucket holds more than ``bucket`` fingerprints, the links are those to the
    smallest fingerprint at each ball point: as many links as members instead of their
    square, and the same components.
    """
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    part = lambda seg, value: F.struct(F.lit(seg).alias("seg"), value.alias("val"))
    table = fps.select("fp", F.inline(F.array(part(0, high), part(1, low))))
    counts = table.groupBy("seg", "val").agg(F.count("*").alias("n"))
    members = table.join(merged(counts.where(F.col("n") <= bucket)), ["seg", "val"]).select("seg", "val", F.col("fp").alias("other"))
    markers = counts.where(F.col("n") > bucket).select("seg", "val", F.lit(None).cast("long").alias("other"))
    ball = [part(0, high), *(part(0, high.bitwiseXOR(F.lit(1 << i))) for i in range(32)), part(1, low)]
    probes = fps.select("fp", F.inline(F.array(*ball)))
    found = probes.join(merged(members.unionAll(markers)), ["seg", "val"]).where(F.col("other").isNull() | ((F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= RADIUS)))
    return found.select("fp", "other")


def hot_links(found: DataFrame) -> DataFrame:
    """(u, v) for the fingerprints that met a marker: each ball point's smallest one with the rest."""
    points = [F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64))]
    hot = found.where(F.col("other").isNull()).select("fp").distinct()
    balls = hot.select("fp", F.explode(F.array(*points)).alias("point"))
    shared = balls.groupBy("point").agg(F.min("fp").alias("v"), F.collect_list("fp").alias("all")).where(F.size("all") > 1)
    return shared.select("v", F.explode("all").alias("u")).where(F.col("u") != F.col("v")).select("u", "v")


def classes(docs: DataFrame, ws: Workspace, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(id, fp, component): every row with the smallest id that it reaches by links.

    Equal fingerprints are one node, so copies cost one row each and no pairs. A null id
    never becomes a component id unless the whole component has no other; repeated ids
    share what they share. An empty table gives an empty result.
    """
    rows = ws.save(fingerprints(docs, key, text, width), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    found = ws.save(link_fingerprints(nodes.select("fp")), "found")
    links = found.where(F.col("other").isNotNull()).select(F.col("fp").alias("u"), F.col("other").alias("v")).unionAll(hot_links(found))
    roots = components(links, ws)
    ws.drop(found)
    labelled = nodes.join(merged(roots), nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("least").alias("component"))
    by_fp = ws.save(labelled.join(merged(least), "root").select("fp", "component"), "components")
    return rows.join(merged(by_fp), "fp").select("id", "fp", "component")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest linked doc_id)."""
    found = classes(docs, Workspace(docs.sparkSession, "simhash"), doc_id, text, width)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


# Near copies by similarity ------------------------------------------------------------------


#: Longs of a parity bitmap: bit i says whether an odd number of a set's hashes end in i. Two sets
#: differ in at least as many members as their bitmaps do in bits.
PARITY = 32
#: A shingle in so many different texts of a batch of 512 is a common one; so many common ones are kept.
OFTEN, COMMON = 4, 100_000
#: Pairs of 16 bytes whose ids are broadcast at most.
BROADCAST_PAIRS = 1_000_000


def shingle_hashes(raw: bytes, width: int) -> np.ndarray:
    """XXH64 of every shingle of a text (repeats included), in blocks; none for a text without words."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    last = ends[width - 1 :] if len(words) >= width else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[s:e], 42) for s, e in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The ``fingerprint`` of a text with these hashes of shingles."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        counts += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist()))


def at_least(share: float, n: int) -> int:
    """The smallest whole number that is ``share`` of n or more."""
    return math.ceil(share * n - 1e-9)


def signature(raw: bytes, width: int, similarity: float, common: np.ndarray) -> tuple[bytes, int, bytes, np.ndarray, int]:
    """Of a text's set of shingles: digest, size, parity bitmap, the keys that it probes, how many of them it owns.

    Sets in one order that share ``o`` members share one among the first ``size - o + 1`` of
    each. The order is that of the hashes, those in ``common`` (sorted) behind all others. A set of n shares at least ``similarity * n`` with a similar one,
    and ``2 * similarity / (1 + similarity) * n`` with one that isn't smaller. So of two
    similar sets the larger one probes a key that the smaller one owns.
    """
    return _signature(shingle_hashes(raw, width), similarity, common)


def _signature(hashes: np.ndarray, similarity: float, common: np.ndarray) -> tuple[bytes, int, bytes, np.ndarray, int]:
    found = np.unique(hashes)
    n = len(found)
    odd = np.bincount((found & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
    parity = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    probed = n and n - at_least(similarity, n) + 1
    owned = n and n - at_least(2 * similarity / (1 + similarity), n) + 1
    digest = xxhash.xxh3_128_digest(found.tobytes())
    if len(common):
        last = common[np.minimum(np.searchsorted(common, found), len(common) - 1)] == found
        found = np.concatenate([found[~last], found[last]])
    return digest, n, parity, found[:probed].view(np.int64), owned


def common_shingles(rows: DataFrame, text: str, width: int) -> np.ndarray:
    """Sorted hashes of the shingles that most of the texts share: at most COMMON, chosen by a count over all texts.

    Counted in each batch, where fewer than OFTEN different texts with a shingle don't count. Which
    ones are found is a matter of speed only: no pair is lost whatever the order of the keys.
    """

    def often(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = [np.unique(shingle_hashes(raw, width)) for raw in set(batch.column(0).slice(at, 512).to_pylist())]
                found, counts = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found[counts >= OFTEN].view(np.int64)), pa.array(counts[counts >= OFTEN])], names=["k", "n"])

    counted = in_arrow(rows.select(utf8(text).alias("raw")), often, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    return np.sort(counted.orderBy(F.desc("n"), "k").limit(COMMON).select("k").toArrow().column("k").to_numpy().view(np.uint64))


def _may_be_similar(n: str, m: str, differ: Column, similarity: float) -> Column:
    """Whether sets of these sizes that differ in so many members at least can be similar."""
    n, m = F.col(n), F.col(m)
    return (F.least(n, m) >= F.lit(similarity) * F.greatest(n, m)) & (differ <= F.lit((1 - similarity) / (1 + similarity)) * (n + m) + F.lit(1e-6))


def _apart(left: str, right: str, words: int) -> Column:
    """How many bits two bitmaps, in columns of 64 bits, differ in."""
    out = F.lit(0)
    for w in range(words):
        out = out + F.bit_count(F.col(f"{left}{w}").bitwiseXOR(F.col(f"{right}{w}")))
    return out


def prints_of(rows: DataFrame, key: str, text: str, width: int, similarity: float) -> DataFrame:
    """(id, d0, d1, size, fp, f0 ..., probes, owned) of every row: the SimHash fingerprint and the ``signature`` in columns."""
    sent = rows.sparkSession.sparkContext.broadcast(common_shingles(rows, text, width))
    names = [f"f{w}" for w in range(PARITY)]

    def hashed(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                seen: dict[bytes, tuple] = {}
                out = []
                for raw in part.column(1).to_pylist():
                    if raw not in seen:
                        hashes = shingle_hashes(raw, width)
                        seen[raw] = (*_signature(hashes, similarity, sent.value), majority(hashes))
                    out.append(seen[raw])
                digests = np.frombuffer(b"".join(x[0] for x in out), np.int64).reshape(len(out), 2)
                parity = np.frombuffer(b"".join(x[2] for x in out), np.int64).reshape(len(out), PARITY)
                columns = [digests[:, 0], digests[:, 1], np.array([x[1] for x in out]), np.array([x[5] for x in out], np.uint64).view(np.int64), *(parity[:, w] for w in range(PARITY))]
                probes = pa.array([x[3] for x in out], pa.list_(pa.int64()))
                owned = pa.array([x[4] for x in out], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(np.ascontiguousarray(c)) for c in columns), probes, owned], names=["id", "d0", "d1", "size", "fp", *names, "probes", "owned"])

    source = rows.select(F.col(key).alias("id"), utf8(text).alias("raw"))
    return in_arrow(source, hashed, f"id long, d0 long, d1 long, size long, fp long, {', '.join(f'{n} long' for n in names)}, probes array<long>, owned int")


def meetings(nodes: DataFrame, ws: Workspace) -> DataFrame:
    """(k, node, own): who probes or owns the keys at which two or more nodes meet, an owner among them.

    Keys with the same nodes and owners are one: near copies share whole runs of keys.
    """
    rows = nodes.select(F.col("id").alias("node"), "owned", F.posexplode("probes").alias("at", "k")).select("k", "node", (F.col("at") < F.col("owned")).alias("own"))
    shared = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("own").alias("own")).where("n > 1 and own").select("k")
    found = ws.save(rows.join(shared, "k"), "meetings")
    mark = lambda n: F.bit_xor(F.xxhash64("node", "own", F.lit(n)))
    who = found.groupBy("k").agg(F.count("*").alias("n"), mark(1).alias("a"), mark(2).alias("b"))
    once = who.groupBy("n", "a", "b").agg(F.min("k").alias("k")).select("k")
    out = ws.save(found.join(once, "k", "left_semi"), "meetings-once")
    ws.drop(found)
    return out


def simhash_links(nodes: DataFrame, rows: DataFrame, ws: Workspace, key: str, text: str, width: int, similarity: float) -> DataFrame:
    """(u, v): nodes (id, fp, ...) whose SimHash fingerprints link (``link_fingerprints``) and whose shingle sets are similar.

    Each fingerprint is met by its smallest node, with which the others of that fingerprint are compared.
    """
    fps = ws.save(nodes.select("id", "fp"), "fingerprints")
    least = fps.groupBy("fp").agg(F.min("id").alias("least"))
    found = ws.save(link_fingerprints(least.select("fp")), "found")
    links = found.where(F.col("other").isNotNull()).select(F.col("fp").alias("a"), F.col("other").alias("b")).unionAll(hot_links(found))
    of = lambda x, node: least.select(F.col("fp").alias(x), F.col("least").alias(node))
    pairs = links.join(of("a", "u"), "a").join(of("b", "v"), "b").select("u", "v").unionAll(fps.join(least, "fp").where("id <> least").select("id", "least"))
    out = _similar(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), rows, ws, key, text, width, similarity)
    ws.drop(fps, found)
    return out


def near_copies(rows: DataFrame, ws: Workspace, key: str, text: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id, root): every row that has a near copy, with the smallest row key among its linked ones; roots excepted.

    Near copies are texts whose sets of ``width``-word shingles have a Jaccard similarity of
    ``similarity`` or more. Candidates are those whose SimHash fingerprints link (``simhash_links``), and, as
    that loses some, those that share a shingle of their prefixes (``signature``), which all
    such pairs do; every link is verified on the shingles. Texts of equal sets are one node. A
    bucket's members are first compared with its most central owner only (the one whose keys most
    others have), so a bucket of very many near copies costs about as many rows as members. What is
    left are buckets of several components: the members of the component that most belong to
    need no comparison with each other, any other member is compared with that whole component
    once, whatever the number of buckets in which they meet, and with the bucket's other members.
    No link that joins two components is left out. Null and empty texts are one group: equal
    texts are copies.
    """
    names = [f"f{w}" for w in range(PARITY)]
    prints = ws.save(prints_of(rows, key, text, width, similarity), "prints")
    members = ws.save(prints.select("id", "d0", "d1").join(prints.groupBy("d0", "d1").agg(F.min("id").alias("node")), ["d0", "d1"]).select("id", "node"), "members")
    nodes = prints.join(members.where("id <> node"), "id", "left_anti")
    by_simhash = simhash_links(nodes, rows, ws, key, text, width, similarity)
    found = meetings(nodes, ws)
    # Who meets no one needs no more columns. The bitmap folded to 64 bits goes with every meeting.
    info = ws.save(nodes.join(found.select(F.col("node").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("node"), "size", *names), "info")
    ws.drop(prints)
    meet = ws.save(found.join(info.select("node", "size", F.expr(" ^ ".join(names)).alias("s")), "node"), "meet")
    ws.drop(found)
    side = lambda x, df=info: df.select(F.col("node").alias(x), F.col("size").alias(f"{x}size"), *(F.col(n).alias(f"{x}{i}") for i, n in enumerate(names)))
    alike = _may_be_similar("size", "vsize", F.bit_count(F.col("s").bitwiseXOR(F.col("vs"))), similarity)
    close = _may_be_similar("usize", "vsize", _apart("u", "v", PARITY), similarity)
    pair = (F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))

    def linked(met: DataFrame) -> DataFrame:
        """The links among the pairs (node, v)."""
        pairs = ws.save(met.select(F.col("node").alias("u"), "v").select(*pair).distinct(), "met")
        out = _similar(pairs.join(side("u"), "u").join(side("v"), "v").where(close).select("u", "v"), rows, ws, key, text, width, similarity)
        ws.drop(pairs)
        return out

    def joined(links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(node, root), the meetings with their roots, and (k, main): the root that most have, of buckets of several."""
        roots = ws.save(info.select("node").join(components(links, ws), "node", "left").withColumn("root", F.coalesce("root", "node")), "roots")
        rooted = meet.join(roots, "node")
        parts = rooted.groupBy("k", "root").agg(F.count("*").alias("c")).groupBy("k").agg(F.count("*").alias("m"), F.max_by("root", F.struct("c", "root")).alias("main"))
        return roots, rooted, parts.where("m > 1").select("k", "main")

    # First, beside what SimHash has linked, each bucket's most central owner with all that meet there.
    sizes = meet.where("own").groupBy("k").agg(F.count("*").alias("n"))
    weights = meet.where("own").join(sizes, "k").groupBy("node").agg(F.sum("n").alias("weight"))
    best = meet.where("own").join(weights, "node").groupBy("k").agg(F.max(F.struct("weight", -F.col("node"), F.col("node").alias("v"), F.col("size").alias("vsize"), F.col("s").alias("vs"))).alias("best"))
    links = by_simhash.unionAll(linked(meet.join(best.select("k", "best.v", "best.vsize", "best.vs"), "k").where((F.col("node") != F.col("v")) & alike)))

    # Then, for those that this hasn't joined to a bucket's main component, any one of that component.
    roots, rooted, parts = joined(links)
    some = rooted.join(parts, "k").where("root = main").groupBy("k").agg(F.min_by(F.struct(F.col("node").alias("v"), F.col("size").alias("vsize"), F.col("s").alias("vs")), F.xxhash64("k", "node")).alias("one"))
    links = links.unionAll(linked(rooted.join(parts, "k").where("root <> main").join(some.select("k", "one.v", "one.vsize", "one.vs"), "k").where(alike)))
    ws.drop(roots)

    # Last, all that is still apart.
    roots, rooted, parts = joined(links)
    odd = ws.save(rooted.join(parts, "k").where("root <> main").select("k", "node", "own", "root", "main"), "odd")
    asked = odd.select(F.col("node").alias("u"), "main").distinct().join(side("u"), "u")
    of_main = side("v").join(roots.select(F.col("node").alias("v"), F.col("root").alias("main")), "v")
    with_main = asked.join(of_main, "main").where(close).select("u", "v")
    full = lambda x, df: df.select(F.col("k").alias(f"{x}k"), F.col("node").alias(x), F.col("root").alias(f"{x}root")).join(side(x), x)
    others = full("u", odd).join(full("v", odd.where("own")), (F.col("uk") == F.col("vk")) & (F.col("uroot") != F.col("vroot")) & close).select("u", "v")
    more = _similar(with_main.unionAll(others).select(*pair).distinct(), rows, ws, key, text, width, similarity)
    joint = components(links.unionAll(more), ws)
    ws.drop(meet, info, odd, roots)
    return members.join(joint.withColumnRenamed("node", "jn"), F.col("node") == F.col("jn"), "left").select("id", F.coalesce("root", "node").alias("root")).where("id <> root")


def _similar(near: DataFrame, rows: DataFrame, ws: Workspace, key: str, text: str, width: int, similarity: float) -> DataFrame:
    """Those of the pairs (u, v) whose shingle sets are similar.

    Pairs first meet with bitmaps of four bits a shingle, and only those that these leave with the sets.
    """
    near = ws.save(near, "near")
    wanted = near.select(F.col("u").alias("w")).unionAll(near.select("v")).distinct()
    # Few ids go to the texts; beyond that bound texts and ids are joined by a shuffle.
    wanted = F.broadcast(wanted) if near.count() <= BROADCAST_PAIRS else wanted

    def sets(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [np.unique(shingle_hashes(raw, width)) for raw in part.column(1).to_pylist()]
                parity = []
                for hashes in found:
                    bits = 64 << max(0, (len(hashes) - 1) // 16).bit_length()
                    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
                    parity.append(np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64))
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array(parity, longs), pa.array([x.view(np.int64) for x in found], longs)], names=["id", "n", "p", "s"])

    source = rows.select(F.col(key).alias("id"), utf8(text).alias("raw"))
    shingles = ws.save(in_arrow(source.join(wanted, F.col("id") == F.col("w"), "left_semi"), sets, "id long, n long, p array<long>, s array<long>"), "shingles")
    of = lambda x, *names: shingles.select(F.col("id").alias(x), *(F.col(n).alias(f"{n}{x}") for n in names))

    def folded(own: str, other: str) -> Column:
        """A bitmap folded to the length of the other; sets that can be similar differ in one doubling at most."""
        half = (F.size(own) / 2).cast("int")
        halves = F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(own) > F.size(other), halves).otherwise(F.col(own))

    fits = F.least("nu", "nv") >= F.lit(similarity) * F.greatest("nu", "nv")
    differ = F.aggregate(F.zip_with(folded("pu", "pv"), folded("pv", "pu"), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    light = near.join(of("u", "n", "p"), "u").join(of("v", "n", "p"), "v")
    likely = ws.save(light.where(F.when(fits, _may_be_similar("nu", "nv", differ, similarity)).otherwise(F.lit(False))).select("u", "v"), "likely")
    common = F.size(F.array_intersect("su", "sv"))
    checked = likely.join(of("u", "s"), "u").join(of("v", "s"), "v").where(common >= F.lit(similarity) * (F.size("su") + F.size("sv") - common))
    out = ws.save(checked.select("u", "v"), "similar")
    ws.drop(near, shingles, likely)
    return out


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents without near copies: of each group the first row (by doc_id, then text) stays.

    All columns of the input are kept as they are. Rows with null ids come last, repeated rows
    are copies, and all null and empty texts are one group.
    """
    ws = Workspace(docs.sparkSession, "near-copies")
    rows = keyed(docs, ws, doc_id, text)
    gone = ws.save(near_copies(rows, ws, "__k_row", text, width, similarity).select(F.col("id").alias("__k_gone")), "gone")
    return rows.join(gone, F.col("__k_row") == F.col("__k_gone"), "left_anti").select(*docs.columns)
