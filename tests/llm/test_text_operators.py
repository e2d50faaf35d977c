"""SimHash, line dedup, suffix dedup and packing against brute force, with the odd cases of each."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindred.llm import line_dedup, packing, simhash, suffix_dedup
from kindred.llm._common import Workspace
from kindred.llm._graph import components

BYTE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
FIELDS = "doc_id long, text string, source string, component long, spans string"
LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(3000))
ODD = [
    (1, None, "a", 1, "x"),
    (2, "", "a", 1, "x"),
    (3, " \t\n", "a", 1, None),
    (4, "one", "a", None, "x"),
    (5, "One", None, 1, "x"),
    (6, "one two", "b", 1, "x"),
    (7, LONG, "b", 1, "x"),
    (7, LONG, "b", 1, "x"),
    (8, LONG + " more", "b", 1, "x"),
    (None, "no id at all", "b", 1, "x"),
    (None, None, None, None, None),
    (9, "a" * 400, "c", 1, "x"),
    (10, "é" * 150 + LONG[:200], "c", 1, "x"),
]


def odd(spark):
    return spark.createDataFrame(ODD, FIELDS).repartition(3)


def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(50, 51), (51, 51)], [(i, (i * 7 + 3) % 90) for i in range(90)]])
def test_components(spark, links):
    rows = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.root for r in components(rows, Workspace(spark, "t")).collect()}
    want = roots({x for pair in links for x in pair}, links)
    assert got == {n: r for n, r in want.items() if n != r}


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split() if w]
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> i & 1 for s in shingles) for i in range(64)]
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(shingles))


def test_fingerprints_are_those_of_the_contract(spark, small):
    docs = documents(spark, small)
    got = {r.doc_id: int(r.fingerprint, 16) for r in simhash.near_duplicates(docs).collect()}
    assert got == {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}


@pytest.mark.parametrize("bucket", [0, 2, 64])
def test_simhash_components(spark, bucket, monkeypatch):
    rng = np.random.Generator(np.random.PCG64(3))
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    prints = {b ^ sum(1 << int(i) for i in rng.choice(64, n, replace=False)) for b in base for n in (0, 1, 1, 2, 3, 4, 5) for _ in range(4)} | {0, 1, 3, 7, (1 << 64) - 1}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.link_fingerprints(spark.createDataFrame([(p,) for p in signed], "fp long"), bucket)
    links = found.where("other is not null").select(F.col("fp").alias("u"), F.col("other").alias("v")).unionAll(simhash.hot_links(found))
    got = {r.node: r.root for r in components(links, Workspace(spark, "t")).collect()}
    near = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2]
    want = roots(signed, near)
    assert {n: got.get(n, n) for n in signed} == want


def test_simhash_odd_cases(spark):
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(odd(spark)).collect()]
    assert len(got) == len(ODD)
    zero = {(d, c) for d, f, c in got if f == "0" * 16}
    assert zero == {(1, 1), (2, 1), (3, 1), (None, 1)}
    assert {c for d, _, c in got if d in (4, 5)} == {4} and {c for d, _, c in got if d == 7} == {7}
    assert simhash.near_duplicates(odd(spark).limit(0)).count() == 0


def test_near_copies_equal_all_pairs(spark, small):
    docs = documents(spark, small).select("doc_id", "text").unionAll(spark.createDataFrame([(10_000 + i, LONG + f" tail{i}" + LONG[: 40 * i]) for i in range(40)], "doc_id long, text string"))
    kept = sorted(r.doc_id for r in simhash.keep_one(docs).collect())
    sets = {r.doc_id: frozenset(simhash.shingle_hashes((r.text or "").encode(), 5).tolist()) for r in docs.collect()}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert kept == sorted(set(roots(ids, links).values()))


def tails(common: int, left: int, right: int, pairs: int = 60) -> list[tuple[int, str]]:
    """Pairs of texts whose sets of five-word shingles share ``common`` members and have so many of their own."""
    out = []
    for n in range(pairs):
        words = lambda tag, k: [f"{tag}{n}x{common}x{left}x{right}x{i}" for i in range(k)]
        out += [(2 * n, " ".join(words("w", common + 4) + words("l", left))), (2 * n + 1, " ".join(words("w", common + 4) + words("r", right)))]
    return out


# Similarities of 0.8 and just above, from 4 shingles to 1,000.
@pytest.mark.parametrize("common, left, right", [(4, 0, 1), (5, 0, 1), (8, 1, 1), (12, 1, 2), (16, 2, 2), (64, 8, 8), (240, 30, 30), (800, 100, 100)])
def test_no_pair_is_lost_at_the_limit(spark, common, left, right):
    docs = spark.createDataFrame(tails(common, left, right), "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == list(range(0, 120, 2))


def test_pairs_below_the_limit_stay(spark):
    assert simhash.keep_one(spark.createDataFrame(tails(7, 1, 1) + [(1000 + i, t) for i, t in tails(3, 0, 1)], "doc_id long, text string")).count() == 240


def test_keep_one_odd_cases(spark):
    kept = simhash.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns
    # One of the empty texts, one of "one", one of the long ones; the others are alone.
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect()) == [-1, 1, 4, 6, 7, 9, 10]
    assert simhash.keep_one(odd(spark).limit(0)).count() == 0


def test_lines(spark):
    rows = [(i, f"head\nbody {i}\n foot \n", "x") for i in range(40)] + [(100, "head\nonly", "y"), (101, None, "x"), (102, "foot", None), (103, "foot", None), (104, "foot", None), (105, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(docs, counts=("n", "gone")).collect()}
    assert got[3].text == "body 3\n" and (got[3].n, got[3].gone) == (4, 2)
    assert got[100].text == "head\nonly" and got[101].text is None and got[102].text == "" and got[105].text == ""
    assert len(got) == len(rows)
    assert line_dedup.drop_boilerplate(docs.limit(0)).count() == 0
    twice = line_dedup.drop_boilerplate(odd(spark))
    assert twice.columns == odd(spark).columns and twice.count() == len(ODD)


def brute_repeats(rows, n=100):
    seen, out = set(), []
    for doc, text in rows:
        raw = (text or "").encode()
        mark = bytearray(len(raw))
        for s in range(len(raw) - n + 1):
            if (w := raw[s : s + n]) in seen:
                mark[s : s + n] = b"\1" * n
            else:
                seen.add(w)
        runs = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        out.append((doc, len(raw), sum(mark), runs, hashlib.sha256(bytes(b for b, m in zip(raw, mark) if not m)).hexdigest()))
    return out


def test_suffix_dedup_equals_brute_force(spark, small):
    docs = documents(spark, small).select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    texts = [t for _, t in rows]
    rows += [(10_000, "a" * 350), (10_001, None), (10_002, ""), (10_003, texts[3]), (10_004, "é" * 120 + texts[5][:300] + "b" * 99), (10_005, "ab" * 200), (10_006, texts[7][50:149]), (10_007, texts[7][50:150]), (10_008, texts[9][:140] + "!" + texts[9][140:320])]
    got = suffix_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(brute_repeats(rows))


def test_suffix_dedup_in_small_parts(spark, small, monkeypatch):
    """Long texts are ranked in overlapping parts, windows compared in small batches."""
    data = np.frombuffer((LONG * 3).encode(), np.uint8)
    t, place, lo, last, name = suffix_dedup.anchors(data, np.array([0, len(data)]))
    assert lo[0] == 0 and last[-1] == len(data) - 100 and (lo[1:] == last[:-1] + 1).all()
    assert ((place >= last) & (place + suffix_dedup.GRAM <= lo + 100)).all()


def test_suffix_dedup_odd_cases(spark):
    got = Counter((r.doc_id, r.n_removed) for r in suffix_dedup.digests(odd(spark)).collect())
    assert sum(got.values()) == len(ODD)
    size = len(LONG.encode())
    assert got[7, 0] == 1 and got[7, size] == 1 and got[9, 400] == 0
    kept = suffix_dedup.remove_repeats(odd(spark))
    assert kept.columns == odd(spark).columns and kept.count() == len(ODD)
    assert suffix_dedup.digests(odd(spark).limit(0)).count() == 0


def test_byte_tokens_equal_the_library(spark, small):
    texts = [r.text for r in documents(spark, small).collect()] + ["", " ", "a  b", "x\n y", "x \ny", " a", "trail ", "tab\t\tz", "a<|endoftext|> b", "　x　 y", "中文 字", "é x ́", "it's I'LL", "a\x1cb c\x85 d"]
    coder = packing.ByteTokenizer(*BYTE)
    library = Tokenizer.from_file(BYTE[0])
    for _ in range(2):
        for text, ids in zip(texts, coder.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text[:60])


def test_pieces_hold_the_ids(spark, small):
    docs = documents(spark, small).select("doc_id", "text")
    library = Tokenizer.from_file(BYTE[0])
    got = defaultdict(dict)
    for r in packing.pack(docs, *BYTE).collect():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        got[r.doc_id][r.start] = r.ids
    for doc in docs.collect():
        ids = [i for _, part in sorted(got[doc.doc_id].items()) for i in part]
        assert ids == [*library.encode(doc.text or "", add_special_tokens=False).ids, packing.END_ID]


def test_packing_keeps_every_token_once(spark, small):
    docs = documents(spark, small).select("doc_id", "text").unionAll(odd(spark).where("doc_id is not null").dropDuplicates(["doc_id"]).select(F.col("doc_id") + 10_000, "text"))
    rows = packing.pack(docs, *BYTE).collect()
    library = Tokenizer.from_file(BYTE[0])
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for doc in docs.collect():
        ids = [*library.encode(doc.text or "", add_special_tokens=False).ids, packing.END_ID]
        at = 0
        for r in sorted(pieces[doc.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    fills = []
    for rows_ in windows.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        fills.append(at)
    assert max(fills) <= 2048 and sum(f < 2048 for f in fills) <= docs.rdd.getNumPartitions()
    assert packing.pack(odd(spark), *BYTE).where("doc_id is null").count() == 2
    assert packing.pack(odd(spark).limit(0), *BYTE).count() == 0


def test_sum_of_squares_chooses_the_least(spark):
    rng = np.random.Generator(np.random.PCG64(1))
    packer = packing.Packer(64, 0)
    for doc in range(3000):
        rest = int(rng.integers(1, 64))
        counts = packer.levels.copy()

        def squares(level):
            after = counts.copy()
            if level:
                after[level] -= 1
            if level + rest < 64:
                after[level + rest] += 1
            return int((after[1:64] ** 2).sum())

        open_ = [h for h in range(1, 64 - rest + 1) if counts[h] > 0]
        best = min(squares(h) for h in [0, *open_])
        assert squares(packer.level_for(rest)) == best
        list(packer.put(doc, bytes(4 * rest)))
    left = list(packer.close())
    sums = Counter()
    for piece in left:
        sums[piece[4]] += len(piece[2]) // 4
    assert sum(v < 64 for v in sums.values()) <= 1


def test_fingerprint_joins_are_never_broadcast(spark, small):
    """The files of fingerprints are small, what the driver would build of them isn't."""
    ws = Workspace(spark, "joins")
    fps = ws.save(simhash.fingerprints(documents(spark, small)).select("fp").distinct(), "fps")
    for df in (simhash.link_fingerprints(fps), simhash.near_duplicates(documents(spark, small))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_prints_hold_the_fingerprint(spark):
    """Near-dedup takes fingerprints from its one pass over the texts, and reads no text to link them."""
    docs = odd(spark).where("doc_id is not null").select("doc_id", "text").distinct()
    prints = simhash.prints_of(docs, "doc_id", "text", 5, 0.8)
    assert sorted(map(tuple, prints.select("id", "fp").collect())) == sorted(map(tuple, simhash.fingerprints(docs, width=5).collect()))
