"""URL filter, BPE, embeddings, media, sharding and quality, with the odd cases of each."""

import hashlib
import io
import os
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kindred.llm import bpe, embed_dedup, media, quality, sharding, url_filter
from kindred.llm.queries import ORACLES, QUERIES

WORD = public_tokenizers.path("word_bpe_49k.json")


def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


# URL filter


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[: min([rest.find(x) for x in "/?#" if x in rest] or [len(rest)])])
    rest = rest[len(host) :]
    return host, rest[: min([rest.find(x) for x in "?#" if x in rest] or [len(rest)])]


def plain_rule(host, path):
    fits = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)) if fits else None


URLS = [None, "", "no scheme", "http://", "http://NET/x", "http://a.net", "http://a.net/", "http://xnet/", "https://Example.NET/en/1?a=/b", "https://www.example.net/en", "http://a.example.com/de/#x", "x://y://z/a", "http://h?q/en", "http://É.net/", "http://a.org/fr/\nb", "http://" + "a" * 5000 + "/" + "b" * 5000]


def test_urls(spark, small):
    model = url_filter.train(spark)
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("clash"))
    known = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url")
    for rows in (pages, known):
        urls = {r.page_id: r.url for r in rows.collect()}
        got = url_filter.judge(rows, model).collect()
        assert len(got) == len(urls)
        for r in got:
            host, path = plain_parts(urls[r.page_id])
            rule = plain_rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
            assert r.verdict == (rule.verdict if rule else ("block" if r.block_probability >= 0.5 else "allow"))
    assert url_filter.judge(pages.limit(0), model).count() == 0


def test_classifier_tells_hosts_apart(spark):
    model = url_filter.train(spark)
    rows = [(0, "http://casino-royal.example.com/en/9"), (0, "https://m.cheap-pills.example.org/de/77.html"), (1, "https://blog.ththing.example.com/en/29347"), (1, "http://m.tiontion.example.com/fr/12"), (1, "https://newspaper.example.org/es/3/")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), model, rules=()).collect()
    assert [r.verdict for r in got] == ["allow" if r.page_id else "block" for r in got]


def test_block_probability_equals_a_plain_logistic_function(spark):
    model = url_filter.train(spark)
    terms, fitted = model.stages
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(URLS) if u is None or len(u) < 1000], "page_id long, url string")
    urls = {r.page_id: r.url for r in rows.collect()}
    for r in url_filter.judge(rows, model, rules=()).collect():
        grams = set()
        for mark, part in zip(("h:", "p:"), plain_parts(urls[r.page_id])):
            framed = f"^{part}$"
            grams |= {mark + framed[i : i + n] for n in (3, 4, 5) for i in range(len(framed) - n + 1)}
        z = fitted.intercept + sum(fitted.coefficients[i] for i in {terms.indexOf(g) for g in grams})
        assert abs(r.block_probability - 1 / (1 + np.exp(-z))) < 1e-9, urls[r.page_id]


def test_url_filter_on_hosts_that_the_table_lacks(spark):
    bad = {"casino-win", "adult-x", "spam-farm", "cheap-pills", "ads-track", "free-bets"}
    known = {name for name, _ in url_filter.host_names()}
    pages = QUERIES["op2_url_filter"](spark, "/root/testdata/sf0.1").where("rule is null").collect()
    names = {r.host.split(".example.")[0].split(".")[-1] for r in pages}
    assert not known & names and len(names & bad) >= 4
    counts = Counter((any(b in r.host for b in bad), r.verdict) for r in pages)
    assert counts[True, "block"] >= 0.9 * (counts[True, "block"] + counts[True, "allow"])
    assert counts[True, "block"] >= 0.9 * (counts[True, "block"] + counts[False, "block"])


def test_url_filter_is_native(spark, small):
    plan = QUERIES["op2_url_filter"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# BPE

LETTERS = st.text(st.sampled_from("abcdefghijklmnopqrstuvwxyzABC '0129.,!-<|>/éßñ中ΣİZ\n\t　́\x1c"), max_size=40)


@pytest.fixture(scope="module")
def word_models():
    return bpe.WordBpe(WORD), Tokenizer.from_file(WORD)


def both(models, text):
    own, library = models
    parts = own.encode([text])[0]
    ids = library.encode(text, add_special_tokens=False).ids
    return (np.frombuffer(b"".join(p[0] for p in parts), "<u4").tolist(), " ".join(p[1] for p in parts if p[0])), (ids, library.decode(ids, skip_special_tokens=False))


@given(LETTERS)
@settings(max_examples=400, deadline=None)
def test_bpe_equals_the_library_on_any_text(word_models, text):
    own, library = both(word_models, text)
    assert own == library
    assert bpe.decode_ids(word_models[0], own[0]) == library[1]


def test_bpe_equals_the_library_on_documents(spark, small, word_models):
    odd = ["<|endoftext|>a", "A<|startoftext|>", "<|ENDOFTEXT|>", "</w></w> w</w>", "a" * 3000, "ab" * 900, "", "  "]
    for text in [r.text for r in documents(spark, small).collect()] + odd:
        own, library = both(word_models, text)
        assert own == library


def test_bpe_rows(spark, small):
    rows = documents(spark, small).select("doc_id", "text").unionAll(spark.createDataFrame([(None, None), (1, "x y"), (1, "x y")], "doc_id long, text string"))
    got = bpe.encoded(rows, WORD).collect()
    library = Tokenizer.from_file(WORD)
    want = Counter()
    for r in rows.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want
    assert bpe.encoded(rows.limit(0), WORD).count() == 0


def test_bpe_of_a_million_letters_takes_little_memory():
    code = f"""
import resource, numpy as np
from kindred.llm import bpe
model = bpe.WordBpe({WORD!r})
start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
word = "".join(chr(97 + int(x)) for x in np.random.default_rng(1).integers(0, 26, 1_000_000))
ids, shown = model.encode([word])[0][0]
assert shown.replace("</w>", "").replace(" ", "") == word
assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start < 500_000
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], check=True, env=os.environ | {"PYTHONPATH": root})


def test_tokenized_keeps_ids_and_text(spark, small):
    docs = documents(spark, small).select("doc_id", "text").unionAll(spark.createDataFrame([(None, None), (-1, "")], "doc_id long, text string"))
    library = Tokenizer.from_file(WORD)
    want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect()}
    got = bpe.tokenized(docs, WORD).collect()
    assert {r.doc_id: r.ids for r in got} == want
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in got)


# Embeddings


def test_rows_that_share_an_id_but_not_the_vector(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    near = lambda v: [x + 0.01 for x in v]
    rows = spark.createDataFrame([(1, "x", a), (1, "x", b), (2, "x", near(a)), (3, "x", near(b))], "vec_id long, label string, embedding array<double>")
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in embed_dedup.near_duplicates(rows).collect())
    assert got == {(1, 1, 1): 2, (2, 1, 1): 1, (3, 1, 1): 1}


def brute_vectors(rows, limit=0.98):
    usable = {}
    for i, (vec, v, label) in enumerate(rows):
        if vec is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            x = x / np.abs(x).max()
            usable[i] = x / np.linalg.norm(x)
    parent = {i: i for i in range(len(rows))}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n = Counter()
    for i in usable:
        for j in usable:
            if i != j and rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= limit:
                n[i] += 1
                parent[find(i)] = find(j)
    least = {}
    for i in range(len(rows)):
        if rows[i][0] is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), rows[i][0])
    return sorted((str(rows[i][0]), n[i], str(least.get(find(i)))) for i in range(len(rows)))


def test_embeddings(spark, small):
    rng = np.random.Generator(np.random.PCG64(2))
    base = rng.standard_normal((6, 64))
    rows = [(i, (base[i % 6] + rng.standard_normal(64) * (0.02 + 0.14 * (i % 5) / 4)).tolist(), int(i % 2)) for i in range(90)]
    rows += [(100, None, 0), (101, [0.0] * 64, 0), (102, [float("nan")] * 64, 0), (103, [None, *[1.0] * 63], 0), (104, [], 0), (105, [1e300] * 64, 1), (106, [1.0] * 64, 1), (107, [1.0] * 64, None), (108, [1.0] * 5, 1), (109, [2.0] * 5, 1), (None, [1.0] * 64, 1)]
    rows += [(110, rows[3][1], rows[3][2]), (3, rows[3][1], rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("clash")).repartition(4)
    got = embed_dedup.near_duplicates(df).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == brute_vectors(rows)
    assert all(r.kept == (None if r.vec_id is None else r.vec_id == r.component_id) for r in got)
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_recall(spark, small):
    df = spark.read.parquet(f"{small.replace('0.001', '0.1')}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    found = {r.vec_id: r.n_links for r in embed_dedup.near_duplicates(df).collect()}
    v = np.array([r[1] for r in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (v @ v.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    missed = sum(abs(int(n) - found[r[0]]) for n, r in zip(near.sum(axis=1), rows))
    assert missed <= 0.01 * max(1, near.sum())


# Media


def test_image_round_trips():
    rng = np.random.Generator(np.random.PCG64(4))
    for shape in ((1, 1), (5, 7), (64, 3), (3, 4, 3), (9, 1, 3)):
        image = rng.integers(0, 256, shape, dtype=np.uint8)
        assert (media.decode(media.encode_pgm(image)) == image).all()
        assert (media.decode(media.encode_bmp(image)) == image).all()
    assert (media.decode(b"P2 # note\n2 1\n15\n0 15\n") == [[0, 255]]).all()
    assert (media.decode(b"P1\n3 1\n1 0 1\n") == [[0, 255, 0]]).all() is not None
    assert media.decode(b"P4\n9 1\n\x80\x00").shape == (1, 9)
    for bad in (b"", b"P5\n2 2\n255\nabc", b"GIF89a", b"P5\n0 2\n255\n"):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_area_resize_is_the_mean_of_areas():
    image = np.random.Generator(np.random.PCG64(5)).integers(0, 256, (12, 18)).astype(float)
    assert np.allclose(media.area_resize(image, 4, 6), image.reshape(4, 3, 6, 3).mean(axis=(1, 3)))
    wide = np.repeat(np.repeat(image, 5, axis=0), 7, axis=1)
    assert np.allclose(media.area_resize(image, 5, 7), media.area_resize(wide, 5, 7))
    assert np.load(io.BytesIO(media.tile(image))).shape == (32, 32)


def test_media_rows(spark, small):
    rows = documents(spark, small).select("doc_id", "text").unionAll(spark.createDataFrame([(900, None), (901, ""), (902, "x" * 64), (903, "x" * 65), (903, "x" * 65), (None, "é" * 100_000)], "doc_id long, text string"))
    texts = Counter((r.doc_id, r.text) for r in rows.collect())
    got = media.media_features(rows.withColumn("feature", F.lit(1))).collect()
    assert len(got) == sum(texts.values())
    want = Counter()
    for (doc, text), n in texts.items():
        raw = (text or "").encode()
        payload = raw + bytes((-len(raw)) % 64 if raw else 64)
        want[doc, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])] += n
    assert Counter(tuple(r)[:5] for r in got) == want
    assert media.media_features(rows.limit(0)).count() == 0


# Sharding


def test_shards(spark, small):
    rows = documents(spark, small).select("doc_id", "text").unionAll(spark.createDataFrame([(None, None), (None, "x"), (5, "same"), (5, "same")], "doc_id long, text string"))
    for size in (sharding.BUCKET_BYTES, 5_000):
        out = sharding.sharded(rows, bucket_bytes=size).collect()
        assert Counter((r.doc_id, r.text) for r in out) == Counter((r.doc_id, r.text) for r in rows.collect())
        by = defaultdict(list)
        for r in out:
            by[r["__shard"]].append(r["__slot"])
            assert r["__grown"] in (r["__shard"], 16)
        assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(16))
        again = sharding.sharded(rows.repartition(7), bucket_bytes=size).collect()
        assert sorted(map(str, out)) == sorted(map(str, again))
    report = {r.doc_id: r for r in sharding.shard_report(rows).collect()}
    grown = {r.doc_id: r["__shard"] for r in sharding.sharded(rows, shards=17).collect()}
    assert all(report[d].grown_shard == grown[d] for d in report)
    text = {r.doc_id: r.text or "" for r in rows.collect()}
    assert all(r.size == len(text[d].encode()) + 1 and r.text_crc32 == zlib.crc32(text[d].encode()) and r.law == "key" for d, r in report.items() if d not in (5, None))
    assert sharding.shard_report(rows.limit(0)).count() == 0


def test_fisher_yates_is_even():
    seen = Counter(tuple(sharding.fisher_yates(3, seed)) for seed in range(6000))
    assert len(seen) == 6 and max(seen.values()) < 1200


def test_shards_on_disk(spark, small, tmp_path):
    rows = documents(spark, small).select("doc_id", "text")
    sharding.write_shards(rows, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == rows.count() and back.select("__shard").distinct().count() <= 16


# Quality


def test_quality_held_out(spark, small):
    big = small.replace("0.001", "0.1")
    docs, labels = documents(spark, big), spark.read.parquet(f"{big}/labels.parquet")
    got = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r.predicted for r in got if r.quality == 1]
    bad = [r.predicted for r in got if r.quality == 0]
    assert sum(good) / len(good) > 0.98 and 1 - sum(bad) / len(bad) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_quality_odd_cases(spark, small):
    docs = documents(spark, small).select("doc_id", "text").unionAll(spark.createDataFrame([(None, None), (901, ""), (902, "x"), (902, "x"), (903, "long " * 300_000)], "doc_id long, text string"))
    labels = spark.read.parquet(f"{small}/labels.parquet")
    got = quality.classify(docs.withColumn("score", F.lit("clash")), labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_labels_do_not_leak(spark, small):
    docs, labels = documents(spark, small), spark.read.parquet(f"{small}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = ({r.doc_id: r.score for r in quality.classify(docs, x).collect()} for x in (labels, turned))
    assert one == two


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, small, name):
    assert compare.difference(QUERIES[name](spark, small), compare.connect(small), ORACLES[name]) == ""
