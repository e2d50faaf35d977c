"""The pipeline's stages, each held against what its operator gives on its own input."""

import importlib
from collections import Counter

import corpus_pipeline as P
from pyspark.sql import functions as F

from kindred.llm import simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    counts = [docs.count()]
    for n, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, small)
        if n < len(P.STAGES) - 1:
            assert out.columns == docs.columns == COLUMNS, name
        out.write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        counts.append(docs.count())
        if n == 0:
            kept = {r.doc_id for r in docs.collect()}
            good = [d for d, q in labels.items() if q == 1]
            assert sum(d in kept for d in good) / len(good) > 0.95 and len(kept) < counts[0]
        if n == 2:
            sets = [frozenset(simhash.shingle_hashes(r.text.encode(), 5).tolist()) for r in docs.collect()]
            assert not any(5 * len(a & b) >= 4 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
        if n == 3:
            assert counts[-1] == counts[-2]
    assert counts[1] == counts[2] >= counts[3] > 0
    assert set(docs.columns) >= {"doc_id", "start", "length", "sequence_id", "offset"}


def test_run_gives_the_last_stage(spark, small):
    out = P.run(spark, small)
    assert out.count() > 0 and out.agg({"length": "max"}).first()[0] <= 2048
    assert importlib.import_module("__spark_entry__").queries()["pipeline"]


def test_line_dedup_rows_equal_a_plain_recomputation(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" common foot \n"), "text")).otherwise(F.col("text")))
    rows = docs.collect()
    pages, holders = Counter(r.source for r in rows), Counter()
    for r in rows:
        holders.update((r.source, line) for line in {x.strip(" ") for x in (r.text or "").split("\n")} if line and r.text is not None)
    bad = {(s, line) for (s, line), n in holders.items() if n >= 3 and n > 0.05 * pages[s]}
    want = {r.doc_id: r.text and "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in bad) for r in rows}
    got = {r.doc_id: r.text for r in P.drop_boilerplate(spark, docs, small).collect()}
    assert got == want and got != {r.doc_id: r.text for r in rows}


def test_near_dedup_links_by_simhash(spark, monkeypatch):
    """Long texts of which one word differs are linked by their fingerprints, without any prefix that they share."""
    from kindred.llm import simhash

    def text(n, changed=None):
        return " ".join("other" if i == changed else f"w{n}x{i}" for i in range(2000))

    rows = [(1, text(1)), (2, text(1, 1999)), (3, text(2)), (4, text(2, 0)), (5, text(3)), (6, text(1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simhash, "meetings", lambda nodes, ws: ws.save(nodes.limit(0).selectExpr("0L AS k", "id AS node", "true AS own"), "none"))
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == [1, 3, 5]
