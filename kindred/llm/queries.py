"""The queries of this package: each applies one operator to its whole table.

Tokenizer files belong to the ``public_tokenizers`` package; their folder is a parameter of
the operators and only these queries fill it in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embed_dedup, line_dedup, media, packing, quality, sharding, simhash, suffix_dedup, url_filter


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.train(spark))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op4_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = line_dedup.drop_boilerplate(docs, counts=("n_lines", "n_dropped"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken")).drop("ids")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_url_filter, op3_bpe, op4_embed_dedup, op5_media, op6_line_dedup, op7_suffix_dedup, op8_packing, op9_sharding, op10_quality)
}

ORACLES = {
    "op6_line_dedup": f"""
        WITH lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
        pages AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
        used AS (SELECT source, trim(line, ' ') AS line, count(DISTINCT doc_id) AS n FROM lines GROUP BY ALL),
        bad AS (SELECT u.source, u.line FROM used u JOIN pages p ON u.source IS NOT DISTINCT FROM p.source WHERE u.n >= {line_dedup.LEAST_PAGES} AND u.n > p.pages * {line_dedup.RATIO} AND u.line <> ''),
        marked AS (SELECT l.*, b.line IS NOT NULL AS gone FROM lines l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line, ' ') = b.line)
        SELECT d.doc_id, count(m.pos) AS n_lines, count(*) FILTER (WHERE m.gone) AS n_dropped,
               sha256(coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (WHERE NOT m.gone), '')) AS kept_sha256
        FROM documents d LEFT JOIN marked m USING (doc_id) GROUP BY d.doc_id""",
}
