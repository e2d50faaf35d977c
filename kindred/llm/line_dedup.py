"""Line dedup by site-relative frequency: a line on too large a share of a host's pages is boilerplate.

Lines travel as 128-bit digests; texts are shuffled once, by their row key, and only where
a site has boilerplate at all. Counting groups by (host, line) after a map-side combine, so
a host with a third of all pages is no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Workspace, keyed

RATIO, LEAST_PAGES = 0.05, 3


def boilerplate(rows: DataFrame, host: str, text: str, ratio: float = RATIO, least_pages: int = LEAST_PAGES, key: str = "__k_row") -> tuple[DataFrame, DataFrame]:
    """(row, host, line) of the distinct lines of every page, and (host, line) of those that exceed the ratio."""
    cut = F.explode(F.array_distinct(F.transform(F.split(text, "\n", -1), lambda x: F.unhex(F.md5(F.trim(x))))))
    lines = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("r"), F.col(host).alias("h"), cut.alias("line"))
    pages = rows.groupBy(F.col(host).alias("h")).agg(F.count("*").alias("pages"))
    used = lines.groupBy("h", "line").agg(F.count("*").alias("with_line")).where(F.col("with_line") >= least_pages)
    pages = pages.withColumnRenamed("h", "ph")
    over = used.join(pages, F.col("h").eqNullSafe(F.col("ph"))).where((F.col("with_line") > F.col("pages") * ratio) & (F.col("line") != F.unhex(F.md5(F.lit("")))))
    return lines, over.select("h", "line")


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", doc_id: str = "doc_id", ratio: float = RATIO, least_pages: int = LEAST_PAGES, counts: tuple[str, str] | None = None) -> DataFrame:
    """All rows and columns, with the boilerplate lines of their host taken out of the text.

    A line is what stands between newlines, compared without spaces at its ends; empty lines
    are kept. It goes if more than ``ratio`` of its host's rows contain it and at least
    ``least_pages`` do (a host of few pages says nothing). A null host is a host of its own; a
    null text stays null; a text whose lines all go is empty. ``counts`` names two more columns:
    lines before and lines dropped.
    """
    ws = Workspace(docs.sparkSession, "lines")
    rows = keyed(docs, ws, doc_id, text)
    lines, over = boilerplate(rows, host, text, ratio, least_pages)
    over = ws.save(over, "over").withColumnRenamed("line", "bad")
    hits = lines.join(over.withColumnRenamed("h", "bh"), F.col("h").eqNullSafe(F.col("bh")) & (F.col("line") == F.col("bad")))
    hits = ws.save(hits.groupBy("r").agg(F.collect_set("line").alias("__k_bad")).withColumnRenamed("r", "__k_hit"), "hits")
    joined = rows.join(hits, F.col("__k_row") == F.col("__k_hit"), "left")
    split = F.split(text, "\n", -1)
    kept = F.filter(split, lambda x: ~F.array_contains("__k_bad", F.unhex(F.md5(F.trim(x)))))
    cleaned = F.when(F.col("__k_bad").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    extra = []
    if counts:
        before = F.coalesce(F.size(split), F.lit(0))
        extra = [before.cast("long").alias(counts[0]), F.when(F.col("__k_bad").isNull(), F.lit(0)).otherwise(before - F.size(kept)).cast("long").alias(counts[1])]
    return joined.select(*[cleaned.alias(c) if c == text else F.col(c) for c in docs.columns], *extra)
