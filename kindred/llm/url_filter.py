"""URL filters: rules first, then logistic regression on hashed character n-grams.

Everything here is DataFrame expressions and Spark ML's JVM transformers; no Python
function runs on the executors.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"), Rule("org", "/fr/", "allow"))

#: Words of hosts to block, and names of hosts to allow.
BAD_WORDS = "casino poker slots bets lottery jackpot adult xxx porn cams pills meds viagra pharma loans cash free win prize cheap ads track clicks spam farm links".split()
GOOD_NAMES = "news library docs weather university museum recipes garden travel history science sports music school council health forum gallery theatre journal market city-guide open-data language-course bookshop river-walks local-history train-times chess-club birdwatch astronomy cooking photography hospital parliament archive cinema observatory botany geology painting sailing cycling knitting woodwork translation poetry orchestra".split()
SUBDOMAINS, DOMAINS, PATHS = ("", "www.", "m.", "blog.", "shop."), ("example.com", "example.org", "example.net"), ("/", "/en/4711.html", "/de/208", "/fr/93/", "/es/a/b")


def host_names() -> list[tuple[str, int]]:
    """(name, 1 to block): bad words alone, in pairs and with made-up ones; good names, made-up words that mean nothing, and pairs of either."""
    draw = random.Random(17)
    bad = [f"{a}-{BAD_WORDS[(i + step) % len(BAD_WORDS)]}" for i, a in enumerate(BAD_WORDS) for step in (3, 8, 14, 19)]
    pairs = [f"{a}-{GOOD_NAMES[(7 * i + 3) % len(GOOD_NAMES)]}" for i, a in enumerate(GOOD_NAMES)]
    syllables = [a + b for a in "bcdfghlmnprstvwz" for b in "aeiou"] + "th sh ch on er an in st nd ing tion ou ly ea".split()
    made = ["".join(draw.choices(syllables, k=draw.randint(2, 4))) for _ in range(160)]
    # One bad word is enough, before or behind any other.
    bad += [x for i, a in enumerate(BAD_WORDS) for x in (a, f"{a}-{made[i]}", f"{made[i + 40]}-{a}", f"{a}-{GOOD_NAMES[i]}", f"{GOOD_NAMES[i + 12]}-{a}")]
    pairs += [f"{a}-{b}" for a, b in zip(made[80:], made[106:])]
    return [(x, 1) for x in bad] + [(x, 0) for x in (*GOOD_NAMES, *pairs, *made)]


def labelled_urls() -> list[tuple[str, int]]:
    """The small labelled table: every name with the same subdomains and the same paths, so that only the name tells."""
    out = []
    for i, (name, label) in enumerate(host_names()):
        for j, sub in enumerate(SUBDOMAINS):
            out.append((f"https://{sub}{name}.{DOMAINS[(i + 2 * j) % len(DOMAINS)]}{PATHS[(i + j) % len(PATHS)]}", label))
    return out


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def grams(host: Column, path: Column, sizes: Sequence[int] = (3, 4, 5)) -> Column:
    """The marked character n-grams of host and path, ends included."""

    def of(mark: str, text: Column, size: int) -> Column:
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        count = F.length(framed) - F.lit(size - 1)
        found = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.concat(F.lit(mark), F.substring(framed, i, F.lit(size))))
        return F.when(count > 0, found).otherwise(F.array().cast("array<string>"))

    return F.concat(*(of(mark, text, size) for mark, text in (("h:", host), ("p:", path)) for size in sizes))


def train(spark: SparkSession, labelled: DataFrame | None = None, buckets: int = 1 << 14, url: str = "url", label: str = "label") -> PipelineModel:
    """Fit the classifier on a small table (url, label with 1 for block); rows without a label are left out."""
    if labelled is None:
        labelled = spark.createDataFrame(labelled_urls(), f"{url} string, {label} int").coalesce(1)
    rows = labelled.where(F.col(label).isNotNull()).select(grams(host_of(F.col(url)), path_of(F.col(url))).alias("__k_grams"), F.col(label).cast("double").alias("__k_label"))
    # Both labels weigh alike, however many rows each has.
    share = rows.agg(F.avg("__k_label")).first()[0]
    rows = rows.withColumn("__k_weight", F.when(F.col("__k_label") == 1, F.lit(0.5 / share if share else 1.0)).otherwise(F.lit(0.5 / (1 - share) if share is not None and share < 1 else 1.0)))
    terms = HashingTF(inputCol="__k_grams", outputCol="__k_terms", numFeatures=buckets, binary=True)
    fit = LogisticRegression(featuresCol="__k_terms", labelCol="__k_label", weightCol="__k_weight", predictionCol="__k_prediction", probabilityCol="__k_probability", rawPredictionCol="__k_raw", regParam=0.01, maxIter=40)
    return Pipeline(stages=[terms, fit]).fit(rows)


def rule_of(host: Column, path: Column, rules: Sequence[Rule], field: str) -> Column:
    """The longest fitting rule's text or verdict; null if none fits. Rules are few and given, so this is a CASE."""
    out = F
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = out.when(fits, F.lit(getattr(rule, field)))
    return F.lit(None).cast("string") if out is F else out


def judge(pages: DataFrame, model: PipelineModel, rules: Sequence[Rule] = RULES, page_id: str = "page_id", url: str = "url", limit: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict and the classifier's block probability of every row.

    A null url or one without ``://`` has an empty host and path, fits no rule and is judged by
    the classifier on their empty frames. Rows don't meet, so repeated rows are judged alike; of
    fitting rules of equal length the one given first counts. Texts of any length are judged
    whole. Only the two columns named are read; others may have any names.
    """
    url_col = F.col(url)
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    scored = model.transform(rows.withColumn("__k_grams", grams(F.col("host"), F.col("path"))))
    block = vector_to_array("__k_probability")[1]
    host, path = F.col("host"), F.col("path")
    return scored.select("page_id", "host", "path", rule_of(host, path, rules, "text").alias("rule"), F.coalesce(rule_of(host, path, rules, "verdict"), F.when(block >= limit, "block").otherwise("allow")).alias("verdict"), block.alias("block_probability"))
