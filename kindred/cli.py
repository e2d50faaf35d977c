"""Command line: python -m kindred.cli --mode train|predict|validate|all|index-train|index-test."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from .config import Settings
from .operators import index
from .operators.validate import ValidationError
from .plans import predict, train
from .sources import tsv

MODES = ("train", "predict", "all", "validate", "index-train", "index-test")
log = logging.getLogger("kindred")


def run(spark: SparkSession, settings: Settings, mode: str, strategy: str = "base", rebuild: bool = False, expected: int | None = None) -> None:
    """One mode; ``all`` trains, predicts and validates. ``rebuild`` counts for the index modes only."""
    if mode.startswith("index-"):
        split = mode.removeprefix("index-")
        sources = {n: tsv.read_records(spark, settings.source(split, n)) for n in (2, 3)}
        folder = index.build_index(spark, settings, split, sources, rebuild)
        log.info("index %s: %d records", folder, index.row_count(index.read_index(spark, settings, split)[0]))
    if mode in ("train", "all"):
        found = train.train(spark, settings)
        log.info("threshold %s, F0.5 %s", found["chosen_threshold"], found["f0.5"])
    if mode in ("predict", "all"):
        log.info("written: %s, %s", *predict.predict(spark, settings, strategy, expected))
    if mode in ("validate", "all"):
        predict.validate_output(spark, settings)


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--mode", choices=MODES, default="all")
    parser.add_argument("--strategy", choices=predict.STRATEGIES, default="base")
    parser.add_argument("--rebuild-index", action="store_true")
    parser.add_argument("--expected-queries", type=int)
    got = parser.parse_args(args)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    spark = SparkSession.builder.appName("kindred").getOrCreate()
    try:
        run(spark, Settings.from_env(), got.mode, got.strategy, got.rebuild_index, got.expected_queries)
    except ValidationError as fault:
        log.error("validation failed: %s", fault)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
