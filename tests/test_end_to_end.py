"""Files in, files out: index, training, both predictors, validation and the command line."""

import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kindred import cli
from kindred.config import Settings, Training
from kindred.operators import index, validate
from kindred.operators.validate import ValidationError, truth_pairs
from kindred.plans import fixtures, predict
from kindred.sources import artifacts, tsv
from kindred.streaming import predict as stream


@pytest.fixture(scope="module")
def settings(spark, small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("er"))
    sources, truth = fixtures.corrupted_directory(spark, small)
    for split in ("train", "test"):
        for n, rows in sources.items():
            pandas = rows.drop("ordinal").toPandas()
            os.makedirs(f"{root}/{split}", exist_ok=True)
            pandas.to_csv(f"{root}/{split}/{split}_source{n}.tsv", sep="\t", index=False)
    listed = truth.groupBy("s1").agg(F.concat_ws(",", F.sort_array(F.collect_list("entity_id"))).alias("ids")).toPandas()
    listed.columns = list(tsv.TRUTH_COLUMNS)
    listed.to_csv(f"{root}/train/train_ground_truth.tsv", sep="\t", index=False)
    return replace(Settings(root=root), training=Training(trees=8, depth=3, min_rows=2, learning_rate=0.3))


def test_all(spark, settings):
    cli.run(spark, settings, "all")
    report = json.loads(artifacts.read_text(spark, settings.artifact("training_report.json")))
    assert report["f0.5"] > 0.9 and len(report["threshold_sweep"]) == 97 and len(report["feature_importance"]) == 22
    assert artifacts.load_threshold(spark, settings) == report["chosen_threshold"]
    matched = tsv.read_tsv(spark, settings.output("matching_results.tsv"), predict.MATCHES)
    queries = tsv.read_records(spark, settings.source("test", 1))
    assert matched.count() == queries.count()
    # The directory is small and training meets few wrong pairs, so precision says little here; the true ones must be found.
    truth = truth_pairs(tsv.read_truth(spark, settings.truth()))
    found = validate.exploded(matched, *predict.MATCHES).select(F.col("source1_entity_id").alias("s1"), F.col("id").alias("entity_id"))
    assert truth.join(found, ["s1", "entity_id"]).count() > 0.95 * truth.count()


def test_cascade_and_index_modes(spark, settings):
    cli.run(spark, settings, "index-test")
    predict.predict(spark, settings, "cascade", expected=tsv.read_records(spark, settings.source("test", 1)).count())
    predict.validate_output(spark, settings)
    with pytest.raises(ValidationError):
        predict.predict(spark, settings, "cascade", expected=1)
    with pytest.raises(ValueError):
        predict.candidates(None, None, None, settings, "other")


def test_faults_are_found(spark, settings):
    path = settings.output("matching_results.tsv")
    rows = tsv.read_tsv(spark, path, predict.MATCHES).toPandas()
    rows.loc[0, "matched_entity_ids"] = "S9-1"
    tsv.write_lists(spark.createDataFrame(rows), path, predict.MATCHES)
    with pytest.raises(ValidationError, match="bad_prefix: 1.*not_a_candidate: 1"):
        predict.validate_output(spark, settings)


def test_streamed_queries(spark, settings, tmp_path):
    targets, posted = index.read_index(spark, settings, "test")
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    tsv.read_records(spark, settings.source("test", 1)).limit(5).toPandas().to_csv(folder / "a.tsv", sep="\t", index=False)
    parts = {"targets": targets, "posted": posted, "model": artifacts.load_model(settings), "calibrator": artifacts.load_calibrator(spark, settings), "threshold": 0.5, "settings": settings}
    query = stream.start(spark, str(folder), str(out), str(tmp_path / "check"), **parts)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(str(out)).count() == 5


def test_tsv_fields(spark, tmp_path):
    path = tmp_path / "x.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t\tNA\tfr\nS1-2\t"a\tb ""q"""\tx\t\n', encoding="utf-8")
    rows = [tuple(r) for r in tsv.read_records(spark, str(path), strict=True).orderBy("entity_id").collect()]
    assert rows == [("S1-1", "", "NA", "fr"), ("S1-2", 'a\tb "q"', "x", "")]
    path.write_text("entity_id\tcountry\tbusiness_name\tbusiness_address\n", encoding="utf-8")
    with pytest.raises(ValueError):
        tsv.check_header(spark, str(path))
    with pytest.raises(FileNotFoundError):
        tsv.read_records(spark, str(tmp_path / "none.tsv"))


def test_last_truth_row_counts(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-1\tS2-2\nS1-2\t\n")
    assert {tuple(r) for r in tsv.read_truth(spark, str(path)).collect()} == {("S1-1", "S2-2"), ("S1-2", "")}


def test_missing_artifacts(spark, tmp_path):
    bare = Settings(root=str(tmp_path))
    assert artifacts.load_calibrator(spark, bare) is None and artifacts.load_threshold(spark, bare) == 0.44
    artifacts.write_text(spark, bare.artifact("threshold.json"), "{")
    assert artifacts.load_threshold(spark, bare) == 0.44


def test_duplicate_ids_stop_the_index(spark, settings, tmp_path):
    rows = tsv.read_records(spark, settings.source("test", 2))
    with pytest.raises(ValueError, match="twice"):
        index.build_index(spark, replace(settings, index_root=str(tmp_path)), "test", {2: rows.unionAll(rows)})
