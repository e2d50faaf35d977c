"""Folders from the environment."""

from kindred.config import Settings


def test_folders(monkeypatch):
    monkeypatch.setenv("BER_ROOT", "/x")
    monkeypatch.delenv("BER_INDEX", raising=False)
    held = Settings.from_env()
    assert held.source("test", 2) == "/x/dataset/test/test_source2.tsv" and held.truth() == "/x/dataset/train/train_ground_truth.tsv"
    assert held.index("train") == "/x/index/train" and held.output("a") == "/x/output/a"
    monkeypatch.setenv("BER_INDEX", "/y")
    assert Settings.from_env(root="/z", data_root=None).source("train", 1) == "/z/train/train_source1.tsv" and Settings.from_env().index("test") == "/y/test"
