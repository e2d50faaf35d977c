"""Limits, constants and folder layout of entity resolution."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

# Word lists that normalisation is defined by.
LEGAL_SUFFIXES = ("limited", "ltd", "llp", "inc", "incorporated", "corp", "corporation", "company", "co", "private", "pvt", "plc", "llc", "gmbh", "sarl", "sas", "sa", "pte", "pty")
STOP_TOKENS = ("the", "and", "of", "for", "in", "at", "near", "road", "rd", "street", "st", "avenue", "ave", "lane", "ln", "drive", "dr", "shop", "store", "market", "india", "usa", "us", "france")

RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TARGET_PREFIXES = ("S2-", "S3-")


@dataclass(frozen=True)
class Limits:
    """How many rows each blocking pass may give a record, and the cap on the final candidates."""

    exact_name: int = 80
    exact_address: int = 80
    name_prefix: int = 50
    address_prefix: int = 50
    tokens: int = 60
    #: Leading name tokens that are looked up; None for all.
    first_tokens: int | None = None
    final: int = 80
    prefix_length: int = 6
    #: Tokens of more records than this are not looked up; None for all.
    max_df: int | None = None

    @classmethod
    def base(cls) -> Limits:
        return cls()

    @classmethod
    def cascade(cls) -> Limits:
        return cls(name_prefix=30, address_prefix=30, tokens=20, first_tokens=3, final=60)


@dataclass(frozen=True)
class Training:
    """Budgets of negatives, the split, and the boosted trees."""

    negatives_per_positive: int = 6
    singleton_negatives: int = 3
    pool_multiplier: int = 3
    hard_fraction: float = 0.5
    train_share: float = 0.85
    sample_seed: int = 42
    split_seed: int = 123
    model_seed: int = 42
    # Fixed values of the boosted trees.
    trees: int = 1200
    patience: int = 80
    learning_rate: float = 0.03
    leaves: int = 47
    depth: int = 8
    min_rows: int = 30
    subsample: float = 0.85
    l1: float = 0.2
    l2: float = 2.0
    beta: float = 0.5


@dataclass(frozen=True)
class Decision:
    threshold: float = 0.44
    strong_name: float = 0.88
    strong_address: float = 0.88


@dataclass(frozen=True)
class Settings:
    """Where things lie, and the limits in force. Folders may be on any file system that Spark reads."""

    root: str = "."
    #: Where the splits lie; ``root`` itself if None.
    data_root: str | None = None
    index_root: str | None = None
    limits: Limits = field(default_factory=Limits.base)
    cascade_limits: Limits = field(default_factory=Limits.cascade)
    training: Training = field(default_factory=Training)
    decision: Decision = field(default_factory=Decision)

    @classmethod
    def from_env(cls, **changes) -> Settings:
        """The splits lie in ``dataset`` under BER_ROOT; BER_INDEX is the folder (not a file) of the index, under BER_ROOT if unset."""
        root = os.environ.get("BER_ROOT", ".")
        return replace(cls(root=root, data_root=f"{root}/dataset", index_root=os.environ.get("BER_INDEX")), **changes)

    def source(self, split: str, number: int) -> str:
        return f"{self.data_root or self.root}/{split}/{split}_source{number}.tsv"

    def truth(self) -> str:
        return f"{self.data_root or self.root}/train/train_ground_truth.tsv"

    def index(self, split: str) -> str:
        return f"{self.index_root or self.root + '/index'}/{split}"

    def artifact(self, name: str) -> str:
        return f"{self.root}/artifacts/{name}"

    def output(self, name: str) -> str:
        return f"{self.root}/output/{name}"
