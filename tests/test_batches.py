"""Pairs compared together, by the numbers of their strings."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from kindred.functions import batches
from kindred.functions import similarity as S
from kindred.operators import features
from kindred.plans.queries import floats

PAIR = "s1_name string, s1_address string, s1_country string, name string, address string, country string"


def test_plain_strings_score_as_pairs_do():
    r = random.Random(5)
    text = lambda: " ".join("".join(r.choice(r.choice(["abc12", "abcdefghijklmnopqrstuvwxyz0123456789"])) for _ in range(r.randint(1, 9))) for _ in range(r.choice([0, 1, 2, 3, 8, 14])))
    pool = ["", " ", "a", "ab", "a b", "the road", "a" * 64, "a" * 128, "a" * 129, "ab " * 24, "A b", "éa b", *(text() for _ in range(150))]
    a, b = ([r.choice(pool) for _ in range(2000)] for _ in range(2))
    for i in range(0, 2000, 3):
        words = a[i].split(" ")
        r.shuffle(words)
        b[i] = " ".join(words[: r.randint(1, len(words))])
    kernels = S.KERNELS | S.SETS
    found = S._scores(pd.Series(a), pd.Series(b), list(kernels))
    for name, one in kernels.items():
        assert found[name].tolist() == [one(x, y) for x, y in zip(a, b)], name


def test_what_a_string_needs_is_made_once_for_a_batch(spark, monkeypatch):
    seen, whole = [], batches.Strings.__init__
    monkeypatch.setattr(batches.Strings, "__init__", lambda self, texts: (seen.append(len(texts)), whole(self, texts))[1])
    names = pd.Series([f"acme stores {i % 3}" for i in range(3000)])
    features.compared.func(names, names[::-1].reset_index(drop=True), names, names)
    assert seen and max(seen) <= 9
    plan = features.pair_features(spark.createDataFrame([], PAIR)).select(*features.COMPARED)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and plan.count("ArrowEvalPython") == 1


def test_features_are_those_of_the_columns(spark):
    rows = [("acme the stores 12", "12 main road 7", "X", "stores acme 12", "12 main st", "X"), ("a", "", "X", "ab", "1", "Y"), ("Élan co", "1 a", None, "elan co", None, "Y"), (None, None, None, None, None, None)]
    pairs = spark.createDataFrame(rows, PAIR)
    native = features.native_features() | {"name_char_jaccard": S.char_jaccard("s1_name", "name")}
    got, want = (x.collect() for x in (features.pair_features(pairs).select(*native), pairs.select(*(c.cast("float").alias(n) for n, c in native.items()))))
    assert got[:3] == want[:3] and [x or 0.0 for x in got[3]] == [x or 0.0 for x in want[3]]


def test_floats_are_rounded_half_up(spark):
    values = [float(np.float32(x)) for x in (0.0, 1.0, 0.5, 1 / 128, 3 / 128, 1 / 3, 0.9999995, 1e-7, 37.0, *np.random.Generator(np.random.PCG64(1)).random(500))]
    rows = spark.createDataFrame([(x,) for x in values], "x float").select("x", *(F.col("x").alias(n) for n in features.NAMES))
    assert [r[0] for r in floats(rows).select(features.NAMES[0]).collect()] == [r[0] for r in rows.select(F.round(F.col("x").cast("double"), 6)).collect()]
