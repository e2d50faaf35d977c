import itertools
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kindred.functions import similarity as S

WORDS = st.lists(st.text("abcd", min_size=1, max_size=4), max_size=5).map(" ".join)


def lcs_table(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for c in a:
        row = [0] + [max(row[j + 1], row[j] + (c == d)) for j, d in enumerate(b)]
        for j in range(len(b)):
            row[j + 1] = max(row[j + 1], row[j])
    return row[-1]


@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
@settings(max_examples=300, deadline=None)
def test_lcs(a, b):
    assert S.lcs_length(a, b) == lcs_table(a, b)


@pytest.mark.parametrize("a,b,n", [("kitten", "sitting", 4), ("abcbdab", "bdcaba", 4), ("", "x", 0)])
def test_known_lcs(a, b, n):
    assert S.lcs_length(a, b) == n


@pytest.mark.parametrize("a,b,score", [("martha", "marhta", 0.9611), ("dwayne", "duane", 0.84), ("dixon", "dicksonx", 0.8133)])
def test_known_jaro_winkler(a, b, score):
    assert round(S.jaro_winkler(a, b), 4) == score


@pytest.mark.parametrize(
    "function,a,b,score",
    [
        (S.token_set, "acme", "acme foods", 1.0),
        (S.token_set, "fuzzy was a bear", "fuzzy fuzzy was a bear", 1.0),
        (S.token_sort, "new york mets", "mets new york", 1.0),
        (S.partial_ratio, "abcd", "xxabcdyy", 1.0),
        (S.partial_ratio, "yankees", "new york yankees", 1.0),
        (S.weighted_ratio, "acme", "acme", 1.0),
        # Lengths 4 and 10: the partial ratio is 1, weighted by 0.9.
        (S.weighted_ratio, "acme", "acme foods", 0.9),
        # Lengths 2 and 20: weighted by 0.6.
        (S.weighted_ratio, "ab", "ab cdefghijklmnopqrs", 0.6),
        (S.ratio, "ab", "cd", 0.0),
    ],
)
def test_known_scores(function, a, b, score):
    assert function(a, b) == pytest.approx(score)


@given(WORDS, WORDS)
@settings(max_examples=200, deadline=None)
def test_scores_are_shares_and_symmetric(a, b):
    for name, kernel in S.KERNELS.items():
        score = kernel(a, b)
        assert 0 <= score <= 1 + 1e-12, name
        if name != "wratio":
            assert score == pytest.approx(kernel(b, a)), name
        assert kernel(a, a) == (pytest.approx(1.0) if a else 0.0), name
        assert kernel(a, "") == 0.0


def test_columns(spark):
    rows = spark.createDataFrame([("ab", "ab"), ("acme foods", "acme food"), ("", "x"), ("abc", "xyz")], "a string, b string")
    got = [r[0] for r in rows.select(S.char_jaccard("a", "b")).collect()]
    assert got == [1.0, pytest.approx(6 / 7), 0.0, 0.0]
    assert [round(r[0], 4) for r in rows.select(S.best_lexical("a", "b")).collect()][0] == 1.0
    sets = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in sets.select(S.set_jaccard("a", "b")).collect()] == [pytest.approx(1 / 3), 0.0]


def test_trigrams_need_no_python(spark):
    """Short strings too, as the kernel has it; all pairs of strings of up to three letters and some longer ones."""
    words = ["", *("".join(x) for n in (1, 2, 3) for x in itertools.product("ab", repeat=n)), "a b", "abcab", "b aab c", "\u00e9a", "x\u00e9ab"]
    rows = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    scored = rows.withColumn("got", S.char_jaccard("a", "b"))
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()

    def expected(a, b):
        x, y = a.replace(" ", ""), b.replace(" ", "")
        if len(x) < 3 or len(y) < 3:
            return S.ratio(x, y)
        x, y = ({t[i : i + 3] for i in range(len(t) - 2)} for t in (x, y))
        return len(x & y) / len(x | y)

    for a, b, got in scored.collect():
        assert abs(got - expected(a, b)) < 1e-12, (a, b)


def test_batches_score_as_the_kernels_do(monkeypatch):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdé") for _ in range(draw.randint(1, 9)))
    text = lambda: " ".join(word() for _ in range(draw.choice([0, 1, 2, 3, 5, 16])))
    a, b = ([text() for _ in range(1500)] + extra for extra in (["a" * 64, "a" * 65, "x\0", "", "ab" * 600], ["a" * 64, "a" * 70, "\0x", "", "ba" * 600]))
    lcs = S.lcs_length
    assert S.lcs_lengths(a, b).tolist() == [lcs(*p) for p in zip(a, b)]
    got = S._scores(pd.Series([*a, None]), pd.Series([*b, "a"]), list(S.KERNELS))
    assert got.values.tolist() == [[k(x, y) for k in S.KERNELS.values()] for x, y in [*zip(a, b), ("", "a")]]
    # Strings of up to 64 letters are not aligned pair by pair.
    monkeypatch.setattr(S, "lcs_length", None)
    assert S.ratios(["abc"], ["bcd"]) == [4 / 6]


def test_kernels_of_many_pairs_give_the_values_of_one_pair():
    r = random.Random(7)
    text = lambda: "".join(r.choice(r.choice(["ab ", "abc de", "aé✓ b𝄞", "a\0b "])) for _ in range(r.randint(0, r.choice([3, 30, 64, 70, 130, 270]))))
    a, b = [text() for _ in range(600)], [text() for _ in range(600)]
    for i in range(0, 600, 3):
        b[i] = "".join(c for c in a[i] if r.random() < 0.9)
    found = S._scores(pd.Series(a), pd.Series(b), list(S.KERNELS))
    for name, one in S.KERNELS.items():
        assert found[name].tolist() == [one(x, y) for x, y in zip(a, b)], name
    assert S.partial_ratios(a, b) == [S.partial_ratio(x, y) for x, y in zip(a, b)]


def test_far_lengths_are_scored_without_a_loop_over_windows(monkeypatch):
    def one_by_one(*pair):
        raise AssertionError(pair)

    want = S.weighted_ratio("acme stores", "acme trading stores of the north")
    for name in ("lcs_length", "partial_ratio", "weighted_ratio", "jaro_winkler"):
        monkeypatch.setattr(S, name, one_by_one)
    found = S._scores(pd.Series(["acme stores"]), pd.Series(["acme trading stores of the north"]), ["wratio", "jaro_winkler"])
    assert found["wratio"].tolist() == [want]
