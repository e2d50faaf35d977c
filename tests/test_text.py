import pytest
from pyspark.sql import functions as F

from kindred.functions import text as T

CASES = [
    (T.normalize_text, "Straße Ümlaut ﬁn ＆ café ½ Ⅳ", "strae umlaut fin and cafe 12 iv"),
    (T.normalize_text, None, ""),
    (T.normalize_text, "中文", ""),
    (T.normalize_name, "Acme Pvt. Ltd.", "acme"),
    (T.normalize_name, "Co Op Bank", "op bank"),
    (T.normalize_name, "Ltd", ""),
    (T.normalize_address, "  12, Main St.\t", "12 main st"),
    (T.prefix_key, "a b c d e f g", "abcdef"),
    (T.prefix_key, "ab", "ab"),
    (T.prefix_key, "", ""),
    (T.tokens, "the acme acme of st foods", ["acme", "foods"]),
    (T.tokens, "", []),
    (T.digit_tokens, "12 main 0045 st 12", ["12", "0045"]),
    (T.acronym, "state bank of india", "sboi"),
    (T.acronym, "acme", ""),
    (T.compact, "a b  c", "abc"),
    (T.id_list, "S2-1,,S3-2,S2-1", ["S2-1", "S3-2"]),
    (T.id_list, "", []),
]


@pytest.mark.parametrize("function,given,expected", CASES)
def test_functions(spark, function, given, expected):
    rows = spark.createDataFrame([(given,)], "x string")
    assert rows.select(function(F.col("x")).alias("y")).first()["y"] == expected


def test_token_hash_is_16_digits(spark):
    got = spark.createDataFrame([("acme",), ("foods",)], "x string").select(T.token_hash("x").alias("y")).collect()
    assert {len(r["y"]) for r in got} == {16} and len({r["y"] for r in got}) == 2


def test_record_keys(spark):
    keys = spark.createDataFrame([("acme foods", "12 main st")], "n string, a string").select(T.record_keys("n", "a").alias("k")).first()["k"]
    assert keys["name_prefix"] == "acmefo" and keys["name_tokens"] == ["acme", "foods"] and keys["addr_tokens"] == ["main"]
