"""Normalised names and addresses, and the keys made of them: Column in, Column out.

All expressions are native but the compatibility decomposition, which Spark lacks.
A null text is an empty one throughout.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import LEGAL_SUFFIXES, STOP_TOKENS


@F.pandas_udf(StringType())
def fold_ascii(texts: pd.Series) -> pd.Series:
    """NFKD without what is not ASCII; ASCII texts pass unchanged."""
    return texts.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode("ascii"))


def _column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def clean_ascii(text: Column) -> Column:
    """Lower case, ``&`` as a word, everything else but letters and digits as single spaces."""
    spelled = F.replace(F.lower(text), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(spelled, "[^a-z0-9]+", " "))


def normalize_text(text: Column | str) -> Column:
    """Python sees only the texts that aren't ASCII."""
    text = F.coalesce(_column(text).cast("string"), F.lit(""))
    return clean_ascii(F.coalesce(fold_ascii(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text))


def words(text: Column | str) -> Column:
    return F.filter(F.split(_column(text), " "), lambda t: t != "")


def drop_suffixes(normalized: Column | str) -> Column:
    """Without legal forms, wherever they stand; the order of the rest is kept."""
    return F.array_join(F.filter(words(normalized), lambda t: ~t.isin(*LEGAL_SUFFIXES)), " ")


def normalize_name(text: Column | str) -> Column:
    return drop_suffixes(normalize_text(text))


def normalize_address(text: Column | str) -> Column:
    return normalize_text(text)


def compact(text: Column | str) -> Column:
    return F.replace(_column(text), F.lit(" "), F.lit(""))


def prefix_key(text: Column | str, length: int = 6) -> Column:
    return F.substring(compact(text), 1, length)


def tokens(text: Column | str) -> Column:
    """Distinct words of three letters or more that aren't stop words, in order of first sight."""
    return F.array_distinct(F.filter(words(text), lambda t: (F.length(t) >= 3) & ~t.isin(*STOP_TOKENS)))


def digit_tokens(text: Column | str) -> Column:
    return F.array_distinct(F.regexp_extract_all(_column(text), F.lit(r"(\d+)"), F.lit(1)))


def acronym(text: Column | str) -> Column:
    """The words' first letters; empty for fewer than two words."""
    all_words = words(text)
    return F.when(F.size(all_words) >= 2, F.array_join(F.transform(all_words, lambda t: F.substring(t, 1, 1)), "")).otherwise(F.lit(""))


def token_hash(token: Column | str) -> Column:
    """A 64-bit hexadecimal name of a token. Joins use the token itself, which can't collide."""
    return F.lower(F.lpad(F.hex(F.xxhash64(_column(token))), 16, "0"))


def record_keys(name: Column | str, address: Column | str, length: int = 6) -> Column:
    """All keys of a record as one struct."""
    return F.struct(
        _column(name).alias("name"), _column(address).alias("address"), prefix_key(name, length).alias("name_prefix"), prefix_key(address, length).alias("addr_prefix"), tokens(name).alias("name_tokens"), tokens(address).alias("addr_tokens")
    )


def length_difference(a: Column | str, b: Column | str) -> Column:
    return F.abs(F.length(_column(a)) - F.length(_column(b)))


def id_list(text: Column | str) -> Column:
    """The non-empty ids of a comma list, each once."""
    return F.array_distinct(F.filter(F.split(F.coalesce(_column(text), F.lit("")), ","), lambda x: x != ""))
