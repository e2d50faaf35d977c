"""Integrity of the outputs: counts of each kind of fault, all of them aggregations and anti-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TARGET_PREFIXES
from ..functions import text as T


class ValidationError(RuntimeError):
    """The outputs have faults."""


def _total(df: DataFrame, column: str, kind: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).cast("long").alias("errors")).select(F.lit(kind).alias("kind"), "errors")


def _count(df: DataFrame, kind: str) -> DataFrame:
    return df.agg(F.count("*").cast("long").alias("errors")).select(F.lit(kind).alias("kind"), "errors")


def last_rows(lists: DataFrame, key: str, value: str, ordinal: str | None = None) -> DataFrame:
    """One row for each key: the last one by ordinal."""
    if ordinal is None:
        lists, ordinal = lists.withColumn("__ordinal", F.monotonically_increasing_id()), "__ordinal"
    return lists.groupBy(key).agg(F.max_by(value, ordinal).alias(value))


def exploded(lists: DataFrame, key: str, value: str) -> DataFrame:
    """(key, id) of comma lists; repeats and empty entries within a list stay, an empty list has no entry."""
    held = F.coalesce(F.col(value), F.lit(""))
    return lists.where(held != "").select(key, F.explode(F.split(held, ",")).alias("id"))


def fault_counts(matches: DataFrame, candidates: DataFrame, queries: DataFrame, key: str = "source1_entity_id", matched: str = "matched_entity_ids", listed: str = "candidate_entity_ids", ordinal: str | None = None) -> DataFrame:
    """(kind, errors): repeated queries, ids without a target prefix, missing and extra queries, matches that aren't candidates.

    ``queries`` has the query ids in entity_id. Of repeated candidate rows the last counts; a
    query without a candidate row has no candidates. Whether candidates cover the queries isn't judged.
    """
    repeated = _total(matches.groupBy(key).agg((F.count("*") - 1).alias("more")), "more", "duplicate_query")
    ids = exploded(matches, key, matched)
    prefixed = F.col("id").startswith(TARGET_PREFIXES[0])
    for prefix in TARGET_PREFIXES[1:]:
        prefixed = prefixed | F.col("id").startswith(prefix)
    known = queries.select(F.col("entity_id").alias(key)).distinct()
    answered = matches.select(key).distinct()
    allowed = exploded(last_rows(candidates, key, listed, ordinal), key, listed).distinct()
    out = repeated.unionAll(_count(ids.where(~prefixed), "bad_prefix"))
    out = out.unionAll(_count(known.join(answered, key, "left_anti"), "missing_query"))
    out = out.unionAll(_count(answered.join(known, key, "left_anti"), "extra_query"))
    return out.unionAll(_count(ids.join(allowed, [key, "id"], "left_anti"), "not_a_candidate"))


def check(faults: DataFrame) -> None:
    """Raise ValidationError if any count isn't zero."""
    if found := [(r["kind"], r["errors"]) for r in faults.where(F.col("errors") > 0).collect()]:
        raise ValidationError("; ".join(f"{kind}: {n}" for kind, n in sorted(found)))


def check_complete(processed: DataFrame, expected: int) -> None:
    """Raise unless as many rows were processed as expected."""
    if (n := processed.count()) != expected:
        raise ValidationError(f"{n} queries were processed, {expected} expected")


def truth_pairs(truth: DataFrame, key: str = "source1_entity_id", value: str = "matched_entity_ids") -> DataFrame:
    """(s1, entity_id) of a ground truth table, each pair once."""
    return truth.select(F.col(key).alias("s1"), F.explode(T.id_list(value)).alias("entity_id")).distinct()
