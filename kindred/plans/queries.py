"""Registered queries of the entity-resolution operators, and the same results in DuckDB SQL.

A corrupted directory of customers stands in for businesses (plans.fixtures), whole fields of all
rows. Limits are the production ones unless a name says ``tight``. Scores
are rounded to six places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LEGAL_SUFFIXES, STOP_TOKENS, Limits, Settings, Training
from ..functions import similarity as S
from ..functions import text as T
from ..operators import blocking, features, index, lists, metrics, selection, validate
from ..sources.staging import staged
from . import fixtures

BASE, CASCADE = Limits.base(), Limits.cascade()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


# DuckDB building blocks -------------------------------------------------------------------


def _in(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def sql_tokens(column: str) -> str:
    kept = f"list_filter(string_split({column}, ' '), lambda x: length(x) >= 3 AND x NOT IN ({_in(STOP_TOKENS)}))"
    return f"list_filter({kept}, lambda x, i: list_position({kept}, x) = i)"


def sql_jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) ELSE 0.0 END"


def sql_grams(column: str) -> str:
    text = f"replace({column}, ' ', '')"
    return f"list_distinct(list_transform(range(1, greatest(length({text}) - 2, 0) + 1), lambda i: substr({text}, i::BIGINT, 3)))"


def sql_lcs(a: str, b: str) -> str:
    """One row of the usual table after another: each cell is a running maximum of its upper and slanting neighbours."""
    same = f"list_transform(string_split({a}, ''), lambda c: list_transform(string_split({b}, ''), lambda d: (c = d)::INT))"
    zeros = f"list_transform(string_split({b}, ''), lambda d: 0)"
    cell = "greatest(r[k::BIGINT], coalesce(r[k::BIGINT - 1], 0) + x[k::BIGINT])"
    step = f"lambda r, x: list_transform(range(1, len(r) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: {cell})))"
    return f"list_extract(list_reduce(list_prepend({zeros}, {same}), {step}), -1)"


def sql_ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE 2.0 * {sql_lcs(a, b)} / (length({a}) + length({b})) END"


def sql_lcs_bits(a: str, b: str) -> str:
    """The same by whole rows of the table in the bits of one integer; for strings of up to 120 letters."""
    place = f"list_sum(list_transform(range(1, length({a}) + 1), lambda i: CASE WHEN {a}[i::BIGINT] = c THEN 1::HUGEINT << (i - 1)::INT ELSE 0::HUGEINT END))::HUGEINT"
    full = f"((1::HUGEINT << length({a})::INT) - 1)"
    rows_ = f"list_transform(string_split({b}, ''), lambda c: coalesce({place}, 0::HUGEINT))"
    step = f"lambda r, x: ((r + (r & x)) | (r - (r & x))) & {full}"
    return f"(length({a}) - bit_count(list_reduce(list_prepend({full}, {rows_}), {step})))"


def sql_ratio_bits(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE 2.0::DOUBLE * {sql_lcs_bits(a, b)} / (length({a}) + length({b})) END"


def sql_similarities(pairs: str, keep: str) -> str:
    """All features of a table of pairs (s1_name, name, s1_address, address, s1_country, country), by steps.

    The weighted ratio is that of strings less than 1.5 times as long as each other, as the directory's are.
    """
    sides = (("name", "s1_name", "name"), ("addr", "s1_address", "address"))
    cut, rest, some, whole = [], [], [], []
    for m, a, b in sides:
        words_a, words_b = f"list_distinct(string_split({a}, ' '))", f"list_distinct(string_split({b}, ' '))"
        cut += [f"array_to_string(list_sort(list_filter({words_a}, lambda x: list_contains({words_b}, x))), ' ') AS {m}_c", f"array_to_string(list_sort(list_filter({words_a}, lambda x: NOT list_contains({words_b}, x))), ' ') AS {m}_l", f"array_to_string(list_sort(list_filter({words_b}, lambda x: NOT list_contains({words_a}, x))), ' ') AS {m}_r", f"{sql_sorted(a)} AS {m}_sa", f"{sql_sorted(b)} AS {m}_sb"]
        rest += [f"{sql_ratio_bits(a, b)} AS {m}_ratio", f"{sql_ratio_bits(f'{m}_sa', f'{m}_sb')} AS {m}_token_sort", f"CASE WHEN {m}_l = '' OR {m}_r = '' THEN 0 ELSE {sql_lcs_bits(f'{m}_l', f'{m}_r')} END AS {m}_lcs", f"length({m}_c) AS {m}_n", f"(length({m}_c) > 0)::INT AS {m}_gap"]
        size_l, size_r = f"({m}_n + {m}_gap + length({m}_l))", f"({m}_n + {m}_gap + length({m}_r))"
        plain = f"1 - (length({m}_l) + length({m}_r) - 2 * {m}_lcs)::DOUBLE / ({size_l} + {size_r})"
        some += [f"""CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {m}_l = '' OR {m}_r = '' THEN (CASE WHEN {m}_n > 0 THEN 1.0 ELSE 0.0 END) WHEN {m}_gap = 0 THEN {plain}
            ELSE greatest({plain}, 1 - (1 + length({m}_l))::DOUBLE / ({m}_n + {size_l}), 1 - (1 + length({m}_r))::DOUBLE / ({m}_n + {size_r})) END AS {m}_token_set""", f"({sql_char_jaccard_bits(a, b)})::DOUBLE AS {m}_char_jaccard", f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE jaro_winkler_similarity({a}, {b}) END AS {m}_jaro_winkler"]
        whole += [f"greatest({m}_ratio, 0.95 * greatest({m}_token_sort, {m}_token_set)) AS {m}_wratio"]
    best = lambda m: f"greatest({m}_ratio, {m}_wratio, {m}_token_set, {m}_char_jaccard, {m}_jaro_winkler)"
    native = f"""(s1_name <> '' AND s1_name = name)::INT AS exact_name, (s1_address <> '' AND s1_address = address)::INT AS exact_address, (s1_country = country)::INT AS same_country,
        {sql_jaccard(sql_tokens('s1_name'), sql_tokens('name'))} AS name_token_jaccard, {sql_jaccard(sql_tokens('s1_address'), sql_tokens('address'))} AS addr_token_jaccard,
        {sql_jaccard("list_distinct(regexp_extract_all(s1_address, '[0-9]+'))", "list_distinct(regexp_extract_all(address, '[0-9]+'))")} AS digit_jaccard,
        ({sql_acronym('s1_name')} <> '' AND {sql_acronym('s1_name')} = {sql_acronym('name')})::INT AS acronym_match,
        abs(length(s1_name) - length(name)) AS name_len_diff, abs(length(s1_address) - length(address)) AS addr_len_diff"""
    steps = f"(SELECT *, {', '.join(whole)} FROM (SELECT *, {', '.join(some)} FROM (SELECT *, {', '.join(rest)} FROM (SELECT *, {', '.join(cut)} FROM {pairs}))))"
    return f"SELECT {keep}, {native}, {', '.join(f'{m}_{x}' for m in ('name', 'addr') for x in features.SIDE)}, 0.58::DOUBLE * {best('name')} + 0.42::DOUBLE * {best('addr')} AS combined FROM {steps}"


def sql_as_floats() -> str:
    return ", ".join(f"round({n}::FLOAT::DOUBLE, 6) AS {n}" for n in features.NAMES)


def sql_sorted(column: str) -> str:
    return f"array_to_string(list_sort(string_split({column}, ' ')), ' ')"


def sql_acronym(column: str) -> str:
    return f"CASE WHEN {column} LIKE '% %' THEN array_to_string(list_transform(string_split({column}, ' '), lambda x: x[1]), '') ELSE '' END"


def sql_char_jaccard(a: str, b: str) -> str:
    x, y = f"replace({a}, ' ', '')", f"replace({b}, ' ', '')"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN length({x}) < 3 OR length({y}) < 3 THEN {sql_ratio(x, y)} ELSE {sql_jaccard(sql_grams(a), sql_grams(b))} END"


def sql_char_jaccard_bits(a: str, b: str) -> str:
    x, y = f"replace({a}, ' ', '')", f"replace({b}, ' ', '')"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN length({x}) < 3 OR length({y}) < 3 THEN {sql_ratio_bits(x, y)} ELSE {sql_jaccard(sql_grams(a), sql_grams(b))} END"


def sql_normalized(column: str) -> str:
    return rf"trim(regexp_replace(replace(lower(regexp_replace(strip_accents(coalesce({column}, '')), '[^\x00-\x7F]', '', 'g')), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


DIRECTORY = """
    base AS MATERIALIZED (SELECT c_custkey AS k, concat_ws(' ', p_name, p_brand, c_mktsegment) AS name, concat_ws(' ', c_custkey, p_type, 'Street', n_name, c_custkey + 10000) AS address, n_name AS nation, n_nationkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN part ON p_partkey = c_custkey),
    cut AS (SELECT *, substr(name, 1, (k % 5 + 1)::INT) || substr(name, (k % 5 + 3)::INT) AS dropped FROM base),
    raw_ AS MATERIALIZED (SELECT 1 AS source, k, name, address, nation AS country FROM base
        UNION ALL SELECT 2, k, upper(name) || [' Ltd', ' Pvt. Ltd.', ' & Co'][(k % 3 + 1)::INT], replace(address, 'Street', 'St.'), nation FROM base WHERE k % 2 = 0
        UNION ALL SELECT 3, k, CASE WHEN k % 7 = 0 THEN array_to_string(list_concat([string_split(dropped, ' ')[2], string_split(dropped, ' ')[1]], string_split(dropped, ' ')[3:]), ' ') ELSE dropped END,
            CASE WHEN k % 4 = 0 THEN regexp_replace(address, '^[0-9]+ ', '') ELSE address END, CASE WHEN k % 25 = 0 THEN next_.n_name ELSE nation END
            FROM cut JOIN nation next_ ON (cut.n_nationkey + 1) % 25 = next_.n_nationkey WHERE k % 3 = 0)"""
RECORDS = f"""{DIRECTORY},
    plain AS (SELECT 'S' || source || '-' || k AS entity_id, source, country, k AS ordinal, source::BIGINT * {1 << 56} + k AS rid, {sql_normalized('name')} AS n, {sql_normalized('address')} AS address FROM raw_),
    rows_ AS (SELECT * EXCLUDE (n), array_to_string(list_filter(string_split(n, ' '), lambda x: x <> '' AND x NOT IN ({_in(LEGAL_SUFFIXES)})), ' ') AS name FROM plain),
    recs AS MATERIALIZED (SELECT *, left(replace(name, ' ', ''), 6) AS name_prefix, left(replace(address, ' ', ''), 6) AS addr_prefix FROM rows_),
    q AS MATERIALIZED (SELECT entity_id AS s1, * EXCLUDE (entity_id) FROM recs WHERE source = 1),
    t AS MATERIALIZED (SELECT * FROM recs WHERE source <> 1),
    posted AS MATERIALIZED (SELECT 'name' AS kind, country, unnest({sql_tokens('name')}) AS tok, rid FROM t UNION ALL SELECT 'addr', country, unnest({sql_tokens('address')}), rid FROM t)"""


def sql_key_pass(number: int, limit: int, asked: str = "q") -> str:
    key = blocking.KEYS[number]
    cut = f"SELECT country, {key}, rid, row_number() OVER (PARTITION BY country, {key} ORDER BY rid) AS rank FROM t WHERE {key} <> ''"
    return f"SELECT {asked}.s1, c.rid, {number} AS pass, c.rank::INT AS rank FROM {asked} JOIN ({cut}) c USING (country, {key}) WHERE c.rank <= {limit}"


def sql_token_pass(number: int, limit: int, first: int | None = None, asked: str = "q") -> str:
    kind, column = ("name", "name") if number == blocking.NAME_TOKENS else ("addr", "address")
    wanted = sql_tokens(column) + (f"[1:{first}]" if first else "")
    shared = f"SELECT a.s1, p.rid, count(*) AS shared FROM (SELECT s1, country, unnest({wanted}) AS tok FROM {asked}) a JOIN posted p ON p.kind = '{kind}' AND p.country = a.country AND p.tok = a.tok GROUP BY ALL"
    return f"SELECT s1, rid, {number} AS pass, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY shared DESC, rid) AS rank FROM ({shared})) WHERE rank <= {limit}"


def sql_first_seen(found: str) -> str:
    return f"SELECT s1, rid, row_number() OVER (PARTITION BY s1 ORDER BY pass, rank)::INT AS ord FROM (SELECT s1, rid, min((pass, rank)) AS place, min(pass) AS pass, arg_min(rank, (pass, rank)) AS rank FROM ({found}) GROUP BY s1, rid)"


KEYED = " UNION ALL ".join(sql_key_pass(n, limit) for n, limit in ((1, BASE.exact_name), (2, BASE.exact_address), (3, BASE.name_prefix), (4, BASE.address_prefix)))
ALL_PASSES = f"{KEYED} UNION ALL {sql_token_pass(5, BASE.tokens)} UNION ALL {sql_token_pass(6, BASE.tokens)}"
TRUTH = "SELECT 'S1-' || k AS s1, 'S' || source || '-' || k AS entity_id FROM raw_ WHERE source <> 1"
PAIRS = "SELECT p.*, t.entity_id, t.name, t.address, t.country, q.name AS s1_name, q.address AS s1_address, q.country AS s1_country FROM ({}) p JOIN t USING (rid) JOIN q USING (s1)"
LABELLED = f"""
    truth AS MATERIALIZED ({TRUTH}),
    true_ AS (SELECT tr.s1, t.rid, 1 AS hit FROM truth tr JOIN t USING (entity_id)),
    marked AS MATERIALIZED (SELECT coalesce(c.s1, x.s1) AS s1, coalesce(c.rid, x.rid) AS rid, coalesce(c.ord, {(1 << 31) - 1}) AS ord, coalesce(x.hit, 0) AS label
        FROM ({sql_first_seen(KEYED)}) c FULL OUTER JOIN true_ x ON c.s1 = x.s1 AND c.rid = x.rid),
    pairs AS MATERIALIZED ({PAIRS.format('SELECT * FROM marked')}),
    scored AS MATERIALIZED (SELECT *, round(0.58 * ({sql_char_jaccard('s1_name', 'name')}) + 0.42 * ({sql_char_jaccard('s1_address', 'address')}), 6) AS score FROM pairs)"""


# Normalisation and keys ---------------------------------------------------------------------


@query("er_normalize_text", f"SELECT doc_id, {sql_normalized('text')} AS normalized FROM documents")
def normalize_text(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", T.normalize_text("text").alias("normalized"))


@query("er_records", f"WITH {RECORDS} SELECT rid, entity_id, source, country, name, address, name_prefix, addr_prefix FROM t")
def records(spark, sf_dir):
    return fixtures.directory(spark, sf_dir)[1]


@query("er_query_records", f"WITH {RECORDS} SELECT s1, country, name, address, name_prefix, addr_prefix, ordinal FROM q")
def query_records(spark, sf_dir):
    return fixtures.directory(spark, sf_dir)[0].select("s1", "country", "name", "address", "name_prefix", "addr_prefix", "ordinal")


@query(
    "er_record_keys",
    f"""WITH {RECORDS} SELECT entity_id, array_to_string({sql_tokens('name')}, ',') AS name_tokens, array_to_string({sql_tokens('address')}, ',') AS addr_tokens,
    replace(name, ' ', '') AS compact_name, {sql_acronym('name')} AS acronym, abs(length(name) - length(address))::INT AS length_difference FROM t""",
)
def record_keys(spark, sf_dir):
    targets = fixtures.directory(spark, sf_dir)[1]
    keys = targets.select("entity_id", "name", "address", T.record_keys("name", "address").alias("k"))
    joined = lambda c: F.array_join(c, ",")
    return keys.select("entity_id", joined("k.name_tokens").alias("name_tokens"), joined("k.addr_tokens").alias("addr_tokens"), T.compact("name").alias("compact_name"), T.acronym("name").alias("acronym"), T.length_difference("name", "address").alias("length_difference"))


@query("er_digit_tokens", r"SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '\d+'))), ',') AS digits FROM documents")
def digit_tokens(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(T.digit_tokens(F.coalesce("text", F.lit("")))), ",").alias("digits"))


# Index ------------------------------------------------------------------------------------


@query("er_union_sources", f"WITH {RECORDS} SELECT source, count(*) AS n, count(DISTINCT entity_id) AS ids FROM t GROUP BY source")
def union_sources(spark, sf_dir):
    sources = fixtures.corrupted_directory(spark, sf_dir)[0]
    both = index.union_sources({n: sources[n] for n in (2, 3)})
    return both.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("ids"))


@query("er_postings", f"WITH {RECORDS} SELECT kind, country, tok, rid FROM posted")
def posted(spark, sf_dir):
    return index.postings(fixtures.directory(spark, sf_dir)[1])


@query("er_token_stats", f"WITH {RECORDS} SELECT kind, tok, count(*) AS df FROM posted GROUP BY ALL")
def token_stats(spark, sf_dir):
    return index.token_stats(index.postings(fixtures.directory(spark, sf_dir)[1]))


@query("er_duplicate_ids", f"WITH {RECORDS} SELECT entity_id, count(*) AS rows FROM (SELECT * FROM t UNION ALL SELECT * FROM t WHERE ordinal % 10 = 1) GROUP BY entity_id HAVING count(*) > 1")
def duplicate_ids(spark, sf_dir):
    targets = fixtures.directory(spark, sf_dir)[1]
    again = targets.where((F.col("rid") - F.col("source").cast("long") * F.lit(1 << 56)) % 10 == 1)
    return index.duplicate_ids(targets.unionAll(again))


@query("er_fetch_entities", f"WITH {RECORDS}, truth AS ({TRUTH}) SELECT rid, entity_id, country FROM t WHERE entity_id IN (SELECT entity_id FROM truth)")
def fetch_entities(spark, sf_dir):
    targets = fixtures.directory(spark, sf_dir)[1]
    return blocking.fetch_entities(targets, fixtures.truth(spark, sf_dir)).select("rid", "entity_id", "country")


@query("er_truth", f"WITH {RECORDS} {TRUTH}")
def truth(spark, sf_dir):
    """Read back from comma lists, repeats and empty entries included."""
    listed = fixtures.truth(spark, sf_dir).groupBy("s1").agg(F.concat_ws(",", F.collect_list("entity_id")).alias("ids"))
    return validate.truth_pairs(listed.withColumn("ids", F.concat_ws(",", "ids", F.lit(""), "ids")), "s1", "ids")


# Blocking -----------------------------------------------------------------------------------


def _pass_query(name: str, number: int, limit: int) -> None:
    @query(name, f"WITH {RECORDS} SELECT s1, rid, rank FROM ({sql_key_pass(number, limit)})")
    def run(spark, sf_dir):
        asked, targets = fixtures.directory(spark, sf_dir)
        return blocking.key_pass(asked, targets, number, limit).select("s1", "rid", "rank")


_pass_query("er_block_exact_name", blocking.EXACT_NAME, BASE.exact_name)
_pass_query("er_block_exact_address", blocking.EXACT_ADDRESS, BASE.exact_address)
_pass_query("er_block_name_prefix", blocking.NAME_PREFIX, BASE.name_prefix)
_pass_query("er_block_address_prefix", blocking.ADDRESS_PREFIX, BASE.address_prefix)


def _token_query(name: str, number: int, limit: int, first: int | None = None) -> None:
    @query(name, f"WITH {RECORDS} SELECT s1, rid, rank FROM ({sql_token_pass(number, limit, first)})")
    def run(spark, sf_dir):
        asked, targets = fixtures.indexed(spark, sf_dir)
        return blocking.token_pass(asked, index.postings(targets), number, limit, first).select("s1", "rid", "rank")


_token_query("er_block_name_tokens", blocking.NAME_TOKENS, BASE.tokens)
_token_query("er_block_address_tokens", blocking.ADDRESS_TOKENS, BASE.tokens)
_token_query("er_block_first_name_tokens", blocking.NAME_TOKENS, CASCADE.tokens, CASCADE.first_tokens)


@query("er_candidates_exact_name", f"WITH {RECORDS}, c AS ({sql_key_pass(1, BASE.exact_name)}) SELECT q.s1, coalesce(string_agg(t.entity_id, ',' ORDER BY c.rank), '') AS candidate_entity_ids FROM q LEFT JOIN c USING (s1) LEFT JOIN t ON t.rid = c.rid GROUP BY q.s1")
def candidates_exact_name(spark, sf_dir):
    asked, targets = fixtures.directory(spark, sf_dir)
    pairs = blocking.key_pass(asked, targets, blocking.EXACT_NAME, BASE.exact_name).join(targets.select("rid", "entity_id"), "rid")
    return lists.for_all(asked, lists.id_lists(pairs, ["rank"], "candidate_entity_ids"), "candidate_entity_ids")


@query("er_candidates_training", f"WITH {RECORDS} {sql_first_seen(KEYED)}")
def candidates_training(spark, sf_dir):
    return blocking.training_passes(*fixtures.indexed(spark, sf_dir), BASE)


@query("er_candidates_base", f"WITH {RECORDS} {sql_first_seen(ALL_PASSES)}")
def candidates_base(spark, sf_dir):
    asked, targets = fixtures.indexed(spark, sf_dir)
    return blocking.all_passes(asked, targets, index.postings(targets), BASE)


CASCADE_SQL = f"""WITH {RECORDS}, c1 AS MATERIALIZED ({sql_key_pass(1, CASCADE.exact_name)}),
    q2 AS (SELECT * FROM q WHERE s1 NOT IN (SELECT s1 FROM c1)), c2 AS MATERIALIZED ({sql_key_pass(2, CASCADE.exact_address, 'q2')}),
    q3 AS (SELECT * FROM q2 WHERE s1 NOT IN (SELECT s1 FROM c2)), c3 AS MATERIALIZED ({sql_key_pass(3, CASCADE.name_prefix, 'q3')} UNION ALL {sql_key_pass(4, CASCADE.address_prefix, 'q3')}),
    q4 AS (SELECT * FROM q3 WHERE s1 NOT IN (SELECT s1 FROM c3)), c4 AS ({sql_token_pass(5, CASCADE.tokens, CASCADE.first_tokens, 'q4')}),
    found AS (SELECT * FROM c1 UNION ALL SELECT * FROM c2 UNION ALL SELECT * FROM c3 UNION ALL SELECT * FROM c4)
    SELECT * FROM ({sql_first_seen('SELECT * FROM found')}) WHERE ord <= {CASCADE.final}"""


@query("er_candidates_cascade", CASCADE_SQL)
def candidates_cascade(spark, sf_dir):
    asked, targets = fixtures.indexed(spark, sf_dir)
    return blocking.cascade(asked, targets, index.postings(targets), CASCADE)


@query("er_candidate_lists", f"WITH {RECORDS}, c AS ({sql_first_seen(ALL_PASSES)}) SELECT q.s1, coalesce(string_agg(t.entity_id, ',' ORDER BY c.ord), '') AS candidate_entity_ids FROM q LEFT JOIN c USING (s1) LEFT JOIN t ON t.rid = c.rid GROUP BY q.s1")
def candidate_lists(spark, sf_dir):
    asked, targets = fixtures.indexed(spark, sf_dir)
    found = blocking.all_lists(asked, targets, index.postings(targets), BASE, "entity_id")
    return lists.for_all(asked, found.select("s1", F.concat_ws(",", "found").alias("candidate_entity_ids")), "candidate_entity_ids")


@query("er_candidate_counts", f"WITH {RECORDS}, c AS ({sql_first_seen(ALL_PASSES)}) SELECT count(*) AS queries, sum(n)::BIGINT AS ids, round(avg(n), 6) AS ids_per_query FROM (SELECT q.s1, count(c.rid) AS n FROM q LEFT JOIN c USING (s1) GROUP BY q.s1)")
def candidate_counts(spark, sf_dir):
    found = lists.list_sizes(candidate_lists(spark, sf_dir), "candidate_entity_ids")
    return found.withColumn("ids_per_query", F.round("ids_per_query", 6))


@query("er_lexical_cap")
def lexical_cap(spark, sf_dir):
    asked, targets = fixtures.indexed(spark, sf_dir)
    pairs = blocking.with_records(blocking.all_passes(asked, targets, index.postings(targets), BASE), asked, targets)
    return blocking.lexical_cap(pairs, BASE.final, features.lexical_score).select("s1", "rid", "entity_id", "ord")


TIGHT = Limits(exact_name=2, exact_address=2, name_prefix=3, address_prefix=1, tokens=5, final=4)
TIGHT_KEYED = " UNION ALL ".join(sql_key_pass(n, most) for n, most in blocking.keyed_limits(TIGHT).items())


@query("er_tight_passes", f"WITH {RECORDS}, f AS ({TIGHT_KEYED} UNION ALL {sql_token_pass(5, TIGHT.tokens)} UNION ALL {sql_token_pass(6, TIGHT.tokens)}) SELECT * FROM ({sql_first_seen('SELECT * FROM f')})")
def tight_passes(spark, sf_dir):
    """Limits that cut blocks at any size of the tables."""
    asked, targets = fixtures.indexed(spark, sf_dir)
    return blocking.all_passes(asked, targets, index.postings(targets), TIGHT)


@query(
    "er_tight_lexical_cap",
    f"""WITH {RECORDS}, c AS ({sql_first_seen(KEYED)}), p AS MATERIALIZED ({PAIRS.format('SELECT * FROM c')}), f AS MATERIALIZED ({sql_similarities('p', 's1, rid, ord')}),
    b AS (SELECT *, count(*) OVER (PARTITION BY s1) AS n, round(0.6 * greatest(name_ratio, name_wratio, name_token_set) + 0.4 * greatest(addr_ratio, addr_wratio, addr_token_set), 9) AS score FROM f),
    r AS (SELECT *, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, ord) AS place FROM b)
    SELECT s1, rid, CASE WHEN n > {TIGHT.final} THEN place ELSE ord END::INT AS ord FROM r WHERE n <= {TIGHT.final} OR place <= {TIGHT.final}""",
)
def tight_lexical_cap(spark, sf_dir):
    """The cap by its own score, on the keyed candidates."""
    asked, targets = fixtures.indexed(spark, sf_dir)
    pairs = blocking.with_records(blocking.training_passes(asked, targets, BASE), asked, targets)
    return blocking.lexical_cap(pairs, TIGHT.final, lambda needed: F.round(features.lexical_score(needed), 9)).select("s1", "rid", "ord")


# Similarity and features --------------------------------------------------------------------


def prefix_pairs(spark, sf_dir) -> DataFrame:
    return blocking.key_pairs(*fixtures.indexed(spark, sf_dir), {blocking.NAME_PREFIX: BASE.name_prefix})


GRAMS = ("name_grams", "address_grams")


def with_grams(records: DataFrame) -> DataFrame:
    return records.withColumns({"name_grams": S.gram_codes("name"), "address_grams": S.gram_codes("address")})


def by_grams(side: str) -> Column:
    return S.char_jaccard(f"s1_{side}", side, (f"s1_{side}_grams", f"{side}_grams"))


PREFIX_PAIRS = PAIRS.format(sql_key_pass(3, BASE.name_prefix))


@query("er_ratio", f"WITH {RECORDS}, p AS ({PREFIX_PAIRS}) SELECT s1, rid, round({sql_ratio('s1_name', 'name')}, 6) AS ratio, round({sql_ratio(sql_sorted('s1_name'), sql_sorted('name'))}, 6) AS token_sort FROM p")
def ratio(spark, sf_dir):
    found = prefix_pairs(spark, sf_dir).withColumn("x", S.aligned("s1_name", "name"))
    return found.select("s1", "rid", F.round("x.ratio", 6).alias("ratio"), F.round("x.token_sort", 6).alias("token_sort"))


@query("er_jaro_winkler", f"WITH {RECORDS}, p AS ({PREFIX_PAIRS}) SELECT s1, rid, round(jaro_winkler_similarity(s1_name, name), 6) AS jaro_winkler FROM p")
def jaro_winkler(spark, sf_dir):
    return prefix_pairs(spark, sf_dir).select("s1", "rid", F.round(S.jaro_winklers("s1_name", "name"), 6).alias("jaro_winkler"))


@query("er_char_jaccard", f"WITH {RECORDS}, p AS ({PREFIX_PAIRS}) SELECT s1, rid, round({sql_char_jaccard('s1_name', 'name')}, 6) AS name_char_jaccard, round({sql_char_jaccard('s1_address', 'address')}, 6) AS addr_char_jaccard FROM p")
def char_jaccard(spark, sf_dir):
    asked, targets = (with_grams(x) for x in fixtures.indexed(spark, sf_dir))
    pairs = blocking.key_pairs(asked, targets, {blocking.NAME_PREFIX: BASE.name_prefix}, fields=(*blocking.FIELDS, *GRAMS))
    return pairs.select("s1", "rid", F.round(by_grams("name"), 6).alias("name_char_jaccard"), F.round(by_grams("address"), 6).alias("addr_char_jaccard"))


NATIVE_SQL = f"""WITH {RECORDS}, p AS ({PREFIX_PAIRS}) SELECT s1, rid,
    (s1_name <> '' AND s1_name = name)::INT::DOUBLE AS exact_name, (s1_address <> '' AND s1_address = address)::INT::DOUBLE AS exact_address, (s1_country = country)::INT::DOUBLE AS same_country,
    round({sql_jaccard(sql_tokens('s1_name'), sql_tokens('name'))}, 6) AS name_token_jaccard, round({sql_jaccard(sql_tokens('s1_address'), sql_tokens('address'))}, 6) AS addr_token_jaccard,
    round({sql_jaccard("list_distinct(regexp_extract_all(s1_address, '[0-9]+'))", "list_distinct(regexp_extract_all(address, '[0-9]+'))")}, 6) AS digit_jaccard,
    ({sql_acronym('s1_name')} <> '' AND {sql_acronym('s1_name')} = {sql_acronym('name')})::INT::DOUBLE AS acronym_match,
    abs(length(s1_name) - length(name))::DOUBLE AS name_len_diff, abs(length(s1_address) - length(address))::DOUBLE AS addr_len_diff FROM p"""


@query("er_native_features", NATIVE_SQL)
def native_features(spark, sf_dir):
    return prefix_pairs(spark, sf_dir).select("s1", "rid", *(F.round(c, 6).alias(n) for n, c in features.native_features().items()))


def floats(df: DataFrame, *keep: str) -> DataFrame:
    """The features rounded to six places, half up: of a float that isn't negative the product and the sum are exact, and no decimal is made."""
    return df.select(*keep, *((F.floor(F.col(n).cast("double") * 1e6 + 0.5) / 1e6).alias(n) for n in features.NAMES))


@query("er_pair_features", f"WITH {RECORDS}, p AS MATERIALIZED ({PREFIX_PAIRS}), f AS ({sql_similarities('p', 's1, rid')}) SELECT s1, rid, {sql_as_floats()} FROM f")
def pair_features(spark, sf_dir):
    return floats(features.pair_features(prefix_pairs(spark, sf_dir)), "s1", "rid")


@query("er_cheap_score", f"WITH {RECORDS}, p AS ({PREFIX_PAIRS}) SELECT s1, rid, round(0.6 * ({sql_ratio_bits('s1_name', 'name')}) + 0.4 * ({sql_ratio_bits('s1_address', 'address')}), 6) AS cheap_score FROM p")
def cheap_score(spark, sf_dir):
    return prefix_pairs(spark, sf_dir).select("s1", "rid", F.round(features.cheap_score(), 6).alias("cheap_score"))


# Truth, selection, metrics, validation ------------------------------------------------------


def labelled(spark, sf_dir) -> DataFrame:
    asked, targets = fixtures.indexed(spark, sf_dir)
    marked = selection.with_truth(blocking.training_passes(asked, targets, BASE), fixtures.truth(spark, sf_dir), targets)
    return blocking.with_records(marked, asked, targets)


def scored(spark, sf_dir) -> DataFrame:
    """The labelled pairs with a score; ``ord`` orders them but isn't dense."""
    asked, targets = (with_grams(x) for x in fixtures.indexed(spark, sf_dir))
    pairs = blocking.key_pairs(asked, targets, blocking.keyed_limits(BASE), fixtures.truth(spark, sf_dir), (*blocking.FIELDS, *GRAMS))
    return pairs.withColumn("score", F.round(0.58 * by_grams("name") + 0.42 * by_grams("address"), 6)).drop(*GRAMS, *(f"s1_{c}" for c in GRAMS))


@query("er_labelled_pairs", f"WITH {RECORDS}, {LABELLED} SELECT s1, rid, ord::INT AS ord, label FROM marked")
def labelled_pairs(spark, sf_dir):
    return labelled(spark, sf_dir).select("s1", "rid", "ord", "label")


@query("er_label_counts", f"WITH {RECORDS}, {LABELLED} SELECT count(*) AS pairs, sum(label)::BIGINT AS positives, sum(1 - label)::BIGINT AS negatives, round(avg(label), 6) AS positive_rate, count(DISTINCT s1) AS groups FROM marked")
def label_counts(spark, sf_dir):
    return metrics.label_counts(labelled(spark, sf_dir)).withColumn("positive_rate", F.round("positive_rate", 6))


POOL = f"""ranked AS (SELECT *, sum(label) OVER (PARTITION BY s1) AS pos, row_number() OVER (PARTITION BY s1, label ORDER BY score DESC, ord) AS place, count(*) OVER (PARTITION BY s1, label) AS n FROM scored),
    pool AS (SELECT * FROM ranked WHERE label = 1 OR n <= CASE WHEN pos > 0 THEN 18 * pos ELSE 9 END OR place <= CASE WHEN pos > 0 THEN 18 * pos ELSE 9 END)"""


@query("er_negative_pool", f"WITH {RECORDS}, {LABELLED}, {POOL} SELECT s1, rid, label, score FROM pool")
def negative_pool(spark, sf_dir):
    return selection.negative_pool(scored(spark, sf_dir), Training(), F.col("score")).select("s1", "rid", "label", "score")


def sql_selected(scored: str, hardness: str) -> str:
    """Positives and the chosen negatives of a table with s1, rid, label."""
    config = Training()
    return f"""sel1 AS (SELECT *, sum(label) OVER (PARTITION BY s1) AS pos, count(*) OVER (PARTITION BY s1, label) AS n, row_number() OVER (PARTITION BY s1, label ORDER BY {hardness} DESC, rid) AS place FROM {scored}),
    sel2 AS (SELECT *, least(n, CASE WHEN pos > 0 THEN {config.negatives_per_positive} * pos ELSE {config.singleton_negatives} END) AS k FROM sel1),
    sel3 AS (SELECT *, n <= k OR place <= greatest(1, round_even(k * {config.hard_fraction}, 0)) AS hard FROM sel2),
    sel4 AS (SELECT *, row_number() OVER (PARTITION BY s1, label ORDER BY CASE WHEN hard THEN place ELSE {1 << 30} END, CASE WHEN NOT hard THEN md5('{config.sample_seed}|' || s1 || '|' || rid) END NULLS FIRST, rid) AS turn FROM sel3),
    selected AS (SELECT * FROM sel4 WHERE label = 1 OR turn <= k)"""


@query("er_selected_pairs", f"WITH {RECORDS}, {LABELLED}, {sql_selected('scored', 'score')} SELECT s1, rid, label FROM selected")
def selected_pairs(spark, sf_dir):
    return selection.select_negatives(scored(spark, sf_dir), Training(), "score").select("s1", "rid", "label")


@query("er_select_negatives", f"""WITH {RECORDS}, {LABELLED}, sized AS (SELECT s1, sum(label) AS pos, sum(1 - label) AS neg FROM marked GROUP BY s1)
    SELECT s1, pos::BIGINT AS positives, least(neg, CASE WHEN pos > 0 THEN 6 * pos ELSE 3 END)::BIGINT AS negatives FROM sized""")
def select_negatives(spark, sf_dir):
    kept = selection.select_negatives(scored(spark, sf_dir), Training(), "score")
    return kept.groupBy("s1").agg(F.sum("label").cast("long").alias("positives"), F.sum(1 - F.col("label")).cast("long").alias("negatives"))


@query("er_group_split", f"WITH {RECORDS}, {LABELLED} SELECT s1, rid, ('0x' || left(md5('{Training().split_seed}|' || s1), 8))::BIGINT / {1 << 32}::DOUBLE >= {Training().train_share} AS is_validation FROM marked")
def group_split(spark, sf_dir):
    return selection.group_split(labelled(spark, sf_dir), Training()).select("s1", "rid", "is_validation")


COUNTS = "sum((score >= {t} AND label = 1)::INT)::BIGINT AS tp, sum((score >= {t} AND label = 0)::INT)::BIGINT AS fp, sum((score < {t} AND label = 1)::INT)::BIGINT AS fn, sum((score < {t} AND label = 0)::INT)::BIGINT AS tn"


def sql_rates(beta: float) -> str:
    p, r, b = "(CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0.0 END)", "(CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0.0 END)", beta * beta
    return f"round({p}, 6) AS precision, round({r}, 6) AS recall, round(CASE WHEN {b} * {p} + {r} > 0 THEN (1 + {b}) * {p} * {r} / ({b} * {p} + {r}) ELSE 0.0 END, 6) AS fbeta, round((tp + tn) / (tp + fp + fn + tn)::DOUBLE, 6) AS accuracy"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("er_confusion", f"WITH {RECORDS}, {LABELLED}, c AS (SELECT {COUNTS.format(t=0.5)} FROM scored) SELECT *, {sql_rates(1.0)} FROM c")
def confusion(spark, sf_dir):
    return rounded(metrics.accuracy(metrics.f_beta(metrics.confusion(scored(spark, sf_dir), 0.5))), "precision", "recall", "fbeta", "accuracy")


SWEEP = f"steps AS (SELECT 0.02::DOUBLE + i * ((0.98::DOUBLE - 0.02::DOUBLE) / 96) AS threshold FROM range(97) r(i)), c AS (SELECT threshold, {COUNTS.format(t='threshold')} FROM steps, scored GROUP BY threshold)"


@query("er_threshold_sweep", f"WITH {RECORDS}, {LABELLED}, {SWEEP} SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn, {sql_rates(0.5)} FROM c")
def threshold_sweep(spark, sf_dir):
    return rounded(metrics.threshold_sweep(scored(spark, sf_dir)), "threshold", "precision", "recall", "fbeta", "accuracy")


@query("er_best_threshold", f"WITH {RECORDS}, {LABELLED}, {SWEEP}, f AS (SELECT threshold, {sql_rates(0.5)} FROM c) SELECT round(threshold, 6) AS threshold, fbeta FROM f ORDER BY fbeta DESC, threshold LIMIT 1")
def best_threshold(spark, sf_dir):
    return rounded(metrics.best_threshold(metrics.threshold_sweep(scored(spark, sf_dir))), "threshold", "fbeta")


@query("er_roc_auc", f"""WITH {RECORDS}, {LABELLED}, r AS (SELECT label, row_number() OVER (ORDER BY score, s1, rid) AS rank FROM scored)
    SELECT round((sum(rank) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * sum(1 - label)), 6) AS auc FROM r""")
def roc_auc(spark, sf_dir):
    return rounded(metrics.roc_auc(scored(spark, sf_dir), ["s1", "rid"]), "auc")


@query("er_roc_auc_ties", f"""WITH {RECORDS}, {LABELLED}, r AS (SELECT label, score, row_number() OVER (ORDER BY score) AS rank FROM scored), m AS (SELECT label, avg(rank) OVER (PARTITION BY score) AS rank FROM r)
    SELECT round((sum(rank) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * sum(1 - label)), 6) AS auc FROM m""")
def roc_auc_ties(spark, sf_dir):
    return rounded(metrics.roc_auc(scored(spark, sf_dir), ["s1", "rid"], average_ties=True), "auc")


@query("er_match_lists", f"""WITH {RECORDS}, {LABELLED}, m AS (SELECT s1, string_agg(entity_id, ',' ORDER BY score DESC, ord, entity_id) AS ids FROM scored WHERE score >= 0.44 GROUP BY s1)
    SELECT q.s1, coalesce(m.ids, '') AS matched_entity_ids FROM q LEFT JOIN m USING (s1)""")
def match_lists(spark, sf_dir):
    pairs = scored(spark, sf_dir).where(F.col("score") >= 0.44)
    listed = lists.id_lists(pairs, [(-F.col("score")).alias("minus"), "ord"], "matched_entity_ids")
    return lists.for_all(fixtures.directory(spark, sf_dir)[0], listed, "matched_entity_ids")


def faulty_outputs(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lists with one stated fault of each kind for every so many documents."""
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("S1-"), "doc_id").alias("id"))
    ids = lambda *parts: F.concat_ws(",", *parts)
    matches = docs.where("doc_id % 11 <> 0").select(F.when(F.expr("doc_id % 13 = 0"), F.concat(F.lit("S1-x"), "doc_id")).otherwise(F.col("id")).alias("source1_entity_id"), F.when(F.expr("doc_id % 5 = 0"), F.lit("")).when(F.expr("doc_id % 29 = 0"), F.concat(F.lit("S2-"), "doc_id", F.lit(",,S3-"), "doc_id")).otherwise(ids(F.concat(F.lit("S2-"), "doc_id"), F.concat(F.when(F.expr("doc_id % 7 = 0"), F.lit("S9-")).otherwise(F.lit("S3-")), "doc_id"))).alias("matched_entity_ids"), "doc_id")
    again = matches.where("doc_id % 17 = 0")
    candidates = docs.where("doc_id % 19 <> 0").select(F.col("id").alias("source1_entity_id"), ids(F.concat(F.lit("S2-"), "doc_id"), F.concat(F.lit("S3-"), "doc_id")).alias("candidate_entity_ids"), F.lit(0).alias("ordinal"))
    later = docs.where("doc_id % 23 = 0").select(F.col("id").alias("source1_entity_id"), F.concat(F.lit("S2-"), "doc_id").alias("candidate_entity_ids"), F.lit(1).alias("ordinal"))
    return matches.unionAll(again).drop("doc_id"), candidates.unionAll(later), docs.select(F.col("id").alias("entity_id"))


FAULTS = """WITH docs AS (SELECT doc_id, 'S1-' || doc_id AS id FROM documents),
    m0 AS (SELECT doc_id, CASE WHEN doc_id % 13 = 0 THEN 'S1-x' || doc_id ELSE id END AS s1, CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 29 = 0 THEN 'S2-' || doc_id || ',,S3-' || doc_id ELSE 'S2-' || doc_id || ',' || CASE WHEN doc_id % 7 = 0 THEN 'S9-' ELSE 'S3-' END || doc_id END AS ids FROM docs WHERE doc_id % 11 <> 0),
    m AS (SELECT * FROM m0 UNION ALL SELECT * FROM m0 WHERE doc_id % 17 = 0),
    c AS (SELECT id AS s1, CASE WHEN doc_id % 23 = 0 THEN 'S2-' || doc_id ELSE 'S2-' || doc_id || ',S3-' || doc_id END AS ids FROM docs WHERE doc_id % 19 <> 0 OR doc_id % 23 = 0),
    mi AS (SELECT s1, unnest(string_split(ids, ',')) AS x FROM m WHERE ids <> ''),
    ci AS (SELECT DISTINCT s1, unnest(string_split(ids, ',')) AS x FROM c)
    SELECT 'duplicate_query' AS kind, coalesce(sum(n - 1), 0)::BIGINT AS errors FROM (SELECT count(*) AS n FROM m GROUP BY s1)
    UNION ALL SELECT 'bad_prefix', count(*) FROM mi WHERE NOT (x LIKE 'S2-%' OR x LIKE 'S3-%')
    UNION ALL SELECT 'missing_query', count(*) FROM (SELECT id FROM docs EXCEPT SELECT s1 FROM m)
    UNION ALL SELECT 'extra_query', count(*) FROM (SELECT s1 FROM m EXCEPT SELECT id FROM docs)
    UNION ALL SELECT 'not_a_candidate', count(*) FROM mi WHERE NOT EXISTS (SELECT 1 FROM ci WHERE ci.s1 = mi.s1 AND ci.x = mi.x)"""


@query("er_validate", FAULTS)
def faults(spark, sf_dir):
    matches, candidates, asked = faulty_outputs(spark, sf_dir)
    return validate.fault_counts(matches, candidates, asked, ordinal="ordinal")


@query("er_last_candidate_rows", "SELECT 'S1-' || doc_id AS source1_entity_id, CASE WHEN doc_id % 23 = 0 THEN 'S2-' || doc_id ELSE 'S2-' || doc_id || ',S3-' || doc_id END AS candidate_entity_ids FROM documents WHERE doc_id % 19 <> 0 OR doc_id % 23 = 0")
def last_candidate_rows(spark, sf_dir):
    return validate.last_rows(faulty_outputs(spark, sf_dir)[1], "source1_entity_id", "candidate_entity_ids", "ordinal")


@query("er_directory_truth", """WITH s AS (SELECT c_custkey AS k, n_name, n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
    p AS (SELECT k, 'S2-' || k AS entity_id, 1 AS same_country FROM s WHERE k % 2 = 0 UNION ALL SELECT k, 'S3-' || k, (k % 25 <> 0)::INT FROM s WHERE k % 3 = 0)
    SELECT 'S1-' || k AS s1, entity_id, same_country FROM p""")
def directory_truth(spark, sf_dir):
    return fixtures.corrupted_directory(spark, sf_dir)[1]


# Model ----------------------------------------------------------------------------------------


TRAINING = f"""
    cheap AS (SELECT *, 0.6 * ({sql_ratio_bits('s1_name', 'name')}) + 0.4 * ({sql_ratio_bits('s1_address', 'address')}) AS score FROM pairs),
    {POOL.replace('FROM scored', 'FROM cheap')},
    feat AS MATERIALIZED ({sql_similarities('pool', 's1, rid, label')}),
    rough AS (SELECT * REPLACE (combined::FLOAT AS combined) FROM feat), {sql_selected('rough', 'combined')}"""


@query("er_training_pairs", f"WITH {RECORDS}, {LABELLED}, {TRAINING} SELECT s1, rid, label, {sql_as_floats()} FROM selected")
def training_pairs(spark, sf_dir):
    from . import train

    asked, targets = fixtures.indexed(spark, sf_dir)
    return floats(train.training_pairs(asked, targets, fixtures.truth(spark, sf_dir), Settings()), "s1", "rid", "label")


def _predict(strategy: str):
    def run(spark, sf_dir):
        from . import predict, train

        settings = Settings()
        asked, targets = fixtures.indexed(spark, sf_dir)
        pairs = train.training_pairs(asked, targets, fixtures.truth(spark, sf_dir), settings).select("s1", "rid", "label", *features.NAMES)
        learned = staged(selection.group_split(pairs, settings.training), "training-pairs")
        stopped, calibrator, held, threshold = train.fit(learned, settings.training)
        held.unpersist()
        model = train.fit_trees(learned, settings.training, train.tree_count(stopped))
        found = predict.score_pairs(predict.candidates(asked, targets, index.postings(targets), settings, strategy), model, calibrator)
        # Both lists read the pairs, which are scored once.
        decided = staged(predict.decide(found, threshold, settings).select("s1", "entity_id", "ord", "score", "is_match"), "scored-pairs")
        matched, listed = predict.output_lists(asked, decided)
        return matched.join(listed, "s1")

    return run


QUERIES["er_predict_base"] = _predict("base")
QUERIES["er_predict_cascade"] = _predict("cascade")
