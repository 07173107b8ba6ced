"""Queries over the star-schema and text tables, each with the SQL that says the same.

They exercise the library's operators on tables that have the operators' shapes: keyed rows in order, labels by split,
nested values, sessions, JSON payloads.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curlew import schemas, vocabulary
from curlew.functions import capabilities, hashing, responses, scores, shapes, text, walks
from curlew.operators import contracts, dedup, joins, reports, splits
from curlew.plans import audits, corpus_build, policy_eval, sft_prep
from curlew.sources import jsonl, sinks
from curlew.streaming import coverage, sessions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(rows: DataFrame) -> DataFrame:
    """A table as read, with __at: a row's place by file and row, which settles what an ORDER BY leaves open."""
    row = F.col("_metadata.row_index")
    return rows.withColumn("__at", F.struct(F.col("_metadata.file_path"), row) if len(rows.inputFiles()) > 1 else row)


# Predictions joined to truths, scored, reported by tool with a null bucket
def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, F.lit("tool_call")).otherwise(F.lit("stop")).alias("truth_kind"), "toxic")
    said = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") > 1000, F.lit("tool_call")).otherwise(F.lit("stop")).alias("said_kind"), "lang", "source")
    both = joins.step_join(said, truth, "doc_id")
    same = F.col("truth_kind") == F.col("said_kind")
    return both.select(
        "doc_id", F.when(F.col("truth_kind") == "tool_call", F.col("lang")).alias("truth_tool"), (same & (F.col("lang") == "en")).alias("exact"), same.alias("tool_match"), (F.col("toxic") == 0).alias("contract_valid"),
        (F.col("truth_kind") == "stop").alias("truth_is_stop"), (same & (F.col("truth_kind") == "stop")).alias("stop_match"),
    )


_OUTCOMES_SQL = """
outcomes AS (
    SELECT d.doc_id, CASE WHEN l.quality = 1 THEN d.lang END AS truth_tool, (l.quality = 1) = (d.n_chars > 1000) AND d.lang = 'en' AS exact, (l.quality = 1) = (d.n_chars > 1000) AS tool_match,
        l.toxic = 0 AS contract_valid, l.quality <> 1 AS truth_is_stop, l.quality <> 1 AND d.n_chars <= 1000 AS stop_match
    FROM documents d JOIN labels l USING (doc_id))
"""
_REPORT_SQL = """count(*) AS parsed, count(*) FILTER (exact) AS exact_count, count(*) FILTER (tool_match) AS tool_count, count(*) FILTER (contract_valid) AS contract_valid_count,
    count(*) FILTER (truth_is_stop) AS stop_truths, count(*) FILTER (stop_match) AS stop_matches"""
_RATES_SQL = """CASE WHEN total = 0 THEN 0 ELSE exact_count / total END AS exact_rate, CASE WHEN total = 0 THEN 0 ELSE tool_count / total END AS tool_rate,
    CASE WHEN total = 0 THEN 0 ELSE contract_valid_count / total END AS contract_valid_rate, CASE WHEN stop_truths = 0 THEN 0 ELSE stop_matches / stop_truths END AS stop_rate"""


@query(f"WITH {_OUTCOMES_SQL}, r AS (SELECT {_REPORT_SQL}, count(*) + 7 AS total FROM outcomes) SELECT *, {_RATES_SQL} FROM r")
def policy_eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.evaluation_report(_outcomes(spark, sf_dir), invalid=7)


@query(f"WITH {_OUTCOMES_SQL}, r AS (SELECT truth_tool, {_REPORT_SQL}, count(*) AS total FROM outcomes GROUP BY truth_tool) SELECT *, {_RATES_SQL} FROM r")
def policy_eval_by_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.evaluation_report(_outcomes(spark, sf_dir), by="truth_tool")


# gates: readiness, minimum pass rate, maximum drop rate
@query(f"""WITH {_OUTCOMES_SQL}, r AS (SELECT count(*) AS n, count(DISTINCT truth_tool) AS families, avg(tool_match::INT) AS rate FROM outcomes)
SELECT CASE WHEN NOT n >= 100 THEN 'trajectories' WHEN NOT families >= 3 THEN 'families' WHEN NOT rate >= 0.9 THEN 'exact_rate' END AS first_failing, n >= 100 AND families >= 3 AND rate >= 0.9 AS passed FROM r""")
def readiness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _outcomes(spark, sf_dir).agg(F.count("*").alias("n"), F.countDistinct("truth_tool").alias("families"), F.avg(F.col("tool_match").cast("int")).alias("rate"))
    return reports.failing([("trajectories", F.col("n") >= 100), ("families", F.col("families") >= 3), ("exact_rate", F.col("rate") >= 0.9)], report)


# C1's trap: repeated truths, the last wins
@query("""WITH t AS (SELECT user_id, arg_max(event_id, event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id)
SELECT c.c_custkey AS user_id, c.c_nationkey, t.event_id, t.event_type, round(t.value, 6) AS value FROM customer c JOIN t ON t.user_id = c.c_custkey""")
def last_wins_dedup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", F.col("event_id").alias("ord"))
    said = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_nationkey")
    return joins.step_join(said, truth, "user_id", "ord").select("user_id", "c_nationkey", "event_id", "event_type", F.round("value", 6).alias("value"))


# Duplicates by digest
def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", hashing.sha256(F.col("text")).alias("digest"))


@query("""SELECT doc_id, sha256(text) AS digest, row_number() OVER w AS duplicate_index, row_number() OVER w <= 2 AS kept FROM documents WINDOW w AS (PARTITION BY sha256(text) ORDER BY doc_id)""")
def duplicate_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.cap_duplicates(_hashed(spark, sf_dir), "digest", "doc_id", 2).select("doc_id", "digest", "duplicate_index", "kept")


@query("""WITH c AS (SELECT sha256(text) AS h, count(*) AS n FROM documents GROUP BY 1)
SELECT sum(n)::BIGINT AS rows, count(*) AS unique_rows, count(*) FILTER (n > 1) AS duplicate_hashes, sum(n - 1)::BIGINT AS extra_rows, max(n) AS max_count FROM c""")
def duplicate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_summary(_hashed(spark, sf_dir), "digest")


@query("""WITH r AS (SELECT sha256(text) AS digest, doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents)
SELECT a.digest, a.doc_id AS first_position, b.doc_id AS second_position FROM r a JOIN r b ON a.digest = b.digest AND a.n = 1 AND b.n = 2""")
def duplicate_key_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.repeated_keys(_hashed(spark, sf_dir), "digest", "doc_id")


# Overlap of train and eval
@query("""WITH d AS (SELECT doc_id, sha256(text) AS digest, doc_id % 10 < 8 AS train FROM documents),
e AS (SELECT * FROM d WHERE NOT train) SELECT doc_id, digest, CASE WHEN digest IN (SELECT digest FROM d WHERE train) THEN 'dropped' ELSE 'kept' END AS status FROM e""")
def eval_overlap_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _hashed(spark, sf_dir).select("doc_id", "digest")
    held = F.col("doc_id") % 10 >= 8
    kept, dropped = joins.overlap(docs.filter(~held), docs.filter(held), "digest")
    return kept.withColumn("status", F.lit("kept")).unionByName(dropped.withColumn("status", F.lit("dropped")))


@query("SELECT count(*) AS overlap_hashes FROM (SELECT sha256(text) FROM documents WHERE doc_id % 10 < 8 INTERSECT SELECT sha256(text) FROM documents WHERE doc_id % 10 >= 8)")
def overlap_hash_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _hashed(spark, sf_dir)
    return dedup.overlap_count(docs.filter("doc_id % 10 < 8"), docs.filter("doc_id % 10 >= 8"), "digest")


# The stable shuffle and its splits
_FNV_SQL = """list_reduce(list_prepend(({seed})::HUGEINT, list_transform(range(1, length({x}) + 1), lambda i: ord(substr({x}, i::BIGINT, 1))::HUGEINT)),
    lambda acc, b: (xor(acc, b) * 1099511628211::HUGEINT) % 18446744073709551616::HUGEINT)"""
_SEED = 0xCBF29CE484222325 ^ 7


@query(f"""WITH k AS (SELECT conv_id, turn, '[' || conv_id || ',' || turn || ']' AS payload FROM conversations),
h AS (SELECT *, {_FNV_SQL.format(seed=_SEED, x="payload")} AS h FROM k), n AS (SELECT *, row_number() OVER (ORDER BY h, payload) AS r, count(*) OVER () AS c FROM h)
SELECT conv_id, turn, lower(printf('%016x', h::UBIGINT)) AS hash, CASE WHEN r <= greatest(1, round_even(c * 0.15, 0)) THEN 'eval' ELSE 'train' END AS split FROM n""")
def stable_shuffle_row_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    payload = F.concat(F.lit("["), F.col("conv_id"), F.lit(","), F.col("turn"), F.lit("]"))
    return splits.row_split(rows, payload, 0.15, 7).withColumn("hash", hashing.fnv1a64(payload, 7))


@query(f"""WITH g AS (SELECT 'conv:' || conv_id AS grp, count(*) AS n FROM conversations GROUP BY 1), p AS (SELECT *, '"' || grp || '"' AS payload FROM g),
h AS (SELECT *, {_FNV_SQL.format(seed=_SEED, x="payload")} AS h FROM p),
s AS (SELECT *, sum(n) OVER (ORDER BY h, payload) - n AS before, row_number() OVER (ORDER BY h, payload) AS place, sum(n) OVER () AS total, count(*) OVER () AS groups FROM h)
SELECT grp, n, CASE WHEN before < greatest(1, round_even(total * 0.2, 0)) AND place < greatest(1, groups) THEN 'eval' ELSE 'train' END AS split FROM s""")
def group_ratio_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.concat(F.lit("conv:"), F.col("conv_id")).alias("grp"))
    return splits.group_ratio_split(rows, "grp", hashing.json_string(F.col("grp")), 0.2, 7)


@query("""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN r > n - greatest(1, ceil(n * 0.1)) THEN 'eval' ELSE 'train' END AS split FROM r""")
def tail_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return splits.tail_split(orders, ["o_orderdate", "o_orderkey"], splits.tail_size(orders.count(), 0.1)).select("o_orderkey", "split")


@query("""WITH g AS (SELECT c_mktsegment AS grp, c_nationkey % 5 AS b FROM customer), s AS (SELECT grp, b, count(*) AS n FROM g GROUP BY ALL)
SELECT b AS bucket, count(DISTINCT grp) AS groups, sum(n)::BIGINT AS rows FROM s GROUP BY b""")
def capability_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").withColumn("caps", F.array((F.col("c_nationkey") % 5).cast("string")))
    found = reports.capability_groups(rows, "c_mktsegment", F.col("caps"), [str(x) for x in range(5)])
    return found.select(F.col("capability").cast("long").alias("bucket"), "groups", "rows")


@query()
def capability_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the greedy cover over order priorities as groups, ship modes as capabilities. Tested against a plain loop."""
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id")).alias("grp"), "event_type")
    counted = rows.groupBy("grp", "event_type").agg(F.count("*").alias("n"))
    per_group = counted.groupBy("grp").agg(F.sum("n").alias("rows"), F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("caps"))
    shuffled = [(r["grp"], r["rows"], r["caps"]) for r in per_group.orderBy(hashing.stable_shuffle_key(hashing.json_string(F.col("grp")), 7)).collect()]
    required = [r["event_type"] for r in rows.select("event_type").distinct().orderBy("event_type").collect()]
    chosen = splits.capability_cover(shuffled, required, least_eval=20, least_train=1)
    return spark.createDataFrame([(g, i + 1) for i, g in enumerate(chosen)], "grp string, place int")


# D16-D19, and D12's grouping over labels of events; H28 and H29, of trajectories, are curlew/functions/capabilities.py and labels.py
def _event_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    labels = F.concat(F.array(F.concat(F.lit("tool:"), F.col("event_type"))), scores.window_labels((k % 12), (F.col("value") / 5).cast("int")))
    return table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("g"), F.col("user_id") % 50).alias("grp"), F.when(F.col("event_id") % 10 == 0, "eval").otherwise("train").alias("split"), labels.alias("labels"))


_LABELS_SQL = """
l AS (SELECT event_id, 'g' || (user_id % 50) AS grp, CASE WHEN event_id % 10 = 0 THEN 'eval' ELSE 'train' END AS split, 'tool:' || event_type AS tool, (props->>'k')::INT % 12 AS b, trunc(value / 5)::INT AS e FROM events),
long AS (SELECT event_id, grp, split, tool AS label FROM l UNION ALL SELECT event_id, grp, split, 'window:expand' FROM l WHERE b > 6 OR e > 12 UNION ALL SELECT event_id, grp, split, 'window:shrink' FROM l WHERE b < 6 OR e < 12)
"""


@query(f"WITH {_LABELS_SQL} SELECT split, label, count(*) AS n FROM long GROUP BY ALL UNION ALL SELECT 'all', label, count(*) FROM long GROUP BY label")
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.label_distribution(_event_labels(spark, sf_dir), F.col("labels"))


_REQUIRED = ("tool:click", "tool:error", "tool:refund", "tool:view", "window:expand", "window:shrink", "window:stop_sufficient")


@query(f"""WITH {_LABELS_SQL}, req AS (SELECT unnest({list(_REQUIRED)}) AS capability), c AS (SELECT capability, count(event_id) AS n FROM req LEFT JOIN long ON label = capability GROUP BY 1)
SELECT count(*) FILTER (n > 0) AS covered, count(*) AS total, round_even(count(*) FILTER (n > 0) * 100.0::DOUBLE / count(*), 4) AS percent, coalesce(string_agg(capability, ',' ORDER BY capability) FILTER (n = 0), '') AS missing FROM c""")
def coverage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.coverage_summary(reports.capability_groups(_event_labels(spark, sf_dir), "grp", F.col("labels"), _REQUIRED))


@query("SELECT coalesce(props->>'missing', 'unknown') AS key, count(*) AS n FROM events GROUP BY 1")
def count_by_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_by(table(spark, sf_dir, "events"), F.get_json_object("props", "$.missing"))


# Patterns that must not occur
_PATTERNS = {"mail": r"[a-z]+\.\d\d@mail\d\.example\.com", "octets": r"\b\d{1,3}(\.\d{1,3}){3}\b", "key": r"token\s*=", "license": "licen[cs]e"}


@query("SELECT doc_id, name AS pattern FROM documents, (VALUES " + ", ".join(f"('{n}', '(?i){p}')" for n, p in _PATTERNS.items()) + ") p(name, pattern) WHERE regexp_matches(text, pattern)")
def forbidden_pattern_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.explode(text.matches_any(F.col("text"), _PATTERNS)).alias("pattern"))


# First-seen numbering
@query("""WITH f AS (SELECT ts::DATE AS day, user_id, min(event_id) AS first FROM events GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, user_id, printf('ref_%04d', row_number() OVER (PARTITION BY day ORDER BY first)) AS alias FROM f""")
def first_seen_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "user_id").agg(F.min("event_id").alias("first"))
    number = F.row_number().over(Window.partitionBy("day").orderBy("first"))
    return first.select("day", "user_id", text.numbered("ref", number).alias("alias"))


# The k-th occurrences paired
@query("""WITH r AS (SELECT role, conv_id * 1000 + turn AS ord, conv_id % 3 AS side, text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY side, role ORDER BY ord) AS k FROM r WHERE side < 2),
p AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY ord) AS k FROM r WHERE side = 2 AND length(text) > 20)
SELECT p.role, p.k AS occurrence, p.ord, a.ord AS raw_ord, b.ord AS model_ord FROM p LEFT JOIN (SELECT * FROM n WHERE side = 0) a ON a.role = p.role AND a.k = p.k LEFT JOIN (SELECT * FROM n WHERE side = 1) b ON b.role = p.role AND b.k = p.k""")
def kth_occurrence_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("role", (F.col("conv_id") * 1000 + F.col("turn")).alias("ord"), (F.col("conv_id") % 3).alias("side"), "text")
    raw, model = (rows.filter(F.col("side") == x).select("role", "ord") for x in (0, 1))
    return joins.kth_pairs(raw, model, rows.filter("side = 2"), "role", "ord", F.length("text") > 20).select("role", "occurrence", "ord", "raw_ord", "model_ord")


# Two versions compared
def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    before = docs.filter("doc_id % 7 <> 0").select("doc_id", F.col("lang").alias("capability"), scores.row_score(F.col("quality") == 1, [F.col("toxic") == 0, F.col("n_chars") > 1500]).alias("score"), (F.col("n_chars") > 2000).alias("exact"))
    after = docs.filter("doc_id % 5 <> 0").select("doc_id", F.when(F.col("doc_id") % 11 > 0, F.col("lang")).alias("capability"), scores.row_score(F.col("quality") == 1, [F.col("toxic") == 0, F.col("n_chars") > 1000]).alias("score"), (F.col("n_chars") > 2500).alias("exact"))
    both = joins.outer_delta(before, after, "doc_id")
    b, a = F.coalesce(F.col("before")["score"], F.lit(0)), F.coalesce(F.col("after")["score"], F.lit(0))
    return both.select(
        "doc_id", F.coalesce(F.col("after")["capability"], F.col("before")["capability"], F.lit("unknown")).alias("capability"), b.alias("before_score"), a.alias("after_score"), (a - b).alias("delta"),
        scores.verdict(F.col("before").isNotNull(), F.col("after").isNotNull(), b, a, F.col("after")["exact"]).alias("verdict"),
    )


_VERSIONS_SQL = """
d AS (SELECT * FROM documents JOIN labels USING (doc_id)),
b AS (SELECT doc_id, lang AS c, (quality = 1)::INT + (toxic = 0)::INT + (n_chars > 1500)::INT AS s FROM d WHERE doc_id % 7 <> 0),
a AS (SELECT doc_id, CASE WHEN doc_id % 11 > 0 THEN lang END AS c, (quality = 1)::INT + (toxic = 0)::INT + (n_chars > 1000)::INT AS s, n_chars > 2500 AS exact FROM d WHERE doc_id % 5 <> 0),
v AS (SELECT doc_id, coalesce(a.c, b.c, 'unknown') AS capability, coalesce(b.s, 0) AS before_score, coalesce(a.s, 0) AS after_score, coalesce(a.s, 0) - coalesce(b.s, 0) AS delta,
    CASE WHEN b.s IS NULL THEN 'missing_baseline' WHEN a.s IS NULL THEN 'missing_candidate' WHEN a.s > b.s THEN 'improved' WHEN a.s < b.s THEN 'regressed' WHEN exact THEN 'stable_correct' ELSE 'stable_gap' END AS verdict
    FROM b FULL OUTER JOIN a USING (doc_id))
"""


@query(f"WITH {_VERSIONS_SQL} SELECT * FROM v")
def version_delta_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versions(spark, sf_dir)


@query(f"WITH {_VERSIONS_SQL}, c AS (SELECT capability, verdict, count(*) AS n, sum(delta) AS delta FROM v GROUP BY ALL) SELECT capability, string_agg(verdict || '=' || n, ',' ORDER BY verdict) AS verdicts, sum(delta)::BIGINT AS net_score_delta FROM c GROUP BY capability")
def version_delta_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _versions(spark, sf_dir).groupBy("capability", "verdict").agg(F.count("*").alias("n"), F.sum("delta").alias("delta"))
    return counts.groupBy("capability").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "verdict", "n"))), ",").alias("verdicts"), F.sum("delta").alias("net_score_delta"))


# I1-I9 as a pattern: all violations collected in order, and the combinators
@query("""WITH o AS (SELECT o_orderkey, o_orderpriority, o_totalprice, c_nationkey, c_acctbal FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
v AS (SELECT o_orderkey, list_filter([CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'tool_outside_mode' END, CASE WHEN c_nationkey % 4 = 0 THEN 'unknown_dimension' END, CASE WHEN c_acctbal <= 0 THEN 'budget_exhausted' END], lambda x: x IS NOT NULL) AS codes,
    CASE WHEN c_nationkey % 4 = 0 THEN 'unknown_dimension' WHEN c_acctbal <= 0 THEN 'budget_exhausted' END AS both_code, CASE WHEN c_nationkey % 4 = 0 AND c_acctbal <= 0 THEN 'budget_exhausted' END AS either_code FROM o)
SELECT o_orderkey, array_to_string(codes, ',') AS codes, both_code, either_code FROM v""")
def contract_specs_collect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"), "left")
    mode = contracts.violation(~F.array_contains(F.array(*(F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM"))), F.col("o_orderpriority")), "tool_outside_mode", "priority", "outside")
    dim = contracts.violation(F.col("c_nationkey") % 4 == 0, "unknown_dimension", "nation", "unknown")
    budget = contracts.violation(F.col("c_acctbal") <= 0, "budget_exhausted", "balance", "none left")
    found = contracts.collect(mode, dim, budget)
    return rows.select("o_orderkey", F.array_join(found["code"], ",").alias("codes"), contracts.both(dim, budget)["code"].alias("both_code"), contracts.either(dim, budget)["code"].alias("either_code"))


# Zero-filled reports and what is missing
@query("""SELECT n.n_name AS n_name, count(o_orderkey) AS orders, coalesce(round(sum(o_totalprice), 2), 0) AS total FROM nation n LEFT JOIN (SELECT * FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING' AND o_orderdate >= TIMESTAMP '1998-07-01') x ON x.c_nationkey = n.n_nationkey GROUP BY 1""")
def zero_filled_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= F.lit("1998-07-01").cast("timestamp_ntz")))
    rows = orders.join(table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'"), F.col("c_custkey") == F.col("o_custkey")).join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return reports.zero_filled_by(rows, table(spark, sf_dir, "nation"), "n_name", {"orders": F.count("*"), "total": F.round(F.sum("o_totalprice"), 2)})


@query("SELECT n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def missing_from_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "supplier").filter("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey"))
    return joins.missing_from(table(spark, sf_dir, "nation"), known, "n_nationkey").select("n_name")


# What a zero denominator gives
@query("""WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_quantity > 45) AS part, count(*) FILTER (l_quantity > 50) AS whole FROM lineitem GROUP BY ALL)
SELECT l_returnflag, l_linestatus, part / n AS rate, CASE WHEN whole = 0 THEN 0.0 ELSE part / whole END AS zero_rate, CASE WHEN whole = 0 THEN NULL ELSE part / whole END AS null_rate, CASE WHEN whole = 0 THEN 1.0 ELSE part / whole END AS one_rate FROM c""")
def rate_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.count_if(F.col("l_quantity") > 45).alias("part"), F.count_if(F.col("l_quantity") > 50).alias("whole"))
    part, whole = F.col("part"), F.col("whole")
    return c.select("l_returnflag", "l_linestatus", scores.rate(part, F.col("n")).alias("rate"), scores.rate(part, whole).alias("zero_rate"), scores.rate(part, whole, None).alias("null_rate"), scores.rate(part, whole, 1.0).alias("one_rate"))


# The ratchet over ordered steps
@query("""WITH s AS (SELECT user_id, list_prepend(1.0::DOUBLE, list(least(1.0, value / 100) ORDER BY event_id)) AS v, count(*) AS n FROM events GROUP BY user_id)
SELECT user_id, n AS steps, round(list_reduce(v, lambda a, x: least(a, 0.5::DOUBLE * x + 0.5::DOUBLE * a)), 9) AS deviation FROM s""")
def ewma_ratchet_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.struct("event_id", F.least(F.lit(1.0), F.col("value") / 100).alias("x"))
    found = table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_sort(F.collect_list(step)).alias("s"), F.count("*").alias("steps"))
    return found.select("user_id", "steps", F.round(coverage.ratchet(F.transform("s", lambda z: z["x"])), 9).alias("deviation"))


@query()
def coverage_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole estimate per user, signals made of the events' columns. Tested against a plain fold."""
    k, cents = F.get_json_object("props", "$.k").cast("long"), (F.col("value") * 100).cast("long")
    signals = F.struct(
        (k % 7).alias("coverage_requested"), (k % 5).alias("coverage_missing"), (k % 2 == 0).alias("page_has_more"), (cents % 9).alias("page_returned"), (cents % 13).alias("page_total"),
        (k % 4).alias("frontier_size"), (F.when(k % 31 == 0, 1).otherwise(0)).cast("long").alias("conflicts"), (F.col("event_type") == "error").alias("confidence_is_unknown"), (F.col("event_type") == "view").alias("answer_is_null"),
        (cents % 3).alias("unvisited_links"), (cents % 4).alias("total_links"),
    )
    steps = table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"), F.col("event_id").alias("step_idx"), signals.alias("signals"), (cents % 2).alias("new_refs"))
    return coverage.fold_steps(steps).select("session_id", "state.*")


# Sessions in order
def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type") == "error", "stop").otherwise("tool_call")
    return e.select(F.col("user_id").alias("session_id"), F.col("event_id").alias("step_idx"), kind.alias("kind"), F.when(F.col("event_type") == "click", "kernel_wake").otherwise("kernel_near").alias("tool"), (F.col("value") > 10).alias("succeeded"), F.concat(F.lit("about:"), F.floor("value")).alias("wake_about"))


@query("""WITH s AS (SELECT user_id AS session_id, event_id AS step_idx, event_type <> 'error' AS call FROM events), b AS (SELECT *, greatest(0, 20 - coalesce(sum(call::INT) OVER (PARTITION BY session_id ORDER BY step_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS calls_left FROM s)
SELECT session_id, step_idx, calls_left, call AND calls_left <= 0 AS budget_failed FROM b""")
def session_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.budget_left(_steps(spark, sf_dir), F.lit(20)).select("session_id", "step_idx", "calls_left", "budget_failed")


@query("""SELECT user_id AS session_id, event_id AS step_idx, coalesce(last_value(CASE WHEN event_type = 'click' AND value > 10 THEN 'about:' || floor(value)::BIGINT END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'about:start') AS current_about FROM events""")
def session_current_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.current_scope(_steps(spark, sf_dir), F.lit("about:start")).select("session_id", "step_idx", "current_about")


@query("SELECT user_id AS session_id, arg_max(value, event_id) FILTER (event_type = 'purchase') AS value FROM events GROUP BY user_id")
def session_last_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id"), F.col("event_id").alias("step_idx"), F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"))
    return sessions.last_signals(e, "value")


@query("""WITH k AS (SELECT user_id, event_id, printf('%d:%04d', user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) AS id FROM events WHERE event_type <> 'error') SELECT user_id AS session_id, event_id AS step_idx, id, 'step:' || id AS step_id FROM k""")
def transcript_to_trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = _steps(spark, sf_dir).withColumn("observation", F.when(F.col("kind") == "tool_call", "tool_response").otherwise("tool_error")).withColumn("outcome", F.lit(None).cast("string"))
    return sessions.expand_transcript(steps).select("session_id", "step_idx", "id", "step_id")


# Marginal yield
@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem), x AS (SELECT p.p_size AS session_id, l.l_orderkey AS step_idx, l.l_suppkey AS ref FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
f AS (SELECT session_id, ref, min(step_idx) AS first FROM x WHERE ref <> 1 GROUP BY ALL), c AS (SELECT x.session_id, x.step_idx, count(f.ref) AS new_refs FROM x LEFT JOIN f ON f.session_id = x.session_id AND f.ref = x.ref AND f.first = x.step_idx GROUP BY ALL) SELECT * FROM c""")
def marginal_yield(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    steps = x.groupBy(F.col("p_size").alias("session_id"), F.col("l_orderkey").alias("step_idx")).agg(F.collect_list(F.col("l_suppkey").cast("string")).alias("refs"))
    return sessions.new_refs(steps, F.col("refs"), F.array(F.lit("1")))


# Missing, null and wrongly typed keys
@query("""SELECT event_id, json_type(props, '$.k') = 'UBIGINT' AS has_k, json_type(props, '$.z') IS NOT NULL AS has_z, CASE WHEN json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') THEN (props->>'k')::BIGINT ELSE 0 END AS k,
    json_extract(json_object('a', NULL), '$.a') IS NOT NULL AS null_is_there, CASE WHEN len(list_filter(json_keys(props), lambda x: x <> 'k')) > 0 THEN 'unexpected' ELSE NULL END AS problem FROM events""")
def json_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = responses.variant(F.col("props"))
    there = F.try_variant_get(v, "$.k", "variant")
    return table(spark, sf_dir, "events").select(
        "event_id", F.coalesce(F.schema_of_variant(there) == "BIGINT", F.lit(False)).alias("has_k"), F.try_variant_get(v, "$.z", "variant").isNotNull().alias("has_z"), responses.number_at(v, "$.k").alias("k"),
        responses.null_at(responses.variant(F.lit('{"a":null}')), "$.a").alias("null_is_there"), F.split_part(responses.keys_problem(v, F.col("props"), ["k"], []), F.lit(":"), F.lit(1)).alias("problem"),
    )


# Membership and covers
@query("""WITH o AS (SELECT l_orderkey, list_sort(list_distinct(list(l_suppkey))) AS known, list_sort(list_distinct(list(l_partkey % 20))) AS expected FROM lineitem GROUP BY 1),
u AS (SELECT *, list_sort(list_filter(expected, lambda x: NOT list_contains(known, x))) AS unc FROM o) SELECT l_orderkey, len(known) AS known, len(expected) AS expected, array_to_string(unc, ',') AS uncovered, len(unc) = 0 AS covered FROM u""")
def coverage_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("known"), F.collect_set(F.col("l_partkey") % 20).alias("expected"))
    left = F.array_sort(joins.uncovered(F.col("expected"), F.col("known")))
    return o.select("l_orderkey", F.size("known").alias("known"), F.size("expected").alias("expected"), F.array_join(left, ",").alias("uncovered"), (F.size(left) == 0).alias("covered"))


# Truncated lists with the overflow
@query("""WITH o AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS p FROM lineitem GROUP BY 1) SELECT l_orderkey, array_to_string(p[1:3], ',') AS kept, CASE WHEN len(p) > 3 THEN len(p) - 3 END AS truncated FROM o""")
def truncate_and_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("p"))
    return o.select("l_orderkey", F.array_join(F.transform(F.slice("p", 1, 3), lambda z: z["l_partkey"]), ",").alias("kept"), F.when(F.size("p") > 3, F.size("p") - 3).alias("truncated"))


# E5: the primary candidate
@query("""WITH r AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_size IN (1, 2, 3) THEN 0 ELSE 1 END, p_retailprice, p_partkey) AS n FROM part) SELECT p_brand, p_partkey AS ref FROM r WHERE n = 1""")
def primary_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("p_size") == 1, "anchor").when(F.col("p_size") == 2, "current").when(F.col("p_size") == 3, "target_question").otherwise("other")
    detail = F.struct(F.col("p_partkey").alias("ref"), role.alias("role"), F.round(F.col("p_retailprice") * 100).cast("long").alias("priority"))
    found = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_sort(F.collect_list(detail)).alias("details"))
    return found.select("p_brand", scores.primary_candidate(F.col("details"))["ref"].alias("ref"))


# Filters whose nulls differ
@query("""WITH e AS (SELECT event_id, CASE WHEN value > 5 THEN event_type END AS mode FROM events ORDER BY event_id LIMIT 5000 OFFSET 100) SELECT event_id, mode, mode IN ('click', 'view') IS TRUE AS included, NOT coalesce(mode IN ('error'), FALSE) AS not_excluded, coalesce(mode NOT IN ('purchase'), TRUE) AS read_profile FROM e""")
def mode_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from curlew.operators import filters

    rows = filters.window_of_rows(table(spark, sf_dir, "events").select("event_id", F.when(F.col("value") > 5, F.col("event_type")).alias("mode")), "event_id", 100, 5000)
    m = F.col("mode")
    return rows.select("event_id", "mode", filters.included(m, ["click", "view"]).alias("included"), filters.not_excluded(m, ["error"]).alias("not_excluded"), filters.passes_unless(m, ["purchase"]).alias("read_profile"))


# A count with its first examples
@query("""WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents WHERE n_chars < 1000) SELECT source, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) FILTER (k <= 10) AS examples FROM r GROUP BY source""")
def failure_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").filter("n_chars < 1000").select("source", "doc_id")
    return reports.first_examples(rows, "doc_id", "doc_id", 10, ["source"]).select("source", "n", F.array_join("examples", ",").alias("examples"))


# Oracles and accept rules per session
@query("""WITH s AS (SELECT user_id, arg_max(value, event_id) AS v, max(value) > 40 AS expanded, bool_or(event_type = 'error' AND value > 60) AS conflict, count(*) AS n FROM events GROUP BY user_id),
o AS (SELECT *, (v::BIGINT % 3) + (n % 2) AS remaining, CASE WHEN (v::BIGINT % 3) + (n % 2) = 0 THEN 'complete' WHEN n > 100 THEN 'saturated' ELSE 'incomplete' END AS label FROM (SELECT user_id, trunc(v)::BIGINT AS v, expanded, conflict, n FROM s))
SELECT user_id AS session_id, label, CASE WHEN label = 'incomplete' THEN remaining END AS remaining, CASE WHEN conflict THEN 'conflict' WHEN user_id % 3 = 0 AND n < 100 THEN 'missing_gold' WHEN NOT expanded THEN 'no_expansion' WHEN user_id % 3 <> 0 AND label <> 'complete' THEN label END AS drop_reason FROM o""")
def episode_accept_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("session_id")).agg(
        F.max_by("value", "event_id").cast("long").alias("v"), (F.max("value") > 40).alias("expanded"), F.bool_or((F.col("event_type") == "error") & (F.col("value") > 60)).alias("conflict"), F.count("*").alias("n")
    )
    signals = F.struct((F.col("v") % 3).alias("coverage_missing"), (F.col("n") % 2).alias("frontier_size"), F.lit(False).alias("page_has_more"))
    found = s.withColumn("o", sessions.oracle(signals, F.col("n") > 100))
    covered = F.when(F.col("session_id") % 3 == 0, F.col("n") >= 100)
    return found.select("session_id", F.col("o.label").alias("label"), F.col("o.remaining").alias("remaining"), sessions.episode_drop(F.col("conflict"), covered, F.col("expanded"), F.col("o.label")).alias("drop_reason"))


# strings
@query("""SELECT c_custkey, length(trim(c_name)) > 0 AS named, starts_with(c_name, 'Customer#') OR starts_with(c_name, 'X') AS prefixed, split_part(split_part(c_name || ':task:t' || c_nationkey || ':x', ':task:', 2), ':', 1) AS task,
    regexp_replace(c_name || '/' || c_mktsegment, '[^A-Za-z0-9._-]', '_', 'g') AS file, regexp_matches('sha256:' || md5(c_name), '^[a-z0-9_-]+:[0-9a-f]+$') AS hash_shape,
    replace(replace(c_name, '0000', '<four>'), '00', '<two>') AS replaced, lower(replace(replace(trim(c_mktsegment), '-', '_'), ' ', '_')) AS relation, c_mktsegment NOT IN ('SUPPORTS') AS accepted FROM customer""")
def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    pairs = F.array(*(F.struct(F.lit(a).alias("from"), F.lit(b).alias("to")) for a, b in (("00", "<two>"), ("0000", "<four>"))))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.non_empty(name).alias("named"), text.starts_with_any(name, ["Customer#", "X"]).alias("prefixed"), text.after_marker(F.concat(name, F.lit(":task:t"), F.col("c_nationkey"), F.lit(":x")), ":task:").alias("task"),
        text.safe_filename(F.concat_ws("/", name, "c_mktsegment")).alias("file"), text.content_hash_shape(F.concat(F.lit("sha256:"), F.md5(name))).alias("hash_shape"),
        text.replace_longest_first(name, pairs).alias("replaced"), text.normalise_relation(F.col("c_mktsegment")).alias("relation"), text.relation_accepted(F.col("c_mktsegment")).alias("accepted"),
    )


# Family counts that add up
@query("""WITH f AS (SELECT source AS family, count(*) AS n FROM documents GROUP BY 1) SELECT family, n, sum(n) OVER () = (SELECT count(*) FROM documents) AS adds_up FROM f""")
def family_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.groupBy(F.col("source").alias("family")).agg(F.count("*").alias("n"))
    total = found.agg(F.sum("n").alias("t")).crossJoin(docs.agg(F.count("*").alias("c")))
    return found.join(F.broadcast(total.select((F.col("t") == F.col("c")).alias("adds_up")))).select("family", "n", "adds_up")


# Set operations
@query("""WITH a AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1), b AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1)
SELECT (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS either_ids, (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS shared, (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_a, (SELECT count(*) = 0 FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS disjoint""")
def split_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    a, b = labels.filter("quality = 1").select("doc_id"), labels.filter("toxic = 1").select("doc_id")
    marks = a.distinct().withColumn("a", F.lit(1)).join(b.distinct().withColumn("b", F.lit(1)), "doc_id", "full_outer")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    return marks.agg(F.count("*").alias("either_ids"), F.count_if(both).alias("shared"), F.count_if(F.col("a").isNotNull() & F.col("b").isNull()).alias("only_a"), (F.count_if(both) == 0).alias("disjoint"))


# by length, stable
@query("SELECT conv_id, turn, row_number() OVER (ORDER BY length(text), conv_id, turn) AS place FROM conversations")
def sort_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    return splits.global_sums(rows, ["n", "conv_id", "turn"], F.lit(1), "place", splits.range_bucket(rows, "n")).select("conv_id", "turn", "place")


# The eight specifications of action contracts, on records made of order lines
@query("""WITH x AS (
    SELECT l_orderkey, l_linenumber, 'about:' || l_orderkey AS about, CASE l_linenumber % 3 WHEN 0 THEN 'read' WHEN 1 THEN 'write' ELSE 'full' END AS mode, l_suppkey % 6 AS pick,
        'node:' || (l_partkey % 5) AS ref, ['node:0', 'node:1', 'node:2'] AS refs, 'dim:' || (l_suppkey % 3) AS dim, ['dim:0', 'dim:1'] AS dims, l_partkey % 4 = 0 AS other, l_suppkey % 4 AS calls, l_partkey % 2 = 0 AS active
    FROM lineitem),
t AS (SELECT *, CASE pick WHEN 0 THEN 'kernel_inspect' WHEN 1 THEN 'kernel_wake' WHEN 2 THEN 'kernel_near' WHEN 3 THEN 'kernel_rewind' WHEN 4 THEN 'kernel_ingest' END AS tool FROM x),
v AS (SELECT *, tool IS NOT NULL AS is_call,
    CASE WHEN tool IS NOT NULL AND NOT (mode = 'full' OR (mode = 'write') = (pick = 4)) THEN 'tool_outside_mode' END AS a,
    CASE WHEN pick IN (1, 4) AND other THEN 'about_mismatch' END AS b,
    CASE WHEN pick = 0 AND NOT list_contains(refs, ref) THEN 'unknown_memory_ref' WHEN pick = 2 AND NOT list_contains(refs, ref) THEN 'unknown_memory_ref' WHEN pick = 2 AND NOT list_contains(dims, dim) THEN 'unknown_dimension' END AS c,
    CASE WHEN pick = 4 AND NOT list_contains(dims, dim) THEN 'unknown_dimension' END AS d,
    CASE WHEN pick = 4 AND NOT (list_contains(refs, ref) OR ref = 'node:4') THEN 'unknown_memory_ref' END AS e,
    CASE WHEN pick = 4 AND NOT (list_contains(refs, ref) OR ref = 'node:4') THEN 'unknown_memory_ref' END AS f,
    CASE WHEN pick = 3 AND NOT active THEN 'cursor_anchor_missing' END AS g,
    CASE WHEN tool IS NOT NULL AND calls <= 0 THEN 'budget_exhausted' END AS h FROM t)
SELECT l_orderkey, l_linenumber, array_to_string(list_filter([a, b, c, d, e, f, g, h], lambda z: z IS NOT NULL), ',') AS codes FROM v""")
def action_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick, ref, dim = F.col("l_suppkey") % 6, F.concat(F.lit("node:"), F.col("l_partkey") % 5), F.concat(F.lit("dim:"), F.col("l_suppkey") % 3)
    about = F.concat(F.lit("about:"), F.col("l_orderkey"))
    said = F.when(F.col("l_partkey") % 4 == 0, F.lit("about:other")).otherwise(about)
    text_of = lambda **parts: F.to_json(F.struct(*(c.alias(k) for k, c in parts.items())))
    coordinate = F.array(F.struct(dim.alias("dimension"), F.lit("s").alias("scope_id")))
    memory = F.struct(
        F.expr("cast(array() as array<struct<id:string>>)").alias("dimensions"), F.array(F.struct(F.lit("node:4").alias("id"), F.lit("k").alias("kind"), F.lit("t").alias("text"), coordinate.alias("coordinates"))).alias("entries"),
        F.array(F.struct(F.lit("node:4").alias("from"), ref.alias("to"), F.lit("answers").alias("rel"), F.lit("evidential").alias("class"))).alias("relations"), F.array(F.struct(F.lit("v").alias("id"), F.array(ref).alias("supports"), F.lit("t").alias("text"))).alias("evidence"),
    )
    args = F.when(pick == 0, text_of(target=ref)).when(pick == 1, text_of(about=said)).when(pick == 2, text_of(anchor=ref, dimensions=F.array(dim))).when(pick == 3, text_of(cursor_key=F.lit("created"), cursor_anchor=F.lit("x"), window=F.lit(3)))
    args = args.when(pick == 4, text_of(about=said, memory=memory, idempotency_key=F.lit("k")))
    tool = F.when(pick == 0, "kernel_inspect").when(pick == 1, "kernel_wake").when(pick == 2, "kernel_near").when(pick == 3, "kernel_rewind").when(pick == 4, "kernel_ingest")
    action = F.concat(F.lit('{"kind":"'), F.when(tool.isNull(), 'stop","reason":"no_candidate"').otherwise(F.concat(F.lit('tool_call","tool":"'), tool, F.lit('","arguments":'), args)), F.lit("}"))
    cursor = F.when(F.col("l_partkey") % 2 == 0, '{"kind":"temporal","key":"created","anchor":"y"}').otherwise("null")
    state = F.concat(F.lit('{"known_refs":["node:0","node:1","node:2"],"known_dimensions":["dim:0","dim:1"],"active_cursor":'), cursor, F.lit(',"budget":{"calls_remaining":'), F.col("l_suppkey") % 4, F.lit("}}"))
    mode = F.when(F.col("l_linenumber") % 3 == 0, "read").when(F.col("l_linenumber") % 3 == 1, "write").otherwise("full")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", about.alias("about"), mode.alias("mode"), F.from_json(state, schemas.STATE).alias("state"), F.from_json(action, schemas.ACTION).alias("action"))
    found = contracts.action_violations(F.struct("about", "mode", "state", "action"))
    return rows.select("l_orderkey", "l_linenumber", F.array_join(F.transform(found, lambda v: v["code"]), ",").alias("codes"))


# I10, E3's typing: trajectories that can't be built
@query("""WITH x AS (SELECT event_id, ['read', 'write', 'full', 'dance'][1 + user_id % 4] AS mode, event_id % 3 AS pick, event_id % 2 = 0 AS stops FROM events)
SELECT event_id, CASE WHEN mode = 'dance' THEN 'unknown_mode' WHEN pick = 1 THEN 'allowed_tools_mismatch' WHEN NOT stops AND mode = 'write' THEN 'tool_outside_mode' END AS problem FROM x""")
def trajectory_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = F.element_at(F.array(*(F.lit(m) for m in ("read", "write", "full", "dance"))), (F.col("user_id") % 4 + 1).cast("int"))
    tools = contracts.mode_tools(mode)
    listed = F.when(F.col("event_id") % 3 == 1, F.reverse(tools)).otherwise(tools)
    kind = F.when(F.col("event_id") % 2 == 0, "stop").otherwise("tool_call")
    action = F.struct(kind.alias("kind"), F.when(kind == "tool_call", "kernel_inspect").alias("tool"))
    return table(spark, sf_dir, "events").select("event_id", contracts.trajectory_problem(F.struct(mode.alias("mode"), listed.alias("allowed_tools"), action.alias("action"))).alias("problem"))


# The closed table of relations, their quality and classes
_RELATION_NAMES = (*vocabulary.RELATION_CLASSES, "has_evidence", "contains_entry")
_RELATION_VALUES = ", ".join(f"({i}, '{n}', '{q}', {list(c)})" for i, (n, (q, c)) in enumerate(vocabulary.RELATION_CLASSES.items()))


@query(f"""WITH r(i, rel, quality, classes) AS (VALUES {_RELATION_VALUES}), x AS (SELECT event_id, event_id % {len(_RELATION_NAMES)} AS i, {list(vocabulary.CLASSES)}[1 + user_id % 6] AS cls FROM events)
SELECT event_id, quality, list_contains(classes, cls) AS allowed FROM x LEFT JOIN r USING (i)""")
def relation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda names, i: F.element_at(F.array(*(F.lit(n) for n in names)), (i + 1).cast("int"))
    quality, allowed = contracts.relation_facts(pick(_RELATION_NAMES, F.col("event_id") % len(_RELATION_NAMES)), pick(vocabulary.CLASSES, F.col("user_id") % 6))
    return table(spark, sf_dir, "events").select("event_id", quality.alias("quality"), allowed.alias("allowed"))


# Shapes of tool calls and stops
@query("""WITH x AS (SELECT event_id, event_id % 8 AS pick, user_id % 130 AS n FROM events)
SELECT event_id, CASE pick WHEN 0 THEN CASE WHEN n < 1 THEN 'invalid_limit' WHEN n > 64 THEN 'limit_over_64' END WHEN 1 THEN 'argument_keys:missing=target;unexpected=ref' WHEN 2 THEN CASE WHEN n % 2 = 0 THEN 'invalid_target' END
    WHEN 3 THEN CASE WHEN n % 3 = 0 THEN 'invalid_cursor_key' END WHEN 4 THEN 'unknown_tool' WHEN 5 THEN CASE WHEN n % 4 > 0 THEN 'invalid_stop_reason' END
    WHEN 6 THEN CASE WHEN n % 5 = 0 THEN 'invalid_target_model' END ELSE 'unknown_action_kind' END AS problem FROM x""")
def bounded_action_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick, n = F.col("event_id") % 8, F.col("user_id") % 130
    call = lambda tool, *args: F.concat(F.lit(f'{{"kind":"tool_call","tool":"kernel_{tool}","arguments":{{'), *(F.lit(a) if isinstance(a, str) else a for a in args), F.lit("}}"))
    text = (
        F.when(pick == 0, call("near", '"anchor":"a","limit":', n.cast("string"))).when(pick == 1, call("inspect", '"ref":"a"')).when(pick == 2, call("inspect", '"target":"', F.when(n % 2 == 0, " ").otherwise("a"), '"'))
        .when(pick == 3, call("goto", '"cursor":{"kind":"temporal","anchor":"a","key":"', F.when(n % 3 == 0, "never").otherwise("updated"), '"}')).when(pick == 4, call("fly"))
        .when(pick == 5, F.concat(F.lit('{"kind":"stop","reason":"'), F.when(n % 4 > 0, "tired").otherwise("answer_ready"), F.lit('"}')))
        .when(pick == 6, F.when(n % 5 == 0, '{"kind":"escalate","reason":"low_confidence","target_model":null}').otherwise('{"kind":"escalate","reason":"low_confidence","target_model":"m"}')).otherwise('{"kind":"dance"}')
    )
    # parsed once, as a column of its own
    rows = table(spark, sf_dir, "events").select("event_id", responses.variant(text).alias("v"))
    return rows.select("event_id", shapes.action_problem(F.col("v")).alias("problem"))


# Relations and provenance that an ingest writes
@query(f"""WITH x AS (SELECT l_orderkey, l_linenumber, {list(_RELATION_NAMES)}[1 + l_partkey % {len(_RELATION_NAMES)}] AS rel, {[*vocabulary.CLASSES, 'vague']}[1 + l_suppkey % 7] AS cls,
    l_linenumber % 2 = 0 AS proven, ['high', NULL, 'sure'][1 + l_orderkey % 3] AS confidence, {[*vocabulary.SOURCE_KINDS, 'robot']}[1 + l_orderkey % 5] AS source FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN rel IN ('has_evidence', 'contains_entry') THEN 'invalid_relation_rel[0]' WHEN cls = 'vague' THEN 'invalid_relation_class[0]' WHEN cls <> 'structural' AND NOT proven THEN 'unproven_relation[0]'
    WHEN cls <> 'structural' AND confidence IS NULL THEN 'missing_relation_confidence[0]' WHEN confidence = 'sure' THEN 'invalid_relation_confidence[0]' WHEN source = 'robot' THEN 'invalid_provenance_source_kind' END AS problem FROM x""")
def bounded_ingest_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda names, i: F.element_at(F.array(*(F.lit(n) for n in names)), (i + 1).cast("int"))
    rel, cls, source = pick(_RELATION_NAMES, F.col("l_partkey") % len(_RELATION_NAMES)), pick((*vocabulary.CLASSES, "vague"), F.col("l_suppkey") % 7), pick((*vocabulary.SOURCE_KINDS, "robot"), F.col("l_orderkey") % 5)
    confidence = pick(("high", None, "sure"), F.col("l_orderkey") % 3)
    relation = F.to_json(F.struct(F.lit("a").alias("from"), F.lit("b").alias("to"), rel.alias("rel"), cls.alias("class"), F.when(F.col("l_linenumber") % 2 == 0, "w").alias("why"), confidence.alias("confidence")))
    text = F.concat(
        F.lit('{"kind":"tool_call","tool":"kernel_ingest","arguments":{"about":"a","idempotency_key":"k","dry_run":true,"provenance":{"source_agent":"x","observed_at":"t","source_kind":"'), source,
        F.lit('"},"memory":{"dimensions":[],"entries":[{"id":"e","kind":"k","text":"t","coordinates":[{"dimension":"d","scope_id":"s"}]}],"relations":['), relation, F.lit("]}}}"),
    )
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", responses.variant(text).alias("v"))
    return rows.select("l_orderkey", "l_linenumber", shapes.action_problem(F.col("v")).alias("problem"))


# A model's answer, read strictly and leniently
@query("""WITH x AS (SELECT event_id, event_id % 7 AS pick FROM events)
SELECT event_id, CASE pick WHEN 0 THEN 'empty_response' WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'incomplete_json' WHEN 3 THEN 'extra_content_after_json' WHEN 4 THEN 'json_not_object' WHEN 5 THEN 'missing_or_extra_top_level_fields' END AS problem,
    CASE WHEN pick IN (3, 6) THEN 'stop' WHEN pick = 5 THEN 'bare' END AS kind FROM x""")
def model_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = ("", "hello", '{"action":{"kind":', '{"action":{"kind":"stop"}} so', "[1]", '{"kind":"bare"}', ' {"action":{"kind":"stop"}} ')
    text = F.element_at(F.array(*(F.lit(s) for s in said)), (F.col("event_id") % 7 + 1).cast("int"))
    loose = shapes.lenient_action(F.regexp_replace(text, " so$", ""))
    return table(spark, sf_dir, "events").select("event_id", shapes.response_problem(text).alias("problem"), responses.string_at(loose, "$.kind").alias("kind"))


# Refs that a state shows and refs that an action needs, walked in JSON
@query("""WITH x AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS p, list(l_suppkey ORDER BY l_linenumber, l_partkey) AS s FROM lineitem GROUP BY 1),
y AS (SELECT l_orderkey, list_concat(list_transform(p[1:2], lambda z: 'n' || z), list_transform(p[3:3], lambda z: 'bug:' || z)) AS seen, list_concat(list_transform(p[2:4], lambda z: 'n' || z), list_transform(s[1:1], lambda z: 'n' || z)) AS wanted FROM x)
SELECT l_orderkey, array_to_string(list_sort(list_distinct(seen)), ',') AS visible, array_to_string(list_sort(list_distinct(wanted)), ',') AS needed, len(list_filter(list_distinct(wanted), lambda z: NOT list_contains(seen, z))) AS missing FROM y""")
def target_refs_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    # lines of one number and part keep the table's order
    lines = placed(table(spark, sf_dir, "lineitem")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "__at", "l_suppkey"))).alias("l"))
    named = lambda mark, column, a, n: F.transform(F.slice(F.transform("l", lambda z: z[column]), a, n), lambda z: F.concat(F.lit(mark), z.cast("string")))
    state = F.struct(named("n", "l_partkey", 1, 1).alias("known_refs"), F.struct(F.array(F.struct(named("n", "l_partkey", 2, 1).alias("refs"))).alias("trace_paths")).alias("read_context"), F.struct(F.array(named("bug:", "l_partkey", 3, 1)).alias("deep"), F.lit("n0").alias("no_ref")).alias("draft_write"))
    relations = F.transform(named("n", "l_partkey", 2, 3), lambda r: F.struct(r.alias("from"), F.lit(None).cast("string").alias("to")))
    action = F.struct(F.lit("tool_call").alias("kind"), F.struct(F.struct(F.get(named("n", "l_suppkey", 1, 1), F.lit(0)).alias("ref")).alias("around"), F.struct(relations.alias("relations")).alias("memory"), F.lit("n0").alias("target")).alias("arguments"))
    rows = lines.select("l_orderkey", F.to_json(F.struct(state.alias("state"), action.alias("action"))).alias("raw"))

    def refs(x: object) -> dict:
        seen, wanted = walks.visible_refs(x["state"]), walks.target_refs(x["action"])
        return {"visible": ",".join(sorted(seen)), "needed": ",".join(sorted(wanted)), "missing": len(wanted - seen)}

    kind = pa.struct([("visible", pa.string()), ("needed", pa.string()), ("missing", pa.int64())])
    return walks.map_json(rows, "raw", "r", kind, "struct<visible:string,needed:string,missing:long>", refs).select("l_orderkey", "r.*")


# Refs and scopes get numbers by first appearance; a topic's prefix that is left is found
@query("""WITH x AS (SELECT l_orderkey, list(l_partkey % 4 ORDER BY l_linenumber, l_partkey) AS p FROM lineitem GROUP BY 1),
y AS (SELECT l_orderkey, p, list_distinct(p) AS d, list_transform(p, lambda z: len(list_distinct(p[1:list_position(p, z)]))) AS n FROM x)
SELECT l_orderkey, array_to_string(list_transform(n, lambda z: printf('ref_%04d', z)), ',') AS refs, len(d) AS ref_count, 1::BIGINT AS about_count, l_orderkey % 3 = 0 AS leak FROM y""")
def ref_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("l"))
    refs = F.transform("l", lambda z: F.concat(F.lit("docs:"), (z["l_partkey"] % 4).cast("string")))
    goal = F.when(F.col("l_orderkey") % 3 == 0, "see bug:7").otherwise("look")
    about = F.concat(F.lit("team "), F.col("l_orderkey"))
    rows = lines.select("l_orderkey", F.to_json(F.struct(about.alias("about"), goal.alias("goal"), F.struct(refs.alias("known_refs"), about.alias("about")).alias("visible_state"))).alias("raw"))

    def numbered(x: dict) -> dict:
        t = walks.anonymised(x)
        told = [{"role": "user", "content": json.dumps([t["goal"], t["visible_state"]])}]
        return {"refs": ",".join(t["visible_state"]["known_refs"]), "ref_count": t["ref_anonymization"]["ref_count"], "about_count": t["ref_anonymization"]["about_count"], "leak": bool(sft_prep.leaks(told))}

    kind = pa.struct([("refs", pa.string()), ("ref_count", pa.int64()), ("about_count", pa.int64()), ("leak", pa.bool_())])
    return walks.map_json(rows, "raw", "r", kind, "struct<refs:string,ref_count:long,about_count:long,leak:boolean>", numbered).select("l_orderkey", "r.*")


# Recorded sessions of many steps, played up to the step that ends them
_PLAYED_SQL = """
s AS (SELECT user_id AS session_id, event_id AS step_idx, event_id % 5 AS pick, event_id, event_id % 3 > 0 AS ok, 'n' || (event_id % 7) AS ref FROM events),
a AS (SELECT *, CASE WHEN pick = 3 AND event_id % 35 = 3 THEN 'stop' WHEN pick = 4 AND event_id % 50 = 4 THEN 'escalate' ELSE 'tool_call' END AS kind, CASE WHEN pick = 1 THEN 'kernel_wake' ELSE 'kernel_inspect' END AS tool,
    CASE WHEN pick = 0 THEN 'n' || (event_id % 4) ELSE 'n0' END AS target FROM s),
b AS (SELECT *, greatest(0, 6 - coalesce(sum((kind = 'tool_call')::INT) OVER w, 0)) AS calls_left, coalesce(last_value(CASE WHEN kind = 'tool_call' AND tool = 'kernel_wake' AND ok THEN 'about:' || (event_id % 2) END IGNORE NULLS) OVER w, 'about:start') AS current_about,
    list_concat(['n0'], coalesce(list(ref) FILTER (ok) OVER w, [])) AS known FROM a WINDOW w AS (PARTITION BY session_id ORDER BY step_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, CASE WHEN kind = 'tool_call' AND calls_left <= 0 THEN 'budget_exhausted' WHEN kind = 'tool_call' AND tool = 'kernel_inspect' AND NOT list_contains(known, target) THEN 'contract_violation' WHEN kind = 'stop' THEN 'completed' WHEN kind = 'escalate' THEN 'escalated' END AS outcome FROM b),
d AS (SELECT *, min(step_idx) FILTER (outcome IS NOT NULL) OVER (PARTITION BY session_id) AS final FROM c),
played AS (SELECT * FROM d WHERE final IS NULL OR step_idx <= final)
"""


def _played(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, pick = F.col("event_id"), F.col("event_id") % 5
    stops, leaves, wakes = (pick == 3) & (n % 35 == 3), (pick == 4) & (n % 50 == 4), pick == 1
    call = F.when(wakes, F.concat(F.lit('{"kind":"tool_call","tool":"kernel_wake","arguments":{"about":"about:'), n % 2, F.lit('"}}')))
    call = call.otherwise(F.concat(F.lit('{"kind":"tool_call","tool":"kernel_inspect","arguments":{"target":"n'), F.when(pick == 0, n % 4).otherwise(0), F.lit('"}}')))
    action = F.when(stops, '{"kind":"stop","reason":"no_candidate"}').when(leaves, '{"kind":"escalate","reason":"low_confidence","target_model":"m"}').otherwise(call)
    events = table(spark, sf_dir, "events")
    steps = events.select(F.col("user_id").alias("session_id"), n.alias("step_idx"), F.from_json(action, schemas.ACTION).alias("action"), (n % 3 > 0).alias("succeeded"), F.array(F.concat(F.lit("n"), n % 7)).alias("refs"))
    state = F.from_json(F.lit('{"known_refs":["n0"],"known_dimensions":[],"budget":{"calls_remaining":6}}'), schemas.STATE)
    requests = events.select(F.col("user_id").alias("session_id")).distinct().select("session_id", F.lit("about:start").alias("about"), F.lit("read").alias("mode"), F.lit(6).alias("calls"), state.alias("state"))
    return sessions.multi_step(requests, steps)


@query(f"WITH {_PLAYED_SQL} SELECT session_id, step_idx, calls_left::BIGINT AS calls_left, current_about, len(list_distinct(known)) AS n_known, outcome FROM played")
def multi_step_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _played(spark, sf_dir).select("session_id", "step_idx", "calls_left", "current_about", F.size("known_refs").alias("n_known"), "outcome")


# An outcome row for each session
@query(f"""WITH {_PLAYED_SQL}, spent AS (SELECT *, kind = 'tool_call' AND outcome IS NULL AS spent FROM played)
SELECT session_id, coalesce(max(outcome), 'unfinished') AS outcome, count(*) FILTER (spent) AS steps, arg_max(calls_left - spent::INT, step_idx)::BIGINT AS calls_left, arg_max(current_about, step_idx) AS about FROM spent GROUP BY session_id""")
def session_outcome_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_outcomes(_played(spark, sf_dir))


# K8: the log of a session
@query(f"""WITH {_PLAYED_SQL}
SELECT session_id, step_idx, 1 AS seq, 'action_predicted' AS event, kind, CASE WHEN kind = 'tool_call' THEN tool END AS tool, NULL AS class FROM played UNION ALL
SELECT session_id, step_idx, 2, 'observation', NULL, NULL, CASE WHEN ok THEN 'tool_response' ELSE 'tool_error' END FROM played WHERE outcome IS NULL UNION ALL
SELECT session_id, step_idx, 3, 'session_complete', NULL, NULL, outcome FROM played WHERE outcome IS NOT NULL""")
def session_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_events(_played(spark, sf_dir))


# Outcomes of sessions of one step
@query("""WITH x AS (SELECT event_id, event_id % 4 AS pick, user_id % 3 AS calls, event_id % 5 = 0 AS bad, event_id % 2 = 0 AS ok FROM events)
SELECT event_id, CASE WHEN bad THEN 'contract_violation' WHEN pick = 0 THEN 'completed' WHEN pick = 1 THEN 'escalated' WHEN calls <= 0 THEN 'budget_exhausted' WHEN ok THEN 'completed' ELSE 'mcp_execution_failure' END AS outcome FROM x""")
def single_step_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    kind = F.when(n % 4 == 0, "stop").when(n % 4 == 1, "escalate").otherwise("tool_call")
    violations = contracts.collect(contracts.violation(n % 5 == 0, "schema_parse", "f", "m"))
    return table(spark, sf_dir, "events").select("event_id", sessions.single_step(kind, violations, F.col("user_id") % 3, n % 2 == 0).alias("outcome"))


# Episodes over several scopes
@query("""WITH x AS (SELECT l_orderkey, l_suppkey % 3 AS t, list_distinct(list(l_partkey % 6)) AS expected FROM lineitem GROUP BY ALL), k AS (SELECT l_orderkey, list_distinct(list(l_suppkey % 6)) AS known FROM lineitem GROUP BY 1),
y AS (SELECT l_orderkey, list(t ORDER BY t) FILTER (len(list_filter(expected, lambda e: NOT list_contains(known, e))) > 0) AS lacking FROM x JOIN k USING (l_orderkey) GROUP BY l_orderkey)
SELECT l_orderkey, coalesce(len(lacking), 0) = 0 AND l_orderkey % 4 > 0 AS accepted, coalesce(array_to_string(lacking, ','), '') AS missing FROM y""")
def cross_about_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    by = lines.groupBy("l_orderkey", (F.col("l_suppkey") % 3).cast("string").alias("about")).agg(F.collect_set((F.col("l_partkey") % 6).cast("string")).alias("expected_refs"))
    targets = by.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("about", "expected_refs"))).alias("targets"))
    known = lines.groupBy("l_orderkey").agg(F.collect_set((F.col("l_suppkey") % 6).cast("string")).alias("known"))
    found = sessions.cross_accept(F.col("targets"), F.col("known"), F.col("l_orderkey") % 4 == 0)
    return targets.join(known, "l_orderkey").select("l_orderkey", found["accepted"].alias("accepted"), F.array_join(found["missing"], ",").alias("missing"))


# A corpus built from decisions, the first failing stage
_BUILT_SQL = """
x AS (SELECT event_id, [NULL, 'shape', 'truncated', 'timeout', NULL, NULL, NULL][1 + event_id % 7] AS teacher, ['stop', 'kernel_inspect', 'escalate'][1 + user_id % 3] AS target, ['stop', 'kernel_inspect'][1 + event_id % 2] AS got,
    CASE WHEN event_id % 11 = 0 THEN 'answer_ready' END AS wanted, event_id % 13 = 0 AS violated, event_id % 17 = 0 AS unbuilt FROM events),
built AS (SELECT event_id, target, got, CASE WHEN teacher = 'timeout' THEN 'teacher_error' WHEN teacher = 'truncated' THEN 'teacher_truncation' WHEN teacher = 'shape' THEN 'parse_failure' WHEN target <> got THEN 'target_mismatch'
    WHEN wanted IS NOT NULL THEN 'semantic_mismatch' WHEN violated THEN 'contract_violation' WHEN unbuilt THEN 'trajectory_build' END AS reason FROM x)
"""


def _built(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    pick = lambda names, i: F.element_at(F.array(*(F.lit(x) for x in names)), (i + 1).cast("int"))
    action = F.from_json(F.when(n % 2 == 0, '{"kind":"stop","reason":"no_candidate"}').otherwise('{"kind":"tool_call","tool":"kernel_inspect","arguments":{"target":"a"}}'), schemas.ACTION)
    target = pick(("stop", "kernel_inspect", "escalate"), F.col("user_id") % 3)
    violations = contracts.collect(contracts.violation(n % 13 == 0, "schema_parse", "f", "m"))
    reason = corpus_build.build_reason(pick((None, "shape", "truncated", "timeout", None, None, None), n % 7), target, action, F.when(n % 11 == 0, "answer_ready"), F.lit(None).cast("string"), violations, F.when(n % 17 == 0, "bad"))
    return table(spark, sf_dir, "events").select("event_id", target.alias("target"), F.when(n % 2 == 0, "stop").otherwise("kernel_inspect").alias("got"), reason.alias("reason"))


@query(f"WITH {_BUILT_SQL} SELECT * FROM built")
def corpus_build_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir)


# The corpus report, and accepted rows by what they are
@query(f"WITH {_BUILT_SQL} SELECT count(*) AS total, count(*) FILTER (reason IS NULL) AS accepted, count(reason) AS dropped, count(reason) / count(*) AS drop_rate FROM built")
def corpus_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_build.corpus_report(_built(spark, sf_dir), "reason")


@query(f"WITH {_BUILT_SQL} SELECT CASE WHEN reason IS NULL THEN got ELSE target END AS target, count(*) FILTER (reason IS NULL) AS accepted, count(*) AS total FROM built GROUP BY 1")
def corpus_by_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_build.by_target(_built(spark, sf_dir), "target", "got", "reason")


# Reasons counted, null as unknown
@query(f"WITH {_BUILT_SQL} SELECT coalesce(reason, 'unknown') AS reason, count(*) AS n FROM built GROUP BY 1")
def failure_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy_eval.failure_reasons(_built(spark, sf_dir), "reason")


# Calibration by capability, null without cases, and its gate
@query("""WITH d(place, capability) AS (VALUES (0, 'view'), (1, 'click'), (2, 'nothing')), c AS (SELECT event_type AS capability, count(*) AS cases, count(*) FILTER (value > 50) AS matched FROM events GROUP BY 1)
SELECT capability, coalesce(cases, 0) AS cases, coalesce(matched, 0) AS matched, CASE WHEN cases > 0 THEN matched / cases END AS accuracy FROM d LEFT JOIN c USING (capability)""")
def calibration_by_capability(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("capability"), (F.col("value") > 50).alias("matched"))
    return corpus_build.calibration(rows, ["view", "click", "nothing"])[0]


# Generated rows against the minimum of each case
@query("""WITH g AS (SELECT event_type AS "case", count(*) AS generated FROM events GROUP BY 1), l AS (SELECT event_type AS "case", (min(user_id) * 100)::BIGINT AS minimum FROM events GROUP BY 1 UNION ALL SELECT 'none', 1)
SELECT l."case", coalesce(generated, 0) AS generated, minimum, coalesce(generated, 0) >= minimum AS satisfied FROM l LEFT JOIN g ON g."case" = l."case" """)
def generation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "case")
    least = events.groupBy("case").agg((F.min("user_id") * 100).cast("long").alias("minimum"))
    return corpus_build.generation_rows(events, least.union(spark.createDataFrame([("none", 1)], "case string, minimum long")))


# Calls replayed against recorded responses
@query("""WITH x AS (SELECT event_id, event_id % 6 AS pick, user_id % 4 AS r FROM events)
SELECT event_id, CASE WHEN pick = 0 THEN 'no_call' WHEN pick = 1 AND r = 0 OR pick IN (2, 3, 4) OR pick = 5 AND r = 3 THEN 'failed' ELSE 'success' END AS outcome,
    CASE WHEN pick = 1 AND r = 0 OR pick = 2 THEN 'transport' WHEN pick = 3 THEN 'protocol' WHEN pick = 4 THEN 'malformed_response' WHEN pick = 5 AND r = 3 THEN 'invalid_arguments' END AS reason FROM x""")
def replay_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick, r = F.col("event_id") % 6, F.col("user_id") % 4
    call = lambda tool, args: f'{{"kind":"tool_call","tool":"kernel_{tool}","arguments":{args}}}'
    action = F.when(pick == 0, '{"kind":"stop","reason":"no_candidate"}').when(pick == 4, call("near", '{"anchor":"a"}')).when(pick == 5, call("trace", '{"from":"a","page":1}')).otherwise(call("inspect", '{"target":"a"}'))
    actions = table(spark, sf_dir, "events").select("event_id", F.col("event_id").alias("step_id"), F.from_json(action, schemas.ACTION).alias("action"))
    error = F.when(pick == 2, "refused").when((pick == 5) & (r == 3), "invalid_arguments")
    body = F.when(pick == 3, "[]").when(pick == 4, '{"entries":[{"ref":"a"},{}]}').when(pick == 5, '{"trace":[{"from":"a","to":"b"}]}').otherwise("{}")
    recorded = table(spark, sf_dir, "events").filter((pick != 1) | (r != 0)).select(F.col("event_id").alias("step_id"), error.alias("error"), body.alias("body"))
    return corpus_build.replay(actions, recorded).select("event_id", "outcome", "reason")


# C4: recorded decisions by the subject's hash, prepared ones first
@query("""WITH r AS (SELECT sha256(n_name) AS subject_hash, 'rec ' || n_regionkey AS action FROM nation WHERE n_nationkey % 2 = 0)
SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'own' ELSE r.action END AS action FROM supplier JOIN nation ON n_nationkey = s_nationkey LEFT JOIN r ON r.subject_hash = sha256(n_name)""")
def recorded_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").withColumn("subject_hash", hashing.sha256(F.col("n_name")))
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(nations), F.col("n_nationkey") == F.col("s_nationkey")).withColumn("prepared_action", F.when(F.col("s_suppkey") % 5 == 0, "own"))
    recorded = nations.filter(F.col("n_nationkey") % 2 == 0).select("subject_hash", F.concat(F.lit("rec "), F.col("n_regionkey").cast("string")).alias("action"))
    return corpus_build.decide(rows, recorded).select("s_suppkey", "action")


# Splits that overlap or name unknown rows
@query("""WITH s AS (SELECT doc_id AS step_id, quality AS split FROM labels UNION ALL SELECT doc_id, 2 FROM labels WHERE doc_id % 9 = 0 UNION ALL SELECT -1, 0)
SELECT step_id, 'repeated' AS problem FROM s GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT DISTINCT step_id, 'unknown' FROM s WHERE step_id NOT IN (SELECT doc_id FROM documents)""")
def split_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    split = labels.select(F.col("doc_id").alias("step_id"), F.col("quality").cast("int").alias("split"))
    split = split.union(labels.filter("doc_id % 9 = 0").select("doc_id", F.lit(2))).union(spark.createDataFrame([(-1, 0)], "step_id long, split int"))
    return corpus_build.split_problem(split, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("step_id")))


# The violated specifications of a corpus
@query("""WITH t AS (SELECT event_id AS step_id, CASE WHEN event_id % 3 = 0 THEN 'write' ELSE 'read' END AS mode, event_id % 2 = 0 AS stops FROM events),
f(place, name, hit) AS (VALUES (0, 'schema_parse', true), (1, 'action_parse', false), (2, 'contract_coverage', true), (3, 'mode_safety', (SELECT count(*) > 0 FROM t WHERE mode = 'write' AND NOT stops)), (4, 'scope_safety', true), (5, 'write_proof', false),
    (6, 'episode_split', false), (7, 'duplicate_audit', (SELECT count(*) <> count(DISTINCT step_id) FROM t)), (8, 'replay_smoke', true), (9, 'frontier_ceiling', true)) SELECT name FROM f WHERE hit""")
def corpus_quality_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    mode = F.when(n % 3 == 0, "write").otherwise("read")
    action = F.struct(F.when(n % 2 == 0, "stop").otherwise("tool_call").alias("kind"), F.when(n % 2 == 1, "kernel_inspect").alias("tool"))
    rows = table(spark, sf_dir, "events").select(n.alias("step_id"), mode.alias("mode"), contracts.mode_tools(mode).alias("allowed_tools"), action.alias("target_action"))
    found = corpus_build.corpus_quality(rows, {"schema_parse": 3, "action_parse": 0, "scope_safety": 1}, rows.select("step_id", F.lit("train").alias("split")), smoke_failures=2)
    return spark.createDataFrame([(x,) for x in found], "name string")


# Rows for each case, and scenarios from templates in turn, with draws that depend on seed, template and variation
@query("""WITH c AS (SELECT unnest(['wake', 'stop']) AS "case"), n AS (SELECT count(*) AS n FROM nation)
SELECT "case", i AS index, printf('synthetic:%s:%04d', "case", i) AS id FROM c, (SELECT unnest(range(n)) AS i FROM n)""")
def synthetic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_build.synthesize(spark, ["wake", "stop"], table(spark, sf_dir, "nation").count())


@query("""WITH n AS (SELECT count(*) AS n FROM supplier), t AS (SELECT unnest(range(n)) AS ordinal FROM n), x AS (SELECT ordinal, ['a', 'b', 'c'][1 + ordinal % 3] AS template, ordinal // 3 AS variation FROM t)
SELECT ordinal, template, variation, ('0x' || substr(md5('5:' || template || ':' || variation), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw FROM x""")
def scenario_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_build.scenarios(spark, ["a", "b", "c"], table(spark, sf_dir, "supplier").count(), 5)


# Refs and signals of recorded responses
@query("""WITH x AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS p, list(l_suppkey ORDER BY l_linenumber, l_partkey) AS s FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_transform(p, lambda z: 'n' || z), ',') AS near_refs, l_orderkey % 2 = 0 AS near_fails, len(p) + 2 AS requested, 2::BIGINT AS missing, l_orderkey % 3 = 0 AS has_more, CASE WHEN l_orderkey % 5 = 0 THEN 0 ELSE len(p) END AS returned,
    2 * len(list_filter(p, lambda z: z % 3 > 0)) + 2 * len(list_filter(p, lambda z: z % 3 = 0)) AS total_links, l_orderkey % 4 = 0 AS answer_is_null FROM x""")
def response_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("l"))
    names = F.transform("l", lambda z: F.concat(F.lit("n"), z["l_partkey"].cast("string")))
    link = lambda z: F.struct(F.concat(F.lit("n"), z["l_partkey"].cast("string")).alias("from"), F.lit("x").alias("to"))
    body = F.concat(
        F.lit('{"entries":'), F.to_json(F.transform(names, lambda r: F.struct(r.alias("ref")))), F.lit(',"coverage":{"missing":["a","b"],"included":'), F.to_json(names), F.lit('},"page":{"has_more":'), F.when(n % 3 == 0, "true").otherwise('"no"'), F.lit(',"returned":'),
        F.when(n % 5 == 0, '"many"').otherwise(F.size("l").cast("string")), F.lit('},"links":{"incoming":'), F.to_json(F.transform(F.filter("l", lambda z: z["l_partkey"] % 3 > 0), link)), F.lit(',"outgoing":'), F.to_json(F.transform(F.filter("l", lambda z: z["l_partkey"] % 3 == 0), link)),
        F.lit("}"), F.when(n % 4 == 0, ',"answer":null').otherwise(""), F.lit("}"),
    )
    broken = F.when(n % 2 == 0, '{"entries":[{"ref":"a"},{"ref":7}]}').otherwise('{"entries":[{"ref":"a"}]}')
    rows = lines.select("l_orderkey", responses.variant(body).alias("v"), responses.variant(broken).alias("b"))
    s = responses.navigation_signals(F.col("v"), F.array(F.lit("x")))
    return rows.select(
        "l_orderkey", F.array_join(responses.observed_refs(F.lit("kernel_near"), F.col("v"), F.lit("t")), ",").alias("near_refs"), responses.entry_refs(F.col("b")).isNull().alias("near_fails"), s["coverage_requested"].alias("requested"), s["coverage_missing"].alias("missing"),
        s["page_has_more"].alias("has_more"), s["page_returned"].alias("returned"), s["total_links"].alias("total_links"), s["answer_is_null"].alias("answer_is_null"),
    )


# Capabilities of trajectories
@query("""WITH x AS (SELECT event_id, event_id % 4 AS pick, user_id % 10 AS b, user_id % 20 AS e, ['all', 'only', 'none'][1 + event_id % 3] AS mode FROM events)
SELECT event_id, array_to_string(list_sort(list_filter(CASE pick WHEN 0 THEN ['mode:read', 'tool:stop', 'window:stop_sufficient'] WHEN 1 THEN ['mode:read', 'tool:escalate'] WHEN 2 THEN ['mode:read', 'tool:kernel_inspect', 'inspect.raw:false']
    ELSE ['mode:read', 'tool:kernel_near', 'cursor:ref', CASE WHEN mode <> 'none' THEN 'dimensions.mode:' || mode END, CASE WHEN b > 6 OR e > 12 THEN 'window:expand' END, CASE WHEN b < 6 OR e < 12 THEN 'window:shrink' END] END, lambda z: z IS NOT NULL)), ',') AS capabilities FROM x""")
def trajectory_capabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick, n = F.col("event_id") % 4, F.col("event_id")
    mode = F.element_at(F.array(F.lit("all"), F.lit("only"), F.lit("none")), (n % 3 + 1).cast("int"))
    near = F.concat(F.lit('{"kind":"tool_call","tool":"kernel_near","arguments":{"around":{"ref":"a"},"dimensions":{"mode":"'), mode, F.lit('"},"window":{"before_entries":'), F.col("user_id") % 10, F.lit('},"limit":{"entries":'), F.col("user_id") % 20, F.lit("}}}"))
    action = F.when(pick == 0, '{"kind":"stop"}').when(pick == 1, '{"kind":"escalate"}').when(pick == 2, '{"kind":"tool_call","tool":"kernel_inspect","arguments":{"include":{"raw":false}}}').otherwise(near)
    row = responses.variant(F.concat(F.lit('{"mode":"read","target_action":'), action, F.lit("}")))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.array_sort(capabilities.trajectory(row)), ",").alias("capabilities"))


# Labels of target actions, by split
@query("""WITH x AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'eval' ELSE 'train' END AS split, user_id % 3 AS d, user_id % 4 AS r, user_id % 2 AS o FROM events),
l AS (SELECT split, 'ingest_dry_run' AS distribution, ['true', 'absent', 'invalid'][1 + d] AS label FROM x UNION ALL SELECT split, 'ingest_relations', ['empty', 'non_empty', 'absent', 'invalid'][1 + r] FROM x UNION ALL
    SELECT split, 'ingest_dimensions', 'absent' FROM x UNION ALL SELECT split, 'ingest_evidence', 'absent' FROM x UNION ALL SELECT split, 'ingest_provenance', CASE WHEN o = 0 THEN 'present' ELSE 'absent' END FROM x)
SELECT distribution, split, label, count(*) AS n FROM l GROUP BY ALL UNION ALL SELECT distribution, 'all', label, count(*) FROM l GROUP BY ALL""")
def target_label_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda names, i: F.element_at(F.array(*(F.lit(x) for x in names)), (i + 1).cast("int"))
    u = F.col("user_id")
    args = F.concat(F.lit('{"memory":{'), pick(('"relations":[]', '"relations":[{}]', '"relations":null', '"relations":7'), u % 4), F.lit("}"), pick((',"dry_run":true', "", ',"dry_run":"yes"'), u % 3), F.when(u % 2 == 0, ',"provenance":{}').otherwise(""), F.lit("}"))
    row = F.concat(F.lit('{"target_action":{"kind":"tool_call","tool":"kernel_ingest","arguments":'), args, F.lit("}}"))
    tagged = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 5 == 0, "eval").otherwise("train").alias("split"), row.alias("trajectory"), F.lit(None).cast("string").alias("drop_reason"))
    return sft_prep.target_distributions(tagged)


# Allowed tools in the profile's order, or why they can't be
@query("""WITH x AS (SELECT event_id, event_id % 6 AS pick FROM events) SELECT event_id, CASE pick WHEN 0 THEN 'kernel_wake,kernel_inspect' END AS tools,
    CASE pick WHEN 1 THEN 'missing_allowed_tools' WHEN 2 THEN 'allowed_tools_not_a_list' WHEN 3 THEN 'allowed_tools_not_strings' WHEN 4 THEN 'duplicate_allowed_tools' WHEN 5 THEN 'tools_outside_profile:kernel_ingest' END AS problem FROM x""")
def allowed_tools_of_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = ('{"t":["kernel_inspect","kernel_wake"]}', "{}", '{"t":"kernel_wake"}', '{"t":["kernel_wake",""]}', '{"t":["kernel_wake","kernel_wake"]}', '{"t":["kernel_ingest","kernel_wake"]}')
    v = responses.variant(F.element_at(F.array(*(F.lit(s) for s in said)), (F.col("event_id") % 6 + 1).cast("int")))
    found = audits.allowed_tools(F.try_variant_get(v, "$.t", "variant"), "read")
    return table(spark, sf_dir, "events").select("event_id", F.array_join(found["tools"], ",").alias("tools"), found["problem"].alias("problem"))


# Messages of training rows
@query("""WITH x AS (SELECT event_id, event_id % 5 AS pick FROM events) SELECT event_id, CASE pick WHEN 0 THEN 'bad_step_id' WHEN 1 THEN 'not_three_messages' WHEN 2 THEN 'message_without_content' WHEN 3 THEN 'unexpected_roles' END AS problem FROM x""")
def message_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = F.col("event_id") % 5
    m = lambda role, content: F.struct(F.lit(role).alias("role"), F.lit(content).alias("content"))
    whole = F.array(m("system", "s"), m("user", "u"), m("assistant", "a"))
    messages = F.when(pick == 1, F.slice(whole, 1, 2)).when(pick == 2, F.array(m("system", "s"), m("user", ""), m("assistant", "a"))).when(pick == 3, F.reverse(whole)).otherwise(whole)
    return table(spark, sf_dir, "events").select("event_id", audits.openai_problem(F.when(pick != 0, F.col("event_id").cast("string")), messages).alias("problem"))


# Attempted and completed sessions
@query("SELECT count(*) AS sessions, count(*) FILTER (event_type <> 'view') AS attempted, count(*) FILTER (value > 50) AS completed FROM events")
def replay_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.when(F.col("event_type") != "view", F.col("event_type")).alias("tool"), F.when(F.col("value") > 50, "completed").otherwise("failed").alias("outcome"))
    return audits.replay_stats(rows)


# K4, K3: canonical JSON lines, prompts and completions
@query("""SELECT event_id, '{"b":[1,"\\u00f1"],"k":' || (props->>'k') || '}' AS raw FROM events""")
def canonical_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(F.lit('{ "k" : '), F.get_json_object("props", "$.k"), F.lit(', "b": [1, "ñ"] }'))
    return sinks.canonical_json(table(spark, sf_dir, "events").select("event_id", raw.alias("raw")), "raw")


@query("""SELECT '{"user":' || user_id || ',"type":"' || event_type || '"}' AS prompt, '{"event":' || event_id || '}' AS completion FROM events""")
def prompt_completion_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type")).alias("visible_state"), F.struct(F.col("event_id").alias("event")).alias("target_action"))
    return sinks.prompt_completion(rows)


# K2, F8: a content hash that doesn't depend on order
@query("""SELECT 'sum60:' || lower(to_hex((sum(('0x' || substr(sha256(text), 1, 15))::BIGINT::HUGEINT) % 1152921504606846976)::BIGINT)) AS content_hash FROM documents""")
def unordered_content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.unordered_hash(table(spark, sf_dir, "documents"), "text")


# B17, E4-like: requests compiled from episodes
@query("""WITH x AS (SELECT l_orderkey, list_sort(list_distinct(list(l_suppkey % 4))) AS a, max(l_linenumber) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey AS line_no, 'a' || a[1] AS about, array_to_string(list_transform(a, lambda z: 'a' || z), ',') AS abouts, least(4294967295, n::BIGINT * 1000000000 * len(a)) AS calls FROM x""")
def compiled_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("line_no")).agg(F.array_sort(F.collect_set(F.col("l_suppkey") % 4)).alias("a"), (F.max("l_linenumber").cast("long") * 1000000000).alias("max_iterations"))
    none = F.expr("cast(array() as array<string>)")
    targets = F.transform("a", lambda z: F.struct(F.concat(F.lit("a"), z.cast("string")).alias("about"), none.alias("expected_refs")))
    rows = lines.select("line_no", targets.alias("targets"), F.lit("g").alias("goal"), F.lit(1).alias("initial_window"), "max_iterations", F.lit(1).alias("token_budget"), none.alias("expected_refs"))
    return audits.compile_episodes(rows).select("line_no", "about", F.array_join("candidate_abouts", ",").alias("abouts"), "calls")


# the readers, over files that the sinks write
def _written(spark: SparkSession, rows: DataFrame, order: str, name: str) -> str:
    """The folder of lines (raw) of rows in order, among what driver and executors share; in local mode without it a temporary one."""
    path = sinks.shared_path(spark, name)
    sinks.write_lines(rows, path, order=order)
    return path


# A1, A2, A3, K1, K6: numbered lines; blank ones count, and go
@query("""WITH x AS (SELECT row_number() OVER (ORDER BY event_id) AS line_no, CASE WHEN event_id % 10 = 0 THEN ' ' ELSE props END AS raw FROM events) SELECT * FROM x WHERE trim(raw) <> ''""")
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, " ").otherwise(F.col("props")).alias("raw"))
    return jsonl.lines(spark, _written(spark, rows, "event_id", "lines")).select("line_no", "raw")


# A4, A5: typed predictions, and lines whose action can't be typed
@query("""WITH x AS (SELECT event_id, event_id % 6 AS pick FROM events)
SELECT 's' || event_id AS step_id, CASE pick WHEN 0 THEN 'kernel_inspect' END AS tool, CASE pick WHEN 1 THEN 'r' || event_id END AS evidence, CASE pick WHEN 2 THEN 'unknown_tool' WHEN 3 THEN 'argument_keys:missing=target;unexpected=ref' WHEN 4 THEN 'invalid_stop_reason' WHEN 5 THEN 'unknown_action_kind' END AS message FROM x""")
def typed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = F.col("event_id") % 6
    action = (
        F.when(pick == 0, '{"kind":"tool_call","tool":"kernel_inspect","arguments":{"target":"a"}}').when(pick == 1, F.concat(F.lit('{"kind":"stop","reason":"answer_ready","final_refs":["r'), F.col("event_id"), F.lit('"]}')))
        .when(pick == 2, '{"kind":"tool_call","tool":"kernel_fly","arguments":{}}').when(pick == 3, '{"kind":"tool_call","tool":"kernel_inspect","arguments":{"ref":"a"}}').when(pick == 4, '{"kind":"stop","reason":"tired"}').otherwise('{"kind":"dance"}')
    )
    rows = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit('{"step_id":"s'), F.col("event_id"), F.lit('","action":'), action, F.lit("}")).alias("raw"))
    good, bad = jsonl.read_predictions(spark, _written(spark, rows, "event_id", "predictions"))
    none = F.lit(None).cast("string")
    return good.select("step_id", F.col("action.tool").alias("tool"), F.array_join("action.evidence", ",").alias("evidence"), none.alias("message")).unionByName(bad.select("step_id", none.alias("tool"), none.alias("evidence"), "message"))


# Scenarios, the mode filter, the tool filter, then the limit
@query("""WITH x AS (SELECT event_id, ['read', 'write', 'full'][1 + event_id % 3] AS mode, ['stop', 'kernel_inspect', NULL][1 + user_id % 3] AS target FROM events)
SELECT 'scenario:' || event_id AS scenario_id, mode, target FROM x WHERE mode IN ('read', 'full') AND target = 'kernel_inspect' ORDER BY event_id LIMIT 40""")
def session_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda names, i: F.element_at(F.array(*(F.lit(x) for x in names)), (i + 1).cast("int"))
    n = F.col("event_id")
    raw = F.concat(F.lit('{"scenario_id":"scenario:'), n, F.lit('","target":'), pick(('"stop"', '"kernel_inspect"', "null"), F.col("user_id") % 3), F.lit(',"subject":{"mode":"'), pick(("read", "write", "full"), n % 3), F.lit('"}}'))
    path = _written(spark, table(spark, sf_dir, "events").select("event_id", raw.alias("raw")), "event_id", "scenarios")
    return jsonl.read_session_scenarios(spark, path, modes=("read", "full"), tools=("kernel_inspect",), limit=40).select("scenario_id", "mode", "target")


# Pack files and episodes
@query("""SELECT row_number() OVER (ORDER BY event_id) AS place, 'scenario:' || event_id AS id FROM events QUALIFY event_id % 7 > 1""")
def pack_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    raw = F.when(n % 7 == 0, "").when(n % 7 == 1, "# a note").otherwise(F.concat(F.lit("  scenario:"), n, F.lit(" ")))
    return jsonl.read_pack(spark, _written(spark, table(spark, sf_dir, "events").select("event_id", raw.alias("raw")), "event_id", "pack"))


@query("""SELECT row_number() OVER (ORDER BY event_id) AS line_no, CASE WHEN event_id % 2 = 0 THEN 'a' || user_id ELSE 'x,y' END AS abouts, 1 + event_id % 4 AS max_iterations, CASE WHEN event_id % 3 = 0 THEN 7 ELSE 8192 END AS token_budget, CASE WHEN event_id % 2 = 0 THEN 'r' ELSE 'p,q' END AS refs FROM events""")
def episode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    where = F.when(n % 2 == 0, F.concat(F.lit('"about":"a'), F.col("user_id"), F.lit('","expected_refs":["r"]'))).otherwise('"targets":[{"about":"x","expected_refs":["p"]},{"about":"y","expected_refs":["q","p"]}]')
    raw = F.concat(F.lit("{"), where, F.lit(',"goal":"g","initial_window":3,"max_iterations":'), 1 + n % 4, F.when(n % 3 == 0, ',"token_budget":7').otherwise(""), F.lit("}"))
    rows = jsonl.read_episodes(spark, _written(spark, table(spark, sf_dir, "events").select("event_id", raw.alias("raw")), "event_id", "episodes"))
    return rows.select("line_no", F.array_join(F.transform("targets", lambda t: t["about"]), ",").alias("abouts"), "max_iterations", "token_budget", F.array_join("expected_refs", ",").alias("refs"))


# Calibration cases and training rows
@query("""SELECT row_number() OVER (ORDER BY event_id) AS line_no, 'c' || event_id AS case_id, event_type AS category, 1 + event_id % 3 AS accepted FROM events""")
def calibration_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    raw = F.to_json(F.struct(F.concat(F.lit("c"), n).alias("case_id"), F.lit("t").alias("domain_theme"), F.col("event_type").alias("category"), F.struct(n.alias("n")).alias("subject"), F.transform(F.sequence(F.lit(0), n % 3), lambda i: F.struct(F.lit("stop").alias("kind"))).alias("accepted_actions")))
    rows = jsonl.read_calibration(spark, _written(spark, table(spark, sf_dir, "events").select("event_id", raw.alias("raw")), "event_id", "calibration"))
    return rows.select("line_no", "case_id", "category", F.size("accepted").alias("accepted"))


@query("""SELECT row_number() OVER (ORDER BY event_id) AS line_no, CASE WHEN event_id % 2 = 0 THEN 's' ELSE 'i' END || event_id AS step_id, event_type AS said FROM events""")
def training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    messages = sinks.messages(F.lit("system"), F.lit("user"), F.col("event_type"))
    raw = F.to_json(F.struct(F.concat(F.lit("i"), n).alias("id"), F.when(n % 2 == 0, F.concat(F.lit("s"), n)).alias("step_id"), messages.alias("messages")))
    rows = jsonl.read_sft(spark, _written(spark, table(spark, sf_dir, "events").select("event_id", raw.alias("raw")), "event_id", "training"))
    return rows.select("line_no", "step_id", F.element_at("messages", 3)["content"].alias("said"))


# The files of a training set; rows whose refs aren't visible go to a file of their own
@query("""WITH x AS (SELECT event_id, event_id % 4 = 1 AS hidden FROM events), k AS (SELECT count(*) FILTER (NOT hidden) AS kept, count(*) FILTER (hidden) AS gone, count(*) AS n FROM x)
SELECT unnest(['all', 'all_trajectories', 'all_model_trajectories', 'openai_all', 'dropped_non_visible_target_refs', 'debug_audit']) AS artifact, unnest([kept, kept, kept, kept, gone, n]) AS n FROM k""")
def training_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    raw = F.concat(
        F.lit('{"step_id":"s'), n, F.lit('","about":"u'), F.col("user_id"), F.lit('","mode":"read","task_family":"t","goal":"look '), n, F.lit('","visible_state":{"known_refs":["docs:'), n, F.lit('"]},"target_action":{"kind":"stop","reason":"answer_ready","evidence":["docs:'),
        F.when(n % 4 == 1, n + 1).otherwise(n), F.lit('"]}}'),
    )
    tagged = sft_prep.prepare(table(spark, sf_dir, "events").select(n.alias("line_no"), raw.alias("raw")), "system", ratio=0.2)
    counts = sft_prep.artifacts(tagged).groupBy("artifact").agg(F.count("raw").alias("n"))
    return counts.filter(~F.col("artifact").rlike("train|eval"))
