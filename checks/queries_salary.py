"""Pay extraction, preparation and the reports on prepared postings."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.registry import check, longs, rounded
from checks.sql_text import filled, mentions, normal_form, parsed_sql, strip_mentions
from checks.tables import POSTINGS_SQL, load, postings, scratch
from jobmine.config import LONG_TEXT_COLUMNS, TEXT_COLUMNS
from jobmine.operators import cleaning, gates, preparation, profiling
from jobmine.operators import salary as salary_ops
from jobmine.plans.prepare import prepare as prepare_plan
from jobmine.session import stage
from jobmine.sources import tables as sources

EXPECTED = "salary_expected_million_vnd"
PARSED_SQL = f"WITH {POSTINGS_SQL}, {parsed_sql('postings')}"
VALID_SQL = f"""{PARSED_SQL}, widened AS (SELECT *, salary_max - salary_min AS salary_range_width,
  coalesce(salary_parse_status = 'valid' AND isfinite({EXPECTED}) AND {EXPECTED} > 0
    AND salary_min <= salary_max, false) AS target_is_valid FROM parsed),
valid AS (SELECT * FROM widened WHERE target_is_valid)"""
BOUNDS_SQL = f"""{VALID_SQL}, qs AS (SELECT quantile_cont({EXPECTED}, [0.25, 0.75, 0.01, 0.99]) AS q FROM valid),
bounds AS (SELECT q[1] AS q1, q[2] AS q3, q[3] AS p1, q[4] AS p99, q[2] - q[1] AS iqr,
  q[1] - 1.5 * (q[2] - q[1]) AS lower_iqr, q[2] + 1.5 * (q[2] - q[1]) AS upper_iqr FROM qs),
reasons AS (SELECT valid.*, CASE WHEN {EXPECTED} < greatest(0, lower_iqr) THEN 'below_iqr_lower'
    WHEN {EXPECTED} > upper_iqr THEN 'above_iqr_upper' END AS r1,
  CASE WHEN {EXPECTED} < p1 THEN 'below_p1' WHEN {EXPECTED} > p99 THEN 'above_p99' END AS r2
  FROM valid, bounds),
flagged AS (SELECT * EXCLUDE (r1, r2), concat_ws('|', r1, r2) AS outlier_reason,
  r1 IS NOT NULL OR r2 IS NOT NULL AS is_salary_outlier FROM reasons)"""


def split_sql(source: str, id_col: str, value: str, out: str = "split_rows") -> str:
    """CTEs for quantile bins, proportional quotas and the draw by hash; all of ``source`` is kept."""
    shares = ", ".join(str(i / 10) for i in range(11))
    return f"""
edges AS (SELECT list_sort(list_distinct(quantile_cont(CAST({value} AS DOUBLE), [{shares}]))) AS e FROM {source}),
binned AS (SELECT s.*, CASE WHEN {value} IS NOT NULL AND len(e) > 2
  THEN greatest(len(list_filter(e, lambda x: x < CAST({value} AS DOUBLE))), 1) - 1 END AS stratum FROM {source} s, edges),
sizes AS (SELECT coalesce(stratum, -1) AS g, count(*) AS n FROM binned GROUP BY 1),
target AS (SELECT ceil(round(sum(n) * 0.1, 9)) AS seats, sum(n) AS total FROM sizes),
exact AS (SELECT g, n, CAST(n AS DOUBLE) * seats / total AS x, seats FROM sizes, target),
ranked_bins AS (SELECT g, floor(x) AS base, row_number() OVER (ORDER BY floor(x) - x, g) AS rk,
  seats - sum(floor(x)) OVER () AS open FROM exact),
quotas AS (SELECT g, base + CASE WHEN rk <= open THEN 1 ELSE 0 END AS quota FROM ranked_bins),
drawn AS (SELECT *, row_number() OVER (PARTITION BY coalesce(stratum, -1)
  ORDER BY md5(concat('42:', {id_col})), {id_col}) AS place FROM binned),
{out} AS (SELECT drawn.* EXCLUDE (place), CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS split
  FROM drawn JOIN quotas ON coalesce(stratum, -1) = g)"""


SPLIT_SQL = f"{BOUNDS_SQL}, {split_sql('flagged', 'id', EXPECTED)}"


def parsed(spark, sf_dir):
    return salary_ops.parse_salary(postings(spark, sf_dir))


def widened(spark, sf_dir):
    return preparation.mark_valid(salary_ops.salary_range_width(parsed(spark, sf_dir)))


def valid(spark, sf_dir):
    return stage(preparation.keep_valid(widened(spark, sf_dir)), "valid")


def flagged(spark, sf_dir):
    rows = valid(spark, sf_dir)
    return preparation.flag_outliers(rows, preparation.outlier_bounds(rows))


def split(spark, sf_dir):
    rows = stage(flagged(spark, sf_dir), "flagged")
    return preparation.stratified_split(preparation.stratify_bins(rows))


@check("salary_parse", f"""{PARSED_SQL} SELECT id, salary_raw_normalized, salary_pattern, salary_currency,
  round(salary_min, 6) AS salary_min, round(salary_max, 6) AS salary_max,
  round({EXPECTED}, 6) AS {EXPECTED}, salary_parse_status FROM parsed""")
def salary_parse(spark, sf_dir):
    return rounded(parsed(spark, sf_dir).select("id", *salary_ops.SALARY_FIELDS))


@check("salary_range_width", f"""{VALID_SQL} SELECT id, round(salary_range_width, 6) AS salary_range_width,
  target_is_valid FROM widened""")
def salary_range_width(spark, sf_dir):
    return rounded(widened(spark, sf_dir).select("id", "salary_range_width", "target_is_valid"))


@check("salary_pattern_summary", f"""{PARSED_SQL} SELECT salary_pattern, count(*) AS count,
  round(count(*) / sum(count(*)) OVER (), 6) AS ratio FROM parsed GROUP BY 1""")
def salary_pattern_summary(spark, sf_dir):
    return rounded(profiling.salary_pattern_summary(postings(spark, sf_dir)))


@check("salary_length_flags", f"""WITH {POSTINGS_SQL}, n AS (SELECT id, {normal_form('salary')} AS t FROM postings)
SELECT id, length(t) AS salary_length, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS salary_word_count,
  regexp_matches(t, 'usd.*vnd|vnd.*usd|\\$.*vnd|vnd.*\\$') AS salary_has_multiple_currencies,
  NOT regexp_matches(t, '[0-9]') AS salary_has_no_digits FROM n""")
def salary_length_flags(spark, sf_dir):
    rows = salary_ops.salary_length_flags(postings(spark, sf_dir).select("id", "salary"))
    return longs(rows.drop("salary"), "salary_length", "salary_word_count")


@check("salary_outlier_examples", f"""WITH {POSTINGS_SQL}, n AS (SELECT id, salary, {normal_form('salary')} AS t FROM postings)
SELECT id, salary, length(t) AS salary_length, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS salary_word_count,
  regexp_matches(t, 'usd.*vnd|vnd.*usd|\\$.*vnd|vnd.*\\$') AS salary_has_multiple_currencies,
  NOT regexp_matches(t, '[0-9]') AS salary_has_no_digits FROM n
ORDER BY salary_has_multiple_currencies DESC, length(t) DESC, id LIMIT 200""")
def salary_outlier_examples(spark, sf_dir):
    return longs(profiling.salary_outlier_examples(postings(spark, sf_dir)), "salary_length", "salary_word_count")


_RULES = ", ".join(f"({i + 1}, '{k}')" for i, k in enumerate((
    "thoa thuan", "thương lượng", "thuong luong", "canh tranh", "cạnh tranh", "negotiable",
    "deal luong", "dang cap nhat", "đang cập nhật", "updating", "update", "competitive")))
_RATIOS = " UNION ALL ".join(
    f"SELECT '{c}' AS value, avg(CASE WHEN {mentions(f'lower(coalesce({c}, {chr(39) * 2}))')} THEN 1 ELSE 0 END) AS ratio FROM postings"
    for c in LONG_TEXT_COLUMNS)


@check("rule_candidates", f"""{PARSED_SQL}, patterns AS (SELECT salary_pattern AS value, count(*) AS count,
  count(*) / sum(count(*)) OVER () AS ratio FROM parsed GROUP BY 1), m AS ({_RATIOS}),
both_rules AS (SELECT 'top_salary_patterns' AS rule, value, count, ratio FROM patterns
  UNION ALL SELECT 'high_salary_mention_columns', value, NULL, ratio FROM m),
r AS (SELECT rule, row_number() OVER (PARTITION BY rule ORDER BY ratio DESC, value) AS rank, value, count, ratio FROM both_rules)
SELECT rule, rank, value, count, round(ratio, 6) AS ratio FROM r WHERE rank <= 10
UNION ALL SELECT 'default_remove_salary_mentions_for_clustering', 1, 'false', NULL, NULL
UNION ALL SELECT 'remove_ambiguous_salary_keywords', rank, value, NULL, NULL FROM (VALUES {_RULES}) AS v(rank, value)""")
def rule_candidates(spark, sf_dir):
    return longs(rounded(profiling.rule_candidates(postings(spark, sf_dir))), "rank")


@check("parse_audit", f"""{PARSED_SQL}, c AS (
  SELECT 'salary_parse_status' AS audit_type, salary_parse_status AS value, count(*) AS count FROM parsed GROUP BY 2
  UNION ALL SELECT 'salary_pattern', salary_pattern, count(*) FROM parsed GROUP BY 2)
SELECT audit_type, value, count, round(count / (SELECT count(*) FROM parsed), 6) AS ratio FROM c""")
def parse_audit(spark, sf_dir):
    return rounded(profiling.parse_audit(parsed(spark, sf_dir)))


@check("valid_filter", f"""{VALID_SQL} SELECT id, salary_pattern, round({EXPECTED}, 6) AS {EXPECTED} FROM valid""")
def valid_filter(spark, sf_dir):
    rows = preparation.keep_valid(parsed(spark, sf_dir))
    return rounded(rows.select("id", "salary_pattern", EXPECTED))


@check("scoring_flags", f"""{VALID_SQL} SELECT id, round({EXPECTED}, 6) AS {EXPECTED}, false AS is_salary_outlier FROM valid""")
def scoring_flags(spark, sf_dir):
    rows = preparation.keep_valid(parsed(spark, sf_dir), finite=False)
    return rounded(preparation.scoring_flags(rows).select("id", EXPECTED, "is_salary_outlier"))


@check("outlier_flags", f"""{BOUNDS_SQL} SELECT id, round({EXPECTED}, 6) AS {EXPECTED}, is_salary_outlier, outlier_reason FROM flagged""")
def outlier_flags(spark, sf_dir):
    return rounded(flagged(spark, sf_dir).select("id", EXPECTED, "is_salary_outlier", "outlier_reason"))


@check("outlier_summary", f"""{BOUNDS_SQL} SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(p1, 6) AS p1,
  round(p99, 6) AS p99, round(iqr, 6) AS iqr, round(lower_iqr, 6) AS lower_iqr, round(upper_iqr, 6) AS upper_iqr,
  CAST((SELECT count(*) FROM flagged WHERE is_salary_outlier) AS DOUBLE) AS outlier_count FROM bounds""")
def outlier_summary(spark, sf_dir):
    rows = valid(spark, sf_dir)
    bounds = preparation.outlier_bounds(rows)
    return rounded(preparation.outlier_summary(preparation.flag_outliers(rows, bounds), bounds))


@check("outlier_flags_iqr", f"""WITH q AS (SELECT quantile_cont(l_extendedprice, [0.25, 0.75]) AS q, count(*) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_extendedprice, n >= 5 AND (l_extendedprice < greatest(0, q[1] - 1.5 * (q[2] - q[1]))
  OR l_extendedprice > q[2] + 1.5 * (q[2] - q[1])) AS is_salary_outlier FROM lineitem, q""")
def outlier_flags_iqr(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return preparation.flag_outliers_iqr(rows, "l_extendedprice")


_NEAR = f"""WITH {POSTINGS_SQL}, n AS (SELECT id, job_title, company_name, location, salary,
  count(*) OVER (PARTITION BY job_title, company_name, location, salary) > 1 AS is_near_duplicate FROM postings)"""


@check("near_duplicates", f"{_NEAR} SELECT id, is_near_duplicate FROM n")
def near_duplicates(spark, sf_dir):
    return preparation.near_duplicates(postings(spark, sf_dir)).select("id", "is_near_duplicate")


@check("near_duplicate_audit", f"{_NEAR} SELECT * EXCLUDE (is_near_duplicate) FROM n WHERE is_near_duplicate")
def near_duplicate_audit(spark, sf_dir):
    return preparation.near_duplicate_audit(preparation.near_duplicates(postings(spark, sf_dir)))


@check("near_duplicate_texts", """SELECT doc_id, count(*) OVER (PARTITION BY text) > 1 AS is_near_duplicate FROM documents""")
def near_duplicate_texts(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").select("doc_id", "text")
    return preparation.near_duplicates(rows, ["text"], "doc_id").drop("text")


@check("dedup", """SELECT doc_id, lang, source FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def dedup(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return preparation.dedup(rows, ["text"], "doc_id").drop("text")


@check("dedup_hot_key", """SELECT l_returnflag, l_linestatus, n AS n_rows, first_line FROM (
  SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey) AS first_line
  FROM lineitem GROUP BY 1, 2)""")
def dedup_hot_key(spark, sf_dir):
    """Keys that each hold a large share of all rows."""
    line = F.expr("l_orderkey * 1000000 + l_linenumber * 100000 + l_partkey")
    rows = load(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", line.alias("first_line"))
    sizes = rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n_rows"))
    kept = preparation.dedup(rows, ["l_returnflag", "l_linestatus"], "first_line")
    return kept.join(sizes, ["l_returnflag", "l_linestatus"])


@check("stratify_bins", f"""WITH {split_sql('events', 'event_id', 'value')} SELECT event_id, stratum FROM split_rows""")
def stratify_bins(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("event_id", "value")
    return longs(preparation.stratify_bins(rows, "value").drop("value"), "stratum")


@check("stratified_split", f"""{SPLIT_SQL} SELECT id, round({EXPECTED}, 6) AS {EXPECTED}, split FROM split_rows""")
def stratified_split(spark, sf_dir):
    return rounded(split(spark, sf_dir).select("id", EXPECTED, "split"))


@check("stratified_split_events", f"""WITH {split_sql('events', 'event_id', 'value')} SELECT event_id, split FROM split_rows""")
def stratified_split_events(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("event_id", "value")
    return preparation.stratified_split(preparation.stratify_bins(rows, "value"), "event_id").select("event_id", "split")


@check("sample_n", "SELECT event_id, event_type FROM events ORDER BY md5(concat('42:', event_id)), event_id LIMIT 500")
def sample_n(spark, sf_dir):
    return preparation.sample_n(load(spark, sf_dir, "events").select("event_id", "event_type"), 500, "event_id")


# Ids that occur often: users of events. Rows of one id are told apart by the digest of the row as JSON.
_USERS_SQL = """SELECT user_id, event_id, event_type, md5(concat('42:', user_id)) AS h,
  md5(concat('{"user_id":', user_id, ',"event_id":', event_id, ',"event_type":"', event_type, '"}')) AS d FROM events"""


@check("sample_n_repeated_ids", f"SELECT user_id, event_id, event_type FROM ({_USERS_SQL}) ORDER BY h, d LIMIT 777")
def sample_n_repeated_ids(spark, sf_dir):
    return preparation.sample_n(load(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), 777, "user_id")


@check("stratified_split_repeated_ids", f"""WITH rows AS ({_USERS_SQL}), sizes AS (
  SELECT *, n * t / total AS exact FROM (SELECT event_type, count(*) AS n, sum(count(*)) OVER () AS total,
    ceil(round(sum(count(*)) OVER () * 0.1, 9)) AS t FROM rows GROUP BY 1)),
quotas AS (SELECT event_type, floor(exact) + CASE WHEN row_number() OVER (ORDER BY floor(exact) - exact, event_type)
  <= t - sum(floor(exact)) OVER () THEN 1 ELSE 0 END AS quota FROM sizes),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY h, d) AS place FROM rows)
SELECT user_id, event_id, event_type, CASE WHEN place <= quota THEN 'test' ELSE 'train' END AS split
FROM ranked JOIN quotas USING (event_type)""")
def stratified_split_repeated_ids(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    kinds = F.dense_rank().over(Window.orderBy("event_type")) - 1  # five kinds
    numbers = rows.select("event_type").distinct().withColumn("stratum", kinds)
    drawn = preparation.stratified_split(rows.join(F.broadcast(numbers), "event_type").select(*rows.columns, "stratum"), "user_id")
    return drawn.drop("stratum")


@check("union_splits", """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'test' ELSE 'train' END AS split FROM orders""")
def union_splits(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    held_out = F.col("o_orderstatus") == "F"
    return preparation.union_splits(rows.where(~held_out), rows.where(held_out))


@check("split_distribution", f"""{SPLIT_SQL} SELECT split, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS ratio,
  round(avg({EXPECTED}), 6) AS salary_mean, round(quantile_cont({EXPECTED}, 0.5), 6) AS salary_median,
  round(stddev_samp({EXPECTED}), 6) AS salary_std, round(min({EXPECTED}), 6) AS salary_min,
  round(max({EXPECTED}), 6) AS salary_max FROM split_rows GROUP BY split""")
def split_distribution(spark, sf_dir):
    return rounded(profiling.split_distribution(split(spark, sf_dir)))


@check("split_ratio", f"""{SPLIT_SQL} SELECT split, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS ratio FROM split_rows GROUP BY split""")
def split_ratio(spark, sf_dir):
    return rounded(profiling.split_ratio(split(spark, sf_dir)))


@check("flag_ratio", f"""{BOUNDS_SQL} SELECT CASE WHEN is_salary_outlier THEN 'outlier' ELSE 'not_outlier' END AS label,
  count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS ratio FROM flagged GROUP BY 1""")
def flag_ratio(spark, sf_dir):
    return rounded(profiling.flag_ratio(flagged(spark, sf_dir)))


@check("outlier_examples", f"""{SPLIT_SQL} SELECT id, salary, split, outlier_reason FROM split_rows WHERE is_salary_outlier
  ORDER BY CASE WHEN split = 'train' THEN 0 ELSE 1 END, id LIMIT 200""")
def outlier_examples(spark, sf_dir):
    return profiling.outlier_examples(split(spark, sf_dir)).select("id", "salary", "split", "outlier_reason")


@check("processing_summary", f"""{SPLIT_SQL}, m AS (
  SELECT 'raw_rows' AS metric, count(*) AS n FROM parsed
  UNION ALL SELECT 'salary_valid_rows_before_dedup', count(*) FROM valid
  UNION ALL SELECT 'rows_after_dedup', count(*) FROM split_rows
  UNION ALL SELECT concat(split, '_rows'), count(*) FROM split_rows GROUP BY split
  UNION ALL SELECT concat('salary_status_', salary_parse_status), count(*) FROM parsed GROUP BY salary_parse_status)
SELECT metric, CAST(n AS VARCHAR) AS value FROM m UNION ALL SELECT 'test_size', '0.1'""")
def processing_summary(spark, sf_dir):
    rows = stage(widened(spark, sf_dir), "widened")
    kept = rows.where("target_is_valid")
    drawn = preparation.stratified_split(preparation.stratify_bins(kept))
    return profiling.processing_summary(rows, kept, drawn, {"test_size": 0.1})


# The whole flow: parse, filter, flag, deduplicate, split, clean.
_PREPARED_SQL = f"""{SPLIT_SQL}, filled AS (SELECT id, split, is_salary_outlier,
  {EXPECTED}, {', '.join(f'{filled(c)} AS {c}' for c in TEXT_COLUMNS)} FROM split_rows)"""


@check("prepare_flow", f"""{_PREPARED_SQL} SELECT * REPLACE (round({EXPECTED}, 6) AS {EXPECTED}) FROM filled""")
def prepare_flow(spark, sf_dir):
    clean = prepare_plan(postings(spark, sf_dir)).clean
    return rounded(clean.select("id", "split", "is_salary_outlier", EXPECTED, *TEXT_COLUMNS))


@check("fill_unknowns", f"""WITH {POSTINGS_SQL} SELECT id, {', '.join(f'{filled(c)} AS {c}' for c in TEXT_COLUMNS)} FROM postings""")
def fill_unknowns(spark, sf_dir):
    return cleaning.fill_unknowns(postings(spark, sf_dir)).drop("salary")


_LONG = ", ".join(f"{filled(c)} AS {c}" for c in LONG_TEXT_COLUMNS)
_LOGS = " UNION ALL ".join(
    f"""SELECT split, '{c}' AS "column", count(*) FILTER (WHERE {mentions(c)}) AS rows_with_salary_mentions,
  count(*) FILTER (WHERE {mentions(c)}) / count(*) AS salary_mention_ratio, false AS salary_mentions_removed
  FROM filled GROUP BY split""" for c in LONG_TEXT_COLUMNS)
_LOG_SQL = f"""WITH {POSTINGS_SQL}, {split_sql('postings', 'id', 'id')},
filled AS (SELECT id, split, {_LONG} FROM split_rows), logs AS ({_LOGS})"""


def _filled_split(spark, sf_dir):
    rows = postings(spark, sf_dir)
    drawn = preparation.stratified_split(preparation.stratify_bins(rows, "id"))
    return cleaning.fill_unknowns(drawn, LONG_TEXT_COLUMNS)


@check("mention_log", f"""{_LOG_SQL} SELECT * REPLACE (round(salary_mention_ratio, 6) AS salary_mention_ratio) FROM logs""")
def mention_log(spark, sf_dir):
    return rounded(cleaning.mention_log(_filled_split(spark, sf_dir)))


@check("mention_log_by_column", f"""{_LOG_SQL} SELECT "column", CAST(sum(rows_with_salary_mentions) AS BIGINT) AS rows_with_salary_mentions,
  round(avg(salary_mention_ratio), 6) AS salary_mention_ratio, false AS salary_mentions_removed FROM logs GROUP BY 1""")
def mention_log_by_column(spark, sf_dir):
    return rounded(cleaning.mention_log_by_column(cleaning.mention_log(_filled_split(spark, sf_dir))))


@check("clean_table", f"""WITH {POSTINGS_SQL}, f AS (SELECT id, {', '.join(f'{filled(c)} AS {c}' for c in TEXT_COLUMNS)} FROM postings)
SELECT * REPLACE ({', '.join(f'{strip_mentions(c)} AS {c}' for c in LONG_TEXT_COLUMNS)}) FROM f""")
def clean_table(spark, sf_dir):
    return cleaning.clean_table(postings(spark, sf_dir), remove_mentions=True).drop("salary")


@check("salary_mention_ratio", f"""WITH {POSTINGS_SQL}, m AS ({_RATIOS})
SELECT value AS "column", round(ratio, 6) AS salary_mention_ratio FROM m""")
def salary_mention_ratio(spark, sf_dir):
    return rounded(profiling.salary_mention_ratio(postings(spark, sf_dir)))


@check("gate_salaries", f"""{VALID_SQL} SELECT 'status_valid' AS "check", count(*) FILTER (WHERE salary_parse_status <> 'valid') AS failures,
  count(*) FILTER (WHERE salary_parse_status <> 'valid') = 0 AS passed FROM valid
UNION ALL SELECT 'salary_positive', count(*) FILTER (WHERE NOT {EXPECTED} > 0), count(*) FILTER (WHERE NOT {EXPECTED} > 0) = 0 FROM valid
UNION ALL SELECT 'bounds_ordered', count(*) FILTER (WHERE salary_min > salary_max), count(*) FILTER (WHERE salary_min > salary_max) = 0 FROM valid""")
def gate_salaries(spark, sf_dir):
    return gates.salaries_valid(preparation.keep_valid(parsed(spark, sf_dir)))


@check("gate_split_ids", f"""WITH {split_sql('orders', 'o_orderkey', 'o_totalprice')}, per AS (SELECT o_orderkey,
  count(*) FILTER (WHERE split = 'train') AS a, count(*) FILTER (WHERE split = 'test') AS b FROM split_rows GROUP BY 1),
c AS (SELECT 'ids_disjoint' AS "check", count(*) FILTER (WHERE a > 0 AND b > 0) AS failures FROM per
  UNION ALL SELECT 'unique_ids_train', CAST(sum(greatest(a - 1, 0)) AS BIGINT) FROM per
  UNION ALL SELECT 'unique_ids_test', CAST(sum(greatest(b - 1, 0)) AS BIGINT) FROM per)
SELECT "check", failures, failures = 0 AS passed FROM c""")
def gate_split_ids(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    binned = preparation.stratify_bins(rows, "o_totalprice")
    return gates.split_ids(preparation.stratified_split(binned, "o_orderkey"), "o_orderkey")


@check("gate_columns_and_schema", f"""WITH {POSTINGS_SQL}, c AS (SELECT count(*) AS n FROM postings)
SELECT 'columns_present' AS "check", CAST(0 AS BIGINT) AS failures, true AS passed, n AS rows FROM c
UNION ALL SELECT 'same_schema', 0, true, n FROM c""")
def gate_columns_and_schema(spark, sf_dir):
    rows = postings(spark, sf_dir)
    train, test = rows.where(F.col("job_type") != "F"), rows.where(F.col("job_type") == "F")
    checks = gates.columns_present(rows, TEXT_COLUMNS).unionByName(gates.same_schema(train, test))
    return checks.withColumn("rows", rows.agg(F.count(F.lit(1))).scalar())


def _described(name: str, table: str, columns: str) -> str:
    """SQL of one schema check, from what the database knows of the tables."""
    return f"""SELECT '{name}' AS "check", failures, failures = 0 AS passed FROM (SELECT CAST(count(*) AS BIGINT) AS failures
  FROM (VALUES {columns}) AS wanted(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE {table})))"""


_KINDS = "(SELECT list({{'n': column_name, 't': column_type}}) FROM (DESCRIBE SELECT {} FROM {}))"


@check("gate_columns_found_missing", f"""{_described('columns_present', 'documents', "('doc_id'), ('salary'), ('text'), ('benefits')")}
UNION ALL {_described('columns_present', 'pages', "('url'), ('html')")}
UNION ALL SELECT 'same_schema', f, f = 0 FROM (SELECT CAST({_KINDS.format('doc_id, text', 'documents')} <> {_KINDS.format('doc_id, text', 'documents')} AS BIGINT) AS f)
UNION ALL SELECT 'same_schema', f, f = 0 FROM (SELECT CAST({_KINDS.format('doc_id, n_chars AS text', 'documents')} <> {_KINDS.format('doc_id, text', 'documents')} AS BIGINT) AS f)""")
def gate_columns_found_missing(spark, sf_dir):
    """Schema checks of which two fail."""
    docs, pages = load(spark, sf_dir, "documents"), load(spark, sf_dir, "pages")
    found = [gates.columns_present(docs, ["doc_id", "salary", "text", "benefits"]), gates.columns_present(pages, ["url", "html"])]
    pair = docs.select("doc_id", "text")
    found += [gates.same_schema(pair, pair.limit(1)), gates.same_schema(docs.select("doc_id", F.col("n_chars").alias("text")), pair)]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@check("gate_row_count", """SELECT 'orders_per_customer' AS "check", abs((SELECT count(*) FROM orders) - (SELECT count(*) FROM customer)) AS failures,
  (SELECT count(*) FROM orders) = (SELECT count(*) FROM customer) AS passed
UNION ALL SELECT 'all_orders', 0, true""")
def gate_row_count(spark, sf_dir):
    """A count that fails and one that holds."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey")
    failing = gates.row_count(orders, load(spark, sf_dir, "customer").count(), "orders_per_customer")
    return failing.unionByName(gates.row_count(orders, orders.count(), "all_orders"))


@check("split_written_and_read", f"""WITH {split_sql('orders', 'o_orderkey', 'o_totalprice')}
SELECT o_orderkey, o_totalprice, o_orderstatus FROM split_rows WHERE split = 'test'""")
def split_written_and_read(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = scratch(spark, "split")
    binned = preparation.stratify_bins(rows, "o_totalprice")
    drawn = preparation.stratified_split(binned, "o_orderkey").drop("stratum")
    sources.write_split(drawn, path)
    return sources.read_split(spark, path, "test")


@check("csv_written_and_read", f"""WITH {POSTINGS_SQL} SELECT id, nullif(salary, '') AS salary, job_description, requirements FROM postings""")
def csv_written_and_read(spark, sf_dir):
    path = scratch(spark, "csv")
    rows = postings(spark, sf_dir).select("id", "salary", "job_description", "requirements")
    sources.write_csv(rows, path)
    read = sources.read_csv_table(spark, path, rows.schema)
    return read.withColumn("salary", F.nullif("salary", F.lit("")))


@check("read_head", "SELECT doc_id, text, lang FROM documents ORDER BY doc_id LIMIT 100")
def read_head(spark, sf_dir):
    return sources.read_table(spark, f"{sf_dir}/documents.parquet", 100, "doc_id").select("doc_id", "text", "lang")


@check("ensure_base_columns", """SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey,
  'unknown' AS job_title, 'unknown' AS salary FROM orders""")
def ensure_base_columns(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select("o_orderkey")
    return sources.ensure_base_columns(rows, ["job_title", "salary"], ["o_orderkey"])
