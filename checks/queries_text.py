"""Text steps, profiles and distribution shift."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.queries_salary import split_sql
from checks.registry import SQL, check, longs, rounded
from checks.sql_text import clean, clean_salary, filled, mentions, squeeze_spaces, strip_mentions
from checks.tables import POSTINGS_SQL, load, postings
from jobmine.functions import text as T
from jobmine.operators import cleaning, preparation, profiling, shift
from jobmine.plans.feature_report import feature_report

DOCS_LABELS = "(SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


def documents(spark, sf_dir):
    return load(spark, sf_dir, "documents")


def labelled(spark, sf_dir):
    """Documents with their labels; unlabelled ones give nulls."""
    return documents(spark, sf_dir).join(load(spark, sf_dir, "labels"), "doc_id", "left")


@check("clean_text", f"SELECT doc_id, {clean('text')} AS text FROM documents")
def clean_text(spark, sf_dir):
    return cleaning.clean_text(documents(spark, sf_dir).select("doc_id", "text"), ["text"])


@check("clean_pages", f"SELECT page_id, {clean('html')} AS html FROM pages")
def clean_pages(spark, sf_dir):
    return cleaning.clean_text(load(spark, sf_dir, "pages").select("page_id", "html"), ["html"])


@check("clean_conversations", f"SELECT conv_id, turn, {filled('text')} AS text FROM conversations")
def clean_conversations(spark, sf_dir):
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return cleaning.fill_unknowns(rows, ["text"])


@check("clean_salary_text", f"SELECT doc_id, {clean_salary('text')} AS text FROM documents")
def clean_salary_text(spark, sf_dir):
    settled = T.unicode_nfkc(F.col("text"))
    return documents(spark, sf_dir).select("doc_id", T.clean_salary_text(settled).alias("text"))


@check("unicode_nfkc", "SELECT doc_id, coalesce(nfc_normalize(text), '') AS text FROM documents")
def unicode_nfkc(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.unicode_nfkc(F.col("text")).alias("text"))


@check("fold_accents", "SELECT doc_id, strip_accents(text) AS text FROM documents")
def fold_accents(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.fold_accents_all_scripts(F.col("text")).alias("text"))


@check("salary_mentions", f"SELECT doc_id, {mentions('lower(text)')} AS text_mentions_salary FROM documents")
def salary_mentions(spark, sf_dir):
    rows = documents(spark, sf_dir).select("doc_id", "text")
    return cleaning.flag_salary_mentions(rows, ["text"]).drop("text")


@check("strip_mentions", f"SELECT doc_id, {strip_mentions(clean('text'))} AS text FROM documents")
def strip_salary_mentions(spark, sf_dir):
    return cleaning.strip_salary_mentions(documents(spark, sf_dir).select("doc_id", "text"), ["text"])


_FINAL = squeeze_spaces("concat_ws(' ', coalesce(lang, ''), coalesce(lang, ''), coalesce(text, ''), coalesce(source, ''))")


@check("final_text", f"SELECT doc_id, {_FINAL} AS final_text FROM documents")
def final_text(spark, sf_dir):
    return cleaning.final_text(documents(spark, sf_dir), ["lang", "text", "source"]).select("doc_id", "final_text")


@check("text_lengths", f"""SELECT doc_id, length(text) AS text_length, length(lang) AS lang_length,
  length({_FINAL}) AS final_text_length FROM documents""")
def text_lengths(spark, sf_dir):
    rows = cleaning.final_text(documents(spark, sf_dir), ["lang", "text", "source"])
    measured = cleaning.text_lengths(rows, ["text", "lang", "final_text"])
    return longs(measured.select("doc_id", "text_length", "lang_length", "final_text_length"),
                 "text_length", "lang_length", "final_text_length")


@check("log_numeric", """SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) AS log_balance FROM customer""")
def log_numeric(spark, sf_dir):
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(cleaning.log_numeric(rows, {"c_acctbal": "log_balance"}), "log_balance").drop("c_acctbal")


@check("bool_to_int", "SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS expensive FROM orders")
def bool_to_int(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") > 250000).alias("expensive"))
    return cleaning.bool_to_int(rows, "expensive")


def _location(text: str) -> str:
    groups = (
        ("ho chi minh", ("ho chi minh", "tphcm", "tp.hcm", "hcm", "sai gon")), ("ha noi", ("ha noi", "hn")),
        ("da nang", ("da nang",)), ("binh duong", ("binh duong",)), ("dong nai", ("dong nai",)),
        ("hai phong", ("hai phong",)), ("can tho", ("can tho",)), ("bac ninh", ("bac ninh",)),
    )
    cases = " ".join(
        f"WHEN {' OR '.join(f'contains({text}, {chr(39)}{k}{chr(39)})' for k in keys)} THEN '{city}'"
        for city, keys in groups
    )
    return f"CASE {cases} WHEN {squeeze_spaces(text)} IN ('', 'unknown', 'khong') THEN 'unknown' ELSE 'other' END"


@check("simplify_location", f"""WITH {POSTINGS_SQL} SELECT id, {_location("strip_accents(lower(coalesce(location, '')))")} AS folded,
  {_location("lower(coalesce(location, ''))")} AS plain,
  {_location("replace(strip_accents(lower(coalesce(location, ''))), 'đ', 'd')")} AS mapped FROM postings""")
def simplify_location(spark, sf_dir):
    place = F.col("location")
    return postings(spark, sf_dir).select(
        "id", T.simplify_location(place).alias("folded"),
        T.simplify_location(place, fold=False).alias("plain"),
        T.simplify_location(place, map_d=True).alias("mapped"),
    )


def _schema_sql(columns: dict[str, str], source: str, split: str = "") -> str:
    group = f" GROUP BY {split}" if split else ""
    keep = f"{split}, " if split else ""
    return " UNION ALL ".join(
        f"""SELECT {keep}'{c}' AS "column", '{t}' AS dtype, count(*) - count({c}) AS missing_count,
  round((count(*) - count({c})) / count(*), 6) AS missing_ratio, count(DISTINCT {c}) AS n_unique FROM {source}{group}"""
        for c, t in columns.items()
    )


_DOC_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string",
              "n_chars": "bigint", "quality": "int", "toxic": "int"}


@check("schema_summary", _schema_sql(_DOC_TYPES, DOCS_LABELS))
def schema_summary(spark, sf_dir):
    return rounded(profiling.schema_summary(labelled(spark, sf_dir)))


_ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"}


@check("schema_summary_by_split", f"""WITH {split_sql('orders', 'o_orderkey', 'o_totalprice')} {_schema_sql(_ORDER_TYPES, 'split_rows', 'split')}""")
def schema_summary_by_split(spark, sf_dir):
    return rounded(profiling.schema_summary(_split_orders(spark, sf_dir).select(*_ORDER_TYPES, "split"), "split"))


def _split_orders(spark, sf_dir):
    rows = load(spark, sf_dir, "orders").drop("o_orderdate")
    return preparation.stratified_split(preparation.stratify_bins(rows, "o_totalprice"), "o_orderkey")


def _split_events(spark, sf_dir):
    rows = load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return preparation.stratified_split(preparation.stratify_bins(rows, "value"), "event_id")


@check("missing_summary", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
  round((count(*) - count({c})) / count(*), 6) AS missing_ratio FROM {DOCS_LABELS}""" for c in _DOC_TYPES))
def missing_summary(spark, sf_dir):
    return rounded(profiling.missing_summary(labelled(spark, sf_dir).select(*_DOC_TYPES)))


@check("duplicate_summary", """WITH c AS (
  SELECT 'duplicate_id' AS "check", sum(n) AS count FROM (SELECT count(*) AS n FROM documents GROUP BY text) WHERE n > 1
  UNION ALL SELECT 'duplicate_full_row', sum(n) FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source) WHERE n > 1
  UNION ALL SELECT 'duplicate_near_key', sum(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang, source) WHERE n > 1)
SELECT "check", CAST(coalesce(count, 0) AS BIGINT) AS count FROM c""")
def duplicate_summary(spark, sf_dir):
    rows = documents(spark, sf_dir).select("text", "lang", "source")
    return profiling.duplicate_summary(rows, "text", ["lang", "source"])


@check("text_length_summary", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg(length(coalesce(CAST({c} AS VARCHAR), ''))), 6) AS mean_length,
  round(quantile_cont(CAST(length(coalesce(CAST({c} AS VARCHAR), '')) AS DOUBLE), 0.5), 6) AS median_length,
  round(quantile_cont(CAST(length(coalesce(CAST({c} AS VARCHAR), '')) AS DOUBLE), 0.9), 6) AS p90_length,
  max(length(coalesce(CAST({c} AS VARCHAR), ''))) AS max_length FROM {DOCS_LABELS}"""
    for c in ("text", "source", "lang", "quality")))
def text_length_summary(spark, sf_dir):
    return longs(rounded(profiling.text_length_summary(labelled(spark, sf_dir), ["text", "source", "lang", "quality"])), "max_length")


def _top_sql(source: str, columns, n: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{c}' AS "column", coalesce(CAST({c} AS VARCHAR), 'unknown') AS value, count(*) AS count
  FROM {source} GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT {n})""" for c in columns)


@check("top_values", _top_sql(DOCS_LABELS, ("lang", "source", "quality", "toxic"), 10))
def top_values(spark, sf_dir):
    return profiling.top_values(labelled(spark, sf_dir), ["lang", "source", "quality", "toxic"])


@check("top_values_postings", f"""WITH {POSTINGS_SQL} {_top_sql('postings', ('company_name', 'location', 'job_industry', 'job_position', 'salary'), 10)}""")
def top_values_postings(spark, sf_dir):
    return profiling.top_values(postings(spark, sf_dir), ["company_name", "location", "job_industry", "job_position", "salary"])


_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@check("numeric_describe", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  round(min({c}), 4) AS min, round(quantile_cont({c}, 0.01), 4) AS p1, round(quantile_cont({c}, 0.25), 4) AS p25,
  round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75,
  round(quantile_cont({c}, 0.99), 4) AS p99, round(max({c}), 4) AS max FROM lineitem""" for c in _NUMBERS))
def numeric_describe(spark, sf_dir):
    return rounded(profiling.numeric_describe(load(spark, sf_dir, "lineitem"), _NUMBERS), digits=4)


_CATS = ("o_orderstatus", "o_orderpriority", "o_custkey")


@check("categorical_summary", f"""WITH {split_sql('orders', 'o_orderkey', 'o_totalprice')} """ + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) FILTER (WHERE split = 'train') AS n_unique_train,
  count(DISTINCT {c}) FILTER (WHERE split = 'test') AS n_unique_test,
  (SELECT CAST({c} AS VARCHAR) FROM split_rows WHERE split = 'train' GROUP BY {c} ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)
  AS top_train_value FROM split_rows""" for c in _CATS))
def categorical_summary(spark, sf_dir):
    return profiling.categorical_summary(_split_orders(spark, sf_dir), _CATS)


@check("dataset_overview", f"""WITH {split_sql(DOCS_LABELS, 'doc_id', 'n_chars')}, f AS (SELECT *, n_chars > 5000 AS is_long FROM split_rows)
SELECT split, count(*) AS rows, CAST(8 AS BIGINT) AS features_per_sample,
  CAST(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END + CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_cells,
  round(sum(CASE WHEN quality IS NULL THEN 1 ELSE 0 END + CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) / (count(*) * 8), 6) AS missing_cell_ratio,
  round(avg(CASE WHEN is_long THEN 1 ELSE 0 END), 6) AS salary_outlier_ratio FROM f GROUP BY split""")
def dataset_overview(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    drawn = preparation.stratified_split(preparation.stratify_bins(rows, "n_chars"), "doc_id").drop("stratum")
    overview = profiling.dataset_overview(drawn.withColumn("is_long", F.col("n_chars") > 5000), "is_long")
    return longs(rounded(overview), "features_per_sample")


@check("histogram", "WITH c AS (SELECT least(CAST(l_extendedprice AS DOUBLE), 60000) AS v FROM lineitem), h AS (SELECT v, min(v) OVER () AS lo, max(v) OVER () AS hi FROM c), "
       "p AS (SELECT least(CAST(floor((v - lo) / ((hi - lo) / 50)) AS BIGINT), 49) AS bin, lo, (hi - lo) / 50 AS w FROM h) "
       "SELECT bin, round(min(lo) + bin * min(w), 4) AS bin_start, count(*) AS count FROM p GROUP BY bin")
def histogram(spark, sf_dir):
    return longs(rounded(profiling.histogram_table(load(spark, sf_dir, "lineitem"), "l_extendedprice", 50, clip=60000), digits=4), "bin")


@check("histogram_by_split", f"WITH {split_sql('events', 'event_id', 'value')}, h AS (SELECT split, value AS v, min(value) OVER () AS lo, max(value) OVER () AS hi FROM split_rows), "
       "p AS (SELECT split, least(CAST(floor((v - lo) / ((hi - lo) / 40)) AS BIGINT), 39) AS bin, lo, (hi - lo) / 40 AS w FROM h) "
       "SELECT split, bin, round(min(lo) + bin * min(w), 6) AS bin_start, count(*) AS count FROM p GROUP BY split, bin")
def histogram_by_split(spark, sf_dir):
    return longs(rounded(profiling.histogram_table(_split_events(spark, sf_dir), "value", 40, by=["split"])), "bin")


def _box_sql(source: str, value: str, by: str = "") -> str:
    keep, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    join = f"b.{by} = s.{by} AND " if by else ""
    return f"""b AS (SELECT {keep}count({value}) AS n, quantile_cont(CAST({value} AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM {source} GROUP BY ALL)
SELECT {f'b.{by}, ' if by else ''}b.n, round(any_value(q[1]), 4) AS q1, round(any_value(q[2]), 4) AS median, round(any_value(q[3]), 4) AS q3,
  round(min({value}), 4) AS whisker_low, round(max({value}), 4) AS whisker_high
FROM b JOIN {source} s ON {join}{value} BETWEEN q[1] - 1.5 * (q[3] - q[1]) AND q[3] + 1.5 * (q[3] - q[1]) GROUP BY ALL"""


@check("boxplot", f"WITH {_box_sql('events', 'value')}")
def boxplot(spark, sf_dir):
    return rounded(profiling.boxplot_table(load(spark, sf_dir, "events"), "value"), digits=4)


@check("boxplot_by_group", f"""WITH top AS (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 6),
kept AS (SELECT p_brand, p_retailprice FROM part WHERE p_brand IN (SELECT p_brand FROM top)), {_box_sql('kept', 'p_retailprice', 'p_brand')}""")
def boxplot_by_group(spark, sf_dir):
    return rounded(profiling.boxplot_table(load(spark, sf_dir, "part"), "p_retailprice", "p_brand", 6), digits=4)


@check("boxplot_by_hot_group", f"WITH {_box_sql('lineitem', 'l_extendedprice', 'l_returnflag')}")
def boxplot_by_hot_group(spark, sf_dir):
    return rounded(profiling.boxplot_table(load(spark, sf_dir, "lineitem"), "l_extendedprice", "l_returnflag"), digits=4)


@check("unpivot", """SELECT l_orderkey, l_linenumber, unnest(['l_discount', 'l_tax']) AS variable, unnest([l_discount, l_tax]) AS value FROM lineitem""")
def unpivot(spark, sf_dir):
    return profiling.unpivot(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_discount", "l_tax"])


@check("category_share", """WITH top AS (SELECT source AS value FROM documents GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 10),
s AS (SELECT lang, count(*) AS size FROM documents GROUP BY 1)
SELECT s.lang, top.value, round(count(d.doc_id) / any_value(s.size), 6) AS ratio
FROM s CROSS JOIN top LEFT JOIN documents d ON d.lang = s.lang AND d.source = top.value GROUP BY 1, 2""")
def category_share(spark, sf_dir):
    return rounded(profiling.category_share_by_group(load(spark, sf_dir, "documents"), "lang", "source"))


@check("group_size", "SELECT source, count(*) AS size FROM documents GROUP BY 1")
def group_size(spark, sf_dir):
    return profiling.group_size(load(spark, sf_dir, "documents"), "source")


_KS_COLUMNS = ("value", "user_id")


def _ks_sql(c: str) -> str:
    return f"""ks_{c} AS (SELECT max(abs(ta / tn - sa / sn)) AS d, any_value(tn) AS n, any_value(sn) AS m FROM (
  SELECT sum(CAST(t AS DOUBLE)) OVER (ORDER BY v) AS ta, sum(CAST(s AS DOUBLE)) OVER (ORDER BY v) AS sa,
    sum(CAST(t AS DOUBLE)) OVER () AS tn, sum(CAST(s AS DOUBLE)) OVER () AS sn FROM (
    SELECT CAST({c} AS DOUBLE) AS v, count(*) FILTER (WHERE split = 'train') AS t,
      count(*) FILTER (WHERE split = 'test') AS s FROM split_rows GROUP BY 1)))"""


def _ks_row(c: str) -> str:
    series = "list_sum(list_transform(range(1, 101), lambda j: CASE WHEN j % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * exp(-2.0::DOUBLE * d * d * n * m / (n + m) * j * j)))"
    return f"""SELECT '{c}' AS "column", round(avg({c}) FILTER (WHERE split = 'train'), 6) AS train_mean,
  round(avg({c}) FILTER (WHERE split = 'test'), 6) AS test_mean,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5) FILTER (WHERE split = 'train'), 6) AS train_median,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5) FILTER (WHERE split = 'test'), 6) AS test_median,
  (SELECT round(d, 6) FROM ks_{c}) AS ks_statistic,
  (SELECT round(CASE WHEN d = 0 THEN 1 ELSE least(greatest(2 * {series}, 0), 1) END, 6) FROM ks_{c}) AS ks_pvalue FROM split_rows"""


_KS_SQL = f"""WITH {split_sql('events', 'event_id', 'value')}, {', '.join(_ks_sql(c) for c in _KS_COLUMNS)},
ks AS ({' UNION ALL '.join(_ks_row(c) for c in _KS_COLUMNS)})"""


@check("ks_shift", f"{_KS_SQL} SELECT * FROM ks")
def ks_shift(spark, sf_dir):
    return rounded(shift.ks_shift(_split_events(spark, sf_dir), _KS_COLUMNS))


def _shift_sql(c: str, n: int) -> str:
    return f"""SELECT '{c}' AS "column", coalesce(CAST({c} AS VARCHAR), 'unknown') AS value,
  count(*) FILTER (WHERE split = 'train') / (SELECT count(*) FROM split_rows WHERE split = 'train') AS train_ratio,
  count(*) FILTER (WHERE split = 'test') / (SELECT count(*) FROM split_rows WHERE split = 'test') AS test_ratio
  FROM split_rows GROUP BY 2 ORDER BY count(*) FILTER (WHERE split = 'train') DESC, 2 LIMIT {n}"""


_CAT_SQL = f"cats AS ((SELECT * FROM ({_shift_sql('event_type', 12)})) UNION ALL (SELECT * FROM ({_shift_sql('user_id', 12)})))"


@check("category_shift", f"""WITH {split_sql('events', 'event_id', 'value')}, {_CAT_SQL}
SELECT "column", value, round(train_ratio, 6) AS train_ratio, round(test_ratio, 6) AS test_ratio,
  round(abs(train_ratio - test_ratio), 6) AS abs_diff FROM cats""")
def category_shift(spark, sf_dir):
    return rounded(shift.category_shift(_split_events(spark, sf_dir), ["event_type", "user_id"], 12))


@check("shift_verdict", f"""{_KS_SQL}, {_CAT_SQL} SELECT "column", 'numeric' AS kind, ks_statistic AS measure,
  NOT (ks_pvalue > 0.05 OR ks_statistic <= 0.02) AS shifted FROM ks
UNION ALL SELECT "column", 'categorical', round(max(abs(train_ratio - test_ratio)), 6), max(abs(train_ratio - test_ratio)) > 0.01 FROM cats GROUP BY 1""")
def shift_verdict(spark, sf_dir):
    rows = _split_events(spark, sf_dir)
    return rounded(shift.shift_verdict(
        shift.ks_shift(rows, _KS_COLUMNS), shift.category_shift(rows, ["event_type", "user_id"], 12)))


@check("feature_report", SQL["shift_verdict"])
def report_of_features(spark, sf_dir):
    """The verdict that the whole report ends with."""
    rows = _split_events(spark, sf_dir).withColumn("is_salary_outlier", F.col("value") > 100)
    return rounded(feature_report(rows, _KS_COLUMNS, ["event_type", "user_id"])["shift_verdict"])


@check("clip_quantile", f"""WITH {split_sql('events', 'event_id', 'value')}, u AS (SELECT quantile_cont(value, 0.99) AS v,
  quantile_cont(CAST(user_id AS DOUBLE), 0.99) AS i FROM split_rows WHERE split = 'train')
SELECT event_id, split, round(least(value, v), 6) AS value, round(least(CAST(user_id AS DOUBLE), i), 6) AS user_id FROM split_rows, u""")
def clip_quantile(spark, sf_dir):
    rows = _split_events(spark, sf_dir).select("event_id", "split", "value", "user_id")
    return rounded(shift.clip_at_train_quantile(rows, ["value", "user_id"]))


@check("lump_rare", """WITH t AS (SELECT source FROM documents GROUP BY 1 ORDER BY count(*) DESC, source LIMIT 8)
SELECT doc_id, CASE WHEN source IN (SELECT source FROM t) THEN source ELSE 'other' END AS source FROM documents""")
def lump_rare(spark, sf_dir):
    return shift.lump_rare(load(spark, sf_dir, "documents").select("doc_id", "source"), "source")
