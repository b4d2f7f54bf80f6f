import pytest
from pyspark.sql import functions as F

from jobmine.config import Settings
from jobmine.operators import salary

EDGE_CASES = [
    (None, None, "missing", "missing"),
    ("", None, "missing", "missing"),
    ("5.000.000đ", None, "unknown_currency", "single_unknown"),
    ("5.000.000 đ", 5.0, "valid", "single_vnd"),
    ("10 triệu đồng", 10.0, "valid", "single_vnd"),
    ("10.000.000-15.000.000 vnd", 12.5, "valid", "range_vnd"),
    ("$1,000/month", 25.0, "valid", "single_usd"),
    ("1.000 - 2.000 usd", 0.0375, "valid", "range_usd"),
    ("up to 15 trieu", 15.0, "valid", "range_vnd"),
    ("15-20-30 trieu", 17.5, "valid", "range_vnd"),
    ("10 - 5 trieu", 7.5, "valid", "range_vnd"),
    ("1,5 tr", 1.5, "valid", "single_vnd"),
    ("1.2.3 vnd", None, "no_numbers", "single_vnd"),
    ("0 trieu", 0.0, "valid", "single_vnd"),
    ("thỏa thuận 10-15 triệu", None, "ambiguous", "ambiguous"),
    ("15", None, "unknown_currency", "single_unknown"),
    ("abc", None, "invalid", "invalid"),
    ("１５ ｔｒ", 15.0, "valid", "single_vnd"),
    ("٣ triệu", 3.0, "valid", "single_vnd"),
    ("<i>US$ 700</i>", 17.5, "valid", "single_usd"),
]


def test_contract_holds(spark):
    assert salary.require_contract(spark).count() == 12


def test_contract_failure_raises(spark):
    with pytest.raises(AssertionError, match="4000 usd"):
        salary.require_contract(spark, Settings(usd_to_vnd=30_000.0))


def test_edge_cases(spark):
    rows = [(i, c[0]) for i, c in enumerate(EDGE_CASES)]
    parsed = salary.parse_salary(spark.createDataFrame(rows, "id int, salary string"))
    found = {r["id"]: r for r in parsed.collect()}
    for i, (text, expected, status, pattern) in enumerate(EDGE_CASES):
        row = found[i]
        assert (row["salary_parse_status"], row["salary_pattern"]) == (status, pattern), text
        assert row["salary_expected_million_vnd"] == pytest.approx(expected), text


def test_text_is_normalised_once(spark):
    parsed = salary.parse_salary(spark.createDataFrame([("5 tr",)], "salary string"))
    plan = parsed.where("salary_parse_status = 'valid'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("us$") == 1  # the chain of replacements
    assert plan.count("_normalize_nfkc(") == 1


def test_length_flags(spark):
    rows = [(1, "100 usd hoặc 2 triệu vnd"), (2, "thỏa thuận"), (3, None)]
    flags = salary.salary_length_flags(spark.createDataFrame(rows, "id int, salary string"))
    found = {r["id"]: r for r in flags.collect()}
    assert found[1]["salary_has_multiple_currencies"] and found[1]["salary_word_count"] == 6
    assert found[2]["salary_has_no_digits"] and found[2]["salary_length"] == 10
    assert found[3]["salary_length"] == 0 and found[3]["salary_word_count"] == 0


def test_range_width(spark):
    parsed = salary.parse_salary(spark.createDataFrame([("10 - 15 tr",)], "salary string"))
    assert salary.salary_range_width(parsed).select(F.round("salary_range_width", 6)).first()[0] == 5.0
