"""Pay extraction as a table step, its contract, and flags on the pay text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmine.config import Settings
from jobmine.functions import salary as S
from jobmine.functions import text as T
from jobmine.operators.rows import compute_once

SALARY_FIELDS = (
    "salary_raw_normalized", "salary_pattern", "salary_currency", "salary_min", "salary_max",
    "salary_expected_million_vnd", "salary_parse_status",
)

# Pay texts every parser must read, with expected value and status.
CONTRACT_CASES = (
    ("26 - 36 triệu", 31.0, "valid"),
    ("15 - 35 triệu", 25.0, "valid"),
    ("15tr", 15.0, "valid"),
    ("15 tr", 15.0, "valid"),
    ("15tr - 20tr", 17.5, "valid"),
    ("15 - 20 tr", 17.5, "valid"),
    ("4000 usd", 100.0, "valid"),
    ("1200 usd", 30.0, "valid"),
    ("14.000.000 - 20.000.000 vnd", 17.0, "valid"),
    ("8,000,000 VND TRỞ LÊN", 8.0, "valid"),
    ("thỏa thuận", None, "ambiguous"),
    ("đang cập nhật", None, "invalid"),
)


def with_normal_form(df: DataFrame, col: str, out: str = "salary_raw_normalized") -> DataFrame:
    """Append the normal form of a pay text: clean, fold, one spelling."""
    cleaned = compute_once(
        df.withColumn("_settled", T.unicode_nfkc(F.col(col))),
        _clean=T.clean_salary_text(F.col("_settled")),
    )
    folded = cleaned.withColumn("_folded", T.fold_accents_all_scripts(F.col("_clean")))
    named = compute_once(folded, **{out: S.spell(F.col("_folded"))})
    return named.drop("_settled", "_clean", "_folded")


def parse_salary(df: DataFrame, col: str = "salary", settings: Settings = Settings()) -> DataFrame:
    """Append the seven pay columns. Narrow: no shuffle, each expression evaluated once a row."""
    text = F.col("salary_raw_normalized")
    unit, found, scale = F.col("_unit"), F.col("_found"), F.col("_scale")
    base = df.select(*[c for c in df.columns if c not in SALARY_FIELDS or c == col])
    read = compute_once(
        with_normal_form(base, col),
        salary_pattern=S.pattern(text),
        _unit=S.currency(text),
        _scale=S.divisor(text),
        _range=S.has_range(text),
    )
    read = compute_once(read, _found=S.numbers(text, unit))
    status = (
        F.when(F.col("salary_pattern").isin("missing", "ambiguous", "invalid"), F.col("salary_pattern"))
        .when(unit.isNull(), "unknown_currency")
        .when(F.size(found) == 0, "no_numbers")
        .otherwise(F.lit("valid"))
    )
    first, second = F.get(found, F.lit(0)), F.get(found, F.lit(1))
    bounded = F.col("_range") & (F.size(found) >= 2)
    read = compute_once(
        read,
        salary_parse_status=status,
        _low=F.when(bounded, F.least(first, second)).otherwise(first),
        _high=F.when(bounded, F.greatest(first, second)).otherwise(first),
    )
    valid = F.col("salary_parse_status") == "valid"
    rate = settings.usd_to_vnd / 1e6
    low, high = (S.to_million_vnd(F.col(c), unit, scale, rate) for c in ("_low", "_high"))
    read = read.withColumns({
        "salary_currency": F.when(valid, unit),
        "salary_min": F.when(valid, low),
        "salary_max": F.when(valid, high),
    }).withColumn(
        "salary_expected_million_vnd", (F.col("salary_min") + F.col("salary_max")) / 2.0
    )
    return read.select(*base.columns, *SALARY_FIELDS)


def salary_range_width(df: DataFrame) -> DataFrame:
    return df.withColumn("salary_range_width", F.col("salary_max") - F.col("salary_min"))


def parse_contract(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """The contract cases run through the parser; the caller checks ``passed``."""
    cases = spark.createDataFrame(
        CONTRACT_CASES, "salary string, expected double, expected_status string"
    )
    value, expected = F.col("salary_expected_million_vnd"), F.col("expected")
    value_ok = F.when(expected.isNull(), value.isNull()).otherwise(
        F.coalesce(F.abs(value - expected) < 1e-9, F.lit(False))
    )
    return (
        parse_salary(cases, "salary", settings)
        .withColumns({
            "value_ok": value_ok,
            "status_ok": F.col("salary_parse_status") == F.col("expected_status"),
        })
        .withColumn("passed", F.col("value_ok") & F.col("status_ok"))
    )


def require_contract(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """Raise unless every contract case passes; returns the table of cases."""
    cases = parse_contract(spark, settings)
    failed = cases.where(~F.col("passed")).select("salary", "expected", "salary_parse_status")
    rows = failed.collect()
    if rows:
        raise AssertionError(f"pay parser contract failed: {rows}")
    return cases


def salary_patterns(df: DataFrame, col: str = "salary") -> DataFrame:
    """Append the normal form and its pattern only."""
    return compute_once(
        with_normal_form(df, col), salary_pattern=S.pattern(F.col("salary_raw_normalized"))
    )


def flag_normal_form(df: DataFrame, col: str = "salary_raw_normalized") -> DataFrame:
    """Length, words, two currencies, no digit of a normal form."""
    text = F.col(col)
    return df.withColumns({
        "salary_length": F.length(text),
        "salary_word_count": F.when(text == "", 0).otherwise(F.size(F.split(text, " "))),
        "salary_has_multiple_currencies": text.rlike(S.TWO_CURRENCIES),
        "salary_has_no_digits": ~S.has_number(text),
    })


def salary_length_flags(df: DataFrame, col: str = "salary") -> DataFrame:
    """The flags of a pay text, taken on its normal form."""
    return flag_normal_form(with_normal_form(df, col, "_text"), "_text").drop("_text")
