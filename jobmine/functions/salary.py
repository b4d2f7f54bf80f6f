"""Pay text expressions: normal form, pattern, currency, numbers and conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmine.config import AMBIGUOUS_KEYWORDS
from jobmine.functions import text as T

# Replacements on the folded pay text, in order.
REPLACEMENTS = (
    ("us$", "usd"),
    ("$/month", " usd "),
    ("$ /month", " usd "),
    ("$/thang", " usd "),
    ("/month", " / month "),
    ("/thang", " / month "),
    ("tri u", "trieu"),
    ("trieu dong", "trieu"),
    ("vnd/thang", "vnd"),
    ("vnđ/tháng", "vnd"),
    ("~", " - "),
    ("–", " - "),
    ("—", " - "),
)

# What separates two bounds, what counts as a million or a unit, what is a number.
RANGE = r"-|~|to|den|tơi|–|—"
MILLION = (
    rf"(?<!{T.WORD})(?:trieu|triệu|tr)(?!{T.WORD})|(?<=\p{{Nd}})(?:tr|trieu|triệu)(?!{T.WORD})"
)
VND_UNIT = rf"(?<!{T.WORD})(?:vnd|vnđ|dong|đ)(?!{T.WORD})"
NUMBER = r"\p{Nd}[\p{Nd}.,]*"
DOTTED_THOUSANDS = r"^\d{1,3}(\.\d{3})+$"
COMMA_THOUSANDS = r"^\d{1,3}(,\d{3})+$"
TWO_CURRENCIES = r"usd.*vnd|vnd.*usd|\$.*vnd|vnd.*\$"

DOLLAR = "usd"
DONG = "vnd"


def spell(folded: Column) -> Column:
    """One spelling for units and dashes of a clean, folded pay text."""
    text = folded
    for old, new in REPLACEMENTS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return T.squeeze_spaces(text)


def is_ambiguous(text: Column) -> Column:
    hit = F.lit(False)
    for keyword in AMBIGUOUS_KEYWORDS:
        hit = hit | text.contains(keyword)
    return hit


def has_dollar(text: Column) -> Column:
    return text.contains("usd") | text.contains("$")


def has_million(text: Column) -> Column:
    return text.rlike(MILLION)


def has_vnd_unit(text: Column) -> Column:
    return text.rlike(VND_UNIT)


def has_range(text: Column) -> Column:
    return text.rlike(RANGE)


def has_number(text: Column) -> Column:
    return text.rlike(r"\p{Nd}")


def pattern(text: Column) -> Column:
    """One of nine classes, for normalised text."""
    shape = F.when(has_range(text), "range_").otherwise(F.lit("single_"))
    unit = (
        F.when(has_dollar(text), DOLLAR)
        .when(has_million(text) | has_vnd_unit(text), DONG)
        .otherwise(F.lit("unknown"))
    )
    return (
        F.when(text == "", "missing")
        .when(is_ambiguous(text), "ambiguous")
        .when(has_number(text), F.concat(shape, unit))
        .otherwise(F.lit("invalid"))
    )


def currency(text: Column) -> Column:
    return F.when(has_dollar(text), DOLLAR).when(has_million(text) | has_vnd_unit(text), DONG)


def _occurrences(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _drop(text: Column, char: str) -> Column:
    return F.replace(text, F.lit(char), F.lit(""))


def _dollar_amount(token: Column) -> Column:
    bare = _drop(token, ",")
    return F.when(_occurrences(bare, ".") > 1, _drop(bare, ".")).otherwise(bare)


def _dong_amount(token: Column) -> Column:
    decimals = F.length(F.substring_index(token, ",", -1))
    lone_comma = (_occurrences(token, ",") == 1) & ~token.contains(".")
    return (
        F.when(token.rlike(DOTTED_THOUSANDS), _drop(token, "."))
        .when(token.rlike(COMMA_THOUSANDS), _drop(token, ","))
        .when(lone_comma & (decimals <= 2), F.translate(token, ",", "."))
        .otherwise(_drop(token, ","))
    )


def numbers(text: Column, unit: Column) -> Column:
    """All readable numbers of a normalised text, in order, as the currency writes them."""
    tokens = F.regexp_extract_all(T.ascii_digits(text), F.lit(NUMBER), F.lit(0))
    spelled = F.when(unit == DOLLAR, F.transform(tokens, _dollar_amount)).otherwise(
        F.transform(tokens, _dong_amount)
    )
    values = F.transform(spelled, lambda t: t.try_cast("double"))
    return F.filter(values, lambda v: v.isNotNull())


def divisor(text: Column) -> Column:
    """What a VND amount is divided by to be in millions."""
    return (
        F.when(has_million(text), 1.0).when(has_vnd_unit(text), 1_000_000.0).otherwise(F.lit(1.0))
    )


def to_million_vnd(value: Column, unit: Column, scale: Column, usd_to_million: float) -> Column:
    return F.when(unit == DOLLAR, value * F.lit(usd_to_million)).otherwise(value / scale)
