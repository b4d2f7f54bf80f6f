"""Text expressions. All are native Spark expressions except Unicode normalisation."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import lru_cache, reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from jobmine.config import LOCATION_GROUPS

# White space as Unicode defines it, plus the four ASCII separator controls.
SPACE = r"[\s\x1c-\x1f]"
NOT_SPACE = r"[^\s\x1c-\x1f]"
WORD = r"[\p{L}\p{N}_]"
EDGE = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# What text cleaning removes or squeezes.
TAG = r"<[^>]+>"
URL = rf"(?U)https?://{NOT_SPACE}+|www\.{NOT_SPACE}+"
EMAIL = rf"{EDGE}[a-zı0-9._%+-]+@[a-zı0-9.-]+\.[a-zı]{{2,}}{EDGE}"
PHONE = rf"(?U)(?<!\d)(?:\+?84|0)(?:[\s\x1c-\x1f.-]?\d){{8,10}}(?!\d)"
REPEATED_PUNCTUATION = r"([!?,.;:\-_=+/\\|])\1+"
SPACES = rf"(?U){SPACE}+"

# Spellings that stand for a missing value after cleaning.
UNKNOWN_SPELLINGS = ("", "khong", "none", "n/a", "null")
UNKNOWN = "unknown"

# How a text mentions pay.
_UNIT = r"(?:usd|us\$|\$|trieu|tri[eệ]u|tr|vnd|vnđ|dong|/thang|/month)"
_NUMBER = rf"\$?{SPACE}*\d[\d.,]*{SPACE}*"
_JOIN = rf"{SPACE}*(?:-|~|to|den|t[ơo]i){SPACE}*"
SALARY_MENTION = (
    rf"(?iU)(?:luong|thu{SPACE}*nhap|salary){SPACE}*[:\-]?{SPACE}*{_NUMBER}{_UNIT}?"
    rf"(?:{_JOIN}{_NUMBER}{_UNIT}?)?"
    rf"|{_NUMBER}{_UNIT}(?:{_JOIN}{_NUMBER}{_UNIT})?"
)
SALARY_KEYWORD = rf"(?U){EDGE}(?:luong|thu nhap|salary){EDGE}{SPACE}*[:\-]?"

TOKEN = r"[\p{L}\p{N}_]{2,}"

# Blocks that hold nearly all text of Latin-script languages; see _settled_class.
_LATIN_BLOCKS = ((0x00, 0x24F), (0x1E00, 0x1EFF), (0x2010, 0x2027), (0x20A0, 0x20C0))


def _ranges(code_points: list[int]) -> str:
    """A regex character class body for sorted code points."""
    spans: list[list[int]] = []
    for cp in code_points:
        if spans and cp == spans[-1][1] + 1:
            spans[-1][1] = cp
        else:
            spans.append([cp, cp])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans)


@lru_cache
def _settled_class() -> str:
    """Characters NFKC never touches, whatever stands next to them, in the Latin blocks."""
    return _ranges([
        cp
        for lo, hi in _LATIN_BLOCKS
        for cp in range(lo, hi + 1)
        if unicodedata.normalize("NFKC", chr(cp)) == chr(cp) and not unicodedata.combining(chr(cp))
    ])


@lru_cache
def _folding() -> tuple[str, str, str]:
    """(from, to, rest): one-to-one accent folding, and the characters it cannot express.

    Derived from the canonical decompositions of the Unicode database, not from a word list.
    """
    source, target, rest = [], [], []
    for cp in range(0xA0, 0x30000):
        char = chr(cp)
        parts = unicodedata.normalize("NFD", char)
        if parts == char:
            continue
        base = [p for p in parts if unicodedata.category(p) != "Mn"]
        if len(base) == 1:
            source.append(char)
            target.append(base[0])
        elif base:
            rest.append(cp)
    return "".join(source), "".join(target), _ranges(rest)


@lru_cache
def _digits() -> tuple[str, str]:
    """Decimal digits of other scripts and their ASCII values."""
    found = [chr(c) for c in range(0x80, 0x20000) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(found), "".join(str(unicodedata.decimal(c)) for c in found)


@F.arrow_udf(StringType())
def _normalize_nfkc(text: pa.Array) -> pa.Array:
    return pa.array(
        [t if t is None else unicodedata.normalize("NFKC", t) for t in text.to_pylist()], pa.string()
    )


@F.arrow_udf(StringType())
def _fold_any(text: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.utf8_normalize(text, form="NFD"), r"\p{Mn}", "")


def unicode_nfkc(col: Column) -> Column:
    """Null becomes ``""``; other text is brought to NFKC.

    Spark has no such function. Only text holding a character that NFKC might change is sent to
    Arrow; for all other rows the worker sees a null.
    """
    text = col.cast("string")
    # The first test rejects plain characters at once, before the long class is looked at.
    unsettled = F.when(text.rlike(rf"[[^\x00-\x9f]&&[^{_settled_class()}]]"), text)
    return F.coalesce(_normalize_nfkc(unsettled), text, F.lit(""))


def fold_accents(col: Column) -> Column:
    """Decompose and drop nonspacing marks; letters without a decomposition (đ) stay."""
    source, target, _ = _folding()
    return F.regexp_replace(F.translate(col, source, target), r"\p{Mn}+", "")


def fold_accents_all_scripts(col: Column) -> Column:
    """As ``fold_accents``, also for characters that decompose to several letters (Hangul)."""
    rest = _folding()[2]  # all above the Latin and Cyrillic letters, so most text fails at once
    odd = F.when(col.rlike(rf"[[^\x00-\x{{9ca}}]&&[{rest}]]"), col)
    return F.coalesce(_fold_any(odd), fold_accents(col))


def ascii_digits(col: Column) -> Column:
    return F.translate(col, *_digits())


def squeeze_spaces(col: Column) -> Column:
    """Every run of white space becomes one blank; none at either end."""
    return F.trim(F.regexp_replace(col, SPACES, " "))


def strip(col: Column) -> Column:
    return F.regexp_replace(col, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def _blanked(col: Column, *rules: tuple[str, Sequence[str]]) -> Column:
    """Every match of the rules' patterns becomes a blank. A text without any of a pattern's marks
    has no match; searching it for a mark costs far less than running the expression over it."""
    for pattern, marks in rules:
        def blank(text: Column, pattern: str = pattern, marks: Sequence[str] = marks) -> Column:
            met = reduce(Column.__or__, [text.contains(m) for m in marks])
            return F.when(met, F.regexp_replace(text, pattern, " ")).otherwise(text)

        col = F.element_at(F.transform(F.array(col), lambda text: blank(text)), 1)
    return col


def _without_markup(settled: Column, *more: tuple[str, Sequence[str]]) -> Column:
    rules = (TAG, ("<",)), (URL, ("://", "www.")), (EMAIL, ("@",))
    return _blanked(F.lower(settled), *rules, *more)


def clean_text(col: Column) -> Column:
    """NFKC, lower case, no tags, addresses or phone numbers, no repeated punctuation."""
    text = _without_markup(unicode_nfkc(col), (PHONE, ("0", "84")))
    return squeeze_spaces(F.regexp_replace(text, REPEATED_PUNCTUATION, "$1"))


def clean_salary_text(settled: Column) -> Column:
    """As ``clean_text`` but digits that look like a phone number stay: they are pay ranges.

    Takes text that is in NFKC already.
    """
    text = F.regexp_replace(_without_markup(settled), REPEATED_PUNCTUATION, "$1")
    return squeeze_spaces(text)


def unknown_if_blank(col: Column) -> Column:
    return F.when(col.isin(*UNKNOWN_SPELLINGS), F.lit(UNKNOWN)).otherwise(col)


def value_or_unknown(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(UNKNOWN))


def mentions_salary(col: Column) -> Column:
    """For raw text."""
    return F.lower(unicode_nfkc(col)).rlike(SALARY_MENTION)


def cleaned_mentions_salary(col: Column) -> Column:
    """For text that is already clean."""
    return F.coalesce(col, F.lit("")).rlike(SALARY_MENTION)


def strip_salary_mentions(col: Column) -> Column:
    text = F.regexp_replace(clean_text(col), SALARY_MENTION, " ")
    text = squeeze_spaces(F.regexp_replace(text, SALARY_KEYWORD, " "))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(UNKNOWN))


def simplify_location(col: Column, fold: bool = True, map_d: bool = False) -> Column:
    """First matching city group, else ``unknown`` for blanks and ``other`` for the rest.

    ``map_d`` also maps the letter đ to d, which plain folding keeps.
    """
    text = F.lower(F.coalesce(col.cast("string"), F.lit("")))
    if fold:
        text = fold_accents(text)
    if map_d:
        text = F.translate(text, "đ", "d")
    label = None
    for city, keywords in LOCATION_GROUPS:
        hit = F.lit(False)
        for keyword in keywords:
            hit = hit | text.contains(keyword)
        label = F.when(hit, city) if label is None else label.when(hit, city)
    return label.when(strip(text).isin("", UNKNOWN, "khong"), UNKNOWN).otherwise(F.lit("other"))


def final_text(columns: list[Column]) -> Column:
    """The text to cluster on; the first column counts twice."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return squeeze_spaces(F.concat_ws(" ", parts[0], *parts))
