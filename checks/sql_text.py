"""SQL for the text and pay rules, in a dialect without look-around and back-references.

The given texts are all in NFKC already, so the SQL has no normalisation step.
"""

from __future__ import annotations

SP = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NSP = SP.replace("[", "[^", 1)
W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"
D = r"\p{Nd}"


def sub(text: str, pattern: str, to: str) -> str:
    return f"regexp_replace({text}, '{pattern}', '{to}', 'g')"


def squeeze_spaces(text: str) -> str:
    return f"trim({sub(text, SP + '+', ' ')})"


def squeeze_punctuation(text: str) -> str:
    for char in ("!", r"\?", ",", r"\.", ";", ":", "-", "_", "=", r"\+", "/", r"\\", r"\|"):
        text = sub(text, f"{char}{{2,}}", r"\\" if char == r"\\" else char.lstrip("\\"))
    return text


def without_markup(text: str) -> str:
    text = sub(f"lower({text})", "<[^>]+>", " ")
    text = sub(text, f"https?://{NSP}+|www\\.{NSP}+", " ")
    email = rf"(^|{NW})[a-zı0-9_][a-zı0-9._%+-]*@[a-zı0-9.-]+\.[a-zı]{{2,}}({NW}|$)"
    for _ in range(2):  # neighbours are consumed, so adjacent matches need a second pass
        text = sub(text, email, r"\1 \2")
    return text


def clean(text: str) -> str:
    text = without_markup(f"coalesce({text}, '')")
    phone = rf"(^|[^{D}])(?:\+?84|0)(?:[\s\x0b\x1c-\x1f\x{{a0}}.-]?{D}){{8,10}}([^{D}]|$)"
    for _ in range(2):
        text = sub(text, phone, r"\1 \2")
    return squeeze_spaces(squeeze_punctuation(text))


def clean_salary(text: str) -> str:
    return squeeze_spaces(squeeze_punctuation(without_markup(f"coalesce({text}, '')")))


def filled(text: str) -> str:
    return (
        f"(CASE WHEN {clean(text)} IN ('', 'khong', 'none', 'n/a', 'null') THEN 'unknown' "
        f"ELSE {clean(text)} END)"
    )


UNIT = r"(?:usd|us\$|\$|trieu|tri[eệ]u|tr|vnd|vnđ|dong|/thang|/month)"
NUM = rf"\$?{SP}*{D}[{D}.,]*{SP}*"
TO = rf"{SP}*(?:-|~|to|den|t[ơo]i){SP}*"
MENTION = (
    rf"(?:luong|thu{SP}*nhap|salary){SP}*[:\-]?{SP}*{NUM}{UNIT}?(?:{TO}{NUM}{UNIT}?)?"
    rf"|{NUM}{UNIT}(?:{TO}{NUM}{UNIT})?"
)


def mentions(text: str) -> str:
    return f"regexp_matches({text}, '{MENTION}')"


def strip_mentions(cleaned: str) -> str:
    text = sub(cleaned, MENTION, " ")
    keyword = rf"(^|{NW})(?:luong|thu nhap|salary)(?:({NW})|$)"
    # A keyword, then blanks and an optional mark; the mark is only taken after a whole keyword.
    marked = rf"(^|{NW})(?:luong|thu nhap|salary){SP}*[:\-]"
    for _ in range(2):
        text = sub(text, marked, r"\1 ")
    for _ in range(2):
        text = sub(text, keyword, r"\1 \2")
    return f"coalesce(nullif({squeeze_spaces(text)}, ''), 'unknown')"


REPLACEMENTS = (
    ("us$", "usd"), ("$/month", " usd "), ("$ /month", " usd "), ("$/thang", " usd "),
    ("/month", " / month "), ("/thang", " / month "), ("tri u", "trieu"),
    ("trieu dong", "trieu"), ("vnd/thang", "vnd"), ("vnđ/tháng", "vnd"),
    ("~", " - "), ("–", " - "), ("—", " - "),
)
AMBIGUOUS = (
    "thoa thuan", "thương lượng", "thuong luong", "canh tranh", "cạnh tranh", "negotiable",
    "deal luong", "dang cap nhat", "đang cập nhật", "updating", "update", "competitive",
)


def normal_form(text: str) -> str:
    text = f"strip_accents({clean_salary(text)})"
    for old, new in REPLACEMENTS:
        text = f"replace({text}, '{old}', '{new}')"
    return squeeze_spaces(text)


def parsed_sql(source: str, col: str = "salary", out: str = "parsed") -> str:
    """CTEs that append the pay columns to ``source``."""
    million = rf"(^|{NW})(trieu|triệu|tr)({NW}|$)|{D}(tr|trieu|triệu)({NW}|$)"
    unit = rf"(^|{NW})(vnd|vnđ|dong|đ)({NW}|$)"
    ambiguous = " OR ".join(f"contains(t, '{k}')" for k in AMBIGUOUS)
    dollar = "CASE WHEN length({0}) - length(replace({0}, '.', '')) > 1 THEN replace({0}, '.', '') ELSE {0} END"
    dollar = dollar.format("replace(x, ',', '')")

    def convert(value: str) -> str:
        return (
            f"CASE WHEN unit = 'usd' THEN {value} * CAST(0.025 AS DOUBLE) WHEN has_million THEN {value} "
            f"WHEN has_unit THEN {value} / CAST(1000000 AS DOUBLE) ELSE {value} END"
        )

    dong = (
        r"CASE WHEN regexp_full_match(x, '[0-9]{1,3}(\.[0-9]{3})+') THEN replace(x, '.', '') "
        r"WHEN regexp_full_match(x, '[0-9]{1,3}(,[0-9]{3})+') THEN replace(x, ',', '') "
        "WHEN length(x) - length(replace(x, ',', '')) = 1 AND NOT contains(x, '.') "
        "AND length(x) - instr(x, ',') <= 2 THEN replace(x, ',', '.') "
        "ELSE replace(x, ',', '') END"
    )
    return rf"""
s1 AS (SELECT *, {normal_form(col)} AS t FROM {source}),
s2 AS (SELECT *, regexp_matches(t, '-|~|to|den|tơi|–|—') AS has_range,
    regexp_matches(t, '{D}') AS has_number, contains(t, 'usd') OR contains(t, '$') AS has_usd,
    regexp_matches(t, '{million}') AS has_million, regexp_matches(t, '{unit}') AS has_unit,
    ({ambiguous}) AS is_ambiguous FROM s1),
s3 AS (SELECT *, CASE WHEN t = '' THEN 'missing' WHEN is_ambiguous THEN 'ambiguous'
    WHEN NOT has_number THEN 'invalid'
    ELSE concat(CASE WHEN has_range THEN 'range_' ELSE 'single_' END,
      CASE WHEN has_usd THEN 'usd' WHEN has_million OR has_unit THEN 'vnd' ELSE 'unknown' END) END AS salary_pattern,
    CASE WHEN has_usd THEN 'usd' WHEN has_million OR has_unit THEN 'vnd' END AS unit FROM s2),
s4 AS (SELECT *, list_filter(list_transform(regexp_extract_all(t, '{D}[{D}.,]*'),
    lambda x: try_cast(CASE WHEN unit = 'usd' THEN {dollar} ELSE {dong} END AS DOUBLE)),
    lambda v: v IS NOT NULL) AS nums FROM s3),
s5 AS (SELECT *, CASE WHEN salary_pattern IN ('missing', 'ambiguous', 'invalid') THEN salary_pattern
    WHEN unit IS NULL THEN 'unknown_currency' WHEN len(nums) = 0 THEN 'no_numbers' ELSE 'valid' END AS status,
    CASE WHEN has_range AND len(nums) >= 2 THEN least(nums[1], nums[2]) ELSE nums[1] END AS low,
    CASE WHEN has_range AND len(nums) >= 2 THEN greatest(nums[1], nums[2]) ELSE nums[1] END AS high FROM s4),
s6 AS (SELECT *, {convert('low')} AS low_million, {convert('high')} AS high_million FROM s5),
{out} AS (SELECT * EXCLUDE (t, has_range, has_number, has_usd, has_million, has_unit, is_ambiguous, unit,
      nums, status, low, high, low_million, high_million),
    t AS salary_raw_normalized, CASE WHEN status = 'valid' THEN unit END AS salary_currency,
    CASE WHEN status = 'valid' THEN low_million END AS salary_min,
    CASE WHEN status = 'valid' THEN high_million END AS salary_max,
    CASE WHEN status = 'valid' THEN (low_million + high_million) / 2 END AS salary_expected_million_vnd,
    status AS salary_parse_status FROM s6)"""


TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: str, stop: list[str] | None = None) -> str:
    words = f"regexp_extract_all(lower(coalesce({text}, '')), '{TOKEN}')"
    if not stop:
        return words
    listed = ", ".join(f"'{s}'" for s in stop)
    return f"list_filter({words}, lambda w: w NOT IN ({listed}))"


def grams_sql(source: str, text: str, keep: str, low: int, high: int, stop: list[str] | None = None) -> str:
    """CTE ``grams(keep, g)`` with one row per occurrence of an n-gram."""
    parts = []
    for n in range(low, high + 1):
        pieces = " || ' ' || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(n))
        parts.append(
            f"SELECT {keep}, {pieces} AS g FROM (SELECT {keep}, w, unnest(range(1, len(w) - {n - 2})) AS i FROM words)"
        )
    return (
        f"words AS (SELECT {keep}, {tokens(text, stop)} AS w FROM {source}), "
        f"grams AS ({' UNION ALL '.join(parts)})"
    )
