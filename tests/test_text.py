import pytest
from pyspark.sql import functions as F

from jobmine.functions import text as T
from jobmine.operators import cleaning

CLEAN = [
    ("  Xin <b>CHÀO</b>  ", "xin chào"),
    ("xem https://a.example.com/x?y=1 và www.b.vn/z nhé", "xem và nhé"),
    ("gửi a.b+c@mail.example.com, ngay", "gửi , ngay"),
    ("gọi 0912.345.678 hoặc +84 912 345 678", "gọi hoặc"),
    ("số 00912345678901 quá dài", "số 00912345678901 quá dài"),
    ("wow!!! a--b ... ,, c", "wow! a-b . , c"),
    ("a b　c\td\x1ce", "a b c d e"),
    ("Ａ１ ﬁn …", "a1 fin ."),
    ("é colé", "é colé"),
    (None, ""),
]


def one_column(spark, rows, expression):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, t string")
    return {r["i"]: r["v"] for r in df.select("i", expression(F.col("t")).alias("v")).collect()}


def test_clean_text(spark):
    found = one_column(spark, CLEAN, T.clean_text)
    for i, (text, expected) in enumerate(CLEAN):
        assert found[i] == expected, text


def test_salary_text_keeps_what_looks_like_a_phone(spark):
    found = one_column(spark, [("10.000.000-15.000.000",)], lambda c: T.clean_salary_text(T.unicode_nfkc(c)))
    assert found[0] == "10.000.000-15.000.000"


@pytest.mark.parametrize("text,folded", [
    ("Đà Nẵng", "Đa Nang"), ("thỏa thuận đ", "thoa thuan đ"), ("é", "e"), ("가", "가"),
])
def test_fold_accents(spark, text, folded):
    assert one_column(spark, [(text,)], T.fold_accents_all_scripts)[0] == folded


MENTIONS = [
    ("Lương: 10 - 15 triệu", True), ("luong 10", True), ("thu nhap : $ 500", True),
    ("3 trung tâm", True), ("15 người", False), ("lương cao", False), ("salary", False), (None, False),
]


def test_mentions(spark):
    found = one_column(spark, MENTIONS, T.mentions_salary)
    assert [found[i] for i in range(len(MENTIONS))] == [m for _, m in MENTIONS]


def test_strip_mentions(spark):
    rows = [("Salary: 5 - 6 trieu và thưởng",), ("luong : cao",), ("10 tr",)]
    found = one_column(spark, rows, T.strip_salary_mentions)
    assert [found[i] for i in range(3)] == ["và thưởng", "cao", "unknown"]


def test_fill_unknowns(spark):
    rows = [(1, "Khong", "x"), (2, "N/A", None), (3, " ", "None"), (4, "Ok", "NULL")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    found = {r["id"]: (r["a"], r["b"]) for r in cleaning.fill_unknowns(df, ["a", "b"]).collect()}
    assert found == {1: ("unknown", "x"), 2: ("unknown", "unknown"), 3: ("unknown", "unknown"), 4: ("ok", "unknown")}


def test_simplify_location(spark):
    rows = [("TP. Hồ Chí Minh",), ("Hà Nội",), ("Đà Nẵng",), ("Hcm - ha noi",), ("  ",), (None,), ("Huế",), ("Lahnstein",)]
    found = one_column(spark, rows, T.simplify_location)
    assert [found[i] for i in range(8)] == [
        "ho chi minh", "ha noi", "other", "ho chi minh", "unknown", "unknown", "other", "ha noi"]
    mapped = one_column(spark, rows, lambda c: T.simplify_location(c, map_d=True))
    assert mapped[2] == "da nang"
    plain = one_column(spark, rows, lambda c: T.simplify_location(c, fold=False))
    assert plain[1] == "other"


def test_engineer(spark):
    row = {
        "job_title": "dev", "job_description": "viết  mã", "requirements": None, "benefits": "tốt",
        "location": "ha noi", "salary_expected_million_vnd": 10.0, "salary_range_width": -1.0,
        "is_salary_outlier": True,
    }
    schema = "job_title string, job_description string, requirements string, benefits string, location string, salary_expected_million_vnd double, salary_range_width double, is_salary_outlier boolean"
    found = cleaning.engineer(spark.createDataFrame([tuple(row.values())], schema)).first()
    assert found["final_text"] == "dev dev viết mã tốt"
    assert (found["final_text_length"], found["requirements_length"]) == (19, 0)
    assert found["is_salary_outlier"] == 1 and found["log_salary_range_width"] == 0.0
    assert found["log_salary_expected"] == pytest.approx(2.397895, abs=1e-6)


def test_mention_log_mean_is_unweighted(spark):
    rows = [("train", "luong 5"), ("train", "x"), ("train", "y"), ("train", "z"), ("test", "luong 5")]
    df = spark.createDataFrame(rows, "split string, d string")
    log = cleaning.mention_log_by_column(cleaning.mention_log(df, ["d"])).first()
    assert (log["rows_with_salary_mentions"], log["salary_mention_ratio"]) == (2, 0.625)


def test_marks_rule_expressions_out(spark):
    texts = ["plain 7 words", "a <b>x</b> y", "see www.a.example.com/x or HTTPS://b", "m A.B@Mail.Example.com n",
             "call 0912.345.678 or +84 912345678", "<a@b.co> 12345678", None, ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = rows.select("i", T.clean_text(F.col("t")).alias("c"))
    assert [r["c"] for r in found.orderBy("i").collect()] == [
        "plain 7 words", "a x y", "see or", "m n", "call or", "12345678", "", ""]
    assert "Contains" in found._jdf.queryExecution().analyzed().toString() or "contains(" in (
        found._jdf.queryExecution().analyzed().toString().lower())
