"""The given tables, and a postings table derived from them with the same SQL in both engines."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from jobmine.sources.tables import read_table, spread

TEXT_TABLES = ("documents", "pages", "conversations", "orders")

# Pay texts of every kind, spelled from an order's price; k is the order key.
SALARY = """CASE k % 40
  WHEN 0 THEN concat(a, 'tr')
  WHEN 1 THEN concat(a, ' tr - ', b, ' tr')
  WHEN 2 THEN concat(a, '.000.000 - ', b, '.000.000 vnd')
  WHEN 3 THEN concat(a, ',000,000 VND TRỞ LÊN')
  WHEN 4 THEN concat(a, '00 usd')
  WHEN 5 THEN concat('$', a, ',000/month')
  WHEN 6 THEN 'thỏa thuận'
  WHEN 7 THEN 'đang cập nhật'
  WHEN 8 THEN ''
  WHEN 9 THEN NULL
  WHEN 10 THEN concat(a, '.000.000đ')
  WHEN 11 THEN concat(a, '.000.000 đ')
  WHEN 12 THEN concat(a, ' triệu đồng')
  WHEN 13 THEN concat(a, ',5 tr')
  WHEN 14 THEN '1.2.3 vnd'
  WHEN 15 THEN '0 trieu'
  WHEN 16 THEN concat('up to ', b, ' trieu')
  WHEN 17 THEN concat(a, '-', b, '-40 trieu')
  WHEN 18 THEN concat('US$ ', a, '0 ~ ', b, '0')
  WHEN 19 THEN concat('<b>', a, ' - ', b, ' triệu</b>!!!')
  WHEN 20 THEN a
  WHEN 21 THEN concat('1.000 - 2.', a, '0 usd')
  WHEN 22 THEN 'abc'
  WHEN 23 THEN concat('Lương ', a, ' tr/tháng – ', b, ' tr/tháng')
  WHEN 24 THEN concat('  ', b, ' - ', a, '   Triệu ')
  WHEN 25 THEN concat(a, ' usd - 5000000 vnd')
  ELSE concat(a, ' - ', b, ' triệu') END"""

LOCATION = """CASE n_nationkey % 13
  WHEN 0 THEN 'TP. Hồ Chí Minh' WHEN 1 THEN 'Hà Nội' WHEN 2 THEN 'Đà Nẵng'
  WHEN 3 THEN 'Binh Duong, VN' WHEN 4 THEN 'Hải Phòng' WHEN 5 THEN 'TPHCM - Sai Gon'
  WHEN 6 THEN 'Cần Thơ' WHEN 7 THEN '  ' WHEN 8 THEN NULL WHEN 9 THEN 'unknown'
  WHEN 10 THEN 'Bắc Ninh/Hà Nội' WHEN 11 THEN 'khong' ELSE n_name END"""

DESCRIPTION = """concat('<p>Mô tả ', c_name, '!!!</p> ', CASE k % 6
  WHEN 0 THEN concat('Lương: ', a, ' - ', b, ' triệu, thưởng')
  WHEN 1 THEN concat('thu nhap ', a, '00 usd to ', b, '00 usd')
  WHEN 2 THEN concat('luong : cao, ', b, ' trung tâm')
  WHEN 3 THEN 'gọi 0912.345.678 hoặc a.b@mail.example.com'
  WHEN 4 THEN 'xem https://a.example.com/x?y=1 ...' ELSE 'không nêu' END)"""

# Column expressions of the derived table, the same text in both engines.
POSTING_COLUMNS = {
    "id": "k",
    "salary": SALARY,
    "job_title": "concat(c_mktsegment, ' ', substr(o_orderpriority, 3))",
    "company_name": "CASE WHEN k % 17 = 0 THEN NULL ELSE c_name END",
    "location": LOCATION,
    "job_type": "o_orderstatus",
    "job_industry": "CASE WHEN k % 23 = 0 THEN NULL ELSE c_mktsegment END",
    "experience_level": "o_orderpriority",
    "education_level": "CASE WHEN k % 11 = 0 THEN ' ' ELSE r_name END",
    "job_position": "CASE WHEN k % 9 = 0 THEN 'N/A' ELSE concat('Level ', k % 4) END",
    "job_description": DESCRIPTION,
    "benefits": "CASE WHEN k % 7 = 0 THEN NULL ELSE concat('Thưởng ', a, ' tr/tháng, bảo hiểm') END",
    "requirements": "CASE WHEN k % 5 = 0 THEN 'None' ELSE concat('Kinh nghiệm ', k % 6, ' năm ++ ', n_name) END",
}

_PRICED = {
    "k": "o_orderkey",
    "a": "CAST(CAST(floor(o_totalprice / 20000) AS INT) + 3 AS STRING)",
    "b": "CAST(CAST(floor(o_totalprice / 20000) AS INT) + 5 + CAST(o_orderkey % 7 AS INT) AS STRING)",
}
_CARRIED = ("o_orderstatus", "o_orderpriority", "c_name", "c_mktsegment", "n_name", "n_nationkey", "r_name")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    table = read_table(spark, path)
    return spread(table, path) if name in TEXT_TABLES else table


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posting per order, with its customer's company, place and field."""
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    customer = load(spark, sf_dir, "customer").drop("c_acctbal")
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    joined = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    priced = joined.selectExpr(*_select(_PRICED), *_CARRIED)
    return priced.selectExpr(*_select(POSTING_COLUMNS))


POSTINGS_SQL = f"""
priced AS (SELECT {', '.join(_select(_PRICED))}, {', '.join(_CARRIED)}
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
postings AS (SELECT {', '.join(_select(POSTING_COLUMNS))} FROM priced)"""


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder for a query that writes and reads back."""
    import uuid

    from jobmine.session import staging_dir

    return os.path.join(staging_dir(spark), f"{name}-{uuid.uuid4().hex}")
