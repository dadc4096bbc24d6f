"""Shared pieces of the registered queries: inputs derived from the data
folder and SQL fragments for the DuckDB oracle."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.operators.clean import drop_duplicates_first
from nutrilake.sources.diet_profile import diet_ctes, diet_profile

ROUND = 6


def r6(col: str | Column) -> Column:
    """Round a double for cross-engine comparison (alias kept)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("double"), ROUND)


def sql_r6(expr: str) -> str:
    # "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's round never yields -0.0)
    return f"(round(CAST({expr} AS DOUBLE), {ROUND}) + CAST(0 AS DOUBLE))"


def diet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw diet rows incl. the duplicate copies and ``copy_no``."""
    return diet_profile(spark, sf_dir)


def diet_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 on the diet table: first row per Person_ID (copy 0 wins)."""
    return drop_duplicates_first(diet(spark, sf_dir), S.ID_COLUMN, ["copy_no"]).drop("copy_no")


RAW_COLS_SQL = ", ".join(S.RAW_COLUMNS)

# SQL: the diet CTEs plus ``dd`` (deduplicated raw columns).
DIET_DD_CTES = diet_ctes("orders") + f""",
dd AS (
  SELECT {RAW_COLS_SQL} FROM (
    SELECT *, row_number() OVER (PARTITION BY Person_ID ORDER BY copy_no) AS _rn FROM diet
  ) WHERE _rn = 1
)"""


def with_dd(body: str, extra: str = "") -> str:
    """``WITH <diet>, dd[, extra] <body>``"""
    return "WITH " + DIET_DD_CTES + ("," + extra if extra else "") + "\n" + body
