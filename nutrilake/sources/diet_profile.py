"""The person-level diet table at driver scale.

``diet_profile`` derives the 15 raw columns (plus ``copy_no``) from the
``orders`` table with integer arithmetic only, so the same SQL text (but for the
generator of copies) runs in Spark and in DuckDB and gives identical cells.  It grows with ``orders`` and
carries real work for every operator: NULL weights and activity levels,
outlying fat intake, and a second copy of every 50th person (duplicates).
"""
from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from nutrilake.sources.tables import read_table

# Common-table expressions ending in ``diet``; usable as the head of a WITH
# clause in both engines.
DIET_PROFILE_CTES = """
base AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS pr, {copies} AS copy_no FROM {orders}
), m AS (
  SELECT k, c, pr, copy_no,
         150 + CAST(k * 7 % 450 AS DOUBLE) / 10 AS h,
         42 + CAST(k * 13 % 780 AS DOUBLE) / 10 AS w
  FROM base
), b AS (
  SELECT *, round(w / ((h / 100) * (h / 100)), 2) AS bmi FROM m
), diet AS (
SELECT
  CAST(copy_no AS INTEGER) AS copy_no,
  'P' || CAST(k AS STRING) AS Person_ID,
  CAST(5 + c % 80 AS INTEGER) AS Age,
  CASE k % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS Gender,
  h AS Height_cm,
  CASE WHEN k % 97 = 0 THEN CAST(NULL AS DOUBLE) ELSE w END AS Weight_kg,
  bmi AS BMI,
  CASE WHEN k % 101 = 0 THEN CAST(NULL AS STRING)
       ELSE CASE substr(pr, 1, 1) WHEN '1' THEN 'Sedentary' WHEN '2' THEN 'Lightly Active'
                 WHEN '3' THEN 'Moderately Active' WHEN '4' THEN 'Very Active'
                 ELSE 'Athlete' END END AS Activity_Level,
  CAST(1600 + k * 31 % 1400 AS DOUBLE) AS Daily_Calorie_Requirement,
  CAST((1600 + k * 31 % 1400) * (70 + c % 60) AS DOUBLE) / 100 AS Daily_Calorie_Consumed,
  CAST(40 + k * 17 % 140 AS DOUBLE) AS Protein_Intake_g,
  CAST(120 + k * 19 % 250 AS DOUBLE) AS Carbohydrate_Intake_g,
  CASE WHEN k % 211 = 0 THEN CAST(900 AS DOUBLE) ELSE CAST(35 + k * 23 % 70 AS DOUBLE) END
    AS Fat_Intake_g,
  1 + CAST(c * 11 % 25 AS DOUBLE) / 10 AS Water_Intake_Liters,
  CASE c % 6 WHEN 0 THEN 'Balanced' WHEN 1 THEN 'Keto' WHEN 2 THEN 'Vegetarian'
       WHEN 3 THEN 'Vegan' WHEN 4 THEN 'High Protein' ELSE 'Mediterranean' END AS Diet_Type,
  CASE WHEN bmi < 18.5 THEN 'Underweight' WHEN bmi < 25 THEN 'Healthy'
       WHEN bmi < 30 THEN 'Overweight' ELSE 'Obese' END AS Health_Status
FROM b
)"""


# Every 50th person twice, from one scan; the generator differs by engine.
COPIES_DUCKDB = "unnest(CASE WHEN o_orderkey % 50 = 0 THEN [0, 1] ELSE [0] END)"
COPIES_SPARK = "explode(CASE WHEN o_orderkey % 50 = 0 THEN array(0, 1) ELSE array(0) END)"


def diet_ctes(orders: str = "orders", copies: str = COPIES_DUCKDB) -> str:
    return DIET_PROFILE_CTES.format(orders=orders, copies=copies)


def diet_profile_sql(orders: str = "orders", copies: str = COPIES_SPARK) -> str:
    return "WITH " + diet_ctes(orders, copies) + "\nSELECT * FROM diet"


def diet_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diet table (with ``copy_no``) derived from ``<sf_dir>/orders``."""
    orders = read_table(spark, sf_dir, "orders")
    view = "nl_orders_" + hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    orders.createOrReplaceTempView(view)
    return spark.sql(diet_profile_sql(view))


def diet_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 raw columns only (``copy_no`` dropped)."""
    return diet_profile(spark, sf_dir).drop("copy_no")
