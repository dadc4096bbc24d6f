"""Health statistics and label studies (A1-A3)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions import rules


def distribution(df: DataFrame, column: str) -> DataFrame:
    """A2: value -> count (NULL kept as its own group)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def tally(entries: F.Column) -> F.Column:
    """MAP key -> summed count from an ARRAY<STRUCT<k, n>> whose keys may
    repeat (a small array of pre-aggregated cells; pure expressions).  NULL
    keys are left out, as a pandas value count leaves out missing values."""
    entries = F.filter(entries, lambda x: x["k"].isNotNull())
    keys = F.array_sort(F.array_distinct(F.transform(entries, lambda x: x["k"])))
    sums = F.transform(keys, lambda key: F.aggregate(
        F.filter(entries, lambda x: x["k"] == key), F.lit(0).cast("long"),
        lambda acc, x: acc + x["n"]))
    return F.map_from_arrays(keys, sums)


def _key(col: str) -> F.Column:
    return F.col(col).cast("string")


def health_statistics(df: DataFrame, status: str = S.TARGET_COLUMN, diet: str = "Diet_Type",
                      bmi: str = "BMI", consumed: str = "Daily_Calorie_Consumed",
                      requirement: str = "Daily_Calorie_Requirement") -> DataFrame:
    """A1 cells: one row per (status, diet) with counts and the sums behind
    the means -- the only aggregation that touches the full table."""
    balance = F.col(consumed) - F.col(requirement)
    return (df.groupBy(_key(status).alias("status"), _key(diet).alias("diet"))
            .agg(F.count(F.lit(1)).alias("people"),
                 F.count_if(rules.needs_intervention(status)).alias("needing_intervention"),
                 F.sum(bmi).alias("bmi_sum"), F.count(bmi).alias("bmi_n"),
                 F.sum(balance).alias("balance_sum"), F.count(balance).alias("balance_n")))


def health_summary(df: DataFrame, status: str = S.TARGET_COLUMN, diet: str = "Diet_Type",
                   bmi: str = "BMI", consumed: str = "Daily_Calorie_Consumed",
                   requirement: str = "Daily_Calorie_Requirement") -> DataFrame:
    """A1: one row: total, status and diet distributions (maps), people
    needing intervention, their percentage, mean BMI, mean calorie balance.

    One shuffle to the (status, diet) cells, then one aggregation over those
    few cells (no join).  Empty input -> no row.  Means skip NULL (the
    per-record loop of the source would turn one NaN into a NaN mean).
    """
    cells = health_statistics(df, status, diet, bmi, consumed, requirement)
    out = cells.agg(
        F.sum("people").alias("total_assessments"),
        F.sum("needing_intervention").alias("people_needing_intervention"),
        (F.sum("bmi_sum") / F.sum("bmi_n")).alias("average_bmi"),
        (F.sum("balance_sum") / F.sum("balance_n")).alias("average_calorie_balance"),
        F.collect_list(F.struct(F.col("status").alias("k"), F.col("people").alias("n"))).alias("_st"),
        F.collect_list(F.struct(F.col("diet").alias("k"), F.col("people").alias("n"))).alias("_dt"))
    return (out.where(F.col("total_assessments") > 0)
            .select("total_assessments",
                    tally(F.col("_st")).alias("health_status_distribution"),
                    tally(F.col("_dt")).alias("diet_type_distribution"),
                    "people_needing_intervention",
                    (F.col("people_needing_intervention") / F.col("total_assessments") * 100)
                    .alias("intervention_percentage"),
                    "average_bmi", "average_calorie_balance"))


def label_determinism(df: DataFrame, band: F.Column | None = None,
                      label: str = S.TARGET_COLUMN) -> DataFrame:
    """A3: does a banding of one column determine the label?

    One row per band: rows, distinct labels, the majority label and the
    number of rows that disagree with it (0 everywhere = deterministic).
    """
    band = band if band is not None else rules.bmi_band("BMI")
    cells = (df.select(band.alias("band"), F.col(label).alias("label"))
             .groupBy("band", "label").agg(F.count(F.lit(1)).alias("n")))
    return (cells.groupBy("band")
            .agg(F.sum("n").alias("rows"), F.count("label").alias("distinct_labels"),
                 F.max_by("label", F.struct("n", F.col("label"))).alias("majority_label"),
                 F.max("n").alias("_max"))
            .withColumn("violations", F.col("rows") - F.col("_max")).drop("_max"))
