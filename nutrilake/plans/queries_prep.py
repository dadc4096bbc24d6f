"""Registered queries: load, profile, row rules, cleaning, split, encode,
statistics.  Each Spark builder calls the library operators; the SQL next
to it is the independent DuckDB oracle over the same parquet tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions import rules
from nutrilake.operators import clean, encode, profile, split, stats
from nutrilake.plans import sqlgen as G
from nutrilake.plans.common import diet, diet_dedup, r6, sql_r6, with_dd
from nutrilake.plans.preprocess import prepare
from nutrilake.plans.registry import query
from nutrilake.sources import loader
from nutrilake.sources.diet_profile import diet_ctes
from nutrilake.sources.tables import read_table

LINEITEM_PROFILE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                         "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _prepared(spark: SparkSession, sf_dir: str):
    return prepare(diet(spark, sf_dir), order_by=["copy_no"])


# ---------------------------------------------------------------- A1 / S6
def _flatten_maps(df: DataFrame, scalars: list[str], maps: list[str]) -> DataFrame:
    """One-row summary -> (measure, key, value) rows with a single explode."""
    entries = F.array(*[F.struct(F.lit(s).alias("measure"), F.lit("").alias("key"),
                                 r6(s).alias("value")) for s in scalars])
    for m in maps:
        entries = F.concat(entries, F.transform(F.map_entries(m), _entry_struct(m)))
    return df.select(F.explode(entries).alias("r")).select("r.*")


def _entry_struct(measure: str, with_text: bool = False):
    """Map entry -> (measure, key, value[, text]) struct (one-argument lambda:
    a second lambda parameter would be read as the element index)."""
    def build(e):
        fields = [F.lit(measure).alias("measure"), e["key"].alias("key"),
                  e["value"].cast("double").alias("value")]
        if with_text:
            fields.append(F.lit(None).cast("string").alias("text"))
        return F.struct(*fields)
    return build


_STATUS_IN = ", ".join(G.lit(s) for s in S.INTERVENTION_STATUSES)
HEALTH_STATS_SQL = with_dd(f"""
SELECT 'total_assessments' AS measure, '' AS key, CAST(count(*) AS DOUBLE) AS value FROM dd
UNION ALL SELECT 'people_needing_intervention', '', CAST(count(*) FILTER (WHERE Health_Status IN ({_STATUS_IN})) AS DOUBLE) FROM dd
UNION ALL SELECT 'intervention_percentage', '', {sql_r6(f"CAST(count(*) FILTER (WHERE Health_Status IN ({_STATUS_IN})) AS DOUBLE) / count(*) * 100")} FROM dd
UNION ALL SELECT 'average_bmi', '', {sql_r6("avg(BMI)")} FROM dd
UNION ALL SELECT 'average_calorie_balance', '', {sql_r6("avg(Daily_Calorie_Consumed - Daily_Calorie_Requirement)")} FROM dd
UNION ALL SELECT 'health_status_distribution', Health_Status, CAST(count(*) AS DOUBLE) FROM dd GROUP BY Health_Status
UNION ALL SELECT 'diet_type_distribution', Diet_Type, CAST(count(*) AS DOUBLE) FROM dd GROUP BY Diet_Type
""")


@query("health_stats", HEALTH_STATS_SQL)
def q_health_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = stats.health_summary(diet_dedup(spark, sf_dir))
    return _flatten_maps(summary, ["total_assessments", "people_needing_intervention",
                                   "intervention_percentage", "average_bmi",
                                   "average_calorie_balance"],
                         ["health_status_distribution", "diet_type_distribution"])


OVERVIEW_SQL = "WITH " + diet_ctes("orders") + """,
raw AS (SELECT * EXCLUDE (copy_no) FROM diet)
SELECT 'total_records' AS measure, '' AS key, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM raw
UNION ALL SELECT 'total_columns', '', 15.0, NULL
UNION ALL SELECT 'age_range', '', NULL, CAST(min(Age) AS VARCHAR) || ' - ' || CAST(max(Age) AS VARCHAR) FROM raw
UNION ALL SELECT 'bmi_range', '', NULL, printf('%.1f - %.1f', min(BMI), max(BMI)) FROM raw
UNION ALL SELECT 'health_status_distribution', Health_Status, CAST(count(*) AS DOUBLE), NULL FROM raw GROUP BY Health_Status
UNION ALL SELECT 'diet_type_distribution', Diet_Type, CAST(count(*) AS DOUBLE), NULL FROM raw GROUP BY Diet_Type
"""


@query("dataset_overview", OVERVIEW_SQL)
def q_dataset_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    ov = loader.dataset_overview(diet(spark, sf_dir).drop("copy_no"))
    none = F.lit(None)
    entries = F.array(*[F.struct(F.lit(s).alias("measure"), F.lit("").alias("key"),
                                 F.col(s).cast("double").alias("value"), none.cast("string").alias("text"))
                        for s in ("total_records", "total_columns")],
                      *[F.struct(F.lit(s).alias("measure"), F.lit("").alias("key"),
                                 none.cast("double").alias("value"), F.col(s).alias("text"))
                        for s in ("age_range", "bmi_range")])
    for m in ("health_status_distribution", "diet_type_distribution"):
        entries = F.concat(entries, F.transform(F.map_entries(m), _entry_struct(m, True)))
    return ov.select(F.explode(entries).alias("r")).select("r.*")


# ---------------------------------------------------------------- D / E
_ENG = G.engineered_sql()
ENGINEERED_SQL = "WITH " + diet_ctes("orders") + "\nSELECT Person_ID, copy_no, " + ", ".join(
    (f"{e} AS {n}" if n in ("Age_Group", "Adequate_Water_Intake") else f"{sql_r6(e)} AS {n}")
    for n, e in _ENG.items()) + " FROM diet"


@query("engineered_features", ENGINEERED_SQL)
def q_engineered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    eng = rules.engineer_features(diet(spark, sf_dir))
    return eng.select("Person_ID", "copy_no", *[
        F.col(c) if c in ("Age_Group", "Adequate_Water_Intake") else r6(c).alias(c)
        for c in rules.engineered_columns()])


ROW_RULES_SQL = "WITH " + diet_ctes("orders") + f"""
SELECT Person_ID, copy_no,
  (BMI >= {rules.HEALTHY_BMI_LOW!r} AND BMI < {rules.HEALTHY_BMI_HIGH!r}) AS is_healthy,
  (Health_Status IN ({_STATUS_IN})) AS needs_intervention,
  {sql_r6(f"Protein_Intake_g * {rules.KCAL_PER_G_PROTEIN!r}")} AS protein_kcal,
  {sql_r6(f"Carbohydrate_Intake_g * {rules.KCAL_PER_G_CARB!r}")} AS carb_kcal,
  {sql_r6(f"Fat_Intake_g * {rules.KCAL_PER_G_FAT!r}")} AS fat_kcal,
  round(Weight_kg / ((Height_cm / 100.0) * (Height_cm / 100.0)), 2) AS bmi_from_measurements,
  {G.bmi_band_sql("BMI")} AS bmi_band
FROM diet"""


@query("row_rules", ROW_RULES_SQL)
def q_row_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = rules.domain_flags(diet(spark, sf_dir))
    return d.select("Person_ID", "copy_no", "is_healthy", "needs_intervention",
                    r6("macro_kcal.protein_kcal").alias("protein_kcal"),
                    r6("macro_kcal.carb_kcal").alias("carb_kcal"),
                    r6("macro_kcal.fat_kcal").alias("fat_kcal"),
                    rules.bmi_from_measurements().alias("bmi_from_measurements"),
                    rules.bmi_band("BMI").alias("bmi_band"))


# ---------------------------------------------------------------- C1
_LI_KEY = ["l_orderkey", "l_linenumber"]
_LI_REST = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
_LI_OUT = [c for c in _LI_KEY + _LI_REST if c != "l_shipdate"]
DEDUP_FIRST_SQL = f"""
SELECT {", ".join(_LI_OUT)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {", ".join(_LI_KEY)}
                               ORDER BY {", ".join(c + " NULLS FIRST" for c in _LI_REST)}) AS _rn
  FROM lineitem) WHERE _rn = 1"""


@query("dedup_first", DEDUP_FIRST_SQL)
def q_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    first = clean.drop_duplicates_first(li.select(*_LI_KEY, *_LI_REST), _LI_KEY, _LI_REST)
    return first.select(*_LI_OUT)


DEDUP_ROWS_SQL = "WITH " + diet_ctes("orders") + "\nSELECT DISTINCT * EXCLUDE (copy_no) FROM diet"


@query("dedup_rows", DEDUP_ROWS_SQL)
def q_dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.drop_duplicate_rows(diet(spark, sf_dir).drop("copy_no"))


# ---------------------------------------------------------------- S2-S4, S7
SAMPLE_SQL = with_dd("SELECT Person_ID, Health_Status FROM dd ORDER BY md5('42:' || Person_ID), Person_ID LIMIT 1000")


@query("sample_n", SAMPLE_SQL)
def q_sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loader.sample_n(diet_dedup(spark, sf_dir), 1000, seed=42).select("Person_ID", "Health_Status")


_RECORD_NUMBERS = ["Height_cm", "Weight_kg", "BMI", "Daily_Calorie_Requirement", "Daily_Calorie_Consumed",
                   "Protein_Intake_g", "Carbohydrate_Intake_g", "Fat_Intake_g", "Water_Intake_Liters"]

# The raw table, duplicates kept, where every seventh age has lost its id.
_LOST_ID = "CASE WHEN Age % 7 = 0 THEN CAST(NULL AS STRING) ELSE Person_ID END"
_RAW_REST = [c for c in S.RAW_COLUMNS if c != S.ID_COLUMN]
_CELL = "coalesce(CAST({} AS VARCHAR), chr(9216))"
SAMPLE_RAW_SQL = "WITH " + diet_ctes("orders") + f""",
raw AS (SELECT {_LOST_ID} AS Person_ID, {", ".join(_RAW_REST)} FROM diet),
o AS (SELECT *, md5('42:' || {_CELL.format("Person_ID")}) AS o1,
      md5(concat_ws('|', {", ".join(_CELL.format(c) for c in S.RAW_COLUMNS)})) AS o2 FROM raw)
SELECT Person_ID, Age, Diet_Type, {sql_r6("Height_cm")} AS Height_cm FROM o ORDER BY o1, o2 LIMIT 777"""


def _lost_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diet(spark, sf_dir).select(F.expr(_LOST_ID).alias("Person_ID"), *_RAW_REST)


@query("sample_n_raw", SAMPLE_RAW_SQL)
def q_sample_n_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 over rows with repeated and missing keys."""
    return loader.sample_n(_lost_ids(spark, sf_dir), 777, seed=42).select(
        "Person_ID", "Age", "Diet_Type", r6("Height_cm").alias("Height_cm"))


KFOLD_NULL_SQL = "WITH " + diet_ctes("orders") + f""",
f AS (SELECT Health_Status, (row_number() OVER (PARTITION BY Health_Status) - 1) % 5 AS fold FROM diet)
SELECT Health_Status, CAST(fold AS INTEGER) AS fold, count(*) AS rows FROM f GROUP BY 1, 2"""


@query("kfold_null_keys", KFOLD_NULL_SQL)
def q_kfold_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 over rows with repeated and missing keys: every row is in a fold."""
    folds = split.stratified_folds(_lost_ids(spark, sf_dir), 5)
    return folds.groupBy("Health_Status", "fold").agg(F.count(F.lit(1)).alias("rows"))


_ODD_ID = "CASE WHEN Age % 5 = 0 THEN Person_ID || ' \"q\", x' || chr(10) || 'y' ELSE Person_ID END"
CSV_SCAN_SQL = "WITH " + diet_ctes("orders") + f"""
SELECT {_ODD_ID} AS Person_ID, Age, Gender, Activity_Level, Diet_Type, Health_Status, copy_no,
       {", ".join(f"{sql_r6(c)} AS {c}" for c in _RECORD_NUMBERS)} FROM diet"""


@query("csv_scan", CSV_SCAN_SQL)
def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table with quotes, commas and line ends in a field, written
    as CSV (half of the missing cells spelt NA) and loaded again."""
    from nutrilake.plans.queries_model import scratch_dir
    path = scratch_dir(spark, "csv")
    level = F.when(F.col("Activity_Level").isNull() & (F.col("Age") % 2 == 0), "NA").otherwise(F.col("Activity_Level"))
    (diet(spark, sf_dir).withColumn("Person_ID", F.expr(_ODD_ID)).withColumn("Activity_Level", level)
     .write.option("header", True).option("escape", '"').csv(path))
    back = loader.load_table(spark, path, fmt="csv")
    return back.select("Person_ID", "Age", "Gender", "Activity_Level", "Diet_Type", "Health_Status",
                       F.col("copy_no").cast("int").alias("copy_no"), *[r6(c).alias(c) for c in _RECORD_NUMBERS])


_NA_SQL = ", ".join(G.lit(s) for s in G.NA_STRINGS)


def _text_lineitem_sql() -> str:
    return """txt AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 3 THEN 'NA' WHEN l_linenumber = 5 THEN 'x' || CAST(l_quantity AS VARCHAR)
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS l_quantity,
    CASE WHEN l_linenumber = 2 THEN '' WHEN l_linenumber = 6 THEN 'n/a'
         ELSE CAST(CAST(round(l_discount * 100) AS BIGINT) AS VARCHAR) END AS l_discount
  FROM lineitem)"""


def _text_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity")
    d = F.col("l_discount")
    ln = F.col("l_linenumber")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(ln == 3, "NA").when(ln == 5, F.concat(F.lit("x"), q.cast("string")))
        .otherwise(q.cast("bigint").cast("string")).alias("l_quantity"),
        F.when(ln == 2, "").when(ln == 6, "n/a")
        .otherwise(F.round(d * 100).cast("bigint").cast("string")).alias("l_discount"))


def _coerce_sql(c: str) -> str:
    return f"CASE WHEN {c} IN ({_NA_SQL}) THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END"


COERCE_SQL = f"""WITH {_text_lineitem_sql()}
SELECT l_orderkey, l_linenumber, {_coerce_sql("l_quantity")} AS l_quantity,
       {_coerce_sql("l_discount")} AS l_discount FROM txt"""


@query("coerce_numeric", COERCE_SQL)
def q_coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    txt = _text_lineitem(spark, sf_dir)
    txt = txt.select("l_orderkey", "l_linenumber",
                     *[loader._na_to_null(F.col(c)).alias(c) for c in ("l_quantity", "l_discount")])
    return loader.coerce_numeric(txt, ["l_quantity", "l_discount"])


COERCION_LOSSES_SQL = f"""WITH {_text_lineitem_sql()}
SELECT 'l_quantity' AS column, count(*) FILTER (WHERE l_quantity NOT IN ({_NA_SQL}) AND TRY_CAST(l_quantity AS DOUBLE) IS NULL) AS lost FROM txt
UNION ALL
SELECT 'l_discount', count(*) FILTER (WHERE l_discount NOT IN ({_NA_SQL}) AND TRY_CAST(l_discount AS DOUBLE) IS NULL) FROM txt"""


@query("coercion_losses", COERCION_LOSSES_SQL)
def q_coercion_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    txt = _text_lineitem(spark, sf_dir)
    txt = txt.select(*[loader._na_to_null(F.col(c)).alias(c) for c in ("l_quantity", "l_discount")])
    return loader.coercion_losses(txt, ["l_quantity", "l_discount"])


def _errors_sql() -> str:
    acts = ", ".join(G.lit(a) for a in G.ACTIVITY_LEVELS)
    diets = ", ".join(G.lit(a) for a in G.DIET_TYPES)
    stats_ = ", ".join(G.lit(a) for a in G.HEALTH_STATUSES)
    return ("concat_ws(', ', "
            f"CASE WHEN Activity_Level IS NULL OR Activity_Level NOT IN ({acts}) THEN 'invalid Activity_Level' END, "
            f"CASE WHEN Diet_Type IS NULL OR Diet_Type NOT IN ({diets}) THEN 'invalid Diet_Type' END, "
            f"CASE WHEN Health_Status IS NULL OR Health_Status NOT IN ({stats_}) THEN 'invalid Health_Status' END, "
            "CASE WHEN Age IS NULL THEN 'missing Age' END)")


_RECORD_SQL = ("Person_ID AS person_id, Age AS age, Gender AS gender, Activity_Level AS activity_level, "
               "Diet_Type AS diet_type, Health_Status AS health_status, "
               + ", ".join(f"{sql_r6(c)} AS {c.lower()}" for c in _RECORD_NUMBERS))
TYPED_SQL = "WITH " + diet_ctes("orders") + f"""
SELECT {_RECORD_SQL}, {_errors_sql()} AS errors
FROM diet"""


def _flat_records(rec: DataFrame) -> DataFrame:
    return rec.select("person.person_id", "person.age", "person.gender", "person.activity_level",
                      "diet_type", "health_status",
                      *[r6(f"{'person' if i < 3 else 'nutrition'}.{c.lower()}").alias(c.lower())
                        for i, c in enumerate(_RECORD_NUMBERS)],
                      F.array_join("errors", ", ").alias("errors"))


@query("typed_records", TYPED_SQL)
def q_typed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_records(loader.typed_records(diet(spark, sf_dir)))


LOAD_VALIDATED_SQL = "WITH " + diet_ctes("orders") + f""",
t AS (SELECT *, {_errors_sql()} AS errors FROM diet)
SELECT {_RECORD_SQL}, errors
FROM t WHERE errors = ''"""


@query("load_validated", LOAD_VALIDATED_SQL)
def q_load_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = loader.coerce_numeric(loader.check_columns(diet(spark, sf_dir)))
    valid, _rejected = loader.load_records(raw, strict=False)
    return _flat_records(valid)


SOURCE_INVENTORY_SQL = "SELECT 'lineitem.parquet' AS file_name, count(*) AS rows, TRUE AS has_bytes FROM lineitem"


@query("source_inventory", SOURCE_INVENTORY_SQL)
def q_source_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = loader.source_inventory(read_table(spark, sf_dir, "lineitem"))
    return files.select(F.element_at(F.split("file_path", "/"), -1).alias("file_name"), "rows",
                        (F.col("size_bytes") > 0).alias("has_bytes"))


# ---------------------------------------------------------------- P
_SPARK_TYPES = {"Person_ID": "string", "Age": "int", "Gender": "string",
                "Activity_Level": "string", "Diet_Type": "string", "Health_Status": "string"}
_LI_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
             "l_linenumber": "int", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}


def profile_sql(src: str, columns: list[str], types: dict[str, str], numeric: list[str],
                factor: float = 1.5, k: int = 5) -> str:
    parts = []
    for c in columns:
        t = types.get(c, "double")
        num = c in numeric
        val = f"CAST({c} AS DOUBLE)" if num else f"CAST({c} AS VARCHAR)"
        miss = f"(count(*) - count({c}))"
        ex = (f"array_to_string(list_transform(list_slice(list_sort(list(DISTINCT {val}) FILTER (WHERE {c} IS NOT NULL)), 1, {k}), "
              f"lambda x: CAST(x AS VARCHAR)), '|')")
        if num:
            q1 = f"(SELECT quantile_cont({c}, 0.25) FROM {src})"
            q3 = f"(SELECT quantile_cont({c}, 0.75) FROM {src})"
            outl = (f"round(CAST(count(*) FILTER (WHERE {c} < {q1} - {factor!r} * ({q3} - {q1}) "
                    f"OR {c} > {q3} + {factor!r} * ({q3} - {q1})) AS DOUBLE) / count(*) * 100, 2)")
            skew = f"(round(skewness({val}), 2) + CAST(0 AS DOUBLE))"
        else:
            outl, skew = "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS Column, '{t}' AS Type, {miss} AS Missing, "
            f"round(CAST({miss} AS DOUBLE) / count(*) * 100, 2) AS Pct_Missing, "
            f"count(DISTINCT {c}) AS Cardinality, count(DISTINCT {c}) <= 1 AS Constant, "
            f"{skew} AS Skewness, {outl} AS Pct_Outliers, {ex} AS Examples FROM {src}")
    return "\nUNION ALL ".join(parts)


def _profile_out(df: DataFrame) -> DataFrame:
    return df.withColumn("Examples", F.array_join("Examples", "|"))


PROFILE_DIET_SQL = "WITH " + diet_ctes("orders") + ", raw AS (SELECT * EXCLUDE (copy_no) FROM diet)\n" + \
    profile_sql("raw", S.RAW_COLUMNS, _SPARK_TYPES, S.RAW_NUMERIC_COLUMNS)


@query("profile_diet", PROFILE_DIET_SQL)
def q_profile_diet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_out(profile.dataset_profile(diet(spark, sf_dir).drop("copy_no")))


_LI_NUM = [c for c in LINEITEM_PROFILE_COLS if c not in ("l_returnflag", "l_linestatus", "l_shipdate")]
PROFILE_LINEITEM_SQL = profile_sql("lineitem", LINEITEM_PROFILE_COLS, _LI_TYPES, _LI_NUM)


@query("profile_lineitem", PROFILE_LINEITEM_SQL)
def q_profile_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(*LINEITEM_PROFILE_COLS)
    return _profile_out(profile.dataset_profile(li))


# ---------------------------------------------------------------- L
SPLIT_COUNTS_SQL = with_dd("SELECT Health_Status, split, count(*) AS rows FROM sp GROUP BY Health_Status, split",
                           G.split_ctes("dd"))


@query("split_counts", SPLIT_COUNTS_SQL)
def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = split.stratified_split(diet_dedup(spark, sf_dir))
    return s.groupBy("Health_Status", "split").agg(F.count(F.lit(1)).alias("rows"))


SPLIT_ASSIGN_SQL = with_dd("SELECT Person_ID, Health_Status, split FROM sp", G.split_ctes("dd"))


@query("split_assign", SPLIT_ASSIGN_SQL)
def q_split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(diet_dedup(spark, sf_dir)).select("Person_ID", "Health_Status", "split")


_LI_SPLIT_KEY = "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) || '|' || CAST(l_extendedprice AS VARCHAR)"
SPLIT_LINEITEM_SQL = "WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, " \
    f"md5('7:' || {_LI_SPLIT_KEY}) AS _h FROM lineitem)," + \
    G.split_ctes("li", target="l_returnflag", key="_h", test_size=0.25, seed=7).replace(
        "md5('7:' || CAST(_h AS VARCHAR))", "_h") + \
    "\nSELECT l_returnflag, split, count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM sp GROUP BY l_returnflag, split"


@query("split_lineitem", SPLIT_LINEITEM_SQL)
def q_split_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified split of lineitem by return flag (native table, composite
    key; the extended price is part of the key so rows are unique)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice")
    s = split.stratified_split(li, "l_returnflag", 0.25, 7,
                               ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                "l_extendedprice"])
    return s.groupBy("l_returnflag", "split").agg(F.count(F.lit(1)).alias("rows"),
                                                  F.sum("l_orderkey").alias("key_sum"))


KFOLD_SQL = with_dd("""SELECT Person_ID, Health_Status,
  CAST((row_number() OVER (PARTITION BY Health_Status ORDER BY md5('42:' || Person_ID), Person_ID) - 1) % 5 AS INTEGER) AS fold
FROM dd""")


@query("kfold_assign", KFOLD_SQL)
def q_kfold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_folds(diet_dedup(spark, sf_dir), 5).select("Person_ID", "Health_Status", "fold")


RECOMBINE_SQL = with_dd("SELECT Health_Status, count(*) AS rows, count(DISTINCT Person_ID) AS distinct_ids "
                        "FROM sp GROUP BY Health_Status", G.split_ctes("dd"))


@query("recombine", RECOMBINE_SQL)
def q_recombine(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split.train_test(diet_dedup(spark, sf_dir))
    both = split.recombine(train, test)
    return both.groupBy("Health_Status").agg(F.count(F.lit(1)).alias("rows"),
                                             F.count_distinct("Person_ID").alias("distinct_ids"))


# ---------------------------------------------------------------- C2-C7
def _prep_sql(body: str, extra: str = "") -> str:
    return "WITH " + G.prepared_ctes() + ("," + extra if extra else "") + "\n" + body


CLEANER_STATE_SQL = _prep_sql(f"SELECT col_name AS \"column\", kind, {sql_r6('num_value')} AS num_value, str_value, "
                              f"{sql_r6('lower')} AS lower, {sql_r6('upper')} AS upper FROM cst")


@query("cleaner_state", CLEANER_STATE_SQL)
def q_cleaner_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _prepared(spark, sf_dir)
    st = p.cleaner.state_df(spark)
    return st.select("column", "kind", r6("num_value").alias("num_value"), "str_value",
                     r6("lower").alias("lower"), r6("upper").alias("upper"))


CLEAN_APPLY_SQL = _prep_sql("SELECT Person_ID, split, " + ", ".join(
    f"{sql_r6(c)} AS {c}" for c in S.RAW_NUMERIC_COLUMNS) + ", Gender, Activity_Level, Diet_Type, Health_Status FROM cl")


@query("clean_apply", CLEAN_APPLY_SQL)
def q_clean_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _prepared(spark, sf_dir)
    return p.engineered.select("Person_ID", "split", *[r6(c).alias(c) for c in S.RAW_NUMERIC_COLUMNS],
                               "Gender", "Activity_Level", "Diet_Type", "Health_Status")


FIT_TRANSFORM_SQL = _prep_sql("SELECT Person_ID, " + ", ".join(
    f"{sql_r6(c)} AS {c}" for c in S.RAW_NUMERIC_COLUMNS) + ", Gender, Activity_Level, Diet_Type FROM cl WHERE split = 'train'")


@query("clean_fit_transform", FIT_TRANSFORM_SQL)
def q_clean_fit_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit and apply on the training rows in one call."""
    from nutrilake.plans.preprocess import split_raw
    sp = split_raw(diet(spark, sf_dir), order_by=["copy_no"])
    train = sp.where(F.col("split") == "train").drop("split")
    _model, out = clean.Cleaner(S.RAW_NUMERIC_COLUMNS, unique_columns=[S.ID_COLUMN]).fit_transform(train)
    return out.select("Person_ID", *[r6(c).alias(c) for c in S.RAW_NUMERIC_COLUMNS], "Gender", "Activity_Level", "Diet_Type")


def _report_sql() -> str:
    parts = []
    for c in S.RAW_COLUMNS:
        if c in S.RAW_NUMERIC_COLUMNS:
            v = f"(SELECT num_value FROM cst WHERE col_name = '{c}')"
            lo = f"(SELECT lower FROM cst WHERE col_name = '{c}')"
            hi = f"(SELECT upper FROM cst WHERE col_name = '{c}')"
            filled = f"coalesce(CAST({c} AS DOUBLE), {v})"
            clipped = f"count(*) FILTER (WHERE {filled} < {lo} OR {filled} > {hi})"
        else:
            clipped = "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS imputed, "
                     f"{clipped} AS clipped FROM sp WHERE split = 'test'")
    return "\nUNION ALL ".join(parts)


CLEAN_REPORT_SQL = _prep_sql(_report_sql())


@query("clean_report", CLEAN_REPORT_SQL)
def q_clean_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells the train-fitted cleaner fills / clips on the test rows."""
    from nutrilake.plans.preprocess import split_raw
    sp = split_raw(diet(spark, sf_dir), order_by=["copy_no"])
    cols = [c for c in sp.columns if c != "split"]
    model = clean.Cleaner(S.RAW_NUMERIC_COLUMNS).fit(sp.where(F.col("split") == "train").select(*cols))
    return model.report(sp.where(F.col("split") == "test").select(*cols))


# ---------------------------------------------------------------- T
def _enc_sql(body: str) -> str:
    return _prep_sql(body, G.encoder_ctes())


SCALED_SQL = _enc_sql("SELECT Person_ID, split, " + ", ".join(
    f"{sql_r6(G.scaled_expr(c))} AS numeric__{c}" for c in S.NUMERIC_FEATURES) + " FROM en")


@query("scaled", SCALED_SQL)
def q_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _prepared(spark, sf_dir)
    return p.frame.select("Person_ID", "split", *[r6(f"numeric__{c}").alias(f"numeric__{c}")
                                                  for c in S.NUMERIC_FEATURES])


ONE_HOT_SQL = _prep_sql("""SELECT feature, category, count(*) AS rows FROM (
  SELECT 'Gender' AS feature, Gender AS category FROM en
  UNION ALL SELECT 'Activity_Level', Activity_Level FROM en
  UNION ALL SELECT 'Diet_Type', Diet_Type FROM en
  UNION ALL SELECT 'Age_Group', Age_Group FROM en)
WHERE category IN (SELECT DISTINCT Gender FROM en WHERE split = 'train' UNION ALL
                   SELECT DISTINCT Activity_Level FROM en WHERE split = 'train' UNION ALL
                   SELECT DISTINCT Diet_Type FROM en WHERE split = 'train' UNION ALL
                   SELECT DISTINCT Age_Group FROM en WHERE split = 'train')
GROUP BY feature, category""")


@query("one_hot", ONE_HOT_SQL)
def q_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column sums of the one-hot block (= rows per seen category)."""
    p = _prepared(spark, sf_dir)
    cols = [n for n in p.feature_names if n.startswith("categorical__")]
    sums = p.frame.agg(*[F.sum(F.col(c)).alias(c) for c in cols])
    out = sums.unpivot([], cols, "name", "rows")
    enc = p.encoder
    pairs = [(f"categorical__{c}_{v}", c, v) for c in enc.categorical for v in enc.categories[c]]
    m_feat = F.create_map(*[x for n, c, _ in pairs for x in (F.lit(n), F.lit(c))])
    m_cat = F.create_map(*[x for n, _, v in pairs for x in (F.lit(n), F.lit(v))])
    return out.select(m_feat[F.col("name")].alias("feature"), m_cat[F.col("name")].alias("category"),
                      F.col("rows").cast("long").alias("rows")).where(F.col("rows") > 0)


FEATURE_MATRIX_SQL = _enc_sql("SELECT Person_ID, Health_Status, split, " + ", ".join(
    f"{sql_r6(G.scaled_expr(c))} AS numeric__{c}" for c in S.NUMERIC_FEATURES) +
    ", Gender, Activity_Level, Diet_Type, Age_Group FROM en")


def matrix_columns(frame: DataFrame, enc: encode.EncoderModel, extra: list[str] | None = None) -> DataFrame:
    """Numeric block and the hot category of each one-hot group."""
    hot = {}
    for c in enc.categorical:
        expr = None
        for v in enc.categories[c]:
            cond = F.col(f"categorical__{c}_{v}") == 1.0
            expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
        hot[c] = expr if expr is not None else F.lit(None).cast("string")
    return frame.select("Person_ID", "Health_Status", "split", *(extra or []),
                        *[r6(f"numeric__{c}").alias(f"numeric__{c}") for c in S.NUMERIC_FEATURES],
                        *[hot[c].alias(c) for c in enc.categorical])


@query("feature_matrix", FEATURE_MATRIX_SQL)
def q_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric block + the category that is hot in each one-hot group."""
    p = _prepared(spark, sf_dir)
    return matrix_columns(p.frame, p.encoder)


LABEL_CODES_SQL = with_dd("""SELECT Health_Status AS label, CAST(row_number() OVER (ORDER BY Health_Status) - 1 AS INTEGER) AS code,
  count(*) AS rows FROM sp WHERE split = 'train' GROUP BY Health_Status""", G.split_ctes("dd"))


@query("label_codes", LABEL_CODES_SQL)
def q_label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = split.train_test(diet_dedup(spark, sf_dir))
    codes = encode.LabelCodes.fit(train)
    return (train.select(codes.encode("Health_Status").alias("code"))
            .groupBy("code").agg(F.count(F.lit(1)).alias("rows"))
            .select(codes.decode("code").alias("label"), "code", "rows"))


# ---------------------------------------------------------------- A3
LABEL_DET_SQL = with_dd(f"""SELECT band, CAST(sum(n) AS BIGINT) AS rows, count(label) AS distinct_labels,
  arg_max(label, n) AS majority_label, CAST(sum(n) - max(n) AS BIGINT) AS violations
FROM (SELECT {G.bmi_band_sql("BMI")} AS band, Health_Status AS label, count(*) AS n FROM dd GROUP BY 1, 2)
GROUP BY band""")


@query("label_determinism", LABEL_DET_SQL)
def q_label_determinism(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.label_determinism(diet_dedup(spark, sf_dir))


DISTRIBUTION_SQL = "SELECT event_type, count(*) AS count FROM events GROUP BY event_type"


@query("distribution_events", DISTRIBUTION_SQL)
def q_distribution_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.distribution(read_table(spark, sf_dir, "events"), "event_type")


# ---------------------------------------------------------------- C9 / T5 / L4 round trips
@query("cleaner_roundtrip", CLEAN_APPLY_SQL)
def q_cleaner_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The train-fitted cleaner saved as a state table, read back and
    applied -- must equal ``clean_apply``."""
    from nutrilake.plans.preprocess import split_raw
    from nutrilake.plans.queries_model import scratch_dir
    sp = split_raw(diet(spark, sf_dir), order_by=["copy_no"])
    cols = [c for c in sp.columns if c != "split"]
    fitted = clean.Cleaner(S.RAW_NUMERIC_COLUMNS, unique_columns=[S.ID_COLUMN]) \
        .fit(sp.where(F.col("split") == "train").select(*cols))
    path = scratch_dir(spark, "cleaner_state")
    fitted.save(spark, path)
    back = clean.CleanerModel.load(spark, path)
    out = back.transform(sp)
    return out.select("Person_ID", "split", *[r6(c).alias(c) for c in S.RAW_NUMERIC_COLUMNS],
                      "Gender", "Activity_Level", "Diet_Type", "Health_Status")


_HOT_NAMES = " UNION ALL ".join(
    f"SELECT {i} AS f, {c} AS v, 'categorical__{c}_' || {c} AS name FROM en WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c}"
    for i, c in enumerate(S.CATEGORICAL_FEATURES))
ENCODER_ROUNDTRIP_SQL = FEATURE_MATRIX_SQL.replace("Person_ID, Health_Status, split,", f"""Person_ID, Health_Status, split,
  '{",".join("numeric__" + c for c in S.NUMERIC_FEATURES)},' || (SELECT string_agg(name, ',' ORDER BY f, v) FROM ({_HOT_NAMES})) AS feature_order,""", 1)


@query("encoder_roundtrip", ENCODER_ROUNDTRIP_SQL)
def q_encoder_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the train-fitted encoder saved, read back and applied: the columns
    in the order of the fit, the numeric block, and what is hot in each group."""
    from nutrilake.plans.queries_model import scratch_dir
    p = _prepared(spark, sf_dir)
    path = scratch_dir(spark, "encoder_state")
    p.encoder.save(spark, path)
    back = encode.EncoderModel.load(spark, path)
    out = back.transform(p.engineered, keep=["Person_ID", "Health_Status", "split"])
    order = ",".join(c for c in out.columns if c not in ("Person_ID", "Health_Status", "split"))
    return matrix_columns(out.withColumn("feature_order", F.lit(order)), back, ["feature_order"])


FEATURES_LABEL_SQL = f"SELECT * FROM ({FEATURE_MATRIX_SQL}) WHERE split = 'test'"


@query("features_label", FEATURES_LABEL_SQL)
def q_features_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: id, every feature and the label of the test rows, side by side."""
    p = _prepared(spark, sf_dir)
    out = split.features_and_label(p.test(), p.feature_names, S.TARGET_COLUMN, S.ID_COLUMN)
    return matrix_columns(out.withColumn("split", F.lit("test")), p.encoder)


EVENTS_PROFILE_COLS = ["event_id", "user_id", "event_type", "ts", "value", "props"]
_EV_TYPES = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "ts": "timestamp_ntz", "props": "string"}
PROFILE_EVENTS_SQL = profile_sql("events", EVENTS_PROFILE_COLS, _EV_TYPES, ["event_id", "user_id", "value"])


@query("profile_events", PROFILE_EVENTS_SQL)
def q_profile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select(*EVENTS_PROFILE_COLS)
    return _profile_out(profile.dataset_profile(ev))
