"""Registered queries of operators that find cuts or numbers in an order."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake.operators import bands, split
from nutrilake.operators.encode_sparse import SparseEncoder
from nutrilake.plans.common import diet, diet_dedup, r6, sql_r6, with_dd
from nutrilake.plans.queries_model import scratch_dir
from nutrilake.plans.queries_prep import _ODD_ID, _RECORD_NUMBERS, CSV_SCAN_SQL
from nutrilake.plans.registry import query
from nutrilake.sources import loader
from nutrilake.sources.diet_profile import diet_ctes
from nutrilake.sources.tables import read_table

# ---------------------------------------------------------------- L2
KFOLD_BLOCKS_SQL = with_dd("""SELECT c.Person_ID, c.Health_Status, CAST(count(e.f) AS INTEGER) AS fold
FROM c LEFT JOIN e ON e.Health_Status = c.Health_Status AND e.upto <= c.r GROUP BY 1, 2""", """
c AS (SELECT Person_ID, Health_Status,
  row_number() OVER (PARTITION BY Health_Status ORDER BY md5('42:' || Person_ID)) - 1 AS r,
  row_number() OVER (ORDER BY Health_Status, Person_ID) - 1 AS p FROM dd),
e AS (SELECT Health_Status, f, sum(n) OVER (PARTITION BY Health_Status ORDER BY f) AS upto
  FROM (SELECT Health_Status, p % 5 AS f, count(*) AS n FROM c GROUP BY 1, 2))""")


@query("kfold_blocks", KFOLD_BLOCKS_SQL)
def q_kfold_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 by cut keys: every class as five blocks of its hash order."""
    return split.stratified_fold_blocks(diet_dedup(spark, sf_dir), 5).select("Person_ID", "Health_Status", "fold")


# Rows without ids and copies: only how many rows of each kind a fold has is told by the order.
KFOLD_REPEATED_SQL = "WITH " + diet_ctes("orders") + """,
c AS (SELECT Health_Status, row_number() OVER (ORDER BY Health_Status) - 1 AS p FROM diet)
SELECT Health_Status, CAST(p % 5 AS INTEGER) AS fold, count(*) AS rows FROM c GROUP BY 1, 2"""


@query("kfold_repeated_rows", KFOLD_REPEATED_SQL)
def q_kfold_repeated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 by cut keys over (Gender, status) alone: nearly all rows repeat."""
    rows = diet(spark, sf_dir).select("Gender", "Health_Status")
    folds = split.stratified_fold_blocks(rows, 5, key="Gender")
    return folds.groupBy("Health_Status", "fold").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- S1
@query("csv_scan_splits", CSV_SCAN_SQL)
def q_csv_scan_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with quoted line ends, every file read by several tasks (splits of 1 MB)."""
    path = scratch_dir(spark, "csv")
    (diet(spark, sf_dir).withColumn("Person_ID", F.expr(_ODD_ID))
     .write.option("header", True).option("escape", '"').csv(path))
    back = loader.load_table(spark, path, fmt="csv", split_bytes=1 << 20)
    return back.select("Person_ID", "Age", "Gender", "Activity_Level", "Diet_Type", "Health_Status",
                       F.col("copy_no").cast("int").alias("copy_no"), *[r6(c).alias(c) for c in _RECORD_NUMBERS])


# ---------------------------------------------------------------- T1, T2
_SPARSE = ["l_orderkey", "l_partkey", "l_returnflag"]
_SPARSE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
ONE_HOT_SPARSE_SQL = f"""WITH fit AS (SELECT * FROM lineitem WHERE l_suppkey % 4 <> 0),
cats AS ({" UNION ALL ".join(f"SELECT {i} AS f, CAST({c} AS VARCHAR) AS v FROM fit WHERE {c} IS NOT NULL GROUP BY ALL"
                             for i, c in enumerate(_SPARSE))}),
idx AS (SELECT f, v, row_number() OVER (ORDER BY f, v) AS i FROM cats),
sc AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM fit)
SELECT {", ".join(f"l.{c}" for c in _SPARSE_KEYS)}, concat_ws(',', 0, a.i, b.i, c.i) AS hot,
  {sql_r6("(l.l_quantity - sc.m) / sc.s")} AS quantity,
  CAST((SELECT count(*) + 1 FROM cats) AS BIGINT) AS width
FROM lineitem l CROSS JOIN sc
LEFT JOIN idx a ON a.f = 0 AND a.v = CAST(l.l_orderkey AS VARCHAR)
LEFT JOIN idx b ON b.f = 1 AND b.v = CAST(l.l_partkey AS VARCHAR)
LEFT JOIN idx c ON c.f = 2 AND c.v = l.l_returnflag"""


@query("one_hot_sparse", ONE_HOT_SPARSE_SQL)
def q_one_hot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1, T2 with as many categories as orders and parts: fitted on three quarters
    of the suppliers, applied to every line."""
    lines = read_table(spark, sf_dir, "lineitem")
    model = SparseEncoder(["l_quantity"], _SPARSE).fit(lines.where("l_suppkey % 4 <> 0"))
    out = model.transform(lines, _SPARSE_KEYS)
    return out.select(*_SPARSE_KEYS, F.array_join(F.col("indices").cast("array<string>"), ",").alias("hot"),
                      r6(F.col("values")[0]).alias("quantity"), F.lit(model.size).cast("long").alias("width"))


# ---------------------------------------------------------------- A3
def _bands_sql(name: str, table: str, column: str, label: str) -> str:
    return f"""SELECT '{name}' AS source, low, high, label, rows, violations FROM (
  SELECT min(v) AS low, max(v) AS high, label, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - most) AS BIGINT) AS violations
  FROM (SELECT *, sum(CASE WHEN label IS DISTINCT FROM before OR first = 1 THEN 1 ELSE 0 END) OVER (ORDER BY v) AS band
    FROM (SELECT *, lag(label) OVER (ORDER BY v) AS before, row_number() OVER (ORDER BY v) AS first
      FROM (SELECT v, label, most, n FROM (
        SELECT v, label, k AS most, sum(k) OVER (PARTITION BY v) AS n,
          row_number() OVER (PARTITION BY v ORDER BY k DESC, label NULLS FIRST) AS best
        FROM (SELECT CAST({column} AS DOUBLE) AS v, {label} AS label, count(*) AS k FROM {table}
              WHERE {column} IS NOT NULL GROUP BY 1, 2)) WHERE best = 1)))
  GROUP BY band, label)"""


LABEL_BANDS_SQL = with_dd(_bands_sql("BMI", "dd", "BMI", "Health_Status") + " UNION ALL "
                          + _bands_sql("o_totalprice", "orders", "o_totalprice", "o_orderstatus"))


@query("label_bands", LABEL_BANDS_SQL)
def q_label_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 as a search: the bands of a column in which one label holds."""
    found = bands.label_bands(diet_dedup(spark, sf_dir), "BMI", "Health_Status")
    prices = bands.label_bands(read_table(spark, sf_dir, "orders"), "o_totalprice", "o_orderstatus")
    cols = ["source", "low", "high", "label", "rows", "violations"]
    return (found.withColumn("source", F.lit("BMI")).select(*cols)
            .unionByName(prices.withColumn("source", F.lit("o_totalprice")).select(*cols)))
