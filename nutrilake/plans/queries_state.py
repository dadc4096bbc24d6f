"""Registered queries over saved state: a mergeable profile and versioned
artifacts, with DuckDB oracles.

Sketches are estimates, so their columns state whether the exact values of the
whole table lie within four standard errors (cardinality) or twice the 99 % rank error
(quartiles); all other columns are exact."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake.functions.ordered import bounded_broadcast, value_counts_long
from nutrilake.operators.profile_state import ProfileState, cardinality_error, rank_error
from nutrilake.plans.common import r6, sql_r6
from nutrilake.plans.registry import query
from nutrilake.session import scratch_folder
from nutrilake.sources.tables import read_table
from nutrilake.sources.versions import VersionedStore
from nutrilake.streaming.baseline import start_baseline_stream

LINEITEM = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
            "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
            "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
EVENTS = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "ts": "timestamp_ntz",
          "value": "double", "props": "string"}
TEXTS = ("string", "timestamp_ntz")


def state_sql(table: str, columns: dict[str, str]) -> str:
    parts = []
    for c, t in columns.items():
        number, text = f"CAST({c} AS DOUBLE)", "CAST(NULL AS VARCHAR)"
        skew, within = f"skewness({number})", "TRUE"
        if t in TEXTS:
            number, text, skew, within = "CAST(NULL AS DOUBLE)", f"CAST({c} AS VARCHAR)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS BOOLEAN)"
        parts.append(f"""SELECT '{c}' AS Column, '{t}' AS Type, count(*) AS Rows, count(*) - count({c}) AS Missing,
  count(DISTINCT {c}) <= 1 AS Constant, {sql_r6(f'avg({number})')} AS Mean, {sql_r6(skew)} AS Skewness,
  min({number}) AS Min, max({number}) AS Max, min({text}) AS Min_Text, max({text}) AS Max_Text,
  TRUE AS Cardinality_Within, {within} AS Quartiles_Within FROM {table} HAVING count(*) > 0""")
    return "\nUNION ALL ".join(parts)


def _held_to_the_table(state: ProfileState, table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The profile of the state, its estimates held to the exact counts of ``table``."""
    numeric = [c for c, t in columns.items() if t not in TEXTS]
    profile = state.profile()
    counts = value_counts_long(table, numeric, [c for c in columns if c not in numeric], keep_nulls=False)
    # one row per column
    met = counts.join(bounded_broadcast(profile.select(F.col("Column").alias("column"), "Quartiles")), "column")
    quartile = [F.col("Quartiles")[i] for i in range(3)]
    n, eps = F.sum("n"), rank_error(state.k)
    inside = F.lit(True)
    for q, p in zip(quartile, (0.25, 0.5, 0.75)):
        inside &= F.sum(F.when(F.col("dval") < q, F.col("n")).otherwise(0)) / n - 2 * eps <= p
        inside &= F.sum(F.when(F.col("dval") <= q, F.col("n")).otherwise(0)) / n + 2 * eps >= p
    exact = met.groupBy(F.col("column").alias("Column")).agg(
        F.count(F.lit(1)).alias("_distinct"), F.when(F.max("dval").isNotNull(), inside).alias("Quartiles_Within"))
    error = F.abs(F.col("Cardinality") - F.col("_distinct"))
    return profile.join(bounded_broadcast(exact), "Column", "left").select(
        "Column", "Type", "Rows", "Missing", "Constant", r6("Mean").alias("Mean"), r6("Skewness").alias("Skewness"),
        "Min", "Max", "Min_Text", "Max_Text",
        (error <= 4 * cardinality_error(state.lg_k) * F.col("_distinct")).alias("Cardinality_Within"),
        "Quartiles_Within")


@query("profile_state", state_sql("lineitem", LINEITEM))
def q_profile_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P6 from merged state: lineitem in three batches, one written twice,
    read back and merged."""
    li = read_table(spark, sf_dir, "lineitem").select(*LINEITEM)
    path = scratch_folder(spark, "profile-state")
    state = ProfileState.create(li, path)
    for batch_id in (0, 1, 2, 1):
        state.add(li.where(F.pmod("l_orderkey", F.lit(3)) == batch_id), batch_id)
    return _held_to_the_table(ProfileState.load(spark, path), li, LINEITEM)


@query("profile_state_stream", state_sql("events", EVENTS))
def q_profile_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same state fed by a stream of event files."""
    ev = read_table(spark, sf_dir, "events").select(*EVENTS)
    path = scratch_folder(spark, "profile-stream")
    ev.repartition(4).write.parquet(path + "/inbox")
    state = ProfileState.create(ev, path + "/state")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(path + "/inbox")
    start_baseline_stream(stream, state, path + "/checkpoint").awaitTermination()
    return _held_to_the_table(state, ev, EVENTS)


VERSIONS_SQL = f"""SELECT v.version, v.note, v.version = 2 AS is_current, o_orderstatus, count(*) AS n_orders,
  {sql_r6('sum(o_totalprice)')} AS total
FROM orders JOIN (VALUES (CAST(1 AS BIGINT), 'closed', 'F'), (2, 'all', NULL)) AS v(version, note, only_status)
  ON v.only_status IS NULL OR o_orderstatus = v.only_status
GROUP BY v.version, v.note, o_orderstatus"""


@query("artifact_versions", VERSIONS_SQL)
def q_artifact_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals published twice; a third write breaks half-way and
    leaves the second in force.  Both committed versions are read back."""
    orders = read_table(spark, sf_dir, "orders")
    path = scratch_folder(spark, "versions")
    store = VersionedStore(spark, path)

    def totals(rows: DataFrame, folder: str) -> None:
        rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total")) \
            .coalesce(1).write.parquet(folder + "/totals")

    def broken(folder: str) -> None:
        totals(orders.where(F.col("o_orderstatus") == "O"), folder)
        raise InterruptedError("lost half-way")

    store.publish(lambda folder: totals(orders.where(F.col("o_orderstatus") == "F"), folder), "closed")
    store.publish(lambda folder: totals(orders, folder), "all")
    try:
        store.publish(broken, "never")
    except InterruptedError:
        pass
    parts = [spark.read.parquet(f"{path}/versions/{v['folder']}/totals").select(
        F.lit(v["version"]).cast("long").alias("version"), F.lit(v["note"]).alias("note"),
        F.lit(store.folder().endswith(v["folder"])).alias("is_current"), "o_orderstatus", "n_orders", r6("total").alias("total"))
        for v in store.history().collect()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
