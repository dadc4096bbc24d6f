"""Registered drift queries (F) with DuckDB oracles.

The p-values are the asymptotic ones, which SQL can state; the exact ones of
small samples are tested against a count of all paths."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.operators import drift
from nutrilake.plans import sqlgen as G
from nutrilake.plans.common import diet_dedup, r6, sql_r6, with_dd
from nutrilake.plans.queries_prep import _prepared
from nutrilake.plans.registry import query
from nutrilake.session import remove_scratch, scratch_folder
from nutrilake.sources.tables import read_table
from nutrilake.streaming.baseline import start_baseline_stream

LI_CUT = "1998-05-24 00:00:00"
EV_CUT = "2024-01-16 00:00:00"
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_TXT = ["l_returnflag", "l_linestatus"]
EV_NUM = ["value", "user_id"]
EV_TXT = ["event_type"]


def drift_sql(ref: str, cur: str, numeric: list[str], strings: list[str], buckets: int = 10,
              cat_max: int = 10, moderate: float = 0.1, major: float = 0.25) -> str:
    """CTE text ending in ``rep`` (feature, psi, ks_statistic, ks_pvalue,
    drift_severity) for the tables ``ref`` / ``cur``."""
    def fam(cols, cast, tag):
        sel = []
        for side, src in ((0, ref), (1, cur)):
            for c in cols:
                sel.append(f"SELECT '{c}' AS feature, CAST({c} AS {cast}) AS value, {side} AS side "
                           f"FROM {src} WHERE {c} IS NOT NULL")
        qs = ", ".join(G.quantile_sql("arr", i / buckets) for i in range(buckets + 1))
        edges = (f"{tag}_srt AS (SELECT feature, list_sort(list(value)) AS arr FROM {tag}_l "
                 f"WHERE side = 0 GROUP BY feature),"
                 f"{tag}_edg AS (SELECT feature, list_sort(list_distinct([{qs}])) AS e FROM {tag}_srt),"
                 ) if cast == "DOUBLE" else ""
        binexpr = ("CAST(len(list_filter(e[2:len(e)-1], lambda x: x < c.value)) AS VARCHAR)"
                   if cast == "DOUBLE" else "NULL")
        edge_join = f"LEFT JOIN {tag}_edg USING (feature)" if cast == "DOUBLE" else ""
        return f"""
{tag}_l AS ({" UNION ALL ".join(sel)}),
{tag}_cnt AS (SELECT feature, value, count(*) FILTER (WHERE side = 0) AS rn,
                     count(*) FILTER (WHERE side = 1) AS cn FROM {tag}_l GROUP BY feature, value),
{tag}_tot AS (SELECT feature, sum(rn) AS n_r, sum(cn) AS n_c, count(*) FILTER (WHERE rn > 0) AS ref_unique
              FROM {tag}_cnt GROUP BY feature),
{edges}
{tag}_cells AS (SELECT c.feature, CASE WHEN t.ref_unique <= {cat_max} OR {cast == "VARCHAR"} THEN CAST(c.value AS VARCHAR)
                                     ELSE {binexpr} END AS cell, c.rn, c.cn, t.n_r, t.n_c
               FROM {tag}_cnt c JOIN {tag}_tot t USING (feature) {edge_join}),
{tag}_psi AS (SELECT feature, sum((greatest(cp, 1e-6) - greatest(rp, 1e-6)) * ln(greatest(cp, 1e-6) / greatest(rp, 1e-6))) AS psi
              FROM (SELECT feature, cell, CAST(sum(rn) AS DOUBLE) / any_value(n_r) AS rp,
                           CAST(sum(cn) AS DOUBLE) / any_value(n_c) AS cp
                    FROM {tag}_cells GROUP BY feature, cell) GROUP BY feature),
{tag}_ks AS (SELECT feature, any_value(n_r) AS n_r, any_value(n_c) AS n_c, max(abs(cr / n_r - cc / n_c)) AS ks
             FROM (SELECT c.feature, n_r, n_c,
                          sum(rn) OVER (PARTITION BY c.feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr,
                          sum(cn) OVER (PARTITION BY c.feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cc
                   FROM {tag}_cnt c JOIN {tag}_tot USING (feature)) GROUP BY feature),
{tag}_res AS (SELECT p.feature, p.psi, k.ks, k.n_r, k.n_c FROM {tag}_psi p JOIN {tag}_ks k USING (feature))"""
    parts, res = [], []
    if numeric:
        parts.append(fam(numeric, "DOUBLE", "nf"))
        res.append("SELECT * FROM nf_res")
    if strings:
        parts.append(fam(strings, "VARCHAR", "sf"))
        res.append("SELECT * FROM sf_res")
    lam = "(ks * sqrt(CAST(n_r AS DOUBLE) * n_c / (n_r + n_c)))"
    pval = (f"CASE WHEN {lam} < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, "
            f"list_reduce(list_transform(range(1, 101), "
            f"lambda j: 2.0 * pow(-1.0, j - 1) * exp(-2.0 * j * j * {lam} * {lam})), lambda a, b: a + b))) END")
    return ",".join(parts) + f""",
allres AS ({" UNION ALL ".join(res)}),
rep AS (SELECT feature, psi, ks AS ks_statistic, {pval} AS ks_pvalue,
               CASE WHEN psi >= {major!r} THEN 'major' WHEN psi >= {moderate!r} THEN 'moderate' ELSE 'none' END AS drift_severity
        FROM allres)"""


REPORT_SELECT = (f"SELECT feature, {sql_r6('psi')} AS psi, {sql_r6('ks_statistic')} AS ks_statistic, "
                 f"{sql_r6('ks_pvalue')} AS ks_pvalue, drift_severity FROM rep")


def _report_out(df: DataFrame) -> DataFrame:
    return df.select("feature", r6("psi").alias("psi"), r6("ks_statistic").alias("ks_statistic"),
                     r6("ks_pvalue").alias("ks_pvalue"), "drift_severity")


def _li_sides(spark: SparkSession, sf_dir: str):
    li = read_table(spark, sf_dir, "lineitem")
    cut = F.expr(f"TIMESTAMP_NTZ '{LI_CUT}'")
    return (li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut))


_LI_CTES = (f"ref AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{LI_CUT}'), "
            f"cur AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{LI_CUT}')")

DRIFT_PSI_NUMERIC_SQL = "WITH " + _LI_CTES + "," + drift_sql("ref", "cur", LI_NUM, []) + \
    f"\nSELECT feature, {sql_r6('psi')} AS psi, drift_severity FROM rep"


@query("drift_psi_numeric", DRIFT_PSI_NUMERIC_SQL)
def q_drift_psi_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binned PSI (and the categorical path for low-cardinality numbers) on
    lineitem shipped before vs after a date."""
    ref, cur = _li_sides(spark, sf_dir)
    rep = drift.drift_report(ref.select(*LI_NUM), cur.select(*LI_NUM))
    return rep.select("feature", r6("psi").alias("psi"), "drift_severity")


DRIFT_PSI_CAT_SQL = "WITH " + _LI_CTES + "," + drift_sql("ref", "cur", [], LI_TXT) + \
    f"\nSELECT feature, {sql_r6('psi')} AS psi, drift_severity FROM rep"


@query("drift_psi_categorical", DRIFT_PSI_CAT_SQL)
def q_drift_psi_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, cur = _li_sides(spark, sf_dir)
    rep = drift.drift_report(ref.select(*LI_TXT), cur.select(*LI_TXT))
    return rep.select("feature", r6("psi").alias("psi"), "drift_severity")


_EV_CTES = (f"ref AS (SELECT * FROM events WHERE ts < TIMESTAMP '{EV_CUT}'), "
            f"cur AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{EV_CUT}')")
DRIFT_KS_SQL = "WITH " + _EV_CTES + "," + drift_sql("ref", "cur", EV_NUM, EV_TXT) + \
    f"\nSELECT feature, {sql_r6('ks_statistic')} AS ks_statistic, {sql_r6('ks_pvalue')} AS ks_pvalue FROM rep"


@query("drift_ks", DRIFT_KS_SQL)
def q_drift_ks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-sample KS on events, early vs late half of the month."""
    ev = read_table(spark, sf_dir, "events")
    cut = F.expr(f"TIMESTAMP_NTZ '{EV_CUT}'")
    cols = EV_NUM + EV_TXT
    rep = drift.drift_report(ev.where(F.col("ts") < cut).select(*cols),
                             ev.where(F.col("ts") >= cut).select(*cols), pvalue="asymptotic")
    return rep.select("feature", r6("ks_statistic").alias("ks_statistic"),
                      r6("ks_pvalue").alias("ks_pvalue"))


EV_ALL = EV_NUM + ["event_id"], EV_TXT + ["props"]
DRIFT_EVENTS_SQL = "WITH " + _EV_CTES + "," + drift_sql("ref", "cur", *EV_ALL) + "\n" + REPORT_SELECT


@query("drift_events", DRIFT_EVENTS_SQL)
def q_drift_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of events but the time that divides it."""
    ev = read_table(spark, sf_dir, "events")
    cut = F.expr(f"TIMESTAMP_NTZ '{EV_CUT}'")
    cols = EV_ALL[0] + EV_ALL[1]
    return _report_out(drift.drift_report(ev.where(F.col("ts") < cut).select(*cols),
                                          ev.where(F.col("ts") >= cut).select(*cols), pvalue="asymptotic"))


@query("drift_baseline", DRIFT_EVENTS_SQL)
def q_drift_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the early events saved as state in two batches, one of them written
    twice, read back and compared with the late ones."""
    ev = read_table(spark, sf_dir, "events")
    cut = F.expr(f"TIMESTAMP_NTZ '{EV_CUT}'")
    cols = EV_ALL[0] + EV_ALL[1]
    early = ev.where(F.col("ts") < cut)
    path = scratch_folder(spark, "drift-baseline")
    base = drift.DriftBaseline.create(early.select(*cols), path)
    for batch_id in (0, 1, 1):
        base.add(early.where(F.col("user_id") % 2 == batch_id).select(*cols), batch_id)
    base.freeze()
    report = _report_out(drift.DriftBaseline.load(spark, path).compare(ev.where(F.col("ts") >= cut).select(*cols), pvalue="asymptotic"))
    remove_scratch(spark, path)
    return report


@query("drift_baseline_stream", DRIFT_EVENTS_SQL)
def q_drift_baseline_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the same state fed by a stream of event files."""
    ev = read_table(spark, sf_dir, "events")
    cut = F.expr(f"TIMESTAMP_NTZ '{EV_CUT}'")
    cols = EV_ALL[0] + EV_ALL[1]
    path = scratch_folder(spark, "drift-stream")
    early = ev.where(F.col("ts") < cut).select(*cols)
    early.repartition(4).write.parquet(path + "/inbox")
    base = drift.DriftBaseline.create(early, path + "/state")
    stream = spark.readStream.schema(early.schema).option("maxFilesPerTrigger", 2).parquet(path + "/inbox")
    start_baseline_stream(stream, base, path + "/checkpoint").awaitTermination()
    base.freeze()
    report = _report_out(base.compare(ev.where(F.col("ts") >= cut).select(*cols), pvalue="asymptotic"))
    remove_scratch(spark, path)
    return report


_TT_FEATURES = S.NUMERIC_FEATURES + S.CATEGORICAL_FEATURES


def _tt_sql(select: str) -> str:
    return ("WITH " + G.prepared_ctes() + ",\n"
            + "ref AS (SELECT * FROM en WHERE split = 'train'), cur AS (SELECT * FROM en WHERE split = 'test'),"
            + drift_sql("ref", "cur", S.NUMERIC_FEATURES, S.CATEGORICAL_FEATURES) + "\n" + select)


def _tt_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _prepared(spark, sf_dir)
    eng = p.engineered
    return drift.drift_report(eng.where(F.col("split") == "train").select(*_TT_FEATURES),
                              eng.where(F.col("split") == "test").select(*_TT_FEATURES), pvalue="asymptotic")


@query("drift_report", _tt_sql(REPORT_SELECT))
def q_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train vs test of the prepared features (numeric and categorical)."""
    return _report_out(_tt_report(spark, sf_dir))


DRIFT_SUMMARY_SQL = _tt_sql("""SELECT count(*) AS n_features_checked,
  coalesce(array_to_string(list(feature ORDER BY psi DESC, feature) FILTER (WHERE drift_severity <> 'none'), ','), '') AS drifted_features,
  coalesce(bool_or(drift_severity = 'major'), false) AS has_major_drift FROM rep""")


@query("drift_summary", DRIFT_SUMMARY_SQL)
def q_drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summ = drift.drift_summary(_tt_report(spark, sf_dir))
    return summ.select("n_features_checked", F.array_join("drifted_features", ",").alias("drifted_features"),
                       "has_major_drift")


@query("drift_encoded")
def q_drift_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source's own drift check: train vs test of the encoded feature
    matrix (scaled numbers and one-hot columns; the 0/1 columns take the
    categorical path).  Rows-only: scaled values are not bit-identical
    across engines, and quantile-bin ties would make an SQL oracle flaky."""
    p = _prepared(spark, sf_dir)
    feats = p.feature_names
    rep = drift.drift_report(p.train().select(*feats), p.test().select(*feats), pvalue="asymptotic")
    return _report_out(rep)


DRIFT_NULL_SQL = with_dd("""SELECT f AS feature, CAST(4 AS BIGINT) AS n_features, TRUE AS reported,
  CASE WHEN f IN ('nothing', 'no_text') THEN CAST(0 AS DOUBLE) END AS psi
FROM (SELECT unnest(['Age', 'BMI', 'nothing', 'no_text']) AS f) WHERE (SELECT count(*) FROM dd) > 0""")


@query("drift_all_null", DRIFT_NULL_SQL)
def q_drift_all_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a column without any value on either side keeps its row."""
    d = diet_dedup(spark, sf_dir).select("Age", "BMI", F.lit(None).cast("double").alias("nothing"),
                                         F.lit(None).cast("string").alias("no_text"), "Health_Status")
    sides = [d.where(F.col("Health_Status") == "Healthy").drop("Health_Status"),
             d.where(F.col("Health_Status") != "Healthy").drop("Health_Status")]
    rep = drift.drift_report(*sides)
    n = drift.drift_summary(rep).first()["n_features_checked"]
    return rep.select("feature", F.lit(n).cast("long").alias("n_features"), F.col("psi").isNotNull().alias("reported"),
                      F.when(F.col("feature").isin("nothing", "no_text"), F.col("psi")).alias("psi"))
