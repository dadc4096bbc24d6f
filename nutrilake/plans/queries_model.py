"""Registered queries: metrics, cross-validation summary, model selection,
learners, scoring (batch, stream, what-if), request validation, sinks.

Metric queries evaluate fixed rule predictors so their numbers have an SQL
oracle; learner and scoring queries return what any fit must satisfy (which
rows, values in range, labels that are the most likely class), which SQL can
state exactly.
"""
from __future__ import annotations

import functools
import os

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions import rules
from nutrilake.operators import evaluate, score, split
from nutrilake.operators.boost import make_model
from nutrilake.operators.clean import path_exists
from nutrilake.plans import sqlgen as G
from nutrilake.plans import training
from nutrilake.plans.common import diet_dedup, r6, sql_r6, with_dd
from nutrilake.plans.preprocess import in_scratch, prepare
from nutrilake.plans.queries_prep import FEATURE_MATRIX_SQL, _prepared, matrix_columns
from nutrilake.plans.registry import query
from nutrilake.session import remove_scratch, scratch_folder
from nutrilake.sources.diet_profile import diet_profile
from nutrilake.sources.sinks import artifact_paths, read_split, write_splits
from nutrilake.sources.tables import read_table
from nutrilake.streaming.scoring import REQUEST_SCHEMA, read_rejected, read_scored, start_scoring_stream

CLASSES = sorted(S.HEALTH_STATUSES)
SMALL_GBT = {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3}
SMALL_SOFTMAX = {"iterations": 4, "depth": 3, "learning_rate": 0.5}
# Settings of the check queries that fit many models (the jobs take any).
SHORT = {"ovr_gbt": {"n_estimators": 2, "max_depth": 2}, "softmax_boost": {"iterations": 2, "depth": 2}}


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a
    machine-local temp dir on a cluster)."""
    return scratch_folder(spark, name)


# ---------------------------------------------------------------- rule predictors
def rule_a(bmi: str = "BMI", age: str = "Age") -> Column:
    """BMI banding with an age-dependent offset (errs near band edges)."""
    return rules.bmi_band(F.col(bmi) + ((F.col(age) % 5) - 2) * 0.5)


def rule_b() -> Column:
    """Banding of BMI re-derived from weight (70 kg when missing), 1 decimal."""
    h = F.col("Height_cm") / 100.0
    return rules.bmi_band(F.round(F.coalesce(F.col("Weight_kg"), F.lit(70.0)) / (h * h), 1))


RULE_A_SQL = G.bmi_band_sql("(BMI + ((Age % 5) - 2) * 0.5)")
RULE_B_SQL = G.bmi_band_sql("round(coalesce(Weight_kg, 70.0) / ((Height_cm / 100.0) * (Height_cm / 100.0)), 1)")


def metrics_sql(src: str, t: str, p: str, group: str | None = None, prefix: str = "") -> str:
    """SQL CTEs computing the five metrics over ``src`` (optionally per
    ``group``); the last CTE is ``<prefix>met``."""
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    jg = f" AND a.{group} = b.{group}" if group else ""
    pairs, cls, per, agg, met = (prefix + n for n in ("pairs", "cls", "per", "agg", "met"))
    return f"""
{pairs} AS (SELECT {g}CAST({t} AS VARCHAR) AS t, CAST({p} AS VARCHAR) AS p, count(*) AS n FROM {src} GROUP BY ALL),
{cls} AS (SELECT DISTINCT {g}t AS k FROM {pairs} UNION SELECT DISTINCT {g}p FROM {pairs}),
{per} AS (SELECT {"a." + group + ", " if group else ""}a.k,
          coalesce((SELECT sum(n) FROM {pairs} b WHERE b.t = a.k AND b.p = a.k{jg}), 0) AS tp,
          coalesce((SELECT sum(n) FROM {pairs} b WHERE b.p = a.k{jg}), 0) AS pk,
          coalesce((SELECT sum(n) FROM {pairs} b WHERE b.t = a.k{jg}), 0) AS tk
        FROM {cls} a),
{agg} AS (SELECT {g}avg(CASE WHEN pk = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pk END) AS precision_macro,
          avg(CASE WHEN tk = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / tk END) AS recall_macro,
          avg(CASE WHEN 2 * tp + (pk - tp) + (tk - tp) = 0 THEN 0.0
                   ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + (pk - tp) + (tk - tp)) END) AS f1_macro,
          CAST(sum(tp) AS DOUBLE) AS c, CAST(sum(tk) AS DOUBLE) AS s,
          sum(CAST(pk AS DOUBLE) * tk) AS pt, sum(CAST(pk AS DOUBLE) * pk) AS pp,
          sum(CAST(tk AS DOUBLE) * tk) AS tt
        FROM {per} {gb}),
{met} AS (SELECT {g}CASE WHEN s = 0 THEN 0.0 ELSE c / s END AS accuracy, precision_macro, recall_macro, f1_macro,
          CASE WHEN sqrt((s * s - pp) * (s * s - tt)) = 0 THEN 0.0
               ELSE (c * s - pt) / sqrt((s * s - pp) * (s * s - tt)) END AS mcc
        FROM {agg})"""


def _met_out(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    return df.select(*(extra or []), *[r6(k).alias(k) for k in S.METRIC_KEYS])


def _rule_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diet_dedup(spark, sf_dir).withColumn("pred_a", rule_a()).withColumn("pred_b", rule_b())


_GRID = ", ".join(f"({G.lit(a)}, {G.lit(b)})" for a in CLASSES for b in CLASSES)
CONFUSION_SQL = with_dd(f"""SELECT g.true_label, g.pred_label, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM grid g
LEFT JOIN (SELECT Health_Status AS t, {RULE_A_SQL} AS p, count(*) AS n FROM dd GROUP BY 1, 2) c
  ON c.t = g.true_label AND c.p = g.pred_label""",
                        f"grid AS (SELECT * FROM (VALUES {_GRID}) AS v(true_label, pred_label))")


@query("confusion", CONFUSION_SQL)
def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = evaluate.pair_counts(_rule_frame(spark, sf_dir), "Health_Status", "pred_a")
    return evaluate.confusion_long(pairs, CLASSES)


METRICS_ROW_SQL = with_dd(f"""SELECT string_agg(CAST(n AS VARCHAR), ',' ORDER BY true_label, pred_label) AS confusion,
  'Healthy,Obese,Overweight,Underweight' AS class_labels
FROM (SELECT g.true_label, g.pred_label, coalesce(c.n, 0) AS n FROM grid g
  LEFT JOIN (SELECT Health_Status AS t, {RULE_A_SQL} AS p, count(*) AS n FROM dd GROUP BY 1, 2) c
    ON c.t = g.true_label AND c.p = g.pred_label)""",
                          f"grid AS (SELECT * FROM (VALUES {_GRID}) AS v(true_label, pred_label))")


@query("metrics_row", METRICS_ROW_SQL)
def q_metrics_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4/V5: the confusion matrix of the metrics row with its class labels."""
    m = evaluate.classification_metrics(_rule_frame(spark, sf_dir), "Health_Status", "pred_a", CLASSES)
    return m.select(F.array_join(F.flatten("confusion_matrix").cast("array<string>"), ",").alias("confusion"),
                    F.array_join("class_labels", ",").alias("class_labels"))


METRICS_MACRO_SQL = with_dd(f"SELECT {', '.join(sql_r6(k) + ' AS ' + k for k in S.METRIC_KEYS[:4])} FROM met",
                            "rf AS (SELECT Health_Status, " + RULE_A_SQL + " AS pred_a FROM dd)," +
                            metrics_sql("rf", "Health_Status", "pred_a"))


@query("metrics_macro", METRICS_MACRO_SQL)
def q_metrics_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = evaluate.classification_metrics(_rule_frame(spark, sf_dir), "Health_Status", "pred_a", CLASSES)
    return m.select(*[r6(k).alias(k) for k in S.METRIC_KEYS[:4]])


METRICS_MCC_SQL = with_dd(f"SELECT {sql_r6('mcc')} AS mcc, {sql_r6('accuracy')} AS accuracy FROM met",
                          "rf AS (SELECT Health_Status, " + RULE_B_SQL + " AS pred_b FROM dd)," +
                          metrics_sql("rf", "Health_Status", "pred_b"))


@query("metrics_mcc", METRICS_MCC_SQL)
def q_metrics_mcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = evaluate.pair_counts(_rule_frame(spark, sf_dir), "Health_Status", "pred_b")
    m = evaluate.metrics_from_pairs(pairs)
    return m.select(r6("mcc").alias("mcc"), r6("accuracy").alias("accuracy"))


METRICS_LABELS_SQL = "WITH " + metrics_sql("labels", "quality", "toxic") + "\nSELECT " + \
    ", ".join(sql_r6(k) + " AS " + k for k in S.METRIC_KEYS) + " FROM met"


@query("metrics_labels", METRICS_LABELS_SQL)
def q_metrics_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five metrics of ``toxic`` read as a prediction of ``quality``."""
    pairs = evaluate.pair_counts(read_table(spark, sf_dir, "labels"), "quality", "toxic")
    return _met_out(evaluate.metrics_from_pairs(pairs))


CV_SUMMARY_SQL = with_dd(
    "SELECT metric, " + sql_r6("avg(v)") + " AS mean, " + sql_r6("stddev_pop(v)") + " AS std FROM (" +
    " UNION ALL ".join(f"SELECT fold, '{k}' AS metric, {k} AS v FROM met" for k in S.METRIC_KEYS) +
    ") GROUP BY metric",
    """rf AS (SELECT (row_number() OVER (PARTITION BY Health_Status ORDER BY md5('42:' || Person_ID), Person_ID) - 1) % 5 AS fold,
       Health_Status, """ + RULE_A_SQL + " AS pred_a FROM dd)," + metrics_sql("rf", "Health_Status", "pred_a", "fold"))


@query("cv_summary", CV_SUMMARY_SQL)
def q_cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold metrics of the rule predictor over 5 stratified folds -> mean and
    population std per metric (the M8 aggregation)."""
    folded = split.stratified_folds(_rule_frame(spark, sf_dir), 5)
    pairs = evaluate.pair_counts(folded, "Health_Status", "pred_a", ["fold"])
    m = evaluate.metrics_from_pairs(pairs, ["fold"])
    per_fold = m.unpivot(["fold"], S.METRIC_KEYS, "metric", "value")
    summ = training.cv_summary(per_fold)
    return summ.select("metric", r6("mean").alias("mean"), r6("std").alias("std"))


BEST_MODEL_SQL = with_dd(
    f"SELECT model_type, 'mcc' AS metric, {sql_r6('value')} AS value FROM "
    "(SELECT * FROM allm ORDER BY value DESC, pos LIMIT 1)",
    "ra AS (SELECT Health_Status, " + RULE_A_SQL + " AS p FROM dd), rb AS (SELECT Health_Status, " + RULE_B_SQL +
    " AS p FROM dd)," + metrics_sql("ra", "Health_Status", "p", prefix="a_") + "," +
    metrics_sql("rb", "Health_Status", "p", prefix="b_") +
    ", allm AS (SELECT 'rule_a' AS model_type, mcc AS value, 0 AS pos FROM a_met UNION ALL "
    "SELECT 'rule_b', mcc, 1 FROM b_met)")


@query("best_model", BEST_MODEL_SQL)
def q_best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 on two rule predictors: highest mcc, first registered on ties."""
    rf = _rule_frame(spark, sf_dir)
    parts = []
    for pos, (name, col) in enumerate((("rule_a", "pred_a"), ("rule_b", "pred_b"))):
        m = evaluate.metrics_from_pairs(evaluate.pair_counts(rf, "Health_Status", col))
        parts.append(m.unpivot([], S.METRIC_KEYS, "metric", "value")
                     .select(F.lit(name).alias("model_type"), "metric", "value",
                             F.lit(pos).alias("registry_position")))
    best = training.best_model(parts[0].unionByName(parts[1]), "mcc")
    return best.select("model_type", "metric", r6("value").alias("value"))


# ---------------------------------------------------------------- learners
# Fits have no SQL form, but what they must return has: which rows, and that
# every value is in range.  The SQL states the grid; the values are checked in
# the query.
LEARNERS = {"ovr_gbt": SMALL_GBT, "softmax_boost": SMALL_SOFTMAX}


def _values(name: str, columns: str, rows: list[str]) -> str:
    return f"SELECT * FROM (VALUES {', '.join(f'({r})' for r in rows)}) AS {name}({columns})"


def _in_range(metric: str = "metric", value: str = "value") -> Column:
    """A metric is finite, in [0, 1], or in [-1, 1] for the correlation."""
    low = F.when(F.col(metric) == "mcc", -1.0).otherwise(0.0)
    return F.coalesce((F.col(value) >= low) & (F.col(value) <= 1.0), F.lit(False))


TRAIN_CURVES_SQL = _values("g", "model_type, iteration, split, metric, plausible", [
    f"'{t}', CAST({i} AS INTEGER), '{side}', '{metric}', TRUE"
    for t, n, metric in (("ovr_gbt", 5, "ovr_logloss"), ("softmax_boost", 4, "mlogloss"))
    for i in range(1, n + 1) for side in ("train", "validation")])


@query("train_curves", TRAIN_CURVES_SQL)
def q_train_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5/M7, both learners: a value per round and side, finite and positive,
    and on the training side no higher than in the first round."""
    p = _prepared(spark, sf_dir)
    frame, folder = in_scratch(training.model_frame(p))     # both learners share the rows and their bins
    binned = training.shared_bins(*training.sides(frame), LEARNERS, 42)
    parts = []
    for t, params in LEARNERS.items():
        fitted = training.train_model(t, p, None, 42, params, frame, binned=binned[t])
        fitted.metrics.unpersist()
        e = fitted.evals
        first = F.max(F.when(F.col("iteration") == 1, F.col("value"))).over(Window.partitionBy("split"))
        parts.append(e.select(F.lit(t).alias("model_type"), "iteration", "split", "metric",
                              F.coalesce((F.col("value") > 0) & (F.col("value") < float("inf"))
                                         & ((F.col("split") != "train") | (F.col("value") <= first)),
                                         F.lit(False)).alias("plausible")))
    training.remove_bins(binned)
    remove_scratch(spark, folder)           # the curves are fetched; the metrics are not read
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- exact trees
# The first round of both learners on lineitem (three classes, five features of
# few values), written out in SQL: cells, running sums, gains, the best split of
# each node, Newton leaf values, and the log loss that follows.
BOOST_FEATURES = ["l_quantity", "l_discount", "l_tax", "CAST(l_linenumber AS DOUBLE)",
                  "CASE WHEN l_linestatus = 'O' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"]
BOOST_STEP = 0.5


def _lineitem_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "lineitem").select(
        F.expr("CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END").alias("label"),
        F.expr("CAST(l_orderkey % 5 AS INT)").alias("fold"),
        array_to_vector(F.array(*[F.expr(c).cast("double") for c in BOOST_FEATURES])).alias("features"))
    return rows


def _boost_ctes(models: str, levels: int, l2: float = 1.0, min_rows: int = 1) -> str:
    """base, shares, and per level i: best{i} (m, k, node, f, v, gain, totals,
    sums of the left side) and at{i + 1} (rows with the node they go to)."""
    x = ", ".join(BOOST_FEATURES)
    unit = "CAST(16777216 AS DOUBLE)"

    def part(g: str, h: str) -> str:
        return f"({g}) / {unit} * (({g}) / {unit}) / (({h}) / {unit} + CAST({l2!r} AS DOUBLE))"

    out = f"""base AS MATERIALIZED (SELECT row_number() OVER () AS rid, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y,
  l_orderkey % 5 AS fold, [{x}] AS x FROM lineitem),
vals AS (SELECT f, v, lead(v) OVER (PARTITION BY f ORDER BY v) AS nv FROM
  (SELECT DISTINCT f, x[f + 1] AS v FROM base, (SELECT unnest(range({len(BOOST_FEATURES)})) AS f))),
trained AS (SELECT m, b.* FROM base b, (SELECT unnest({models}) AS m) WHERE m < 0 OR fold <> m),
share AS (SELECT m, y AS k, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY m) AS p FROM trained GROUP BY m, y),
at0 AS (SELECT t.m, s.k, rid, y, x, 0 AS node,
  CAST(round((p - CASE WHEN y = k THEN 1 ELSE 0 END) * 16777216) AS BIGINT) AS g,
  CAST(round(p * (1 - p) * 16777216) AS BIGINT) AS h FROM trained t JOIN share s ON t.m = s.m)"""
    for i in range(levels):
        out += f""",
cells{i} AS (SELECT m, k, node, f, x[f + 1] AS v, sum(g) AS g, sum(h) AS h, count(*) AS n
  FROM at{i}, (SELECT unnest(range({len(BOOST_FEATURES)})) AS f) GROUP BY ALL),
sums{i} AS (SELECT m, k, node, f, v, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl,
  sum(g) OVER a AS g, sum(h) OVER a AS h, sum(n) OVER a AS n FROM cells{i}
  WINDOW w AS (PARTITION BY m, k, node, f ORDER BY v), a AS (PARTITION BY m, k, node, f)),
gains{i} AS (SELECT *, CASE WHEN nl >= {min_rows} AND n - nl >= {min_rows} THEN {part('gl', 'hl')} + {part('g - gl', 'h - hl')} - {part('g', 'h')} END AS gain FROM sums{i}),
best{i} AS (SELECT * FROM gains{i} QUALIFY row_number() OVER (PARTITION BY m, k, node ORDER BY gain DESC NULLS LAST, f, v) = 1),
at{i + 1} AS (SELECT a.* REPLACE (2 * a.node + 1 + CASE WHEN x[b.f + 1] <= b.v THEN 0 ELSE 1 END AS node)
  FROM at{i} a JOIN best{i} b ON a.m = b.m AND a.k = b.k AND a.node = b.node WHERE b.gain > 1e-9)"""
    return out


def _leaf_sql(levels: int) -> str:
    """(m, k, node, f, threshold, gain, g, h) of every node: splits, then leaves."""
    parts = [f"""SELECT b.m, b.k, b.node, CASE WHEN gain > 1e-9 THEN b.f ELSE -1 END AS f,
  CASE WHEN gain > 1e-9 THEN b.v + (nv - b.v) / 2 END AS threshold, CASE WHEN gain > 1e-9 THEN gain END AS gain, g, h
  FROM best{i} b JOIN vals ON vals.f = b.f AND vals.v = b.v""" for i in range(levels)]
    parts.append(f"SELECT m, k, node, -1, NULL, NULL, sum(g), sum(h) FROM at{levels} GROUP BY m, k, node")
    return " UNION ALL ".join(parts)


def _leaf_value(share: str, l2: float = 1.0) -> str:
    return f"-(CAST({share} AS DOUBLE)) * (g / CAST(16777216 AS DOUBLE)) / (h / CAST(16777216 AS DOUBLE) + {l2!r})"



_LEARNER_SHARE = {"ovr_gbt": "1", "softmax_boost": "2.0 / 3.0"}
BOOST_TREE_SQL = f"WITH {_boost_ctes('[-1]', 2)}, nodes AS ({_leaf_sql(2)})\n" + " UNION ALL ".join(
    f"""SELECT '{t}' AS model_type, CAST(k AS INTEGER) AS class, CAST(node AS INTEGER) AS node, CAST(f AS INTEGER) AS feature,
  {sql_r6('threshold')} AS threshold, round(gain, 3) AS gain,
  CASE WHEN f < 0 THEN {sql_r6(_leaf_value(_LEARNER_SHARE[t]))} END AS value FROM nodes""" for t in _LEARNER_SHARE)


def _tree_rows(spark: SparkSession, model_type: str, rounds: list, thresholds: list, model: int) -> list[tuple]:
    tree, out = rounds[0], []
    for k in range(tree.feature.shape[1]):
        todo = [0]
        while todo:
            at = todo.pop()
            f = int(tree.feature[model, k, at])
            if f >= 0:
                out.append((model_type, model, k, at, f, float(thresholds[f][tree.bin[model, k, at]]),
                            float(tree.gain[model, k, at]), None))
                todo += [2 * at + 1, 2 * at + 2]
            else:
                out.append((model_type, model, k, at, -1, None, None, float(tree.value[model, k, at])))
    return out


def _tree_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "model_type string, fold int, class int, node int, feature int, threshold double, "
                                       "gain double, value double") \
        .withColumns({"threshold": r6("threshold"), "gain": F.round("gain", 3), "value": r6("value")})


@query("boost_tree", BOOST_TREE_SQL)
def q_boost_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1/M2: the first trees of both learners on all of lineitem: split
    features, thresholds, gains and leaf values."""
    rows, out = _lineitem_vectors(spark, sf_dir), []
    for t in ("ovr_gbt", "softmax_boost"):
        m = make_model(t, 42, iterations=1, depth=2, learning_rate=BOOST_STEP, max_bins=64).fit(rows)
        out += _tree_rows(spark, t, m.forest.rounds, m.forest.thresholds, 0)
    return _tree_frame(spark, out).drop("fold")


CV_TREE_SQL = f"WITH {_boost_ctes('range(5)', 1)}, nodes AS ({_leaf_sql(1)})\n" + f"""SELECT 'softmax_boost' AS model_type,
  CAST(m AS INTEGER) AS fold, CAST(k AS INTEGER) AS class, CAST(node AS INTEGER) AS node, CAST(f AS INTEGER) AS feature,
  {sql_r6('threshold')} AS threshold, round(gain, 3) AS gain,
  CASE WHEN f < 0 THEN {sql_r6(_leaf_value(_LEARNER_SHARE['softmax_boost']))} END AS value FROM nodes"""


@query("cv_tree", CV_TREE_SQL)
def q_cv_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: five folds of lineitem trained in the same passes: the first tree of
    every fold's model and class."""
    _, forest = make_model("softmax_boost", 42, iterations=1, depth=1, max_bins=64) \
        .fit_folds(_lineitem_vectors(spark, sf_dir), 5, n_classes=3)
    rows = [r for fold in range(5) for r in _tree_rows(spark, "softmax_boost", forest.rounds, forest.thresholds, fold)]
    return _tree_frame(spark, rows)


BOOST_PARAMS_SQL = f"WITH {_boost_ctes('[-1]', 1, 50.0, 2000)}, nodes AS ({_leaf_sql(1)})\n" + " UNION ALL ".join(
    f"""SELECT '{t}' AS model_type, CAST(k AS INTEGER) AS class, CAST(node AS INTEGER) AS node, CAST(f AS INTEGER) AS feature,
  {sql_r6('threshold')} AS threshold, round(gain, 3) AS gain,
  CASE WHEN f < 0 THEN {sql_r6(_leaf_value(_LEARNER_SHARE[t], 50.0))} END AS value FROM nodes""" for t in _LEARNER_SHARE)


@query("boost_params", BOOST_PARAMS_SQL)
def q_boost_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: both learners under a caller's names for rounds, depth, rate, bins,
    penalty and smallest node."""
    rows, out = _lineitem_vectors(spark, sf_dir), []
    for t, params in (("ovr_gbt", {"n_estimators": 1, "max_depth": 1, "eta": 0.3, "reg_lambda": 50.0, "min_child_weight": 2000}),
                      ("softmax_boost", {"iterations": 1, "depth": 1, "learning_rate": 0.3, "l2_leaf_reg": 50.0,
                                         "minInstancesPerNode": 2000})):
        m = make_model(t, random_state=7, max_bins=64, verbose=0, eval_metric="mlogloss", **params).fit(rows)
        assert m.step == 0.3 and m.random_state == 7
        out += _tree_rows(spark, t, m.forest.rounds, m.forest.thresholds, 0)
    return _tree_frame(spark, out).drop("fold")


_SCORED = f"""leaf AS (SELECT a.rid, a.y, a.k, n.g AS g, n.h AS h
  FROM at2 a JOIN (SELECT m, k, node, sum(g) AS g, sum(h) AS h FROM at2 GROUP BY ALL) n ON a.k = n.k AND a.node = n.node
  UNION ALL SELECT a.rid, a.y, a.k, b.g, b.h FROM at1 a JOIN best1 b ON a.k = b.k AND a.node = b.node
  WHERE b.gain IS NULL OR b.gain <= 1e-9
  UNION ALL SELECT a.rid, a.y, a.k, b.g, b.h FROM at0 a JOIN best0 b ON a.k = b.k
  WHERE b.gain IS NULL OR b.gain <= 1e-9)"""


def _score_sql(init: str, share: str) -> str:
    return f"{init} + {BOOST_STEP!r} * {_leaf_value(share)}"


BOOST_LOSS_SQL = f"""WITH {_boost_ctes('[-1]', 2)}, {_SCORED},
soft AS (SELECT rid, max(CASE WHEN leaf.k = y THEN exp(s) END) / sum(exp(s)) AS p FROM
  (SELECT leaf.*, {_score_sql('ln(share.p)', '2.0 / 3.0')} AS s FROM leaf JOIN share ON leaf.k = share.k) leaf
  GROUP BY ALL),
rest AS (SELECT CASE WHEN k = y THEN 1 / (1 + exp(-s)) ELSE 1 - 1 / (1 + exp(-s)) END AS p FROM
  (SELECT leaf.*, {_score_sql('ln(share.p / (1 - share.p))', '1')} AS s FROM leaf JOIN share ON leaf.k = share.k))
SELECT 'ovr_gbt' AS model_type, round(avg(-ln(p)), 5) AS train_loss FROM rest
UNION ALL SELECT 'softmax_boost', round(avg(-ln(p)), 5) FROM soft"""


@query("boost_loss", BOOST_LOSS_SQL)
def q_boost_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3-M5: the training loss after the first round, as the curves report it."""
    rows, out = _lineitem_vectors(spark, sf_dir), []
    for t in ("ovr_gbt", "softmax_boost"):
        m = make_model(t, 42, iterations=1, depth=2, learning_rate=BOOST_STEP, max_bins=64)
        curve = m.fit(rows, validation=rows.limit(0)).get_evals_result()
        out.append(curve.where("split = 'train'").select(F.lit(t).alias("model_type"), F.round("value", 5).alias("train_loss")))
    return out[0].unionByName(out[1])


COMPARE_MODELS_SQL = _values("g", "model_type, metric, registry_position, in_range", [
    f"'{t}', '{m}', CAST({i} AS INTEGER), TRUE" for i, t in enumerate(("ovr_gbt", "softmax_boost"))
    for m in ("accuracy", "precision_macro", "recall_macro", "f1_macro", "mcc")])


@query("compare_models", COMPARE_MODELS_SQL)
def q_compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _prepared(spark, sf_dir)
    table = training.metrics_table(training.compare_models(p, None, 42, LEARNERS))
    return table.select("model_type", "metric", "registry_position", _in_range().alias("in_range"))


CROSS_VALIDATE_SQL = _values("g", "model_type, fold, metric, in_range", [
    f"'{t}', CAST({f} AS INTEGER), '{m}', TRUE" for t in ("ovr_gbt", "softmax_boost") for f in range(5)
    for m in ("accuracy", "precision_macro", "recall_macro", "f1_macro", "mcc")])


@query("cross_validate", CROSS_VALIDATE_SQL)
def q_cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: both learners over the default five folds."""
    p = _prepared(spark, sf_dir)
    short = {t: {**params, **SHORT[t]} for t, params in LEARNERS.items()}
    folded, folder = training.folded_rows(p, 5, 42)         # both learners share the folds and bins
    binned = training.shared_bins(folded, None, short, 42, "fold")
    remove_scratch(spark, folder)
    parts = [training.cross_validate(t, p, 5, 42, params, binned[t])[0]
             .select(F.lit(t).alias("model_type"), "fold", "metric", _in_range().alias("in_range"))
             for t, params in short.items()]
    training.remove_bins(binned)
    return parts[0].unionByName(parts[1])


LEAKAGE_SQL = _values("g", "model_type, subset, metric, in_range", [
    f"'{t}', '{n}', '{m}', TRUE" for t in ("ovr_gbt", "softmax_boost")
    for n in ("all_features", "without_bmi", "without_leaking")
    for m in ("accuracy", "precision_macro", "recall_macro", "f1_macro", "mcc")])


@query("leakage_ablation", LEAKAGE_SQL)
def q_leakage_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: test metrics with all numeric columns, without BMI, and without
    every BMI-reconstructing column, for both learners."""
    numeric = S.RAW_NUMERIC_COLUMNS + S.ENGINEERED_NUMERIC_COLUMNS
    p = prepare(diet_profile(spark, sf_dir), order_by=["copy_no"], numeric=numeric)
    names = p.feature_names
    subsets = {
        "all_features": names,
        "without_bmi": [n for n in names if n != "numeric__BMI"],
        "without_leaking": [n for n in names if n.replace("numeric__", "") not in S.LEAKING_NUMERIC_COLUMNS],
    }
    short = {t: {**params, **SHORT[t]} for t, params in LEARNERS.items()}
    # both learners share the rows and their bins
    whole, folder = in_scratch(training.model_frame(p, training.subset_features(subsets)))
    binned = training.shared_bins(*training.sides(whole), short, 42)
    parts = [training.leakage_ablation(p, t, 42, params, subsets, whole, binned[t])
             .select(F.lit(t).alias("model_type"), "subset", "metric", _in_range().alias("in_range"))
             for t, params in short.items()]
    training.remove_bins(binned)
    remove_scratch(spark, folder)
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------- requests
def requests_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests derived from the diet table, with broken rows:
    negative ages, unknown genders / activity levels, missing weights."""
    d = diet_dedup(spark, sf_dir)
    k = F.substring("Person_ID", 2, 20).cast("long")
    return d.select(
        F.col("Person_ID").alias("request_id"),
        F.when(k % 53 == 0, F.lit(-5)).otherwise(F.col("Age")).alias("age"),
        F.when(k % 59 == 0, F.lit("Robot")).otherwise(F.col("Gender")).alias("gender"),
        F.col("Height_cm").alias("height_cm"), F.col("Weight_kg").alias("weight_kg"),
        F.when(k % 61 == 0, F.lit("Superhuman")).otherwise(F.col("Activity_Level")).alias("activity_level"),
        F.col("Diet_Type").alias("diet_type"),
        F.col("Daily_Calorie_Requirement").alias("daily_calorie_requirement"),
        F.col("Daily_Calorie_Consumed").alias("daily_calorie_consumed"),
        F.col("Protein_Intake_g").alias("protein_intake_g"),
        F.col("Carbohydrate_Intake_g").alias("carbohydrate_intake_g"),
        F.col("Fat_Intake_g").alias("fat_intake_g"),
        F.col("Water_Intake_Liters").alias("water_intake_liters"))


REQ_CTE = """req AS (SELECT Person_ID AS request_id,
  CASE WHEN CAST(substr(Person_ID, 2) AS BIGINT) % 53 = 0 THEN -5 ELSE Age END AS age,
  CASE WHEN CAST(substr(Person_ID, 2) AS BIGINT) % 59 = 0 THEN 'Robot' ELSE Gender END AS gender,
  Height_cm AS height_cm, Weight_kg AS weight_kg,
  CASE WHEN CAST(substr(Person_ID, 2) AS BIGINT) % 61 = 0 THEN 'Superhuman' ELSE Activity_Level END AS activity_level,
  Diet_Type AS diet_type, Daily_Calorie_Requirement AS daily_calorie_requirement,
  Daily_Calorie_Consumed AS daily_calorie_consumed, Protein_Intake_g AS protein_intake_g,
  Carbohydrate_Intake_g AS carbohydrate_intake_g, Fat_Intake_g AS fat_intake_g,
  Water_Intake_Liters AS water_intake_liters FROM dd)"""


def _req_errors_sql() -> str:
    g = ", ".join(G.lit(x) for x in G.GENDERS)
    a = ", ".join(G.lit(x) for x in G.ACTIVITY_LEVELS)
    d = ", ".join(G.lit(x) for x in G.DIET_TYPES)
    parts = [
        f"CASE WHEN age IS NULL OR age <= 0 OR age > 120 THEN 'age must be an integer in 1..120' END",
        f"CASE WHEN gender IS NULL OR gender NOT IN ({g}) THEN 'gender must be one of Male, Female, Other' END",
        f"CASE WHEN activity_level IS NULL OR activity_level NOT IN ({a}) THEN 'activity_level is not a known level' END",
        f"CASE WHEN diet_type IS NULL OR diet_type NOT IN ({d}) THEN 'diet_type is not a known diet' END",
    ]
    parts += [f"CASE WHEN {c} IS NULL OR {c} <= 0 THEN '{c} must be > 0' END" for c in G.POSITIVE_FIELDS]
    parts += [f"CASE WHEN {c} IS NULL OR {c} < 0 THEN '{c} must be >= 0' END" for c in G.NON_NEGATIVE_FIELDS]
    return "[" + ", ".join(parts) + "]"


VALIDATE_SQL = with_dd(f"""SELECT request_id, CAST(len(list_filter(e, lambda x: x IS NOT NULL)) AS INTEGER) AS n_errors,
  array_to_string(list_filter(e, lambda x: x IS NOT NULL), '; ') AS errors
FROM (SELECT request_id, {_req_errors_sql()} AS e FROM req) WHERE len(list_filter(e, lambda x: x IS NOT NULL)) > 0""", REQ_CTE)


@query("validate_requests", VALIDATE_SQL)
def q_validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    _valid, rejected = score.validate_requests(requests_frame(spark, sf_dir))
    return rejected.select("request_id", F.size("errors").alias("n_errors"),
                           F.array_join("errors", "; ").alias("errors"))


DERIVE_BMI_SQL = with_dd(f"""SELECT request_id, CAST(age AS INTEGER) AS Age, gender AS Gender,
  round(weight_kg / ((height_cm / 100.0) * (height_cm / 100.0)), 2) AS BMI, {sql_r6('weight_kg')} AS Weight_kg
FROM (SELECT *, {_req_errors_sql()} AS e FROM req) WHERE len(list_filter(e, lambda x: x IS NOT NULL)) = 0""", REQ_CTE)


@query("derive_bmi", DERIVE_BMI_SQL)
def q_derive_bmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = score.validate_requests(requests_frame(spark, sf_dir))
    raw = score.to_raw_records(valid, keep=["request_id"])
    return raw.select("request_id", "Age", "Gender", "BMI", r6("Weight_kg").alias("Weight_kg"))


# ---------------------------------------------------------------- scoring
_PUBLISHED: dict[tuple[str, str], tuple[str, str, str]] = {}
_IN_SESSION: dict[tuple[str, str], score.ScoringArtifacts] = {}


def _published(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Prepare, compare both learners, publish the best; returns
    (processed_dir, best_model_dir, best by the comparison) in the shared
    scratch folder.  The scoring queries of one application share it.  The
    artifacts as they were fitted stay in ``_IN_SESSION``."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PUBLISHED or not path_exists(os.path.dirname(_PUBLISHED[key][0])):     # not yet, or cleared
        out = scratch_dir(spark, "models")
        p = prepare(diet_profile(spark, sf_dir), order_by=["copy_no"], out_dir=os.path.join(out, "processed"))
        results = training.compare_models(p, os.path.join(out, "models"), 42, LEARNERS)
        training.publish_best(results, os.path.join(out, "models"), "mcc")
        table = {r["model_type"]: r["value"] for r in training.metrics_table(results).where("metric = 'mcc'").collect()}
        _PUBLISHED[key] = (os.path.join(out, "processed"), os.path.join(out, "models", "best"),
                           max(table, key=table.get))
        _IN_SESSION[key] = score.ScoringArtifacts(p.cleaner, p.encoder, results[_PUBLISHED[key][2]].model, p.labels)
    return _PUBLISHED[key]


_VALID_SQL = f"len(list_filter({_req_errors_sql()}, lambda x: x IS NOT NULL)) = 0"
SCORE_BATCH_SQL = with_dd(f"""SELECT request_id, CAST(1 AS DOUBLE) AS probability_sum, CAST(4 AS INTEGER) AS n_classes,
  TRUE AS is_most_likely FROM req WHERE {_VALID_SQL}""", REQ_CTE)


@query("score_batch", SCORE_BATCH_SQL)
def q_score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every valid request scored once; the label is the most likely of
    the four classes."""
    processed, best, _ = _published(spark, sf_dir)
    art = score.ScoringArtifacts.load(spark, processed, best)
    valid, _ = score.validate_requests(requests_frame(spark, sf_dir))
    scored = score.score(score.to_raw_records(valid, keep=["request_id"]), art, keep=["request_id"])
    p = F.map_values("probabilities")
    return scored.select(
        "request_id", F.round(F.aggregate(p, F.lit(0.0), lambda a, x: a + x), 6).alias("probability_sum"),
        F.size("probabilities").alias("n_classes"),
        F.coalesce(F.element_at("probabilities", F.col("predicted_health_status")) == F.array_max(p),
                   F.lit(False)).alias("is_most_likely"))


SCORE_RELOAD_SQL = with_dd(f"""SELECT request_id, TRUE AS same_label, TRUE AS same_probabilities
FROM req WHERE {_VALID_SQL}""", REQ_CTE)


@query("score_reload", SCORE_RELOAD_SQL)
def q_score_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 after a restart: every valid request scored with the artifacts as
    they were fitted and as they are read back gets the same label and the same
    probabilities, bit by bit."""
    processed, best, _ = _published(spark, sf_dir)
    valid, _ = score.validate_requests(requests_frame(spark, sf_dir))
    raw = score.to_raw_records(valid, keep=["request_id"])

    def judged(rows: DataFrame, art: score.ScoringArtifacts, keep: list[str], name: str) -> DataFrame:
        p = F.array(*[F.element_at("probabilities", c) for c in CLASSES]).alias("p")
        return score.score(rows, art, keep=keep).select(
            *keep, F.struct(F.col("predicted_health_status").alias("label"), p).alias(name))

    # A row takes its raw record and what the first artifacts gave it to the second: no shuffle by id.
    fitted = judged(raw.withColumn("_raw", F.struct(*raw.columns)),
                    _IN_SESSION[(spark.sparkContext.applicationId, sf_dir)], ["_raw"], "a")
    both = judged(fitted.select("_raw.*", "a"), score.ScoringArtifacts.load(spark, processed, best), ["request_id", "a"], "b")
    return both.select("request_id", F.coalesce(F.col("a.label") == F.col("b.label"), F.lit(False)).alias("same_label"),
                       F.coalesce(F.col("a.p") == F.col("b.p"), F.lit(False)).alias("same_probabilities"))


SCORE_STREAM_SQL = with_dd(f"""SELECT request_id, CASE WHEN {_VALID_SQL} THEN 'scored' ELSE 'rejected' END AS outcome,
  {_VALID_SQL} AS has_label FROM req""", REQ_CTE)


@query("score_stream", SCORE_STREAM_SQL)
def q_score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scoring as a stream over request files (availableNow)."""
    processed, best, _ = _published(spark, sf_dir)
    art = score.ScoringArtifacts.load(spark, processed, best)
    base = scratch_dir(spark, "stream")
    inbox = os.path.join(base, "inbox")
    reqs = requests_frame(spark, sf_dir)
    reqs.select(*[F.col(f.name).cast(f.dataType) for f in REQUEST_SCHEMA.fields]) \
        .repartition(4).write.mode("overwrite").parquet(inbox)
    q = start_scoring_stream(spark, inbox, art, os.path.join(base, "out"), os.path.join(base, "ckpt"),
                             max_files_per_trigger=2)
    q.awaitTermination()
    scored = read_scored(spark, os.path.join(base, "out"))
    rejected = read_rejected(spark, os.path.join(base, "out"))
    return scored.select("request_id", F.lit("scored").alias("outcome"),
                         F.coalesce(F.col("predicted_health_status").isin(*CLASSES), F.lit(False)).alias("has_label")) \
        .unionByName(rejected.select("request_id", F.lit("rejected").alias("outcome"), F.lit(False).alias("has_label")))


SENSITIVITY_SQL = with_dd(f"""SELECT scenario, count(*) AS records, TRUE AS plausible
FROM req, (VALUES ('baseline'), ('weight_minus_10pct'), ('weight_plus_10pct'), ('calorie_surplus_500')) AS v(scenario)
WHERE {_VALID_SQL} GROUP BY scenario""", REQ_CTE)


@query("sensitivity", SENSITIVITY_SQL)
def q_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions under weight / calorie what-if scenarios: all records in
    each, none changed in the baseline."""
    processed, best, _ = _published(spark, sf_dir)
    art = score.ScoringArtifacts.load(spark, processed, best)
    valid, _ = score.validate_requests(requests_frame(spark, sf_dir))
    table = score.sensitivity(score.to_raw_records(valid, keep=["request_id"]), art)
    most = F.when(F.col("scenario") == "baseline", 0).otherwise(F.col("records"))
    return table.select("scenario", "records", (F.col("changed").between(0, most)).alias("plausible"))


@query("best_model_info", "SELECT 'mcc' AS selection_metric, TRUE AS is_best, TRUE AS in_range")
def q_best_model_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published metadata, read back, against the comparison."""
    _processed, best, winner = _published(spark, sf_dir)
    info = training.best_model_info(spark, os.path.dirname(best))
    return spark.createDataFrame(
        [(info["selection_metric"], info["model_type"] == winner, -1.0 <= float(info["selection_metric_value"]) <= 1.0)],
        "selection_metric string, is_best boolean, in_range boolean")


# ---------------------------------------------------------------- K
WRITE_READ_SQL = f"""SELECT m.*, fmt AS format
FROM ({FEATURE_MATRIX_SQL}) m, (VALUES ('parquet'), ('csv')) AS f(fmt)"""


@query("write_read_back", WRITE_READ_SQL)
def q_write_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K4: write X/y per split as parquet and as CSV, read back, join X to
    y on the key; all features."""
    p = _prepared(spark, sf_dir)
    parts = []
    for fmt in ("parquet", "csv"):
        out = scratch_dir(spark, "processed")
        write_splits(p.frame, out, p.key, p.target, fmt)
        for side in ("train", "test"):
            x = read_split(spark, out, f"X_{side}")
            y = read_split(spark, out, f"y_{side}")
            both = x.join(y, p.key).withColumns({"split": F.lit(side), "format": F.lit(fmt)})
            parts.append(matrix_columns(both, p.encoder, ["format"]))
    return functools.reduce(DataFrame.unionByName, parts)


SINK_LOCATIONS_SQL = with_dd("""SELECT a.name, a.folder, count(*) AS rows FROM sp JOIN (VALUES
  ('X_train', 'prepared/split=train', 'train'), ('y_train', 'prepared/split=train', 'train'),
  ('X_test', 'prepared/split=test', 'test'), ('y_test', 'prepared/split=test', 'test')) a(name, folder, side)
  ON sp.split = a.side GROUP BY 1, 2""", G.split_ctes("dd"))


@query("sink_locations", SINK_LOCATIONS_SQL)
def q_sink_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the rows found under the fixed location of every part."""
    p = _prepared(spark, sf_dir)
    out = scratch_dir(spark, "processed")
    write_splits(p.frame, out, p.key, p.target)
    paths = artifact_paths(out)
    parts = [spark.read.parquet(paths[name]).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(name).alias("name"), F.lit(os.path.relpath(paths[name], out)).alias("folder"), "rows")
             for name in ("X_train", "X_test", "y_train", "y_test")]
    return functools.reduce(DataFrame.unionByName, parts)
