"""Scaling, one-hot encoding and label codes.

Fit = one aggregation over the training rows (means, population standard
deviations, sorted category lists: a few numbers per column); transform =
column arithmetic with those numbers as literals.  Output columns are named
like scikit-learn's ColumnTransformer: ``numeric__<col>`` and
``categorical__<col>_<value>``.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions.ordered import collect_bounded

MAX_CATEGORIES = 10_000  # default width limit: each category becomes a column


@dataclass
class EncoderModel:
    numeric: list[str]
    categorical: list[str]
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)

    def feature_names(self) -> list[str]:
        names = [f"numeric__{c}" for c in self.numeric]
        for c in self.categorical:
            names += [f"categorical__{c}_{v}" for v in self.categories[c]]
        return names

    def feature_columns(self) -> list[F.Column]:
        cols = []
        for c in self.numeric:
            mean = self.means[c]
            std = self.stds[c]
            scale = 1.0 if (std is None or std == 0) else std
            cols.append(((F.col(c).cast("double") - F.lit(mean)) / F.lit(scale))
                        .alias(f"numeric__{c}"))
        for c in self.categorical:
            for v in self.categories[c]:
                cols.append(F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("double")
                            .alias(f"categorical__{c}_{v}"))
        return cols

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """Feature matrix; ``keep`` columns (id, label, split ...) ride along."""
        missing = [c for c in self.numeric + self.categorical if c not in df.columns]
        if missing:
            raise ValueError(f"columns missing for the encoder: {missing}")
        keep = [c for c in (keep or []) if c in df.columns]
        return df.select(*keep, *self.feature_columns())

    def state_df(self, spark: SparkSession) -> DataFrame:
        """One row per numeric feature, one per categorical feature (value
        position -1) and one per category; ``feature_position`` is the order
        of the fit, which the columns of the feature matrix follow."""
        rows = [("numeric", c, i, 0, self.means[c], self.stds[c], None)
                for i, c in enumerate(self.numeric)]
        for i, c in enumerate(self.categorical):
            rows.append(("categorical", c, i, -1, None, None, None))
            rows += [("categorical", c, i, j, None, None, v) for j, v in enumerate(self.categories[c])]
        return spark.createDataFrame(
            rows, "kind string, feature string, feature_position int, value_position int, mean double, "
                  "std double, category string")

    def save(self, spark: SparkSession, path: str) -> None:
        self.state_df(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "EncoderModel":
        rows = sorted(spark.read.parquet(path).collect(),
                      key=lambda r: (r["feature_position"], r["value_position"]))
        model = cls([r["feature"] for r in rows if r["kind"] == "numeric"],
                    [r["feature"] for r in rows if r["kind"] == "categorical" and r["value_position"] < 0])
        model.categories = {c: [] for c in model.categorical}
        for r in rows:
            if r["kind"] == "numeric":
                model.means[r["feature"]] = r["mean"]
                model.stds[r["feature"]] = r["std"]
            elif r["value_position"] >= 0:
                model.categories[r["feature"]].append(r["category"])
        return model


class Encoder:
    """Fit standard scaling (population std, zero variance -> 1) and
    one-hot categories (sorted, unseen -> all zeros) on training rows.

    Every category becomes a column, so ``max_categories`` limits the exact
    number of categories per column; raise it for wider tables."""

    def __init__(self, numeric: list[str] | None = None, categorical: list[str] | None = None,
                 max_categories: int = MAX_CATEGORIES):
        self.max_categories = max_categories
        self.numeric = list(S.NUMERIC_FEATURES if numeric is None else numeric)
        self.categorical = list(S.CATEGORICAL_FEATURES if categorical is None else categorical)

    def transform(self, df: DataFrame):  # noqa: D401 - contract: unfitted use is an error
        raise RuntimeError("Encoder must be fitted before calling transform()")

    def fit(self, df: DataFrame) -> EncoderModel:
        """One aggregation for the means and population stds; the distinct
        categories are counted exactly before they are fetched."""
        model = EncoderModel(self.numeric, self.categorical)
        aggs = []
        for c in self.numeric:
            aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                     F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
        row = df.agg(*aggs).first() if aggs else None
        for c in self.numeric:
            model.means[c] = row[f"m_{c}"]
            model.stds[c] = row[f"s_{c}"]
        if self.categorical:
            cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                 F.col(c).cast("string").alias("value"))
                                        for c in self.categorical]))
            long_df = df.select(cells.alias("_c")).select("_c.*") \
                .where(F.col("value").isNotNull()).dropDuplicates()
            widths = long_df.groupBy("column").count().where(F.col("count") > self.max_categories)
            too_wide = [(r["column"], r["count"]) for r in widths.collect()]    # one row per column
            if too_wide:
                raise ValueError(f"more than {self.max_categories} categories: {too_wide}")
            found: dict[str, list[str]] = {c: [] for c in self.categorical}
            for r in long_df.collect():  # at most columns x max_categories rows
                found[r["column"]].append(r["value"])
            model.categories = {c: sorted(v) for c, v in found.items()}
        return model


def assemble(df: DataFrame, feature_cols: list[str], out: str = "features") -> DataFrame:
    """Pack feature columns into one MLlib vector column."""
    return VectorAssembler(inputCols=feature_cols, outputCol=out, handleInvalid="keep").transform(df)


# --------------------------------------------------------------------------
# Label codes
# --------------------------------------------------------------------------
@dataclass
class LabelCodes:
    classes: list[str]

    @classmethod
    def fit(cls, df: DataFrame, label: str = S.TARGET_COLUMN) -> "LabelCodes":
        values = [r[0] for r in collect_bounded(
            df.select(label).where(F.col(label).isNotNull()).distinct(), what="classes")]
        return cls(sorted(values))

    def encode(self, label: str | F.Column = S.TARGET_COLUMN) -> F.Column:
        col = F.col(label) if isinstance(label, str) else label
        m = F.create_map(*[x for i, c in enumerate(self.classes) for x in (F.lit(c), F.lit(i))])
        code = m[col]
        return F.when(code.isNull(), F.raise_error(F.concat(
            F.lit("y contains previously unseen labels: "), F.coalesce(col, F.lit("NULL"))))) \
            .otherwise(code).cast("int")

    def decode(self, code: str | F.Column) -> F.Column:
        col = F.col(code) if isinstance(code, str) else code
        return F.element_at(F.array(*[F.lit(c) for c in self.classes]), col.cast("int") + 1)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.classes)), "code int, label string")

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "LabelCodes":
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["code"])
        return cls([r["label"] for r in rows])
