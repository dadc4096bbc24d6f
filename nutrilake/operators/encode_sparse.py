"""Sparse one-hot encoding (T1, T2) without a limit on the number of categories.

Categories are numbered in sorted order, feature after feature, by range partitions
and kept as a table (feature, category, place); rows meet it in joins.  A row of the
feature matrix is two arrays: the places that are set, rising, and their values.
Places 0.. are the scaled numeric features, then come the categories; the layout is
that of ``encode.Encoder``.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions import segments
from nutrilake.functions.ordered import BROADCAST_MAX_ROWS
from nutrilake.session import scratch_folder

INDICES, VALUES = "indices", "values"


@dataclass
class SparseEncoderModel:
    """Fitted state; ``path`` holds the category table, partitioned by feature number."""
    numeric: list[str]
    categorical: list[str]
    path: str
    means: dict[str, float | None] = field(default_factory=dict)
    stds: dict[str, float | None] = field(default_factory=dict)
    widths: list[int] = field(default_factory=list)

    @property
    def size(self) -> int:
        """The length of a row of the matrix."""
        return len(self.numeric) + sum(self.widths)

    def categories(self, spark: SparkSession) -> DataFrame:
        """(feature, category, place): a row per category."""
        names = F.array(*[F.lit(c) for c in self.categorical]) if self.categorical \
            else F.array().cast("array<string>")
        return (self._table(spark).select(F.get(names, F.col("feature")).alias("feature"), "category", "place"))

    def _table(self, spark: SparkSession) -> DataFrame:
        schema = "category string, place long, feature int"
        if not sum(self.widths):        # a table without rows has no files
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.path)

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """The ``keep`` columns, ``indices`` and ``values``.  An unseen or NULL
        category sets nothing; a NULL number is a NULL value.

        A category table of up to ``BROADCAST_MAX_ROWS`` rows (their number is part of
        the state) is broadcast; a larger one is joined by category, where Spark may
        split hot ones.  Kept columns may have any names but those of the two arrays.
        """
        missing = [c for c in self.numeric + self.categorical if c not in df.columns]
        if missing:
            raise ValueError(f"columns missing for the encoder: {missing}")
        keep = [c for c in (keep or []) if c in df.columns]
        if {INDICES, VALUES} & set(keep):
            raise ValueError(f"{INDICES} and {VALUES} are the names of the result")
        numbers = []
        for c in self.numeric:
            std = self.stds[c]
            mean = F.lit(self.means[c]).cast("double")
            numbers.append((F.col(f"`{c}`").cast("double") - mean) / F.lit(1.0 if not std else std))
        out = df.select(*[F.col(f"`{c}`").alias(f"_keep{i}") for i, c in enumerate(keep)],
                        F.array(*numbers).cast("array<double>").alias("_numbers"),
                        *[F.col(f"`{c}`").cast("string").alias(f"_cat{i}") for i, c in enumerate(self.categorical)])
        table = self._table(df.sparkSession)
        for i, width in enumerate(self.widths):
            own = table.where(F.col("feature") == i).select(F.col("category").alias(f"_known{i}"),
                                                            F.col("place").alias(f"_place{i}"))
            own = F.broadcast(own) if width <= BROADCAST_MAX_ROWS else own
            out = out.join(own, F.col(f"_cat{i}") == F.col(f"_known{i}"), "left")
        places = F.array_compact(F.array(*[F.col(f"_place{i}") for i in range(len(self.widths))])) \
            if self.widths else F.array().cast("array<bigint>")
        first = F.array(*[F.lit(i).cast("long") for i in range(len(self.numeric))]).cast("array<bigint>")
        return out.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)],
                          F.concat(first, places).alias(INDICES),
                          F.concat("_numbers", F.array_repeat(F.lit(1.0), F.size(places))).alias(VALUES))

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [("numeric", i, c, self.means[c], self.stds[c], None) for i, c in enumerate(self.numeric)]
        rows += [("categorical", i, c, None, None, w) for i, (c, w) in enumerate(zip(self.categorical, self.widths))]
        spark.createDataFrame(rows, "kind string, position int, feature string, mean double, std double, width long") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        self._table(spark).write.mode("overwrite").partitionBy("feature").parquet(f"{path}/categories")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SparseEncoderModel":
        rows = sorted(spark.read.parquet(f"{path}/features").collect(), key=lambda r: r["position"])  # a row per feature
        numeric, categorical = ([r for r in rows if r["kind"] == kind] for kind in ("numeric", "categorical"))
        return cls([r["feature"] for r in numeric], [r["feature"] for r in categorical], f"{path}/categories",
                   {r["feature"]: r["mean"] for r in numeric}, {r["feature"]: r["std"] for r in numeric},
                   [r["width"] for r in categorical])


class SparseEncoder:
    """Fit of the sparse form: one aggregation for means and population stds, one
    for the distinct categories, which are then sorted by ranges and numbered."""

    def __init__(self, numeric: list[str] | None = None, categorical: list[str] | None = None):
        self.numeric = list(S.NUMERIC_FEATURES if numeric is None else numeric)
        self.categorical = list(S.CATEGORICAL_FEATURES if categorical is None else categorical)

    def transform(self, df: DataFrame):
        raise RuntimeError("SparseEncoder must be fitted before calling transform()")

    def fit(self, df: DataFrame) -> SparseEncoderModel:
        spark, folder = df.sparkSession, scratch_folder(df.sparkSession, "categories")
        model = SparseEncoderModel(self.numeric, self.categorical, f"{folder}/numbered")
        moments = [f(F.col(f"`{c}`").cast("double")) for c in self.numeric for f in (F.avg, F.stddev_pop)]
        found = list(df.agg(*moments).first()) if moments else []
        model.means = dict(zip(self.numeric, found[::2]))
        model.stds = dict(zip(self.numeric, found[1::2]))
        if self.categorical:
            cells = F.explode(F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"`{c}`").cast("string").alias("sval"))
                                        for i, c in enumerate(self.categorical)]))
            counts = (df.select(cells.alias("_c")).select("_c.*").where(F.col("sval").isNotNull())
                      .groupBy("feature", "sval").agg(F.count(F.lit(1)).alias("rn"))
                      .select("feature", F.lit(None).cast("double").alias("dval"), "sval", "rn",
                              F.lit(0).cast("long").alias("cn")))
            ordered = segments.write_ordered(counts, f"{folder}/ordered")
            parts = segments.totals(ordered)
            model.widths = [sum(p.distinct for p in parts if p.feature == i) for i in range(len(self.categorical))]
            numbered = segments.numbered(ordered, parts, len(self.numeric))
            numbered.select("feature", F.col("sval").alias("category"), "place") \
                .write.partitionBy("feature").parquet(model.path)
        return model
