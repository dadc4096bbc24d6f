"""The preparation job.

raw -> dedup -> stratified split -> cleaner (fit on train) -> engineered
features -> encoder (fit on train) -> feature matrix, with train and test
kept in one frame (``split`` column) until the sink.  The split table is
materialised once (Parquet in the cluster's shared folder)
because three fits and the output read it.
"""
from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions.rules import engineer_features
from nutrilake.operators.clean import Cleaner, CleanerModel, drop_duplicates_first
from nutrilake.operators.encode import Encoder, EncoderModel, LabelCodes
from nutrilake.operators.split import stratified_split
from nutrilake.session import remove_scratch, scratch_folder
from nutrilake.sources.sinks import write_splits


@dataclass
class Prepared:
    frame: DataFrame            # key, label, split, features...
    engineered: DataFrame       # cleaned + engineered rows with split
    cleaner: CleanerModel
    encoder: EncoderModel
    labels: LabelCodes
    feature_names: list[str]
    key: str
    target: str

    def train(self) -> DataFrame:
        return self.frame.where(F.col("split") == "train")

    def test(self) -> DataFrame:
        return self.frame.where(F.col("split") == "test")


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Cut the lineage of a table that several jobs read.

    ``checkpoint``: Parquet in a scratch folder below ``spark.checkpoint.dir``
    (survives executor loss; a reader decodes only the columns it needs);
    ``cache``: memory/disk cache (recomputed on loss); ``none``: keep the lineage.
    """
    if how == "checkpoint":
        return in_scratch(df)[0]
    if how == "cache":
        return df.cache()
    return df


def in_scratch(df: DataFrame) -> tuple[DataFrame, str]:
    """The table written to a scratch folder, and the folder to remove."""
    folder = scratch_folder(df.sparkSession, "checkpoint")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def split_raw(raw: DataFrame, target: str = S.TARGET_COLUMN, key: str = S.ID_COLUMN,
              test_size: float = 0.2, seed: int = 42, order_by: list[str] | None = None,
              how: str = "checkpoint") -> DataFrame:
    """dedup (first per key), materialised once, + stratified split.

    The deduplicated table is materialised (its shuffle is the expensive
    part) to find the cuts of the split, and with ``checkpoint`` once more
    with the split: a hash a row, which the many readers need not repeat.
    """
    deduped = drop_duplicates_first(raw, key, order_by)
    if order_by:
        deduped = deduped.drop(*[c for c in order_by if c not in S.RAW_COLUMNS])
    if how != "checkpoint":
        return stratified_split(materialize(deduped, how), target, test_size, seed, key)
    rows, folder = in_scratch(deduped)
    split = materialize(stratified_split(rows, target, test_size, seed, key))
    remove_scratch(raw.sparkSession, folder)
    return split


def prepare(raw: DataFrame, target: str = S.TARGET_COLUMN, key: str = S.ID_COLUMN,
            test_size: float = 0.2, seed: int = 42, order_by: list[str] | None = None,
            numeric: list[str] | None = None, categorical: list[str] | None = None,
            outlier_columns: list[str] | None = None, out_dir: str | None = None,
            how: str = "checkpoint", quantile_method: str = "exact") -> Prepared:
    split = split_raw(raw, target, key, test_size, seed, order_by, how)
    raw_cols = [c for c in split.columns if c != "split"]
    train_raw = split.where(F.col("split") == "train").select(*raw_cols)
    # the key is unique after dedup: its mode is min(key), no shuffle of ids
    cleaner = Cleaner(outlier_columns if outlier_columns is not None else S.RAW_NUMERIC_COLUMNS,
                      quantile_method=quantile_method, unique_columns=[key]).fit(train_raw)
    engineered = engineer_features(cleaner.transform(split))
    encoder = Encoder(numeric, categorical).fit(engineered.where(F.col("split") == "train"))
    labels = LabelCodes.fit(split.where(F.col("split") == "train"), target)
    frame = encoder.transform(engineered, keep=[key, target, "split"])
    prepared = Prepared(frame, engineered, cleaner, encoder, labels, encoder.feature_names(),
                        key, target)
    if out_dir:
        spark = raw.sparkSession
        write_splits(frame, out_dir, key, target)
        cleaner.save(spark, os.path.join(out_dir, "cleaner_state"))
        encoder.save(spark, os.path.join(out_dir, "encoder_state"))
        labels.save(spark, os.path.join(out_dir, "label_codes"))
    return prepared
