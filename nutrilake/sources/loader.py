"""Loading and validating the raw diet table.

The raw file is read as all-string columns and bound *by name* (the
reference binds by name, a CSV schema binds by position), the pandas NA
spellings are turned into NULL once, then the numeric columns are coerced
with ``try_cast`` so an unparsable cell becomes NULL instead of failing the
job (Spark 4 is ANSI by default).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions.ordered import hash_thresholds, row_order_key, seeded_order_key

# ---- fixed values: strings pandas reads as missing by default ---------------
NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
              "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
              "nan", "null"]
# ------------------------------------------------------------------------------


class DataLoadError(Exception):
    """The source could not be read or does not have the expected shape."""


def _na_to_null(col: Column) -> Column:
    return F.when(col.isin(*NA_STRINGS), F.lit(None).cast("string")).otherwise(col)


def na_to_null(df: DataFrame) -> DataFrame:
    """NA spellings -> NULL in every string column."""
    return df.select(*[(_na_to_null(F.col(f"`{f.name}`")).alias(f.name)
                        if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`"))
                       for f in df.schema])


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Header CSV as strings, NA spellings -> NULL.  Errors name the path.

    Quotes inside a quoted field are doubled, and quoted fields may hold
    commas and line ends.  Rows with too few fields are filled with NULL,
    fields beyond the header are dropped.  ``multi_line=False`` lets Spark
    split large files; use it where no field holds a line end.
    """
    try:
        df = (spark.read.option("header", True).option("inferSchema", False)
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
              .option("mode", "PERMISSIVE").csv(path))
        _ = df.schema  # forces the listing: a missing path raises here
    except Exception as exc:  # noqa: BLE001 - re-raised as one load error
        raise DataLoadError(f"cannot read {path}: {exc}") from exc
    return na_to_null(df)


def file_format(spark: SparkSession, path: str) -> str:
    """"parquet" if the path or a file in it ends so, else "csv" (asked of the
    cluster's file system)."""
    if path.rstrip("/").endswith(".parquet"):
        return "parquet"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return "csv"
    names = [s.getPath().getName() for s in fs.listStatus(hpath)]
    return "parquet" if any(n.endswith(".parquet") for n in names) else "csv"


def check_columns(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """S3: every expected column present (extra columns are allowed)."""
    expected = expected or S.RAW_COLUMNS
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise DataLoadError(
            f"the table lacks {missing}; it needs {expected} and has {df.columns}")
    return df


def _numeric_target(name: str) -> str:
    return "int" if name == "Age" else "double"


def coerce_numeric(df: DataFrame, columns: list[str] | None = None,
                   types: dict[str, str] | None = None) -> DataFrame:
    """Cast numeric columns with ``try_cast``; unparsable -> NULL.

    Strings go through DOUBLE first so "30.0" is a valid integer age;
    NaN/Infinity parsed from text become NULL as well.
    """
    columns = [c for c in (columns or S.RAW_NUMERIC_COLUMNS) if c in df.columns]
    types = types or {}
    out = {}
    for c in columns:
        target = types.get(c, _numeric_target(c))
        as_double = F.col(c).try_cast("double")
        as_double = F.when(F.isnan(as_double) | (F.abs(as_double) == float("inf")),
                           F.lit(None).cast("double")).otherwise(as_double)
        out[c] = as_double.try_cast(target) if target != "double" else as_double
    return df.withColumns(out)


def coercion_losses(raw: DataFrame, columns: list[str] | None = None,
                    types: dict[str, str] | None = None) -> DataFrame:
    """Per column: cells that were present but became NULL by coercion
    (one aggregation, unpivoted to (column, lost))."""
    columns = [c for c in (columns or S.RAW_NUMERIC_COLUMNS) if c in raw.columns]
    typed = coerce_numeric(raw.select(*[F.col(c).alias(f"_raw_{c}") for c in columns],
                                      *columns), columns, types)
    aggs = [F.count_if(F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull()).alias(c)
            for c in columns]
    return typed.agg(*aggs).unpivot([], columns, "column", "lost")


SOURCE_POSITION = "_source_pos"


def with_source_position(df: DataFrame, name: str = SOURCE_POSITION) -> DataFrame:
    """Add the row's position in the source files as an orderable struct:
    (file path, byte offset of its split, row id inside the split).  Within
    one split ``monotonically_increasing_id`` grows with the row's offset, so
    ordering by this struct is file order -- what "keep the first row" means
    for a file -- with no sort or single-task pass."""
    return df.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"),
                                        F.col("_metadata.file_block_start").alias("block"),
                                        F.monotonically_increasing_id().alias("row")))


def load_table(spark: SparkSession, path: str, sample_size: int | None = None,
               seed: int = 42, key: str = S.ID_COLUMN,
               expected: list[str] | None = None, keep_position: bool = False,
               fmt: str | None = None, split_bytes: int | None = None) -> DataFrame:
    """Read, optional exact-n sample, column check, numeric coercion.

    ``fmt`` is "csv" or "parquet"; when None, it is told by the file names.
    Both go the same way after the read (NA spellings -> NULL included).
    ``keep_position`` adds ``_source_pos`` (file order, see
    ``with_source_position``) for a later "first row per key".  ``split_bytes``
    reads CSV files in splits of that size (``split_csv``: quotes as in RFC 4180);
    without it, a file is one task.
    """
    if (fmt or file_format(spark, path)) == "parquet":
        try:
            df = spark.read.parquet(path)
        except Exception as exc:  # noqa: BLE001
            raise DataLoadError(f"cannot read {path}: {exc}") from exc
        df = na_to_null(df)
    elif split_bytes:
        from nutrilake.sources.split_csv import read_split_csv
        df = read_split_csv(spark, path, split_bytes, keep_position)
    else:
        df = read_raw_csv(spark, path)
    if keep_position and SOURCE_POSITION not in df.columns:
        df = with_source_position(df)
    if sample_size is not None:
        df = sample_n(df, sample_size, seed=seed, key=key)
    check_columns(df, expected)
    return coerce_numeric(df)


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str | list[str] = S.ID_COLUMN,
             order_col: str | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, seeded.

    Rows are ordered by ``md5('<seed>:<key>')`` and, where keys repeat or are
    NULL, by the md5 of all their columns; the first ``n`` are kept.  Rows
    equal in every column are interchangeable: as many copies are taken as fit.
    The n-th key is located by ``hash_thresholds`` (bucket counts + one cut
    bucket), so the sample is a filter -- no sort of the table, no
    driver-side top-k, and ``n`` can be as large as the table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # the key's hash orders nearly all rows; the hash of all columns is computed in the cut bucket only
    ordered = df.withColumns({"_key": seeded_order_key(seed, *keys), "_order": row_order_key(df, seed, *keys)})
    cut, totals, tied = hash_thresholds(ordered, "_order", None, [],
                                        lambda t: {None: min(n, t[None])}, key_len=64, leading=("_key", 32))
    if n >= totals[None]:
        out = ordered
    elif n <= 0:
        out = ordered.where(F.lit(False))
    else:
        last = cut[None][0]
        copies = (ordered.where((F.col("_key") == last[:32]) & (F.col("_order") == last)).limit(1)
                  .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), int(tied[None])))).drop("_copy"))
        ahead = (F.col("_key") < last[:32]) | ((F.col("_key") == last[:32]) & (F.col("_order") < last))
        out = ordered.where(ahead).unionByName(copies)
    out = out.drop("_key")
    return out.drop("_order") if order_col is None else out.withColumnRenamed("_order", order_col)


def source_info(spark: SparkSession, path: str) -> dict:
    """S5 (``get_info``): path, whether it exists, total size in bytes --
    asked of the cluster's file system (HDFS, object stores, local) through
    Hadoop's FileSystem API; no data is read."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    exists = bool(fs.exists(hpath))
    size = int(fs.getContentSummary(hpath).getLength()) if exists else None
    return {"path": path, "exists": exists, "size_bytes": size}


def source_inventory(df: DataFrame) -> DataFrame:
    """The files behind a scan: path, size in bytes, rows."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("size_bytes"))
            .groupBy("file_path", "size_bytes").agg(F.count(F.lit(1)).alias("rows")))


def dataset_overview(df: DataFrame, target: str = S.TARGET_COLUMN,
                     diet: str = "Diet_Type", age: str = "Age", bmi: str = "BMI") -> DataFrame:
    """One row: records, columns, the two distributions as maps, age
    and BMI ranges (BMI to 1 decimal).  One shuffle to (status, diet) cells,
    one aggregation over the cells."""
    from nutrilake.operators.stats import tally

    def key(c: str) -> Column:
        return F.col(c).cast("string")
    cells = df.groupBy(key(target).alias("_s"), key(diet).alias("_d")).agg(
        F.count(F.lit(1)).alias("n"), F.min(age).alias("amin"), F.max(age).alias("amax"),
        F.min(bmi).alias("bmin"), F.max(bmi).alias("bmax"))
    return (cells.agg(F.sum("n").alias("total_records"),
                      F.min("amin").alias("_amin"), F.max("amax").alias("_amax"),
                      F.min("bmin").alias("_bmin"), F.max("bmax").alias("_bmax"),
                      F.collect_list(F.struct(F.col("_s").alias("k"), F.col("n"))).alias("_st"),
                      F.collect_list(F.struct(F.col("_d").alias("k"), F.col("n"))).alias("_dt"))
            .select("total_records", F.lit(len(df.columns)).alias("total_columns"),
                    tally(F.col("_st")).alias("health_status_distribution"),
                    tally(F.col("_dt")).alias("diet_type_distribution"),
                    F.concat_ws(" - ", F.col("_amin").cast("string"),
                                F.col("_amax").cast("string")).alias("age_range"),
                    F.format_string("%.1f - %.1f", "_bmin", "_bmax").alias("bmi_range")))


def record_errors() -> Column:
    """ARRAY<STRING>: what is wrong with a raw row, empty when it is valid."""
    checks = [
        (F.col("Activity_Level").isNull() | ~F.col("Activity_Level").isin(*S.ACTIVITY_LEVELS),
         "invalid Activity_Level"),
        (F.col("Diet_Type").isNull() | ~F.col("Diet_Type").isin(*S.DIET_TYPES),
         "invalid Diet_Type"),
        (F.col(S.TARGET_COLUMN).isNull() | ~F.col(S.TARGET_COLUMN).isin(*S.HEALTH_STATUSES),
         "invalid Health_Status"),
        (F.col("Age").isNull(), "missing Age"),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(msg)) for c, msg in checks]),
                      lambda e: e.isNotNull())


def typed_records(df: DataFrame) -> DataFrame:
    """Nested ``person`` / ``nutrition`` structs plus enum membership.

    Adds ``errors`` (ARRAY<STRING>, empty when the row is valid): unknown or
    missing activity level, diet type or health status, missing id/age.
    """
    errors = record_errors()
    return df.select(
        F.struct(F.col(S.ID_COLUMN).alias("person_id"), F.col("Age").cast("int").alias("age"),
                 F.col("Gender").alias("gender"), F.col("Height_cm").alias("height_cm"),
                 F.col("Weight_kg").alias("weight_kg"), F.col("BMI").alias("bmi"),
                 F.col("Activity_Level").alias("activity_level")).alias("person"),
        F.struct(F.col("Daily_Calorie_Requirement").alias("daily_calorie_requirement"),
                 F.col("Daily_Calorie_Consumed").alias("daily_calorie_consumed"),
                 F.col("Protein_Intake_g").alias("protein_intake_g"),
                 F.col("Carbohydrate_Intake_g").alias("carbohydrate_intake_g"),
                 F.col("Fat_Intake_g").alias("fat_intake_g"),
                 F.col("Water_Intake_Liters").alias("water_intake_liters")).alias("nutrition"),
        F.col("Diet_Type").alias("diet_type"),
        F.col(S.TARGET_COLUMN).alias("health_status"),
        errors.alias("errors"),
    )


def validated(df: DataFrame) -> DataFrame:
    """The table as it is, if all its records are valid; reading an invalid
    one fails the job."""
    errors = record_errors()
    return df.where(F.when(F.size(errors) == 0, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("invalid record: "), F.array_join(errors, ", ")))))


def load_records(df: DataFrame, strict: bool = True) -> DataFrame | tuple[DataFrame, DataFrame]:
    """S7 load: strict mode fails the job on the first invalid row
    (``raise_error`` inside the plan, no driver-side scan); permissive mode
    returns (valid, rejected)."""
    rec = typed_records(df)
    if strict:
        # a filter is always evaluated (a dropped column would be pruned)
        return rec.where(F.when(F.size("errors") == 0, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("invalid record: "),
                                   F.array_join("errors", ", ")))))
    return rec.where(F.size("errors") == 0), rec.where(F.size("errors") > 0)
