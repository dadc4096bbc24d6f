"""S1 for large CSV files: quoted line ends, and still many tasks per file.

Spark cuts a CSV file into splits only if no field holds a line end.  Here the text
is read as lines, in splits, and the parity of the quotes before a line tells whether
the line begins a record:

1. quotes per split, by a plain aggregation; running sums over the splits of a file
   tell which splits begin inside quotes (a row per split);
2. of the splits at whose edges a record is cut, the fragments are written to a
   scratch folder and put together there;
3. every task then joins the lines of its splits to whole records, and Spark's own
   CSV functions parse them.

A file must double the quotes inside quoted fields and have no quotes in unquoted
ones (RFC 4180); ``loader.read_raw_csv`` reads other files, one task per file.
Line ends inside fields stay as they are.  Compressed files are one split each.
"""
from __future__ import annotations

import sys

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nutrilake.functions.ordered import BROADCAST_MAX_ROWS
from nutrilake.session import scratch_folder
from nutrilake.sources.loader import SOURCE_POSITION, DataLoadError, na_to_null

# Functions that run in Python workers are shipped by value: executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 128 << 20
SPLIT = ["file", "block"]
_OUT = "file string, block long, row long, kind int, record string"
WHOLE, HEAD, MIDDLE, END = 0, 1, 2, 3   # a record, or a fragment: its begin, a part, its end


def _fixed_splits(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session in which files are cut alike on every read: by default the
    cuts depend on how many cores the cluster has at that moment."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "1")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, odd, value): the lines in file order within a split;
    ``at`` grows with it, ``odd`` says whether the line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at"), (quotes % 2).cast("int").alias("odd"), "value"))


def _opens(lines: DataFrame) -> DataFrame:
    """(file, block, opens, cut): does the split begin inside quotes, and is a
    record cut at its begin or end?  A row per split."""
    per = lines.groupBy(*SPLIT).agg(F.sum("odd").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opens = (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2).cast("int")
    return (per.withColumn("opens", opens)
            .select(*SPLIT, "opens", ((F.col("opens") == 1) | ((F.col("opens") + F.col("n")) % 2 == 1)).alias("cut")))


def _with_state(lines: DataFrame, table: DataFrame, how: str, n_rows: int) -> DataFrame:
    """Lines with the state of their split; lines of a split stay together and in order."""
    if n_rows <= BROADCAST_MAX_ROWS:
        return lines.join(F.broadcast(table), SPLIT, how)
    return lines.join(table, SPLIT, how).sortWithinPartitions(*SPLIT, "at")


def _records(whole: bool):
    """Lines (file, block, opens, odd, value) -> records begun and ended in a
    split (``whole``), or the fragments at its edges."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        split, out = None, []
        held: list[str] = []            # lines of a record that goes on
        kind = start = n = state = 0

        def flush(last: int):
            nonlocal held
            if held and (whole == (kind == WHOLE and last == WHOLE)):
                now = last if kind == WHOLE else (MIDDLE if last == HEAD else END)
                out.append((split[0], split[1], start, now, "\n".join(held)))
            held = []

        def batch_of(rows):
            cols = list(zip(*rows)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=["file", "block", "row", "kind", "record"])

        for batch in batches:
            files, blocks, opens = (batch.column(i).to_pylist() for i in range(3))
            odd = batch.column(3).to_pylist()
            values = batch.column(4).to_pylist()
            for i, value in enumerate(values):
                if (files[i], blocks[i]) != split:
                    flush(HEAD)          # an open record of the split before goes on elsewhere
                    split, n, state = (files[i], blocks[i]), 0, opens[i]
                    kind, start = (MIDDLE, 0) if state else (WHOLE, 0)
                if not held and not state:
                    kind, start = WHOLE, n
                held.append(value)
                state ^= odd[i]
                n += 1
                if not state:
                    flush(WHOLE)
                    kind = WHOLE
            if out:
                yield batch_of(out)
                out = []
        flush(HEAD)
        if out:
            yield batch_of(out)
    return run


def _put_together(fragments: DataFrame) -> DataFrame:
    """Fragments -> records, under the place where they begin.  The order of the
    fragments of a file is found without their texts."""
    begins = F.when(F.col("kind") == HEAD, F.struct("block", "row"))
    upto = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, 0)
    owner = fragments.select(*SPLIT, "row", F.last(begins, ignorenulls=True).over(upto).alias("own"))
    return (fragments.join(owner, [*SPLIT, "row"]).groupBy("file", "own")
            .agg(F.array_sort(F.collect_list(F.struct("block", "row", "record"))).alias("parts"))
            .select("file", F.col("own.block").alias("block"), F.col("own.row").alias("row"),
                    F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))


def read_records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, block, row, record): the records of CSV files as text, headers
    included; (block, row) is the order in a file.  Quotes that are never closed make
    the rest of the file one record, as in Spark's reader.  Empty lines are no records."""
    own = _fixed_splits(spark, split_bytes)
    lines = _lines(own, path)
    folder = scratch_folder(spark, "csv_splits")
    _opens(lines).write.parquet(f"{folder}/splits")
    splits = own.read.parquet(f"{folder}/splits")
    opening, cut = splits.where("opens = 1").select(*SPLIT, "opens"), splits.where("cut").select(*SPLIT, "opens")
    inner = ["file", "block", "opens", "odd", "value"]
    state = _with_state(lines, opening, "left", opening.count()).withColumn("opens", F.coalesce("opens", F.lit(0)))
    found = state.select(*inner).mapInArrow(_records(True), _OUT).select(*SPLIT, "row", "record")
    n_cut = cut.count()
    if n_cut:
        (_with_state(lines, cut, "inner", n_cut).select(*inner).mapInArrow(_records(False), _OUT)
         .write.parquet(f"{folder}/fragments"))
        found = found.unionByName(_put_together(own.read.parquet(f"{folder}/fragments")))
    ended = F.regexp_replace("record", r"\r$", "")
    found = found.withColumn("record", ended).where(F.col("record") != "")
    # The result belongs to the caller's session.
    return spark.createDataFrame([], found.schema).unionByName(found)


def read_split_csv(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES,
                   keep_position: bool = False) -> DataFrame:
    """The rows of ``loader.read_raw_csv`` (strings, NA spellings -> NULL; missing
    fields NULL, surplus ones dropped), read in splits of ``split_bytes``.

    ``keep_position`` adds the place in the files (``_source_pos``).  Splits and
    fragments stay in a scratch folder, which the result reads.
    """
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    try:
        names = spark.read.options(header="true", inferSchema="false", **options).csv(path).columns
    except Exception as exc:  # noqa: BLE001 - re-raised as one load error
        raise DataLoadError(f"cannot read {path}: {exc}") from exc
    records = read_records(spark, path, split_bytes)
    # Every file begins with its header; empty lines may precede it.
    first = records.groupBy("file").agg(F.min(F.struct("block", "row")).alias("_first"))
    folder = scratch_folder(spark, "csv_headers")
    first.write.parquet(folder)
    first = spark.read.parquet(folder)
    rows = records.join(first, (records["file"] == first["file"])
                        & (F.struct("block", "row") == F.col("_first")), "left_anti")
    ddl = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    place = F.struct("file", "block", "row").alias(SOURCE_POSITION)
    parsed = rows.select(*([place] if keep_position else []), F.from_csv("record", F.lit(ddl), options).alias("_r"))
    parts = [F.col("_r").getField(n).alias(n) for n in names]
    out = na_to_null(parsed.select(*parts, *([F.col(SOURCE_POSITION)] if keep_position else [])))
    return out
