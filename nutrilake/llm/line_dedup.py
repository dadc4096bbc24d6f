"""Operator 1: line dedup with levelled sorted runs of line hashes.

A *run* is a table (h1, h2, n_docs, keeper): the 128-bit hash of a line key,
the number of documents that hold it and the largest doc_id among them.  Runs
are bucketed by hash and sorted inside each bucket.  A new batch of documents
adds one run at level 0; when a level has two runs they are merged, bucket by
bucket, into one run of the next level, so n batches leave at most log2(n)
runs and every row is rewritten log2(n) times.  Lines are dropped by an
inner join with the keys that enough documents hold; the merge anti-join of
``novel_lines`` tells the new lines of a batch and is used by no query.

Scale: the lines of a batch are counted with map-side combine, so a line that
a third of all documents hold costs one row per task.  Runs meet each other
bucket by bucket, without a shuffle.  Nothing is collected.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake.llm.common import WHITE, ascii_lower, scratch_path, shuffle_partitions, written

MIN_CHARS = 20
MIN_DOCS = 3
KEY = ["h1", "h2"]


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, th, keys): a row per document with the keys of its lines, in
    order; a key that is too short is null.  ``th`` is the hash of the whole
    text: with doc_id it names a row."""
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    keys = F.transform(F.split(ascii_lower(F.col("_t")), "\n", -1),
                       lambda x: F.btrim(x, F.lit(WHITE)))
    return d.select("doc_id", F.xxhash64("_t").alias("th"),
                    F.transform(keys, lambda k: F.when(F.length(k) >= min_chars, k)).alias("keys"))


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, th, pos, h1, h2): every line whose key is long enough."""
    return (_lines(docs, min_chars).select("doc_id", "th", F.posexplode("keys").alias("pos", "key"))
            .where(F.col("key").isNotNull()).select("doc_id", "th", "pos", *_hashed(F.col("key"))))


class LineRuns:
    """The levelled runs of a corpus that grows batch by batch."""

    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS):
        self.spark, self.min_chars = spark, min_chars
        self.buckets = shuffle_partitions(spark)
        self.levels: list[DataFrame | None] = []

    def _write(self, run: DataFrame) -> DataFrame:
        # The aggregate or join above is hashed by KEY into `buckets` partitions
        # already, so each bucket is one sorted file and no shuffle is added.
        name = f"nutrilake_run_{uuid.uuid4().hex}"
        (run.write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", scratch_path(self.spark, "run")).saveAsTable(name))
        return self.spark.table(name)

    @staticmethod
    def _merge(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.select(*KEY, F.col("n_docs").alias("n2"), F.col("keeper").alias("k2"))
        return a.join(b, KEY, "full").select(
            *KEY, (F.coalesce("n_docs", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n_docs"),
            F.greatest("keeper", "k2").alias("keeper"))

    def add(self, docs: DataFrame) -> None:
        """Add a batch: its keys, counted once per row of ``docs``, become a
        run at level 0; full levels are compacted into the next."""
        keys = F.array_compact(F.array_distinct("keys"))
        own = (_lines(docs, self.min_chars).select("doc_id", F.explode(keys).alias("key"))
               .select("doc_id", *_hashed(F.col("key"))).groupBy(*KEY)
               .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper")))
        run, level = self._write(own), 0
        while level < len(self.levels) and self.levels[level] is not None:
            run, self.levels[level] = self._write(self._merge(self.levels[level], run)), None
            level += 1
        if level == len(self.levels):
            self.levels.append(None)
        self.levels[level] = run

    def novel_lines(self, docs: DataFrame) -> DataFrame:
        """The lines of a new batch that no run holds: one anti-join per run."""
        lines = line_keys(docs, self.min_chars)
        for run in self.levels:
            if run is not None:
                lines = lines.join(run.select(*KEY), KEY, "left_anti")
        return lines.select("doc_id", "th", "pos", *KEY)

    def total(self) -> DataFrame:
        """All runs merged into one table of counts."""
        runs = [r for r in self.levels if r is not None]
        if not runs:
            return self.spark.createDataFrame([], "h1 long, h2 long, n_docs long, keeper long")
        whole = runs[0]
        for run in runs[1:]:
            whole = self._merge(whole, run)
        return whole


def drop_common_lines(docs: DataFrame, runs: LineRuns, min_docs: int = MIN_DOCS) -> DataFrame:
    """Drop from ``docs`` the lines whose key at least ``min_docs`` documents
    of the runs hold, except in the largest doc_id holding it.

    Every column of ``docs`` stays, ``text`` being what is left; added are
    n_lines and n_dropped.  A null or empty text is one empty line.  Rows are
    documents: repeated rows count each, and rows that share the largest
    doc_id all keep the line.  A null doc_id ranks below every other.
    Only keys that are common enough meet the lines again, in a join whose hot
    keys Spark can split; dropped places return to the texts by doc_id.
    """
    common = written(runs.total().where(F.col("n_docs") >= min_docs).select(*KEY, "keeper"), "common")
    dropped = (line_keys(docs, runs.min_chars).join(common, KEY)
               .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
               .groupBy(F.col("doc_id").alias("_ld_id"), F.col("th").alias("_ld_th"))
               .agg(F.collect_set("pos").alias("_ld_pos")))
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.join(dropped, docs["doc_id"].eqNullSafe(dropped["_ld_id"])
                  & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == dropped["_ld_th"]), "left")
    d = d.withColumn("_ld_lines", F.split(text, "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), F.col("_ld_pos"))
    rest = F.array_join(F.transform(left, lambda i: F.get("_ld_lines", i)), "\n")
    same = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    return d.select(*same, F.when(F.col("_ld_pos").isNull(), text).otherwise(rest).alias("text"),
                    F.size("_ld_lines").cast("long").alias("n_lines"),
                    F.coalesce(F.size(F.col("_ld_pos")), F.lit(0)).cast("long").alias("_n"),
                    ).withColumn("n_dropped", F.greatest(F.col("_n"), F.lit(0))).drop("_n")


def dedup_lines(docs: DataFrame, batches: list[DataFrame] | None = None,
                min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Index ``docs`` batch by batch (together the batches are ``docs``; one
    batch if none are given), then drop the common lines."""
    runs = LineRuns(docs.sparkSession, min_chars)
    for batch in batches or [docs]:
        runs.add(batch)
    return drop_common_lines(docs, runs, min_docs)


def file_batches(spark: SparkSession, path: str, n: int = 4) -> list[DataFrame]:
    """A Parquet table as up to ``n`` batches of whole files, each file in one."""
    files = sorted(spark.read.parquet(path).inputFiles())
    size = max(1, -(-len(files) // n))
    return [spark.read.parquet(*files[i:i + size]) for i in range(0, len(files), size)]
