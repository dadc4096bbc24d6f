import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) tuples, over a few partitions."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC).repartition(3) if full else spark.createDataFrame([], DOC)
    return make


@pytest.fixture(scope="session")
def words():
    """A seeded maker of prose: words(seed, n) gives n invented words."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))
    return make
