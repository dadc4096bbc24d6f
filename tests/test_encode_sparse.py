import random

import pytest
from pyspark.sql import functions as F

from nutrilake.operators.encode import Encoder
from nutrilake.operators.encode_sparse import SparseEncoder, SparseEncoderModel


def _dense(row, size):
    out = [0.0] * size
    for i, v in zip(row["indices"], row["values"]):
        out[i] = v
    return out


def test_equals_the_dense_encoder_also_after_a_reload(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, 1.5, 2.0, 7.25]), 4.0, rng.choice(["b", "a", None, "é", ""]), rng.choice("zyxw"))
            for i in range(200)]
    df = spark.createDataFrame(rows, "_keep0 int, x double, `c.d` double, g string, `h i` string").repartition(3)
    train = df.where("_keep0 < 150")
    seen = df.withColumn("g", F.when(F.col("_keep0") % 9 == 0, "new").otherwise(F.col("g")))
    cols = (["x", "c.d"], ["h i", "g"])
    model = SparseEncoder(*cols).fit(train)
    plain = train.withColumnRenamed("c.d", "cd")
    dense = Encoder(["x", "cd"], cols[1]).fit(plain)
    assert model.size == len(dense.feature_names())
    assert [tuple(r) for r in model.categories(spark).orderBy("place").collect()] == [
        (c, v, 2 + i) for i, (c, v) in enumerate((c, v) for c in cols[1] for v in dense.categories[c])]
    want = {r[0]: list(r[1:]) for r in dense.transform(seen.withColumnRenamed("c.d", "cd"), ["_keep0"]).collect()}
    model.save(spark, str(tmp_path / "m"))
    for m in (model, SparseEncoderModel.load(spark, str(tmp_path / "m"))):
        out = m.transform(seen, keep=["_keep0"])
        assert out.columns == ["_keep0", "indices", "values"]
        got = out.collect()
        assert {r[0]: _dense(r, m.size) for r in got} == want
        assert all(r["indices"] == sorted(set(r["indices"])) for r in got)


def test_a_million_categories(spark, monkeypatch):
    from nutrilake.operators import encode_sparse
    n = 1_000_000
    df = spark.range(n).select("id", F.concat(F.lit("c"), F.col("id")).alias("c"), F.lit("one").alias("d"))
    model = SparseEncoder([], ["c", "d"]).fit(df)
    assert model.widths == [n, 1] and model.size == n + 1
    for limit in (n, 10):       # broadcast, then a join by category
        monkeypatch.setattr(encode_sparse, "BROADCAST_MAX_ROWS", limit)
        got = model.transform(df, ["id"]).agg(
            F.count_distinct(F.col("indices")[0]), F.min(F.col("indices")[0]), F.max(F.col("indices")[0]),
            F.min(F.col("indices")[1]), F.sum(F.size("values"))).first()
        assert tuple(got) == (n, 0, n - 1, n, 2 * n)


def test_edges(spark):
    with pytest.raises(RuntimeError, match="fitted"):
        SparseEncoder().transform(None)
    df = spark.createDataFrame([], "x double, g string, id int")
    model = SparseEncoder(["x"], ["g"]).fit(df)
    assert model.size == 1 and model.widths == [0]
    row = model.transform(spark.createDataFrame([(2.0, "a", 1)], df.schema), ["id"]).first()
    assert row["indices"] == [0] and row["values"] == [None]
    assert SparseEncoder(["x"], []).fit(df).transform(df, ["id"]).count() == 0
    with pytest.raises(ValueError, match="missing"):
        model.transform(df.drop("g"))
    with pytest.raises(ValueError, match="names of the result"):
        model.transform(df.withColumn("values", F.lit(1)), ["values"])
