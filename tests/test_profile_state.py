import numpy as np
import pandas as pd
import pytest

from nutrilake.operators.profile_state import ProfileState, cardinality_error, rank_error
from nutrilake.streaming.baseline import start_baseline_stream

SCHEMA = "v double, i int, s string, c int, none double, b boolean"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.RandomState(11)
    rows = [(float(x), int(i), f"t{i % 977}", 7, None, bool(i % 3))
            for x, i in zip(rng.gamma(2.0, 3.0, 6000), rng.randint(0, 4000, 6000))]
    rows += [(None, None, None, 7, None, None), (float("nan"), 1, "", 7, None, True), (-0.0, 2, "é", 7, None, True), (0.0, 2, "é", 7, None, True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def by_column(df):
    return {r["Column"]: r for r in df.collect()}


def test_against_pandas(table, tmp_path):
    state = ProfileState.create(table, str(tmp_path / "p")).add(table, 0)
    got, pdf = by_column(state.profile()), table.toPandas()
    v = pd.Series([x for x in pdf["v"] if x is not None and x == x])
    assert got["v"]["Missing"] == 2 and got["v"]["Rows"] == 6004
    assert got["v"]["Skewness"] == pytest.approx(v.skew(), rel=1e-9)
    assert got["v"]["Mean"] == pytest.approx(v.mean(), rel=1e-12)
    assert got["v"]["Min"] == v.min() and got["v"]["Max"] == v.max()
    for c, exact in (("v", v.nunique()), ("i", pdf["i"].nunique()), ("s", pdf["s"].nunique()), ("b", 2), ("c", 1), ("none", 0)):
        assert abs(got[c]["Cardinality"] - exact) <= 4 * cardinality_error() * exact
    for p, q in zip((0.25, 0.5, 0.75), got["v"]["Quartiles"]):
        assert (v < q).mean() - 2 * rank_error() <= p <= (v <= q).mean() + 2 * rank_error()
    q1, _, q3 = got["v"]["Quartiles"]
    out = ((v < q1 - 1.5 * (q3 - q1)) | (v > q3 + 1.5 * (q3 - q1))).mean()
    assert abs(got["v"]["Pct_Outliers"] / 100 - out) <= 4 * rank_error()
    assert (got["s"]["Min_Text"], got["s"]["Max_Text"]) == ("", "é") and got["s"]["Quartiles"] is None
    assert got["c"]["Constant"] and got["none"]["Constant"] and not got["b"]["Constant"]
    assert got["none"]["Mean"] is None and got["none"]["Quartiles"] is None and got["none"]["Pct_Missing"] == 100.0


def test_union_of_states_equals_one_pass(table, tmp_path):
    one = by_column(ProfileState.create(table, str(tmp_path / "one")).add(table, 0).profile())
    state = ProfileState.create(table, str(tmp_path / "many"))
    parts = table.randomSplit([0.1, 0.6, 0.3], seed=5)
    for batch_id, part in enumerate(parts):
        state.add(part, batch_id)
    state.add(parts[1], 1)                       # replayed
    state.add(table.limit(0), 9)                 # nothing
    many = by_column(ProfileState.load(table.sparkSession, str(tmp_path / "many")).profile())
    assert list(one) == list(many)
    for c, a in one.items():
        b = many[c]
        for key in ("Type", "Rows", "Missing", "Pct_Missing", "Constant", "Min", "Max", "Min_Text", "Max_Text"):
            assert a[key] == b[key], (c, key)
        # a union's estimate may differ from that of a sketch fed in one go, within the error of either
        assert abs(a["Cardinality"] - b["Cardinality"]) <= 4 * cardinality_error() * a["Cardinality"]
        for key in ("Mean", "Skewness"):
            assert a[key] == b[key] or a[key] == pytest.approx(b[key], rel=1e-9), (c, key)
    some = by_column(state.profile(batches=[0, 2]))
    assert some["c"]["Rows"] == parts[0].count() + parts[2].count()


def test_small_sketch_is_exact_and_fences_exclude_their_value(spark, tmp_path):
    df = spark.createDataFrame([(float(x),) for x in [10] * 4 + [12] * 4 + [7, 15, 6.9, 15.1]], "x double")
    r = ProfileState.create(df, str(tmp_path / "p")).add(df, 0).profile().first()
    assert r["Quartiles"][0] == 10.0 and r["Quartiles"][2] == 12.0
    assert r["Pct_Outliers"] == round(2 / 12 * 100, 2)


def test_stream_feeds_the_state(spark, table, tmp_path):
    table.repartition(3).write.parquet(str(tmp_path / "in"))
    state = ProfileState.create(table, str(tmp_path / "state"))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    start_baseline_stream(stream, state, str(tmp_path / "ck")).awaitTermination()
    assert state.states().select("batch_id").distinct().count() == 3
    assert by_column(state.profile())["v"]["Rows"] == 6004


def test_errors_and_extra_columns(spark, table, tmp_path):
    with pytest.raises(FileNotFoundError):
        ProfileState.load(spark, str(tmp_path / "absent"))
    state = ProfileState.create(table, str(tmp_path / "p"))
    with pytest.raises(FileNotFoundError):
        state.profile()
    with pytest.raises(ValueError, match="lacks"):
        state.add(table.drop("i"), 0)
    wide = table.selectExpr("*", "1 AS _merge_task", "2 AS n", "3 AS `column`")
    assert state.add(wide, 0).profile().count() == len(table.columns)
    empty = ProfileState.create(table, str(tmp_path / "e")).add(table.limit(0), 0)
    assert empty.profile().count() == 0
