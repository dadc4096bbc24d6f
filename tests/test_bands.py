import random

import pytest

from nutrilake.operators import bands


def _brute(rows):
    cells = {}
    for v, c in rows:
        if v is not None:
            own = cells.setdefault(v, {})
            own[c] = own.get(c, 0) + 1
    out = []
    for v in sorted(cells):
        best = min(cells[v], key=lambda c: (-cells[v][c], c is not None, c or ""))
        n = sum(cells[v].values())
        if out and out[-1][2] == best:
            out[-1][1], out[-1][3], out[-1][4] = v, out[-1][3] + n, out[-1][4] + n - cells[v][best]
        else:
            out.append([v, v, best, n, n - cells[v][best]])
    return [tuple(r) for r in out]


@pytest.mark.parametrize("kind", ["noise", "bands", "one", "empty"])
@pytest.mark.parametrize("parts", ["1", "7"])
def test_equals_brute_force(spark, kind, parts):
    rng = random.Random(5)
    label = {"noise": lambda v: rng.choice(["a", "b", None]), "bands": lambda v: "abc"[int(v) // 100 % 3],
             "one": lambda v: "a", "empty": None}[kind]
    rows = []
    if label:
        rows = [(v, label(v)) for v in (rng.randrange(600) / 2 for _ in range(900))] + [(None, "a"), (7.0, None)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, "`x.y` double, Health_Status string")
        got = bands.label_bands(df, "x.y")
        assert [tuple(r) for r in got.orderBy("low").collect()] == _brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_runs_meet_across_many_tasks(spark):
    """Bands longer than a task, and one that a single task holds whole."""
    rows = [(float(i), "a" if i < 500 or i > 520 else "b") for i in range(2000)]
    df = spark.createDataFrame(rows, "x double, Health_Status string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in bands.label_bands(df, "x").orderBy("low").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got == _brute(rows) and len(got) == 3


def test_nan_is_the_last_value(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "a"), (2.0, "b")], "x double, Health_Status string")
    got = bands.label_bands(df, "x").orderBy("low").collect()
    assert [(repr(r["low"]), r["label"]) for r in got] == [("1.0", "a"), ("2.0", "b"), ("nan", "a")]
