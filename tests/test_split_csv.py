"""CSV read in splits against the reader that takes a whole file in one task."""
import random

import pytest

from nutrilake.sources import loader
from nutrilake.sources.split_csv import read_records, read_split_csv


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def _field(rng):
    text = "".join(rng.choice(['x', 'é', ' ', ',', '"', '\n', '7', 'NA']) for _ in range(rng.choice([0, 1, 3, 9, 60])))
    if any(c in text for c in ',"\n') or rng.random() < 0.2:
        return '"' + text.replace('"', '""') + '"'
    return text


@pytest.mark.parametrize("split_bytes", [151, 1 << 20])
def test_equals_the_whole_file_reader(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    for f in range(3):
        body = "".join(",".join(["k%d" % i, _field(rng), _field(rng)]) + "\n" for i in range(40))
        (tmp_path / f"part{f}.csv").write_text('id,"b ""b""",c.d\n' + body)
    got = read_split_csv(spark, str(tmp_path), split_bytes)
    want = loader.read_raw_csv(spark, str(tmp_path))
    assert got.columns == want.columns == ["id", 'b "b"', "c.d"]
    assert _rows(got) == _rows(want) and got.count() == 120
    assert got.sparkSession is spark


def test_a_file_takes_several_tasks(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n" + "".join(f'{i},"line\n{i}"\n' for i in range(100)))
    path = str(tmp_path / "one.csv")
    records = read_records(spark, path, 200)
    assert records.select("block").distinct().count() > 5 and records.count() == 101
    placed = read_split_csv(spark, path, 200, keep_position=True)
    assert [r["a"] for r in placed.orderBy(loader.SOURCE_POSITION).collect()] == [str(i) for i in range(100)]


def test_record_over_many_splits_and_odd_ends(spark, tmp_path):
    long = "\n".join("word " * 20 for _ in range(60))
    (tmp_path / "t.csv").write_text(f'a,b\n1,"{long}"\n\n2,\n3,x,surplus\n4\n5,"open to the\nend')
    for split_bytes in (400, 1 << 20):
        assert _rows(read_split_csv(spark, str(tmp_path / "t.csv"), split_bytes)) == _rows(
            loader.read_raw_csv(spark, str(tmp_path / "t.csv")))


def test_windows_line_ends_and_no_rows(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2,z\r\n')
    assert _rows(read_split_csv(spark, str(tmp_path / "w.csv"), 8)) == ["('1', 'x\\r\\ny')", "('2', 'z')"]
    (tmp_path / "h.csv").write_text("a,b\n")
    empty = read_split_csv(spark, str(tmp_path / "h.csv"))
    assert empty.columns == ["a", "b"] and empty.count() == 0
    with pytest.raises(loader.DataLoadError, match="nowhere"):
        read_split_csv(spark, str(tmp_path / "nowhere.csv"))
