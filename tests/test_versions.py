import threading

import pytest

from nutrilake.sources.versions import VersionedStore, published_folder


@pytest.fixture
def store(spark, tmp_path):
    return VersionedStore(spark, str(tmp_path / "artifact"))


def writer(spark, value):
    return lambda folder: spark.range(value, value + 1).write.parquet(folder + "/part")


def value(spark, folder):
    return [r[0] for r in spark.read.parquet(folder + "/part").collect()]


def test_newest_version_is_read_and_old_ones_stay(spark, store):
    assert store.publish(writer(spark, 7), "first") == 1
    held = store.folder()
    assert store.publish(writer(spark, 8)) == 2
    assert value(spark, store.folder()) == [8] and value(spark, held) == [7]
    assert value(spark, store.folder(1)) == [7]
    assert [(r["version"], r["note"], r["is_current"]) for r in store.history().orderBy("version").collect()] == \
        [(1, "first", False), (2, "", True)]


def test_broken_write_leaves_the_old_version(spark, store):
    store.publish(writer(spark, 7))

    def broken(folder):
        writer(spark, 9)(folder)
        raise OSError("executor lost")

    with pytest.raises(OSError, match="executor lost"):
        store.publish(broken)
    assert store.numbers() == [1] and value(spark, store.folder()) == [7]
    assert store.publish(writer(spark, 10)) == 2


def test_writer_without_output_is_refused(store):
    with pytest.raises(ValueError, match="no version folder"):
        store.publish(lambda folder: None)
    assert store.numbers() == []


def test_a_taken_number_is_never_replaced(spark, store):
    store.publish(writer(spark, 1))
    seen = store.numbers
    store.numbers = lambda: []           # a writer that listed before the other committed
    assert store.publish(writer(spark, 2)) == 2
    store.numbers = seen
    assert value(spark, store.folder(1)) == [1] and value(spark, store.folder(2)) == [2]


def test_concurrent_writers_all_commit(spark, tmp_path):
    path, got = str(tmp_path / "many"), []
    threads = [threading.Thread(target=lambda i=i: got.append(VersionedStore(spark, path).publish(writer(spark, i))))
               for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    store = VersionedStore(spark, path)
    assert sorted(got) == store.numbers() == [1, 2, 3, 4]
    assert sorted(value(spark, store.folder(n))[0] for n in got) == [0, 1, 2, 3]


def test_rollback_and_absent_versions(spark, store):
    with pytest.raises(FileNotFoundError):
        store.folder()
    assert published_folder(spark, store.path) == store.path     # no store yet: the folder itself
    store.publish(writer(spark, 1))
    store.publish(writer(spark, 2))
    assert store.rollback(1) == 3
    assert value(spark, published_folder(spark, store.path)) == [1]
    with pytest.raises(FileNotFoundError):
        store.folder(9)
