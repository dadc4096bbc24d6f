import random
import zlib

import pytest
from pyspark.sql import types as T

from nutrilake.llm import toxicity

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()),
                       T.StructField("toxic", T.IntegerType())])


def corpus(words, n=900):
    rng, rows, labels = random.Random(1), [], []
    for i in range(n):
        text, bad = words(i, rng.randint(5, 200)).split(" "), i % 5 == 0
        if bad:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(["Worzlefink", "gribblesnot", "zunkhead"]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def scored(make_docs, spark, words):
    rows, labels = corpus(words)
    rows += [(5000, None), (5001, ""), (None, "zunkhead gribblesnot zunkhead"), (0, rows[0][1])]
    labels += [(None, 1, 1), (1, 1, None), (2, 1, 0), (2, 1, 0)]
    docs = make_docs(rows)
    out = toxicity.score_toxicity(docs, spark.createDataFrame(labels, LABELS))
    return rows, [r.asDict() for r in out.collect()]


def test_held_out_accuracy(scored):
    _, out = scored
    held = [r for r in out if r["held_out"] and r["doc_id"] < 5000]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    right = sum(r["predicted"] == int(r["doc_id"] % 5 == 0) for r in held)
    assert right >= 0.97 * len(held) and len(held) > 100


def test_edges(scored):
    rows, out = scored
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[5000]["score"] == by_id[5001]["score"] < toxicity.THRESHOLD
    assert by_id[None]["predicted"] == 1 and by_id[None]["held_out"] is False
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)


def test_whole_texts_count(make_docs, spark, words):
    rows, labels = corpus(words)
    model = toxicity.fit_toxicity(make_docs(rows), spark.createDataFrame(labels, LABELS))
    long_text = words(77, 120_000)
    late = make_docs([(1, long_text + " zunkhead gribblesnot worzlefink"), (2, long_text)])
    score = {r.doc_id: r.score for r in model.score(late).collect()}
    assert score[1] > score[2]


def test_no_labels_and_empty_tables(make_docs, spark):
    none = spark.createDataFrame([], LABELS)
    out = toxicity.score_toxicity(make_docs([(1, "x"), (2, None)]), none).collect()
    assert [r.score for r in out] == [0.5, 0.5]
    assert toxicity.score_toxicity(make_docs([]), none).count() == 0


def test_long_text_chunks_lose_no_gram(monkeypatch):
    import numpy as np
    texts = ["abcdefghijklmnopqrstuvwxyz" * 3, "", "zz"]
    whole = [np.unique(np.concatenate([m[ok] for c in toxicity._chunks([t], 6) for *_, ok, m in toxicity._grams(c, toxicity.ORDERS)] or [np.zeros(0)]))
             for t in texts]
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    parts = [np.unique(np.concatenate([m[ok] for c in toxicity._chunks([t], 6) for *_, ok, m in toxicity._grams(c, toxicity.ORDERS)] or [np.zeros(0)]))
             for t in texts]
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_rare_toxic_rows_are_all_in_the_sample(make_docs, spark, words):
    texts = [words(90_000 + i, 30) + (" zyx vuzzle qwrt" if i % 50 == 0 else "") for i in range(2000)]
    labels = spark.createDataFrame([(i, int(i % 50 == 0)) for i in range(2000)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(make_docs(list(enumerate(texts))), labels, max_rows=200)
    new = make_docs([(5000, words(1, 30) + " zyx vuzzle qwrt"), (5001, words(2, 30))])
    score = {r.doc_id: r.score for r in model.score(new).collect()}
    assert score[5000] >= toxicity.THRESHOLD > score[5001]


def test_hash_cut_of_any_corpus():
    for total in (1, 16_000, 10**6, 10**11, 10**15):
        taken = toxicity.hash_cut(min(16_000, total), total) + (1 << 63) + 1
        assert abs(taken * total / 2**64 - min(16_000, total)) < 1
    assert toxicity.sample_sizes(5, 10**9, 100) == (5, 95) and toxicity.sample_sizes(10**9, 10, 100) == (90, 10)
    assert toxicity.sample_sizes(10**9, 10**9, 100) == (50, 50) and toxicity.sample_sizes(3, 4, 100) == (3, 4)
