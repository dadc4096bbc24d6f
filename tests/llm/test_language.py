import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nutrilake.llm import language

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("score", T.StringType())])
STEMS = {"aa": "ka to mi ra so", "bb": "strel vlk prst zim hrad", "cc": "eau oui ère çon lle"}


def prose(lang, seed, n):
    rng = random.Random(f"{lang}{seed}")
    stems = STEMS[lang].split()
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n)).capitalize()


def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(600):
        lang = ("aa", "aa", "aa", "bb", "bb", "cc")[i % 6]
        rows.append((i, prose(lang, i, rng.randint(2, 60)), lang, "x"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3) if rows else spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def predicted(spark):
    extra = [(1000, None, "aa", "x"), (1001, "", "bb", "x"), (1002, "12 -- 34 !", None, "x"), (None, prose("bb", 5, 40), "aa", "x"),
             (0, prose("aa", 0, 30), None, "x"), (1003, prose("cc", 9, 300_000), None, "x"), (1004, "q", None, "x")]
    rows = corpus() + extra
    out = language.identify_language(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score", "held_out"]
    return rows, out.select("doc_id", "lang", "lang_pred", "score", "held_out").collect()


def test_held_out_accuracy(predicted):
    rows, out = predicted
    assert len(out) == len(rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out and r.doc_id < 600 and r.lang]
    assert len(held) > 80 and sum(r.lang_pred == r.lang for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_edges(predicted):
    _, out = predicted
    by_id = {r.doc_id: r for r in out if r.doc_id != 0}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1000, 1001, 1002))
    assert by_id[None].lang_pred == "bb" and not by_id[None].held_out
    assert by_id[1003].lang_pred == "cc" and by_id[1003].score > 0.9
    assert by_id[1004].lang_pred in STEMS and by_id[1004].score < by_id[1003].score


def test_what_is_learned_from(spark):
    """Held-out rows, null ids and null languages teach nothing: with other labels and texts there, nothing changes."""
    rows = corpus()
    noise = [(i, prose("cc", 1, 50), "zz", "x") for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    noise += [(None, prose("aa", 2, 50), "zz", "x"), (7, prose("bb", 2, 50), None, "x")]
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    a = language.fit_language(frame(spark, learned))
    b = language.fit_language(frame(spark, learned + noise))
    assert a.languages == b.languages == ["aa", "bb", "cc"]
    assert np.allclose(a.bias, b.bias) and np.allclose(a.per_gram, b.per_gram) and np.isclose(a.temperature, b.temperature)


def test_nothing_or_one_language_to_learn(spark):
    none = language.identify_language(frame(spark, [(1, "abc", None, "x"), (2, None, "aa", "x")])).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)] * 2
    one = language.identify_language(frame(spark, [(i, f"abc {i}", "aa", "x") for i in range(9)] + [(20, "77", None, "x")])).collect()
    assert {(r.lang_pred, r.score) for r in one if r.doc_id < 20} == {("aa", 1.0)}
    assert [(r.lang_pred, r.score) for r in one if r.doc_id == 20] == [("und", 0.0)]
    assert language.identify_language(frame(spark, [])).count() == 0


def test_sample_is_bounded_by_rows(spark):
    rows = [(1, prose("aa", 1, 20), "aa", "x")] * 3000 + [(i, prose("bb", i, 20), "bb", "x") for i in range(2, 400)]
    model = language.fit_language(frame(spark, rows), max_rows=100)
    assert model.languages == ["aa", "bb"]
    assert language.even_shares([5, 1000, 1000], 100) == [5, 47, 48] and language.even_shares([3, 4], 100) == [3, 4]


def test_chunks_count_every_occurrence_once(monkeypatch):
    from collections import Counter
    texts = ["abcdefghij" * 5, "", "zz", "é" * 9]

    def grams():
        return Counter((int(r), int(g)) for rows, mixed in language.occurrences(texts, (1, 2, 4)) for r, g in zip(rows, mixed))

    whole = grams()
    assert sum(whole.values()) == sum(len(t) + 2 - n + 1 for t in texts for n in (1, 2, 4) if len(t) + 2 >= n)
    monkeypatch.setattr(language, "CHUNK", 7)
    assert grams() == whole


def test_vocabulary_finds_exactly_its_grams():
    rng = np.random.default_rng(2)
    grams = np.unique(np.append(rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2), np.uint64(0)))
    crowded = np.unique(np.append(grams, np.arange(1, 40, dtype=np.uint64)))
    asked = np.append(crowded, rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    place, feature = language.Vocabulary(crowded, (1,)).find(asked)
    assert (crowded[feature] == asked[place]).all() and len(place) == np.isin(asked, crowded).sum()


def test_ftrl_weights_match_the_formula_and_are_sparse():
    z, n = np.array([[0.01, -0.5, 2.0]]), np.array([[1.0, 4.0, 9.0]])
    want = [[0.0, (0.5 - language.L1) / ((language.BETA + 2) / language.ALPHA + language.L2),
             -(2.0 - language.L1) / ((language.BETA + 3) / language.ALPHA + language.L2)]]
    assert np.allclose(language._weights(z, n), want)


def test_temperature_recovers_a_known_scale():
    rng = np.random.default_rng(1)
    margin = rng.normal(size=(4000, 3)) * 2
    p = language._softmax(margin)
    label = np.array([rng.choice(3, p=row) for row in p])
    found = language.fit_temperature(margin * 5, label, np.zeros(3), np.ones(len(label)))
    assert 4.3 < found < 5.8
