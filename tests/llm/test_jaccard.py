import random

import pytest

from nutrilake.llm import jaccard
from nutrilake.llm.components import components


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def groups_of(rows):
    """The rows of every component, as lists of their places."""
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return list(groups.values())


def brute(rows):
    return sorted(((rows[i][0], len(shingles(rows[i][1])), min((rows[j][0] for j in own if rows[j][0] is not None), default=None))
                   for own in groups_of(rows) for i in own), key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows(words):
    rng, rows = random.Random(4), []
    passage = words(999, 60)
    for i in range(40):                                  # families of near copies, around the threshold
        base = words(i, rng.randint(5, 300)).split(" ")
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(copy) // 25))):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(9))
            rows.append(" ".join(copy))
    for i in range(60):                                  # a passage that many documents share
        rows.append(words(2000 + i, rng.randint(2, 30)) + " " + passage + " " + words(3000 + i, rng.randint(0, 12)))
    chain = words(50_000, 200).split(" ")
    for i in range(12):                                  # a chain: each near the next, the ends far apart
        chain = chain[8:] + words(60_000 + i, 8).split(" ")
        rows.append(" ".join(chain))
    rows += ["", None, " \n\t ", "one", "ONE", "one two", "two one", "a b c d e", "A\tb\nc  d e", "x " * 500, "x " * 5]
    rng.shuffle(rows)
    return [(1000 + 3 * i, t) for i, t in enumerate(rows)] + [(None, rows[0]), (1000, rows[0]), (1000, "another row of the id")]


def test_against_brute_force(make_docs, rows):
    assert result(jaccard.similar_documents(make_docs(rows))) == brute(rows)


def test_one_per_component(make_docs, rows):
    docs = make_docs(rows).withColumnRenamed("lang", "label").withColumnRenamed("source", "component_id")
    kept = jaccard.one_per_component(docs)
    assert kept.columns == docs.columns
    # One row of every component, with its smallest id; rows without words are components of their own.
    got = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert got == sorted((min((rows[i][0] for i in own if rows[i][0] is not None), default=None)
                          for own in groups_of(rows)), key=repr)


def test_one_row_of_every_component_whatever_its_ids(make_docs, words):
    a, b, c, d, e = (words(80_000 + i, 60) for i in range(5))
    rows = [(None, a), (None, b), (None, b + " end"), (None, c), (7, c + " end"),     # null ids: a, b unlinked
            (5, d), (5, e), (5, e), (5, e + " end"), (9, e), (None, ""), (None, None)]  # one id, unlinked texts
    kept = sorted(((r.doc_id, r.text) for r in jaccard.one_per_component(make_docs(rows)).collect()), key=repr)
    ids = [k for k, t in kept if t]
    assert sorted(ids, key=repr) == [5, 5, 7, None, None]
    texts = {t for k, t in kept if t}
    assert {a, d, c + " end"} <= texts and len(texts & {b, b + " end"}) == len(texts & {e, e + " end"}) == 1
    assert [k for k, t in kept if not t] == [None, None]


def test_empty_table(make_docs):
    assert jaccard.similar_documents(make_docs([])).count() == 0
    assert jaccard.one_per_component(make_docs([])).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    random.Random(0).shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}


def test_dense_sketch_bounds_the_difference(words):
    import numpy as np

    from nutrilake.llm.shingles import shingle_sets
    rng = random.Random(2)
    for i in range(30):
        a = words(i, 120).split(" ")
        b = list(a)
        for _ in range(rng.randint(0, 6)):
            b[rng.randrange(len(b))] = "new"
        x, y = shingle_sets([" ".join(a), " ".join(b)])
        difference = len(np.setxor1d(x, y))
        p, q = jaccard._dense(x), jaccard._dense(y)
        n = min(len(p), len(q))
        fold = lambda d: d if len(d) == n else d[:n] ^ d[n:]
        assert sum(int(v).bit_count() for v in (fold(p) ^ fold(q)).view(np.uint64)) <= difference
