import hashlib
import math

from nutrilake.llm import mixing


def targets(sizes, weights=(1, 2, 3), rate=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, budget, free = {}, float(sum(sizes.values())), set(order)
    while free:
        level = budget / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > rate * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = float(rate * sizes[s])
        budget -= sum(out[s] for s in over)
        free -= over
    return out


def rows(words):
    out = [(i, words(i, 5 + i % 60), ["b", "a", "é", None, "", "tiny"][min(i % 7, 4)]) for i in range(300)]
    return out + [(1000, "one two three", "tiny"), (1001, None, "a"), (1002, "", "empty"), (None, "x y", "b"), (3, words(3, 8), "b")]


def test_plan_against_brute_force(make_docs, words):
    data = rows(words)
    sizes = {}
    for _, text, source in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = targets(sizes)
    plan = mixing.plan_mix(make_docs(data)).collect()
    assert len(plan) == len(data)
    for r in plan:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12)
        rate = r.target / r.source_size if r.source_size else 0
        u = int(hashlib.md5(f"7:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / 2 ** 52
        assert r.copies == math.floor(rate) + (u < rate - math.floor(rate)) <= 3
    for source in ("a", "b", "é", None, ""):
        taken = sum(r["size"] * r.copies for r in plan if r.source == source)
        assert abs(taken - want[source]) <= 0.3 * want[source]


def test_documents_are_emitted_as_planned(make_docs, words):
    docs = make_docs(rows(words)).withColumnRenamed("lang", "rate").withColumnRenamed("n_chars", "target")
    first = sorted(map(repr, mixing.mix_documents(docs).collect()))
    assert first == sorted(map(repr, mixing.mix_documents(docs).collect()))
    assert mixing.mix_documents(docs).columns == docs.columns
    assert len(first) == sum(r.copies for r in mixing.plan_mix(docs).collect())


def test_no_words_at_all(make_docs):
    assert mixing.plan_mix(make_docs([])).count() == 0
    assert [r.copies for r in mixing.plan_mix(make_docs([(1, None), (2, "")])).collect()] == [0, 0]
    assert mixing.mix_documents(make_docs([])).count() == 0
