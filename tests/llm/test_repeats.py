import hashlib
import random
from collections import Counter

import pytest

from nutrilake.llm import repeats

N = repeats.LENGTH


def brute(rows):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[p:p + N] for _, b in data for p in range(len(b) - N + 1))
    out = []
    for d, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - N + 1):
            if seen[b[p:p + N]] > 1:
                gone[p:p + N] = b"\1" * N
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    out = []
    for r in df.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
        out.append((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows(words):
    rng, out = random.Random(9), []
    passages = [words(100 + i, n) for i, n in enumerate((55, 61, 64, 68, 75, 120))]
    passages += [words(200, 90)[:N], words(201, 90)[:N - 1], words(202, 90)[:N + 1], "éü" * 250]
    for i in range(60):
        text = words(i, rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            text += rng.choice(["", " ", "\n"]) + rng.choice(passages) + words(1000 + i, rng.randint(0, 40))
        out.append(text)
    base = words(5000, 900)
    for i in range(6):                                      # near copies with edits at chance places
        copy = list(base)
        for _ in range(5):
            copy[rng.randrange(len(copy))] = "#"
        out.append("".join(copy))
    out += ["", None, "a" * 399, "b" * 400, "c" * 401, "d" * 3000, "ab" * 700, words(1, 300), words(1, 300),
            passages[5] + "X" + passages[5]]
    rng.shuffle(out)
    return list(enumerate(out)) + [(None, out[0]), (3, out[3]), (3, words(77, 400))]


def test_against_brute_force(make_docs, rows):
    assert result(repeats.remove_repeats(make_docs(rows))) == brute(rows)


def test_long_texts_in_parts(make_docs, rows, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 700)
    assert result(repeats.remove_repeats(make_docs(rows))) == brute(rows)


def test_empty_table_and_no_repeats(make_docs, words):
    assert repeats.remove_repeats(make_docs([])).count() == 0
    rows = [(1, words(1, 200)), (2, "short"), (3, None)]
    assert result(repeats.remove_repeats(make_docs(rows).withColumnRenamed("source", "runs"))) == brute(rows)
