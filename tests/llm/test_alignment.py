import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from nutrilake.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = ["Hello world, this is a test of alignment.", "", None, " ", "\n\n\t x", "naïve café — 日本語 \U0001F600",
         "a▁b is not restored", "<|endoftext|> and <s> </s> <unk> <0x0A>", "tab\there  two  spaces ", "é ﬁ \x00 nul",
         "the the the the the", "x" * 3000, " " * 2500 + "end"]


def reference(texts):
    """Per text: tokens, groups and links by two pointers over byte ranges."""
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in tok.get_vocab().items() if i != 50256}
    sp = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    found = []
    for text in texts:
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        x, y = [a_bytes[i] for i in a], [piece(i) for i in b]
        if text and not b"".join(x) == (" " + text).encode() == b"".join(y):
            a, b, x, y = [], [], [], []
        links, groups, i, j, end_a, end_b, at_a, at_b = [], [], 0, 0, 0, 0, 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            next_a, next_b = end_a + len(x[i]), end_b + len(y[j])
            if next_a == next_b:
                groups.append(",".join(map(str, a[at_a:i + 1])) + "|" + ",".join(map(str, b[at_b:j + 1])))
                at_a, at_b = i + 1, j + 1
            if next_a <= next_b:
                i, end_a = i + 1, next_a
            if next_b <= next_a:
                j, end_b = j + 1, next_b
        found.append((len(a), len(b), groups, links))
    count = Counter(pair for *_, links in found for pair in set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [(n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
             sum(count[p] for p in links), ";".join(groups)) for n_a, n_b, groups, links in found]


@pytest.mark.parametrize("settings", [{}, {"spill": 40, "fan_in": 2, "radices": 5, "broadcast_bytes": 0}])
def test_against_two_pointers(make_docs, words, settings):
    texts = TEXTS + [words(i % 37, 5 + i % 60) for i in range(150)] + [words(999, 20_000)]
    ids = [None if i % 40 == 7 else i // 2 for i in range(len(texts))]      # ids repeat and are null
    docs = make_docs(list(zip(ids, texts))).withColumnRenamed("lang", "run").withColumnRenamed("source", "radix")
    got = alignment.align_tokens(docs, A, B, **settings).collect()
    want = [(i, *row) for i, row in zip(ids, reference(texts))]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_digests_and_empty_tables(make_docs):
    rows = alignment.align_tokens(make_docs(list(enumerate(TEXTS))), A, B, keep_groups=False).collect()
    want = reference(TEXTS)
    for r in rows:
        groups = want[r.doc_id][-1]
        assert r.groups == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    assert all(r.n_a == r.n_links == r.count_sum == 0 for r in rows if r.doc_id in (1, 2, 6))
    assert alignment.align_tokens(make_docs([]), A, B).collect() == []
    blank = alignment.align_tokens(make_docs([(1, None), (2, "")]), A, B).collect()
    assert sorted(tuple(r) for r in blank) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_heap_merge_and_highest():
    rng = np.random.default_rng(5)
    lists = [np.unique(rng.integers(0, 500, 100)) for _ in range(9)]
    runs = [(k, rng.integers(1, 9, len(k))) for k in lists]
    key, count = alignment.merge_counts(runs)
    want = Counter()
    for k, n in runs:
        want.update(dict(zip(k.tolist(), n.tolist())))
    assert dict(zip(key.tolist(), count.tolist())) == want and (np.diff(key) > 0).all()
    best = alignment.highest(key, count, 10)
    assert best.tolist() == [n == max(want[j] for j in want if j // 10 == k // 10) for k, n in zip(key.tolist(), count.tolist())]


def test_runs_round_trip():
    rng = np.random.default_rng(6)
    code = np.unique(rng.integers(0, 1 << 40, 5000))
    links = rng.integers(1, 300, len(code))
    back = []
    for radix, pairs, n, documents in alignment.run_rows(code, links, 1000, 7):
        step, here = alignment._unpack(pairs)
        number, own = alignment._unpack_small(documents)
        key = np.cumsum(step)
        assert n == len(key) and (alignment.radix_of(key // 1000, 7) == radix).all()
        back += zip(((np.repeat(key, here) << alignment.DOC_BITS) | np.cumsum(number)).tolist(), own.tolist())
    assert sorted(back) == sorted(zip(code.tolist(), links.tolist()))


def test_token_sizes_are_found_once(spark):
    import public_tokenizers

    from nutrilake.llm.alignment import load_tokenizer
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        tokenizer = load_tokenizer(public_tokenizers.path(name))
        assert tokenizer.sizes.tolist() == [len(t) for t in tokenizer.bytes_of]
