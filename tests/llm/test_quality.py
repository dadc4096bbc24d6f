import re
from collections import Counter

from nutrilake.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    repeat = {p for i, x in enumerate(windows) if often[x] >= 2 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))


TEXTS = [None, "", " \n\t", "a", "a b", "a b c a b c", "x " * 400, "a b c d e a b c x a b c d", "l\nl\nl \n\nl", "#*$ %&|<>",
         "é ü 日本 é ü 日本\x0b\x0c\r z", "one two three", "w" * 100_000]


def test_measurements_against_brute_force(make_docs, words):
    texts = TEXTS + [words(i % 7, 30 + i) + " " + words(i % 3, 20) + " " + words(i % 7, 30) for i in range(30)]
    out = quality.rule_ledger(make_docs(list(enumerate(texts))))
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect()}
    assert got == {i: measures(t) for i, t in enumerate(texts)}


def test_policies_and_ablation(make_docs, words):
    rows = [(i, words(i, 120)) for i in range(20)]
    rows += [(100, "few words"), (101, "a b c " * 40), (102, " ".join(w + "###" for w in words(3, 90).split(" "))),
             (None, None), (100, "few words")]
    ledger = quality.rule_ledger(make_docs(rows).withColumnRenamed("lang", "kept")).cache()
    assert ledger.count() == len(rows)
    v1 = quality.apply_policy(ledger, "v1").where("kept").count()
    v2 = quality.apply_policy(ledger, "v2").where("kept").count()
    assert (v1, v2) == (21, 20)
    table = {r.rule: r for r in quality.ablation(ledger, "v2").collect()}
    kept = lambda mask: sum(r.fail_bits & mask == 0 for r in ledger.collect())
    whole = quality.mask(quality.POLICIES["v2"])
    for rule in quality.POLICIES["v2"]:
        assert table[rule].n_only == kept(whole & ~quality.BITS[rule]) - kept(whole)
        assert table[rule].n_kept == kept(whole)
        assert table[rule].n_failed == len(rows) - kept(quality.BITS[rule])


def test_empty_table(make_docs):
    ledger = quality.rule_ledger(make_docs([]))
    assert ledger.count() == 0 and quality.ablation(ledger, "v1").count() == 0
