import hashlib
from collections import defaultdict

from nutrilake.llm import line_dedup

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows):
    holders = defaultdict(list)
    for r, (doc_id, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append((r, doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keep = []
        for x in lines:
            held = holders.get(key(x), [])
            best = max((d for _, d in held if d is not None), default=None)
            if len(held) < 3 or doc_id == best:
                keep.append(x)
        out.append((doc_id, len(lines), len(lines) - len(keep),
                    hashlib.sha256("\n".join(keep).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest())
                   for r in df.collect()), key=repr)


COMMON = "This very common line is long enough"
ROWS = [
    (1, f"a\n  {COMMON.upper()}\t\nb"), (2, COMMON), (3, f"x\n{COMMON}\n{COMMON}\n"), (4, None), (5, ""),
    (6, "short\nshort"), (7, "short"), (8, "short"), (9, f"É{COMMON}\r\n\x0b{COMMON}\x0c"),
    (9, f"another text of the same id\n{COMMON}"), (None, f"{COMMON}\nno id"), (10, "\n\n\n"),
    (11, "twice twice twice twice in two documents"), (12, "twice twice twice twice in two documents"),
]


def test_against_brute_force(make_docs):
    assert result(line_dedup.dedup_lines(make_docs(ROWS))) == brute(ROWS)


def test_batches_give_the_same(make_docs, spark):
    whole = make_docs(ROWS)
    batches = [make_docs(ROWS[i::4]) for i in range(4)]
    assert result(line_dedup.dedup_lines(whole, batches)) == brute(ROWS)


def test_levels_and_novel_lines(make_docs, spark):
    runs = line_dedup.LineRuns(spark)
    for i in range(3):
        runs.add(make_docs([(i, f"{COMMON}\nline number {i} that is long enough")]))
    assert [r is not None for r in runs.levels] == [True, True]       # 3 = 1 + 2 batches
    counts = sorted(r.n_docs for r in runs.total().collect())
    assert counts == [1, 1, 1, 3]
    novel = runs.novel_lines(make_docs([(9, f"{COMMON}\nline number 1 that is long enough\nand this line is new to all")]))
    assert [r.pos for r in novel.collect()] == [2]


def test_empty_table_and_other_columns(make_docs, spark):
    assert line_dedup.dedup_lines(make_docs([])).count() == 0
    docs = make_docs(ROWS[:3]).withColumnRenamed("lang", "n_lines").withColumnRenamed("source", "keeper")
    out = line_dedup.dedup_lines(docs)
    assert result(out) == brute(ROWS[:3])
    assert "keeper" in out.columns
