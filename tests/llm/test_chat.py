from pyspark.sql import functions as F

from nutrilake.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, extra string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return sorted((r.asDict() for r in chat.format_chats(df).collect()),
                  key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["position"]))


ROWS = [
    (1, 0, "user", "How do I sort a table?\nIt has two columns."),
    (1, 1, "user", "Unrelated: is the server up?"),
    (1, 2, "assistant", "On Monday user wrote:\n> How do I  SORT a table?\nUse order by."),
    (1, 3, "assistant", "> Unrelated: is the server up?\n\nYes."),
    (1, 4, "user", "> > How do I sort a table?\n> Use order by.\nThanks!"),
    (1, 5, "user", ">> How do I sort a table?\nOnly the nested quote"),
    (1, 6, "user", "> nobody ever wrote this\nreply"),
    (2, 0, "user", "How do I sort a table?"),
    (2, 1, "user", "> It has two columns.\nquote of another conversation"),
    (None, 0, "user", None), (None, 1, None, ""), (3, None, "user", "no turn"), (3, 0, "user", "> no turn"),
    (4, 0, "user", "> twice\ntwice"), (4, 0, "user", "> twice\ntwice"), (4, 1, "user", "> twice"),
]


def test_links_threads_and_order(spark):
    out = run(spark, ROWS)
    assert len(out) == len(ROWS)
    one = [r for r in out if r["conv_id"] == 1]
    assert [(r["turn"], r["parent_turn"], r["thread_turn"], r["depth"]) for r in one] == [
        (0, None, 0, 0), (2, 0, 0, 1), (4, 2, 0, 2), (5, 0, 0, 1), (1, None, 1, 0), (3, 1, 1, 1), (6, None, 6, 0)]
    text = {r["turn"]: r["text"] for r in one}
    assert text[0] == ROWS[0][3] and text[2] == "Use order by." and text[3] == "Yes." and text[4] == "Thanks!"
    assert [r["n_quoted"] for r in one] == [0, 1, 2, 1, 0, 1, 1] and [r["n_linked"] for r in one] == [0, 1, 2, 1, 0, 1, 0]
    two = [r for r in out if r["conv_id"] == 2]
    assert [r["parent_turn"] for r in two] == [None, None]
    assert [r["position"] for r in out if r["conv_id"] is None] == [0, 1]
    assert [r["parent_turn"] for r in out if r["conv_id"] == 4] == [None, None, 0]
    assert one[1]["formatted"] == "<|assistant|>\nUse order by."


def test_far_quotes_cross_the_ranges_of_turns(spark, monkeypatch):
    rows = [(1, t, "user", "the common line" if t % 3 else f"line {t}\n> the common line") for t in range(60)]
    want = run(spark, rows)
    monkeypatch.setattr(chat, "TURNS", 4)
    assert run(spark, rows) == want
    for r in want:
        t = r["turn"]
        if t % 3 == 0 and t:
            assert r["parent_turn"] == t - 1


def test_long_chain(spark):
    rows = [(7, 0, "a", "message 0")] + [(7, t, "a", f"> message {t - 1}\nmessage {t}") for t in range(1, 40)]
    out = run(spark, rows)
    assert [(r["thread_turn"], r["depth"], r["position"]) for r in out] == [(0, t, t) for t in range(40)]


def test_empty_table(spark):
    assert run(spark, []) == []
    assert chat.format_chats(spark.createDataFrame([], SCHEMA).withColumn("level", F.lit(1))).count() == 0


def test_wrapped_and_partial_quotes(spark):
    rows = [
        (1, 0, "user", "The quick brown fox jumps over the lazy dog. It runs. Then the day ends."),
        (1, 1, "user", "Another start\nthat was wrapped\nover lines!"),
        (1, 2, "assistant", "> The quick brown fox\n> jumps over the lazy dog.\nwrapped anew"),
        (1, 3, "assistant", "> Another start that was wrapped over lines!\nunwrapped"),
        (1, 4, "assistant", "> then the DAY ends.\none sentence"),
        (1, 5, "user", "> > The quick brown\n> > fox jumps over the lazy dog.\n> wrapped anew\nnested"),
        (1, 6, "user", "> The quick brown fox\n\n> jumps over the lazy dog.\ntwo paragraphs are no sentence"),
        (2, 0, "user", "The quick brown fox jumps over the lazy dog."),
    ]
    out = {(r["conv_id"], r["turn"]): r for r in run(spark, rows)}
    assert [out[1, t]["parent_turn"] for t in range(7)] == [None, None, 0, 1, 0, 2, None]
    assert [out[1, t]["text"] for t in (2, 3, 4, 5)] == ["wrapped anew", "unwrapped", "one sentence", "nested"]
    assert [out[1, t]["n_quoted"] for t in (2, 3, 4, 5)] == [2, 1, 1, 3]
    assert out[1, 5]["depth"] == 2 and out[2, 0]["parent_turn"] is None


def test_prompts_of_code_are_no_quotes(spark):
    code = "Try this:\n>>> print(1)\n1\n>>> quit()"
    rows = [(1, 0, "user", code), (1, 1, "user", "> Try this:\n>>> print(1)\nthanks"), (2, 0, "user", "I wrote:\n>>> a")]
    out = {(r["conv_id"], r["turn"]): r for r in run(spark, rows)}
    assert out[1, 0]["text"] == code and out[1, 0]["parent_turn"] is None
    assert out[1, 1]["parent_turn"] == 0 and out[1, 1]["text"] == "thanks"
    assert out[2, 0]["text"] == "I wrote:\n>>> a"
