"""Operator 9: chat formatting by quotation linking.

Messages quote earlier ones by lines that begin with ">", once per level.
Every line is parsed into (level, passage); passages are normalised (A-Z
lower-cased, white space runs one blank) and hashed; a quoted passage is
linked to the last earlier message of its conversation that holds it
unquoted.  Passages are lines and, where lines were wrapped anew or only a
sentence was quoted, the sentences of neighbouring lines of one level.  The message that wrote most passages of a message's outermost
quotes is its original; ties go to the later one.  Following originals leads
to the thread's first message.  Conversations come out in reply order, thread
after thread and by turn inside a thread, so that every reply follows what it
replies to, with the quotes taken out.

Scale: passages meet by an as-of window over (conversation, passage, range of
turns) and not by a join of all holders, so a line that is everywhere in a
huge conversation costs linear work and no range of turns is unbounded.
Threads need one join per doubling of the reply depth.  Positions come from
range partitions; no window spans a conversation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nutrilake.llm.common import LOWER, UPPER, WHITE, WHITE_RUN, global_rank, written

TURNS = 1024          # turns looked at together by the as-of window
QUOTE = r"^[\x20\x09]*>[\x20\x09>]*"
# A line that introduces a quote, such as "On Monday A wrote:" (fixed words).
INTRODUCTION = r"(?i)(wrote|writes|said|schrieb|a écrit|escribió)[\x20\x09]*:[\x20\x09\x0D]*$"
# Sentences of joined lines: cut at ends of paragraphs and after end marks.
SENTENCES = r"\x20*\n[\x20\n]*|(?<=[.!?])\x20+"
# The prompt of an interactive session in a code sample.
PROMPT = r"^>>> "
ID = ["conv_id", "turn"]


def _level(line: Column) -> Column:
    mark = F.regexp_extract(line, QUOTE, 0)
    return F.length(mark) - F.length(F.replace(mark, F.lit(">")))


def _passage(line: Column) -> Column:
    bare = F.regexp_replace(line, QUOTE, "")
    return F.translate(F.btrim(F.regexp_replace(bare, WHITE_RUN, " ")), UPPER, LOWER)


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lines): lines as (level, line, passage)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    m = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", text.alias("text"))
    lines = F.transform(F.split("text", "\n", -1), lambda x: F.struct(
        _level(x).alias("level"), x.alias("line"), _passage(x).alias("passage")))
    return m.withColumn("lines", lines)


def _sentences(lines: Column, level: Column) -> Column:
    """The sentences of the lines of a level that are not lines themselves, as
    (level, passage); other levels and empty lines end a paragraph."""
    own = F.transform(lines, lambda x: F.when(x["level"] == level, x["passage"]).otherwise(F.lit("")))
    joined = F.array_join(F.transform(own, lambda t: F.when(t == "", F.lit("\n")).otherwise(t)), " ")
    found = F.array_except(F.split(joined, SENTENCES, -1), own)
    return F.transform(F.filter(found, lambda t: t != ""),
                       lambda t: F.struct(level.alias("level"), t.alias("passage")))


def passages(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, level, passage) of the conversations that quote at all."""
    quoting = (lines.where(F.exists("lines", lambda x: x["level"] > 0))
               .select(F.col("conv_id").alias("_conv")).distinct())
    kept = lines.join(quoting, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    whole = F.transform("lines", lambda x: F.struct(x["level"].alias("level"), x["passage"].alias("passage")))
    levels = F.array_distinct(F.transform("lines", lambda x: x["level"]))
    parts = F.flatten(F.transform(levels, lambda n: _sentences(F.col("lines"), n)))
    return (kept.select(*ID, F.explode(F.concat(whole, parts)).alias("x")).where(F.col("x.passage") != "")
            .select(*ID, "x.level", "x.passage"))


def originals(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, level, source): every quoted passage with the
    last earlier turn that holds it unquoted (null if none)."""
    p = (passages(lines)
         .select(*ID, "level", F.xxhash64("passage").alias("h1"), F.xxhash64(F.lit("q"), "passage").alias("h2"))
         .withColumn("part", F.floor(F.col("turn") / TURNS)))
    wrote = F.when(F.col("level") == 0, F.col("turn"))
    key = ["conv_id", "h1", "h2"]
    # The last holder in earlier ranges of turns, one row per range ...
    last = p.groupBy(*key, "part").agg(F.max(wrote).alias("last"), F.max("level").alias("deepest"))
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (last.withColumn("before", F.max("last").over(before)).where(F.col("deepest") > 0)
               .select(*[F.col(c).alias(f"_{c}") for c in (*key, "part")], "before"))
    # ... and inside the range, over turns before the own one.
    inside = Window.partitionBy(*key, "part").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    asked = p.withColumn("near", F.max(wrote).over(inside)).where(F.col("level") > 0)
    return (asked.join(carried, F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("h1") == F.col("_h1"))
                       & (F.col("h2") == F.col("_h2")) & F.col("part").eqNullSafe(F.col("_part")))
            .select(*ID, "level", F.coalesce("near", "before").alias("source")))


def parents(quotes: DataFrame) -> DataFrame:
    """(conv_id, turn, parent, n_linked): the original of every message that has one."""
    found = quotes.where(F.col("source").isNotNull())
    votes = found.groupBy(*ID, "level", "source").agg(F.count("*").alias("n"))
    return (votes.groupBy(*ID).agg(
        F.max_by("source", F.struct(-F.col("level"), "n", "source")).alias("parent"),
        F.sum("n").alias("n_linked")))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth): the first message reached through the
    originals, and the replies in between.  Each round doubles the distance."""
    state = written(links.select(*ID, F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth"),
                                 F.lit(True).alias("moved")), "threads")
    while state.where("moved").limit(1).count():
        above = state.select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"),
                             F.col("thread").alias("_thread"), F.col("depth").alias("_depth"))
        state = written(state.join(above, F.col("conv_id").eqNullSafe(F.col("_conv"))
                                   & (F.col("thread") == F.col("_turn")), "left").select(
            *ID, F.coalesce("_thread", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            F.col("_thread").isNotNull().alias("moved")), "threads")
    return state.drop("moved")


def _reply(lines: Column, linked: Column) -> Column:
    """The message without quoted lines and the lines that introduce them.
    Prompts of code stay in a message that quotes no other."""
    code = lambda x: ~linked & x["line"].rlike(PROMPT)
    after = lambda i: F.get(lines, i)
    quoted = lambda i: F.coalesce((after(i)["level"] > 0) & ~code(after(i)), F.lit(False))
    own = F.filter(lines, lambda x, i: ((x["level"] == 0) | code(x))
                   & ~(quoted(i + 1) & x["line"].rlike(INTRODUCTION)))
    return F.btrim(F.array_join(F.transform(own, lambda x: x["line"]), "\n"), F.lit(WHITE))


def format_chats(messages: DataFrame) -> DataFrame:
    """One row per row of ``messages`` (conv_id, turn, role, text): conv_id,
    turn, role, text without quotes, parent_turn, thread_turn, depth,
    n_quoted (quoted lines), n_linked (quoted lines and sentences with an original), position
    (place in the conversation's reply order, from 0) and formatted.

    A message without quotes keeps its text as it is.  Null texts are empty.
    Rows that repeat a (conv_id, turn) are further parts of one message: they
    share its links and follow each other by role and text.  A null conv_id is
    a conversation of its own; a null turn comes last, has no original and is
    none.  Other columns are ignored; an empty table gives no rows.
    """
    lines = written(parsed(messages), "lines")
    links = written(parents(originals(lines)), "links")
    linked = links.join(threads(links).select(*[F.col(c).alias(f"_{c}") for c in ID], "thread", "depth"),
                        F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("turn") == F.col("_turn"))).select(
        F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "parent", "thread", "depth", "n_linked")
    n_quoted = F.size(F.filter("lines", lambda x: (x["level"] > 0) & (x["passage"] != "")))
    any_quoted = F.exists("lines", lambda x: x["level"] > 0)
    told = (lines.join(linked, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left")
            .select("conv_id", "turn", "role",
                    F.when(any_quoted, _reply(F.col("lines"), F.col("parent").isNotNull())).otherwise(F.col("text")).alias("text"),
                    F.col("parent").alias("parent_turn"), F.coalesce("thread", "turn").alias("thread_turn"),
                    F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), n_quoted.cast("long").alias("n_quoted"),
                    F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked")))
    order = [F.col("conv_id").isNull(), F.col("conv_id"), F.col("thread_turn").isNull(), F.col("thread_turn"),
             F.col("turn"), F.col("role"), F.col("text")]
    ranked = global_rank(told, order, "_rank")
    first = ranked.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("_rank").alias("_first"))
    body = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("text"))
    return (ranked.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")))
            .withColumn("position", F.col("_rank") - F.col("_first")).withColumn("formatted", body)
            .drop("_rank", "_conv", "_first"))
