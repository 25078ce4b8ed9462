"""Conversations ordered by replies, from quoted passages (operator 5). DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registry_spark.sources.shared import written

# Start of a quoted line: blanks and quote marks up to the last mark.
MARK = r"^[ \t>]*>"
QUOTED_LINE = r"(?md)^[ \t>]*>[^\n]*(?:\n|$)"
# A single line links two messages only when it has this many words; whole passages always do.
LINE_WORDS = 4
# Words of a passage quoted in part that must be found in a row; a paragraph of fewer must be found whole.
WINDOW_WORDS = 8
MESSAGE = ["conv", "turn", "key"]


def normal(text: Column) -> Column:
    """Lower case, runs of blanks as one, none at the ends: quoting re-wraps and re-indents text."""
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\r]+", " "))


def quoting(text: Column) -> Column:
    return F.coalesce(text.rlike("(?md)" + MARK), F.lit(False))


def message_lines(messages: DataFrame) -> DataFrame:
    """Lines of distinct messages (conv, turn, key, text): pos, depth of quotation, run of equal depth, normalised words."""
    lines = messages.select(*MESSAGE, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    mark = F.regexp_extract("line", MARK, 0)
    parsed = lines.select(
        *MESSAGE, "pos",
        (F.length(mark) - F.length(F.replace(mark, F.lit(">"), F.lit("")))).alias("depth"),
        normal(F.regexp_replace("line", MARK, "")).alias("words"),
    )
    order = Window.partitionBy(*MESSAGE).orderBy("pos")
    changed = F.when(F.col("depth") == F.lag("depth").over(order), 0).otherwise(1)
    return parsed.withColumn("changed", changed).withColumn("run", F.sum("changed").over(order)).drop("changed")


def units(lines: DataFrame) -> DataFrame:
    """What can be recognised: passages (kind 0: all lines of a run) and long enough lines (kind 1), each with its hash."""
    some = lines.filter("words <> ''")
    entry = F.sort_array(F.collect_list(F.struct("pos", "words")))
    passages = some.groupBy(*MESSAGE, "run", "depth").agg(F.array_join(F.transform(entry, lambda e: e["words"]), " ").alias("words"))
    long = some.filter(F.size(F.split("words", " ")) >= LINE_WORDS)
    columns = [*MESSAGE, "run", "depth"]
    return passages.select(*columns, F.lit(0).alias("kind"), F.lit(0).alias("pos"), F.md5(F.col("words").cast("binary")).alias("hash")).unionByName(
        long.select(*columns, F.lit(1).alias("kind"), "pos", F.md5(F.col("words").cast("binary")).alias("hash"))
    )


def windows(words: Column, size: Column) -> Column:
    """Hash of every ``size`` words in a row of an array that has as many."""
    starts = F.sequence(F.lit(1), F.size(words) - size + 1)
    return F.transform(starts, lambda i: F.md5(F.array_join(F.slice(words, i, size), " ").cast("binary")))


def partial_origins(messages: DataFrame, unlinked: DataFrame) -> DataFrame:
    """Origins of quoted passages (MESSAGE, run) that are parts of messages, by words in a row wherever lines break.

    Each paragraph of a passage is looked for, by WINDOW_WORDS words or whole if it has fewer, in what earlier
    messages of the conversation say in their own words; the first that is found decides. Fewer than LINE_WORDS words
    count only when a single earlier message says them.
    """
    lines = message_lines(messages.join(unlinked.select("conv").distinct(), "conv", "left_semi"))
    blanks = F.sum(F.when(F.col("words") == "", 1).otherwise(0)).over(Window.partitionBy(*MESSAGE).orderBy("pos"))
    entry = F.sort_array(F.collect_list(F.struct("pos", "words")))
    words = F.split(F.array_join(F.transform(entry, lambda e: e["words"]), " "), " ").alias("words")
    quoted = lines.withColumn("paragraph", blanks).filter("depth > 0 AND words <> ''").join(unlinked.select(*MESSAGE, "run"), [*MESSAGE, "run"], "left_semi")
    quoted = quoted.groupBy(*MESSAGE, "run", "paragraph").agg(words).withColumn("size", F.least(F.size("words"), F.lit(WINDOW_WORDS)))
    wanted = written(quoted.select(*MESSAGE, "run", "paragraph", "size", F.posexplode(windows(F.col("words"), F.col("size"))).alias("place", "hash")))
    own = lines.filter("depth = 0 AND words <> ''").groupBy(*MESSAGE, "run").agg(words).select("conv", "turn", "words")
    sizes = wanted.select("conv", "size").distinct()
    said = own.join(sizes, "conv").filter(F.size("words") >= F.col("size"))
    said = said.select("conv", "turn", "size", F.explode(F.array_distinct(windows(F.col("words"), F.col("size")))).alias("hash"))
    same = ["conv", "size", "hash"]
    said = written(said.join(wanted.select(*same).distinct(), same, "left_semi").distinct())
    first = said.groupBy(*same).agg(F.min("turn").alias("origin"))
    both = said.join(first, same).groupBy(*same, "origin").agg(F.min(F.when(F.col("turn") > F.col("origin"), F.col("turn"))).alias("next"))
    alone = (F.col("size") >= LINE_WORDS) | F.col("next").isNull() | (F.col("next") >= F.col("turn"))
    found = wanted.join(both, same).filter((F.col("origin") < F.col("turn")) & alone)
    best = F.min(F.struct("paragraph", "place", "origin"))
    return found.groupBy(*MESSAGE, "run").agg(best["origin"].alias("part_origin"))


def quotation_links(conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """One row per quoted passage: conv, turn, key (MD5 of the message's text), run, depth, origin (turn quoted, or NULL).

    The origin is the first message of the conversation that says the passage in its own words, and has a smaller turn.
    The whole passage decides; failing that, its first line that is found, then what ``partial_origins`` finds. Messages
    without a conversation, turn or text neither quote nor are quoted.
    """
    known = conversations.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{text}`").alias("text"))
    known = known.dropna()
    threads = known.filter(quoting(F.col("text"))).select("conv").distinct()
    messages = known.join(threads, "conv", "left_semi").withColumn("key", F.md5(F.col("text").cast("binary")))
    # Equal messages are read once; the text is a function of the key.
    distinct = messages.groupBy(*MESSAGE).agg(F.first("text").alias("text"))
    found = written(units(message_lines(distinct)))
    origins = found.filter("depth = 0").groupBy("conv", "hash").agg(F.min("turn").alias("origin"))
    best = F.min(F.when(F.col("origin") < F.col("turn"), F.struct("kind", "pos", "origin"))).alias("best")
    links = written(found.filter("depth > 0").join(origins, ["conv", "hash"], "left").groupBy(*MESSAGE, "run", "depth").agg(best).select(
        *MESSAGE, "run", "depth", F.col("best.origin").alias("origin")
    ))
    unlinked = links.filter("origin IS NULL")
    if unlinked.isEmpty():
        return links
    parts = partial_origins(distinct, unlinked)
    return links.join(parts, [*MESSAGE, "run"], "left").select(*MESSAGE, "run", "depth", F.coalesce("origin", "part_origin").alias("origin"))


def thread_starts(parents: DataFrame) -> DataFrame:
    """First turn of each reply's thread and its distance, from conv, turn, parent: every round doubles the distance looked over."""
    state = parents.select("conv", "turn", F.col("parent").alias("top"), F.lit(1).cast("long").alias("steps"))
    while True:
        state = written(state)
        above = state.select("conv", F.col("turn").alias("top"), F.col("top").alias("next"), F.col("steps").alias("more"))
        if state.join(above, ["conv", "top"], "left_semi").isEmpty():
            return state
        state = state.join(above, ["conv", "top"], "left").select(
            "conv", "turn", F.coalesce("next", "top").alias("top"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")
        )


def reply_order(
    conversations: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Every message without its quotations, with its place among the replies.

    Columns: ``conv``, ``turn``, ``role``, n_quotes (quoted passages), n_linked (those whose origin is known), max_depth,
    parent_turn (origin of the outermost linked passage, the first of them; NULL if none), thread_turn (the message at
    the head of the chain of parents, itself if it answers none), reply_depth, ``text``. Ordered by (``conv``, thread_turn, ``turn``) a
    conversation reads thread by thread, every reply after what it answers. Text of messages that quote loses quoted lines and
    line breaks at its ends; any other, NULL and empty included, stays as it is. Repeated rows are each returned; where different messages
    share a turn, its parent is the smallest of theirs. Other columns are not carried.
    """
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    rows = conversations.select(*[F.col(f"`{c}`").alias(n) for c, n in ((conv, "conv"), (turn, "turn"), (role, "role"), (text, "text"))])
    links = written(quotation_links(rows, conv="conv", turn="turn", text="text"))
    message = links.groupBy(*MESSAGE).agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("origin").alias("n_linked"), F.max("depth").alias("max_depth")
    )
    outermost = F.min(F.when(F.col("origin").isNotNull(), F.struct("depth", "run", "origin")))
    own = links.groupBy(*MESSAGE).agg(outermost["origin"].alias("parent")).groupBy("conv", "turn").agg(F.min("parent").alias("parent"))
    tops = thread_starts(own.filter("parent IS NOT NULL")).join(own, ["conv", "turn"])
    out = rows.withColumn("key", key).join(message, MESSAGE, "left").join(tops, ["conv", "turn"], "left")
    left = F.regexp_replace(F.regexp_replace("text", QUOTED_LINE, ""), r"^\n+|\n+\z", "")
    return out.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role),
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("max_depth", F.lit(0)).cast("long").alias("max_depth"), F.col("parent").alias("parent_turn"),
        F.coalesce("top", "turn").alias("thread_turn"), F.coalesce("steps", F.lit(0)).cast("long").alias("reply_depth"),
        F.when(quoting(F.col("text")), left).otherwise(F.col("text")).alias(text),
    )
