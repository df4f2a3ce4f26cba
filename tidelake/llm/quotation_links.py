"""Quotation linking: who answers whom, found by what is quoted, and conversations without the quotes.

A line's quote level is the number of ``>`` before its body. Runs of lines of one level are passages;
those of level 0 are the author's own text. Quoted passages, and their single lines and sentences, are
normalised (A-Z in lower case, white space collapsed) and hashed, and joined to the own text of messages
of the same conversation: whole, by paragraph, by line and by sentence, however short. The original of a
passage is the first message that holds it, so the join finds at most one row; it must come before the
message that quotes it. Of several originals a message answers that of the lowest quote level, then of
the longest passage, then the latest.

Messages that answer nothing found begin a thread. A conversation is ordered by thread, then turn, so
every answer comes after what it answers; it is cut into parts by blocks of threads and turns. A block
of more than ``PART_MESSAGES`` messages (many texts on one turn, or rows without conversation or turn) is
cut by turn and, inside a turn, by hash, which bounds a row however long the conversation is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.tables import written

PART_TURNS = 128
PART_MESSAGES = 1024

MARKS = r"^([ \t]*>)+"
#: A sentence ends with one of these and a space after it.
SENTENCE_END = "(?<=[.!?]) "


def normal(text: Column) -> Column:
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(folded, r"\s+", " "))


def sentences(normalised: Column) -> Column:
    return F.split(normalised, SENTENCE_END)


def with_passages(messages: DataFrame) -> DataFrame:
    """``messages`` with own (own text), and quoted (array of level and lines)."""
    marked = f"transform(split(regexp_replace(text, '\\r\\n?', '\\n'), '\\n'), line -> named_struct('line', line, 'marks', IF(contains(line, '>'), regexp_extract(line, r'{MARKS}', 0), '')))"
    lines = (
        f"transform({marked}, x -> named_struct('level', length(x.marks) - length(replace(x.marks, '>', '')), "
        "'body', IF(x.marks = '', x.line, trim(BOTH FROM substr(x.line, length(x.marks) + 1)))))"
    )
    parsed = messages.withColumn("_lines", F.expr(lines)).withColumn(
        "_starts", F.expr("filter(transform(_lines, (x, i) -> IF(i = 0 OR _lines[i - 1].level <> x.level, i, -1)), i -> i >= 0)")
    )
    runs = parsed.withColumn(
        "_runs",
        F.expr(
            "transform(_starts, (s, k) -> named_struct('level', _lines[s].level, 'lines', "
            "slice(_lines.body, s + 1, coalesce(get(_starts, k + 1), size(_lines)) - s)))"
        ),
    )
    own = "trim(BOTH '\\n' FROM array_join(transform(filter(_lines, x -> x.level = 0), x -> x.body), '\\n'))"
    return runs.select(*messages.columns, F.expr(own).alias("own"), F.expr("filter(_runs, r -> r.level > 0)").alias("quoted"))


def digest(normalised: str) -> Column:
    return F.md5(F.col(normalised).cast("binary"))


def originals(parsed: DataFrame) -> DataFrame:
    """(conv_id, passage, source): the first turn whose own text holds a passage, as text, paragraph, line or sentence."""
    blocks = F.concat(F.array("own"), F.split("own", r"\n[ \t]*\n"), F.split("own", "\n"))
    each = parsed.where("own IS NOT NULL").select("conv_id", "turn", F.transform(blocks, normal).alias("blocks"))
    pieces = F.array_distinct(F.concat("blocks", F.flatten(F.transform("blocks", sentences))))
    each = each.select("conv_id", "turn", F.explode(pieces).alias("piece")).where("piece <> ''")
    return each.groupBy("conv_id", digest("piece").alias("passage")).agg(F.min("turn").alias("source"))


def quotations(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, level, passage, chars) of all quoted passages, their lines and their sentences."""
    runs = parsed.select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.level", "q.lines")
    texts = F.transform(F.concat(F.array(F.array_join("lines", "\n")), F.col("lines")), normal)
    each = runs.select("conv_id", "turn", "level", texts.alias("texts"))
    pieces = F.array_distinct(F.concat("texts", F.flatten(F.transform("texts", sentences))))
    each = each.select("conv_id", "turn", "level", F.explode(pieces).alias("text")).where("text <> ''")
    return each.select("conv_id", "turn", "level", digest("text").alias("passage"), F.char_length("text").alias("chars"))


def reply_links(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of all messages whose quotation was found."""
    matched = quotations(parsed).join(originals(parsed), ["conv_id", "passage"]).where("source < turn")
    best = F.max(F.struct((-F.col("level")).alias("near"), "chars", "source")).alias("best")
    return matched.groupBy("conv_id", "turn").agg(best).select("conv_id", "turn", F.col("best.source").alias("reply_to"))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth): the first message of each answer's chain and the steps to it.

    Chains are halved in every round, so the rounds grow with the logarithm of the longest.
    """
    state = written(links.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")))
    while True:
        up = state.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("_up"), F.col("depth").alias("_more"))
        joined = state.join(up, ["conv_id", "thread"], "left")
        moved = written(joined.select("conv_id", "turn", "thread", "depth", "_up", "_more"))
        state = moved.select("conv_id", "turn", F.coalesce("_up", "thread").alias("thread"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"))
        if moved.where("_up IS NOT NULL").isEmpty():
            return state


def link_quotations(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, text (without quotes), n_quoted, reply_to, thread, depth.

    Rows that repeat conv_id, turn, role and text count once; rows of one turn with different texts share
    the turn's link. A text that is NULL stays NULL and quotes nothing. Messages without conv_id or turn
    are linked with nothing; a NULL turn is its own thread, NULL. Other columns are ignored.
    """
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.col("text").cast("string").alias("text"))
    parsed = written(with_passages(rows.dropDuplicates()))
    links = written(reply_links(parsed))
    chains = threads(links).join(links, ["conv_id", "turn"])
    told = parsed.join(chains, ["conv_id", "turn"], "left")
    return told.select(
        "conv_id", "turn", "role", F.col("own").alias("text"), F.coalesce(F.size("quoted"), F.lit(0)).alias("n_quoted"),
        "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"),
    )


def part_keys(linked: DataFrame) -> DataFrame:
    """``linked`` with thread_block, turn_block, and, in blocks of too many messages, part_turn and part."""
    block = {name: F.floor(F.coalesce(c, F.lit(-1)) / PART_TURNS) for c, name in (("thread", "thread_block"), ("turn", "turn_block"))}
    linked = linked.withColumns(block)
    keys = ["conv_id", "thread_block", "turn_block", "turn"]
    # One row a turn, and a block has few turns, so this window is small for any conversation.
    turns = linked.groupBy(*keys).agg(F.count("*").alias("_in_turn"))
    whole = F.sum("_in_turn").over(Window.partitionBy(*keys[:3]))
    large = written(turns.withColumn("_in_block", whole).where(F.col("_in_block") > PART_MESSAGES).drop("_in_block"))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    joined = linked.alias("a").join(large.alias("b"), same, "left").select("a.*", "_in_turn")
    lanes = F.ceil(F.col("_in_turn") / PART_MESSAGES)
    lane = F.pmod(F.xxhash64("role", "text", "reply_to", "n_quoted"), lanes)
    return joined.withColumns({"part_turn": F.when(F.col("_in_turn").isNotNull(), F.col("turn")), "part": F.coalesce(lane, F.lit(0))}).drop("_in_turn")


def conversations(messages: DataFrame) -> DataFrame:
    """Reply-ordered conversations: one row per conversation and part, with its messages in order.

    A part holds the messages of one block of 128 thread beginnings and one block of 128 turns; in blocks of
    more than ``PART_MESSAGES`` messages, those of one turn, dealt over numbered parts of about that size.
    Parts in the order of (thread_block, turn_block, part_turn, part), and messages inside, keep every answer
    after its original.
    """
    linked = part_keys(link_quotations(messages))
    message = F.struct("thread", "turn", "reply_to", "depth", "role", "text")
    keys = ["conv_id", "thread_block", "turn_block", "part_turn", "part"]
    parts = linked.groupBy(*keys).agg(F.sort_array(F.collect_list(message)).alias("messages"), F.count("reply_to").alias("n_links"))
    return parts.select(*keys, F.size("messages").alias("n_messages"), "n_links", "messages")
