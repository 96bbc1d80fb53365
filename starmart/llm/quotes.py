"""Chat formatting: quotation linking, in DataFrame functions only.

A line that starts with ``>`` marks is quoted, as deep as it has marks; a passage is a run of
lines of one depth.  Normalised passages (white space collapsed, lower case) are hashed and
joined to the earliest message of the conversation that wrote the same passage, paragraph or
line itself.  A message replies to the latest message it quotes at depth one, and to the
message before it where it quotes none that is known.  Roots and depths of the reply trees come
from pointer doubling, so a conversation of n messages takes log2(n) joins on (conversation,
turn) and is never gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import SPACE, staged, text_or_empty

MARKS = r"^[ \t]*>(?:[ \t]*>)*[ \t]?"  # fixed value: quote marks at the start of a line
FIRST_TURN = -(1 << 62)  # null turns come before all others
MOST_ROUNDS = 70


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, SPACE, " ")))


def _texts(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Bodies of each group's lines in order, joined by line feeds."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "body")))
    return lines.groupBy(*keys).agg(F.concat_ws("\n", F.transform(ordered, lambda x: x["body"])).alias("joined"))


def parse_lines(messages: DataFrame) -> DataFrame:
    """(row, ck, tk, pos, level, body, part, run) of every line: quote depth, text without marks, paragraph and passage numbers."""
    lines = messages.select("row", "ck", "tk", F.posexplode(F.split("body_text", "\n", -1)).alias("pos", "line"))
    marks = F.regexp_extract("line", MARKS, 0)
    lines = lines.withColumn("marks", marks).select("row", "ck", "tk", "pos", F.length(F.translate("marks", " \t", "")).alias("level"),
                                                    F.expr("substring(line, length(marks) + 1)").alias("body"))
    in_order = Window.partitionBy("row").orderBy("pos")
    turn = F.coalesce(F.col("level") != F.lag("level").over(in_order), F.lit(True))
    blank = _normal(F.col("body")) == ""
    lines = lines.withColumn("turns", turn.cast("int")).withColumn("breaks", (turn | blank).cast("int"))
    return lines.select("row", "ck", "tk", "pos", "level", "body", F.sum("breaks").over(in_order).alias("part"), F.sum("turns").over(in_order).alias("run"))


def _previous(nodes: DataFrame) -> DataFrame:
    """(ck, tk, before): the largest smaller turn of the conversation, for distinct (ck, tk).

    The nodes are sorted by range partitions; a node's predecessor stands before it in its partition, or is the last
    node of the partition before.  So no task holds a conversation, however long it is and however far its turns lie
    apart; one row per partition goes through a single window.
    """
    key = F.struct("ck", "tk")
    ordered = staged(nodes.orderBy("ck", "tk").withColumn("at", F.monotonically_increasing_id()), "quote-turns").withColumn("part", F.shiftright("at", 33))
    last = ordered.groupBy("part").agg(F.max_by(key, "at").alias("last"))
    edges = last.select("part", F.lag("last").over(Window.orderBy("part")).alias("edge"))
    inside = ordered.withColumn("near", F.lag(key).over(Window.partitionBy("part").orderBy("at")))
    found = inside.join(F.broadcast(edges), "part").withColumn("prev", F.coalesce("near", "edge"))
    return found.select("ck", "tk", F.when(F.col("prev.ck") == F.col("ck"), F.col("prev.tk")).alias("before"))


def reply_trees(parents: DataFrame) -> DataFrame:
    """(ck, tk, parent) -> (ck, tk, parent, root, depth); a parent is always an earlier node of its conversation.

    Each round doubles how far a node sees; a node leaves the rounds once it sees its root, so
    short conversations cost few rows and only the deepest trees take part to the end.
    """
    start = parents.select("ck", "tk", "parent", F.coalesce("parent", "tk").alias("root"), F.col("parent").isNotNull().cast("long").alias("depth"), F.col("parent").isNull().alias("done"))
    start = staged(start, "quote-trees")
    settled, open_ = start.where("done"), start.where("not done")
    for _ in range(MOST_ROUNDS):
        if open_.limit(1).count() == 0:
            return settled.drop("done")
        up = settled.unionByName(open_).select("ck", F.col("tk").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"), F.col("done").alias("known"))
        seen = open_.join(up, ["ck", "root"]).select("ck", "tk", "parent", F.col("next").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), F.col("known").alias("done"))
        seen = staged(seen, "quote-trees")
        settled, open_ = settled.unionByName(seen.where("done")), seen.where("not done")
    raise RuntimeError("reply trees did not settle")


def link_quotations(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, role, text) with quotes cut off and their place in the reply tree.

    One row per row: conv_id, turn, role, text (own lines, outer blank lines off), parent_turn,
    root_turn, depth, n_quotes (passages), n_linked (passages whose original is known), max_level.
    Reply order is (conv_id, root_turn, turn): every message comes after the one it answers.
    Null texts are empty; null conv_ids are one conversation, and blank ones another; a null turn comes before all others
    and stays null; rows that repeat a turn share its place in the tree.  Empty tables give no
    rows; other columns are not read.
    """
    base = messages.select("conv_id", "turn", "role", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("ck"),
                           F.coalesce(F.col("turn").cast("long"), F.lit(FIRST_TURN)).alias("tk"), F.monotonically_increasing_id().alias("row"), text_or_empty().alias("body_text"))
    base = staged(base, "quote-messages")
    has = F.col("body_text").rlike(r"(?:^|\n)[ \t]*>")
    quoting = base.where(has)
    lines = parse_lines(quoting)
    runs = _texts(lines.where("level > 0"), ["row", "ck", "tk", "level", "run"]).withColumn("kind", F.lit("run"))
    parts = _texts(lines.where("level > 0"), ["row", "ck", "tk", "level", "run", "part"]).withColumn("kind", F.lit("part")).drop("part")
    quoted = runs.unionByName(parts).withColumn("norm", _normal(F.col("joined"))).where("norm != ''")
    quoted = staged(quoted.select("row", "ck", "tk", "level", "run", "kind", F.md5("norm").alias("hash")), "quote-passages")

    talk = base.join(quoting.select("ck").distinct(), "ck", "left_semi")  # only their messages can be originals
    own = parse_lines(talk).where("level = 0")
    whole = _texts(own, ["row", "ck", "tk"]).select("ck", "tk", "joined")
    paragraph = _texts(own, ["row", "ck", "tk", "part"]).select("ck", "tk", "joined")
    single = own.select("ck", "tk", F.col("body").alias("joined"))
    originals = whole.unionByName(paragraph).unionByName(single).withColumn("norm", _normal(F.col("joined"))).where("norm != ''")
    first = originals.groupBy("ck", F.md5("norm").alias("hash")).agg(F.min("tk").alias("origin"))
    found = quoted.join(first, ["ck", "hash"], "left").withColumn("origin", F.when(F.col("origin") < F.col("tk"), F.col("origin")))
    passage = found.groupBy("row", "level", "run").agg(F.max("origin").alias("origin"))
    direct = F.max(F.when(F.col("level") == 1, F.col("origin")))
    per_row = passage.groupBy("row").agg(F.count(F.lit(1)).alias("n_quotes"), F.count("origin").alias("n_linked"), F.max("level").alias("max_level"), direct.alias("quoted"))
    per_row = staged(per_row, "quote-rows")

    kept = _texts(parse_lines(quoting).where("level = 0"), ["row"]).withColumn("joined", F.regexp_replace("joined", r"^(?:[ \t]*\n)+|(?:\n[ \t]*)+$", ""))
    told = base.join(kept, "row", "left").join(per_row, "row", "left")
    told = told.withColumn("own", F.when(has, F.coalesce("joined", F.lit(""))).otherwise(F.col("body_text")))
    nodes = base.select("ck", "tk").distinct()
    linked = base.select("row", "ck", "tk").join(per_row.select("row", "quoted"), "row").groupBy("ck", "tk").agg(F.max("quoted").alias("quoted"))
    parents = _previous(nodes).join(linked, ["ck", "tk"], "left").select("ck", "tk", F.coalesce("quoted", "before").alias("parent"))
    trees = reply_trees(parents)
    turn = lambda c: F.when(F.col(c) != FIRST_TURN, F.col(c))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    out = told.join(trees, ["ck", "tk"])
    return out.select("conv_id", "turn", "role", F.col("own").alias("text"), turn("parent").alias("parent_turn"), turn("root").alias("root_turn"), "depth",
                      zero("n_quotes"), zero("n_linked"), zero("max_level"))


def with_quotes(messages: DataFrame) -> DataFrame:
    """A mail-like rendering of a chat: every message quotes the one before it (every third the one before that), with what that one quoted in turn.

    One row per row: conv_id, turn, role, text.  Null texts are empty; of rows that repeat a turn the smallest text is
    quoted; messages without a turn, or of no conversation (null conv_id), quote nothing and are not quoted.  Empty
    tables give no rows; other columns are not read.
    """
    key = ["conv_id", "turn"]
    mark = lambda text, m: F.when(text.isNotNull(), F.concat_ws("\n", F.transform(F.split(text, "\n", -1), lambda x: F.concat(F.lit(m), x))))
    told = messages.select(*key, "role", text_or_empty().alias("text"))
    back = told.groupBy(*key).agg(F.min("text").alias("said"))
    step = F.when(F.col("turn") % 3 == 2, 2).otherwise(1)
    one = back.select("conv_id", F.col("turn").alias("t1"), F.col("said").alias("said1"))
    two = back.select("conv_id", F.col("turn").alias("t2"), F.col("said").alias("said2"))
    out = told.withColumn("t1", F.col("turn") - step).join(one, ["conv_id", "t1"], "left")
    out = out.withColumn("t2", F.col("t1") - F.when(F.col("t1") % 3 == 2, 2).otherwise(1)).join(two, ["conv_id", "t2"], "left")
    return out.select(*key, "role", F.concat_ws("\n", mark(F.col("said2"), ">> "), mark(F.col("said1"), "> "), "text").alias("text"))
