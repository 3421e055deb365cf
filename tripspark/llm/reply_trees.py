"""Chat formatting of reply trees: root-to-leaf paths by iterative self-joins, ranked, each one conversation.

Messages point to their parents. A self-join doubles the reach of every message's ancestor pointer, and each leaf
gathers its ancestors from the pointers of reach 1, 2, 4, ...: after k rounds the lowest 2**k messages of its path. So a tree of
depth d takes log2(d) rounds, each a join on message keys, and no round handles more rows than the paths have.
Branches of a conversation are ranked by the sum of their messages' scores; the first ``best`` are kept (all by default).

Template: ``### role: text </turn>`` and a line end for each turn. Inside roles and texts the escape character and the characters
that start a control string are replaced (``\\`` by ``\\b``, ``#`` by ``\\h``, ``<`` by ``\\l``, in roles ``:`` by ``\\c``),
so no text can hold a control string, and reading back undoes it. The loss mask lists, in code points,
where the assistant's texts stand.

Only DataFrame functions are used. Null texts and roles are empty. A null conversation or message id is an id like any other;
messages of one conversation with the same id are one (the least by parent, role, text). A parent that is not
there makes its child a root; messages that only lead into a cycle have no path. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripspark.llm.common import stored

OPEN, COLON, CLOSE = "### ", ": ", " </turn>\n"
#: Character and its replacement; the escape character itself stands first.
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(x: Column, pairs=ESCAPES) -> Column:
    for plain, written in pairs:
        x = F.replace(x, F.lit(plain), F.lit(written))
    return x


def unescape(x: Column, pairs=ROLE_ESCAPES) -> Column:
    for plain, written in reversed(pairs):
        x = F.replace(x, F.lit(written), F.lit(plain))
    return x


def chains(rows: DataFrame) -> DataFrame:
    """Messages of plain conversations (conv_id, turn, role, text): each answers the one before it.

    Order: turn (null first), role, text. The conversation is the unit of the result, so its rows meet in one task.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    return (rows.select("conv_id", "turn", "role", "text").withColumn("msg_id", F.row_number().over(order))
            .select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score")))


def _key(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("\x00"))


def paths(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored messages (c, m, ...), and (c, leaf, m, up): the messages of each root-to-leaf path, ``up`` steps above its leaf."""
    spark = messages.sparkSession
    said = stored(spark, messages.select(_key("conv_id").alias("c"), _key("msg_id").alias("m"), F.struct(
        F.col("parent_id").cast("string").alias("p"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), "conv_id").alias("x"))
        .groupBy("c", "m").agg(F.min("x").alias("x")).select("c", "m", "x.*"), "messages")
    parents = said.select("c", F.col("m").alias("p")).distinct()
    up = said.select("c", "m", "p").filter("p is not null").join(parents, ["c", "p"]).select("c", "m", F.col("p").alias("a"))
    up = stored(spark, up, "up1")
    answered = up.select("c", F.col("a").alias("m")).distinct()
    parts = [stored(spark, said.select("c", "m").join(answered, ["c", "m"], "left_anti").select("c", F.col("m").alias("leaf"), "m", F.lit(0).alias("up")), "leaves")]
    reach, most = 1, said.count()
    while reach <= most and not up.isEmpty():
        so_far = parts[0]
        for x in parts[1:]:
            so_far = so_far.unionByName(x)
        parts.append(stored(spark, so_far.join(up, ["c", "m"]).select("c", "leaf", F.col("a").alias("m"), (F.col("up") + reach).alias("up")), "path"))
        further = up.select("c", F.col("m").alias("a"), F.col("a").alias("b"))
        up = stored(spark, up.join(further, ["c", "a"]).select("c", "m", F.col("b").alias("a")), "up")
        reach *= 2
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    if reach > most and not up.isEmpty():  # a cycle: a path above a leaf that never ends is longer than all messages
        loops = out.join(up.select("c", "m"), ["c", "m"]).select("c", "leaf").distinct()
        out = out.join(loops, ["c", "leaf"], "left_anti")
    return said, out


def format_paths(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(conv_id, leaf, rank, path_score, formatted, mask): one conversation for each chosen path.

    ``messages``: conv_id, msg_id, parent_id, role, text, score. ``mask``: array of (start, end) in code points.
    """
    said, path = paths(messages)
    full = path.join(said, ["c", "m"])
    rank = F.row_number().over(Window.partitionBy("c").orderBy(F.desc("path_score"), "leaf"))
    ranked = path.join(said.select("c", "m", "score"), ["c", "m"]).groupBy("c", "leaf").agg(F.sum("score").alias("path_score")).withColumn("rank", rank)
    if best is not None:
        ranked = ranked.filter(F.col("rank") <= best)
    head = F.concat(F.lit(OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(COLON))
    body = escape(F.col("text"))
    turns = (full.withColumn("head", head).withColumn("body", body)
             .select("c", "leaf", "conv_id", "up", "role", F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
                     F.length("head").cast("long").alias("before"), F.length("body").cast("long").alias("chars")))
    down = Window.partitionBy("c", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.length("piece").cast("long")).over(down)
    turns = turns.withColumn("start", end - F.length("piece") + F.col("before"))
    mine = F.when(F.col("role") == "assistant", F.struct("start", (F.col("start") + F.col("chars")).alias("end")))
    whole = turns.groupBy("c", "leaf").agg(
        F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(mine)).alias("mask"))
    return (whole.join(ranked, ["c", "leaf"])
            .select("conv_id", "leaf", "rank", "path_score", F.array_join("pieces.piece", "").alias("formatted"), "mask"))


def read_turns(formatted: str) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    pieces = F.split(F.col(formatted), CLOSE, -1)
    at = lambda x: F.instr(x, COLON)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda x: F.struct(
        unescape(F.substring(x, F.lit(len(OPEN) + 1), at(x) - len(OPEN) - 1)).alias("role"),
        unescape(F.substring(x, at(x) + len(COLON), F.length(x))).alias("text")))


def read_loss(formatted: str, mask: str) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.concat_ws("", F.transform(mask, lambda m: unescape(
        F.substring(F.col(formatted), (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))))
