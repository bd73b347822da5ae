"""Reply trees to training conversations, with DataFrame functions only.

Messages point to the message they answer. Self-joins double the distance that
each message sees up its tree, so the paths from all leaves to their roots are
known after a number of joins that grows with the logarithm of the depth. The
branches of a tree are ranked by the mean score of their messages, and the best
ones are written out by going through the same joins backwards.

A conversation is formatted turn by turn as ``### role``, a line feed, the text
and ``</turn>`` with a line feed. Inside texts a backslash marks control strings
(``\\\\`` for a backslash, ``\\###``, ``<\\/turn>``), and role names are URL-encoded,
so every text can be read back. The loss mask is a list of spans over the
assistant texts.

Nulls: a null text or role is an empty one, a null tree id is a tree of its own,
a null score counts as 0, and a message whose parent is null or missing begins a
tree. Messages on a circle have no root and are left out. Of rows with the same
tree and id one stays. Ties go to the longer branch, then to the smaller leaf.
Empty tables give empty results; extra columns are dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.session import stage

END = "</turn>\n"
HEAD = "### "
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    """Text without the control strings of the template."""
    for plain, marked in (("\\", "\\\\"), ("</turn>", "<\\/turn>"), ("###", "\\###")):
        text = F.replace(text, F.lit(plain), F.lit(marked))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _same(left: str, right: str, columns: dict[str, str]) -> Column:
    """Equality of columns of two aliased tables, nulls being equal to each other."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{x}").eqNullSafe(F.col(f"{right}.{y}")) for x, y in columns.items()])


def _meet(left: DataFrame, right: DataFrame, columns: dict[str, str], how: str = "inner") -> DataFrame:
    """Join of tables aliased a and b; both grow with the messages, so both are shuffled at every size."""
    return left.alias("a").join(right.hint("merge").alias("b"), _same("a", "b", columns), how)


def best_branches(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Messages of the best root-to-leaf paths: tree, leaf, rank, place (0 at the root), role, text.

    ``messages`` has tree, id, parent, role, text and score.
    """
    rows = messages.where("id is not null").select(
        "tree", "id", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0)).cast("double").alias("score")
    )
    rows = stage(rows.groupBy("tree", "id").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m")).select("tree", "id", "m.*"), "messages")
    ids = rows.select("tree", "id")
    known = _meet(rows, ids, {"tree": "tree", "parent": "id"}, "left").withColumn("up", F.when(F.col("a.parent").isNotNull(), F.col("b.id")))
    # up: the message that many steps above; total and steps: of the messages from here to below it.
    jump = stage(known.select("a.tree", "a.id", "up", F.col("a.score").alias("total"), F.lit(1).cast("long").alias("steps")), "jump")
    jumps, size = [], rows.count()
    answered = jump.select("tree", F.col("up").alias("id")).where("id is not null").distinct()
    while jump.where("up is not null").limit(1).count() and 2 ** len(jumps) <= size:
        jumps.append(jump)
        far = _meet(jump.where("up is not null"), jump, {"tree": "tree", "up": "id"})
        add = lambda c: (F.col(f"a.{c}") + F.col(f"b.{c}")).alias(c)
        far = far.select("a.tree", "a.id", "b.up", add("total"), add("steps"))
        jump = stage(far.union(jump.where("up is null")), "jump")
    leaves = _meet(jump.where("up is null"), answered, {"tree": "tree", "id": "id"}, "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("steps")), F.desc("steps"), "id")
    path = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    path = path.select("tree", F.col("id").alias("leaf"), "rank", "id", (F.col("steps") - 1).alias("place"))
    for step, table in reversed(list(enumerate(jumps))):
        higher = _meet(path, table.where("up is not null"), {"tree": "tree", "id": "id"})
        path = stage(path.union(higher.select("a.tree", "a.leaf", "a.rank", "b.up", F.col("a.place") - 2**step)), "path")
    found = _meet(path, rows, {"tree": "tree", "id": "id"})
    return found.select("a.tree", "a.leaf", "a.rank", "a.place", "b.role", "b.text")


def format_paths(paths: DataFrame) -> DataFrame:
    """tree, leaf, rank, formatted text and loss_spans (start and length in characters of escaped assistant texts)."""
    turns = F.sort_array(F.collect_list(F.struct("place", "role", "text")))
    grouped = paths.groupBy("tree", "leaf", "rank").agg(turns.alias("turns"))
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(HEAD), F.url_encode(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"), (t["role"] == ASSISTANT).alias("loss")
        ),
    )
    grouped = grouped.withColumn("parts", parts).drop("turns")
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def walk(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["head"])
        own = F.array(F.struct(begin.alias("start"), F.length(p["body"]).alias("length")))
        return F.struct((begin + F.length(p["body"]) + len(END)).alias("at"), F.when(p["loss"], F.concat(state["spans"], own)).otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate("parts", empty, walk, lambda s: s["spans"])
    return grouped.select("tree", "leaf", "rank", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Formatted rows with turns (role, text) and loss (unescaped text under the mask, in order)."""
    pieces = F.split("formatted", END)
    body = lambda p: F.substring(p, F.instr(p, "\n") + 1, F.length(p))
    turns = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(F.url_decode(F.substring_index(F.substring(p, F.lit(len(HEAD) + 1), F.length(p)), "\n", 1)).alias("role"), unescape(body(p)).alias("text")),
    )
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    return formatted.withColumn("turns", turns).withColumn("loss", loss)


def turn_messages(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as messages: each row answers the row before.

    Every row is kept. Rows that share a turn follow each other: system, user,
    other roles by name, assistant, then by text; equal rows one after the other.
    Null roles and texts are empty ones.
    """
    speaks = F.when(F.col("role") == "system", 0).when(F.col("role") == "user", 1).when(F.col("role") == ASSISTANT, 3).otherwise(2)
    own = Window.partitionBy("conv_id", "turn").orderBy(speaks, "role", "text", "copy")
    plain = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    # Copies of a row are numbered from their count, which combines before the shuffle.
    copies = plain.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rows = copies.withColumn("place", F.row_number().over(own)).drop("copies", "copy")
    order = Window.partitionBy("conv_id").orderBy("turn", "place")
    before = rows.select("conv_id", "turn", "place").withColumn("before", F.lag(F.struct("turn", "place")).over(order))
    joined = _meet(rows, before, {"conv_id": "conv_id", "turn": "turn", "place": "place"})
    return joined.select(
        F.col("a.conv_id").alias("tree"), F.struct(F.col("a.turn"), F.col("a.place")).alias("id"), F.col("b.before").alias("parent"), "a.role", "a.text", F.lit(0.0).alias("score")
    )


def digests(conversations: DataFrame) -> DataFrame:
    """Every conversation formatted and read back: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    read = read_back(stage(format_paths(best_branches(turn_messages(conversations))), "formatted"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
