"""Reply trees to conversations with a loss mask (operator 11).

Messages name the message they reply to. Self-joins that double the distance give every message
its ancestor 2**i steps up and the score of the way there, so the leaves of a tree of depth d know their
root, depth and path score after log2(d) joins. The best leaves of each tree are kept, and
the same tables, taken from the longest distance down, put every message of a chosen path on it
exactly once. Text joins the path only then, and turns are put together in blocks before a
path becomes one row, so a long conversation is not gathered row by row in one task.

Template, per turn: user ``[INST]text[/INST]``, assistant ``<s>text</s>``, system
``<<SYS>>text<</SYS>>``, any other role ``<<ROLE>>role<<TURN>>text<</ROLE>>``. Inside texts and roles
a backslash is put after the first character of a control string and before every backslash, so no
control string is left there and ``plain`` gives the exact text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuflow.llm.common import stage

#: Turns put together before a conversation becomes one row.
BLOCK = 256
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
ROLE_OPEN, ROLE_TEXT, ROLE_CLOSE = "<<ROLE>>", "<<TURN>>", "<</ROLE>>"
#: The first character of every control string.
_CONTROL = r"\[(?=/?INST\])|<(?=/?s>|</?(?:SYS|ROLE)>>|<TURN>>)"


def escape(text: Column) -> Column:
    """``text`` without control strings: each has a backslash after its first character, a backslash is doubled."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), _CONTROL, r"$0\\")


def plain(escaped: Column) -> Column:
    """The text that ``escape`` was given."""
    return F.regexp_replace(escaped, r"(?s)\\(.)", "$1")


def in_order(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with their number from 0 in the order of ``by``, without a window over all of them.

    Rows are dealt by ranges of ``by`` and sorted within each; a range's number of rows gives
    the next ones their offset (one small row a range goes to the driver's plan as a broadcast).
    Equal rows of one range may take each other's number.
    """
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    kept = stage(dealt.withColumn("_range", F.spark_partition_id())
                 .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "chat-order")
    sizes = kept.groupBy(F.col("_range").alias("_of")).agg(F.max("_at").alias("_last"))
    # _of numbers ranges: prefix sums over at most as many rows as there are shuffle partitions
    offsets = (sizes.agg(F.array_sort(F.collect_list(F.struct("_of", (F.col("_last") + 1).alias("n")))).alias("s"))
               .select(F.posexplode("s").alias("i", "r"), "s")
               .select(F.col("r._of").alias("_of"), F.aggregate(F.slice("s", F.lit(1), F.col("i")), F.lit(0).cast("long"),
                                                                 lambda total, x: total + x["n"]).alias("_before")))
    return (kept.join(F.broadcast(offsets), F.col("_range") == F.col("_of"))
            .withColumn(name, F.col("_before") + F.col("_at")).drop("_range", "_at", "_of", "_before"))


def chains(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Messages (tree_id, node_id, parent_id, role, text, score) of flat conversations: each row replies to the one before.

    Rows of one conversation follow by turn, role and text, nulls first; equal rows are turns of their
    own. Rows without a conversation id form one conversation without an id.
    """
    flat = turns.select(F.col(conv_col).cast("long").alias("tree_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    rows = in_order(flat, ["tree_id", "turn", "role", "text"], "node_id")
    first = rows.groupBy("tree_id").agg(F.min("node_id").alias("_first"))
    firsts = first.select("_first").withColumn("_starts", F.lit(True))
    # a conversation's rows have neighbouring numbers, so only its first row has no parent
    return (rows.join(firsts, rows["node_id"] == F.col("_first"), "left")
            .withColumn("parent_id", F.when(F.col("_starts").isNull(), F.col("node_id") - 1))
            .select("tree_id", "node_id", "parent_id", "role", "text", F.lit(0.0).alias("score")))


def best_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(tree_id, path, rank, node_id, turn): the messages of the ``keep`` best root-to-leaf paths of each tree.

    ``messages`` has node_id (long, unique), parent_id (long or null), tree_id and score (null: 0). A message whose
    parent is null or absent is a root; messages that only lead round in a circle have no root, and messages
    without a node_id no place: they are on no path. A path's score is the sum of its messages'; ties go to the smaller leaf. ``path`` is the leaf's id, ``turn``
    counts from 0 at the root. Ranking keeps ``keep`` leaves per tree by a map-side top list.
    """
    nodes = messages.select("tree_id", "node_id", "parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    replies = nodes.where("parent_id is not null")
    ids = nodes.select(F.col("node_id").alias("_known"))
    linked = stage(replies.join(ids, F.col("parent_id") == F.col("_known"), "left").select("tree_id", "node_id", F.col("_known").alias("up"), "score")
                   .union(nodes.where("parent_id is null").select("tree_id", "node_id", F.lit(None).cast("long").alias("up"), "score")),
                   "chat-linked")
    step = linked.select("node_id", "up", "score", F.lit(1).cast("long").alias("steps"))
    # ways[i] leads 2**i steps up; who passes a root on the way is done, with the score and steps to the root
    ways, done = [step.where("up is not null")], step.where("up is null").drop("up")
    most = nodes.count()
    while not ways[-1].isEmpty() and 1 << len(ways) <= most:
        low = ways[-1]
        known = low.unionByName(done, allowMissingColumns=True)
        high = known.select(F.col("node_id").alias("_mid"), F.col("up").alias("_top"), F.col("score").alias("_more"),
                            F.col("steps").alias("_steps"))
        wider = stage(low.join(high, F.col("up") == F.col("_mid")).select(
            "node_id", F.col("_top").alias("up"), (F.col("score") + F.col("_more")).alias("score"),
            (F.col("steps") + F.col("_steps")).alias("steps")), "chat-way")
        ways.append(wider.where("up is not null"))
        done = done.union(wider.where("up is null").drop("up"))
    inner = linked.where("up is not null").select(F.col("up").alias("_inner")).distinct()
    leaves = (linked.join(inner, linked["node_id"] == F.col("_inner"), "left_anti")
              .select("tree_id", F.col("node_id").alias("leaf"))
              .join(done, F.col("leaf") == F.col("node_id")).select("tree_id", "leaf", "score", "steps"))
    order = F.struct((-F.col("score")).alias("s"), F.col("leaf").alias("leaf"), F.col("steps").alias("steps"))
    if keep == 1:
        top = leaves.groupBy("tree_id").agg(F.min(order).alias("b")).withColumn("rank", F.lit(1).cast("long"))
    else:
        lists = leaves.withColumn("_part", F.pmod(F.xxhash64("leaf"), F.lit(64))).groupBy("tree_id", "_part").agg(
            F.slice(F.array_sort(F.collect_list(order)), 1, keep).alias("l"))
        top = (lists.groupBy("tree_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("l"))), 1, keep).alias("l"))
               .select("tree_id", F.posexplode("l").alias("_i", "b")).withColumn("rank", F.col("_i").cast("long") + 1))
    chosen = top.select("tree_id", F.col("b.leaf").alias("path"), "rank", F.col("b.leaf").alias("node_id"),
                        (F.col("b.steps") - 1).alias("turn"))
    for i in reversed(range(len(ways))):
        up = ways[i].select(F.col("node_id").alias("_node"), F.col("up").alias("_up"))
        above = chosen.join(up, F.col("node_id") == F.col("_node")).select(
            "tree_id", "path", "rank", F.col("_up").alias("node_id"), (F.col("turn") - (1 << i)).alias("turn"))
        chosen = chosen.union(above) if i == 0 else stage(chosen.union(above), "chat-paths")
    return chosen


def format_conversations(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(tree_id, path, rank, n_turns, formatted, segments): one row per chosen path.

    ``formatted`` is the templated text; ``segments`` are its pieces in order (text, loss), whose texts joined
    are ``formatted``; loss marks the assistant's texts and nothing else. Null roles and texts count as empty.
    Of messages that repeat a node_id the first by tree, parent, score, role and text counts. A path without
    messages does not exist, so an empty table gives an empty result.
    """
    messages = _one_each(messages)
    paths = best_paths(messages, keep)
    texts = messages.select(F.col("node_id").alias("_id"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = F.col("role").isin(*MARKS)
    begin, end = F.lit(ROLE_CLOSE), F.lit(ROLE_CLOSE)
    begin = F.concat(F.lit(ROLE_OPEN), escape(F.col("role")), F.lit(ROLE_TEXT))
    for role, (a, b) in MARKS.items():
        begin = F.when(F.col("role") == role, F.lit(a)).otherwise(begin)
        end = F.when(F.col("role") == role, F.lit(b)).otherwise(end)
    turns = paths.join(texts, F.col("node_id") == F.col("_id")).select(
        "tree_id", "path", "rank", "turn", begin.alias("begin"), escape(F.col("text")).alias("body"), end.alias("end"),
        (known & (F.col("role") == "assistant")).alias("loss"))
    piece = F.struct("turn", "begin", "body", "end", "loss")
    blocks = turns.groupBy("tree_id", "path", "rank", F.floor(F.col("turn") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"))
    whole = blocks.groupBy("tree_id", "path", "rank").agg(F.array_sort(F.collect_list(F.struct("block", "pieces"))).alias("b"))
    pieces = F.flatten(F.col("b.pieces"))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    segments = F.flatten(F.transform(pieces, lambda t: F.array(
        segment(t["begin"], no), segment(t["body"], t["loss"]), segment(t["end"], no))))
    return (whole.select("tree_id", "path", "rank", F.size(pieces).cast("long").alias("n_turns"), segments.alias("segments"))
            .withColumn("formatted", F.array_join(F.col("segments.text"), "")))


def _one_each(messages: DataFrame) -> DataFrame:
    names = ["tree_id", "parent_id", "score", "role", "text"]
    known = messages.where("node_id is not null").select("node_id", *names)
    if known.groupBy("node_id").count().where("count > 1").isEmpty():
        return known
    return known.groupBy("node_id").agg(F.min(F.struct(*names)).alias("m")).select("node_id", "m.*")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, as an array of structs."""
    shape = "|".join([*(_quoted(a) + "(.*?)" + _quoted(b) for a, b in MARKS.values()),
                      _quoted(ROLE_OPEN) + "(.*?)" + _quoted(ROLE_CLOSE)])
    found = F.regexp_extract_all(formatted, F.lit("(?s)" + shape), F.lit(0))

    def turn(piece: Column) -> Column:
        other = F.substring_index(F.substr(piece, F.lit(len(ROLE_OPEN) + 1)), ROLE_TEXT, 1)
        role, body = other, F.substr(piece, F.length(other) + len(ROLE_OPEN + ROLE_TEXT) + 1,
                                     F.length(piece) - F.length(other) - len(ROLE_OPEN + ROLE_TEXT + ROLE_CLOSE))
        for name, (a, b) in MARKS.items():
            role = F.when(piece.startswith(a), F.lit(name)).otherwise(role)
            body = F.when(piece.startswith(a), F.substr(piece, F.lit(len(a) + 1), F.length(piece) - len(a + b))).otherwise(body)
        return F.struct(plain(role).alias("role"), plain(body).alias("text"))

    return F.transform(found, turn)


def _quoted(mark: str) -> str:
    return mark.replace("[", r"\[").replace("]", r"\]")


def digest(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from ``format_conversations``: turns and the text under the loss mask, as digests."""
    lines = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: plain(s["text"]))
    return (formatted.withColumn("_turns", read_back(F.col("formatted"))).withColumn("_loss", F.array_join(under, ""))
            .select(F.col("tree_id").alias("conv_id"), F.size("_turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                    F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))
