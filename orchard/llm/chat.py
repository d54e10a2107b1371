"""Chat formatting over reply trees.

Messages form trees (``parent_id`` null: a root).  Self-joins that double the
jump length find, for every message, its depth and the summed score from the
root in about log2(depth) rounds; leaves are ranked by that score and the
chosen leaves' ancestors are listed by walking the stored jumps from the
longest down, so the work is the size of the chosen paths and not depth times
messages.  Each chosen path becomes one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn.  Inside roles and
texts a backslash becomes two and ``<|`` becomes ``<\\|``, so the control
strings occur only where the template writes them; a line feed in a role
becomes backslash-n.  ``parse`` undoes this from the formatted string alone.

Nulls and odd rows: null text or role reads as empty; a null ``conv_id`` is a
conversation of its own; null turns come first; rows that share a turn are
ordered by role and text and follow one another; an empty table gives an empty
result.  One conversation is one output string, so a conversation must fit in
a task; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import materialize

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    parts = F.split(text, r"\\\\")
    plain = F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
    return F.array_join(plain, "\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def linear_messages(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as a tree of one branch each."""
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    t = t.withColumn("msg_id", at)
    return t.select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def best_paths(messages: DataFrame, per_tree: int = 1, max_rounds: int = 40) -> DataFrame:
    """(conv_id, path, msg_id, depth) of the ``per_tree`` best leaves of each
    conversation, ranked by the mean score from root to leaf, then by leaf id."""
    tree = messages.select("conv_id", "msg_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    jumps = []
    at = materialize(tree.select("conv_id", "msg_id", F.col("parent_id").alias("jump"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total")), "chat-jump")
    for _ in range(max_rounds):
        jumps.append(at.where("jump is not null").select("conv_id", "msg_id", "jump"))
        up = at.select(F.col("conv_id").alias("c"), F.col("msg_id").alias("m"), F.col("jump").alias("far"), F.col("depth").alias("more"), F.col("total").alias("sum"))
        on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("jump") == F.col("m"))
        opened = at.where("jump is not null").join(up, on, "left").select("conv_id", "msg_id", F.col("far").alias("jump"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), (F.col("total") + F.coalesce("sum", F.lit(0.0))).alias("total"))
        at = materialize(at.where("jump is null").unionByName(opened), "chat-jump")
        if at.where("jump is not null").limit(1).count() == 0:
            break
    else:
        raise ValueError("the reply links hold a cycle")
    parents = tree.where("parent_id is not null").select(F.col("conv_id").alias("c"), F.col("parent_id").alias("m")).distinct()
    leaves = at.join(parents, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("msg_id") == F.col("m")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy((F.col("total") / F.col("depth")).desc(), "msg_id"))
    paths = leaves.withColumn("path", rank).where(F.col("path") <= per_tree).select("conv_id", "path", "msg_id", "depth")
    # A path's messages: apply the jumps of 2**k, longest first, to all found so far.
    for k in reversed(range(len(jumps))):
        hop = jumps[k].select(F.col("conv_id").alias("c"), F.col("msg_id").alias("m"), "jump")
        more = paths.join(hop, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("msg_id") == F.col("m"))).select("conv_id", "path", F.col("jump").alias("msg_id"), (F.col("depth") - 2**k).alias("depth"))
        paths = materialize(paths.unionByName(more), "chat-path")
    return paths


def format_paths(messages: DataFrame, paths: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, path, formatted, loss_spans): spans are [start, end) in code
    points of ``formatted`` and cover the texts of ``loss_role``."""
    m = messages.select(F.col("conv_id").alias("c"), F.col("msg_id").alias("m"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = paths.join(m, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("msg_id") == F.col("m")))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    t = t.select("conv_id", "path", "depth", (F.col("role") == loss_role).alias("loss"), head.alias("head"), escape(F.col("text")).alias("body"))
    t = t.withColumn("whole", F.concat("head", "body", F.lit(END + "\n")))
    line = Window.partitionBy("conv_id", "path").orderBy("depth")
    before = F.coalesce(F.sum(F.length("whole")).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    t = t.withColumn("start", before + F.length("head")).withColumn("end", F.col("start") + F.length("body"))
    t = t.groupBy("conv_id", "path").agg(F.array_sort(F.collect_list(F.struct("depth", "whole", "loss", "start", "end"))).alias("turns"))
    spans = F.transform(F.filter("turns", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return t.select("conv_id", "path", F.array_join(F.transform("turns", lambda x: x["whole"]), "").alias("formatted"), spans.alias("loss_spans"))


def parse(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def one(p: Column) -> Column:
        body = F.substring(p, F.lit(len(START) + 1), F.length(p))
        cut = F.length(F.substring_index(body, "\n", 1))
        return F.struct(unescape(F.substring(body, F.lit(1), cut)).alias("role"), unescape(F.substring(body, cut + 2, F.length(body))).alias("text"))

    return F.transform(pieces, one)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, read back and joined."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
