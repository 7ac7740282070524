"""Reply trees as training conversations: every chosen root-to-leaf path becomes one text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from yieldlens.llm.storage import Workspace

# The template: START role MIDDLE text END and a line end for every turn.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
# Control strings of this and other common templates begin so; texts must not hold them unescaped.
_CONTROL = r"(<)(?=\||/?s>)|(\[)(?=/?INST\])"
# Paths of more than two to this power turns are taken for cycles.
MOST_DOUBLINGS = 40


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put behind the first character of every control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    """What ``escaped`` was given: after a backslash, the next character stands for itself."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def jumps(nodes: DataFrame, space: Workspace) -> list[DataFrame]:
    """Tables of (node, up, score, turns): the ancestor two to the power of k replies up, if there is any.

    Each is the self-join of the one before, so that the longest path of n turns takes log n joins.
    ``score`` and ``turns`` are totals from the node up to but without ``up``; where ``up`` is null they
    are those of the whole branch.
    """
    found = [space.keep(nodes.select("node", F.col("parent").alias("up"), "score", F.lit(1).cast("long").alias("turns")), "jump-0")]
    while not found[-1].filter("up IS NOT NULL").isEmpty():
        if len(found) > MOST_DOUBLINGS:
            raise ValueError("replies form a cycle")
        low = found[-1]
        high = low.select(F.col("node").alias("up"), *[F.col(c).alias(f"high_{c}") for c in ("up", "score", "turns")])
        # What has come to its root stays as it is and is not joined again.
        further = low.filter("up IS NOT NULL").join(high, "up").select(
            "node",
            F.col("high_up").alias("up"),
            (F.col("score") + F.col("high_score")).alias("score"),
            (F.col("turns") + F.col("high_turns")).alias("turns"),
        )
        found.append(space.keep(further.unionByName(low.filter("up IS NULL")), f"jump-{len(found)}"))
    return found


def branches(messages: DataFrame, best: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The chosen branches and their turns.

    ``messages`` has ``tree``, ``node``, ``parent``, ``role``, ``text`` and ``score``. A parent that is not
    a node of the table, or null, makes its message a root; a message without ``node`` is left out. Of messages with one ``node`` the least by all
    other columns counts. A branch runs from a root to a message without reply; its score is the sum of its
    messages' scores, null counting as 0. ``best`` keeps that many branches of a tree, by score, then by
    node; None keeps all. Returns (tree, leaf, rank, score, n_turns), with a null rank if all are kept, and
    (leaf, up, node), ``up`` being the number of replies from the node to the leaf. A cycle of replies fails.
    """
    space = Workspace(messages.sparkSession, "chat")
    messages = messages.filter("node IS NOT NULL")
    parents = messages.select(F.col("node").alias("parent")).distinct().withColumn("known", F.lit(True))
    linked = messages.select("tree", "node", "parent", "score").join(parents, "parent", "left")
    nodes = space.keep(
        linked.groupBy("node")
        .agg(
            F.min(
                F.struct(
                    "tree",
                    F.when(F.col("known"), F.col("parent")).alias("parent"),
                    F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
                )
            ).alias("m")
        )
        .select("node", "m.*"),
        "nodes",
    )
    tables = jumps(nodes, space)
    replied = nodes.select(F.col("parent").alias("node"))
    leaves = (
        tables[-1].join(replied, "node", "left_anti").join(nodes.select("node", "tree"), "node")
        .select("tree", F.col("node").alias("leaf"), "score", F.col("turns").alias("n_turns"))
    )
    if best is None:
        chosen = leaves.withColumn("rank", F.lit(None).cast("int"))
    else:
        order = W.partitionBy("tree").orderBy(F.col("score").desc(), "leaf")
        chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    chosen = space.keep(chosen, "chosen")
    # Every distance to the leaf is one sum of powers of two: from the largest jump down, each adds its share.
    path = chosen.select("leaf", F.lit(0).cast("long").alias("up"), F.col("leaf").alias("node"))
    for k in range(len(tables) - 2, -1, -1):
        jump = tables[k].filter("up IS NOT NULL").select("node", F.col("up").alias("there"))
        step = path.join(jump, "node").select("leaf", (F.col("up") + 2**k).alias("up"), F.col("there").alias("node"))
        # Stored, for the next round reads it twice.
        path = space.keep(path.unionByName(step), f"path-{k}")
    return chosen, path


def format_branches(messages: DataFrame, best: int | None = None) -> DataFrame:
    """One row per chosen branch: ``tree``, ``leaf``, ``rank``, ``score``, ``n_turns``, ``formatted``, ``loss_spans``.

    See ``branches`` for the input and the choice. ``formatted`` holds the turns from root to leaf; null
    roles and texts count as empty; control strings in them are escaped, ``parsed`` gives them back.
    ``loss_spans`` are the places (code points, end exclusive) of the assistant's texts. Other columns are
    not read. No messages give no rows.
    """
    chosen, path = branches(messages, best)
    texts = (
        messages.groupBy("node")
        .agg(F.min(F.struct("tree", "parent", "score", "role", "text")).alias("m"))
        .select("node", *[F.coalesce(f"m.{c}", F.lit("")).alias(c) for c in ("role", "text")])
        .withColumns({"head": F.concat(F.lit(START), escaped(F.col("role")), F.lit(MIDDLE)), "body": escaped(F.col("text"))})
    )
    turns = path.join(texts, "node")
    before = W.partitionBy("leaf").orderBy(F.col("up").desc()).rowsBetween(W.unboundedPreceding, -1)
    length = F.length("head") + F.length("body") + len(END)
    begins = (F.coalesce(F.sum(length).over(before), F.lit(0)) + F.length("head")).alias("begins")
    placed = turns.select("leaf", "up", "role", F.concat("head", "body", F.lit(END)).alias("turn"), F.length("body").alias("size"), begins)
    whole = placed.groupBy("leaf").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("place"), "turn", "role", "begins", "size"))).alias("turns")
    )
    mask = F.transform(
        F.filter("turns", lambda t: t["role"] == "assistant"),
        lambda t: F.struct(t["begins"].cast("long").alias("start"), (t["begins"] + t["size"]).cast("long").alias("end")),
    )
    return chosen.join(
        whole.select(
            "leaf", F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("formatted"), mask.alias("loss_spans")
        ),
        "leaf",
    ).select("tree", "leaf", "rank", "score", "n_turns", "formatted", "loss_spans")


def parsed(formatted: Column) -> Column:
    """The turns of a formatted text as array<struct<role, text>>, read from the marks alone."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda _, i: i > 0)
    body = r"(?s)^(.*?)<\|im_sep\|>(.*)<\|im_end\|>\n$"
    return F.transform(
        parts,
        lambda p: F.struct(
            unescaped(F.regexp_extract(p, body, 1)).alias("role"), unescaped(F.regexp_extract(p, body, 2)).alias("text")
        ),
    )


def under_mask(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped, with nothing between."""
    cut = F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return F.array_join(cut, "")


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Plain conversations as trees without branches: each row answers the one before, by turn, role and text."""
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = conversations.select("conv_id", "role", "text", F.row_number().over(order).alias("place"))
    node = lambda place: F.struct(F.col("conv_id").alias("conv"), place.cast("long").alias("place"))
    return placed.select(
        F.col("conv_id").alias("tree"),
        node(F.col("place")).alias("node"),
        F.when(F.col("place") > 1, node(F.col("place") - 1)).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def digests(branches_: DataFrame) -> DataFrame:
    """What can be read back from formatted branches."""
    loss = under_mask(F.col("formatted"), F.col("loss_spans"))
    spoken = F.array_join(F.transform(parsed(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return branches_.select(
        F.col("tree").alias("conv_id"),
        F.size(parsed(F.col("formatted"))).cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
