"""Chat formatting of reply trees.

Messages form trees by their parent ids. Root-to-leaf paths are enumerated by iterative self-joins that double the
distance to the ancestor known (pointer jumping), so a tree of depth d takes log2(d) joins; branches are ranked by
score within their tree; each chosen path is formatted as one conversation with turn markers and a loss mask.

Markers: `<s>` and `</s>` around a conversation; `[INST]..[/INST]` a user's turn, `[SYS]..[/SYS]` a system's,
`[OUT]..[/OUT]` an assistant's, `[TURN role]..[/TURN]` any other. Inside texts every string that could start a marker
gets a backslash after its first character (one more if backslashes stand there already), which unescape() undoes.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut

_MARKER = r"(/?(?:INST|SYS|OUT|TURN|s>))"
_TAGS = {"user": "INST", "system": "SYS", "assistant": "OUT"}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([\[<])(\\*){_MARKER}", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([\[<])\\(\\*){_MARKER}", "$1$2$3")


def linear_messages(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """Messages (tree_id, message_id, parent_id, role, text, score) of plain conversations: each turn replies to the last.

    Turns are numbered by turn, then role and text, so repeated turn numbers keep all their rows; null turns come
    first; null roles and texts become empty; all scores are zero.
    """
    rows = turns.select(
        F.col(conv_col).alias("tree_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("tree_id").orderBy("turn", "role", F.xxhash64("text"))
    rows = rows.withColumn("message_id", F.row_number().over(order).cast("bigint"))
    parent = F.when(F.col("message_id") > 1, F.col("message_id") - 1)
    return rows.select("tree_id", "message_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def branches(messages: DataFrame, best: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """The chosen leaves (tree_id, leaf, n, score, rank) and the jump tables that enumerate their paths.

    A branch's score is the mean score of its messages (null scores count as zero); rank 1 is the best branch of its
    tree, ties by the smaller leaf id; `best` keeps that many a tree, None keeps all. Jump table k maps a message to
    its ancestor 2^k steps up. A parent that is missing makes a root; messages on or below a cycle have no root and
    so are on no path.
    """
    nodes = messages.select(
        "tree_id", F.col("message_id").alias("id"), F.col("parent_id").alias("up"), F.coalesce("score", F.lit(0.0)).alias("s")
    )
    there = nodes.select(F.col("tree_id").alias("t"), F.col("id").alias("p"))
    same = F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("up") == F.col("p"))
    state = nodes.join(there, same, "left").select("tree_id", "id", F.col("p").alias("up"), F.lit(1).cast("bigint").alias("n"), "s")
    state = cut(state)
    children = state.where("up is not null").select(F.col("tree_id").alias("t"), F.col("up").alias("p")).distinct()
    jumps, open_before = [], None
    while True:
        still_open = state.where("up is not null").count()
        if still_open == 0 or still_open == open_before:
            break
        open_before = still_open
        jumps.append(state.where("up is not null").select("tree_id", "id", "up"))
        above = state.select(*[F.col(c).alias(f"a_{c}") for c in state.columns])
        same = F.col("tree_id").eqNullSafe(F.col("a_tree_id")) & (F.col("up") == F.col("a_id"))
        moved = state.where("up is not null").join(above, same, "left").select(
            "tree_id",
            "id",
            F.col("a_up").alias("up"),
            (F.col("n") + F.coalesce("a_n", F.lit(0))).alias("n"),
            (F.col("s") + F.coalesce("a_s", F.lit(0.0))).alias("s"),
        )
        state = cut(state.where("up is null").unionByName(moved))  # messages that know their root wait
    same = F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("id") == F.col("p"))
    leaves = state.where("up is null").join(children, same, "left_anti")
    leaves = leaves.select("tree_id", F.col("id").alias("leaf"), "n", (F.col("s") / F.col("n")).alias("score"))
    order = [F.col("score").desc(), F.col("leaf")]
    if best is not None:  # first within salted parts, so that one huge tree is ranked by many tasks
        part = Window.partitionBy("tree_id", "salt").orderBy(*order)
        leaves = leaves.withColumn("salt", F.pmod(F.xxhash64("leaf"), F.lit(64)))
        leaves = leaves.withColumn("r", F.row_number().over(part)).where(F.col("r") <= best).drop("salt", "r")
    leaves = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree_id").orderBy(*order)))
    return (leaves if best is None else leaves.where(F.col("rank") <= best)), jumps


def paths(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(tree_id, leaf, position, id): every message of each chosen path, position 0 at the root."""
    found = chosen.select("tree_id", "leaf", (F.col("n") - 1).alias("position"), F.col("leaf").alias("id"))
    for k in reversed(range(len(jumps))):
        jump = jumps[k].select(F.col("tree_id").alias("t"), F.col("id").alias("from"), F.col("up").alias("to"))
        same = F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("id") == F.col("from"))
        above = F.struct((F.col("position") - 2**k).alias("position"), F.col("to").alias("id"))
        both = F.array_compact(F.array(F.struct("position", "id"), F.when(F.col("to").isNotNull(), above)))
        found = found.join(jump, same, "left").select("tree_id", "leaf", F.explode(both).alias("m")).select("tree_id", "leaf", "m.*")
    return found


def _tag(role: Column) -> Column:
    tag = F.lit("TURN")
    for name, short in _TAGS.items():
        tag = F.when(role == name, F.lit(short)).otherwise(tag)
    return tag


def format_chats(messages: DataFrame, best: int | None = None) -> DataFrame:
    """One row per chosen branch: tree_id, leaf, rank, score, formatted, loss_spans.

    messages: tree_id, message_id, parent_id, role, text, score; message ids are unique within a tree. loss_spans are
    the code point ranges [start, stop) of the assistant's (escaped) texts in `formatted`. Null roles and texts count
    as empty; an empty table gives no rows; other columns are ignored.
    """
    messages = cut(messages.select("tree_id", "message_id", "parent_id", "role", "text", "score"))
    chosen, jumps = branches(messages, best)
    chosen = cut(chosen)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = messages.select(F.col("tree_id").alias("t"), F.col("message_id").alias("m"), role.alias("role"), text.alias("text"))
    same = F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("id") == F.col("m"))
    tag = _tag(F.col("role"))
    head = F.when(tag == "TURN", F.concat(F.lit("[TURN "), F.url_encode("role"), F.lit("]")))
    parts = paths(chosen, jumps).join(said, same).select(
        "tree_id",
        "leaf",
        "position",
        (F.col("role") == "assistant").alias("loss"),
        head_or_short(head, tag).alias("head"),
        escape(F.col("text")).alias("body"),
        F.concat(F.lit("[/"), tag, F.lit("]")).alias("tail"),
    )
    turn = F.struct("position", "loss", "head", "body", "tail")
    whole = parts.groupBy("tree_id", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted = F.concat(
        F.lit("<s>"), F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], t["tail"])), ""), F.lit("</s>")
    )
    start = F.struct(F.lit(3).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + F.length(t["head"])
        end = begin + F.length(t["body"])
        span = F.struct(begin.alias("start"), end.alias("stop"))
        spans = F.when(t["loss"], F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct((end + F.length(t["tail"])).alias("at"), spans.alias("spans"))

    spans = F.aggregate("turns", start, step, lambda s: s["spans"])
    whole = whole.select("tree_id", "leaf", formatted.alias("formatted"), spans.alias("loss_spans"))
    ranked = chosen.select(F.col("tree_id").alias("t"), F.col("leaf").alias("l"), "rank", "score")
    same = F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("l"))
    return whole.join(ranked, same).select("tree_id", "leaf", "rank", "score", "formatted", "loss_spans")


def head_or_short(head: Column, tag: Column) -> Column:
    return F.coalesce(head, F.concat(F.lit("["), tag, F.lit("]")))


def read_turns(formatted: Column) -> Column:
    """The turns array<struct<role, text>> that a formatted conversation holds, unescaped."""
    inner = F.substring(formatted, F.lit(4), F.length(formatted) - 7)
    pieces = F.filter(F.split(inner, r"\[/(?:INST|SYS|OUT|TURN)\]", -1), lambda p, k: F.length(p) > 0)
    pattern = r"(?s)^\[(INST|SYS|OUT|TURN)(?: ([^\]]*))?\](.*)$"

    def turn(piece: Column) -> Column:
        tag = F.regexp_extract(piece, pattern, 1)
        role = F.url_decode(F.regexp_extract(piece, pattern, 2))
        for name, short in _TAGS.items():
            role = F.when(tag == short, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(F.regexp_extract(piece, pattern, 3)).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined in order."""
    cut_out = F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["stop"] - s["start"])))
    return F.array_join(cut_out, "")


def digest(chats: DataFrame) -> DataFrame:
    """n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of formatted conversations, read back from them."""
    back = chats.withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "loss", read_loss(F.col("formatted"), F.col("loss_spans"))
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.withColumns(
        {
            "n_turns": F.size("turns").cast("bigint"),
            "turns_sha256": F.sha2(F.array_join(lines, ""), 256),
            "loss_chars": F.length("loss").cast("bigint"),
            "loss_sha256": F.sha2("loss", 256),
            "formatted_chars": F.length("formatted").cast("bigint"),
        }
    )
