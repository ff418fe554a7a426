"""Chat formatting as a prefix tree: turns that conversations share from their start are written once.

A node is a first run of turns, known by a 128-bit xor of position-tagged turn hashes (a prefix sum, so a conversation
of any length is spread over tasks).  The smallest conversation through a node owns it, so each conversation owns a
suffix of its turns, its block.  Depth-first order is: a block, then the blocks that branch off it, deepest branch
first, ties by owner; this is a plain sort of blocks by their branch path.  A prefix sum of tokens in that order gives
every block its place in the sequence of its tree, position ids continue along the path, and a block attends to one
interval per owner on its path, and causally to itself.

Defined results: null role and null text are empty; turns are ordered by number (null first), ties by their hash; the
rows of null conversation ids are one conversation; ids are whole numbers above -2^63, which stands for null inside; repeated
rows are turns of their own; a text of any length is one turn; extra columns are ignored; an empty table gives empty tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import dealt_join
from cairn.llm.tokens import token_lengths
from cairn.operators.prefix import durable, grouped_prefix

START, END = "<|im_start|>", "<|im_end|>\n"
#: Stands for a null conversation id inside the operator.
NO_ID = -(2 ** 63)


def escape(text: Column) -> Column:
    """No control string is left: one backslash is put into every ``<|``, ``<\\|``, ``<\\\\|`` and so on."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


@dataclass
class PrefixTree:
    """nodes: tree, owner, depth, start, tokens, position, segment, loss_from, loss_chars, attend; paths: conv, depth, owner."""

    nodes: DataFrame
    paths: DataFrame


def build(conversations: DataFrame, *, tokenizer: str | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
          role_col: str = "role", text_col: str = "text", trained_role: str = "assistant") -> PrefixTree:
    """The prefix tree of all conversations.

    ``start`` is a node's first token in the sequence of its ``tree``, ``position`` that token's position id,
    ``attend`` the token intervals [from, to) of its ancestors in other blocks, ``block`` the first token of its own.
    ``loss_from``/``loss_chars`` mark the trained text inside ``segment``.  Without a ``tokenizer`` (a path) a code
    point is a token.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    body = escape(text)
    trained = role == trained_role
    turns = conversations.select(
        F.coalesce(F.col(conv_col).cast("long"), F.lit(NO_ID)).alias("conv"), F.col(turn_col).alias("turn"),
        F.concat(head, body, F.lit(END)).alias("segment"),
        F.when(trained, F.char_length(head)).alias("loss_from"), F.when(trained, F.char_length(body)).alias("loss_chars"))
    if tokenizer:
        turns = token_lengths(turns, "segment", tokenizer)
    else:
        turns = turns.withColumn("tokens", F.char_length("segment").cast("long"))
    turns = durable(turns.withColumn("rid", F.monotonically_increasing_id()))
    # the segment holds role and text, so equal segments are equal turns
    narrow = turns.select("conv", "turn", "rid", "tokens", F.xxhash64("segment", F.lit(1)).alias("h1"),
                          F.xxhash64(F.lit(2), "segment").alias("h2"))
    placed = grouped_prefix(narrow, ["turn", "h1", "rid"], group=["conv"], sums={"position": "tokens"}, index="depth")
    tagged = placed.withColumns({"h1": F.xxhash64("depth", "h1"), "h2": F.xxhash64("h2", "depth")}).drop("turn")
    keyed = grouped_prefix(tagged, ["depth"], group=["conv"], xors={"k1": "h1", "k2": "h2"})
    keyed = durable(keyed.withColumns({"k1": F.col("k1").bitwiseXOR(F.col("h1")), "k2": F.col("k2").bitwiseXOR(F.col("h2"))})
                    .drop("h1", "h2"))
    owners = durable(keyed.groupBy("depth", "k1", "k2").agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n")))
    paths = durable(dealt_join(keyed, owners, ["depth", "k1", "k2"], "n")
                    .select("conv", "depth", "owner", "rid", "tokens", "position"))

    runs = paths.groupBy("conv", "owner").agg(F.min("depth").alias("at"), F.min("position").alias("p0"),
                                              F.max(F.col("position") + F.col("tokens")).alias("p1"))
    chain = runs.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("at", "owner", "p0", "p1"))).alias("chain"))
    own = F.element_at("chain", -1)
    blocks = (chain.where(own["owner"] == F.col("conv"))
              .select("conv", F.col("chain")[0]["owner"].alias("tree"), own["p0"].alias("p0"),
                      (own["p1"] - own["p0"]).alias("size"), "chain",
                      F.transform("chain", lambda x: F.struct((-x["at"]).alias("branch"), x["owner"].alias("owner"))).alias("path")))
    blocks = durable(grouped_prefix(blocks, ["path"], group=["tree"], sums={"block": "size"}).drop("path"))
    begin = blocks.select(F.col("conv").alias("owner"), F.col("block").alias("from"))
    seen = (blocks.select("conv", F.explode("chain").alias("x")).where("x.owner != conv")
            .select("conv", F.col("x.owner").alias("owner"), F.col("x.at").alias("at"), (F.col("x.p1") - F.col("x.p0")).alias("n"))
            .join(begin, "owner").groupBy("conv")
            .agg(F.array_sort(F.collect_list(F.struct("at", "from", (F.col("from") + F.col("n")).alias("to")))).alias("seen")))
    interval = "array<struct<from:bigint,to:bigint>>"
    attend = F.coalesce(F.transform("seen", lambda x: F.struct(x["from"].alias("from"), x["to"].alias("to"))),
                        F.array().cast(interval))
    blocks = blocks.join(seen, "conv", "left").select("conv", "tree", "p0", "block", attend.alias("attend"))
    nodes = (paths.where("owner = conv").join(blocks, "conv").join(turns.drop("conv", "turn", "tokens"), "rid")
             .select("tree", "owner", "depth", (F.col("block") + F.col("position") - F.col("p0")).alias("start"), "tokens",
                     "position", "segment", "loss_from", "loss_chars", "block", "attend"))
    return PrefixTree(nodes, paths.select("conv", "depth", "owner"))


def read_back(tree: PrefixTree) -> DataFrame:
    """conv_id, turns (role, text), formatted, trained (texts under the loss mask): each conversation from its nodes.

    One conversation is one value here, so its turns meet in one row; that is the only place where they do.
    """
    part = tree.nodes.select("owner", "depth", "segment", F.when(
        F.col("loss_from").isNotNull(),
        unescape(F.substr("segment", F.col("loss_from") + 1, F.col("loss_chars")))).alias("trained"))
    rows = tree.paths.join(part, ["owner", "depth"])
    whole = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "segment", "trained"))).alias("x"))
    formatted = F.array_join(F.transform("x", lambda v: v["segment"]), "")
    whole = whole.select(F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id"), formatted.alias("formatted"),
                         F.filter(F.transform("x", lambda v: v["trained"]), lambda v: v.isNotNull()).alias("trained"))
    raw = F.split("formatted", r"<\|im_end\|>\n")
    turn = lambda v: F.struct(
        unescape_role(F.substring_index(F.substr(v, F.lit(len(START) + 1)), "\n", 1)).alias("role"),
        unescape(F.substr(v, F.locate("\n", v) + 1)).alias("text"))
    return whole.withColumn("turns", F.transform(F.slice(raw, 1, F.size(raw) - 1), turn))


def digests(back: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of read-back conversations."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("trained", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))
