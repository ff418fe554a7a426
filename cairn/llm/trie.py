"""Prefix trie of conversations from padded matrices of turn ids.

A turn's id is the 128-bit MD5 of its role and text, so a conversation is a string of 16-byte ids, and strings of ids sort
as their turns do.  Equal conversations become one class first.  The classes are range-partitioned by that string; a
partition (shard) lays its classes out as rows of a padded matrix of local ids, one block of ``WIDTH`` columns at a time,
with as many rows as are that long.  ``numpy.lexsort`` orders the rows of a block under their groups of the block before;
the masks "differs from the row above", accumulated by OR from left to right, mark where nodes start.  With that depth
known for each row every measure of a node is a sum or a minimum over its rows, which ``reduceat`` forms depth by depth:

* a node starts at the rows that first differ from the row above at or before its depth;
* a child starts at each longer row that first differs one turn later;
* a leaf is a row of which the next row is no continuation;
* saved tokens are the members' bytes from the node's depth on, less those of the nodes that start there.

Only the nodes on the border path between two shards lie in more than one of them.  The shards' borders (two rows each) are
compared before, so a shard knows which of its nodes those are; their parts are summed by node, and their values go
back to the nodes that hang from them.

Defined results: rows with a null conversation id belong to no conversation and take no part; null role and text are
empty; turns are ordered by number (null first), equal numbers by the turn's id; repeated rows are turns of their own;
``c % 5`` has the sign of ``c``, as in SQL; extra columns are ignored; an empty table gives no node.  A turn of any
length is 16 bytes and a count here, and a conversation of any length is one matrix row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.combine import broadcast_if_small
from cairn.operators.prefix import durable, task_count
from cairn.session import ship_by_value

#: Bytes of a turn id; columns of a matrix block; members' ids that are joined before they are hashed.
ID, WIDTH, PIECE = 16, 64, 4096
#: What a node has besides its place, in the order of the result.
MEASURES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """Hex of the 128-bit id of a turn; the length before the role keeps role and text apart."""
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def turn_strings(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """conv, turns (array of id, bytes): every conversation in order.  Only ids and lengths are shuffled, never a text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).isNotNull().alias("some"), F.col(turn_col).alias("turn"),
        turn_id(role, text).alias("id"), F.octet_length(text).cast("long").alias("bytes"))
    whole = turns.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("some", "turn", "id", "bytes"))).alias("turns"))
    return whole.withColumn("turns", F.transform("turns", lambda x: F.struct(x["id"].alias("id"), x["bytes"].alias("bytes"))))


def graft(strings: DataFrame, *, step: int = 5, most: int = 8) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of ``c - c % step``; h = crc32(c) % (most + 1)."""
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % (most + 1)).cast("int")
    heads = strings.select(F.col("conv").alias("base"), F.slice("turns", 1, most).alias("head"))
    both = strings.withColumns({"base": F.col("conv") - F.col("conv") % step, "h": h}).join(heads, "base", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return both.select("conv", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def classes_of(strings: DataFrame) -> DataFrame:
    """One row per distinct sequence: key, seq, bytes, low (smallest conversation), n, ends (hash of its conversations).

    Copies are counted by partial aggregates.  The list of a class's conversations is one hashed value, so it is joined
    piece by piece in range partitions that cut large classes, and then only streamed through the hash in order.
    """
    spark = strings.sparkSession
    rows = durable(strings.select(
        "conv", F.unhex(F.array_join(F.transform("turns", lambda x: x["id"]), "")).alias("seq"),
        F.transform("turns", lambda x: x["bytes"]).alias("bytes")).withColumn("key", F.md5("seq")))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            key = batch["key"].to_numpy()
            at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
            conv, out = batch["conv"].to_numpy(), []
            for a, b in zip(at, np.r_[at[1:], len(key)]):
                out += [(key[a], int(conv[k]), ",".join(map(str, conv[k:min(k + PIECE, b)]))) for k in range(a, b, PIECE)]
            yield pd.DataFrame(out, columns=["key", "first", "text"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, None
        for batch in batches:
            out = []
            for key, text in zip(batch["key"], batch["text"]):
                if key != now:
                    if now is not None:
                        out.append((now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            yield pd.DataFrame(out, columns=["key", "ends"])
        if now is not None:
            yield pd.DataFrame([(now, digest.hexdigest())], columns=["key", "ends"])

    width = task_count(spark)
    joined = (rows.select("key", "conv").repartitionByRange(width, "key", "conv").sortWithinPartitions("key", "conv")
              .mapInPandas(pieces, "key string, first long, text string"))
    ends = (joined.repartition(width, "key").sortWithinPartitions("key", "first")
            .mapInPandas(hashed, "key string, ends string"))
    each = rows.groupBy("key").agg(F.min("conv").alias("low"), F.count(F.lit(1)).alias("n"), F.first("seq").alias("seq"),
                                   F.first("bytes").alias("bytes"))
    return each.join(ends, "key").select("seq", "bytes", "low", "n", "ends")


def shared_turns(a, b) -> int:
    """Turns that two sequences share from the start; -1 where one is missing."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
    return (int(differ[0]) if len(differ) else n) // ID


def order_rows(flat: np.ndarray, base: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of sequences, and for each row in that order the turns it shares with the row above.

    Row i has the ids ``flat[base[i]:base[i] + length[i]]``, all positive; the rows are distinct.  Blocks hold the rows
    that reach them; rows that are equal so far are a group, and what a group's first row shares with the row above it
    is carried until that row is known.
    """
    shares, at = np.zeros(len(length), np.int64), 0
    active = np.flatnonzero(length > 0)
    group, carry, blocks = np.zeros(len(active), np.int64), np.zeros(len(active), np.int64), []
    while len(active):
        left = length[active] - at
        column = np.arange(min(WIDTH, int(left.max())))
        inside = column < left[:, None]
        block = np.where(inside, flat[np.where(inside, base[active][:, None] + at + column, 0)], 0)  # 0 pads: before all ids
        place = np.lexsort((left > WIDTH, *block.T[::-1], group))  # of equal rows the one that ends here comes first
        active, group, carry, block, done = (x[place] for x in (active, group, carry, block, left <= WIDTH))
        first = np.r_[True, group[1:] != group[:-1]]
        change = np.zeros(block.shape, bool)
        change[1:] = block[1:] != block[:-1]
        change = np.logical_or.accumulate(change | first[:, None], axis=1)
        value = np.where(first, carry, at + change.argmax(axis=1))
        head = change[:, -1]
        group = np.cumsum(head) - 1
        value = value[head][group]
        shares[active[done]] = value[done]
        ended = np.zeros(int(group[-1]) + 1, bool)
        ended[group[done]] = True
        blocks.append(active)
        at += WIDTH
        carry = np.where(ended[group], at, value)
        active, group, carry = active[~done], group[~done], carry[~done]
    order = np.flatnonzero(length == 0)
    if blocks:
        order = np.concatenate((order, blocks[0]))
        place = np.empty(len(length), np.int64)
        place[order] = np.arange(len(order))
        for rows in blocks[1:]:  # a later block settles the order inside groups, whose rows are neighbours
            place[rows] = np.sort(place[rows])
        order = np.argsort(place)
    return order, shares[order]


def path_keys(seq: bytes, depth: int) -> list[bytes]:
    """Digests that name the nodes of depth 0..``depth`` on the path of ``seq``."""
    h, out = hashlib.md5(), []
    for d in range(depth + 1):
        h.update(seq[(d - 1) * ID:d * ID] if d else b"")
        out.append(h.copy().digest())
    return out


def shard_nodes(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """All nodes of one shard, depth by depth: complete ones, and the parts (with a key) of those that go on in a
    neighbouring shard."""
    pid, before, after = (int(pdf[c].iloc[0]) for c in ("pid", "before", "after"))
    seqs = pdf["seq"].tolist()
    length = np.array([len(s) // ID for s in seqs], np.int64)
    base = np.cumsum(length) - length
    turns = np.frombuffer(b"".join(seqs), dtype=f"S{ID}") if length.any() else np.zeros(0, f"S{ID}")
    raw = turns.view(">u8").reshape(-1, 2).astype(np.uint64)  # S16 would ignore trailing zero bytes
    place = np.lexsort((raw[:, 1], raw[:, 0]))
    local = np.empty(len(raw), np.int64)
    local[place] = np.cumsum(np.r_[True, (raw[place[1:]] != raw[place[:-1]]).any(axis=1)]) if len(raw) else 0
    order, f = order_rows(local, base, length)
    f[0] = before
    length, base = length[order], base[order]
    n, low, ends = (pdf[c].to_numpy()[order] for c in ("n", "low", "ends"))
    upto = np.concatenate(([0], np.cumsum(np.concatenate([np.asarray(b, np.int64) for b in pdf["bytes"]] or [np.zeros(0)])))).astype(np.int64)
    leaf = np.append(f[1:], after) < length
    keys = (path_keys(bytes(seqs[order[0]]), before), path_keys(bytes(seqs[order[-1]]), after))
    above, above_side = np.full(len(length), -1, np.int64), np.full(len(length), -1, np.int64)
    active, depth, held, size = np.arange(len(length)), 0, [], 0
    while len(active):  # the rows that reach this depth, in order; a node is a run of them
        reach, shared, start = length[active], f[active], f[active] < depth
        start[0] = True
        at, run, d = np.flatnonzero(start), np.cumsum(start) - 1, max(depth, 1)
        end = upto[base[active] + reach]
        saved = n[active] * (end - upto[base[active] + d - 1]) - (end - upto[base[active] + np.maximum(d, shared + 1) - 1])
        head = active[at]
        side, key = np.full(len(at), -1), np.full(len(at), None, object)
        for s, k, goes_on in ((1, -1, depth <= after), (0, 0, depth <= before)):
            if goes_on:
                side[k], key[k] = s, keys[s][depth]
        lows = np.minimum.reduceat(low[active], at)
        total = lambda x: np.add.reduceat(x.astype(np.int64), at)  # noqa: E731, B023
        held.append(pd.DataFrame({
            "pid": pid, "conv_id": lows, "depth": depth, "parent": above[head], "side": side, "up": above_side[head],
            "n_convs": total(n[active]), "n_children": total((reach > depth) & (shared <= depth)),
            "n_leaves": total(leaf[active]), "saved_tokens": total(saved),
            "ends": np.where(reach[at] == depth, ends[head], None), "key": key}))
        size += len(at)
        if size > 20_000 or len(held) > 1_000:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
        above[active], above_side[active] = lows[run], side[run]
        depth += 1
        active = active[reach >= depth]
    if held:
        yield pd.concat(held, ignore_index=True)


NODE = ("pid long, conv_id long, depth long, parent long, side int, up int, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends string, key binary")


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = [b for b in batches if len(b)]
    if rows:
        yield from shard_nodes(pd.concat(rows, ignore_index=True))


def trie(classes: DataFrame, *, shard_rows: int = 20_000, shard_turns: int = 1_000_000) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = classes.sparkSession
    classes = durable(classes)
    count, turns = classes.agg(F.count(F.lit(1)), F.sum(F.octet_length("seq") / ID)).first()
    width = max(task_count(spark, count, shard_rows), int(turns or 0) // shard_turns)
    laid = durable(classes.repartitionByRange(width, "seq").withColumn("pid", F.spark_partition_id().cast("long")))
    # two rows a shard: its first and its last sequence meet those of the neighbours
    ends = laid.groupBy("pid").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    share = F.udf(shared_turns, "int")  # once a shard
    borders = durable(ends.selectExpr("pid", "first", "last", "lag(last) over (order by pid) as previous",
                                      "lead(first) over (order by pid) as next")
                      .select(F.col("pid").alias("__p"), share("first", "previous").alias("before"),
                              share("last", "next").alias("after")))
    parts = durable(laid.join(F.broadcast(borders), F.col("pid") == F.col("__p")).drop("__p").mapInPandas(_shards, NODE))
    on_border = parts.where("side >= 0")
    nodes = durable(on_border.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in MEASURES), F.max("ends").alias("ends"),
        F.min(F.struct("pid", "up")).alias("at")))
    # the node that a shard knows as (pid, side, depth): two for each shard and border depth
    known = broadcast_if_small(on_border.select("pid", "side", "depth", "key").join(
        nodes.select("depth", "key", F.col("conv_id").alias("above")), ["depth", "key"])
        .select(F.col("pid").alias("__p"), F.col("side").alias("__s"), (F.col("depth") + 1).alias("__d"), "above"))
    out = parts.where("side < 0").select("pid", "up", "conv_id", "depth", "parent", *MEASURES, "ends").unionByName(
        nodes.select("at.pid", "at.up", "conv_id", "depth", F.lit(-1).cast("long").alias("parent"), *MEASURES, "ends"))
    out = out.join(known, (F.col("pid") == F.col("__p")) & (F.col("up") == F.col("__s")) & (F.col("depth") == F.col("__d")), "left")
    parent = F.when(F.col("depth") > 0, F.when(F.col("up") >= 0, F.col("above")).otherwise(F.col("parent")))
    return out.select("conv_id", "depth", parent.alias("parent_conv_id"), *MEASURES,
                      F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256"))


ship_by_value(__name__)
