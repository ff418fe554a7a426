"""The conversation trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import trie
from cairn.llm.queries import op13_conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def tid(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain(rows, graft=True):
    """Every node from the definition: a dictionary of prefixes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, tid(role or "", text or ""), role or "", text or ""))
    own = {c: [(x[3], x[4]) for x in sorted(v)] for c, v in convs.items()}
    if graft:
        h = lambda c: zlib.crc32(str(c).encode()) % 9
        own = {c: own.get(c - int(np.fmod(c, 5)), [])[:h(c)] + x[h(c):] for c, x in own.items()}
    nodes = {}
    for c, x in own.items():
        for d in range(len(x) + 1):
            nodes.setdefault(tuple(x[:d]), []).append(c)
    out = set()
    for p, members in nodes.items():
        kids = [q for q in nodes if len(q) == len(p) + 1 and q[:len(p)] == p]
        below = [q for q in nodes if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(members) if len(own[c]) == len(p))
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        leaves = sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in below) for q in below)
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids), leaves, saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def build(spark, rows, graft=True, **options):
    given = trie.turn_strings(spark.createDataFrame(rows, SCHEMA))
    nodes = trie.trie(trie.classes_of(trie.graft(given) if graft else given), **options)
    got = [tuple(r) for r in nodes.collect()]
    assert len(got) == len(set(got))
    return set(got)


def made(seed, convs, most, vocabulary):
    rng = random.Random(seed)
    return [(c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(vocabulary))
            for c in range(convs) for t in range(rng.randint(1, most))]


@pytest.mark.parametrize("seed, convs, most", [(1, 40, 12), (2, 120, 4)])
def test_equals_a_dictionary_of_prefixes(spark, seed, convs, most):
    rows = made(seed, convs, most, ["a", "bé", "", None])
    random.Random(seed).shuffle(rows)
    assert build(spark, rows) == plain(rows)


def test_many_shards_share_their_border_paths(spark):
    rng = random.Random(5)
    stem = [("user", "s")] * 20
    rows = [(c, t, *x) for c in range(60) for t, x in enumerate(stem[:rng.randint(0, 20)] + [("user", str(c % 7))] * rng.randint(1, 2))]
    whole = build(spark, rows, graft=False)
    assert whole == build(spark, rows, graft=False, shard_rows=2) == plain(rows, graft=False)


def test_matrix_blocks_of_long_conversations(spark):
    width = trie.WIDTH
    lengths = [width - 1, width, width + 1, 2 * width, 2 * width + 5, 3 * width]
    rows = [(c, t, "user", "x") for c, n in enumerate(lengths) for t in range(n)]
    rows += [(10 + c, t, "user", "x" if t != width else str(c)) for c in range(4) for t in range(2 * width + c)]
    assert build(spark, rows, graft=False) == plain(rows, graft=False)


def test_order_rows_against_sorted_lists():
    rng = random.Random(3)
    lists = {tuple([1] * rng.choice([0, 60, 64, 128, 130]) + [rng.randint(1, 3) for _ in range(rng.randint(0, 70))]) for _ in range(200)}
    lists = list(lists | {(), (1,) * 64, (1,) * 128, (1,) * 65})
    length = np.array([len(x) for x in lists])
    order, shares = trie.order_rows(np.concatenate([np.array(x, np.int64) for x in lists]), np.cumsum(length) - length, length)
    assert [lists[i] for i in order] == sorted(lists)
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    ranked = sorted(lists)
    assert shares[1:].tolist() == [common(a, b) for a, b in zip(ranked, ranked[1:])]


def test_large_class_is_hashed_in_pieces(spark):
    n = 2 * trie.PIECE + 7
    given = trie.turn_strings(spark.range(n).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"),
                                                    F.lit("user").alias("role"), F.lit("same").alias("text")))
    got = {r.depth: r for r in trie.trie(trie.classes_of(given)).collect()}
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(n))).encode()).hexdigest()
    assert (got[0].n_convs, got[0].n_leaves, got[0].saved_tokens) == (n, 1, 4 * (n - 1))
    assert got[0].ends_sha256 == trie.EMPTY


def test_nulls_repeats_and_long_texts(spark):
    rows = [(None, 1, "user", "no conversation"), (1, None, None, None), (1, None, None, None), (1, 2, "user", "é" * 50_000),
            (2, 0, "", ""), (2, 0, "", ""), (-3, 5, "user", "x"), (-3, 5, "assistant", "x")]
    assert build(spark, rows) == plain(rows)
    assert build(spark, rows, graft=False) == plain(rows, graft=False)
    extra = spark.createDataFrame(rows, SCHEMA).withColumn("id", F.lit(1)).withColumn("pid", F.lit("p")).withColumn("seq", F.lit(2))
    nodes = trie.trie(trie.classes_of(trie.graft(trie.turn_strings(extra))))
    assert {tuple(r) for r in nodes.collect()} == plain(rows)


def test_a_turnless_conversation_is_a_member_of_the_root(spark):
    # h of 1 is 3 or more and conversation 0 has no turn: nothing is left of a conversation of one turn
    c = next(k for k in range(1, 100) if k % 5 and zlib.crc32(str(k).encode()) % 9 > 0)
    rows = [(c, 0, "user", "gone")]
    got = build(spark, rows)
    assert got == plain(rows) == {(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())}


def test_empty(spark):
    assert build(spark, []) == set()


def test_whole_table_against_the_dictionary(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in op13_conversation_trie(spark, "/root/testdata/sf0.001").collect()} == plain(rows)
