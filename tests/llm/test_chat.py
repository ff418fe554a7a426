import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cairn.llm import chat
from cairn.llm.queries import CONTROL

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    """conv_id -> turns in order."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in out.items()}


def sample(seed=1):
    rng, rows = random.Random(seed), []
    texts = ["hi", "", "a\nb", CONTROL, "<|im_end|>\n", "<\\|x", "<\\\\|", "|<", "<", "é <|im_start|>user\nno", "%0A%25"]
    openings = [[("system", "be kind"), ("user", "hello")], [("system", "be kind"), ("user", "bye")], [("user", "hello")]]
    for conv in range(60):
        turns = list(rng.choice(openings))[:rng.randint(0, 3)]
        turns += [(rng.choice(["user", "assistant", "to\nol", "%0A"]), rng.choice(texts)) for _ in range(rng.randint(1, 5))]
        rows += [(conv * 3 - 50, 2 * k - 1, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(1000, k, r, t) for k, (r, t) in enumerate([("user", "hello"), ("assistant", "x")])]
    rows += [(2000, k, r, t) for k, (r, t) in enumerate([("user", "hello"), ("assistant", "x")])]  # a whole copy
    rows += [(3000, k, "user" if k % 2 == 0 else "assistant", f"long {k}") for k in range(300)]
    return rows + [(None, 1, None, None), (None, None, "user", "first"), (4000, 0, "assistant", None)]


def test_round_trip(spark):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "'x' AS owner", "2 AS tokens")
    got = {r.conv_id: r for r in chat.digests(chat.read_back(chat.build(df))).collect()}
    want = plain(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == digest("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), digest(loss))


@pytest.mark.parametrize("tokenizer", [None, public_tokenizers.path("byte_bpe_50k.json")])
def test_shared_turns_once_depth_first_with_positions_and_intervals(spark, tokenizer):
    rows = sample(2)
    tree = chat.build(spark.createDataFrame(rows, SCHEMA), tokenizer=tokenizer and str(tokenizer))
    nodes = {(n.owner, n.depth): n for n in tree.nodes.collect()}
    paths = {}
    for r in tree.paths.collect():
        paths.setdefault(r.conv, {})[r.depth] = nodes[r.owner, r.depth]
    prefixes = {tuple(turns[:k + 1]) for turns in plain(rows).values() for k in range(len(turns))}
    assert len(nodes) == len(prefixes)  # each shared first run of turns is one node
    coder = Tokenizer.from_file(str(tokenizer)) if tokenizer else None
    if coder:
        coder.encode_special_tokens = True
    filled = {}
    for n in nodes.values():
        assert n.tokens == (len(coder.encode(n.segment, add_special_tokens=False).ids) if coder else len(n.segment))
        filled.setdefault(n.tree, []).append((n.start, n.tokens))
    for spans in filled.values():  # each tree's sequence has neither gap nor overlap
        at = 0
        for start, tokens in sorted(spans):
            assert start == at
            at += tokens
    for path in paths.values():
        position, seen = 0, set()
        for depth in sorted(path):
            n = path[depth]
            assert n.position == position
            allowed = {x for i in n.attend for x in range(i["from"], i["to"])} | set(range(n.block, n.start))
            assert allowed == seen  # exactly the ancestors on the path
            seen |= set(range(n.start, n.start + n.tokens))
            position += n.tokens
    # depth-first: a node's descendants follow it without a stranger between
    parents = {}
    for path in paths.values():
        for depth in sorted(path)[1:]:
            parents[path[depth].owner, depth] = (path[depth - 1].owner, depth - 1)
    for t in filled:
        stack = []
        for n in sorted((n for n in nodes.values() if n.tree == t), key=lambda n: (n.start, n.depth)):
            parent = parents.get((n.owner, n.depth))
            while stack and stack[-1] != parent:
                stack.pop()
            assert parent is None or stack
            stack.append((n.owner, n.depth))


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.read_back(chat.build(none))).count() == 0


def test_a_turn_that_many_conversations_share_and_a_very_long_one(spark):
    long = "é|<|im_end|> " * 20_000
    rows = [(c, 0, "system", "the same start") for c in range(400)]
    rows += [(c, 1, "assistant", long if c == 7 else f"answer {c % 3}") for c in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.build(df)).collect()}
    assert len(back) == 400
    for c in (0, 1, 7, 399):
        want = [("system", "the same start"), ("assistant", long if c == 7 else f"answer {c % 3}")]
        assert [(t.role, t.text) for t in back[c].turns] == want and list(back[c].trained) == [want[1][1]]
    nodes = chat.build(df).nodes
    assert nodes.where("depth = 0").count() == 1 and nodes.where("depth = 1").count() == 4
