import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cairn.llm.packing import best_fit, crossover, evolve, mutate, pack, pack_documents
from cairn.llm.tokens import Encoder

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def coder():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.one_of(st.text(max_size=20), st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " "])), max_size=6).map("".join))
@settings(max_examples=200, deadline=None)
def test_ids_are_those_of_the_named_library(text):
    held = test_ids_are_those_of_the_named_library.__dict__
    if "coder" not in held:
        held["coder"], held["own"] = Tokenizer.from_file(PATH), Encoder(PATH)
    assert held["own"].encode(text).tolist() == held["coder"].encode(text, add_special_tokens=False).ids


def test_added_tokens_in_a_text_are_their_own_ids():
    default, own = Tokenizer.from_file(PATH), Encoder(PATH)
    for t in ("", "plain text, 12 é", "<|im_end|> <| endoftext |>", "a  b\n\tc's", "a <|endoftext|> b", "<|endoftext|>",
              "x<|endoftext|><|endoftext|>\n y", "<|endoftext|", "  <|endoftext|>  "):
        assert own.encode(t).tolist() == default.encode(t, add_special_tokens=False).ids
    assert own.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


def is_packing(bins, lengths, capacity):
    return sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(sum(lengths[i] for i in b) <= capacity for b in bins)


@given(st.lists(st.integers(1, 50), min_size=1, max_size=60), st.integers(0, 999))
@settings(max_examples=60, deadline=None)
def test_genetic_steps_keep_every_item_once(lengths, seed):
    rng = random.Random(seed)
    a = best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 50, [])
    b = best_fit(rng.sample(range(len(lengths)), len(lengths)), lengths, 50, [])
    child = crossover(a, b, lengths, 50, rng)
    for bins in (a, b, child, mutate(child, lengths, 50, rng), evolve(lengths, 50, [], str(seed), 6, 4)):
        assert is_packing(bins, lengths, 50)
    assert len(evolve(lengths, 50, [], str(seed), 6, 4)) <= len(a)


def test_evolution_beats_best_fit_where_it_is_not_optimal():
    lengths = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6, 20, 30, 40, 10, 33, 33, 34, 51, 27, 22] * 3
    first = best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i]), lengths, 100, [])
    assert len(evolve(lengths, 100, [], "s", 8, 40)) <= len(first)


def test_documents_come_back_from_their_pieces(documents, coder):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["alpha", "beta", "Gamma,", "é"]) for _ in range(rng.choice([3, 30, 200, 900]))) for _ in range(60)]
    texts += ["", None, "<|endoftext|> is text", "a  b ", "x" * 9000, texts[0]]
    df = documents(texts)
    rows = pack_documents(df, tokenizer=PATH, capacity=128, group_items=24, with_ids=True).collect()
    ids = {k: (coder.encode(t, add_special_tokens=False).ids if t else []) + [2] for k, t in enumerate(texts)}
    back, bins = {}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(back.setdefault(r.doc_id, [])) and r.length == len(r.ids) <= 128
        assert r.ids_crc32 == zlib.crc32(np.asarray(r.ids, "<u4").tobytes())
        assert r.length == 128 or r.piece == 0
        back[r.doc_id] += r.ids
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert back == ids
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 128
    least = -(-sum(map(len, ids.values())) // 128)
    assert len(bins) <= 1.1 * least + 3
    again = pack_documents(df, tokenizer=PATH, capacity=128, group_items=24, with_ids=True).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_equal_pieces_by_the_thousand(spark):
    df = spark.range(3000).selectExpr("1L AS doc_id", "0 AS piece", "0L AS start", "300L AS length", "5L AS ids_crc32")
    got = pack(df, group_items=256).groupBy("sequence_id").count().collect()
    assert 1000 <= len(got) <= 1012 and sum(r["count"] for r in got) == 3000  # one short sequence a group at most


def test_poor_bins_of_all_groups_are_packed_again(spark):
    rng = random.Random(8)
    lengths = [rng.choice([rng.randint(1, 40), rng.randint(1, 1023)]) for _ in range(3000)]
    df = spark.createDataFrame([(k, 0, 0, n, k) for k, n in enumerate(lengths)],
                               "doc_id long, piece int, start long, length long, ids_crc32 long")
    used = lambda **o: {r.sequence_id: r.s for r in pack(df, group_items=64, **o).groupBy("sequence_id").agg(
        F.sum("length").alias("s")).collect()}
    apart, together = used(poor=0.0), used()
    least = -(-sum(lengths) // 1024)
    assert sum(together.values()) == sum(lengths) and max(together.values()) <= 1024
    assert len(together) < len(apart) and len(together) - least <= (len(apart) - least) / 3


def test_awkward_rows(awkward, nothing):
    rows = pack_documents(awkward, tokenizer=PATH).collect()
    assert sum(r.piece == 0 for r in rows) == awkward.count()
    assert pack_documents(nothing, tokenizer=PATH).count() == 0
