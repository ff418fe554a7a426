import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from cairn.llm import simhash
from cairn.llm.forest import near_vectors
from cairn.llm.simhash import drop_near_duplicates, fingerprint, links, narrower, near_duplicates, position_masks

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(keys, near):
    parent = {k: k for k in keys}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(keys, 2):
        if near(a, b):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {k: find(k) for k in keys}


@pytest.mark.parametrize("text", ["", None, "One", "two WORDS", "a b c", "Ärger über ÖL und A B C " * 9, "x y " * 500])
def test_fingerprint_against_plain_code(text):
    assert fingerprint(text, 3) == plain_fingerprint(text)


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(1000))
    whole = fingerprint(text, 3)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert fingerprint(text, 3) == whole == plain_fingerprint(text)


def test_some_mask_avoids_any_three_bytes():
    masks = [m % (1 << 64) for m in position_masks()]
    assert len(masks) == 14
    for three in itertools.combinations(range(8), 3):
        assert any(all(not m >> (8 * p) & 255 for p in three) for m in masks)


def test_narrower_lists_keep_pairs_within_three_bits():
    mask, rng = position_masks()[3] % (1 << 64), random.Random(1)
    free = [b for b in range(64) if not mask >> b & 1]
    for _ in range(200):
        differ = sum(1 << b for b in rng.sample(free, 3))
        assert any(differ & (m % (1 << 64)) == 0 for m in narrower(mask))


@pytest.mark.parametrize("list_limit", [2048, 4])
def test_links_connect_what_all_pairs_connect(spark, list_limit):
    """Dense balls of fingerprints, with lists that fit and lists that must be narrowed again and again."""
    rng, values = random.Random(5), set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    values |= {rng.getrandbits(64) for _ in range(60)}
    keys = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    got = links(spark.createDataFrame([(k,) for k in keys], "fp long"), list_limit=list_limit).collect()
    near = {frozenset((r.a, r.b)) for r in got}
    want = roots(keys, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 3)
    assert roots(keys, lambda a, b: frozenset((a, b)) in near) == want
    assert len(near) <= 14 * 4 * len(keys)


def test_documents_meet_their_smallest_id(documents):
    rng = random.Random(2)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(900)) for _ in range(12)]
    texts = base + [b + " tail" for b in base[:5]] + base[5:8] + ["", None, " "]
    got = {r.doc_id: r for r in near_duplicates(documents(texts)).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    want = roots(range(len(texts)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert {k: r.component_id for k, r in got.items()} == want
    kept = sorted(r.doc_id for r in drop_near_duplicates(documents(texts)).collect())
    assert kept == sorted(set(want.values()))


def test_awkward_documents(awkward, nothing):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r.component_id for r in rows if r.fp == 0} == {2}
    kept = drop_near_duplicates(awkward.select("doc_id", "text", "lang", "source", "n_chars"))
    assert kept.count() == len({r.root for r in rows})
    assert near_duplicates(nothing).count() == 0 and drop_near_duplicates(nothing).count() == 0


def test_too_many_bits_are_refused(spark):
    with pytest.raises(ValueError):
        links(spark.createDataFrame([(1,)], "fp long"), max_bits=4)


def ball(rng, n, dim=24, spread=0.03):
    centre = rng.standard_normal(dim)
    centre /= np.linalg.norm(centre)
    return [(centre + spread * rng.standard_normal(dim) / np.sqrt(dim)).tolist() for _ in range(n)]


@pytest.mark.parametrize("leaf, block", [(32, 16), (256, 1024)])
def test_vectors_against_all_pairs(spark, leaf, block):
    rng = np.random.default_rng(3)
    vectors = [v.tolist() for v in rng.standard_normal((400, 24))] + ball(rng, 70) + ball(rng, 30, spread=0.25)
    vectors += [vectors[3], vectors[3], [2 * x for x in vectors[4]], vectors[410]]
    vectors = [np.asarray(v, np.float32).tolist() for v in vectors]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors + odd)] + [(None, vectors[0])],
                               "vec_id long, embedding array<float>").selectExpr("*", "'x' AS cid", "1 AS leaf")
    got = {r.vec_id: r for r in near_vectors(df, leaf_size=leaf, block=block, fit_sample=128).collect()}
    x = np.asarray(vectors, np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    want = roots(range(len(x)), lambda a, b: near[a, b])
    assert len(got) == len(vectors) + len(odd) + 1
    for k in range(len(x)):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (near[k].sum(), want[k], want[k] == k)
    for k in range(len(x), len(x) + len(odd)):
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert got[None].n_links == 0 and got[None].component_id is None


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert near_vectors(none).count() == 0
    assert near_vectors(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).first().kept


def test_the_tally_decides_which_pairs_are_verified():
    rng = random.Random(11)
    low = rng.getrandbits(32)  # a list: four equal bytes, the others free
    values = np.array(sorted({low | rng.getrandbits(32) << 32 for _ in range(600)}
                             | {low | (7 << 40) ^ (1 << rng.randrange(32, 64)) ^ (1 << rng.randrange(32, 64)) for _ in range(60)}), np.uint64)
    i, j, verified = simhash.near_pairs(values, 3)
    pairs = list(itertools.combinations(range(len(values)), 2))
    shared = lambda a, b: sum((int(a) ^ int(b)) >> (8 * k) & 255 == 0 for k in range(8))
    want = {(a, b) for a, b in pairs if (int(values[a]) ^ int(values[b])).bit_count() <= 3}
    assert set(zip(i.tolist(), j.tolist())) == want and want
    assert verified == sum(shared(values[a], values[b]) >= 5 for a, b in pairs) < len(pairs) / 10
    assert (simhash.tally(values, 3, 5)[1] == [shared(values[4], v) for v in values]).all()


def at_cosine(rng, a, cosine):
    b = rng.standard_normal(len(a))
    b -= (b @ a) * a
    return cosine * a + np.sqrt(1 - cosine ** 2) * b / np.linalg.norm(b)


def test_cosines_in_double_precision(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in range(20):
        a = rng.standard_normal(16)
        a /= np.linalg.norm(a)
        rows += [(4 * k, a.tolist()), (4 * k + 1, at_cosine(rng, a, 0.95 + 1e-9).tolist())]
        a = -a
        rows += [(4 * k + 2, (1e200 * a).tolist()), (4 * k + 3, (1e-200 * at_cosine(rng, a, 0.95 + 1e-9)).tolist())]
    rows += [(100, [1e300] + [0.0] * 15), (101, [1e-300] + [0.0] * 15)]
    got = {r.vec_id: r.component_id for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert all(got[4 * k + 1] == 4 * k and got[4 * k + 3] == 4 * k + 2 for k in range(20))
    assert got[101] == got[100] == 100


def test_recall_of_pairs_at_the_limit(spark):
    rng = np.random.default_rng(6)
    a = rng.standard_normal((8_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    pairs = [(x, at_cosine(rng, x, rng.uniform(0.9502, 0.956))) for x in a]
    df = spark.createDataFrame([(2 * k + s, p[s].tolist()) for k, p in enumerate(pairs) for s in (0, 1)], "vec_id long, embedding array<double>")
    linked = near_vectors(df).where("n_links = 1 and component_id = vec_id - vec_id % 2").count()
    assert linked >= 0.995 * 16_000


def test_a_dense_ball_does_not_multiply_its_rows(spark):
    from cairn.llm.forest import grow

    rng = np.random.default_rng(7)
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)
    for spread in (0.42, 0.30):  # mean cosine 0.85 and 0.92
        x = centre + spread * rng.standard_normal((4_000, 64)) / 8
        df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "cid long, vector array<double>")
        margin = 0.5 * float(np.sqrt(0.1 / 64))
        assert grow(df, trees=5, leaf_size=256, fit_sample=2048, margin=margin, seed=1).count() < 20 * 4_000
