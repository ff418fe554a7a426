import re
import zlib
from collections import Counter, defaultdict
from hashlib import md5

import pytest

from cairn.llm.common import connected_components
from cairn.llm.mixing import apportion, mix, mixed_documents, shard_quotas, source_targets
from cairn.llm.sharding import byte_shards
from cairn.operators.prefix import grouped_prefix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_grouped_prefix_against_python(spark):
    rows = [(k % 3 if k % 3 else None, (k * 7919) % 101, k % 13, k * 31) for k in range(600)]
    df = spark.createDataFrame(rows, "g long, o long, v long, x long")
    got = grouped_prefix(df, ["o", "x"], group=["g"], sums={"s": "v"}, xors={"b": "x"}, index="i").collect()
    seen = defaultdict(lambda: [0, 0, 0])
    for r in sorted(got, key=lambda r: (r.g is None, r.g, r.o, r.x)):
        assert [r.s, r.b, r.i] == seen[r.g]
        seen[r.g] = [seen[r.g][0] + r.v, seen[r.g][1] ^ r.x, seen[r.g][2] + 1]


def test_components_of_a_path_a_star_and_pairs(spark):
    path = [(k, k + 1) for k in range(100, 160)]
    star = [(500, k) for k in range(501, 560)]
    edges = spark.createDataFrame([*path, *star, (900, 901), (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 500 for k in range(500, 560)}, 900: 900, 901: 900}


def seats_by_hand(targets, n):
    won = [0] * len(targets)
    for _ in range(n):
        k = max(range(len(targets)), key=lambda i: (targets[i] / (2 * won[i] + 1), -i))
        won[k] += 1
    return won


@pytest.mark.parametrize("targets", [[53.0, 24.0, 23.0], [1.0] * 7, [1000.0, 1.0, 1.0, 3.0], [0.0, 5.0], [2.5]])
def test_seats_are_the_highest_quotients(spark, targets):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(targets)], "place long, target double")
    for r in apportion(df, [1, 2, 10, 57]).collect():
        assert r.seats == seats_by_hand(targets, r.house)[r.place]


def test_shard_quotas_are_integer_and_fill_equal_shards(spark):
    df = spark.createDataFrame([(0, 900.0), (1, 350.0), (2, 33.0)], "place long, target double")
    per = defaultdict(int)
    for r in shard_quotas(df, block_tokens=10, n_shards=8).collect():
        assert r.blocks >= 0
        per[r.shard] += r.blocks
    assert sorted(per) == list(range(8)) and max(per.values()) - min(per.values()) <= 1 and sum(per.values()) == 128


def targets_by_hand(sizes, share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    open_, target, budget = set(order), {}, share * sum(sizes.values())
    while open_:
        level = budget / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
        open_ -= over
    return target


def plain_mix(rows, block, n_shards, seed=1):
    """(size, taken, shards with their ranges) by row, from sorted streams and highest quotients one by one."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s))
    target = targets_by_hand(total)
    blocks = round(sum(target.values()) / block)
    out = {k: (n, 0, []) for k, n in enumerate(size)}
    upto = [seats_by_hand([target[s] for s in order], blocks * (k + 1) // n_shards) for k in range(n_shards)]
    for p, s in enumerate(order):
        own = sorted((k for k, r in enumerate(rows) if r[2] == s), key=lambda k: (md5(f"{seed}:{rows[k][0]}".encode()).hexdigest(), rows[k][0]))
        stream = [(k, w) for k in own for w in range(size[k])]
        quota, taken = upto[-1][p], Counter()
        for shard in range(n_shards):
            high, low = upto[shard][p], upto[shard - 1][p] if shard else 0
            if not quota:
                continue
            strip = stream[total[s] * low // quota:total[s] * high // quota]
            words = min((high - low) * block, 2 * len(strip))
            name = f"{seed}:{'-' if s is None else '+' + s}:{shard}"
            first = int(md5(name.encode()).hexdigest()[:8], 16) % max(-(-len(strip) // block), 1) * block
            full = words // len(strip) if strip else 0
            for x in strip:
                taken[x] += full
            for j in range(words - full * len(strip)):
                taken[strip[(first + j) % len(strip)]] += 1
            for k in {k for k, _ in strip}:
                out[k][2].append(shard)
        for k in own:
            out[k] = (size[k], sum(taken[k, w] for w in range(size[k])), sorted(out[k][2]), {w: taken[k, w] for w in range(size[k])})
    return out


@pytest.mark.parametrize("block, n_shards", [(8, 8), (32, 3), (5, 1)])
def test_mix_against_plain_streams(documents, block, n_shards):
    sources = ["b", "a", None, "c", "a", "é", "B"]
    texts = [" ".join(f"w{k}x{j}" for j in range(37 * k % 400 if k % 9 else 0)) for k in range(70)]
    rows = [(k, t, sources[k % 7]) for k, t in enumerate(texts)]
    df = documents(texts, source=[r[2] for r in rows])
    options = dict(block_tokens=block, n_shards=n_shards)
    got, want = {r.doc_id: r for r in mix(df, **options).collect()}, plain_mix(rows, block, n_shards)
    sizes, taken = defaultdict(int), defaultdict(int)
    for k, r in got.items():
        assert (r.size, r.taken, [p.shard for p in r.parts]) == want[k][:3], k
        assert r.taken <= 2 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    target = targets_by_hand(sizes)
    for r in got.values():
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    assert all(abs(taken[s] - target[s]) <= block + n_shards for s in target)
    # the documents of the mix hold each word as often as it is taken
    held, out = defaultdict(Counter), mixed_documents(df, **options)
    assert out.columns == df.columns
    for r in out.collect():
        held[r.doc_id].update(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    for k in range(70):
        words = WORD.findall(texts[k])
        assert {w: n for w, n in held[k].items()} == {words[j]: n for j, n in want[k][3].items() if n}


def test_the_number_of_shards_changes_what_is_taken(documents):
    df = documents([f"w{k} " * (10 + k % 90) for k in range(300)], source=["abc"[k % 3] for k in range(300)])
    taken = lambda n: {r.doc_id: (r.taken, len(r.parts)) for r in mix(df, n_shards=n).collect()}
    one, eight = taken(1), taken(8)
    assert one != eight and taken(8) == eight
    assert abs(sum(v[0] for v in one.values()) - sum(v[0] for v in eight.values())) <= 3 * 8


def test_rows_that_differ_in_other_columns_stay_apart(spark):
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "de", "s", 5), (1, "a b c", "de", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixed_documents(docs, share=2.0).collect()
    assert sorted(r.lang for r in got) == ["de"] * 4 + ["en"] * 2


def test_targets_of_one_and_of_no_source(spark):
    one = spark.createDataFrame([("s", 10)], "source string, size long")
    assert source_targets(one).first().target == 15.0
    assert source_targets(one.where("false")).count() == 0


def plain_shards(texts, n):
    """shard and slot of every document (ids are places) by one sort."""
    first = {}
    for k, t in enumerate(texts):
        first.setdefault(t, k)
    size = [len((t or "").encode()) + 1 for t in texts]
    order = sorted(range(len(texts)), key=lambda k: (first[texts[k]], k))
    at, total, slots, out = 0, sum(size), Counter(), {}
    for k in order:
        shard = min(int((at + size[k] / 2) * n // total), n - 1)
        out[k] = (size[k], at, shard, slots[shard])
        slots[shard] += 1
        at += size[k]
    return out


def test_shards_against_a_sort(documents):
    texts = [f"text {k} é" * (1 + k % 40) for k in range(800)] + [None, "", None]
    for k in (5, 300, 700):
        texts[k] = texts[250]
    rows = byte_shards(documents(texts), 8).collect()
    assert {r.doc_id: (r.size, r.start, r.shard, r.slot) for r in rows} == plain_shards(texts, 8)
    assert all(r.text_crc32 == (None if texts[r.doc_id] is None else zlib.crc32(texts[r.doc_id].encode())) for r in rows)
    per, of_text = defaultdict(int), defaultdict(set)
    for r in rows:
        per[r.shard] += r.size
        of_text[texts[r.doc_id]].add(r.shard)
    assert sorted(per) == list(range(8)) and max(per.values()) - min(per.values()) <= 2 * max(r.size for r in rows)
    assert sum(len(s) - 1 for s in of_text.values()) <= 7  # a border cuts one group of equal texts at most


def test_a_hot_group_of_copies_is_cut(documents):
    rows = byte_shards(documents(["same text"] * 500 + [f"other {k}" for k in range(500)]), 8).collect()
    per = defaultdict(int)
    for r in rows:
        per[r.shard] += r.size
    assert len(per) == 8 and max(per.values()) - min(per.values()) <= 24


def test_awkward_rows(awkward, nothing):
    n = awkward.count()
    assert mix(awkward).count() == n and byte_shards(awkward).count() == n
    assert all(r.size == 1 and r.text_crc32 is None for r in byte_shards(awkward).where("text_crc32 is null").collect())
    assert mixed_documents(awkward.select("doc_id", "text", "lang", "source", "n_chars")).count() > 0
    assert mix(nothing).count() == 0 and byte_shards(nothing).count() == 0 and mixed_documents(nothing).count() == 0
