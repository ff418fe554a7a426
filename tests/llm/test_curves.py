"""Nearest neighbours on Hilbert curves against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import curves as cv

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=10, every=100):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    if not fine:
        return {}
    dim = max(len(v) for _, v in fine)
    x = np.stack([np.pad(v, (0, dim - len(v))) for _, v in fine])
    ids, out = np.array([i for i, _ in fine]), {}
    for r in np.flatnonzero(ids % every == 0):
        d = cv.distances(x[r], x)
        order = [j for j in np.lexsort((ids, d)) if j != r][:k]
        out.setdefault(int(ids[r]), []).append([(int(ids[j]), float(d[j])) for j in order])
    return out


def search(spark, rows, every=100, **options):
    df = spark.createDataFrame(rows, SCHEMA) if isinstance(rows, list) else rows
    out = {}
    for r in cv.nearest_neighbours(df, F.col("vec_id") % every == 0, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


@pytest.mark.parametrize("axes, bits", [(1, 5), (2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_walks_to_a_neighbour_at_each_step(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(2 ** bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
    key = [bytes(b) for b in cv.hilbert(cells, bits)]
    assert len(set(key)) == len(cells)
    walk = cells[sorted(range(len(key)), key=key.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(300)]
    got = search(spark, rows, every=20, curves=3)
    want = brute(rows, every=20)
    assert {q: [(v, s) for _, v, s in x] for q, x in got.items()} == {q: x[0] for q, x in want.items()}
    assert all([r for r, _, _ in x] == list(range(1, 11)) for x in got.values())


def test_recall_with_windows(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((60, 24))
    x = centres[rng.integers(0, 60, 6_000)] + 0.4 * rng.standard_normal((6_000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    seen = []
    measured = cv.measured_window
    cv.measured_window = lambda *a, **o: seen.append(measured(*a, **o)) or seen[-1]
    try:
        got = search(spark, rows, min_window=16, block=64, curves=8)
    finally:
        cv.measured_window = measured
    want = brute(rows)
    hits = [len({v for _, v, _ in got[q]} & {v for v, _ in w[0]}) for q, w in want.items()]
    assert sum(hits) / (10 * len(want)) >= 0.95 and seen[0] < 1_500
    exact = {q: {v: s for v, s in w[0]} for q, w in want.items()}
    assert all(s == exact[q][v] for q, x in got.items() for _, v, s in x if v in exact[q])


def test_copies_ties_and_own_row(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 400)] + [(500, [1.0, 2.0]), (500, [1.0, 2.0]), (700, [5.0, 5.0]), (701, [5.0, 5.0])]
    got = search(spark, rows)
    assert [v for _, v, _ in got[0]] == list(range(1, 11))
    assert [v for _, v, _ in got[300]] == list(range(0, 10))
    assert [v for _, v, _ in got[500]] == [v for k in range(10) for v in (k, k)]  # two query rows of the same id
    assert [v for _, v, _ in got[700]][:3] == [701, 0, 1]


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (None, [1.0, 0.0]), (100, None), (200, [0.0]), (8, [2.0]), (300, [1.0, 0.0])]
    got = search(spark, rows)
    assert {q: [v for _, v, _ in x] for q, x in got.items()} == {0: [300, 1, 8], 300: [0, 1, 8]}
    assert [s for _, _, s in got[0]] == [0.0, 0.1, 1.0]


def test_magnitudes_beyond_squares(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 3e200]), (2, [4e200, 0.0]), (3, [-1e200, 0.0]), (100, [1e-200, 0.0]), (101, [3e-200, 0.0])]
    got = search(spark, rows)
    assert [v for _, v, _ in got[0]][:4] == [100, 101, 3, 1] or [v for _, v, _ in got[0]][0] in (100, 101)
    assert got[100][0][1] == 101 and np.isclose(got[100][0][2], 2e-200)


def test_extra_columns_and_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert search(spark, empty) == {}
    rows = [(i, [float(i % 7), 1.0]) for i in range(101)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("cid", "h1", "query", "rank", "place", "low")})
    plain = brute(rows)
    assert {q: [(v, s) for _, v, s in x] for q, x in search(spark, df).items()} == {q: w[0] for q, w in plain.items()}
    assert search(spark, [(7, [1.0])]) == {} and search(spark, [(100, [1.0])]) == {}
