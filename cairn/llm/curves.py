"""Approximate nearest neighbours by shifted space-filling curves.

Equal vectors are one class.  Every curve projects the classes onto ``axes`` random orthogonal directions, shifts them by
a random offset, cuts each axis into ``2 ** bits`` cells and numbers the cells along a Hilbert curve; classes are then
range-partitioned by (curve, cell number), and a distributed prefix count gives each its place on each curve.  A query is
compared with all classes within ``window`` places on any curve.  A curve is cut into blocks of ``block`` places, a query
goes to the blocks that its window meets, so a task never holds more than a block and the queries about it; only each
block's nearest leave it.  Results of all blocks and curves merge by query and are ranked by distance in double precision.

The window is measured, not guessed: for up to ``probes`` queries the true neighbours are found by comparing all classes
with them (a fixed number of vectors, one pass), and the window is the least that holds ``target_recall`` of them, at
least ``min_window``.  In data without near neighbours it therefore grows as the data asks for it.  A table of at most
``min_window`` classes is compared whole, so the result is exact there.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, take no
part; vectors of unequal length are compared as if zeros followed the shorter; a repeated row is a candidate of its own,
and a query leaves out one row of its id and vector; ties go to the smaller id; extra columns are ignored; an empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.llm.common import dealt_join
from cairn.operators.prefix import durable, grouped_prefix, task_count
from cairn.session import ship_by_value


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cells, as big-endian bytes (one row each).

    Axes are reflected and exchanged from the coarsest bit down, then Gray-coded; the bits are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for axis in x:
            upper = (axis >> b) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(upper, low, swap)
            axis ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1  # bit, axis, row
    return np.packbits(planes.reshape(-1, x.shape[1]).T.astype(np.uint8), axis=1)


class Curve:
    """One projection with its shift and scale."""

    def __init__(self, number: int, sample: np.ndarray, axes: int, bits: int, seed: int) -> None:
        rng, dim = np.random.default_rng([seed, number]), sample.shape[1]
        self.axes = np.linalg.qr(rng.standard_normal((dim, dim)))[0][:, :axes]
        p = sample @ self.axes
        low, high = np.quantile(p, [0.005, 0.995], axis=0) if len(p) else np.zeros((2, self.axes.shape[1]))
        self.span = 4.0 * (float((high - low).max()) or 1.0)  # one cube for all axes, wide enough for the shift
        self.origin = (low + high) / 2 - self.span * rng.uniform(0.3, 0.7, self.axes.shape[1])
        self.bits = bits

    def places(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            cells = np.nan_to_num((x @ self.axes - self.origin) / self.span, nan=0.0, posinf=1.0, neginf=0.0)
        return hilbert(np.clip(cells * 2 ** self.bits, 0, 2 ** self.bits - 1), self.bits)


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 0))


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distance of one vector to each row, summed in the order of the components."""
    top = max(float(np.abs(q).max(initial=0)), float(np.abs(x).max(initial=0)))
    scale = top if top > 1e150 or 0 < top < 1e-150 else 1.0  # squares would leave the range of doubles
    return np.sqrt(np.cumsum(((q / scale - x / scale) if scale != 1.0 else (q - x)) ** 2, axis=1)[:, -1]) * scale


def nearest(queries: np.ndarray, x: np.ndarray, allowed: np.ndarray | None, low: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, rows, distances) of the ``k`` nearest allowed rows of each query by distance, then ``low``.

    A matrix product finds rows that may be among them, with room for its rounding; only those are measured.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        qq, xx = (queries ** 2).sum(axis=1), (x ** 2).sum(axis=1)
        rough = qq[:, None] + xx[None, :] - 2 * (queries @ x.T)
        room = 1e-12 * x.shape[1] * (qq + xx.max(initial=0))
    for i in range(len(queries)):
        rows = np.arange(len(x)) if allowed is None else np.flatnonzero(allowed[i])
        r = rough[i, rows]
        if len(rows) > k and np.isfinite(r).all() and np.isfinite(room[i]):
            rows = rows[r <= np.partition(r, k - 1)[k - 1] + room[i]]
        d = distances(queries[i], x[rows])
        best = np.lexsort((low[rows], d))[:k]
        yield i, rows[best], d[best]


def usable(vector: Column, key: Column) -> Column:
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda v: v != 0) & key.isNotNull(), F.lit(False))


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """cid, h1, h2, vector, low, asked (query rows), ids: one row per distinct vector, with its k + 1 smallest ids.

    Window limits and partial aggregates reduce a vector that a third of all rows share before the shuffle.
    """
    first = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id"))
    ids = (rows.select("h1", "h2", "vec_id").withColumn("__r", first).where(F.col("__r") <= k + 1)
           .groupBy("h1", "h2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    each = rows.groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.sum(F.col("query").cast("long")).alias("asked"))
    return durable(each.join(ids, ["h1", "h2"]).withColumns({"cid": F.monotonically_increasing_id(), "low": F.col("ids")[0]}))


def places_on_curves(classes: DataFrame, curves: list[Curve]) -> DataFrame:
    """curve, place, cid: the order of all classes on each curve.  Only cell numbers are shuffled, no vectors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = matrix(batch["vector"])
            for n, curve in enumerate(curves):
                yield pd.DataFrame({"curve": n, "cell": [c.tobytes() for c in curve.places(x)], "cid": batch["cid"].to_numpy()})

    cells = classes.select("cid", "vector").mapInPandas(run, "curve int, cell binary, cid long")
    laid = grouped_prefix(cells, ["cell", "cid"], group=["curve"], index="place")
    return durable(laid.select("curve", "place", "cid"))


def measured_window(classes: DataFrame, places: DataFrame, *, k: int, probes: int, target_recall: float, min_window: int) -> int:
    """Least window that holds ``target_recall`` of the true neighbours of up to ``probes`` queries."""
    spark = classes.sparkSession
    drawn = classes.where("asked > 0").orderBy(F.xxhash64("h1", "h2"), "cid").limit(probes).select("cid", "vector").toPandas()
    if not len(drawn):
        return min_window
    asked, own = matrix(drawn["vector"]), drawn["cid"].to_numpy()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cid, x = batch["cid"].to_numpy(), matrix(batch["vector"])
            out = [pd.DataFrame({"probe": own[i], "cid": cid[rows], "d": d})
                   for i, rows, d in nearest(asked, x, cid[None, :] != own[:, None], cid, k)]
            yield pd.concat(out, ignore_index=True)

    true = classes.select("cid", "vector").mapInPandas(run, "probe long, cid long, d double")
    rank = F.row_number().over(Window.partitionBy("probe").orderBy("d", "cid"))
    true = F.broadcast(durable(true.withColumn("r", rank).where(F.col("r") <= k).select("probe", "cid")))  # probes * k rows
    at = F.broadcast(spark.createDataFrame([(int(c),) for c in own], "probe long"))
    at = places.join(at, F.col("cid") == F.col("probe")).select("curve", "probe", F.col("place").alias("from"))
    away = (places.join(true, "cid").join(F.broadcast(at), ["curve", "probe"])  # curves * probes rows
            .groupBy("probe", "cid").agg(F.min(F.abs(F.col("place") - F.col("from"))).alias("away")))
    window = away.agg(F.percentile("away", F.lit(float(target_recall)))).first()[0]
    return max(min_window, int(np.ceil(window or 0)))


def nearest_neighbours(vectors: DataFrame, is_query: Column, *, k: int = 10, curves: int = 12, axes: int = 16, bits: int = 10,
                       block: int = 1024, min_window: int = 1024, target_recall: float = 0.97, probes: int = 512,
                       fit_sample: int = 4096, seed: int = 1, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest rows found for each row where ``is_query`` holds.

    ``fit_sample`` rows (smallest hashes) set the scale of the curves; every row lies on every curve.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("query"))
    rows = durable(rows.where(usable(F.col("vector"), F.col("vec_id")))
                   .withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")}))
    classes = classes_of(rows, k)
    dim = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    classes = classes.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("vector"))))
    sample = matrix(classes.orderBy(F.xxhash64("h2", "h1"), "cid").limit(fit_sample).select("vector").toPandas()["vector"])
    if not len(sample):
        sample = np.zeros((0, dim))
    made = [Curve(n, sample, min(axes, dim), bits, seed) for n in range(curves)]
    places = places_on_curves(classes, made)
    window = measured_window(classes, places, k=k, probes=probes, target_recall=target_recall, min_window=min_window)

    laid = places.join(classes.select("cid", "vector", "low", "asked"), "cid")
    held = laid.select("curve", (F.col("place") / block).cast("long").alias("part"), "place", "cid", "low", "vector")
    met = F.explode(F.sequence((F.greatest(F.col("place") - window, F.lit(0)) / block).cast("long"),
                               ((F.col("place") + window) / block).cast("long")))
    asks = laid.where("asked > 0").select(F.col("curve").alias("on"), met.alias("met"), F.col("place").alias("at"),
                                          F.col("cid").alias("query"), F.col("vector").alias("asked"))

    def compared(asks: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "cid": [], "low": [], "d": []}
        if len(asks) and len(held):
            x, cid, low, place = matrix(held["vector"]), *(held[c].to_numpy() for c in ("cid", "low", "place"))
            for a in range(0, len(asks), 256):
                some = asks.iloc[a:a + 256]
                own, at = some["query"].to_numpy(), some["at"].to_numpy()
                allowed = (np.abs(at[:, None] - place[None, :]) <= window) & (own[:, None] != cid[None, :])
                for i, found, d in nearest(matrix(some["asked"]), x, allowed, low, k + 1):
                    out["query"].append(np.full(len(found), own[i]))
                    out["cid"].append(cid[found])
                    out["low"].append(low[found])
                    out["d"].append(d)
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in out.items()}).astype(
            {"query": "int64", "cid": "int64", "low": "int64", "d": "float64"})

    found = (asks.groupBy("on", "met").cogroup(held.groupBy("curve", "part"))
             .applyInPandas(compared, "query long, cid long, low long, d double"))
    own = classes.where("asked > 0").select(F.col("cid").alias("query"), "cid", "low", F.lit(0.0).alias("d"))
    found = found.unionByName(own).groupBy("query", "cid").agg(F.min("d").alias("d"), F.first("low").alias("low"))
    best = F.row_number().over(Window.partitionBy("query").orderBy("d", "low"))
    found = durable(found.withColumn("r", best).where(F.col("r") <= k + 1).select("query", "cid", "d"))
    # the classes of a query's nearest rows are among its k + 1 nearest classes, and their rows among the k + 1 of each
    member = found.join(classes.select("cid", F.explode("ids").alias("id")), "cid")
    lists = member.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "id"))), 1, k + 1).alias("near"))
    keyed = durable(classes.where("asked > 0").select(F.col("cid").alias("query"), "h1", "h2", "asked").join(lists, "query").drop("query"))
    each = dealt_join(rows.where("query").select("vec_id", "h1", "h2"), keyed, ["h1", "h2"], "asked")
    same = F.array_position(F.transform("near", lambda x: (x["id"] == F.col("vec_id")) & (x["d"] == 0)), F.lit(True))
    others = F.slice(F.filter("near", lambda x, i: (i + 1) != F.col("__self")), 1, k)
    return (each.withColumn("__self", same).select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("r", "x"))
            .select("query_id", (F.col("r") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.d").alias("score")))


ship_by_value(__name__)
