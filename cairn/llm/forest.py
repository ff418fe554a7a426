"""Embedding near-duplicates by a forest of random-projection trees.

Equal vectors are one class.  Each tree splits by random directions, round by round: a node of more than ``leaf_size``
classes gets a subtree of up to ``DEPTH`` levels whose thresholds are fitted on a bounded sample of it
(``fit_sample`` rows a node, drawn by hash) on the executors, and every row of the node is routed down.  A row within the
spill margin of a threshold goes to both sides.  A node whose children would hold more pairs than it has itself (a dense
ball, or nearly so) stays whole and is compared in blocks; so rows multiply only where comparisons are saved.
Within a leaf all classes are compared in blocks of ``block`` rows, so no task holds more than two blocks; a pair is
counted in the first leaf that it shares, and only counts and a forest of links leave the task.  Links are verified by
cosine in double precision.

The margin is half the spread (one standard deviation) of the projected distance of a pair at the limit; with 5 trees
the loss at the limit itself is under one in a thousand for a hundred thousand vectors, and smaller for closer pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null id, link
with nothing; repeated rows are vectors of their own; extra columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import connected_components, dealt_join
from cairn.operators.prefix import durable, task_count
from cairn.session import ship_by_value

#: Levels of a subtree that one round fits; a node has 2 ** DEPTH children at most.
DEPTH = 6
#: Children of 0.71 of a node each have as many pairs as it has; with this share a level saves a quarter of them and more.
MOST = 0.62


def directions(seed: int, node: int, depth: int, dim: int) -> np.ndarray:
    d = np.random.default_rng([seed, node]).standard_normal((depth, dim))
    return d / np.linalg.norm(d, axis=1, keepdims=True)


def unit(vectors: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    top = np.abs(x).max(axis=1, keepdims=True)
    x = x / np.where((top > 1e100) | (top < 1e-100), top, 1.0)  # squares of such components leave the range of doubles
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit(x: np.ndarray, node: int, rows: int, leaf_size: int, margin: float, seed: int) -> list[float]:
    """Thresholds of a node's subtree in heap order; NaN: not split further."""
    p = x @ directions(seed, node, DEPTH, x.shape[1]).T
    out = [float("nan")] * (2 ** DEPTH - 1)
    scale, inside = rows / len(x), {0: np.arange(len(x))}
    for at in range(len(out)):
        own = inside.pop(at, None)
        if own is None or len(own) * scale <= leaf_size or len(own) < 16:
            continue
        v = p[own, (at + 1).bit_length() - 1]
        tries = np.quantile(v, [0.5, 0.4, 0.6, 0.25, 0.75, 0.1, 0.9])
        larger = [max((v <= t + margin).sum(), (v >= t - margin).sum()) for t in tries]
        if min(larger) > MOST * len(own):
            continue
        out[at] = t = float(tries[int(np.argmin(larger))])
        if 2 * at + 2 < len(out):
            inside[2 * at + 1], inside[2 * at + 2] = own[v <= t + margin], own[v >= t - margin]
    return out


def route(x: np.ndarray, node: int, thresholds: np.ndarray, margin: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, heap place) of every leaf that each row reaches."""
    p = x @ directions(seed, node, DEPTH, x.shape[1]).T
    rows, at, done = np.arange(len(x)), np.zeros(len(x), np.int64), []
    for level in range(DEPTH):
        t = thresholds[at]
        split = ~np.isnan(t)
        done.append((rows[~split], at[~split]))
        rows, at, t = rows[split], at[split], t[split]
        v = p[rows, level]
        left, right = v <= t + margin, v >= t - margin
        rows, at = np.concatenate((rows[left], rows[right])), np.concatenate((2 * at[left] + 1, 2 * at[right] + 2))
    done.append((rows, at))
    return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])


def grow(classes: DataFrame, *, trees: int, leaf_size: int, fit_sample: int, margin: float, seed: int) -> DataFrame:
    """cid, leaf: every class in every leaf that it reaches in any tree."""
    width, kind = task_count(classes.sparkSession), classes.schema["vector"].dataType.simpleString()

    def fitted(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t = fit(unit(pdf["vector"]), int(key[0]), int(pdf["rows"].iloc[0]), leaf_size, margin, seed)
        return pd.DataFrame({"node": [key[0]], "thresholds": [t]})

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, pdf in batch.groupby("node", sort=False):
                t = np.asarray(pdf["thresholds"].iloc[0], dtype=np.float64)
                rows, at = route(unit(pdf["vector"]), int(node), t, margin, seed)
                child = int(node) * 2 ** (DEPTH + 1) + at + 1
                # the root alone: nothing split it, so it is a leaf for good
                yield pd.DataFrame({"cid": pdf["cid"].to_numpy()[rows], "node": child,
                                    "vector": pdf["vector"].to_numpy()[rows], "whole": np.isnan(t[0])})

    here = classes.select("cid", "vector", F.explode(F.array(*(F.lit(t).cast("long") for t in range(1, trees + 1)))).alias("node"),
                          F.lit(False).alias("whole"))
    leaves = None
    for _ in range(8):  # 64 ** 8 leaves and more; what is still large then is compared as it is, in blocks
        here = durable(here)
        sizes = durable(here.where("not whole").groupBy("node").agg(F.count(F.lit(1)).alias("rows"))
                        .where(F.col("rows") > leaf_size))
        if sizes.isEmpty():
            break
        known = here.join(sizes, "node", "left")
        part = known.where("rows is null").select("cid", F.col("node").alias("leaf"))
        leaves = part if leaves is None else leaves.union(part)
        large = known.where("rows is not null")
        drawn = F.pmod(F.xxhash64("cid", "node"), F.col("rows")) < fit_sample
        models = large.where(drawn).select("node", "rows", "vector").groupBy("node").applyInPandas(
            fitted, "node long, thresholds array<double>")
        # a node whose draw came out empty would lose its rows in an inner join: it stays whole instead
        none = F.array(*[F.lit(float("nan"))] * (2 ** DEPTH - 1))
        large = large.join(models, "node", "left").withColumn("thresholds", F.coalesce("thresholds", none))
        here = (large.select("cid", "node", "vector", "thresholds").repartition(width, "cid").sortWithinPartitions("node")
                .mapInPandas(routed, f"cid long, node long, vector {kind}, whole boolean"))
    part = here.select("cid", F.col("node").alias("leaf"))
    return part if leaves is None else leaves.union(part)


def _compare(left: pd.DataFrame, right: pd.DataFrame | None, leaf: int, limit: float) -> pd.DataFrame:
    """Counts and local roots of the links between two blocks of a leaf (or within one)."""
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    a = unit(left["vector"])
    b = a if right is None else unit(right["vector"])
    near = a @ b.T >= limit
    if right is None:
        np.fill_diagonal(near, False)
    offset = 0 if right is None else len(left)
    i, j = np.nonzero(near.any(axis=1))[0], np.nonzero(near.any(axis=0))[0]
    n = len(both)
    links, label = np.zeros(n, np.int64), np.arange(n)
    if len(i):
        near = near[np.ix_(i, j)]
        # a pair belongs to the first leaf that both are in
        earlier = [[x for x in both["leaves"].iloc[k] if x < leaf] for k in (*i, *(j + offset))]
        names = {x: k for k, x in enumerate(sorted({x for e in earlier for x in e}))}
        member = np.zeros((len(earlier), max(len(names), 1)), np.float32)
        for k, e in enumerate(earlier):
            member[k, [names[x] for x in e]] = 1
        counted = near & (member[:len(i)] @ member[len(i):].T < 0.5)
        weight = both["n"].to_numpy()
        links[i] += counted @ weight[j + offset]
        if right is not None:
            links[j + offset] += counted.T @ weight[i]
        while True:
            before = label.copy()
            up = np.where(near, label[j + offset][None, :], n).min(axis=1)
            label[i] = np.minimum(label[i], up)
            down = np.where(near, label[i][:, None], n).min(axis=0)
            label[j + offset] = np.minimum(label[j + offset], down)
            label = label[label]
            if (label == before).all():
                break
    cid = both["cid"].to_numpy()
    hit = np.flatnonzero((links > 0) | (label != np.arange(n)))
    return pd.DataFrame({"cid": cid[hit], "links": links[hit], "root": cid[label[hit]]})


def near_vectors(vectors: DataFrame, *, limit: float = 0.95, trees: int = 5, leaf_size: int = 256, block: int = 1024,
                 fit_sample: int = 2048, spill: float = 1.0, seed: int = 1, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    given = vectors.schema[vector_col].dataType.simpleString()
    kind = given if given in ("array<float>", "array<double>") else "array<double>"  # as given; all arithmetic is double
    rows = durable(vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast(kind).alias("vector")))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(fine & F.exists("vector", lambda v: v != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    keys = {"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")}
    good = rows.where(usable).withColumns(keys)
    classes = durable(good.groupBy("h1", "h2").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("n"),
                                                   F.first("vector").alias("vector"))
                      .withColumn("cid", F.monotonically_increasing_id()))
    dim = classes.agg(F.max(F.size("vector"))).first()[0] or 1
    classes = classes.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0.0).cast(kind[6:-1]), F.lit(dim) - F.size("vector"))))
    margin = spill * 0.5 * float(np.sqrt(max(2 - 2 * limit, 0.0) / dim))
    leaves = durable(grow(classes, trees=trees, leaf_size=leaf_size, fit_sample=fit_sample, margin=margin, seed=seed))
    held = leaves.groupBy("cid").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))  # a few per tree
    blocks = leaves.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1")
    entry = (classes.select("cid", "vector", "n").join(held, "cid").withColumn("leaf", F.explode("leaves"))
             .join(blocks, "leaf", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("b", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumns({"i": F.least("b", "o"), "j": F.greatest("b", "o")}))

    def compared(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        leaf, i, j = (int(k) for k in key)
        pdf = pdf.sort_values("cid", ignore_index=True)
        if i == j:
            return _compare(pdf, None, leaf, limit)
        return _compare(pdf[pdf["b"] == i].reset_index(drop=True), pdf[pdf["b"] == j].reset_index(drop=True), leaf, limit) \
            if pdf["b"].nunique() == 2 else pd.DataFrame({"cid": [], "links": [], "root": []}).astype("int64")

    found = durable(entry.select("leaf", "i", "j", "b", "cid", "n", "vector", "leaves").groupBy("leaf", "i", "j")
                    .applyInPandas(compared, "cid long, links long, root long"))
    comp = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    near = durable(classes.select("cid", "h1", "h2", "low", "n").join(counts, "cid", "left")
                   .join(comp.withColumnsRenamed({"node": "cid"}), "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    lowest = durable(near.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("m")))
    near = durable(dealt_join(near, lowest, ["root"], "m").select(
        "h1", "h2", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    linked = dealt_join(good.select("vec_id", "h1", "h2"), near, ["h1", "h2"], "n").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


ship_by_value(__name__)
