"""Helpers shared by the training-data operators: tables, word patterns, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.prefix import durable, task_count

#: White space that separates words, and a word (fixed by the task).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; the path may lie in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text; null text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: ``node`` and ``root`` (smallest node reachable).

    Alternating large-star / small-star contraction (Kiveris et al. 2014):
    per round two partial aggregates (``min`` per node, combined before the
    shuffle) and two joins, whose hot nodes are dealt out; each round is cut by
    checkpoints.  Only nodes with an edge appear; self-loops and null ends are
    ignored.  The number of rounds is logarithmic; ``max_rounds`` guards
    against a broken session and raises rather than returning a wrong answer.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e, state = durable(e), None
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = durable(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n")))
        large = (dealt_join(both, low, ["u"], "n").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())
        # small star: each node u links its smaller neighbours and itself to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        e = durable(joined.select(F.col("v").alias("x"), "m").union(least.select(F.col("u").alias("x"), "m"))
                    .where("x != m").distinct().select(F.col("x").alias("u"), F.col("m").alias("v")))
        now = tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == state:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
    raise RuntimeError("component contraction did not settle")


def component_of(nodes: DataFrame, key: str, edges: DataFrame, out: str = "component") -> DataFrame:
    """``nodes`` with the smallest key reachable by ``edges`` (columns a, b) over the same keys; itself where alone."""
    comp = connected_components(edges).select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    return (nodes.join(comp, F.col(key) == F.col("__n"), "left")
            .withColumn(out, F.coalesce("__r", F.col(key))).drop("__n", "__r"))


def dealt_join(rows: DataFrame, per_key: DataFrame, on: list[str], count: str) -> DataFrame:
    """Inner equi-join of ``rows`` with one row per key, however many rows share a key.

    ``per_key`` names in ``count`` how many rows have its key (a column that the result does not keep).  Keys with more
    rows than a quarter of a task's fair part are fewer than four a task, so they are broadcast and their rows stay
    where they are; the rows of all other keys meet by a shuffle in which none stands out.  Both inputs are read twice:
    pass durable ones.  Null keys join nothing.
    """
    tasks = task_count(rows.sparkSession)
    total = per_key.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) > F.lit(max(total // (4 * tasks), 1))
    few = F.broadcast(per_key.where(hot).drop(count))
    return rows.join(few, on).unionByName(
        rows.join(F.broadcast(per_key.where(hot).select(*on)), on, "left_anti").join(per_key.where(~hot).drop(count), on))
