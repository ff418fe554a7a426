"""Best-fit packing of token pieces by a grouping genetic algorithm.

Full pieces are sequences of their own.  The others are dealt in a seeded order to groups of at most ``group_items``
pieces.  Each group is packed by ``islands`` populations, rows of their own that Spark spreads over tasks.  A child takes
whole well-filled bins of one parent, drops the bins of the other that hold the same pieces, and best-fits the displaced
pieces; the fitness is the mean squared fill.  Between epochs every island sends its elite to the next one.  A group
stops early only once its number of bins is the proven least (total length over capacity).  The poorly filled bins of all
groups are then packed again together.

Defined results: null and empty texts are the end id alone; repeated rows and ids are pieces of their own; null ids stay
null; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.tokens import token_pieces
from cairn.operators.prefix import durable, grouped_prefix, task_count
from cairn.session import ship_by_value

Bins = list[list[int]]


def best_fit(items: list[int], lengths: list[int], capacity: int, bins: Bins) -> Bins:
    """Add ``items`` in their order to ``bins``, each to the fullest bin that has room, else to a new one."""
    room: dict[int, list[int]] = {}
    mask = 0
    for k, b in enumerate(bins):
        left = capacity - filled(b, lengths)
        room.setdefault(left, []).append(k)
        mask |= 1 << left
    for i in items:
        size = lengths[i]
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            k = room[left].pop()
            if not room[left]:
                mask &= ~(1 << left)
            bins[k].append(i)
        else:
            left, k = capacity, len(bins)
            bins.append([i])
        room.setdefault(left - size, []).append(k)
        mask |= 1 << (left - size)
    return bins


def filled(b: list[int], lengths: list[int]) -> int:
    return sum(map(lengths.__getitem__, b))


def fitness(bins: Bins, lengths: list[int], capacity: int) -> float:
    return sum(filled(b, lengths) ** 2 for b in bins) / (max(len(bins), 1) * capacity * capacity)


def crossover(a: Bins, b: Bins, lengths: list[int], capacity: int, rng: random.Random) -> Bins:
    """``a`` with a draw of the well-filled bins of ``b`` injected."""
    ranked = sorted(b, key=lambda x: -filled(x, lengths))
    top = ranked[:max(1, len(ranked) // 2)]
    taken = rng.sample(top, rng.randint(1, len(top)))
    inside = {i for x in taken for i in x}
    kept, displaced = [list(x) for x in taken], []
    for x in a:
        if inside.isdisjoint(x):
            kept.append(list(x))
        else:
            displaced += [i for i in x if i not in inside]
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(displaced, lengths, capacity, kept)


def mutate(bins: Bins, lengths: list[int], capacity: int, rng: random.Random) -> Bins:
    """Empty a few of the least filled bins and one other, and best-fit their pieces again."""
    ranked = sorted(bins, key=lambda x: filled(x, lengths))
    out = max(1, len(ranked) // 20)
    if len(ranked) > out:
        ranked.insert(0, ranked.pop(rng.randrange(out, len(ranked))))
        out += 1
    loose = [i for x in ranked[:out] for i in x]
    rng.shuffle(loose)
    loose.sort(key=lambda i: -lengths[i] * rng.uniform(0.8, 1.0))
    return best_fit(loose, lengths, capacity, [list(x) for x in ranked[out:]])


def evolve(lengths: list[int], capacity: int, start: list[Bins], seed: str, population: int, generations: int) -> Bins:
    """Best individual of one island after ``generations``, from ``start`` and seeded best-fit packings."""
    rng, least = random.Random(seed), -(-sum(lengths) // capacity)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    people = list(start) or [best_fit(order, lengths, capacity, [])]
    if min(map(len, people)) <= least:
        return min(people, key=len)
    while len(people) < population:
        noisy = sorted(order, key=lambda i: -lengths[i] * rng.uniform(0.7, 1.0))
        people.append(best_fit(noisy, lengths, capacity, []))
    # an individual is (bins, -fitness, packing); its score is formed once
    scored = lambda p: (len(p), -fitness(p, lengths, capacity), p)
    score = lambda x: x[:2]
    ranked = sorted(map(scored, people), key=score)
    for _ in range(generations):
        if ranked[0][0] <= least:
            break
        children = [mutate(ranked[0][2], lengths, capacity, rng)]
        while len(children) < population // 2:
            a, b = (min(rng.sample(ranked, 2), key=score)[2] for _ in range(2))
            children.append(crossover(a, b, lengths, capacity, rng))
        ranked = sorted(ranked + [scored(c) for c in children], key=score)[:population]
    return ranked[0][2]


def _bins_of(labels: list[int]) -> Bins:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(labels):
        out.setdefault(k, []).append(i)
    return list(out.values())


def evolve_groups(loose: DataFrame, n: int, *, capacity: int, group_items: int, islands: int, epochs: int, population: int,
                  generations: int, seed: str) -> DataFrame:
    """g, bin, __i, __len: ``loose`` (__i, length and a place ``at`` of 0..n-1) packed in groups that evolve on islands."""
    spark, groups = loose.sparkSession, max(1, -(-n // group_items))
    dealt = loose.select((F.col("at") % groups).alias("g"), F.struct("__i", "length").alias("x"))
    rows = (dealt.groupBy("g").agg(F.array_sort(F.collect_list("x")).alias("x"))  # at most group_items each
            .select("g", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "x",
                    F.array().cast("array<array<int>>").alias("start")))
    rows = rows.repartition(task_count(spark, groups * islands, 4), "g", "island")

    def step(epoch: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                best = []
                for g, island, x, start in zip(batch["g"], batch["island"], batch["x"], batch["start"]):
                    lengths = [int(r["length"]) for r in x]
                    bins = evolve(lengths, capacity, [_bins_of([int(v) for v in s]) for s in start],
                                  f"{seed}:{g}:{island}:{epoch}", population, generations)
                    labels = [0] * len(lengths)
                    for k, b in enumerate(bins):
                        for i in b:
                            labels[i] = k
                    best.append(labels)
                yield batch[["g", "island", "x"]].assign(best=best)
        return run

    shape = "g long, island int, x array<struct<__i:long,length:long>>, best array<int>"
    for epoch in range(epochs):
        elite = rows.mapInPandas(step(epoch), shape)
        if epoch + 1 < epochs:  # each island keeps its elite and gets that of the one before it
            to = F.explode(F.array_distinct(F.array("island", ((F.col("island") + 1) % islands).cast("int"))))
            rows = (elite.select("g", to.alias("island"), "x", "best").groupBy("g", "island")
                    .agg(F.first("x").alias("x"), F.array_sort(F.collect_list("best")).alias("start")))
    fewest = (elite.withColumn("bins", F.array_max("best")).groupBy("g")
              .agg(F.min_by("best", F.struct("bins", "island")).alias("best"), F.first("x").alias("x")))
    return (fewest.select("g", F.explode(F.arrays_zip("x", "best")).alias("p"))
            .select("g", F.col("p.best").alias("bin"), F.col("p.x.__i").alias("__i"), F.col("p.x.length").alias("__len")))


def pack(pieces: DataFrame, *, capacity: int = 1024, group_items: int = 1536, islands: int = 3, epochs: int = 2,
         population: int = 6, generations: int = 5, poor: float = 0.99, seed: int = 1) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32, ...) with sequence_id and offset.

    Groups do not see each other's pieces, so each may end with a few sequences that are filled to less than ``poor``.
    Their pieces are dealt to new groups and packed again, until one group holds all of them or a round saves nothing.
    """
    options = dict(capacity=capacity, group_items=group_items, islands=islands, epochs=epochs, population=population,
                   generations=generations)
    pieces = durable(pieces)
    drawn = pieces.withColumn("__full", F.col("length") >= capacity).withColumn(
        "__draw", F.xxhash64(F.lit(seed), "doc_id", "piece", "start", "length", "ids_crc32"))
    laid = durable(grouped_prefix(drawn, ["__draw", "doc_id", "piece"], group=["__full"], index="__i"))
    n = laid.where("not __full").count()
    placed = durable(evolve_groups(laid.where("not __full").select("__i", "length", F.col("__i").alias("at")), n,
                                   seed=str(seed), **options).withColumn("round", F.lit(0)))
    settled, turn = None, 0
    while n > group_items:  # more than one group: pieces of poor bins of all of them meet
        turn += 1
        bins = placed.groupBy("g", "bin").agg(F.sum("__len").alias("fill"), F.count(F.lit(1)).alias("items"))
        low = durable(bins.where(F.col("fill") < poor * capacity))
        before, items = low.agg(F.count(F.lit(1)), F.sum("items")).first()
        if before < 2:
            break
        loose = placed.join(low.select("g", "bin"), ["g", "bin"]).select("__i", F.col("__len").alias("length"))
        loose = grouped_prefix(loose, [F.xxhash64(F.lit(turn), "__i")], index="at")
        again = durable(evolve_groups(loose, items, seed=f"{seed}/{turn}", **options).withColumn("round", F.lit(turn)))
        if again.select("g", "bin").distinct().count() >= before:
            break
        good = placed.join(low.select("g", "bin"), ["g", "bin"], "left_anti")
        settled, placed, n = good if settled is None else settled.unionByName(good), again, items
    placed = placed if settled is None else settled.unionByName(placed)
    inside = F.expr("sum(__len) over (partition by round, g, bin order by __i rows between unbounded preceding and current row)")
    number = (F.col("g") * (group_items + 1) + F.col("bin")) * 64 + F.col("round")  # rounds shrink at least by halves
    placed = placed.select("__i", number.cast("long").alias("sequence_id"), (inside - F.col("__len")).cast("long").alias("offset"))
    loose = laid.where("not __full").join(placed, "__i").select(*pieces.columns, "sequence_id", "offset")
    full = laid.where("__full").select(*pieces.columns, (-1 - F.col("__i")).cast("long").alias("sequence_id"),
                                       F.lit(0).cast("long").alias("offset"))
    return loose.unionByName(full)


def pack_documents(docs: DataFrame, *, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False, **options) -> DataFrame:
    """Whole documents as pieces in sequences: doc_id, piece, start, length, ids_crc32 (and ids), sequence_id, offset."""
    pieces = token_pieces(docs, tokenizer=tokenizer, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col,
                          with_ids=with_ids)
    return pack(pieces, capacity=capacity, **options)


ship_by_value(__name__)
