"""Joins and windows along time (or any ordered value) that hold when one key has a third of all rows.

* :func:`as_of_join` - each row with the last row of another table at or before it;
* :func:`interval_join` - points with the intervals that contain them, without a nested loop;
* :func:`frame` - window functions over a bounded number of neighbouring rows.

A plain window or sort-merge join gathers a whole key in one task.  Here rows are placed by distributed prefix sums
(:mod:`cairn.operators.prefix`) or cut into blocks, and only borders are exchanged.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from cairn.operators.prefix import grouped_carry, grouped_prefix, task_count

#: An interval join of more pairs a row is dealt out by its pairs: so many a task, into so many tasks and parts of a bucket at most.
PAIRS_A_ROW, PAIRS_A_TASK, MOST_TASKS, MOST_PARTS = 32, 32_000_000, 4_096, 16


def as_of_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], times: tuple[str, str],
               take: Sequence[str], tie: Sequence[str] = (), strict: bool = False, within: Column | None = None,
               prefix: str = "") -> DataFrame:
    """``left`` with the columns ``take`` of the last ``right`` row of the same keys at or before its time.

    ``on`` pairs key columns (left, right), ``times`` names the two time columns.  Among right rows of one time the one
    with the greatest ``tie`` columns counts; without them, or where they are equal too, the greatest ``take`` values,
    so the result is settled.  ``strict`` asks for an earlier time.  ``within`` is the longest distance allowed (an
    interval for timestamps, a number for numbers); a row beyond it does not count, and neither does any before it.
    Every left row stays, once; one without a match, a key or a time gets nulls.

    Both tables are sorted together, key by key, in range partitions; the last right row is carried forward within a
    partition and from the partitions before, so a key with a third of all rows is spread over as many tasks.
    """
    keys = [f"__k{i}" for i in range(len(on))]
    names = [f"{prefix}{c}" for c in take]
    found = F.struct(F.col(times[1]).alias("at"), *(F.col(c).alias(f"t{i}") for i, c in enumerate(tie)),
                     *(F.col(c).alias(f"v{i}") for i, c in enumerate(take)))
    there = F.col(times[1]).isNotNull()
    for _, r in on:
        there = there & F.col(r).isNotNull()
    # one candidate for each key and time: ties are settled by a partial aggregate, before any order matters
    best = (right.where(there).select(*(F.col(r).alias(k) for k, (_, r) in zip(keys, on)), F.col(times[1]).alias("__at"), found.alias("__found"))
            .groupBy(*keys, "__at").agg(F.max("__found").alias("__found")))
    rows = left.select(F.struct(*(f"`{c}`" for c in left.columns)).alias("__row"),
                       *(F.col(l).alias(k) for k, (l, _) in zip(keys, on)), F.col(times[0]).alias("__at"))
    side = 0 if strict else 1
    both = rows.withColumn("__side", F.lit(side)).unionByName(
        best.withColumn("__side", F.lit(1 - side)), allowMissingColumns=True)
    placed = grouped_carry(both, ["__at", "__side"], "__found", group=keys, name="__last").where("__row is not null")
    usable = F.col("__at").isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    if within is not None:
        usable = usable & (F.col("__last.at") + within >= F.col("__at"))
    taken = [F.when(usable, F.col(f"__last.v{i}")).alias(n) for i, n in enumerate(names)]
    return placed.select(*(F.col(f"__row.`{c}`").alias(c) for c in left.columns), *taken)


def _level(length: Column) -> Column:
    """Exponent of the least power of two above ``length``: the number of its binary digits."""
    return F.length(F.bin(length)).cast("int")


def _pair_tasks(placed: DataFrame, counts: dict[int, int], keys: Sequence[str]) -> tuple[int, dict[int, int]]:
    """Tasks for an interval join (``counts``: intervals by size) and, by size, the parts of a bucket's intervals.

    Points are taken to lie evenly over their time and keys, and an interval to meet two buckets.  One task: few pairs.
    """
    distinct = F.approx_count_distinct(F.struct(*(F.col(k) for k in keys))) if keys else F.lit(1)
    n, low, high, groups = placed.agg(F.count(F.lit(1)), F.min("__at"), F.max("__at"), distinct).first()
    pairs, parts = 0.0, {}
    for size, count in counts.items():
        share = min(1.0, 2 ** size / (high - low + 1)) / max(groups, 1) if n else 0.0  # of the points, in a bucket
        pairs += n * share * 2 * count
        parts[size] = min(1 + int(n * share * 2 * count * share / PAIRS_A_TASK), MOST_PARTS)
    sparse = pairs <= PAIRS_A_ROW * (n + sum(counts.values()))
    return 1 if sparse else min(1 + int(pairs / PAIRS_A_TASK), MOST_TASKS), parts


def interval_join(points: DataFrame, intervals: DataFrame, at: str, bounds: tuple[str, str],
                  on: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Every (point, interval) pair with ``start <= at <= end`` and equal keys; the columns of both tables.

    An interval of length l goes to buckets of the least power of two above l, of which it meets two at most; a point
    goes to its bucket in each bucket size that occurs (one aggregate finds them: 64 at most, few in practice).  They
    meet by an equi-join on (keys, size, bucket), and an exact comparison decides.  So neither a long interval nor a
    long table makes a nested loop, and rows are repeated twice and as often as there are sizes.  A crowded bucket is an
    ordinary skewed join key, which AQE splits.

    Where few rows make many pairs, tasks cut by the rows' bytes would be few and uneven.  So the pairs to compare are
    estimated (from counts and the points' span, one aggregate of each table), and if they are many to a row and ask for
    more tasks than there are cores, both tables are dealt into as many.  A bucket of more pairs than a task should have
    is then dealt out too: its intervals by their hash, its points to each part.  The estimate decides on these numbers
    only, on no pair.

    ``at`` and the bounds are whole numbers, dates or timestamps (compared by microseconds).  Null keys, points and bounds
    match nothing, and neither does an interval that ends before it starts.  The tables' column names must differ.
    """
    clash = set(points.columns) & set(intervals.columns)
    if clash:
        raise ValueError(f"columns in both tables: {sorted(clash)}")
    number = lambda df, c: (F.unix_micros(F.col(c).cast("timestamp"))
                            if df.schema[c].dataType.typeName() in ("timestamp", "timestamp_ntz", "date") else F.col(c).cast("long"))
    low, high = (number(intervals, c) for c in bounds)
    spans = (intervals.withColumns({"__low": low, "__high": high}).where("__low <= __high")
             .withColumn("__size", _level(F.col("__high") - F.col("__low"))))
    counts = dict(spans.groupBy("__size").count().collect())  # exponents: 64 at most
    sizes = sorted(counts)
    bucket = lambda v, size: F.call_function("shiftright", v, size)
    first, last = bucket(F.col("__low"), F.col("__size")), bucket(F.col("__high"), F.col("__size"))
    spans = spans.withColumn("__bucket", F.explode(F.array_distinct(F.array(first, last))))
    placed = points.withColumn("__at", number(points, at)).where("__at is not null")
    width, parts = _pair_tasks(placed, counts, [p for p, _ in on])
    crowded = width > points.sparkSession.sparkContext.defaultParallelism
    dealt = [size + 64 * part for size in sizes for part in range(parts[size] if crowded else 1)]  # sizes are below 64
    if crowded:
        drawn = F.xxhash64(*(f"`{f.name}`" for f in intervals.schema if "map<" not in f.dataType.simpleString()))
        many = F.element_at(F.create_map(*(F.lit(v) for item in parts.items() for v in item)), F.col("__size"))
        spans = spans.withColumn("__size", (F.col("__size") + 64 * F.pmod(drawn, many)).cast("int"))
    each = F.explode(F.array(*(F.lit(s) for s in dealt)).cast("array<int>"))
    dots = placed.withColumn("__psize", each).withColumn("__pbucket", bucket(F.col("__at"), F.col("__psize") % 64))
    if crowded:
        width = max(width, task_count(points.sparkSession))
        dots = dots.repartition(width, "__psize", "__pbucket", *(p for p, _ in on))
        spans = spans.repartition(width, "__size", "__bucket", *(i for _, i in on))
    same = (F.col("__psize") == F.col("__size")) & (F.col("__pbucket") == F.col("__bucket"))
    for p, i in on:
        same = same & (F.col(p) == F.col(i))
    met = dots.join(spans, same).where("__low <= __at AND __at <= __high")
    return met.select(*points.columns, *intervals.columns)


def frame(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], reach: tuple[int, int],
          compute: Callable[[WindowSpec], dict[str, Column]], block: int = 65_536) -> DataFrame:
    """``df`` with window functions that look at most ``reach = (rows before, rows after)`` away.

    ``compute`` gets the window (partitioned and ordered) and returns new columns: ``lag``, ``lead``, or aggregates over
    ``rowsBetween(-a, b)`` with a and b within ``reach``.  Rows are numbered in their group by a distributed prefix count
    and cut into blocks of ``block`` rows; a block also gets copies of the neighbouring rows within reach.  A group of
    any size is thus many tasks, and at most (before + after) / block of the rows are copied.

    ``order`` should be total: rows that are equal in it take some settled order.
    """
    before, after = reach
    if not (0 <= before <= block and 0 <= after <= block):
        raise ValueError("reach must lie within a block")
    placed = grouped_prefix(df, order, group=group, index="__i")
    own = F.floor(F.col("__i") / block)
    inside = F.col("__i") % block
    # a row within reach of the next block's first row, or of the previous block's last one, is needed there too
    homes = F.array_compact(F.array(own, F.when(inside >= block - before, own + 1) if before else F.lit(None).cast("long"),
                                    F.when((inside < after) & (own > 0), own - 1) if after else F.lit(None).cast("long")))
    dealt = placed.withColumns({"__own": own, "__home": F.explode(homes)}) if before or after else placed.withColumns(
        {"__own": own, "__home": own})
    window = Window.partitionBy(*group, "__home").orderBy("__i")
    out = dealt.select("*", *(c.alias(n) for n, c in compute(window).items())).where("__home = __own")
    return out.drop("__i", "__own", "__home")
