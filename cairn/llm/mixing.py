"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets: sources in code-point order (null last) get cyclic weights; a source's target stops at ``max_repeat`` times its
size and the excess goes to the others by weight.  Quotas: blocks of ``block_tokens`` words go to sources one by one by
the highest quotient ``target / (2 j - 1)``.  The method is house-monotone, so the first ``k / n_shards`` of the
blocks are an apportionment too, and the differences are the integer quotas of each shard of the mix.  Selection: the
documents of a source are laid out as a stream in a seeded order.  Each shard draws from its own strip of that stream, cut in
proportion to the quotas: whole copies as far as its quota goes, and a run of blocks that starts at a seeded one.

Defined results: null text counts 0 words and takes none; null sources form one source; repeated rows and
repeated or null ids count as rows of their own; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.llm.common import dealt_join, word_count
from cairn.operators.prefix import durable, grouped_prefix

#: A word with the white space before it.
SPACED_WORD = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
PARTS = "array<struct<shard:int,block:bigint,begin:bigint,end:bigint,full:bigint,ranges:array<struct<a:bigint,b:bigint>>>>"


def source_targets(sizes: DataFrame, *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
                   max_repeat: float = 2.0) -> DataFrame:
    """source, source_size, place (0-based), weight, target: water-filling of ``share`` x all words under the caps.

    Sources in the order of cap over weight reach their caps one after the other, so the level of the water is that
    of the first source which does not; two prefix sums over one row per source give it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    per = grouped_prefix(per.withColumn("__null", F.col("source").isNull()), ["__null", "source"], index="place")
    cyclic = F.array(*(F.lit(float(w)) for w in weights))
    per = (per.drop("__null").withColumn("weight", F.get(cyclic, (F.col("place") % len(weights)).cast("int")))
           .withColumn("cap", F.col("source_size") * float(max_repeat)).withColumn("ratio", F.col("cap") / F.col("weight")))
    per = durable(grouped_prefix(per, ["ratio", "place"], sums={"held": "cap", "lighter": "weight"}))
    total, weight = per.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(float(share) * (total or 0)) - F.col("held")) / (F.lit(weight or 1.0) - F.col("lighter"))
    open_ = per.withColumn("level", level).where(F.col("level") < F.col("ratio"))
    first = open_.agg(F.min_by("level", F.struct("ratio", "place"))).first()[0]
    target = F.col("cap") if first is None else F.least("cap", F.col("weight") * F.lit(first))
    return per.select("source", "source_size", "place", "weight", target.alias("target"))


def apportion(targets: DataFrame, houses: list[int]) -> DataFrame:
    """house, place, seats: Sainte-Laguë seats of every source for each house size (ties: the earlier place).

    The divisor bounds ``T / (n ± S / 2)`` settle all but about two seats per source; only those compete, ranked by a
    distributed prefix count.
    """
    total, sources = targets.agg(F.sum("target"), F.count(F.lit(1))).first()
    total = float(total or 0.0)
    rows = []
    for n in houses:
        if total <= 0 or n <= 0:
            rows.append((n, None, None))
        else:
            rows.append((n, total / (n - sources / 2) if n > sources / 2 else None, total / (n + sources / 2)))
    # each source row unfolds to the handful of house sizes
    bounds = F.array(*(F.struct(F.lit(n).cast("long").alias("house"), F.lit(high).cast("double").alias("high"),
                                F.lit(low).cast("double").alias("low")) for n, high, low in rows))
    seats = lambda d: F.floor(F.col("target") / d + 0.5).cast("long")
    each = durable(targets.select("place", "target", F.explode(bounds).alias("h")).select("place", "target", "h.*")
                   .withColumn("base", F.coalesce(F.greatest(seats(F.col("high")) - 1, F.lit(0)), F.lit(0)))
                   .withColumn("most", F.coalesce(seats(F.col("low")) + 1, F.lit(0))))
    sure = each.groupBy("house").agg((F.col("house") - F.sum("base")).alias("open"))  # one row per house
    asked = (each.where("most > base and target > 0")
             .select("house", "place", F.explode(F.sequence(F.col("base") + 1, F.col("most"))).alias("j"), "target")
             .withColumn("falling", -F.col("target") / (2 * F.col("j") - 1)))
    won = (grouped_prefix(asked, ["falling", "place"], group=["house"], index="rank").join(F.broadcast(sure), "house")
           .where("rank < open").groupBy("house", "place").agg(F.count(F.lit(1)).alias("won")))
    return (each.join(won, ["house", "place"], "left")
            .select("house", "place", (F.col("base") + F.coalesce("won", F.lit(0))).cast("long").alias("seats")))


def shard_quotas(targets: DataFrame, *, block_tokens: int = 32, n_shards: int = 8) -> DataFrame:
    """shard, place, blocks: integer block quotas of every source in each of the mix's equal shards."""
    total = float(targets.agg(F.sum("target")).first()[0] or 0.0)
    blocks = round(total / block_tokens)
    houses = [blocks * (k + 1) // n_shards for k in range(n_shards)]
    seats = apportion(targets, sorted(set(houses)))
    number = F.broadcast(targets.sparkSession.createDataFrame(
        [(k, houses[k]) for k in range(n_shards)], "shard int, house long"))
    upto = seats.join(number, "house")
    last = F.lag("seats", 1, 0).over(Window.partitionBy("place").orderBy("shard"))
    return upto.select("shard", "place", (F.col("seats") - last).alias("blocks"))


def strips_of(targets: DataFrame, quotas: DataFrame, *, block_tokens: int, max_repeat: float, seed: int) -> DataFrame:
    """place, quota, strips: for each shard of the mix the part of a source's stream that it draws from, in words.

    A source's stream is cut into strips in proportion to its quotas.  Of its strip [``begin``, ``end``) a shard takes
    ``full`` whole copies, and ``rest`` words more: the blocks from a seeded one on, around the strip's end if need be,
    which are the ranges [``a0``, ``a1``) and [``b0``, ``b1``).
    """
    at = Window.partitionBy("place").orderBy("shard")  # n_shards rows
    q = quotas.withColumns({"upto": F.sum("blocks").over(at.rowsBetween(Window.unboundedPreceding, 0)),
                            "quota": F.sum("blocks").over(Window.partitionBy("place"))}).where("quota > 0")
    q = q.join(targets.select("place", "source", "source_size"), "place")
    edge = lambda c: F.expr(f"cast(cast(source_size as decimal(19,0)) * ({c}) div quota as long)")
    q = q.withColumns({"begin": edge("upto - blocks"), "end": edge("upto")}).withColumn("size", F.col("end") - F.col("begin"))
    q = q.withColumn("words", F.least(F.col("blocks") * block_tokens, (F.col("size") * F.lit(float(max_repeat))).cast("long")))
    name = F.concat_ws(":", F.lit(seed), F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source")), "shard")
    draw = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long")
    q = q.where("size > 0").withColumns({"full": F.expr("words div size"), "rest": F.expr("words % size"),
                                         "a0": draw % F.ceil(F.col("size") / block_tokens) * block_tokens})
    a1 = F.least(F.col("size"), F.col("a0") + F.col("rest"))
    strip = F.struct("shard", "begin", "end", "full", (F.col("begin") + F.col("a0")).alias("a0"), (F.col("begin") + a1).alias("a1"),
                     F.col("begin").alias("b0"), (F.col("begin") + F.greatest(F.lit(0), F.col("a0") + F.col("rest") - F.col("size"))).alias("b1"))
    return q.groupBy("place").agg(F.first("quota").alias("quota"), F.array_sort(F.collect_list(strip)).alias("strips"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, max_repeat: float = 2.0, block_tokens: int = 32,
        n_shards: int = 8, seed: int = 1) -> DataFrame:
    """One row per document: id, source, key (hash of the row), size, source_size, target, quota (blocks), taken, parts.

    ``parts`` has a struct for each shard that draws from the document: shard, block (the first one, counted in the
    source's stream), begin and end (the document's words in the shard's strip), full (whole copies of them) and ranges
    (the words of one copy more).  A source of a third of all rows is summed before the shuffle, and its seeded stream
    is a distributed prefix sum; its one row of strips reaches its documents without a shuffle of them.
    """
    sizes = durable(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.xxhash64(*docs.columns).alias("key"), F.xxhash64(text_col).alias("__text"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string"))).alias("__draw")))
    targets = durable(source_targets(sizes, weights=weights, share=share, max_repeat=max_repeat))
    quotas = durable(shard_quotas(targets, block_tokens=block_tokens, n_shards=n_shards))
    strips = strips_of(targets, quotas, block_tokens=block_tokens, max_repeat=max_repeat, seed=seed)
    name = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), "source"))
    rows = sizes.groupBy(name.alias("__s")).agg(F.count(F.lit(1)).alias("__n"))
    plan = durable(targets.select("source", "place", "source_size", "target").withColumn("__s", name).drop("source")
                   .join(strips, "place", "left").join(rows, "__s").drop("place"))
    laid = durable(grouped_prefix(sizes.withColumn("__s", name), ["__draw", "doc_id", "size", "__text", "key"], group=["source"],
                                  sums={"start": "size"}).drop("__draw", "__text"))
    joined = dealt_join(laid, plan, ["__s"], "__n")
    word = lambda x: F.greatest(F.lit(0), F.least(x - F.col("start"), F.col("size"))).cast("long")
    own = F.filter("strips", lambda s: (s["begin"] < F.col("start") + F.col("size")) & (s["end"] > F.col("start")))
    cut = F.transform(own, lambda s: F.struct(
        s["shard"].alias("shard"), F.floor(F.greatest(s["begin"], F.col("start")) / block_tokens).cast("long").alias("block"),
        word(s["begin"]).alias("begin"), word(s["end"]).alias("end"), s["full"].alias("full"),
        F.filter(F.array(F.struct(word(s["b0"]).alias("a"), word(s["b1"]).alias("b")),
                         F.struct(word(s["a0"]).alias("a"), word(s["a1"]).alias("b"))), lambda r: r["a"] < r["b"]).alias("ranges")))
    none = F.slice(cut, 1, 0)
    joined = joined.withColumn("parts", F.coalesce(F.when(F.col("size") > 0, cut), none, F.array().cast(PARTS)))
    zero = F.lit(0).cast("long")
    taken = F.aggregate("parts", zero, lambda n, p: n + p["full"] * (p["end"] - p["begin"]) + F.aggregate(
        p["ranges"], zero, lambda m, r: m + r["b"] - r["a"]))
    return joined.select("doc_id", "source", "key", "size", "source_size", "target",
                         F.coalesce("quota", zero).alias("quota"), taken.alias("taken"), "parts")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as shards take words of it, cut only where a strip or a run of blocks ends.

    Copy c holds a document's words from the strips that are taken c times or more whole, and copy ``full`` + 1 those of
    the runs.  Returns the columns of ``docs`` (doc_id, text, lang, source, n_chars); ``n_chars`` follows the text.
    Documents without words hold nothing to weigh and stay once; rows equal in every column are interchangeable.
    """
    plan = mix(docs, **options).select(F.col("doc_id").alias("__id"), F.col("key").alias("__k"), "size", "parts")
    whole = docs.withColumn("__key", F.xxhash64(*docs.columns)).dropDuplicates(["doc_id", "__key"])
    both = whole.join(plan, (F.col("__key") == F.col("__k")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    times = F.array_max(F.transform("parts", lambda p: p["full"] + (F.size(p["ranges"]) > 0).cast("long")))
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.coalesce(times, F.lit(0)))
    copies = (both.withColumn("__times", times).where("__times > 0")
              .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times").cast("long")))))
    here = F.flatten(F.transform("parts", lambda p: F.when(
        p["full"] >= F.col("__copy"), F.array(F.struct(p["begin"].alias("a"), p["end"].alias("b"))))
        .when(p["full"] + 1 == F.col("__copy"), p["ranges"]).otherwise(F.slice(p["ranges"], 1, 0))))
    held = F.aggregate("__ranges", F.lit(0).cast("long"), lambda n, r: n + r["b"] - r["a"])
    words = F.regexp_extract_all("text", F.lit(SPACED_WORD), F.lit(0))
    cut = F.array_join(F.flatten(F.transform("__ranges", lambda r: F.slice(
        F.col("__words"), (r["a"] + 1).cast("int"), (r["b"] - r["a"]).cast("int")))), "")
    copies = copies.withColumn("__ranges", here).withColumn("__held", held)
    copies = copies.withColumn("__words", F.when(F.col("__held") < F.col("size"), words))
    text = F.when(F.col("__held") < F.col("size"), cut).otherwise(F.col("text"))
    return (copies.withColumn("text", text).withColumn("n_chars", F.char_length("text").cast("long"))
            .select(*docs.columns))
