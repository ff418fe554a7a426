"""Contiguous shards of near-equal bytes by global prefix sums.

Documents are ordered by id, equal texts next to their first; per-partition byte totals give every row its global start,
and shard borders lie at equal byte targets.  A document goes where its middle falls, so a border is off by half a
document at most.  Equal texts therefore share a shard, but for the one group at most that each border cuts.

Defined results: null text has 0 bytes (size 1), no checksum, and all null texts form one group; null ids come first;
repeated rows are rows of their own; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.common import dealt_join
from cairn.operators.prefix import durable, grouped_prefix


def byte_shards(docs: DataFrame, n_shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, start (global byte offset), shard (0..n-1), slot (gapless in the shard).

    Only (id, hash, size, checksum) is shuffled, never a text.  A hot group of equal texts is reduced to its first id
    before the shuffle, and its rows are dealt out on the way back.
    """
    rows = durable(docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("__a"), F.crc32(text_col).alias("text_crc32"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size")))
    rows = rows.withColumn("__b", F.coalesce("text_crc32", F.lit(-1))).withColumn("__any", F.col("doc_id").isNotNull())
    key = ["__a", "__b", "size"]
    first = durable(rows.groupBy(*key).agg(F.min(F.struct("__any", "doc_id")).alias("__first"), F.count(F.lit(1)).alias("__n"))
                    .where("__n > 1"))
    copies = dealt_join(rows, first, key, "__n").withColumn("__group", F.col("__a"))
    alone = (rows.join(first.select(*key), key, "left_anti")
             .withColumns({"__first": F.struct("__any", "doc_id"), "__group": F.lit(0).cast("long")}))
    narrow = ["doc_id", "size", "text_crc32", "__first", "__group"]
    laid = durable(grouped_prefix(copies.select(*narrow).unionByName(alone.select(*narrow)),
                                  ["__first", "__group", "doc_id", "text_crc32", "size"], sums={"start": "size"}, index="__row"))
    total = laid.agg(F.sum("size")).first()[0] or 1
    middle = F.col("start") + F.col("size") / 2
    shard = F.least(F.floor(middle * n_shards / F.lit(float(total))), F.lit(n_shards - 1)).cast("int")
    placed = durable(laid.withColumn("shard", shard).select("doc_id", "size", "text_crc32", "start", "shard", "__row"))
    opens = F.broadcast(placed.groupBy("shard").agg(F.min("__row").alias("__open")))  # one row per shard
    return (placed.join(opens, "shard").withColumn("slot", (F.col("__row") - F.col("__open")).cast("long"))
            .select("doc_id", "size", "text_crc32", "start", "shard", "slot"))
