"""Replaying files as a stream and keeping running grouped totals.

The reference emulates a stream by reading a folder of CSV files one file
per trigger, keeps a running ``sum``/``count`` per key in complete mode in
an in-memory table, sleeps five seconds and queries the table.  Here:

* the source is a typed, headered file stream (``replay_files``);
* the aggregate keeps ``total``, ``count`` (all rows) and ``count_values``
  (rows with a value), so both the reference's ``sum/count(*)`` mean and
  the null-skipping mean are available (``running_totals``);
* the run is bounded: ``trigger(availableNow=True)`` processes every file
  present at start, one file per micro-batch, and stops — no sleep, no
  race (``run_to_end``);
* the durable sink writes below the shared checkpoint folder through
  ``foreachBatch``: in complete mode each batch writes the whole result to a
  folder of its own and :func:`read_complete` reads the newest; in update mode each batch appends only the changed keys tagged
  with the batch id, and :func:`read_latest` keeps the newest row per key.
  The memory sink of the reference is offered for small, interactive use.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cairn.functions.numeric import mean_from_totals
from cairn.session import remove_path, scratch_path

#: Whole results that a complete-mode table sink keeps.
KEPT_BATCHES = 3


def replay_files(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1,
                 header: bool = True, fmt: str = "csv") -> DataFrame:
    """Streaming DataFrame over the files in ``path``, ``files_per_trigger`` per micro-batch.

    Files are taken oldest first (modification time).  The schema is
    declared — a streaming file source cannot infer one — and typed, so
    numeric columns are parsed at the source; with ``header=True`` header
    lines are skipped instead of becoming data rows.  Partition folders
    (``key=value``) are read back as columns when ``schema`` names them.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "csv":
        return reader.option("header", header).csv(path)
    return reader.format(fmt).load(path)


def running_totals(stream: DataFrame, keys: Sequence[str], value: str, sort_desc: str | None = None) -> DataFrame:
    """Running ``total``, ``count`` (rows) and ``count_values`` (non-null values) per key.

    ``sort_desc`` (e.g. ``"count"``) orders the result descending by that
    column; Spark accepts a sorted streaming aggregate only in complete
    output mode, where every trigger re-emits the whole (small) result.
    """
    totals = stream.groupBy(*keys).agg(
        F.sum(F.col(value)).alias("total"),
        F.count(F.lit(1)).alias("count"),
        F.count(F.col(value)).alias("count_values"),
    )
    return totals.orderBy(F.desc(sort_desc)) if sort_desc else totals


def run_to_end(stream_df: DataFrame, name: str, mode: str = "complete", sink: str = "table",
               path: str | None = None, checkpoint: str | None = None, timeout: float | None = None,
               state_partitions: int | None = None) -> StreamingQuery:
    """Run a streaming query over everything available now, then stop.

    ``sink="table"`` writes Parquet at ``path`` through ``foreachBatch``;
    ``"memory"`` keeps the result in the driver as table ``name``.  The
    checkpoint goes below the shared checkpoint directory unless given.
    Raises if the query fails; there is no time limit unless ``timeout`` (seconds) is given.

    In complete mode every batch writes its result to a folder of its own,
    ``batch_id=<n>``, and :func:`read_complete` reads the newest: a reader
    never finds the table missing or half written.  The newest
    ``KEPT_BATCHES`` folders stay, for readers that began before a batch.

    ``state_partitions`` sets the number of state-store partitions of the
    query (fixed in its checkpoint at first start).  Every micro-batch
    commits every state partition, so it should follow the number of
    grouping keys, not the input volume: map-side partial aggregation
    already reduces each batch to one row per key and input task.
    """
    spark = stream_df.sparkSession
    checkpoint = checkpoint or scratch_path(spark, f"stream-checkpoint-{name}")
    writer = (stream_df.writeStream.outputMode(mode).trigger(availableNow=True)
              .option("checkpointLocation", checkpoint).queryName(name))
    if sink == "memory":
        writer = writer.format("memory")
    elif sink == "table":
        if path is None:
            raise ValueError("sink='table' needs a path")
        target = path

        if mode == "complete":
            def write_batch(batch: DataFrame, epoch_id: int) -> None:
                batch.write.mode("overwrite").parquet(f"{target}/batch_id={epoch_id}")
                remove_path(spark, f"{target}/batch_id={epoch_id - KEPT_BATCHES}")
        else:
            def write_batch(batch: DataFrame, epoch_id: int) -> None:
                batch.withColumn("_batch", F.lit(epoch_id).cast("bigint")).write.mode("append").parquet(target)

        writer = writer.foreachBatch(write_batch)
    else:
        raise ValueError(f"unknown sink {sink!r}")
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        # the query copies the session's settings as it starts; restored as soon as it has
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        query = writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    finished = query.awaitTermination(timeout) if timeout is not None else query.awaitTermination() or True
    if query.exception() is not None:
        raise RuntimeError(f"streaming query {name} failed: {query.exception()}")
    if not finished:
        query.stop()
        raise TimeoutError(f"streaming query {name} did not finish within {timeout}s")
    return query


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The result of the newest batch of a complete-mode table sink."""
    table = spark.read.parquet(path)
    newest = table.agg(F.max("batch_id")).scalar()
    return table.where(F.col("batch_id") == newest).drop("batch_id")


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Final state of an update-mode table sink: the newest row per key.

    ``max_by`` over the batch id is an ordinary aggregate with partial
    aggregation, so a key updated in every batch is not gathered in one
    task.
    """
    table = spark.read.parquet(path)
    values = [c for c in table.columns if c not in keys and c != "_batch"]
    latest = table.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("_batch")).alias("_row"))
    return latest.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values])


def mean_from_running(totals: DataFrame, keys: Sequence[str], scale: int = 2) -> DataFrame:
    """``keys, count, total, avg_value`` where ``avg_value = total / count`` (rounded).

    Uses ``count`` of all rows, like the reference's ``sum/count(*)``; use
    ``count_values`` instead for the mean over present values only.
    """
    return totals.select(*keys, "count", "count_values", F.col("total"),
                         mean_from_totals("total", "count", scale).alias("avg_value"),
                         mean_from_totals("total", "count_values", scale).alias("avg_present"))
