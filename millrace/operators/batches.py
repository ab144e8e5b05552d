"""Epoch order, batches and the run plan that follows from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.sequences import attention_mask, pad

# Leading hex digits of the shuffle hash that name a bucket.
BUCKET_DIGITS = 4


def shuffle_hash(seed: int, *parts: Column) -> Column:
    """The md5 that rows are shuffled by."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]).cast("binary"))


def epoch_order(df: DataFrame, key: str, epochs: int, seed: int) -> DataFrame:
    """``(epoch, key, pos)``: a seeded order of the unique keys for every epoch.

    Hashes are even over their leading digits, so each bucket of them is ranked on
    its own and shifted by the number of rows in the buckets before it. The largest
    group in any window is one bucket.
    """
    if epochs < 1:
        raise ValueError("epochs must be at least 1")
    rows = df.select(
        F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"), F.col(key).alias("key")
    ).withColumn("_hash", shuffle_hash(seed, F.col("epoch"), F.col("key")))
    rows = rows.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    before = Window.partitionBy("epoch").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy("epoch", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select("epoch", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy("epoch", "_bucket").orderBy("_hash", "key")
    return (
        rows.withColumn("_place", F.row_number().over(within) - 1)
        .join(starts, ["epoch", "_bucket"])
        .select("epoch", "key", (F.col("_start") + F.col("_place")).alias("pos"))
    )


def assign_batches(ordered: DataFrame, batch: int, accum: int = 1, world: int = 1) -> DataFrame:
    """``(epoch, key, pos, rank, micro, step)`` for every row.

    Batches of ``batch`` rows go round the ``world`` ranks; one batch on every rank
    is a micro-batch and ``accum`` of those make a step. The last batch may be short.
    """
    return ordered.select(
        "epoch", "key", "pos",
        F.expr(f"cast(pos div {batch} % {world} as int)").alias("rank"),
        F.expr(f"pos div {batch * world}").alias("micro"),
        F.expr(f"pos div {batch * world * accum}").alias("step"),
    )


def planned_run(rows: DataFrame, epochs: int, batch: int, accum: int = 1, world: int = 1) -> DataFrame:
    """The plan of :func:`run_plan` from the number of rows alone, without laying them out."""
    spark, n_rows = rows.sparkSession, rows.count()
    if not n_rows:
        return run_plan(spark.createDataFrame([], "epoch INT, micro BIGINT, step BIGINT"))
    micro = -(-n_rows // (batch * world))
    steps = -(-n_rows // (batch * world * accum))
    return spark.range(epochs).select(
        F.col("id").cast("int").alias("epoch"), F.lit(n_rows).cast("long").alias("n_rows"),
        F.lit(micro).cast("long").alias("micro_batches"), F.lit(steps).cast("long").alias("steps"),
        (F.col("id") * steps + 1).alias("first_step"), ((F.col("id") + 1) * steps).alias("last_step"),
    )


def run_plan(assigned: DataFrame) -> DataFrame:
    """Rows, micro-batches and steps of every epoch, and the steps it ends before and after."""
    epochs = assigned.groupBy("epoch").agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.max("micro") + 1).alias("micro_batches"),
        (F.max("step") + 1).alias("steps"),
    )
    # One row per epoch.
    so_far = F.sum("steps").over(Window.orderBy("epoch"))
    return epochs.select(
        "epoch", "n_rows", "micro_batches", "steps",
        (so_far - F.col("steps") + 1).alias("first_step"), so_far.alias("last_step"),
    )


def run_points(plan: DataFrame, logging_steps: int, save_steps: int | None = None) -> DataFrame:
    """``(kind, step)`` at which to log and to save; without ``save_steps``, save after every epoch."""

    def every(kind: str, n: int) -> DataFrame:
        total = plan.agg(F.max("last_step")).first()[0] or 0
        points = plan.sparkSession.range(1, total // n + 1)
        return points.select(F.lit(kind).alias("kind"), (F.col("id") * n).alias("step"))

    saves = (
        plan.select(F.lit("save").alias("kind"), F.col("last_step").alias("step"))
        if save_steps is None
        else every("save", save_steps)
    )
    return every("log", logging_steps).union(saves)


def pad_to_batch_max(df: DataFrame, batch_cols: Sequence[str], ids: str, pad_id: int) -> DataFrame:
    """``df`` with every list padded to the longest of its batch, and its mask."""
    return pad_lists_to_batch_max(df, batch_cols, {ids: pad_id}, {ids: "attention_mask"})


def pad_lists_to_batch_max(
    df: DataFrame, batch_cols: Sequence[str], fills: Mapping[str, int], masks: Mapping[str, str]
) -> DataFrame:
    """Pad the lists named in ``fills`` with its values, each to its own longest of the batch.

    ``masks`` names the mask column of a list. The rows of a batch meet in one window,
    so the table is read and shuffled once; the batch size bounds the window.
    """
    batch = Window.partitionBy(*batch_cols)
    padded = df.select("*", *[F.max(F.size(c)).over(batch).alias(f"_longest_{c}") for c in fills])
    for ids, mask in masks.items():
        padded = padded.withColumn(mask, attention_mask(F.col(ids), F.col(f"_longest_{ids}")))
    for ids, value in fills.items():
        padded = padded.withColumn(ids, pad(F.col(ids), F.col(f"_longest_{ids}"), value))
    return padded.drop(*[f"_longest_{c}" for c in fills])


def write_ranks(batched: DataFrame, path: str) -> None:
    """Write rows with ``epoch, step, micro, pos, rank`` so that a rank reads its own alone.

    Every rank has a folder. A task has a range of steps and writes one file a rank,
    its rows in order; names of files rise with their steps.
    """
    dealt = batched.repartitionByRange("epoch", "step").sortWithinPartitions("rank", "epoch", "pos")
    dealt.write.mode("overwrite").partitionBy("rank").parquet(path)


def read_rank(spark: SparkSession, path: str, rank: int) -> DataFrame:
    """The rows of a rank; files of other ranks are not opened."""
    return spark.read.parquet(path).filter(F.col("rank") == rank)
