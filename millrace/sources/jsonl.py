"""Reading examples, limiting and counting them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from millrace.session import cut_lineage, spread

LIMIT_POLICIES = ("strict", "clamp", "clamp_zero_all")
# Keys that part the rows in one pass, and rows of which each key is counted.
SPLITS = 63
FEW_ROWS = 100_000


def read_jsonl(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None
) -> DataFrame:
    """One JSON object per line; a line that does not parse fails the job.

    Without a schema Spark reads the files once more to infer it.
    """
    reader = spark.read.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return spread(reader.json(paths if isinstance(paths, str) else list(paths)))


def read_jsonl_quarantine(
    spark: SparkSession, paths: str | Sequence[str], schema: str, needed: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Lines as rows of ``schema``, and the lines that are none: ``(reason, line)``.

    A line is set aside if it isn't JSON of that schema, or if one of the ``needed``
    fields is null; the first such reason is given. Blank lines are no lines. Every
    other line is in one of the two tables.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).filter(F.trim("value") != "")
    parsed = F.from_json("value", f"{schema}, _damaged STRING", {"columnNameOfCorruptRecord": "_damaged"})
    rows = lines.select("value", parsed.alias("row"))
    damaged = F.col("row").isNull() | F.col("row._damaged").isNotNull()
    reasons = [F.when(F.col("row")[name].isNull(), F.lit(f"{name} is null")) for name in needed]
    reason = F.when(damaged, F.lit("not JSON of the schema")).otherwise(F.coalesce(*reasons, F.lit(None).cast("string")))
    rows = rows.withColumn("reason", reason)
    good = rows.filter(F.col("reason").isNull()).select("row.*").drop("_damaged")
    return good, rows.filter(F.col("reason").isNotNull()).select("reason", F.col("value").alias("line"))


def limit_examples(
    df: DataFrame, n: int | None, order_by: Sequence[str], policy: str = "strict"
) -> DataFrame:
    """The first ``n`` rows by ``order_by``, nulls first; ties are settled by the other columns.

    ``strict`` fails if there are fewer rows, ``clamp`` takes what is there, and
    ``clamp_zero_all`` does too but reads 0 as no limit. None is never a limit.

    Nothing is sorted or shuffled: the ``n``-th key is found by counting rows between
    sampled keys, and the result is the table with a filter on its keys, whatever
    ``n`` is. A table that is no longer than ``n`` is returned as it is.
    """
    if policy not in LIMIT_POLICIES:
        raise ValueError(f"policy must be one of {LIMIT_POLICIES}")
    if n is None or (n == 0 and policy == "clamp_zero_all"):
        return df
    if n <= 0:
        return df.limit(0)
    last, below, tied = nth_key(df.select(*order_by), n)
    if last is None:
        if policy == "strict" and below < n:
            raise ValueError(f"fewer than {n} examples")
        return df
    key, end = _row(order_by), _literal(df, order_by, last)
    if below + tied == n:
        return df.filter(key <= end)
    first, ties = df.filter(key < end), df.filter(key == end)
    others = [c for c in df.columns if c not in order_by]
    if not others:
        return first.unionByName(ties.limit(n - below))
    # Rows of equal keys go by a hash of the rest; those equal in that too are the same row again.
    order = F.xxhash64(*[F.to_json(F.struct(c)) if isinstance(df.schema[c].dataType, MapType) else F.col(c) for c in others])
    ties = ties.withColumn("_order", order)
    last, within, same = nth_key(ties.select("_order"), n - below)
    end = F.lit(last["_order"])
    kept = ties.filter(F.col("_order") < end).unionByName(ties.filter(F.col("_order") == end).limit(n - below - within))
    kept = ties.filter(F.col("_order") <= end) if below + within + same == n else kept
    return first.unionByName(kept.drop("_order"))


def nth_key(keys: DataFrame, n: int) -> tuple[Row | None, int, int]:
    """The ``n``-th smallest row, the number of rows before it, and of those equal to it.

    Without so many rows the first is None, and the second is their number; so it is
    with just as many, which leave nothing to cut.

    Every pass samples a few keys and counts the rows at and between them; partial
    counts are all that is shuffled. It goes on between the two keys around the
    ``n``-th row, until the distinct keys there are few enough to be counted each. A
    key with very many rows soon is one of the samples, and then is found as such.
    """
    columns = keys.columns
    key, before, rows, first = _row(columns), 0, keys, True
    while True:
        sample = rows.orderBy(F.rand(7)).limit(SPLITS).distinct().orderBy(*columns).collect()
        if not sample:
            return None, before, 0
        ends = F.array(*[_literal(keys, columns, row) for row in sample])
        # Even places are between the keys, odd ones at them.
        place = F.size(F.filter(ends, lambda e: e < key)) + F.size(F.filter(ends, lambda e: e <= key))
        counts = {row.place: row["count"] for row in rows.groupBy(place.alias("place")).count().collect()}
        if first and sum(counts.values()) <= n:
            return None, sum(counts.values()), 0
        first = False
        for place in sorted(counts):
            if before + counts[place] >= n:
                break
            before += counts[place]
        if place % 2:
            return sample[place // 2], before, counts[place]
        if place > 0:
            rows = rows.filter(key > _literal(keys, columns, sample[place // 2 - 1]))
        if place < 2 * len(sample):
            rows = rows.filter(key < _literal(keys, columns, sample[place // 2]))
        if counts[place] <= FEW_ROWS:
            # Few rows by now, in one window.
            upto = F.sum("count").over(Window.orderBy(*columns))
            found = rows.groupBy(*columns).count().withColumn("upto", upto).filter(F.col("upto") >= n - before).orderBy("upto").first()
            return Row(**{c: found[c] for c in columns}), before + found["upto"] - found["count"], found["count"]


def _row(columns: Sequence[str]) -> Column:
    """Columns as one value that compares like rows in an order, nulls before everything."""
    return F.struct(*[F.col(c) for c in columns])


def _literal(df: DataFrame, columns: Sequence[str], row: Row) -> Column:
    return F.struct(*[F.lit(row[c]).cast(df.schema[c].dataType).alias(c) for c in columns])


def positions(df: DataFrame, order_by: Sequence[str], name: str = "pos") -> DataFrame:
    """``df`` with every row's 0-based place in the order.

    The sort is by ranges, so no task holds more than its range; the sorted rows
    are written out first because the ranges may differ from run to run.
    """
    ordered = cut_lineage(df.orderBy(*order_by).withColumn("_id", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_part", F.shiftright("_id", 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort.
    starts = (
        ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    place = F.col("_start") + F.col("_id").bitwiseAND((1 << 33) - 1)
    return ordered.join(starts, "_part").withColumn(name, place).drop("_part", "_start", "_id")


def count_examples(df: DataFrame) -> DataFrame:
    """The number of rows, as a table of one row."""
    return df.agg(F.count(F.lit(1)).alias("examples"))
