"""Stage outputs that are reused only when they are complete."""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Sequence
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import cut_lineage

# Spark cuts rows before a ranked window up to this many of a group, by its default settings.
MAX_GROUP_LIMIT = 1_000
VERSIONS, VERSIONS_SCHEMA = "versions", "at BIGINT, folder STRING, fields STRING, n_rows BIGINT, version STRING"
# Spark's conditions of files that are not there or not whole.
_LACKING = ("PATH_NOT_FOUND", "FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA")
_DAMAGED = re.compile("is not a Parquet file|FileNotFoundException|Could not read footer|ChecksumException|EOFException|BlockMissingException")
MANIFEST_SCHEMA = "state STRING, fields STRING, n_rows BIGINT, version STRING"


def materialize_stage(df: DataFrame, path: str, version: str) -> DataFrame:
    """``df`` written below ``path`` and read back, or the rows of an earlier run.

    The manifest says ``building`` before the first row is written and ``complete``
    after the last, so an interrupted write is found and written again. Rows are
    reused only if state, schema, ``version`` and the number of rows all agree.
    ``version`` has to change with the input and the code. A part that can't be read
    is counted as missing.
    """
    spark = df.sparkSession
    fields = df.schema.simpleString()
    data = f"{path}/data"
    if not is_complete(spark, path, fields, version):
        _write_manifest(spark, path, ("building", fields, None, version))
        written = Observation()
        df.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(data)
        _write_manifest(spark, path, ("complete", fields, written.get["n"], version))
    return spark.read.schema(df.schema).parquet(data)


def is_complete(spark: SparkSession, path: str, fields: str, version: str) -> bool:
    """Whether ``path`` holds a finished stage of this schema and version."""
    try:
        manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{path}/manifest").collect()
        if len(manifest) != 1 or manifest[0].state != "complete":
            return False
        if (manifest[0].fields, manifest[0].version) != (fields, version):
            return False
        return spark.read.parquet(f"{path}/data").count() == manifest[0].n_rows
    except (PySparkException, Py4JJavaError) as error:
        if not _lacks_files(error):
            raise
        # The stage is written again.
        return False


def _lacks_files(error: Exception) -> bool:
    """Whether files are missing or damaged; any other failure of a store may pass."""
    if isinstance(error, PySparkException) and (error.getCondition() or "").split(".")[0] in _LACKING:
        return True
    return any(f"[{condition}" in str(error) for condition in _LACKING) or _DAMAGED.search(str(error)) is not None


def input_version(*sources: DataFrame, code: str = "") -> str:
    """A text that changes with the files that tables were read from, and with ``code``.

    ``sources`` are tables as read. A file counts with its path, size and time of change,
    once it has a row; the hashes of all files are summed, so their order is no matter.
    """
    parts = [code]
    for source in sources:
        files = source.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        found = files.agg(F.count("*"), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()
        parts += [str(found[0]), str(found[1] or 0), source.schema.simpleString()]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def materialize_version(df: DataFrame, path: str, version: str) -> DataFrame:
    """``df`` as a version of the stage below ``path``, or the rows that it had before.

    Each version is written to a folder of its own, and a line of the log names it when
    all of it is there. Until then, and if the write fails, the stage is what it was. A
    version whose files are missing or damaged is written again.
    """
    spark, fields = df.sparkSession, df.schema.simpleString()
    for entry in _versions(spark, path):
        if (entry.fields, entry.version) == (fields, version) and _has_rows(spark, entry):
            return spark.read.schema(df.schema).parquet(entry.folder)
    folder, written = f"{path}/{uuid4().hex}", Observation()
    df.observe(written, F.count(F.lit(1)).alias("n")).write.parquet(folder)
    line = (time.time_ns(), folder, fields, written.get["n"], version)
    spark.createDataFrame([line], VERSIONS_SCHEMA).coalesce(1).write.mode("append").json(f"{path}/{VERSIONS}")
    return spark.read.schema(df.schema).parquet(folder)


def latest_version(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest version below ``path`` that is whole."""
    for entry in _versions(spark, path):
        if _has_rows(spark, entry):
            return spark.read.schema(_schema_of(spark, entry.fields)).parquet(entry.folder)
    raise ValueError(f"no version of a stage in {path}")


def _schema_of(spark: SparkSession, fields: str) -> StructType:
    return spark.createDataFrame([], fields.removeprefix("struct<").removesuffix(">")).schema


def _versions(spark: SparkSession, path: str) -> list:
    """The lines of the log, newest first; there is one for every version."""
    try:
        return spark.read.schema(VERSIONS_SCHEMA).json(f"{path}/{VERSIONS}").orderBy(F.desc("at")).collect()
    except (PySparkException, Py4JJavaError) as error:
        if not _lacks_files(error):
            raise
        return []


def _has_rows(spark: SparkSession, entry) -> bool:
    try:
        return spark.read.parquet(entry.folder).count() == entry.n_rows
    except (PySparkException, Py4JJavaError) as error:
        if not _lacks_files(error):
            raise
        return False


def keep_latest(
    runs: DataFrame, n: int = 3, partition_by: Sequence[str] = ("run",), order_by: Sequence[str] = ("step",)
) -> DataFrame:
    """The newest ``n`` rows of every run; ``order_by`` has to tell the rows of a run apart.

    Up to ``MAX_GROUP_LIMIT`` Spark keeps at most ``n`` rows per run and task before the
    shuffle, so a run with very many rows sends few. Beyond it rows are sorted by
    ranges of run and order, and each counts the rows before it: a long run is spread
    over as many tasks as it fills.
    """
    if n > MAX_GROUP_LIMIT:
        return _newest_by_ranges(runs, n, partition_by, order_by)
    newest = Window.partitionBy(*partition_by).orderBy(*[F.desc(c) for c in order_by])
    return runs.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= n).drop("_place")


def _newest_by_ranges(runs: DataFrame, n: int, partition_by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    keys = [*[F.col(c) for c in partition_by], *[F.desc(c) for c in order_by]]
    ordered = runs.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Written, as a second sort may draw other ranges.
    ordered = cut_lineage(ordered.withColumn("_id", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_id", 33))
    shares = ordered.groupBy(*partition_by, "_part").agg(F.count("*").alias("_rows"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy(*partition_by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).filter(F.col("_before") < n)
    shares = shares.select(*[F.col(c).alias(f"_of_{c}") for c in (*partition_by, "_part")], (F.col("_before") - F.col("_first")).alias("_shift"))
    condition = F.lit(True)
    for c in (*partition_by, "_part"):
        condition = condition & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return ordered.join(shares, condition).filter(F.col("_id") + F.col("_shift") < n).select(*runs.columns)


def _write_manifest(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
