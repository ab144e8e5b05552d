"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from millrace.session import checkpoint_dir

#: Words a task remembers before it starts anew.
REMEMBERED = 400_000
#: Bytes of text a task looks at together.
SLICE_BYTES = 2_000_000


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, **options: object) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, read again.

    The plan ends there, and a lost executor loses none of it. ``options`` are the
    writer's.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "llm")
    df.write.options(**options).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; a null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch with about SLICE_BYTES of text each, and their texts, which are made part by part."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        own = batch.slice(start, end - start)
        yield own, texts_of(own.column(column))


class Numbering(dict):
    """Gives every new key the next number."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number

    def numbers(self, keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
