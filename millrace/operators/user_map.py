"""A user function over batches of rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    batch_size: int = 1000,
) -> DataFrame:
    """``fn`` over batches of at most ``batch_size`` rows; only what it returns is kept."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                yield fn(frame.iloc[start : start + batch_size].reset_index(drop=True))

    return df.mapInPandas(run, schema)
