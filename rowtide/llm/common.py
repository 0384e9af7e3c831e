"""What the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.session import defaults, scratch

# Shuffled files of a query go when it ends, and not when the driver happens to collect its garbage.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stored(df: DataFrame, purpose: str, compression: str = "snappy", free: bool = False) -> DataFrame:
    """The rows, written to the folder that all executors share and read again.

    This cuts the lineage: what is read afterwards does not depend on an executor that may be
    lost, and is not computed again. With ``free``, what was shuffled for it goes at once.
    """
    spark = df.sparkSession
    path = scratch(spark, purpose)
    with defaults(spark, FREED if free else {}):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def remainder(ident: Column, divisor: int) -> Column:
    """CRC-32 of an id as text, modulo a divisor; null for a null id."""
    return F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(divisor)).cast("int")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(array: pa.Array) -> list[bytes]:
    """The values of a binary column, null as empty."""
    return [value or b"" for value in array.to_pylist()]


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in one array, and where each row starts; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"")
    if not pa.types.is_large_binary(array.type):
        array = array.cast(pa.large_binary())
    starts = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[starts[0] : starts[-1]], starts - starts[0]


def pieces(starts: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer row stands alone."""
    ranges, first = [], 0
    while first < len(starts) - 1:
        last = int(np.searchsorted(starts, starts[first] + limit, side="right")) - 1
        last = max(last, first + 1)
        ranges.append((first, last))
        first = last
    return ranges
