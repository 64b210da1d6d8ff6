"""Written intermediate tables and bounded Arrow slices, shared by the operators here."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tickloom.session import work_folder

SLICE_BYTES = 2 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: this cuts the lineage.

    Later jobs read files, so nothing is computed twice and a lost executor costs only its own
    tasks.
    """
    path = work_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice hold ``limit`` bytes, or one text that is longer.

    What earlier tasks of a reused worker have left in its allocators is given back first.
    """
    release_memory()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        before = np.cumsum(size, dtype=np.int64) - size
        cuts = np.flatnonzero(np.diff(before // limit)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(start, end - start)


def release_memory() -> None:
    """Give freed memory that the allocators keep back to the system, where they know how."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a slice; null counts as empty."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def mixed(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit integers."""
    x = values.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(values: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1] that depend on ``values`` and ``salt`` alone."""
    return ((mixed(values, salt) >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
