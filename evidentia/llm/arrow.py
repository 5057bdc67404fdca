"""Arrow batches in and out of Python stages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.plans.ship import ship

#: Rows of a batch handed to Python. Texts differ in length a thousandfold, so few rows bound the bytes.
BATCH_ROWS = 512

#: A batch is worked on in slices of at most this many bytes of text, or of one text.
SLICE_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Sets the session's Arrow batches to BATCH_ROWS rows and sends the package to the workers."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table; inputs may lie in a store that only Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch by SLICE_BYTES and BATCH_ROWS."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        stop = min(stop, start + BATCH_ROWS)
        yield batch.slice(start, stop - start)
        start = stop


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: str, column: str = "text") -> DataFrame:
    """work on each slice of df's rows; it returns columns by name, in the order of schema."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column):
                out = work(part)
                yield out if isinstance(out, pa.RecordBatch) else pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(run, schema)


def remainder(key: str, n: int):
    """crc32 of the key as text, mod n."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def strings(values: list) -> pa.Array:
    return pa.array(values, type=pa.string())
