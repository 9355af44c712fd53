"""Small helpers for frames: column names that cannot clash, batches, kept results."""

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.queries.inputs import scratch_dir


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``frame`` is called so."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


class Scratch:
    """A folder of the run under ``spark.checkpoint.dir``, for results that cut the lineage.

    Kept tables are plain Parquet in a folder that all executors share, so the loss of an
    executor costs the work of one job at most.
    """

    def __init__(self, spark):
        self.spark, self.folder = spark, scratch_dir(spark)

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        frame.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Free the space of a table that no result reads any more."""
        empty = self.spark.createDataFrame([], "nothing int")
        empty.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{name}")


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, over all its tasks."""
    name = "_sluiceway_llm_worker_cache"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def text_groups(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """Slices of ``texts`` of about ``max_bytes`` (one long text may be more), with their start.

    Slices hold whole texts; NULL becomes the empty text.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, texts[start:stop]
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a slice from :func:`text_groups`, and where each text begins."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def map_columns(
    frame: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply a function of Arrow batches to a frame."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return frame.mapInArrow(over, schema)
