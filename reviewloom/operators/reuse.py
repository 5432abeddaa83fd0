"""One evaluation for several uses."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df``, kept by the executors for as long as the block runs, and released at its end, also after a failure.

    For frames that are dear to compute and have several sinks, such as reviews scored by a model. The first sink fills the store, partition by
    partition, without a job of its own. What a lost executor held is computed again. A frame that was kept
    already stays so.
    """
    kept_before = df.storageLevel.useMemory or df.storageLevel.useDisk
    kept = df if kept_before else df.persist(level)
    try:
        yield kept
    finally:
        if not kept_before:
            kept.unpersist(blocking=True)
