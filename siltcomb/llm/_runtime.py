"""What the operators share: worker import paths, shared storage, table hygiene."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltcomb.functions.workers import importable
from siltcomb.sources import store


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package even when only the driver's sys.path holds it."""
    importable(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the setting is absent and Spark runs on this machine alone (tests, a laptop) is a folder of our own made and set.
    """
    where = store.shared_dir(spark)
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(where)
    return where


def persisted(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/siltcomb-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrowed(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` reduced to the named columns, renamed; other columns (and their names) never matter."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def give_back() -> None:
    """Returns to the system what Arrow and malloc hold for later; workers stay after their tasks, beside those of the next stage."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError, TypeError):  # a libc without it
        ctypes.CDLL(None).malloc_trim(0)


def chunks_of(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` of about ``limit`` characters each, so that working memory is bounded."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
