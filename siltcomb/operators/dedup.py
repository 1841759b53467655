"""Exact duplicates over all months."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltcomb.functions.entries import canonical_hash


def drop_duplicates(df: DataFrame, raw: str = "raw", exact: bool = False, order: list[str] | None = None) -> DataFrame:
    """One entry of each set that agrees in all of its JSON object; with ``order``, the first by those columns."""
    hashed = df.withColumn("__h", canonical_hash(F.col(raw), exact))
    if not order:
        return hashed.dropDuplicates(["__h"]).drop("__h")
    # the limit on groups is applied before the shuffle as well
    first = F.row_number().over(Window.partitionBy("__h").orderBy(*order))
    return hashed.withColumn("__n", first).where("__n = 1").drop("__n", "__h")


def first_of(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """The row of least ``order`` among those that agree in ``columns``."""
    rest = [c for c in df.columns if c not in columns]
    least = F.min_by(F.struct(*rest), F.col(order)).alias("__x")
    return df.groupBy(*columns).agg(least).select(*columns, *[F.col(f"__x.{c}").alias(c) for c in rest])
