"""Proportional and fixed-size samples.

The documented samples are functions of the rows: the same rows give the same sample however they are
partitioned. The compat ones repeat a sequential scan with Python's generator from the counts alone.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltcomb.sources.store import stored

SEED = 42
#: Bytes of a sample's bitmap in one row.
SLICE = 1 << 16


def sample_size(share: float, count: int) -> int:
    """Rows in a sample; halves go to the even number."""
    return round(share * count)


def order_key(columns: list[Column], seed: int) -> Column:
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in columns], F.lit(str(seed))))


def fixed_size(df: DataFrame, n: int, keys: list[str], seed: int = SEED) -> DataFrame:
    """``n`` rows, each set of n as likely as any other: those of least hash."""
    return df.withColumn("__k", order_key([F.col(k) for k in keys], seed)).orderBy("__k", *keys).limit(n).drop("__k")


def proportional(df: DataFrame, share: float, keys: list[str], by: list[str], seed: int = SEED) -> DataFrame:
    """Exactly ``round(share * rows)`` rows of each group.

    Groups are cut into 4096 ranges of the hash and counted by range; only where a group's quota ends within
    a range must rows be ranked, so no task sees a whole group.
    """
    k = order_key([F.col(c) for c in keys], seed)
    t = df.withColumn("__k", k).withColumn("__b", F.substring("__k", 1, 3))
    per = t.groupBy(*by, "__b").agg(F.count("*").alias("__n"))
    w = Window.partitionBy(*by)
    quota = F.bround(F.sum("__n").over(w) * F.lit(share))
    before = F.sum("__n").over(w.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    per = per.withColumn("__take", F.least(F.col("__n"), quota - F.coalesce(before, F.lit(0)))).where("__take > 0")
    names = [f"__g{i}" for i in range(len(by))]
    per = per.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=True)], F.col("__b").alias("__r"), "__take")
    on = t["__b"] == per["__r"]
    for c, n in zip(by, names, strict=True):
        on &= t[c].eqNullSafe(per[n])
    rank = F.row_number().over(Window.partitionBy(*by, "__b").orderBy("__k", *keys))
    return t.join(per, on).withColumn("__i", rank).where(F.col("__i") <= F.col("__take")).select(df.columns)


def bernoulli(df: DataFrame, share: float, keys: list[str], seed: int = SEED) -> DataFrame:
    """Each row with the given probability, without a shuffle."""
    if share >= 1:
        return df
    head = F.substring(order_key([F.col(k) for k in keys], seed), 1, 8)
    return df.where(head < f"{int(share * 2**32):08x}")


def scan_points(share: float, counts: list[tuple[str, int]], seed: int = SEED) -> dict[str, list[int]]:
    """Compat: the line numbers that a sequential scan samples from each month; the last of a month is lost."""
    rng = random.Random(seed)
    return {month: _points(rng, share, month, count) for month, count in counts}


def _points(rng: random.Random, share: float, month: str, count: int) -> list[int]:
    k = sample_size(share, count)
    if not k:
        raise IndexError(f"no sample points in {month}")
    return sorted(rng.sample(range(count), k))[:-1]


def at_points(df: DataFrame, share: float, counts: list[tuple[str, int]], seed: int = SEED) -> DataFrame:
    """Rows of ``df`` (file_name, line_idx) whose index is a point of :func:`scan_points`.

    One generator runs through the months, so the points are drawn on the driver; a month's points go out as one bitmap
    of a bit for each line (33 MB for the largest month of the corpus), and rows are looked up there.
    """
    spark = df.sparkSession
    rng, maps = random.Random(seed), []
    for month, count in counts:
        points = _points(rng, share, month, count)
        bits = bytearray(count // 8 + 1)
        for i in points:
            bits[i >> 3] |= 1 << (i & 7)
        # in slices, so that no row of the small table is large
        maps += [(month, at // SLICE, bytes(bits[at : at + SLICE])) for at in range(0, len(bits), SLICE)]
    table = spark.createDataFrame(maps, "__m string, __s bigint, __bits binary")
    byte = F.shiftright("line_idx", 3)
    on = (F.col("file_name") == F.col("__m")) & (F.floor(byte / SLICE) == F.col("__s"))
    value = F.conv(F.hex(F.substring("__bits", (byte % SLICE + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.bit_get(value, (F.col("line_idx") % 8).cast("int")) == 1
    return df.join(table, on).where(hit).select(df.columns)


def reservoir_slots(n: int, total: int, seed: int = SEED) -> list[int]:
    """Compat: which of ``total`` matches, in scan order, end up in each slot of a reservoir of ``n``.

    The sequential scan draws a number for every match behind the first ``n``, so repeating it takes as many draws, on the
    driver (half a second a million); the memory is that of the reservoir. The documented sample, :func:`fixed_size`, has no such loop.
    """
    randint, slots = random.Random(seed).randint, list(range(min(n, total)))
    for i in range(n, total):
        j = randint(0, i)
        if j < n:
            slots[j] = i
    return slots


def reservoir_scan(df: DataFrame, n: int, order: list[str], seed: int = SEED) -> DataFrame:
    """Compat: the matches that a sequential reservoir keeps, with their ``slot``."""
    # ordinals without one task for all rows: rows before each partition, then a count within it
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id())
    ranged = ranged.withColumn("__i", F.monotonically_increasing_id() - F.shiftleft(F.col("__p").cast("long"), 33))
    ranged = stored(ranged, "scan")  # the ranges must be the same for counts and rows
    sizes = {r["__p"]: r["n"] for r in ranged.groupBy("__p").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    slots = [(s, i) for s, i in enumerate(reservoir_slots(n, total, seed))]
    spark = df.sparkSession
    numbered = ranged.join(F.broadcast(spark.createDataFrame(before, "__p int, __b bigint")), "__p").withColumn("__o", F.col("__i") + F.col("__b"))
    kept = numbered.join(spark.createDataFrame(slots, "slot int, __o bigint"), "__o")
    return kept.drop("__o", "__p", "__i", "__b").orderBy("slot")
