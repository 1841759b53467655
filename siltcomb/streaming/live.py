"""Entries as they arrive: parsed, deduplicated and counted by month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltcomb.functions.entries import canonical_hash, epoch
from siltcomb.sources.dumps import parsed


def entries(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """New dump files of a folder as a stream of entries: plain, gzip, bzip2 and zstd ones (xz and long windows need :func:`siltcomb.sources.dumps.scan`)."""
    t = spark.readStream.option("pathGlobFilter", "R[CS]_[0-9][0-9][0-9][0-9]-[0-9][0-9]{,.gz,.bz2,.zst}").text(path)
    return parsed(t.select(F.lit(None).cast("string").alias("file_name"), F.lit(0).cast("bigint").alias("block_start"), "value"), kind)


def unique(stream: DataFrame, delay: str = "30 days") -> DataFrame:
    """Without exact repetitions that arrive within ``delay``; older hashes leave the state."""
    t = stream.withColumn("at", F.timestamp_seconds(epoch(F.col("created_utc")))).withColumn("h", canonical_hash(F.col("raw")))
    return t.withWatermark("at", delay).dropDuplicatesWithinWatermark(["h"]).drop("h")


def counts(stream: DataFrame, time: str, every: str, by: list[str], delay: str = "1 hour") -> DataFrame:
    """(start, *by, n) in tumbling windows, late rows within ``delay`` counted."""
    w = F.window(F.col(time), every)
    return stream.withWatermark(time, delay).groupBy(w, *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def drained(stream: DataFrame, folder: str, keys: list[str] | None = None) -> DataFrame:
    """Run over what is there and give the result, which is kept in files of the shared folder, never in the driver.

    Without ``keys``, rows are appended. With them, each batch writes the keys whose values changed, windows that the watermark has
    passed leave the state, and a key's value is that of its last batch. A batch that is run again replaces its own files.
    """
    spark = stream.sparkSession
    names = [f"`{k}`" for k in keys or []]

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    q = stream.writeStream.outputMode("update" if keys else "append").foreachBatch(write).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    t = spark.read.schema(f"{stream._jdf.schema().toDDL()}, batch bigint").parquet(f"{folder}/out")
    if not keys:
        return t.drop("batch")
    rest = [c for c in stream.columns if c not in keys]
    last = t.groupBy(*names).agg(F.max_by(F.struct(*rest), "batch").alias("__x"))
    return last.select(*[F.col(n) for n in names], *[F.col(f"__x.`{c}`").alias(c) for c in rest])
