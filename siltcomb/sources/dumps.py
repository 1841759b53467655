"""Monthly dumps of JSON lines as DataFrames, pruned by the month in the file name.

A file's first bytes tell how it is read. Plain, gzip, bzip2 and zstd files are read by the JVM; zstd files whose
window is over 128 MiB, which the JVM codec refuses, and xz files go through a Python source with one task a file.
Folders are listed by Hadoop's file systems. A dump that no reader is known for is an error, never silence.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siltcomb.functions.values import within
from siltcomb.functions.workers import importable
from siltcomb.sources.store import files, fs_and_path, head

COMMENT = ("id", "author", "author_flair_text", "body", "subreddit", "score", "created_utc", "link_id", "parent_id", "permalink")
POST = ("id", "author", "author_flair_text", "selftext", "title", "subreddit", "score", "created_utc", "permalink")
#: The largest zstd window that the JVM reads.
JVM_WINDOW = 1 << 27
#: Bytes of files that can't be split for each task that their lines are dealt to.
DEALT = 8 << 20
#: A month file's name: kind, month, codec.
NAME = r"^R([CS])_(\d{4})-(\d{2})(\.(?:zst|xz|bz2|gz))?$"


def kind_of(path: str) -> str:
    """Posts if the path says submissions, else comments."""
    return "posts" if "submissions" in path else "comments"


def text_column(kind: str) -> str:
    return "selftext" if kind == "posts" else "body"


def file_date(name: Column) -> tuple[Column, Column]:
    """Year and month of a dump's file name; null for other names."""
    return tuple(F.regexp_extract(name, r"(\d{4})-(\d{2})", i).try_cast("int") for i in (1, 2))


def file_month(name: Column) -> Column:
    """year * 12 + month of a dump's file name; null for other names."""
    year, month = file_date(name)
    return year * 12 + month


class LongWindowReader(DataSourceReader):
    """One task a file. Files are opened where they are: local ones directly, others by pyarrow's file systems."""

    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"])

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition):
        import bz2
        import gzip
        import io
        import lzma

        import zstandard
        from pyarrow.fs import FileSystem

        if partition is None:  # no file in range
            return
        store, path = FileSystem.from_uri(re.sub(r"^file:/+", "file:///", partition.value))
        with store.open_input_stream(path, compression=None) as raw:
            if path.endswith(".zst"):
                # frames follow each other in concatenated dumps
                data = zstandard.ZstdDecompressor(max_window_size=2**31).stream_reader(raw, read_across_frames=True)
            else:
                opened = {".xz": lzma.open, ".bz2": bz2.open, ".gz": gzip.open}.get(path[path.rfind(".") :])
                data = opened(raw) if opened else raw
            for line in io.TextIOWrapper(data, encoding="utf-8", errors="replace", newline="\n"):
                yield path.rpartition("/")[2], line.rstrip("\n")


class LongWindowSource(DataSource):
    """``spark.read.format("jsonl_dumps")``: option paths, a JSON list of files."""

    @classmethod
    def name(cls) -> str:
        return "jsonl_dumps"

    def schema(self) -> str:
        return "file_name string, value string"

    def reader(self, schema) -> DataSourceReader:
        return LongWindowReader(self.options)


def window_of(head: bytes) -> int:
    """The window in bytes that the first frame of a zstd file asks for."""
    if head[4] & 0x20:  # a single segment: the window is the content
        size = head[4] >> 6
        at = 5 + (0, 1, 2, 4)[head[4] & 3]
        n = (1, 2, 4, 8)[size]
        return int.from_bytes(head[at : at + n], "little") + (256 if size == 1 else 0)
    base = 1 << 10 + (head[5] >> 3)
    return base + (base >> 3) * (head[5] & 7)


def reader_of(name: str, head: bytes) -> str:
    """``jvm`` or ``python``: what reads a dump with these first bytes; ValueError if nothing does."""
    if not re.match(NAME, name):
        raise ValueError(f"no reader for a dump of this name: {name}")
    suffix = name[name.rfind(".") :] if "." in name else ""
    magic = {b"\x28\xb5\x2f\xfd": ".zst", b"\xfd7zX": ".xz"}.get(head[:4]) or (".bz2" if head[:3] == b"BZh" else ".gz" if head[:2] == b"\x1f\x8b" else "")
    if head and magic != suffix and not head[1:4] == b"\x2a\x4d\x18":  # a skippable frame may stand before a zstd frame
        raise ValueError(f"{name} is not what its name says: it begins like a {magic or 'plain'} file")
    if suffix == ".xz":
        return "python"
    if suffix == ".zst":
        return "python" if len(head) < 18 or magic != ".zst" or window_of(head) > JVM_WINDOW else "jvm"
    return "jvm"


def dump_files(spark: SparkSession, path: str, first: tuple[int, int] | None = None, last: tuple[int, int] | None = None) -> list[tuple[str, str]]:
    """(name, full path) of the dumps in range; other files of a folder are passed over."""
    return [(n, p) for n, p in files(spark, path) if re.match(r"R[CS]_\d{4}-\d{2}", n) and within(n, first, last)]


def lines(spark: SparkSession, path: str, first: tuple[int, int] | None = None, last: tuple[int, int] | None = None, codec: str = "auto", spread: bool = False) -> DataFrame:
    """(file_name, block_start, value) of the dump lines in range; files out of range aren't opened.

    ``codec`` is ``jvm`` or ``python`` to read all files one way; ``auto`` decides by each file's first bytes. With ``spread``, what one
    task must read, a file that can't be split, is dealt out to many as lines; the order of lines is lost.
    """
    found = dump_files(spark, path, first, last)
    by: dict[str, list[str]] = {"jvm": [], "python": []}
    for name, full in found:
        by[reader_of(name, head(spark, full, 18)) if codec == "auto" else codec].append(full)
    out = None
    if by["jvm"]:
        whole = [p for p in by["jvm"] if spread and p.endswith((".gz", ".zst"))]
        for paths in (whole, [p for p in by["jvm"] if p not in whole]):
            if paths:
                t = spark.read.text(paths)
                t = t.select(F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_block_start").alias("block_start"), "value")
                t = dealt(t, paths) if whole and paths is whole else t
                out = t if out is None else out.unionByName(t)
    if by["python"]:
        importable(spark)
        spark.dataSource.register(LongWindowSource)
        t = spark.read.format("jsonl_dumps").option("paths", json.dumps(by["python"])).load()
        t = t.select("file_name", F.lit(0).cast("bigint").alias("block_start"), "value")
        t = dealt(t, by["python"]) if spread else t
        out = t if out is None else out.unionByName(t)
    return spark.createDataFrame([], "file_name string, block_start bigint, value string") if out is None else out


def dealt(lines_: DataFrame, paths: list[str]) -> DataFrame:
    """Lines of files in turns to as many tasks as keep all cores busy, and more where files are large. Copies don't meet in one task."""
    spark = lines_.sparkSession
    size = sum(fs.getFileStatus(p).getLen() for fs, p in (fs_and_path(spark, x) for x in paths))
    n = max(4 * spark.sparkContext.defaultParallelism, size // DEALT)
    return lines_.withColumn("__i", F.monotonically_increasing_id()).repartition(n, "__i").drop("__i")


def parsed(lines_: DataFrame, kind: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Entries of the pruned schema with ``raw``, ``file_name`` and ``block_start``; lines that aren't JSON objects are left out.

    ``mode="FAILFAST"`` makes them an error instead.
    """
    fields = COMMENT if kind == "comments" else POST
    # all as strings: numbers come as numbers or strings, depending on the dump's age
    schema = ", ".join(f"{f} string" for f in fields) + ", _corrupt_record string"
    t = lines_.withColumn("j", F.from_json("value", schema, {"mode": mode, "columnNameOfCorruptRecord": "_corrupt_record"}))
    t = t.where("j is not null and j._corrupt_record is null")
    out = [F.col(f"j.{f}").cast("bigint").alias(f) if f == "score" else F.col(f"j.{f}").alias(f) for f in fields]
    return t.select(*out, F.col("value").alias("raw"), "file_name", "block_start")


def malformed(lines_: DataFrame) -> DataFrame:
    """(file_name, n) of lines that aren't JSON objects."""
    j = F.from_json("value", "id string, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    return lines_.withColumn("j", j).where("j is null or j._corrupt_record is not null").groupBy("file_name").agg(F.count("*").alias("n"))


def scan(spark: SparkSession, path: str, kind: str | None = None, first=None, last=None, codec: str = "auto", mode: str = "PERMISSIVE", spread: bool = False) -> DataFrame:
    """Entries of a folder of dumps."""
    return parsed(lines(spark, path, first, last, codec, spread), kind or kind_of(path), mode)


def line_index(entries: DataFrame) -> DataFrame:
    """``entries`` with ``line_idx``, the position among the parsed lines of the file, from 0.

    A file's blocks are counted first, a row for each; then each row knows how many come before its block. No task sees a whole month.
    """
    t = entries.withColumn("__at", F.monotonically_increasing_id()).withColumn("__p", F.spark_partition_id())
    blocks = t.groupBy("file_name", "block_start", "__p").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("file_name").orderBy("block_start", "__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each block that was read: 20 TB in blocks of 128 MB are 160,000
    blocks = blocks.select("file_name", "block_start", "__p", "__first", before.alias("__before"))
    return t.join(F.broadcast(blocks), ["file_name", "block_start", "__p"]).withColumn("line_idx", F.col("__at") - F.col("__first") + F.col("__before")).select(*entries.columns, "line_idx")


def months(spark: SparkSession, path: str) -> DataFrame:
    """(year, month, file_name) of the dumps in a folder; a row for each file."""
    rows = [(int(n[3:7]), int(n[8:10]), n) for n, _ in dump_files(spark, path) if re.match(NAME, n)]
    return spark.createDataFrame(rows, "year int, month int, file_name string")


def month_range(spark: SparkSession, path: str) -> tuple[tuple[int, int], tuple[int, int]] | None:
    """First and last month of a folder, None if it has no dumps."""
    at = F.col("year") * 12 + F.col("month") - 1
    a, b = months(spark, path).agg(F.min(at), F.max(at)).first()
    return None if a is None else ((a // 12, a % 12 + 1), (b // 12, b % 12 + 1))


def monthly_counts(spark: SparkSession, path: str) -> DataFrame:
    """(year, month, n) of a tab-separated table with or without a header, months padded or not."""
    t = spark.read.csv(path, sep="\t", schema="year string, month string, n string")
    t = t.select(F.col("year").try_cast("int").alias("year"), F.col("month").try_cast("int").alias("month"), F.col("n").try_cast("bigint").alias("n"))
    return t.where("year is not null")


def ingest(spark: SparkSession, path: str, to: str, kind: str | None = None, codec: str = "auto") -> None:
    """Rewrite dumps as Parquet in folders by year and month, for repeated queries."""
    t = scan(spark, path, kind, codec=codec, spread=True)
    year, month = file_date(F.col("file_name"))
    t.withColumn("year", year).withColumn("month", month).repartition("year", "month", F.pmod(F.xxhash64("id"), F.lit(64))).write.partitionBy("year", "month").parquet(to)


def results(spark: SparkSession, path: str) -> DataFrame:
    """Result tables that were written as CSV.

    Their folders, of which there may be thousands, are listed by a few tasks for each core; Spark would start a task for each folder.
    """
    tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(tasks)
    spark.conf.set(tasks, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        return spark.read.csv(path, sep=";", quote='"', escape='"', multiLine=True, header=True)
    finally:
        spark.conf.set(tasks, before)
