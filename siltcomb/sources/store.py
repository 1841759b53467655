"""Working tables and small files in the folder that driver and executors share, by Hadoop's file systems alone."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of the session's own only where that is not set and Spark runs on this machine alone."""
    sc = spark.sparkContext
    set_ = sc._jsc.sc().getCheckpointDir()
    where = sc.getConf().get("spark.checkpoint.dir") or (set_.get() if set_.isDefined() else None)
    if not where:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = f"file://{tempfile.mkdtemp(prefix='siltcomb-shared-')}"
        sc.setCheckpointDir(where)
    return where.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: it isn't worked out again, whatever is lost."""
    path = f"{shared_dir(df.sparkSession)}/siltcomb-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fs_and_path(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(df: DataFrame) -> None:
    """Remove the folder of a stored table that nothing reads any more."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        fs, p = fs_and_path(df.sparkSession, path)
        fs.delete(p, True)


def files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, full path) of the files in a folder, or of the file itself, by name."""
    fs, p = fs_and_path(spark, path)
    found = [s.getPath() for s in fs.listStatus(p) if s.isFile()]
    return sorted((x.getName(), x.toString()) for x in found)


def head(spark: SparkSession, path: str, n: int) -> bytes:
    """The first bytes of a file."""
    fs, p = fs_and_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file."""
    fs, p = fs_and_path(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()


def put_text(df: DataFrame, path: str, compression: str = "none") -> None:
    """Write the one string column of ``df`` as a single file of lines under a name of its own (a month's dump is one file).

    Each task writes a part, and parts are put behind each other in order: plain text, gzip members and bzip2 streams may be.
    """
    spark = df.sparkSession
    folder = f"{path}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).text(folder)
    fs, to = fs_and_path(spark, path)
    parts = [full for name, full in files(spark, folder) if name.startswith("part-")]
    if len(parts) == 1:
        fs.rename(fs_and_path(spark, parts[0])[1], to)
    else:
        out = fs.create(to, False)
        try:
            for part in parts:
                stream = fs.open(fs_and_path(spark, part)[1])
                try:
                    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                finally:
                    stream.close()
        finally:
            out.close()
    fs.delete(fs_and_path(spark, folder)[1], True)
