"""Directory listing through the cluster's Hadoop file system.

Only one folder level is listed on the driver (names of dataset folders);
file-level listings go through Spark's own parallel file index (see
`landed_files`).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def same_store(spark: SparkSession, a: str, b: str) -> bool:
    """Whether two paths are in one file system."""
    return _fs(spark, a)[0].getUri().equals(_fs(spark, b)[0].getUri())


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Immediate sub-folder names of `path`, in name order; [] if missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def ages(spark: SparkSession, path: str) -> dict[str, float]:
    """Immediate sub-folder names of `path` and the seconds since each was last written to."""
    import time

    f, p = _fs(spark, path)
    if not f.exists(p):
        return {}
    return {s.getPath().getName(): time.time() - s.getModificationTime() / 1000 for s in f.listStatus(p) if s.isDirectory()}


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """(rel_path, rel_dir, length) of every file under `root`, listed by
    Spark's parallel file index. Only metadata columns are selected, so no
    file content is read. Zero-byte files are not listed by this reader."""
    root = root.rstrip("/")
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .load(root).select("path", "length"))
    rel = F.regexp_extract(F.col("path"), r"^.*?" + _tail_pattern(root) + r"/(.+)$", 1)
    return df.select(rel.alias("rel_path"),
                     F.regexp_extract(rel, r"^(.*)/[^/]+$", 1).alias("rel_dir"),
                     F.col("length"))


def _tail_pattern(root: str) -> str:
    import re
    # Match on the last path components only: the listing qualifies paths
    # with a scheme (file:/, hdfs://...) that the caller's root may lack.
    tail = "/".join(root.split("/")[-2:])
    return re.escape(tail)


def du(spark: SparkSession, path: str) -> int:
    """Total bytes under `path` (one metadata call)."""
    f, p = _fs(spark, path)
    return int(f.getContentSummary(p).getLength())


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Rename `src` to `dst` (replacing `dst`), creating the parent folder.
    A metadata operation on HDFS-like file systems."""
    f, s = _fs(spark, src)
    jvm = spark.sparkContext._jvm
    d = jvm.org.apache.hadoop.fs.Path(dst)
    if not f.exists(s):
        raise FileNotFoundError(src)
    if f.exists(d):
        f.delete(d, True)
    f.mkdirs(d.getParent())
    if not f.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Replace a small file: write a sibling, then rename it over the old one
    in one step, so a reader finds either the old or the new content."""
    f, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    out = f.create(tmp, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(f.getUri(), conf).rename(f.makeQualified(tmp), f.makeQualified(p), how)


def create_new(spark: SparkSession, path: str, data: bytes) -> bool:
    """Put a small whole file at `path` unless there is one; False then.

    Of several writers exactly one succeeds, where the file system refuses to
    rename onto a file in one step (HDFS and its like) or to link to a name
    that is taken (local disks)."""
    f, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    f.mkdirs(p.getParent())
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(f.getUri(), conf)
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    if context.util().exists(f.makeQualified(p)):
        return False
    out = f.create(tmp, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    try:
        if f.getUri().getScheme() == "file":
            file = lambda x: jvm.java.io.File(f.makeQualified(x).toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(file(p), file(tmp))
        else:
            how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            how[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(f.makeQualified(tmp), f.makeQualified(p), how)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        if f.exists(tmp):
            f.delete(tmp, False)
    return True


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Immediate file names of `path`, in name order; [] if missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small text file in one step."""
    write_bytes(spark, path, text.encode("utf-8"))


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small text file, or None when it does not exist."""
    f, p = _fs(spark, path)
    if not f.exists(p):
        return None
    stream = f.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder tree; False when it did not exist."""
    f, p = _fs(spark, path)
    return bool(f.delete(p, True)) if f.exists(p) else False
