"""Publishing converted datasets named in the manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from ..sources import fs

# Manifest check outcomes, tested in this order.
MSG_NOT_FOUND = "No new datasets to upload (ingested.csv not found)"
MSG_NO_DATA = "No new datasets to upload (manifest has no data)"
MSG_EMPTY = "No new datasets to upload (manifest is empty)"
EMPTY_DATA_ERROR = "EmptyDataError"


def manifest_check(exists: Column, read_error: Column, n_rows: Column) -> tuple[Column, Column]:
    """(is_valid, message): missing file, then unreadable-empty file, then
    zero rows, else valid with a null message."""
    message = (F.when(~exists, F.lit(MSG_NOT_FOUND))
               .when(F.coalesce(read_error == F.lit(EMPTY_DATA_ERROR), F.lit(False)), F.lit(MSG_NO_DATA))
               .when(n_rows == 0, F.lit(MSG_EMPTY)))
    return message.isNull(), message


def publish_plan(manifest: DataFrame, landed: DataFrame, prefix: str, file_col: str = "file_path",
                 landed_col: str = "rel_dir") -> DataFrame:
    """Manifest rows with an action: `publish` when the converted dataset is
    present under the data root (a folder counts), else `skip_missing`; and
    the target path `prefix + file_path`."""
    here = landed.select(F.col(landed_col).alias(file_col)).distinct().withColumn("_here", F.lit(True))
    j = manifest.join(here, file_col, "left")
    action = F.when(F.col("_here"), F.lit("publish")).otherwise(F.lit("skip_missing"))
    return j.select(*manifest.columns, action.alias("action"),
                    F.concat(F.lit(prefix), F.col(file_col)).alias("target"))


def execute_publish(plan: DataFrame, src_root: str, n_tasks: int | None = None, move: bool = False) -> DataFrame:
    """Bring every `publish` row from `src_root/file_path` to its `target`, on
    the executors (paths travel, never file contents). Returns
    (file_path, target, status, bytes).

    With `move`, where both are in one file system, a dataset folder is
    renamed, so no byte is copied. Else its files are copied beside the data
    root, each by a task of its own, and the folder is put in place when all
    are there: a dataset of many files is copied by all cores, and one that
    can't be copied leaves the old one whole. Either way the old dataset is
    put aside first and deleted last, and a task that runs again finds its
    dataset published."""
    spark, src_root = plan.sparkSession, src_root.rstrip("/")
    ship_package(spark)
    todo = plan.where(F.col("action") == "publish").select("file_path", "target")
    n_tasks = n_tasks or spark.sparkContext.defaultParallelism
    first = todo.select("target").first() if move else None
    if move and (first is None or fs.same_store(spark, src_root, first.target)):
        ready = todo.select("file_path", "target", F.concat(F.lit(src_root + "/"), "file_path").alias("source"), F.lit(None).cast("string").alias("error"))
    else:
        ready = _copied(todo, src_root)

    def place(batches):
        import pandas as pd

        from cubeshelf.operators.publish import put_in_place
        for pdf in batches:
            out = []
            for fp, target, source, error in zip(pdf["file_path"], pdf["target"], pdf["source"], pdf["error"]):
                try:
                    if error is not None:
                        raise OSError(error)
                    out.append((fp, target, "published", put_in_place(source, target, fp)))
                except Exception as e:  # noqa: BLE001 - reported per dataset
                    out.append((fp, target, f"failed: {error or type(e).__name__}", 0))
            yield pd.DataFrame(out, columns=["file_path", "target", "status", "bytes"])

    return ready.repartition(n_tasks).mapInPandas(place, "file_path string, target string, status string, bytes long")


def _beside(target: str, file_path: str) -> str:
    """The folder for what is on its way to `target`: outside the data root, in its file system."""
    prefix = target[: len(target) - len(file_path)] if target.endswith(file_path) else target.rsplit("/", 1)[0] + "/"
    return f"{prefix.rstrip('/')}-publishing"


def put_in_place(source: str, target: str, file_path: str) -> int:
    """Rename `source` to `target`, whose old content is put aside and then
    deleted; bytes of the dataset. Done already when there is no source."""
    import uuid

    from pyarrow import fs as pafs

    from ..sources.paths import open_fs
    store, src = open_fs(source)
    _, dst = open_fs(target)
    done = store.get_file_info(src).type == pafs.FileType.NotFound
    info = store.get_file_info(dst if done else src)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(source)
    files = [info] if info.type == pafs.FileType.File else \
        [i for i in store.get_file_info(pafs.FileSelector(info.path, recursive=True)) if i.type == pafs.FileType.File]
    if not done:
        store.create_dir(dst.rstrip("/").rsplit("/", 1)[0], recursive=True)
        old = None
        if store.get_file_info(dst).type != pafs.FileType.NotFound:
            aside = open_fs(_beside(target, file_path))[1]
            store.create_dir(aside, recursive=True)
            old = f"{aside}/{uuid.uuid4().hex}-old"
            store.move(dst, old)
        store.move(src, dst)
        if old:
            (store.delete_dir if store.get_file_info(old).type == pafs.FileType.Directory else store.delete_file)(old)
    return int(sum(i.size for i in files))


def _copied(todo: DataFrame, src_root: str) -> DataFrame:
    """(file_path, target, source, error): every dataset copied file by file to
    a folder beside the data root; `error` if a file could not be."""
    import uuid

    landed = fs.landed_files(todo.sparkSession, src_root)
    own = landed.select(F.col("rel_dir").alias("own"), "rel_path").union(landed.select(F.col("rel_path").alias("own"), "rel_path"))
    files = todo.join(own, F.col("file_path") == F.col("own"), "left").select("file_path", "target", "rel_path")
    mark = uuid.uuid4().hex

    def copy(batches):
        import uuid

        import pandas as pd
        import pyarrow.fs as pafs

        from cubeshelf.operators.publish import _beside
        from cubeshelf.sources.paths import open_fs
        for pdf in batches:
            out = []
            for fp, target, rel in zip(pdf["file_path"], pdf["target"], pdf["rel_path"]):
                base, error = f"{_beside(target, fp)}/{mark}/{fp}", None
                try:
                    if rel is None:
                        raise FileNotFoundError(fp)
                    src_fs, src = open_fs(f"{src_root}/{rel}")
                    dst_fs, dst = open_fs(base + rel[len(fp):])
                    dst_fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
                    tmp = f"{dst.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp"  # a repeated task writes its own file; the last rename wins
                    pafs.copy_files(src, tmp, source_filesystem=src_fs, destination_filesystem=dst_fs)
                    dst_fs.move(tmp, dst)
                except Exception as e:  # noqa: BLE001 - reported per dataset
                    error = type(e).__name__
                out.append((fp, target, base, error))
            yield pd.DataFrame(out, columns=["file_path", "target", "source", "error"])

    schema = "file_path string, target string, source string, error string"
    n = max(1, min(files.count(), 64 * todo.sparkSession.sparkContext.defaultParallelism))
    done = materialize(files.repartition(n).mapInPandas(copy, schema), "publish-copies")
    return done.groupBy("file_path", "target", "source").agg(F.max("error").alias("error"))


def manifest_status(spark, path: str):
    """Check a manifest on disk: (is_valid, message, manifest DataFrame).

    A missing file, a zero-byte file (no header even) and a header-only file
    give the three messages, in that order of checks."""
    from ..schemas import MANIFEST
    if not fs.exists(spark, path):
        df = spark.createDataFrame([], MANIFEST)
        exists, err = False, None
    else:
        empty = fs.du(spark, path) == 0
        df = (spark.createDataFrame([], MANIFEST) if empty
              else spark.read.schema(MANIFEST).option("header", "true").csv(path))
        exists, err = True, (EMPTY_DATA_ERROR if empty else None)
    n = df.count() if exists and err is None else 0
    probe = spark.createDataFrame([(exists, err, n)], "exists boolean, err string, n long")
    valid, message = manifest_check(F.col("exists"), F.col("err"), F.col("n"))
    row = probe.select(valid, message).first()
    return bool(row[0]), row[1], df
