"""Landed archives: signature check, data-member choice and extraction.

Archives are handled by path: the executors open them (any Hadoop-style URI
that PyArrow understands), so a multi-gigabyte archive never becomes one
DataFrame cell. Signature and member choice are column expressions applied
to the small per-archive facts gathered by `inspect_archives`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

# The local-file-header signature of a ZIP archive, the member
# extension, the marker of metadata members, and the two member-choice errors.
ZIP_MAGIC_HEX = "504b0304"
DATA_EXTENSION = ".csv"
METADATA_MARK = "MetaData"
MSG_EMPTY_ARCHIVE = "ZIP archive is empty"
MSG_NO_CSV = "No CSV file found in ZIP. Files: "


def magic_hex(content: Column) -> Column:
    """Lower-case hex of the first 4 bytes, 'empty' for no bytes."""
    head = F.substring(content, 1, 4)
    return F.when(F.octet_length(head) > 0, F.lower(F.hex(head))).otherwise(F.lit("empty"))


def signature_check(magic: Column) -> tuple[Column, Column]:
    """(valid, reason) from the hex of the first bytes."""
    valid = magic == F.lit(ZIP_MAGIC_HEX)
    reason = F.when(~valid, F.concat(F.lit("no ZIP archive: the first bytes are "), magic,
                                     F.lit("; the provider probably answered with a web page")))
    return valid, reason


def choose_member(names: Column) -> tuple[Column, Column]:
    """(member, error) for an archive's member list.

    CSV members by extension (case-insensitive); the first one without the
    metadata mark (case-sensitive, anywhere in the path) wins, else the first
    CSV. An empty list and a list without CSV are distinct errors."""
    csvs = F.filter(names, lambda x: F.lower(x).endswith(DATA_EXTENSION))
    data = F.filter(csvs, lambda x: ~x.contains(METADATA_MARK))
    member = F.coalesce(F.get(data, 0), F.get(csvs, 0))
    quoted = F.transform(names, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    listing = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    error = (F.when(F.size(names) == 0, F.lit(MSG_EMPTY_ARCHIVE))
             .when(F.size(csvs) == 0, F.concat(F.lit(MSG_NO_CSV), listing)))
    return member, error


def inspect_archives(archives: DataFrame, path: str = "archive_path") -> DataFrame:
    """Per archive: length, first-bytes hex and member names, read on the
    executors. Zero-byte and missing files are reported, not dropped."""
    ship_package(archives.sparkSession)
    def facts(batches):
        import zipfile
        import pandas as pd
        from cubeshelf.sources.paths import open_fs
        for pdf in batches:
            lengths, magics, members, errors = [], [], [], []
            for p in pdf[path]:
                try:
                    f, rel = open_fs(p)
                    with f.open_input_file(rel) as fh:
                        size = fh.size()
                        head = fh.read(4)
                        magic = head.hex() if head else "empty"
                        names = None
                        if magic == ZIP_MAGIC_HEX:
                            fh.seek(0)
                            with zipfile.ZipFile(fh) as z:
                                names = z.namelist()
                    lengths.append(size); magics.append(magic); members.append(names); errors.append(None)
                except Exception as e:  # noqa: BLE001 - reported per archive
                    lengths.append(None); magics.append(None); members.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            out = pdf.copy()
            out["length"] = pd.array(lengths, dtype="Int64")
            out["magic"] = magics
            out["members"] = members
            out["read_error"] = errors
            yield out

    schema = T.StructType(archives.schema.fields + [
        T.StructField("length", T.LongType()), T.StructField("magic", T.StringType()),
        T.StructField("members", T.ArrayType(T.StringType())), T.StructField("read_error", T.StringType())])
    return archives.mapInPandas(facts, schema)


def plan_extraction(facts: DataFrame) -> DataFrame:
    """Adds `member` and `error` (read error, bad signature, or member
    choice error, in that order)."""
    valid, bad_sig = signature_check(F.col("magic"))
    member, member_err = choose_member(F.coalesce(F.col("members"), F.array().cast("array<string>")))
    error = F.coalesce(F.col("read_error"), F.when(~valid, bad_sig), member_err)
    return facts.withColumn("member", F.when(error.isNull(), member)).withColumn("error", error)


def extract_members(plan: DataFrame, staging: str, path: str = "archive_path", key: str = "productId",
                    n_tasks: int | None = None) -> DataFrame:
    """Stream each chosen member to `staging/<key>/<member file>` on the
    executors. Returns the plan rows with `csv_path` and `csv_bytes` (null on
    failure)."""
    ship_package(plan.sparkSession)
    staging = staging.rstrip("/")

    def extract(batches):
        import shutil
        import uuid
        import zipfile
        import pandas as pd
        from cubeshelf.sources.paths import open_fs
        for pdf in batches:
            outs, errs, sizes = [], [], []
            for k, p, m, err in zip(pdf[key], pdf[path], pdf["member"], pdf["error"]):
                if err is not None or m is None:
                    outs.append(None); errs.append(err); sizes.append(None)
                    continue
                try:
                    src_fs, rel = open_fs(p)
                    target = f"{staging}/{k}/{m.rsplit('/', 1)[-1]}"
                    dst_fs, dst = open_fs(target)
                    dst_fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
                    # a repeated or speculative task writes its own file; the last rename wins
                    tmp = f"{dst}.{uuid.uuid4().hex[:8]}.tmp"
                    with src_fs.open_input_file(rel) as fh, zipfile.ZipFile(fh) as z, \
                            z.open(m) as src, dst_fs.open_output_stream(tmp) as out:
                        shutil.copyfileobj(src, out, 1 << 20)
                        size = out.tell()
                    dst_fs.move(tmp, dst)
                    outs.append(target); errs.append(None); sizes.append(size)
                except Exception as e:  # noqa: BLE001 - reported per archive
                    outs.append(None); errs.append(f"{type(e).__name__}: {e}"); sizes.append(None)
            res = pdf.copy()
            res["csv_path"] = outs
            res["error"] = errs
            res["csv_bytes"] = pd.array(sizes, dtype="Int64")
            yield res

    schema = T.StructType(plan.schema.fields + [T.StructField("csv_path", T.StringType()),
                                                T.StructField("csv_bytes", T.LongType())])
    n_tasks = n_tasks or plan.sparkSession.sparkContext.defaultParallelism
    return plan.repartition(n_tasks).mapInPandas(extract, schema)

