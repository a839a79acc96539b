"""CSV dataset -> all-string parquet, and the failure-isolated batch of them.

One dataset = one Spark read/write. Datasets have different schemas, so
they are separate jobs; a small driver-side pool submits several at once
(the FAIR scheduler shares the executors between them).
"""

from __future__ import annotations

import json
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import error_label, sanitize_names, unique_names
from ..functions.nulls import map_null_symbols
from ..schemas import INGEST_REPORT, MANIFEST, all_string
from ..session import materialize
from ..sources import fs
from . import split_csv

# The CSV dialect of the statistical tables.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",   # quoted values may hold newlines
    "quote": '"',
    "escape": '"',         # a doubled quote inside quotes is one quote
    "encoding": "UTF-8",
    "inferSchema": "false",
}
BOM = "\ufeff"
# Names given to blank and repeated header cells
# ('Unnamed: 4'; 'a', 'a.1', 'a.2').
BLANK_NAME = "Unnamed: {i}"
REPEAT_NAME = "{name}.{k}"
TARGET_FILE_BYTES = 128 * 1024 * 1024


class EmptyFileError(ValueError):
    pass


def _reader(spark: SparkSession, multiline: bool):
    opts = dict(CSV_OPTIONS)
    opts["multiLine"] = "true" if multiline else "false"
    return spark.read.options(**opts)


def read_header(spark: SparkSession, csv_path: str, multiline: bool = True) -> list[str]:
    """Column names from the first record (quoted, possibly multi-line).

    Blank names become 'Unnamed: <i>', repeated names 'a', 'a.1', 'a.2', and
    a UTF-8 byte-order mark is dropped. Only the first record is parsed."""
    first = _reader(spark, multiline).option("header", "false").csv(csv_path).first()
    if first is None:
        raise EmptyFileError(f"empty CSV file: {csv_path}")
    return header_names([("" if v is None else v) for v in first])


def header_names(raw: list[str]) -> list[str]:
    """Header cells -> column names (before cleaning): BOM dropped, blank
    cells named by position, repeated names numbered."""
    raw = list(raw)
    if raw and raw[0].startswith(BOM):
        raw[0] = raw[0][len(BOM):]
    names, counts = [], {}
    for i, n in enumerate(raw):
        n = n if n != "" else BLANK_NAME.format(i=i)
        if n in counts:
            counts[n] += 1
            n = REPEAT_NAME.format(name=n, k=counts[n])
        else:
            counts[n] = 0
        names.append(n)
    return names


def read_all_string(spark: SparkSession, csv_path: str, names: list[str], multiline: bool = True,
                    quarantine: bool = False) -> DataFrame:
    """Every column as STRING under positional names; a row of the wrong
    width fails the read (or, with `quarantine`, lands in `_corrupt_record`)."""
    r = _reader(spark, multiline).option("enforceSchema", "true")
    if quarantine:
        schema = all_string(names + ["_corrupt_record"])
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    else:
        schema = all_string(names)
        r = r.option("mode", "FAILFAST")
    return r.schema(schema).csv(csv_path)


def has_quoted_newlines(spark: SparkSession, csv_path: str) -> bool:
    """True when some physical line of the file holds an odd number of quote characters.

    With '"' as quote and '""' as escape, a line that starts outside quotes
    and ends inside them has an odd count; if no line does, by induction no
    quoted value spans lines and the file can be parsed line by line, split
    across tasks. One parallel pass; stops at the first odd line."""
    return _odd_lines(spark.read.text(csv_path)).limit(1).count() > 0


def _odd_lines(lines: DataFrame) -> DataFrame:
    quotes = F.length("value") - F.length(F.regexp_replace("value", '"', ""))
    return lines.where(quotes % 2 == 1)


def files_with_quoted_newlines(spark: SparkSession, paths: list[str]) -> set[str]:
    """Those of `paths` that `has_quoted_newlines` holds for, in one job."""
    by_uri = {_file_uri(spark, p): p for p in paths}
    found = _odd_lines(spark.read.text(paths).select("value", _norm_uri(F.col("_metadata.file_path")).alias("_fp")))
    return {by_uri[r[0]] for r in found.select("_fp").distinct().collect()}


def convert_csv(spark: SparkSession, csv_path: str, out_dir: str,
                multiline: bool | None = None, quarantine: bool = False, rejects_dir: str | None = None,
                range_bytes: int = split_csv.RANGE_BYTES) -> dict:
    """One dataset: header -> clean unique names -> all-string read ->
    missing-value symbols to null -> parquet folder (overwritten).

    `multiline=None` decides per file, by its content and not by its size:
    files without quoted newlines (`has_quoted_newlines`) are parsed line by
    line; the others are cut at records (`split_csv`). Either way a large file
    is read, parsed and written by many tasks, and lines of blanks alone are
    no rows."""
    if multiline is None:
        multiline = has_quoted_newlines(spark, csv_path)
    original = read_header(spark, csv_path, True)
    positional = [f"c{i}" for i in range(len(original))]
    clean, renamed = unique_names(sanitize_names(original))
    if multiline:
        df = split_csv.read_all_string(spark, csv_path, positional, CSV_OPTIONS, quarantine, range_bytes)
    else:
        df = read_all_string(spark, csv_path, positional, False, quarantine)
    rejects = 0
    if quarantine:
        # written once: counting and splitting must not parse the file again
        df = materialize(df, "quarantine")
        bad = df.where(F.col("_corrupt_record").isNotNull())
        rejects = bad.count()
        if rejects:
            bad.select("_corrupt_record").write.mode("overwrite").text(rejects_dir or out_dir.rstrip("/") + "_rejects")
        df = df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    map_null_symbols(df.toDF(*clean)).write.mode("overwrite").parquet(out_dir)
    return {"columns": clean, "renamed": renamed, "rejects": rejects, "multiline": multiline}


def read_headers(spark: SparkSession, paths: list[str], n_tasks: int = 8) -> dict[str, list | str]:
    """First record of every file, read on the executors in one pass (the
    CSV module parses one quoted record, BOM included). Returns path ->
    header cells, or path -> error text."""
    from ..session import ship_package
    ship_package(spark)
    def heads(batches):
        import csv
        import io
        import json
        import pandas as pd
        from cubeshelf.sources.paths import open_fs
        for pdf in batches:
            out = []
            for p in pdf["path"]:
                try:
                    f, rel = open_fs(p)
                    with f.open_input_stream(rel) as raw:
                        text = io.TextIOWrapper(raw, encoding="utf-8", newline="")
                        rec = next(csv.reader(text), None)
                    out.append((p, json.dumps(rec) if rec else None,
                                None if rec else "EmptyFileError: empty CSV file"))
                except Exception as e:  # noqa: BLE001 - reported per file
                    out.append((p, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "header", "err"])

    import json
    df = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, n_tasks))
    rows = df.mapInPandas(heads, "path string, header string, err string").collect()
    return {r.path: (json.loads(r.header) if r.header is not None else r.err) for r in rows}


def convert_group(spark: SparkSession, members: list[tuple[str, str]], raw_header: list[str],
                  staging: str) -> tuple[dict[str, str], list, list[str]]:
    """Several small CSV files with the same header -> one job.

    `members` are (dataset key, csv path), at most GROUP_SIZE. One scan reads
    all files (Spark packs small files into shared tasks); each row is tied
    to its dataset through its file path, joined with a key table of
    len(members) rows, and the result is written partitioned by key.
    Returns (key -> folder of that dataset's parquet files, renamed
    columns, output columns); an empty dataset gets an empty, schema-only
    folder."""
    original = header_names(raw_header)
    positional = [f"c{i}" for i in range(len(original))]
    clean, renamed = unique_names(sanitize_names(original))
    keys = spark.createDataFrame([(_file_uri(spark, p), str(k)) for k, p in members], "_fp string, _key string")
    scan = read_all_string(spark, [p for _, p in members], positional, False)
    rows = scan.select(*positional, _norm_uri(F.col("_metadata.file_path")).alias("_fp"))
    tagged = rows.join(F.broadcast(keys), "_fp").select(
        *[F.col(c).alias(n) for c, n in zip(positional, clean)], "_key")
    map_null_symbols(tagged, clean).write.partitionBy("_key").parquet(staging)
    done = {}
    for k, _ in members:
        part = f"{staging}/_key={k}"
        if not fs.exists(spark, part):
            spark.createDataFrame([], all_string(clean)).write.parquet(part)
        done[str(k)] = part
    return done, renamed, clean


def _norm_uri(c):
    return F.regexp_replace(c, "^file:///", "file:/")


def _file_uri(spark: SparkSession, path: str) -> str:
    """The form in which a scan reports a file (`_metadata.file_path`)."""
    import re
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    uri = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hp).toUri().toString()
    return re.sub(r"^file:///", "file:/", uri)



GROUP_SIZE = 256


def convert_batch(spark: SparkSession, items: DataFrame, data_root: str, workers: int = 4,
                  key: str = "productId", title: str = "title", folder: str = "folder",
                  csv_path: str = "csv_path", size_bytes: str = "length",
                  error: str = "error", timeout_s: float | None = None,
                  group_small: bool = True, split_threshold: int = TARGET_FILE_BYTES,
                  quarantine: bool = False) -> DataFrame:
    """Convert every item; one failure never stops the others.

    `items` carries one row per dataset with its extracted CSV path (or an
    earlier error). The list of datasets of one run is driver-side metadata
    (the jobs are submitted from the driver); the data never is. Returns the
    ingest report (INGEST_REPORT); the manifest is its `status = 'ok'` part.

    Small files (up to one split) that share a header are converted together,
    one job per group of up to GROUP_SIZE datasets; a group that fails is
    retried dataset by dataset so that the failure stays with its dataset.
    Large files are converted one by one (with the parallel split check).
    Every job runs in its own job group; a timer cancels it after
    `timeout_s`, and the dataset is reported as a `ConversionTimeout`.
    With `quarantine`, rows of the wrong width go to `<dataset>_rejects`
    instead of failing the dataset (one job per dataset then).
    """
    rows = items.select(key, title, folder, csv_path, size_bytes, error).collect()
    data_root = data_root.rstrip("/")
    sc = spark.sparkContext

    def guarded(label: str, fn):
        """Run fn() in a cancellable job group; returns (value, expired)."""
        group = f"{label}-{uuid.uuid4().hex[:8]}"
        expired = threading.Event()

        def expire():
            expired.set()
            sc.cancelJobGroup(group)

        timer = threading.Timer(timeout_s, expire) if timeout_s is not None else None
        sc.setLocalProperty("spark.scheduler.pool", "ingest")
        sc.setJobGroup(group, label, interruptOnCancel=True)
        if timer:
            timer.start()
        try:
            try:
                value = fn()
            except Exception:
                if expired.is_set():
                    return None, True
                raise
            return value, expired.is_set()
        finally:
            if timer:
                timer.cancel()

    def ok_row(r, rel, renamed=(), rejects=0, columns=None):
        parts = []
        if renamed:
            parts.append("renamed: " + ", ".join(f"{a} -> {b}" for a, b in renamed))
        if rejects:
            parts.append(f"rejected rows: {rejects}")
        notes = "; ".join(parts) or None
        cols = json.dumps(list(columns)) if columns is not None else None
        return (r[key], r[title], "ok", fs.du(spark, f"{data_root}/{rel}") / 1e6, rel, None, None, notes, cols)

    def failed_row(r, cls, msg):
        return (r[key], r[title], "failed", None, None, cls, msg, None, None)

    def timeout_row(r):
        return failed_row(r, "ConversionTimeout", f"Conversion timeout (>{timeout_s:g}s)")

    def one(r):
        if r[error] is not None or r[csv_path] is None:
            return failed_row(r, "ArchiveError", r[error] or "no data member")
        rel = f"{r[folder]}/{r[key]}.parquet"
        try:
            info, expired = guarded(f"convert dataset {r[key]}",
                                    lambda: convert_csv(spark, r[csv_path], f"{data_root}/{rel}", quarantine=quarantine,
                                                        rejects_dir=f"{data_root}-rejects/{rel}"))
            return timeout_row(r) if expired else ok_row(r, rel, info["renamed"], info["rejects"], info["columns"])
        except Exception as e:  # noqa: BLE001 - isolated per dataset
            return failed_row(r, type(e).__name__, str(e))

    def group(batch, header):
        try:
            staging = f"{data_root}-groups/{uuid.uuid4().hex}"
            (done, renamed, columns), expired = guarded(f"convert {len(batch)} datasets",
                                    lambda: convert_group(spark, [(r[key], r[csv_path]) for r in batch],
                                                          header, staging))
            if expired:
                raise TimeoutError("group conversion timed out")
        except Exception:  # noqa: BLE001 - fall back to one job per dataset
            return [one(r) for r in batch]
        def place(r):
            rel = f"{r[folder]}/{r[key]}.parquet"
            try:
                fs.move(spark, done[str(r[key])], f"{data_root}/{rel}")
                return ok_row(r, rel, renamed, columns=columns)
            except Exception as e:  # noqa: BLE001 - isolated per dataset
                return failed_row(r, type(e).__name__, str(e))

        # renames and sizes are metadata calls: issue them side by side
        with ThreadPoolExecutor(max_workers=8) as movers:
            return list(movers.map(place, batch))

    grouping = group_small and not quarantine
    small, singles, repeated, seen = [], [], [], set()
    for r in rows:
        if r[key] in seen:  # one dataset is converted once a run
            repeated.append(failed_row(r, "DuplicateId", f"dataset {r[key]} stands twice in the work list"))
            continue
        seen.add(r[key])
        fits = grouping and r[error] is None and r[csv_path] is not None and (r[size_bytes] or 0) <= split_threshold
        (small if fits else singles).append(r)
    if small:
        try:
            spanning = files_with_quoted_newlines(spark, [r[csv_path] for r in small])
        except Exception:  # noqa: BLE001 - an unreadable file: each dataset finds out for itself
            spanning = {r[csv_path] for r in small}
        singles += [r for r in small if r[csv_path] in spanning]
        small = [r for r in small if r[csv_path] not in spanning]
    tasks = []
    if small:
        headers = read_headers(spark, [r[csv_path] for r in small], n_tasks=workers * 2)
        by_header: dict[tuple, list] = {}
        for r in small:
            h = headers.get(r[csv_path])
            if isinstance(h, list):
                by_header.setdefault(tuple(h), []).append(r)
            else:
                singles.append(r)
        for h, members in by_header.items():
            for i in range(0, len(members), GROUP_SIZE):
                tasks.append((group, (members[i:i + GROUP_SIZE], list(h))))
    tasks += [(lambda r: [one(r)], (r,)) for r in singles]

    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        results = [row for rows_ in pool.map(lambda t: t[0](*t[1]), tasks) for row in rows_]
    return spark.createDataFrame(results + repeated, INGEST_REPORT)


def with_error_labels(report: DataFrame, max_len: int = 50) -> DataFrame:
    """Adds the short display label of each failure."""
    return report.withColumn("error_label", error_label(F.col("error_class"), F.col("error_message"), max_len))


def manifest_of(report: DataFrame) -> DataFrame:
    return report.where(F.col("status") == "ok").select([F.col(f.name) for f in MANIFEST.fields])


def ingest_summary(report: DataFrame) -> DataFrame:
    """One row: datasets converted and failed, total size in MB and GB."""
    ok = F.col("status") == "ok"
    mb = F.coalesce(F.sum(F.when(ok, F.col("size_mb"))), F.lit(0.0))
    return report.agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"),
                      mb.alias("total_mb"), (mb / F.lit(1000.0)).alias("total_gb"))
