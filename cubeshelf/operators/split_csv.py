"""A CSV file whose quoted values hold newlines, read by many tasks.

A newline inside quotes ends no record, and whether a byte is inside quotes
depends on all bytes before it. So the file is scanned in byte ranges that
begin behind a newline: there a range starts either at a record (outside) or
inside quotes. Each range tells for both cases where it ends and where its first record begins; a
running composition over the ranges, in order, gives each one's true case. That
yields cut points that are record starts, and every stretch between two of
them is read and parsed on its own.

Quotes count as the CSV reader counts them: one opens a value only at its
first character, a doubled one inside is a quote, and one in the middle of an
unquoted value is text.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, ship_package
from ..sources import fs

RANGE_BYTES = 64 * 1024 * 1024  # held by a task at once

_QUOTE, _NEWLINE, _COMMA = 0x22, 0x0A, 0x2C
# One value and what ends it; a closing quote followed by text goes on as text.
_VALUE = re.compile(rb'(?:"(?:[^"]|"")*(?:"|\Z)[^,\n]*|[^",\n][^,\n]*)?(?:[,\n]|\Z)')
_INSIDE = re.compile(rb'(?:[^"]|"")*(?:"[^,\n]*(?:[,\n]|\Z)|\Z)')


def record_ends(data: bytes, inside: bool) -> tuple[np.ndarray, bool]:
    """Positions of the newlines in `data` that end a record, and whether its
    end is inside quotes. `inside`: whether its start is."""
    raw = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(raw == _QUOTE)
    newlines = np.flatnonzero(raw == _NEWLINE)
    # As long as every quote that opens stands at the start of a value, or right
    # behind the one that has just closed, quotes simply alternate.
    opens = quotes[int(inside)::2]
    before = raw[opens - 1]
    fits = (opens == 0) | (before == _COMMA) | (before == _NEWLINE) | (before == _QUOTE)
    if fits.all():
        in_quotes = (np.searchsorted(quotes, newlines) + int(inside)) % 2 == 1
        return newlines[~in_quotes], (len(quotes) + int(inside)) % 2 == 1
    return _walked(data, inside)


def _walked(data: bytes, inside: bool) -> tuple[np.ndarray, bool]:
    """The same, value by value."""
    ends, at = [], 0
    if inside:
        m = _INSIDE.match(data)
        at = m.end()
        if at == len(data) and not _closed(data, 0, at, True):
            return np.empty(0, np.int64), True
        if data[at - 1:at] == b"\n":
            ends.append(at - 1)
    while at < len(data):
        m = _VALUE.match(data, at)
        if m.end() == len(data) and not _closed(data, at, m.end(), False):
            return np.array(ends, np.int64), True
        at = m.end()
        if data[at - 1:at] == b"\n":
            ends.append(at - 1)
    return np.array(ends, np.int64), False


def _closed(data: bytes, at: int, end: int, inside: bool) -> bool:
    """Whether the value data[at:end], the last one, has its quotes closed."""
    if not inside:
        if data[at:at + 1] != b'"':
            return True
        at += 1
    while True:
        at = data.find(b'"', at, end)
        if at < 0:
            return False
        if data[at + 1:at + 2] != b'"' or at + 1 >= end:
            return True
        at += 2


def _next_line(f, at: int, size: int) -> int:
    """The place behind the first newline at `at` - 1 or later; `size` if none."""
    if at <= 0:
        return 0
    at -= 1
    step = 1 << 12  # most lines end soon; a long one is read in longer blocks
    while at < size:
        block = f.read_at(min(step, size - at), at)
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)
        step = min(4 * step, 1 << 20)
    return size


def _dealt(spark: SparkSession, rows: DataFrame, size) -> DataFrame:
    """Ranges or stretches dealt to tasks: one each while they are few, else
    several, of RANGE_BYTES together at most on average. `size`: a row's bytes."""
    n, held = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    few = max(4 * spark.sparkContext.defaultParallelism, -(-held // RANGE_BYTES))
    return rows.repartition(max(1, min(n, few)))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of a file, or of the data files of a folder."""
    f, p = fs._fs(spark, path)
    if f.getFileStatus(p).isFile():
        return spark.createDataFrame([(path, int(f.getFileStatus(p).getLen()))], "path string, length long")
    files = fs.landed_files(spark, path).where(~F.substring_index("rel_path", "/", -1).rlike("^[_.]"))
    return files.select(F.concat(F.lit(path.rstrip("/") + "/"), "rel_path").alias("path"), "length")


def stretches(spark: SparkSession, csv_path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, start, stop): whole records, in stretches of about `range_bytes`;
    `start` 0 holds the header. One row for each range, none of its text."""
    ship_package(spark)
    files = _files(spark, csv_path).where(F.col("length") > 0)
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.expr(f"(length - 1) div {range_bytes}"))).alias("i"))

    def scan(batches):
        import pandas as pd

        from cubeshelf.operators.split_csv import _next_line, record_ends
        from cubeshelf.sources.paths import open_fs
        at = {}
        for pdf in batches:
            out = []
            for path, length, i in zip(pdf["path"], pdf["length"], pdf["i"]):
                if path not in at:
                    at = {path: open_fs(path)}
                where, rel = at[path]
                with where.open_input_file(rel) as f:
                    start, stop = (_next_line(f, min(k * range_bytes, length), length) for k in (i, i + 1))
                    data = f.read_at(stop - start, start)
                ends_out, in_out = record_ends(data, False)
                ends_in, in_in = record_ends(data, True)
                out.append((path, int(length), int(i), in_out, in_in, start if data else None,
                            start + int(ends_in[0]) + 1 if len(ends_in) and start + int(ends_in[0]) + 1 < stop else None))
            yield pd.DataFrame(out, columns=["path", "length", "i", "end_outside", "end_inside", "first_outside", "first_inside"]).astype(
                {"first_outside": "Int64", "first_inside": "Int64"})

    bytes_of = F.least(F.lit(range_bytes), F.col("length") - F.col("i") * range_bytes)
    told = _dealt(spark, ranges, bytes_of).mapInPandas(scan, "path string, length long, i long, end_outside boolean, end_inside boolean, "
                                                   "first_outside long, first_inside long")
    # A range either ends alike in both cases, which settles what comes behind it,
    # or turns the case round, or leaves it.
    earlier = Window.partitionBy("path").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    settles = F.col("end_outside") == F.col("end_inside")
    turns = F.when(~settles & F.col("end_outside"), 1).otherwise(0)
    told = told.withColumn("turned", F.sum(turns).over(upto))
    told = told.withColumn("mark", F.when(settles, (F.col("end_outside").cast("int") + F.col("turned")) % 2))
    told = told.withColumn("case", (F.coalesce(F.last("mark", ignorenulls=True).over(earlier), F.lit(0))
                                    + F.coalesce(F.sum(turns).over(earlier), F.lit(0))) % 2)
    told = told.withColumn("start", F.when(F.col("case") == 1, F.col("first_inside")).otherwise(F.col("first_outside")))
    # From the end on, as a frame that reaches to the end is gone through anew for every row.
    later = Window.partitionBy("path").orderBy(F.col("i").desc()).rowsBetween(Window.unboundedPreceding, -1)
    told = told.withColumn("stop", F.coalesce(F.last("start", ignorenulls=True).over(later), F.col("length")))
    return told.where(F.col("start").isNotNull()).select("path", "start", "stop")


def read_records(spark: SparkSession, csv_path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(record): the text of every record but the headers (the first record of
    each file); lines of blanks are none. A task reads its stretches one
    after the other."""
    cut = materialize(stretches(spark, csv_path, range_bytes), "csv-stretches")  # a lost executor must not move a cut

    def read(batches):
        import numpy as np
        import pyarrow as pa

        from cubeshelf.operators.split_csv import record_ends
        from cubeshelf.sources.paths import open_fs
        at = {}
        for b in batches:
            for path, start, stop in zip(*(c.to_pylist() for c in b.columns)):
                if path not in at:
                    at = {path: open_fs(path)}
                where, rel = at[path]
                with where.open_input_file(rel) as f:
                    data = f.read_at(stop - start, start)
                ends, _ = record_ends(data, False)
                edges = np.concatenate([[0], ends + 1, [len(data)] if not len(ends) or ends[-1] + 1 < len(data) else []]).astype(np.int64)
                if start == 0:
                    edges = edges[1:]
                for lo in range(0, len(edges) - 1, 20_000):
                    some = edges[lo:lo + 20_001]
                    rows = [data[x:y].removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace") for x, y in zip(some, some[1:])]
                    # as the line reader: blank down to control characters
                    yield pa.RecordBatch.from_arrays([pa.array([r for r in rows if r.strip(_BLANKS)], pa.string())], ["record"])

    return _dealt(spark, cut, F.col("stop") - F.col("start")).mapInArrow(read, "record string")


_BLANKS = "".join(map(chr, range(33)))


def read_all_string(spark: SparkSession, csv_path: str, names: list[str], options: dict, quarantine: bool = False,
                    range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every column as STRING under `names`, as `convert.read_all_string`, from many tasks."""
    opts = {k: v for k, v in options.items() if k in ("quote", "escape")}
    if quarantine:
        names = [*names, "_corrupt_record"]
        opts |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    else:
        opts["mode"] = "FAILFAST"
    parsed = F.from_csv("record", ", ".join(f"`{n}` STRING" for n in names), opts)
    return read_records(spark, csv_path, range_bytes).select(parsed.alias("r")).select("r.*")
