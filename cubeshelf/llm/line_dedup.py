"""Line dedup: lines that stand in many documents are dropped everywhere.

1. Every text is split at line feeds; a line's key is the line stripped of
   ASCII white space at both ends, with A-Z lower-cased. Each document sends
   every distinct key once, as a 128-bit hash, with its id.
2. Copies of a (hash, id) pair are merged, then the ids of a hash are counted
   (combined before the shuffle).
3. Lines whose key reached the threshold are dropped and the others are
   joined again in their order. Up to `broadcast_rows` frequent hashes (16
   bytes each) go to the tasks as one sorted array; beyond that the hashes
   are joined to the documents that hold them.

Rows with the same id count as one document, rows without an id as none; each
row is cleaned and returned. Null and empty texts have one empty line, whose key is too short to be counted. An empty
table gives an empty result. Input columns named like a result column give
way to it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeshelf.llm.common import quoted, row_key, staged, without

#: Frequent hashes that are broadcast at most: 16 MB.
BROADCAST_ROWS = 1 << 20

_SPACE = b" \t\n\x0b\x0c\r"


def line_hash(line: bytes, min_chars: int = 1) -> bytes | None:
    """128-bit hash of a line's key; None if the key is under `min_chars`
    code points."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars or (min_chars > 1 and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _text_hashes(text: bytes | None, min_chars: int) -> list:
    return [line_hash(x, min_chars) for x in (text or b"").split(b"\n")]


def document_hashes(docs: DataFrame, min_chars: int = 1, text_col: str = "text", keyed_by: str | None = None) -> DataFrame:
    """(hash) of each distinct line key of each row; with `keyed_by`, the
    id column, also the row's key."""
    keys = row_key(keyed_by, text_col) if keyed_by else []
    src = docs.select(F.col(quoted(text_col)).cast("binary").alias("text"), *keys)
    schema = src.drop("text").selectExpr("*", "cast(null as binary) as hash").schema

    def hashes(batches):
        for b in batches:
            cols = {n: b.column(n) for n in b.schema.names if n != "text"}
            at, out = [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                found = {*_text_hashes(t, min_chars)} - {None}
                out.extend(found)
                at.extend([i] * len(found))
                if len(out) >= 200_000:
                    yield _rows(cols, at, out)
                    at, out = [], []
            yield _rows(cols, at, out)

    def _rows(cols, at, out):
        take = pa.array(at, pa.int64())
        return pa.RecordBatch.from_arrays([*(c.take(take) for c in cols.values()), pa.array(out, pa.binary())],
                                          [*cols, "hash"])

    return src.mapInArrow(hashes, schema)


def frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text",
                   id_col: str = "doc_id") -> DataFrame:
    """(hash, n_docs) of the line keys found in at least `min_docs` documents."""
    held = document_hashes(docs, min_chars, text_col, keyed_by=id_col).where(F.col("key_id").isNotNull())
    return (held.select("hash", "key_id").distinct().groupBy("hash")
            .agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= min_docs))


def _drop(docs: DataFrame, listed: DataFrame | None, frequent, min_chars: int, text_col: str) -> DataFrame:
    """Rows of `docs` with the lines dropped whose hash is in `frequent`, or
    in the row's own `drop_hashes` where `listed` carries them."""
    src = listed if listed is not None else docs
    src = src.withColumn(text_col, F.col(quoted(text_col)).cast("binary"))
    rest = [f for f in docs.schema if f.name.lower() not in (text_col.lower(), "n_lines", "n_dropped")]
    schema = docs.select(*[F.col(quoted(f.name)) for f in rest], F.col(quoted(text_col)).cast("string").alias(text_col),
                         F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")).schema

    def clean(batches):
        known = frequent.value if frequent is not None else None
        for b in batches:
            names = b.schema.names
            own = b.column(names.index("drop_hashes")).to_pylist() if known is None else None
            texts, lines, dropped = [], [], []
            for i, t in enumerate(b.column(names.index(text_col)).to_pylist()):
                parts = (t or b"").split(b"\n")
                hashes = [line_hash(x, min_chars) for x in parts]
                if known is None:
                    gone = set(own[i] or ())
                    keep = [x for x, h in zip(parts, hashes) if h not in gone]
                else:
                    a = np.array([h or b"" for h in hashes], dtype="S16")
                    hit = np.zeros(len(a), bool)
                    if len(known):
                        j = np.searchsorted(known, a)
                        hit = (j < len(known)) & (known[np.minimum(j, len(known) - 1)] == a)
                        hit &= np.array([h is not None for h in hashes])
                    keep = [x for x, y in zip(parts, hit) if not y]
                texts.append(t if len(keep) == len(parts) else b"\n".join(keep))
                lines.append(len(parts))
                dropped.append(len(parts) - len(keep))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(names.index(f.name)) for f in rest), pa.array(texts, pa.binary()).cast(pa.string()),
                 pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())],
                [*(f.name for f in rest), text_col, "n_lines", "n_dropped"])

    return src.mapInArrow(clean, schema)


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                        text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """`docs` with the frequent lines dropped from the text, and `n_lines`
    (before) and `n_dropped`. A null text that loses nothing stays null."""
    spark = docs.sparkSession
    often = staged(frequent_lines(docs, min_docs, min_chars, text_col, id_col), "frequent-lines")
    if often.count() <= broadcast_rows:
        rows = [bytes(r.hash) for r in often.select("hash").collect()]
        return _drop(docs, None, spark.sparkContext.broadcast(np.sort(np.array(rows, dtype="S16"))), min_chars, text_col)
    held = staged(document_hashes(docs, min_chars, text_col, keyed_by=id_col), "line-hashes")
    mine = (held.join(often.select("hash"), "hash").groupBy("key_id", "key_hash")
            .agg(F.collect_set("hash").alias("drop_hashes")))
    mine = staged(mine.withColumnsRenamed({"key_id": "own_id", "key_hash": "own_hash"}), "dropped-lines")
    key_id, key_hash = row_key(id_col, text_col)
    names = [F.col(quoted(c)) for c in docs.columns]
    shaped = docs.select(F.struct(*names).alias("row"), key_id, key_hash)
    listed = shaped.join(mine, F.col("key_id").eqNullSafe(F.col("own_id"))
                         & F.col("key_hash").eqNullSafe(F.col("own_hash")), "left")
    kept = without(docs, ["drop_hashes"])
    listed = listed.select(*[F.col("row." + quoted(c)).alias(c) for c in docs.select(*kept).columns], "drop_hashes")
    return _drop(docs.select(*kept), listed, None, min_chars, text_col)
