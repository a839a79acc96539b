"""SimHash near-dedup by pigeonhole blocks.

A document's fingerprint has 64 bits: a bit is set if it is set in over half
the XXH64 hashes of its word shingles. Two fingerprints link when they differ
in at most `max_bits` bits. The 64 bits are split into `blocks` blocks; two
linked fingerprints agree in at least `blocks - max_bits` whole blocks, so
they meet under one of the choices of that many blocks. Distinct fingerprints
are joined on these block keys and the Hamming distance is verified within
each group.

Copies share a fingerprint and are merged first, so no group holds more rows
than there are distinct fingerprints; and a group's members agree in 4 of 6
blocks, which leaves 22 free bits: it has at most 2**22 members (32 MB) on
any input. A group sends one edge for each member, not its pairs. Components
are found by distributed connected components.

Null and empty texts have no words and fingerprint zero, which links like any
other. A text of fewer words than a shingle is one shingle. Rows with a null
id take part; a component's id is its smallest id that isn't null. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeshelf.llm.common import quoted, staged
from cubeshelf.llm.graph import connected_components

_LANES = np.uint64(0x0101010101010101)


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint as an unsigned 64-bit integer; 0 for no words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = [b" ".join(x) for x in zip(*(words[i:] for i in range(shingle)))]
    counts = np.zeros((8, 8), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(grams), 1 << 16):
        h = np.array([digest(g, seed) for g in grams[at:at + (1 << 16)]], dtype=np.uint64)
        starts = np.arange(0, len(h), 255)
        for s in range(8):  # eight bits at a time, summed in byte lanes of up to 255 hashes
            lanes = np.add.reduceat((h >> np.uint64(s)) & _LANES, starts)
            counts[:, s] += lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = (2 * counts.reshape(64) > len(grams)).astype(np.uint8)  # bit 8 * byte + s
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, shingle: int = 3, seed: int = 42, text_col: str = "text",
                     carry=("doc_id",)) -> DataFrame:
    """The columns `carry` of every row and `fp`, its fingerprint as a signed long."""
    src = docs.select(*[F.col(quoted(c)) for c in carry], F.col(quoted(text_col)).cast("binary").alias("text_bytes"))
    schema = src.drop("text_bytes").withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in b.column(b.num_columns - 1).to_pylist()],
                           dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps, pa.int64())], schema.names)

    return src.mapInArrow(run, schema)


def block_masks(max_bits: int, blocks: int) -> list[int]:
    """One 64-bit mask (signed) for every choice of blocks that may agree."""
    if not 0 <= max_bits < blocks <= 64:
        raise ValueError("max_bits must be under the number of blocks")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    masks = [sum(part[i] for i in kept) for kept in combinations(range(blocks), blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _near(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links (index pairs) of sorted distinct fingerprints. Small
    groups compare all members; in larger ones each member looks its few
    neighbours up, so the work stays in proportion to the group."""
    n = len(members)
    free = [1 << i for i in range(64) if np.bitwise_count((members ^ members[0]) & np.uint64(1 << i)).any()]
    flips = np.array([sum(c) for k in range(1, max_bits + 1) for c in combinations(free, k)], dtype=np.uint64)
    left, right = [], []
    if n <= max(64, len(flips)):
        step = max(1, (1 << 22) // n)
        for at in range(0, n, step):
            i, j = np.nonzero(np.bitwise_count(members[at:at + step, None] ^ members[None, :]) <= max_bits)
            left.append(i + at)
            right.append(j)
    else:
        for f in flips:
            want = members ^ f
            j = np.minimum(np.searchsorted(members, want), n - 1)
            i = np.nonzero(members[j] == want)[0]
            left.append(i)
            right.append(j[i])
    if not left:
        return np.empty(0, int), np.empty(0, int)
    i, j = np.concatenate(left), np.concatenate(right)
    return i[i < j], j[i < j]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node it is linked to, over any number of links."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[i], low[j])
        new = low.copy()
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        np.minimum.at(new, low[i], m)
        np.minimum.at(new, low[j], m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def fingerprint_links(fps: DataFrame, max_bits: int = 2, blocks: int = 6) -> DataFrame:
    """(src, dst) edges over distinct fingerprints (column `fp`) that connect
    just those within `max_bits` bits, directly or over other members."""
    if max_bits == 0:
        return fps.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).limit(0)
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in block_masks(max_bits, blocks)])
    groups = (fps.select("fp", F.posexplode(keys).alias("choice", "block"))
              .groupBy("choice", "block").agg(F.collect_list("fp").alias("members"))
              .where(F.size("members") > 1).select("members"))

    def verify(batches):
        for b in batches:
            src, dst = [], []
            values, offsets = b.column(0).values.to_numpy(zero_copy_only=False), b.column(0).offsets.to_numpy()
            for lo, hi in zip(offsets, offsets[1:]):
                m = np.sort(values[lo:hi].view(np.uint64))
                low = _forest(len(m), *_near(m, max_bits))
                at = np.nonzero(low != np.arange(len(m)))[0]
                src.append(m[at].view(np.int64))
                dst.append(m[low[at]].view(np.int64))
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src), pa.int64()),
                                                  pa.array(np.concatenate(dst), pa.int64())], ["src", "dst"])

    return groups.mapInArrow(verify, "src long, dst long")


def fingerprint_components(fps: DataFrame, max_bits: int = 2, blocks: int = 6) -> DataFrame:
    """(node, component) of the distinct fingerprints that have a link."""
    return staged(connected_components(fingerprint_links(fps, max_bits, blocks)), "fingerprint-components")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42, blocks: int = 6,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row; the component's id is the
    smallest doc_id reachable over links."""
    fp = staged(with_fingerprint(docs, shingle, seed, text_col, (id_col,)).withColumnRenamed(id_col, "doc_id"), "simhash")
    first = staged(fp.groupBy("fp").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("fp", "own"), "simhash-first")
    cc = fingerprint_components(first.select(F.col("own").alias("fp")), max_bits, blocks)
    linked = first.join(cc, F.col("own") == F.col("node"))
    lowest = staged(linked.groupBy("component").agg(F.min("first_id").alias("low")).withColumnRenamed("component", "root"),
                    "simhash-lowest")
    label = (first.join(cc, F.col("own") == F.col("node"), "left")
             .join(lowest, F.col("component") == F.col("root"), "left")
             .select("own", F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("low")).alias("component_id")))
    label = staged(label, "simhash-label")
    return fp.join(label, F.col("fp") == F.col("own")).select("doc_id", "fp", "component_id")


def fingerprint_hex(fp) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42, blocks: int = 6,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each component: the one with the smallest id
    (rows with a null id come last; of rows with one id, the first read)."""
    names = [F.col(quoted(c)) for c in docs.columns]
    own = docs.select(F.struct(*names).alias("row"), F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    own = staged(with_fingerprint(own, shingle, seed, "text", ("row", "id"))
                 .withColumn("uid", F.monotonically_increasing_id()), "simhash-rows")
    fps = staged(own.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("void"), "id", "uid")).alias("best"))
                 .withColumnRenamed("fp", "own"), "simhash-best")
    cc = fingerprint_components(fps.select(F.col("own").alias("fp")), max_bits, blocks)
    root = fps.join(cc, F.col("own") == F.col("node"), "left").select(F.coalesce("component", "own").alias("root"), "best")
    stay = staged(root.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.uid").alias("kept_uid")), "simhash-kept")
    gone = staged(own.select("uid").join(stay, F.col("uid") == F.col("kept_uid"), "left_anti")
                  .withColumnRenamed("uid", "gone_uid"), "simhash-gone")
    return own.join(gone, F.col("uid") == F.col("gone_uid"), "left_anti").select("row.*")
