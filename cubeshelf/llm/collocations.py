"""Phrase collocations by dynamic itemset counting.

The corpus is cut into `shards`. Step t scans shard t modulo their number and
counts, in one pass, phrases of all lengths that are active then. Words are
active from the first step. A phrase becomes active in the step after both of
its subphrases (without its last, without its first word) have reached
`least` occurrences, wherever the scan stands then, and stays active until it
has seen every shard once; so each count is exact. The scan ends when no
phrase is active any more.

A phrase travels as the 64-bit hash of its language and words. A task
sends its chunks' counts as sorted runs cut by hash range; a task meets a range
of all chunks with the totals so far. Complete phrases under `least` leave the
totals. Which phrases reached `least`, and when, goes to the tasks as one
array over the top `filter_bits` bits of the hash (one byte each, 16 MB), the
same at any size of the corpus: phrases that share a cell can only activate
too much, which costs counting, never a count.

The totals remember one chunk for each phrase; the texts of the frequent
phrases are read there at the end, each once. Scores, cuts and containment are then joins over frequent phrases; products are exact
decimals.

Null texts are empty, a null language is `und`; every row counts, also
repeated ones. No words give no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeshelf.llm import runs
from cubeshelf.llm.common import quoted, staged

CHUNK_BYTES, SHARDS, FILTER_BITS, LEAST, LONGEST = 8 << 20, 4, 24, 100, 5
RANGE_TOKENS = 1 << 20  # tokens of the corpus for each hash range; from 2**32 tokens on, ranges grow
RUN_ENTRIES = 1 << 21  # a task sends its chunks' counts as one run when it holds so many

_BREAK, _FIRST = 1, 2  # codes: end of a piece, first word
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_KINDS = ["<u8", "<u8", "<u2", "<u8"]  # hash, count, 8 * first active step + words, a chunk that holds it


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _coded(texts: list[bytes | None]) -> tuple[bytes, int]:
    """Texts as numbers of their words, pieces ended by `_BREAK`; and the number of words."""
    number = _Numbers({b"": 0, b"\n": _BREAK})
    get, parts = number.__getitem__, []
    for t in texts:
        words = (t or b"").translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
        parts.append(np.fromiter(map(get, words), "<i4", len(words)))
        parts.append(np.array([_BREAK], "<i4"))
    codes = np.concatenate(parts)
    codes = codes[codes > 0]
    codes = codes[np.concatenate([[True], (codes[1:] > _BREAK) | (codes[:-1] > _BREAK)])]
    packed = runs.pack([codes])
    return len(packed).to_bytes(4, "little") + packed + pa.compress(b" ".join([*number][_FIRST:]), codec="zstd", asbytes=True) \
        + sum(map(len, number)).to_bytes(8, "little") + (len(number) - _FIRST).to_bytes(8, "little"), int((codes > _BREAK).sum())


def _decoded(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    size, chars, n = (int.from_bytes(x, "little") for x in (blob[:4], blob[-16:-8], blob[-8:]))
    codes, = runs.unpack(blob[4:4 + size], ["<i4"])
    if not n:
        return codes, []
    raw = pa.decompress(blob[4 + size:-16], decompressed_size=chars - 1 + n - 1, codec="zstd", asbytes=True)
    return codes, raw.split(b" ")


def coded_chunks(docs: DataFrame, shards: int, chunk_bytes: int) -> DataFrame:
    """(shard, chunk, lang, blob, n): chunks, in one row for each language, and
    their words. `docs`: (lang, text as binary)."""
    def run(batches):
        part, made, held, size = TaskContext.get().partitionId(), 0, {}, 0

        def flush():
            rows = [((part + made) % shards, part << 24 | made, lang, *_coded(texts)) for lang, texts in held.items()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.int64()))],
                                              ["shard", "chunk", "lang", "blob", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                size += len(text or b"") + 1
                if size >= chunk_bytes:
                    yield flush()
                    held, size, made = {}, 0, made + 1
        if held:
            yield flush()

    return docs.mapInArrow(run, "shard int, chunk long, lang string, blob binary, n long")


class _Scan:
    """One chunk, level by level: hashes of its windows and the step from which each is active."""

    def __init__(self, lang: str, blob: bytes, since: np.ndarray, longest: int):
        self.codes, self.words = _decoded(blob)
        self.since, self.longest = since, longest
        own = runs.hashed(self.words, xxhash.xxh64_intdigest(lang.encode()) & 0x7FFFFFFF)
        self.hash = np.concatenate([np.zeros(_FIRST, np.uint64), own])[self.codes]
        self.shift = np.uint64(64 - (len(since).bit_length() - 1))

    def levels(self):
        """(words, starts of windows, hashes, first active steps) of lengths 2 and more whose parts are frequent."""
        h = self.hash
        reached = self.since[h >> self.shift]
        reached[self.codes <= _BREAK] = 0
        for k in range(2, self.longest + 1):
            at = np.flatnonzero((reached[:-1] > 0) & (reached[1:] > 0))
            if not len(at):
                return
            first = np.maximum(reached[at], reached[at + 1]).astype(np.uint16) + 1
            got = runs.mixed(h[at], self.hash[at + k - 1])
            yield k, at, got, first
            h, reached = np.zeros_like(h), np.zeros_like(reached)
            # A shared cell may be set before the phrase itself was counted.
            own = self.since[got >> self.shift]
            h[at], reached[at] = got, np.where(own > 0, np.maximum(own, first), 0)

    def phrase(self, at: int, k: int) -> bytes:
        return b" ".join(self.words[c - _FIRST] for c in self.codes[at:at + k])


def _counts(scan: _Scan, step: int, shards: int) -> list[np.ndarray]:
    """The chunk's (hash, count, tag) of the phrases that are active in this step."""
    found = [(np.empty(0, np.uint64), np.empty(0, "<u8"), np.empty(0, "<u2"))]
    if step <= shards and scan.words:
        n = np.bincount(scan.codes, minlength=_FIRST + len(scan.words))
        hashes = np.zeros(len(n), np.uint64)
        hashes[scan.codes] = scan.hash
        found.append((hashes[_FIRST:], n[_FIRST:].astype("<u8"), np.full(len(n) - _FIRST, 8 + 1, "<u2")))
    for k, _, got, first in scan.levels():
        live = (first <= step) & (step < first + shards)
        h, at, n = np.unique(got[live], return_index=True, return_counts=True)
        found.append((h, n.astype("<u8"), (first[live][at] * 8 + k).astype("<u2")))
    return [np.concatenate(x) for x in zip(*found)]


def frequent(chunks: DataFrame, total: int, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS,
             filter_bits: int = FILTER_BITS) -> DataFrame:
    """(lang, phrase, words, a) of every phrase of up to `longest` words with
    `least` occurrences or more."""
    if not 1 <= shards * (longest + 1) < 250 or longest > 7:
        raise ValueError("too many steps")
    spark = chunks.sparkSession
    bits = runs.ranges(total, RANGE_TOKENS)
    since, step, last = np.zeros(1 << filter_bits, np.uint8), 0, 0
    state = spark.createDataFrame([], "cut long, old boolean, blob binary")

    def broadcast():
        return spark.sparkContext.broadcast(pa.compress(since.tobytes(), codec="zstd", asbytes=True))

    def filter_of(sent):
        return np.frombuffer(pa.decompress(sent.value, decompressed_size=1 << filter_bits, codec="zstd", asbytes=True), np.uint8)

    def scanned(sent, now):
        def sorted_run(held):
            h, n, tag, source = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            h, n, tag, source = h[order], n[order], tag[order], source[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            run = [h[first], np.add.reduceat(n, first), tag[first], source[first]]
            tops, at = runs.cuts(run[0], 64 - bits)
            blobs = [runs.pack_sorted([c[i:j] for c in run]) for i, j in zip(at, at[1:])]
            return pa.RecordBatch.from_arrays([pa.array(tops, pa.int64()), pa.array([False] * len(tops), pa.bool_()), pa.array(blobs, pa.binary())],
                                              ["cut", "old", "blob"])

        def run(batches):
            reached, held, size = filter_of(sent), [], 0
            for b in batches:
                for chunk, lang, blob in zip(*(c.to_pylist() for c in b.columns)):
                    got = _counts(_Scan(lang, blob, reached, longest), now, shards)
                    if len(got[0]):
                        held.append([*got, np.full(len(got[0]), chunk, "<u8")])
                        size += len(got[0])
                    if size >= RUN_ENTRIES:
                        yield sorted_run(held)
                        held, size = [], 0
            if held:
                yield sorted_run(held)
        return run

    def merged(now):
        def run(cut, rows):
            parts = [[*runs.unpack_sorted(blob, _KINDS), old] for old, blob in rows]
            h, n, tag, source = (np.concatenate(x) for x in list(zip(*parts))[:4])
            if not len(h):  # all that the range held was complete and rare
                return
            old = np.concatenate([np.full(len(p[0]), p[4]) for p in parts])
            order = np.argsort(h, kind="stable")
            h, n, tag, source, old = h[order], n[order], tag[order], source[order], old[order]
            at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            count, before = np.add.reduceat(n, at), np.add.reduceat(n * old, at)
            h, tag, source = h[at], tag[at], source[at]
            new = h[(count >= least) & (before < least) & ((tag & 7) < longest)]
            cells = np.unique(new >> np.uint64(64 - filter_bits)).astype("<u4")
            keep = (count >= least) | (now < (tag >> 3).astype(int) + shards - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([cut], pa.int64()), pa.array([True]), pa.array([runs.pack_sorted([h[keep], count[keep], tag[keep], source[keep]])], pa.binary()),
                 pa.array([cells.tobytes()], pa.binary())], ["cut", "old", "blob", "cells"])
        return run

    # Over shared cells a phrase may activate a longer one only when it is active itself: a step later for each length.
    while step < last + shards + max(0, longest - 2):
        step += 1
        sent = broadcast()
        rows = chunks.where(F.col("shard") == (step - 1) % shards).select("chunk", "lang", "blob").mapInArrow(scanned(sent, step), "cut long, old boolean, blob binary")
        got = staged(runs.met(rows.union(state), "cut", "cut long, old boolean, blob binary, cells binary", merged(step)), f"phrases-{step}")
        state = got.select("cut", "old", "blob")
        # At most one number for each cell of the filter.
        for r in got.where(F.length("cells") > 0).select("cells").collect():
            cells = np.frombuffer(r.cells, "<u4")
            since[cells[since[cells] == 0]] = step
            last = step
        sent.unpersist()

    def counted(batches):
        for b in batches:
            for blob in b.column(0).to_pylist():
                h, n, tag, source = runs.unpack_sorted(blob, _KINDS)
                enough = n >= least
                yield pa.RecordBatch.from_arrays([pa.array(h[enough].view(np.int64)), pa.array(n[enough].astype(np.int64)),
                                                  pa.array((tag[enough] & 7).astype(np.int32)), pa.array(source[enough].view(np.int64))],
                                                 ["h", "a", "words", "chunk"])

    sent = broadcast()

    def named(left: pa.Table, right: pa.Table) -> pa.Table:
        """The texts of the phrases that are to be read from this chunk."""
        reached, wanted = filter_of(sent), np.sort(right.column("h").to_numpy().view(np.uint64))
        hashes, langs, texts = [np.empty(0, np.uint64)], [], []
        for lang, blob in zip(left.column("lang").to_pylist(), left.column("blob").to_pylist()):
            scan = _Scan(lang, blob, reached, longest)
            words, at = np.unique(scan.hash, return_index=True)
            for k, at, got in [(1, at, words), *((k, at, got) for k, at, got, _ in scan.levels())]:
                here = np.flatnonzero(np.isin(got, wanted))
                h, first = np.unique(got[here], return_index=True)
                hashes.append(h)
                texts.extend(scan.phrase(i, k) for i in at[here[first]])
                langs.extend([lang] * len(h))
        return pa.Table.from_arrays([pa.array(np.concatenate(hashes).view(np.int64)), pa.array(langs, pa.string()),
                                     pa.array(texts, pa.binary()).cast(pa.string())], ["g", "lang", "phrase"])

    counts = staged(state.select("blob").mapInArrow(counted, "h long, a long, words int, chunk long"), "phrase-counts")
    names = (chunks.select("chunk", "lang", "blob").groupBy("chunk").cogroup(counts.select("h", "chunk").groupBy("chunk"))
             .applyInArrow(named, "g long, lang string, phrase string"))
    return counts.join(names, F.col("h") == F.col("g")).select("lang", "phrase", "words", "a")


def _part(first: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.col("w"), first, length), " ")


def scored(phrases: DataFrame, totals: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more,
    by their lowest cut, without those that a longer one always holds."""
    w = phrases.where("words >= 2").withColumn("w", F.split("phrase", " "))
    ends = F.array(_part(F.lit(1), F.col("words") - 1), _part(F.lit(2), F.col("words") - 1))
    longer = (w.where("words >= 3").select("lang", F.explode(ends).alias("inner"), "a")
              .groupBy(F.col("lang").alias("in_lang"), "inner").agg(F.max("a").alias("longer")))
    w = (w.join(longer, (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("inner")), "left")
         .where(F.col("longer").isNull() | (F.col("longer") < F.col("a"))))
    cut = w.select("lang", "phrase", "a", "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"),
                     _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    side = lambda name, n: phrases.select(F.col("lang").alias(name + "_lang"), F.col("phrase").alias(name + "_text"), F.col("a").alias(n))
    cut = cut.join(side("l", "l"), (F.col("lang") == F.col("l_lang")) & (F.col("left") == F.col("l_text")))
    cut = cut.join(side("r", "r"), (F.col("lang") == F.col("r_lang")) & (F.col("right") == F.col("r_text")))
    cut = cut.join(totals.select(F.col("lang").alias("n_lang"), "n"), F.col("lang") == F.col("n_lang"))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.select("lang", "phrase", "a", "k", "l", "r", "n", (whole("a") * whole("n")).alias("an"), (whole("l") * whole("r")).alias("lr"))
    cut = cut.withColumn("score", F.expr("(an * cast(1000 as decimal(4,0))) div lr"))
    best = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    return best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = 2000, shards: int = SHARDS,
                 filter_bits: int = FILTER_BITS, chunk_bytes: int = CHUNK_BYTES, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's `top` phrases
    by score, then a, then phrase."""
    src = docs.select(F.coalesce(F.col(quoted(lang_col)).cast("string"), F.lit("und")).alias("lang"),
                      F.col(quoted(text_col)).cast("binary").alias("text"))
    chunks = staged(coded_chunks(src, shards, chunk_bytes), "phrase-chunks", by="shard")
    totals = staged(chunks.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    phrases = staged(frequent(chunks, total, least, longest, shards, filter_bits), "phrases")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(phrases, totals, longest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
