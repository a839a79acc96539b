"""Bounded-space packing of token ids into fixed-length sequences.

Every partition keeps at most `open_windows` windows open. A document's ids
(its closing id included) fill whole windows first; the rest goes to the open
window that it fits best. When none fits, the fullest window is topped up with
the head of the rest (unless it lacks `slack` ids at most) and emitted, and a
new window opens. Windows left open at the end are dealt into small buckets and
merged: they are cut at window ends, so a bucket has at most one rest, which is
cut at powers of two and needs no padding.

So a sequence is full, lacks `slack` ids at most, or has a power of two of
ids. Each id lies in exactly one piece.

Null texts count as empty ones: only the closing id. Ids and texts may repeat;
every row is packed. An empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import json
import struct
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cubeshelf.llm.common import quoted, staged

CAPACITY, OPEN_WINDOWS, SLACK, CACHE_WORDS, LEFT_PER_BUCKET = 4096, 32, 32, 300_000, 64
PART_BYTES = 16 << 20  # of text encoded at once

# Words of these letters alone are one token run, whatever stands around them.
_MARKS = ".,;:!?"
_PLAIN = f"^[A-Za-zÀ-ÖØ-öø-ÿ]+[{_MARKS}]*$"


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: printable
    ones stand for themselves, the others for letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(other)) for b in range(256)]


class Encoder:
    """Token ids of whole texts, by a tokenizer that drops white space.

    A text is the sequence of its runs between ASCII blanks, so the distinct
    runs of many texts are encoded once and their ids dealt back; those of
    words and other runs are kept (up to `CACHE_WORDS`, then the store starts anew).
    `by_word`: the vocabulary lower-cases and reads words one by one; plain
    words then skip the tokenizer's text normalisation."""

    def __init__(self, spec: str):
        self.full = Tokenizer.from_str(spec)
        self.model = self.full.model
        made = json.loads(spec)
        norms = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers", [])]
        self.by_word = norms == ["NFC", "Replace", "Lowercase"] and made["model"].get("end_of_word_suffix") == "</w>"
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _ids(self, ids) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _whole(self, text: str) -> bytes:
        return self._ids(self.full.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        out = self.words.get(word)
        if out is None:
            shown = word if word.isascii() else "".join(self.letters[b] for b in word.encode())
            out = self._ids([t.id for t in self.model.tokenize(shown)])
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = out
        return out

    def _other(self, run: str) -> bytes:
        out = self.runs.get(run)
        if out is None:
            out = self._whole(run)
            if len(run) <= 64:
                if len(self.runs) >= CACHE_WORDS:
                    self.runs.clear()
                self.runs[run] = out
        return out

    def _distinct(self, values: pa.Array, ids) -> pa.Array:
        """The ids of each value, those of a distinct one made once."""
        coded = values.dictionary_encode()
        return pa.array(map(ids, coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)

    def _runs(self, runs: pa.Array) -> pa.Array:
        """The ids of runs that are all distinct."""
        plain = pc.match_substring_regex(runs, _PLAIN)
        those = runs.filter(plain)
        words = self._distinct(pc.utf8_lower(pc.utf8_rtrim(those, _MARKS)), self._word)
        tails = self._distinct(pc.replace_substring_regex(those, f"^[^{_MARKS}]+", ""), self._other)
        others = pa.array(map(self._other, runs.filter(pc.invert(plain)).to_pylist()), pa.large_binary())
        made = pa.concat_arrays([pc.binary_join_element_wise(words, tails, pa.scalar(b"", pa.large_binary())), others])
        plain = plain.to_numpy(zero_copy_only=False)
        place = np.where(plain, np.cumsum(plain) - 1, len(those) + np.cumsum(~plain) - 1)
        return made.take(pa.array(place))

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if not self.by_word:
            return [self._whole(t) for t in texts.to_pylist()]
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        ids = self._runs(coded.dictionary).take(coded.indices)
        _, offsets, data = ids.buffers()
        at = split.offsets.to_numpy().astype(np.int64)
        ends = np.frombuffer(offsets, np.int64)[ids.offset + at - at[0]].tolist()
        data = memoryview(data or b"")
        return [data[x:y].tobytes() for x, y in zip(ends, ends[1:])]


def _parts(b: pa.RecordBatch, most: int):
    """A batch's rows in slices of about `most` bytes of text."""
    upto = np.cumsum(np.asarray(pc.binary_length(b.column(1)), np.int64))
    at = 0
    while at < b.num_rows:
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
        yield b.slice(at, end - at)
        at = end


class _Window:
    def __init__(self, number: int):
        self.number, self.used, self.pieces = number, 0, []


class Packer:
    """Packs documents one after another; `closed` gathers finished windows."""

    def __init__(self, capacity: int, open_windows: int, slack: int, first: int):
        self.capacity, self.most, self.slack, self.next = capacity, open_windows, slack, first
        self.open: list[_Window] = []
        self.closed: list[_Window] = []

    def _new(self) -> _Window:
        self.next += 1
        return _Window(self.next - 1)

    def _put(self, w: _Window, doc, ids: bytes, start: int, length: int, total: int) -> None:
        w.pieces.append((doc, start, length, ids[4 * start:4 * (start + length)], total, w.number, w.used))
        w.used += length

    def add(self, doc, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        while start < total:
            rest = total - start
            if rest >= self.capacity:
                w = self._new()
                self._put(w, doc, ids, start, self.capacity, total)
                self.closed.append(w)
                start += self.capacity
                continue
            fit = max((w for w in self.open if w.used + rest <= self.capacity), key=lambda w: w.used, default=None)
            if fit is None and len(self.open) >= self.most:
                full = max(self.open, key=lambda w: w.used)
                gap = self.capacity - full.used
                if gap > self.slack:
                    self._put(full, doc, ids, start, gap, total)
                    start += gap
                self.open.remove(full)
                self.closed.append(full)
                continue
            if fit is None:
                fit = self._new()
                self.open.append(fit)
            self._put(fit, doc, ids, start, rest, total)
            start = total
            if fit.used == self.capacity:
                self.open.remove(fit)
                self.closed.append(fit)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _merge(batches, capacity: int, schema: pa.Schema):
    """Leftover pieces, bucket by bucket, into full sequences and one rest in powers of two."""
    queue, held, bucket, number = deque(), 0, None, 0

    def take(n):
        nonlocal held, number
        out, used = [], 0
        while used < n:
            doc, start, length, ids, total = queue.popleft()
            if length > n - used:
                cut = n - used
                queue.appendleft((doc, start + cut, length - cut, ids[4 * cut:], total))
                length, ids = cut, ids[:4 * cut]
            out.append((doc, start, length, ids, total, (1 << 62) | (bucket << 24) | number, used))
            used += length
        held -= n
        number += 1
        return out

    def rest():
        out = []
        for p in reversed(range(held.bit_length())):
            if held >> p & 1:
                out += take(1 << p)
        return out

    for b in batches:
        out = []
        for doc, start, length, ids, total, at in zip(*(c.to_pylist() for c in b.columns)):
            if at != bucket:
                out += rest()
                bucket, number = at, 0
            queue.append((doc, start, length, ids, total))
            held += length
            while held >= capacity:
                out += take(capacity)
        yield _batch(out, schema)
    yield _batch(rest(), schema)


def pack(docs: DataFrame, tokenizer_file: str, end_id: int = 2, capacity: int = CAPACITY,
         open_windows: int = OPEN_WINDOWS, slack: int = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): the
    pieces of every row. `ids` are little-endian unsigned 32-bit integers;
    `tokenizer_file` is read on the driver and sent to the tasks."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    end = end_id.to_bytes(4, "little")
    src = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"))
    names = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    schema = src.select("doc_id", *[F.lit(None).cast(t).alias(n) for n, t in (x.split() for x in names.split(", "))]).schema
    with_state = src.select("doc_id").schema.add("start", "long").add("length", "long").add("ids", "binary") \
        .add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long").add("left", "boolean")

    def place(batches):
        enc = Encoder(spec.value)
        packer = Packer(capacity, open_windows, slack, TaskContext.get().partitionId() << 32)
        shape = None
        for b in batches:
            shape = shape or _arrow(b.schema.field("doc_id").type, True)
            for part in _parts(b, PART_BYTES):
                for doc, ids in zip(part.column(0).to_pylist(), enc.encode_all(part.column(1))):
                    packer.add(doc, ids + end)
                    if len(packer.closed) >= 1000:
                        yield _batch([(*p, False) for w in packer.closed for p in w.pieces], shape)
                        packer.closed = []
        if shape:
            yield _batch([(*p, left) for ws, left in ((packer.closed, False), (packer.open, True)) for w in ws for p in w.pieces], shape)

    placed = staged(src.mapInArrow(place, with_state), "packed")
    left = placed.where("left")
    n = left.select("sequence_id").distinct().count()
    whole = placed.where(~F.col("left")).drop("left")
    if not n:
        return whole
    buckets = -(-n // LEFT_PER_BUCKET)
    dealt = (left.withColumn("bucket", F.pmod(F.xxhash64("sequence_id"), F.lit(buckets))).repartition(buckets, "bucket")
             .sortWithinPartitions("bucket", "sequence_id", "offset")
             .select("doc_id", "start", "length", "ids", "doc_tokens", "bucket"))

    def merge(batches):
        first = next(batches, None)
        if first is not None:
            def every():
                yield first
                yield from batches
            yield from _merge(every(), capacity, _arrow(first.schema.field("doc_id").type, False))

    return whole.union(dealt.mapInArrow(merge, schema))


def _arrow(id_type, state: bool) -> pa.Schema:
    fields = [("doc_id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
              ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    return pa.schema(fields + [("left", pa.bool_())] * state)
