"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and how often.

A text is encoded by a byte-level BPE (A, a leading space added) and by a
sentence-piece BPE (B, which adds it itself). Byte offsets where tokens of both end cut it
into groups; the A and the B token that end there are linked. How many links
of the corpus hold an id pair is counted externally:

1. Encoding. Every text is encoded whole by both tokenizers. (A's merges are
   looked up as ranks where that gives the same ids; texts with a word or a run
   of blanks over 500 characters go through the tokenizer itself.)
2. Runs. A task gathers pair-document records up to `chunk_links` links, sorts
   them by pair, B id first, and writes for each of `radixes` remainders of
   the B id one compressed run: the chunk's pairs and their links. The chunk's
   documents, with their links as places in its pair list, are written once.
3. Merge. One task meets all runs of a remainder and merges them by a heap
   over the runs. A pair's records follow each other, so it is counted
   on the way; a B id's pairs follow each other, so its highest count is known
   when it ends, and the contributions to each run (count, highest or not) are
   put out in the run's order. Only one B id is held at a time, and a frequent
   one has at most one record for each pair and chunk.
4. Each chunk's contributions return to its documents and are added up.

Texts that are null, empty, or whose tokens don't give the bytes of a space
and the text have no tokens. Every row is encoded, also repeated ones. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from heapq import merge

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cubeshelf.llm import runs
from cubeshelf.llm.common import quoted, staged
from cubeshelf.llm.packing import _byte_letters

CHUNK_LINKS, RADIXES = 4 << 20, 256

# Where a byte-level tokenizer of this kind cuts a text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_MARK = "▁"


def _by_rank(spec: dict) -> tiktoken.Encoding | None:
    """The same merges as a rank table, which encodes faster; None unless a
    token's id tells when it is merged and texts are cut by the usual pattern."""
    vocab, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"].get("merges", [])]
    cut = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space"):
        return None
    order = [vocab["".join(m)] for m in merges]
    if order != sorted(set(order)) or min(order, default=256) < 256 or len(vocab) - len(order) not in (256, 257):
        return None
    byte_of = {c: bytes([i]) for i, c in enumerate(_byte_letters())}
    single = {byte_of[t]: i for t, i in vocab.items() if t in byte_of}
    ranks = single | {b"".join(byte_of[c] for c in "".join(m)): i for m, i in zip(merges, order)}
    return tiktoken.Encoding("merges", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Aligner:
    """Both tokenizers, and what they say about texts."""

    def __init__(self, byte_bpe: bytes, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(byte_bpe.decode())
        self.a.encode_special_tokens = True
        self.fast = _by_rank(json.loads(byte_bpe))
        self.b = SentencePieceProcessor(model_proto=pieces)
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_size = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.a_size[i] = len(token)  # one character for each byte
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # An id as it stands in the groups' text: inside a group, then at its end.
        self.a_text = np.array([f"{i}," for i in range(len(self.a_size))] + [f"{i}|" for i in range(len(self.a_size))], object)
        self.b_text = np.array([f"{i}," for i in range(len(self.b_size))] + [f"{i};" for i in range(len(self.b_size))], object)

    def _a_ids(self, text: str) -> list[int]:
        words = text.split()
        # Ranks take a time that grows with the square of one word or run of blanks.
        if self.fast is None or max(map(len, words), default=0) > 500 or len(text) - sum(map(len, words)) - len(words) > 500:
            return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return self.fast.encode_ordinary(text)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Both ids of a text; None where it has no tokens."""
        if not text:
            return None
        raw = (" " + text).encode()
        b = self.b.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        a = np.array(self._a_ids(" " + text), np.int64)
        return (a, np.array(b, np.int64)) if self.a_size[a].sum() == len(raw) else None

    def align(self, texts: list[str | None]) -> list[tuple[int, int, str, np.ndarray]]:
        """(A tokens, B tokens, digest of the groups, linked pairs) of each text."""
        found = [self.tokens(t) for t in texts]
        kept = [x for x in found if x is not None]
        if not kept:
            return [_NOTHING] * len(texts)
        a, b = (np.concatenate(x) for x in zip(*kept))
        upto_a, upto_b = (np.cumsum([len(x[i]) for x in kept]) for i in (0, 1))
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        at = np.zeros(end_a[-1] + 1, bool)
        at[end_b] = True
        last_a = at[end_a]
        at[:] = False
        at[end_a] = True
        last_b = at[end_b]
        at_a, at_b = np.flatnonzero(last_a), np.flatnonzero(last_b)  # the linked tokens, group by group
        codes = b[at_b].astype(np.uint64) << np.uint64(32) | a[at_a].astype(np.uint64)
        # Each group's A ids, then its B ids.
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        words = np.empty(len(a) + len(b), object)
        words[np.arange(len(a)) + np.concatenate([[0], at_b + 1])[group_a]] = self.a_text[a + last_a * len(self.a_size)]
        words[np.arange(len(b)) + at_a[group_b] + 1] = self.b_text[b + last_b * len(self.b_size)]
        upto = np.searchsorted(at_b, upto_b)
        out, k, start_a, start_b, start = [], 0, 0, 0, 0
        for x in found:
            if x is None:
                out.append(_NOTHING)
                continue
            text = "".join(words[start_a + start_b:upto_a[k] + upto_b[k]].tolist())[:-1]
            out.append((int(upto_a[k] - start_a), int(upto_b[k] - start_b), hashlib.sha256(text.encode()).hexdigest(), codes[start:upto[k]]))
            start_a, start_b, start = upto_a[k], upto_b[k], upto[k]
            k += 1
        return out


_NOTHING = (0, 0, "", np.empty(0, np.uint64))


_DOC = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _chunk(number: int, ids, id_type, stats: list[tuple], pairs: list[np.ndarray], radixes: int):
    """Rows (chunk, radix, blob, docs): the chunk's runs, and under radix -1 its pairs and documents."""
    codes = np.concatenate(pairs)
    found, at, n = np.unique(codes, return_inverse=True, return_counts=True)
    sink = pa.BufferOutputStream()
    columns = [pa.array(ids, id_type), *(pa.array(c, pa.int64()) for c in list(zip(*stats))[:4]), pa.array([s[4] for s in stats], pa.string())]
    table = pa.Table.from_arrays(columns, _DOC)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    radix = ((found >> np.uint64(32)) % np.uint64(radixes)).astype(np.int64)
    order = np.argsort(radix, kind="stable")  # the order of the contributions
    place = np.empty(len(order), "<u4")
    place[order] = np.arange(len(order), dtype="<u4")
    at_of = np.searchsorted(radix[order], np.arange(radixes + 1))
    full = np.flatnonzero(at_of[1:] > at_of[:-1])
    blobs = [runs.pack_sorted([found[order][at_of[r]:at_of[r + 1]], n[order][at_of[r]:at_of[r + 1]].astype("<u4")]) for r in full]
    k = len(full)
    return pa.RecordBatch.from_arrays(
        [pa.array([number] * (k + 1), pa.int64()), pa.array([-1, *full.tolist()], pa.int32()),
         pa.array([runs.pack([place[at].astype("<u4")]), *blobs], pa.binary()),
         pa.array([sink.getvalue().to_pybytes(), *[None] * k], pa.binary())], ["chunk", "radix", "blob", "docs"])


def _runs(docs: DataFrame, files, chunk_links: int, radixes: int) -> DataFrame:
    def run(batches):
        aligner = Aligner(*files.value)
        part, made = TaskContext.get().partitionId() << 24, 0
        ids, stats, pairs, links, id_type = [], [], [], 0, None
        for b in batches:
            id_type = b.schema.field(0).type
            id_list, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo in range(0, len(texts), 64):
                for i, (n_a, n_b, digest, codes) in zip(id_list[lo:lo + 64], aligner.align(texts[lo:lo + 64])):
                    ids.append(i)
                    stats.append((n_a, n_b, len(codes), len(codes), digest))
                    pairs.append(codes)
                    links += len(codes)
                    if links >= chunk_links:
                        yield _chunk(part + made, ids, id_type, stats, pairs, radixes)
                        ids, stats, pairs, links, made = [], [], [], 0, made + 1
        if ids:
            yield _chunk(part + made, ids, id_type, stats, pairs, radixes)

    return docs.mapInArrow(run, "chunk long, radix int, blob binary, docs binary")


def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For sorted runs of (pair, links): each record's corpus count, and whether no pair of its B id has a higher one."""
    k = len(held)
    out = [([], []) for _ in held]
    streams = [[(code * k + i, n) for code, n in zip(codes.tolist(), counts.tolist())] for i, (codes, counts) in enumerate(held)]
    side, of_side = -1, []  # the B id at hand: [count, runs that hold the pair] of each of its pairs

    def put():
        best = max((x[0] for x in of_side), default=0)
        for count, where in of_side:
            for i in where:
                out[i][0].append(count)
                out[i][1].append(count == best)

    pair = -1
    for key, n in merge(*streams):
        code, i = divmod(key, k)
        if code != pair:
            if code >> 32 != side:
                put()
                side, of_side = code >> 32, []
            of_side.append([0, []])
            pair = code
        of_side[-1][0] += n
        of_side[-1][1].append(i)
    put()
    return [(np.array(c, "<u8"), np.array(b, "<u1")) for c, b in out]


def align(docs: DataFrame, byte_bpe: str, pieces: str, chunk_links: int = CHUNK_LINKS, radixes: int = RADIXES,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    of every row. The two tokenizer files are read on the driver and sent to the tasks."""
    read = []
    for path in (byte_bpe, pieces):
        with open(path, "rb") as f:
            read.append(f.read())
    files = docs.sparkSession.sparkContext.broadcast(read)
    src = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    rows = staged(_runs(src, files, chunk_links, radixes), "alignment-runs")

    def answer(radix, held):
        got = merged([runs.unpack_sorted(blob, ["<u8", "<u4"]) for _, blob in held])
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in held], pa.int64()), pa.array([radix] * len(held), pa.int32()),
                                          pa.array([runs.pack(list(x)) for x in got], pa.binary())], ["chunk", "radix", "blob"])

    counts = runs.met(rows.where("radix >= 0").select("radix", "chunk", "blob"), "radix", "chunk long, radix int, blob binary", answer)
    schema = src.select("doc_id").schema
    for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(n, "long")
    schema = schema.add("groups_sha256", "string")

    def returned(left: pa.Table, right: pa.Table) -> pa.Table:
        table = pa.ipc.open_stream(left.column("docs")[0].as_py()).read_all()
        place, = runs.unpack(left.column("blob")[0].as_py(), ["<u4"])
        order = np.argsort(right.column("radix").to_numpy(), kind="stable").tolist()
        got = [runs.unpack(right.column("blob")[i].as_py(), ["<u8", "<u1"]) for i in order]
        count, best = (np.concatenate(x) for x in zip(*got)) if got else (np.empty(0, "<u8"), np.empty(0, "<u1"))
        n = table.column("n_links").to_numpy()
        end = np.cumsum(n)
        total = lambda x: (lambda c: c[end] - c[end - n])(np.concatenate([[0], np.cumsum(x[place].astype(np.int64))]))
        columns = {c: table.column(c) for c in _DOC} | {"n_best": pa.array(total(best)), "count_sum": pa.array(total(count))}
        return pa.Table.from_arrays([columns[f.name] for f in schema], schema.names)

    return (rows.where("radix < 0").select("chunk", "blob", "docs").groupBy("chunk")
            .cogroup(counts.groupBy("chunk")).applyInArrow(returned, schema))
