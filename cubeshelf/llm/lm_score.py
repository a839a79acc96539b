"""Language-model scoring by a weighted backoff automaton.

Tokens are the words of the text (A-Z lower-cased, split at ASCII white space)
and one end token, the empty word, which is also the history of a text's first
word.

1. Words. Documents are packed into chunks of about `chunk_bytes` of text,
   written once as numbers with the hashes (72 bits) of the chunk's distinct
   words. A slice of all chunks' hashes meets in one task, which sends every
   chunk its words' numbers (frequent ones are small) and training counts.
2. Arcs. A text's step is (the two words before, the word). Each chunk lists its
   distinct steps with their training counts as sorted, prefix-coded numbers, and
   all steps with one middle word meet in one task. It has what the states of
   that word need: counts of the 3-grams around it, of the 2-grams and of the
   word are sums of the steps' counts. Every n-gram found in training is an arc.
   A history that has arcs is a state; its failure arc leads to the next shorter
   history with the weight that makes all words' chances add up to one
   (absolute discounting). The root scores any token by its smoothed count.
3. Scoring. A step starts in its longest history that is a state; it takes the
   arc of its word or the failure arc, whose weight is added, and so on down to
   the root. Each chunk gets its steps' weights and adds them along its texts.

Nothing is left out, gathered on the driver or broadcast, whatever the size of
the corpus; the number of slices follows the number of tokens. The steps around
a word with over `hot` training tokens are spread over several tasks by the
word before it; they get the word's 2-gram counts from a table of their own.

`word_share` and `gram_share` are off by default; a caller that wants a smaller
model can set them: arcs then need that share of all training tokens.

Null texts count as empty ones: only the end token. Every row is scored, also
repeated ones. Nothing to learn from gives the
smoothed count of an empty corpus. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from math import log10

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeshelf.llm.common import quoted, staged

CHUNK_BYTES, WORD_SHARE, GRAM_SHARE, ADD, DISCOUNT, END = 16 << 20, 0.0, 0.0, 0.1, 0.5, b""
SLICE_TOKENS, HOT = 1 << 20, 1 << 22  # tokens a slice, and training tokens of a word from which its steps are spread
_BITS = 17  # of a word's number in `Model`
_ROWS, _MASK = "chunk long, slice int, blob binary", (1 << 32) - 1


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, docs, words, uses, hashes, n, size): the documents' ids, folds and
    lengths, their tokens as numbers by falling count, each word's count and its
    hash with its training count in the order of the hashes; training tokens and all
    tokens. `docs`: (doc_id, text as binary, learn)."""
    def run(batches):
        part, made = TaskContext.get().partitionId() << 24, 0
        ids, learn, numbers, parts, size, id_type = [], [], _Numbers({END: 0}), [], 0, None

        def flush():
            lens, y = np.array([len(x) for x in parts], "<i4"), np.array(learn, bool)
            w = np.concatenate(parts)
            raw = np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=9).digest() for t in numbers), np.uint8).reshape(-1, 9)
            a, b = np.ascontiguousarray(raw[:, :8]).view("<u8").ravel(), raw[:, 8]
            order = np.lexsort((b, a))
            uses = np.bincount(w, minlength=len(a))[order].astype("<u4")
            number = np.empty(len(a), "<i4")
            number[order[_by_use(uses)]] = np.arange(len(a))
            known = np.repeat(y, lens)
            n = np.bincount(w[known], minlength=len(a))[order].astype("<u4")
            table = pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(y), pa.array(lens)], ["doc_id", "learn", "size"])
            row = [part + made, _packed(table), _planes(len(w), [number[w]]), _planes(len(a), [uses]),
                   _planes(len(a), [np.diff(a[order], prepend=np.uint64(0)), np.ascontiguousarray(b[order]), n]), int(known.sum()), len(w)]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["chunk", "docs", "words", "uses", "hashes", "n", "size"])

        for b in batches:
            id_type = b.schema.field(0).type
            for i, t, y in zip(*(c.to_pylist() for c in b.columns)):
                ids.append(i)
                learn.append(y)
                parts.append(np.array([*map(numbers.__getitem__, t.lower().split()), 0], "<i4"))
                size += len(t)
                if size >= chunk_bytes:
                    yield flush()
                    ids, learn, numbers, parts, size, made = [], [], _Numbers({END: 0}), [], 0, made + 1
        if ids:
            yield flush()

    return docs.mapInArrow(run, "chunk long, docs binary, words binary, uses binary, hashes binary, n long, size long")


def _by_use(uses: np.ndarray) -> np.ndarray:
    return np.argsort(-uses.astype(np.int64), kind="stable")


def _planes(n: int, columns: list[np.ndarray]) -> bytes:
    """Columns of `n` entries as compressed bytes, each split into the planes of its bytes."""
    raw = b"".join(c.view(np.uint8).reshape(n, c.itemsize).T.tobytes() for c in columns)
    return n.to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _columns(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    n, sizes = int.from_bytes(blob[:4], "little"), [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.decompress(blob[4:], decompressed_size=n * sum(sizes), codec="zstd", asbytes=True), np.uint8)
    parts = np.split(raw, np.cumsum(sizes)[:-1] * n)
    return [np.ascontiguousarray(p.reshape(i, n).T).view(k).ravel() for p, i, k in zip(parts, sizes, kinds)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                       pa.array([r[2] for r in rows], pa.binary())], ["chunk", "slice", "blob"])


def _met(rows: DataFrame, answer) -> DataFrame:
    """(chunk, slice, blob, found, most) for rows (chunk, slice, blob) of all chunks,
    met slice by slice: `answer` gets a slice and its (chunk, blob) and gives rows
    and two numbers for the first one's last columns."""
    def run(batches):
        held, of = [], None

        def flush():
            got, numbers = answer(of, held)
            out = _batch(got)
            for name, x in zip(("found", "most"), numbers):
                out = out.append_column(name, pa.array(([x] + [0] * len(got))[:len(got)], pa.int64()))
            return out

        for batch in batches:
            for chunk, k, blob in zip(*(col.to_pylist() for col in batch.columns)):
                if held and k != of:
                    yield flush()
                    held = []
                of = k
                held.append((chunk, blob))
        if held:
            yield flush()

    return (rows.select("chunk", "slice", "blob").repartition("slice").sortWithinPartitions("slice", "chunk")
            .mapInArrow(run, _ROWS + ", found long, most long"))


def vocabulary(chunks: DataFrame, slices: int) -> DataFrame:
    """(chunk, slice, blob, found, most): number and training count of each word
    of a chunk in the order of the hashes. A number's remainder by `slices` is the
    word's slice, its quotient the rank by count there. `found` adds up to the
    number of distinct training tokens, `most` is a slice's highest count."""
    def run(batches):
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                step, b, n = _columns(blob, ["<u8", "u1", "<u4"])
                a = np.cumsum(step)
                at = np.searchsorted((a >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32), np.arange(slices + 1, dtype=np.uint64))
                rows = []
                for k in np.flatnonzero(at[1:] > at[:-1]).tolist():
                    own = slice(at[k], at[k + 1])
                    rows.append((i, k, _planes(int(at[k + 1] - at[k]), [np.diff(a[own], prepend=np.uint64(0)), b[own], n[own]])))
                yield _batch(rows)

    def answer(k, blobs):
        read = [_columns(x, ["<u8", "u1", "<u4"]) for _, x in blobs]
        a, b, n = (np.concatenate(x) for x in zip(*([np.cumsum(x[0]), *x[1:]] for x in read)))
        order = np.lexsort((b, a))
        new = (np.diff(a[order], prepend=~a[order[:1]]) != 0) | (np.diff(b[order], prepend=b[order[:1]]) != 0)
        word = np.empty(len(a), np.int64)
        word[order] = np.cumsum(new) - 1
        total = np.bincount(word, n).astype("<i8")
        number = np.empty(len(total), "<i8")
        number[_by_use(total)] = np.arange(len(total)) * slices + k
        ends = np.cumsum([len(x[0]) for x in read])
        got = [word[e - len(x[0]):e] for e, x in zip(ends, read)]
        return [(c, k, _planes(len(w), [number[w], total[w]])) for (c, _), w in zip(blobs, got)], (int((total > 0).sum()), int(total.max()))

    return _met(chunks.select("chunk", "hashes").mapInArrow(run, _ROWS), answer)


def _ordered(rows: pa.Table) -> list[bytes]:
    """A chunk's answers in the order of its slices."""
    return rows.take(np.argsort(rows.column("slice").to_numpy(), kind="stable")).column("blob").to_pylist()


def _differences(x: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Differences in runs that begin, with the value itself, where `new`."""
    out = np.diff(x, prepend=x[:1])
    out[new] = x[new]
    return out


def _sums(steps: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The inverse of `_differences`."""
    out, at = np.cumsum(steps), np.flatnonzero(new)
    return out - np.repeat(out[at] - steps[at], np.diff(at, append=len(out)))


class Steps:
    """A chunk's distinct steps, sorted by slice, middle word, word before it
    and word: `history` (its slice, middle word, word before it or -1), each step's `of` (its
    history), `y` (its word) and `n` (training count); `at` is each token's step. Words are
    the chunk's; `number` and `n1` are their number and count in the corpus."""

    def __init__(self, words: bytes, uses: bytes, table: pa.Table, numbers: list[bytes], slices: int, hot: int):
        w, = _columns(words, ["<i4"])
        by_use, end = _by_use(_columns(uses, ["<u4"])[0]), w[-1]
        self.number, self.n1 = (np.concatenate(x)[by_use] for x in zip(*(_columns(x, ["<i8", "<i8"]) for x in numbers)))
        size = table.column("size").to_numpy()
        self.w, self.doc, start = w, np.repeat(np.arange(len(size), dtype=np.int32), size), np.cumsum(size) - size
        m, x = np.roll(w, 1), np.roll(w, 2)
        m[start], x[start + (size > 1)], x[start] = end, end, -1
        by_number = np.argsort(self.number)
        rank = np.append(np.empty(len(by_number), np.int64), 0)  # the last one stands for no word
        rank[by_number] = np.arange(1, len(by_number) + 1)
        where = np.lexsort((self.number // slices, self.number % slices))
        place = np.empty(len(where), np.int64)
        place[where] = np.arange(len(where))
        key = place[m]
        key <<= 32
        key |= rank[x]
        del m, x
        history, at = np.unique(key, return_inverse=True)
        at = at.astype(np.int32)
        m, x = where[history >> 32], np.append(-1, by_number)[history & _MASK]
        to = self.number[m] % slices
        spread = (self.n1[m] > hot) & (m != end)
        if spread.any():
            # Part 0 of a slice holds its other words; the parts of a hot word's histories go by the word before.
            to[spread] += slices * (1 + _part(self.number[x[spread]], _parts(self.n1[m[spread]], hot)))
            order = np.argsort(to, kind="stable")
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            at, to, m, x = back[at], to[order], m[order], x[order]
        self.history = to, m, x
        key[:] = at
        key <<= 32
        key |= rank[w]
        del at, history
        step, at = np.unique(key, return_inverse=True)
        del key
        self.at = at.astype(np.int32)
        self.of, self.y = step >> 32, by_number[(step & _MASK) - 1]
        known = np.repeat(table.column("learn").to_numpy().astype(bool), size)
        self.n = np.bincount(self.at[known], minlength=len(step)).astype("<u4")

    def rows(self, chunk: int, slices: int, often: np.ndarray) -> pa.RecordBatch:
        """(chunk, slice, blob): what each slice gets; `often`: the words that may be part of an arc."""
        to, m, x = self.history
        first = np.flatnonzero(np.diff(to, prepend=-1))
        rank = self.number[m] // slices
        before = np.where(x < 0, 0, (self.number[x] + 1) * 2 + often[x])
        new = np.diff(rank, prepend=-1) != 0
        new[first] = True
        held = np.bincount(self.of, minlength=len(m)).astype("<u4")
        begin = np.cumsum(held, dtype=np.int64) - held
        lone = np.zeros(len(self.of), bool)
        lone[begin] = True
        y = _differences(self.number[self.y], lone)
        before = _differences(before, new)
        rows = []
        for i, j in zip(first.tolist(), [*first[1:].tolist(), len(m)]):
            of = slice(int(begin[i]), int(begin[j]) if j < len(m) else len(y))
            step = np.diff(rank[i:j], prepend=rank[i] - 1)  # 0: the same middle word
            rows.append((chunk, int(to[i]), _pair(_planes(j - i, [np.where(np.arange(j - i) == 0, rank[i] + 1, step), before[i:j], held[i:j]]),
                                                  _pair(_planes(of.stop - of.start, [y[of], self.n[of]]), _counts(self.number[self.y[of]], self.n1[self.y[of]])))))
        return _batch(rows)


    def pairs(self, chunk: int, slices: int, hot: int) -> pa.RecordBatch:
        """(chunk, slice, blob): the 2-grams that follow hot words."""
        to, m, _ = self.history
        own = to[self.of] >= slices
        m, y, n = m[self.of[own]], self.y[own], self.n[own]
        found, pair = np.unique(m.astype(np.int64) << 32 | y, return_inverse=True)
        m, y, n = found >> 32, found & _MASK, np.bincount(pair, n, len(found)).astype("<i8")
        columns = [self.number[m], self.number[y], n, self.n1[y], _parts(self.n1[m], hot)]
        at = _part(columns[0] + columns[1], np.array([slices]))
        return _batch([(chunk, k, _planes(int((at == k).sum()), [c[at == k] for c in columns])) for k in np.unique(at).tolist()])


def _counts(number: np.ndarray, n1: np.ndarray) -> bytes:
    """The counts of the distinct numbers in rising order. They nearly fall, so
    differences are sent, the sign as the lowest bit."""
    step = np.diff(n1[np.unique(number, return_index=True)[1]], prepend=0)
    return _planes(len(step), [step << 1 ^ step >> 63])


def _counts_of(number: np.ndarray, blob: bytes) -> np.ndarray:
    step, = _columns(blob, ["<i8"])
    return np.cumsum(step >> 1 ^ -(step & 1))[np.unique(number, return_inverse=True)[1]]


def _pair(a: bytes, b: bytes) -> bytes:
    return len(a).to_bytes(4, "little") + a + b


def _halves(blob: bytes) -> tuple[bytes, bytes]:
    n = 4 + int.from_bytes(blob[:4], "little")
    return blob[4:n], blob[n:]


def _parts(n: np.ndarray, hot: int) -> np.ndarray:
    return -(-n // hot)


def _part(number: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return ((number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int64)


def _listed(blobs) -> tuple[np.ndarray, ...]:
    """The rows' steps: rank of the middle word and code of the one before of each
    history; history, word, training count and the word's count of each step; steps a row."""
    out, base = [], 0
    for blob in blobs:
        a, b = _halves(blob)
        b, counts = _halves(b)
        (step, before, held), (y, n) = _columns(a, ["<i8", "<i8", "<u4"]), _columns(b, ["<i8", "<u4"])
        m = np.cumsum(step) - 1
        lone = np.zeros(len(y), bool)
        lone[np.cumsum(held, dtype=np.int64) - held] = True
        y = _sums(y, lone)
        out.append((m, _sums(before, step != 0), base + np.repeat(np.arange(len(m)), held), y, n, _counts_of(y, counts)))
        base += len(m)
    return *(np.concatenate(x) for x in zip(*out)), [len(x[3]) for x in out]


def _codes(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """One number for each pair, `b` being below `most`."""
    if int(a.max(initial=0)) + 1 > (1 << 63) // most:
        raise OverflowError("too many words for 64 bits a 2-gram")
    return a * most + b


def _weights(steps: tuple, pairs: tuple | None, total: int, distinct: int, word_share: float, gram_share: float):
    """The states around the middle words of `steps` (see `_listed`) and the weight of each step from the longest one:
    (3-gram's count, history's count) where it has an arc there, else (0, 1 if it ends at the
    root, whose weight is not added), and the weights of these others. `pairs`: rank of
    the middle word, word, count and the word's count of all 2-grams, if these steps are a part."""
    m, before, of, y, n, n1 = steps
    most = 1 + max(int(y.max()), int(before.max()), int(pairs[1].max()) if pairs else 0)
    _, at, back = np.unique(_codes(m, before, most), return_index=True, return_inverse=True)
    m, before, of = m[at], before[at], back[of]
    _, at, step = np.unique(_codes(of, y, most), return_index=True, return_inverse=True)
    of, y, n1, n3 = of[at], y[at], n1[at], np.bincount(step, n)
    n2 = np.bincount(of, n3, len(m))
    if pairs is None:
        _, at, two = np.unique(_codes(m[of], y, most), return_index=True, return_inverse=True)
        mid, next1, count2 = m[of[at]], n1[at], np.bincount(two, n3)
    else:
        mid, word, count2, next1 = pairs
        key = _codes(mid, word, most)
        order = np.argsort(key)
        two = order[np.searchsorted(key[order], _codes(m[of], y, most))]
    middle, mid = np.unique(mid, return_inverse=True)
    m = np.searchsorted(middle, m)
    count1 = np.bincount(mid, count2)
    least, enough = max(1, total * gram_share), total * word_share
    often = (count1 > 0) & (count1 >= enough)
    kept2 = (count2 >= least) & often[mid] & (next1 > 0) & (next1 >= enough)
    state = (n2 >= least) & (before & 1 == 1) & often[m]
    kept3 = (n3 >= least) & state[of] & kept2[two]
    p2 = np.where(kept2, (count2 - DISCOUNT) / np.maximum(count1, 1)[mid], 1.0)
    p3 = (n3[kept3] - DISCOUNT) / n2[of[kept3]]
    one = (next1 + ADD) / (total + ADD * (distinct + 1))
    left1 = np.log10((1 - np.bincount(mid[kept2], p2[kept2], len(middle))) / (1 - np.bincount(mid[kept2], one[kept2], len(middle))))
    left2 = np.log10((1 - np.bincount(of[kept3], p3, len(m))) / (1 - np.bincount(of[kept3], p2[two[kept3]], len(m))))
    # From the longest state down: an arc ends the step, else the failure arc's weight is added.
    weight = np.where(state[of], left2[of], 0.0)
    weight += np.where(kept2[two], np.log10(p2)[two], np.where(often[m[of]], left1[m[of]], 0.0))
    first, second = np.where(kept3, n3, 0).astype("<i8"), np.where(kept3, n2[of], ~kept2[two]).astype("<i8")
    return first[step], second[step], weight[step]


class Model:
    """The whole automaton in memory, for a small corpus; the chunks' parts of
    it give the same scores. `words`: history words and their counts; `grams`: one
    (codes, counts) pair for orders 2 and 3, a code being the words' numbers."""

    def __init__(self, words: list[tuple[bytes, int]], grams: list, total: int, distinct: int):
        self.number = {w: i for i, (w, _) in enumerate(words)}
        self.total, self.below = total, total + ADD * (distinct + 1)
        count = np.array([c for _, c in words], dtype=np.float64)
        one = (count + ADD) / self.below
        mask = (1 << _BITS) - 1
        (code2, n2), (code3, n3) = grams
        first, second = code2 >> _BITS, code2 & mask
        p2 = (n2 - DISCOUNT) / count[first] if len(code2) else np.zeros(0)
        prefix = np.searchsorted(code2, code3 >> _BITS)  # every kept 3-gram's parts are kept 2-grams
        suffix = np.searchsorted(code2, code3 & ((1 << 2 * _BITS) - 1))
        p3 = (n3 - DISCOUNT) / n2[prefix] if len(code3) else np.zeros(0)
        # States: 0 the root, then histories of one word, then of two, that have arcs.
        has1, has2 = np.unique(first), np.unique(prefix)
        home = np.zeros(len(words), np.int64)
        home[has1] = 1 + np.arange(len(has1))
        pair = np.zeros(len(code2), np.int64)
        pair[has2] = 1 + len(has1) + np.arange(len(has2))
        left1 = (1 - np.bincount(first, p2, len(words))) / (1 - np.bincount(first, one[second], len(words)))
        left2 = (1 - np.bincount(prefix, p3, len(code2))) / (1 - np.bincount(prefix, p2[suffix], len(code2)))
        self.home = home.tolist()
        self.fail = [0] + [0] * len(has1) + home[second[has2]].tolist()
        self.weight = [0.0, *np.log10(left1[has1]).tolist(), *np.log10(left2[has2]).tolist()]
        self.drop = [0.0] * len(self.fail)  # weights of all failure arcs down to the root
        for s in range(1, len(self.fail)):
            self.drop[s] = self.weight[s] + self.drop[self.fail[s]]
        after2 = np.where(pair > 0, pair, home[second])
        after3 = np.where(pair[suffix] > 0, pair[suffix], home[code3 & mask]) if len(code3) else np.zeros(0, int)
        keys = np.concatenate([(home[first] << _BITS) | second, (pair[prefix] << _BITS) | (code3 & mask)]).tolist()
        steps = zip(np.concatenate([after2, after3]).astype(int).tolist(), np.log10(np.concatenate([p2, p3])).tolist())
        self.arcs = dict(zip(keys, steps))

    def root(self, counts: np.ndarray) -> np.ndarray:
        """log10 chance of tokens with these counts, without a history."""
        return np.log10((counts + ADD) / self.below)

    def walk(self, numbers: list[int], base: list[float]) -> float:
        """One traversal; `numbers`: each token's number or -1, `base`: its root weight."""
        arcs, fail, weight, drop, home = self.arcs, self.fail, self.weight, self.drop, self.home
        end = self.number.get(END, -1)
        state, out = (home[end] if end >= 0 else 0), 0.0
        for w, b in zip(numbers, base):
            if w < 0:
                out += drop[state] + b
                state = 0
                continue
            while True:
                arc = arcs.get(state << _BITS | w) if state else None
                if arc is not None:
                    state, p = arc
                    out += p
                    break
                if not state:
                    out += b
                    state = home[w]
                    break
                out += weight[state]
                state = fail[state]
        return out


def _answers(rows: DataFrame, *model) -> DataFrame:
    """(chunk, slice, blob): the weights of the steps that each chunk listed."""
    def answer(k, blobs):
        pairs = [_columns(x, ["<i8"] * 4) for c, x in blobs if c < 0]
        blobs = [(c, x) for c, x in blobs if c >= 0]
        if not blobs:
            return [], (0, 0)
        *steps, lens = _listed([x for _, x in blobs])
        got, rows = _weights(tuple(steps), tuple(np.concatenate(x) for x in zip(*pairs)) or None, *model), []
        for (c, _), e, n in zip(blobs, np.cumsum(lens), lens):
            first, second, weight = (x[e - n:e] for x in got)
            rest = weight[first == 0]
            rows.append((c, k, _pair(_planes(n, [first, second]), _planes(len(rest), [rest]))))
        return rows, (0, 0)

    return _met(rows, answer).drop("found", "most")


def _hot_pairs(rows: DataFrame, slices: int, hot: int) -> DataFrame:
    """(-1, slice, blob) for each part of each hot word: rank of the word, next
    word, training count and the next word's count of its 2-grams, of which `rows` hold each
    chunk's (see `Steps.pairs`)."""
    def answer(_, blobs):
        m, y, n, n1, parts = (np.concatenate(x) for x in zip(*(_columns(x, ["<i8"] * 5) for _, x in blobs)))
        _, at, pair = np.unique(_codes(m, y, int(y.max()) + 1), return_index=True, return_inverse=True)
        m, y, n, n1, parts = m[at], y[at], np.bincount(pair, n).astype("<i8"), n1[at], parts[at]
        rows = []
        for k in np.unique(m % slices).tolist():
            for p in range(int(parts[m % slices == k].max())):
                own = (m % slices == k) & (parts > p)
                rows.append((-1, slices * (1 + p) + k, _planes(int(own.sum()), [m[own] // slices, y[own], n[own], n1[own]])))
        return rows, (0, 0)

    return _met(rows, answer).drop("found", "most")


def score(docs: DataFrame, learn: Column, word_share: float = WORD_SHARE, gram_share: float = GRAM_SHARE,
          chunk_bytes: int = CHUNK_BYTES, id_col: str = "doc_id", text_col: str = "text", slice_tokens: int = SLICE_TOKENS,
          hot: int = HOT) -> DataFrame:
    """(doc_id, learn, n_tokens, n_known, train_tokens, base_score, score) of
    every row: log10 probabilities without histories and by the automaton,
    learned from the rows where `learn` holds."""
    src = docs.select(F.col(quoted(id_col)).alias("doc_id"),
                      F.coalesce(F.col(quoted(text_col)), F.lit("")).cast("binary").alias("text"),
                      F.coalesce(learn, F.lit(False)).alias("learn"))
    chunks = staged(chunked(src, chunk_bytes), "lm-chunks")
    total, size = chunks.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).first()
    slices = max(16, -(-size // slice_tokens))
    numbers = staged(vocabulary(chunks, slices), "lm-words")
    distinct, most = numbers.agg(F.coalesce(F.sum("found"), F.lit(0)), F.coalesce(F.max("most"), F.lit(0))).first()
    numbers = numbers.select("chunk", "slice", "blob")
    texts = chunks.select("chunk", "docs", "words", "uses").groupBy("chunk")

    def read(left: pa.Table, numbers: pa.Table) -> tuple[int, pa.Table, Steps]:
        chunk, docs, words, uses = (c[0].as_py() for c in left.columns)
        table = _unpack(docs)
        return chunk, table, Steps(words, uses, table, _ordered(numbers), slices, hot)

    def listed(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk, _, c = read(left, right)
        return pa.Table.from_batches([c.rows(chunk, slices, (c.n1 > 0) & (c.n1 >= total * word_share))])

    steps = texts.cogroup(numbers.groupBy("chunk")).applyInArrow(listed, _ROWS)
    if most > hot:
        def paired(left: pa.Table, right: pa.Table) -> pa.Table:
            chunk, _, c = read(left, right)
            return pa.Table.from_batches([c.pairs(chunk, slices, hot)])

        pairs = texts.cogroup(numbers.groupBy("chunk")).applyInArrow(paired, _ROWS)
        steps = steps.unionByName(_hot_pairs(pairs, slices, hot))
    answers = staged(_answers(steps, total, distinct, word_share, gram_share), "lm-weights")
    schema = src.select("doc_id", "learn").schema
    for n, t in (("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double")):
        schema = schema.add(n, t)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        word = pc.is_null(right.column("weights"))
        _, table, c = read(left, right.filter(word).select(["slice", "blob"]))
        first, second, weight = [], [], []
        for blob in _ordered(right.filter(pc.invert(word))):
            a, b = _halves(blob)
            for to, x in zip((first, second, weight), (*_columns(a, ["<i8", "<i8"]), *_columns(b, ["<f8"]))):
                to.append(x)
        first, second, weight = map(np.concatenate, (first, second, weight))
        arc = first > 0
        root = np.log10((c.n1 + ADD) / (total + ADD * (distinct + 1)))
        value = np.empty(len(first))
        value[arc] = np.log10((first[arc] - DISCOUNT) / second[arc])
        value[~arc] = weight + np.where(second[~arc] > 0, root[c.y[~arc]], 0.0)
        docs = len(table)
        return pa.Table.from_arrays([table.column("doc_id"), table.column("learn"), table.column("size").cast(pa.int64()),
                                     pa.array(np.bincount(c.doc, (c.n1 > 0)[c.w], docs).astype(np.int64)),
                                     pa.array(np.full(docs, total), pa.int64()), pa.array(np.bincount(c.doc, root[c.w], docs)),
                                     pa.array(np.bincount(c.doc, value[c.at], docs))], names=schema.names)

    sent = (numbers.withColumn("weights", F.lit(None).cast("boolean"))
            .unionByName(answers.withColumn("weights", F.lit(True))))
    return texts.cogroup(sent.groupBy("chunk")).applyInArrow(run, schema)


def log10_chance(count: int, total: int, distinct: int) -> float:
    """Root weight of a token, as a plain formula."""
    return log10((count + ADD) / (total + ADD * (distinct + 1)))
