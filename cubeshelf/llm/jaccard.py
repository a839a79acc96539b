"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection.

A document's set holds the 64-bit hashes of its distinct word shingles. Two
sets link when 100 * intersection >= least * union.

1. Equal texts (lower-cased words) are one class; its first row stands for it.
2. Every shingle's documents are counted over the corpus: chunks of documents
   list theirs as sorted runs of 48 hash bits, cut by hash range; a task meets
   a range of all chunks and answers each with the counts' magnitude. A set's
   shingles are ordered by magnitude, rare ones first. Linked sets share a
   shingle within the first n - ceil(n * least / 100) + 1 of both; those that
   stand in one document only link nothing, so most sets end here.
3. Tiles: sets that share such a shingle and whose sizes fall into one band of
   ratio 0.84 or into neighbouring ones; others can't link. First each set is compared
   with one partner, the smallest of its band under most of its shingles;
   components of these links make large groups of copies one class. In further
   turns each set of a tile that holds several components is compared with one
   hub of another component, another one each turn, until a turn joins few:
   near copies that link to some of their group only become one class, too.
   Then, in every tile that still holds several components, pairs across them
   are bounded from above: by size, by the shingle's place, and by bitmaps of
   up to 1024 bits (a shingle flips one bit; the bits in which two bitmaps
   differ are at most the shingles that the sets don't share). Tiles over
   `block` sets are cut into pairs of blocks, dealt to different tasks.
4. What passes is verified by intersecting the sorted arrays. Components of all links are found by
   distributed connected components.

A text of fewer words than a shingle is one shingle; null texts and texts
without words have an empty set and no link. Rows with a null id take part; a
component's id is its smallest id that isn't null. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeshelf.llm import runs
from cubeshelf.llm.common import quoted, staged
from cubeshelf.llm.graph import connected_components

CHUNK_BYTES, SHINGLE, LEAST, BLOCK = 16 << 20, 4, 85, 2048
TURNS = 8  # of merging by hubs at most; what they leave is compared pair by pair
RANGE_WORDS = 1 << 18  # words of the corpus for each hash range
_RATIO = 0.99  # bands are this much wider than the bound, so that rounding can't part a pair by two


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def shingle_sets(texts: list[bytes | None], shingle: int = SHINGLE) -> list[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    number, codes = _Numbers(), []
    for t in texts:
        words = (t or b"").lower().split()
        codes.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
    # Windows over all texts at once; those that cross texts are not looked at.
    h = runs.hashed(number, 42)[np.concatenate([np.empty(0, np.int32), *codes])]
    whole = h[:max(0, len(h) - shingle + 1)]
    for k in range(1, shingle):
        whole = runs.mixed(whole, h[k:len(h) - shingle + 1 + k])
    out, at = [], 0
    for c in codes:
        n = len(c)
        if 0 < n < shingle:
            got = h[at:at + 1]
            for x in range(at + 1, at + n):
                got = runs.mixed(got, h[x:x + 1])
            out.append(got)
        else:
            out.append(np.unique(whole[at:at + max(0, n - shingle + 1)]))
        at += n
    return out


def width(n: int) -> int:
    """Bits of the bitmap of a set of n."""
    return min(1024, max(64, 1 << (n - 1).bit_length()))


def bitmap(hashes: np.ndarray) -> np.ndarray:
    w = width(len(hashes))
    return np.packbits((np.bincount((hashes & np.uint64(w - 1)).astype(np.int64), minlength=w) & 1).astype(np.uint8), bitorder="little")


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """A bitmap folded to `size` bytes: the bitmap that the same set has at that width."""
    return np.bitwise_xor.reduce(bits.reshape(-1, size), axis=0)


def prefix(n, least: int):
    return n - (n * least + 99) // 100 + 1


def shared(n, m, least: int):
    """The intersection that sets of n and m need to link."""
    return (least * (n + m) + 99 + least) // (100 + least)


def _uid(chunk, at):
    return (chunk >> 24) << 39 | (chunk & 0xFFFFFF) << 20 | at


def _digests(chunks: DataFrame, id_type: str) -> DataFrame:
    """(uid, chunk, at, doc_id, digest, words) of every row; no digest without words."""
    def run(batches):
        for b in batches:
            for chunk, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = runs.unpack_texts(blob)
                words = [(x or b"").lower().split() for x in t.column("text").to_pylist()]
                digest = [xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in words]
                n = len(digest)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_uid(chunk, np.arange(n)), pa.int64()), pa.array(np.full(n, chunk), pa.int64()), pa.array(np.arange(n), pa.int32()),
                     t.column("doc_id").combine_chunks(), pa.array(digest, pa.binary()), pa.array([len(w) for w in words], pa.int64())],
                    ["uid", "chunk", "at", "doc_id", "digest", "words"])

    return chunks.mapInArrow(run, f"uid long, chunk long, at int, doc_id {id_type}, digest binary, words long")


def _listed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The chunk's distinct shingles by 48 bits, and their documents."""
    return np.unique(np.concatenate([np.empty(0, np.uint64), *sets]) >> np.uint64(16), return_counts=True)


def _magnitudes(chunks: DataFrame, shingle: int, bits: int) -> DataFrame:
    """(chunk, cut, blob): for each shingle that a chunk lists the number of binary digits of its document count."""
    def run(batches):
        for b in batches:
            for chunk, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found, n = _listed(shingle_sets(runs.unpack_texts(blob).column("text").to_pylist(), shingle))
                tops, at = runs.cuts(found, 48 - bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tops, pa.int64()), pa.array([chunk] * len(tops), pa.int64()),
                     pa.array([runs.pack_sorted([found[i:j], n[i:j].astype("<u4")]) for i, j in zip(at, at[1:])], pa.binary())], ["cut", "chunk", "blob"])

    def answer(cut, rows):
        parts = [runs.unpack_sorted(blob, ["<u8", "<u4"]) for _, blob in rows]
        h, n = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(h, kind="stable")
        at = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        total = np.add.reduceat(n[order].astype(np.int64), at)
        out = np.empty(len(h), np.uint8)
        out[order] = np.repeat(np.ceil(np.log2(total + 1)).astype(np.uint8), np.diff(np.append(at, len(h))))
        ends = np.cumsum([len(p[0]) for p in parts])
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()), pa.array([cut] * len(rows), pa.int64()),
                                          pa.array([runs.pack([out[e - len(p[0]):e]]) for p, e in zip(parts, ends)], pa.binary())], ["chunk", "cut", "blob"])

    listed = chunks.mapInArrow(run, "cut long, chunk long, blob binary")
    return runs.met(listed, "cut", "chunk long, cut long, blob binary", answer)


_SETS = "uid long, n int, hashes binary, bits binary, places array<struct<token:long,place:int>>"


def _sets(chunks: DataFrame, answers: DataFrame, shingle: int, least: int) -> DataFrame:
    """The chosen rows' sets. `answers`: magnitudes, and under cut -1 each
    chunk's chosen rows. `hashes`, `bits` and `places` only where a link is possible."""
    place_type = pa.list_(pa.struct([("token", pa.int64()), ("place", pa.int32())]))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = left.column("chunk")[0].as_py()
        sets = shingle_sets(runs.unpack_texts(left.column("blob")[0].as_py()).column("text").to_pylist(), shingle)
        cut = right.column("cut").to_numpy()
        order = np.argsort(cut, kind="stable").tolist()
        chosen = [np.sort(runs.unpack(right.column("blob")[i].as_py(), ["<i4"])[0]) for i in order if cut[i] < 0]
        if not chosen:
            return pa.Table.from_arrays([pa.array([], t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary(), place_type)],
                                        ["uid", "n", "hashes", "bits", "places"])
        ends_of = np.cumsum([len(h) for h in sets])
        _, place_of = np.unique(np.concatenate([np.empty(0, np.uint64), *sets]) >> np.uint64(16), return_inverse=True)
        magnitude = np.concatenate([runs.unpack(right.column("blob")[i].as_py(), ["<u1"])[0] for i in order if cut[i] >= 0])
        n, hashes, bits, tokens, places, ends = [], [], [], [], [], [0]
        nothing = np.empty(0, np.int32)
        for i in chosen[0].tolist():
            h, k = sets[i], prefix(len(sets[i]), least)
            size = magnitude[place_of[ends_of[i] - len(h):ends_of[i]]]
            first = at = nothing
            if np.count_nonzero(size == 1) < k:
                first = np.argsort(size, kind="stable")[:k]  # by hash within a magnitude, as h ascends
                at = np.flatnonzero(size[first] > 1).astype(np.int32)
            n.append(len(h))
            hashes.append(h.tobytes() if len(at) else None)
            bits.append(bitmap(h).tobytes() if len(at) else None)
            tokens.append(h[first[at]].view(np.int64))
            places.append(at)
            ends.append(ends[-1] + len(at))
        struct = pa.StructArray.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(places), pa.int32())], ["token", "place"])
        return pa.Table.from_arrays([pa.array(_uid(chunk, chosen[0].astype(np.int64)), pa.int64()), pa.array(n, pa.int32()), pa.array(hashes, pa.binary()),
                                     pa.array(bits, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)],
                                    ["uid", "n", "hashes", "bits", "places"])

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, _SETS)


def verified(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(src, dst): the pairs (x, y) whose sets link, by exact intersection."""
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column("hx").to_pylist(), b.column("hy").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= least * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y")], ["src", "dst"]).filter(pa.array(keep, pa.bool_()))

    side = lambda u, h: sets.where(F.col("hashes").isNotNull()).select(F.col("uid").alias(u), F.col("hashes").alias(h))
    both = pairs.join(side("ux", "hx"), F.col("x") == F.col("ux")).join(side("uy", "hy"), F.col("y") == F.col("uy"))
    return both.select("x", "y", "hx", "hy").mapInArrow(run, "src long, dst long")


def _near_pairs(tiles: DataFrame, least: int) -> DataFrame:
    """(x, y): pairs of a tile across components that no bound excludes."""
    def run(batches):
        for b in batches:
            members = b.column("members")
            values, ends = members.values, members.offsets.to_numpy()
            get = lambda name: values.field(name).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            uid, n, place, root, upper, block = (get(c) for c in ("uid", "n", "place", "root", "upper", "block"))
            n, place = n.astype(np.int64), place.astype(np.int64)
            bits = values.field("bits")
            left, right = b.column("left").to_pylist(), b.column("right").to_pylist()
            xs, ys = [], []
            for k, (lo, hi) in enumerate(zip(ends, ends[1:])):
                size = min(len(bits[i].as_py()) for i in range(lo, hi))
                sig = np.stack([folded(np.frombuffer(bits[i].as_py(), np.uint8), size) for i in range(lo, hi)]).view(np.uint64)
                own = np.arange(lo, hi)
                step = max(1, (1 << 20) // len(own))
                for at in range(0, len(own), step):
                    i, j = own[at:at + step, None], own[None, :]
                    need = shared(n[i], n[j], least)
                    ok = (i < j) & (root[i] != root[j]) & ~(upper[i] & upper[j]) & (np.minimum(n[i] - place[i], n[j] - place[j]) >= need)
                    ok &= 100 * np.minimum(n[i], n[j]) >= least * np.maximum(n[i], n[j])
                    if left[k] != right[k]:
                        ok &= block[i] != block[j]
                    i, j = np.nonzero(ok)
                    i = i + at
                    for p in range(0, len(i), 1 << 16):
                        u, v = i[p:p + (1 << 16)], j[p:p + (1 << 16)]
                        apart = np.bitwise_count(sig[u] ^ sig[v]).sum(axis=1).astype(np.int64)
                        u, v = lo + u, lo + v
                        near = n[u] + n[v] - 2 * shared(n[u], n[v], least) >= apart
                        xs.append(np.minimum(uid[u[near]], uid[v[near]]))
                        ys.append(np.maximum(uid[u[near]], uid[v[near]]))
            if xs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(xs)), pa.array(np.concatenate(ys))], ["x", "y"])

    return tiles.mapInArrow(run, "x long, y long")


def _still_split(posts: DataFrame, links: DataFrame) -> DataFrame:
    """(uid, n, lone, band, token, place, root): the posts of tokens whose sets are of several components."""
    roots = staged(connected_components(links).withColumnsRenamed({"node": "own", "component": "top"}), "jaccard-roots")
    rooted = staged(posts.join(roots, F.col("uid") == F.col("own"), "left").select(*posts.columns, F.coalesce("top", "uid").alias("root")),
                    "jaccard-rooted")
    split = rooted.groupBy(F.col("token").alias("t")).agg(F.min("root").alias("a"), F.max("root").alias("z")).where("a < z").select("t")
    return staged(rooted.join(split, F.col("token") == F.col("t"), "left_semi"), "jaccard-split")


def _tiled(posts: DataFrame) -> DataFrame:
    """The posts in the tiles of their band and the one below."""
    both = F.explode(F.array(F.struct(F.col("band").alias("tile"), F.lit(False).alias("upper")), F.struct((F.col("band") - 1).alias("tile"), F.lit(True).alias("upper"))))
    return posts.select("*", both.alias("q")).select("uid", "n", "lone", "token", "place", "root", "q.tile", "q.upper")


def _hub_pairs(posts: DataFrame, least: int, turn: int) -> DataFrame:
    """(x, y): each set with one partner of another component at most, the hub
    of most of its tiles. A tile's hub has the fewest shingles of its own, as
    what is closest to the whole group has; with every turn among another share of the sets."""
    tiled = _tiled(posts)
    hubs = (tiled.groupBy(F.col("token").alias("t"), F.col("tile").alias("b"))
            .agg(F.min(F.struct(F.pmod(F.xxhash64(F.lit(turn), "uid"), F.lit(turn + 1)).alias("h"), "lone", "uid", "n", "root")).alias("m"), F.count(F.lit(1)).alias("c")).where("c > 1")
            .select("t", "b", F.col("m.uid").alias("y"), F.col("m.n").alias("other"), F.col("m.root").alias("top")))
    met = tiled.join(hubs, (F.col("token") == F.col("t")) & (F.col("tile") == F.col("b")))
    met = met.where((F.col("root") != F.col("top")) & (100 * F.least("n", "other") >= least * F.greatest("n", "other")))
    return (met.groupBy("uid", "y").agg(F.count(F.lit(1)).alias("c")).groupBy("uid").agg(F.max(F.struct("c", "y")).alias("m"))
            .select(F.col("uid").alias("x"), F.col("m.y").alias("y")))


def set_links(sets: DataFrame, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """(src, dst): verified links that join just the sets that are linked, directly or over others."""
    band = F.floor(F.log(F.col("n")) / F.lit(-log(_RATIO * least / 100))).cast("int")
    lone = F.expr(f"n - (n * {least} + 99) div 100 + 1 - size(places)").cast("int")  # shingles that no other document has
    posts = staged(sets.where(F.size("places") > 0).select("uid", "n", lone.alias("lone"), band.alias("band"), F.explode("places").alias("p"))
                   .select("uid", "n", "lone", "band", "p.token", "p.place"), "jaccard-posts")
    # One partner each: the smallest set of its band under most of its shingles.
    lowest = (posts.groupBy(F.col("token").alias("t"), F.col("band").alias("b")).agg(F.min(F.struct("n", "uid")).alias("m"), F.count(F.lit(1)).alias("c"))
              .where("c > 1").select("t", "b", F.col("m.uid").alias("y")))
    met = posts.join(lowest, (F.col("token") == F.col("t")) & (F.col("band") == F.col("b"))).where(F.col("uid") != F.col("y"))
    one = (met.groupBy("uid", "y").agg(F.count(F.lit(1)).alias("c")).groupBy("uid").agg(F.max(F.struct("c", "y")).alias("m"))
           .select(F.col("uid").alias("x"), F.col("m.y").alias("y")))
    sure = staged(verified(staged(one, "jaccard-first"), sets, least), "jaccard-sure")
    left, links, last = _still_split(posts, sure), sure, 1
    for turn in range(TURNS):
        found = staged(verified(staged(_hub_pairs(left, least, turn), "jaccard-hubs"), sets, least), "jaccard-hub-links")
        now, waiting = found.count(), left.select("uid").distinct().count()
        if now:
            links = staged(links.union(found), "jaccard-joined")
            left = _still_split(left.drop("root"), links)
        if 50 * max(now, last) < waiting or not waiting:  # two turns with few links
            break
        last = now
    left = staged(_tiled(left), "jaccard-tiled")
    kinds = (left.groupBy(F.col("token").alias("t"), F.col("tile").alias("b"))
             .agg(F.min("root").alias("a"), F.max("root").alias("z"), F.bool_and("upper").alias("high"), F.count(F.lit(1)).alias("c"))
             .where("a < z and not high").select("t", "b", F.ceil(F.col("c") / block).cast("int").alias("blocks")))
    members = left.join(kinds, (F.col("token") == F.col("t")) & (F.col("tile") == F.col("b")))
    members = members.withColumn("block", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))
    members = members.join(sets.where(F.col("bits").isNotNull()).select(F.col("uid").alias("u"), "bits"), F.col("uid") == F.col("u"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = members.select("*", other.alias("o")).select(
        "token", "tile", F.least("block", "o").alias("left"), F.greatest("block", "o").alias("right"),
        F.struct("uid", "n", "place", "root", "upper", "block", "bits").alias("m"))
    tiles = dealt.groupBy("token", "tile", "left", "right").agg(F.collect_list("m").alias("members")).where(F.size("members") > 1)
    near = staged(_near_pairs(tiles.select("left", "right", "members"), least).distinct(), "jaccard-near")
    return staged(links.union(verified(near, sets, least)), "jaccard-links")


def join(docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST, chunk_bytes: int = CHUNK_BYTES, block: int = BLOCK,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    if not 50 < least <= 100:
        raise ValueError("least: over 50 and up to 100")
    src = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("binary").alias("text"))
    chunks = staged(runs.packed_texts(src, chunk_bytes), "jaccard-chunks")
    rows = staged(_digests(chunks, src.schema["doc_id"].dataType.simpleString()), "jaccard-rows")
    first = (rows.where(F.col("digest").isNotNull()).groupBy(F.col("digest").alias("text_digest"))
             .agg(F.min("doc_id").alias("low"), F.min(F.struct("uid", "chunk", "at")).alias("r"))
             .select("text_digest", "low", F.col("r.uid").alias("uid"), F.col("r.chunk").alias("chunk"), F.col("r.at").alias("at")))
    first = staged(first, "jaccard-first-rows")

    def blobs(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([-1] * b.num_rows, pa.int64()),
                                              pa.array([runs.pack([np.array(x, "<i4")]) for x in b.column(1).to_pylist()], pa.binary())], ["chunk", "cut", "blob"])

    chosen = first.groupBy("chunk").agg(F.collect_list("at").alias("ats")).mapInArrow(blobs, "chunk long, cut long, blob binary")
    words = rows.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    answers = _magnitudes(chunks, shingle, runs.ranges(words, RANGE_WORDS))
    sets = staged(_sets(chunks, answers.union(chosen), shingle, least), "jaccard-sets")
    links = set_links(sets, least, block)
    classes = staged(connected_components(links).withColumnsRenamed({"node": "own", "component": "top"}), "jaccard-classes")
    known = sets.select(F.col("uid").alias("set_uid"), "n").join(classes, F.col("set_uid") == F.col("own"), "left")
    known = first.join(known, F.col("uid") == F.col("set_uid")).select("text_digest", "low", "n", F.coalesce("top", "uid").alias("top"))
    known = staged(known, "jaccard-known")
    lows = known.groupBy(F.col("top").alias("root")).agg(F.min("low").alias("component"))
    known = known.join(lows, F.col("top") == F.col("root")).select("text_digest", "n", "component")
    return (rows.join(staged(known, "jaccard-label"), F.col("digest") == F.col("text_digest"), "left")
            .select("doc_id", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_shingles"),
                    F.when(F.col("text_digest").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id")))
