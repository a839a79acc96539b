"""The Jaccard join against comparing all pairs."""

import random

import numpy as np
import pytest

from cubeshelf.llm import jaccard
from tests.llm.helpers import ROWS, docs


def shingles(text, k):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def linked(a, b, least):
    return bool(a) and bool(b) and 100 * len(a & b) >= least * len(a | b)


def slow(rows, k=4, least=85):
    sets = [shingles(t, k) for _, t, _ in rows]
    low = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j], least) and low[i] != low[j]:
                a, b = low[i], low[j]
                low = [min(a, b) if x in (a, b) else x for x in low]
    ids = {}
    for (i, _, _), root in zip(rows, low):
        if i is not None:
            ids[root] = min(i, ids.get(root, i))
    return sorted(repr((i, len(s), ids.get(root))) for (i, _, _), s, root in zip(rows, sets, low))


def got(df, **how):
    return sorted(repr(tuple(r)) for r in jaccard.join(df, **how).collect())


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 2000])
def test_hard_rows(spark, chunk_bytes):
    rows = ROWS + [(None, "row without an id\nSAME\x0bline", None), (30, "a b c", None), (31, "A  b\tc", None), (32, "a b c d", None), (33, "a b", None),
                   (34, "x x x x x x", None), (35, "x x x x", None), (36, "ÉTÉ a b c", None), (37, "été a b c", None), (38, " \t ", None)]
    df = docs(spark, rows)
    assert got(df, chunk_bytes=chunk_bytes) == slow(rows)
    assert jaccard.join(df.limit(0)).collect() == []
    assert jaccard.join(docs(spark, [(1, None, None), (2, "", None)])).count() == 2


def variants(seed, n=320):
    """Texts at all distances: chains of edits, copies, a passage that many share."""
    pick = random.Random(seed)
    word = lambda: f"w{pick.randrange(400)}"
    passage = [word() for _ in range(40)]
    out = []
    while len(out) < n:
        base = [word() for _ in range(pick.choice([3, 6, 8, 20, 60, 150]))]
        if pick.random() < 0.4:
            base = base[:30] + passage
        chain = pick.random() < 0.5
        for _ in range(pick.choice([1, 2, 5, 12])):
            out.append(" ".join(base))
            now = list(base)
            for _ in range(pick.choice([0, 1, 1, 2, 3])):
                at = pick.randrange(len(now))
                now[at:at + pick.randrange(2)] = [word() for _ in range(pick.randrange(3))]
            if chain:
                base = now or base
            else:
                out.append(" ".join(now))
    return [(i, t, None) for i, t in enumerate(out[:n])]


@pytest.mark.parametrize("seed,k,least,block", [(1, 4, 85, 2048), (2, 4, 85, 3), (3, 1, 70, 5)])
def test_random_variants(spark, seed, k, least, block):
    rows = variants(seed)
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(5)
    want = slow(rows, k, least)
    assert got(df, shingle=k, least=least, block=block, chunk_bytes=4000) == want
    assert len({x.split(", ")[2] for x in want}) < len(rows) - 50


def test_bounds_exclude_no_link():
    pick = np.random.default_rng(5)
    for least in (60, 85, 100):
        for _ in range(400):
            n = int(pick.integers(1, 300))
            x = np.unique(pick.integers(0, 1 << 63, n, dtype=np.uint64))
            y = np.unique(np.concatenate([x[pick.random(len(x)) < 0.93], pick.integers(0, 1 << 63, int(pick.integers(0, 20)), dtype=np.uint64)]))
            if not len(y):
                continue
            both = len(np.intersect1d(x, y))
            links = 100 * both >= least * (len(x) + len(y) - both)
            assert links == (both >= jaccard.shared(len(x), len(y), least))
            a, b = jaccard.bitmap(x), jaccard.bitmap(y)
            size = min(len(a), len(b))
            apart = int(np.bitwise_count(jaccard.folded(a, size) ^ jaccard.folded(b, size)).sum())
            assert apart <= len(x) + len(y) - 2 * both
            if links:
                first = [set(s[:jaccard.prefix(len(s), least)].tolist()) for s in (x, y)]
                assert first[0] & first[1]


def test_near_copies_are_joined_by_hubs_not_pair_by_pair(spark, monkeypatch):
    """Copies of one text, each with some words of its own: linked to the text
    or to the light ones, seldom to each other."""
    pick = random.Random(5)
    base, rows = [f"w{i}" for i in range(400)], []
    for i in range(80):
        words = list(base)
        for _ in range(14 - i % 14):  # heavy ones first
            words[pick.randrange(400)] = f"own{i}x{pick.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    made, near = [], jaccard._near_pairs

    def counted(tiles, least):
        out = near(tiles, least)
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_near_pairs", counted)
    got = {r.doc_id: r.component_id for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: {tuple(t.split()[k:k + 4]) for k in range(len(t.split()) - 3)} for i, t in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert got == root and len(set(root.values())) < 50
    assert made and max(made) <= 4 * len(rows)  # all pairs: 3160, most in several tiles
