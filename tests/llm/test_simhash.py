import random
import re
from collections import defaultdict
from functools import reduce

import pytest
import xxhash

from cubeshelf.llm import simhash
from cubeshelf.llm.graph import connected_components
from cubeshelf.llm.queries import op2_simhash
from tests.llm.helpers import ROWS, docs


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """rows: (id, fingerprint) -> smallest id reachable, per row."""
    fps = sorted({f for _, f in rows})
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                up[root(a)] = root(b)
    low = defaultdict(list)
    for i, f in rows:
        if i is not None:
            low[root(f)].append(i)
    return [min(low[root(f)], default=None) for _, f in rows]


def order(rows):
    return sorted(rows, key=repr)


def test_fingerprint_is_the_slow_one():
    for _, text, _ in ROWS:
        assert simhash.fingerprint(text.encode() if text is not None else None) == slow_fingerprint(text)


def test_edge_rows(spark):
    got = simhash.near_duplicates(docs(spark)).collect()
    rows = [(i, slow_fingerprint(t)) for i, t, _ in ROWS]
    want = [(i, f, c) for (i, f), c in zip(rows, slow_components(rows))]
    assert order((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == order(want)


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []
    assert simhash.keep_one(docs(spark, [])).columns == docs(spark, []).columns


@pytest.mark.parametrize("max_bits,blocks", [(1, 4), (2, 6), (3, 5)])
def test_links_by_blocks_are_all_links(spark, max_bits, blocks):
    rnd = random.Random(max_bits)
    fps = set()
    for _ in range(40):
        f = rnd.getrandbits(64)
        fps.add(f)
        for _ in range(rnd.randrange(8)):  # chains of flips
            for b in rnd.sample(range(64), rnd.randrange(1, max_bits + 2)):
                f ^= 1 << b
            fps.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    cc = simhash.fingerprint_components(spark.createDataFrame(signed, "fp long"), max_bits, blocks).collect()
    of = {r.node % (1 << 64): r.component % (1 << 64) for r in cc}
    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= max_bits:
                assert of.get(a, a) == of.get(b, b)
    groups = defaultdict(set)
    for a in fps:
        groups[of.get(a, a)].add(a)
    for g in groups.values():  # and nothing else is linked
        seen = {next(iter(g))}
        while more := {b for b in g - seen if any((a ^ b).bit_count() <= max_bits for a in seen)}:
            seen |= more
        assert seen == g


def test_large_group_looks_neighbours_up():
    import numpy as np
    rnd = random.Random(5)
    base = rnd.getrandbits(64)
    m = np.array(sorted({base ^ reduce(lambda x, b: x ^ 1 << b, rnd.sample(range(14), rnd.randrange(6)), 0) for _ in range(900)}),
                 dtype=np.uint64)
    i, j = simhash._near(m, 2)
    want = {(a, b) for a in range(len(m)) for b in range(a + 1, len(m)) if (int(m[a]) ^ int(m[b])).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want


def test_one_row_of_each_component_stays(spark):
    kept = simhash.keep_one(docs(spark)).collect()
    rows = [(i, slow_fingerprint(t)) for i, t, _ in ROWS]
    assert len(kept) == len({simhash_root for simhash_root in roots(rows)})
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({c for c in slow_components(rows) if c is not None})


def roots(rows):
    labels = slow_components(rows)
    return [c if c is not None else ("null", f) for (_, f), c in zip(rows, labels)]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    odd = [(None, 5), (7, None), (2000, 2000), (3001, 3000), (3000, 3001)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain + star + odd, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(200)}, 3000: 3000, 3001: 3000}


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = op2_simhash(spark, sf).collect()
    src = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, slow_fingerprint(r.text)) for r in src]
    want = sorted((i, f"{f:016x}", c) for (i, f), c in zip(rows, slow_components(rows)))
    assert sorted(tuple(r) for r in got) == want
