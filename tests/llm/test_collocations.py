"""Phrase collocations against counting every phrase at once."""

import re
from collections import Counter

import pytest

from cubeshelf.llm import collocations
from tests.llm.helpers import LONG, docs


def slow(rows, least, top=2000, longest=5):
    f, n, out = Counter(), Counter(), []
    for _, text, lang in rows:
        lang = lang or "und"
        low = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split(r"[\x20\x09]", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    c = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    for (lang, p), a in c.items():
        inside = [b for (other, q), b in c.items() if other == lang and len(q) > len(p) and f" {' '.join(p)} " in f" {' '.join(q)} "]
        if any(100 * b >= 100 * a for b in inside):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    rank = Counter()
    for lang, score, a, p, left, right, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            yield lang, rank[lang], p.decode(), -a, left, right, total, -score


ROWS = [
    (1, "The big CAT sat on the big cat. The big cat!\x0bNew York", "en"), (2, None, "en"), (2, None, None), (None, "the  big cat\tsat on\nthe big cat sat, on", None),
    (3, "a a a a a a a", "de"), (4, "", "de"), (5, ".,;:!?\n\r\n", "de"), (6, "ÉTÉ été \x00 x\x0cy", "fr"), (6, LONG, "la"), (7, "New York, new york new\xa0york", "en"),
] * 7


def rows_of(df):
    return [tuple(r) for r in df.orderBy("lang", "rank").collect()]


@pytest.mark.parametrize("shards,chunk_bytes,filter_bits", [(1, 1 << 20, 24), (4, 90, 24), (3, 400, 6)])
def test_collocations(spark, shards, chunk_bytes, filter_bits):
    got = collocations.collocations(docs(spark, ROWS), least=7, shards=shards, chunk_bytes=chunk_bytes, filter_bits=filter_bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = list(slow(ROWS, 7))
    assert rows_of(got) == sorted(want) and any(len(w[2].split()) == 5 for w in want)


def test_first_of_each_language_and_no_rows(spark):
    got = collocations.collocations(docs(spark, ROWS), least=7, top=2, shards=2)
    assert rows_of(got) == sorted(slow(ROWS, 7, top=2))
    assert collocations.collocations(docs(spark, [])).collect() == []
    assert collocations.collocations(docs(spark, [(1, "", "en"), (2, None, None)])).collect() == []


def test_nothing_is_frequent(spark):
    rows = [(i, f"only{i} here{i} once{i}", "en") for i in range(50)]
    assert collocations.collocations(docs(spark, rows), least=3, shards=2).collect() == []
    got = collocations.collocations(docs(spark, rows + [(60, "x y x y x y", "de")]), least=3, shards=2, chunk_bytes=50)
    assert rows_of(got) == sorted(slow(rows + [(60, "x y x y x y", "de")], 3))


def test_products_pass_64_bits(spark):
    big = 4_000_000_000
    phrases = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, big + 2)], "lang string, phrase string, words int, a long")
    got = collocations.scored(phrases, spark.createDataFrame([("en", 9 * 10**18)], "lang string, n long")).first()
    assert got.score == 1000 * big * 9 * 10**18 // ((big + 1) * (big + 2))
