import re

import pytest

from cubeshelf.llm import decontaminate
from tests.llm.helpers import ROWS, docs

ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven"),
    (2, "The quick, brown FOX"),
    (3, "fox"), (3, "fox"),
    (4, None), (5, " ... "), (None, "lorem ipsum dolor"),
    (6, "Straße été"),
]
TEXTS = [
    (100, "a one two three four five six seven eight nine ten, eleven b", None),
    (101, "one two three four five six seven eight nine, eleven ten", None),
    (102, "... the QUICK brown fox! the fox; STRASSE Straße été ÉTÉ 7", None),
    (103, "fox fox fox", None),
]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def slow(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(window, len(iw))
        wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w)):
            if n and tuple(w[i:i + n]) in wins:
                hit |= set(range(i, i + n))
                found |= {str(item)} if item is not None else set()
    return len(w), len(hit), sorted(found)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.mark.parametrize("bounds", [{}, {"max_windows": 2}, {"max_mb": 0.0005}, {"items_per_row": 1}])
def test_scan_is_the_slow_one(spark, bench, bounds):
    rows = ROWS + TEXTS
    got = decontaminate.scan(docs(spark, rows), bench, **bounds).collect()
    key = lambda r: repr(r)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got), key=key) == sorted(
        ((i, *(s := slow(t, ITEMS)), s[1] > 0) for i, t, _ in rows), key=key)


def test_empty_sides(spark, bench):
    assert decontaminate.scan(docs(spark, []), bench).collect() == []
    got = decontaminate.scan(docs(spark), bench.limit(0)).collect()
    assert len(got) == len(ROWS) and not any(r.contaminated for r in got)


def test_documents_go(spark, bench):
    rows = ROWS + TEXTS
    kept = decontaminate.remove(docs(spark, rows), bench)
    assert kept.columns == docs(spark, []).columns
    want = [(i, t) for i, t, _ in rows if not slow(t, ITEMS)[1]]
    assert sorted(map(repr, kept.select("doc_id", "text").collect())) == sorted(map(repr, docs(spark, [(*r, None) for r in want]).select("doc_id", "text").collect()))


def test_spans_go(spark, bench):
    got = {r.doc_id: r.text for r in decontaminate.remove(docs(spark, TEXTS), bench, whole=False).collect()}
    assert got == {100: "a b", 101: TEXTS[1][1], 102: "... the STRASSE ÉTÉ 7", 103: ""}


def test_no_python_in_the_plan(spark, bench):
    plan = decontaminate.scan(docs(spark), bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
