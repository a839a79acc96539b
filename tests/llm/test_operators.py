"""Each operator against a slow version, on rows that are hard to take."""

import json
import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cubeshelf.llm import language_id, line_dedup, lm_score, packing, topk, toxicity, url_filter
from cubeshelf.llm.common import held_out
from cubeshelf.llm.queries import URL_RULES
from tests.llm.helpers import ROWS, docs, plain

SPACE = " \t\n\x0b\x0c\r"


def same(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))


def test_unlearned_script_is_not_identified(spark):
    rows = [(1, "the cat sat", "en"), (2, "die katze sitzt", "de"), (3, "η γάτα κάθεται", None), (4, "a cat", None), (5, "42", None)]
    got = language_id.keep_identified(docs(spark, rows), F.col("lang").isNotNull())
    assert sorted(r.doc_id for r in got.collect()) == [1, 2, 4]


# line dedup

def slow_lines(rows, least):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    key = lambda x: low(x.strip(SPACE))
    n = Counter(k for _, t, _ in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if n[key(x)] < least]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_line_dedup(spark, broadcast_rows):
    rows = ROWS + [(20 + i, f"own {i}\n  SAME line\t\nother", None) for i in range(4)]
    got = line_dedup.drop_frequent_lines(docs(spark, rows), min_docs=4, broadcast_rows=broadcast_rows).collect()
    same([(r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got], slow_lines(rows, 4))
    assert line_dedup.drop_frequent_lines(docs(spark, []), broadcast_rows=broadcast_rows).collect() == []


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_line_dedup_counts_distinct_ids(spark, broadcast_rows):
    rows = [(1, f"copied\nown {i}", None) for i in range(6)] + [(None, "copied\nno id", None)] * 6
    rows += [(10 + i, f"common\nown {i}", None) for i in range(4)]
    got = line_dedup.drop_frequent_lines(docs(spark, rows), min_docs=4, broadcast_rows=broadcast_rows).collect()
    same([(r.doc_id, r.n_dropped, r.text) for r in got],
         [(i, int(t.startswith("common")), t.removeprefix("common\n")) for i, t, _ in rows])


# exact top-k

def slow_top(rows, queries, k):
    usable = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    cut = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if usable(v) and i is not None]
    for q, v in queries:
        if usable(v) and q is not None:
            w = [math.floor(1024 * x) for x in v]
            best = sorted((-sum(a * b for a, b in zip(w, x)), i) for i, x in cut if i != q)[:k]
            yield from ((q, r, i, -s) for r, (s, i) in enumerate(best, 1))


def test_top_k(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-1.5, -0.001, 0.0, 0.25, 0.7]) for _ in range(40)]) for i in range(300)]
    rows += [(5, rows[5][1]), (301, None), (302, [None] * 40), (303, [float("nan")] * 40), (304, [float("inf")]), (None, [1.0]),
             (305, []), (306, [1.0, 2.0]), (307, [rnd.random() for _ in range(50)])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, score string, rank int")
    queries = [r for r in rows if r[0] is not None and r[0] % 5 == 0]
    import numpy as np
    flat = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = list(slow_top(flat, [r for r in flat if r[0] is not None and r[0] % 5 == 0], 7))
    for block in (10_000, 9):
        got = topk.exact_top_k(df, df.where(F.col("vec_id") % 5 == 0), k=7, block_queries=block).collect()
        same([tuple(r) for r in got], want)
    assert len(queries) > 50
    assert topk.exact_top_k(df.limit(0), df.limit(0)).collect() == []


def test_top_k_of_large_components(spark):
    rows = [(i, [float(1 << (12 + i % 6)), 0.3, -float(i)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    small = df.where("vec_id % 30 < 8")
    got = topk.exact_top_k(small, small, k=3).collect()
    same([tuple(r) for r in got], slow_top(rows[:8], rows[:8], 3))


# url filter

def test_urls_and_aliases(spark):
    link = '<html><LINK href="{}" rel="canonical"></html>'
    move = "<meta http-equiv=refresh content='0; url={}'>"
    pages = [
        (1, "https://Shop.Example.com/en/a?x#y", None), (2, "http://www.example.com/en/b", ""), (3, None, None), (4, "no scheme", "x"),
        (5, "http://a.net/es/1", "<p>"), (6, "http://a.net/de/1", link.format("/es/1")), (7, "http://b.org/x", move.format("https://a.net/de/1#top")),
        (8, "http://c.org/x", link.format("http://b.com/ok")), (9, "http://c.org/x", None), (10, "http://d.org", link.format("//c.org/x")),
        (11, "http://d.org", link.format("http://a.net/fr/zz")), (12, "http://e.org/q", None), (13, "http://com/", None), (14, "http://b.com", None),
        (None, "http://xnet/es/1", None), (15, "http://net/fr/", None),
    ]
    df = spark.createDataFrame([(*p, "h", "r") for p in pages], "page_id long, url string, html string, host string, rule string")
    for limit in (url_filter.INLINE_RULES, 0):
        url_filter.INLINE_RULES, old = limit, url_filter.INLINE_RULES
        try:
            got = url_filter.judge(df, URL_RULES).collect()
        finally:
            url_filter.INLINE_RULES = old
        same([(r.page_id, r.rule, r.verdict) for r in got], [
            (1, "example.com/en/", "block"), (2, "www.example.com/en/", "allow"), (3, None, "allow"), (4, None, "allow"),
            (5, "net/es/", "block"), (6, None, "block"), (7, None, "block"), (8, None, "allow"), (9, None, "allow"),
            (10, None, "allow"), (11, None, "allow"), (12, None, "allow"), (13, "com/", "allow"), (14, None, "allow"),
            (None, None, "allow"), (15, "net/fr/", "block")])
    assert {r.page_id: r.host for r in got}[1] == "shop.example.com"
    assert url_filter.judge(df.limit(0), URL_RULES).collect() == []


def test_redirect_table(spark):
    df = spark.createDataFrame([(1, "http://q.org/1", ""), (2, "http://q.org/2", "")], "page_id long, url string, html string")
    moved = spark.createDataFrame([("http://q.org/1", "http://a.net/es/9"), (None, "x")], "src string, dst string")
    got = {r.page_id: r.verdict for r in url_filter.judge(df, URL_RULES, moved).collect()}
    assert got == {1: "block", 2: "allow"}


# packing

@pytest.fixture(scope="module")
def tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


def test_encoder_is_the_tokenizer(tokenizer):
    spec = open(tokenizer, encoding="utf-8").read()
    enc, full = packing.Encoder(spec), Tokenizer.from_file(tokenizer)
    texts = [t or "" for _, t, _ in ROWS] + [
        "It's a dog's life, they'LL say: \"no\"...", "ÀÉÎ ΣΑΣ İstanbul ﬁn été á", "tab\tnew\r\nline\x0bvt\x0cff\x1cfs nbsp em",
        "<|endoftext|> x<|startoftext|>y", "日本語 テキスト 12 34.5 ½ ² ¡ª º µ ß ẞ", "a.b,c;d!? word... word?! (x)", "  lead  and  trail  ", "\x00 \x01a"]
    for t in texts:
        assert list(struct.unpack(f"<{len(b := enc.encode(t)) // 4}I", b)) == full.encode(t, add_special_tokens=False).ids, t[:50]


def test_runs_of_many_texts_are_encoded_once(tokenizer):
    enc, full = packing.Encoder(open(tokenizer, encoding="utf-8").read()), Tokenizer.from_file(tokenizer)
    texts = ["One word, one\tWORD. (a)", "", " ", "word... (a) word,,\n\nOne été", "x" * 70_000, "ÉTÉ! été?  été a\x0bb \x00 ßẞ ½"] * 50
    seen, whole = Counter(), enc._whole
    enc._whole = lambda t: seen.update([t]) or whole(t)
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    parts = list(packing._parts(b, 1 << 16))
    got = [ids for p in parts for ids in enc.encode_all(p.column(1))]
    assert len(parts) > 5 and sum(p.num_rows for p in parts) == len(texts)
    for t, ids in zip(texts, got):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == full.encode(t, add_special_tokens=False).ids, t[:50]
    assert seen and max(seen.values()) == 1


@pytest.mark.parametrize("capacity,windows,slack", [(4096, 32, 32), (64, 2, 0), (16, 1, 4)])
def test_packing_is_whole(spark, tokenizer, capacity, windows, slack):
    full = Tokenizer.from_file(tokenizer)
    rows = [(i, t) for i, t, _ in ROWS if t is None or len(t) < 50_000] + [(100 + i, "some words of a text " * (i % 9)) for i in range(60)]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, ids string, left int")
    got = packing.pack(df, tokenizer, capacity=capacity, open_windows=windows, slack=slack).collect()
    parts = defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) // 4 > 0
        parts[r.sequence_id].append(r)
    for seq in parts.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and (at & (at - 1) == 0 or capacity - at <= slack)
    want = Counter((i, tuple(full.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in rows)
    have = Counter()
    for i, ids in want:  # pieces of repeated rows are alike: compare them piece by position
        mine = sorted((r.start, bytes(r.ids)) for r in got if r.doc_id == i and r.doc_tokens == len(ids))
        flat = defaultdict(Counter)
        for start, b in mine:
            for k, x in enumerate(struct.unpack(f"<{len(b) // 4}I", b)):
                flat[start + k][x] += 1
        for k, x in enumerate(ids):
            assert flat[k][x] >= want[(i, ids)]
        have[(i, ids)] = sum(r.length for r in got if r.doc_id == i and r.doc_tokens == len(ids))
    assert sum(r.length for r in got) == sum(len(ids) * n for (_, ids), n in want.items())
    assert packing.pack(df.limit(0), tokenizer).collect() == []


# language

def test_language_profiles(spark):
    known = {"en": "the dog and the cat were in the house with a bird", "de": "der hund und die katze waren im haus mit einem vogel"}
    train = [(i, t, lang) for i, (lang, t) in enumerate([*known.items()] * 5)]
    test = [(20, "the bird was in that house", None), (21, "ein vogel und der hund", None), (22, "123 ...", "en"), (23, None, "en"),
            (24, "", None), (None, "THE CAT", None), (25, "日本語", None), (25, "日本語", None)]
    df = docs(spark, train + test)
    got = language_id.identify(df, F.col("doc_id") < 20).collect()
    by = {r.doc_id: (r.lang_pred, 0 <= r.score <= 1) for r in got}
    assert len(got) == len(train) + len(test) and all(by[i][0] == lang for i, _, lang in train)
    assert [by[i][0] for i in (20, 21, 22, 23, 24, None)] == ["en", "de", "und", "und", "und", "en"]
    assert by[25][0] == "de" and all(ok for _, ok in by.values())  # no n-gram in common: the first by name
    kept = language_id.keep_identified(df, F.col("doc_id") < 20)
    assert kept.columns == df.columns and kept.count() == len(got) - 5  # no letter, or no n-gram that a language has
    nothing = language_id.identify(df, F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language_id.identify(df.limit(0), F.lit(True)).collect() == []


def test_language_distance_is_the_slow_one():
    ranked = {"a": [], "b": []}
    ok = language_id._letters()
    for lang, text in (("a", "abc abd xyz abc"), ("b", "abd zyx zyx ccc")):
        codes, n = language_id.grams(text, ok)
        ranked[lang] = [c for _, c in sorted(zip(-n, codes))][:10]
    m = language_id.Identifier(ranked, 10)
    codes, n = language_id.grams("abc zyx abd", ok)
    mine = [c for _, c in sorted(zip(-n, codes))][:10]
    far = {lang: sum(abs(i - p.index(c)) if c in p else 10 for i, c in enumerate(mine)) for lang, p in ranked.items()}
    lang = min(far, key=lambda k: (far[k], k))
    assert m.predict("abc zyx abd") == (lang, pytest.approx(1 - far[lang] / (10 * len(mine))))


# language model

def test_scores(spark):
    rows = [(i, t, None) for i, t, _ in ROWS] + [(50 + i, "the cat sat on the mat and the dog sat too", None) for i in range(20)]
    got = lm_score.score(docs(spark, rows), ~held_out("doc_id", 10, 0), word_share=1e-3, gram_share=1e-3, chunk_bytes=5000).collect()
    tok = lambda t: [*(t or "").encode().lower().split(), b""]
    out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(w for i, t, _ in rows if not out(i) for w in tok(t))
    total, v = sum(c.values()), len(c)
    want = [(i, not out(i), len(ws := tok(t)), sum(c[w] > 0 for w in ws), total,
             round(sum(lm_score.log10_chance(c[w], total, v) for w in ws), 4)) for i, t, _ in rows]
    same([(r.doc_id, r.learn, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got], want)
    assert all(r.score < 0 for r in got)
    assert lm_score.score(docs(spark, []), F.lit(True)).collect() == []
    alone = lm_score.score(plain(spark, ["a b"]), F.lit(False)).first()
    assert (alone.train_tokens, alone.n_known, alone.base_score) == (0, 0, 0.0)


def test_automaton_adds_up_to_one():
    import numpy as np
    rnd = random.Random(1)
    texts = [[rnd.choice(b"abcdef") for _ in range(rnd.randrange(12))] for _ in range(200)]
    seqs = [[b"", *(bytes([x]) for x in t), b""] for t in texts]
    c = Counter(w for s in seqs for w in s[1:])
    words = sorted(c.items())
    num = {w: i for i, (w, _) in enumerate(words)}
    b, mask = lm_score._BITS, 0
    n2, n3 = Counter(), Counter()
    for s in seqs:
        x = [num[w] for w in s]
        n2.update(p << b | q for p, q in zip(x, x[1:]))
        n3.update(p << 2 * b | q << b | r for p, q, r in zip(x, x[1:], x[2:]))
    as_arrays = lambda n, least: tuple(np.array(z, np.int64) for z in zip(*sorted((k, v) for k, v in n.items() if v >= least)))
    total = sum(c.values())
    m = lm_score.Model(words, [as_arrays(n2, 5), as_arrays(n3, 5)], total, len(c))
    root = m.root(np.array([x for _, x in words], float)).tolist()
    unknown = m.root(np.zeros(1)).tolist()[0]
    for history in ([], ["a"], ["a", "b"], ["c", "c"], ["f", "a", "d"]):
        h = [num[x.encode()] for x in history]
        before = m.walk(h, [root[i] for i in h])
        nexts = [m.walk([*h, i], [*(root[j] for j in h), root[i]]) for i in range(len(words))]
        nexts.append(m.walk([*h, -1], [*(root[j] for j in h), unknown]))
        assert sum(10 ** (x - before) for x in nexts) == pytest.approx(1, abs=1e-9)
    assert mask == 0 and len(m.fail) > len(words)


def test_every_trained_ngram_has_its_arc(spark):
    """Scores of many chunks against the automaton of the whole corpus, in
    which 5e-6 of all tokens are more than one occurrence."""
    import numpy as np
    rnd = random.Random(3)
    rows = [(i, "x y " * 6000, None) for i in range(40)]
    rows += [(100 + i, " ".join(rnd.choice("abcdefghij") + rnd.choice("klmno") for _ in range(rnd.randrange(60))), None) for i in range(60)]
    learn = lambda i: i % 4 != 0
    seqs = {i: [b"", *t.encode().split(), b""] for i, t, _ in rows}
    c = Counter(w for i, q in seqs.items() if learn(i) for w in q[1:])
    words = sorted(c.items())
    num = {w: i for i, (w, _) in enumerate(words)}
    b, n2, n3 = lm_score._BITS, Counter(), Counter()
    for i, q in seqs.items():
        if learn(i):
            x = [num[w] for w in q]
            n2.update(p << b | q for p, q in zip(x, x[1:]))
            n3.update(p << 2 * b | q << b | r for p, q, r in zip(x, x[1:], x[2:]))
    total = sum(c.values())
    assert min(n2.values()) == min(n3.values()) == 1 < total * 5e-6
    m = lm_score.Model(words, [tuple(np.array(z, np.int64) for z in zip(*sorted(n.items()))) for n in (n2, n3)], total, len(c))
    base = lambda q: m.root(np.array([c[w] for w in q], float)).tolist()
    want = {i: m.walk([num.get(w, -1) for w in q[1:]], base(q[1:])) for i, q in seqs.items()}
    got = lm_score.score(docs(spark, rows), F.col("doc_id") % 4 != 0, chunk_bytes=3000).collect()
    assert {r.doc_id: r.score for r in got} == pytest.approx(want, abs=1e-8) and len(got) == len(rows)


def test_scores_of_spread_hot_words(spark):
    """Steps around frequent words, met in several parts, get the same scores,
    at any number of slices."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    text = lambda: " ".join(words[min(int(rnd.paretovariate(0.6)) - 1, 299)] for _ in range(rnd.randrange(120)))
    rows = [(i, text(), None) for i in range(300)] + [(None, None, None), (None, None, None), (7, "", None)]
    learn = F.col("doc_id") % 5 != 0
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens)
    want = sorted(lm_score.score(docs(spark, rows), learn).collect(), key=key)
    for kwargs in ({"hot": 40, "slice_tokens": 300}, {"hot": 1, "slice_tokens": 100}, {"hot": 40, "word_share": 1e-3, "gram_share": 2e-4}):
        if "word_share" in kwargs:
            want = sorted(lm_score.score(docs(spark, rows), learn, word_share=1e-3, gram_share=2e-4, chunk_bytes=1 << 10).collect(), key=key)
        got = sorted(lm_score.score(docs(spark, rows), learn, chunk_bytes=3000, **kwargs).collect(), key=key)
        assert [key(r) for r in got] == [key(r) for r in want] and len(got) == len(rows)
        for g, w in zip(got, want):
            assert (g.n_known, g.train_tokens) == (w.n_known, w.train_tokens)
            assert (g.base_score, g.score) == pytest.approx((w.base_score, w.score), abs=1e-8)


def test_scoring_stages_less_than_it_reads(spark):
    """What is written between the steps stays below the texts' own size."""
    import os
    from cubeshelf.session import STAGING, shared_root

    def staged():
        top = f"{shared_root(spark)}/{STAGING}/{spark.sparkContext.applicationId}"
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(top) for f in files if "/lm-" in d and f.endswith(".parquet"))

    rnd = random.Random(5)
    word = lambda: f"word{min(int(rnd.paretovariate(0.3)), 10 ** 6)}"
    rows = [(i, " ".join(word() for _ in range(400)), None) for i in range(500)]
    before = staged()
    assert lm_score.score(docs(spark, rows), F.col("doc_id") % 10 != 0).count() == len(rows)
    assert staged() - before < sum(len(t) for _, t, _ in rows)


# toxicity

def test_toxicity(spark):
    rnd = random.Random(2)
    plain_words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    rows, labels = [], []
    for i in range(400):
        g = i % 4 if i % 4 < 3 else 0
        ws = rnd.sample(plain_words, 30) + (["meanword"] if g else []) + (["vileword"] if g == 2 else [])
        rnd.shuffle(ws)
        rows.append((i, " ".join(ws), None))
        if i < 300:
            labels.append((i, g))
    labels += [(None, 1), (7, None), (9999, 2)]
    lab = spark.createDataFrame(labels, "doc_id long, g int")
    df = docs(spark, rows + [(500, None, None), (None, "meanword vileword", None), (501, "", None), (501, "", None)])
    got = toxicity.predict(df, toxicity.learn(df, lab, F.col("g"), l1=1e-3)).collect()
    by = {r.doc_id: r for r in got}
    right = sum(by[i].grade == (i % 4 if i % 4 < 3 else 0) for i in range(300, 400))
    assert right >= 97 and len(got) == 404
    assert by[None].grade == 2 and by[500].grade == 0 and by[500].expected_severity <= by[300].expected_severity < by[301].expected_severity < by[302].expected_severity
    none = toxicity.predict(df, toxicity.learn(df, lab.limit(0), F.col("g"))).collect()
    assert {(r.grade, r.expected_severity, r.p_toxic) for r in none} == {(None, None, None)}
    one = toxicity.predict(df, toxicity.learn(df, lab.where("g = 1"), F.col("g"))).collect()
    assert {(r.grade, r.expected_severity) for r in one} == {(1, 1.0)}
    assert toxicity.predict(df.limit(0), toxicity.learn(df, lab, F.col("g"), max_rows=50)).collect() == []
    assert json.dumps(toxicity.places("word"))
