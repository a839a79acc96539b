import hashlib
import re

import pytest

from cubeshelf.llm import pii
from cubeshelf.llm.queries import op3_pii
from tests.llm.helpers import ROWS, docs, plain

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def slow_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and luhn(d) or kind == "phone" and 9 <= len(d) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


HARD = [
    "mail a@b.c..d@e.f, x@y, a._b@c-d.ef-.g. and p%q+r@s.t_u@v.w é@é.com",
    "a@b.c@d.e@f.g h.@i.j @k.l m@.n o@p. q@r.s.",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 1.2.3 .1.2.3.4. 99999999999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111  1111 1111 1111, 4111 1111 1111 1112",
    "4111111111111111 4111 1111 1111 1111 two in a run, - 4111 1111 1111 1111 -",
    "ünï +1 (988) 555-2485 o, +49 30 1234567., +1234 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +33.1.23.45.67.89",
    "++1 988 555 2485 +(1) 5", "4141894974608795", "0000000000000", "5 - 5 - 5", "1", "+", "@", "....", "",
    "1 " * 30_000, "a.b" * 30_000 + "@" + "c.d" * 30_000, "9" * 100_000, "@" * 50_000, "1." * 50_000, "a" * 100_000,
    "+1" + " " * 50_000, ("bob@example.com 10.0.0.1 +1 (988) 555-2485 4111 1111 1111 1111 " * 200),
    "😀 bob@example.com 😀 10.0.0.1",
]


@pytest.mark.parametrize("text", HARD + [t for _, t, _ in ROWS], ids=lambda t: repr(t)[:30])
def test_base_spans(spark, text):
    got = pii.find_spans(plain(spark, [text])).first().spans
    assert [(s.kind, s.start, s.end) for s in got if s.kind in pii.BASE_KINDS] == slow_spans(text)


def test_added_kinds_need_their_checks(spark):
    texts = ["iban DE89 3704 0044 0532 0130 00 ok", "GB82WEST12345698765432", "DE88 3704 0044 0532 0130 00",
             "call me: 555-123-4567", "order 555-123-4567", "ssn 123-45-6789", "part 123-45-6789"]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.find_spans(plain(spark, texts)).collect()}
    assert got == {0: [("iban", 5, 32)], 1: [("iban", 0, 22)], 2: [], 3: [("local_phone", 9, 21)], 4: [],
                   5: [("national_id", 4, 15)], 6: []}


def test_context_raises_the_score(spark):
    a, b = (r.spans[0].score for r in pii.find_spans(plain(spark, ["server 10.0.0.1", "x 10.0.0.1"])).orderBy("doc_id").collect())
    assert a > b


def test_ibans_end_where_the_country_says(spark):
    es, se, at = "ES91 2100 0418 4502 0005 1332", "SE45 5000 0000 0583 9825 7466", "AT611904300234573201"
    texts = [f"{es} BIC X", f"{se} SEK", f"{es} {se}", f"ä {at} EUR, {es}", f"ES91 2100 0418 {se}", f"{es}Q {se[:-1]}", f"x{es}", es]
    got = {r.doc_id: [texts[r.doc_id][s.start:s.end] for s in r.spans if s.kind == "iban"] for r in pii.find_spans(plain(spark, texts)).collect()}
    assert got == {0: [es], 1: [se], 2: [es, se], 3: [at, es], 4: [se], 5: [], 6: [], 7: [es]}


def test_a_context_word_serves_all_spans_within_reach(spark):
    texts = ["Call 212-555-0147 or 212-555-0199", "SSN 123-45-6789, 987-65-4321", "tel" + " 212-555-0147" * 5,
             "ssn " + "x" * 36 + "123-45-6789 987-65-4321", "fax 1 2 3 4 212-555-0147", "my  card  4111 1111 1111 1111"]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.kind not in pii.BASE_KINDS] for r in pii.find_spans(plain(spark, texts)).collect()}
    assert got == {0: [("local_phone", 5, 17), ("local_phone", 21, 33)], 1: [("national_id", 4, 15), ("national_id", 17, 28)],
                   # "tel" stands 1, 14 and 27 code points before the first three, over 37 before the others
                   2: [("local_phone", 4 + 13 * i, 16 + 13 * i) for i in range(3)],
                   3: [("national_id", 40, 51)], 4: [("local_phone", 12, 24)], 5: []}
    low, high = (pii.find_spans(plain(spark, [t])).first().spans[0].score for t in ("x 4111 1111 1111 1111", texts[5]))
    assert low < high


def test_rows_and_empty_table(spark):
    got = pii.find_spans(docs(spark)).collect()
    assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, (r[0] for r in ROWS)))
    assert pii.find_spans(docs(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = pii.find_spans(plain(spark, ["x"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query_over_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op3_pii(spark, sf).collect()}
    src = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(src)
    for r in src:
        spans, row = slow_spans(r.text), got[r.doc_id]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert row.spans.startswith(base)
