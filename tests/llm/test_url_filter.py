"""URL decisions against following links and trying rules one by one."""

import html
import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from cubeshelf.llm import url_filter
from cubeshelf.llm.queries import URL_RULES


def node(url):
    if url is None or "://" not in url:
        return None
    rest = url.split("://", 1)[1].split("#")[0]
    host = re.match("[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host) + rest[len(host):]


def rule_of(n, rules):
    host = re.match("[^/?#]*", n)[0]
    path = re.match("[^?#]*", n[len(host):])[0]
    fits = [(len(h + p), v == "allow", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def slow(pages, rules):
    """`pages`: (id, url, base href or None, [references])."""
    group = {}
    find = lambda x: x if group.setdefault(x, x) == x else find(group[x])
    for _, url, base, refs in pages:
        for r in refs:
            to = html.unescape(r).strip()
            if not to.split("#")[0] or re.match("[a-zA-Z][a-zA-Z0-9+.-]*:(?!//)", to):
                continue
            to = node(urljoin(urljoin(url, base or ""), to))
            if to and node(url):
                group[find(node(url))] = find(to)
    votes = {}
    for n in list(group):
        votes.setdefault(find(n), set()).add(rule_of(n, rules)[1])
    for i, url, _, _ in pages:
        n = node(url)
        rule, verdict = rule_of(n, rules) if n else (None, None)
        said = votes.get(find(n), set()) if n in group else set()
        yield i, rule, verdict or ("allow" if "allow" in said else "block" if "block" in said else "allow")


TAGS = ['<link rel="canonical" href="{}">', "<LINK HREF='{}' rel='next canonical'/>", '<link\nhref="{}"\nrel=canonical >',
        '<meta http-equiv="refresh" content="0; url={}">', "<meta content='5;URL={}' http-equiv=Refresh>"]
OTHER = ['<link rel="stylesheet" href="/canonical.css">', '<link rel="canonicals" href="/es/no">', '<meta name="refresh" content="0;url=/es/no">',
         "<a rel=canonical href=/es/no>", '<link rel="canonical">']
REFS = ["/es/1", "../es/1", "es/./2", "./", "..", "../..", "?page=2&amp;ref=x", "?page=2&#38;ref=x", "#top", "", "mailto:a@b", "//B.net/es/7",
        "https://c.org/y/../z", "x.html", "/a/b/../c#f", "&#x2f;fr/3", "a&lt;b", "../../../up"]


@pytest.mark.parametrize("inline", [200, 0])
def test_random_pages(spark, monkeypatch, inline):
    monkeypatch.setattr(url_filter, "INLINE_RULES", inline)
    pick = random.Random(200)
    hosts = ["a.net", "B.net", "c.org", "www.example.com", "com", "x.y.net"]
    paths = ["", "/", "/x/y.html", "/es/1", "/a/b/c/d", "/x/?page=2&ref=x", "/fr/3", "/es/es/2", "/a/c", "/en/1?q#top", "/up"]
    pages, rows = [], []
    for i in range(160):
        url = f"http://{pick.choice(hosts)}{pick.choice(paths)}"
        base = pick.choice([None, None, None, "/a/b/", "http://c.org/es/x", "sub/"])
        refs = [pick.choice(REFS) for _ in range(pick.choice([0, 0, 1, 1, 2]))]
        tags = [pick.choice(TAGS).format(r) for r in refs] + pick.choices(OTHER, k=2)
        pick.shuffle(tags)
        pages.append((i, url, base, refs))
        rows.append((i, url, "<html>" + (f'<base href="{base}">' if base else "") + "".join(tags) + "</html>"))
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()
    want = sorted(slow(pages, URL_RULES))
    assert sorted((r.page_id, r.rule, r.verdict) for r in got) == want
    assert sum(rule is None and verdict == "block" for _, rule, verdict in want) >= 3  # links decide some


def test_very_long_html_and_many_tags(spark):
    page = "<p>" * 200_000 + TAGS[0].format("/de/9") * 500 + "<link " + "x" * 100_000 + TAGS[0].format("http://a.net/es/1")
    rows = [(1, "http://q.org/1", page), (2, "http://q.org/de/9", None), (2, "http://q.org/de/9", "")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()
    assert sorted((r.page_id, r.verdict) for r in got) == [(1, "block"), (2, "block"), (2, "block")]


def test_a_host_with_very_many_rules(spark):
    """Rules are looked up by host and prefix: pages times lengths, not pages times rules."""
    rules = [("block", "big.org", f"/{i:05d}/") for i in range(20_000)] + [("allow", "big.org", "/00007/ok"), ("block", "big.org", "/00007/ok")]
    listed = spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string")
    pages = spark.range(3000).select(F.col("id").alias("uid"), F.lit("www.big.org").alias("host"), F.format_string("/%05d/ok", "id").alias("path"))
    got = url_filter._joined_rule(pages, listed)
    by = {r.hit_uid: (r.rule, r.verdict) for r in got.collect()}
    assert len(by) == 3000 and by[7] == ("big.org/00007/ok", "allow") and by[9] == ("big.org/00009/", "block")
