"""URL filters with redirect equivalence.

1. Every url is parsed into host and path. A rule (host, path) fits its host
   and all subdomains when the url's path starts with the rule's; the longest
   fitting rule decides. Long rule lists are joined on (rule host, path prefix),
   not tried one by one: a url offers its host suffixes and path prefixes.
2. A page names aliases: every `<link rel="canonical">` and `<meta http-equiv=
   "refresh">` in its html (relative ones, with entities, under a `<base href>`)
   and rows of an optional table of redirects. Urls
   are compared without scheme and fragment. Aliases are grouped by
   distributed connected components over these edges.
3. A url that no rule fits takes the decision of its group: `allow` if a
   member has an explicit allow, else `block` if a member is blocked, else
   `allow`.

Null urls and those without `://` have an empty host and path, fit no rule
and are allowed. Repeated pages each get their row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeshelf.llm.common import ASCII_LOWER, ASCII_UPPER, quoted, staged
from cubeshelf.llm.graph import connected_components

#: Rules that are written into the plan at most; larger lists are joined.
INLINE_RULES = 200


def after_scheme(url: Column) -> Column:
    """What follows the first `://`; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, ASCII_UPPER, ASCII_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The url without scheme and fragment, host in lower case; null without `://`."""
    rest = F.regexp_extract(after_scheme(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(after_scheme(url).isNotNull(), F.concat(host_of(url), rest))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule (of equal ones an
    allow); null if none fits. `rules`: (verdict, host, path)."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow", r[1:])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _joined_rule(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """`pages` (uid, host, path) -> (uid, found): the longest fitting rule by
    joins; for rule lists too long for the plan. A url offers its host's
    suffixes, then for each one that has rules the path prefixes of their
    lengths, and these pairs meet the rules: a host's rules are looked up,
    never tried one by one."""
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    offered = pages.where(F.col("host") != "").select("uid", "path", F.explode(suffixes).alias("offer"))
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    offered = offered.join(lengths, F.col("offer") == F.col("rule_host")).select(
        "uid", "offer", "path", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"))
    offered = offered.select("uid", "offer", F.substring("path", F.lit(1), F.col("n")).alias("prefix"))
    # of equal rules an allow
    single = rules.groupBy("rule_host", "rule_path").agg(F.min("verdict").alias("verdict"))
    hit = offered.join(single, (F.col("offer") == F.col("rule_host")) & (F.col("prefix") == F.col("rule_path")))
    best = F.struct(F.length(F.concat("rule_host", "rule_path")).alias("n"), (F.col("verdict") == "allow").alias("a"),
                    F.concat("rule_host", "rule_path").alias("rule"), "verdict")
    return hit.groupBy(F.col("uid").alias("hit_uid")).agg(F.max(best).alias("best")).select("hit_uid", "best.rule", "best.verdict")


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a tag, quoted or not; null without one."""
    found = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.when(found != "", decoded(F.trim(F.regexp_replace(found, """^["']|["']$""", ""))))


def decoded(text: Column) -> Column:
    """HTML entities as their characters: the five named ones, and numbers below 128."""
    pieces = F.split(text, "(?i)&#")
    number = r"(?s)^(x[0-9A-Fa-f]{1,6}|[0-9]{1,6});(.*)$"

    def plain(p, i):
        code = F.regexp_extract(p, number, 1)
        value = F.when(F.lower(code).startswith("x"), F.conv(F.substring(code, 2, 6), 16, 10)).otherwise(code).cast("int")
        return F.when(i == 0, p).when((code != "") & (F.length(code) < 5) & (value < 128), F.concat(F.char(value), F.regexp_extract(p, number, 2))) \
            .otherwise(F.concat(F.lit("&#"), p))

    text = F.array_join(F.transform(pieces, plain), "")
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        text = F.regexp_replace(text, f"&{name};", char)
    return text


def resolved(to: Column, base: Column) -> Column:
    """The url that a reference on the page `base` means; null if it is none
    on the web (`mailto:`), or the page itself (empty, or a fragment)."""
    origin = F.regexp_extract(base, r"^[^:/?#]*://[^/?#]*", 0)
    path, tail = F.regexp_extract(to, r"^[^?#]*", 0), F.regexp_extract(to, r"^[^?#]*(\?[^#]*)?", 1)
    folder = F.regexp_extract(path_of(base), r"^(.*/)", 1)
    whole = F.when(path == "", path_of(base)).when(path.startswith("/"), path).when(folder == "", F.concat(F.lit("/"), path)) \
        .otherwise(F.concat(folder, path))
    return (F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
            .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .when(to.startswith("//"), F.concat(F.lit("http:"), to))
            .when((origin != "") & (F.regexp_replace(to, "#.*", "") != ""), F.concat(origin, _without_dots(whole), tail)))


def _without_dots(path: Column) -> Column:
    """An absolute path with its `.` and `..` steps taken."""
    steps = F.split(path, "/")
    last = F.when(F.element_at(steps, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    # the first step, before the leading slash, stays
    take = lambda acc, x: (F.when(x == ".", acc)
                           .when((x == "..") & (F.size(acc) > 1), F.slice(acc, F.lit(1), F.size(acc) - 1))
                           .when(x == "..", acc).otherwise(F.concat(acc, F.array(x))))
    kept = F.aggregate(F.slice(steps, 2, 1 << 30), F.array(F.lit("")), take)
    return F.when(path.contains("/."), F.array_join(F.concat(kept, last), "/")).otherwise(path)


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst): a page's url and those that its canonical links and
    refreshes name, resolved against its first `<base href>` or its url."""
    html, url = F.col(quoted(html_col)), F.col(quoted(url_col))
    tags = F.when(html.rlike("(?i)canonical|refresh"), F.regexp_extract_all(html, F.lit("(?is)<(?:link|meta|base)\\b[^>]*>"), F.lit(0)))
    own = pages.where(url.isNotNull()).select(url.alias("url"), tags.alias("tags")).where(F.size("tags") > 0)
    base = F.get(F.filter(F.transform(F.filter("tags", lambda t: t.rlike(r"(?i)^<base\b")), lambda t: attribute(t, "href")), lambda x: x.isNotNull()), 0)
    own = own.select("url", "tags", F.coalesce(resolved(base, F.col("url")), F.col("url")).alias("base"))

    def named(t):
        moved = F.regexp_extract(attribute(t, "content"), r"""(?is)^[^;,]*[;,]\s*url\s*=\s*["']?([^"']*)""", 1)
        return (F.when(t.rlike(r"(?i)^<link\b") & attribute(t, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)"), attribute(t, "href"))
                .when(t.rlike(r"(?i)^<meta\b") & (F.lower(attribute(t, "http-equiv")) == "refresh"), F.trim(moved)))

    found = own.select("url", "base", F.explode(F.transform("tags", named)).alias("to")).where(F.col("to").isNotNull())
    return found.select(node_of(F.col("url")).alias("src"), node_of(resolved(F.col("to"), F.col("base"))).alias("dst")).dropna()


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], redirects: DataFrame | None = None,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, alias_group) of every page.
    `redirects`: optional (src, dst) urls."""
    spark = pages.sparkSession
    url = F.col(quoted(url_col))
    own = pages.select(F.col(quoted(id_col)).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                       node_of(url).alias("node_url"))
    if len(rules) <= INLINE_RULES:
        own = own.withColumn("found", longest_rule(F.col("host"), F.col("path"), rules))
        own = own.select("*", "found.rule", F.col("found.verdict").alias("ruled")).drop("found")
        own = staged(own, "urls")
    else:
        own = staged(own.withColumn("uid", F.monotonically_increasing_id()), "urls")
        listed = spark.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, rule_host string, rule_path string")
        own = (own.join(_joined_rule(own, listed), F.col("uid") == F.col("hit_uid"), "left")
               .select("page_id", "host", "path", "node_url", "rule", F.col("verdict").alias("ruled")))
        own = staged(own, "ruled-urls")
    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("src")), node_of(F.col("dst"))).dropna())
    groups = staged(connected_components(edges), "url-groups")
    # Aliases may be urls that no page has: rules that fit them count as well.
    at = F.concat(F.lit("http://"), F.col("node"))
    if len(rules) <= INLINE_RULES:
        votes = groups.withColumn("ruled", longest_rule(host_of(at), path_of(at), rules)["verdict"])
    else:
        named = staged(groups.select(F.monotonically_increasing_id().alias("uid"), "component", host_of(at).alias("host"),
                                     path_of(at).alias("path")), "url-nodes")
        votes = (named.join(_joined_rule(named, listed), F.col("uid") == F.col("hit_uid"), "left")
                 .select("component", F.col("verdict").alias("ruled")))
    decided = (votes.groupBy("component").agg(F.max(F.col("ruled") == "allow").alias("allowed"),
                                              F.max(F.col("ruled") == "block").alias("blocked"))
               .select(F.col("component").alias("root"), F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block")
                       .alias("propagated")))
    decided = staged(groups.join(staged(decided, "url-decisions"), F.col("component") == F.col("root"))
                     .select("node", F.col("component").alias("alias_group"), "propagated"), "url-aliases")
    return (own.join(decided, F.col("node_url") == F.col("node"), "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", "propagated", F.lit("allow")).alias("verdict"), "alias_group"))
