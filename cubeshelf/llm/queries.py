"""One query for each operator, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from cubeshelf.llm import (alignment, collocations, decontaminate, jaccard, language_id, line_dedup, lm_score, packing, pii, simhash, topk, toxicity,
                           url_filter)
from cubeshelf.llm.common import held_out
from cubeshelf.plans.testbed import table

URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


TOKENIZER = "word_bpe_49k.json"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = language_id.identify(docs, ~held_out("doc_id", 3, 1))
    return got.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def _span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pii.find_spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("long").alias("n_" + k)
    base = F.filter("spans", lambda s: s.kind.isin(*pii.BASE_KINDS))
    return got.select("doc_id", *map(count, pii.BASE_KINDS),
                      F.sha2(_span_text(base).cast("binary"), 256).alias("base_sha256"), _span_text(F.col("spans")).alias("spans"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vecs, vecs.where(F.col("vec_id") % 100 == 0))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return got.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def severity(labels: DataFrame) -> Column:
    """Grades: 0 not toxic, 1 toxic, 2 toxic and of low quality as well."""
    return F.when(F.col("toxic") == 0, 0).when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    got = toxicity.predict(docs, toxicity.learn(docs, labels, severity(labels)))
    return got.select("doc_id", "grade", "expected_severity", "p_toxic", (F.col("grade") > 0).alias("toxic"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return got.select("page_id", "host", "path", "rule", "verdict")


def url_alias_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in chains of five: each but the first names the one before as its
    canonical url, in turn absolute, without scheme, or from the root."""
    url = F.concat(F.regexp_extract("url", "^[^?#]*", 0), F.lit("?p="), F.col("page_id").cast("string"), F.lit("&x=1"))
    pages = table(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    host, tail = F.regexp_extract("to", "^[^:]*://[^/?#]*", 0), F.regexp_extract("to", "^[^:]*://[^/?#]*(.*)$", 1)
    here = F.regexp_extract("url", "^[^:]*://[^/?#]*", 0)
    named = (F.when(host == here, F.concat(F.lit("/."), tail)).when(F.col("page_id") % 2 == 0, F.regexp_replace("to", "^[^:]*:", ""))
             .otherwise(F.col("to")))
    before = pages.select((F.col("page_id") + 1).alias("next"), F.col("url").alias("to")).where(F.col("next") % 5 != 0)
    html = F.concat(F.lit('<html><link rel="canonical" href="'), F.regexp_replace(named, "&", "&amp;"), F.lit('"></html>'))
    linked = pages.join(before, F.col("page_id") == F.col("next"), "left").select("page_id", "url", html.alias("html"))
    return url_filter.judge(linked, URL_RULES).select("page_id", "rule", "verdict")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = lm_score.score(docs, ~held_out("doc_id", 10, 0))
    return got.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_simhash": op2_simhash,
    "op3_pii": op3_pii,
    "op4_topk": op4_topk,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_url_filter": op7_url_filter,
    "url_alias_decisions": url_alias_decisions,
    "op8_packing": op8_packing,
    "op9_decontaminate": op9_decontaminate,
    "op10_lm_score": op10_lm_score,
    "op11_ngram_jaccard": op11_ngram_jaccard,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL = {
    "op4_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as c
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select q.vec_id as query_id, x.vec_id,
         cast(list_sum(list_transform(generate_series(1, least(len(q.c), len(x.c))), lambda i: q.c[i] * x.c[i])) as bigint) as score
  from v q join v x on x.vec_id <> q.vec_id where q.vec_id % 100 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from pairs qualify rank <= 10""",
    "op5_line_dedup": f"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents),
k as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UP}', '{_LOW}') as line_key from l),
often as (select line_key from k where length(line_key) >= 1 group by line_key having count(distinct doc_id) >= 10),
m as (select k.*, often.line_key is not null as gone from k left join often using (line_key))
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(*) filter (where gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from m group by doc_id""",
    "op7_url_filter": f"""
with p as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
q as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p),
rules(verdict, rule_host, rule_path) as (values {", ".join(str(r) for r in URL_RULES)}),
fits as (
  select q.page_id, rule_host || rule_path as rule, verdict from q join rules
  on (q.host = rule_host or ends_with(q.host, '.' || rule_host)) and starts_with(q.path, rule_path)),
best as (select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict from fits group by page_id)
select q.page_id, q.host, q.path, best.rule, coalesce(best.verdict, 'allow') as verdict
from q left join best using (page_id)""",
    "url_alias_decisions": f"""
with p as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
q as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UP}', '{_LOW}') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from p),
rules(verdict, rule_host, rule_path) as (values {", ".join(str(r) for r in URL_RULES)}),
fits as (
  select q.page_id, rule_host || rule_path as rule, verdict from q join rules
  on (q.host = rule_host or ends_with(q.host, '.' || rule_host)) and starts_with(q.path, rule_path)),
best as (select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict from fits group by page_id),
voted as (select q.page_id, q.page_id // 5 as g, best.rule, best.verdict from q left join best using (page_id)),
chain as (select g, bool_or(verdict = 'allow') as allowed, bool_or(verdict = 'block') as blocked from voted group by g)
select page_id, rule, coalesce(verdict, case when allowed then 'allow' when blocked then 'block' else 'allow' end) as verdict
from voted join chain using (g)""",
    "op9_decontaminate": f"""
with w as (
  select item_id, regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
win as (
  select distinct cast(item_id as varchar) as item_id, least(len(w), 10) as n, w[i:i + least(len(w), 10) - 1] as win
  from (select item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) as i from w where len(w) > 0)),
sizes as (select distinct n from win),
d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
pos as (select doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) as i from d, sizes where len(w) >= n),
hit as (select pos.doc_id, pos.i, pos.n, win.item_id from pos join win on pos.n = win.n and pos.w[pos.i:pos.i + pos.n - 1] = win.win),
words as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as j from hit) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id from hit) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)""",
    "op11_ngram_jaccard": f"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i + least(len(w), 4) - 1], ' ') as g
  from (select doc_id, w, unnest(generate_series(1, len(w) - least(len(w), 4) + 1)) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
both_in as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (select x, y from both_in join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 85 * (p.n + q.n - c)),
reach(doc_id, low) as (
  select doc_id, doc_id from documents
  union select l.y, r.low from reach r join (select x, y from links union all select y, x from links) l on r.doc_id = l.x)
select reach.doc_id, cast(coalesce(any_value(n.n), 0) as bigint) as n_shingles, min(low) as component_id
from reach left join n using (doc_id) group by reach.doc_id""",
    "op13_collocations": f"""
with p as (
  select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
w as (select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]'), lambda x: x <> '') as w from p),
totals as (select lang, cast(sum(len(w)) as hugeint) as n from w group by lang),
f as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, cast(count(*) as hugeint) as a
  from (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from w, generate_series(1, 5) as s(k) where len(w) >= k)
  group by all having count(*) >= 100),
c as (select *, string_split(phrase, ' ') as pw from f where k >= 2),
inner_part as (
  select lang, phrase, max(a) as a from (
    select lang, array_to_string(pw[1:k - 1], ' ') as phrase, a from c where k >= 3
    union all select lang, array_to_string(pw[2:k], ' '), a from c where k >= 3) group by all),
cand as (select c.* from c left join inner_part i on c.lang = i.lang and c.phrase = i.phrase where i.a is null or 100 * i.a < 100 * c.a),
cut as (
  select lang, phrase, a, j, array_to_string(pw[1:j], ' ') as lp, array_to_string(pw[j + 1:k], ' ') as rp
  from (select *, unnest(generate_series(1, k - 1)) as j from cand)),
s as (
  select cut.lang, cut.phrase, cut.a, j, x.a as l, y.a as r, n, (1000 * cut.a * n) // (x.a * y.a) as score
  from cut join f x on x.lang = cut.lang and x.phrase = lp join f y on y.lang = cut.lang and y.phrase = rp
  join totals t on t.lang = cut.lang),
best as (select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1)
select lang, cast(row_number() over (partition by lang order by score desc, a desc, phrase) as bigint) as rank, phrase,
       cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from best qualify rank <= 2000""",
}
