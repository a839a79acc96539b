"""Personal data by patterns, checksums and context words.

For each kind a regular expression proposes spans (leftmost, not overlapping
within the kind), validators confirm or drop them (Luhn for cards, mod-97 for
IBANs, value and digit counts), and words shortly before a span adjust its
score. The base kinds (email, ip, card, phone) stay whatever their score; the
added kinds stay from `min_score` up:

* iban: two letters, two check digits, 11 to 30 letters and digits, single
  spaces allowed, mod-97 remainder 1. The country's length decides where it
  ends; where that doesn't fit or isn't known, the longest possible end. Every
  start proposes; a span that starts within an earlier valid one is dropped.
* local_phone: 3-3-4 digits, not within a longer number; stays only with a
  phone word before it.
* national_id: 3-2-4 digits joined by hyphens, likewise with an id word.

All is DataFrame functions. The patterns only repeat single characters or
start where a run starts, so their time and stack stay in proportion to the
text however long a run is. Proposals become rows, offsets are running sums
over a document's rows, and one shuffle by document serves both.

Null and empty texts have no spans. Repeated rows get a row each. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeshelf.llm.common import ASCII_LOWER, ASCII_UPPER, quoted

KINDS = ["email", "ip", "card", "phone", "iban", "local_phone", "national_id"]
BASE_KINDS = KINDS[:4]

#: Code points before a span that are searched for context words, and the
#: proposals before it that hold as many at least (no kind's take under 3 with
#: what parts them).
CONTEXT, CONTEXT_ROWS = 40, 14

# Where a run of these characters starts, or the last match ended within one.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]*+"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_DIGITS = r"[0-9][0-9 -]*[0-9]"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# The length of an IBAN by country: the registry and the codes in use beside it.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_KNOWN = "|".join(
    "(?:" + codes.replace(" ", "|") + ")[0-9]{2}(?: ?[A-Z0-9]{4}){" + str(n // 4 - 1) + "}" + (" ?[A-Z0-9]{" + str(n % 4) + "}" if n % 4 else "")
    for n, codes in _IBAN_LENGTHS.items())
_IBAN_ANY = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
# Takes no text, so that a proposal that turns out wrong hides none that starts within it.
_IBAN = rf"(?<![A-Za-z0-9])(?=((?:{_IBAN_KNOWN})(?![A-Za-z0-9])|{_IBAN_ANY}(?![A-Za-z0-9])))"
_LOCAL = r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"
_NATIONAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

# Context words of each kind, the score without and the gain with one.
_CONTEXT_WORDS = {
    "email": ("mail|contact|correo|courriel", 0.9, 0.1),
    "ip": ("ip|host|server|address|login", 0.6, 0.3),
    "card": ("card|visa|credit|debit|payment|karte|carte|tarjeta", 0.7, 0.3),
    "phone": ("phone|tel|call|mobile|fax|telefon", 0.7, 0.3),
    "iban": ("iban|account|bank|konto|compte|cuenta", 0.8, 0.2),
    "local_phone": ("phone|tel|call|mobile|fax|telefon", 0.3, 0.5),
    "national_id": ("ssn|social security|national id|tax id", 0.3, 0.5),
}


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _mod97(s: Column) -> Column:
    """Remainder of an IBAN (no spaces) by 97, letters counting 10 to 35."""
    turned = F.concat(F.substring(s, 5, F.length(s)), F.substring(s, 1, 4))
    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    step = lambda acc, c: F.when(c >= "A", (acc * 100 + F.ascii(c) - 55) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97)
    return F.aggregate(chars, F.lit(0), lambda acc, c: step(acc, c).cast("int"))


def _proposals(kind: str, text: Column, pattern: str, likely: Column) -> Column:
    """array<struct<kind, at, gap, match, before>>: the pattern's matches, the
    code points between the last match and this one, and the
    CONTEXT code points in front of it in lower case, earlier matches included."""
    takes = kind != "iban"
    # A pattern that takes no text doesn't part the text at its very start: a blank stands before it.
    text = text if takes else F.concat(F.lit(" "), text)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0 if takes else 1))
    # Zipped, so that each side is computed once and not anew for every match; the last gap has no match.
    pairs = F.filter(F.zip_with(found, F.split(text, pattern, -1), lambda m, g: F.struct(m.alias("m"), g.alias("g"))),
                     lambda x: x.m.isNotNull())
    tail = lambda y: F.right(F.concat(y.g, y.m) if takes else y.g, F.lit(CONTEXT))
    earlier = lambda every, i: F.array_join(F.transform(
        F.slice(every, F.greatest(i - CONTEXT_ROWS, F.lit(0)) + 1, F.least(i, F.lit(CONTEXT_ROWS))), tail), "")
    before = lambda every, x, i: F.when(F.length(x.g) < CONTEXT, F.right(F.concat(earlier(every, i), x.g), F.lit(CONTEXT))).otherwise(
        F.right(x.g, F.lit(CONTEXT)))
    # `every` is the one element of an array, so that it, too, is computed once.
    rows = F.flatten(F.transform(F.array(pairs), lambda every: F.transform(every, lambda x, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("at"),
        (F.length(x.g) - (F.lit(0) if takes else F.when(i == 0, 1).otherwise(0))).alias("gap"), x.m.alias("match"),
        F.translate(before(every, x, i), ASCII_UPPER, ASCII_LOWER).alias("before")))))
    return F.when(likely, rows).otherwise(F.array())


def _valid(kind: Column, value: Column) -> Column:
    is_a = lambda k: kind == KINDS.index(k)
    digits = _digits(value)
    n = F.length(digits)
    parts = F.split(value, r"\.")
    bare = F.translate(value, " ", "")
    return (F.when(is_a("ip"), F.forall(parts, lambda p: p.cast("double") <= 255))
            .when(is_a("card"), F.when(n.between(13, 19), F.call_function("luhn_check", digits)).otherwise(False))
            .when(is_a("phone"), n.between(9, 15))
            .when(is_a("iban"), F.when(F.length(bare).between(15, 34), _mod97(bare) == 1).otherwise(False))
            .otherwise(True))


def find_spans(docs: DataFrame, min_score: float = 0.75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; `spans` is an array of (kind, start, end,
    score) in code points, end exclusive, by kind as in KINDS and start."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    t = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(quoted(id_col)).alias("doc_id"), text.alias("t"))
    # Separators next to another one end a card number: they become a sign that no word holds, which keeps all offsets.
    t = t.withColumn("cards", F.when(F.col("t").rlike("[0-9][0-9 -]{11,}[0-9]"),
                                     F.regexp_replace("t", "(?<=[ -])[ -]|[ -](?=[ -])", "|")))
    # A dot that no label follows ends an email's domain; in front of the @ it may be any local character.
    t = t.withColumn("mails", F.when(F.contains("t", F.lit("@")), F.regexp_replace("t", r"\.(?![A-Za-z0-9-])", "_")))
    has = lambda s: F.contains(F.col("t"), F.lit(s))
    dashed = F.col("t").rlike("[0-9]{3}[ .)-]{1,2}[0-9]")
    every = F.concat(
        _proposals("email", F.col("mails"), _EMAIL, F.col("mails").isNotNull()),
        _proposals("ip", F.col("t"), _IP, F.col("t").rlike(r"[0-9]\.[0-9]")),
        _proposals("card", F.col("cards"), _DIGITS, F.col("cards").isNotNull()),
        _proposals("phone", F.col("t"), _PHONE, has("+")),
        _proposals("iban", F.col("t"), _IBAN, F.col("t").rlike("[A-Z]{2}[0-9]{2}[A-Z0-9 ]{11}")),
        _proposals("local_phone", F.col("t"), _LOCAL, dashed),
        _proposals("national_id", F.col("t"), _NATIONAL, has("-") & F.col("t").rlike("[0-9]-[0-9]{2}-[0-9]")),
    )
    rows = t.select("uid", "doc_id", F.explode_outer(every).alias("p"))
    rows = rows.repartition(F.col("uid")).select("uid", "doc_id", "p.*")
    w = Window.partitionBy("uid", "kind").orderBy("at")
    is_iban = F.col("kind") == KINDS.index("iban")
    taken = F.when(is_iban, 0).otherwise(F.length("match"))  # of an iban stands in the next gap
    rows = rows.withColumn("start", F.sum(F.col("gap") + taken).over(w) - taken)
    rows = rows.withColumn("end", F.col("start") + F.length("match"))
    near = F.lit(None).cast("double")
    for i, k in enumerate(KINDS):
        said, base, gain = _CONTEXT_WORDS[k]
        near = F.when(F.col("kind") == i, F.when(F.col("before").rlike(rf"\b(?:{said})"), base + gain).otherwise(F.lit(base))).otherwise(near)
    rows = rows.withColumn("score", near)
    stays = _valid(F.col("kind"), F.col("match")) & ((F.col("kind") < len(BASE_KINDS)) | (F.col("score") >= min_score))
    rows = rows.withColumn("stays", stays)
    rows = rows.withColumn("shut", F.max(F.when(is_iban & F.col("stays"), F.col("end"))).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    stays = F.col("stays") & (F.col("start") >= F.coalesce("shut", F.lit(0)))
    span = F.struct("kind", "start", "end", "score")
    got = rows.groupBy("uid", "doc_id").agg(F.array_sort(F.collect_list(F.when(stays, span))).alias("s"))
    names = F.array(*map(F.lit, KINDS))
    return got.select("doc_id", F.transform("s", lambda s: F.struct(
        F.get(names, s.kind).alias("kind"), s.start.alias("start"), s.end.alias("end"),
        s.score.alias("score"))).alias("spans"))
