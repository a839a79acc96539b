"""Benchmark decontamination with a broadcast hash set of test n-grams.

Texts are lower-cased (A-Z) and read as runs of digits, a-z and characters
beyond ASCII. A benchmark item's windows are all its `window` consecutive
words; an item with fewer words (but not none) is one window. The distinct
windows, keyed by a 64-bit hash of their words' hashes, are broadcast. A
training document becomes one row per word position inside the running stage
(nothing is shuffled), its window hash is looked up, and hits are verified by
comparing the words themselves. Only hits and one closing row per document
reach the shuffle. All of it is DataFrame functions.

A broadcast holds at most `max_windows` rows and `max_mb` of texts and ids,
both counted before it is sent. The items of a window that very many items
share stand in several rows. A larger benchmark is looked up in more passes
over the documents (written once for that), each with its own share of the
rows; the result is the same.

Null texts have no words. Rows without words are returned with zeros. Repeated
rows get a row each. A null item id hits words, but isn't listed. An empty
benchmark hits nothing; an empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeshelf.llm.common import ASCII_LOWER, ASCII_UPPER, quoted, row_key, staged

#: Rows and MB of windows in one broadcast at most, and about the most items in a row.
MAX_WINDOWS, MAX_MB, ITEMS_PER_ROW = 500_000, 128, 10_000

# Every ASCII character that is no word character.
_BREAKS = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def words(text: Column) -> Column:
    plain = F.translate(F.coalesce(text, F.lit("")), _BREAKS + ASCII_UPPER, " " * len(_BREAKS) + ASCII_LOWER)
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _window_hash(hashes: Column, at: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + i) for i in range(length)])


def benchmark_windows(benchmark: DataFrame, window: int = 10, id_col: str = "item_id", text_col: str = "text",
                      slots: int = 1) -> DataFrame:
    """(win_len, win_text, win_key, slot, items): the distinct windows with the
    ids, as sorted strings, of the items that hold them, dealt to `slots` rows."""
    w = benchmark.select(F.col(quoted(id_col)).cast("string").alias("item"), words(F.col(quoted(text_col))).alias("w"))
    w = w.where(F.size("w") > 0).withColumn("win_len", F.least(F.size("w"), F.lit(window)))
    w = w.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    w = w.select("item", "w", "h", "win_len", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("win_len"))).alias("at"))
    key = reduce(lambda out, n: F.when(F.col("win_len") == n, _window_hash(F.col("h"), F.col("at"), n)).otherwise(out),
                 range(1, window + 1), F.lit(None).cast("long"))
    w = w.select("item", "win_len", key.alias("win_key"), F.pmod(F.xxhash64("item"), F.lit(slots)).alias("slot"),
                 F.array_join(F.slice("w", F.col("at") + 1, F.col("win_len")), " ").alias("win_text"))
    return w.groupBy("win_len", "win_key", "win_text", "slot").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _row_bytes() -> Column:
    """About the memory of a row of windows."""
    ids = F.aggregate("items", F.lit(0).cast("long"), lambda acc, x: acc + 24 + F.octet_length(x))
    return 100 + F.octet_length("win_text") + ids


def _positions(docs: DataFrame, keep: list, lengths: list[int], text_col: str) -> DataFrame:
    """One row per word position and window length, and one closing row at
    the position behind the last word; `key` is null where no window fits."""
    w = docs.select(*keep, words(F.col(quoted(text_col))).alias("w"))
    w = w.withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).withColumn("n_words", F.size("w").cast("long"))
    rows = w.select("*", F.explode(F.sequence(F.lit(0), F.size("w"))).alias("at"))
    fits = lambda n: F.when(F.col("at") + n <= F.col("n_words"), _window_hash(F.col("h"), F.col("at"), n))
    if len(lengths) == 1:
        return rows.withColumn("len", F.lit(lengths[0])).withColumn("key", fits(lengths[0]))
    return rows.select("*", F.inline(F.array(*[F.struct(F.lit(n).alias("len"), fits(n).alias("key")) for n in lengths])))


def _merged(hits: Column) -> Column:
    """Sorted, disjoint [start, end) word ranges that cover the hits."""
    def add(acc, x):
        last = F.element_at(acc, -1)
        grown = F.concat(F.slice(acc, 1, F.size(acc) - 1),
                         F.array(F.struct(last.start.alias("start"), F.greatest(last.end, x.end).alias("end"))))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1).end >= x.start), grown).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(hits), F.array().cast("array<struct<start:int,end:int>>"), add)


def _covered(hits: Column) -> Column:
    """Number of words that the hits cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc, x):
        new = F.greatest(F.lit(0), x.end - F.greatest(acc.end, x.start))
        return F.struct(F.greatest(acc.end, x.end).alias("end"), (acc.n + new).alias("n"))

    return F.aggregate(F.array_sort(hits), zero, add, lambda acc: acc.n)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", max_windows: int = MAX_WINDOWS,
         max_mb: float = MAX_MB, items_per_row: int = ITEMS_PER_ROW) -> DataFrame:
    """(doc_id, key_hash, n_words, n_hit, hits, items, contaminated) of every
    row: `hits` are the verified windows as [start, end) word positions,
    `items` the ids of the items whose windows occur, sorted as strings."""
    slots = -(-benchmark.count() // items_per_row) or 1
    wins = staged(benchmark_windows(benchmark, window, item_id_col, item_text_col, slots), "benchmark-windows")
    found = wins.groupBy("win_len").agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes()).alias("size")).orderBy("win_len").collect()
    lengths = [r.win_len for r in found]
    full = max(sum(r.n for r in found) / max_windows, sum(r["size"] for r in found) / (max_mb * 1e6))
    passes = 1 if full <= 1 else ceil(1.25 * full)  # shares dealt by hash stay under the bound
    key_id, key_hash = row_key(id_col, text_col)
    keep = [F.monotonically_increasing_id().alias("uid"), key_id, key_hash]
    if passes > 1:  # every pass must see the same row numbers
        docs = staged(docs.select(*keep, F.col(quoted(text_col)).alias("text")), "decontaminate-texts")
        keep, text_col = ["uid", "key_id", "key_hash"], "text"
    rows = _positions(docs, keep, lengths or [window], text_col)
    hits = []
    for i in range(passes):
        part = wins.where(F.pmod(F.xxhash64("win_key", "slot"), F.lit(passes)) == i) if passes > 1 else wins
        same = (F.col("key") == F.col("win_key")) & (F.col("len") == F.col("win_len"))
        same &= F.array_join(F.slice("w", F.col("at") + 1, F.col("len")), " ") == F.col("win_text")
        closing = (F.col("at") == F.col("n_words")) if i == 0 else F.lit(False)
        hits.append(rows.join(F.broadcast(part), same, "left" if i == 0 else "inner")
                    .where(closing | F.col("win_text").isNotNull())
                    .select("uid", "key_id", "key_hash", "n_words", "items",
                            F.when(F.col("win_text").isNotNull(),
                                   F.struct(F.col("at").alias("start"), (F.col("at") + F.col("len")).alias("end"))).alias("hit")))
    found = (reduce(DataFrame.union, hits).groupBy("uid", "key_id", "key_hash", "n_words")
             .agg(F.collect_set("hit").alias("hits"), F.collect_set("items").alias("lists")))
    return found.select(F.col("key_id").alias("doc_id"), "key_hash", "n_words", _covered(F.col("hits")).alias("n_hit"),
                        F.array_sort("hits").alias("hits"),
                        F.sort_array(F.array_distinct(F.flatten("lists"))).alias("items"),
                        (F.size("hits") > 0).alias("contaminated"))


def remove(docs: DataFrame, benchmark: DataFrame, whole: bool = True, window: int = 10, id_col: str = "doc_id",
           text_col: str = "text", **names) -> DataFrame:
    """`docs` without the contaminated documents (whole=True), or with the hit
    words, and what follows each up to the next word, cut from their texts."""
    found = scan(docs, benchmark, window, id_col, text_col, **names).where("contaminated")
    found = found.groupBy(F.col("doc_id").alias("hit_id"), F.col("key_hash").alias("hit_hash")).agg(F.first("hits").alias("hits"))
    found = staged(found.withColumn("cuts", _merged(F.col("hits"))), "contaminated")
    cols = [F.col(quoted(c)) for c in docs.columns]
    key_id, key_hash = row_key(id_col, text_col)
    own = docs.select(F.struct(*cols).alias("row"), key_id, key_hash)
    same = F.col("key_id").eqNullSafe(F.col("hit_id")) & F.col("key_hash").eqNullSafe(F.col("hit_hash"))
    if whole:
        return own.join(found, same, "left_anti").select("row.*")
    text = F.col("row." + quoted(text_col))
    letter = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
    tokens = F.regexp_extract_all(text, F.lit(f"[^{letter}]+[{letter}]*"), F.lit(0))
    # The explode keeps the tokens a column: they are computed once a text, not for every cut.
    both = own.join(found, same, "left").select("row", "hits", "cuts", F.explode(F.array(F.when(F.col("hits").isNotNull(), tokens))).alias("tokens"))
    ends = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c.end))
    starts = F.concat(F.transform("cuts", lambda c: c.start), F.array(F.size("tokens")))
    left = F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice("tokens", e + 1, s - e)))
    lead = F.regexp_extract(text, f"^[{letter}]*", 0)
    clean = F.when(F.col("hits").isNull(), text).otherwise(F.concat(lead, F.array_join(left, "")))
    return both.select(*[clean.alias(c) if c == text_col else F.col("row." + quoted(c)).alias(c) for c in docs.columns])
