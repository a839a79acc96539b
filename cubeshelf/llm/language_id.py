"""Language identification by rank-order profiles.

A language's profile is the ranking of its `profile` most frequent letter
n-grams (1 to 3 letters, words padded with a blank) in all its training texts.
A document's most frequent n-grams are ranked likewise; its distance to a
language is the sum of how far out of place each n-gram is, `profile` for one
that the language's profile lacks. The nearest language is predicted (of equal
ones the first by name) with score 1 - distance / largest distance.

Null texts and texts without a letter give `und` with score 0; so does every
text if there is nothing to learn from. Rows without a language are not
learned from. Repeated rows count as often as they stand. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cubeshelf.llm.common import quoted, staged

PROFILE, SALTS, UNKNOWN, MAX_LANGUAGES = 400, 16, "und", 20_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, count) of the text's n-grams of 1 to 3 letters in lower case; a
    code holds 21 bits for each letter. Blanks stand only at an end."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    ok = is_letter[c]
    c = np.where(ok, c, 32)
    one = c[ok] << 42
    two = ((c[:-1] << 42) | (c[1:] << 21))[ok[:-1] | ok[1:]]
    three = ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[ok[1:-1]]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def _counts(train: DataFrame) -> DataFrame:
    """(lang, gram, n) summed over all training texts; each task sends its sums."""
    def count(batches):
        is_letter, held, size = _letters(), {}, 0

        def rows():
            for lang, parts in held.items():
                codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()),
                                                  pa.array(n, pa.int64())], ["lang", "gram", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = grams(text, is_letter)
                held.setdefault(lang, []).append(got)
                size += len(got[0])
                if size > 2_000_000:
                    yield from rows()
                    held, size = {}, 0
        yield from rows()

    return train.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def profiles(train: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """Each language's n-grams in the order of their frequency (then code).
    `train`: (lang, text), neither null. The driver gets `SALTS * profile`
    rows of a language at most, and refuses more than MAX_LANGUAGES."""
    counts = staged(_counts(train), "gram-counts")
    langs = counts.select("lang").distinct().count()
    if langs > MAX_LANGUAGES:
        raise ValueError(f"{langs} languages; profiles of {MAX_LANGUAGES} at most are sent to the tasks")
    w = Window.partitionBy("lang", "salt").orderBy(F.desc("n"), "gram")
    best = (counts.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(SALTS))).withColumn("r", F.row_number().over(w))
            .where(F.col("r") <= profile).select("lang", "gram", "n").collect())
    out: dict[str, list] = {}
    for r in best:
        out.setdefault(r.lang, []).append((-r.n, r.gram))
    return {lang: [g for _, g in sorted(rows)[:profile]] for lang, rows in sorted(out.items())}


class Identifier:
    def __init__(self, ranked: dict[str, list[int]], profile: int = PROFILE):
        self.langs, self.profile, self.is_letter = list(ranked), profile, _letters()
        self.grams = np.unique(np.array([g for p in ranked.values() for g in p], dtype=np.int64))
        self.rank = np.full((len(ranked), len(self.grams)), 10 * profile, dtype=np.int64)
        for i, p in enumerate(ranked.values()):
            self.rank[i, np.searchsorted(self.grams, np.array(p, dtype=np.int64))] = np.arange(len(p))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not len(self.grams):
            return UNKNOWN, 0.0
        codes, n = grams(text, self.is_letter)
        if not len(codes):
            return UNKNOWN, 0.0
        codes = codes[np.argsort(-n, kind="stable")[:self.profile]]  # equal counts stay in the order of their codes
        at = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        known = self.grams[at] == codes
        place = np.arange(len(codes))
        off = np.minimum(abs(self.rank[:, at] - place), self.profile)
        distance = np.where(known, off, self.profile).sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], 1 - float(distance[best]) / (self.profile * len(codes))


def identify(docs: DataFrame, train: Column, profile: int = PROFILE, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", carry=()) -> DataFrame:
    """(the columns `carry`, lang_pred, score) of every row. Languages are
    learned from the rows where `train` holds, their language isn't null and
    the text isn't null; predictions see the text alone."""
    spark = docs.sparkSession
    text, lang = F.col(quoted(text_col)), F.col(quoted(lang_col))
    learn = docs.where(train & lang.isNotNull() & text.isNotNull()).select(lang.alias("lang"), text.alias("text"))
    ranked = spark.sparkContext.broadcast(profiles(learn, profile))
    src = docs.select(*[F.col(quoted(c)) for c in carry or (id_col,)], text.alias("text_read"))
    schema = (src.drop("text_read").withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0))).schema

    def run(batches):
        known = Identifier(ranked.value, profile)
        for b in batches:
            got = [known.predict(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())], schema.names)

    return src.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, train: Column, profile: int = PROFILE, text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """`docs` without the rows whose language can't be told: no letter, or no
    n-gram that any profile has (score 0)."""
    names = [F.col(quoted(c)) for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row"), train.alias("learn"), F.col(quoted(text_col)).alias("text"),
                       F.col(quoted(lang_col)).alias("lang"))
    got = identify(rows, F.col("learn"), profile, text_col="text", lang_col="lang", carry=("row",))
    return got.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0)).select("row.*")
