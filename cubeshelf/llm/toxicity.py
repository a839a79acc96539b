"""Toxicity by cumulative-link ordinal regression.

Grades of severity are ordered classes. One weight vector over sparse features
is shared by all thresholds t_1 < t_2 < ...: P(grade >= k) = sigmoid(f(x) - t_k),
and the expected severity is the sum of these. Features are the text's
distinct words (lower-cased runs of letters, of any script) and their beginnings of 4 and
5 letters, each hashed to one of 2**20 places. An L1 penalty keeps the few
places that matter, so a long text collects no noise.

The model is fitted in one task on a sample of at most about `max_rows`
labelled rows, taken by a hash of the id; a bounded sample whatever the input.
Every row of the table is scored on its whole text.

Null texts and texts without words get the lowest grade. Rows without a label are scored all the
same; of repeated labels each counts. With no labels the grade and the scores
are null; with a single grade it is predicted for all. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeshelf.llm.common import quoted

BITS, MAX_ROWS, L1, STEPS, CACHE_WORDS = 20, 8_000, 4e-4, 300, 300_000
_WORD = re.compile(r"[^\W\d_]+")


def places(word: str) -> list[int]:
    """The feature places of one word."""
    mask = (1 << BITS) - 1
    return [zlib.crc32(s.encode()) & mask for s in {word, word[:4] + "*", word[:5] + "**"}]


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(rows: list[list[int]], grades: list[int], l1: float = L1, steps: int = STEPS):
    """(places, weights, thresholds, classes) by accelerated proximal gradient
    descent on the mean negative log-likelihood plus the L1 penalty."""
    classes = sorted(set(grades))
    y = np.searchsorted(classes, grades)
    n, k = len(rows), len(classes) - 1
    flat = np.fromiter((f for r in rows for f in r), np.int64)
    used, col = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    seen = np.bincount(col, minlength=len(used))
    col_ok = seen[col] >= 3  # a place seen once or twice tells nothing
    row, col = row[col_ok], col[col_ok]
    share = np.array([(y >= j + 1).mean() for j in range(k)])
    t = -np.log(share / (1 - share))
    w = np.zeros(len(used))
    # Places are scaled by how common they are, so one step size serves rare and common ones.
    scale = 1 / np.sqrt(np.maximum(seen, 1) / n + 1e-3)
    vw, vt, momentum = w.copy(), t.copy(), 1.0
    lr = 1 / (0.25 * max(1, k) * (_largest(row, col, scale, n) if len(row) else 0) + 0.25)
    for _ in range(steps):
        f = np.bincount(row, weights=(vw * scale)[col], minlength=n)
        p = _sigmoid(f[:, None] - vt[None, :])  # P(grade > j)
        up = np.concatenate([np.ones((n, 1)), p, np.zeros((n, 1))], axis=1)
        mass = np.maximum(up[np.arange(n), y] - up[np.arange(n), y + 1], 1e-12)
        d = p * (1 - p)
        sign = np.zeros((n, k))  # d mass / d p
        at = np.arange(n)
        hi, lo = y > 0, y < k
        sign[at[hi], y[hi] - 1] += 1
        sign[at[lo], y[lo]] -= 1
        g = -(sign * d) / mass[:, None] / n
        gw = np.bincount(col, weights=g.sum(axis=1)[row], minlength=len(used)) * scale
        new = vw - lr * gw
        new = np.sign(new) * np.maximum(np.abs(new) - lr * l1 * scale, 0)
        new_t = np.sort(vt + lr * g.sum(axis=0))
        faster = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        vw, vt = new + (momentum - 1) / faster * (new - w), new_t + (momentum - 1) / faster * (new_t - t)
        w, t, momentum = new, new_t, faster
    keep = np.nonzero(w)[0]
    return used[keep], (w * scale)[keep], t, classes


def _largest(row, col, scale, n, rounds: int = 20) -> float:
    """Largest eigenvalue of X'X / n for the scaled features, by power iteration."""
    v = np.ones(col.max() + 1)
    size = 1.0
    for _ in range(rounds):
        v /= np.linalg.norm(v) or 1.0
        u = np.bincount(row, weights=(v * scale[:len(v)])[col], minlength=n)
        v = np.bincount(col, weights=u[row], minlength=len(v)) * scale[:len(v)] / n
        size = np.linalg.norm(v)
    return 1.1 * float(size)


class Grader:
    def __init__(self, at, weights, thresholds, classes):
        self.w = dict(zip(at, weights))
        self.t, self.classes = np.array(thresholds), np.array(classes)
        self.known: dict[str, float] = {}

    def _word(self, word: str) -> float:
        got = self.known.get(word)
        if got is None:
            got = sum(self.w.get(p, 0.0) for p in places(word))
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = got
        return got

    def grade(self, text: str | None) -> tuple:
        """(likeliest grade, expected grade, chance of a grade over the lowest)."""
        if not len(self.classes):
            return None, None, None
        own = words(text)
        if not own:
            return int(self.classes[0]), float(self.classes[0]), float(self.classes[0] > 0)
        f = sum(sorted(map(self._word, own)))
        up = np.concatenate([[1.0], _sigmoid(f - self.t), [0.0]])
        mass = up[:-1] - up[1:]
        return (int(self.classes[mass.argmax()]), float((mass * self.classes).sum()),
                float(up[1]) if len(self.t) else float(self.classes[0] > 0))


def learn(docs: DataFrame, labels: DataFrame, grade: Column, max_rows: int = MAX_ROWS, l1: float = L1,
          id_col: str = "doc_id", text_col: str = "text") -> Grader:
    """Fit on the labelled rows (`grade`: an integer column of `labels`)."""
    lab = labels.select(F.col(quoted(id_col)).alias("lab_id"), grade.cast("int").alias("grade")).dropna()
    n = lab.count()
    if n > max_rows:
        lab = lab.where(F.pmod(F.xxhash64("lab_id", F.lit(1)), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
    own = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    both = own.join(lab, F.col("doc_id") == F.col("lab_id")).select("grade", "text")

    def read(batches):
        for b in batches:
            rows = [[p for w in sorted(words(t)) for p in places(w)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int32()))], ["grade", "at"])

    def fitted(batches):
        rows, grades = [], []
        for b in batches:
            grades += b.column(0).to_pylist()
            rows += b.column(1).to_pylist()
        if rows:
            at, w, t, classes = fit(rows, grades, l1)
            yield pa.RecordBatch.from_arrays([pa.array([at.tolist()], pa.list_(pa.int64())), pa.array([w.tolist()], pa.list_(pa.float64())),
                                              pa.array([t.tolist()], pa.list_(pa.float64())), pa.array([classes], pa.list_(pa.int32()))],
                                             ["at", "w", "t", "classes"])

    model = (both.mapInArrow(read, "grade int, at array<int>").repartition(1)
             .mapInArrow(fitted, "at array<long>, w array<double>, t array<double>, classes array<int>").collect())
    return Grader(*model[0]) if model else Grader([], [], [], [])


def predict(docs: DataFrame, model: Grader, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, grade, expected_severity, p_toxic) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast((model.w, model.t, model.classes))
    src = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    schema = src.select("doc_id").schema.add("grade", "integer").add("expected_severity", "double").add("p_toxic", "double")

    def run(batches):
        w, t, classes = sent.value
        m = Grader([], [], t, classes)
        m.w = w
        for b in batches:
            got = [m.grade(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.int32()),
                                              pa.array([g[1] for g in got], pa.float64()),
                                              pa.array([g[2] for g in got], pa.float64())], schema.names)

    return src.mapInArrow(run, schema)
