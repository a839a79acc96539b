import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cubeshelf.operators import ordering, planning

NOW = "2024-06-01 00:00:00"


def _fresh(spark, rows):
    return spark.createDataFrame(rows, "productId string, title string, frequency string, ordinal long")


def _stored(spark, rows):
    df = spark.createDataFrame(rows, "productId string, d string")
    return df.select("productId", F.col("d").cast("timestamp").alias("last_ingestion_date"))


def _reasons(df):
    return {r.productId: r.reason for r in df.collect()}


def test_classify_new_due_and_not_due(spark):
    fresh = _fresh(spark, [("A", "a", "Daily", 0), ("B", "b", "Monthly", 1), ("C", "c", "Annual", 2),
                           ("D", "d", "Monthly", 3)])
    stored = _stored(spark, [("B", "2024-05-01 00:00:00"), ("C", "2024-01-01 00:00:00"), ("D", None),
                             ("Z", "2020-01-01 00:00:00")])
    got = _reasons(planning.classify(fresh, stored, NOW))
    assert got == {"A": "new", "B": "update_due", "D": "new"}  # C not due, Z only stored


def test_classify_uses_fresh_frequency_and_first_row(spark):
    fresh = _fresh(spark, [("A", "first", "Daily", 5), ("A", "second", "Annual", 9)])
    stored = _stored(spark, [("A", "2024-05-30 00:00:00")])
    rows = planning.classify(fresh, stored, NOW).collect()
    assert [(r.title, r.reason) for r in rows] == [("first", "update_due")]


def test_classify_empty_stored_is_all_new(spark):
    fresh = _fresh(spark, [("A", "a", "Daily", 0), ("B", "b", "Weekly", 1)])
    empty = spark.createDataFrame([], "productId string, last_ingestion_date timestamp")
    assert _reasons(planning.classify(fresh, empty, NOW)) == {"A": "new", "B": "new"}


def test_classify_nothing_due_has_fixed_schema(spark):
    fresh = _fresh(spark, [("A", "a", "Annual", 0)])
    stored = _stored(spark, [("A", "2024-05-30 00:00:00")])
    out = planning.classify(fresh, stored, NOW)
    assert out.count() == 0
    assert out.columns == ["productId", "title", "frequency", "reason", "ordinal"]
    assert planning.reason_counts(out).count() == 0


def _work(spark):
    rows = [("n1", "new", 1), ("n2", "new", 2), ("n3", "new", 3), ("u1", "update_due", 4), ("u2", "update_due", 5)]
    return spark.createDataFrame(rows, "productId string, reason string, ordinal long").withColumn("extra_column", F.lit("x"))


@pytest.mark.parametrize("limit,expected", [
    (None, {"n1", "n2", "n3", "u1", "u2"}), (2, {"n1", "n2", "u1", "u2"}), (0, {"u1", "u2"}),
    (10, {"n1", "n2", "n3", "u1", "u2"}),
])
def test_limit_new(limit, expected, spark):
    out = planning.limit_new(_work(spark), limit)
    assert {r.productId for r in out.collect()} == expected
    assert "extra_column" in out.columns


def test_plan_summary(spark):
    w = _work(spark)
    s = planning.plan_summary(w, planning.limit_new(w, 1)).first()
    assert (s.new_before, s.update_due, s.new_after, s.total) == (3, 2, 1, 3)


def test_legacy_filter(spark):
    rows = [(1, "A"), (2, "B INVISIBLE"), (3, "C"), (4, "D"), (5, "E"), (6, "INVISIBLE F"), (7, "G")]
    cat = spark.createDataFrame([(i, t, i) for i, t in rows], "productId long, title string, ordinal long")
    existing = spark.createDataFrame([(4,)], "productId long")
    assert [r.productId for r in planning.legacy_filter(cat, existing, limit=2).collect()] == [1, 3]
    assert planning.legacy_filter(cat, existing, limit=0).count() == 4
    assert planning.legacy_filter(cat, existing, skip_invisible=False).count() == 6


def test_legacy_filter_keeps_null_title_and_null_id(spark):
    cat = spark.createDataFrame([(1, None, 1), (None, "x", 2)], "productId long, title string, ordinal long")
    existing = spark.createDataFrame([(None,), (3,)], "productId long")
    assert planning.legacy_filter(cat, existing).count() == 2


def test_worklist_join_keeps_catalog_columns(spark):
    cat = spark.createDataFrame([(1, "a", "s"), (2, "b", "t"), (3, "c", "u")], "productId long, title string, subject string")
    work = spark.createDataFrame([(1, "new"), (3, "update_due")], "productId long, reason string")
    got = {r.productId: (r.subject, r.reason) for r in planning.worklist_join(cat, work).collect()}
    assert got == {1: ("s", "new"), 3: ("u", "update_due")}


def test_id_membership(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "productId long")
    b = spark.createDataFrame([(2,), (4,)], "productId long")
    got = dict(planning.id_membership(a, b).collect())
    assert got == {1: "left_only", 3: "left_only", 2: "both", 4: "right_only"}


def test_first_per_key_with_hot_key(spark):
    rng = random.Random(3)
    rows = [(0 if i % 3 == 0 else i % 50, rng.randint(0, 10_000), f"v{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, o long, v string")
    got = {r.k: (r.o, r.v) for r in ordering.first_per_key(df, "k", ["o", "v"]).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "o", "v"]).sort_values(["k", "o", "v"]).groupby("k").head(1)
    assert got == {r.k: (r.o, r.v) for r in pdf.itertuples()}


@pytest.mark.parametrize("n_blocks", [2, 7, 64])
def test_running_total_before_matches_cumsum(n_blocks, spark):
    rng = random.Random(n_blocks)
    ords = rng.sample(range(100_000), 2000)
    rows = [(o, float(rng.randint(0, 100))) for o in ords]
    df = spark.createDataFrame(rows, "o long, v double")
    got = {r.o: r.before for r in ordering.running_total_before(df, "v", "o", "before", n_blocks=n_blocks).collect()}
    pdf = pd.DataFrame(rows, columns=["o", "v"]).sort_values("o")
    pdf["before"] = pdf["v"].cumsum() - pdf["v"]
    assert got == dict(zip(pdf["o"], pdf["before"]))


def test_within_budget_includes_crossing_item(spark):
    df = spark.createDataFrame([(1, 4000.0), (2, 5000.0), (3, 2000.0), (4, 10.0)], "o long, mb double")
    got = {r.o: r.started for r in ordering.within_budget(df, "mb", "o", 10_000.0).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False}


@pytest.mark.parametrize("limit", [0, 1, 37, 500, 5000])
def test_limit_new_large_limit_path_matches_topk(limit, spark):
    rng = random.Random(limit)
    ords = rng.sample(range(1_000_000), 1200)
    rows = [(f"p{o}", "new" if i % 4 else "update_due", o) for i, o in enumerate(ords)]
    work = spark.createDataFrame(rows, "productId string, reason string, ordinal long")
    small = {r.productId for r in planning.limit_new(work, limit).collect()}
    large = {r.productId for r in planning.limit_new(work, limit, topk_max=0).collect()}
    assert small == large


@pytest.mark.parametrize("n_blocks", [None, 5])
def test_running_total_with_nulls_strings_and_ties(n_blocks, spark):
    rows = [("b", 2.0), (None, 1.0), ("a", 4.0), ("b", 8.0), (None, 16.0), ("c", None)]
    df = spark.createDataFrame(rows, "o string, v double")
    got = sorted((r.o or "", r.v or 0.0, r.t) for r in ordering.running_total_before(df, "v", "o", "t", n_blocks=n_blocks).collect())
    assert got == [("", 1.0, 0.0), ("", 16.0, 1.0), ("a", 4.0, 17.0), ("b", 2.0, 21.0), ("b", 8.0, 23.0), ("c", 0.0, 31.0)]
    for n in (0, 1, 2, 4, 6, 9):
        few = [(r.o, r.v) for r in ordering.first_n(df, n, "o").collect()]
        many = [(r.o, r.v) for r in ordering.first_n(df, n, "o", topk_max=0).collect()]
        assert sorted(map(repr, few)) == sorted(map(repr, many)) and len(few) == min(n, 6)


@pytest.mark.parametrize("n_blocks", [2, 9])
def test_running_total_paths_agree(n_blocks, spark):
    rng = random.Random(11)
    rows = [(o, float(rng.randint(0, 9))) for o in rng.sample(range(50_000), 3000)]
    df = spark.createDataFrame(rows, "o long, v double")
    got = {r.o: r.b for r in ordering.running_total_before(df, "v", "o", "b", n_blocks=n_blocks).collect()}
    pdf = pd.DataFrame(rows, columns=["o", "v"]).sort_values("o")
    pdf["b"] = pdf["v"].cumsum() - pdf["v"]
    assert got == dict(zip(pdf["o"], pdf["b"]))
