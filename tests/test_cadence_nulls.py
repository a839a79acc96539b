import datetime as dt

import pytest
from pyspark.sql import functions as F

from cubeshelf.functions import cadence
from cubeshelf.functions.nulls import NULL_SYMBOLS, map_null_symbols, null_symbol


@pytest.mark.parametrize("freq,days", [
    ("Daily", 1), ("Weekly", 7), ("Bi-weekly", 14), ("Monthly", 30), ("Quarterly", 90),
    ("Semi-annual", 180), ("Annual", 365), ("Occasional", 180), ("Unknown", 180), ("", 180),
    (None, 180), ("monthly", 180), ("M", 180),
])
def test_frequency_days(freq, days, spark):
    df = spark.createDataFrame([(freq,)], "f string")
    assert df.select(cadence.frequency_days("f")).first()[0] == days


def test_frequency_mapping_extension(spark):
    df = spark.createDataFrame([("M",)], "f string")
    assert df.select(cadence.frequency_days("f", {"M": 30})).first()[0] == 30


@pytest.mark.parametrize("freq,last,now,due", [
    ("Monthly", "2024-01-01 00:00:00", "2024-01-31 00:00:00", True),    # exactly 30 days
    ("Monthly", "2024-01-01 00:00:00", "2024-01-30 23:59:59", False),
    ("Daily", "2024-01-01 00:00:00", "2024-01-02 01:00:00", True),      # 25 hours
    ("Daily", "2024-01-01 23:00:00", "2024-01-02 01:00:00", False),     # crosses midnight, 2 hours
    ("Annual", "2023-01-01 00:00:00", "2024-01-01 00:00:00", True),
    ("Weekly", "2024-01-10 00:00:00", "2024-01-01 00:00:00", False),    # future date
])
def test_is_due(freq, last, now, due, spark):
    df = spark.createDataFrame([(freq, last)], "f string, l string").select(
        "f", F.col("l").cast("timestamp").alias("l"))
    got = df.select(cadence.is_due("f", "l", cadence.timestamp_literal(now))).first()[0]
    assert got is due


def test_days_between_floors_like_python(spark):
    last, now = dt.datetime(2024, 1, 2, 12), dt.datetime(2024, 1, 1, 0)
    df = spark.createDataFrame([(last.isoformat(sep=" "),)], "l string").select(F.col("l").cast("timestamp_ntz").alias("l"))
    got = df.select(cadence.days_between("l", cadence.timestamp_literal(now, like_ntz=True))).first()[0]
    assert got == (now - last).days == -2


def test_every_symbol_is_null_and_others_stay(spark):
    values = NULL_SYMBOLS + [" x ", "a", "P", "0", "12", "x.", "0S", "..x"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = dict(df.select("v", null_symbol("v").alias("n")).collect())
    for s in NULL_SYMBOLS:
        assert got[s] is None
    for v in [" x ", "a", "P", "0", "12", "x.", "0S", "..x"]:
        assert got[v] == v


def test_map_null_symbols_subset_keeps_order(spark):
    df = spark.createDataFrame([("A", "x", "keep")], "GEO string, VALUE string, other string")
    out = map_null_symbols(df, ["VALUE"])
    assert out.columns == ["GEO", "VALUE", "other"]
    assert tuple(out.first()) == ("A", None, "keep")
    assert tuple(map_null_symbols(df).first()) == (None, None, "keep")
