import datetime as dt

from pyspark.sql import functions as F

from cubeshelf.operators import catalog as C
from cubeshelf.schemas import STORED_CATALOG
from cubeshelf.sources import catalog_store


def test_mark_available(spark):
    cat = spark.createDataFrame([(i, f"t{i}", "Monthly", "2024", None) for i in range(1, 6)],
                                "productId long, title string, frequency_label string, releaseTime string, available boolean")
    ids = spark.createDataFrame([(1,), (3,), (5,), (5,)], "productId long")
    out = C.mark_available(cat, ids)
    assert out.columns == cat.columns
    assert [r.available for r in out.orderBy("productId").collect()] == [True, False, True, False, True]
    assert cat.where(F.col("available").isNotNull()).count() == 0  # input unchanged


def test_stamp_dates(spark):
    old = dt.datetime(2020, 1, 1)
    cat = spark.createDataFrame([("A", None), ("B", old), ("C", old)], "productId string, last_ingestion_date timestamp")
    ids = spark.createDataFrame([("A",), ("C",)], "productId string")
    got = dict(C.stamp_dates(cat, ids, "2024-06-01 00:00:00").collect())
    assert got == {"A": dt.datetime(2024, 6, 1), "B": old, "C": dt.datetime(2024, 6, 1)}
    none = spark.createDataFrame([], "productId string")
    assert dict(C.stamp_dates(cat, none, "2024-06-01 00:00:00").collect()) == {"A": None, "B": old, "C": old}


def test_merge_metadata_cases(spark):
    fresh = spark.createDataFrame([(1, "new title", "Daily", dt.datetime(1999, 1, 1)), (2, "b", "Weekly", None)],
                                  "productId long, title string, frequency string, last_ingestion_date timestamp")
    stored = spark.createDataFrame([(1, "old", dt.datetime(2024, 1, 1)), (1, "old", dt.datetime(2024, 2, 1)),
                                    (9, "gone", dt.datetime(2024, 1, 1))],
                                   "productId long, title string, last_ingestion_date timestamp")
    out = C.merge_metadata(fresh, stored)
    rows = {r.productId: (r.title, r.last_ingestion_date) for r in out.collect()}
    assert rows == {1: ("new title", dt.datetime(2024, 2, 1)), 2: ("b", None)}
    no_date = spark.createDataFrame([(1, "x", "Daily")], "productId long, title string, frequency string")
    out2 = C.merge_metadata(fresh.drop("last_ingestion_date"), no_date)
    assert out2.where(F.col("last_ingestion_date").isNotNull()).count() == 0
    assert "last_ingestion_date" in out2.columns


def test_ensure_column_and_summary(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, True)], "productId long, available boolean")
    assert "last_ingestion_date" in C.ensure_column(df).columns
    s = C.availability_summary(df).first()
    assert (s.n_available, s.n_total) == (2, 3)


def test_catalog_store_versions(spark, tmp_path):
    root = str(tmp_path / "catalog")
    first = catalog_store.read_catalog(spark, root, STORED_CATALOG)
    assert first.count() == 0 and first.schema == STORED_CATALOG
    v1 = spark.createDataFrame([(1, "a", None, None, None, 0, 1, 0, None, True)], STORED_CATALOG)
    p1 = catalog_store.write_catalog(v1, root)
    back = catalog_store.read_catalog(spark, root, STORED_CATALOG)
    # read the current snapshot and write the next one from it (the in-place trap)
    v2 = back.withColumn("title", F.lit("b"))
    p2 = catalog_store.write_catalog(v2, root)
    assert p1 != p2
    assert catalog_store.read_catalog(spark, root, STORED_CATALOG).first().title == "b"
    assert spark.read.parquet(p1).first().title == "a"


def test_read_optional_propagates_other_errors(spark, tmp_path):
    bad = tmp_path / "not_parquet"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("this is not parquet")
    import pytest
    with pytest.raises(Exception):
        catalog_store.read_optional(spark, str(bad), STORED_CATALOG).collect()


def test_dangling_pointer_is_an_error(spark, tmp_path):
    import pytest
    root = str(tmp_path / "catalog")
    v1 = spark.createDataFrame([(1, "a", None, None, None, 0, 1, 0, None, True)], STORED_CATALOG)
    path = catalog_store.write_catalog(v1, root)
    import shutil
    shutil.rmtree(path)
    with pytest.raises(Exception):
        catalog_store.read_catalog(spark, root, STORED_CATALOG).collect()
