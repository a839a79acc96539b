"""Further cases of the original test-suite, re-expressed on Spark frames."""

import pytest
from pyspark.sql import functions as F

from cubeshelf.functions import names as nm
from cubeshelf.operators import convert, planning, publish
from cubeshelf.schemas import all_string


@pytest.mark.parametrize("folder,expected", [
    ("12100163-international-trade-merchandise", 12100163), ("98100001-a-b-c-d", 98100001),
    ("12100163-title/", 12100163),
])
def test_folder_ids_long_and_trailing(folder, expected, spark):
    assert spark.createDataFrame([(folder,)], "f string").select(nm.folder_product_id("f")).first()[0] == expected


def test_classify_multiple_frequencies(spark):
    rows = [("D", "Daily", 0), ("W", "Weekly", 1), ("Q", "Quarterly", 2), ("A", "Annual", 3), ("U", "Whatever", 4)]
    fresh = spark.createDataFrame([(i, i.lower(), f, o) for i, f, o in rows],
                                  "productId string, title string, frequency string, ordinal long")
    stored = spark.createDataFrame([(i, "2024-01-01 00:00:00") for i, _, _ in rows], "productId string, d string") \
        .select("productId", F.col("d").cast("timestamp").alias("last_ingestion_date"))
    # 100 days later: daily, weekly and quarterly are due; annual and unknown (180) are not
    out = planning.classify(fresh, stored, "2024-04-10 00:00:00")
    assert {r.productId for r in out.collect()} == {"D", "W", "Q"}
    assert out.columns == ["productId", "title", "frequency", "reason", "ordinal"]


def test_limit_only_new_and_only_updates(spark):
    new = spark.createDataFrame([(f"n{i}", "new", i) for i in range(5)], "productId string, reason string, ordinal long")
    upd = spark.createDataFrame([(f"u{i}", "update_due", i) for i in range(5)], "productId string, reason string, ordinal long")
    assert [r.productId for r in planning.limit_new(new, 2).orderBy("ordinal").collect()] == ["n0", "n1"]
    assert planning.limit_new(upd, 2).count() == 5
    assert planning.limit_new(upd, 0).count() == 5


def test_string_schema_shapes():
    assert all_string([]).fields == []
    s = all_string([f"c{i}" for i in range(200)])
    assert len(s.fields) == 200 and {f.dataType.simpleString() for f in s.fields} == {"string"}


def test_positional_rename_of_empty_frame(spark):
    df = spark.createDataFrame([], all_string(["a b", "c/d"]))
    out = df.toDF(*nm.sanitize_names(df.columns))
    assert out.columns == ["a_b", "c_d"] and out.count() == 0


def test_manifest_status_on_files(spark, tmp_path):
    missing = publish.manifest_status(spark, str(tmp_path / "nope.csv"))
    assert missing[:2] == (False, publish.MSG_NOT_FOUND)
    (tmp_path / "zero.csv").write_text("")
    assert publish.manifest_status(spark, str(tmp_path / "zero.csv"))[:2] == (False, publish.MSG_NO_DATA)
    (tmp_path / "header.csv").write_text("productId,title,size_mb,file_path\n")
    assert publish.manifest_status(spark, str(tmp_path / "header.csv"))[:2] == (False, publish.MSG_EMPTY)
    rows = "".join(f"{i},t{i},1.5,{i}-t/{i}.parquet\n" for i in range(100))
    (tmp_path / "many.csv").write_text("productId,title,size_mb,file_path\n" + rows)
    ok, msg, df = publish.manifest_status(spark, str(tmp_path / "many.csv"))
    assert ok and msg is None and df.count() == 100
    (tmp_path / "one.csv").write_text("productId,title,size_mb,file_path\n1,a,0.5,1-a/1.parquet\n")
    assert publish.manifest_status(spark, str(tmp_path / "one.csv"))[0] is True


def test_typed_view_over_string_table(spark, tmp_path):
    from cubeshelf.functions.typed import create_typed_view, typed_view
    path = str(tmp_path / "ds")
    spark.createDataFrame([("2020", "Canada", "4680"), ("2021", "Ontario", "4680, 4690"), ("2022", "x", None)],
                          "REF_DATE string, GEO string, VALUE string").write.parquet(path)
    spark.sql("CREATE DATABASE IF NOT EXISTS typed_db")
    spark.sql(f"CREATE TABLE typed_db.ds USING parquet LOCATION '{path}'")
    name = create_typed_view(spark, "typed_db.ds", {"REF_DATE": "int", "VALUE": "double"})
    rows = sorted(tuple(r) for r in spark.table(name).collect())
    assert rows == [(2020, "Canada", 4680.0), (2021, "Ontario", None), (2022, "x", None)]
    assert [f.dataType.simpleString() for f in spark.table(name).schema] == ["int", "string", "double"]
    df = typed_view(spark.table("typed_db.ds"), {"VALUE": "bigint"})
    assert sorted(r.VALUE for r in df.collect() if r.VALUE is not None) == [4680]
    spark.sql("DROP DATABASE typed_db CASCADE")


def test_quoted_symbols_and_padded_values(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('GEO,VALUE,STATUS\n"x","..","E"\n"A"," x ",""\n"Canada","12",F\n')
    out = str(tmp_path / "q.parquet")
    convert.convert_csv(spark, str(p), out)
    rows = sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=str)
    assert rows == sorted([(None, None, None), (None, " x ", None), ("Canada", "12", None)], key=str)
