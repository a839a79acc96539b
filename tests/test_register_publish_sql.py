import os

from pyspark.sql import functions as F

from cubeshelf.operators import publish as P
from cubeshelf.operators import register as R
from cubeshelf.plans.sql import render, sql_strings
from cubeshelf.sources import fs, inventory


def _folders(spark, names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "folder string, ordinal long")


def _tables(spark, names):
    return spark.createDataFrame([(n,) for n in names], "table_name string")


def test_new_folders(spark):
    folders = _folders(spark, ["1-a", "2-b", "catalog", "nodash", "3-c", "12345"])
    tables = _tables(spark, ["1_a", "catalog", "abc_table", "12345_x"])
    got = [r.folder for r in R.new_folders(folders, tables).orderBy("ordinal").collect()]
    assert got == ["2-b", "3-c"]
    assert R.new_folders(_folders(spark, []), tables).count() == 0
    assert R.new_folders(folders, _tables(spark, [])).count() == 4


def test_register_plan_actions(spark):
    folders = _folders(spark, ["1-a", "2-b-new", "3-c"])
    tables = _tables(spark, ["1_a", "2_b_old", "4_gone", "catalog"])
    plan = {(r.product_id, r.action): r.path for r in R.register_plan(folders, tables, "s3://b/data/", "s3://b/catalog/").collect()}
    assert plan == {(1, "keep"): "s3://b/data/1-a/", (2, "relocated"): "s3://b/data/2-b-new/",
                    (3, "create"): "s3://b/data/3-c/", (4, "deprecate"): None, (None, "refresh"): "s3://b/catalog/"}


def test_apply_register_plan(spark, tmp_path):
    data = tmp_path / "data"
    for pid in (1, 2):
        spark.createDataFrame([(str(pid), "x")], "a string, b string").write.parquet(str(data / f"{pid}-t" / f"{pid}.parquet"))
    cat_dir = tmp_path / "catalog"
    spark.createDataFrame([(1, "t")], "productId long, title string").write.parquet(str(cat_dir / "v=1"))
    folders = inventory.folder_inventory(spark, str(data))
    assert [r.folder for r in folders.collect()] == ["1-t", "2-t"]
    db = "cubeshelf_test_db"
    plan = R.register_plan(folders, inventory.table_inventory(spark, "default"), str(data) + "/", str(cat_dir / "v=1"))
    counts = R.apply_register_plan(spark, plan, db)
    assert counts == {"create": 2, "refresh": 1}
    assert spark.table(f"{db}.`1_t`").count() == 1
    assert spark.table(f"{db}.catalog").count() == 1
    plan2 = R.register_plan(folders, inventory.table_inventory(spark, db), str(data) + "/", str(cat_dir / "v=1"))
    assert {r.action for r in plan2.collect()} == {"keep", "refresh"}
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_manifest_check_order(spark):
    rows = [(False, None, 5), (True, "EmptyDataError", 0), (True, None, 0), (True, None, 3)]
    df = spark.createDataFrame(rows, "e boolean, err string, n long")
    v, m = P.manifest_check(F.col("e"), F.col("err"), F.col("n"))
    got = [tuple(r) for r in df.select(v, m).collect()]
    assert got == [(False, P.MSG_NOT_FOUND), (False, P.MSG_NO_DATA), (False, P.MSG_EMPTY), (True, None)]


def test_publish_plan_and_execute(spark, tmp_path):
    src = tmp_path / "data"
    spark.createDataFrame([("1",)], "a string").write.parquet(str(src / "1-a" / "1.parquet"))
    manifest = spark.createDataFrame([(1, "a", 0.1, "1-a/1.parquet"), (2, "b", 0.2, "2-b/2.parquet")],
                                     "productId long, title string, size_mb double, file_path string")
    landed = fs.landed_files(spark, str(src))
    dest = str(tmp_path / "published") + "/"
    plan = P.publish_plan(manifest, landed, dest)
    actions = {r.productId: r.action for r in plan.collect()}
    assert actions == {1: "publish", 2: "skip_missing"}
    done = P.execute_publish(plan, str(src), n_tasks=2).collect()
    assert [(r.file_path, r.status) for r in done] == [("1-a/1.parquet", "published")]
    assert spark.read.parquet(dest + "1-a/1.parquet").count() == 1


def test_sql_strings_and_render(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "a int, b string, c double")
    out = sql_strings(spark, "select * from {t}", t=df)
    assert [f.dataType.simpleString() for f in out.schema] == ["string"] * 3
    assert render(out) == {"columns": ["a", "b", "c"], "data": [["1", "", "2.5"]], "truncated": False}
    twice = render(sql_strings(spark, "select 1 as x, 2 as x, 3 as `a``b`"))
    assert twice["columns"] == ["x", "x", "a`b"] and twice["data"] == [["1", "2", "3"]]
    assert render(sql_strings(spark, "select id from range(5)"), max_rows=2)["truncated"]
    assert len(render(sql_strings(spark, "select id from range(5)"), max_rows=2)["data"]) == 2


def test_update_action_picks_up_new_schema(spark, tmp_path):
    data = tmp_path / "data"
    spark.createDataFrame([("1", "x")], "a string, b string").write.parquet(str(data / "1-t" / "1.parquet"))
    cat = str(tmp_path / "catalog" / "v=1")
    spark.createDataFrame([(1, "t")], "productId long, title string").write.parquet(cat)
    db = "cubeshelf_update_db"
    folders = inventory.folder_inventory(spark, str(data))
    R.apply_register_plan(spark, R.register_plan(folders, inventory.table_inventory(spark, "default"),
                                                 str(data) + "/", cat), db)
    assert spark.table(f"{db}.`1_t`").columns == ["a", "b"]
    # re-published with an extra column
    spark.createDataFrame([("1", "x", "new")], "a string, b string, c string").write.mode("overwrite") \
        .parquet(str(data / "1-t" / "1.parquet"))
    ids = spark.createDataFrame([(1,)], "productId long")
    plan = R.register_plan(folders, inventory.table_inventory(spark, db), str(data) + "/", cat,
                           refreshed=ids)
    assert {r.action for r in plan.collect()} == {"update", "refresh"}
    R.apply_register_plan(spark, plan, db)
    assert spark.table(f"{db}.`1_t`").columns == ["a", "b", "c"]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_publish_twice_replaces(spark, tmp_path):
    src = tmp_path / "data"
    dest = str(tmp_path / "published") + "/"
    manifest = spark.createDataFrame([(1, "a", 0.1, "1-a/1.parquet")],
                                     "productId long, title string, size_mb double, file_path string")
    for rows in ([("1",)], [("1",), ("2",)]):
        spark.createDataFrame(rows, "a string").write.mode("overwrite").parquet(str(src / "1-a" / "1.parquet"))
        plan = P.publish_plan(manifest, fs.landed_files(spark, str(src)), dest)
        assert [r.status for r in P.execute_publish(plan, str(src), n_tasks=1).collect()] == ["published"]
        assert spark.read.parquet(dest + "1-a/1.parquet").count() == len(rows)
    assert os.listdir(dest + "1-a") == ["1.parquet"]


def test_text_pointer_helpers(spark, tmp_path):
    p = str(tmp_path / "ptr" / "pointer.txt")
    assert fs.read_text(spark, p) is None
    fs.write_text(spark, p, "v=1\n")
    fs.write_text(spark, p, "v=2\n")
    assert fs.read_text(spark, p) == "v=2\n"


def test_retitled_dataset_and_deprecation(spark, tmp_path):
    data = tmp_path / "data"
    for folder in ("1-old-title", "1-new-title", "2-b"):
        pid = folder.split("-")[0]
        spark.createDataFrame([(pid,)], "a string").write.parquet(str(data / folder / f"{pid}.parquet"))
    cat = str(tmp_path / "catalog" / "v=1")
    spark.createDataFrame([(1, "t")], "productId long, title string").write.parquet(cat)
    db = "cubeshelf_retitle_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    # table 1 was registered under the old title; table 3 has lost its folder
    spark.sql(f"CREATE TABLE {db}.`1_old_title` USING parquet OPTIONS (recursiveFileLookup 'true') "
              f"LOCATION '{data / '1-old-title'}'")
    spark.sql(f"CREATE TABLE {db}.`3_gone` (a string) USING parquet LOCATION '{tmp_path / 'gone'}'")
    folders = inventory.folder_inventory(spark, str(data))
    plan = R.register_plan(folders, inventory.table_inventory(spark, db), str(data) + "/", cat)
    got = sorted((r.product_id, r.folder, r.action) for r in plan.collect() if r.product_id is not None)
    assert got == [(1, "1-new-title", "relocated"), (1, "1-old-title", "keep"), (2, "2-b", "create"),
                   (3, None, "deprecate")]
    counts = R.apply_register_plan(spark, plan, db)
    assert counts == {"relocated": 1, "create": 1, "deprecate": 1, "refresh": 1}
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {db}.`3_gone`").collect()}
    assert props.get("deprecated") == "true"
    assert spark.catalog.tableExists(f"{db}.`1_new_title`") and spark.catalog.tableExists(f"{db}.`3_gone`")
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_declared_schema_skips_inference(spark, tmp_path):
    data = tmp_path / "data"
    spark.createDataFrame([("1", "x")], "a string, `b c` string").write.parquet(str(data / "1-t" / "1.parquet"))
    cat = str(tmp_path / "catalog" / "v=1")
    spark.createDataFrame([(1, "t")], "productId long, title string").write.parquet(cat)
    db = "cubeshelf_declared_db"
    folders = inventory.folder_inventory(spark, str(data))
    plan = R.register_plan(folders, inventory.table_inventory(spark, "default"), str(data) + "/", cat)
    R.apply_register_plan(spark, plan, db, schemas={1: ["a", "b c"]})
    t = spark.table(f"{db}.`1_t`")
    assert t.columns == ["a", "b c"] and [tuple(r) for r in t.collect()] == [("1", "x")]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_folder_of_an_earlier_title_is_left_behind(spark):
    folders = spark.createDataFrame([("1-old-title",), ("1-new-title",), ("2-same",), ("3-not-yet-again",), ("notes",)], "folder string")
    catalog = spark.createDataFrame([(1, "New title"), (2, "Same"), (2, "Same"), (3, "Renamed, not ingested"), (None, None)],
                                    "productId long, title string")
    got = R.current_folders(folders, catalog)
    assert sorted(r.folder for r in got.collect()) == ["1-new-title", "2-same", "3-not-yet-again", "notes"]
    assert R.current_folders(folders.limit(0), catalog).collect() == []


def test_publish_by_rename_can_run_again(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "data"
    plan = spark.createDataFrame([("7-t/7.parquet", f"{dst}/7-t/7.parquet", "publish"), ("8-t/8.parquet", f"{dst}/8-t/8.parquet", "publish")],
                                 "file_path string, target string, action string")
    for value in ("old", "new"):
        spark.createDataFrame([(value,)], "v string").write.parquet(str(src / "7-t" / "7.parquet"))
        for _ in range(2):  # the second time the folder has moved already
            done = {r.file_path: r for r in P.execute_publish(plan, str(src), n_tasks=1, move=True).collect()}
            assert done["7-t/7.parquet"].status == "published" and done["7-t/7.parquet"].bytes > 0
            assert done["8-t/8.parquet"].status.startswith("failed")
            assert not (src / "7-t" / "7.parquet").exists()
            assert [r.v for r in spark.read.parquet(str(dst / "7-t" / "7.parquet")).collect()] == [value]
    assert not list((tmp_path / "data-publishing").glob("*"))


def test_a_dataset_is_copied_file_by_file(spark, tmp_path, monkeypatch):
    """Many tasks copy one dataset; if a file can't be copied, the old one stays whole."""
    src, root = tmp_path / "data", tmp_path / "wh" / "data"
    spark.range(200).repartition(40).write.parquet(str(src / "1-a" / "1.parquet"))
    spark.range(5).write.parquet(str(src / "2-b" / "2.parquet"))
    spark.range(7).write.parquet(str(root / "2-b" / "2.parquet"))
    plan = spark.createDataFrame([(f"{n}/{n[0]}.parquet", f"{root}/{n}/{n[0]}.parquet", "publish") for n in ("1-a", "2-b", "3-gone")],
                                 "file_path string, target string, action string")
    copied = P._copied(plan.where("file_path like '1%'").select("file_path", "target"), str(src))
    assert copied.count() == 1
    parts = len(list((src / "1-a" / "1.parquet").glob("part-*")))
    (src / "2-b" / "2.parquet" / "broken.parquet").symlink_to(tmp_path / "nowhere")
    monkeypatch.setattr(P.fs, "landed_files", lambda s, r: spark.createDataFrame(
        [(str(p.relative_to(src)), str(p.parent.relative_to(src)), 1) for p in src.glob("*/*/*.parquet")], "rel_path string, rel_dir string, length long"))
    done = {r.file_path[0]: r for r in P.execute_publish(plan, str(src)).collect()}
    assert parts > 10 and done["1"].status == "published" and done["1"].bytes > 0
    assert done["2"].status.startswith("failed") and done["3"].status.startswith("failed")
    assert spark.read.parquet(str(root / "1-a" / "1.parquet")).count() == 200
    assert spark.read.parquet(str(root / "2-b" / "2.parquet")).count() == 7
