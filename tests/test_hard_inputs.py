"""Inputs on which a refresh must not lose, drop or stop anything."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from cubeshelf.operators import convert, register
from cubeshelf.plans.refresh import RefreshConfig, read_manifest, run_refresh
from cubeshelf.schemas import STORED_CATALOG
from cubeshelf.sources import catalog_store, fs, inventory, listing
from cubeshelf.sources.paths import open_fs
from cubeshelf.streaming.listing_watch import watch_listings

AS_OF = "2025-01-01 00:00:00"


def cube(pid, title, freq="Daily"):
    return {"productId": pid, "cubeTitleEn": title, "subjectEn": "s", "frequencyCode": freq, "dimensions": []}


def landing(path, cubes, files):
    """files: id -> bytes of the archive, or (member, text) to zip."""
    (path / "archives").mkdir(parents=True)
    (path / "listing.json").write_text(json.dumps(cubes), encoding="utf-8")
    for pid, what in files.items():
        p = path / "archives" / f"{pid}.zip"
        if isinstance(what, bytes):
            p.write_bytes(what)
        else:
            with zipfile.ZipFile(p, "w") as z:
                z.writestr(*what)
    return str(path)


def test_hard_names_and_bad_archives(spark, tmp_path):
    src = landing(tmp_path / "lan ding é", [
        cube(1, "Prix Montréal"), cube("2", "Plain title"), cube(2, "Plain title again"), cube(3, "Error page"),
        cube(4, "Zero bytes"), cube(5, "No csv"), cube(6, "Ragged"), cube(7, "Missing"), cube(8, "人口 50% #1 it's"),
    ], {1: ("My Data é.csv", "GEO,VALUE\nCanada,1\n"), 2: ("2.csv", "GEO,VALUE\nx,2\n"), 3: b"<html>sorry</html>", 4: b"",
        5: ("readme.txt", "x"), 6: ("6.csv", "a,b\n1,2\n1,2,3,4\n"), 8: ("8 #.csv", 'a\n"line\nbreak"\n')})
    root, db = str(tmp_path / "ware house"), "hard_names_db"
    out = run_refresh(spark, RefreshConfig(landing=src, root=root, db=db, as_of=AS_OF))
    status = {r.productId: r.status for r in out["report"].collect()}
    assert status == {1: "ok", 2: "ok", 3: "failed", 4: "failed", 5: "failed", 6: "failed", 7: "failed", 8: "ok"}
    assert (out["ingest"]["n_ok"], out["ingest"]["n_deferred"]) == (3, 0)
    assert sorted(r.productId for r in read_manifest(spark, out["run"]).collect()) == [1, 2, 8]
    cat = {r.productId: r for r in spark.read.parquet(out["catalog_path"]).collect()}
    assert sorted(i for i, r in cat.items() if r.last_ingestion_date is not None) == [1, 2, 8]
    assert "failed" not in out["registered"], out["registered"]
    tables = [r.table_name for r in inventory.table_inventory(spark, db).collect() if r.table_name != "catalog"]
    assert sorted(int(t.split("_")[0]) for t in tables) == [1, 2, 8] and all(t.isascii() for t in tables)
    first = next(t for t in tables if t.startswith("1_"))
    assert [tuple(r) for r in spark.table(f"{db}.`{first}`").collect()] == [("Canada", "1")]
    again = run_refresh(spark, RefreshConfig(landing=src, root=root, db=db, as_of=AS_OF))
    assert {r.productId for r in again["report"].collect()} == {3, 4, 5, 6, 7}  # only what failed is new again


def test_cap_defers_and_reports(spark, tmp_path):
    src = landing(tmp_path / "l", [cube(i, f"t{i}") for i in (1, 2, 3)],
                  {i: (f"{i}.csv", "a\n" + "1\n" * 2000) for i in (1, 2, 3)})
    out = run_refresh(spark, RefreshConfig(landing=src, root=str(tmp_path / "w"), db="cap_db", as_of=AS_OF, max_total_gb=1e-9))
    assert {r.productId: r.status for r in out["report"].collect()} == {1: "ok", 2: "deferred", 3: "deferred"}
    assert (out["ingest"]["n_ok"], out["ingest"]["n_failed"], out["ingest"]["n_deferred"]) == (1, 0, 2)


@pytest.mark.parametrize("text", ["<html>error</html>", '[{"productId": 1, "cubeTitleEn": "x"', "[]", '[{"productId": "abc"}]'])
def test_bad_listing_leaves_the_catalog(spark, tmp_path, text):
    src, root = landing(tmp_path / "l", [], {}), str(tmp_path / "w")
    row = spark.createDataFrame([(1, "kept")], "productId long, title string")
    full = row.select([F.col(f.name) if f.name in row.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in STORED_CATALOG.fields])
    catalog_store.write_catalog(full, f"{root}/catalog")
    (tmp_path / "l" / "listing.json").write_text(text)
    with pytest.raises(Exception):
        run_refresh(spark, RefreshConfig(landing=src, root=root, db="bad_db", as_of=AS_OF))
    assert catalog_store.read_catalog(spark, f"{root}/catalog", STORED_CATALOG).count() == 1


def test_lost_pointer_is_no_first_run(spark, tmp_path):
    cat = str(tmp_path / "catalog")
    full = spark.createDataFrame([], STORED_CATALOG)
    path = catalog_store.write_catalog(full, cat)
    fs.delete(spark, f"{cat}/{catalog_store.POINTER}")
    assert path.endswith(catalog_store.latest_version(spark, cat))


@pytest.mark.parametrize("text,rows", [
    ("a,b\n1,2\n   \n\n3,4\n", [("1", "2"), ("3", "4")]), ("a\n1\n  \n2\n", [("1",), ("2",)]),
    ("﻿a,a\n1,\"x\"\"y\"\n", [("1", 'x"y')]), ('a,b\n1,"two\nlines"\n', [("1", "two\nlines")]),
])
def test_readers_agree_on_rows(spark, tmp_path, text, rows):
    p = tmp_path / "f.csv"
    p.write_text(text, encoding="utf-8")
    for i, kw in enumerate(({}, {"multiline": True}, {"multiline": True, "range_bytes": 3}, {"range_bytes": 1})):
        convert.convert_csv(spark, str(p), str(tmp_path / f"o{i}"), **kw)
        got = [tuple(r) for r in spark.read.parquet(str(tmp_path / f"o{i}")).collect()]
        assert sorted(got) == sorted(rows), kw


def test_views_are_no_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS views_db")
    spark.range(1).createOrReplaceTempView("55_tmp")
    assert inventory.table_inventory(spark, "views_db").count() == 0
    spark.catalog.dropTempView("55_tmp")


def test_bad_ddl_stays_alone(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "cat"))
    plan = spark.createDataFrame([(1, "1-a", "1_gone", "deprecate", None), (None, "catalog", "catalog", "refresh", str(tmp_path / "cat"))],
                                 "product_id long, folder string, table_name string, action string, path string")
    got = register.apply_register_plan(spark, plan, "alone_db")
    assert got["failed"] == 1 and got["refresh"] == 1 and len(got["errors"]) == 1


def test_newest_snapshot_is_planned_once(spark, tmp_path):
    import os
    docs = tmp_path / "listings"
    docs.mkdir()
    for at, name, cubes in ((1, "z-old.json", [cube(1, "old"), cube(9, "withdrawn")]), (2, "a-new.json", [cube(1, "new"), cube(2, "two")])):
        (docs / name).write_text(json.dumps(cubes))
        os.utime(docs / name, (1_700_000_000 + at, 1_700_000_000 + at))
    watch_listings(spark, str(docs), str(tmp_path / "cat"), str(tmp_path / "out"), str(tmp_path / "cp"), as_of=AS_OF)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.productId, r.title) for r in got) == [(1, "new"), (2, "two")]


def test_paths_are_paths():
    for p in ("/a b/é#%.zip", "file:/a b/é#%.zip", "file:///a b/é#%.zip"):
        assert open_fs(p)[1] == "/a b/é#%.zip"
