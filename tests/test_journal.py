"""Runs taken up again, commits of several writers, tables declared on demand."""

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubeshelf import session
from cubeshelf.__main__ import main
from cubeshelf.operators import vacuum
from cubeshelf.operators.register import table_name_for, update_table
from cubeshelf.plans import landing_build
from cubeshelf.plans.journal import Journal
from cubeshelf.plans.refresh import STEPS, RefreshConfig, RunStopped, run_refresh
from cubeshelf.plans.sql import register_relation, warehouse_sql
from cubeshelf.schemas import SCHEMA_HISTORY, STORED_CATALOG
from cubeshelf.sources import catalog_store, fs, schema_history

SF = "/root/testdata/sf0.001"


def test_half_written_hand_off_is_replaced(spark, tmp_path):
    j = Journal(spark, str(tmp_path / "run"))
    (tmp_path / "run" / "numbers").mkdir(parents=True)
    (tmp_path / "run" / "numbers" / "part-0.parquet").write_text("cut off")
    assert j.table("numbers", lambda: spark.range(3)).count() == 3
    assert j.table("numbers", lambda: spark.range(9)).count() == 3  # stands
    calls = []
    assert j.step("a", lambda: calls.append(1) or {"n": 7}) == {"n": 7}
    assert j.step("a", lambda: calls.append(2)) == {"n": 7} and calls == [1]
    with pytest.raises(FileNotFoundError):
        run_refresh(spark, resume=str(tmp_path / "nowhere"))
    with pytest.raises(ValueError, match="until"):
        run_refresh(spark, RefreshConfig("l", "r"), until="tea")


def test_steps_on_their_own(spark, tmp_path, capsys):
    """Every step by a command of its own, from a planned work list; a root with a quote in it."""
    landing, root = str(tmp_path / "landing"), str(tmp_path / "o'neil wh")
    landing_build.build_landing(spark, SF, landing, n_tasks=2)
    work = str(tmp_path / "work")
    out = lambda: json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    main(["plan", "--landing", landing, "--root", root, "--as-of", "2001-09-01 00:00:00", "--limit", "2", "--out", work], spark=spark)
    out()
    main(["refresh", "--landing", landing, "--root", root, "--db", "steps_db", "--as-of", "2001-09-01 00:00:00", "--worklist", work,
          "--until", "plan"], spark=spark)
    run = out()["run"]
    for step in STEPS[1:-1]:
        main(["refresh", "--resume", run, "--until", step], spark=spark)
        assert out() == {"run": run, "stopped_after": step}
    assert fs.exists(spark, f"{run}/extracted")
    main(["refresh", "--resume", run], spark=spark)
    done = out()
    assert done["ingest"]["n_ok"] == 2 and done["registered"] == {"create": 2, "refresh": 1} and not fs.exists(spark, f"{run}/extracted")
    main(["refresh", "--resume", run], spark=spark)  # nothing left to do
    assert out() == done
    stored = catalog_store.read_catalog(spark, f"{root}/catalog", STORED_CATALOG)
    assert stored.where("available").count() == 2
    spark.sql("DROP DATABASE steps_db CASCADE")


def test_a_lost_publish_is_not_repeated(spark, tmp_path):
    """The driver dies when folders have been moved and nothing says so."""
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    landing_build.build_landing(spark, SF, landing, n_tasks=2)
    with pytest.raises(RunStopped) as stopped:
        run_refresh(spark, RefreshConfig(landing, root, db="lost_db", as_of="2001-09-01 00:00:00", limit=3), until="publish_plan")
    run = stopped.value.run
    with pytest.raises(RunStopped):
        run_refresh(spark, resume=run, until="publish")
    fs.delete(spark, f"{run}/published")  # as if its commit had not been reached
    fs.delete(spark, f"{run}/_journal/publish.json")
    done = run_refresh(spark, resume=run)
    assert done["ingest"]["n_ok"] == 3 and done["registered"]["create"] == 3
    assert spark.read.parquet(f"{run}/published").where("status = 'published'").count() == 3
    spark.sql("DROP DATABASE lost_db CASCADE")


def test_one_writer_creates_a_file(spark, tmp_path):
    path = str(tmp_path / "commits" / "1.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: fs.create_new(spark, path, str(i).encode()), range(16)))
    assert won.count(True) == 1 and fs.read_text(spark, path) == str(won.index(True))
    assert fs.list_files(spark, str(tmp_path / "commits")) == ["1.json"]


def row(i, title, stamp=None, ordinal=0):
    return (i, title, None, None, None, 0, 1, ordinal, stamp, True)


def test_commits_of_many_writers_are_all_kept(spark, tmp_path):
    root = str(tmp_path / "catalog")
    assert catalog_store.latest_commit(spark, root) is None
    catalog_store.write_catalog(spark.createDataFrame([row(0, "zero")], STORED_CATALOG), root)

    def writer(i):
        mine = spark.createDataFrame([row(i, f"w{i}", ordinal=i)], STORED_CATALOG)
        build = lambda stored, planned_on: stored.where(F.col("productId") != i).unionByName(mine)
        return catalog_store.commit(spark, root, build, STORED_CATALOG, 1, note=f"run-{i}")

    with ThreadPoolExecutor(4) as pool:
        paths = list(pool.map(writer, range(1, 5)))
    got = catalog_store.read_catalog(spark, root, STORED_CATALOG)
    assert sorted(r.productId for r in got.collect()) == [0, 1, 2, 3, 4]
    assert catalog_store.commits(spark, root) == [1, 2, 3, 4, 5]
    assert [catalog_store.commit_of(spark, root, f"run-{i}", since=1) for i in range(1, 5)] == paths
    assert len([n for n in fs.list_dirs(spark, root) if n.startswith("v=")]) == 5  # lost attempts are removed


def test_news_of_another_commit_are_kept(spark):
    fresh = spark.createDataFrame([row(1, "a", ordinal=0), row(2, "b", ordinal=1)], STORED_CATALOG)
    base = spark.createDataFrame([row(1, "a"), row(9, "gone from both")], STORED_CATALOG)
    theirs = spark.createDataFrame([row(1, "a"), row(3, "new there"), row(9, "gone from ours")], STORED_CATALOG)
    got = {r.productId: r.ordinal for r in catalog_store.with_news(fresh, theirs, base).collect()}
    assert got == {1: 0, 2: 1, 3: 2}


def test_older_catalog_with_a_pointer(spark, tmp_path):
    root = str(tmp_path / "catalog")
    spark.createDataFrame([row(1, "old")], STORED_CATALOG).write.parquet(f"{root}/v=20200101T000000-aa")
    fs.write_text(spark, f"{root}/{catalog_store.POINTER}/pointer.txt", "v=20200101T000000-aa\n")
    assert catalog_store.latest_commit(spark, root) == 0
    build = lambda stored, planned_on: stored
    catalog_store.commit(spark, root, build, STORED_CATALOG, 0)
    assert catalog_store.commits(spark, root) == [1]
    assert [r.title for r in catalog_store.read_catalog(spark, root, STORED_CATALOG).collect()] == ["old"]


def history(spark, rows):
    return spark.createDataFrame(rows, T.StructType([*SCHEMA_HISTORY.fields, T.StructField("run", T.StringType())]))


def test_column_changes(spark):
    at = lambda day: dt.datetime(2024, 1, day)
    rows = [(1, "1-a", at(1), ["a", "b", "c"], "r1"), (1, "1-a", at(2), ["a", "x", "c", "d"], "r2"), (1, "1-a", at(3), ["c", "a", "x"], "r3"),
            (1, "1-a", at(4), ["c", "a", "x"], "r4"), (2, "2-b", at(1), ["a"], "r1"), (2, "2-b", at(2), [], "r2")]
    got = sorted((r.productId, r.run, r.change, r.column, r.was) for r in schema_history.changes(history(spark, rows)).collect())
    assert got == [(1, "r2", "added", "d", None), (1, "r2", "renamed", "x", "b"), (1, "r3", "gone", "d", None), (1, "r3", "moved", "a", "0"),
                   (1, "r3", "moved", "c", "2"), (1, "r3", "moved", "x", "1"), (2, "r2", "gone", "a", None)]
    last = {(r.productId, r.folder): r.columns for r in schema_history.latest(history(spark, rows)).collect()}
    assert last == {(1, "1-a"): ["c", "a", "x"], (2, "2-b"): []}


def test_only_named_tables_are_declared(spark, tmp_path):
    """A warehouse of many folders; two have files, nothing lists the others."""
    root = str(tmp_path / "wh")
    rows = [(i, f"{i}-set-{i}-é" if i == 7 else f"{i}-set-{i}", None, ["a", "b"]) for i in range(3000)]
    spark.createDataFrame(rows, SCHEMA_HISTORY).coalesce(4).write.parquet(f"{root}/schemas/run=r1")
    for i, folder in ((5, "5-set-5"), (7, "7-set-7-é"), (9999, "9999-before-the-history")):
        spark.createDataFrame([(f"x{i}", None)], "a string, b string").write.parquet(f"{root}/data/{folder}/{i}.parquet")
    sql = "with t as (select a, b from `5_set_5`) select t.a, (select max(a) from lazy_db.`accented`) as m, t.b from t"
    name = [r[0] for r in spark.createDataFrame([("7-set-7-é",)], "folder string").select(
        table_name_for("folder")).collect()][0]
    sql = sql.replace("accented", name)
    try:
        assert [tuple(r) for r in warehouse_sql(spark, sql, root, "lazy_db").collect()] == [("x5", "x7", "")]
        assert sorted(r.tableName for r in spark.sql("SHOW TABLES IN lazy_db").collect()) == sorted(["5_set_5", name.lower()])
        assert warehouse_sql(spark, "select * from `9999_before_the_history`", root, "lazy_db").count() == 1
        for missing in ("no_such", "12345_x", "catalog", "other_db.`5_set_5`"):
            with pytest.raises(AnalysisException):
                warehouse_sql(spark, f"select * from {'`' + missing + '`' if '.' not in missing else missing}", root, "lazy_db")
        assert not register_relation(spark, root, "lazy_db", "7_other_title")
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE lazy_db CASCADE")


def test_a_table_is_updated_in_place(spark, tmp_path):
    path, name = str(tmp_path / "1-t"), "inplace_db.`1_t`"
    spark.sql("CREATE DATABASE IF NOT EXISTS inplace_db")
    spark.createDataFrame([("x", "y")], "a string, b string").write.parquet(f"{path}/1.parquet")
    spark.sql(f"CREATE TABLE {name} (`a` STRING, `b` STRING) USING parquet OPTIONS (recursiveFileLookup 'true') LOCATION '{path}'")
    property_of = lambda: {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get("gone_columns")
    steps = [("a string, `b c` string", {"added": ["b c"], "gone": ["b"]}, ["a", "b", "b c"], [("x", None, "y")], '["b"]'),
             ("b string, `b c` string", {"added": [], "gone": ["a"]}, ["a", "b", "b c"], [(None, "x", "y")], '["a"]'),
             ("a string, b string, `b c` string", {"added": [], "gone": []}, ["a", "b", "b c"], [("x", "y", "z")], None)]
    for known in (False, True):
        for schema, changed, columns, rows, gone in steps:
            spark.createDataFrame([("x", "y", "z")[:schema.count("string")]], schema).write.mode("overwrite").parquet(f"{path}/1.parquet")
            now = spark.read.parquet(f"{path}/1.parquet").columns
            got = update_table(spark, name, path, now if known else None)
            assert got == (changed if not known else {**changed, "added": []})
            assert spark.table(name).columns == columns and [tuple(r) for r in spark.table(name).collect()] == rows and property_of() == gone
    spark.sql("DROP DATABASE inplace_db CASCADE")


def test_vacuum_spares_what_is_read(spark, tmp_path):
    root = str(tmp_path / "wh")
    cat = f"{root}/catalog"
    paths = [catalog_store.write_catalog(spark.createDataFrame([row(i, "t")], STORED_CATALOG), cat) for i in range(6)]
    names = [p.rsplit("/", 1)[1] for p in paths]
    spark.range(1).write.parquet(f"{cat}/v=20000101T000000-dead")  # of a writer that died
    open_run, ended = (Journal(spark, f"{root}/runs/{n}") for n in ("open", "ended"))
    open_run.mark("plan", {"base": 2})
    ended.mark("plan", {"base": 3})
    ended.mark("clean", {})
    Journal(spark, f"{root}/runs/unplanned").save_settings(RefreshConfig("l", root))
    assert vacuum.vacuum_catalog(spark, root, keep=2) == []  # all of it is young
    assert sorted(vacuum.vacuum_catalog(spark, root, keep=2, grace_s=0)) == sorted(["v=20000101T000000-dead", names[0], names[2], names[3]])
    assert catalog_store.commits(spark, cat) == [2, 5, 6]
    assert catalog_store.read_commit(spark, cat, 2, STORED_CATALOG).first().productId == 1
    assert catalog_store.read_catalog(spark, cat, STORED_CATALOG).first().productId == 5
    catalog_store.write_catalog(spark.createDataFrame([], STORED_CATALOG), cat)
    assert catalog_store.commits(spark, cat)[-1] == 7


def test_staging_of_other_applications(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_root", lambda s: str(tmp_path))
    monkeypatch.setattr(vacuum, "shared_root", lambda s: str(tmp_path))
    mine = session.staging_dir(spark, "x")
    spark.range(1).write.parquet(mine)
    (tmp_path / session.STAGING / "app-gone" / "y-1").mkdir(parents=True)
    assert vacuum.vacuum_staging(spark) == []
    assert vacuum.vacuum_staging(spark, grace_s=0) == ["app-gone"] and fs.exists(spark, mine)
    session.drop_staging(spark)
    assert not fs.exists(spark, mine)
