import uuid

from pyspark.sql import functions as F

from cubeshelf.plans import landing_build
from cubeshelf.plans.refresh import RefreshConfig, run_refresh
from cubeshelf.schemas import STORED_CATALOG
from cubeshelf.sources import catalog_store

SF = "/root/testdata/sf0.001"


def test_three_runs(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    landing_build.build_landing(spark, SF, landing, n_tasks=2)
    n_customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    db = "refresh_" + uuid.uuid4().hex[:8]

    first = run_refresh(spark, RefreshConfig(landing, root, db=db, as_of="2001-09-01 00:00:00", workers=3))
    n_ds = first["plan"]["new_before"]
    assert first["plan"]["update_due"] == 0 and first["ingest"]["n_ok"] == n_ds > 0
    assert first["registered"]["create"] == n_ds and first["registered"]["refresh"] == 1
    cat = catalog_store.read_catalog(spark, f"{root}/catalog", STORED_CATALOG)
    assert cat.where("available and last_ingestion_date is not null").count() == n_ds
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data").count() == n_customers
    import os
    run_dir = first["run"]
    assert not os.path.exists(f"{run_dir}/extracted") and not os.path.exists(f"{run_dir}/data")
    assert os.path.exists(f"{run_dir}/manifest") and os.path.exists(f"{run_dir}/report")

    # Same day again: nothing is due; an empty plan is a normal outcome.
    second = run_refresh(spark, RefreshConfig(landing, root, db=db, as_of="2001-09-02 00:00:00"))
    assert second["plan"]["new_before"] == 0 and second["plan"]["update_due"] == 0
    assert second["ingest"]["n_ok"] == 0 and second["registered"] == {"refresh": 1}

    # A month later every monthly dataset is due; re-ingest replaces, never duplicates.
    third = run_refresh(spark, RefreshConfig(landing, root, db=db, as_of="2001-10-02 00:00:00", limit=0))
    assert third["plan"]["update_due"] == n_ds and third["ingest"]["n_ok"] == n_ds
    assert third["registered"] == {"update": n_ds, "refresh": 1}
    assert spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/data").count() == n_customers
    cat3 = catalog_store.read_catalog(spark, f"{root}/catalog", STORED_CATALOG)
    assert cat3.agg(F.min("last_ingestion_date")).first()[0].month == 10
    tables = [t.name for t in spark.catalog.listTables(db)]
    assert "catalog" in tables and len(tables) == n_ds + 1
    assert spark.table(f"{db}.catalog").count() == n_ds
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_budget_and_legacy_mode(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    landing_build.build_landing(spark, SF, landing, n_tasks=2)
    db = "legacy_" + uuid.uuid4().hex[:8]
    # a tiny cap: only the first archive (the one crossing the cap) is started
    r = run_refresh(spark, RefreshConfig(landing, root, db=db, as_of="2001-09-01 00:00:00", max_total_gb=1e-9))
    assert r["ingest"]["n_ok"] == 1
    # legacy mode takes what is not landed yet, limited
    r2 = run_refresh(spark, RefreshConfig(landing, root, db=db, as_of="2001-09-01 00:00:00", legacy=True, limit=2))
    assert r2["ingest"]["n_ok"] == 2
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_choose_work_invisible_switch(spark):
    from cubeshelf.plans.refresh import choose_work
    fresh = spark.createDataFrame([(1, "a", 0), (2, "b INVISIBLE", 1)], "productId long, title string, ordinal long")
    work = spark.createDataFrame([(1, "new"), (2, "new")], "productId long, reason string")
    assert choose_work(fresh, work, None).count() == 2
    assert [r.productId for r in choose_work(fresh, work, None, skip_invisible_planned=True).collect()] == [1]
    existing = spark.createDataFrame([], "productId long")
    assert [r.productId for r in choose_work(fresh, None, existing).collect()] == [1]
