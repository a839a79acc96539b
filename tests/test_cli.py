import json

from cubeshelf.__main__ import main
from cubeshelf.plans import landing_build

SF = "/root/testdata/sf0.001"


def test_cli_plan_refresh_query(spark, tmp_path, capsys, monkeypatch):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "wh")
    landing_build.build_landing(spark, SF, landing, n_tasks=2)
    monkeypatch.setenv("LIMIT", "3")

    assert main(["discover", "--listing", landing + "/listing.json", "--out", str(tmp_path / "catalog.parquet")],
                spark=spark) == 0
    n = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["datasets"]
    assert n == spark.read.parquet(f"{SF}/customer.parquet").select("c_nationkey").distinct().count()

    work_out = str(tmp_path / "catalog_filtered.parquet")
    assert main(["plan", "--landing", landing, "--root", root, "--as-of", "2001-09-01 00:00:00",
                 "--out", work_out], spark=spark) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    summary = json.loads(lines[0])
    assert summary["new_after"] == 3 and len(lines) == 4
    assert spark.read.parquet(work_out).count() == 3

    assert main(["refresh", "--landing", landing, "--root", root, "--db", "cli_db",
                 "--as-of", "2001-09-01 00:00:00"], spark=spark) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["ingest"]["n_ok"] == 3 and out["registered"]["create"] == 3

    spark.sql("DROP DATABASE cli_db CASCADE")   # a new session would start without tables
    assert main(["query", "--root", root, "--db", "cli_db",
                 "select count(*) as n, sum(cast(available as int)) as a from catalog"], spark=spark) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert res["columns"] == ["n", "a"] and int(res["data"][0][1]) == 3
    spark.sql("DROP DATABASE cli_db CASCADE")


def test_cli_watch(spark, tmp_path, capsys):
    listings, root, out = tmp_path / "listings", str(tmp_path / "wh"), str(tmp_path / "out")
    listings.mkdir()
    (listings / "a.json").write_text(json.dumps([{"productId": 1, "cubeTitleEn": "a", "frequencyCode": "Daily"},
                                                 {"productId": 2, "cubeTitleEn": "b", "frequencyCode": "Daily"}]))
    assert main(["watch", "--listings", str(listings), "--root", root, "--out", out,
                 "--as-of", "2024-06-01 00:00:00"], spark=spark) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"out": out}
    assert sorted((r.productId, r.reason) for r in spark.read.parquet(out).collect()) == [(1, "new"), (2, "new")]
