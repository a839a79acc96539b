import json

from cubeshelf.schemas import STORED_CATALOG
from cubeshelf.sources import catalog_store
from cubeshelf.streaming.listing_watch import watch_listings


def test_watch_listings_processes_only_new_documents(spark, tmp_path):
    listings, out, ckpt = tmp_path / "listings", str(tmp_path / "out"), str(tmp_path / "ckpt")
    listings.mkdir()
    cat_dir = str(tmp_path / "catalog")
    stored = spark.createDataFrame([(2, "b", None, "Monthly", None, 0, 0, 1, __import__("datetime").datetime(2024, 5, 20), True)],
                                   STORED_CATALOG)
    catalog_store.write_catalog(stored, cat_dir)

    (listings / "d1.json").write_text(json.dumps([{"productId": 1, "cubeTitleEn": "a", "frequencyCode": "Monthly"},
                                                  {"productId": 2, "cubeTitleEn": "b", "frequencyCode": "Monthly"}]))
    watch_listings(spark, str(listings), cat_dir, out, ckpt, as_of="2024-06-01 00:00:00")
    first = {r.productId: r.reason for r in spark.read.parquet(out).collect()}
    assert first == {1: "new"}

    (listings / "d2.json").write_text(json.dumps([{"productId": 2, "cubeTitleEn": "b", "frequencyCode": "Daily"}]))
    watch_listings(spark, str(listings), cat_dir, out, ckpt, as_of="2024-06-01 00:00:00")
    rows = sorted((r.epoch, r.productId, r.reason) for r in spark.read.parquet(out).collect())
    assert rows == [(0, 1, "new"), (1, 2, "update_due")]
