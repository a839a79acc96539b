import json

from cubeshelf.sources import listing


def _flatten(spark, cubes):
    return listing.flatten_listing(spark.createDataFrame([(json.dumps(cubes),)], "value string"))


def test_full_row(spark):
    cube = {"productId": 12100163, "cubeTitleEn": "Trade", "subjectEn": "Economy", "frequencyCode": "M",
            "releaseTime": "2024-01-15T08:30", "dimensions": ["GEO", "REF_DATE", "UOM"], "nbDatapointsCube": 99}
    r = _flatten(spark, [cube]).first()
    assert (r.productId, r.title, r.subject, r.frequency, r.releaseTime, r.dimensions, r.nbDatapoints, r.ordinal) == \
        (12100163, "Trade", "Economy", "M", "2024-01-15T08:30", 3, 99, 0)


def test_missing_fields_and_order(spark):
    cubes = [{"productId": 3}, {"productId": 1, "dimensions": []}, {"productId": 2, "dimensions": ["d"] * 60}]
    rows = _flatten(spark, cubes).orderBy("ordinal").collect()
    assert [r.productId for r in rows] == [3, 1, 2]
    assert [r.dimensions for r in rows] == [0, 0, 60]
    assert rows[0].title is None and rows[0].nbDatapoints is None


def test_empty_listing(spark):
    assert _flatten(spark, []).count() == 0


def test_read_listing_file(spark, tmp_path):
    p = tmp_path / "listing.json"
    p.write_text(json.dumps([{"productId": i, "cubeTitleEn": f"t{i}"} for i in range(5)], indent=2))
    out = listing.read_listing(spark, str(p))
    assert sorted((r.productId, r.ordinal) for r in out.collect()) == [(i, i) for i in range(5)]


def test_flatten_cubes_lines(spark):
    rows = [(json.dumps({"productId": 7, "cubeTitleEn": "x"}), 10)]
    r = listing.flatten_cubes(spark.createDataFrame(rows, "j string, o long"), "j", "o").first()
    assert (r.productId, r.title, r.dimensions, r.ordinal) == (7, "x", 0, 10)


def test_multi_document_listing_keeps_global_order(spark, tmp_path):
    from cubeshelf.schemas import CUBE
    rows = [(i * 7 % 50, f"t{i}", None, "M", None, ["a"] * (i % 3), None) for i in range(40)]
    cubes = spark.createDataFrame(rows, CUBE).dropDuplicates(["productId"])
    path = str(tmp_path / "listing")
    listing.write_listing(cubes, path, parts=4)
    import os
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) > 1
    out = listing.read_listing(spark, path).collect()
    ids = sorted(r.productId for r in out)
    assert sorted((r.ordinal, r.productId) for r in out) == list(enumerate(ids))
