import zipfile

import pytest
from pyspark.sql import functions as F

from cubeshelf.sources import archives as A


@pytest.mark.parametrize("names,member,error", [
    (["1_MetaData.csv", "1.csv"], "1.csv", None),
    (["1.csv", "1_MetaData.csv"], "1.csv", None),
    (["1_MetaData.csv"], "1_MetaData.csv", None),
    (["1_metadata.csv", "x.txt"], "1_metadata.csv", None),     # lower-case marker is not skipped
    (["DATA.CSV"], "DATA.CSV", None),
    (["sub/1.csv", "readme.txt"], "sub/1.csv", None),
    (["a.txt", "b.xml"], None, "No CSV file found in ZIP. Files: ['a.txt', 'b.xml']"),
    ([], None, "ZIP archive is empty"),
])
def test_choose_member(names, member, error, spark):
    df = spark.createDataFrame([(names,)], "n array<string>")
    m, e = A.choose_member(F.col("n"))
    got = df.select(m, e).first()
    assert tuple(got) == (member, error)


@pytest.mark.parametrize("content,valid,magic", [
    (b"PK\x03\x04rest", True, "504b0304"),
    (b"hello world", False, "68656c6c"),
    (b"<!DOCTYPE html>", False, "3c21444f"),
    (b"PK\x03", False, "504b03"),
    (b"", False, "empty"),
])
def test_signature(content, valid, magic, spark):
    df = spark.createDataFrame([(bytearray(content),)], "c binary")
    got_magic = df.select(A.magic_hex(F.col("c"))).first()[0]
    assert got_magic == magic
    v, reason = A.signature_check(F.lit(got_magic))
    r = df.select(v, reason).first()
    assert r[0] is valid and ((r[1] is None) == valid)
    if not valid:
        assert magic in r[1]


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_inspect_and_extract(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    _zip(land / "1.zip", {"1_MetaData.csv": "meta\n", "1.csv": "a,b\n1,2\n"})
    _zip(land / "2.zip", {"notes.txt": "x"})
    (land / "3.zip").write_bytes(b"<html>error</html>")
    (land / "4.zip").write_bytes(b"")
    rows = [(i, str(land / f"{i}.zip")) for i in range(1, 6)]  # 5 is missing
    arch = spark.createDataFrame(rows, "productId long, archive_path string")
    plan = A.plan_extraction(A.inspect_archives(arch))
    out = {r.productId: r for r in A.extract_members(plan, str(tmp_path / "staging"), n_tasks=2).collect()}
    assert out[1].member == "1.csv" and out[1].error is None
    assert open(out[1].csv_path).read() == "a,b\n1,2\n" and out[1].csv_bytes == 8
    assert out[2].error.startswith("No CSV file found")
    assert "3c68746d" in out[3].error
    assert out[4].magic == "empty" and out[4].length == 0 and "empty" in out[4].error
    assert out[5].read_error is not None and out[5].csv_path is None


def test_extraction_is_idempotent(spark, tmp_path):
    """A retried task writes the same member to the same place."""
    land = tmp_path / "landing"
    land.mkdir()
    _zip(land / "1.zip", {"1.csv": "a,b\n1,2\n"})
    arch = spark.createDataFrame([(1, str(land / "1.zip"))], "productId long, archive_path string")
    plan = A.plan_extraction(A.inspect_archives(arch))
    staging = str(tmp_path / "staging")
    first = [tuple(r) for r in A.extract_members(plan, staging, n_tasks=1).collect()]
    second = [tuple(r) for r in A.extract_members(plan, staging, n_tasks=1).collect()]
    assert first == second
    assert open(first[0][-2]).read() == "a,b\n1,2\n"
