import os

import pytest

from cubeshelf.operators import convert as C


def _write(tmp_path, name, text, encoding="utf-8"):
    p = tmp_path / name
    p.write_bytes(text.encode(encoding))
    return str(p)


def _convert(spark, tmp_path, text, name="d.csv"):
    src = _write(tmp_path, name, text)
    out = str(tmp_path / (name + ".parquet"))
    info = C.convert_csv(spark, src, out)
    return spark.read.parquet(out), info


def test_values_stay_strings_and_symbols_become_null(spark, tmp_path):
    text = 'REF_DATE,GEO,VALUE\n2020,Canada,4680\n2021,"Ontario, Canada","4680, 4690"\n2022,A,x\n2023,B,..\n2024,C, x \n'
    df, _ = _convert(spark, tmp_path, text)
    assert [f.dataType.simpleString() for f in df.schema] == ["string"] * 3
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("2020", "Canada", "4680"), ("2021", "Ontario, Canada", "4680, 4690"),
                    ("2022", None, None), ("2023", None, None), ("2024", None, " x ")]


def test_odd_headers_are_sanitized(spark, tmp_path):
    df, info = _convert(spark, tmp_path, "Column Name,Another/Column,With-Hyphen\n1,2,3\n")
    assert df.columns == ["Column_Name", "Another_Column", "With_Hyphen"]


def test_wide_dataset(spark, tmp_path):
    header = ",".join(f"col_{i}" for i in range(50))
    body = "\n".join(",".join(str(r * 100 + i) for i in range(50)) for r in range(10))
    df, _ = _convert(spark, tmp_path, header + "\n" + body + "\n")
    assert len(df.columns) == 50 and df.count() == 10


def test_quotes_newlines_blank_lines_and_bom(spark, tmp_path):
    text = '﻿A,B\n"line one\nline two","say ""hi"""\n\n3,4\n'
    df, _ = _convert(spark, tmp_path, text)
    assert df.columns == ["A", "B"]
    assert sorted(tuple(r) for r in df.collect()) == [("3", "4"), ("line one\nline two", 'say "hi"')]


def test_duplicate_blank_and_colliding_headers(spark, tmp_path):
    df, info = _convert(spark, tmp_path, "a,a,,GEO,Geo,x y,x-y\n1,2,3,4,5,6,7\n")
    assert df.columns == ["a", "a.1", "Unnamed:_2", "GEO", "Geo_2", "x_y", "x_y_2"]
    assert tuple(df.first()) == tuple(str(i) for i in range(1, 8))


def test_ragged_rows_fail_the_file(spark, tmp_path):
    src = _write(tmp_path, "bad.csv", "a,b\n1,2\n3\n")
    with pytest.raises(Exception):
        C.convert_csv(spark, src, str(tmp_path / "bad.parquet"))


def test_quarantine_routes_bad_rows(spark, tmp_path):
    src = _write(tmp_path, "bad.csv", "a,b\n1,2\n3\n4,5,6\n")
    out = str(tmp_path / "q.parquet")
    info = C.convert_csv(spark, src, out, quarantine=True)
    assert info["rejects"] == 2
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [("1", "2")]


def test_empty_file_is_an_error(spark, tmp_path):
    src = _write(tmp_path, "empty.csv", "")
    with pytest.raises(C.EmptyFileError):
        C.read_header(spark, src)


def test_batch_isolates_failures(spark, tmp_path):
    good = _write(tmp_path, "g.csv", "a,b\n1,2\n")
    bad = _write(tmp_path, "b.csv", "a,b\n1,2,3\n")
    items = spark.createDataFrame([
        (1, "good", "1-good", good, 10, None),
        (2, "bad", "2-bad", bad, 10, None),
        (3, "no archive", "3-no-archive", None, None, "Not a valid ZIP file (magic bytes: empty)"),
    ], "productId long, title string, folder string, csv_path string, length long, error string")
    report = C.convert_batch(spark, items, str(tmp_path / "data"), workers=2)
    got = {r.productId: r for r in report.collect()}
    assert got[1].status == "ok" and got[1].file_path == "1-good/1.parquet" and got[1].size_mb > 0
    assert got[2].status == "failed" and got[3].status == "failed"
    assert C.manifest_of(report).count() == 1
    s = C.ingest_summary(report).first()
    assert (s.n_ok, s.n_failed) == (1, 2)
    labels = {r.productId: r.error_label for r in C.with_error_labels(report).collect()}
    assert labels[1] is None and labels[3] == "Not a valid ZIP file (magic bytes: empty)"
    assert labels[2] == got[2].error_class or len(labels[2]) <= 50


def test_batch_timeout_is_reported(spark, tmp_path):
    rows = "\n".join(f"{i},{'v' * 50}" for i in range(200_000))
    big = _write(tmp_path, "big.csv", "a,b\n" + rows + "\n")
    items = spark.createDataFrame([(1, "big", "1-big", big, 10, None)],
                                  "productId long, title string, folder string, csv_path string, length long, error string")
    report = C.convert_batch(spark, items, str(tmp_path / "data"), timeout_s=0.01).first()
    assert report.status == "failed" and report.error_class == "ConversionTimeout"
    ok = C.convert_batch(spark, items, str(tmp_path / "data2")).first()
    assert ok.status == "ok"


def test_line_mode_chosen_only_when_safe(spark, tmp_path):
    plain = _write(tmp_path, "plain.csv", "a,b\n" + "".join(f'{i},"v, {i}"\n' for i in range(2000)))
    quoted = _write(tmp_path, "quoted.csv", "a,b\n" + "".join(f'{i},"line\n{i}"\n' for i in range(2000)))
    assert not C.has_quoted_newlines(spark, plain) and C.has_quoted_newlines(spark, quoted)
    for path, expect_multi in ((plain, False), (quoted, True)):
        out = path + ".parquet"
        info = C.convert_csv(spark, path, out, range_bytes=1_000)
        assert info["multiline"] is expect_multi
        rows = {r.a: r.b for r in spark.read.parquet(out).collect()}
        assert len(rows) == 2000
        assert rows["7"] == ("v, 7" if path == plain else "line\n7")


def test_small_datasets_with_same_header_convert_together(spark, tmp_path):
    files = {
        1: "REF_DATE,GEO,VALUE\n2020,Canada,1\n2021,A,x\n",
        2: "REF_DATE,GEO,VALUE\n2020,Ontario,..\n",
        3: "REF_DATE,GEO,VALUE\n",                      # header only
        4: "Other Header,V\nk,1\n",
    }
    rows = [(k, f"t{k}", f"{k}-t", _write(tmp_path, f"{k}.csv", text), len(text), None) for k, text in files.items()]
    items = spark.createDataFrame(rows, "productId long, title string, folder string, csv_path string, length long, error string")
    data = str(tmp_path / "data")
    report = {r.productId: r for r in C.convert_batch(spark, items, data).collect()}
    assert all(r.status == "ok" for r in report.values())
    import json
    assert json.loads(report[1].columns) == ["REF_DATE", "GEO", "VALUE"]
    assert json.loads(report[4].columns) == ["Other_Header", "V"]
    read = lambda k: sorted(tuple(x) for x in spark.read.parquet(f"{data}/{k}-t/{k}.parquet").collect())
    assert read(1) == [("2020", "Canada", "1"), ("2021", None, None)]
    assert read(2) == [("2020", "Ontario", None)]
    assert read(3) == [] and spark.read.parquet(f"{data}/3-t/3.parquet").columns == ["REF_DATE", "GEO", "VALUE"]
    assert spark.read.parquet(f"{data}/4-t/4.parquet").columns == ["Other_Header", "V"]
    assert sorted(os.listdir(data)) == ["1-t", "2-t", "3-t", "4-t"]


def test_report_notes_renamed_columns(spark, tmp_path):
    src = _write(tmp_path, "r.csv", "x y,x-y,GEO,Geo\n1,2,3,4\n")
    items = spark.createDataFrame([(1, "r", "1-r", src, 30, None)],
                                  "productId long, title string, folder string, csv_path string, length long, error string")
    for grouped in (True, False):
        r = C.convert_batch(spark, items, str(tmp_path / f"data{grouped}"), group_small=grouped).first()
        assert r.status == "ok" and r.notes == "renamed: x_y -> x_y_2, Geo -> Geo_2"


def test_group_maps_rows_to_files_with_odd_names(spark, tmp_path):
    names = ["with space.csv", "plus+sign.csv", "hash#1.csv", "pct%20x.csv", "héllo.csv"]
    rows = []
    for k, n in enumerate(names, start=1):
        p = tmp_path / n
        p.write_text(f"A,B\n{k},{n}\n{k},again\n")
        rows.append((k, n, f"{k}-d", str(p), 30, None))
    items = spark.createDataFrame(rows, "productId long, title string, folder string, csv_path string, length long, error string")
    data = str(tmp_path / "data")
    assert {r.status for r in C.convert_batch(spark, items, data).collect()} == {"ok"}
    for k, n in enumerate(names, start=1):
        got = sorted(tuple(r) for r in spark.read.parquet(f"{data}/{k}-d/{k}.parquet").collect())
        assert got == sorted([(str(k), n), (str(k), "again")])


def test_missing_file_in_group_fails_alone(spark, tmp_path):
    good = _write(tmp_path, "g.csv", "a,b\n1,2\n")
    gone = str(tmp_path / "gone.csv")
    rows = [(1, "g", "1-g", good, 10, None), (2, "x", "2-x", gone, 10, None)]
    items = spark.createDataFrame(rows, "productId long, title string, folder string, csv_path string, length long, error string")
    got = {r.productId: r.status for r in C.convert_batch(spark, items, str(tmp_path / "data")).collect()}
    assert got == {1: "ok", 2: "failed"}


def test_batch_quarantine_keeps_dataset(spark, tmp_path):
    bad = _write(tmp_path, "b.csv", "a,b\n1,2\n3\n4,5\n")
    items = spark.createDataFrame([(1, "b", "1-b", bad, 20, None)],
                                  "productId long, title string, folder string, csv_path string, length long, error string")
    strict = C.convert_batch(spark, items, str(tmp_path / "d1")).first()
    assert strict.status == "failed"
    kept = C.convert_batch(spark, items, str(tmp_path / "d2"), quarantine=True).first()
    assert kept.status == "ok" and kept.notes == "rejected rows: 1"
    assert spark.read.parquet(str(tmp_path / "d2" / "1-b" / "1.parquet")).count() == 2
    assert [r.value for r in spark.read.text(str(tmp_path / "d2-rejects" / "1-b" / "1.parquet")).collect()] == ["3"]
