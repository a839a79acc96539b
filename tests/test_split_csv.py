"""Cutting CSV files at records, against reading them byte by byte."""

import csv
import io
import random

import pytest

from cubeshelf.operators import convert, split_csv


def walk(data: bytes, inside: bool):
    """Record ends by a state for each byte: value start, text, in quotes, quote seen in quotes."""
    state, ends = "quoted" if inside else "start", []
    for i, c in enumerate(data.decode("latin-1")):
        if state == "quoted":
            state = "quote" if c == '"' else "quoted"
        elif c in ",\n":
            state = "start"
            if c == "\n":
                ends.append(i)
        elif c == '"' and state in ("start", "quote"):
            state = "quoted"
        else:
            state = "text"
    return ends, state == "quoted"


def test_record_ends():
    pick = random.Random(2)
    for _ in range(20_000):
        data = "".join(pick.choices('a,"\n', weights=(2, 1, 3, 1), k=pick.randrange(0, 16))).encode()
        for inside in (False, True):
            ends, last = split_csv.record_ends(data, inside)
            assert (ends.tolist(), bool(last)) == walk(data, inside), (data, inside)


@pytest.mark.parametrize("seed,size", [(1, 40), (2, 7), (3, 300)])
def test_any_cut_gives_the_records(spark, tmp_path, seed, size):
    pick = random.Random(seed)
    value = lambda: "".join(pick.choices(['a', 'é', ',', '"', '\n', '\n\n', ' x', '\r\n', '日'], k=pick.randrange(0, 9)))
    rows = [[str(i), value(), value()] for i in range(120)]
    out = io.StringIO()
    csv.writer(out, lineterminator=pick.choice(["\n", "\r\n"])).writerows([["k", "a\nb", "c"], *rows])
    p = tmp_path / "x.csv"
    p.write_bytes(b"\xef\xbb\xbf" + out.getvalue().encode())
    got = split_csv.read_all_string(spark, str(p), ["k", "b", "c"], convert.CSV_OPTIONS, range_bytes=size)
    assert sorted((r.k, r.b or "", r.c or "") for r in got.collect()) == sorted(map(tuple, rows))
    cut = [tuple(r)[1:] for r in split_csv.stretches(spark, str(p), size).orderBy("start").collect()]
    assert cut[0][0] == 0 and cut[-1][1] == p.stat().st_size and [b for _, b in cut[:-1]] == [a for a, _ in cut[1:]]
    assert len(cut) > 3


def test_quotes_inside_text_and_one_long_value(spark, tmp_path):
    rows = 'k,v\n1,5" pipe\n2,"two\nlines"\n3,say "x"\n4,"' + "long\n" * 3000 + '"\n5,"a"b\n6,\n'
    p = tmp_path / "x.csv"
    p.write_text(rows)
    for size in (64, 5000, 1 << 20):
        got = split_csv.read_all_string(spark, str(p), ["k", "v"], convert.CSV_OPTIONS, range_bytes=size).collect()
        by = {r.k: r.v for r in got}
        assert sorted(by) == list("123456") and by["1"] == '5" pipe' and by["2"] == "two\nlines" and by["3"] == 'say "x"'
        assert by["4"] == "long\n" * 3000 and by["6"] is None


def test_ragged_rows_fail_or_go_aside(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('a,b\n1,"x\ny"\n2\n3,"z",4\n5,"u\nv"\n')
    with pytest.raises(Exception, match="MALFORMED"):
        convert.convert_csv(spark, str(p), str(tmp_path / "out"), range_bytes=8)
    info = convert.convert_csv(spark, str(p), str(tmp_path / "out2"), quarantine=True, rejects_dir=str(tmp_path / "bad"), range_bytes=8)
    assert info["rejects"] == 2 and sorted(r[0] for r in spark.read.text(str(tmp_path / "bad")).collect()) == ["2", '3,"z",4']
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out2")).collect()) == [("1", "x\ny"), ("5", "u\nv")]


def test_folder_of_files_and_header_only(spark, tmp_path):
    d = tmp_path / "csv"
    d.mkdir()
    (d / "_SUCCESS").write_text("")
    (d / "a.csv").write_text('a,b\n1,"x\ny"\n')
    (d / "b.csv").write_text("a,b\n")
    (d / "c é.csv").write_text('a,b\n2,"p\nq"')
    info = convert.convert_csv(spark, str(d), str(tmp_path / "out"), range_bytes=4)
    assert info["multiline"] and sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("1", "x\ny"), ("2", "p\nq")]
    (tmp_path / "h.csv").write_text('"a\nb",c\n')
    convert.convert_csv(spark, str(tmp_path / "h.csv"), str(tmp_path / "out3"))
    got = spark.read.parquet(str(tmp_path / "out3"))
    assert got.columns == ["a\nb", "c"] and got.count() == 0


def test_many_small_ranges_share_tasks_and_blocks(spark, tmp_path, monkeypatch):
    p = tmp_path / "x.csv"
    p.write_text("k,v\n" + "".join(f'{i},"two\nlines {i}"\n' for i in range(2000)))
    few = 4 * spark.sparkContext.defaultParallelism
    got = split_csv.read_records(spark, str(p), 32)
    assert split_csv.stretches(spark, str(p), 32).count() > few >= got.rdd.getNumPartitions() > 1
    assert sorted(r[0] for r in got.collect()) == sorted(f'{i},"two\nlines {i}"' for i in range(2000))
    monkeypatch.setattr(split_csv, "RANGE_BYTES", 100)  # large data: as many tasks as hold that much each
    assert split_csv.read_records(spark, str(p), 32).rdd.getNumPartitions() > few


def test_next_line_reads_little_where_lines_are_short():
    class File:
        def __init__(self, data):
            self.data, self.read = data, 0

        def read_at(self, n, at):
            self.read += n
            return self.data[at:at + n]

    for line in (10, 5000, 300_000):
        f = File((b"x" * (line - 1) + b"\n") * (3_000_000 // line))
        for at in (0, 1, line - 1, line, line + 1, 2_900_000, 3_000_000):
            f.read = 0
            assert split_csv._next_line(f, at, len(f.data)) == min(-(-at // line) * line, len(f.data))
            assert f.read <= 4096 + 8 * line
