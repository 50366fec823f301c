"""Files read by many tasks: line numbers and quoted line breaks do not depend on where the splits fall."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from veracast.plans import build
from veracast.sources import readers, splits


@pytest.fixture(params=[64, 400, 1 << 27])
def split_bytes(spark, request):
    names = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": 0}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


def awkward_rows(seed, count):
    rng = random.Random(seed)
    parts = ["a", "b c", ",", '"', "\n", '""', "\n\n", "é", '",', ',"', '"\n"']

    def field():
        kind = rng.random()
        if kind < 0.3:
            return "".join(rng.choice("ab1") for _ in range(rng.randint(0, 6)))
        if kind < 0.95:
            return "".join(rng.choice(parts) for _ in range(rng.randint(0, 10))).strip()
        return ('long "q", \n' * rng.randint(1, 60)).strip()  # over many splits

    return [(str(k), field(), field()) for k in range(count)]


def written(path, rows, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerow(["id", "first `one`", "b"])
    writer.writerows(rows)
    path.write_bytes(("﻿" + out.getvalue()).encode())


def test_csv_whole_and_in_splits(spark, tmp_path, split_bytes):
    rows = awkward_rows(3, 150)
    written(tmp_path / "a.csv", rows)
    written(tmp_path / "b.csv", awkward_rows(4, 20), end="\r\n")
    found = readers.read_csv(spark, str(tmp_path))
    assert found.columns == ["id", "first `one`", "b"]
    expected = [tuple(v or None for v in row) for row in rows + awkward_rows(4, 20)]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    first = readers.read_csv(spark, str(tmp_path / "a.csv"), limit=40).collect()
    assert [tuple(row) for row in first] == expected[:40]
    tasks = splits.split_lines(spark, str(tmp_path / "a.csv")).select(F.spark_partition_id()).distinct().count()
    assert tasks >= min(8, (tmp_path / "a.csv").stat().st_size // split_bytes)


def test_csv_edges(spark, tmp_path):
    cases = {
        "header only": ("a,b\n", []),
        "blank lines": ("a,b\n\n1,2\n\n\n3,4", [("1", "2"), ("3", "4")]),
        "left open": ('a,b\n1,"x\ny,2\nz', [("1", "x\ny,2\nz")]),
        "quote inside a plain field": ('a,b\nsay "hi,2\n3,4\n', [('say "hi', "2"), ("3", "4")]),
        "quoted header over lines": ('"a\nx",b\n1,2\n', [("1", "2")]),
    }
    for name, (body, expected) in cases.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(body)
        assert [tuple(row) for row in readers.read_csv(spark, str(path)).collect()] == expected, name
    assert readers.read_csv(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "t.csv").write_text("n,x\n1,a\nzz,b\n")
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "t.csv"), schema="n int, x string").collect()] == [(1, "a"), (None, "b")]


def test_bad_lines_by_file_and_number(spark, tmp_path, split_bytes):
    lines = [f'{{"a": {k}}}' for k in range(120)]
    lines[7], lines[70], lines[100], lines[119] = "", "{oops", "   ", '{"a": "text"}'
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    (tmp_path / "y.jsonl").write_text('{"a": 1}\n\n')
    found = splits.bad_json_lines(spark, str(tmp_path), "a int").orderBy("file", "line").collect()
    assert [(r.file.rsplit("/", 1)[1], r.line, r.error, r.value) for r in found] == [
        ("x.jsonl", 71, "invalid JSON", "{oops"), ("x.jsonl", 120, "does not fit the schema", '{"a": "text"}')]
    with pytest.raises(splits.BadInputLine, match=r"x.jsonl, line 71: invalid JSON") as raised:
        with readers.naming_bad_lines(spark, {str(tmp_path / "none"): "a int", str(tmp_path / "x.jsonl"): "a int"}):
            readers.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a int").collect()
    assert raised.value.line == 71
    with pytest.raises(ZeroDivisionError):
        with readers.naming_bad_lines(spark, {str(tmp_path / "x.jsonl"): "a int"}):
            1 / 0


def test_build_names_the_bad_line(spark, tmp_path):
    (tmp_path / "youtube_channels.jsonl").write_text('{"channel_id": "UC1"}\n{"channel_id": "UC2"}\n{"channel_id"\n')
    with pytest.raises(splits.BadInputLine, match="youtube_channels.jsonl, line 3"):
        build.build_dataset(spark, build.read_raw(spark, str(tmp_path)), str(tmp_path / "out"))
