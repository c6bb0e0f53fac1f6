"""Golden case G-3 (extractors) and text-file reading."""

import csv
import json
import os
import tempfile

import pytest

from cadenza.sources import files as A


def test_csv_column(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "in.csv")
    with open(p, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["id", "text"])
        w.writerows([["1", "  a\nb  "], ["2", ""], ["3", "   "], ["4", "plain"], ["5", 'say "hi"']])
    got = [r.text for r in A.read_csv_column(spark, p, "text").orderBy("row_no").collect()]
    assert got == ["a\nb", "", "plain", 'say "hi"']
    with pytest.raises(ValueError, match="Available headers"):
        A.read_csv_column(spark, p, "Text")


def test_messages(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump({"messages": [{"text": "a"}, {"text": 5}, {"x": 1}, {"text": None}, {"text": ""}]}, f)
    with open(os.path.join(d, "b.json"), "w") as f:
        f.write('{"messages": 3}')
    with open(os.path.join(d, "c.json"), "w") as f:
        f.write("not json")
    got = [r.text for r in A.read_messages(spark, d).orderBy("doc_id", "msg_no").collect()]
    assert got == ["a", ""]


def test_read_lines_folder_and_newlines(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "one.txt"), "wb") as f:
        f.write(b"first\r\nsecond\rthird\nfourth")
    with open(os.path.join(d, "skip.md"), "w") as f:
        f.write("ignored")
    rows = A.read_lines(spark, d).orderBy("line_no").collect()
    assert [r.line for r in rows] == ["first", "second", "third", "fourth"]
    with pytest.raises(FileNotFoundError):
        A.read_lines(spark, os.path.join(d, "missing"))


def test_concat_and_dir_size(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "k long, o long, t string")
    got = {r.k: r.t for r in A.concat_text(df, "k", "o", "t").collect()}
    assert got == {1: "a\nb", 2: "c"}
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "x.bin"), "wb") as f:
        f.write(b"0" * 1234)
    os.makedirs(os.path.join(d, "sub"))
    with open(os.path.join(d, "sub", "y.bin"), "wb") as f:
        f.write(b"0" * 66)
    assert A.dir_size(spark, d).first().bytes == 1300


def test_materialise_key_changes_with_options(spark):
    root = tempfile.mkdtemp()
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    A.materialise(spark, "x", build, {"v": 1}, root=root)
    A.materialise(spark, "x", build, {"v": 1}, root=root)
    A.materialise(spark, "x", build, {"v": 2}, root=root)
    assert len(calls) == 2
