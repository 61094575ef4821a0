import pytest

import os
import tempfile

from quire.operators.index import doc_lengths
from quire.sources.collection import parse_collection_lines, read_collection
from quire.sources.postings import parse_posting_lines, read_postings_dir

from conftest import rows


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)


def test_collection_edge_lines(spark):
    d = tempfile.mkdtemp(prefix="quire-test-")
    _write(f"{d}/c.tsv", b"1\ta\tb\nno tab here\n7abc\tx\n 8\ty\nxx\tbad\n-3\tneg\n9\t\n"
                         b"2\ta\rb c\r\n3\tcaf\xe9 d\n")
    good, rejects = read_collection(spark, f"{d}/c.tsv")
    lengths = dict((r["doc_id"], r["n_tokens"]) for r in doc_lengths(good).collect())
    assert lengths == {1: 2, 7: 1, 8: 1, 9: 0, 2: 3, 3: 2}
    reasons = sorted(r["reason"] for r in rejects.collect())
    assert reasons == ["doc id not a number", "negative doc id", "no tab"]
    text1 = [r["text"] for r in good.where("doc_id = 1").collect()]
    assert text1 == ["a\tb"]  # later tabs stay in the passage


def test_collection_fail_mode(spark):
    lines = spark.createDataFrame([("xx\tbad",)], "value STRING")
    good, _ = parse_collection_lines(lines, on_error="fail")
    try:
        good.collect()
    except Exception as e:  # noqa: BLE001
        assert "bad collection line" in str(e)
    else:
        raise AssertionError("expected failure")


def test_posting_lines_parse_and_reject(spark):
    lines = spark.createDataFrame(
        [("apple 1:2 5:1",), ("bee  3:4",), ("a 1",), ("c -1:2",), ("lonely",)], "value STRING")
    good, rejects = parse_posting_lines(lines)
    assert rows(good) == [("apple", 1, 2), ("apple", 5, 1), ("bee", 3, 4)]
    assert sorted(r["reason"].split(":")[0] for r in rejects.collect()) == [
        "negative doc id or tf", "posting without colon"]


def test_read_postings_dir_any_file_order(spark):
    d = tempfile.mkdtemp(prefix="quire-test-")
    # run 10 sorts before run 2 by name; lines of one term spread over runs
    _write(f"{d}/intermediate_10.txt", b"a 20:1\nb 21:2\n")
    _write(f"{d}/intermediate_2.txt", b"a 3:1 4:2\n")
    _write(f"{d}/notes.md", b"z 1:1\n")
    os.makedirs(f"{d}/sub")
    _write(f"{d}/sub/x.txt", b"q 1:1\n")
    good, rejects = read_postings_dir(spark, d)
    assert rows(good) == [("a", 3, 1), ("a", 4, 2), ("a", 20, 1), ("b", 21, 2)]
    assert rejects.count() == 0


def test_posting_lines_fail_mode(spark):
    lines = spark.createDataFrame([("a 1",)], "value STRING")
    good, _ = parse_posting_lines(lines, on_error="fail")
    try:
        good.collect()
    except Exception as e:  # noqa: BLE001
        assert "malformed posting" in str(e)
    else:
        raise AssertionError("expected failure")


def _files(spark, tmp_path, texts):
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path)


@pytest.mark.parametrize("split", ["1", "7", "64", "1000", "100000"])
def test_lines_longer_than_a_split(spark, tmp_path, split):
    """Lists of one line that many tasks read, cut anywhere: the rows that
    the lines give when read whole."""
    long = "hot " + " ".join(f"{d}:{d % 9 + 1}" for d in range(0, 900, 3))
    texts = {"a.txt": f"{long}\nrare 5:1 9:2\n\nlonely\n  x  1:1\t2:2 \r\n", "b.txt": f"rare 7:1\n{long.replace('hot', 'hotter')}",
             "c.txt": "", "d.txt": "\n\n", "e.txt": "alone", "f.txt": f"é 1:1 bad 2:x 3:-1\n{long}\n", "g.txt": "z 3:4  \n y 8:8"}
    path = _files(spark, tmp_path, texts)
    whole = parse_posting_lines(spark.read.option("lineSep", "\n").text(path), "value")
    keys = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    if split == "1":
        keys["spark.sql.files.maxPartitionBytes"] = "40"
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = read_postings_dir(spark, path)
        assert rows(got.good) == rows(whole.good) and len(rows(got.good)) > 900
        assert rows(got.rejects) == rows(whole.rejects)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
