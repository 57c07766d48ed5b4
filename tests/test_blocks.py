"""Workbooks too large for one row: packed by many tasks, read in blocks."""

import io
import tempfile
import zipfile
import zlib

import pandas as pd
import pytest
from celltables import tuples

from refmill.plans.catalog import books as B
from refmill.sources import workbook as W


def write_parts(spark, folder, n=400):
    """Parts with repeated keys, and with keys, names, brands and sizes missing."""
    rows = spark.range(n).selectExpr(
        "CASE WHEN id % 97 = 5 THEN NULL WHEN id % 50 = 7 THEN id - 1 ELSE id END AS p_partkey", "CASE WHEN id % 13 <> 3 THEN concat('relür ', id * 7919 % 1009) END AS p_name",
        "CASE WHEN id % 17 <> 4 THEN concat('b', id) END AS p_brand", "concat('t', id % 7) AS p_type", "CASE WHEN id % 11 <> 2 THEN CAST(id % 50 AS INT) END AS p_size", "1.0D AS p_retailprice",
    )
    rows.write.parquet(f"{folder}/part.parquet")
    return str(folder)


def texts(content):
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        assert archive.testzip() is None
        return {i.filename: (archive.read(i), i.CRC) for i in archive.infolist()}


@pytest.mark.parametrize("rows_each", [90, 10**9])
def test_blocks_make_the_workbooks_that_one_task_packs(spark, tmp_path, monkeypatch, rows_each):
    folder = write_parts(spark, tmp_path)
    monkeypatch.setattr(B, "_BOOK_ROWS", 20)
    monkeypatch.setattr(B, "_BLOCK", 50)
    blocks = B.book_blocks(spark, folder, rows_each).collect()
    whole = {r.path: r.content for r in B.book_files(spark, folder, rows_each).collect()}
    made = {}
    for r in sorted(blocks, key=lambda r: r.block):
        made[r.path] = made.get(r.path, b"") + r.content
    assert {p: texts(c) for p, c in made.items()} == {p: texts(c) for p, c in whole.items()}
    assert len(blocks) > 20 and max(len(r.content) for r in blocks) < max(map(len, whole.values()))


def test_one_sheet_is_packed_by_many_tasks_and_read_whole(spark, tmp_path, monkeypatch):
    folder = write_parts(spark, tmp_path)
    whole = W.parse_workbooks(B.book_files(spark, folder, B._ALL)).cells.where("r > 2")
    monkeypatch.setattr(B, "_BOOK_ROWS", 20)
    files = []
    monkeypatch.setattr(B, "parse_workbooks", lambda f, parse=W.parse_workbooks: (files.append(f), parse(f))[1])
    found = B.workbook_one_sheet(spark, folder)
    assert files[0].groupBy("path").count().where("path IS NOT NULL").first()["count"] > 20
    assert tuples(found) == tuples(whole) and found.count() > 2000


@pytest.mark.parametrize("split", [0, 1000])
def test_blocks_and_slices_equal_the_whole(spark, tmp_path, monkeypatch, split):
    folder = write_parts(spark, tmp_path)
    files = B.book_files(spark, folder, 150).where("path IS NOT NULL").toPandas()
    content = files["content"][0]
    broken = pd.DataFrame({"path": ["x.xlsx", "y.xls", "z.xlsx"], "content": [b"no zip", b"old", content[: len(content) // 2]]})
    files = pd.concat([files, broken], ignore_index=True)
    files = pd.concat([files, files[:1]], ignore_index=True)  # one path twice
    one = W.parse_workbooks(spark.createDataFrame(files, "path string, content binary"))
    expected = [tuples(x) for x in (one.cells, one.merges, one.errors)]
    monkeypatch.setattr(W, "SLICE", 33)
    monkeypatch.setattr(W, "SPLIT_PART", split)
    monkeypatch.setattr(W, "PIECE", 500)
    sliced = W.parse_workbooks(spark.createDataFrame(files, "path string, content binary"))
    assert [tuples(x) for x in (sliced.cells, sliced.merges, sliced.errors)] == expected
    once = files[:-1]
    expected = W.parse_workbooks(spark.createDataFrame(once, "path string, content binary"))
    rows = [(p, n, c[at : at + 70]) for p, c in zip(once["path"], once["content"]) for n, at in enumerate(range(0, len(c), 70))]
    read = W.parse_workbooks(spark.createDataFrame(rows[::-1], "path string, block bigint, content binary"))
    assert [tuples(x) for x in (read.cells, read.merges, read.errors, read.sheets)] == [tuples(x) for x in (expected.cells, expected.merges, expected.errors, expected.sheets)]


def test_large_parts_leave_the_unpacking_in_slices(monkeypatch):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr("xl/workbook.xml", "<workbook/>")
        archive.writestr("xl/worksheets/sheet1.xml", "<worksheet/>" * 100_000)
    files = pd.DataFrame({"path": ["a.xlsx"], "content": [out.getvalue()]})
    parts = pd.concat(W._unpack([files]))
    assert parts["data"].map(len).max() <= W.SLICE < 1_200_000 == parts["data"].map(len).sum() - len("<workbook/>")


def test_sizes_beyond_32_bits_are_kept():
    name, big = b"xl/sharedStrings.xml", 5 << 32
    _, record = B._entry(name, 7, big, big + 1, big + 2)
    end = B._directory([record], 100)
    with zipfile.ZipFile(io.BytesIO(bytes(100) + end)) as archive:
        info = archive.infolist()[0]
    assert (info.compress_size, info.file_size, info.CRC) == (big, big + 1, 7) and info.header_offset == big + 2
    with tempfile.TemporaryFile() as file:  # with holes, so it takes no room
        file.seek(big)
        file.write(B._directory([record], big))
        with zipfile.ZipFile(file) as archive:
            assert archive.infolist()[0].file_size == big + 1
    header, _ = B._entry(name, 7, big, big + 1, 0)
    assert len(header) == 30 + len(name) + 20


def test_check_of_texts_in_a_row():
    texts = [b"", b"a", b"bc" * 1000, b"", b"d" * 65537]
    check, so_far = 0, b""
    for text in texts:
        check, so_far = B._check_of_both(check, zlib.crc32(text), len(text)), so_far + text
        assert check == zlib.crc32(so_far)
