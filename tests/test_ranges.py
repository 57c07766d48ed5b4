"""Split files: every record as Spark's reader of whole files finds it, whatever the ranges and chunks."""

import gzip
import json
import random

import pytest
from celltables import tuples
from pyspark.sql import Row

from refmill.plans.catalog.jobs import read_json_drop
from refmill.sources import files as FS
from refmill.sources import ranges


@pytest.fixture(params=[(250, 40), (1 << 20, 5)])
def cut(spark, request, monkeypatch):
    """Bytes of a range and of a chunk."""
    size, chunk = request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    monkeypatch.setattr(ranges.read_csv_ranges, "__defaults__", ("", chunk))
    monkeypatch.setattr(ranges.read_json_ranges, "__defaults__", (chunk,))
    yield chunk
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def csv_text(seed, records, newline="\n"):
    rnd = random.Random(seed)
    values = ["", "plain", "a b", '"quoted"', '"two' + newline + 'lines"', '"with ""quotes"" in"', '"a,b"', '""', '"' + newline * 3 + '"', 'in"ch', '5" pipe',
              ' "no quote', '"x"tail', "'", "é", '"""begin"', '"end"""', "\t"]
    lines = ["id,first,second"]
    for i in range(records):
        lines.append(f"{i},{rnd.choice(values)},{rnd.choice(values)}")
        if rnd.random() < 0.1:
            lines.append("")
    return newline.join(lines) + newline


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_csv_as_read_whole(spark, tmp_path, cut, newline):
    (tmp_path / "d").mkdir()
    for seed in range(2):
        (tmp_path / "d" / f"{seed}.csv").write_bytes(csv_text(seed, 50, newline).encode())
    (tmp_path / "d" / "3.csv").write_bytes(b'id,first,second\n1,"mixed\r\nbreaks",x\r\n2,y,z\n')
    (tmp_path / "d" / "4.csv").write_bytes(b"\xef\xbb\xbfid,first,second\n7,x,y")
    whole, split = FS.read_csv(spark, f"{tmp_path}/d", 1 << 40), FS.read_csv(spark, f"{tmp_path}/d", 0)
    assert split.columns == whole.columns
    assert tuples(split) == tuples(whole)


def test_csv_odd_files(spark, tmp_path, cut):
    odd = {"header only": "a,b\n", "long header": 'a,"b\nb' + "c" * 200 + '"\n1,2\n', "short and long rows": "a,b,c\n1\n1,2,3,4\n,,\n", "no end": 'a,b\n1,"x\ny"',
           "same names": "a,a,,b\n1,2,3,4\n", "long value": 'a,b\n1,"' + "line\n" * 300 + '"\n2,y\n', "breaks only": 'a\n"\n"\n"\n\n"\n'}
    for name, text in odd.items():
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        whole, split = FS.read_csv(spark, str(path), 1 << 40), FS.read_csv(spark, str(path), 0)
        assert (split.columns, tuples(split)) == (whole.columns, tuples(whole)), name


def test_empty_and_null_values(spark, tmp_path, cut):
    (tmp_path / "a.csv").write_text('a,b,c\n1,,""\n2,~,"~"\n')
    for mark, want in (("", [("1", None, None), ("2", "~", "~")]), ("~", [("1", None, ""), ("2", None, None)])):
        for split_from in (0, 1 << 40):
            assert tuples(FS.read_csv(spark, f"{tmp_path}/a.csv", split_from, mark)) == want


def documents(seed):
    rnd = random.Random(seed)
    texts = ["", "plain", '"', "\\", "}{", '}"', "]", '\\"}', "é\n", "{\"a\": 1}", "x" * 90]
    made = lambda depth: rnd.choice([rnd.randint(0, 99), rnd.random(), True, None, rnd.choice(texts), rnd.choice(texts)]) if depth > 2 or rnd.random() < 0.6 else (
        [made(depth + 1) for _ in range(rnd.randint(0, 3))] if rnd.random() < 0.4 else {rnd.choice("pqr"): made(9) for _ in range(2)})
    return [{"id": i, "text": rnd.choice(texts), "list": [rnd.choice(texts) for _ in range(rnd.randint(0, 4))], "in": {"a": {"b": rnd.choice(texts)}}, "free": made(9)} for i in range(15)]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_as_read_whole(spark, tmp_path, cut, indent):
    (tmp_path / "d").mkdir()
    for seed in range(2):
        (tmp_path / "d" / f"{seed}.json").write_text(json.dumps(documents(seed), indent=indent, ensure_ascii=bool(seed)))
    (tmp_path / "d" / "one.json").write_text(" \n" + json.dumps(documents(5)[0], indent=4) + "\n")
    (tmp_path / "d" / "none.json").write_text("[]")
    whole, split = FS.read_json(spark, f"{tmp_path}/d", 1 << 40), FS.read_json(spark, f"{tmp_path}/d", 0)
    assert split.schema == whole.schema
    assert tuples(split) == tuples(whole)


def test_one_file_goes_to_many_tasks(spark, tmp_path):
    (tmp_path / "a.csv").write_text(csv_text(1, 20_000))
    (tmp_path / "a.json").write_text(json.dumps(documents(1) * 130))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        for file, read in (("a.csv", FS.read_csv), ("a.json", FS.read_json)):
            chunks = ranges._chunks(spark, f"{tmp_path}/{file}", *(("\n", "", 8192, ranges._csv_measure) if read is FS.read_csv else ("}", "}", 8192, ranges._json_measure)))
            assert chunks.select("block").distinct().count() > 3
            assert read(spark, f"{tmp_path}/{file}", 0).count() == read(spark, f"{tmp_path}/{file}", 1 << 40).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_small_drops_and_folders_of_columns_are_read_whole(spark, tmp_path):
    (tmp_path / "d" / "part=3").mkdir(parents=True)
    (tmp_path / "d" / "part=3" / "x.csv").write_text("a\n1\n")
    assert not FS._splits(spark, f"{tmp_path}/d", 0) and tuples(FS.read_csv(spark, f"{tmp_path}/d", 0)) == [("1", 3)]
    assert not FS._splits(spark, f"{tmp_path}/d/part=3/x.csv", 100) and FS._splits(spark, f"{tmp_path}/d/part=3/*.csv", 1)


def small_documents(folder):
    folder.mkdir(parents=True)
    for seed in range(34):
        (folder / f"{seed}.json").write_text(json.dumps(documents(seed), indent=seed % 3 or None, ensure_ascii=bool(seed % 2)))
    (folder / "one.json").write_text(" \r\n" + json.dumps(documents(50)[0], indent=4) + "\n")
    (folder / "none.json").write_text("[]")
    (folder / "empty.json").write_text("")
    (folder / "marked.json").write_text("\ufeff[{\"id\": 1.50}, {\"id\": 12345678901234567890123, \"free\": {\"p\":  [1.0E5,\n2]}}]")
    (folder / "broken.json").write_text('[{"id": 7,\n "text": "cut\nhere"}]')
    (folder / "half.json").write_text('[{"id": 8}, {"id": ')
    return str(folder)


def as_rows(df):
    return sorted((repr(r) for r in df.collect()))


def test_many_small_documents_are_put_together(spark, tmp_path):
    path = small_documents(tmp_path / "d")
    whole, together = FS.read_json(spark, path, many_from=1 << 40), FS.read_json(spark, path)
    assert len(whole.inputFiles()) == 40 and len(together.inputFiles()) < 40
    assert together.schema == whole.schema and "_corrupt_record" in whole.columns
    assert as_rows(together) == as_rows(whole) and together.count() == whole.count()


@pytest.mark.parametrize("odd", ["utf-16", "packed", "separator", "latin", "folder", "large"])
def test_documents_of_other_kinds_are_read_whole(spark, tmp_path, monkeypatch, odd):
    path, text = str(tmp_path / "d"), '[{"id": 99, "text": "é"}]'
    small_documents(tmp_path / "d" / "part=3" if odd == "folder" else tmp_path / "d")
    if odd == "large":
        monkeypatch.setattr(FS, "MAX_CONTENT", 40)
    elif odd != "folder":
        name, content = {
            "utf-16": ("u.json", text.encode("utf-16-le")),
            "packed": ("p.json.gz", gzip.compress(text.encode())),
            "separator": ("s.json", b'[{"id": 99}]\x1e[{"id": 98}]'),
            "latin": ("l.json", text.encode("latin-1")),
        }[odd]
        (tmp_path / "d" / name).write_bytes(content)
    whole, read = FS.read_json(spark, path, many_from=1 << 40), FS.read_json(spark, path)
    assert FS._documents_together(spark, path) is None
    assert read.schema == whole.schema and as_rows(read) == as_rows(whole)


def test_json_drop_of_many_documents(spark, tmp_path):
    rows = [(i * 7, None if i % 5 == 0 else i % 90, f"{i % 5}-KIND") for i in range(3000)] + [(None, 4, None), (49, 9, "again")]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    drop = read_json_drop(spark, str(tmp_path))
    assert len(drop.inputFiles()) < 40  # of 43 documents
    assert as_rows(drop) == sorted(repr(Row(o_orderkey=k, o_custkey=c, o_orderpriority=p)) for k, c, p in rows)
