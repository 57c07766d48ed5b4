"""Inputs of many rows, sheets and files: what one task holds."""

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from refmill.operators import extract as X
from refmill.sources import workbook as W


def test_cells_are_not_dealt_by_header(spark, monkeypatch):
    monkeypatch.setattr(X, "CELLS_PER_TASK", 100)
    recs = spark.range(1000).select(
        F.lit("b").alias("workbook"), F.lit("s").alias("sheet"), F.lit(0).alias("block"), (F.col("id") / 2).cast("int").alias("r"),
        (F.col("id") % 2).cast("int").alias("c"), F.concat(F.lit("h"), F.col("id") % 2).alias("header"),
        F.col("id").cast("string").alias("value"), F.lit("number").alias("kind"),
    )
    recs = X.stage(recs)
    wide = X.wide_rows(recs, ["h0", "h1"], 1000)
    assert "hashpartitioning(header" not in wide._jdf.queryExecution().toString()
    assert wide.rdd.getNumPartitions() == 10
    found = {r.r: [x.value for x in r.cells] for r in wide.collect()}
    assert found == {r: [str(2 * r), str(2 * r + 1)] for r in range(500)}


def test_parts_of_many_workbooks_share_frames():
    def book(n):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as archive:
            archive.writestr("xl/workbook.xml", "<workbook/>")
            archive.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="m"><sheetData><row r="1"><c r="A1"><v>{n}</v></c></row></sheetData></worksheet>')
        return out.getvalue()

    files = pd.DataFrame({"path": [f"{n}.xlsx" for n in range(50)], "content": [book(n) if n != 7 else b"broken" for n in range(50)]})
    parts = list(W._unpack([files]))
    events = list(W._parse(W._pieces(parts)))
    assert len(parts) == 1 and len(events) == 1
    assert (events[0]["what"] == "error").sum() == 1
    assert len(events[0]) == 50 and set(events[0]["workbook"]) == set(files["path"])


def test_packing_tasks_grow_with_the_table(spark, tmp_path, monkeypatch):
    from refmill.plans.catalog import books as B

    rows = spark.range(400).selectExpr(
        "id AS p_partkey", "concat('n', id) AS p_name", "'b' AS p_brand", "'t' AS p_type", "CAST(id % 50 AS INT) AS p_size", "1.0D AS p_retailprice"
    )
    rows.write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(B, "_BOOK_ROWS", 20)
    made = B.book_files(spark, str(tmp_path), 10)
    assert made.rdd.getNumPartitions() == 20 and made.count() == 40


def test_one_file_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from refmill.plans.catalog import jobs as J

    texts = [None, "a", 'x\n"y", z', " b ", "ü\n\nlong " * 50]
    rows = [(n, texts[n % 5], "en" if n % 3 else None) for n in range(200)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    written = []
    monkeypatch.setattr(J, "_write_csv", lambda df, *a, f=J._write_csv, **k: (written.append(df.rdd.getNumPartitions()), f(df, *a, **k)))
    found = J.csv_one_file(spark, str(tmp_path))
    assert written[0] > 1
    assert sorted(map(tuple, found.collect()), key=str) == sorted(rows, key=str)
