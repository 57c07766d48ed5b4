"""Many small appends, broken replacements, publications by dataset, hashes of large files."""

import hashlib
import os
import subprocess
import sys
from datetime import datetime
from pathlib import Path

import pytest
from celltables import tuples
from pyspark.sql import functions as F

from refmill.plans import audit as A
from refmill.plans.publish import Store

ROOT = Path(__file__).resolve().parents[1]


def attempt(n, month=1):
    return {"dataset_id": f"d{n % 3}", "run_id": f"r{n}", "status": "SUCCESS", "row_count": n, "started_at_utc": datetime(2026, month, 1 + n % 27)}


def test_many_appends_leave_few_files(spark, tmp_path):
    path = str(tmp_path / "history")
    for n in range(40):
        A.append_history(spark, path, attempt(n, 1 + n % 2), compact_from=5)
        assert all(A.data_files(spark, f"{path}/started_month=2026-0{m}") < 5 for m in (1, 2))
    got = A.read_history(spark, path)
    assert tuples(got, "run_id", "row_count") == sorted(((f"r{n}", n) for n in range(40)), key=repr)
    assert {r.started_month: r["count"] for r in got.groupBy("started_month").count().collect()} == {"2026-01": 20, "2026-02": 20}
    assert len(list((tmp_path / "history").rglob("*.parquet"))) < 10


def test_broken_replacement_is_put_back(spark, tmp_path):
    path = str(tmp_path / "h")
    A.append_history(spark, path, [attempt(n) for n in range(6)], compact_from=99)
    home, aside = tmp_path / "h" / "started_month=2026-01", tmp_path / "h" / ".aside-started_month=2026-01"
    home.rename(aside)  # the driver was lost between putting the old folder aside and the new one in its place
    assert A.read_history(spark, path).count() == 0
    A.append_history(spark, path, attempt(6), compact_from=99)
    assert A.read_history(spark, path).count() == 7 and not aside.exists()
    aside.mkdir()  # lost after the new one was in its place
    (aside / "part-0.parquet").write_bytes(b"old")
    A.append_history(spark, path, attempt(7), compact_from=99)
    assert A.read_history(spark, path).count() == 8 and not aside.exists()


def test_folder_names_are_spark_s(spark, tmp_path):
    values = ["plain", "a/b", "x=y", "50%", "a:b", "é ü", "tab\there", "", None, "{q}", "[w]", "c#d", "~&;"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k string, i int")
    for _ in range(3):
        A.append_rows(spark, str(tmp_path / "t"), df, "k", compact_from=2)
    assert all(len(list(f.glob("*.parquet"))) < 2 for f in (tmp_path / "t").glob("k=*"))
    back = spark.read.schema("i int, k string").parquet(str(tmp_path / "t"))
    assert back.count() == 3 * len(values)
    assert {r.k for r in back.collect()} == {v or None for v in values}


def test_live_version_reads_one_dataset_s_folder(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    for n in range(6):
        store.publish_pointer({"dataset_id": f"d{n % 3}", "version": n, "label": "v", "path": f"p{n}", "run_id": f"r{n}", "published_at": datetime(2026, 1, 1)})
    assert store.latest("d1")["version"] == 4 and store.latest("none") is None
    files = store.publications("d1").select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert files and all("dataset_id=d1" in r.f for r in files)
    assert {r.dataset_id: r.version for r in store.live().collect()} == {"d0": 3, "d1": 4, "d2": 5}


PROBE = """
import sys
sys.path.insert(0, sys.argv[1])
from refmill.session import build_session
from refmill.sources.files import hash_files
spark = build_session("hash", "local[2]", **{"spark.ui.enabled": "false"})
for r in hash_files(spark, sys.argv[2]).collect():
    print(r.bytes, r.sha256)
"""


def test_large_file_under_a_small_heap(tmp_path):
    size = 300 << 20
    file = tmp_path / "large.bin"
    digest, block = hashlib.sha256(), os.urandom(1 << 20)
    with file.open("wb") as out:
        for n in range(size >> 20):
            part = block[n:] + block[:n]
            out.write(part)
            digest.update(part)
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--driver-memory 512m pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", PROBE, str(ROOT), str(tmp_path)], capture_output=True, text=True, env=env)
    file.unlink()
    assert done.stdout.split() == [str(size), digest.hexdigest()], done.stderr[-2000:]


def test_fail_fast_raises_what_the_table_raised(spark):
    from refmill.plans import extraction as E
    from refmill.sources.workbook import Workbooks

    cells = spark.createDataFrame([("b", "S", r, c, f"{r}{c}", "string") for r in (1, 2) for c in (1, 2)], "workbook string, sheet string, r int, c int, value string, kind string")
    empty = "workbook string, sheet string, min_r int, min_c int, max_r int, max_c int"
    books = Workbooks(cells, spark.createDataFrame([], empty), spark.createDataFrame([("b", "S", 0)], "workbook string, sheet string, position int"), spark.createDataFrame([], "workbook string, error string"))
    common = {"sheet_name": "S", "table_type": "simple", "header_rows": [1], "data_start_row": 2}
    sheets = [{**common, "output_name": "bad", "unpivot": True, "unpivot_var_name": "V", "unpivot_value_name": "V"}, {**common, "output_name": "good"}]
    config = {"config_name": "c", "sheets": sheets}
    results, _ = E.extract_all(books, {**config, "settings": {"on_error": "continue"}})
    assert [(r.output_name, r.table is None) for r in results] == [("bad", True), ("good", False)]
    with pytest.raises(Exception, match="V"):
        E.extract_all(books, {**config, "settings": {"on_error": "fail_fast"}})
