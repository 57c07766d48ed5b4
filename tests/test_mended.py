"""Cases beyond earlier limits: wide sheets, formats, names, dates, large files, open arrivals."""

import hashlib
import json

import pytest
from celltables import tuples
from pyspark.sql import functions as F
from test_load import CONTRACT, GOOD, book, drop, history, world  # noqa: F401

from refmill.functions import dates as D
from refmill.operators import extract as X
from refmill.operators import inventory as I
from refmill.operators import profiling as P
from refmill.plans.load import LoadRules, detail_text
from refmill.sources import files as FS
from refmill.sources.config import Settings, config_hash, flat_hash
from refmill.sources.workbook import scan_workbooks
from refmill.streaming.arrivals import watch_landing


def sheet_config(**more):
    return {"sheet_name": "s", "table_type": "simple", "header_row": 1, "data_start_row": 2, **more}


def test_a_sheet_as_wide_as_can_be(spark):
    n = 16_384
    place = (F.col("id") % n + 1).cast("int")
    row = (F.floor(F.col("id") / n) + 1).cast("int")
    header = F.when(F.col("id") % 100 == 7, "again").otherwise(F.concat(F.lit("h"), (F.col("id") % n).cast("string")))
    value = F.when(F.col("id") < n, header).otherwise((F.col("id") % n).cast("string"))
    cells = spark.range(3 * n).select(
        F.lit("b").alias("workbook"), F.lit("s").alias("sheet"), row.alias("r"), place.alias("c"), value.alias("value"), F.lit("string").alias("kind")
    )
    t = X.extract_table(cells, sheet_config(), Settings())
    assert len(t.columns) == n and t.columns[7] == "again" and t.columns[107] == "again_2" and t.columns[-1] == f"h{n - 1}"
    assert set(t.types.values()) == {"bigint"}
    picked = t.frame.select(*[F.col(f"`{t.columns[i]}`") for i in (0, 1100, n - 1)])
    assert tuples(picked) == [(0, 1100, n - 1)] * 2


def test_repeated_headers_are_numbered_around_taken_names(grid):
    t = X.extract_table(grid({"s": [["a", "a_2", "a", "b", "a"], ["1", "2", "3", "4", "5"]]}), sheet_config(), Settings())
    assert t.columns == ("a", "a_2", "a_3", "b", "a_4")


def test_constants_keep_their_kind(grid):
    constants = {"none": None, "flag": True, "year": 2024, "share": 0.5, "text": "x"}
    t = X.extract_table(grid({"s": [["a"], ["1"]]}), sheet_config(static_columns=constants), Settings())
    assert t.types == {"a": "bigint", "none": "string", "flag": "boolean", "year": "bigint", "share": "double", "text": "string"}
    assert tuples(t.frame, "none", "flag", "year", "share", "text") == [(None, True, 2024, 0.5, "x")]


def test_given_ends_are_kept(grid):
    lines = [["a", "b"], ["1", "2"], [None, None], ["3", "4"], ["5", "6"]]
    t = X.extract_table(grid({"s": lines}), sheet_config(data_end_row=4), Settings())
    assert tuples(t.frame) == [(1, 2), (3, 4)]


def test_formats_of_conditional_styles_are_not_cell_formats(spark, tmp_path, monkeypatch):
    import zipfile

    book(tmp_path / "a.xlsx")
    source = zipfile.ZipFile(tmp_path / "a.xlsx")
    parts = {n: source.read(n).decode() for n in source.namelist()}
    dxf = '<dxfs><dxf><numFmt numFmtId="170" formatCode="0.00"/></dxf><dxf><numFmt numFmtId="170" formatCode="dd"/></dxf></dxfs>'
    parts["xl/styles.xml"] = parts["xl/styles.xml"].replace("</styleSheet>", f"{dxf}</styleSheet>")
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    plain, styled = (scan_workbooks(spark, str(tmp_path / n)).cells.drop("workbook") for n in ("a.xlsx", "b.xlsx"))
    assert tuples(plain) == tuples(styled) and plain.where("kind = 'date'").count() > 0


def test_output_names_are_unique(grid):
    sheets = {n: [["Year", "x"], ["1", "2"], ["3", "4"]] for n in ("a", "A", "a 2")}
    entries = P.sheet_configs(P.profile_sheets(grid(sheets), Settings())).collect()
    names = [e["entry"]["output_name"] for e in entries]
    assert len(set(names)) == 3 and "a" in names


@pytest.mark.parametrize(
    "name, day",
    [
        ("NG_20209999_20240105.psv", "2024-01-05"),
        ("NG_99992099_05012024.psv", "2024-01-05"),
        ("NG_20240105_20240201.psv", "2024-01-05"),
        ("NG_120240105.psv", None),
        ("NG_20240230_x.psv", None),
    ],
)
def test_every_digit_group_is_tried(spark, name, day):
    files = spark.createDataFrame([("/d", name)], "folder string, name string")
    assert str(I.dated_files(files).first()["file_day"]) == str(day)
    assert D.BY_NOTHING == "None"


def test_large_files_are_hashed_in_pieces(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, data in (("small", b"abc"), ("in/large", b"x" * 5000)):
        (tmp_path / name).write_bytes(data)
    got = {r["name"]: (r["bytes"], r["sha256"]) for r in FS.hash_files(spark, str(tmp_path), max_content=100).collect()}
    assert got == {"small": (3, hashlib.sha256(b"abc").hexdigest()), "large": (5000, hashlib.sha256(b"x" * 5000).hexdigest())}


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"two\nlines ""quoted"""\n2,plain\n')
    assert tuples(FS.read_csv(spark, str(tmp_path / "a.csv"))) == [("1", 'two\nlines "quoted"'), ("2", "plain")]


def test_details_stay_readable_when_cut():
    detail = {"expected": ["a"] * 3, "violations": [{"n": i, "text": "x" * 50} for i in range(200)]}
    cut = json.loads(detail_text(detail, 1000))
    assert len(detail_text(detail, 1000)) <= 1000 and cut["violations_left_out"] == 200 - len(cut["violations"])
    assert json.loads(detail_text({"error": "y" * 5000}, 300))["error"].startswith("y")
    assert detail_text({"a": 1}, 300) == '{"a": 1}'


def test_hash_does_not_depend_on_key_order(spark):
    config = {"b": "1", "a": 'q"ü'}
    texts = [json.dumps(config), json.dumps(dict(sorted(config.items())))]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    flat = {r[0] for r in frame.select(flat_hash(F.col("t"))).collect()}
    assert len(flat) == 1 and config_hash(config) == config_hash(dict(sorted(config.items())))


def test_open_arrivals_are_tried_again(spark, world, tmp_path):  # noqa: F811
    store, registry, landing = world
    drop(landing, "good.csv", GOOD)
    check = str(tmp_path / "check")
    watch_landing(store, registry(), {}, str(landing), check).awaitTermination()
    assert history(store).count() == 0
    failing = registry(source_format="excel")  # no extract config: an extract failure that is recorded
    seen = []
    watch_landing(store, registry(), {"d1": LoadRules(CONTRACT)}, str(landing), check, on_result=seen.append).awaitTermination()
    assert [r["status"] for r in seen] == ["SUCCESS"] and failing is not None
    assert history(store).count() == 1 and not store.exists(store.path("staging", seen[0]["run_id"]))


def test_history_is_read_by_month(spark, world):  # noqa: F811
    from datetime import datetime, timezone

    from refmill.plans import audit as A

    store, *_ = world
    for month in (1, 6):
        at = datetime(2024, month, 3, tzinfo=timezone.utc)
        A.append_history(spark, store.path("history"), {"dataset_id": "d", "run_id": str(month), "status": "SUCCESS", "started_at_utc": at})
    recent = A.recent_attempts(history(store), F.lit("2024-06-10").cast("timestamp"), 90)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(started_month" in plan
    assert [tuple(r) for r in recent.collect()] == [("d", 1, 0)]


# --- fixed values: one month of a published inventory, megabytes by day
JUNE_2024 = {
    3: 1315.1, 4: 820.7, 5: 584.26, 6: 604.72, 7: 553.1, 10: 1283.41, 11: 599.12, 12: 525.03, 13: 560.11, 14: 544.02,
    17: 1271.98, 18: 507.55, 19: 668.28, 20: 641.78, 21: 525.23, 24: 1202.69, 25: 625.57, 26: 538.06, 27: 586.57, 28: 526.18,
}


def test_a_published_month(spark):
    rows = [("/d", f"NG_x_202406{d:02d}.psv", round(mb * 1048576)) for d, mb in JUNE_2024.items()]
    files = spark.createDataFrame(rows, "folder string, name string, bytes bigint")
    days = I.per_day(I.dated_files(I.matching_files(files)))
    month = I.rollup(days).where("level = 'month'").first()
    assert (month["year"], month["month"], month["files"]) == (2024, 6, 20)
    assert month["size_mb"] == pytest.approx(14483.45, abs=0.02)
    assert sorted(r["missing_day"] for r in I.missing_days(days).collect()) == [1, 2, 8, 9, 15, 16, 22, 23, 29, 30]
    assert sorted(r["missing_month"] for r in I.missing_months(days).collect()) == [m for m in range(1, 13) if m != 6]


def test_values_far_below_the_header_fill_a_column(grid):
    lines = [["a", "b", None, "d"], ["1", "2", None, "4"], ["1", "2"]] + [["1", "2"]] * 400 + [["1", "2", "late"]]
    profile = P.profile_sheets(grid({"s": lines}), Settings()).first()
    assert profile["empty_columns"] is None
