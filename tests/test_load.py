import io
import zipfile
from datetime import datetime, timedelta, timezone

import pytest
from celltables import tuples
from pyspark.sql import functions as F

from refmill.operators import constraints as C
from refmill.operators import gates as G
from refmill.plans import audit as A
from refmill.plans import extraction as EX
from refmill.plans.load import LoadRules, Rejected, load_file
from refmill.plans.publish import Store
from refmill.sources import files as FS
from refmill.sources import registry as REG
from refmill.sources.workbook import parse_workbooks, scan_workbooks
from refmill.streaming.arrivals import watch_inventory, watch_landing

NOW = datetime(2026, 3, 1, 12, 0, tzinfo=timezone.utc)
CONTRACT = (G.ContractColumn(1, "id", "int", False), G.ContractColumn(2, "name", "string"), G.ContractColumn(3, "rate", "double"))
GOOD = "id,name,rate\n1,north,1.5\n2,south,\n"


@pytest.fixture
def world(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()

    def registry(**over):
        row = {
            "dataset_id": "d1", "domain": "energy", "entity": "use", "source_type": "manual", "source_format": "csv",
            "quarantine_path": str(landing), "schema_contract_ref": "c", "owner_upn": "owner@example.org",
            "steward_upn": "steward@example.org", "cadence": "yearly", "active": True, **over,
        }
        return spark.createDataFrame([row], REG.REGISTRY_DDL)

    return Store(spark, str(tmp_path / "store")), registry, landing


def drop(landing, name, text):
    path = landing / name
    path.write_text(text)
    return str(path)


def history(store):
    return A.read_history(store.spark, store.path("history"))


def load(world, name, text, rules=LoadRules(CONTRACT), registry=None, **kw):
    store, reg, landing = world
    return load_file(store, registry or reg(), "d1", drop(landing, name, text), rules, now=kw.pop("now", NOW), **kw)


# --------------------------------------------------------------------------- registry
def test_registry_defaults_and_lookup(spark, world):
    _, registry, landing = world
    cfg = REG.lookup(registry(), "d1")
    assert cfg["target_table"] == "prod_catalog.reference_data.energy_use"
    assert cfg["rejected_path"] == f"{landing}/_rejected/"
    assert cfg["timetravel_retention_days"] == 90 and cfg["pii_scan_enabled"] is True
    with pytest.raises(ValueError):
        REG.lookup(registry(active=False), "d1")
    with pytest.raises(ValueError):
        REG.lookup(registry(), "other")


# --------------------------------------------------------------------------- loads
def test_good_load_publishes(world):
    store, registry, _ = world
    row = load(world, "a.csv", GOOD)
    assert (row["status"], row["version"], row["row_count"], row["column_count"], row["schema_changed"]) == ("SUCCESS", 1, 2, 3, False)
    live = store.read_live("d1")
    assert tuples(live, "id", "name", "rate", "version_effective_from") == [(1, "north", 1.5, "v2026"), (2, "south", None, "v2026")]
    assert live.first()["source_file_sha256"] == FS.hash_files(store.spark, row["source_file_path"]).first()["sha256"]
    saved = history(store).first()
    assert saved["finished_at_utc"] > saved["started_at_utc"] and saved["file_size_bytes"] == len(GOOD)
    state = A.registry_state(registry(), history(store)).first()
    assert (state["last_status"], state["current_version_label"]) == ("SUCCESS", "v2026")


@pytest.mark.parametrize(
    "text, violation",
    [
        ("id,name\n1,a\n", "MISSING"),
        ("id,name,rate,extra\n1,a,2,3\n", "EXTRA"),
        ("name,id,rate\na,1,2\n", "REORDERED"),
        ("id,label,rate\n1,a,2\n", "RENAMED"),
        ("id,name,rate\nx,a,2\n", "TYPE_DRIFT"),
        ("id,name,rate\n,a,2\n", "NULL_FOUND"),
    ],
)
def test_contract_gate(world, text, violation):
    store, _, landing = world
    load(world, "ok.csv", GOOD)
    with pytest.raises(Rejected) as caught:
        load(world, "bad.csv", text, now=NOW + timedelta(hours=1))
    assert caught.value.reason == G.SCHEMA_MISMATCH
    assert violation in {v["violation"] for v in caught.value.detail["violations"]}
    assert store.latest("d1")["version"] == 1
    assert not (landing / "bad.csv").exists()
    assert [p.name for p in (landing / "_rejected").iterdir() if p.suffix == ".csv"][0].endswith("_bad.csv")
    last = A.latest_loads(history(store)).first()
    assert (last["status"], last["reject_reason"]) == ("REJECTED", G.SCHEMA_MISMATCH)
    outbox = store.spark.read.schema(A.OUTBOX_DDL).parquet(store.path("outbox"))
    assert tuples(outbox, "recipient") == [("owner@example.org",), ("steward@example.org",)]


def test_personal_data_blocks_unless_disabled(world):
    store, registry, _ = world
    text = "id,name,rate\n1,jo@example.org,1\n"
    with pytest.raises(Rejected) as caught:
        load(world, "p.csv", text)
    assert caught.value.reason == G.PII_DETECTED and caught.value.detail["entities"][0]["entity"] == "EMAIL"
    row = load(world, "q.csv", text, registry=registry(pii_scan_enabled=False), now=NOW + timedelta(hours=1))
    assert row["status"] == "SUCCESS"


def test_quality_gate_lists_failed_rules(world):
    rules = LoadRules(
        CONTRACT,
        dq=[
            {"rule_id": "few", "kind": "row_count", "min": 10},
            {"rule_id": "rate", "kind": "null_ratio", "column": "rate", "max": 0.4},
            {"rule_id": "fine", "kind": "range", "column": "id", "min": 0, "max": 9},
            {"rule_id": "names", "kind": "domain", "column": "name", "values": ["north"]},
            {"rule_id": "ids", "kind": "unique", "column": "id"},
        ],
    )
    with pytest.raises(Rejected) as caught:
        load(world, "a.csv", GOOD, rules)
    assert {r["rule_id"] for r in caught.value.detail["failed_rules"]} == {"few", "rate", "names"}


def test_unreadable_format_is_an_extract_failure(world):
    _, registry, _ = world
    with pytest.raises(Rejected) as caught:
        load(world, "a.csv", GOOD, registry=registry(source_format="xml"))
    assert caught.value.reason == G.EXTRACT_FAILED


def test_other_failures_are_recorded_as_error(world):
    store = world[0]
    rules = LoadRules(CONTRACT, dq=[{"rule_id": "x", "kind": "no such kind"}])
    with pytest.raises(ValueError):
        load(world, "a.csv", GOOD, rules)
    assert [r["status"] for r in history(store).collect()] == ["ERROR"]


def test_json_order_does_not_matter(world):
    _, registry, _ = world
    text = '[{"rate": 1.5, "name": "a", "id": 1}, {"rate": null, "name": "b", "id": 2}]'
    row = load(world, "a.json", text, registry=registry(source_format="json"))
    assert (row["status"], row["row_count"]) == ("SUCCESS", 2)


@pytest.mark.parametrize("policy", ["history_partition", "dated_table"])
def test_snapshot_of_a_label_is_replaced(world, policy):
    store, registry, _ = world
    reg = registry(snapshot_policy=policy)
    cfg = REG.lookup(reg, "d1")
    load(world, "a.csv", GOOD, registry=reg)
    load(world, "b.csv", "id,name,rate\n7,new,1\n", registry=reg, now=NOW + timedelta(days=1))
    load(world, "c.csv", GOOD, registry=reg, now=NOW + timedelta(days=400))
    assert tuples(store.read_snapshot(cfg, "v2026"), "id") == [(7,)]
    assert store.read_snapshot(cfg, "v2027").count() == 2
    assert tuples(store.read_version("d1", 1), "id") == [(1,), (2,)]
    assert store.live().first()["version"] == 3


def test_roll_back_and_retention(spark, world):
    store, registry, _ = world
    reg = registry(timetravel_retention_days=10)
    load(world, "a.csv", GOOD, registry=reg)
    load(world, "b.csv", "id,name,rate\n7,new,1\n", registry=reg, now=NOW + timedelta(days=1))
    late = F.lit("2026-04-01").cast("timestamp")
    assert tuples(store.expired(reg, late), "version") == [(1,)]
    assert store.expired(reg, F.lit("2026-03-05").cast("timestamp")).count() == 0
    assert store.roll_back("d1", 1, NOW + timedelta(days=2)) == 3
    assert tuples(store.read_live("d1"), "id") == [(1,), (2,)]
    assert tuples(store.expired(reg, late), "version") == [(2,)]  # version 1's files are live again


def test_contract_change_notifies(world):
    store = world[0]
    load(world, "a.csv", GOOD)
    row = load(world, "b.csv", GOOD, LoadRules(CONTRACT, contract_version=2), now=NOW + timedelta(days=1))
    assert row["schema_changed"] is True
    outbox = store.spark.read.schema(A.OUTBOX_DDL).parquet(store.path("outbox"))
    assert outbox.where(F.col("subject").contains("contract changed")).count() == 2


def test_replayed_run_publishes_once(world):
    store = world[0]
    for _ in range(2):
        load(world, "a.csv", GOOD, run_id="same")
    assert store.publications("d1").count() == 1


# --------------------------------------------------------------------------- freshness
def test_freshness_fixture(spark, world):
    reg = spark.createDataFrame(
        [(d, "x", d, "yearly", 400, "o", d != "d4") for d in ("d1", "d2", "d3", "d4", "d5")],
        "dataset_id string, domain string, entity string, cadence string, sla_days int, owner_upn string, active boolean",
    )
    rows = [
        ("d1", "SUCCESS", "2025-01-01 10:00", "2025-01-01 10:05"),
        ("d2", "REJECTED", "2026-02-01 09:00", "2026-02-01 09:01"),
        ("d3", "SUCCESS", "2026-02-20 09:00", "2026-02-20 09:01"),
    ]
    hist = spark.createDataFrame(rows, "dataset_id string, status string, s string, f string").select(
        "dataset_id", "status", F.col("s").cast("timestamp").alias("started_at_utc"), F.col("f").cast("timestamp").alias("finished_at_utc")
    )
    view = A.freshness_view(reg, hist, F.lit("2026-03-01").cast("timestamp"))
    assert tuples(view, "dataset_id", "days_since_success", "freshness_status", "attempts_90d", "rejects_90d", "never_loaded") == [
        ("d1", 424, "STALE — SLA breached", None, None, False),
        ("d2", None, "OK", 1, 1, True),
        ("d3", 9, "OK", 1, 0, False),
        ("d5", None, "OK", None, None, True),
    ]


# --------------------------------------------------------------------------- gates alone
def test_pii_patterns(spark):
    texts = ["jo@example.org", "020 7946 0000", "QQ123456C", "no data here", "at SW1A 1AA", "+1 (743) 555-3824", "a@b", "12345"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert tuples(G.pii_scan(df), "entity", "hits") == [("EMAIL", 1), ("PHONE", 2), ("UK_NINO", 1), ("UK_POSTCODE", 1)]
    assert tuples(G.blocking(G.pii_scan(df)), "entity") == [("EMAIL",), ("PHONE",), ("UK_NINO",)]
    person = {"PERSON": (0.85, lambda c: c.startswith("jo"))}
    assert ("PERSON", 1) in tuples(G.pii_scan(df, extra=person), "entity", "hits")


def test_config_lint_rules(spark):
    from refmill.sources.config import parse_configs

    ok = '{"sheet_name":"s","output_name":"o","table_type":"simple","header_row":1,"data_start_row":2}'
    cases = {
        "missing config_name": '{"config_name":"","sheets":[%s]}' % ok,
        "no sheets": '{"config_name":"c","sheets":[]}',
        "missing sheet_name": '{"config_name":"c","sheets":[%s]}' % ok.replace('"s"', '""'),
        "missing output_name": '{"config_name":"c","sheets":[%s]}' % ok.replace('"o"', '""'),
        "invalid table_type": '{"config_name":"c","sheets":[%s]}' % ok.replace("simple", "odd"),
        "duplicate output_name": '{"config_name":"c","sheets":[%s,%s]}' % (ok, ok),
        "missing header row": '{"config_name":"c","sheets":[%s]}' % ok.replace('"header_row":1,', ""),
        "missing data_start_row": '{"config_name":"c","sheets":[%s]}' % ok.replace(',"data_start_row":2', ""),
        "side_by_side without sections": '{"config_name":"c","sheets":[%s]}' % ok.replace("simple", "side_by_side"),
        "section start right of end": '{"config_name":"c","sheets":[%s]}'
        % ok.replace("simple", "side_by_side").replace("}", ',"sections":[{"name":"n","start_col":"C","end_col":"B"}]}'),
        "stacked without tables": '{"config_name":"c","sheets":[%s]}' % ok.replace("simple", "stacked"),
        "column entry without col or name": '{"config_name":"c","sheets":[%s]}' % ok.replace("}", ',"columns":[{"col":"A"}]}'),
        "invalid type_inference": '{"config_name":"c","settings":{"type_inference":"x"},"sheets":[%s]}' % ok,
        "invalid on_error": '{"config_name":"c","settings":{"on_error":"x"},"sheets":[%s]}' % ok,
    }
    rows = [*cases.items(), (None, '{"config_name":"c","sheets":[%s]}' % ok)]
    df = parse_configs(spark.createDataFrame(rows, "want string, config_json string"))
    got = C.lint_configs(df, ["want"])
    assert tuples(got, "want", "rule") == sorted(((k, k) for k in cases), key=repr)
    stacked = ok.replace("simple", "stacked").replace("}", ',"tables":[{"header_rows":[1],"data_start_row":2}]}')
    fine = parse_configs(spark.createDataFrame([('{"config_name":"c","sheets":[%s]}' % stacked,)], "config_json string"))
    assert C.lint_configs(fine, []).count() == 0


# --------------------------------------------------------------------------- workbooks
SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="inlineStr"><is><t>Rate</t></is></c><c r="C1" t="s"><v>1</v></c></row>
<row r="2"><c r="A2"><v>1</v></c><c r="B2"><v>1.5</v></c><c r="C2" s="1"><v>45000</v></c></row>
<row r="4"><c r="A4" t="b"><v>1</v></c><c r="B4" t="e"><v>#N/A</v></c><c r="C4" t="str"><f>1+1</f><v>two</v></c><c r="D4" s="1"/></row>
</sheetData><mergeCells count="1"><mergeCell ref="A1:A2"/></mergeCells></worksheet>"""


def book(path, sheets=("Data",), xml=SHEET, date1904=False):
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}">'
        + ('<workbookPr date1904="1"/>' if date1904 else "")
        + "<sheets>"
        + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        + "".join(f'<Relationship Id="rId{i}" Target="/xl/worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        + "</Relationships>",
        "xl/sharedStrings.xml": f'<sst xmlns="{main}"><si><t>Id</t><rPh sb="0" eb="1"><t>no</t></rPh></si><si><r><t>Si</t></r><r><t>nce</t></r></si></sst>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><numFmts><numFmt numFmtId="170" formatCode="[Red]yyyy\\-mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/></cellXfs></styleSheet>',
    }
    for i in range(1, len(sheets) + 1):
        parts[f"xl/worksheets/sheet{i}.xml"] = xml
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    path.write_bytes(out.getvalue())


def test_workbook_cells(spark, tmp_path):
    book(tmp_path / "a.xlsx", ("One", "Two"))
    (tmp_path / "old.xls").write_bytes(b"x")
    (tmp_path / "broken.xlsx").write_bytes(b"not a zip")
    books = scan_workbooks(spark, str(tmp_path))
    one = books.cells.where("sheet = 'One'")
    assert tuples(one, "r", "c", "value", "kind") == sorted(
        [
            (1, 1, "Id", "string"), (1, 2, "Rate", "string"), (1, 3, "Since", "string"), (2, 1, "1", "number"),
            (2, 2, "1.5", "number"), (2, 3, "2023-03-15 00:00:00", "date"), (4, 1, "True", "bool"),
            (4, 2, "#N/A", "string"), (4, 3, "two", "string"),
        ],
        key=repr,
    )
    assert books.cells.where("sheet = 'Two'").count() == 9
    assert tuples(books.sheets, "sheet", "position") == [("One", 0), ("Two", 1)]
    assert tuples(books.merges.where("sheet = 'One'"), "min_r", "min_c", "max_r", "max_c") == [(1, 1, 2, 1)]
    errors = {r["workbook"].split("/")[-1]: r["error"] for r in books.errors.collect()}
    assert set(errors) == {"old.xls", "broken.xlsx"} and "xls" in errors["old.xls"]


def test_workbook_1904_dates_and_large_sheet(spark, tmp_path):
    rows = "".join(f'<row r="{r}"><c r="A{r}"><v>{r}</v></c><c r="B{r}"><v>0.5</v></c></row>' for r in range(1, 60_001))
    xml = f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{rows}</sheetData></worksheet>'
    book(tmp_path / "big.xlsx", xml=xml)
    cells = scan_workbooks(spark, str(tmp_path)).cells
    assert cells.agg(F.count("*"), F.max("r"), F.countDistinct("r")).first()[:] == (120_000, 60_000, 60_000)
    other = tmp_path / "x"
    other.mkdir()
    book(other / "m.xlsx", date1904=True)
    day = scan_workbooks(spark, str(other)).cells.where("kind = 'date'").first()["value"]
    assert day == "2027-03-16 00:00:00"


def test_extraction_job(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    book(source / "a.xlsx", ("Data", "Other"))
    config = {
        "config_name": "c", "config_version": "1",
        "sheets": [
            {"sheet_name": "Data", "output_name": "t", "table_type": "simple", "header_row": 1, "data_start_row": 2, "data_end_row": 2},
            {"sheet_name": "Other", "output_name": "e", "table_type": "simple", "header_row": 90, "data_start_row": 91},
            {"sheet_name": "Gone", "output_name": "g", "table_type": "simple", "header_row": 1, "data_start_row": 2},
        ],
    }
    books = scan_workbooks(spark, str(source))
    results, notes = EX.extract_all(books, config)
    assert tuples(notes, "sheet") == [("Gone",)]
    manifest = EX.save_all(spark, results, config, str(tmp_path / "out"), "parquet", str(source))
    assert tuples(manifest, "table", "status", "rows") == [("e", "empty", None), ("t", "ok", 1)]
    back = spark.read.parquet(str(tmp_path / "out" / "t"))
    assert back.dtypes == [("Id", "string"), ("Rate", "double"), ("Since", "timestamp")] or back.columns == ["Id", "Rate", "Since"]
    totals = EX.manifest_totals(manifest).first()
    assert (totals["total_tables_ok"], totals["total_tables_error"], totals["total_rows"]) == (1, 0, 1)
    only, _ = EX.extract_all(books, config, sheet_filter=["Data"])
    assert [r.output_name for r in only] == ["t"]
    with pytest.raises(ValueError):
        EX.extract_all(books, {**config, "config_name": ""})


def test_excel_load(spark, world):
    store, registry, landing = world
    book(landing / "a.xlsx")
    cfg = {"config_name": "c", "sheets": [{"sheet_name": "Data", "output_name": "t", "table_type": "simple", "header_row": 1, "data_start_row": 2, "data_end_row": 2}]}
    contract = (G.ContractColumn(1, "Id", "string"), G.ContractColumn(2, "Rate", "double"), G.ContractColumn(3, "Since", "timestamp"))
    row = load_file(store, registry(source_format="excel"), "d1", str(landing / "a.xlsx"), LoadRules(contract, extract_config=cfg), now=NOW)
    assert (row["status"], row["row_count"]) == ("SUCCESS", 1)


# --------------------------------------------------------------------------- listing and streams
def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    drop(tmp_path / "sub", "NG_a.csv", "12345")
    df = FS.listing(spark, str(tmp_path))
    assert tuples(df, "name", "bytes") == [("NG_a.csv", 5)]
    assert "content#" not in df._jdf.queryExecution().executedPlan().toString()


def test_arriving_files_are_listed_once(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    drop(landing, "a.csv", "1")
    for expected in (1, 1, 2):
        watch_inventory(spark, str(landing), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "t")).count() == expected
        if expected == 1 and not (landing / "b.csv").exists() and (tmp_path / "again").exists():
            drop(landing, "b.csv", "22")
        (tmp_path / "again").touch()


def test_landing_stream_loads_each_file_once(spark, world, tmp_path):
    store, registry, landing = world
    drop(landing, "good.csv", GOOD)
    drop(landing, "bad.csv", "id,name\n1,a\n")
    seen = []
    for _ in range(2):
        query = watch_landing(
            store, registry(), {"d1": LoadRules(CONTRACT)}, str(landing), str(tmp_path / "check"), on_result=seen.append
        )
        query.awaitTermination()
    assert sorted(r["status"] for r in seen) == ["REJECTED", "SUCCESS"]
    assert history(store).count() == 2 and store.latest("d1")["version"] == 1
    # A lost checkpoint replays the listing; files already loaded are known by their run id.
    watch_landing(store, registry(), {"d1": LoadRules(CONTRACT)}, str(landing), str(tmp_path / "fresh")).awaitTermination()
    assert history(store).count() == 2


def test_parse_accepts_content_rows(spark, tmp_path):
    book(tmp_path / "a.xlsx")
    raw = spark.createDataFrame([("mem/a.xlsm", (tmp_path / "a.xlsx").read_bytes())], "path string, content binary")
    assert parse_workbooks(raw).cells.count() == 9


def test_worker_functions_need_no_package_on_the_executor(tmp_path):
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    from refmill.plans.catalog import books as B
    from refmill.sources import workbook as W

    code = "import pickle, sys; print([f.__name__ for f in pickle.loads(sys.stdin.buffer.read())])"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    sent = cloudpickle.dumps([W._unpack, W._parse, B._zip])
    done = subprocess.run([sys.executable, "-c", code], input=sent, capture_output=True, cwd=tmp_path, env=env, timeout=60)
    assert done.returncode == 0, done.stderr.decode()
