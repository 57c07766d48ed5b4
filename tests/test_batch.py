"""Files of a dataset loaded together: the same store as after as many single loads, in few jobs."""

from datetime import datetime, timezone

import pytest
from celltables import tuples

from refmill.operators import gates as G
from refmill.plans import audit as A
from refmill.plans.load import LoadRules, load_file, load_files
from refmill.plans.publish import Store
from refmill.sources.registry import REGISTRY_DDL

NOW = datetime(2026, 3, 1, tzinfo=timezone.utc)
CONTRACT = (G.ContractColumn(1, "id", "bigint", False), G.ContractColumn(2, "text", "string"))
FILES = {
    "a": 'id,text\n1,"two\nlines"\n2,\n', "b": "id,text\n3,x\n", "c": "id,text\n4,x\n5,y\n6,z\n", "d drift": "id,text\nno,x\n", "e": "﻿id,text\n7,x\n",
    "f names": "id,txt\n8,x\n", "g": "id,text\r\n9,x\r\n", "h null": "id,text\n,x\n", "i personal": "id,text\n1,me@example.org\n", "j": "id,text\n10,x\n",
    "k": "id,text\n10,x\n", "l nothing": "id,text\n", "m more": "id,text,\n1,2,3\n", "n few": "id,text\n11,q\n12,q\n13,q\n14,q\n", "o": "id,text\n15,é\n", "p": "id,text\n16,x\n",
}


def world(spark, root, files):
    for name, text in files.items():
        (root / "landing").mkdir(parents=True, exist_ok=True)
        (root / "landing" / f"{name}.csv").write_bytes(text.encode())
    row = {"dataset_id": "d1", "domain": "x", "entity": "y", "source_type": "manual", "source_format": "csv", "quarantine_path": f"{root}/landing",
           "rejected_path": f"{root}/refused", "schema_contract_ref": "c", "pii_scan_enabled": True, "owner_upn": "o", "cadence": "adhoc", "active": True}
    listed = [(f"{root}/landing/{n}.csv", f"run {n}") for n in files]
    return Store(spark, f"{root}/store"), spark.createDataFrame([row], REGISTRY_DDL), listed


RULES = LoadRules(CONTRACT, dq=[{"rule_id": "rows", "kind": "row_count", "max": 3}])


def state(store):
    history = A.read_history(store.spark, store.path("history"))
    columns = ["run_id", "status", "reject_reason", "version", "version_label", "row_count", "column_count", "file_size_bytes", "source_file_sha256", "source_file_name",
               "published_table", "snapshot_ref", "schema_changed", "triggered_by", "loaded_by_upn", "contract_version"]
    pubs = store.publications().select("version", "label", "rows", "sha256", "run_id", "contract_version")
    versions = {r.version: tuples(store.read_version("d1", r.version)) for r in pubs.collect()}
    return tuples(history, *columns), tuples(pubs), versions, tuples(store.read_live("d1")), tuples(store.spark.read.parquet(store.path("snapshots")))


def test_together_as_one_by_one(spark, tmp_path):
    results = []
    for way in ("single", "batch"):
        store, registry, listed = world(spark, tmp_path / way, FILES)
        if way == "batch":
            rows = load_files(store, registry, "d1", listed, RULES, now=NOW, loaded_by="loader")
            assert [r["run_id"] for r in rows] == [r for _, r in listed]
        else:
            for path, run_id in listed:
                load_file(store, registry, "d1", path, RULES, run_id=run_id, now=NOW, raise_on_reject=False)
        results.append(state(store))
        assert sorted(p.name.split("_", 1)[1] for p in (tmp_path / way / "refused").iterdir()) == [f"{n}.csv" for n in FILES if " " in n and n != "l nothing"]
    for single, batch in zip(*results):
        assert single == batch


def test_replayed_batch_writes_only_records(spark, tmp_path):
    store, registry, listed = world(spark, tmp_path, {n: FILES[n] for n in "abc"})
    load_files(store, registry, "d1", listed, RULES, now=NOW)
    before = state(store)
    store.remove(store.path("history"))  # the driver was lost before the records were written
    load_files(store, registry, "d1", listed, RULES, now=NOW)
    after = state(store)
    assert before[1:4] == after[1:4]
    assert [r[:4] for r in before[0]] == [r[:4] for r in after[0]]


@pytest.mark.parametrize("n", [4, 24])
def test_jobs_do_not_grow_with_files(spark, tmp_path, n):
    store, registry, listed = world(spark, tmp_path, {f"f{i:02d}": f"id,text\n{i},x\n" for i in range(n)})
    spark.sparkContext.setJobGroup(f"batch {n}", "")
    rows = load_files(store, registry, "d1", listed, RULES, now=NOW)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"batch {n}"))
    spark.sparkContext.setJobGroup("other", "")
    assert [r["version"] for r in rows] == list(range(1, n + 1)) and all(r["status"] == "SUCCESS" for r in rows)
    assert tuples(store.read_live("d1"), "id") == [(n - 1,)]
    assert jobs < 60, jobs
