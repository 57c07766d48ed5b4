"""Extraction job: all sheets of a config, written per table, with a manifest."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import ENGINE_VERSION
from ..operators.constraints import lint_configs
from ..operators.extract import Table, extract_table
from ..operators.merges import fill_merged
from ..session import stage
from ..sources.config import Settings, config_hash, config_schema
from ..sources.workbook import Workbooks

MANIFEST_DDL = """
  run_id string, config_name string, config_version string, engine_version string, config_hash string,
  source string, output_format string, `table` string, sheet string, status string, error string,
  path string, duration_ms bigint, `rows` bigint, `columns` int,
  profile array<struct<name string, type string, nulls bigint>>
"""


@dataclass(frozen=True)
class Extracted:
    output_name: str
    sheet: str
    table: Table | None
    error: str | None = None
    started: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


def check_config(spark: SparkSession, config: Mapping[str, Any]) -> None:
    """The first broken rule stops a run before any data is read; warnings do not."""
    import json

    one = spark.createDataFrame([(json.dumps(config),)], "config_json string").select(
        F.from_json("config_json", config_schema()).alias("config")
    )
    found = lint_configs(one, []).where(~F.startswith("rule", F.lit("warning"))).limit(20).collect()
    if found:
        raise ValueError("; ".join(f"{r['loc']}: {r['rule']}" for r in found))


def extract_all(
    books: Workbooks,
    config: Mapping[str, Any],
    sheet_filter: Sequence[str] = (),
    unpivot_mode: str = "as_configured",
    end_from_first_block: bool = False,
    provenance: bool = False,
) -> tuple[list[Extracted], DataFrame]:
    """Tables by config entry, and ``(sheet, message)`` rows for sheets that are not there."""
    spark = books.cells.sparkSession
    check_config(spark, config)
    settings = Settings.of(config)
    names = list(dict.fromkeys([s["sheet_name"] for s in config["sheets"]] + list(sheet_filter)))
    # One row per requested name; a workbook's own sheets never come to the driver.
    wanted = spark.createDataFrame([(n,) for n in names], "sheet string")
    missing = wanted.join(books.sheets.select("sheet").distinct(), "sheet", "left_anti")
    absent = {r["sheet"] for r in missing.collect()}
    chosen = [
        s
        for s in config["sheets"]
        if s["sheet_name"] not in absent and (not sheet_filter or s["sheet_name"] in sheet_filter)
    ]
    cells = books.cells.where(F.col("sheet").isin([s["sheet_name"] for s in chosen]))
    if settings.resolve_merged_cells:
        cells = fill_merged(cells, books.merges, settings.max_scan_rows, settings.max_scan_cols)
    grid = stage(cells)
    out = []
    for sheet in chosen:
        started = datetime.now(timezone.utc)
        try:
            table = extract_table(
                grid, sheet, settings, unpivot_mode, end_from_first_block, provenance=provenance
            )
            out.append(Extracted(sheet["output_name"], sheet["sheet_name"], table, None, started))
        except Exception as error:
            if settings.on_error == "fail_fast":
                raise
            out.append(Extracted(sheet["output_name"], sheet["sheet_name"], None, str(error)[:500], started))
    notes = missing.select("sheet", F.lit("sheet not found, skipped").alias("message"))
    return out, notes


def save_all(
    spark: SparkSession,
    results: Sequence[Extracted],
    config: Mapping[str, Any],
    path: str,
    output_format: str,
    source: str,
    run_id: str | None = None,
) -> DataFrame:
    """Write every non-empty table below ``path`` and return the manifest rows.

    Row and null counts are observed while a table is written; nothing is read twice.
    """
    run_id = run_id or uuid.uuid4().hex
    base = {
        "run_id": run_id,
        "config_name": config["config_name"],
        "config_version": config.get("config_version") or "unknown",
        "engine_version": ENGINE_VERSION,
        "config_hash": config_hash(config),
        "source": source,
        "output_format": output_format,
    }
    rows = []
    for item in results:
        row = {**base, "table": item.output_name, "sheet": item.sheet, "status": "error", "error": item.error}
        if item.table is not None:
            row.update(_write(item, f"{path.rstrip('/')}/{item.output_name}", output_format))
        rows.append(row)
    manifest = spark.createDataFrame(rows, MANIFEST_DDL)
    manifest.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/_manifest")
    return manifest


def _write(item: Extracted, path: str, output_format: str) -> dict[str, Any]:
    frame = item.table.frame
    columns = list(item.table.columns)
    if not columns or frame.isEmpty():
        return {"status": "empty", "error": None}
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    counts += [(F.count(F.lit(1)) - F.count(F.col(f"`{c}`"))).alias(f"n{i}") for i, c in enumerate(frame.columns)]
    writer = frame.observe(seen, *counts).write.mode("overwrite").format(output_format)
    (writer.option("header", True) if output_format == "csv" else writer).save(path)
    got = seen.get
    elapsed = datetime.now(timezone.utc) - item.started
    return {
        "status": "ok",
        "error": None,
        "path": path,
        "duration_ms": int(elapsed.total_seconds() * 1000),
        "rows": got["rows"],
        "columns": len(frame.columns),
        "profile": [
            {"name": f.name, "type": f.dataType.simpleString(), "nulls": got[f"n{i}"]}
            for i, f in enumerate(frame.schema.fields)
        ],
    }


def manifest_totals(manifest: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    return manifest.groupBy(*keys).agg(
        F.count_if(F.col("status") == "ok").alias("total_tables_ok"),
        F.count_if(F.col("status") == "error").alias("total_tables_error"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
    )
