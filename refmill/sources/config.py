"""Extraction configs: schema, defaults, hash, and the driver-side settings object."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

# --- fixed values: legal words in a config
TYPE_INFERENCE = ("none", "safe", "aggressive")
ON_ERROR = ("continue", "fail_fast")
TABLE_TYPES = ("simple", "side_by_side", "stacked")
UNPIVOT_MODES = ("as_configured", "force_wide", "force_unpivot")

_SETTINGS_DDL = """
  null_markers ARRAY<STRING>, note_pattern STRING, type_inference STRING,
  decimal_sep STRING, thousands_sep STRING, header_search_max_rows INT,
  max_scan_cols INT, max_scan_rows INT, stop_on_blank_rows INT,
  footer_markers ARRAY<STRING>, resolve_merged_cells BOOLEAN,
  dedupe_headers BOOLEAN, on_error STRING
"""
_TABLE_DDL = """
  name STRING, header_row INT, header_rows ARRAY<INT>, data_start_row INT,
  data_end_row INT, start_col STRING, static_columns MAP<STRING,STRING>
"""
_SHEET_DDL = f"""
  sheet_name STRING, output_name STRING, table_type STRING, header_row INT,
  header_rows ARRAY<INT>, header_join STRING, data_start_row INT, data_end_row INT,
  start_col STRING, index_columns ARRAY<STRING>, section_column_name STRING,
  sections ARRAY<STRUCT<name STRING, start_col STRING, end_col STRING>>,
  tables ARRAY<STRUCT<{_TABLE_DDL}>>,
  columns ARRAY<STRUCT<col STRING, name STRING>>, drop_columns ARRAY<STRING>,
  rename_columns MAP<STRING,STRING>, static_columns MAP<STRING,STRING>,
  column_types MAP<STRING,STRING>, unpivot BOOLEAN, unpivot_id_cols ARRAY<STRING>,
  unpivot_var_name STRING, unpivot_value_name STRING,
  exclude_from_unpivot ARRAY<STRING>
"""
CONFIG_DDL = f"""
  config_name STRING, config_version STRING, null_markers ARRAY<STRING>,
  note_pattern STRING, settings STRUCT<{_SETTINGS_DDL}>,
  sheets ARRAY<STRUCT<{_SHEET_DDL}>>
"""

def config_schema() -> str:
    return " ".join(CONFIG_DDL.split())


def read_configs(spark: SparkSession, path: str) -> DataFrame:
    """Configs as rows with one fixed schema; absent keys are null."""
    return spark.read.schema(config_schema()).option("multiLine", True).json(path)


def parse_configs(df: DataFrame, json_column: str = "config_json") -> DataFrame:
    """JSON text rows → the same struct, in column ``config``."""
    return df.withColumn("config", F.from_json(json_column, config_schema()))


@dataclass(frozen=True)
class Settings:
    """Workbook-level behaviour; every field can be set in the config's ``settings``."""

    null_markers: tuple[str, ...] = X.NULL_MARKERS
    note_pattern: str | None = X.NOTE_PATTERN
    type_inference: str = "safe"
    decimal_sep: str = "."
    thousands_sep: str = ","
    header_search_max_rows: int = 25
    max_scan_cols: int = 16_384
    max_scan_rows: int = 1_048_576
    stop_on_blank_rows: int = 1
    footer_markers: tuple[str, ...] = ()
    resolve_merged_cells: bool = True
    dedupe_headers: bool = True
    on_error: str = "continue"

    def __post_init__(self) -> None:
        if self.type_inference not in TYPE_INFERENCE:
            raise ValueError(f"settings.type_inference must be one of {TYPE_INFERENCE}, got {self.type_inference!r}")
        if self.on_error not in ON_ERROR:
            raise ValueError(f"settings.on_error must be one of {ON_ERROR}, got {self.on_error!r}")

    @classmethod
    def of(cls, config: Mapping[str, Any]) -> Settings:
        given = dict(config.get("settings") or {})
        for old_place in ("null_markers", "note_pattern"):
            if config.get(old_place) is not None:
                given.setdefault(old_place, config[old_place])
        known = {f.name for f in fields(cls)}
        values = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in known and v is not None}
        return cls(**values)


def resolve_settings(configs: DataFrame, config: str = "config") -> DataFrame:
    """Effective settings of a *table* of configs: block, else old top-level key, else default."""
    defaults = Settings()

    def default_of(name: str) -> Column:
        value = getattr(defaults, name)
        if isinstance(value, tuple):
            return F.array(*[F.lit(v) for v in value]) if value else F.lit([]).cast("array<string>")
        return F.lit(value)

    def effective(name: str) -> Column:
        places = [F.col(f"{config}.settings.{name}")]
        if name in ("null_markers", "note_pattern"):
            places.append(F.col(f"{config}.{name}"))
        return F.coalesce(*places, default_of(name)).alias(name)

    return configs.select("*", *[effective(f.name) for f in fields(Settings)])


def config_hash(config: Mapping[str, Any]) -> str:
    """Short, key-order independent hash of a config."""
    text = json.dumps(config, sort_keys=True, default=str)
    return hashlib.sha256(text.encode("utf-8")).hexdigest()[:16]


def text_hash(json_text: Column) -> Column:
    """The same short hash over JSON text that is already key-sorted."""
    return F.substring(F.sha2(json_text, 256), 1, 16)


def flat_hash(json_text: Column) -> Column:
    """The short hash of flat JSON objects of texts, whatever the order of their keys."""

    def quoted(text: Column) -> Column:
        listed = F.to_json(F.array(text))
        return F.substring(listed, F.lit(2), F.length(listed) - 2)

    entries = F.array_sort(F.map_entries(F.from_json(json_text, "map<string, string>")))
    pairs = F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit(": "), quoted(e["value"])))
    return text_hash(F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")))
