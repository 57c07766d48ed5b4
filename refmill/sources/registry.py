"""Dataset registry: lookup, defaults, derived names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.constraints import REGISTRY_DEFAULTS, apply_defaults

REGISTRY_DDL = """
  dataset_id string, domain string, entity string, display_name string, description string,
  source_type string, source_config string, source_format string, quarantine_path string,
  rejected_path string, extract_config_ref string, schema_contract_ref string,
  dq_rules_ref string, pii_scan_enabled boolean, target_catalog string, target_schema string,
  snapshot_policy string, timetravel_retention_days int, owner_upn string, steward_upn string,
  cadence string, sla_days int, active boolean, created_at_utc timestamp, created_by string,
  updated_at_utc timestamp, updated_by string
"""


def read_registry_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Registry kept in an external database; the filters of a lookup are pushed into its query."""
    return spark.read.format("jdbc").options(**options).load()


def effective_registry(registry: DataFrame) -> DataFrame:
    """Active rows with defaults filled in and the names derived from them."""
    filled = apply_defaults(registry, {k: v for k, v in REGISTRY_DEFAULTS.items() if k in registry.columns})
    default_reject = F.concat(X.trim_slash(F.col("quarantine_path")), F.lit("/_rejected/"))
    target = X.table_name(F.col("target_catalog"), F.col("target_schema"), F.col("domain"), F.col("entity"))
    return (
        filled.where(F.col("active"))
        .withColumn("rejected_path", F.coalesce(F.nullif("rejected_path", F.lit("")), default_reject))
        .withColumn("target_table", target)
        .withColumn("history_table", F.concat(target, F.lit("_history")))
    )


def lookup(registry: DataFrame, dataset_id: str) -> dict:
    """The one active row of a dataset; an error when there is none."""
    rows = effective_registry(registry.where(F.col("dataset_id") == dataset_id)).limit(2).collect()
    if not rows:
        raise ValueError(f"no active registry row for dataset_id={dataset_id!r}")
    if len(rows) > 1:
        raise ValueError(f"more than one active registry row for dataset_id={dataset_id!r}")
    return rows[0].asDict(recursive=True)
