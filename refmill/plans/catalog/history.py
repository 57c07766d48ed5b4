"""Registry, load history, freshness and constraint queries.

Registry rows come from ``customer``, load attempts from ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions import text as X
from ...operators import constraints as C
from ...sources import registry as REG
from .. import audit as A
from .base import query, select, select_sql

AS_OF = "2024-04-10 12:00:00"

REGISTRY = {
    "dataset_id": "concat('ds_', CAST(c_custkey AS STRING))",
    "domain": "lower(c_mktsegment)",
    "entity": "concat('entity_', CAST(c_custkey % 1000 AS STRING))",
    "source_type": "CASE c_nationkey % 5 WHEN 0 THEN 'api' WHEN 1 THEN 'sharepoint' WHEN 2 THEN 'mailbox' WHEN 3 THEN 'manual' ELSE 'ftp' END",
    "source_format": "CASE c_custkey % 4 WHEN 0 THEN 'excel' WHEN 1 THEN 'csv' WHEN 2 THEN 'json' ELSE 'xml' END",
    "quarantine_path": "concat('/landing/', lower(c_mktsegment), '/')",
    "rejected_path": "CASE WHEN c_custkey % 2 = 1 THEN concat('/rejected/', lower(c_mktsegment), '/') END",
    "schema_contract_ref": "CASE WHEN c_custkey % 13 <> 5 THEN concat('contract_', CAST(c_custkey AS STRING)) END",
    "pii_scan_enabled": "CASE WHEN c_custkey % 6 = 1 THEN FALSE WHEN c_custkey % 6 = 2 THEN TRUE END",
    "target_catalog": "CASE WHEN c_custkey % 5 = 1 THEN 'test_catalog' END",
    "target_schema": "CASE WHEN c_custkey % 5 = 2 THEN 'staging' END",
    "snapshot_policy": "CASE c_custkey % 3 WHEN 0 THEN 'history_partition' WHEN 1 THEN 'dated_table' END",
    "timetravel_retention_days": "CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey % 20 + 1 AS INT) END",
    "owner_upn": "concat('owner', CAST(c_nationkey AS STRING), '@example.org')",
    "steward_upn": "CASE WHEN c_custkey % 3 <> 0 THEN concat('steward', CAST(c_nationkey AS STRING), '@example.org') END",
    "cadence": "CASE c_nationkey % 4 WHEN 0 THEN 'quarterly' WHEN 1 THEN 'yearly' WHEN 2 THEN 'adhoc' END",
    "sla_days": "CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_custkey % 60 + 60 AS INT) END",
    "active": "CASE WHEN c_custkey % 10 <> 9 THEN TRUE WHEN c_custkey % 20 = 9 THEN FALSE END",
}
REGISTRY_SQL = select_sql("customer", REGISTRY)

HISTORY = {
    "dataset_id": "concat('ds_', CAST(user_id AS STRING))",
    "run_id": "event_id",
    "status": "CASE event_type WHEN 'error' THEN 'REJECTED' WHEN 'click' THEN 'ERROR' WHEN 'view' THEN 'RUNNING' ELSE 'SUCCESS' END",
    "reject_reason": "CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 'SCHEMA_MISMATCH' WHEN 1 THEN 'PII_DETECTED' WHEN 2 THEN 'DQ_FAILED' ELSE 'EXTRACT_FAILED' END END",
    "reject_detail": "props",
    "version_label": "concat('v', CAST(2000 + event_id % 30 AS STRING))",
    "source_file_name": "concat('drop_', CAST(event_id AS STRING), '.csv')",
    "started_at_utc": "ts",
    "value": "value",
}
HISTORY_SQL = (
    "SELECT *, started_at_utc + to_milliseconds(CAST(floor(value * 100) AS BIGINT)) AS finished_at_utc FROM ("
    + select_sql("events", HISTORY)
    + ")"
)


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select(spark, sf_dir, "customer", REGISTRY)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = (F.floor(F.col("value") * 100).cast("decimal(18,0)") / 1000).cast("decimal(18,6)")
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return select(spark, sf_dir, "events", HISTORY).withColumn("finished_at_utc", F.col("started_at_utc") + step)


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


@query(
    "freshness_view",
    f"""
    WITH r AS ({REGISTRY_SQL}), h AS ({HISTORY_SQL}),
    last_ok AS (SELECT dataset_id, max(finished_at_utc) AS last_success_at_utc FROM h WHERE status = 'SUCCESS' GROUP BY 1),
    attempts AS (
      SELECT dataset_id, count(*) AS attempts_90d,
             CAST(sum(CASE WHEN status = 'REJECTED' THEN 1 ELSE 0 END) AS BIGINT) AS rejects_90d
      FROM h WHERE started_at_utc >= TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY GROUP BY 1)
    SELECT r.dataset_id, r.domain, r.entity, r.cadence, r.sla_days, r.owner_upn, o.last_success_at_utc,
           datediff('day', o.last_success_at_utc, TIMESTAMP '{AS_OF}') AS days_since_success,
           CASE WHEN r.sla_days IS NOT NULL
                 AND datediff('day', o.last_success_at_utc, TIMESTAMP '{AS_OF}') > r.sla_days
                THEN 'STALE — SLA breached' ELSE 'OK' END AS freshness_status,
           a.attempts_90d, a.rejects_90d, o.last_success_at_utc IS NULL AS never_loaded
    FROM r LEFT JOIN last_ok o ON o.dataset_id = r.dataset_id
           LEFT JOIN attempts a ON a.dataset_id = r.dataset_id
    WHERE r.active
    """,
)
def freshness_view(spark, sf_dir):
    return A.freshness_view(registry(spark, sf_dir), history(spark, sf_dir), as_of())


@query(
    "last_success",
    f"SELECT dataset_id, max(finished_at_utc) AS last_success_at_utc FROM ({HISTORY_SQL}) WHERE status = 'SUCCESS' GROUP BY 1",
)
def last_success(spark, sf_dir):
    return A.last_success(history(spark, sf_dir))


@query(
    "recent_attempts",
    f"""
    SELECT dataset_id, count(*) AS attempts_90d, count(*) FILTER (status = 'REJECTED') AS rejects_90d
    FROM ({HISTORY_SQL}) WHERE started_at_utc >= TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY GROUP BY 1
    """,
)
def recent_attempts(spark, sf_dir):
    return A.recent_attempts(history(spark, sf_dir), as_of())


@query(
    "latest_load_state",
    f"""
    SELECT dataset_id, status, started_at_utc, reject_reason FROM (
      SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY started_at_utc DESC, run_id DESC) AS n
      FROM ({HISTORY_SQL})) WHERE n = 1
    """,
)
def latest_load_state(spark, sf_dir):
    return A.latest_loads(history(spark, sf_dir))


@query(
    "reject_rates",
    f"""
    SELECT dataset_id, count(*) AS attempts, count(*) FILTER (status = 'REJECTED') AS rejects,
           round(count(*) FILTER (status = 'REJECTED') / count(*), 6) AS reject_rate
    FROM ({HISTORY_SQL}) GROUP BY 1
    """,
)
def reject_rates(spark, sf_dir):
    return A.reject_rates(history(spark, sf_dir))


@query(
    "registry_state",
    f"""
    WITH h AS ({HISTORY_SQL}),
    s AS (SELECT dataset_id, max(started_at_utc) AS last_attempt_at_utc,
                 max(finished_at_utc) FILTER (status = 'SUCCESS') AS last_success_at_utc,
                 arg_max(status, (started_at_utc, run_id)) AS last_status
          FROM h GROUP BY 1),
    v AS (SELECT dataset_id, arg_max(version_label, (started_at_utc, run_id)) AS current_version_label
          FROM h WHERE status = 'SUCCESS' GROUP BY 1)
    SELECT r.dataset_id, r.active, s.last_attempt_at_utc, s.last_success_at_utc, s.last_status, v.current_version_label
    FROM ({REGISTRY_SQL}) r LEFT JOIN s USING (dataset_id) LEFT JOIN v USING (dataset_id)
    """,
)
def registry_state(spark, sf_dir):
    slim = registry(spark, sf_dir).select("dataset_id", "active")
    return A.registry_state(slim, history(spark, sf_dir))


@query(
    "load_latency",
    f"""
    SELECT dataset_id, count(ms) AS loads, min(ms) AS min_ms, max(ms) AS max_ms, CAST(sum(ms) AS BIGINT) AS total_ms
    FROM (SELECT dataset_id, epoch_ms(finished_at_utc) - epoch_ms(started_at_utc) AS ms FROM ({HISTORY_SQL})) GROUP BY 1
    """,
)
def load_latency(spark, sf_dir):
    return A.load_latency(history(spark, sf_dir))


# --------------------------------------------------------------------------- registry lookups
@query(
    "registry_config",
    f"""
    SELECT dataset_id, concat(coalesce(target_catalog, 'prod_catalog'), '.', coalesce(target_schema, 'reference_data'),
                              '.', domain, '_', entity) AS target_table,
           concat(coalesce(target_catalog, 'prod_catalog'), '.', coalesce(target_schema, 'reference_data'),
                  '.', domain, '_', entity, '_history') AS history_table,
           coalesce(rejected_path, concat(rtrim(quarantine_path, '/'), '/_rejected/')) AS rejected_path,
           coalesce(snapshot_policy, 'history_partition') AS snapshot_policy,
           coalesce(timetravel_retention_days, 90) AS timetravel_retention_days,
           coalesce(pii_scan_enabled, TRUE) AS pii_scan_enabled
    FROM ({REGISTRY_SQL}) WHERE coalesce(active, TRUE)
    """,
)
def registry_config(spark, sf_dir):
    return REG.effective_registry(registry(spark, sf_dir)).select(
        "dataset_id", "target_table", "history_table", "rejected_path", "snapshot_policy",
        "timetravel_retention_days", "pii_scan_enabled",
    )


@query(
    "rejected_paths",
    f"""
    SELECT h.dataset_id, h.run_id,
           concat(rtrim(coalesce(r.rejected_path, concat(rtrim(r.quarantine_path, '/'), '/_rejected/')), '/'), '/',
                  strftime(h.finished_at_utc, '%Y%m%dT%H%M%S'), '_', h.source_file_name) AS moved_to,
           concat('REJECTED (', h.reject_reason, '): ', coalesce(target_catalog, 'prod_catalog'), '.',
                  coalesce(target_schema, 'reference_data'), '.', domain, '_', entity) AS subject,
           u.recipient
    FROM ({HISTORY_SQL}) h JOIN ({REGISTRY_SQL}) r USING (dataset_id),
         LATERAL (SELECT unnest([r.owner_upn, r.steward_upn]) AS recipient) u
    WHERE h.status = 'REJECTED' AND coalesce(r.active, TRUE) AND u.recipient IS NOT NULL
    """,
)
def rejected_paths(spark, sf_dir):
    """Rejects with their move target, one row per person to notify."""
    rejected = history(spark, sf_dir).where(F.col("status") == "REJECTED")
    reg = REG.effective_registry(registry(spark, sf_dir)).select(
        "dataset_id", "owner_upn", "steward_upn", "rejected_path", "target_table"
    )
    events = A.reject_events(rejected.join(reg, "dataset_id"))
    messages = A.outbox_rows(events).select("dataset_id", "run_id", "recipient", "subject")
    return messages.join(events.select("dataset_id", "run_id", "moved_to"), ["dataset_id", "run_id"])


@query(
    "history_extracts",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           concat('{"k":', CAST(json_extract(props, '$.k') AS STRING), '}') AS detail,
           left(concat(event_type, ':', props), 12) AS short
    FROM events
    """,
)
def history_extracts(spark, sf_dir):
    """JSON text columns parsed, written back and cut to their stored width."""
    props = F.from_json("props", "k bigint")
    return select(spark, sf_dir, "events", {"event_id": "event_id", "event_type": "event_type", "props": "props"}).select(
        "event_id",
        props["k"].alias("k"),
        F.to_json(props).alias("detail"),
        F.left(F.concat_ws(":", "event_type", "props"), F.lit(12)).alias("short"),
    )


# --------------------------------------------------------------------------- constraints
@query(
    "domain_violations",
    f"""
    WITH r AS ({REGISTRY_SQL})
    SELECT dataset_id, 'source_type' AS column_name, source_type AS value FROM r WHERE source_type NOT IN ('api','sharepoint','mailbox','manual')
    UNION ALL SELECT dataset_id, 'source_format', source_format FROM r WHERE source_format NOT IN ('excel','csv','json')
    UNION ALL SELECT dataset_id, 'snapshot_policy', snapshot_policy FROM r WHERE snapshot_policy NOT IN ('history_partition','dated_table')
    UNION ALL SELECT dataset_id, 'cadence', cadence FROM r WHERE cadence NOT IN ('quarterly','yearly','adhoc')
    """,
)
def domain_violations(spark, sf_dir):
    return C.domain_violations(registry(spark, sf_dir), C.REGISTRY_DOMAINS, ["dataset_id"])


@query(
    "history_domain_violations",
    f"SELECT run_id, 'status' AS column_name, status AS value FROM ({HISTORY_SQL}) WHERE status NOT IN ('SUCCESS','REJECTED','ERROR')",
)
def history_domain_violations(spark, sf_dir):
    return C.domain_violations(history(spark, sf_dir), C.HISTORY_DOMAINS, ["run_id"])


@query(
    "null_violations",
    f"""
    WITH r AS ({REGISTRY_SQL})
    SELECT dataset_id, 'schema_contract_ref' AS column_name FROM r WHERE schema_contract_ref IS NULL
    UNION ALL SELECT dataset_id, 'cadence' FROM r WHERE cadence IS NULL
    """,
)
def null_violations(spark, sf_dir):
    """Required columns that stay empty after the defaults are filled in."""
    filled = C.apply_defaults(registry(spark, sf_dir), C.REGISTRY_DEFAULTS)
    required = [c for c in C.REGISTRY_REQUIRED if c in filled.columns]
    return C.null_violations(filled, required, ["dataset_id"])


@query(
    "unique_violations",
    f"SELECT domain, entity, count(*) AS occurrences FROM ({REGISTRY_SQL}) GROUP BY ALL HAVING count(*) > 1",
)
def unique_violations(spark, sf_dir):
    return C.unique_violations(registry(spark, sf_dir), ["domain", "entity"])


@query(
    "key_violations",
    "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def key_violations(spark, sf_dir):
    lines = select(spark, sf_dir, "lineitem", {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"})
    return C.unique_violations(lines, ["l_orderkey", "l_linenumber"])


@query(
    "fk_orphans",
    f"""
    SELECT h.dataset_id, count(*) AS rows FROM ({HISTORY_SQL}) h
    WHERE NOT EXISTS (SELECT 1 FROM ({REGISTRY_SQL}) r WHERE r.dataset_id = h.dataset_id AND coalesce(r.active, TRUE))
    GROUP BY 1
    """,
)
def fk_orphans(spark, sf_dir):
    """History rows whose dataset has no active registry row."""
    active = registry(spark, sf_dir).where(F.coalesce("active", F.lit(True)))
    return C.orphans(history(spark, sf_dir), "dataset_id", active, "dataset_id")


@query(
    "fk_orphans_lines",
    """
    SELECT l_orderkey, count(*) AS rows FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1
    """,
)
def fk_orphans_lines(spark, sf_dir):
    lines = select(spark, sf_dir, "lineitem", {"l_orderkey": "l_orderkey"})
    parents = select(spark, sf_dir, "orders", {"o_orderkey": "o_orderkey"}, "o_orderstatus <> 'P'")
    return C.orphans(lines, "l_orderkey", parents, "o_orderkey")


@query(
    "names_and_slugs",
    """
    WITH n AS (SELECT p_partkey, concat(p_name, '.', p_type) AS sheet, replace(replace(lower(concat(p_name, '.', p_type)), ' ', '_'), '.', '_') AS base FROM part)
    SELECT p_partkey, CASE WHEN k > 1 THEN concat(base, '_', CAST(k AS STRING)) ELSE base END AS output_name
    FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY p_partkey) AS k FROM n)
    """,
)
def names_and_slugs(spark, sf_dir):
    """Output names of sheets, made unique; a name may repeat without bound."""
    from ...operators.ordered import occurrence_number

    parts = select(spark, sf_dir, "part", {"p_partkey": "p_partkey", "sheet": "concat(p_name, '.', p_type)"})
    named = occurrence_number(parts.withColumn("base", X.slug(F.col("sheet"))), ["base"], "p_partkey", "k")
    suffixed = F.concat_ws("_", "base", F.col("k").cast("string"))
    return named.select("p_partkey", F.when(F.col("k") > 1, suffixed).otherwise(F.col("base")).alias("output_name"))
