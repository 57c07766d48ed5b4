"""Table constraints as violation queries: domain, not-null, unique, foreign key, config lint."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.config import ON_ERROR, TABLE_TYPES, TYPE_INFERENCE

# --- fixed values: CHECK constraints of the registry and the load history
REGISTRY_DOMAINS = {
    "source_type": ("api", "sharepoint", "mailbox", "manual"),
    "source_format": ("excel", "csv", "json"),
    "snapshot_policy": ("history_partition", "dated_table"),
    "cadence": ("quarterly", "yearly", "adhoc"),
}
HISTORY_DOMAINS = {"status": ("SUCCESS", "REJECTED", "ERROR")}

# --- fixed values: NOT NULL columns and DEFAULT values of the registry
REGISTRY_REQUIRED = (
    "dataset_id", "domain", "entity", "source_type", "source_format", "quarantine_path",
    "schema_contract_ref", "pii_scan_enabled", "target_catalog", "target_schema",
    "snapshot_policy", "timetravel_retention_days", "owner_upn", "cadence", "active",
    "created_at_utc", "updated_at_utc",
)
REGISTRY_DEFAULTS = {
    "pii_scan_enabled": True,
    "target_catalog": "prod_catalog",
    "target_schema": "reference_data",
    "snapshot_policy": "history_partition",
    "timetravel_retention_days": 90,
    "active": True,
}


def domain_violations(df: DataFrame, domains: Mapping[str, Sequence[str]], keys: Sequence[str]) -> DataFrame:
    """``(keys…, column_name, value)`` of values outside their list, in one pass. Null passes."""
    checks = [
        F.when(
            ~F.col(c).isin(*allowed),
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")),
        )
        for c, allowed in domains.items()
    ]
    return df.select(*keys, F.inline(F.array_compact(F.array(*checks))))


def null_violations(df: DataFrame, required: Sequence[str], keys: Sequence[str]) -> DataFrame:
    checks = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    return df.select(*keys, F.explode(F.array_compact(F.array(*checks))).alias("column_name"))


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Partial counts shrink a hot key before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row count.

    Child rows are counted per key first, so the join sees each key once however
    often it occurs.
    """
    counted = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def missing_names(wanted: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Requested or configured names that are not there."""
    return wanted.join(present.select(*keys), list(keys), "left_anti")


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def _empty(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) < 1


def lint_configs(configs: DataFrame, keys: Sequence[str], config: str = "config") -> DataFrame:
    """Every rule a config breaks, as ``(keys…, loc, rule)``.

    All rules are evaluated inside the config's own row; the table of configs is read
    once and nothing is shuffled.
    """
    cfg = F.col(config)

    def issue(broken: Column, loc: Column, rule: str) -> Column:
        return F.when(F.coalesce(broken, F.lit(False)), F.struct(loc.alias("loc"), F.lit(rule).alias("rule")))

    def at(base: Column, name: str, i: Column) -> Column:
        return F.concat(base, F.lit(f".{name}["), i.cast("string"), F.lit("]"))

    def each(arr: Column, fn) -> Column:
        none = F.array().cast("array<struct<loc:string,rule:string>>")
        return F.coalesce(F.flatten(F.transform(arr, fn)), none)

    def section_issues(loc: Column):
        def check(s: Column, j: Column) -> Column:
            here = at(loc, "sections", j)
            start, end = X.column_index(s["start_col"]), X.column_index(s["end_col"])
            given = ~_blank(s["start_col"]) & ~_blank(s["end_col"])
            return F.array_compact(
                F.array(
                    issue(_blank(s["name"]), here, "section without name"),
                    issue(~given, here, "section without start_col or end_col"),
                    issue(given & (start.isNull() | end.isNull()), here, "section with an invalid column"),
                    issue(start > end, here, "section start right of end"),
                )
            )

        return check

    def table_issues(loc: Column):
        def check(t: Column, j: Column) -> Column:
            no_header = t["header_row"].isNull() & _empty(t["header_rows"])
            return F.array_compact(
                F.array(issue(no_header | t["data_start_row"].isNull(), at(loc, "tables", j), "table without header row or data_start_row"))
            )

        return check

    def column_issues(loc: Column):
        def check(c: Column, j: Column) -> Column:
            return F.array_compact(
                F.array(issue(_blank(c["col"]) | _blank(c["name"]), at(loc, "columns", j), "column entry without col or name"))
            )

        return check

    names = F.transform(cfg["sheets"], lambda s: F.coalesce(s["output_name"], F.lit("")))

    def sheet_issues(s: Column, i: Column) -> Column:
        loc = F.concat(F.lit("sheets["), i.cast("string"), F.lit("]"))
        one_block = s["table_type"].isin("simple", "side_by_side")
        ids = F.coalesce(s["unpivot_id_cols"], F.array().cast("array<string>"))
        static_names = F.map_keys(s["static_columns"])
        own = F.array_compact(
            F.array(
                issue(_blank(s["sheet_name"]), loc, "missing sheet_name"),
                issue(_blank(s["output_name"]), loc, "missing output_name"),
                issue(~F.coalesce(s["table_type"], F.lit("")).isin(*TABLE_TYPES), loc, "invalid table_type"),
                issue(
                    ~_blank(s["output_name"]) & (F.array_position(names, s["output_name"]) < i + 1),
                    loc,
                    "duplicate output_name",
                ),
                issue(one_block & s["header_row"].isNull() & s["header_rows"].isNull(), loc, "missing header row"),
                issue(one_block & (F.size(s["header_rows"]) == 0), loc, "empty header_rows"),
                issue(one_block & s["data_start_row"].isNull(), loc, "missing data_start_row"),
                issue((s["table_type"] == "side_by_side") & _empty(s["sections"]), loc, "side_by_side without sections"),
                issue((s["table_type"] == "stacked") & _empty(s["tables"]), loc, "stacked without tables"),
                issue(
                    s["unpivot"] & (F.size(F.array_except(static_names, ids)) > 0),
                    loc,
                    "warning: static columns melt into values",
                ),
            )
        )
        side, stack = s["table_type"] == "side_by_side", s["table_type"] == "stacked"
        return F.concat(
            own,
            each(F.when(side, s["sections"]), section_issues(loc)),
            each(F.when(stack, s["tables"]), table_issues(loc)),
            each(s["columns"], column_issues(loc)),
        )

    top = F.lit("config")
    settings = F.lit("settings")
    own = F.array_compact(
        F.array(
            issue(cfg.isNull(), top, "not a JSON object"),
            issue(_blank(cfg["config_name"]), top, "missing config_name"),
            issue(_empty(cfg["sheets"]), top, "no sheets"),
            issue(~cfg["settings"]["type_inference"].isin(*TYPE_INFERENCE), settings, "invalid type_inference"),
            issue(~cfg["settings"]["on_error"].isin(*ON_ERROR), settings, "invalid on_error"),
        )
    )
    return configs.select(*keys, F.inline(F.concat(own, each(cfg["sheets"], sheet_issues))))
