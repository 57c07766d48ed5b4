"""The three gates before publishing: schema contract, personal data, data quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .personal import ADDRESS_DETECTORS, Detector

# --- fixed values: reject reasons
SCHEMA_MISMATCH = "SCHEMA_MISMATCH"
PII_DETECTED = "PII_DETECTED"
DQ_FAILED = "DQ_FAILED"
EXTRACT_FAILED = "EXTRACT_FAILED"

# --- fixed values: personal-data patterns with their scores; findings from the threshold on block a load
PII_THRESHOLD = 0.7
PII_PATTERNS = {
    "EMAIL": (1.0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "UK_NINO": (0.9, r"\b[A-Z]{2} ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[A-D]\b"),
    "PHONE": (0.75, r"(\+[0-9]{1,3}[ -]?\(?[0-9]{2,4}\)?|\(?\b0[0-9]{2,4}\)?)[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}\b"),
    "UK_POSTCODE": (0.5, r"\b[A-Z]{1,2}[0-9][A-Z0-9]? [0-9][A-Z]{2}\b"),
}

# A character every match holds; texts without it skip the pattern.
PII_HINTS = {"EMAIL": "@"}

CONTRACT_DDL = "dataset_id string, version int, ordinal int, name string, type string, nullable boolean"
RULES_DDL = "rule_id string, kind string, column string, min double, max double, values array<string>"


@dataclass(frozen=True)
class ContractColumn:
    ordinal: int
    name: str
    type: str
    nullable: bool = True


# --------------------------------------------------------------------------- contract
def name_violations(
    spark: SparkSession, columns: Sequence[str], contract: Sequence[ContractColumn], ordered: bool = True
) -> DataFrame:
    """Missing, extra, renamed and reordered columns, from the raw names alone.

    Two lists the size of a schema; no data is read. JSON fields arrive sorted by
    name, so ``ordered`` must be off for them.
    """
    actual = _rows(spark, [(i + 1, n) for i, n in enumerate(columns)], "ordinal int, name string")
    expected = _rows(spark, [(c.ordinal, c.name) for c in contract], "ordinal int, name string")
    return compare_names(actual, expected, ordered)


def compare_names(actual: DataFrame, expected: DataFrame, ordered: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys…, violation, expected, actual)`` for schemas given as rows."""
    keys = list(keys)
    both = expected.select(*keys, "name", F.col("ordinal").alias("want")).join(
        actual.select(*keys, "name", F.col("ordinal").alias("have")), [*keys, "name"], "full_outer"
    )
    lost = both.where(F.col("have").isNull()).select(*keys, F.col("want").alias("at"), F.col("name").alias("expected"))
    new = both.where(F.col("want").isNull()).select(*keys, F.col("have").alias("at"), F.col("name").alias("actual"))
    pairs = lost.join(new, [*keys, "at"], "full_outer")
    kind = (
        F.when(F.col("expected").isNull(), "EXTRA").when(F.col("actual").isNull(), "MISSING").otherwise("RENAMED")
    )
    if not ordered:
        # Without an order a lost and a new column cannot be paired.
        pairs = lost.withColumn("actual", F.lit(None).cast("string")).unionByName(
            new.withColumn("expected", F.lit(None).cast("string"))
        )
    found = pairs.select(*keys, kind.alias("violation"), "expected", "actual")
    if ordered:
        moved = both.where(F.col("have") != F.col("want")).select(
            *keys,
            F.lit("REORDERED").alias("violation"),
            F.format_string("%s at %d", "name", "want").alias("expected"),
            F.format_string("%s at %d", "name", "have").alias("actual"),
        )
        found = found.unionByName(moved)
    return found


def drift_metrics(contract: Sequence[ContractColumn], columns: Sequence[str]) -> dict[str, Column]:
    """Aggregates that count failed casts and forbidden nulls; they can ride on a write."""
    out: dict[str, Column] = {}
    for c in contract:
        if c.name in columns:
            raw = F.col(f"`{c.name}`")
            out[f"drift_{c.ordinal}"] = F.count_if(raw.isNotNull() & raw.try_cast(c.type).isNull())
            out[f"null_{c.ordinal}"] = F.count_if(raw.isNull()) if not c.nullable else F.lit(0)
    return out


def drift_violations(df: DataFrame, contract: Sequence[ContractColumn]) -> DataFrame:
    """Columns whose content does not fit the contract: ``(violation, expected, actual, rows)``.

    One aggregate over all columns; casts are tried, never forced.
    """
    metrics = drift_metrics(contract, df.columns)
    checks = []
    for c in contract:
        if f"drift_{c.ordinal}" not in metrics:
            continue
        for kind, key in (("TYPE_DRIFT", "drift"), ("NULL_FOUND", "null")):
            if key == "null" and c.nullable:
                continue
            checks.append(
                F.struct(
                    F.lit(kind).alias("violation"),
                    F.lit(f"{c.name} {c.type}").alias("expected"),
                    F.lit(c.name).alias("actual"),
                    metrics[f"{key}_{c.ordinal}"].cast("bigint").alias("rows"),
                )
            )
    return df.agg(F.array(*checks).alias("v")).select(F.inline("v")).where(F.col("rows") > 0)


def to_contract(df: DataFrame, contract: Sequence[ContractColumn]) -> DataFrame:
    """Project raw columns to the contract's names, order and types."""
    ordered = sorted(contract, key=lambda c: c.ordinal)
    return df.select(*[F.col(f"`{c.name}`").try_cast(c.type).alias(c.name) for c in ordered])


def contract_changes(before: DataFrame, now: DataFrame, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Datasets whose contract differs from the one last published, with the differences counted."""
    cols = [*keys, "ordinal", "name", "type", "nullable"]
    sided = before.select(*cols, F.lit(1).alias("side")).unionByName(now.select(*cols, F.lit(2).alias("side")))
    per_row = sided.groupBy(*cols).agg(F.sum("side").alias("sides"))
    return (
        per_row.groupBy(*keys)
        .agg(F.count_if(F.col("sides") == 1).alias("removed"), F.count_if(F.col("sides") == 2).alias("added"))
        .withColumn("schema_changed", (F.col("removed") + F.col("added")) > 0)
    )


# --------------------------------------------------------------------------- personal data
def pii_scan(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    extra: Mapping[str, tuple[float, Detector]] | None = None,
) -> DataFrame:
    """``(column_name, entity, score, hits)`` — cells with a match, per text column.

    Reads whole texts of all rows, for the patterns and for postal addresses.
    ``extra`` adds detectors such as that of a name model (``personal.fit_names``): entity → (score, text → boolean).
    The only shuffle carries one row per column and task.
    """
    columns = list(columns or [n for n, t in df.dtypes if t == "string"])
    texts = df.select(*[F.col(f"`{c}`") for c in columns])
    detectors = pii_detectors(extra)
    hits = {name: detect(F.col("text")) for name, (_, detect) in detectors.items()}
    if len(columns) == 1:
        long = texts.select(F.lit(columns[0]).alias("column_name"), F.col(f"`{columns[0]}`").alias("text"))
    else:
        long = texts.unpivot([], [F.col(f"`{c}`") for c in columns], "column_name", "text")
    counted = long.groupBy("column_name").agg(*[F.count_if(hit).alias(n) for n, hit in hits.items()])
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("entity"), F.lit(float(score)).alias("score"), F.col(n).alias("hits"))
            for n, (score, _) in detectors.items()
        ]
    )
    return counted.select("column_name", F.inline(rows)).where(F.col("hits") > 0)


def pii_detectors(extra: Mapping[str, tuple[float, Detector]] | None = None) -> dict[str, tuple[float, Detector]]:
    """All detectors by entity: patterns, addresses, the caller's.

    entity → (score, text → boolean)
    """

    def by_pattern(name: str, pattern: str) -> Detector:
        hint = PII_HINTS.get(name)
        return lambda text: text.contains(hint) & text.rlike(pattern) if hint else text.rlike(pattern)

    found: dict[str, tuple[float, Detector]] = {n: (score, by_pattern(n, pattern)) for n, (score, pattern) in PII_PATTERNS.items()}
    return {**found, **ADDRESS_DETECTORS, **(extra or {})}


def blocking(findings: DataFrame, threshold: float = PII_THRESHOLD) -> DataFrame:
    return findings.where(F.col("score") >= threshold)


# --------------------------------------------------------------------------- data quality
def dq_results(df: DataFrame, rules: Sequence[Mapping[str, Any]]) -> DataFrame:
    """``(rule_id, kind, column_name, observed, failed)`` for every rule.

    Kinds: ``row_count`` (bounds), ``null_ratio`` (max), ``domain`` (allowed values),
    ``range`` (bounds of values), ``unique``. All but ``unique`` share one aggregate;
    a unique rule groups on its column.
    """
    single = [r for r in rules if r["kind"] != "unique"]
    frames = []
    if single:
        checks = F.array(*[_dq_check(r) for r in single])
        frames.append(df.agg(checks.alias("checks")).select(F.inline("checks")))
    for rule in rules:
        if rule["kind"] == "unique":
            name = rule["column"]
            repeated = unique_excess(df, name)
            frames.append(
                repeated.select(
                    F.lit(rule["rule_id"]).alias("rule_id"),
                    F.lit("unique").alias("kind"),
                    F.lit(name).alias("column_name"),
                    F.col("excess").cast("double").alias("observed"),
                    (F.col("excess") > 0).alias("failed"),
                )
            )
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def unique_excess(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(f"`{column}`").isNotNull()).groupBy(f"`{column}`").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess"))


def dq_failed(rule: Mapping[str, Any]) -> Column:
    """Whether a rule other than ``unique`` fails, as an aggregate."""
    return _dq_check(rule)["failed"]


def _dq_check(rule: Mapping[str, Any]) -> Column:
    kind, name, low, high = rule["kind"], rule.get("column"), rule.get("min"), rule.get("max")
    col = F.col(f"`{name}`") if name else None
    if kind == "row_count":
        seen = F.count(F.lit(1)).cast("double")
    elif kind == "null_ratio":
        seen = F.coalesce(F.try_divide(F.count_if(col.isNull()).cast("double"), F.count(F.lit(1)).cast("double")), F.lit(0.0))
    elif kind == "domain":
        seen = F.count_if(~col.isin(*rule["values"])).cast("double")
        low, high = None, 0.0
    elif kind == "range":
        value = col.try_cast("double")
        outside = F.lit(False)
        if low is not None:
            outside = outside | (value < low)
        if high is not None:
            outside = outside | (value > high)
        seen = F.count_if(outside).cast("double")
        low, high = None, 0.0
    else:
        raise ValueError(f"unknown rule kind {kind!r}")
    failed = F.lit(False)
    if low is not None:
        failed = failed | (seen < float(low))
    if high is not None:
        failed = failed | (seen > float(high))
    return F.struct(
        F.lit(rule["rule_id"]).alias("rule_id"),
        F.lit(kind).alias("kind"),
        F.lit(name).cast("string").alias("column_name"),
        seen.alias("observed"),
        failed.alias("failed"),
    )


def _rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(list(rows), ddl)
