"""Column clean-up, renames, constants, and wide → long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import squeeze_name

_NUMERIC = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DoubleType, T.FloatType, T.DecimalType)


def columns_to_drop(columns: Sequence[str], patterns: Sequence[str]) -> list[str]:
    """Exact names, else names that contain the pattern without its star."""
    gone: list[str] = []
    for pattern in patterns:
        left = [c for c in columns if c not in gone]
        if pattern in left:
            gone.append(pattern)
        elif "*" in pattern:
            stem = pattern.replace("*", "")
            gone += [c for c in left if stem in c]
    return gone


def drop_columns(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    return df.drop(*columns_to_drop(df.columns, patterns))


def rename_map(columns: Sequence[str], renames: Mapping[str, str]) -> dict[str, str]:
    """Old → new for the columns at hand; white space may differ on either side."""
    loose = {squeeze_name(old): new for old, new in renames.items()}
    found = {c: renames.get(c, loose.get(squeeze_name(c))) for c in columns}
    return {old: new for old, new in found.items() if new is not None}


def rename_columns(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(rename_map(df.columns, renames))


def add_constants(df: DataFrame, constants: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in constants.items()}) if constants else df


def keep_payload(df: DataFrame, index_columns: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value outside the index columns; every row when no index is named."""
    names = list(columns or df.columns)
    payload = [c for c in names if c not in set(index_columns)]
    if not index_columns:
        return df
    if not payload:
        return df.where(F.lit(False))
    return df.where(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in payload]).isNotNull())


def unpivot(
    df: DataFrame,
    ids: Sequence[str],
    exclude: Sequence[str] = (),
    var_name: str = "Variable",
    value_name: str = "Value",
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Every column that is not an id becomes rows; null values are dropped.

    A narrow step. Spark columns have one type, so mixed value columns are first
    brought to BIGINT (all whole), DOUBLE (all numeric) or STRING.
    """
    ids = [c for c in ids if c in df.columns]
    keep = ids + [c for c in df.columns if c in set(exclude) and c not in ids]
    value_cols = [c for c in (values or df.columns) if c not in keep]
    if not value_cols:
        return df
    types = [df.schema[c].dataType for c in value_cols]
    if len(set(types)) > 1:
        whole = all(isinstance(t, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)) for t in types)
        numeric = all(isinstance(t, _NUMERIC) for t in types)
        common = "bigint" if whole else "double" if numeric else "string"
        df = df.withColumns({c: F.col(f"`{c}`").cast(common) for c in value_cols})

    def ref(c: str):
        return F.col(f"`{c}`")

    long = df.unpivot([ref(c) for c in keep], [ref(c) for c in value_cols], var_name, value_name)
    return long.where(F.col(f"`{value_name}`").isNotNull())


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames by column name; missing columns become null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
