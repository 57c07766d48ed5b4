"""Column typing from text and native cells, as one aggregate and one projection.

A column on its way to a type is a struct ``{value, kind}``; ``kind`` says what the
cell held (string, number, bool, date). The profile of all columns comes from a
single aggregate; its result has one row per column and decides the projection.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

# --- fixed values: overrides a config may name per column
OVERRIDES = ("string", "int", "float", "number", "keep")

# --- fixed values: what a filled cell can be, as far as typing is concerned
CLASSES = {
    "text": 0, "whole_text": 1, "fraction_text": 2, "big_text": 3,
    "whole_number": 4, "fraction_number": 5, "flag": 6, "date": 7,
}


def cell_class(value: Column, kind: Column, number: Column) -> Column:
    """Class code of a cell; ``number`` is its number text where it has one. Null when empty."""
    whole = X.number_bigint(number).isNotNull()
    big = X.is_whole_text(number) & number.try_cast("bigint").isNull()
    return (
        F.when(value.isNull(), None)
        .when(
            kind == "string",
            F.when(number.isNull(), CLASSES["text"])
            .when(big, CLASSES["big_text"])
            .when(whole, CLASSES["whole_text"])
            .otherwise(CLASSES["fraction_text"]),
        )
        .when(kind == "number", F.when(whole, CLASSES["whole_number"]).otherwise(CLASSES["fraction_number"]))
        .when(kind == "bool", CLASSES["flag"])
        .otherwise(CLASSES["date"])
    )


def class_counts() -> dict[str, Column]:
    """The counts that :func:`decide_type` needs, from rows ``(class, n)`` of one column."""

    def of(*names: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("class").isin([CLASSES[n] for n in names]), F.col("n"))), F.lit(0))

    return {
        "filled": F.coalesce(F.sum(F.when(F.col("class").isNotNull(), F.col("n"))), F.lit(0)),
        "texts": of("text", "whole_text", "fraction_text", "big_text"),
        "parsed": of("whole_text", "fraction_text", "big_text"),
        "parsed_whole": of("whole_text"),
        "parsed_big": of("big_text"),
        "numbers": of("whole_number", "fraction_number"),
        "numbers_whole": of("whole_number"),
        "bools": of("flag"),
        "dates": of("date"),
    }


COUNTS = (
    "filled", "texts", "parsed", "parsed_whole", "parsed_big", "numbers", "numbers_whole", "bools", "dates",
)


def decide_type(mode: Column, override: Column, count: Mapping[str, Column] | None = None) -> Column:
    """Result type of a column, from its counts: a plain expression over one row per column.

    ``safe`` converts only when every text parses; ``aggressive`` (and the int,
    number and float overrides) parses what it can, and since a Spark column has one
    type, a column that keeps some text stays STRING.
    """
    n = count or {name: F.col(name) for name in COUNTS}
    native = (
        F.when(n["filled"] == 0, "string")
        .when(n["bools"] == n["filled"], "boolean")
        .when(n["dates"] == n["filled"], "timestamp")
        .when((n["numbers"] == n["filled"]) & (n["numbers_whole"] == n["filled"]), "bigint")
        .when(n["numbers"] == n["filled"], "double")
        .otherwise("string")
    )
    all_numeric = (n["parsed"] == n["texts"]) & (n["dates"] == 0)
    all_whole = (n["parsed_whole"] == n["texts"]) & (n["numbers_whole"] == n["numbers"])
    numeric = (
        F.when((n["filled"] == 0) | ((n["texts"] == 0) & (n["dates"] > 0)), native)
        .when(~all_numeric | (n["parsed_big"] > 0), "string")
        .when(all_whole, "bigint")
        .otherwise("double")
    )
    safe = F.when(n["texts"] == 0, native).otherwise(numeric)
    as_float = F.when((numeric == "string") & ~all_numeric, "string").when(n["filled"] == 0, "string").when(
        numeric == "timestamp", native
    ).otherwise("double")
    return (
        F.when(override == "string", "string")
        .when(override == "keep", native)
        .when(override == "float", as_float)
        .when(override.isin("int", "number"), numeric)
        .when(mode == "none", native)
        .when(mode == "safe", safe)
        .otherwise(numeric)
    )


def plain_number(value: Column, kind: Column, thousands: str = ",", decimal: str = ".") -> Column:
    """Number text of a cell of any kind: texts are parsed, flags count as 1 and 0."""
    flag = F.when(F.lower(value) == "true", "1").otherwise("0")
    text = X.number_text(value, thousands, decimal)
    return F.when(kind == "string", text).when(kind == "bool", flag).when(kind == "number", value)


def typed_value(
    value: Column, kind: Column, number: Column, target: str, parse: bool = False, as_float: bool = False
) -> Column:
    """Project one column to its decided type; ``number`` is its :func:`plain_number`."""
    if target == "bigint":
        return X.number_bigint(number)
    if target == "double":
        return X.number_double(number)
    if target in ("boolean", "timestamp"):
        return value.try_cast(target)
    if not parse:
        return value
    # Aggressive parsing that left text behind: numbers in canonical spelling, as text.
    whole = X.is_whole_text(number)
    as_double = number.try_cast("double").cast("string")
    canonical = as_double if as_float else F.when(whole, number.try_cast("bigint").cast("string")).otherwise(as_double)
    return F.when(kind == "string", F.coalesce(canonical, value)).otherwise(value)


def type_plan(
    wide: DataFrame,
    columns: Sequence[str],
    mode: str,
    overrides: Mapping[str, str],
    thousands: str = ",",
    decimal: str = ".",
) -> DataFrame:
    """One row per column: ``name``, its counts, and the decided ``type``.

    Each cell is parsed once and reduced to a class code; the codes are counted per
    column before the shuffle, which carries at most nine rows per column and task.
    """

    cells = wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("at"),
                        F.col(f"`{c}`.value").alias("value"),
                        F.col(f"`{c}`.kind").alias("kind"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    return cell_plan(cells, list(enumerate(columns)), mode, overrides, thousands, decimal)


def cell_plan(
    cells: DataFrame,
    columns: Sequence[tuple[int, str]],
    mode: str,
    overrides: Mapping[str, str],
    thousands: str = ",",
    decimal: str = ".",
) -> DataFrame:
    """The plan of the ``(at, name)`` columns from their cells in long form, ``at, value, kind``."""
    value, kind = F.col("value"), F.col("kind")
    parsed = cells.select("at", "value", "kind", plain_number(value, kind, thousands, decimal).alias("number"))
    coded = parsed.select("at", cell_class(value, kind, F.col("number")).alias("class"))
    per_class = coded.groupBy("at", "class").agg(F.count(F.lit(1)).alias("n"))
    counted = per_class.groupBy("at").agg(*[e.alias(k) for k, e in class_counts().items()])
    # Columns of a table without rows still get a type.
    listed = cells.sparkSession.createDataFrame(
        [(i, c, overrides.get(c)) for i, c in columns], "at int, name string, override string"
    )
    full = listed.join(counted, "at", "left").fillna(0, list(COUNTS))
    return full.withColumn("type", decide_type(F.lit(mode), F.col("override"))).drop("at")


def parses(name: str, mode: str, overrides: Mapping[str, str]) -> bool:
    """Whether texts of a column are read as numbers where they can be."""
    rule = overrides.get(name)
    return rule in ("int", "float", "number") or (mode == "aggressive" and rule not in ("string", "keep"))


# How a cell of an array becomes a column: the field of the typed cell, by code.
_FIELDS = {"bigint": (1, "whole"), "double": (2, "fraction"), "boolean": (3, "flag"), "timestamp": (4, "time"), "string": (0, "text")}
_CANONICAL, _CANONICAL_FLOAT = 5, 6


def apply_cell_types(
    rows: DataFrame,
    picked: Sequence[tuple[int, str]],
    plan: Mapping[str, str],
    mode: str,
    overrides: Mapping[str, str],
    thousands: str = ",",
    decimal: str = ".",
) -> DataFrame:
    """Array column ``cells`` → one typed column per picked ``(at, name)``, other columns kept.

    Cells are typed inside the array, by a code per position, so the plan holds one
    short expression per column, whatever the number of columns.
    """
    codes: dict[int, int] = {}
    for at, name in picked:
        code = _FIELDS[plan[name]][0]
        if code == 0 and parses(name, mode, overrides):
            code = _CANONICAL_FLOAT if overrides.get(name) == "float" else _CANONICAL
        codes[at] = code
    listed = [codes.get(i, -1) for i in range(max(codes, default=-1) + 1)]
    by_place = F.from_json(F.lit(json.dumps(listed)), "array<int>")

    def with_number(x: Column) -> Column:
        number = plain_number(x["value"], x["kind"], thousands, decimal)
        return F.struct(x["value"].alias("value"), x["kind"].alias("kind"), number.alias("number"))

    def typed(x: Column, i: Column) -> Column:
        code = F.get(by_place, i)
        value, kind, number = x["value"], x["kind"], x["number"]

        def text(as_float: bool) -> Column:
            return typed_value(value, kind, number, "string", True, as_float)

        return F.struct(
            F.when(code == 1, typed_value(value, kind, number, "bigint")).alias("whole"),
            F.when(code == 2, typed_value(value, kind, number, "double")).alias("fraction"),
            F.when(code == 3, typed_value(value, kind, number, "boolean")).alias("flag"),
            F.when(code == 4, typed_value(value, kind, number, "timestamp")).alias("time"),
            F.when(code == 0, value).when(code == _CANONICAL, text(False)).when(code == _CANONICAL_FLOAT, text(True)).alias("text"),
        )

    numbered = F.transform("cells", lambda x: F.when(x.isNotNull(), with_number(x)))
    done = rows.withColumn("cells", F.transform(numbered, lambda x, i: F.when(x.isNotNull(), typed(x, i))))
    keep = [f"`{c}`" for c in rows.columns if c != "cells"]
    return done.selectExpr(*keep, *[f"get(cells, {at}).{_FIELDS[plan[n]][1]} AS {quoted(n)}" for at, n in picked])


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def apply_types(
    wide: DataFrame,
    plan: Mapping[str, str],
    mode: str,
    overrides: Mapping[str, str],
    thousands: str = ",",
    decimal: str = ".",
) -> DataFrame:
    """Struct columns → typed columns, by the collected plan ``name → type``.

    The number text of a cell is projected first, so that it is worked out once.
    """

    needs = {n: i for i, n in enumerate(plan) if plan[n] in ("bigint", "double") or (plan[n] == "string" and parses(n, mode, overrides))}
    parsed = wide.select(
        "*",
        *[
            plain_number(F.col(f"`{n}`.value"), F.col(f"`{n}`.kind"), thousands, decimal).alias(f"_number_{i}")
            for n, i in needs.items()
        ],
    )

    def project(name: str) -> Column:
        if name not in plan:
            return F.col(f"`{name}`")
        value, kind = F.col(f"`{name}`.value"), F.col(f"`{name}`.kind")
        number = F.col(f"_number_{needs[name]}") if name in needs else F.lit(None)
        return typed_value(value, kind, number, plan[name], parses(name, mode, overrides), overrides.get(name) == "float").alias(name)

    return parsed.select(*[project(c) for c in wide.columns])


def table_profile(df: DataFrame, table: str | None = None) -> DataFrame:
    """``(column_name, data_type, rows, nulls)`` from one aggregate over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    (F.count(F.lit(1)) - F.count(F.col(f"`{f.name}`"))).alias("nulls"),
                )
                for f in df.schema.fields
            ]
        ).alias("cols"),
    )
    lead = [F.lit(table).alias("table_name")] if table else []
    flat = counts.select("rows", F.inline("cols"))
    return flat.select(*lead, "column_name", "data_type", "rows", "nulls")


def all_null_columns(profile: DataFrame) -> DataFrame:
    return profile.where(F.col("rows") == F.col("nulls"))
