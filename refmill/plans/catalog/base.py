"""Registry of named queries and the inputs they derive from the driver's tables.

Every query reads whole tables. Where an operator needs an input of its own shape
(cells, files, a registry), Spark derives it from the tables row by row, so the work
grows with the data. Input expressions are plain SQL that Spark and the oracle share;
the oracle's logic is written independently.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...session import spread, stage

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    oracle: str | None


REGISTERED: dict[str, Query] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in REGISTERED:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTERED[name] = Query(name, run, oracle)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def select(
    spark: SparkSession,
    sf_dir: str,
    source: str,
    columns: dict[str, str],
    where: str | None = None,
    wide_work: bool = False,
) -> DataFrame:
    """Projection of a table. ``wide_work`` spreads a small file before costly expressions."""
    df = table(spark, sf_dir, source)
    if wide_work:
        used = [c for c in df.columns if any(c in e for e in [*columns.values(), where or ""])]
        df = spread(df.select(*used))
    df = df.where(where) if where else df
    return df.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def select_sql(source: str, columns: dict[str, str], where: str | None = None) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT {cols} FROM {source}" + (f" WHERE {where}" if where else "")


@dataclass(frozen=True)
class Cell:
    """One cell that every source row contributes: column, row, text, condition."""

    c: str
    r: str
    value: str
    kind: str = "string"
    when: str = "TRUE"


@dataclass(frozen=True)
class Grid:
    """A table laid out as spreadsheet cells, one scan for all cells of a row."""

    source: str
    workbook: str
    sheet: str
    cells: Sequence[Cell]

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        entries = F.array(
            *[
                F.struct(
                    F.expr(f"CAST({x.r} AS INT)").alias("r"),
                    F.expr(f"CAST({x.c} AS INT)").alias("c"),
                    F.expr(f"CASE WHEN {x.when} THEN {x.value} END").alias("value"),
                    F.lit(x.kind).alias("kind"),
                )
                for x in self.cells
            ]
        )
        texts = [self.workbook, self.sheet, *[t for x in self.cells for t in (x.r, x.c, x.value, x.when)]]
        df = table(spark, sf_dir, self.source)
        df = spread(df.select(*[c for c in df.columns if any(c in t for t in texts)]))
        cells = df.select(F.expr(self.workbook).alias("workbook"), F.expr(self.sheet).alias("sheet"), F.inline(entries))
        return cells.where("value IS NOT NULL")

    def staged(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        """The cells as the stored table they are for operators that read them more than once."""
        return stage(self.spark(spark, sf_dir))

    def sql(self) -> str:
        parts = [
            f"SELECT {self.workbook} AS workbook, {self.sheet} AS sheet, CAST({x.r} AS INT) AS r, "
            f"CAST({x.c} AS INT) AS c, {x.value} AS value, '{x.kind}' AS kind "
            f"FROM {self.source} WHERE ({x.when}) AND ({x.value}) IS NOT NULL"
            for x in self.cells
        ]
        return " UNION ALL ".join(parts)


def chunk(key: str, size: int) -> str:
    """Number of the block of ``size`` consecutive keys; same text for both engines."""
    return f"CAST(floor({key} / {size}) AS BIGINT)"


def chunk_name(prefix: str, key: str, size: int) -> str:
    return f"concat('{prefix}', CAST({chunk(key, size)} AS STRING))"
