"""Grid → table: simple, side-by-side and stacked sheets.

Everything up to :func:`records` is one plan over the cells of all workbooks. A
table's column names and types depend on the data, so :func:`extract_table` asks for
them with two small actions (distinct headers, one profile row per column).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import stage
from ..sources.config import UNPIVOT_MODES, Settings
from . import layout as L
from . import reshape as R
from . import typing as TY

ROW_KEY = ["workbook", "sheet", "block", "r"]
CELLS_PER_TASK = 1_500_000  # of those that one task puts together to rows
CELLS_PER_FILE = 500_000
CELL_TYPE = "struct<value: string, kind: string>"


@dataclass(frozen=True)
class Table:
    """One extracted table, and what was learnt on the way."""

    frame: DataFrame
    columns: tuple[str, ...]
    types: Mapping[str, str]
    empty_blocks: DataFrame


def records(
    cells: DataFrame,
    sheet: Mapping[str, Any],
    settings: Settings,
    end_from_first_block: bool = False,
) -> DataFrame:
    """``(workbook, sheet, block, r, c, header, value, kind)`` for cells that carry data.

    ``cells`` holds this config's sheets with merged ranges filled. The labels are
    joined by column, the ends by block; they are few next to the cells and staged, so the
    planner knows their size and broadcasts them when it allows, else splits a hot workbook.
    """
    blocks = L.blocks_of(sheet)
    given = all(b.data_end is not None for b in blocks) and not end_from_first_block
    ends = None if given else stage(L.table_ends(cells, blocks, settings, end_from_first_block))
    if blocks[0].columns:
        labels = L.explicit_labels(cells, blocks[0])
        in_span = with_any_column(cells, blocks[0])
        if given:
            in_span = in_span.where(F.col("r") <= min(blocks[0].data_end, settings.max_scan_rows))
        else:
            in_span = in_span.join(ends, L.BLOCK_KEY).where(F.col("r") <= F.col("end_row"))
    else:
        labels = L.header_labels(cells, blocks, settings, sheet.get("header_join") or " | ")
        if given:  # ends from the config are predicates: nothing to look for, nothing to join
            last = F.least("data_end", F.lit(settings.max_scan_rows))
            in_span = L.with_blocks(cells, blocks, F.col("r").between(F.col("data_start"), last))
        elif L.disjoint(blocks):
            in_span = L.with_blocks(cells, blocks, F.col("r") >= F.col("data_start"))
            in_span = in_span.join(ends, L.BLOCK_KEY).where(F.col("r") <= F.col("end_row"))
        else:
            bounded = cells.join(L.ends_by_sheet(ends), ["workbook", "sheet"])
            in_span = L.with_blocks(bounded, blocks, ends="ends")
    return in_span.join(stage(labels), [*L.BLOCK_KEY, "c"]).select(
        *ROW_KEY,
        "c",
        "header",
        X.clean_value(F.col("value"), F.col("kind"), settings.null_markers).alias("value"),
        "kind",
    )


def with_any_column(cells: DataFrame, block: L.Block) -> DataFrame:
    """Data cells of explicit columns, which may lie left of the block's first column."""
    columns = [c for c, _ in block.columns]
    found = cells.where(F.col("c").isin(columns) & (F.col("r") >= block.data_start))
    return found.withColumn("block", F.lit(block.number))


def wide_rows(recs: DataFrame, headers: list[str], n_cells: int) -> DataFrame:
    """One row per (workbook, sheet, block, r) with an array ``cells``: ``{value, kind}`` per header.

    ``filled`` lists the row's cells with their places. A row's cells are gathered
    once, sorted by place, and each is followed by the nulls up to the next, so the
    work is in proportion to the width; a row is at most as wide as a legal sheet.
    The headers come from the driver and go to the cells: dealing cells by header would
    make a task of each header. Tasks are as many as the ``n_cells`` cells ask for.
    """
    spark = recs.sparkSession
    places = spark.createDataFrame(list(enumerate(headers)), "at int, header string")
    placed = recs.join(F.broadcast(places), "header").select(*ROW_KEY, "at", "value", "kind")
    tasks = max(spark.sparkContext.defaultParallelism, -(-n_cells // CELLS_PER_TASK))
    entry = F.struct("at", F.struct("value", "kind").alias("cell"))
    rows = placed.repartition(tasks, *ROW_KEY).groupBy(*ROW_KEY).agg(
        F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), entry))).alias("filled")
    )
    width = F.lit(len(headers))

    def blanks(n: Column) -> Column:
        return F.array_repeat(F.lit(None).cast(CELL_TYPE), n)

    def followed(x: Column, i: Column) -> Column:
        until = F.coalesce(F.get("filled", i + 1)["at"], width)
        return F.concat(F.array(x["cell"]), blanks(until - x["at"] - 1))

    ahead = blanks(F.coalesce(F.get("filled", F.lit(0))["at"], width))
    return rows.withColumn("cells", F.concat(ahead, F.flatten(F.transform("filled", followed))))


def rightmost(recs: DataFrame) -> DataFrame:
    """Where names may repeat within a row, the right-most column wins."""
    return recs.groupBy(*ROW_KEY, "header").agg(
        F.max("c").alias("c"), F.max_by("value", "c").alias("value"), F.max_by("kind", "c").alias("kind")
    )


def header_order(recs: DataFrame, blocks: list[L.Block]) -> tuple[list[str], int, int]:
    """Distinct headers in sheet order, how many of them the first block brings, and the number of cells.

    Bounded by the width of a legal sheet, for each of the config's blocks.
    """
    found = (
        recs.groupBy("header")
        .agg(F.min(F.struct("block", "c")).alias("at"), F.count(F.lit(1)).alias("cells"))
        .orderBy("at", "header")
        .collect()
    )
    cells = sum(row["cells"] for row in found)
    listed = [name for b in blocks for _, name in b.columns]
    if listed:
        return listed, len(listed), cells
    first = sum(row["at"]["block"] == found[0]["at"]["block"] for row in found)
    return [row["header"] for row in found], first, cells


def extract_table(
    cells: DataFrame,
    sheet: Mapping[str, Any],
    settings: Settings,
    unpivot_mode: str = "as_configured",
    end_from_first_block: bool = False,
    keep_blank_rows: bool = False,
    provenance: bool = False,
) -> Table:
    """Run one sheet config over all workbooks in ``cells``.

    ``keep_blank_rows`` keeps rows without any value when no index column is named;
    by default such rows are dropped. ``provenance`` leads with workbook and row.
    """
    if unpivot_mode not in UNPIVOT_MODES:
        raise ValueError(f"unpivot_mode must be one of {UNPIVOT_MODES}, got {unpivot_mode!r}")
    blocks = L.blocks_of(sheet)
    grid = cells.where(F.col("sheet") == sheet["sheet_name"])
    found = records(grid, sheet, settings, end_from_first_block)
    recs = stage(found if settings.dedupe_headers and not blocks[0].columns else rightmost(found), CELLS_PER_FILE)
    headers, first, n_cells = header_order(recs, blocks)
    if not headers:
        return Table(recs.select(*(ROW_KEY if provenance else [])).limit(0), (), {}, _empty_blocks(recs, grid, blocks))
    index = [c for c in sheet.get("index_columns") or [] if c]

    wide = wide_rows(recs, headers, n_cells)
    if keep_blank_rows and not index and not blocks[0].columns:
        wide = _with_blank_rows(wide, grid, blocks, settings, end_from_first_block, len(headers))
    else:
        at = [i for i, h in enumerate(headers) if h in set(index)]
        wide = wide.where(F.exists("filled", lambda x: ~x["at"].isin(at)) if at else F.size("filled") > 0)
    wide = stage(wide.drop("filled"))  # read for the types, then for the table
    wide, columns = _block_columns(wide, headers, first, blocks, sheet)
    frame, columns, types = post_process(wide, columns, sheet, settings, unpivot_mode)
    lead = ["workbook", "sheet", "block", "r"] if provenance else []
    shaped = frame.selectExpr(*lead, *[TY.quoted(c) for c in columns])
    return Table(shaped, tuple(columns), types, _empty_blocks(recs, grid, blocks))


def _with_blank_rows(wide, grid, blocks, settings, end_from_first_block, width: int) -> DataFrame:
    ends = L.table_ends(grid, blocks, settings, end_from_first_block)
    start = F.element_at(F.create_map(*[F.lit(x) for b in blocks for x in (b.number, b.data_start)]), F.col("block"))
    rows = ends.where(start <= F.col("end_row")).select(
        *L.BLOCK_KEY, F.explode(F.sequence(start, F.col("end_row"))).alias("r")
    )
    blank = F.array_repeat(F.lit(None).cast(CELL_TYPE), width)
    return rows.join(wide, ROW_KEY, "left").withColumn("cells", F.coalesce("cells", blank))


def constant_cell(value: Any) -> Column:
    """A configured value as a cell of its own kind; null stays null."""
    if value is None:
        return F.lit(None).cast(CELL_TYPE)
    kind = "bool" if isinstance(value, bool) else "number" if isinstance(value, (int, float)) else "string"
    return F.struct(F.lit(str(value)).alias("value"), F.lit(kind).alias("kind"))


def _block_columns(wide, headers, first, blocks, sheet) -> tuple[DataFrame, list[tuple[int, str]]]:
    """Section name (side by side) and per-table constants (stacked), as further cells.

    They are listed behind the columns of the first block.
    """
    added: dict[str, Any] = {}
    if sheet["table_type"] == "side_by_side":
        name = sheet.get("section_column_name") or "Section"
        added[name] = {b.number: b.name for b in blocks}
    for b in blocks:
        for key, value in b.statics.items():
            if value is not None:
                added.setdefault(key, {})[b.number] = value
    more = []
    for by_block in added.values():
        found = F.lit(None).cast(CELL_TYPE)
        for number, value in by_block.items():
            found = F.when(F.col("block") == number, constant_cell(value)).otherwise(found)
        more.append(found)
    place = {h: i for i, h in enumerate(headers)} | {n: len(headers) + i for i, n in enumerate(added)}
    order = dict.fromkeys([*headers[:first], *added, *headers[first:]])
    return _with_cells(wide, more), [(place[n], n) for n in order]


def _with_cells(wide: DataFrame, more: list[Column]) -> DataFrame:
    return wide.withColumn("cells", F.concat("cells", F.array(*more))) if more else wide


def post_process(
    wide: DataFrame,
    columns: list[tuple[int, str]],
    sheet: Mapping[str, Any],
    settings: Settings,
    unpivot_mode: str = "as_configured",
) -> tuple[DataFrame, list[str], dict[str, str]]:
    """Drop → drop all-null → rename → constants → types → unpivot, in this order.

    ``columns`` are places in the array ``cells`` with their names; dropping and
    renaming change that list only. One profile of the cells serves both the all-null
    test and the type decision: the names it reports are the renamed ones, and
    constants take part in typing.
    """
    present = [n for _, n in columns]
    gone = set(R.columns_to_drop(present, sheet.get("drop_columns") or []))
    renames = R.rename_map([n for n in present if n not in gone], sheet.get("rename_columns") or {})
    kept = [(i, renames.get(n, n)) for i, n in columns if n not in gone]
    constants = dict(sheet.get("static_columns") or {})
    width = max((i for i, _ in columns), default=-1) + 1
    wide = _with_cells(wide, [constant_cell(v) for v in constants.values()])
    at = {n: i for i, n in kept} | {k: width + j for j, k in enumerate(constants)}
    picked = [(i, n) for n, i in at.items()]
    overrides = {k: v for k, v in (sheet.get("column_types") or {}).items() if v}
    mode, thousands, decimal = settings.type_inference, settings.thousands_sep, settings.decimal_sep

    cells = wide.select(F.posexplode("cells").alias("at", "cell")).where(F.col("cell").isNotNull())
    cells = cells.select("at", "cell.value", "cell.kind")
    plan = TY.cell_plan(cells, picked, mode, overrides, thousands, decimal).select("name", "filled", "type").collect()
    types = {p["name"]: p["type"] for p in plan if p["filled"] > 0 or p["name"] in constants}
    picked = [(i, n) for i, n in picked if n in types]
    names = [n for _, n in picked]
    typed = TY.apply_cell_types(wide, picked, types, mode, overrides, thousands, decimal)

    wanted = bool(sheet.get("unpivot")) if unpivot_mode == "as_configured" else unpivot_mode == "force_unpivot"
    if not wanted or not names:
        return typed, names, types
    index = list(sheet.get("index_columns") or [])
    index += [renames[c] for c in index if c in renames]
    if sheet.get("unpivot_id_cols") is not None:
        ids = list(sheet["unpivot_id_cols"])
    else:
        ids = index + [c for c in [sheet.get("section_column_name")] if c]
    ids = [c for c in dict.fromkeys(ids) if c in names]
    ids += [c for c in names if c in set(sheet.get("exclude_from_unpivot") or []) and c not in ids]
    values = [c for c in names if c not in ids]
    if not values:
        return typed, names, types
    var = sheet.get("unpivot_var_name") or "Variable"
    val = sheet.get("unpivot_value_name") or "Value"
    lead = [c for c in ROW_KEY if c in typed.columns]
    long = R.unpivot(typed, lead + ids, (), var, val, values)
    return long, [*ids, var, val], types


def _empty_blocks(recs: DataFrame, grid: DataFrame, blocks: list[L.Block]) -> DataFrame:
    """Sections without a single data row: warned about, not an error."""
    names = F.array(
        *[F.struct(F.lit(b.number).alias("block"), F.lit(b.name).cast("string").alias("name")) for b in blocks]
    )
    wanted = grid.select("workbook", "sheet").distinct().select("workbook", "sheet", F.inline(names))
    return wanted.join(recs.select(*L.BLOCK_KEY).distinct(), L.BLOCK_KEY, "left_anti")
