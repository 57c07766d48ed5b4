"""Where a table sits on its sheet: blocks, header labels, width and end row.

A *block* is one rectangle with its own header: the whole table of a simple sheet,
one column span of a side-by-side sheet, one row span of a stacked sheet. Blocks
come from a config, so their number is bounded by the config, not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import stage
from ..sources.config import Settings
from .ordered import RANGE_WIDTH

BLOCK_KEY = ["workbook", "sheet", "block"]


@dataclass(frozen=True)
class Block:
    number: int
    name: str | None
    start_col: int
    end_col: int | None  # None: as wide as the last header row
    header_rows: tuple[int, ...]
    data_start: int
    data_end: int | None  # None: find the end
    statics: Mapping[str, str] = field(default_factory=dict)
    columns: tuple[tuple[int, str], ...] = ()  # explicit (column, name) list


def _header_rows(cfg: Mapping[str, Any]) -> tuple[int, ...]:
    rows = cfg.get("header_rows")
    return tuple(int(r) for r in rows) if rows else (int(cfg["header_row"]),)


def blocks_of(sheet: Mapping[str, Any]) -> list[Block]:
    """The blocks of one sheet config."""
    kind = sheet["table_type"]
    if kind == "stacked":
        return [
            Block(
                number=i,
                name=t.get("name"),
                start_col=X.letters_to_index(t.get("start_col") or "A"),
                end_col=None,
                header_rows=_header_rows(t),
                data_start=int(t["data_start_row"]),
                data_end=t.get("data_end_row"),
                statics=dict(t.get("static_columns") or {}),
            )
            for i, t in enumerate(sheet["tables"])
        ]
    common = {
        "header_rows": _header_rows(sheet),
        "data_start": int(sheet["data_start_row"]),
        "data_end": sheet.get("data_end_row"),
    }
    if kind == "side_by_side":
        return [
            Block(
                number=i,
                name=s["name"],
                start_col=X.letters_to_index(s["start_col"]),
                end_col=X.letters_to_index(s["end_col"]),
                **common,
            )
            for i, s in enumerate(sheet["sections"])
        ]
    listed = tuple((X.letters_to_index(c["col"]), c["name"]) for c in sheet.get("columns") or ())
    start = listed[0][0] if listed else X.letters_to_index(sheet.get("start_col") or "A")
    return [Block(number=0, name=None, start_col=start, end_col=None, columns=listed, **common)]


def disjoint(blocks: Sequence[Block]) -> bool:
    """True when no cell can lie in two blocks: closed column spans that do not overlap."""
    spans = sorted((b.start_col, b.end_col or 0) for b in blocks)
    closed = all(b.end_col is not None for b in blocks)
    return len(blocks) == 1 or (closed and all(a[1] < b[0] for a, b in zip(spans, spans[1:])))


def with_blocks(
    cells: DataFrame, blocks: Sequence[Block], inside: Column | None = None, ends: str | None = None
) -> DataFrame:
    """Attach every block whose columns (and rows from its first header on) hold the cell.

    A narrow step: the blocks are literals in the expression, no join. Cells outside
    all blocks are filtered out at the scan. ``ends`` names a map column block → last
    row; with it only data rows up to that row count, so a cell of a stacked sheet is
    not handed to all the blocks above it.
    """

    def holds(b: Block) -> Column:
        at = (F.col("r") >= min(b.data_start, *b.header_rows)) & (F.col("c") >= b.start_col)
        if b.end_col is not None:
            at = at & (F.col("c") <= b.end_col)
        # Below a given last row only header rows could follow.
        if b.data_end is not None:
            at = at & (F.col("r") <= max(b.data_end, *b.header_rows))
        if ends is not None:
            at = at & (F.col("r") >= b.data_start) & (F.col("r") <= F.try_element_at(ends, F.lit(b.number)))
        return at

    numbers = [F.when(holds(b), F.lit(b.number)) for b in blocks]
    if disjoint(blocks):
        found = cells.withColumn("block", F.coalesce(*numbers)).where(F.col("block").isNotNull())
    else:
        found = cells.select("*", F.explode(F.array_compact(F.array(*numbers))).alias("block"))

    def of_block(value, kind: str) -> Column:
        """An attribute of the cell's block, as one literal where all blocks agree."""
        values = {b.number: value(b) for b in blocks}
        if len(set(values.values())) == 1:
            return _literal(next(iter(values.values()))).cast(kind)
        pairs = F.create_map(*[x for n, v in values.items() for x in (F.lit(n), _literal(v).cast(kind))])
        return F.try_element_at(pairs, F.col("block"))

    found = found.select(
        "*",
        of_block(lambda b: b.start_col, "int").alias("start_col"),
        of_block(lambda b: b.end_col, "int").alias("end_col"),
        of_block(lambda b: b.header_rows, "array<int>").alias("header_rows"),
        of_block(lambda b: b.data_start, "int").alias("data_start"),
        of_block(lambda b: b.data_end, "int").alias("data_end"),
    )
    return found if inside is None else found.where(inside)


def _literal(value) -> Column:
    return F.array(*[F.lit(v) for v in value]) if isinstance(value, tuple) else F.lit(value)


def _in_scan(settings: Settings) -> Column:
    """The scan limit on columns holds where the config names no last column."""
    return F.col("end_col").isNotNull() | (F.col("c") <= settings.max_scan_cols)


def header_labels(
    cells: DataFrame, blocks: Sequence[Block], settings: Settings, join: str = " | "
) -> DataFrame:
    """``(workbook, sheet, block, c, header)`` — cleaned, joined over rows, unique per block.

    The header rows of one block are at most the sheet's width, so folding them in
    one array per block is bounded by the file format.
    """
    rows = sorted({r for b in blocks for r in b.header_rows})
    top = with_blocks(cells.where(F.col("r").isin(rows)), blocks, _in_scan(settings))
    top = top.where(F.array_contains("header_rows", F.col("r")))
    part = X.clean_header(F.col("value"), settings.note_pattern)
    last_row = F.element_at("header_rows", -1)
    # Width: up to the last filled cell of the last header row, unless the block says.
    per_column = top.groupBy(*BLOCK_KEY, "start_col", "c").agg(
        F.array_sort(
            F.collect_list(F.struct(F.array_position("header_rows", F.col("r")).alias("at"), part.alias("part")))
        ).alias("parts"),
        F.max(F.when((F.col("r") == last_row) | F.col("end_col").isNotNull(), F.col("c"))).alias("width_mark"),
    )
    labels = F.filter(F.transform("parts", lambda p: p["part"]), lambda p: p.isNotNull())
    no_repeat = F.filter(labels, lambda p, i: (i == 0) | (p != F.get(labels, i - 1)))
    per_column = per_column.withColumn(
        "header", F.when(F.size(no_repeat) > 0, F.array_join(no_repeat, join))
    )
    per_block = per_column.groupBy(*BLOCK_KEY, "start_col").agg(
        F.coalesce(F.max("width_mark"), F.col("start_col")).alias("width"),
        F.array_sort(F.collect_list(F.when(F.col("header").isNotNull(), F.struct("c", "header")))).alias("cols"),
    )
    inside = F.filter("cols", lambda x: x["c"] <= F.col("width"))
    listed = per_block.select(*BLOCK_KEY, F.inline(inside))
    return number_repeats(listed) if settings.dedupe_headers else listed


def number_repeats(listed: DataFrame) -> DataFrame:
    """``(workbook, sheet, block, c, header)`` with repeated headers numbered as in :func:`unique_labels`.

    The n-th equal header of a block is named by a window, in time linear in the
    columns. Only blocks where such a name meets a header of its own are folded.
    """
    nth = F.row_number().over(Window.partitionBy(*BLOCK_KEY, "header").orderBy("c"))
    counted = F.when(nth > 1, F.concat_ws("_", "header", nth.cast("string"))).otherwise(F.col("header"))
    named = listed.withColumn("name", counted)
    taken = F.count(F.lit(1)).over(Window.partitionBy(*BLOCK_KEY, "name"))
    marked = named.withColumn("taken", taken)
    blocks = marked.groupBy(*BLOCK_KEY).agg(
        F.max("taken").alias("most"), F.array_sort(F.collect_list(F.struct("c", "header", "name"))).alias("cols")
    )
    labels = F.transform("cols", lambda x: x["header"])
    names = F.when(F.col("most") > 1, folded_labels(labels)).otherwise(F.transform("cols", lambda x: x["name"]))
    pairs = F.arrays_zip(F.transform("cols", lambda x: x["c"]).alias("c"), names.alias("header"))
    return blocks.select(*BLOCK_KEY, pairs.alias("pairs")).select(*BLOCK_KEY, F.inline("pairs"))


def unique_labels(labels: Column) -> Column:
    """Later repeats get ``_2``, ``_3`` …; a suffix already in use is skipped."""
    return F.when(F.size(F.array_distinct(labels)) == F.size(labels), labels).otherwise(folded_labels(labels))


def folded_labels(labels: Column) -> Column:
    """Labels made unique one by one, each against those before it."""
    size = F.size(labels)

    def free_name(out: Column, label: Column) -> Column:
        tries = F.transform(F.sequence(F.lit(2), size + 1), lambda k: F.concat(label, F.lit("_"), k.cast("string")))
        return F.element_at(F.filter(tries, lambda t: ~F.array_contains(out, t)), 1)

    def step(out: Column, label: Column) -> Column:
        name = F.when(F.array_contains(out, label), free_name(out, label)).otherwise(label)
        return F.concat(out, F.array(name))

    return F.aggregate(labels, F.lit([]).cast("array<string>"), step)


def explicit_labels(cells: DataFrame, block: Block) -> DataFrame:
    """Header table of an explicit ``columns`` list, for every sheet at hand."""
    literal = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(n).alias("header")) for c, n in block.columns])
    sheets = cells.select("workbook", "sheet").distinct()
    return sheets.select("workbook", "sheet", F.lit(block.number).alias("block"), F.inline(literal))


def block_widths(cells: DataFrame, blocks: Sequence[Block], settings: Settings) -> DataFrame:
    """Last column per block: given, or the last filled cell of the last header row."""
    rows = sorted({b.header_rows[-1] for b in blocks})
    top = with_blocks(cells.where(F.col("r").isin(rows)), blocks, _in_scan(settings))
    return (
        top.where(F.col("r") == F.element_at("header_rows", -1))
        .groupBy(*BLOCK_KEY)
        .agg(F.max(F.coalesce("end_col", "c")).alias("last_col"))
    )


def end_rows(
    rows: DataFrame,
    stop_on_blank_rows: int = 1,
    keys: Sequence[str] = tuple(BLOCK_KEY),
    width: int = RANGE_WIDTH,
) -> DataFrame:
    """Last data row per key: before the first footer or run of blank rows.

    ``rows`` holds the non-blank rows at or after ``data_start``, with columns
    ``r, data_start, footer`` and the keys; the same ``r`` may occur more than once.
    Works on row ranges, so a sheet of any length is spread over tasks; only one
    summary row per range meets in the final window.
    """
    keys = list(keys)
    gap = max(int(stop_on_blank_rows), 1)
    in_range = Window.partitionBy(*keys, "_range").orderBy("r")
    stepped = (
        rows.groupBy(*keys, "data_start", "r")
        .agg(F.max("footer").alias("footer"))
        .withColumn("_range", F.floor(F.col("r") / F.lit(width)))
        .withColumn("_prev", F.lag("r").over(in_range))
    )
    stops_here = F.col("footer") | (F.col("r") - F.col("_prev") - 1 >= gap)
    ranges = stepped.groupBy(*keys, "data_start", "_range").agg(
        F.min("r").alias("first_r"),
        F.max("r").alias("last_r"),
        F.min_by("footer", "r").alias("first_is_footer"),
        F.min(F.when(stops_here, F.col("_prev"))).alias("stop_inside"),
    )
    across = Window.partitionBy(*keys).orderBy("_range")
    carry = F.coalesce(F.lag("last_r").over(across), F.col("data_start") - 1)
    ranges = ranges.withColumn("carry", carry)
    stop = F.when(
        F.col("first_is_footer") | (F.col("first_r") - F.col("carry") - 1 >= gap), F.col("carry")
    ).otherwise(F.col("stop_inside"))
    return ranges.groupBy(*keys).agg(F.coalesce(F.min(stop), F.max("last_r")).cast("int").alias("end_row"))


def ends_by_sheet(ends: DataFrame) -> DataFrame:
    """``(workbook, sheet, ends)`` with a map block → end row; as long as the config's block list."""
    entry = F.map_from_entries(F.collect_list(F.struct("block", "end_row")))
    return ends.groupBy("workbook", "sheet").agg(entry.alias("ends"))


def table_ends(
    cells: DataFrame,
    blocks: Sequence[Block],
    settings: Settings,
    end_from_first_block: bool = False,
) -> DataFrame:
    """``(workbook, sheet, block, end_row)`` of every block that has data.

    ``end_from_first_block`` measures the first block only and applies its end to
    all (side-by-side parity); the default lets each block end where it ends.
    """
    measured = [b for b in blocks if b.number == 0] if end_from_first_block else list(blocks)
    spans = with_blocks(
        cells.where(F.col("r") <= settings.max_scan_rows),
        measured,
        (F.col("r") >= F.col("data_start")) & _in_scan(settings),
    )
    if any(b.end_col is None for b in measured):
        spans = (
            spans.join(stage(block_widths(cells, measured, settings)), BLOCK_KEY, "left")
            .where(F.col("c") <= F.coalesce("last_col", "start_col"))
            .drop("last_col")
        )
    text = X.strip(F.col("value"))
    footer = F.lit(False)
    for marker in settings.footer_markers:
        footer = footer | text.startswith(F.lit(marker))
    found = end_rows(
        spans.where(F.col("data_end").isNull()).select(
            *BLOCK_KEY, "r", "data_start", ((F.col("c") == F.col("start_col")) & footer).alias("footer")
        ),
        settings.stop_on_blank_rows,
    )
    given = (
        spans.where(F.col("data_end").isNotNull())
        .groupBy(*BLOCK_KEY)
        .agg(F.min(F.least("data_end", F.lit(settings.max_scan_rows))).alias("end_row"))
    )
    kinds = {b.data_end is not None for b in measured}
    ends = given if kinds == {True} else found if kinds == {False} else found.unionByName(given)
    if not end_from_first_block:
        return ends
    numbers = F.array(*[F.lit(b.number) for b in blocks])
    return ends.select("workbook", "sheet", F.explode(numbers).alias("block"), "end_row")
