"""Structure detection over all sheets at once, and configs generated from it.

Header, banner and section logic looks at the first rows only, a predicate that
reaches the scan. Only stacked-table detection reads every row, and it does so on
per-row counts with the range-wise carry of :mod:`ordered`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import stage
from ..sources.config import Settings
from .layout import unique_labels
from .ordered import RANGE_WIDTH

SHEET = ["workbook", "sheet"]

# --- fixed values of the heuristics
BANNER_LOOKBACK = 2
BANNER_MIN_COLUMN = 5
TITLE_MIN_LENGTH = 10
TITLE_KEEP = 50
START_COLUMNS = 5
NO_HEADER = "NO_HEADER_DETECTED"

# --- fixed values: texts of the report
ADVICE_SIDES = "side_by_side with %d sections"
ADVICE_STACK = "stacked with %d tables"
ADVICE_SIMPLE = "simple (single table)"
ADVICE_NONE = "Skip (metadata/cover) or define manually"
DESCRIBED = "Auto-detected: "
BOOK_DESCRIBED = "Auto-generated config for "


def is_label(value: Column, kind: Column, settings: Settings) -> Column:
    """A genuine text: not empty, not a null marker, not a number."""
    t = X.strip(value)
    number = X.number_text(value, settings.thousands_sep, settings.decimal_sep)
    return F.coalesce((kind == "string") & ~t.isin(*settings.null_markers, "") & number.isNull(), F.lit(False))


def sheet_bounds(grid: DataFrame) -> DataFrame:
    """Dimensions and last filled row of the first column."""
    return grid.groupBy(*SHEET).agg(
        F.max("r").alias("max_row"),
        F.max("c").alias("max_col"),
        F.coalesce(F.max(F.when(F.col("c") == 1, F.col("r"))), F.lit(1)).alias("last_data_row"),
    )


def top_rows(grid: DataFrame, settings: Settings, merges: DataFrame | None = None) -> DataFrame:
    """Per row of the header window: counts, and the row's cells in column order.

    ``anchors`` lists the cells as written (before merged ranges were filled), each
    with the last column its merged range reaches.
    """
    if "origin" not in grid.columns:
        grid = grid.withColumn("origin", F.lit("cell"))
    top = grid.where((F.col("r") <= settings.header_search_max_rows + 1) & (F.col("c") <= settings.max_scan_cols))
    reach = F.col("c")
    if merges is not None:
        spans = merges.select(*SHEET, F.col("min_r").alias("r"), F.col("min_c").alias("c"), F.col("max_c").alias("reach"))
        top = top.join(spans, [*SHEET, "r", "c"], "left")
        reach = F.coalesce("reach", "c")
    own = F.col("origin") == "cell"
    return top.groupBy(*SHEET, "r").agg(
        F.count(F.lit(1)).alias("filled"),
        F.count_if(is_label(F.col("value"), F.col("kind"), settings)).alias("labels"),
        F.array_sort(F.collect_list(F.struct("c", "value"))).alias("cells"),
        F.array_sort(F.collect_list(F.when(own, F.struct("c", "value")))).alias("anchors"),
        F.max(F.when(own, reach)).alias("reach"),
        F.bool_and(F.col("kind") == "string").alias("all_text"),
    )


def header_rows(top: DataFrame, settings: Settings) -> DataFrame:
    """One row per sheet with a header: the row itself, its candidates, and the rows above.

    A candidate and its successor both hold two or more cells; the one with most
    labels wins, then most cells, then the later row. The window spans at most the
    header-search rows of a sheet.
    """
    order = Window.partitionBy(*SHEET).orderBy("r")
    below = F.when(F.lead("r").over(order) == F.col("r") + 1, F.lead("filled").over(order)).otherwise(0)
    rows = top.withColumn("below", below)
    candidate = (
        (F.col("filled") >= 2) & (F.col("below") >= 2) & (F.col("r") <= settings.header_search_max_rows)
    )
    picked = rows.groupBy(*SHEET).agg(
        F.max_by(
            F.when(candidate, F.struct("r", "filled", "cells")),
            F.when(candidate, F.struct("labels", "filled", "r")),
        ).alias("h"),
        F.array_sort(F.collect_list(F.when(candidate, F.struct("r", "labels")))).alias("candidates"),
        F.array_sort(F.collect_list(F.struct("r", F.size("anchors").alias("filled"), "all_text", "reach", "anchors"))).alias("rows"),
    )
    return picked.where(F.col("h").isNotNull()).select(
        *SHEET,
        F.col("h.r").alias("header_row"),
        F.col("h.filled").alias("header_filled"),
        F.col("h.cells").alias("header_cells"),
        "candidates",
        "rows",
    )


def with_banner(headers: DataFrame) -> DataFrame:
    """The section banner above the header, nearest first, on unfilled cells."""

    def fits(row: Column) -> Column:
        above = F.col("header_row") - row["r"]
        return (
            above.between(1, BANNER_LOOKBACK)
            & (row["filled"] >= 2)
            & (row["filled"] < F.col("header_filled"))
            & row["all_text"]
            & (row["reach"] > BANNER_MIN_COLUMN)
        )

    banners = F.filter("rows", fits)
    return headers.withColumn("banner", F.try_element_at(banners, F.lit(-1))).drop("rows")


def with_sections(headers: DataFrame, settings: Settings, index_keyword: str = "year") -> DataFrame:
    """Repeats of the index keyword, and the column spans they or the banner open."""
    keyword = index_keyword.strip().lower()
    columns = F.transform("header_cells", lambda x: x["c"])
    repeats = F.transform(
        F.filter("header_cells", lambda x: F.lower(X.strip(x["value"])) == keyword), lambda x: x["c"]
    )
    headers = headers.withColumn("repeats", repeats).withColumn("header_columns", columns)
    note = settings.note_pattern

    def banner_name(text: Column) -> Column:
        t = X.strip(text)
        return X.strip(F.regexp_replace(t, F.lit(note), F.lit(""))) if note else t

    starts = F.when(
        F.col("banner").isNotNull(),
        F.transform(F.col("banner.anchors"), lambda x: F.struct(x["c"].alias("c"), banner_name(x["value"]).alias("name"))),
    ).otherwise(F.transform("repeats", lambda c: F.struct(c.alias("c"), F.lit("").alias("name"))))
    last = F.array_max("header_columns")

    def span(start: Column, i: Column) -> Column:
        nxt = F.get(F.col("starts"), i + 1)["c"]
        end = F.coalesce(nxt - 1, F.col("last_col"))
        inside = F.filter("header_columns", lambda c: (c >= start["c"]) & (c <= end))
        numbered = F.concat(F.lit("Section_"), (i + 1).cast("string"))
        return F.struct(
            F.coalesce(F.nullif(start["name"], F.lit("")), numbered).alias("name"),
            start["c"].alias("start"),
            F.coalesce(F.array_max(inside), start["c"]).alias("end"),
        )

    many = F.size("repeats") > 1
    return (
        headers.withColumn("last_col", last)
        .withColumn("banner", F.when(many, F.col("banner")))
        .withColumn("starts", F.when(many, starts).otherwise(F.array().cast("array<struct<c:int,name:string>>")))
        .withColumn("sections", F.transform("starts", span))
        .drop("starts")
    )


def stacked_titles(
    grid: DataFrame, settings: Settings, width: int = RANGE_WIDTH, title_keep: int = TITLE_KEEP
) -> DataFrame:
    """Title rows of stacked tables: ``(workbook, sheet, title_row, name)``.

    A title is a lone text of more than ten characters with a filled row right below
    and no filled row (two or more cells) earlier in its run of non-blank rows. Rows
    are worked on in ranges; what a range needs to know of the others (its
    neighbours' edge rows, the last filled row and the last start of a run before it)
    is carried by one summary row per range.
    """
    cells = grid.where((F.col("r") <= settings.max_scan_rows) & (F.col("c") <= settings.max_scan_cols))
    # Numbers only, so that the rows are counted by hash; the few titles fetch their text later.
    rows = cells.groupBy(*SHEET, "r").agg(
        F.count(F.lit(1)).alias("filled"), F.max(F.length("value")).alias("length")
    )
    order = Window.partitionBy(*SHEET, "part").orderBy("r")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    full_row = F.when(F.col("filled") >= 2, F.col("r"))
    local = (
        rows.withColumn("part", F.floor(F.col("r") / F.lit(width)))
        .withColumns(
            {
                "prev_r": F.lag("r").over(order),
                "next_r": F.lead("r").over(order),
                "next_filled": F.lead("filled").over(order),
                "full_before": F.max(full_row).over(before),
            }
        )
        .withColumn("opens", F.when(F.col("prev_r") < F.col("r") - 1, F.col("r")))
        .withColumn("opened", F.max("opens").over(upto))
    )
    edges = local.groupBy(*SHEET, "part").agg(
        F.min("r").alias("first_r"),
        F.max("r").alias("last_r"),
        F.min_by("filled", "r").alias("first_filled"),
        F.max(full_row).alias("last_full"),
        F.max("opens").alias("last_open"),
    )
    parts = Window.partitionBy(*SHEET).orderBy("part")
    earlier = parts.rowsBetween(Window.unboundedPreceding, -1)
    last_before = F.lag("last_r").over(parts)
    edges = edges.withColumn(
        "first_opens",
        F.when(last_before.isNull() | (last_before < F.col("first_r") - 1), F.col("first_r")),
    ).select(
        *SHEET,
        "part",
        "first_opens",
        F.lead("first_r").over(parts).alias("far_r"),
        F.lead("first_filled").over(parts).alias("far_filled"),
        F.max("last_full").over(earlier).alias("far_full"),
        F.max(F.greatest("last_open", "first_opens")).over(earlier).alias("far_open"),
    )
    lone = local.where((F.col("filled") == 1) & (F.col("length") > TITLE_MIN_LENGTH))
    seen = lone.join(edges, [*SHEET, "part"])
    full = F.coalesce("full_before", "far_full")
    run_start = F.coalesce("opened", "first_opens", "far_open")
    below_r, below_filled = F.coalesce("next_r", "far_r"), F.coalesce("next_filled", "far_filled")
    title = (below_r == F.col("r") + 1) & (below_filled >= 2) & (full.isNull() | (full < run_start))
    return cells.join(seen.where(title).select(*SHEET, "r"), [*SHEET, "r"]).select(
        *SHEET, F.col("r").alias("title_row"), F.left("value", F.lit(title_keep)).alias("name")
    )


def stacked_tables(grid: DataFrame, settings: Settings, title_keep: int = TITLE_KEEP) -> DataFrame:
    """Sheets with two or more titles, their tables in row order."""
    titles = stacked_titles(grid, settings, title_keep=title_keep)
    per_sheet = titles.groupBy(*SHEET).agg(F.array_sort(F.collect_list(F.struct("title_row", "name"))).alias("t"))
    table = F.transform(
        "t",
        lambda x: F.struct(
            x["title_row"].alias("title_row"), (x["title_row"] + 1).alias("header_row"), x["name"].alias("name")
        ),
    )
    return per_sheet.where(F.size("t") > 1).select(*SHEET, table.alias("stacked"))


def used_columns(grid: DataFrame, headers: DataFrame, settings: Settings) -> DataFrame:
    """``(workbook, sheet, used)``: columns with a value anywhere below the header.

    Counted over whole columns: one row per column and task is shuffled.
    """
    lowest = grid.where(F.col("c") <= settings.max_scan_cols).groupBy(*SHEET, "c").agg(F.max("r").alias("r"))
    below = lowest.join(headers.select(*SHEET, "header_row"), SHEET).where(F.col("r") > F.col("header_row"))
    return below.groupBy(*SHEET).agg(F.collect_set("c").alias("used"))


def empty_columns() -> Column:
    """Columns with neither a header nor a value below, up to the last header."""
    filled = F.concat("header_columns", F.coalesce("used", F.array().cast("array<int>")))
    return F.transform(F.array_except(F.sequence(F.lit(1), "last_col"), filled), X.column_letters)


def header_list(settings: Settings) -> Column:
    """Every column from the start column to the last header, with its cleaned name."""
    by_column = F.map_from_entries("header_cells")

    def name(c: Column) -> Column:
        t = X.squeeze(F.try_element_at(by_column, c))
        return X.strip(F.regexp_replace(t, F.lit(settings.note_pattern), F.lit(""))) if settings.note_pattern else t

    return F.transform(
        F.sequence("start_index", "last_col"),
        lambda c: F.struct(X.column_letters(c).alias("col"), name(c).alias("name")),
    )


def profile_sheets(
    grid: DataFrame,
    settings: Settings,
    index_keyword: str = "year",
    merges: DataFrame | None = None,
    start_columns: int = START_COLUMNS,
    title_keep: int = TITLE_KEEP,
) -> DataFrame:
    """One row per sheet: dimensions, header, sections or stacked tables, layout.

    ``grid`` is the filled grid (``origin`` tells written cells from filled ones). A table is
    taken to start in one of the first ``start_columns``, headers are looked for in the first
    ``header_search_max_rows`` of the settings, and ``title_keep`` characters name a stacked table.
    """
    bounds = sheet_bounds(grid)
    headers = with_sections(with_banner(header_rows(top_rows(grid, settings, merges), settings)), settings, index_keyword)
    start = F.array_min(F.filter("header_columns", lambda c: c <= start_columns))
    # One row per sheet, read by two joins below.
    headers = stage(headers.withColumn("start_index", F.coalesce(start, F.lit(1))).drop("header_filled"))
    full = (
        bounds.join(headers, SHEET, "left")
        .join(stacked_tables(grid, settings, title_keep), SHEET, "left")
        .join(used_columns(grid, headers, settings), SHEET, "left")
        .withColumn("empty_columns", empty_columns())
    )
    found = F.col("header_row").isNotNull()
    side = F.size("repeats") > 1
    stacked = F.when(~side, F.col("stacked"))
    kind = F.when(side, "side_by_side").when(F.col("stacked").isNotNull(), "stacked").otherwise("simple")
    advice = (
        F.when(side, F.format_string(ADVICE_SIDES, F.size("sections")))
        .when(F.col("stacked").isNotNull(), F.format_string(ADVICE_STACK, F.size("stacked")))
        .otherwise(ADVICE_SIMPLE)
    )
    sections = F.transform(
        "sections",
        lambda s: F.struct(
            s["name"].alias("name"),
            X.column_letters(s["start"]).alias("start_col"),
            X.column_letters(s["end"]).alias("end_col"),
        ),
    )
    return full.select(
        *SHEET,
        F.concat_ws(" x ", F.concat("max_row", F.lit(" rows")), F.concat("max_col", F.lit(" cols"))).alias("dimensions"),
        "last_data_row",
        F.when(~found, NO_HEADER).alias("status"),
        "header_row",
        (F.col("header_row") + 1).alias("data_start_row"),
        F.col("last_col").alias("actual_max_col"),
        "candidates",
        F.when(found, X.column_letters(F.col("start_index"))).alias("start_col"),
        F.when(found, header_list(settings)).alias("headers"),
        F.when(F.size("empty_columns") > 0, F.col("empty_columns")).alias("empty_columns"),
        F.when(found, F.size("repeats")).alias("repeat_columns"),
        F.col("banner.r").alias("section_header_row"),
        F.when(side, sections).alias("sections"),
        F.when(found, stacked).alias("stacked_tables"),
        F.when(found, kind).alias("table_type"),
        F.when(~found, ADVICE_NONE).otherwise(advice).alias("recommendation"),
    )


def sheet_configs(
    profiles: DataFrame,
    index_keyword: str = "Year",
    section_column_name: str = "Section",
    position: str = "sheet",
) -> DataFrame:
    """One config entry per profiled sheet; sheets without a header are left out.

    ``position`` orders the sheets of a workbook for the suffix on equal output
    names (``_2``, ``_3`` …); a suffix already in use is skipped.
    """
    found = profiles.where(F.col("status").isNull()).withColumn("base", X.slug(F.col("sheet")))
    side = (F.col("table_type") == "side_by_side") & (F.size("sections") > 0)
    stack = F.col("stacked_tables").isNotNull()

    def table(t: Column, i: Column) -> Column:
        nxt = F.get(F.col("stacked_tables"), i + 1)["title_row"]
        return F.struct(
            t["name"].alias("name"),
            t["header_row"].alias("header_row"),
            (t["header_row"] + 1).alias("data_start_row"),
            (nxt - 1).alias("data_end_row"),
        )

    entry = F.struct(
        F.col("sheet").alias("sheet_name"),
        "table_type",
        F.concat(F.lit(DESCRIBED), "recommendation").alias("description"),
        "output_name",
        F.when(~stack, F.col("header_row")).alias("header_row"),
        F.when(~stack, F.col("data_start_row")).alias("data_start_row"),
        F.when(side, F.array(F.lit(index_keyword))).otherwise(F.array().cast("array<string>")).alias("index_columns"),
        F.when(F.col("start_col") != "A", F.col("start_col")).alias("start_col"),
        F.when(side, F.col("section_header_row")).alias("section_header_row"),
        F.when(side, F.lit(section_column_name)).alias("section_column_name"),
        F.when(side, F.lit(False)).alias("unpivot"),
        F.when(side, F.lit("Variable")).alias("unpivot_var_name"),
        F.when(side, F.lit("Value")).alias("unpivot_value_name"),
        F.when(side, F.array(F.lit("Total"))).alias("exclude_from_unpivot"),
        F.when(side, F.col("sections")).alias("sections"),
        F.when(stack, F.transform("stacked_tables", table)).alias("tables"),
    )
    order = F.struct(F.col(position).alias("at"), "sheet", "base")
    books = found.groupBy("workbook").agg(F.array_sort(F.collect_list(order)).alias("order"))
    free = unique_labels(F.transform("order", lambda x: x["base"]))
    pairs = F.arrays_zip(F.transform("order", lambda x: x["sheet"]).alias("sheet"), free.alias("output_name"))
    names = books.select("workbook", pairs.alias("pairs")).select("workbook", F.inline("pairs"))
    named = found.join(names, ["workbook", "sheet"])
    keep = ["workbook", "sheet", *([position] if position != "sheet" else [])]
    return named.select(*keep, entry.alias("entry"))


def generate_configs(
    entries: DataFrame,
    engine_version: str,
    settings: Settings,
    generated_at: Column,
    position: str = "sheet",
) -> DataFrame:
    """``(workbook, config_json)``: one config document per workbook."""
    per_book = entries.groupBy("workbook").agg(
        F.array_sort(F.collect_list(F.struct(F.col(position).alias("at"), "entry"))).alias("list")
    )
    name = X.basename(F.col("workbook"))
    doc = F.struct(
        F.regexp_replace(name, r"\.[^.]*$", "").alias("config_name"),
        F.lit("2.0").alias("config_version"),
        F.lit(engine_version).alias("engine_version"),
        F.concat(F.lit(BOOK_DESCRIBED), name).alias("description"),
        F.struct(
            name.alias("original_file"),
            F.lit("profile").alias("generated_by"),
            generated_at.cast("string").alias("generated_at"),
        ).alias("source_info"),
        F.struct(
            F.array(*[F.lit(m) for m in settings.null_markers]).alias("null_markers"),
            F.lit(settings.note_pattern).alias("note_pattern"),
            F.lit(settings.type_inference).alias("type_inference"),
            F.lit(settings.stop_on_blank_rows).alias("stop_on_blank_rows"),
            F.lit(settings.resolve_merged_cells).alias("resolve_merged_cells"),
            F.lit(settings.dedupe_headers).alias("dedupe_headers"),
            F.lit(settings.on_error).alias("on_error"),
        ).alias("settings"),
        F.transform("list", lambda x: x["entry"]).alias("sheets"),
    )
    return per_book.select("workbook", F.to_json(doc).alias("config_json"))
