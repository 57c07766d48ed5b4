"""Structure detection on sheets derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import ENGINE_VERSION
from ...operators import profiling as P
from ...sources import config as CFG
from ...session import stage
from ...sources.config import Settings
from .base import Cell, Grid, chunk, chunk_name, query

# Simple sheets: a title, one or two lines of numbers, the header at a varying row, data.
SIMPLE_BOOK = chunk_name("simple_", "p_partkey", 20)
_HEAD = f"({chunk('p_partkey', 20)} % 4) + 2"
_PFIRST = "p_partkey % 20 = 0"
_PROW = f"{_HEAD} + 1 + p_partkey % 20"
SIMPLE_GRID = Grid(
    "part",
    SIMPLE_BOOK,
    "'Parts 2024.v1'",
    [
        Cell("1", "1", "concat('Parts list ', p_brand)", when=_PFIRST),
        Cell("2", f"{_HEAD}", "'Key [Note 2]'", when=_PFIRST),
        Cell("3", f"{_HEAD}", "'Name'", when=_PFIRST),
        Cell("5", f"{_HEAD}", "'Size'", when=_PFIRST),
        Cell("7", f"{_HEAD}", "'Price'", when=_PFIRST),
        Cell("2", _PROW, "CAST(p_partkey AS STRING)", kind="number"),
        Cell("3", _PROW, "CASE WHEN p_partkey % 7 = 3 THEN '[x]' ELSE p_name END"),
        Cell("5", _PROW, "CAST(p_size AS STRING)"),
        Cell("7", _PROW, "CAST(p_size * 10 AS STRING)", kind="number"),
        Cell("6", _PROW, "'x'", when=f"{chunk('p_partkey', 20)} % 3 = 1"),
    ],
)

# Side by side: banner (sometimes missing) over three sections.
SIDE_BOOK = chunk_name("side_", "o_orderkey", 50)
_SFIRST = "o_orderkey % 50 = 0"
_BANNER = f"{_SFIRST} AND {chunk('o_orderkey', 50)} % 3 <> 0"
_SROW = "o_orderkey % 50 + 4"
SIDE_GRID = Grid(
    "orders",
    SIDE_BOOK,
    "'Flows'",
    [
        Cell("1", "2", "concat('Road', ' [Note 1]')", when=_BANNER),
        Cell("4", "2", "'Rail'", when=_BANNER),
        Cell("8", "2", "o_orderpriority", when=_BANNER),
        *[
            Cell(str(c), "3", f"'{h}'", when=_SFIRST)
            for c, h in ((1, "Year"), (2, "Gas"), (3, "Oil"), (4, " YEAR"), (5, "Gas"), (6, "Coal"), (8, "year "), (9, "Wind"))
        ],
        *[Cell(str(c), _SROW, f"CAST(o_custkey + {c} AS STRING)", kind="number") for c in (1, 2, 3, 4, 5, 6, 8, 9)],
    ],
)

# Stacked: per ten keys a title, a header, data, and blank rows; some titles do not count.
STACK_BOOK = chunk_name("stack_", "o_orderkey", 500)
_K = "(o_orderkey % 500)"
_R = f"{_K} + 1"
STACK_GRID = Grid(
    "orders",
    STACK_BOOK,
    "'Stack'",
    [
        Cell("1", _R, "concat('Table for customer ', CAST(o_custkey AS STRING), ' and some more words to be cut off here')", when=f"{_K} % 10 = 0 AND {_K} % 40 <> 20"),
        Cell("1", _R, "'short'", when=f"{_K} % 40 = 20"),
        *[Cell(str(c), _R, f"'H{c} label'", when=f"{_K} % 10 = 1") for c in (1, 2, 3)],
        *[Cell(str(c), _R, f"CAST(o_custkey + {c} AS STRING)", kind="number", when=f"{_K} % 10 BETWEEN 2 AND 6") for c in (1, 2, 3)],
        Cell("2", _R, "'a lone remark in the data'", when=f"{_K} % 10 = 7 AND o_custkey % 2 = 0"),
        Cell("1", _R, "concat('lone text right above a title ', o_orderpriority)", when=f"{_K} % 10 = 9 AND o_custkey % 3 = 0"),
    ],
)

ALL_GRIDS = (SIMPLE_GRID, SIDE_GRID, STACK_GRID)
_LABEL = "kind = 'string' AND trim(value) NOT IN ('[x]','[c]','[z]','..','') AND NOT (NOT regexp_full_match(trim(value), '0[0-9]+') AND regexp_full_match(replace(trim(value), ',', ''), '[+-]?[0-9]*\\.?[0-9]+([eE][+-]?[0-9]+)?'))"
_ALL_SQL = " UNION ALL ".join(g.sql() for g in ALL_GRIDS)
_LETTER = "chr(64 + CAST({0} AS INT))"

HEADER_CTE = f"""
  cells AS ({{cells}}),
  top AS (SELECT workbook, sheet, r, count(*) AS filled, count(*) FILTER ({_LABEL}) AS labels FROM cells WHERE r <= 26 GROUP BY ALL),
  cand AS (SELECT t.*, row_number() OVER (PARTITION BY t.workbook, t.sheet ORDER BY t.labels DESC, t.filled DESC, t.r DESC) AS n
           FROM top t JOIN top b ON b.workbook = t.workbook AND b.sheet = t.sheet AND b.r = t.r + 1 AND b.filled >= 2
           WHERE t.filled >= 2 AND t.r <= 25),
  head AS (SELECT workbook, sheet, r AS header_row, filled FROM cand WHERE n = 1)
"""


def grid_of(spark, sf_dir, *grids):
    out = grids[0].spark(spark, sf_dir)
    for g in grids[1:]:
        out = out.unionByName(g.spark(spark, sf_dir))
    return stage(out)


@query(
    "row_counts",
    f"SELECT workbook, sheet, r, count(*) AS filled, count(*) FILTER ({_LABEL}) AS labels FROM ({_ALL_SQL}) WHERE r <= 26 GROUP BY ALL",
)
def row_counts(spark, sf_dir):
    """Filled cells and labels per row of the header window."""
    return P.top_rows(grid_of(spark, sf_dir, *ALL_GRIDS), Settings()).select("workbook", "sheet", "r", "filled", "labels")


@query(
    "header_detect",
    f"WITH {HEADER_CTE.format(cells=_ALL_SQL)} SELECT workbook, sheet, header_row, filled AS header_filled FROM head",
)
def header_detect(spark, sf_dir):
    top = P.top_rows(grid_of(spark, sf_dir, *ALL_GRIDS), Settings())
    return P.header_rows(top, Settings()).select("workbook", "sheet", "header_row", "header_filled")


_SECTION_SQL = f"""
  WITH {HEADER_CTE.format(cells=SIDE_GRID.sql())},
  hc AS (SELECT c.workbook, c.sheet, c.c, c.value FROM cells c JOIN head h ON h.workbook = c.workbook AND h.sheet = c.sheet AND c.r = h.header_row),
  rep AS (SELECT workbook, sheet, c, '' AS name FROM hc WHERE lower(trim(value)) = 'year'),
  ban AS (SELECT c.workbook, c.sheet, c.c, trim(regexp_replace(trim(c.value), '\\[[Nn]ote\\s*\\d+\\]', '', 'g')) AS name
          FROM cells c JOIN head h ON h.workbook = c.workbook AND h.sheet = c.sheet AND c.r = h.header_row - 1),
  starts AS (SELECT * FROM ban UNION ALL SELECT * FROM rep WHERE (workbook, sheet) NOT IN (SELECT (workbook, sheet) FROM ban)),
  spans AS (SELECT *, row_number() OVER w AS i, coalesce(lead(c) OVER w - 1, 9999) AS e FROM starts WINDOW w AS (PARTITION BY workbook, sheet ORDER BY c)),
  ends AS (SELECT s.workbook, s.sheet, s.i, s.name, s.c, coalesce(max(h.c), s.c) AS e FROM spans s
           LEFT JOIN hc h ON h.workbook = s.workbook AND h.sheet = s.sheet AND h.c BETWEEN s.c AND s.e GROUP BY s.workbook, s.sheet, s.i, s.name, s.c)
  SELECT workbook, sheet, CASE WHEN name = '' THEN concat('Section_', CAST(i AS STRING)) ELSE name END AS name,
         {_LETTER.format('c')} AS start_col, {_LETTER.format('e')} AS end_col FROM ends
"""


@query("section_detect", _SECTION_SQL)
def section_detect(spark, sf_dir):
    """Column spans of side-by-side sheets, from the banner or the repeated keyword."""
    headers = P.header_rows(P.top_rows(SIDE_GRID.spark(spark, sf_dir), Settings()), Settings())
    found = P.with_sections(P.with_banner(headers), Settings(), "Year")
    spans = found.select("workbook", "sheet", F.inline("sections"))
    from ...functions.text import column_letters

    return spans.select(
        "workbook", "sheet", "name", column_letters(F.col("start")).alias("start_col"), column_letters(F.col("end")).alias("end_col")
    )


@query(
    "keyword_columns",
    f"""
    WITH {HEADER_CTE.format(cells=_ALL_SQL)}
    SELECT h.workbook, h.sheet, count(*) FILTER (lower(trim(c.value)) = 'year') AS repeat_columns
    FROM head h JOIN cells c ON c.workbook = h.workbook AND c.sheet = h.sheet AND c.r = h.header_row GROUP BY ALL
    """,
)
def keyword_columns(spark, sf_dir):
    headers = P.header_rows(P.top_rows(grid_of(spark, sf_dir, *ALL_GRIDS), Settings()), Settings())
    found = P.with_sections(P.with_banner(headers), Settings(), "Year")
    return found.select("workbook", "sheet", F.size("repeats").cast("bigint").alias("repeat_columns"))


_TITLES = """
  {prefix}rows AS (SELECT workbook, sheet, r, count(*) AS filled, arg_min(value, c) AS text FROM {cells} GROUP BY ALL),
  {prefix}isl AS (SELECT *, r - row_number() OVER (PARTITION BY workbook, sheet ORDER BY r) AS island FROM {prefix}rows),
  {prefix}seen AS (SELECT *, coalesce(max(CASE WHEN filled >= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY workbook, sheet, island ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
                 lead(r) OVER (PARTITION BY workbook, sheet ORDER BY r) AS nr, lead(filled) OVER (PARTITION BY workbook, sheet ORDER BY r) AS nf FROM {prefix}isl),
  {prefix}titles AS (SELECT workbook, sheet, r AS title_row, left(text, 50) AS name, count(*) OVER (PARTITION BY workbook, sheet) AS n
             FROM {prefix}seen WHERE filled = 1 AND length(text) > 10 AND full_before = 0 AND nr = r + 1 AND nf >= 2)
"""


@query(
    "stacked_detect",
    f"""
    WITH cells AS ({_ALL_SQL}), {_TITLES.format(prefix='', cells='cells')}
    SELECT workbook, sheet, title_row, title_row + 1 AS header_row, name FROM titles WHERE n > 1
    """,
)
def stacked_detect(spark, sf_dir):
    found = P.stacked_tables(grid_of(spark, sf_dir, *ALL_GRIDS), Settings())
    return found.select("workbook", "sheet", F.inline("stacked"))


_PROFILE_CTE = f"""
  {HEADER_CTE.format(cells=_ALL_SQL)},
  {_TITLES.format(prefix='', cells='cells')},
  stk AS (SELECT workbook, sheet, count(*) AS tables FROM titles WHERE n > 1 GROUP BY ALL),
  dims AS (SELECT workbook, sheet, max(r) AS mr, max(c) AS mc, coalesce(max(r) FILTER (c = 1), 1) AS last_data_row FROM cells GROUP BY ALL),
  hc AS (SELECT h.workbook, h.sheet, h.header_row, count(*) FILTER (lower(trim(c.value)) = 'year') AS reps, max(c.c) AS last_col, min(c.c) FILTER (c.c <= 5) AS first_col,
                list(c.c) AS cols
         FROM head h JOIN cells c ON c.workbook = h.workbook AND c.sheet = h.sheet AND c.r = h.header_row GROUP BY ALL),
  used AS (SELECT h.workbook, h.sheet, list(DISTINCT c.c) AS cols FROM hc h JOIN cells c ON c.workbook = h.workbook AND c.sheet = h.sheet AND c.r > h.header_row AND c.r <= h.header_row + 200 GROUP BY ALL),
  prof AS (
    SELECT d.workbook, d.sheet, concat(CAST(d.mr AS STRING), ' rows x ', CAST(d.mc AS STRING), ' cols') AS dimensions, d.last_data_row,
           hc.header_row, hc.header_row + 1 AS data_start_row, hc.last_col AS actual_max_col, CAST(hc.reps AS INT) AS repeat_columns,
           chr(64 + coalesce(hc.first_col, 1)) AS start_col,
           (SELECT string_agg(chr(64 + CAST(x AS INT)), ',' ORDER BY x) FROM (SELECT unnest(range(1, hc.last_col + 1)) AS x) WHERE x NOT IN (SELECT unnest(hc.cols)) AND x NOT IN (SELECT unnest(used.cols))) AS empties,
           CASE WHEN hc.reps > 1 THEN 'side_by_side' WHEN stk.tables IS NOT NULL THEN 'stacked' ELSE 'simple' END AS table_type,
           stk.tables
    FROM dims d JOIN hc ON hc.workbook = d.workbook AND hc.sheet = d.sheet
    JOIN used ON used.workbook = d.workbook AND used.sheet = d.sheet
    LEFT JOIN stk ON stk.workbook = d.workbook AND stk.sheet = d.sheet)
"""


@query(
    "sheet_profile",
    f"""
    WITH {_PROFILE_CTE}
    SELECT workbook, sheet, dimensions, last_data_row, header_row, data_start_row, actual_max_col, repeat_columns, start_col, empties, table_type FROM prof
    """,
)
def sheet_profile(spark, sf_dir):
    """Layout, dimensions, header, start and empty columns of every sheet in one plan."""
    found = P.profile_sheets(grid_of(spark, sf_dir, *ALL_GRIDS), Settings(), "Year")
    return found.select(
        "workbook", "sheet", "dimensions", "last_data_row", "header_row", "data_start_row", "actual_max_col",
        "repeat_columns", "start_col", F.array_join("empty_columns", ",").alias("empties"), "table_type",
    )


@query(
    "sheet_headers",
    f"""
    WITH {HEADER_CTE.format(cells=_ALL_SQL)},
    hc AS (SELECT c.workbook, c.sheet, c.c, c.value FROM cells c JOIN head h ON h.workbook = c.workbook AND h.sheet = c.sheet AND c.r = h.header_row),
    ext AS (SELECT workbook, sheet, coalesce(min(c) FILTER (c <= 5), 1) AS a, max(c) + 1 AS b FROM hc GROUP BY workbook, sheet),
    span AS (SELECT workbook, sheet, unnest(range(a, b)) AS c FROM ext)
    SELECT s.workbook, s.sheet, chr(64 + CAST(s.c AS INT)) AS col,
           trim(regexp_replace(trim(regexp_replace(hc.value, '\\s+', ' ', 'g')), '\\[[Nn]ote\\s*\\d+\\]', '', 'g')) AS name
    FROM span s LEFT JOIN hc ON hc.workbook = s.workbook AND hc.sheet = s.sheet AND hc.c = s.c
    """,
)
def sheet_headers(spark, sf_dir):
    """Cleaned header list with column letters, gaps included."""
    found = P.profile_sheets(grid_of(spark, sf_dir, *ALL_GRIDS), Settings(), "Year")
    return found.select("workbook", "sheet", F.inline("headers"))


@query(
    "generate_config",
    f"""
    WITH {_PROFILE_CTE}
    SELECT workbook, sheet AS sheet_name, replace(replace(lower(sheet), ' ', '_'), '.', '_') AS output_name, table_type,
           CASE WHEN table_type <> 'stacked' THEN header_row END AS header_row,
           CASE WHEN table_type = 'side_by_side' THEN 'Flow' END AS section_column_name,
           CAST(CASE WHEN table_type = 'side_by_side' THEN 3 END AS INT) AS sections,
           CAST(CASE WHEN table_type = 'stacked' THEN tables END AS INT) AS tables,
           CASE WHEN table_type = 'stacked' THEN (SELECT min(title_row) FROM titles t WHERE t.workbook = prof.workbook AND title_row > (SELECT min(title_row) FROM titles u WHERE u.workbook = prof.workbook)) - 1 END AS first_end_row
    FROM prof
    """,
)
def generate_config(spark, sf_dir):
    """Config documents generated from the profiles, parsed again and taken apart."""
    profiles = P.profile_sheets(grid_of(spark, sf_dir, *ALL_GRIDS), Settings(), "Year")
    entries = P.sheet_configs(profiles, "Year", "Flow")
    docs = P.generate_configs(entries, ENGINE_VERSION, Settings(), F.lit("2024-01-01T00:00:00Z"))
    parsed = CFG.parse_configs(docs).select("workbook", F.explode("config.sheets").alias("s"))
    return parsed.select(
        "workbook", "s.sheet_name", "s.output_name", "s.table_type", "s.header_row", "s.section_column_name",
        F.when(F.size("s.sections") > 0, F.size("s.sections")).alias("sections"),
        F.when(F.size("s.tables") > 0, F.size("s.tables")).alias("tables"),
        F.get("s.tables", 0)["data_end_row"].alias("first_end_row"),
    )


# --------------------------------------------------------------------------- configs as data
CONFIG_JSON = """concat('{"config_name":"', CASE WHEN p_partkey % 31 = 3 THEN '' ELSE p_brand END, '","settings":{"type_inference":"',
  CASE WHEN p_partkey % 17 = 2 THEN 'maybe' ELSE 'safe' END, '","on_error":"', CASE WHEN p_partkey % 19 = 4 THEN 'stop' ELSE 'continue' END,
  '"},"note_pattern":"N', CAST(p_size AS STRING), '","sheets":[',
  CASE WHEN p_partkey % 37 = 5 THEN '' ELSE concat(
    '{"sheet_name":"', CASE WHEN p_partkey % 7 = 1 THEN '' ELSE p_name END, '","output_name":"', p_type, '","table_type":"',
    CASE p_partkey % 5 WHEN 0 THEN 'simple' WHEN 1 THEN 'side_by_side' WHEN 2 THEN 'stacked' WHEN 3 THEN 'wide' ELSE 'simple' END, '"',
    CASE WHEN p_partkey % 5 <> 4 THEN ',"header_row":1' ELSE '' END, ',"data_start_row":2',
    ',"sections":[', CASE WHEN p_size % 2 = 0 THEN '{"name":"a","start_col":"D","end_col":"B"}' ELSE '' END, ']',
    ',"tables":[', CASE WHEN p_size % 3 = 0 THEN '{"name":"t","header_row":4}' ELSE '' END, ']',
    ',"columns":[{"col":"A","name":"x"}', CASE WHEN p_size % 4 = 0 THEN ',{"col":"B"}' ELSE '' END, ']},',
    '{"sheet_name":"second","output_name":"', CASE WHEN p_size % 5 = 0 THEN p_type ELSE 'second' END, '","table_type":"simple","header_rows":[1,2]}') END,
  ']}')"""
CONFIG_JSON = " ".join(CONFIG_JSON.split())

_HAS = "p_partkey % 37 <> 5"
_SIDE, _STACK = "p_partkey % 5 = 1", "p_partkey % 5 = 2"


def _lint_sql() -> str:
    rules = [
        ("p_partkey % 31 = 3", "config", "missing config_name"),
        ("p_partkey % 37 = 5", "config", "no sheets"),
        ("p_partkey % 17 = 2", "settings", "invalid type_inference"),
        ("p_partkey % 19 = 4", "settings", "invalid on_error"),
        (f"{_HAS} AND p_partkey % 7 = 1", "sheets[0]", "missing sheet_name"),
        (f"{_HAS} AND p_partkey % 5 = 3", "sheets[0]", "invalid table_type"),
        (f"{_HAS} AND p_partkey % 5 = 4", "sheets[0]", "missing header row"),
        (f"{_HAS} AND {_SIDE} AND p_size % 2 <> 0", "sheets[0]", "side_by_side without sections"),
        (f"{_HAS} AND {_SIDE} AND p_size % 2 = 0", "sheets[0].sections[0]", "section start right of end"),
        (f"{_HAS} AND {_STACK} AND p_size % 3 <> 0", "sheets[0]", "stacked without tables"),
        (f"{_HAS} AND {_STACK} AND p_size % 3 = 0", "sheets[0].tables[0]", "table without header row or data_start_row"),
        (f"{_HAS} AND p_size % 4 = 0", "sheets[0].columns[1]", "column entry without col or name"),
        (f"{_HAS} AND p_size % 5 = 0", "sheets[1]", "duplicate output_name"),
        (_HAS, "sheets[1]", "missing data_start_row"),
    ]
    return " UNION ALL ".join(f"SELECT p_partkey, '{loc}' AS loc, '{rule}' AS rule FROM part WHERE {cond}" for cond, loc, rule in rules)


def configs(spark, sf_dir):
    from .base import select

    return CFG.parse_configs(select(spark, sf_dir, "part", {"p_partkey": "p_partkey", "config_json": CONFIG_JSON}))


@query("config_lint", _lint_sql())
def config_lint(spark, sf_dir):
    """Every broken rule of every config document."""
    from ...operators.constraints import lint_configs

    return lint_configs(configs(spark, sf_dir), ["p_partkey"])


@query(
    "config_settings",
    """
    SELECT p_partkey, CASE WHEN p_partkey % 17 = 2 THEN 'maybe' ELSE 'safe' END AS type_inference,
           concat('N', CAST(p_size AS STRING)) AS note_pattern, '.' AS decimal_sep, 25 AS header_search_max_rows,
           CAST(5 AS INT) AS null_markers, TRUE AS resolve_merged_cells
    FROM part
    """,
)
def config_settings(spark, sf_dir):
    """Effective settings: block, else old top-level key, else default."""
    s = CFG.resolve_settings(configs(spark, sf_dir))
    return s.select(
        "p_partkey", "type_inference", "note_pattern", "decimal_sep", "header_search_max_rows",
        F.size("null_markers").alias("null_markers"), "resolve_merged_cells",
    )


@query(
    "config_hash",
    f"SELECT p_partkey, left(sha256({CONFIG_JSON}), 16) AS config_hash FROM part",
)
def config_hash(spark, sf_dir):
    from .base import select

    docs = select(spark, sf_dir, "part", {"p_partkey": "p_partkey", "config_json": CONFIG_JSON})
    return docs.select("p_partkey", CFG.text_hash(F.col("config_json")).alias("config_hash"))
