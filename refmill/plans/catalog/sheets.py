"""Sheets laid out from the tables, read back as tables, and profiled."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators import extract as X
from ...operators import layout as L
from ...operators import merges as M
from ...session import stage
from ...sources.config import Settings
from .base import Cell, Grid, chunk_name, query, select

# --------------------------------------------------------------------------- one block per sheet
CUSTOMER_BOOK = chunk_name("customers_", "c_custkey", 100)
_ROW = "c_custkey % 100 + 3"
_FIRST = "c_custkey % 100 = 0"
CUSTOMERS = Grid(
    "customer",
    CUSTOMER_BOOK,
    "'Data'",
    [
        Cell("1", "1", "'Customer balances'", when=_FIRST),
        Cell("1", "2", "'Name'", when=_FIRST),
        Cell("2", "2", "concat('Balance [Note 1]', chr(10), 'cents')", when=_FIRST),
        Cell("3", "2", "'Segment'", when=_FIRST),
        Cell("4", "2", "'Segment '", when=_FIRST),
        Cell("6", "2", "'Key'", when=_FIRST),
        Cell("1", _ROW, "c_name"),
        Cell("2", _ROW, "CASE WHEN c_custkey % 11 = 0 THEN '[x]' ELSE CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS STRING) END"),
        Cell("3", _ROW, "concat(' ', c_mktsegment)", when="c_custkey % 3 <> 1"),
        Cell("4", _ROW, "concat('00', CAST(c_nationkey AS STRING))", when="c_custkey % 3 <> 2"),
        Cell("5", _ROW, "'no header here'"),
        Cell("6", _ROW, "CAST(c_custkey AS STRING)", kind="number"),
        Cell("1", "104", "'Source: office'", when=_FIRST),
        Cell("1", "106", "'left over'", when=_FIRST),
    ],
)
SIMPLE = {
    "sheet_name": "Data",
    "output_name": "balances",
    "table_type": "simple",
    "header_row": 2,
    "data_start_row": 3,
    "index_columns": ["Name"],
}


@query(
    "cells_to_table",
    f"""
    SELECT {CUSTOMER_BOOK} AS workbook, CAST({_ROW} AS INT) AS r, c_name AS "Name",
           CASE WHEN c_custkey % 11 <> 0 THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS "Balance cents",
           CASE WHEN c_custkey % 3 <> 1 THEN c_mktsegment END AS "Segment",
           CASE WHEN c_custkey % 3 <> 2 THEN concat('00', CAST(c_nationkey AS STRING)) END AS "Segment_2", c_custkey AS "Key"
    FROM customer
    """,
)
def cells_to_table(spark, sf_dir):
    """Headers cleaned and made unique, blank header skipped, columns typed, table end found."""
    t = X.extract_table(CUSTOMERS.staged(spark, sf_dir), SIMPLE, Settings(), provenance=True)
    return t.frame.drop("sheet", "block")


@query(
    "cells_to_records",
    f"""
    SELECT {CUSTOMER_BOOK} AS workbook, CAST({_ROW} AS INT) AS r, 'Segment_2' AS header, concat('00', CAST(c_nationkey AS STRING)) AS value FROM customer WHERE c_custkey % 3 <> 2
    UNION ALL SELECT {CUSTOMER_BOOK}, CAST({_ROW} AS INT), 'Segment', c_mktsegment FROM customer WHERE c_custkey % 3 <> 1
    UNION ALL SELECT {CUSTOMER_BOOK}, CAST({_ROW} AS INT), 'Name', c_name FROM customer
    UNION ALL SELECT {CUSTOMER_BOOK}, CAST({_ROW} AS INT), 'Key', CAST(c_custkey AS STRING) FROM customer
    UNION ALL SELECT {CUSTOMER_BOOK}, CAST({_ROW} AS INT), 'Balance cents',
              CASE WHEN c_custkey % 11 <> 0 THEN CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS STRING) END FROM customer
    """,
)
def cells_to_records(spark, sf_dir):
    """The long form alone: one plan, no driver round trip."""
    recs = X.records(CUSTOMERS.staged(spark, sf_dir), SIMPLE, Settings())
    return recs.select("workbook", "r", "header", "value")


EXPLICIT = {
    **SIMPLE,
    "columns": [{"col": "F", "name": "key"}, {"col": "B", "name": "cents"}, {"col": "E", "name": "note"}],
    "index_columns": ["key", "note"],
    "drop_columns": ["note"],
    "rename_columns": {"cents": "Balance"},
    "static_columns": {"edition": "2024"},
    "column_types": {"Balance": "float"},
    "data_end_row": 102,
}


@query(
    "explicit_columns",
    """
    SELECT c_custkey AS key, CAST(round(c_acctbal * 100) AS DOUBLE) AS "Balance", CAST(2024 AS BIGINT) AS edition
    FROM customer WHERE c_custkey % 11 <> 0
    """,
)
def explicit_columns(spark, sf_dir):
    """Named columns, payload test, and the whole post-processing chain."""
    return X.extract_table(CUSTOMERS.staged(spark, sf_dir), EXPLICIT, Settings()).frame


# --------------------------------------------------------------------------- end of table
NATION_ROWS = {
    "sheet": "concat('N', CAST(c_nationkey AS STRING))",
    "r": "CAST(c_custkey + 3 AS INT)",
    "data_start": "3",
    "footer": "c_acctbal < -999 AND c_mktsegment = 'MACHINERY'",
}


def _end_sql(gap: int) -> str:
    return f"""
    WITH s AS (SELECT {', '.join(f'{e} AS {n}' for n, e in NATION_ROWS.items())} FROM customer),
    g AS (SELECT *, coalesce(lag(r) OVER (PARTITION BY sheet ORDER BY r), data_start - 1) AS p FROM s),
    f AS (SELECT sheet, coalesce(min(p) FILTER (footer OR r - p - 1 >= {gap}), max(r)) AS end_row FROM g GROUP BY 1)
    SELECT sheet, CAST(end_row AS INT) AS end_row FROM f"""


@query("end_of_table", _end_sql(90))
def end_of_table(spark, sf_dir):
    """Twenty-five very long sheets: first run of 90 blank rows, or a footer."""
    rows = select(spark, sf_dir, "customer", NATION_ROWS)
    return L.end_rows(rows, 90, keys=["sheet"], width=256)


@query("end_of_table_first_blank", _end_sql(1))
def end_of_table_first_blank(spark, sf_dir):
    rows = select(spark, sf_dir, "customer", NATION_ROWS)
    return L.end_rows(rows, 0, keys=["sheet"])


# --------------------------------------------------------------------------- side by side
ORDER_BOOK = chunk_name("orders_", "o_orderkey", 1000)
_OROW = "o_orderkey % 1000 + 3"
_OFIRST = "o_orderkey % 1000 = 0"
_OPEN, _CLOSED = "o_orderstatus <> 'F'", "o_orderstatus <> 'O'"
ORDERS = Grid(
    "orders",
    ORDER_BOOK,
    "'Status'",
    [
        Cell("1", "1", "'Open'", when=_OFIRST),
        Cell("5", "1", "'Closed'", when=_OFIRST),
        *[Cell(c, "2", f"'{h}'", when=_OFIRST) for c, h in (("1", "Key"), ("2", "Total"), ("3", "Customer"))],
        *[Cell(c, "2", f"'{h}'", when=_OFIRST) for c, h in (("5", "Key"), ("6", "Total"), ("7", "Priority"))],
        Cell("1", _OROW, "CAST(o_orderkey AS STRING)", when=_OPEN),
        Cell("2", _OROW, "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)", when=_OPEN),
        Cell("3", _OROW, "CAST(o_custkey AS STRING)", when=f"{_OPEN} AND o_custkey % 4 <> 0"),
        Cell("5", _OROW, "CAST(o_orderkey AS STRING)", when=_CLOSED),
        Cell("6", _OROW, "CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING)", when=_CLOSED),
        Cell("7", _OROW, "o_orderpriority", when=_CLOSED),
    ],
)
SIDE_BY_SIDE = {
    "sheet_name": "Status",
    "output_name": "status",
    "table_type": "side_by_side",
    "header_row": 2,
    "data_start_row": 3,
    "data_end_row": 1002,
    "index_columns": ["Key"],
    "section_column_name": "Part",
    "sections": [
        {"name": "Open", "start_col": "A", "end_col": "C"},
        {"name": "Closed", "start_col": "E", "end_col": "G"},
    ],
}


@query(
    "side_by_side",
    """
    SELECT o_orderkey AS "Key", CAST(floor(o_totalprice) AS BIGINT) AS "Total",
           CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END AS "Customer", NULL::VARCHAR AS "Priority", 'Open' AS "Part"
    FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL
    SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT), NULL, o_orderpriority, 'Closed' FROM orders WHERE o_orderstatus <> 'O'
    """,
)
def side_by_side(spark, sf_dir):
    return X.extract_table(ORDERS.staged(spark, sf_dir), SIDE_BY_SIDE, Settings()).frame


@query(
    "side_by_side_unpivot",
    """
    WITH t AS (
      SELECT o_orderkey AS "Key", 'Open' AS "Part", CAST(floor(o_totalprice) AS BIGINT) AS "Total",
             CASE WHEN o_custkey % 4 <> 0 THEN o_custkey END AS "Customer", NULL AS "Priority" FROM orders WHERE o_orderstatus <> 'F'
      UNION ALL
      SELECT o_orderkey, 'Closed', CAST(floor(o_totalprice) AS BIGINT), NULL, o_orderpriority FROM orders WHERE o_orderstatus <> 'O')
    SELECT "Key", "Part", 'Total' AS "Variable", CAST("Total" AS VARCHAR) AS "Value" FROM t
    UNION ALL SELECT "Key", "Part", 'Customer', CAST("Customer" AS VARCHAR) FROM t WHERE "Customer" IS NOT NULL
    UNION ALL SELECT "Key", "Part", 'Priority', "Priority" FROM t WHERE "Priority" IS NOT NULL
    """,
)
def side_by_side_unpivot(spark, sf_dir):
    """The tidy form of the same sheets, forced over the config."""
    return X.extract_table(ORDERS.staged(spark, sf_dir), SIDE_BY_SIDE, Settings(), unpivot_mode="force_unpivot").frame


# --------------------------------------------------------------------------- stacked
_SROW = "s_suppkey % 6 + 203"
STACK_CUSTOMERS = Grid(
    "customer",
    chunk_name("stack_", "c_custkey", 100),
    "'Parties'",
    [
        Cell("1", "1", "'Table 1: customers'", when=_FIRST),
        *[Cell(c, "2", f"'{h}'", when=_FIRST) for c, h in (("1", "Name"), ("2", "Nation"), ("3", "Segment"))],
        Cell("1", _ROW, "c_name"),
        Cell("2", _ROW, "CAST(c_nationkey AS STRING)", kind="number"),
        Cell("3", _ROW, "c_mktsegment"),
    ],
)
STACK_SUPPLIERS = Grid(
    "supplier",
    chunk_name("stack_", "s_suppkey", 6),
    "'Parties'",
    [
        Cell("1", "201", "'Table 2: suppliers'", when="s_suppkey % 6 = 0"),
        *[Cell(c, "202", f"'{h}'", when="s_suppkey % 6 = 0") for c, h in (("1", "Name"), ("2", "Nation"), ("3", "Cents"))],
        Cell("1", _SROW, "s_name"),
        Cell("2", _SROW, "CAST(s_nationkey AS STRING)", kind="number"),
        Cell("3", _SROW, "CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS STRING)", kind="number"),
    ],
)
STACKED = {
    "sheet_name": "Parties",
    "output_name": "parties",
    "table_type": "stacked",
    "index_columns": ["Name"],
    "tables": [
        {"name": "customers", "header_row": 2, "data_start_row": 3, "static_columns": {"party": "c", "edition": "7"}},
        {"name": "suppliers", "header_row": 202, "data_start_row": 203, "data_end_row": 300, "static_columns": {"party": "s"}},
    ],
}


@query(
    "stacked",
    """
    SELECT c_name AS "Name", CAST(c_nationkey AS BIGINT) AS "Nation", c_mktsegment AS "Segment", NULL::BIGINT AS "Cents", 'c' AS party, CAST(7 AS BIGINT) AS edition FROM customer
    UNION ALL SELECT s_name, s_nationkey, NULL, CAST(round(s_acctbal * 100) AS BIGINT), 's', NULL FROM supplier
    """,
)
def stacked(spark, sf_dir):
    cells = stage(STACK_CUSTOMERS.spark(spark, sf_dir).unionByName(STACK_SUPPLIERS.spark(spark, sf_dir)))
    return X.extract_table(cells, STACKED, Settings()).frame


# --------------------------------------------------------------------------- merged ranges and header rows
_MROW = "(c_custkey % 1000) * 3 + 1"
MERGE_CELLS = Grid(
    "customer",
    "'merged'",
    chunk_name("S", "c_custkey", 1000),
    [
        Cell("1", _MROW, "c_name", when="c_custkey % 5 <> 4"),
        Cell("2", f"{_MROW} + 1", "'own value'", when="c_custkey % 2 = 0"),
    ],
)
MERGE_RANGES = {
    "workbook": "'merged'",
    "sheet": chunk_name("S", "c_custkey", 1000),
    "min_r": f"CAST({_MROW} AS INT)",
    "min_c": "1",
    "max_r": f"CAST({_MROW} + 2 AS INT)",
    "max_c": "CAST(2 + c_custkey % 3 AS INT)",
}


@query(
    "merge_fill",
    f"""
    WITH c AS ({MERGE_CELLS.sql()}),
    m AS (SELECT {', '.join(f'{e} AS {n}' for n, e in MERGE_RANGES.items())} FROM customer),
    a AS (SELECT m.*, c.value FROM m JOIN c ON c.sheet = m.sheet AND c.r = m.min_r AND c.c = m.min_c),
    x AS (SELECT a.sheet, r.r AS r, k.k AS c, a.value FROM a
          CROSS JOIN range(0, 3000) r(r) CROSS JOIN range(1, 5) k(k)
          WHERE r.r BETWEEN a.min_r AND a.max_r AND k.k BETWEEN a.min_c AND a.max_c)
    SELECT sheet, r, c, value, 'cell' AS origin FROM c
    UNION ALL
    SELECT sheet, CAST(r AS INT), CAST(c AS INT), value, 'merge' FROM x
    WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.sheet = x.sheet AND c.r = x.r AND c.c = x.c)
    """,
)
def merge_fill(spark, sf_dir):
    cells = MERGE_CELLS.staged(spark, sf_dir)
    ranges = select(spark, sf_dir, "customer", MERGE_RANGES)
    return M.fill_merged(cells, ranges).select("sheet", "r", "c", "value", "origin")


PART_BOOK = chunk_name("parts_", "p_partkey", 50)
PART_HEADERS = Grid(
    "part",
    PART_BOOK,
    "'H'",
    [
        Cell("p_partkey % 50 + 1", "1", "p_type", when="p_partkey % 4 <> 2"),
        Cell("p_partkey % 50 + 1", "2", "CASE WHEN p_partkey % 3 = 0 THEN concat(' ', p_type) ELSE p_name END"),
        Cell("p_partkey % 50 + 1", "3", "concat(p_brand, ' [note 7]')"),
        Cell("p_partkey % 50 + 1", "4", "CAST(p_size AS STRING)"),
    ],
)


@query(
    "multi_row_header",
    f"""
    WITH p AS (SELECT {PART_BOOK} AS workbook, CAST(p_partkey % 50 + 1 AS INT) AS c,
      CASE WHEN p_partkey % 4 <> 2 THEN p_type END AS a, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_name END AS b, p_brand AS d FROM part),
    l AS (SELECT workbook, c, concat_ws(' | ', a, CASE WHEN a IS NULL OR a <> b THEN b END, d) AS header FROM p),
    n AS (SELECT *, row_number() OVER (PARTITION BY workbook, header ORDER BY c) AS k FROM l)
    SELECT workbook, c, CASE WHEN k > 1 THEN concat(header, '_', CAST(k AS STRING)) ELSE header END AS header FROM n
    """,
)
def multi_row_header(spark, sf_dir):
    """Three header rows folded into one label per column, equal neighbours once."""
    sheet = {**SIMPLE, "sheet_name": "H", "header_row": None, "header_rows": [1, 2, 3], "data_start_row": 4}
    labels = L.header_labels(PART_HEADERS.staged(spark, sf_dir), L.blocks_of(sheet), Settings())
    return labels.select("workbook", "c", "header")


@query(
    "table_width",
    f"""
    SELECT workbook, CAST(max(c) AS INT) AS last_col FROM ({PART_HEADERS.sql()}) WHERE r = 1 GROUP BY 1
    """,
)
def table_width(spark, sf_dir):
    sheet = {**SIMPLE, "sheet_name": "H", "header_row": 1, "data_start_row": 4}
    widths = L.block_widths(PART_HEADERS.staged(spark, sf_dir), L.blocks_of(sheet), Settings())
    return widths.select("workbook", "last_col")


@query(
    "sheet_presence",
    f"""
    WITH want AS (SELECT DISTINCT {CUSTOMER_BOOK} AS workbook, unnest(['Data', 'Summary']) AS sheet FROM customer)
    SELECT workbook, sheet FROM want WHERE sheet <> 'Data'
    """,
)
def sheet_presence(spark, sf_dir):
    """Configured sheets that a workbook does not have."""
    from ...operators.constraints import missing_names

    cells = CUSTOMERS.staged(spark, sf_dir)
    present = cells.select("workbook", "sheet").distinct()
    wanted = present.select("workbook").distinct().select("workbook", F.explode(F.array(F.lit("Data"), F.lit("Summary"))).alias("sheet"))
    return missing_names(wanted, present, ["workbook", "sheet"])
