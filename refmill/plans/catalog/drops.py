"""File-drop inventory queries; one file per row of ``orders``."""

from __future__ import annotations

from ...operators import inventory as I
from .base import query, select, select_sql

DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
YMD = f"replace({DAY}, '-', '')"
DMY = f"concat(substr({DAY}, 9, 2), substr({DAY}, 6, 2), substr({DAY}, 1, 4))"
ROOT = "concat(CASE WHEN o_custkey % 7 = 0 THEN '/drive/Other-' ELSE '/drive/DataDrop-' END, substr(o_orderpriority, 1, 1))"
KEYWORD = "datadrop"

FILES = {
    "folder": f"CASE WHEN o_orderkey % 6 = 2 THEN concat({ROOT}, '/', {YMD}) ELSE {ROOT} END",
    "name": f"""CASE WHEN o_orderkey % 11 = 6 THEN concat('NG_', substr({DAY}, 1, 4), '9999_', {YMD}, '.psv')
                WHEN o_orderkey % 11 = 7 THEN concat('NG_99992099_', {DMY}, '.psv') ELSE
                CASE o_orderkey % 6 WHEN 0 THEN concat('NG_Output_', {YMD}, '.psv') WHEN 1 THEN concat('NG-x_', {DMY}, '.psv')
                WHEN 2 THEN 'NG_x.psv' WHEN 3 THEN 'NG_part_12345678.psv' WHEN 4 THEN concat('XNG_', {YMD})
                ELSE concat('NG_', substr({DAY}, 1, 4), '1399_', {DMY}) END END""",
    "bytes": "CAST(floor(o_totalprice * 1000) AS BIGINT)",
    "modified_at": "CAST(o_orderdate AS DATE) + CAST(o_custkey % 400 AS INT)",
}
FILES_SQL = select_sql("orders", FILES)


def _first_day(text: str, groups: str, form: str) -> str:
    """The first run of eight digits of a form that is a date; runs are set apart by two marks, as each match takes one on either side."""
    runs = f"regexp_extract_all(regexp_replace(concat('_', {text}, '_'), '[^0-9]+', '__', 'g'), '_({groups})_', 1)"
    return f"list_filter(list_transform({runs}, lambda g: CAST(try_strptime(g, '{form}') AS DATE)), lambda d: d IS NOT NULL)[1]"


_YMD_RE, _DMY_RE = "(?:19|20|21)[0-9]{6}", "[0-9]{4}(?:19|20|21)[0-9]{2}"
DATED_SQL = f"""
  SELECT *, coalesce(d1, d2, d3) AS file_day,
         CASE WHEN d1 IS NOT NULL THEN 'FN_YYYYMMDD' WHEN d2 IS NOT NULL THEN 'FN_DDMMYYYY'
              WHEN d3 IS NOT NULL THEN 'FolderName' ELSE 'None' END AS method
  FROM (SELECT *,
          {_first_day("name", _YMD_RE, "%Y%m%d")} AS d1,
          {_first_day("name", _DMY_RE, "%d%m%Y")} AS d2,
          {_first_day("split_part(folder, '/', -1)", _YMD_RE, "%Y%m%d")} AS d3
        FROM ({FILES_SQL}) WHERE regexp_matches(name, '^NG[_-]') AND contains(lower(folder), '{KEYWORD}'))
"""
DAYS_SQL = f"SELECT folder, file_day, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM ({DATED_SQL}) WHERE file_day IS NOT NULL GROUP BY ALL"


def files(spark, sf_dir):
    return select(spark, sf_dir, "orders", FILES, wide_work=True)


def dated(spark, sf_dir):
    return I.dated_files(I.matching_files(files(spark, sf_dir), KEYWORD))


def days(spark, sf_dir):
    return I.per_day(dated(spark, sf_dir))


@query(
    "inventory_rollup",
    f"""
    SELECT folder, year, month, day, CAST(sum(files) AS BIGINT) AS files, round(sum(bytes) / 1048576.0, 2) AS size_mb,
           CASE GROUPING(folder, year, month, day) WHEN 0 THEN 'day' WHEN 1 THEN 'month' WHEN 3 THEN 'year' WHEN 7 THEN 'folder' ELSE 'total' END AS level
    FROM (SELECT folder, CAST(year(file_day) AS INT) AS year, CAST(month(file_day) AS INT) AS month, CAST(day(file_day) AS INT) AS day, files, CAST(bytes AS DOUBLE) AS bytes FROM ({DAYS_SQL}))
    GROUP BY ROLLUP (folder, year, month, day)
    """,
)
def inventory_rollup(spark, sf_dir):
    return I.rollup(days(spark, sf_dir))


@query("inventory_date_methods", f"SELECT method, count(*) AS files FROM ({DATED_SQL}) GROUP BY 1")
def inventory_date_methods(spark, sf_dir):
    return I.method_counts(dated(spark, sf_dir))


@query(
    "inventory_year_compare",
    f"""
    WITH d AS ({DATED_SQL}),
    f AS (SELECT CAST(year(file_day) AS INT) AS year, count(*) AS n, sum(bytes) AS b FROM d WHERE file_day IS NOT NULL GROUP BY 1),
    m AS (SELECT CAST(year(modified_at) AS INT) AS year, count(*) AS n, sum(bytes) AS b FROM d GROUP BY 1)
    SELECT year, coalesce(f.n, 0) AS fn_count, round(CAST(coalesce(f.b, 0) AS DOUBLE) / 1048576.0, 2) AS fn_size_mb,
           coalesce(m.n, 0) AS md_count, round(CAST(coalesce(m.b, 0) AS DOUBLE) / 1048576.0, 2) AS md_size_mb
    FROM f FULL JOIN m USING (year)
    """,
)
def inventory_year_compare(spark, sf_dir):
    return I.year_compare(dated(spark, sf_dir))


@query(
    "inventory_folder_counts",
    f"""
    WITH a AS (SELECT DISTINCT folder FROM ({FILES_SQL})),
    n AS (SELECT folder, count(*) AS files FROM ({DATED_SQL}) GROUP BY 1)
    SELECT folder, coalesce(files, 0) AS files FROM a LEFT JOIN n USING (folder)
    """,
)
def inventory_folder_counts(spark, sf_dir):
    return I.folder_counts(files(spark, sf_dir), KEYWORD)


@query(
    "inventory_totals",
    f"SELECT (SELECT count(DISTINCT folder) FROM ({FILES_SQL})) AS folders_found, (SELECT count(*) FROM ({DATED_SQL})) AS files_matched",
)
def inventory_totals(spark, sf_dir):
    return I.report_totals(I.folder_counts(files(spark, sf_dir), KEYWORD))


@query(
    "inventory_detail",
    f"""
    WITH a AS (SELECT DISTINCT folder FROM ({FILES_SQL})),
    p AS (SELECT folder, CAST(year(file_day) AS INT) AS year, CAST(month(file_day) AS INT) AS month, CAST(day(file_day) AS INT) AS day, files, CAST(bytes AS DOUBLE) AS bytes FROM ({DAYS_SQL})),
    l AS (SELECT folder, NULL::INT AS year, NULL::INT AS month, NULL::INT AS day, sum(files) AS files, sum(bytes) AS b, 'folder' AS level FROM p GROUP BY folder
          UNION ALL SELECT folder, year, NULL, NULL, sum(files), sum(bytes), 'year' FROM p GROUP BY folder, year
          UNION ALL SELECT folder, year, month, NULL, sum(files), sum(bytes), 'month' FROM p GROUP BY folder, year, month
          UNION ALL SELECT folder, year, month, day, sum(files), sum(bytes), 'day' FROM p GROUP BY folder, year, month, day)
    SELECT a.folder, year, month, day, CAST(coalesce(files, 0) AS BIGINT) AS files, round(b / 1048576.0, 2) AS size_mb, level
    FROM a LEFT JOIN l ON l.folder = a.folder
    """,
)
def inventory_detail(spark, sf_dir):
    """Year, month and day lines per folder, empty folders included."""
    return I.detail_report(files(spark, sf_dir), days(spark, sf_dir))


@query(
    "missing_days",
    f"""
    WITH d AS ({DAYS_SQL}), m AS (SELECT DISTINCT folder, date_trunc('month', file_day) AS m FROM d),
    c AS (SELECT folder, CAST(unnest(generate_series(m::TIMESTAMP, m::TIMESTAMP + INTERVAL 1 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM m)
    SELECT folder, CAST(year(day) AS INT) AS year, CAST(month(day) AS INT) AS month, CAST(day(day) AS INT) AS missing_day
    FROM c WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.folder = c.folder AND d.file_day = c.day)
    """,
)
def missing_days(spark, sf_dir):
    return I.missing_days(days(spark, sf_dir))


@query(
    "missing_months",
    f"""
    WITH d AS (SELECT DISTINCT folder, year(file_day) AS y, month(file_day) AS m FROM ({DAYS_SQL})),
    c AS (SELECT DISTINCT folder, y, unnest(range(1, 13)) AS m FROM d)
    SELECT folder, CAST(y AS INT) AS year, CAST(m AS INT) AS missing_month FROM c
    WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.folder = c.folder AND d.y = c.y AND d.m = c.m)
    """,
)
def missing_months(spark, sf_dir):
    return I.missing_months(days(spark, sf_dir))
