"""Header and value cleaning, number parsing, column typing, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import text as X
from ...operators import layout as L
from ...operators import ordered as O
from ...operators import reshape as R
from ...operators import typing as TY
from .base import chunk, query, select, select_sql, table

HEADERS = {
    "p_partkey": "p_partkey",
    "raw": """CASE p_partkey % 6 WHEN 0 THEN concat('  ', p_name, ' ') WHEN 1 THEN concat(p_name, chr(10), ' ', p_type, ' [Note ', CAST(p_size AS STRING), ']')
              WHEN 2 THEN '[note 3]' WHEN 3 THEN '   ' WHEN 4 THEN concat(p_brand, ' [Note x]  ', p_name) ELSE concat(p_name, chr(9), chr(9), '(', p_brand, ')') END""",
}
CLEAN_HEADER = "nullif(trim(regexp_replace(regexp_replace(trim(raw, ' ' || chr(9) || chr(10)), '\\[[Nn]ote\\s*\\d+\\]', '', 'g'), '\\s+', ' ', 'g')), '')"


@query("clean_headers", f"SELECT p_partkey, {CLEAN_HEADER} AS header FROM ({select_sql('part', HEADERS)})")
def clean_headers(spark, sf_dir):
    return select(spark, sf_dir, "part", HEADERS, wide_work=True).select("p_partkey", X.clean_header(F.col("raw")).alias("header"))


@query(
    "dedupe_headers",
    """
    WITH h AS (SELECT floor(p_partkey / 200) AS sheet, p_partkey, p_name FROM part),
    n AS (SELECT *, row_number() OVER (PARTITION BY sheet, p_name ORDER BY p_partkey) AS k FROM h)
    SELECT p_partkey, CASE WHEN k > 1 THEN concat(p_name, '_', CAST(k AS STRING)) ELSE p_name END AS header FROM n
    """,
)
def dedupe_headers(spark, sf_dir):
    """Labels of sheets that are 200 columns wide, made unique per sheet."""
    parts = select(spark, sf_dir, "part", {"sheet": chunk("p_partkey", 200), "p_partkey": "p_partkey", "p_name": "p_name"})
    listed = parts.select(
        F.lit("b").alias("workbook"), F.col("sheet").cast("string").alias("sheet"), F.lit(0).alias("block"),
        F.col("p_partkey").alias("c"), F.col("p_name").alias("header"),
    )
    return L.number_repeats(listed).select(F.col("c").alias("p_partkey"), "header")


@query(
    "occurrence_numbers",
    "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS nth FROM orders",
)
def occurrence_numbers(spark, sf_dir):
    """Exact numbering within a few very large groups, without one task per group."""
    orders = select(spark, sf_dir, "orders", {"o_orderkey": "o_orderkey", "o_orderpriority": "o_orderpriority"})
    return O.occurrence_number(orders, ["o_orderpriority"], "o_orderkey", "nth", width=4096).select("o_orderkey", "nth")


VALUES = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "quantity": "CASE l_partkey % 5 WHEN 0 THEN '[x]' WHEN 1 THEN ' .. ' ELSE concat(' ', CAST(CAST(l_quantity AS INT) AS STRING)) END",
    "flag": "CASE l_suppkey % 4 WHEN 0 THEN '[c]' WHEN 1 THEN '-' WHEN 2 THEN '   ' ELSE l_returnflag END",
    "status": "CASE WHEN l_suppkey % 3 = 0 THEN concat(l_linestatus, ' ') WHEN l_suppkey % 3 = 1 THEN '[z]' END",
}
VALUES_SQL = select_sql("lineitem", VALUES)
CLEANED_SQL = "SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(
    f"CASE WHEN trim({c}) NOT IN ('[x]','[c]','[z]','..','') THEN trim({c}) END AS {c}" for c in ("quantity", "flag", "status")
) + f" FROM ({VALUES_SQL})"


def cleaned(spark, sf_dir):
    df = select(spark, sf_dir, "lineitem", VALUES, wide_work=True)
    return df.withColumns({c: X.clean_value(F.col(c)) for c in ("quantity", "flag", "status")})


@query("clean_values", CLEANED_SQL)
def clean_values(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query("payload_filter", f"SELECT * FROM ({CLEANED_SQL}) WHERE coalesce(quantity, status) IS NOT NULL")
def payload_filter(spark, sf_dir):
    """Rows with a value outside the index columns (here the keys and the flag)."""
    return R.keep_payload(cleaned(spark, sf_dir), ["l_orderkey", "l_linenumber", "l_partkey", "flag"])


# Two engines print doubles differently, so the texts are put together from whole numbers.
NUMBERS = {
    "o_orderkey": "o_orderkey",
    "raw": """CASE o_orderkey % 12
        WHEN 0 THEN CAST(o_custkey AS STRING)
        WHEN 1 THEN concat(' ', CAST(o_custkey + 1 AS STRING), ',', substr(CAST(1000 + o_orderkey % 1000 AS STRING), 2, 3), ' ')
        WHEN 2 THEN concat('0', CAST(o_custkey AS STRING))
        WHEN 3 THEN concat('-', CAST(o_custkey AS STRING), '.5')
        WHEN 4 THEN concat(CAST(o_custkey % 9 + 1 AS STRING), 'e', CAST(o_orderkey % 5 AS STRING))
        WHEN 5 THEN concat(CAST(o_custkey AS STRING), '.')
        WHEN 6 THEN concat('$', CAST(o_custkey AS STRING))
        WHEN 7 THEN concat(CAST(o_custkey AS STRING), '%')
        WHEN 8 THEN concat(CAST(o_custkey AS STRING), 'd')
        WHEN 9 THEN concat('.', CAST(o_custkey AS STRING))
        WHEN 10 THEN concat('+00', CAST(o_custkey AS STRING))
        ELSE concat(CAST(o_custkey + 100 AS STRING), '12345678901234567') END""",
}
NUMBERS_SQL = select_sql("orders", NUMBERS)
_NUM = "CASE WHEN NOT regexp_full_match(trim(raw), '0[0-9]+') AND regexp_full_match(replace(trim(raw), ',', ''), '[+-]?[0-9]*\\.?[0-9]+([eE][+-]?[0-9]+)?') THEN replace(trim(raw), ',', '') END"
_WHOLE = "NOT contains(n, '.') AND NOT contains(n, 'e')"


@query(
    "parse_numbers",
    f"""
    SELECT o_orderkey, n AS number_text, TRY_CAST(n AS DOUBLE) AS as_double,
           CASE WHEN {_WHOLE} THEN TRY_CAST(n AS BIGINT)
                WHEN TRY_CAST(n AS DOUBLE) = floor(TRY_CAST(n AS DOUBLE)) THEN TRY_CAST(TRY_CAST(n AS DOUBLE) AS BIGINT) END AS as_bigint
    FROM (SELECT o_orderkey, {_NUM} AS n FROM ({NUMBERS_SQL}))
    """,
)
def parse_numbers(spark, sf_dir):
    n = select(spark, sf_dir, "orders", NUMBERS, wide_work=True).select("o_orderkey", X.number_text(F.col("raw")).alias("n"))
    return n.select(
        "o_orderkey",
        F.col("n").alias("number_text"),
        X.number_double(F.col("n")).alias("as_double"),
        X.number_bigint(F.col("n")).alias("as_bigint"),
    )


@query(
    "parse_numbers_locale",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey AS DOUBLE) * 1000 + l_partkey % 1000 + 0.5 AS amount
    FROM lineitem
    """,
)
def parse_numbers_locale(spark, sf_dir):
    """``1.234,5`` with dot thousands and decimal comma."""
    raw = "concat(CAST(l_suppkey AS STRING), '.', substr(CAST(1000 + l_partkey % 1000 AS STRING), 2, 3), ',5')"
    raw = f"CASE WHEN l_suppkey = 0 THEN concat(CAST(l_partkey % 1000 AS STRING), ',5') ELSE {raw} END"
    df = select(
        spark, sf_dir, "lineitem",
        {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "l_partkey": "l_partkey", "raw": raw},
    )
    amount = X.number_double(X.number_text(F.col("raw"), thousands=".", decimal=","))
    return df.select("l_orderkey", "l_linenumber", "l_partkey", amount.alias("amount"))


# --------------------------------------------------------------------------- column typing
TYPED = {
    "key": "CAST(o_orderkey AS STRING)",
    "code": "concat('0', CAST(o_custkey AS STRING))",
    "grouped": "concat(CAST(o_custkey + 1 AS STRING), ',000')",
    "half": "CASE WHEN o_orderkey % 2 = 0 THEN concat(CAST(o_custkey AS STRING), '.5') ELSE CAST(o_custkey AS STRING) END",
    "whole": "CASE WHEN o_orderkey % 3 = 0 THEN concat(CAST(o_custkey AS STRING), '.0') WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey AS STRING) END",
    "mixed": "CASE WHEN o_custkey % 100 = 7 THEN o_orderstatus ELSE CAST(o_custkey AS STRING) END",
    "big": "concat('9', CAST(o_orderkey + 1000000 AS STRING), '000000000000000')",
    "empty": "CAST(NULL AS STRING)",
}
TYPED_SQL = select_sql("orders", TYPED)
_OVERRIDES = {"grouped": "string", "half": "float", "whole": "keep", "mixed": "int"}


def as_cells(df):
    """Plain text columns as ``{value, kind}`` cells."""
    return df.select(
        *[F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("value"), F.lit("string").alias("kind"))).alias(c) for c in df.columns]
    )


def _type_case(mode: str, overrides: dict[str, str]) -> str:
    rows = []
    for c in TYPED:
        t = c
        num = f"CASE WHEN NOT regexp_full_match({t}, '0[0-9]+') AND regexp_full_match(replace({t}, ',', ''), '[+-]?[0-9]*\\.?[0-9]+') THEN replace({t}, ',', '') END"
        rows.append(
            f"""SELECT '{c}' AS name, count({t}) AS filled, count({num}) AS parsed,
                count(*) FILTER (TRY_CAST({num} AS DOUBLE) = floor(TRY_CAST({num} AS DOUBLE)) AND TRY_CAST({num} AS DOUBLE) < 9.2e18) AS parsed_whole,
                count(*) FILTER (NOT contains({num}, '.') AND TRY_CAST({num} AS BIGINT) IS NULL) AS parsed_big,
                {f"'{overrides[c]}'" if c in overrides else "NULL::VARCHAR"} AS override FROM t"""
        )
    return f"""
    WITH t AS ({TYPED_SQL}), n AS ({' UNION ALL '.join(rows)})
    SELECT name, filled, parsed, parsed_whole,
      CASE WHEN filled = 0 OR override IN ('string', 'keep') OR (override IS NULL AND '{mode}' = 'none') THEN 'string'
           WHEN override = 'float' THEN CASE WHEN parsed = filled THEN 'double' ELSE 'string' END
           WHEN parsed < filled OR parsed_big > 0 THEN 'string'
           WHEN parsed_whole = filled THEN 'bigint' ELSE 'double' END AS type
    FROM n"""


def _plan(spark, sf_dir, mode, overrides):
    wide = as_cells(select(spark, sf_dir, "orders", TYPED, wide_work=True))
    return TY.type_plan(wide, wide.columns, mode, overrides).select("name", "filled", "parsed", "parsed_whole", "type")


@query("typed_column_plan", _type_case("safe", {}))
def typed_column_plan(spark, sf_dir):
    return _plan(spark, sf_dir, "safe", {})


@query("typed_column_plan_none", _type_case("none", {}))
def typed_column_plan_none(spark, sf_dir):
    return _plan(spark, sf_dir, "none", {})


@query("typed_column_plan_overrides", _type_case("safe", _OVERRIDES))
def typed_column_plan_overrides(spark, sf_dir):
    return _plan(spark, sf_dir, "safe", _OVERRIDES)


@query(
    "typed_columns",
    f"""
    SELECT CAST(key AS BIGINT) AS key, code, CAST(replace(grouped, ',', '') AS BIGINT) AS grouped, CAST(half AS DOUBLE) AS half,
           CAST(CAST(whole AS DOUBLE) AS BIGINT) AS whole, mixed, big, empty FROM ({TYPED_SQL})
    """,
)
def typed_columns(spark, sf_dir):
    """Columns projected to the types that the plan of the same data decides."""
    wide = as_cells(select(spark, sf_dir, "orders", TYPED, wide_work=True))
    plan = {p["name"]: p["type"] for p in TY.type_plan(wide, wide.columns, "safe", {}).collect()}
    return TY.apply_types(wide, plan, "safe", {})


@query(
    "typed_columns_aggressive",
    f"""
    SELECT CAST(key AS BIGINT) AS key, code, grouped, CAST(half AS DOUBLE) AS half, whole,
           CASE WHEN mixed IN ('F', 'O', 'P') THEN mixed ELSE CAST(CAST(mixed AS BIGINT) AS STRING) END AS mixed, big, empty FROM ({TYPED_SQL})
    """,
)
def typed_columns_aggressive(spark, sf_dir):
    wide = as_cells(select(spark, sf_dir, "orders", TYPED, wide_work=True))
    plan = {p["name"]: p["type"] for p in TY.type_plan(wide, wide.columns, "aggressive", _OVERRIDES).collect()}
    return TY.apply_types(wide, plan, "aggressive", _OVERRIDES)


# --------------------------------------------------------------------------- reshape
@query(
    "unpivot_measures",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, Variable, Value FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
             CASE WHEN l_discount > 0 THEN l_discount END AS l_discount, l_tax FROM lineitem)
    UNPIVOT (Value FOR Variable IN (l_quantity, l_extendedprice, l_discount, l_tax))
    """,
)
def unpivot_measures(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("l_discount"), "l_tax",
    )
    return R.unpivot(df, ["l_orderkey", "l_linenumber", "l_partkey", "not_there"])


@query(
    "unpivot_mixed",
    """
    SELECT p_partkey, p_brand, attribute, content FROM (
      SELECT p_partkey, p_brand, p_name, CAST(p_size AS VARCHAR) AS p_size, p_type FROM part)
    UNPIVOT (content FOR attribute IN (p_name, p_size, p_type))
    """,
)
def unpivot_mixed(spark, sf_dir):
    """Value columns of several types become text; one excluded column stays an id."""
    df = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size", "p_type")
    return R.unpivot(df, ["p_partkey"], exclude=["p_brand"], var_name="attribute", value_name="content")


@query(
    "rename_drop_constant",
    """
    SELECT p_partkey AS "Part key", p_name AS "Name", p_type AS "Kind of part", 'catalogue' AS source FROM part
    """,
)
def rename_drop_constant(spark, sf_dir):
    """Drop by name and by star, rename with loose white space, add a constant."""
    df = table(spark, sf_dir, "part").withColumnsRenamed({"p_partkey": "Part\n key", "p_type": "Kind  of part"})
    df = R.drop_columns(df, ["p_brand", "*size*", "*price"])
    df = R.rename_columns(df, {"Part key": "Part key", "p_name": "Name", "Kind of  part": "Kind of part"})
    return R.add_constants(df, {"source": "catalogue"})


@query(
    "union_missing_columns",
    """
    SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, NULL::BIGINT AS key FROM customer
    UNION ALL BY NAME SELECT s_name AS name, s_acctbal AS balance, s_suppkey AS key FROM supplier
    """,
)
def union_missing_columns(spark, sf_dir):
    customers = select(spark, sf_dir, "customer", {"name": "c_name", "balance": "c_acctbal", "segment": "c_mktsegment"})
    suppliers = select(spark, sf_dir, "supplier", {"name": "s_name", "balance": "s_acctbal", "key": "s_suppkey"})
    return R.union_by_name([customers, suppliers])


def _profile_sql(name: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{t}' AS data_type, count(*) AS rows, count(*) - count({c}) AS nulls FROM {name}"
        for c, t in columns.items()
    )


_ORDERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}
_EVENTS = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


@query("table_profile", _profile_sql("orders", _ORDERS) + " UNION ALL " + _profile_sql("events", _EVENTS))
def table_profile(spark, sf_dir):
    frames = [TY.table_profile(table(spark, sf_dir, n), n) for n in ("orders", "events")]
    return R.union_by_name(frames)


@query(
    "all_null_columns",
    "SELECT 'empty' AS column_name, 'string' AS data_type, count(*) AS rows, count(*) AS nulls FROM orders",
)
def all_null_columns(spark, sf_dir):
    return TY.all_null_columns(TY.table_profile(select(spark, sf_dir, "orders", TYPED, wide_work=True)))


@query(
    "column_letters",
    """
    WITH n AS (SELECT p_partkey, CAST(p_partkey % 16384 AS INT) + 1 AS i FROM part),
    t AS (SELECT *, CAST(floor((i - 1) / 26) AS INT) AS a, CAST(floor((floor((i - 1) / 26) - 1) / 26) AS INT) AS b FROM n)
    SELECT p_partkey, concat(CASE WHEN b > 0 THEN chr(64 + b) ELSE '' END, CASE WHEN a > 0 THEN chr(65 + (a - 1) % 26) ELSE '' END, chr(65 + (i - 1) % 26)) AS letters, i AS index FROM t
    """,
)
def column_letters(spark, sf_dir):
    """Index → letters → index."""
    df = select(spark, sf_dir, "part", {"p_partkey": "p_partkey", "i": "CAST(p_partkey % 16384 AS INT) + 1"})
    df = df.withColumn("letters", X.column_letters(F.col("i")))
    return df.select("p_partkey", "letters", X.column_index(F.col("letters")).alias("index"))
