import random

import pytest
from celltables import CELLS, tuples
from pyspark.sql import functions as F

from refmill.operators import extract as E
from refmill.operators import layout as L
from refmill.operators import merges as M
from refmill.operators import ordered as O
from refmill.operators import profiling as P
from refmill.operators import reshape as R
from refmill.operators import typing as TY
from refmill.sources.config import Settings

MERGES = "workbook string, sheet string, min_r int, min_c int, max_r int, max_c int"
SIMPLE = [
    ["Title"],
    ["Year", "Sales [Note 1]", "Sales", "Code"],
    ["2020", "1,200", "7", "007"],
    ["2021", "[x]", "8", "008"],
    ["2022"],
    [],
    ["Source: office"],
]
SIDE = [
    ["Road", None, None, "Rail"],
    ["Year", "Gas", "Oil", "Year", "Gas", "Coal"],
    ["2020", "1", "2", "2020", "5", "6"],
    ["2021", "3", None, "2021", "7", "8"],
]
STACK = [["Table 1: households"], ["Region", "N"], ["North", "4"], [], ["Table 2: businesses"], ["Region", "N"], ["South", "9"]]


def config(**extra):
    return {"sheet_name": "s", "output_name": "o", "table_type": "simple", "header_row": 2, "data_start_row": 3, **extra}


def run(cells, cfg, settings=Settings(), **kw):
    return E.extract_table(cells, cfg, settings, **kw)


def test_simple_sheet(grid):
    t = run(grid({"s": SIMPLE}), config(index_columns=["Year"]))
    assert t.frame.dtypes == [("Year", "bigint"), ("Sales", "bigint"), ("Sales_2", "bigint"), ("Code", "string")]
    assert tuples(t.frame) == [(2020, 1200, 7, "007"), (2021, None, 8, "008")]


def test_simple_sheet_without_index_keeps_filled_rows(grid):
    t = run(grid({"s": SIMPLE}), config())
    assert tuples(t.frame, "Year") == [(2020,), (2021,), (2022,)]


def test_blank_rows_on_request(grid):
    lines = [[], ["a", "b"], ["1", "2"], [" ", "[x]"], ["3", None]]
    assert run(grid({"s": lines}), config()).frame.count() == 2
    assert run(grid({"s": lines}), config(), keep_blank_rows=True).frame.count() == 3


SIDE_CONFIG = dict(
    table_type="side_by_side",
    index_columns=["Year"],
    section_column_name="Industry_sector",
    sections=[{"name": "Road", "start_col": "A", "end_col": "C"}, {"name": "Rail", "start_col": "D", "end_col": "F"}],
)


def test_side_by_side(grid):
    t = run(grid({"s": SIDE}), config(**SIDE_CONFIG))
    assert t.columns == ("Year", "Gas", "Oil", "Industry_sector", "Coal")
    rows = tuples(t.frame, "Year", "Gas", "Oil", "Industry_sector", "Coal")
    assert rows == [(2020, 1, 2, "Road", None), (2020, 5, None, "Rail", 6), (2021, 3, None, "Road", None), (2021, 7, None, "Rail", 8)]


def test_side_by_side_tidy(grid):
    t = run(grid({"s": SIDE}), config(**SIDE_CONFIG), unpivot_mode="force_unpivot")
    assert tuples(t.frame) == [
        (2020, "Rail", "Coal", 6), (2020, "Rail", "Gas", 5), (2020, "Road", "Gas", 1), (2020, "Road", "Oil", 2),
        (2021, "Rail", "Coal", 8), (2021, "Rail", "Gas", 7), (2021, "Road", "Gas", 3),
    ]


def test_configured_unpivot_can_be_forced_wide(grid):
    cfg = config(**SIDE_CONFIG, unpivot=True)
    assert run(grid({"s": SIDE}), cfg).columns == ("Year", "Industry_sector", "Variable", "Value")
    assert "Gas" in run(grid({"s": SIDE}), cfg, unpivot_mode="force_wide").columns


def test_sections_end_where_they_end_unless_told(grid):
    lines = [["Year", "A", "Year", "A"], ["1", "1", "1", "1"], [None, None, "2", "2"]]
    cfg = config(
        table_type="side_by_side", header_row=1, data_start_row=2, index_columns=["Year"],
        sections=[{"name": "x", "start_col": 1, "end_col": 2}, {"name": "y", "start_col": "C", "end_col": "D"}],
    )
    assert run(grid({"s": lines}), cfg).frame.count() == 3
    assert run(grid({"s": lines}), cfg, end_from_first_block=True).frame.count() == 2


def test_empty_section_is_reported(grid):
    lines = [["Year", "A", "Year", "A"], ["1", "1"]]
    cfg = config(
        table_type="side_by_side", header_row=1, data_start_row=2, index_columns=["Year"],
        sections=[{"name": "x", "start_col": 1, "end_col": 2}, {"name": "y", "start_col": 3, "end_col": 4}],
    )
    assert tuples(run(grid({"s": lines}), cfg).empty_blocks, "name") == [("y",)]


def stacked(index, **second):
    return config(
        table_type="stacked",
        index_columns=index,
        tables=[
            {"header_row": 2, "data_start_row": 3, "data_end_row": 4, "static_columns": {"grp": "h"}},
            {"header_rows": [6], "data_start_row": 7, "static_columns": {"grp": "b"}, **second},
        ],
    )


def test_stacked(grid):
    assert tuples(run(grid({"s": STACK}), stacked(["Region"])).frame) == [("North", 4, "h"), ("South", 9, "b")]
    assert tuples(run(grid({"s": STACK}), stacked([])).frame) == [("North", 4, "h"), ("South", 9, "b")]


def test_stacked_open_block_stops_at_blank_row(grid):
    cfg = stacked(["Region"])
    cfg["tables"][0]["data_end_row"] = None
    assert tuples(run(grid({"s": STACK}), cfg).frame) == [("North", 4, "h"), ("South", 9, "b")]


def test_multi_row_header_over_merged_banner(spark, grid):
    cells = grid({"s": [["Energy", None, "Total"], ["Gas", "Oil", "Total"], ["1", "2", "3"]]})
    merges = spark.createDataFrame([("b", "s", 1, 1, 1, 2)], MERGES)
    filled = M.fill_merged(cells, merges)
    t = run(filled, config(header_row=None, header_rows=[1, 2]))
    assert t.columns == ("Energy | Gas", "Energy | Oil", "Total")
    assert run(filled, config(header_row=None, header_rows=[1, 2], header_join="/")).columns[0] == "Energy/Gas"


def test_merge_fill_keeps_own_values_and_skips_empty_anchors(spark, grid):
    cells = grid({"s": [["a", None, "own"], [None, None], [None, None, None, "x"]]})
    merges = spark.createDataFrame([("b", "s", 1, 1, 2, 3), ("b", "s", 3, 1, 3, 3)], MERGES)
    got = tuples(M.fill_merged(cells, merges).where("origin = 'merge'"), "r", "c", "value")
    assert got == [(1, 2, "a"), (2, 1, "a"), (2, 2, "a"), (2, 3, "a")]


def test_merge_fill_of_a_long_range(spark, grid):
    merges = spark.createDataFrame([("b", "s", 1, 1, 5000, 2)], MERGES)
    filled = M.fill_merged(grid({"s": [["a"]]}), merges)
    assert filled.count() == 10_000 and filled.select("r", "c").distinct().count() == 10_000


@pytest.mark.parametrize(
    "labels, unique",
    [
        (["a", "a", "b", "a"], ["a", "a_2", "b", "a_3"]),
        (["a", "a_2", "a"], ["a", "a_2", "a_3"]),
        (["a", "a", "a_2"], ["a", "a_2", "a_2_2"]),
        (["x", "y"], ["x", "y"]),
    ],
)
def test_unique_labels(spark, labels, unique):
    df = spark.createDataFrame([(labels,)], "l array<string>")
    assert df.select(L.unique_labels(F.col("l")).alias("u")).first()["u"] == unique


@pytest.mark.parametrize("gap, footer, end", [(0, None, 4), (1, None, 4), (2, None, 6), (3, None, 9), (3, 6, 4)])
@pytest.mark.parametrize("width", [2, 3, 65536])
def test_end_of_table(spark, gap, footer, end, width):
    rows = spark.createDataFrame([("k", r, 3, r == footer) for r in (3, 4, 6, 9)], "k string, r int, data_start int, footer boolean")
    assert tuples(L.end_rows(rows, gap, keys=["k"], width=width)) == [("k", end)]


def brute_end(rows, start, gap, footers):
    last, blanks = start - 1, 0
    for r in range(start, max(rows, default=0) + 1):
        if r in footers:
            break
        if r in rows:
            blanks, last = 0, r
        else:
            blanks += 1
            if blanks >= max(gap, 1):
                break
    return last


def test_end_of_table_against_brute_force(spark):
    rng = random.Random(7)
    cases, data = {}, []
    for k in range(60):
        rows = {r for r in range(3, 60) if rng.random() < 0.8}
        footers = {r for r in rows if rng.random() < 0.03}
        cases[k] = (rows, footers)
        data += [(k, r, 3, r in footers) for r in rows]
    df = spark.createDataFrame(data, "k int, r int, data_start int, footer boolean")
    for gap in (1, 2, 3):
        got = {r["k"]: r["end_row"] for r in L.end_rows(df, gap, keys=["k"], width=5).collect()}
        assert got == {k: brute_end(rows, 3, gap, footers) for k, (rows, footers) in cases.items()}


def test_explicit_end_and_footer_setting(grid):
    lines = [["h", "i"], ["1", "2"], [], ["3", "4"], ["Source: x", None], ["5", "6"]]
    cfg = config(header_row=1, data_start_row=2)
    assert run(grid({"s": lines}), {**cfg, "data_end_row": 4}).frame.count() == 2
    settings = Settings(stop_on_blank_rows=2, footer_markers=("Source:",))
    assert tuples(run(grid({"s": lines}), cfg, settings).frame) == [(1, 2), (3, 4)]


def test_explicit_columns_need_payload(grid):
    lines = [["x", "y", "z"], ["1", None, "a"], [None, None, "b"], ["3", "4", None]]
    base = dict(header_row=1, data_start_row=2, index_columns=["z"])
    x, z = {"col": "A", "name": "x"}, {"col": "C", "name": "z"}
    # Row 3 has no value outside the index. The table's end is looked for from the first
    # listed column on: from C, row 4 is blank and ends it; from A it is part of it.
    t = run(grid({"s": lines}), config(**base, columns=[z, x]))
    assert t.columns == ("z", "x") and tuples(t.frame) == [("a", 1)]
    t = run(grid({"s": lines}), config(**base, columns=[x, z]))
    assert t.columns == ("x", "z") and tuples(t.frame) == [(1, "a"), (3, None)]


def test_post_processing_order(grid):
    lines = [["Old  name", "Total", "spare", "Sub total"], ["1", "9", None, "8"], ["2", "9", None, "8"]]
    cfg = config(
        header_row=1, data_start_row=2, drop_columns=["Total*", "*total"], rename_columns={"Old\nname": "new"},
        static_columns={"year": "2024"}, column_types={"new": "string"},
    )
    t = run(grid({"s": lines}), cfg)
    assert t.frame.dtypes == [("new", "string"), ("year", "bigint")]
    assert tuples(t.frame) == [("1", 2024), ("2", 2024)]


def test_renamed_index_stays_an_id(grid):
    cfg = config(index_columns=["Year"], rename_columns={"Year": "Y"}, unpivot=True, drop_columns=["Code", "Sales_2"])
    assert tuples(run(grid({"s": SIMPLE}), cfg).frame) == [(2020, "Sales", 1200)]


def test_duplicate_names_keep_right_most_value(grid):
    lines = [["a", "a"], ["1", "2"]]
    t = run(grid({"s": lines}), config(header_row=1, data_start_row=2), Settings(dedupe_headers=False))
    assert tuples(t.frame) == [(2,)]


def test_many_workbooks_share_one_plan(grid):
    cells = grid({"s": SIMPLE}, "b1").unionByName(grid({"s": SIMPLE[:4]}, "b2"))
    t = run(cells, config(index_columns=["Year"]), provenance=True)
    assert tuples(t.frame, "workbook", "r") == [("b1", 3), ("b1", 4), ("b2", 3), ("b2", 4)]


def test_sheet_without_header_gives_no_columns(grid):
    assert run(grid({"s": [["only"]]}), config()).columns == ()


# --------------------------------------------------------------------------- typing
def wide(spark, values, kinds=None):
    rows = [(v, (kinds or ["string"] * len(values))[i]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value string, kind string").select(
        F.when(F.col("value").isNotNull(), F.struct("value", "kind")).alias("x")
    )


@pytest.mark.parametrize(
    "values, kinds, mode, override, type_, result",
    [
        (["1", "x"], None, "safe", None, "string", ["1", "x"]),
        (["1", "2.0", None], None, "safe", None, "bigint", [1, 2, None]),
        (["1.5", "2"], None, "safe", None, "double", [1.5, 2.0]),
        (["007", "8"], None, "safe", None, "string", ["007", "8"]),
        (["12345678901234567890"], None, "safe", None, "string", ["12345678901234567890"]),
        (["1", "x", "2.50"], None, "aggressive", None, "string", ["1", "x", "2.5"]),
        (["1", "2"], None, "none", None, "string", ["1", "2"]),
        (["1", "2"], None, "safe", "keep", "string", ["1", "2"]),
        (["1", "2"], None, "safe", "string", "string", ["1", "2"]),
        (["1", "2"], None, "safe", "float", "double", [1.0, 2.0]),
        (["1", "x"], None, "safe", "float", "string", ["1.0", "x"]),
        (["1.5", "2"], None, "safe", "int", "double", [1.5, 2.0]),
        (["1,000", "x"], None, "none", "number", "string", ["1000", "x"]),
        (["1", None], ["number", "number"], "safe", None, "bigint", [1, None]),
        (["1", "2"], ["number", "string"], "safe", None, "bigint", [1, 2]),
        (["True", "False"], ["bool", "bool"], "safe", None, "boolean", [True, False]),
        (["True", "3"], ["bool", "string"], "safe", None, "bigint", [1, 3]),
        (["True", "3"], ["bool", "number"], "safe", None, "string", ["True", "3"]),
        (["2020-01-01 00:00:00", "3"], ["date", "string"], "safe", None, "string", ["2020-01-01 00:00:00", "3"]),
        ([None], None, "safe", None, "string", [None]),
    ],
)
def test_column_typing(spark, values, kinds, mode, override, type_, result):
    df = wide(spark, values, kinds)
    overrides = {"x": override} if override else {}
    plan = {p["name"]: p["type"] for p in TY.type_plan(df, ["x"], mode, overrides).collect()}
    typed = TY.apply_types(df, plan, mode, overrides)
    assert plan == {"x": type_}
    assert sorted((r["x"] for r in typed.collect()), key=repr) == sorted(result, key=repr)


def test_type_plan_of_no_rows(spark):
    assert [p["type"] for p in TY.type_plan(wide(spark, ["1"]).where("false"), ["x"], "safe", {}).collect()] == ["string"]


def test_unpivot_then_pivot_restores_values(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 4.0), (3, 5.0, 6.0)], "k int, a double, b double")
    long = R.unpivot(df, ["k"])
    back = long.groupBy("k").pivot("Variable", ["a", "b"]).agg(F.first("Value"))
    assert tuples(back) == tuples(df)


def test_unpivot_without_value_columns_changes_nothing(spark):
    df = spark.createDataFrame([(1,)], "k int")
    assert R.unpivot(df, ["k"]).columns == ["k"]


def test_drop_pattern_is_a_substring():
    assert R.columns_to_drop(["Total", "Sub Total x", "a"], ["Total*"]) == ["Total", "Sub Total x"]
    assert R.columns_to_drop(["Total*", "Total"], ["Total*"]) == ["Total*"]


def test_table_to_cells_and_back(spark, grid):
    rng = random.Random(3)
    rows = [[i, rng.randint(0, 9) or None, f"t{rng.randint(0, 5)}"] for i in range(1, 40)]
    t = run(grid({"s": [["k", "n", "t"], *rows]}), config(header_row=1, data_start_row=2, index_columns=["k"]))
    assert tuples(t.frame) == sorted((tuple(r) for r in rows), key=repr)


def test_rows_after_the_footer_change_nothing(grid):
    settings = Settings(footer_markers=("Notes",))
    base = [["h", "i"], ["1", "2"], ["Notes", None]]
    more = base + [["7", "8"]] * 5
    cfg = config(header_row=1, data_start_row=2)
    assert tuples(run(grid({"s": base}), cfg, settings).frame) == tuples(run(grid({"s": more}), cfg, settings).frame)


@pytest.mark.parametrize("width", [1, 4, 1000])
def test_occurrence_number(spark, width):
    df = spark.createDataFrame([("a" if i % 3 else "b", i) for i in range(50)], "k string, p int")
    got = O.occurrence_number(df, ["k"], "p", "n", width)
    want, seen = [], {}
    for i in range(50):
        k = "a" if i % 3 else "b"
        seen[k] = seen.get(k, 0) + 1
        want.append((k, i, seen[k]))
    assert tuples(got) == sorted(want, key=repr)


# --------------------------------------------------------------------------- profiling
def brute_titles(lines):
    tables, in_data = [], False
    count = [sum(v is not None for v in line) for line in lines]
    for r, n in enumerate(count, 1):
        if n == 0:
            in_data = False
        elif n == 1 and not in_data:
            text = next(v for v in lines[r - 1] if v is not None)
            if len(text) > 10 and r < len(lines) and count[r] >= 2:
                tables.append(r)
                in_data = True
        elif n >= 2:
            in_data = True
    return tables


@pytest.mark.parametrize("width", [2, 5, 65536])
def test_stacked_titles_against_brute_force(spark, grid, width):
    rng = random.Random(width)
    sheets = {}
    for s in range(25):
        lines = []
        for _ in range(40):
            n = rng.choice([0, 0, 1, 1, 2, 3])
            lines.append([rng.choice(["short", "a title that is long enough"]) for _ in range(n)])
        sheets[f"s{s:02d}"] = lines + [["end", "end"]]
    got = tuples(P.stacked_titles(grid(sheets), Settings(), width), "sheet", "title_row")
    assert got == sorted(((s, r) for s, lines in sheets.items() for r in brute_titles(lines)), key=repr)


def test_profile_of_the_three_layouts(spark, grid):
    cells = grid({"simple": SIMPLE, "side": SIDE, "stack": STACK, "cover": [["nothing"], ["here"]]})
    merges = spark.createDataFrame([("b", "side", 1, 1, 1, 3), ("b", "side", 1, 4, 1, 6)], MERGES)
    rows = {r["sheet"]: r for r in P.profile_sheets(M.fill_merged(cells, merges), Settings(), "year", merges).collect()}
    assert rows["cover"]["status"] == P.NO_HEADER and rows["cover"]["table_type"] is None
    assert (rows["simple"]["header_row"], rows["simple"]["table_type"]) == (2, "simple")
    assert rows["side"]["table_type"] == "side_by_side" and rows["side"]["section_header_row"] == 1
    assert [tuple(s) for s in rows["side"]["sections"]] == [("Road", "A", "C"), ("Rail", "D", "F")]
    assert [(t["title_row"], t["name"]) for t in rows["stack"]["stacked_tables"]] == [(1, "Table 1: households"), (5, "Table 2: businesses")]
    assert rows["stack"]["table_type"] == "stacked"
    entries = {e["sheet"]: e["entry"] for e in P.sheet_configs(P.profile_sheets(M.fill_merged(cells, merges), Settings(), "year", merges)).collect()}
    assert set(entries) == {"simple", "side", "stack"}
    assert [t["data_end_row"] for t in entries["stack"]["tables"]] == [4, None]
    assert entries["side"]["exclude_from_unpivot"] == ["Total"] and entries["side"]["index_columns"] == ["Year"]


def test_sections_fall_back_to_keyword(grid):
    cells = grid({"s": [["Year", "A", "Year", "B", None, "C"], ["1", "2", "3", "4", "5", "6"]]})
    row = P.profile_sheets(cells, Settings(), "YEAR").first()
    assert [tuple(s) for s in row["sections"]] == [("Section_1", "A", "B"), ("Section_2", "C", "F")]
    assert row["empty_columns"] is None


def test_output_names_get_suffixes(spark, grid):
    lines = [["h1", "h2"], ["1", "2"]]
    cells = grid({"My Sheet": lines, "my.sheet": lines})
    names = [e["entry"]["output_name"] for e in P.sheet_configs(P.profile_sheets(cells, Settings())).collect()]
    assert sorted(names) == ["my_sheet", "my_sheet_2"]


def test_cells_schema(spark, grid):
    assert grid({"s": [["a", 1, True]]}).schema == spark.createDataFrame([], CELLS).schema
