"""Whole jobs: drops in each format, arriving files, written tables, very wide sheets."""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ...operators import extract as X
from ...operators import gates as G
from ...session import scratch_path, stage
from ...sources import config as CFG
from ...sources.files import hash_files, join_parts, listing, read_csv, read_json, read_native
from ...sources.registry import REGISTRY_DDL, lookup
from ...sources.workbook import parse_workbooks
from ...streaming.arrivals import watch_inventory, watch_landing
from .. import audit as A
from .. import extraction as E
from ..load import LoadRules, load_file, load_files
from ..publish import Store
from .base import Cell, Grid, chunk_name, query, select, table
from .books import book_files
from .governance import NOW

ORDER_CONTRACT = (
    G.ContractColumn(1, "o_orderkey", "bigint", False),
    G.ContractColumn(2, "o_custkey", "bigint", False),
    G.ContractColumn(3, "o_orderpriority", "string"),
)
NAMES = [c.name for c in ORDER_CONTRACT]
ORDERS_SQL = f"SELECT {', '.join(NAMES)} FROM orders"


def registry_rows(spark, root: str, datasets: list[str], source_format: str, **more):
    rows = [
        {
            "dataset_id": d, "domain": "sales", "entity": d, "source_type": "manual", "source_format": source_format,
            "quarantine_path": f"{root}/landing/{d}", "rejected_path": f"{root}/refused/{d}", "schema_contract_ref": "c1",
            "pii_scan_enabled": False, "owner_upn": "owner@example.org", "cadence": "adhoc", "active": True, **more,
        }
        for d in datasets
    ]
    return spark.createDataFrame(rows, REGISTRY_DDL)


# --------------------------------------------------------------------------- formats
@query("read_json_drop", ORDERS_SQL)
def read_json_drop(spark, sf_dir):
    """Documents of 500 records each, a file each, read back as text fields and brought to the contract."""
    path = scratch_path(spark, "json")
    record = F.struct(*NAMES)
    documents = table(spark, sf_dir, "orders").groupBy(F.floor(F.col("o_orderkey") / 500).alias("part"))
    listed = documents.agg(F.to_json(F.collect_list(record)).alias("value"))
    listed.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return G.to_contract(read_native(spark, "json", path), ORDER_CONTRACT).select(*NAMES)


@query("read_parquet_drop", ORDERS_SQL)
def read_parquet_drop(spark, sf_dir):
    """A columnar drop through the load job, and the live table read back."""
    root = scratch_path(spark, "parquet")
    landing = f"{root}/landing/orders/drop"
    table(spark, sf_dir, "orders").select(*NAMES).write.parquet(landing)
    store = Store(spark, f"{root}/store")
    load_file(store, registry_rows(spark, root, ["orders"], "parquet"), "orders", landing, LoadRules(ORDER_CONTRACT), now=NOW)
    return store.read_live("orders").select(*NAMES)


@query(
    "unknown_format",
    "SELECT 'REJECTED' AS status, 'EXTRACT_FAILED' AS reject_reason, count(*) AS kept FROM orders",
)
def unknown_format(spark, sf_dir):
    """A format nobody reads is recorded and the drop is kept whole among the refused ones."""
    root = scratch_path(spark, "unknown")
    landing = f"{root}/landing/orders/drop.xml"
    table(spark, sf_dir, "orders").select(*NAMES).write.option("header", True).csv(landing)
    store, registry = Store(spark, f"{root}/store"), registry_rows(spark, root, ["orders"], "xml")
    load_file(store, registry, "orders", landing, LoadRules(ORDER_CONTRACT), now=NOW, raise_on_reject=False)
    files = spark.read.option("recursiveFileLookup", True).option("header", True).csv(f"{root}/refused")
    attempts = A.read_history(spark, store.path("history")).select("status", "reject_reason", F.lit(1).alias("drop"))
    return attempts.join(files.agg(F.lit(1).alias("drop"), F.count("*").alias("kept")), "drop").drop("drop")


_GAPPED = "CASE turn % 7 WHEN 3 THEN NULL WHEN 5 THEN '' ELSE text END AS text"


def _write_csv(rows, path: str, header: bool = True) -> None:
    kept = {"header": header, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.options(**kept).csv(path)


@query("quoted_line_breaks", f"SELECT conv_id, turn, role, {_GAPPED} FROM conversations")
def quoted_line_breaks(spark, sf_dir):
    """Texts with line breaks and quotes in them, null and empty ones survive a CSV drop as they are."""
    path = scratch_path(spark, "csv")
    _write_csv(table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "role", _GAPPED), path)
    found = read_csv(spark, path, null_value="\\N")
    return found.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")


@query("csv_one_file", "SELECT doc_id, text, lang FROM documents")
def csv_one_file(spark, sf_dir):
    """All documents as one CSV file, read by ranges though its values hold line breaks."""
    parts, path = scratch_path(spark, "parts"), f"{scratch_path(spark, 'csv')}/documents.csv"
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"), "text", "lang")
    header = spark.createDataFrame([("doc_id", "text", "lang")], documents.schema)
    _write_csv(header.coalesce(1).unionByName(documents), parts, header=False)
    join_parts(spark, parts, path)
    return read_csv(spark, path, split_from=0).select(F.col("doc_id").cast("bigint"), "text", "lang")


@query("json_one_file", ORDERS_SQL)
def json_one_file(spark, sf_dir):
    """All orders as one array in one file, read by ranges and brought to the contract."""
    path = f"{scratch_path(spark, 'json')}/orders.json"
    orders = table(spark, sf_dir, "orders")
    first = orders.agg(F.min("o_orderkey")).first()[0]
    listed = orders.select(F.col("o_orderkey") == F.lit(first), F.to_json(F.struct(*NAMES))).toDF("first", "object")
    opened = listed.where("first").select(F.concat(F.lit("["), "object").alias("value"))
    others = listed.where("NOT first").select(F.concat(F.lit(","), "object").alias("value"))
    closed = spark.range(1).select(F.lit("]").alias("value"))
    parts = scratch_path(spark, "parts")
    opened.unionByName(others).unionByName(closed).write.text(parts)
    join_parts(spark, parts, path)
    return G.to_contract(read_json(spark, path, split_from=0), ORDER_CONTRACT).select(*NAMES)


# --------------------------------------------------------------------------- publishing
@query("dated_snapshot", f"SELECT *, 'v2026' AS version_effective_from FROM ({ORDERS_SQL})")
def dated_snapshot(spark, sf_dir):
    """The policy that keeps one table per label: written by the load, read back by label."""
    root = scratch_path(spark, "dated")
    landing = f"{root}/landing/orders/drop"
    table(spark, sf_dir, "orders").select(*NAMES).write.parquet(landing)
    store = Store(spark, f"{root}/store")
    registry = registry_rows(spark, root, ["orders"], "parquet", snapshot_policy="dated_table")
    load_file(store, registry, "orders", landing, LoadRules(ORDER_CONTRACT), now=NOW)
    return store.read_snapshot(lookup(registry, "orders"), "v2026").select(*NAMES, "version_effective_from")


@query(
    "written_tables",
    """
    SELECT 'parts' AS "table", 'ok' AS status, count(*) AS "rows", 6 AS columns, count(*) AS stored FROM part
    UNION ALL SELECT 'ambiguous', 'error', NULL, NULL, NULL
    """,
)
def written_tables(spark, sf_dir):
    """Tables written with their manifest; a config that fails doesn't stop the others, an absent sheet is skipped."""
    path = scratch_path(spark, "tables")
    common = {"sheet_name": "Parts", "table_type": "simple", "header_rows": [1, 2], "data_start_row": 3}
    config = {
        "config_name": "parts", "config_version": "1",
        "sheets": [
            {**common, "output_name": "parts"},
            {**common, "sheet_name": "Nowhere", "output_name": "absent"},
            {**common, "output_name": "ambiguous", "unpivot": True, "unpivot_var_name": "V", "unpivot_value_name": "V"},
        ],
    }
    results, _ = E.extract_all(parse_workbooks(stage(book_files(spark, sf_dir))), config)
    manifest = E.save_all(spark, results, config, path, "parquet", "part")
    stored = spark.read.parquet(f"{path}/parts").agg(F.count("*").alias("stored"))
    return manifest.join(stored, manifest["status"] == "ok", "left").select("table", "status", "rows", "columns", "stored")


@query(
    "fail_fast",
    "SELECT 'fail_fast' AS on_error, TRUE AS raised, FALSE AS written, count(*) * 6 AS cells FROM part",
)
def fail_fast(spark, sf_dir):
    """A table that can't be made stops the others under this policy, before anything is written; ``written_tables`` goes on instead."""
    books, path = parse_workbooks(stage(book_files(spark, sf_dir))), scratch_path(spark, "policy")
    common = {"sheet_name": "Parts", "table_type": "simple", "header_rows": [1, 2], "data_start_row": 3}
    sheets = [
        {**common, "output_name": "ambiguous", "unpivot": True, "unpivot_var_name": "V", "unpivot_value_name": "V"},
        {**common, "output_name": "parts"},
    ]
    config = {"config_name": "parts", "config_version": "1", "settings": {"on_error": "fail_fast"}, "sheets": sheets}
    try:
        E.save_all(spark, E.extract_all(books, config)[0], config, path, "parquet", "part")
        raised = False
    except AnalysisException:  # what the first table raised, as it is
        raised = True
    written = Store(spark, path).exists(path)
    cells = books.cells.where("r > 2").agg(F.count("*").alias("cells"))
    return cells.select(F.lit("fail_fast").alias("on_error"), F.lit(raised).alias("raised"), F.lit(written).alias("written"), "cells")


@query(
    "file_hashes",
    """
    SELECT CAST(s_nationkey AS STRING) AS nation, sum(strlen(concat(s_suppkey, ',', s_name)) + 1)::BIGINT AS bytes,
           sha256(concat(string_agg(concat(s_suppkey, ',', s_name), chr(10) ORDER BY s_suppkey), chr(10))) AS sha256
    FROM supplier GROUP BY s_nationkey
    """,
)
def file_hashes(spark, sf_dir):
    """Hashes of real files, one per nation, those of few bytes as rows and the others streamed through the digest."""
    path = scratch_path(spark, "hashed")
    lines = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", F.concat("s_suppkey", F.lit(","), "s_name").alias("value"))
    ordered = lines.repartition("s_nationkey").sortWithinPartitions("s_nationkey", "s_suppkey")
    ordered.select("s_nationkey", "value").write.partitionBy("s_nationkey").text(path)
    found = hash_files(spark, path, max_content=150)
    return found.select(F.regexp_extract("path", "s_nationkey=([0-9]+)", 1).alias("nation"), "bytes", "sha256")


@query(
    "rolled_back",
    """
    WITH n AS (SELECT count(*) AS c FROM orders)
    SELECT 'live' AS what, CAST(3 AS BIGINT) AS version, 'F' AS status, count(*) AS orders FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'version', 1, 'F', count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'version', 2, 'O', count(*) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'expired', 2, NULL, NULL FROM n
    """,
)
def rolled_back(spark, sf_dir):
    """Two versions are published, the first is made live again, both are read, and only the files of the second may go."""
    root = scratch_path(spark, "versions")
    store, registry = Store(spark, f"{root}/store"), registry_rows(spark, root, ["orders"], "parquet", timetravel_retention_days=30)
    contract = (*ORDER_CONTRACT, G.ContractColumn(4, "o_orderstatus", "string"))
    orders = table(spark, sf_dir, "orders").select(*NAMES, "o_orderstatus")
    for n, status in enumerate("FO"):
        landing = f"{root}/landing/orders/{status}"
        orders.where(F.col("o_orderstatus") == status).write.parquet(landing)
        load_file(store, registry, "orders", landing, LoadRules(contract), now=NOW + timedelta(days=n))
    version = store.roll_back("orders", 1, NOW + timedelta(days=2))

    def counted(what: str, number: int, df):
        grouped = df.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("orders"))
        return grouped.select(F.lit(what).alias("what"), F.lit(number).cast("bigint").alias("version"), "status", "orders")

    late = F.lit((NOW + timedelta(days=90)).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")
    expired = store.expired(registry, late).select(
        F.lit("expired").alias("what"), "version", F.lit(None).cast("string").alias("status"), F.lit(None).cast("bigint").alias("orders")
    )
    read = [counted("version", n, store.read_version("orders", n)) for n in (1, 2)]
    return counted("live", version, store.read_live("orders")).unionByName(read[0]).unionByName(read[1]).unionByName(expired)


@query(
    "compacted_appends",
    "SELECT year(o_orderdate)::INTEGER AS year, count(*) AS attempts, sum(o_custkey)::BIGINT AS customers, TRUE AS few_files FROM orders GROUP BY 1",
)
def compacted_appends(spark, sf_dir):
    """All orders in five appends to a table in folders by year: every folder keeps all its rows in fewer files than there were appends."""
    path = scratch_path(spark, "appended")
    orders = stage(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year")))
    for n in range(5):
        A.append_rows(spark, path, orders.where(F.col("o_orderkey") % 5 == n), "year", compact_from=3)
    found = spark.read.parquet(path).groupBy("year").agg(
        F.count("*").alias("attempts"), F.sum("o_custkey").alias("customers"), (F.count_distinct("_metadata.file_path") < 3).alias("few_files")
    )
    return found.select("year", "attempts", "customers", "few_files")


@query(
    "many_small_files",
    """
    SELECT 'SUCCESS' AS status, 100::BIGINT AS files, 100::BIGINT AS versions, count(*)::BIGINT AS "rows", sum(o_custkey)::BIGINT AS customers FROM orders
    """,
)
def many_small_files(spark, sf_dir):
    """All orders as a hundred files of one dataset, checked and published together: every file has its record and its version."""
    root = scratch_path(spark, "many")
    orders = table(spark, sf_dir, "orders").select(*NAMES).repartition(100, F.pmod(F.xxhash64("o_orderkey"), F.lit(100)))
    numbered = orders.withColumn("part", F.pmod(F.xxhash64("o_orderkey"), F.lit(100)))
    numbered.write.option("header", True).partitionBy("part").csv(f"{root}/landing")
    listed = sorted(r.path for r in listing(spark, f"{root}/landing").select("path").collect())  # a hundred
    store, registry = Store(spark, f"{root}/store"), registry_rows(spark, root, ["orders"], "csv")
    load_files(store, registry, "orders", [(p, f"run-{n}") for n, p in enumerate(listed)], LoadRules(ORDER_CONTRACT), now=NOW)
    history = A.read_history(spark, store.path("history")).groupBy("status").agg(
        F.count("*").alias("files"), F.count_distinct("version").alias("versions"), F.sum("row_count").alias("rows")
    )
    published = spark.read.parquet(store.path("live")).agg(F.sum("o_custkey").alias("customers"), F.lit("SUCCESS").alias("status"))
    return history.join(published, "status").select("status", "files", "versions", "rows", "customers")


# --------------------------------------------------------------------------- arriving files
STATUSES = ("F", "O", "P")


def _land(spark, sf_dir, root: str) -> None:
    orders = table(spark, sf_dir, "orders").select(*NAMES, "o_orderstatus").repartition(2)
    for status in STATUSES:
        mine = orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus")
        mine.write.option("header", True).csv(f"{root}/landing/{status}")


@query("arrival_inventory", "SELECT o_orderstatus AS folder, count(*) AS rows FROM orders GROUP BY 1")
def arrival_inventory(spark, sf_dir):
    """Landed files, streamed into an inventory table, and the rows that lie in the files it lists."""
    root = scratch_path(spark, "arrivals")
    _land(spark, sf_dir, root)
    watch_inventory(spark, f"{root}/landing", f"{root}/files", f"{root}/checkpoint").awaitTermination()
    listed = spark.read.parquet(f"{root}/files").select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "folder")
    lines = spark.read.option("header", True).option("recursiveFileLookup", True).csv(f"{root}/landing")
    counted = lines.groupBy(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("path")).agg(F.count("*").alias("n"))
    folder = F.element_at(F.split("folder", "/"), -1)
    return listed.join(counted, "path").groupBy(folder.alias("folder")).agg(F.sum("n").alias("rows"))


@query(
    "arrival_loads",
    "SELECT o_orderstatus AS dataset_id, 'SUCCESS' AS status, CAST(count(*) AS BIGINT) AS rows FROM orders GROUP BY 1",
)
def arrival_loads(spark, sf_dir):
    """Three landing folders watched by one stream; every file that lands is loaded once."""
    root = scratch_path(spark, "landing")
    _land(spark, sf_dir, root)
    store, registry = Store(spark, f"{root}/store"), registry_rows(spark, root, list(STATUSES), "csv")
    rules = {s: LoadRules(ORDER_CONTRACT) for s in STATUSES}
    for attempt in ("first", "again"):  # the second run finds nothing open
        watch_landing(store, registry, rules, f"{root}/landing", f"{root}/{attempt}").awaitTermination()
    history = A.read_history(spark, store.path("history"))
    return history.groupBy("dataset_id", "status").agg(F.sum("row_count").alias("rows"))


# --------------------------------------------------------------------------- sheets
_WIDTH = 1200


@query(
    "wide_sheet",
    f"""
    SELECT CAST(CAST(floor(o_orderkey / {_WIDTH}) AS BIGINT) + 2 AS INT) AS r, concat('c', CAST(o_orderkey % {_WIDTH} AS STRING)) AS variable, o_custkey AS value FROM orders
    """,
)
def wide_sheet(spark, sf_dir):
    """A sheet of 1,200 columns as a table, each with its type, then as rows."""
    grid = select(spark, sf_dir, "orders", {"k": "o_orderkey", "v": "o_custkey"})
    place = (F.col("k") % _WIDTH + 1).cast("int")
    head = grid.where(F.col("k") < _WIDTH).select(F.lit(1).alias("r"), place.alias("c"), F.concat(F.lit("c"), F.col("k") % _WIDTH).alias("value"))
    body = grid.select((F.floor(F.col("k") / _WIDTH) + 2).cast("int").alias("r"), place.alias("c"), F.col("v").cast("string").alias("value"))
    cells = head.unionByName(body).select(F.lit("wide").alias("workbook"), F.lit("Wide").alias("sheet"), "r", "c", "value", F.lit("string").alias("kind"))
    sheet = {"sheet_name": "Wide", "table_type": "simple", "header_row": 1, "data_start_row": 2}
    t = X.extract_table(cells, sheet, CFG.Settings(), provenance=True)
    long = t.frame.drop("workbook", "sheet", "block").unpivot(["r"], list(t.columns), "variable", "value")
    return long.where("value IS NOT NULL")


_BOOK = chunk_name("customers_", "c_custkey", 100)
MARKED = Grid(
    "customer",
    _BOOK,
    "'Data'",
    [
        Cell("1", "1", "'Name'", when="c_custkey % 100 = 0"),
        Cell("2", "1", "'Key'", when="c_custkey % 100 = 0"),
        Cell("1", "c_custkey % 100 + 2", "CASE c_custkey % 100 WHEN 60 THEN ' Total of all' WHEN 80 THEN 'Grand Total' ELSE c_name END"),
        Cell("2", "c_custkey % 100 + 2", "CAST(c_custkey AS STRING)", kind="number"),
    ],
)


@query("footer_markers", f'SELECT {_BOOK} AS workbook, c_name AS "Name", c_custkey AS "Key" FROM customer WHERE c_custkey % 100 < 60')
def footer_markers(spark, sf_dir):
    """Tables that end where a first cell begins with a marker text."""
    sheet = {"sheet_name": "Data", "table_type": "simple", "header_row": 1, "data_start_row": 2}
    t = X.extract_table(MARKED.staged(spark, sf_dir), sheet, CFG.Settings(footer_markers=("Total", "Source")), provenance=True)
    return t.frame.select("workbook", "Name", "Key")


# --------------------------------------------------------------------------- configs
_TEXTS = ("p_type", "p_brand", "p_name")
_TWO_ORDERS = [
    "concat('{', " + ", ', ', ".join(f"""'"{c}": "', {c}, '"'""" for c in order) + ", '}')" for order in (_TEXTS, _TEXTS[::-1])
]


@query(
    "config_hash_any_order",
    "SELECT p_partkey, substr(sha256(concat('{', "
    + ", ', ', ".join(f"""'"{c}": "', {c}, '"'""" for c in sorted(_TEXTS))
    + ", '}')), 1, 16) AS hash FROM part",
)
def config_hash_any_order(spark, sf_dir):
    """Hashes of JSON documents whose keys come in either order."""
    parts = table(spark, sf_dir, "part")
    document = F.when(F.col("p_partkey") % 2 == 0, F.expr(_TWO_ORDERS[0])).otherwise(F.expr(_TWO_ORDERS[1]))
    return parts.select("p_partkey", CFG.flat_hash(document).alias("hash"))
