"""Gates, publishing, versions, manifests, and whole loads."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ...operators import gates as G
from ...operators import ordered as O
from ...operators import personal as P
from ...session import scratch_path, spread
from ...sources import files as FS
from .. import audit as A
from .. import extraction as E
from ..load import LoadRules, load_file
from ..publish import Store
from .base import query, select, select_sql, table

# --------------------------------------------------------------------------- contract
_COLS = (("id", "bigint"), ("name", "string"), ("balance", "double"), ("segment", "string"))


def _schema_rows(spark, sf_dir, actual: bool):
    """Every customer stands for a dataset; its key decides how its file deviates."""
    k = F.col("c_custkey")
    rows = []
    for i, (name, _) in enumerate(_COLS):
        at, label, there = F.lit(i + 1), F.lit(name), F.lit(True)
        if actual:
            if name == "balance":
                at = F.when(k % 5 == 1, 4).otherwise(3)  # swapped with segment
                label = F.when(k % 5 == 2, "amount").otherwise(name)  # renamed
            if name == "segment":
                at = F.when(k % 5 == 1, 3).otherwise(4)
                there = k % 5 != 3  # missing
        rows.append(F.when(there, F.struct(at.alias("ordinal"), label.alias("name"))))
    if actual:
        rows.append(F.when(k % 5 == 4, F.struct(F.lit(5).alias("ordinal"), F.lit("extra").alias("name"))))
    return table(spark, sf_dir, "customer").select("c_custkey", F.inline(F.array_compact(F.array(*rows))))


@query(
    "contract_diff",
    """
    SELECT c_custkey, 'REORDERED' AS violation, 'balance at 3' AS expected, 'balance at 4' AS actual FROM customer WHERE c_custkey % 5 = 1
    UNION ALL SELECT c_custkey, 'REORDERED', 'segment at 4', 'segment at 3' FROM customer WHERE c_custkey % 5 = 1
    UNION ALL SELECT c_custkey, 'RENAMED', 'balance', 'amount' FROM customer WHERE c_custkey % 5 = 2
    UNION ALL SELECT c_custkey, 'MISSING', 'segment', NULL FROM customer WHERE c_custkey % 5 = 3
    UNION ALL SELECT c_custkey, 'EXTRA', NULL, 'extra' FROM customer WHERE c_custkey % 5 = 4
    """,
)
def contract_diff(spark, sf_dir):
    """Missing, extra, renamed and reordered columns of many datasets."""
    return G.compare_names(_schema_rows(spark, sf_dir, True), _schema_rows(spark, sf_dir, False), keys=["c_custkey"])


RAW_ORDERS = {
    "o_orderkey": "CAST(o_orderkey AS STRING)",
    "o_custkey": "CASE WHEN o_custkey % 50 = 7 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END",
    "o_orderstatus": "CASE WHEN o_custkey % 40 <> 3 THEN o_orderstatus END",
    "o_orderdate": "CASE WHEN o_orderkey % 90 = 1 THEN '31/12/1999' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "o_orderpriority": "o_orderpriority",
}
ORDER_CONTRACT = (
    G.ContractColumn(1, "o_orderkey", "bigint", False),
    G.ContractColumn(2, "o_custkey", "bigint"),
    G.ContractColumn(3, "o_orderstatus", "string", False),
    G.ContractColumn(4, "o_orderdate", "date"),
    G.ContractColumn(5, "o_orderpriority", "int"),
)


@query(
    "contract_drift",
    """
    SELECT 'TYPE_DRIFT' AS violation, 'o_custkey bigint' AS expected, 'o_custkey' AS actual, count(*) AS rows FROM orders WHERE o_custkey % 50 = 7
    UNION ALL SELECT 'NULL_FOUND', 'o_orderstatus string', 'o_orderstatus', count(*) FROM orders WHERE o_custkey % 40 = 3
    UNION ALL SELECT 'TYPE_DRIFT', 'o_orderdate date', 'o_orderdate', count(*) FROM orders WHERE o_orderkey % 90 = 1
    UNION ALL SELECT 'TYPE_DRIFT', 'o_orderpriority int', 'o_orderpriority', count(*) FROM orders
    """,
)
def contract_drift(spark, sf_dir):
    """Casts that fail and nulls that must not be, counted for all columns in one pass."""
    return G.drift_violations(select(spark, sf_dir, "orders", RAW_ORDERS, wide_work=True), ORDER_CONTRACT)


def _contract_rows(spark, sf_dir, version: int):
    cols = [
        F.when(
            (F.col("c_custkey") % 4 != 1) | (F.lit(n) != "segment") | F.lit(version == 1),
            F.struct(
                F.lit(i + 1).alias("ordinal"),
                F.lit(n).alias("name"),
                F.when((F.col("c_custkey") % 4 == 2) & F.lit(version == 2 and n == "id"), "string").otherwise(t).alias("type"),
                F.lit(True).alias("nullable"),
            ),
        )
        for i, (n, t) in enumerate(_COLS)
    ]
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("dataset_id"), F.inline(F.array_compact(F.array(*cols)))
    )


@query(
    "contract_changed",
    """
    SELECT c_custkey AS dataset_id, CASE WHEN c_custkey % 4 IN (1, 2) THEN 1 ELSE 0 END::BIGINT AS removed,
           CASE WHEN c_custkey % 4 = 2 THEN 1 ELSE 0 END::BIGINT AS added, c_custkey % 4 IN (1, 2) AS schema_changed FROM customer
    """,
)
def contract_changed(spark, sf_dir):
    return G.contract_changes(_contract_rows(spark, sf_dir, 1), _contract_rows(spark, sf_dir, 2))


# --------------------------------------------------------------------------- personal data
def _pii_sql(source: str, columns: tuple[str, ...]) -> str:
    parts = []
    for entity, (score, pattern) in G.PII_PATTERNS.items():
        for c in columns:
            parts.append(
                f"SELECT '{c}' AS column_name, '{entity}' AS entity, CAST({score} AS DOUBLE) AS score, "
                f"count(*) FILTER (regexp_matches({c}, '{pattern}')) AS hits FROM {source}"
            )
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE hits > 0"


@query("pii_scan", _pii_sql("documents", ("text", "lang", "source")))
def pii_scan(spark, sf_dir):
    """Whole texts of all documents against every pattern."""
    return G.pii_scan(spread(table(spark, sf_dir, "documents").select("text", "lang", "source")))


_MESSAGES = "(SELECT concat('to ', role, conv_id, '@example.org: ', text) AS text FROM conversations)"


@query("pii_tripwire", f"SELECT * FROM ({_pii_sql(_MESSAGES, ('text',))}) WHERE score >= 0.7")
def pii_tripwire(spark, sf_dir):
    """Findings that block a load: messages with an address line put before them."""
    text = F.concat(F.lit("to "), "role", F.col("conv_id").cast("string"), F.lit("@example.org: "), "text")
    return G.blocking(G.pii_scan(spread(table(spark, sf_dir, "conversations")).select(text.alias("text"))))


@query(
    "pii_detector_hook",
    """
    SELECT 'text' AS column_name, 'SECRET' AS entity, CAST(0.8 AS DOUBLE) AS score, count(*) AS hits FROM documents WHERE contains(text, 'password')
    HAVING count(*) > 0
    """,
)
def pii_detector_hook(spark, sf_dir):
    """A caller's own detector next to the built-in ones."""
    extra = {"SECRET": (0.8, lambda text: F.contains(text, F.lit("password")))}
    found = G.pii_scan(spread(table(spark, sf_dir, "documents").select("text")), extra=extra)
    return found.where(F.col("entity") == "SECRET")


# names of customers whose keys are even teach the model; those planted in texts have other family names
FIRST = "Alice Bruno Clara Daniel Edwin Fiona Georg Hanna Ivan Julia Karl Laura Marco Nadia Oscar Paula".split()
STEMS = "Thorn Ash Whit Har Wood Brad Clay Hart Lang Mor Nor Pem Rad Stan Wex Win".split()
ENDS = "bury combe ford worth wick field brook stead".split()


def _pick(words: list[str], n: str) -> str:
    return f"element_at(array({', '.join(repr(w) for w in words)}), CAST({n} AS INT) % {len(words)} + 1)"


def name_model(spark, sf_dir):
    """Learned from the names of half of the customers against what all documents say."""
    full = f"concat({_pick(FIRST, 'c_custkey div 2')}, ' ', {_pick(STEMS[::2], 'c_custkey div 10')}, {_pick(ENDS, 'c_custkey div 6')})"
    names = select(spark, sf_dir, "customer", {"name": full}, "c_custkey % 2 = 0")
    return P.fit_names(names, spread(table(spark, sf_dir, "documents").select("text")))


def _planted(spark, sf_dir, source: str, key: str, before: dict[int, str], after: dict[int, str]):
    """Texts of a table with a sentence put before or after them, by the key's remainder."""
    kind = f"{key} % 10"
    put = [f"CASE {kind} {' '.join(f'WHEN {n} THEN {e}' for n, e in x.items())} ELSE '' END" if x else "''" for x in (before, after)]
    columns = {"planted": f"CAST({kind} AS INT)", "text": f"concat({put[0]}, coalesce(text, ''), {put[1]})"}
    return select(spark, sf_dir, source, columns, wide_work=True)


@query(
    "pii_names",
    """
    SELECT CAST(doc_id % 10 AS INTEGER) AS planted, count(*) AS cells, count(*) FILTER (doc_id % 10 IN (0, 1, 2, 5)) AS found
    FROM documents GROUP BY 1
    """,
)
def pii_names(spark, sf_dir):
    """Names found in whole documents: recall where names were planted, false hits where brands, places or nothing were."""
    first, last = _pick(FIRST, "doc_id div 10"), f"concat({_pick(STEMS[1::2], 'doc_id div 70')}, {_pick(ENDS, 'doc_id div 30')})"
    texts = _planted(
        spark, sf_dir, "documents", "doc_id",
        {5: f"concat({first}, ' ', {last}, ' wrote: ')"},
        {
            0: f"concat(' yours sincerely, ', {first}, ' ', {last})",
            1: f"concat(' please ask for Mr Quillon ', {last}, ' tomorrow')",
            2: f"concat(' we met ', {first}, ' J. ', {last}, ' there')",
            3: f"concat(' made by ', initcap({_pick(['blue ring', 'hot bolt', 'large gear'], 'doc_id')}), ' of Brand#7')",
            4: "' from Market Days to the Winter Games'",
        },
    )
    hit = name_model(spark, sf_dir).detector()(F.col("text"))
    return texts.groupBy("planted").agg(F.count("*").alias("cells"), F.count_if(hit).alias("found"))


@query(
    "pii_addresses",
    """
    SELECT CAST(conv_id % 10 AS INTEGER) AS planted, count(*) AS cells, count(*) FILTER (conv_id % 10 IN (0, 1, 2, 3, 4)) AS addresses,
           count(*) FILTER (conv_id % 10 IN (0, 1, 3, 4, 7)) AS street_lines
    FROM conversations GROUP BY 1
    """,
)
def pii_addresses(spark, sf_dir):
    """Addresses found in whole conversations: recall by kind, false hits on numbers and street words that make none."""
    number = "CAST(conv_id % 400 + 1 AS STRING)"
    texts = _planted(
        spark, sf_dir, "conversations", "conv_id",
        {4: f"concat({number}, ' rue de la Paix, 75002 Paris. ')"},
        {
            0: f"concat(' deliver to ', {number}, ' Baker Street, London NW1 6XE')",
            1: f"concat(' it is at Flat 3, ', {number}, ' North Hill Road now')",
            2: f"concat(' write to P.O. Box ', {number}, ' please')",
            3: f"concat(' in der Hauptstraße ', {number}, ', 10115 Berlin')",
            5: f"concat(' order ', {number}, ' Blue Rings, close to Street level')",
            6: f"concat(' see section 4.', {number}, ' Main points, a Place of note')",
            7: f"concat(' seen near ', {number}, ' Mill Lane yesterday')",
        },
    )
    hits = [F.count_if(detect(F.col("text"))).alias(n) for n, detect in (("addresses", P.address), ("street_lines", P.street_line))]
    return texts.groupBy("planted").agg(F.count("*").alias("cells"), *hits)


@query(
    "pii_names_block",
    "SELECT 'text' AS column_name, 'PERSON' AS entity, CAST(0.85 AS DOUBLE) AS score, count(*) AS hits FROM documents WHERE doc_id % 10 = 0",
)
def pii_names_block(spark, sf_dir):
    """The finding that refuses a load, by the trained detector next to the built-in ones."""
    texts = _planted(spark, sf_dir, "documents", "doc_id", {}, {0: f"concat(' signed Herr {FIRST[3]} ', {_pick(STEMS, 'doc_id')}, {_pick(ENDS, 'doc_id div 3')})"})
    found = G.blocking(G.pii_scan(texts.select("text"), extra=P.person_detector(name_model(spark, sf_dir))))
    return found.where(F.col("entity") == "PERSON")


# --------------------------------------------------------------------------- data quality
DQ_RULES = (
    {"rule_id": "rows", "kind": "row_count", "min": 1000, "max": 1e12},
    {"rule_id": "too_few", "kind": "row_count", "min": 1e11},
    {"rule_id": "flag_null", "kind": "null_ratio", "column": "flag", "max": 0.1},
    {"rule_id": "status_null", "kind": "null_ratio", "column": "l_linestatus", "max": 0.0},
    {"rule_id": "flag_domain", "kind": "domain", "column": "flag", "values": ["A", "N"]},
    {"rule_id": "discount", "kind": "range", "column": "l_discount", "min": 0.0, "max": 0.05},
    {"rule_id": "quantity", "kind": "range", "column": "l_quantity", "min": 1.0},
    {"rule_id": "order_unique", "kind": "unique", "column": "l_orderkey"},
)


@query(
    "dq_rules",
    """
    WITH t AS (SELECT *, CASE WHEN l_suppkey % 7 <> 0 THEN l_returnflag END AS flag FROM lineitem),
    s AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (flag IS NULL)::DOUBLE AS fn, count(*) FILTER (l_linestatus IS NULL)::DOUBLE AS ln,
                 count(*) FILTER (flag NOT IN ('A', 'N'))::DOUBLE AS fd, count(*) FILTER (l_discount < 0 OR l_discount > 0.05)::DOUBLE AS dr,
                 count(*) FILTER (l_quantity < 1)::DOUBLE AS qr, (count(l_orderkey) - count(DISTINCT l_orderkey))::DOUBLE AS u FROM t)
    SELECT 'rows' AS rule_id, 'row_count' AS kind, NULL::VARCHAR AS column_name, n AS observed, n < 1000 OR n > 1e12 AS failed FROM s
    UNION ALL SELECT 'too_few', 'row_count', NULL, n, n < 1e11 FROM s
    UNION ALL SELECT 'flag_null', 'null_ratio', 'flag', fn / n, fn / n > 0.1 FROM s
    UNION ALL SELECT 'status_null', 'null_ratio', 'l_linestatus', ln / n, ln / n > 0 FROM s
    UNION ALL SELECT 'flag_domain', 'domain', 'flag', fd, fd > 0 FROM s
    UNION ALL SELECT 'discount', 'range', 'l_discount', dr, dr > 0 FROM s
    UNION ALL SELECT 'quantity', 'range', 'l_quantity', qr, qr > 0 FROM s
    UNION ALL SELECT 'order_unique', 'unique', 'l_orderkey', u, u > 0 FROM s
    """,
)
def dq_rules(spark, sf_dir):
    flag = F.when(F.col("l_suppkey") % 7 != 0, F.col("l_returnflag"))
    return G.dq_results(table(spark, sf_dir, "lineitem").withColumn("flag", flag), DQ_RULES)


# --------------------------------------------------------------------------- publishing
LOADED_AT = "2026-03-01 12:30:00"


@query(
    "audit_columns",
    f"""
    SELECT *, 'orders.parquet' AS source_file_name, sha256(concat(CAST(o_orderkey AS STRING), o_orderpriority)) AS source_file_sha256,
           TIMESTAMP '{LOADED_AT}' AS loaded_at_utc, 'loader' AS loaded_by_upn, 'v2026' AS version_effective_from FROM orders
    """,
)
def audit_columns(spark, sf_dir):
    """The five audit columns, with a hash of text in place of the file's."""
    df = table(spark, sf_dir, "orders")
    digest = F.sha2(F.concat(F.col("o_orderkey").cast("string"), "o_orderpriority"), 256)
    name = F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1)
    return A.with_audit_columns(df, name, digest, F.lit(LOADED_AT).cast("timestamp_ntz"), F.lit("loader"))


@query("content_hashes", "SELECT doc_id, strlen(text) AS bytes, sha256(text) AS sha256 FROM documents")
def content_hashes(spark, sf_dir):
    """Each document as one file: size and content hash of all of its bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("content"))
    return docs.select("doc_id", F.octet_length("content").cast("bigint").alias("bytes"), FS.content_hash(F.col("content")).alias("sha256"))


@query(
    "snapshot_read",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, concat('v', CAST(year(o_orderdate) AS STRING)) AS version_effective_from FROM orders
    WHERE year(o_orderdate) = 1997
    UNION ALL
    SELECT o_orderkey, o_custkey, 'second', concat('v', CAST(year(o_orderdate) AS STRING)) FROM orders WHERE year(o_orderdate) = 1998
    """,
)
def snapshot_read(spark, sf_dir):
    """Labels written as partitions, one of them published again, two of them read back."""
    store = Store(spark, scratch_path(spark, "snapshot"))
    cfg = {"snapshot_policy": "history_partition", "history_table": "orders_history", "target_table": "orders"}
    label = F.concat(F.lit("v"), F.year("o_orderdate").cast("string"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", label.alias("version_effective_from"))
    store.write_snapshot(cfg, "", orders)
    again = orders.where(F.col("version_effective_from") == "v1998").withColumn("o_orderstatus", F.lit("second"))
    store.write_snapshot(cfg, "v1998", again)
    both = store.read_snapshot(cfg, "v1997").unionByName(store.read_snapshot(cfg, "v1998"))
    return both.select("o_orderkey", "o_custkey", "o_orderstatus", "version_effective_from")


PUBLICATIONS_SQL = """
    SELECT concat('ds_', CAST(o_custkey % 50 AS STRING)) AS dataset_id,
           row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) AS version,
           concat('v', CAST(year(o_orderdate) AS STRING)) AS label, concat('/live/', CAST(o_orderkey AS STRING)) AS path,
           o_custkey AS rows, TIMESTAMP '1995-01-01' + to_hours(o_orderkey) AS published_at FROM orders
"""


def publications(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ds_"), (F.col("o_custkey") % 50).cast("string")).alias("dataset_id"),
        F.concat(F.lit("v"), F.year("o_orderdate").cast("string")).alias("label"),
        F.concat(F.lit("/live/"), F.col("o_orderkey").cast("string")).alias("path"),
        F.col("o_custkey").alias("rows"),
        F.expr("timestampadd(HOUR, o_orderkey, TIMESTAMP_NTZ'1995-01-01 00:00:00')").alias("published_at"),
        "o_orderkey",
    )
    return O.occurrence_number(df, ["dataset_id"], "o_orderkey", "version").drop("o_orderkey")


@query(
    "live_versions",
    f"""
    SELECT dataset_id, version, label, path, rows, published_at FROM (
      SELECT *, row_number() OVER (PARTITION BY dataset_id ORDER BY version DESC) AS n FROM ({PUBLICATIONS_SQL})) WHERE n = 1
    """,
)
def live_versions(spark, sf_dir):
    return A.live_versions(publications(spark, sf_dir))


RETENTION_SQL = "SELECT DISTINCT concat('ds_', CAST(o_custkey % 50 AS STRING)) AS dataset_id, CAST(o_custkey % 50 + 100 AS INT) AS days FROM orders"


@query(
    "expired_versions",
    f"""
    WITH v AS (SELECT dataset_id, version, lead(published_at) OVER (PARTITION BY dataset_id ORDER BY version) AS retired_at FROM ({PUBLICATIONS_SQL}))
    SELECT v.dataset_id, version, retired_at FROM v JOIN ({RETENTION_SQL}) r USING (dataset_id)
    WHERE retired_at < TIMESTAMP '1995-09-01' - to_days(r.days)
    """,
)
def expired_versions(spark, sf_dir):
    """Versions replaced longer ago than the retention of their dataset."""
    retention = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ds_"), (F.col("o_custkey") % 50).cast("string")).alias("dataset_id"),
        (F.col("o_custkey") % 50 + 100).cast("int").alias("timetravel_retention_days"),
    ).distinct()
    return A.expired_versions(publications(spark, sf_dir), retention, F.lit("1995-09-01").cast("timestamp_ntz"))


MANIFEST = {
    "run_id": "l_suppkey",
    "status": "CASE l_returnflag WHEN 'A' THEN 'ok' WHEN 'N' THEN 'error' ELSE 'empty' END",
    "rows": "CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END",
}


@query(
    "manifest_totals",
    f"""
    SELECT run_id, count(*) FILTER (status = 'ok') AS total_tables_ok, count(*) FILTER (status = 'error') AS total_tables_error,
           CAST(coalesce(sum(rows), 0) AS BIGINT) AS total_rows FROM ({select_sql('lineitem', MANIFEST)}) GROUP BY 1
    """,
)
def manifest_totals(spark, sf_dir):
    return E.manifest_totals(select(spark, sf_dir, "lineitem", MANIFEST))


# --------------------------------------------------------------------------- whole loads
NOW = datetime(2026, 3, 1, 12, 30, tzinfo=timezone.utc)


def _registry(spark, landing: str, dataset_id: str, source_format: str, pii: bool):
    row = {
        "dataset_id": dataset_id, "domain": "sales", "entity": dataset_id, "source_type": "manual",
        "source_format": source_format, "quarantine_path": landing, "schema_contract_ref": "c1",
        "pii_scan_enabled": pii, "owner_upn": "owner@example.org", "cadence": "adhoc", "active": True,
    }
    from ...sources.registry import REGISTRY_DDL

    return spark.createDataFrame([row], REGISTRY_DDL)


CLEAN_CONTRACT = (
    G.ContractColumn(1, "o_orderkey", "bigint", False),
    G.ContractColumn(2, "o_custkey", "bigint", False),
    G.ContractColumn(3, "o_orderstatus", "string"),
    G.ContractColumn(4, "o_totalprice", "double"),
    G.ContractColumn(5, "o_orderpriority", "string"),
)


@query(
    "load_and_publish",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, 'loader' AS loaded_by_upn, 'v2026' AS version_effective_from FROM orders
    """,
)
def load_and_publish(spark, sf_dir):
    """A text drop through all gates, published, and the live table read back."""
    root = scratch_path(spark, "load")
    landing = f"{root}/landing/orders.csv"
    names = [c.name for c in CLEAN_CONTRACT]
    table(spark, sf_dir, "orders").select(*names).write.option("header", True).csv(landing)
    rules = LoadRules(
        CLEAN_CONTRACT,
        dq=[
            {"rule_id": "rows", "kind": "row_count", "min": 1},
            {"rule_id": "status", "kind": "domain", "column": "o_orderstatus", "values": ["F", "O", "P"]},
            {"rule_id": "key", "kind": "unique", "column": "o_orderkey"},
        ],
    )
    store = Store(spark, f"{root}/store")
    load_file(store, _registry(spark, f"{root}/landing", "orders", "csv", False), "orders", landing, rules, now=NOW)
    return store.read_live("orders").select(*names, "loaded_by_upn", "version_effective_from")


@query(
    "load_rejected",
    """
    SELECT 'REJECTED' AS status, 'PII_DETECTED' AS reject_reason, count(*) AS row_count, CAST(4 AS INT) AS column_count, CAST(1 AS BIGINT) AS messages FROM conversations
    """,
)
def load_rejected(spark, sf_dir):
    """Documents with addresses in them are stopped, recorded, and reported to the owner."""
    root = scratch_path(spark, "reject")
    landing = f"{root}/landing/messages"
    text = F.concat(F.lit("to "), "role", F.lit("@example.org: "), "text")
    df = table(spark, sf_dir, "conversations").withColumn("text", text)
    df.select("conv_id", "turn", "role", "text").write.option("header", True).option("escape", '"').csv(landing)
    columns = (("conv_id", "bigint"), ("turn", "int"), ("role", "string"), ("text", "string"))
    contract = [G.ContractColumn(i + 1, n, t) for i, (n, t) in enumerate(columns)]
    store = Store(spark, f"{root}/store")
    registry = _registry(spark, f"{root}/landing", "messages", "csv", True)
    load_file(store, registry, "messages", landing, LoadRules(contract), now=NOW, raise_on_reject=False)
    outbox = spark.read.schema(A.OUTBOX_DDL).parquet(store.path("outbox"))
    sent = outbox.groupBy("run_id").agg(F.count(F.lit(1)).alias("messages"))
    history = A.read_history(spark, store.path("history"))
    return history.join(sent, "run_id").select("status", "reject_reason", "row_count", "column_count", "messages")
