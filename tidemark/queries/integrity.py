"""Multiset comparison, digests, locks, generations and value contracts."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import checks, csv_scan, integrity, multiset
from tidemark.queries.events import event_lines, nested_events
from tidemark.queries.monitoring import _digest_sql
from tidemark.queries.registry import query, table
from tidemark.session import shared_folder
from tidemark.sources import files

LINES = "l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag"


@query(
    "multiset_difference",
    """
    WITH a AS (SELECT l_partkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL),
    b AS (SELECT l_partkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE l_linenumber END AS l_linenumber, l_returnflag,
                 count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber,
           coalesce(a.l_returnflag, b.l_returnflag) AS l_returnflag, coalesce(b.n, 0) - coalesce(a.n, 0) AS surplus
    FROM a FULL JOIN b ON a.l_partkey = b.l_partkey AND a.l_linenumber = b.l_linenumber AND a.l_returnflag = b.l_returnflag
    WHERE coalesce(b.n, 0) <> coalesce(a.n, 0)
    """,
)
def multiset_difference(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_linenumber", "l_returnflag")
    changed = lines.withColumn(
        "l_linenumber", F.when(F.col("l_returnflag") == "R", F.lit(1)).otherwise(F.col("l_linenumber"))
    )
    return multiset.multiset_difference(lines, changed)


@query(
    "multiset_report",
    """
    SELECT count(*) AS missing_rows, cast(0 AS bigint) AS extra_rows, count(*) = 0 AS equal
    FROM lineitem WHERE l_returnflag = 'R'
    """,
)
def multiset_report(spark, folder):
    lines = table(spark, folder, "lineitem")
    return multiset.multiset_report(lines, lines.where(F.col("l_returnflag") != "R"))


@query("table_fingerprint")
def table_fingerprint(spark, folder):
    return multiset.fingerprint(table(spark, folder, "lineitem"))


@query("table_snapshot")
def table_snapshot(spark, folder):
    return multiset.table_snapshot(table(spark, folder, "documents"))


@query(
    "portable_fingerprint",
    """
    WITH t AS (
        SELECT o_orderkey || chr(31) || o_custkey || chr(31) || o_orderstatus || chr(31) || o_orderpriority AS line FROM orders),
    h AS (
        SELECT cast('0x' || left(sha256('nyc-quality-a' || chr(31) || line), 15) AS bigint) AS a,
               cast('0x' || left(sha256('nyc-quality-b' || chr(31) || line), 15) AS bigint) AS b FROM t)
    SELECT count(*) AS row_count, cast(sum(a) AS decimal(38,0)) AS sum_a, bit_xor(a) AS xor_a,
           cast(sum(b) AS decimal(38,0)) AS sum_b, bit_xor(b) AS xor_b FROM h
    """,
)
def portable_fingerprint(spark, folder):
    return multiset.portable_fingerprint(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    )


MANIFEST_LINES = """
    SELECT 0 AS one, '{"bytes":' || strlen(text) || ',"name":"doc-' || doc_id || '","sha256":"' || sha256(text) || '"}' AS line
    FROM documents
"""


def document_manifest(spark, folder):
    return table(spark, folder, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("name"),
        F.octet_length("text").alias("bytes"),
        F.sha2("text", 256).alias("sha256"),
    )


@query("manifest_digest", f"SELECT digest AS manifest_sha256 FROM ({_digest_sql(MANIFEST_LINES, 'one')})")
def manifest_digest(spark, folder):
    return integrity.manifest_digest(document_manifest(spark, folder))


@query(
    "lock_check",
    """
    SELECT 'doc-' || doc_id AS name, CASE WHEN lang = 'de' THEN 'missing' WHEN lang = 'fr' THEN 'unexpected'
        WHEN n_chars > 3000 THEN 'size_mismatch' WHEN source = 'src1' THEN 'digest_mismatch' ELSE 'ok' END AS status
    FROM documents
    """,
)
def lock_check(spark, folder):
    """Documents as objects against a lock that disagrees by language, length and source."""
    documents = table(spark, folder, "documents")
    named = documents.select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("name"), "lang", "source", "n_chars",
        F.octet_length("text").alias("bytes"), F.sha2("text", 256).alias("sha256"),
    )
    observed = named.where(F.col("lang") != "de").select("name", "bytes", "sha256")
    lock = named.where(F.col("lang") != "fr").select(
        "name",
        F.when(F.col("n_chars") > 3000, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"),
        F.when(F.col("source") == "src1", F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("sha256"),
    )
    return integrity.verify_lock(observed, lock)


@query(
    "inventory_positions",
    """
    SELECT cast(coalesce(e.position, o.position) AS bigint) AS position, e.name AS expected_name, o.name AS observed_name
    FROM (SELECT page_id AS position, url AS name FROM pages) e
    FULL JOIN (SELECT page_id + 1 AS position, url AS name FROM pages) o ON e.position = o.position
    WHERE e.name IS DISTINCT FROM o.name
    """,
)
def inventory_positions(spark, folder):
    pages = table(spark, folder, "pages")
    expected = pages.select(F.col("page_id").alias("position"), F.col("url").alias("name"))
    observed = pages.select((F.col("page_id") + 1).alias("position"), F.col("url").alias("name"))
    return integrity.inventory_positions(expected, observed)


def _document_uris(spark, folder):
    """Object URIs of the documents; each source has its own plan, French ones a malformed publication."""
    publication = F.when(F.col("lang") == "fr", "0" * 32).otherwise("0" * 12 + "4" + "0" * 3 + "8" + "0" * 15)
    uri = F.concat(
        F.lit("s3://landing/documents/_generations/"), F.sha2("source", 256), F.lit("/"), publication,
        F.lit("/doc-"), F.col("doc_id"), F.lit(".txt"),
    )
    return table(spark, folder, "documents").select("doc_id", uri.alias("uri"))


@query(
    "parse_generation",
    """
    SELECT doc_id, CASE WHEN lang <> 'fr' THEN sha256(source) END AS plan_id,
           CASE WHEN lang <> 'fr' THEN repeat('0', 12) || '4000' || '8' || repeat('0', 15) END AS publication_id,
           CASE WHEN lang <> 'fr' THEN 'doc-' || doc_id || '.txt' END AS object_name
    FROM documents
    """,
)
def parse_generation(spark, folder):
    return integrity.parse_generation(_document_uris(spark, folder), "uri", "documents").drop("uri")


@query(
    "generation_check",
    """
    WITH found AS (
        SELECT 'uri_malformed' AS "check", count(*) FILTER (WHERE lang = 'fr') AS violations FROM documents
        UNION ALL SELECT 'uri_repeated', count(*) FROM (SELECT doc_id FROM documents GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'generation_differs', count(*) FILTER (WHERE lang <> 'fr' AND source <> 'src0') FROM documents)
    SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def generation_check(spark, folder):
    import hashlib

    parsed = integrity.parse_generation(_document_uris(spark, folder), "uri", "documents")
    plan = hashlib.sha256(b"src0").hexdigest()
    return integrity.generation_checks(parsed, "uri", plan, "0" * 12 + "4000" + "8" + "0" * 15)


@query(
    "provenance_compare",
    """
    SELECT coalesce(a.key, b.key) AS key, a.value AS left_value, b.value AS right_value
    FROM (SELECT 'customer.' || c_custkey AS key, c_mktsegment AS value FROM customer WHERE c_nationkey <> 3) a
    FULL JOIN (SELECT 'customer.' || c_custkey AS key, CASE WHEN c_nationkey = 4 THEN 'OTHER' ELSE c_mktsegment END AS value
               FROM customer WHERE c_nationkey <> 5) b ON a.key = b.key
    WHERE a.value IS DISTINCT FROM b.value
    """,
)
def provenance_compare(spark, folder):
    customer = table(spark, folder, "customer")
    key = F.concat(F.lit("customer."), F.col("c_custkey")).alias("key")
    left = customer.where(F.col("c_nationkey") != 3).select(key, F.col("c_mktsegment").alias("value"))
    right = customer.where(F.col("c_nationkey") != 5).select(
        key, F.when(F.col("c_nationkey") == 4, "OTHER").otherwise(F.col("c_mktsegment")).alias("value")
    )
    return checks.provenance_differences(left, right)


@query(
    "provenance_checks",
    """
    WITH found AS (
        SELECT 'scale_unknown' AS "check", count(*) FILTER (WHERE event_type <> 'click') AS violations FROM events
        UNION ALL SELECT 'plan_malformed', 0 FROM (SELECT 1)
        UNION ALL SELECT 'publication_malformed', count(*) FILTER (WHERE substr(md5(cast(event_id AS varchar)), 13, 1) <> '4'
            OR substr(md5(cast(event_id AS varchar)), 17, 1) NOT IN ('8', '9', 'a', 'b')) FROM events
        UNION ALL SELECT 'manifest_malformed', count(*) FROM events)
    SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def provenance_checks(spark, folder):
    text = F.col("event_id").cast("string")
    identities = table(spark, folder, "events").select(
        F.when(F.col("event_type") == "click", "tiny").otherwise(F.col("event_type")).alias("scale"),
        F.sha2(text, 256).alias("plan_id"),
        F.md5(text).alias("publication_id"),
        F.md5(text).alias("manifest_sha256"),
    )
    return integrity.provenance_checks(identities)


CELL_CONTRACT = [
    ("o_orderkey", "int8", False),
    ("o_custkey", "uint16", False),
    ("o_orderstatus", "boolean", False),
    ("o_totalprice", "decimal(7,2)", False),
    ("o_orderdate", "date", False),
    ("o_orderpriority", "string", True),
    ("stamp", "timestamp-tz", False),
    ("local", "timestamp", True),
    ("share", "float32", True),
]

CELL_SQL = """
    WITH found AS (
        SELECT 'o_orderkey:int8' AS "check", count(*) FILTER (WHERE o_orderkey > 127) AS violations FROM orders
        UNION ALL SELECT 'o_custkey:uint16', count(*) FILTER (WHERE o_custkey > 65535) FROM orders
        UNION ALL SELECT 'o_orderstatus:boolean', count(*) FROM orders
        UNION ALL SELECT 'o_totalprice:decimal(7,2)', count(*) FILTER (WHERE o_totalprice >= 100000) FROM orders
        UNION ALL SELECT 'o_orderdate:date', 0
        UNION ALL SELECT 'o_orderpriority:string', 0
        UNION ALL SELECT 'stamp:timestamp-tz', count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders
        UNION ALL SELECT 'local:timestamp', count(*) FILTER (WHERE o_orderstatus = 'O') FROM orders
        UNION ALL SELECT 'share:float32', count(*) FILTER (WHERE o_orderpriority = '5-LOW') FROM orders)
    SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
"""


def _order_cells(spark, folder):
    """Orders as text cells; some forms are illegal by status or priority."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.concat(F.lit("+"), F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("o_totalprice"),
        day.alias("o_orderdate"),
        "o_orderpriority",
        F.concat(day, F.lit("T12:30:59"), F.when(status == "P", "").otherwise("-07:30")).alias("stamp"),
        F.concat(day, F.when(status == "O", "T24:00:00").otherwise("T23:59:59.123456789")).alias("local"),
        F.when(F.col("o_orderpriority") == "5-LOW", "4" + "0" * 38).otherwise(".5").alias("share"),
    )


@query("typed_cell_check", CELL_SQL)
def typed_cell_check(spark, folder):
    return integrity.cell_checks(_order_cells(spark, folder), CELL_CONTRACT)


@query(
    "csv_cell_check",
    CELL_SQL.replace("FROM found", "FROM (SELECT * FROM found UNION ALL SELECT 'row_width', 0)"),
)
def csv_cell_check(spark, folder):
    """The same cells written to CSV files and checked as read."""
    path = shared_folder(spark, "cells")
    cells = _order_cells(spark, folder)
    cells.write.option("header", True).csv(path)
    names = [name for name, _, _ in CELL_CONTRACT]
    files.require_csv_header(spark, path, names)
    return integrity.cell_checks(files.read_csv_text(spark, path, names), CELL_CONTRACT, corrupt="_corrupt")


JSON_CONTRACT = [
    ("id", "string", False),
    ("type", "string", False),
    ("actor.login", "string", False),
    ("repo.name", "string", False),
    ("created_at", "timestamp-tz", False),
    ("weight", "decimal(4,2)", True),
    ("rank", "int8", False),
    ("flag", "boolean", True),
]


def _json_lines(spark, folder):
    """Event lines with typed members; error events are duplicated members, views miss the rank."""
    rows = table(spark, folder, "events")
    k = F.from_json("props", "k int")["k"]
    line = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_type").alias("type"),
            F.struct(F.concat(F.lit("[{u"), F.col("user_id")).alias("login")).alias("actor"),
            F.struct(F.col("props").alias("name")).alias("repo"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
            F.col("value").cast("decimal(18,2)").alias("weight"),
            F.when(F.col("event_type") != "view", F.col("user_id")).alias("rank"),
            (k > 50).alias("flag"),
        )
    )
    twice = F.concat(F.lit('{"id":"x",'), F.substring(line, F.lit(2), F.length(line)))
    return rows.select(F.when(F.col("event_type") == "error", twice).otherwise(line).alias("value"))


@query(
    "json_contract",
    """
    WITH e AS (SELECT *, event_type <> 'error' AS fine FROM events), found AS (
        SELECT 'no_records' AS "check", 0 AS violations
        UNION ALL SELECT 'line_too_long', 0
        UNION ALL SELECT 'depth_exceeded', 0
        UNION ALL SELECT 'not_one_object', count(*) FILTER (WHERE NOT fine) FROM e
        UNION ALL SELECT 'id:string', 0 UNION ALL SELECT 'type:string', 0 UNION ALL SELECT 'actor.login:string', 0
        UNION ALL SELECT 'repo.name:string', 0 UNION ALL SELECT 'created_at:timestamp-tz', 0
        UNION ALL SELECT 'weight:decimal(4,2)', count(*) FILTER (WHERE fine AND value >= 100 AND
            NOT (value < 1000 AND round(value, 1) = value)) FROM e
        UNION ALL SELECT 'rank:int8', count(*) FILTER (WHERE fine AND (event_type = 'view' OR user_id > 127)) FROM e
        UNION ALL SELECT 'flag:boolean', 0
        UNION ALL SELECT 'members_differ:record', count(*) FILTER (WHERE event_type = 'view' OR NOT fine) FROM e
        UNION ALL SELECT 'members_differ:actor', 0 UNION ALL SELECT 'members_differ:repo', 0)
    SELECT "check", cast(violations AS bigint) AS violations,
           CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def json_contract(spark, folder):
    return integrity.json_line_checks(_json_lines(spark, folder), "value", JSON_CONTRACT, exact=True)


@query(
    "landing_check",
    """
    SELECT n AS "check", CASE WHEN n IN ('not_one_object', 'id:text', 'type:text', 'actor.login:text', 'repo.name:text',
               'created_at:text', 'created_at:canonical') THEN (SELECT count(*) FROM pages) ELSE 0 END AS violations,
           CASE WHEN n IN ('not_one_object', 'id:text', 'type:text', 'actor.login:text', 'repo.name:text',
               'created_at:text', 'created_at:canonical') THEN 'fail' ELSE 'pass' END AS status
    FROM (SELECT unnest(['no_records', 'line_too_long', 'blank_line', 'depth_exceeded', 'not_one_object', 'id:text',
        'type:text', 'actor.login:text', 'repo.name:text', 'created_at:text', 'created_at:canonical']) AS n)
    """,
)
def landing_check(spark, folder):
    """Event files in landing form, with the addresses of the pages mixed in as lines."""
    lines = spark.read.text(event_lines(spark, folder)).unionByName(
        table(spark, folder, "pages").select(F.col("url").alias("value"))
    )
    return integrity.landing_event_checks(lines)


@query(
    "parquet_contract",
    """
    SELECT t.*, (SELECT count(*) FROM orders) AS rows_affected
    FROM (VALUES (1, 'o_custkey', 'int32', 'o_custkey', 'int64'), (6, 'o_comment', 'string', NULL, NULL))
        AS t(position, contract_column, contract_type, observed_column, observed_type)
    """,
)
def parquet_contract(spark, folder):
    """The schema of the orders file against a contract that asks for a narrower key and a comment."""
    contract = spark.createDataFrame(
        [
            (0, "o_orderkey", "int64"),
            (1, "o_custkey", "int32"),
            (2, "o_orderstatus", "string"),
            (3, "o_totalprice", "float64"),
            (4, "o_orderdate", "timestamp"),
            (5, "o_orderpriority", "string"),
            (6, "o_comment", "string"),
        ],
        "position int, column_name string, logical_type string",
    )
    differences = integrity.compare_columns(files.parquet_columns(spark, f"{folder}/orders.parquet"), contract)
    return differences.withColumn("rows_affected", table(spark, folder, "orders").agg(F.count(F.lit(1))).scalar())


@query("file_digest")
def file_digest(spark, folder):
    """Name, size and sha256 of every table file."""
    digests = files.digests(spark, folder, "*.parquet")
    return digests.select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes", "sha256")


@query(
    "utf8_files",
    """
    SELECT source, count(*) FILTER (doc_id % 7 IN (0, 3)) AS lines FROM documents GROUP BY source
    HAVING count(*) FILTER (doc_id % 7 IN (0, 3)) > 0
    """,
)
def utf8_files(spark, folder):
    """Lines that are not UTF-8 in files of texts, one folder of files for each source, read split by split."""
    path = shared_folder(spark, "utf8-files")
    number = F.col("doc_id") % 7
    line = F.encode(F.translate(F.coalesce("text", F.lit("")), "\r\n", "  "), "UTF-8")
    broken = F.when(number == 0, F.concat(line, F.unhex(F.lit("C3")))).when(number == 3, F.concat(F.unhex(F.lit("FF")), line))
    texts = table(spark, folder, "documents").select("source", F.coalesce(broken, line).cast("string").alias("value"))
    texts.write.partitionBy("source").option("maxRecordsPerFile", 50_000).text(path)
    found = csv_scan.utf8_violations(files.raw_lines(spark, path))
    return found.groupBy(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source")).agg(F.sum("lines").alias("lines"))


@query(
    "content_digest",
    """
    SELECT doc_id AS name, octet_length(encode(text)) AS bytes, sha256(text) AS sha256,
           CASE doc_id % 5 WHEN 0 THEN 'digest_mismatch' WHEN 1 THEN 'size_mismatch' ELSE 'ok' END AS status FROM documents
    """,
)
def content_digest(spark, folder):
    """Every text as a file, against a lock that is wrong in the digest or the size of some."""
    name = F.col("doc_id")
    stored = table(spark, folder, "documents").select(
        name.alias("path"), F.octet_length("text").cast("long").alias("length"), F.encode("text", "UTF-8").alias("content")
    )
    observed = integrity.file_digests(stored).withColumnRenamed("path", "name")
    lock = observed.select(
        "name",
        F.when(F.col("name") % 5 == 1, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"),
        F.when(F.col("name") % 5 == 0, F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"),
    )
    return observed.join(integrity.verify_lock(observed, lock), "name")


@query(
    "content_utf8",
    "SELECT doc_id AS path FROM documents WHERE doc_id % 7 IN (0, 3)",
)
def content_utf8(spark, folder):
    """Texts whose bytes were cut inside a character, or that hold a byte no character begins with."""
    number = F.col("doc_id") % 7
    whole = F.encode("text", "UTF-8")
    content = F.when(number == 0, F.concat(whole, F.unhex(F.lit("C3")))).when(number == 3, F.concat(F.unhex(F.lit("FF")), whole))
    stored = table(spark, folder, "documents").select(F.col("doc_id").alias("path"), F.coalesce(content, whole).alias("content"))
    return integrity.utf8_violations(stored)


@query(
    "portable_snapshot",
    """
    WITH t AS (SELECT doc_id || chr(31) || lang || chr(31) || source || chr(31) || n_chars AS line FROM documents),
    h AS (
        SELECT cast('0x' || left(sha256('nyc-quality-a' || chr(31) || line), 15) AS bigint) AS a,
               cast('0x' || left(sha256('nyc-quality-b' || chr(31) || line), 15) AS bigint) AS b FROM t)
    SELECT 'doc_id:bigint,lang:string,n_chars:bigint,source:string' AS schema_text, count(*) AS row_count,
           cast(sum(a) AS decimal(38,0)) AS sum_a, bit_xor(a) AS xor_a,
           cast(sum(b) AS decimal(38,0)) AS sum_b, bit_xor(b) AS xor_b FROM h
    """,
)
def portable_snapshot(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return multiset.table_snapshot(documents, portable=True)


@query(
    "canonical_manifest",
    """
    SELECT sha256('{' || string_agg('"' || source || '":' || n, ',' ORDER BY source) || '}') AS manifest_sha256
    FROM (SELECT source, count(*) AS n FROM documents GROUP BY 1)
    """,
)
def canonical_manifest(spark, folder):
    """Documents per source as one compact JSON object, digested."""
    counts = table(spark, folder, "documents").groupBy("source").count()
    return integrity.canonical_manifest_digest(counts.select(F.col("source").alias("name"), F.col("count").cast("string").alias("value")))


@query(
    "schema_contracts",
    """
    SELECT contract, CASE WHEN met THEN n ELSE 0 END AS accepted_rows FROM (SELECT count(*) AS n FROM orders), (VALUES
        ('names_and_types', true), ('renamed_column', false), ('reordered_columns', false), ('columns_present', true),
        ('column_missing', false), ('column_of_another_type', false), ('nested_strings', true), ('nested_number', false),
        ('schema_digest', true), ('schema_digest_of_another_order', false)) AS t(contract, met)
    """,
)
def schema_contracts(spark, folder):
    """Rows of orders that each schema contract lets through: all of them, or none."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    schema = orders.schema
    nested = orders.select(F.struct("o_orderstatus", "o_orderkey").alias("o"))
    digest = checks.schema_sha256(schema)

    def same_digest(frame):
        if checks.schema_sha256(frame.schema) != digest:
            raise checks.ContractError("schema digest differs")
        return frame

    kinds = {field.name: field.dataType for field in schema.fields}
    contracts = {
        "names_and_types": (orders, lambda frame: checks.require_names_and_types(frame, schema)),
        "renamed_column": (orders.withColumnRenamed("o_orderkey", "O_ORDERKEY"), lambda frame: checks.require_names_and_types(frame, schema)),
        "reordered_columns": (orders.select("o_orderstatus", "o_orderkey"), lambda frame: checks.require_names_and_types(frame, schema)),
        "columns_present": (orders.withColumn("more", F.lit(1)), lambda frame: checks.require_columns(frame, kinds)),
        "column_missing": (orders.drop("o_orderstatus"), lambda frame: checks.require_columns(frame, kinds)),
        "column_of_another_type": (
            orders.withColumn("o_orderkey", F.col("o_orderkey").cast("string")), lambda frame: checks.require_columns(frame, kinds)
        ),
        "nested_strings": (nested, lambda frame: checks.require_nested_strings(frame, ["o.o_orderstatus"])),
        "nested_number": (nested, lambda frame: checks.require_nested_strings(frame, ["o.o_orderkey"])),
        "schema_digest": (orders, same_digest),
        "schema_digest_of_another_order": (orders.select("o_orderstatus", "o_orderkey"), same_digest),
    }
    outcomes = []
    for name, (frame, require) in contracts.items():
        try:
            accepted = require(frame)
        except checks.ContractError:
            accepted = frame.limit(0)
        outcomes.append(accepted.agg(F.count(F.lit(1)).alias("accepted_rows")).withColumn("contract", F.lit(name)))
    return functools.reduce(DataFrame.unionByName, outcomes).select("contract", "accepted_rows")


@query(
    "nested_columns",
    """
    SELECT cast(event_id AS varchar) AS id, 'u' || user_id AS login FROM events
    """,
)
def nested_columns(spark, folder):
    from tidemark.operators.events import flatten_columns

    return flatten_columns(nested_events(spark, folder), {"id": "id", "login": "actor.login"})


_CSV_FILES = """
    WITH sized AS (SELECT *, 2 * (1 + (SELECT count(*) FROM orders) // 400000) AS parts FROM orders),
    dealt AS (SELECT *, split_part(o_orderpriority, '-', 1) AS kind, o_orderkey % parts AS part FROM sized),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY kind, part ORDER BY o_orderkey) AS record FROM dealt),
    found AS (
      SELECT kind, part, CASE kind WHEN '1' THEN 'header' ELSE 'byte_order_mark' END AS violation, 0 AS record
      FROM ranked WHERE kind IN ('1', '2')
      UNION ALL
      SELECT kind, part, CASE WHEN kind = '5' THEN 'quoting' WHEN part % 2 = 0 THEN 'width' ELSE 'quoting' END, record
      FROM ranked WHERE kind IN ('3', '5') AND o_orderkey // 32 % 7 = 3)
"""


@query(
    "csv_file_violations",
    _CSV_FILES + "SELECT kind, part, violation, min(record) AS record FROM found GROUP BY ALL",
)
def csv_file_violations(spark, folder):
    """Orders in CSV files of a bounded size, some of them compressed, in five kinds by priority.

    1 has its columns swapped and is compressed, 2 begins with a byte order mark, 3 has some rows with a cell more or with a
    quote in a bare cell, 4 has quoted cells over two lines, as agreed, 5 has some quotes that are not closed.
    """
    path = shared_folder(spark, "csv-files")
    names = ["o_orderkey", "o_totalprice", "o_orderdate"]
    _write_csv_files(table(spark, folder, "orders"), path)
    found = files.csv_violations(spark, path, names)
    place = "kind=([0-9])/part=([0-9]+)/"
    return found.select(
        F.regexp_extract("path", place, 1).alias("kind"),
        F.regexp_extract("path", place, 2).cast("long").alias("part"),
        "violation",
        "record",
    )


def _write_csv_files(orders, path):
    """One file for each kind and part; the parts are as many as keep a file below 100,000 rows or so."""
    parts = 2 * (1 + orders.count() // 400_000)
    dealt = orders.withColumns({"kind": F.substring("o_orderpriority", 1, 1), "part": F.col("o_orderkey") % parts})
    odd = F.floor(F.col("o_orderkey") / 32) % 7 == 3
    cells = F.concat_ws(",", "o_orderkey", "o_totalprice", "o_orderdate")
    line = (
        F.when((F.col("kind") == "5") & odd, F.concat(F.lit('"'), cells))
        .when((F.col("kind") == "3") & odd & (F.col("part") % 2 == 0), F.concat(cells, F.lit(",more")))
        .when((F.col("kind") == "3") & odd, F.concat(cells, F.lit('"')))
        .when(F.col("kind") == "4", F.concat_ws(",", "o_orderkey", F.lit('"two\nlines, ""quoted"""'), "o_orderdate"))
        .otherwise(cells)
    )
    header = (
        F.when(F.col("kind") == "1", "o_totalprice,o_orderkey,o_orderdate")
        .when(F.col("kind") == "2", "\ufeffo_orderkey,o_totalprice,o_orderdate")
        .otherwise("o_orderkey,o_totalprice,o_orderdate")
    )
    heads = dealt.select("kind", "part").distinct().select("kind", "part", F.lit(-1).alias("place"), header.alias("value"))
    lines = heads.unionByName(dealt.select("kind", "part", F.col("o_orderkey").alias("place"), line.alias("value")))
    ordered = lines.repartition("kind", "part").sortWithinPartitions("kind", "part", "place").drop("place")
    for archived in (False, True):
        chosen = ordered.where((F.col("kind") == "1") == archived)
        chosen.write.mode("append").partitionBy("kind", "part").option("compression", "gzip" if archived else "none").text(path)
