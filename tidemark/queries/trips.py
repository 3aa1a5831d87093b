"""Cleaning, normalisation, deduplication, exports and catalog tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cleaning
from tidemark.queries.registry import query, table
from tidemark.session import shared_folder
from tidemark.sources import exports, files, tables

LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)


@query(
    "clean_trips",
    "SELECT *, cast(l_shipdate AS date) AS ship_date FROM lineitem WHERE l_shipdate IS NOT NULL AND l_quantity > 0",
)
def clean_trips(spark, folder):
    return cleaning.clean_trips(table(spark, folder, "lineitem"), "l_shipdate", "l_quantity", "ship_date")


@query(
    "normalize_union",
    "SELECT l_orderkey, cast(l_linenumber AS double) AS l_linenumber, l_quantity, l_returnflag FROM lineitem",
)
def normalize_union(spark, folder):
    """One folder per return flag, each with another physical type of the drifting column."""
    base = shared_folder(spark, "drift")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    flag = F.coalesce("l_returnflag", F.lit(""))
    parts = {"int": flag == "A", "bigint": flag == "N", "double": ~flag.isin("A", "N")}
    for kind, chosen in parts.items():
        part = lines.where(chosen).withColumn("l_linenumber", F.col("l_linenumber").cast(kind))
        part.write.parquet(f"{base}/{kind}")
    return files.read_parquet_normalised(spark, [f"{base}/{kind}" for kind in parts], {"l_linenumber": "double"})


@query(
    "silver_dedupe",
    f"""
    SELECT {LINE_COLUMNS} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_COLUMNS}) = 1
    """,
)
def silver_dedupe(spark, folder):
    return cleaning.dedupe(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("export_sorted", "SELECT * FROM lineitem")
def export_sorted(spark, folder):
    path = shared_folder(spark, "export")
    exports.export_sorted(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], path)
    return files.read_parquet(spark, path)


@query("compact_rows", "SELECT * FROM orders")
def compact_rows(spark, folder):
    small, large = shared_folder(spark, "small"), shared_folder(spark, "compact")
    table(spark, folder, "orders").repartition(24).write.parquet(small)
    exports.compact(spark, small, large)
    return files.read_parquet(spark, large)


def _namespaces(spark):
    """Two fresh namespaces below the shared folder."""
    root = shared_folder(spark, "catalog")
    suffix = root.rsplit("-", 1)[1]
    names = [f"silver_{suffix}", f"gold_{suffix}"]
    tables.ensure_namespaces(spark, names, root)
    return names


@query(
    "table_replace",
    """
    SELECT c_nationkey, count(*) AS customers, '3' AS stored_plan, 'customer' AS stored_dataset
    FROM customer GROUP BY c_nationkey
    """,
)
def table_replace(spark, folder):
    """Replace a table twice with properties, verify the readback, and report rows with properties."""
    silver, _ = _namespaces(spark)
    name = f"{silver}.customers"
    counts = table(spark, folder, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    tables.replace_table(counts.where(F.col("customers") < 0), name, {"plan": "2"})
    stored = exports.replace_verified(counts, name, {"dataset": "customer", "plan": "3"})
    found = tables.read_properties(spark, name, ["plan", "dataset"])
    by_key = found.agg(
        F.max(F.when(F.col("key") == "plan", F.col("value"))).alias("p"),
        F.max(F.when(F.col("key") == "dataset", F.col("value"))).alias("d"),
    )
    return stored.select(
        "*", by_key.select("p").scalar().alias("stored_plan"), by_key.select("d").scalar().alias("stored_dataset")
    )


@query(
    "table_append",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_totalprice > 400000
    """,
)
def table_append(spark, folder):
    """Create an empty table from a schema, create-if-absent, and append by position."""
    silver, _ = _namespaces(spark)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    tables.create_empty_table(spark, f"{silver}.orders", orders.schema)
    tables.append_rows(orders, f"{silver}.orders")
    tables.create_table_if_absent(orders.limit(0), f"{silver}.orders")
    tables.append_rows(orders.where(F.col("o_totalprice") > 400000), f"{silver}.orders")
    return files.read_table(spark, f"{silver}.orders")


@query(
    "table_ctas",
    "SELECT o_orderdate, count(*) AS orders FROM orders GROUP BY o_orderdate",
)
def table_ctas(spark, folder):
    """Create a table from a query if absent; the second statement finds it and does nothing."""
    silver, _ = _namespaces(spark)
    days = table(spark, folder, "orders").groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("orders"))
    tables.create_table_if_absent(days, f"{silver}.days")
    tables.create_table_if_absent(days.limit(0), f"{silver}.days")
    return files.read_table(spark, f"{silver}.days")


@query(
    "table_properties",
    """
    SELECT t AS source_table, k AS key, CASE k WHEN 'dataset' THEN 'tpch' ELSE cast((SELECT count(*) FROM customer) AS varchar) END AS value
    FROM (SELECT unnest(['dim_customer', 'fct_customer']) AS t), (SELECT unnest(['dataset', 'dataset.rows']) AS k)
    """,
)
def table_properties(spark, folder):
    """Properties of two tables in one listing, tagged by table."""
    silver, gold = _namespaces(spark)
    customer = table(spark, folder, "customer")
    provenance = {"dataset": "tpch", "dataset.rows": str(customer.count())}
    names = {"dim_customer": f"{gold}.dim_customer", "fct_customer": f"{silver}.fct_customer"}
    for name in names.values():
        exports.replace_verified(customer, name, provenance)
    return tables.tagged_properties(spark, names, list(provenance))


@query(
    "table_metadata",
    """
    SELECT * FROM (VALUES
        ('dim_customer', 1, 'c_custkey', 'bigint'), ('dim_customer', 2, 'c_name', 'string'),
        ('dim_customer', 3, 'c_nationkey', 'int'), ('dim_customer', 4, 'c_mktsegment', 'string'),
        ('fct_orders', 1, 'o_orderkey', 'bigint'), ('fct_orders', 2, 'o_custkey', 'bigint'),
        ('fct_orders', 3, 'o_orderdate', 'timestamp_ntz'), ('fct_orders', 4, 'revenue', 'decimal(25,2)'),
        ('fct_orders', 5, 'line_count', 'bigint')
    ) AS t(table_name, position, column_name, data_type)
    """,
)
def table_metadata(spark, folder):
    """Columns of both star tables as the catalog reports them after the application has run."""
    from tidemark.operators import star

    _, gold = _namespaces(spark)
    provenance = {"dataset": "tpch", "dataset.scale": "tiny"}
    orders, lineitem = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    exports.replace_verified(
        star.customer_dimension(table(spark, folder, "customer")), f"{gold}.dim_customer", provenance
    )
    exports.replace_verified(star.order_fact(orders, lineitem), f"{gold}.fct_orders", provenance)
    return tables.table_columns(spark, [f"{gold}.dim_customer", f"{gold}.fct_orders"])


@query(
    "table_lifecycle",
    """
    SELECT step, cast(rows AS bigint) AS rows FROM (SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f FROM orders),
        LATERAL (SELECT unnest(['created', 'appended', 'replaced_from_itself', 'dropped', 'smoke']) AS step,
                        unnest([0, n, f, -1, 1]) AS rows)
    """,
)
def table_lifecycle(spark, folder):
    """Rows of a table after each step; -1 once it is gone. A table is replaced by rows read from itself."""
    silver, _ = _namespaces(spark)
    name = f"{silver}.lifecycle"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    tables.drop_table(spark, name)
    tables.create_empty_table(spark, name, orders.schema)
    steps = [("created", spark.table(name).count())]
    tables.append_rows(orders, name)
    steps.append(("appended", spark.table(name).count()))
    tables.replace_table(spark.table(name).where(F.col("o_orderstatus") == "F"), name)
    steps.append(("replaced_from_itself", spark.table(name).count()))
    tables.drop_table(spark, name)
    steps.append(("dropped", spark.table(name).count() if spark.catalog.tableExists(name) else -1))
    steps.append(("smoke", tables.smoke(spark, f"{silver}.smoke")))
    return spark.createDataFrame(steps, "step string, rows long")


@query(
    "temp_view_statement",
    "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY o_orderstatus",
)
def temp_view_statement(spark, folder):
    statement = "SELECT o_orderstatus, count(*) AS orders FROM staged_orders GROUP BY o_orderstatus"
    return tables.with_temp_view(table(spark, folder, "orders"), "staged_orders", statement)
