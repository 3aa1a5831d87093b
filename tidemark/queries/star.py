"""Star schema, revenue reports and rating features."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import checks, features, star
from tidemark.plans import artifacts
from tidemark.queries.registry import query, table
from tidemark.session import shared_folder
from tidemark.sources import files

FACT_SQL = """
    SELECT o_orderkey, o_custkey, o_orderdate,
           cast(sum(cast(l_extendedprice AS decimal(15,2))) AS decimal(25,2)) AS revenue,
           count(*) AS line_count
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY o_orderkey, o_custkey, o_orderdate
"""
SEGMENT_SQL = f"""
    SELECT c_mktsegment AS market_segment, cast(sum(revenue) AS decimal(38,2)) AS total_revenue,
           cast(sum(line_count) AS bigint) AS line_count, count(*) AS order_count
    FROM ({FACT_SQL}) f JOIN customer ON o_custkey = c_custkey
    GROUP BY c_mktsegment
"""
DAILY_SQL = """
    SELECT cast(o_orderdate AS date) AS day, count(*) AS orders,
           cast(sum(cast(o_totalprice AS decimal(15,2))) AS double) / count(o_totalprice) AS avg_price
    FROM orders GROUP BY 1
"""


def order_fact(spark, folder):
    return star.order_fact(table(spark, folder, "orders"), table(spark, folder, "lineitem"))


def dimension(spark, folder):
    return star.customer_dimension(table(spark, folder, "customer"))


@query("dim_customer", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def dim_customer(spark, folder):
    return dimension(spark, folder)


@query("fct_orders", FACT_SQL)
def fct_orders(spark, folder):
    return order_fact(spark, folder)


@query("segment_revenue", SEGMENT_SQL + " ORDER BY market_segment")
def segment_revenue(spark, folder):
    return star.segment_revenue(order_fact(spark, folder), dimension(spark, folder)).orderBy("market_segment")


SEGMENT_ORDERS_SQL = """
    SELECT c_mktsegment, cast(sum(cast(o_totalprice AS decimal(15,2))) AS decimal(38,2)) AS total_price,
           count(*) AS order_count
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY c_mktsegment
"""


@query("segment_broadcast", SEGMENT_ORDERS_SQL)
def segment_broadcast(spark, folder):
    return star.segment_orders(table(spark, folder, "orders"), table(spark, folder, "customer"))


@query("segment_shuffled", SEGMENT_ORDERS_SQL)
def segment_shuffled(spark, folder):
    return star.segment_orders(table(spark, folder, "orders"), table(spark, folder, "customer"), limit_bytes=0)


@query(
    "source_totals",
    f"""
    SELECT count(*) AS fact_order_count, cast(sum(revenue) AS decimal(38,2)) AS fact_revenue,
           cast(sum(line_count) AS bigint) AS fact_line_count,
           cast(count(*) FILTER (WHERE c_custkey IS NULL) AS bigint) AS unmatched_orders
    FROM ({FACT_SQL}) f LEFT JOIN customer ON o_custkey = c_custkey
    """,
)
def source_totals(spark, folder):
    return star.source_totals(order_fact(spark, folder), dimension(spark, folder))


@query(
    "source_checks",
    """
    WITH found AS (
        SELECT 'customer_null_key' AS "check", count(*) FILTER (WHERE c_custkey IS NULL) AS violations FROM customer
        UNION ALL SELECT 'customer_duplicate_key', count(*) FROM (
            SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'orders_null_key', count(*) FILTER (WHERE o_orderkey IS NULL) FROM orders
        UNION ALL SELECT 'orders_duplicate_key', count(*) FROM (
            SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'lineitem_null_key',
            count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) FROM lineitem
        UNION ALL SELECT 'lineitem_duplicate_key', count(*) FROM (
            SELECT 1 FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        UNION ALL SELECT 'orders_without_customer', count(*) FROM orders
            WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
        UNION ALL SELECT 'lineitem_without_order', count(*) FROM lineitem
            WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
    )
    SELECT "check", violations, CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def source_checks(spark, folder):
    return checks.star_source_checks(*[table(spark, folder, name) for name in ("customer", "orders", "lineitem")])


@query(
    "lines_without_part",
    """
    SELECT n.name AS "check", n.violations, CASE WHEN n.violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
        SELECT 'lines_without_small_part' AS name, count(*) AS violations FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size <= 25)) n
    """,
)
def lines_without_part(spark, folder):
    small = table(spark, folder, "part").where(F.col("p_size") <= 25)
    return checks.reference_check(
        table(spark, folder, "lineitem"), "l_partkey", small, "p_partkey", "lines_without_small_part"
    )


@query(
    "bi_reconcile",
    f"""
    WITH s AS ({SEGMENT_SQL}), f AS ({FACT_SQL}),
    t AS (SELECT sum(revenue) AS revenue, sum(line_count) AS lines, count(*) AS orders,
                 count(*) FILTER (WHERE c_custkey IS NULL) AS unmatched
          FROM f LEFT JOIN customer ON o_custkey = c_custkey),
    a AS (SELECT count(*) AS n, count(DISTINCT market_segment) AS names,
                 count(*) FILTER (WHERE line_count < order_count) AS short,
                 count(*) FILTER (WHERE NOT total_revenue > 0) AS unpaid,
                 sum(total_revenue) AS revenue, sum(line_count) AS lines, sum(order_count) AS orders FROM s),
    found AS (
        SELECT 'segment_count' AS "check", abs(n - 5) AS violations FROM a
        UNION ALL SELECT 'segment_repeated', n - names FROM a
        UNION ALL SELECT 'fewer_lines_than_orders', short FROM a
        UNION ALL SELECT 'revenue_not_positive', unpaid FROM a
        UNION ALL SELECT 'revenue_differs', cast(a.revenue IS DISTINCT FROM t.revenue AS int) FROM a, t
        UNION ALL SELECT 'lines_differ', cast(a.lines IS DISTINCT FROM t.lines AS int) FROM a, t
        UNION ALL SELECT 'orders_differ', cast(a.orders IS DISTINCT FROM t.orders AS int) FROM a, t
        UNION ALL SELECT 'unmatched_orders', unmatched FROM t
    )
    SELECT "check", cast(violations AS bigint) AS violations,
           CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def bi_reconcile(spark, folder):
    fact, dim = order_fact(spark, folder), dimension(spark, folder)
    return artifacts.segment_reconciliation(star.segment_revenue(fact, dim), star.source_totals(fact, dim))


@query(
    "bi_artifact",
    f"""
    WITH r AS (
        SELECT market_segment, '["' || market_segment || '","' || cast(total_revenue AS varchar) || '",' ||
               line_count || ',' || order_count || ']' AS line
        FROM ({SEGMENT_SQL}) s),
    p AS (SELECT count(*) AS row_count, '[' || string_agg(line, ',' ORDER BY market_segment) || ']' AS rows_json FROM r)
    SELECT row_count, rows_json, sha256(
        '{{"columns":[{{"name":"market_segment","type":"varchar"}},{{"name":"total_revenue","type":"decimal(38,2)"}},' ||
        '{{"name":"line_count","type":"bigint"}},{{"name":"order_count","type":"bigint"}}],"rows":' || rows_json || '}}'
    ) AS result_sha256 FROM p
    """,
)
def bi_artifact(spark, folder):
    return artifacts.segment_artifact(star.segment_revenue(order_fact(spark, folder), dimension(spark, folder)))


def _daily(spark, folder):
    from tidemark.operators.cleaning import daily_totals

    return daily_totals(
        table(spark, folder, "orders"), F.to_date("o_orderdate").alias("day"), "o_totalprice", "orders", "avg_price",
        exact_type="decimal(15,2)",
    )


@query("gold_daily", DAILY_SQL)
def gold_daily(spark, folder):
    return _daily(spark, folder)


@query(
    "daily_reconcile",
    f"""
    WITH d AS ({DAILY_SQL}), found AS (
        SELECT 'rows_differ' AS "check", abs((SELECT sum(orders) FROM d) - (SELECT count(*) FROM orders)) AS violations
        UNION ALL SELECT 'day_repeated', (SELECT count(day) - count(DISTINCT day) FROM d)
        UNION ALL SELECT 'day_null', (SELECT count(*) FROM d WHERE day IS NULL)
        UNION ALL SELECT 'over_row_bound', (SELECT greatest(count(*) - 4000, 0) FROM d))
    SELECT "check", cast(violations AS bigint) AS violations,
           CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def daily_reconcile(spark, folder):
    return artifacts.daily_reconciliation(_daily(spark, folder), "day", "orders", table(spark, folder, "orders"))


@query(
    "daily_artifact",
    """
    WITH r AS (
        SELECT day, '["' || strftime(day, '%Y-%m-%d') || '",' || orders || ',"' ||
               regexp_replace(regexp_replace(cast(total AS varchar), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') || '"]' AS line
        FROM (SELECT cast(o_orderdate AS date) AS day, count(*) AS orders,
                     sum(cast(o_totalprice AS decimal(15,2))) AS total FROM orders GROUP BY 1)),
    p AS (SELECT count(*) AS row_count, '[' || string_agg(line, ',' ORDER BY day) || ']' AS rows_json FROM r)
    SELECT row_count, rows_json, sha256(
        '{"columns":[{"name":"trip_date","type":"date"},{"name":"trip_count","type":"bigint"},' ||
        '{"name":"avg_fare","type":"double"}],"rows":' || rows_json || '}') AS result_sha256 FROM p
    """,
)
def daily_artifact(spark, folder):
    days = table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(15,2)")).alias("total")
    )
    return artifacts.daily_artifact(days, "day", "orders", "total")


# --- rating features ----------------------------------------------------------------------------

USER_FEATURE_SQL = """
    SELECT user_id, cast(sum(cast(value AS decimal(18,2))) AS double) / count(value) AS avg_rating,
           count(*) AS num_ratings
    FROM events GROUP BY user_id
"""


@query("user_features", USER_FEATURE_SQL)
def user_features(spark, folder):
    return features.user_features(table(spark, folder, "events"), "user_id", "value", "decimal(18,2)")


@query(
    "item_features",
    """
    SELECT l_partkey, cast(sum(cast(l_quantity AS decimal(18,2))) AS double) / count(l_quantity) AS movie_avg,
           count(*) AS popularity
    FROM lineitem GROUP BY l_partkey
    """,
)
def item_features(spark, folder):
    return features.item_features(table(spark, folder, "lineitem"), "l_partkey", "l_quantity", "decimal(18,2)")


@query(
    "popular_items",
    """
    SELECT l_partkey, count(*) AS popularity FROM lineitem
    GROUP BY l_partkey ORDER BY popularity DESC, l_partkey LIMIT 10
    """,
)
def popular_items(spark, folder):
    items = features.item_features(table(spark, folder, "lineitem"), "l_partkey", "l_quantity", "decimal(18,2)")
    return items.orderBy(F.desc("popularity"), F.asc("l_partkey")).limit(10).select("l_partkey", "popularity")


@query(
    "feature_checks",
    f"""
    WITH u AS ({USER_FEATURE_SQL}), found AS (
        SELECT 'user_id_null_key' AS "check", (SELECT count(*) FROM u WHERE user_id IS NULL) AS violations
        UNION ALL SELECT 'user_id_duplicate_key', (SELECT count(*) - count(DISTINCT user_id) FROM u)
        UNION ALL SELECT 'mean_not_finite', (SELECT count(*) FROM u WHERE avg_rating IS NULL OR NOT isfinite(avg_rating))
        UNION ALL SELECT 'count_not_positive', (SELECT count(*) FROM u WHERE num_ratings <= 0)
        UNION ALL SELECT 'counts_differ_from_source',
            abs((SELECT sum(num_ratings) FROM u) - (SELECT count(*) FROM events))
        UNION ALL SELECT 'ratings_empty', (SELECT cast(count(*) = 0 AS int) FROM events)
        UNION ALL SELECT 'ratings_null', (SELECT count(*) FROM events WHERE user_id IS NULL OR event_id IS NULL OR value IS NULL)
        UNION ALL SELECT 'ratings_not_finite', (SELECT count(*) FROM events WHERE value IS NULL OR NOT isfinite(value)))
    SELECT "check", cast(violations AS bigint) AS violations,
           CASE WHEN violations = 0 THEN 'pass' ELSE 'fail' END AS status FROM found
    """,
)
def feature_checks(spark, folder):
    ratings = table(spark, folder, "events").select("user_id", "event_id", "value")
    by_user = features.user_features(ratings, "user_id", "value", "decimal(18,2)")
    return checks.feature_checks(by_user, "user_id", "avg_rating", "num_ratings", ratings).unionByName(
        checks.ratings_checks(ratings, "user_id", "event_id", "value")
    )


RATING_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

CSV_SQL = """
    SELECT l_partkey AS "movieId", cast(sum(cast(l_quantity AS decimal(18,2))) AS double) / count(*) AS movie_avg,
           count(*) AS popularity
    FROM lineitem GROUP BY l_partkey
"""


def _ratings_csv(spark, folder):
    path = shared_folder(spark, "ratings")
    ratings = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        F.col("l_quantity").alias("rating"),
        F.unix_timestamp("l_shipdate").alias("timestamp"),
    )
    ratings.write.option("header", True).csv(path)
    return path


@query("csv_strict_features", CSV_SQL)
def csv_strict_features(spark, folder):
    ratings = files.read_csv_strict(spark, _ratings_csv(spark, folder), RATING_SCHEMA)
    return features.item_features(ratings, exact_type="decimal(18,2)")


@query("csv_inferred_features", CSV_SQL.replace("l_partkey AS", "cast(l_partkey AS int) AS"))
def csv_inferred_features(spark, folder):
    ratings = files.read_csv_inferred(spark, _ratings_csv(spark, folder))
    return features.item_features(ratings, exact_type="decimal(18,2)")
