import datetime
import decimal

import pytest
from conftest import SMALL, plan_of

from tidemark.operators import checks, features, star
from tidemark.plans import applications, artifacts
from tidemark.sources import tables

D = decimal.Decimal


@pytest.fixture
def sources(spark):
    customer = spark.createDataFrame(
        [(1, "Alice", 10, "BUILDING"), (2, "Bob", 20, "AUTOMOBILE")],
        "c_custkey long, c_name string, c_nationkey int, c_mktsegment string",
    )
    orders = spark.createDataFrame(
        [(100, 1, datetime.date(2026, 1, 2)), (101, 2, datetime.date(2026, 1, 3))],
        "o_orderkey long, o_custkey long, o_orderdate date",
    )
    lineitem = spark.createDataFrame(
        [(100, 1, D("10.25")), (100, 2, D("2.75")), (101, 1, D("9.00"))],
        "l_orderkey long, l_linenumber int, l_extendedprice decimal(15,2)",
    )
    return customer, orders, lineitem


def test_fact_sums_lines_per_order(sources, rows):
    _, orders, lineitem = sources
    fact = star.order_fact(orders, lineitem)
    assert rows(fact, "o_orderkey", "revenue", "line_count") == [(100, D("13.00"), 2), (101, D("9.00"), 1)]
    assert dict(fact.dtypes)["revenue"] == "decimal(25,2)"


def test_source_contract_reports_every_key_defect(spark, sources, violations):
    customer, orders, lineitem = sources
    assert set(violations(checks.star_source_checks(*sources)).values()) == {0}
    bad_customer = customer.unionAll(customer.limit(1)).unionAll(customer.limit(1).selectExpr("null", "c_name", "c_nationkey", "c_mktsegment"))
    dangling = orders.unionAll(spark.createDataFrame([(102, 9, None)], orders.schema))
    lost = lineitem.unionAll(spark.createDataFrame([(500, 1, D("1.00")), (500, 2, D("1.00"))], lineitem.schema))
    found = violations(checks.star_source_checks(bad_customer, dangling, lost))
    assert found["customer_null_key"] == 1 and found["customer_duplicate_key"] == 1
    assert found["orders_without_customer"] == 1 and found["lineitem_without_order"] == 2
    with pytest.raises(checks.ContractError, match="customer_null_key"):
        checks.require_passed(checks.star_source_checks(bad_customer, dangling, lost))


def test_required_columns_are_checked_by_type(sources):
    customer, _, _ = sources
    wanted = {field.name: field.dataType for field in customer.schema.fields}
    checks.require_columns(customer, wanted)
    with pytest.raises(checks.ContractError):
        checks.require_columns(customer.drop("c_name"), wanted)
    with pytest.raises(checks.ContractError):
        checks.require_columns(customer.selectExpr("cast(c_custkey as int) c_custkey", "c_name", "c_nationkey", "c_mktsegment"), wanted)


def test_small_dimension_is_broadcast_and_large_one_is_not(spark):
    orders, customer = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("orders", "customer"))
    small = star.segment_orders(orders, customer)
    assert "BroadcastHashJoin" in star.plan_text(small) and "PushedFilters" in star.plan_text(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = star.segment_orders(orders, customer, limit_bytes=10)
        plan = plan_of(large)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan.split("Physical Plan")[1]
        assert sorted(map(tuple, large.collect())) == sorted(map(tuple, small.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_measured_bytes_are_exact(spark):
    frame = spark.createDataFrame([(1, "abc"), (2, None)], "k long, s string")
    assert star.measured_bytes(frame) == 2 * 8 + 2 * 8 + 3


def test_hot_customer_is_one_row_before_the_join(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    lineitem = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    customer = spark.read.parquet(f"{SMALL}/customer.parquet")
    plan = plan_of(star.segment_revenue(star.order_fact(orders, lineitem), star.customer_dimension(customer)))
    assert "partial_sum(revenue" in plan and "partial_sum(line_count" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_star_application_and_report(spark, sources, tmp_path):
    tables.ensure_namespaces(spark, ["star_app"], str(tmp_path))
    provenance = {"dataset": "tpch", "dataset.scale": "tiny"}
    applications.build_star(*sources, "star_app.dim", "star_app.fact", provenance)
    applications.build_star(*sources, "star_app.dim", "star_app.fact", provenance)
    fact, dim = spark.table("star_app.fact"), spark.table("star_app.dim")
    assert fact.count() == 2 and dim.count() == 2
    with pytest.raises(checks.ContractError, match="segment_count"):
        applications.segment_report(fact, dim)


def test_segment_report_reconciles(spark):
    read = lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")
    fact = star.order_fact(read("orders"), read("lineitem"))
    report = applications.segment_report(fact, star.customer_dimension(read("customer"))).first()
    assert report["row_count"] == 5 and len(report["result_sha256"]) == 64


def test_artifact_over_its_bound_fails(spark):
    rows = spark.range(7).selectExpr("cast(id as string) k")
    with pytest.raises(Exception, match="artifact exceeds its bound"):
        artifacts.result_artifact(rows, [("k", "varchar")], [artifacts.json_text(rows["k"])], "k", 5, 1000).collect()


@pytest.mark.parametrize("column", ["row_count", "rows_json", "result_sha256"])
@pytest.mark.parametrize("max_rows, max_bytes", [(6, 1000), (7, 80)])
def test_artifact_bound_holds_for_each_column(spark, column, max_rows, max_bytes):
    rows = spark.range(7).selectExpr("cast(id as string) k")
    report = lambda *bounds: artifacts.result_artifact(rows, [("k", "varchar")], [artifacts.json_text(rows["k"])], "k", *bounds)
    with pytest.raises(Exception, match="artifact exceeds its bound"):
        report(max_rows, max_bytes).select(column).collect()
    exact = len('{"columns":[{"name":"k","type":"varchar"}],"rows":[' + ",".join(f'["{n}"]' for n in range(7)) + "]}")
    assert report(7, exact).first()["row_count"] == 7
    with pytest.raises(Exception, match="artifact exceeds its bound"):
        report(7, exact - 1).select(column).collect()


def test_daily_report(spark, rows):
    trips = spark.createDataFrame(
        [(datetime.date(2023, 1, 1), 5.0), (datetime.date(2023, 1, 1), 6.5), (datetime.date(2023, 1, 2), 20000000.0)],
        "trip_date date, fare_amount double",
    )
    report = applications.daily_report(trips).first()
    assert report["rows_json"] == '[["2023-01-01",2,"5.75"],["2023-01-02",1,"20000000"]]'


RATINGS = [(1, 10, 4.0, 100), (1, 10, 4.0, 100), (1, 11, 2.0, 101), (2, 10, 5.0, 102)]
RATING_DDL = "userId long, movieId long, rating double, timestamp long"


def test_rating_features(spark, rows):
    for order in (RATINGS, RATINGS[::-1]):
        ratings = spark.createDataFrame(order, RATING_DDL)
        assert rows(features.user_features(ratings)) == [(1, 10 / 3, 3), (2, 5.0, 1)]
        assert rows(features.item_features(ratings)) == [(10, 13 / 3, 3), (11, 2.0, 1)]


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_ratings_contract(spark, violations, bad):
    ratings = spark.createDataFrame([*RATINGS, (3, 3, bad, 1)], RATING_DDL)
    assert violations(checks.ratings_checks(ratings, "userId", "movieId", "rating"))["ratings_not_finite"] == 1
    empty = spark.createDataFrame([], RATING_DDL)
    assert violations(checks.ratings_checks(empty, "userId", "movieId", "rating"))["ratings_empty"] == 1


def test_feature_contract_and_application(spark, violations, tmp_path):
    ratings = spark.createDataFrame(RATINGS, RATING_DDL)
    short = features.user_features(ratings.limit(3))
    assert violations(checks.feature_checks(short, "userId", "avg_rating", "num_ratings", ratings))["counts_differ_from_source"] == 1
    tables.ensure_namespaces(spark, ["feature_app"], str(tmp_path))
    applications.build_features(ratings, "feature_app.users", "feature_app.movies", {"dataset": "ratings"})
    assert spark.table("feature_app.users").count() == 2
