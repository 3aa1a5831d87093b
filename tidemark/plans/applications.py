"""Batch applications: contract checks, transform, verified replace."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import checks, cleaning, events, features, star
from tidemark.plans import artifacts
from tidemark.sources import files, tables
from tidemark.sources.exports import replace_verified


def ingest_trips(spark: SparkSession, paths: Sequence[str], table: str) -> DataFrame:
    """Raw monthly files to the bronze table: normalise, clean, date, replace."""
    raw = files.read_parquet_normalised(spark, paths, {"passenger_count": "double"})
    cleaned = cleaning.clean_trips(raw, "tpep_pickup_datetime", "passenger_count", "trip_date")
    tables.replace_table(cleaned, table)
    return spark.table(table)


def refine_trips(spark: SparkSession, bronze: str, silver: str, gold: str) -> DataFrame:
    """Bronze to silver (one row per pickup and dropoff time) and gold (daily totals)."""
    distinct = cleaning.dedupe(spark.table(bronze), ["tpep_pickup_datetime", "tpep_dropoff_datetime"])
    tables.replace_table(distinct, silver)
    daily = cleaning.daily_totals(spark.table(silver), F.col("trip_date"), "fare_amount", "trips", "avg_fare")
    tables.replace_table(daily, gold)
    return spark.table(gold)


def build_star(
    customer: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    dimension: str,
    fact: str,
    provenance: Mapping[str, str],
) -> None:
    """Checked sources to dimension and fact tables, both with the same provenance."""
    checks.require_passed(checks.star_source_checks(customer, orders, lineitem))
    replace_verified(star.customer_dimension(customer), dimension, provenance)
    replace_verified(star.order_fact(orders, lineitem), fact, provenance)


def build_features(ratings: DataFrame, users: str, movies: str, provenance: Mapping[str, str]) -> None:
    """Checked ratings to user and movie feature tables, each proved against the ratings before it is published."""
    checks.require_passed(checks.ratings_checks(ratings, "userId", "movieId", "rating"))

    def proof(key: str, mean: str, count: str) -> Callable[[DataFrame], None]:
        return lambda stored: checks.require_passed(checks.feature_checks(stored, key, mean, count, ratings))

    by_user, by_movie = features.user_features(ratings), features.item_features(ratings)
    replace_verified(by_user, users, provenance, audit=proof("userId", "avg_rating", "num_ratings"))
    replace_verified(by_movie, movies, provenance, audit=proof("movieId", "movie_avg", "popularity"))


def build_events(source: DataFrame, table: str, provenance: Mapping[str, str]) -> DataFrame:
    """Nested events to the flat event table."""
    checks.require_nested_strings(source, ["id", "type", "actor.login", "repo.name", "created_at"])
    flat = events.flatten_events(source)
    checks.require_passed(checks.event_checks(flat))
    return replace_verified(checks.impose_schema(flat, events.EVENT_SCHEMA), table, provenance)


def build_sessions(spark: SparkSession, source: str, table: str, provenance: Mapping[str, str]) -> DataFrame:
    """Event table to the session table; the events must carry the same provenance."""
    expected = spark.createDataFrame(sorted(provenance.items()), "key string, value string")
    stored = tables.read_properties(spark, source, list(provenance))
    if not checks.provenance_differences(expected, stored).isEmpty():
        raise checks.ContractError(f"{source} comes from another generation")
    flat = checks.require_names_and_types(spark.table(source), events.EVENT_SCHEMA)
    annotated = checks.impose_schema(events.sessionize(flat), events.SESSION_SCHEMA)

    def proof(stored: DataFrame) -> None:
        names = ("actor_login", "created_at", "previous_created_at")
        checks.require_passed(checks.session_checks(stored, flat, *names, events.SESSION_GAP_SECONDS))

    return replace_verified(annotated, table, provenance, audit=proof)


def segment_report(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """Reconciled segment revenue as a bounded artifact."""
    segments = star.segment_revenue(fact, dimension)
    checks.require_passed(artifacts.segment_reconciliation(segments, star.source_totals(fact, dimension)))
    return artifacts.segment_artifact(segments)


def daily_report(trips: DataFrame) -> DataFrame:
    """Reconciled daily fares as a bounded artifact."""
    days = cleaning.daily_totals(trips, F.col("trip_date"), "fare_amount", "trip_count", "avg_fare")
    checks.require_passed(artifacts.daily_reconciliation(days, "trip_date", "trip_count", trips))
    return artifacts.daily_artifact(days, "trip_date", "trip_count", "avg_fare")
