"""Rating features per user and per item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import mean


def user_features(
    ratings: DataFrame, user: str = "userId", rating: str = "rating", exact_type: str | None = None
) -> DataFrame:
    return ratings.groupBy(user).agg(
        mean(rating, exact_type).alias("avg_rating"), F.count(F.lit(1)).alias("num_ratings")
    )


def item_features(
    ratings: DataFrame, item: str = "movieId", rating: str = "rating", exact_type: str | None = None
) -> DataFrame:
    return ratings.groupBy(item).agg(
        mean(rating, exact_type).alias("movie_avg"), F.count(F.lit(1)).alias("popularity")
    )
