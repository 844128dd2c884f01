"""Sample runs: raw text rows to clean rows to one row per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import celsius, iso_date, normalise_date
from tidegate.operators.aggregate import distinct_values, last_value_pivot

# Run distances in metres and the column of each one's last duration.
DISTANCES = {
    21097.5: "last_duration_on_half_marathon",
    42195.0: "last_duration_on_marathon",
    10000.0: "last_duration_on_10k",
    5000.0: "last_duration_on_5k",
}

BRONZE_RUNS = (
    "run_id bigint, duration double, distance string, date string, location string, temperature string, user_id bigint"
)


def clean_runs(bronze: DataFrame) -> DataFrame:
    """ISO dates, degrees Celsius, distances as double, no location."""
    return bronze.select(
        "run_id",
        F.col("duration").try_cast("double").alias("duration"),
        F.col("distance").try_cast("double").alias("distance"),
        iso_date(normalise_date(F.col("date"))).alias("date"),
        celsius(F.col("temperature")).alias("temperature"),
        "user_id",
    )


def clean_users(bronze: DataFrame) -> DataFrame:
    return distinct_values(bronze, "user_id")


def runner_performances(runs: DataFrame) -> DataFrame:
    return last_value_pivot(runs, "user_id", "distance", "run_id", "duration", DISTANCES)
