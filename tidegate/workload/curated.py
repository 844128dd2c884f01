"""Clean and curated rows (F14-F16, A5, A6, H7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import iso_date, normalise_date
from tidegate.operators.aggregate import distinct_values, last_value_pivot
from tidegate.plans.medallion import clean_runs, clean_users, runner_performances
from tidegate.workload.registry import Tables, query

# Run texts made from events: three date layouts and two temperature units, as in raw exports.
DATE_TEXT = """
    CASE event_type WHEN 'click' THEN strftime(ts, '%Y/%m/%d') WHEN 'view' THEN strftime(ts, '%m/%d/%Y')
                    WHEN 'purchase' THEN strftime(ts, '%d-%m-%Y') WHEN 'error' THEN strftime(ts, '%m-%d-%Y')
                    ELSE 'unknown' END
"""
DATE_SQL = f"""
    strftime(coalesce(try_strptime({DATE_TEXT}, '%Y/%m/%d'), try_strptime({DATE_TEXT}, '%m/%d/%Y'),
                      try_strptime({DATE_TEXT}, '%m-%d-%Y'), try_strptime({DATE_TEXT}, '%d-%m-%Y')), '%Y-%m-%d')
"""
CELSIUS_SQL = "CASE WHEN event_type IN ('click', 'error') THEN (value - 32) * 5 / 9 ELSE value END"
DISTANCE_SQL = """
    CASE event_type WHEN 'click' THEN 5000.0 WHEN 'view' THEN 10000.0 WHEN 'purchase' THEN 42195.0
                    WHEN 'error' THEN 21097.5 ELSE 1500.0 END
"""


def bronze_runs(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    unit = F.when(kind.isin("click", "error"), "°F").otherwise("°C")
    return t.events.select(
        F.col("event_id").alias("run_id"),
        (F.col("value") * 10).alias("duration"),
        F.when(kind == "click", "5000").when(kind == "view", "10000").when(kind == "purchase", "42195")
        .when(kind == "error", "21097.5").otherwise("1500").alias("distance"),
        F.when(kind == "click", F.date_format("ts", "yyyy/MM/dd")).when(kind == "view", F.date_format("ts", "MM/dd/yyyy"))
        .when(kind == "purchase", F.date_format("ts", "dd-MM-yyyy")).when(kind == "error", F.date_format("ts", "MM-dd-yyyy"))
        .otherwise("unknown").alias("date"),
        F.lit("14.243298,-8.477252").alias("location"),
        F.concat(F.col("value").cast("string"), unit).alias("temperature"),
        "user_id",
    )


@query("runs_silver_dates", f"SELECT event_id AS run_id, {DATE_SQL} AS date FROM events")
def runs_silver_dates(t: Tables) -> DataFrame:
    return bronze_runs(t).select("run_id", iso_date(normalise_date(F.col("date"))).alias("date"))


@query("runs_silver_units", f"""
    SELECT event_id AS run_id, value * 10 AS duration, {DISTANCE_SQL}::DOUBLE AS distance, {DATE_SQL} AS date,
           {CELSIUS_SQL} AS temperature, user_id
    FROM events
""")
def runs_silver_units(t: Tables) -> DataFrame:
    return clean_runs(bronze_runs(t))


@query("last_value_pivot", """
    SELECT user_id, arg_max(value, event_id) FILTER (event_type = 'click') AS last_click,
           arg_max(value, event_id) FILTER (event_type = 'view') AS last_view,
           arg_max(value, event_id) FILTER (event_type = 'purchase') AS last_purchase
    FROM events GROUP BY user_id
""")
def pivot_events(t: Tables) -> DataFrame:
    outputs = {"click": "last_click", "view": "last_view", "purchase": "last_purchase"}
    return last_value_pivot(t.events, "user_id", "event_type", "event_id", "value", outputs)


@query("distinct_users", "SELECT DISTINCT user_id FROM events")
def distinct_users(t: Tables) -> DataFrame:
    return clean_users(t.events)


@query("distinct_combinations", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_combinations(t: Tables) -> DataFrame:
    return distinct_values(t.events, "user_id", "event_type")


@query("runs_gold", """
    SELECT user_id, arg_max(value * 10, event_id) FILTER (event_type = 'error') AS last_duration_on_half_marathon,
           arg_max(value * 10, event_id) FILTER (event_type = 'purchase') AS last_duration_on_marathon,
           arg_max(value * 10, event_id) FILTER (event_type = 'view') AS last_duration_on_10k,
           arg_max(value * 10, event_id) FILTER (event_type = 'click') AS last_duration_on_5k
    FROM events GROUP BY user_id
""")
def runs_gold(t: Tables) -> DataFrame:
    return runner_performances(clean_runs(bronze_runs(t)))
