"""SQL over the star schema (temporary views + ``spark.sql``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATION_RANKING = """
SELECT station_key, count(*) AS n_readings,
       CAST(round(CAST(avg(occupancy_pct) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_occupancy_pct
FROM fact_occupancy
WHERE station_key IS NOT NULL
GROUP BY station_key
"""

WEATHER_IMPACT = """
SELECT w.weather_condition, count(DISTINCT o.date_key) AS n_days, count(*) AS n_readings,
       CAST(round(CAST(avg(o.occupancy_pct) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_occupancy_pct
FROM fact_occupancy o
JOIN fact_dominant_weather d ON o.date_key = d.date_key
JOIN dim_weather w ON d.weather_condition_key = w.weather_condition_key
GROUP BY w.weather_condition
"""

HOURLY_PROFILE = """
SELECT CAST(o.time_key DIV 60 AS INT) AS hour_of_day, d.is_weekend, count(*) AS n_readings,
       CAST(round(CAST(avg(o.occupancy_pct) AS DECIMAL(38,10)), 2) AS DOUBLE) AS avg_occupancy_pct
FROM fact_occupancy o
JOIN dim_date d ON o.date_key = d.date_key
WHERE o.time_key IS NOT NULL
GROUP BY CAST(o.time_key DIV 60 AS INT), d.is_weekend
"""

REPORTS = {"station_ranking": STATION_RANKING, "weather_impact": WEATHER_IMPACT,
           "hourly_profile": HOURLY_PROFILE}


def register_star(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_report(spark: SparkSession, tables: dict[str, DataFrame], name: str) -> DataFrame:
    """Register the star tables as views and run one of the reports."""
    register_star(spark, tables)
    return spark.sql(REPORTS[name])
