"""Oracle SQL per registered query (DuckDB text; see :mod:`stationlake.oracle`)."""

from __future__ import annotations

from stationlake import oracle as O
from stationlake.plans.registry import FIXED_CALENDAR, LATE_DAY, LATE_STATION, STREAM_CUTS


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["silver_stations"] = O.with_ctes(O.silver_parts(stations=True), final="SELECT * FROM stations_silver")
    q["silver_weather"] = O.with_ctes(O.silver_parts(weather=True), final="SELECT * FROM weather_silver")
    q["silver_availability"] = O.with_ctes(O.silver_parts(availability=True),
                                           final="SELECT * FROM availability_silver")
    q["report_stations"] = O.report_sql("stations")
    q["report_weather"] = O.report_sql("weather")
    q["report_availability"] = O.report_sql("availability")
    q["dim_station"] = O.with_ctes(O.silver_parts(stations=True), O.STATION_ONE, O.DIM_STATION,
                                   final="SELECT * FROM dim_station")
    q["dim_weather"] = O.with_ctes(O.silver_parts(weather=True), O.DIM_WEATHER,
                                   final="SELECT * FROM dim_weather")
    q["dim_date"] = O.with_ctes(O.silver_parts(weather=True, availability=True), O.DIM_DATE,
                                final="SELECT * FROM dim_date")
    for name in ("fact_avg_bikes", "fact_occupancy", "fact_dominant_weather", "fact_saturation",
                 "fact_top_saturated", "fact_top_array", "gold_daily"):
        q[name] = O.fact_sql(name)
    q["fact_occupancy_time_join"] = q["fact_occupancy"]
    q["fact_avg_bikes_calendar"] = O.fact_sql("fact_avg_bikes", FIXED_CALENDAR)
    q["gold_daily_calendar"] = O.fact_sql("gold_daily", FIXED_CALENDAR)
    q["dim_station_key_check"] = O.station_key_check_sql()
    q["weather_hours"] = O.WEATHER_HOURS
    for name in ("csv_stations", "csv_rejects", "csv_silver_availability", "batch_report", "station_export"):
        q[name] = O.landing_sql(name)
    lo, hi = FIXED_CALENDAR
    q["silver_partition_readback"] = (f"SELECT * FROM ({q['silver_availability']}) "
                                      f"WHERE date_partition BETWEEN DATE '{lo}' AND DATE '{hi}'")
    for name in ("enriched_weather", "quality_negatives", "quality_capacity", "quality_report_lines",
                 "null_audit", "weather_profile", "frozen_stations", "critical_episodes", "quality_daily"):
        q[name] = O.quality_sql(name)
    for name in ("stream_alerts", "stream_silver", "stream_intake", "stream_day_silver"):
        q[name] = O.stream_sql(name, STREAM_CUTS[0], LATE_DAY, LATE_STATION)
    q["critical_alerts"] = q["stream_alerts"]
    for name in ("features_hourly", "baseline_errors", "predictions", "model_errors", "sql_station_ranking", "sql_weather_impact",
                 "sql_hourly_profile"):
        q[name] = O.feature_sql(name)
    q["station_day_cube"] = O.cube_sql()
    q["cube_gold_daily"] = q["gold_daily"]
    q["cube_quality_daily"] = q["quality_daily"]
    # the daily runs: what one run over all days gives, of the readings that have a day
    for daily, whole in (("daily_frozen_runs", "frozen_stations"), ("daily_critical_episodes", "critical_episodes"),
                         ("daily_features", "features_hourly"), ("daily_predictions", "predictions")):
        q[daily] = q[whole]
    q["daily_quality"] = f"SELECT * FROM ({q['quality_daily']}) WHERE date_partition IS NOT NULL"
    return q
