"""Column-level functions: cleaning rules, rounding, calendar helpers."""

from stationlake.functions.rules import (  # noqa: F401
    clean_bike_count, clean_bounded_decimal, clean_date, clean_latitude,
    clean_longitude, clean_member, clean_pattern, clean_positive_int, clean_rain_mm,
    clean_station_name, clean_temperature, clean_weather,
)
from stationlake.functions.numeric import pct, round2  # noqa: F401
