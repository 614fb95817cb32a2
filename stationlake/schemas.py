"""Column names of the raw landing files (all text)."""

from __future__ import annotations

RAW_STATION_COLUMNS = ("station_id", "station_name", "lat", "lon", "capacity")
RAW_AVAILABILITY_COLUMNS = ("station_id", "timestamp", "bikes_available", "slots_free")
RAW_WEATHER_COLUMNS = ("timestamp", "temperature_c", "rain_mm", "weather_condition")
