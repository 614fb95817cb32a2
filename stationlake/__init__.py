"""stationlake: Spark-native analytics for shared-mobility station data.

Raw readings (stations, availability, weather) are cleaned with native column rules
that record per cell whether a value was corrected or rejected, deduplicated by
keeping the most complete row, and turned into a star schema (date, time, station and
weather dimensions, daily facts and a daily gold table). Quality checks, features with
simple baselines and a Structured Streaming path build on the same rules.

Everything is expressed with the DataFrame / SQL / Structured Streaming API so that
Catalyst plans it; there is no row-at-a-time Python UDF in the batch path.
"""

__version__ = "0.1.0"
