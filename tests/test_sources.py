"""Raw CSV reading (S1, S2, B1) and the derived raw tables."""

import datetime as dt
import os

from pyspark.sql import functions as F

from helpers import SF_MID, SF_SMALL
from stationlake.plans.silver import availability_silver, station_silver
from stationlake.schemas import RAW_AVAILABILITY_COLUMNS, RAW_STATION_COLUMNS, RAW_WEATHER_COLUMNS
from stationlake.sources import csv as S
from stationlake.sources import testdata as td


def write(tmp_dir, text):
    p = os.path.join(tmp_dir, "a.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_read_raw_csv_text_and_projection(spark, tmp_dir):
    p = write(tmp_dir, "station_id;timestamp;bikes_available;slots_free\n"
                       "101;2025-11-01 08:00;5;15\n102;01/11/2025;007;x\n")
    df = S.read_raw_csv(spark, p)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string"] * 4
    assert [tuple(r) for r in df.collect()] == [("101", "2025-11-01 08:00", "5", "15"),
                                                ("102", "01/11/2025", "007", "x")]
    assert S.read_raw_csv(spark, p, ["station_id", "slots_free"]).columns == ["station_id", "slots_free"]


def test_malformed_rows_are_set_apart_and_counted(spark, tmp_dir):
    cols = ["station_id", "timestamp", "bikes_available", "slots_free"]
    p = write(tmp_dir, ",".join(cols) + "\n1,t,5,15\n2,t,5\n3,t,5,15,extra\n4,t,1,2\n")
    read = S.read_raw(spark, p, cols, sep=",")
    assert sorted(r.station_id for r in read.rows.collect()) == ["1", "4"]
    assert sorted(r._corrupt_record for r in read.rejected.collect()) == ["2,t,5", "3,t,5,15,extra"]
    assert tuple(read.counts().first()) == (2, 2)
    assert [r.station_id for r in S.read_raw_csv(spark, p, sep=",").collect()] == ["1", "4"]


def test_projection_never_changes_what_is_malformed(spark, tmp_dir):
    """A station line with a field too many gives no capacity, whatever columns are asked for."""
    p = write(tmp_dir, "station_id,station_name,lat,lon,capacity\n1,a,1,1,10\n2,b,1,1,20,extra\n3,c,1,1\n")
    for columns in (["station_id", "capacity"], ["capacity"], ["station_id"], None):
        got = S.read_raw_csv(spark, p, columns, sep=",", header_columns=RAW_STATION_COLUMNS)
        assert got.count() == 1
    read = S.read_raw(spark, p, RAW_STATION_COLUMNS, sep=",")
    readings = spark.createDataFrame([("2", "2030-01-01 00:00:00", None, "15")],
                                     "station_id string, timestamp string, bikes_available string, slots_free string")
    out = availability_silver(readings, read.rows).df.first()
    assert out.bikes_available is None and station_silver(read.rows).df.count() == 1


def test_landed_lines_come_back(spark, tmp_dir):
    df = spark.createDataFrame([("a;b", None, "1"), ("c", "", "2"), ('q"q', "x,y", "3")], "u string, v string, w string")
    S.land_csv(df, os.path.join(tmp_dir, "land"), malformed=F.col("w") == "2")
    read = S.read_raw(spark, os.path.join(tmp_dir, "land"), df.columns, header=False)
    assert sorted(tuple(r) for r in read.rows.collect()) == [("a;b", None, "1"), ('q"q', "x,y", "3")]
    assert tuple(read.counts().first()) == (2, 1)


def test_derived_raw_tables_cover_inputs(spark):
    ev = td.table(spark, SF_SMALL, "events").count()
    cu = td.table(spark, SF_SMALL, "customer").count()
    assert td.raw_stations(spark, SF_SMALL).count() == cu
    ra = td.raw_availability(spark, SF_SMALL)
    assert ra.columns == list(RAW_AVAILABILITY_COLUMNS)
    assert ra.count() == ev + ev // 10 + (1 if ev % 10 > 3 else 0)
    assert td.raw_weather(spark, SF_SMALL).columns == list(RAW_WEATHER_COLUMNS)


def test_every_event_counts_in_the_weather_feed(spark):
    for sf in (SF_SMALL, SF_MID):
        hours = td.weather_hours(spark, sf)
        assert hours.agg(F.sum("n_events")).first()[0] == td.table(spark, sf, "events").count()
        assert td.raw_weather(spark, sf).count() == hours.count()


def test_weather_hour_by_hand(spark, tmp_dir):
    """Mean of the whole parts, rounded down; most frequent type, ties to the smaller; least id."""
    t = dt.datetime(2030, 6, 17, 5)
    data = [(9, t, "view", 7.9), (3, t + dt.timedelta(minutes=59), "click", 2.2), (4, t, "click", 0.4), (5, t, "view", 1.0),
            (8, t + dt.timedelta(hours=1), "x", 3.0)]
    (spark.createDataFrame(data, "event_id long, ts timestamp_ntz, event_type string, value double")
     .write.parquet(os.path.join(tmp_dir, "events.parquet")))
    got = sorted(tuple(r) for r in td.weather_hours(spark, tmp_dir).select("hour", "k", "v", "kind", "n_events").collect())
    assert got == [(t, 3, 2, "click", 4), (t + dt.timedelta(hours=1), 8, 3, "x", 1)]
