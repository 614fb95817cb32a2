"""Rule framework on two toy rules of our own, and the silver tables on rows whose expected
"""

import datetime as dt

from pyspark.sql import functions as F

from helpers import rows
from stationlake.functions.rules import _result
from stationlake.operators import cleaning as C
from stationlake.plans import silver


def upper_code(s):
    """Codes are upper case; a missing code is invalid."""
    return _result(F.upper(s), F.coalesce(F.upper(s) != s, F.lit(False)), s.isNull())


def three_letters(s):
    """Codes have three letters; others become NULL and are invalid."""
    ok = F.coalesce(F.length(s) == 3, F.lit(False))
    return _result(F.when(ok, s), F.lit(False), ~ok)


RULES = [C.CleanRule("code", upper_code), C.CleanRule("code", three_letters)]
DATA = [(7, "LIL", "2031-03-09 06:15"), (8, "par", "2031-03-09 06:20"), (9, "toolong", "2031-03-09 06:25"),
        (10, None, "2031-03-09 06:30")]


def coded(spark, data=DATA):
    return spark.createDataFrame(data, "n int, code string, seen string")


def test_apply_rules_flags_and_score(spark):
    out = C.apply_rules(coded(spark).drop("seen"), RULES, score=True)
    assert out.columns == ["n", "code", "row_corrected", "value_invalid", "score"]
    assert rows(out) == [(10, None, False, True, 1), (7, "LIL", False, False, 0), (8, "PAR", True, False, 0),
                         (9, None, True, True, 1)]
    assert out.schema["score"].nullable is False


def test_apply_rules_drop_and_report(spark):
    out = C.apply_rules(coded(spark), RULES, drop=["code", "seen"])
    assert out.columns == ["n", "row_corrected", "value_invalid"]
    flagged = C.apply_rules(coded(spark), RULES)
    assert tuple(C.flag_report(flagged).first()) == (2, 2)
    clean, report = C.report_and_strip(flagged)
    assert clean.columns == C.strip_flags(flagged).columns == ["n", "code", "seen"]
    assert tuple(report.first()) == (2, 2)


def test_rules_see_the_rules_before_them(spark):
    """The length rule judges the upper-cased value: ``ß`` grows to two letters."""
    out = C.apply_rules(coded(spark, [(1, "aß", "x")]), RULES)
    assert [r.code for r in out.collect()] == ["ASS"]


def test_keep_best_lowest_score_deterministic(spark):
    df = spark.createDataFrame([("a", 4, 5), ("a", 1, 9), ("b", 0, 2), ("b", 0, 1), (None, 3, 3), (None, 2, 8)],
                               "k string, score int, v int")
    assert rows(C.keep_best(df, ["k"], ["score"])) == [("a", 1, 9), ("b", 0, 1), (None, 2, 8)]
    # ties on the score are broken by the other columns, NULL first
    t = spark.createDataFrame([(4, 1, "z"), (4, 1, None), (4, 1, "y")], "k int, score int, v string")
    assert rows(C.keep_best(t, ["k"], ["score"])) == [(4, 1, None)]


def test_to_silver_dedup_partition_and_days(spark):
    data = DATA + [(11, "LYS", "2031-03-09 06:30"), (12, "nce", "2031-03-10 00:00")]
    args = dict(score=True, dedup_keys=["seen"], partition_col="seen", drop_cols=["score"])
    res = C.to_silver(coded(spark, data), RULES, **args)
    assert res.df.columns == ["n", "code", "seen", "date_partition"]
    got = {r.n: (r.code, r.date_partition) for r in res.df.collect()}
    # at 06:30 the row with a code is more complete than the one without
    assert got == {7: ("LIL", dt.date(2031, 3, 9)), 8: ("PAR", dt.date(2031, 3, 9)), 9: (None, dt.date(2031, 3, 9)),
                   11: ("LYS", dt.date(2031, 3, 9)), 12: ("NCE", dt.date(2031, 3, 10))}
    assert res.report.first().asDict() == {"rows_raw": 6, "rows_corrected": 3, "rows_invalid": 2, "rows_removed": 1}
    one = C.to_silver(coded(spark, data), RULES, days=("2031-03-10", "2031-03-10"), **args)
    assert [r.n for r in one.df.collect()] == [12]
    assert one.report.first().asDict() == {"rows_raw": 1, "rows_corrected": 1, "rows_invalid": 0, "rows_removed": 0}


def test_station_silver(spark):
    raw = spark.createDataFrame(
        [("12", "Lille - Station 40", "50.5", "3.25", "33"),      # all kept
         ("0", "Lille - Station 4", "-90.5", "180.5", "0"),       # every cell just outside its rule
         ("+7", "Lille - Station 99", "-90", "180", "1"),         # bounds are inside
         (None, "lille - Station 41", "", "east", "12.0")],       # case matters; not numbers
        "station_id string, station_name string, lat string, lon string, capacity string")
    res = silver.station_silver(raw)
    assert [f.dataType.simpleString() for f in res.df.schema.fields] == ["int", "string", "float", "float", "int"]
    # the rows without any valid cell are removed
    assert rows(res.df) == [(12, "Lille - Station 40", 50.5, 3.25, 33), (7, "Lille - Station 99", -90.0, 180.0, 1)]
    # an accepted positive integer always counts as corrected
    assert res.report.first().asDict() == {"rows_raw": 4, "rows_corrected": 2, "rows_invalid": 2, "rows_removed": 2}


def test_weather_silver(spark):
    raw = spark.createDataFrame(
        [("17.06.2030", "-20", "0", "Fog"), ("2030-06-17T05:00:00", "50,0", "-0.1", "fog"),
         ("2030/06/18 23:00", "50.1", "0,75", "Drizzle"), ("soon", None, "", "Hail")],
        "timestamp string, temperature_c string, rain_mm string, weather_condition string")
    res = silver.weather_silver(raw)
    a, b = dt.date(2030, 6, 17), dt.date(2030, 6, 18)
    assert rows(res.df) == [("2030-06-17 00:00:00", -20.0, 0.0, "Fog", a), ("2030-06-17 05:00:00", 50.0, None, None, a),
                            ("2030-06-18 23:00:00", None, 0.75, "Drizzle", b)]
    assert res.report.first().asDict() == {"rows_raw": 4, "rows_corrected": 3, "rows_invalid": 3, "rows_removed": 1}


READINGS = "station_id string, timestamp string, bikes_available string, slots_free string"


def test_availability_silver_end_to_end(spark):
    raw = spark.createDataFrame(
        [("31", "2030-06-17 05:00:00", "8", "4"),       # consistent
         ("31", "2030-06-17 05:05:00", "40", "3"),      # bikes capped at 12, then slots kept
         ("31", "2030-06-17 05:10:00", "x", "5"),       # bikes = 12 - 5
         ("31", "2030-06-17 05:15:00", "9", None),      # slots = 12 - 9
         ("77", "2030-06-17 05:00:00", "6", "-1")],     # unknown station: no capacity to fill from
        READINGS)
    cap = spark.createDataFrame([("31", "12"), ("31", "13"), ("50", "9")], "station_id string, capacity string")
    res = silver.availability_silver(raw, cap)
    got = rows(res.df.select("station_id", "timestamp", "bikes_available", "slots_free"))
    t = "2030-06-17 05:%s:00"
    # station 31 is listed twice: the smaller capacity counts, and no reading is doubled
    assert got == [(31, t % "00", 8, 4), (31, t % "05", 12, 3), (31, t % "10", 7, 5), (31, t % "15", 9, 3),
                   (77, t % "00", 6, None)]
    assert res.report.first().asDict() == {"rows_raw": 5, "rows_corrected": 5, "rows_invalid": 1, "rows_removed": 0}


def test_dedup_keeps_most_complete_and_empty_input(spark):
    raw = spark.createDataFrame([("31", "17/06/2030 05:00", None, "x"), ("31", "2030-06-17T05:00:00", "2", "10"),
                                 ("31", "2030-06-17 05:00:00", "3", "9")], READINGS)
    cap = spark.createDataFrame([("31", "12")], "station_id string, capacity string")
    res = silver.availability_silver(raw, cap)
    # two complete copies: the one with fewer bikes is first
    assert rows(res.df.select("bikes_available", "slots_free")) == [(2, 10)]
    assert res.report.first().rows_removed == 2
    empty = silver.availability_silver(raw.limit(0), cap)
    assert empty.df.count() == 0
    assert empty.report.first().asDict() == {"rows_raw": 0, "rows_corrected": 0, "rows_invalid": 0,
                                             "rows_removed": 0}


def test_keep_best_hot_key_combined_map_side(spark):
    """One key holds a third of the rows: result equals brute force, and the plan
    reduces it before the shuffle (partial aggregate below the exchange)."""
    import random

    rnd = random.Random(5)
    data = [(0 if i % 3 == 0 else rnd.randint(1, 500), rnd.randint(0, 4), rnd.choice([None, 1, 2]))
            for i in range(6000)]
    df = spark.createDataFrame(data, "k int, score int, v int").repartition(8)
    best = {}
    for k, sc, v in data:
        cand = (sc, (v is not None, v if v is not None else 0))
        if k not in best or cand < best[k][0]:
            best[k] = (cand, (k, sc, v))
    assert rows(C.keep_best(df, ["k"], ["score"])) == sorted(
        (b[1] for b in best.values()), key=lambda r: tuple((x is None, str(x)) for x in r))
    plan = C.keep_best(df, ["k"], ["score"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
