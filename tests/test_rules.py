"""Cell rules on the golden cases (FIXTURES.md §1) and on edge cases beyond them."""

import pytest
from pyspark.sql import functions as F

from stationlake.functions import rules as R


def run(spark, rule, values, *extra_cols):
    """Apply ``rule`` to a one-column (or multi-column) text table; return value/flags."""
    if extra_cols:
        df = spark.createDataFrame(values, ", ".join(f"c{i} string" for i in range(len(values[0]))))
        out = rule(F.col("c0"), *[F.col(f"c{i}") for i in range(1, len(values[0]))])
    else:
        df = spark.createDataFrame([(v,) for v in values], "c0 string")
        out = rule(F.col("c0"))
    res = df.withColumn("__i", F.monotonically_increasing_id())
    res = (out.apply(res, "r") if isinstance(out, R.Staged) else res.withColumn("r", out)).orderBy("__i")
    return [(r["r"]["value"], r["r"]["corrected"], r["r"]["invalid"]) for r in res.collect()]


def test_clean_date_golden(spark):
    cases = {
        "2031-04-07T18:45:09": ("2031-04-07 18:45:09", True, False),
        "07/04/2031 18:45": ("2031-04-07 18:45:00", True, False),
        "07-04-2031 18:45:09": ("2031-04-07 18:45:09", True, False),
        "2031-04-07 18:45": ("2031-04-07 18:45:00", True, False),
        "2031-04-07 18:45:09.5+02": ("2031-04-07 18:45:09", True, False),
        "07.04.2031": ("2031-04-07 00:00:00", True, False),
        "2031-04-07": ("2031-04-07 00:00:00", True, False),
        "": (None, False, True),
        None: (None, False, True),
        "tomorrow": (None, False, True),
    }
    assert run(spark, R.clean_date, list(cases)) == list(cases.values())


def test_clean_date_edges(spark):
    cases = {
        "2025-11-01 10:00:00": ("2025-11-01 10:00:00", False, False),   # already clean
        "not/a/date": (None, True, True),                               # separators fixed, still bad
        "2025-02-31 10:00:00": ("2025-02-31 10:00:00", False, False),   # not range-checked
        "2025-11-01 abc": ("2025-11-01 abc", False, False),             # time passed through
        "31/02/2025": ("2025-02-31 00:00:00", True, False),
        " 2025-11-01 10:00": (None, False, True),                       # leading space: empty date
        "2025-11-01  10:00": ("2025-11-01 00:00:00", True, False),      # double space loses the time
    }
    assert run(spark, R.clean_date, list(cases)) == list(cases.values())


def test_clean_date_column_form_matches_staged(spark):
    vals = ["2025-11-01T10:00:00", "01/11/2025 10:00", "x", None, "01.11.2025"]
    df = spark.createDataFrame([(v,) for v in vals], "c0 string")
    a = [r[0] for r in df.select(R.clean_date(F.col("c0")).to_column().alias("r")).collect()]
    b = [r[0] for r in R.clean_date(F.col("c0")).apply(df, "r").select("r").collect()]
    assert a == b


@pytest.mark.parametrize("rule,cases", [
    (R.clean_temperature, {"23": (23.0, False, False), "23,5": (23.5, True, False),
                           "-25": (None, False, True), "70": (None, False, True),
                           "abc": (None, False, True), "": (None, False, True), None: (None, False, True),
                           "-20": (-20.0, False, False), "50": (50.0, False, False),
                           "nan": (None, False, True), "inf": (None, False, True), "1.0d": (None, False, True)}),
    (R.clean_rain_mm, {"12.5": (12.5, False, False), "3,7": (3.7, True, False), "0": (0.0, False, False),
                       "25": (25.0, False, False), "-1.2": (None, False, True), "": (None, False, True),
                       None: (None, False, True), "abc": (None, False, True), " 4 ": (4.0, False, False),
                       "1e2": (100.0, False, False)}),
])
def test_decimal_rules(spark, rule, cases):
    assert run(spark, rule, list(cases)) == list(cases.values())


def test_weather_member(spark):
    cases = {"Rain": ("Rain", False, False), "Cloudy": ("Cloudy", False, False),
             "Clear": ("Clear", False, False), "Drizzle": ("Drizzle", False, False),
             "Fog": ("Fog", False, False), "Sunny": (None, False, True), "": (None, False, True),
             None: (None, False, True), "rain": (None, False, True)}
    assert run(spark, R.clean_weather, list(cases)) == list(cases.values())


@pytest.mark.parametrize("rule,cases", [
    (R.clean_latitude, {"45.0": (45.0, False, False), "-90": (-90.0, False, False), "90": (90.0, False, False),
                        "91": (None, False, True), "-91": (None, False, True), "": (None, False, True),
                        None: (None, False, True), "abc": (None, False, True), "45,5": (None, False, True)}),
    (R.clean_longitude, {"45.0": (45.0, False, False), "-180": (-180.0, False, False),
                         "180": (180.0, False, False), "181": (None, False, True), "-181": (None, False, True),
                         "": (None, False, True), None: (None, False, True), "abc": (None, False, True)}),
])
def test_coordinates(spark, rule, cases):
    assert run(spark, rule, list(cases)) == list(cases.values())


def test_station_name(spark):
    cases = {"Lille - Station 58": ("Lille - Station 58", False, False),
             "Lille -Station 58": (None, False, True), None: (None, False, True),
             "Roubaix - Station 58": (None, False, True), "Lille - Station 5": (None, False, True),
             "Lille - Station 058": (None, False, True),
             "": (None, False, True), "Lille - Station 58\n": (None, False, True)}
    assert run(spark, R.clean_station_name, list(cases)) == list(cases.values())


def test_positive_int(spark):
    cases = {"48": (48, True, False), "1": (1, True, False), "0": (None, False, True),
             "-3": (None, False, True), None: (None, False, True), "four": (None, False, True),
             "2.0": (None, False, True), " 7 ": (7, True, False), "2147483647": (2147483647, True, False),
             "2147483648": (None, False, True), "1_0": (None, False, True)}
    assert run(spark, R.clean_positive_int, list(cases)) == list(cases.values())


def test_bike_count_golden(spark):
    cases = [(("12", "19", "31"), (12, False, False)), (("-4", "19", "31"), (12, True, False)),
             (("32", "19", "31"), (31, True, False)), (("31", "19", "31"), (31, False, False)),
             ((None, "7", "31"), (24, True, False)), (("many", "7", "31"), (24, True, False)),
             ((None, "40", "31"), (0, True, False)), ((None, None, "31"), (None, False, True)),
             ((None, "7", None), (None, False, True)), ((None, None, None), (None, False, True)),
             (("12", None, None), (12, False, False))]
    got = run(spark, R.clean_bike_count, [c for c, _ in cases], True)
    assert got == [e for _, e in cases]


def test_bike_count_all_triples_against_python(spark):
    """Every triple of 11 values against a direct restatement of the rule in Python."""
    vals = ["5", "10", "20", "0", "-1", "abc", "5.0", "", None, "25", "007"]

    def dig(x):
        return int(x) if isinstance(x, str) and x.isdigit() else None

    def expected(v, o, c):
        o, c, d = dig(o), dig(c), dig(v)
        if d is None:
            if o is not None and c is not None:
                return (max(c - o, 0), True, False)
            return (None, False, True)
        if c is not None and d > c:
            return (c, True, False)
        return (d, False, False)

    triples = [(a, b, c) for a in vals for b in vals for c in vals]
    got = run(spark, R.clean_bike_count, triples, True)
    assert got == [expected(*t) for t in triples]
