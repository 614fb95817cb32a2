"""Property tests: the native rules against small Python models of the rule text
"""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationlake.functions import rules as R

DIG = st.text(alphabet="0123456789", min_size=1, max_size=4)
TWO = st.integers(0, 99).map("{:02d}".format)
FOUR = st.integers(0, 9999).map("{:04d}".format)
OK, FIXED, BAD = (False, False), (True, False), (False, True)  # corrected, invalid


@st.composite
def written_dates(draw):
    """A text put together from the parts of a date, with the cell that those parts must give."""
    year, month, day, mark = draw(FOUR), draw(TWO), draw(TWO), draw(st.sampled_from("--/."))
    day_first, gap = draw(st.booleans()), draw(st.sampled_from(" T"))
    time, clean = draw(st.one_of(
        st.just(("", "00:00:00")), st.tuples(TWO, TWO).map(lambda x: (":".join(x), ":".join(x) + ":00")),
        st.tuples(TWO, TWO, TWO).map(lambda x: (":".join(x),) * 2),
        st.tuples(TWO, TWO, TWO, DIG).map(lambda x: (":".join(x[:3]) + "-" + x[3] + "Z", ":".join(x[:3])))))
    text = mark.join([day, month, year] if day_first else [year, month, day]) + (gap + time if time else "")
    value = f"{year}-{month}-{day} {clean}"
    return text, (value, text != value, False)


@st.composite
def broken_dates(draw):
    """A date with a digit too few, too many or no digit at all in one part: no date, whatever follows."""
    parts = [draw(FOUR), draw(TWO), draw(TWO)]
    at = draw(st.integers(0, 2))
    parts[at] = draw(st.sampled_from(["", parts[at][1:], parts[at] + "0", "x" * len(parts[at])]))
    time = draw(st.sampled_from(["", " 10:00", " 10:00:00"]))
    text = "-".join(parts) + (time or " ")
    return text, (None, False, True)


def model_decimal(s, low, high, comma):
    if not s:
        return (None, False, True)
    f = s.replace(",", ".") if comma else s
    if not re.fullmatch(r"\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*", f):
        return (None, False, True)
    v = float(f)
    if (low is not None and v < low) or (high is not None and v > high):
        return (None, False, True)
    return (v, comma and f != s, False)


def apply(spark, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    out = rule(F.col("s"))
    res = out.apply(df, "r") if isinstance(out, R.Staged) else df.withColumn("r", out)
    got = {r.i: (r.r.value, r.r.corrected, r.r.invalid) for r in res.collect()}
    return [got[i] for i in range(len(values))]



@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(written_dates(), broken_dates()), min_size=50, max_size=200))
def test_clean_date_of_written_parts(spark, cases):
    assert apply(spark, R.clean_date, [c[0] for c in cases]) == [c[1] for c in cases]


#: Odd texts and their cells: (text, value, (corrected, invalid)).
ODD_DATES = [
    (None, None, BAD), ("", None, BAD), (" ", None, BAD), ("x", None, BAD), ("2025-11-01", "2025-11-01 00:00:00", FIXED),
    ("2025-11-01 ", "2025-11-01 00:00:00", FIXED), ("2025-11-01  10:00", "2025-11-01 00:00:00", FIXED),
    ("2025-11-01 10:00 11:00", "2025-11-01 10:00:00", FIXED), ("2025-11-01 10:00:00 x", "2025-11-01 10:00:00", OK),
    ("2025-11-01 abc", "2025-11-01 abc", OK), ("2025-11-0110:00", "2025-11-01 10:00:00", FIXED), ("2025-11-01x", "2025-11-01 x", OK),
    ("T2025-11-01", None, (True, True)), ("2025/11/01 10.00", "2025-11-01 10-00", FIXED), (" 01/11/2025 ", "2025-11-01 00:00:00", FIXED),
    (" 01-11-2025", None, BAD), ("1/11/2025", None, (True, True)), ("2025-11-01T10:00:00", "2025-11-01 10:00:00", FIXED),
    # only a newline ends a line: the other line ends are plain characters
    ("01-11-2025\r 10:00", None, BAD), ("2025-11-01 10:00\r", "2025-11-01 10:00:00", FIXED),
    ("2025-11-01 10:00:00\r", "2025-11-01 10:00:00", OK), ("01/11/2025\x85 10:00", None, (True, True)),
]


def test_clean_date_of_odd_texts(spark):
    got = apply(spark, R.clean_date, [c[0] for c in ODD_DATES])
    assert {t: g for (t, _, _), g in zip(ODD_DATES, got, strict=True)} == {t: (v, *f) for t, v, f in ODD_DATES}


NUM = st.one_of(st.builds(lambda a, b, c, sep: f"{a}{b}{sep}{c}", st.sampled_from(["", "-", "+", " "]),
                          DIG, DIG, st.sampled_from([".", ",", ""])),
                st.text(alphabet="0123456789.,-+eE x", max_size=8), st.none())


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(NUM, min_size=50, max_size=200))
def test_decimal_rules_match_model(spark, values):
    assert apply(spark, R.clean_temperature, values) == [model_decimal(v, -20, 50, True) for v in values]
    assert apply(spark, R.clean_rain_mm, values) == [model_decimal(v, 0, None, True) for v in values]
