"""Cell cleaning rules as native column expressions.

Every rule maps a raw (string) column to ``STRUCT<value, corrected, invalid>``:

* ``value``     the cleaned, typed value (NULL when the cell is rejected),
* ``corrected`` the cell was changed to make it valid,
* ``invalid``   the cell was rejected (value replaced by NULL).

The rules are built only from built-in functions (``rlike``, ``translate``,
``try_cast``, ``when`` ...), so they run inside whole-stage codegen, let filters on
cleaned columns push through, and never leave the JVM.

Stated deviations from a Python ``float()``/``int()`` reading of the same text:
underscores inside numbers, non-ASCII digits, ``inf``/``nan`` spellings and integers
beyond the target type are rejected (invalid) instead of being accepted or wrapped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must stay equal to the reference rules for equal results.
VALID_WEATHER_CONDITIONS = ("Rain", "Cloudy", "Clear", "Drizzle", "Fog")
STATION_NAME_PATTERN = r"^Lille - Station \d{2}$"
TEMPERATURE_MIN, TEMPERATURE_MAX = -20.0, 50.0
RAIN_MIN = 0.0
LATITUDE_MIN, LATITUDE_MAX = -90.0, 90.0
LONGITUDE_MIN, LONGITUDE_MAX = -180.0, 180.0
MIDNIGHT = "00:00:00"
# ---------------------------------------------------------------------------

# Characters Python's str.strip() removes (str.isspace), as a regex class.
_WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_DECIMAL_TEXT = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\z"
_INTEGER_TEXT = r"^[+-]?\d+\z"
_DIGITS_TEXT = r"^\d+\z"
_STRIP_IF_SEPARATOR = r"(?s)^(?=.*[./])" + _WS + r"*(.*?)" + _WS + r"*\z"
_DATE_TOKEN = r"(?s)^([^ ]*) .*|^(.{0,10}).*"
_TIME_TOKEN = r"(?s)^[^ ]* ([^ ]*).*|^.{0,10}(.*)"
# (?d): only "\n" ends a line for ^ $ . (Java otherwise also counts \r, \u0085, ...),
# the same reading of "$" as the rules' text
_DAY_FIRST = r"(?d)^\d{2}-\d{2}-\d{4}$"
_DATE_SHAPES = r"(?d)^\d{2}-\d{2}-\d{4}$|^\d{4}-\d{2}-\d{2}$"
_HOUR_MINUTE = r"(?d)^(\d{2}:\d{2})$"
_LONG_TIME = r"(?s)^(\d{2}:\d{2}:\d{2})[^\n].*"
_DAY_FIRST_GROUPS = r"(?d)^(\d{2})-(\d{2})-(\d{4})$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _result(value: Column, corrected: Column, invalid: Column) -> Column:
    return F.struct(
        value.alias("value"),
        F.coalesce(corrected, F.lit(False)).alias("corrected"),
        F.coalesce(invalid, F.lit(False)).alias("invalid"),
    )


def is_blank(s: Column) -> Column:
    """NULL or the empty string (the rules' notion of a missing cell)."""
    return s.isNull() | (s == F.lit(""))


def strip_ws(s: Column) -> Column:
    """Remove leading and trailing whitespace (all of it, not only spaces)."""
    return F.regexp_replace(s, f"^{_WS}+|{_WS}+$", "")


def full_match(s: Column, pattern: str) -> Column:
    """True when the whole string matches ``pattern`` (no partial or newline slack)."""
    return s.rlike(f"^(?:{pattern})\\z")


def parse_decimal(text: Column) -> Column:
    """Plain decimal / scientific text to DOUBLE, anything else to NULL."""
    core = strip_ws(text)
    return F.when(core.rlike(_DECIMAL_TEXT), core.try_cast("double"))


def parse_integer(text: Column) -> Column:
    """Signed integer text (surrounding whitespace allowed) to INT, else NULL."""
    core = strip_ws(text)
    return F.when(core.rlike(_INTEGER_TEXT), core.try_cast("int"))


def parse_count(text: Column) -> Column:
    """Unsigned all-digit text (no sign, no blanks) to BIGINT, else NULL."""
    t = text.cast("string")
    return F.when(t.rlike(_DIGITS_TEXT), t.try_cast("bigint"))


# --- staged rules ------------------------------------------------------------------
Ref = Callable[[str], Column]


@dataclass(frozen=True)
class Staged:
    """A rule written as a few named steps; later steps refer to earlier ones by name.

    Materialising the steps as (temporary) columns keeps every generated expression
    small: a sub-expression used by several later steps is computed once and read as
    a column, instead of being copied into each of them. That keeps whole-stage codegen
    within the JVM's method-size limits, so the rule stays compiled.
    """

    steps: tuple[Callable[[Ref], dict[str, Column]], ...]
    result: Callable[[Ref], Column]

    def to_column(self) -> Column:
        """The same rule as one (larger) expression, for ad-hoc use in a select."""
        env: dict[str, Column] = {}
        for step in self.steps:
            env.update(step(env.__getitem__))
        return self.result(env.__getitem__)

    def apply(self, df: DataFrame, out: str) -> DataFrame:
        """Add the rule's struct as column ``out`` (step columns are not kept)."""
        prefix = f"{out}__"
        ref: Ref = lambda name: F.col(prefix + name)
        keep = [F.col(c) for c in df.columns]
        carried: list[str] = []
        for step in self.steps:
            cols = step(ref)
            df = df.select(*keep, *[F.col(c) for c in carried],
                           *[v.alias(prefix + k) for k, v in cols.items()])
            carried += [prefix + k for k in cols]
        return df.select(*keep, self.result(ref).alias(out))


# --- U1 -------------------------------------------------------------------
def clean_date(s: Column | str) -> Staged:
    """Normalise a timestamp text to ``yyyy-MM-dd HH:mm:ss`` (kept as a string).

    ``T`` becomes a space; ``.`` and ``/`` become ``-``; the date part may be
    day-first (re-ordered) or year-first; a missing time becomes midnight, ``HH:mm``
    gets ``:00`` and a longer ``HH:mm:ss...`` is cut to 8 characters. Other time
    texts are passed through unchecked.
    """
    s = _col(s).cast("string")

    def read(r: Ref) -> dict[str, Column]:
        return {"blank": is_blank(s), "had_t": F.instr(s, "T") > 0,
                "t": F.translate(s, "T", " ")}

    def separators(r: Ref) -> dict[str, Column]:
        # With a "." or "/" anywhere: strip surrounding whitespace, then turn them to "-".
        t = r("t")
        return {"sep": t.rlike("[./]"),
                "n": F.regexp_replace(F.regexp_replace(t, _STRIP_IF_SEPARATOR, "$1"),
                                      "[./]", "-")}

    def split(r: Ref) -> dict[str, Column]:
        # First / second space-separated token when there is a space, otherwise the
        # first ten characters / the rest (exactly one alternative takes part).
        n = r("n")
        return {"date_part": F.regexp_replace(n, _DATE_TOKEN, "$1$2"),
                "time_part": F.regexp_replace(n, _TIME_TOKEN, "$1$2")}

    def classify(r: Ref) -> dict[str, Column]:
        d = r("date_part")
        return {"day_first": d.rlike(_DAY_FIRST),
                "date_iso": F.when(d.rlike(_DATE_SHAPES),
                                   F.regexp_replace(d, _DAY_FIRST_GROUPS, "$3-$2-$1")),
                "tp": strip_ws(r("time_part"))}

    def normalise(r: Ref) -> dict[str, Column]:
        # Empty → midnight, HH:mm → HH:mm:00, HH:mm:ss<more> → HH:mm:ss, else unchanged;
        # each step changes the text exactly when it applies.
        tp = r("tp")
        fixed = F.when(tp == F.lit(""), F.lit(MIDNIGHT)).otherwise(
            F.regexp_replace(F.regexp_replace(tp, _HOUR_MINUTE, "$1:00"), _LONG_TIME, "$1"))
        return {"time_fixed": fixed}

    def result(r: Ref) -> Column:
        iso, fixed = r("date_iso"), r("time_fixed")
        value = F.when(~r("blank"), F.concat(iso, F.lit(" "), fixed))
        invalid = r("blank") | iso.isNull()
        corrected = ~r("blank") & (r("had_t") | r("sep") | (
            ~invalid & (r("day_first") | (fixed != r("tp")))))
        return _result(value, corrected, invalid)

    return Staged((read, separators, split, classify, normalise), result)


# --- U2, U3, U5, U6 -------------------------------------------------------------
def clean_bounded_decimal(s: Column | str, low: float | None = None,
                          high: float | None = None, *, comma_decimal: bool = False,
                          as_type: str = "double") -> Column:
    """Parse a decimal and keep it only inside ``[low, high]``.

    With ``comma_decimal`` a ``,`` is read as the decimal point and the cell counts as
    corrected when that happened (and the value is kept).
    """
    s = _col(s).cast("string")
    blank = is_blank(s)
    text = F.regexp_replace(s, ",", ".") if comma_decimal else s
    v = parse_decimal(text)
    ok = v.isNotNull()
    if low is not None:
        ok = ok & (v >= F.lit(low))
    if high is not None:
        ok = ok & (v <= F.lit(high))
    ok = ~blank & F.coalesce(ok, F.lit(False))
    value = F.when(ok, v).cast(as_type)
    corrected = ok & (text != s) if comma_decimal else F.lit(False)
    return _result(value, corrected, ~ok)


def clean_temperature(s: Column | str) -> Column:
    return clean_bounded_decimal(s, TEMPERATURE_MIN, TEMPERATURE_MAX, comma_decimal=True)


def clean_rain_mm(s: Column | str) -> Column:
    return clean_bounded_decimal(s, RAIN_MIN, None, comma_decimal=True)


def clean_latitude(s: Column | str) -> Column:
    return clean_bounded_decimal(s, LATITUDE_MIN, LATITUDE_MAX, as_type="float")


def clean_longitude(s: Column | str) -> Column:
    return clean_bounded_decimal(s, LONGITUDE_MIN, LONGITUDE_MAX, as_type="float")


# --- U4, U7 ---------------------------------------------------------------------
def clean_member(s: Column | str, allowed: Sequence[str] = VALID_WEATHER_CONDITIONS) -> Column:
    """Keep the value only if it is (case-sensitively) one of ``allowed``."""
    s = _col(s).cast("string")
    ok = ~is_blank(s) & F.coalesce(s.isin(list(allowed)), F.lit(False))
    return _result(F.when(ok, s), F.lit(False), ~ok)


def clean_weather(s: Column | str, allowed: Sequence[str] = VALID_WEATHER_CONDITIONS) -> Column:
    return clean_member(s, allowed)


def clean_pattern(s: Column | str, pattern: str) -> Column:
    """Keep the value only if the whole text matches ``pattern``."""
    s = _col(s).cast("string")
    ok = ~is_blank(s) & F.coalesce(full_match(s, pattern), F.lit(False))
    return _result(F.when(ok, s), F.lit(False), ~ok)


def clean_station_name(s: Column | str, pattern: str = STATION_NAME_PATTERN) -> Column:
    return clean_pattern(s, pattern)


# --- U8 -------------------------------------------------------------------------
def clean_positive_int(s: Column | str, *, flag_valid: bool = True) -> Column:
    """Integer > 0. ``flag_valid`` keeps the reference convention that every accepted
    value is also reported as corrected."""
    return staged_positive_int(s, flag_valid=flag_valid).to_column()


def staged_positive_int(s: Column | str, *, flag_valid: bool = True) -> Staged:
    """:func:`clean_positive_int` in steps: the text is parsed once."""
    s = _col(s).cast("string")

    def result(r: Ref) -> Column:
        value = F.when(r("v") > 0, r("v"))
        return _result(value, value.isNotNull() & F.lit(flag_valid), value.isNull())

    return Staged((lambda r: {"v": parse_integer(s)},), result)


# --- U9 -------------------------------------------------------------------------
def clean_bike_count(s: Column | str, other: Column | str, capacity: Column | str) -> Column:
    """Count of bikes (or free slots) checked against the station capacity.

    ``other`` is the complementary count (raw text or an already cleaned integer
    column) and ``capacity`` the raw capacity text. A missing / non-numeric count is
    filled with ``max(capacity - other, 0)`` when both are known; a count above the
    capacity is capped at the capacity. Applying it to bikes first and then to slots
    (with the cleaned bikes as ``other``) makes the second column win.
    """
    return staged_bike_count(s, other, capacity).to_column()


def staged_bike_count(s: Column | str, other: Column | str, capacity: Column | str) -> Staged:
    """:func:`clean_bike_count` in steps: every text is parsed once."""

    def read(r: Ref) -> dict[str, Column]:
        return {"v": parse_count(_col(s)), "o": parse_count(_col(other)), "cap": parse_count(_col(capacity))}

    def choose(r: Ref) -> dict[str, Column]:
        v, o, cap = r("v"), r("o"), r("cap")
        fill = F.when(o.isNotNull() & cap.isNotNull(), F.greatest(cap - o, F.lit(0)))
        over = cap.isNotNull() & (v > cap)
        return {"over": over, "value": F.when(v.isNull(), fill).when(over, cap).otherwise(v).try_cast("int")}

    def result(r: Ref) -> Column:
        value = r("value")
        return _result(value, value.isNotNull() & (r("v").isNull() | F.coalesce(r("over"), F.lit(False))), value.isNull())

    return Staged((read, choose), result)
