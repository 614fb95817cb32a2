"""DuckDB restatement of the registered queries (the correctness oracle).

Each function returns ANSI-ish SQL that DuckDB runs over the shared test tables
(``customer``, ``events`` ... registered as views). The raw tables, the cleaning rules,
the silver steps and the star schema are written again here in plain SQL — on purpose
a second, independent formulation (e.g. the date rule classifies the time part instead of
rewriting it with regular expressions), so that agreement means something.

Nothing here runs on Spark; it is only text.
"""

from __future__ import annotations

_WS_STRIP = r"^\s+|\s+$"


def _trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '{_WS_STRIP}', '', 'g')"


class Chain:
    """A linear CTE pipeline: every step is ``SELECT *, ...`` or ``SELECT * REPLACE``."""

    def __init__(self, prefix: str, source: str):
        self.prefix = prefix
        self.ctes: list[tuple[str, str]] = [(f"{prefix}0", source)]

    @property
    def last(self) -> str:
        return self.ctes[-1][0]

    def _push(self, body: str) -> Chain:
        self.ctes.append((f"{self.prefix}{len(self.ctes)}", body))
        return self

    def add(self, **cols: str) -> Chain:
        sel = ", ".join(f"{e} AS {n}" for n, e in cols.items())
        return self._push(f"SELECT *, {sel} FROM {self.last}")

    def replace(self, **cols: str) -> Chain:
        sel = ", ".join(f"{e} AS {n}" for n, e in cols.items())
        return self._push(f"SELECT * REPLACE ({sel}) FROM {self.last}")


def with_ctes(*parts: list[tuple[str, str]] | tuple[str, str], final: str) -> str:
    ctes: list[tuple[str, str]] = []
    for p in parts:
        ctes.extend(p if isinstance(p, list) else [p])
    body = ",\n".join(f"{n} AS ({s})" for n, s in ctes)
    return f"WITH {body}\n{final}"


# --------------------------------------------------------------------------- raw views
def _m(x: str, k: int, r: int) -> str:
    return f"({x} % {k} = {r})"


RAW_STATIONS = f"""
SELECT
  CASE WHEN {_m('c_custkey', 101, 50)} THEN '-' || CAST(c_custkey + 1 AS VARCHAR)
       WHEN {_m('c_custkey', 103, 51)} THEN 'abc'
       ELSE CAST(c_custkey + 1 AS VARCHAR) END AS station_id,
  CASE WHEN {_m('c_custkey', 53, 7)} THEN 'Lille Station ' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0')
       WHEN {_m('c_custkey', 59, 11)} THEN NULL
       ELSE 'Lille - Station ' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') END AS station_name,
  CASE WHEN {_m('c_custkey', 61, 3)} THEN '91.5' WHEN {_m('c_custkey', 67, 4)} THEN ''
       ELSE '50.' || lpad(CAST(c_custkey * 37 % 10000 AS VARCHAR), 4, '0') END AS lat,
  CASE WHEN {_m('c_custkey', 71, 5)} THEN '-181' WHEN {_m('c_custkey', 73, 6)} THEN 'abc'
       ELSE '3.' || lpad(CAST(c_custkey * 91 % 10000 AS VARCHAR), 4, '0') END AS lon,
  CASE WHEN {_m('c_custkey', 79, 7)} THEN '0' WHEN {_m('c_custkey', 83, 8)} THEN 'x'
       ELSE CAST(c_custkey % 30 + 20 AS VARCHAR) END AS capacity
FROM customer"""

_TS_TEXT = f"""CASE WHEN {_m('k', 8, 0)} THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
       WHEN {_m('k', 8, 1)} THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       WHEN {_m('k', 8, 2)} THEN strftime(ts, '%d/%m/%Y %H:%M')
       WHEN {_m('k', 8, 3)} THEN strftime(ts, '%d-%m-%Y %H:%M:%S')
       WHEN {_m('k', 8, 4)} THEN strftime(ts, '%Y-%m-%d %H:%M')
       WHEN {_m('k', 8, 5)} THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.123Z'
       WHEN {_m('k', 8, 6)} THEN strftime(ts, '%d.%m.%Y')
       WHEN {_m('k', 64, 7)} THEN 'not-a-date'
       WHEN {_m('k', 64, 15)} THEN ''
       ELSE strftime(ts, '%Y/%m/%d %H:%M:%S') END"""

RAW_AVAILABILITY = f"""
SELECT
  CASE WHEN {_m('k', 211, 17)} THEN 'x' || CAST(u + 1 AS VARCHAR) ELSE CAST(u + 1 AS VARCHAR) END AS station_id,
  CASE WHEN copy = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE {_TS_TEXT} END AS timestamp,
  CASE WHEN copy = 1 THEN CAST(b + 1 AS VARCHAR)
       WHEN {_m('k', 23, 1)} THEN 'n/a' WHEN {_m('k', 29, 2)} THEN '-3'
       WHEN {_m('k', 31, 4)} THEN NULL WHEN {_m('k', 37, 5)} THEN ''
       ELSE CAST(b AS VARCHAR) END AS bikes_available,
  CASE WHEN copy = 1 AND {_m('k', 20, 3)} THEN NULL
       WHEN copy = 1 THEN CAST(greatest(u % 30 + 20 - b - 1, 0) AS VARCHAR)
       WHEN {_m('k', 41, 6)} THEN NULL WHEN {_m('k', 43, 7)} THEN '5.0'
       WHEN {_m('k', 47, 8)} THEN CAST(greatest(u % 30 + 20 - b, 0) + 3 AS VARCHAR)
       ELSE CAST(greatest(u % 30 + 20 - b, 0) AS VARCHAR) END AS slots_free
FROM (
  SELECT event_id AS k, ts, user_id AS u, CAST(floor(value / 8.0) AS BIGINT) AS b,
         unnest(CASE WHEN event_id % 10 = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM events)"""

RAW_WEATHER = f"""
SELECT
  CASE WHEN {_m('k', 5, 0)} THEN strftime(h, '%Y-%m-%dT%H:%M:%S')
       WHEN {_m('k', 7, 1)} THEN strftime(h, '%d/%m/%Y %H:%M')
       ELSE strftime(h, '%Y-%m-%d %H:%M:%S') END AS timestamp,
  CAST(v % 80 - 25 AS VARCHAR) || CASE WHEN {_m('k', 3, 0)} THEN ',' ELSE '.' END
    || CAST(k % 10 AS VARCHAR) AS temperature_c,
  CASE WHEN {_m('k', 13, 0)} THEN 'abc'
       ELSE CAST(v % 9 - 1 AS VARCHAR) || '.' || CAST(k % 10 AS VARCHAR) END AS rain_mm,
  CASE kind WHEN 'view' THEN 'Clear' WHEN 'click' THEN 'Cloudy' WHEN 'purchase' THEN 'Rain'
            WHEN 'signup' THEN 'Drizzle'
            ELSE CASE WHEN {_m('k', 2, 0)} THEN 'Fog' ELSE 'Sunny' END END AS weather_condition
FROM (
  SELECT h, min(k) AS k, CAST(floor(sum(s) / sum(n)) AS BIGINT) AS v,
         first(kind ORDER BY n DESC, kind) AS kind
  FROM (SELECT date_trunc('hour', ts) AS h, event_type AS kind, count(*) AS n, min(event_id) AS k,
               sum(CAST(floor(value) AS BIGINT)) AS s FROM events GROUP BY 1, 2)
  GROUP BY h)"""


# --------------------------------------------------------------------------- rules
# Each rule: (stages, value, corrected, invalid) with "{p}" standing for the rule's
# temp-column prefix and "{c}" for the input expression.

def _rule_date() -> tuple[list[dict[str, str]], str, str, str]:
    stages = [
        {"{p}blank": "({c} IS NULL OR {c} = '')", "{p}had_t": "(strpos({c}, 'T') > 0)",
         "{p}t": "replace({c}, 'T', ' ')"},
        {"{p}sep": "regexp_matches({p}t, '[./]')",
         "{p}n": "CASE WHEN regexp_matches({p}t, '[./]') THEN regexp_replace("
                 + _trim_ws("{p}t") + ", '[./]', '-', 'g') ELSE {p}t END"},
        {"{p}dp": "CASE WHEN strpos({p}n, ' ') > 0 THEN split_part({p}n, ' ', 1) ELSE substr({p}n, 1, 10) END",
         "{p}hp": "CASE WHEN strpos({p}n, ' ') > 0 THEN split_part({p}n, ' ', 2) ELSE substr({p}n, 11) END"},
        {"{p}dmy": r"regexp_matches({p}dp, '^\d{2}-\d{2}-\d{4}$')",
         "{p}ymd": r"regexp_matches({p}dp, '^\d{4}-\d{2}-\d{2}$')",
         "{p}hs": _trim_ws("{p}hp")},
        {"{p}d1": "CASE WHEN {p}dmy THEN substr({p}dp, 7, 4) || '-' || substr({p}dp, 4, 2) || '-' || substr({p}dp, 1, 2) "
                  "WHEN {p}ymd THEN {p}dp END",
         "{p}kind": r"CASE WHEN length({p}hs) = 0 THEN 1 WHEN regexp_matches({p}hs, '^\d{2}:\d{2}$') THEN 2 "
                    r"WHEN regexp_matches({p}hs, '^\d{2}:\d{2}:\d{2}.+') THEN 3 ELSE 0 END"},
    ]
    value = ("CASE WHEN NOT {p}blank AND {p}d1 IS NOT NULL THEN {p}d1 || ' ' || CASE {p}kind "
             "WHEN 1 THEN '00:00:00' WHEN 2 THEN {p}hs || ':00' WHEN 3 THEN substr({p}hs, 1, 8) "
             "ELSE {p}hs END END")
    corrected = ("(NOT {p}blank AND ({p}had_t OR {p}sep OR ({p}d1 IS NOT NULL AND "
                 "({p}dmy OR {p}kind > 0))))")
    invalid = "({p}blank OR {p}d1 IS NULL)"
    return stages, value, corrected, invalid


_DEC = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _rule_decimal(low: float | None, high: float | None, comma: bool, typ: str = "DOUBLE"):
    text = "replace({c}, ',', '.')" if comma else "{c}"
    stages = [{"{p}blank": "({c} IS NULL OR {c} = '')", "{p}f": text},
              {"{p}v": f"CASE WHEN regexp_matches({_trim_ws('{p}f')}, '{_DEC}') "
                       f"THEN TRY_CAST({_trim_ws('{p}f')} AS DOUBLE) END"}]
    cond = ["{p}v IS NOT NULL"]
    if low is not None:
        cond.append(f"{{p}}v >= {low}")
    if high is not None:
        cond.append(f"{{p}}v <= {high}")
    stages.append({"{p}ok": f"(NOT {{p}}blank AND coalesce({' AND '.join(cond)}, false))"})
    value = f"CAST(CASE WHEN {{p}}ok THEN {{p}}v END AS {typ})"
    corrected = "({p}ok AND {p}f <> {c})" if comma else "false"
    return stages, value, corrected, "(NOT {p}ok)"


def _rule_member(allowed: tuple[str, ...]):
    lst = ", ".join(f"'{a}'" for a in allowed)
    stages = [{"{p}ok": f"coalesce({{c}} IN ({lst}), false)"}]
    return stages, "CASE WHEN {p}ok THEN {c} END", "false", "(NOT {p}ok)"


def _rule_station_name():
    stages = [{"{p}ok": r"coalesce(regexp_full_match({c}, 'Lille - Station \d{2}'), false)"}]
    return stages, "CASE WHEN {p}ok THEN {c} END", "false", "(NOT {p}ok)"


def _rule_positive_int():
    t = _trim_ws("{c}")
    stages = [{"{p}v": rf"CASE WHEN regexp_matches({t}, '^[+-]?\d+$') THEN TRY_CAST({t} AS INTEGER) END"},
              {"{p}val": "CASE WHEN {p}v > 0 THEN {p}v END"}]
    return stages, "{p}val", "({p}val IS NOT NULL)", "({p}val IS NULL)"


def _count_sql(x: str) -> str:
    return rf"CASE WHEN regexp_matches(CAST({x} AS VARCHAR), '^\d+$') THEN TRY_CAST(CAST({x} AS VARCHAR) AS BIGINT) END"


def _rule_bike_count(other: str, capacity: str):
    stages = [{"{p}v": _count_sql("{c}"), "{p}o": _count_sql(other), "{p}cap": _count_sql(capacity)},
              {"{p}val": "CAST(CASE WHEN {p}v IS NULL THEN (CASE WHEN {p}o IS NOT NULL AND {p}cap IS NOT NULL "
                         "THEN greatest({p}cap - {p}o, 0) END) "
                         "WHEN {p}cap IS NOT NULL AND {p}v > {p}cap THEN {p}cap ELSE {p}v END AS INTEGER)"}]
    corrected = "({p}val IS NOT NULL AND ({p}v IS NULL OR coalesce({p}cap IS NOT NULL AND {p}v > {p}cap, false)))"
    return stages, "{p}val", corrected, "({p}val IS NULL)"


# The conditions the cleaning rules accept.
WEATHER = ("Rain", "Cloudy", "Clear", "Drizzle", "Fog")


def apply_rules(chain: Chain, rules: list[tuple[str, tuple]]) -> Chain:
    """Apply (column, rule) pairs in order; adds row_corrected / value_invalid."""
    chain.add(row_corrected="false", value_invalid="false")
    for i, (col, rule) in enumerate(rules):
        stages, value, corr, inv = rule
        p = f"r{i}_"
        fill = lambda s: s.replace("{p}", p).replace("{c}", col)
        for st in stages:
            chain.add(**{fill(k): fill(v) for k, v in st.items()})
        chain.replace(**{col: fill(value), "row_corrected": f"(row_corrected OR {fill(corr)})",
                         "value_invalid": f"(value_invalid OR {fill(inv)})"})
    return chain


# --------------------------------------------------------------------------- silver
def silver_stations_ctes(prefix: str = "st", source: str = RAW_STATIONS) -> tuple[list, str]:
    """(ctes, last cte name) with columns of the station silver + flags."""
    ch = Chain(prefix, source)
    apply_rules(ch, [("station_id", _rule_positive_int()),
                     ("station_name", _rule_station_name()),
                     ("lat", _rule_decimal(-90.0, 90.0, False, "FLOAT")),
                     ("lon", _rule_decimal(-180.0, 180.0, False, "FLOAT")),
                     ("capacity", _rule_positive_int())])
    return ch.ctes, ch.last


STATION_COLS = "station_id, station_name, lat, lon, capacity"
WEATHER_COLS = "timestamp, temperature_c, rain_mm, weather_condition, date_partition"
AVAIL_COLS = "station_id, timestamp, bikes_available, slots_free, date_partition"


def silver_weather_ctes(prefix: str = "wx", source: str = RAW_WEATHER) -> tuple[list, str]:
    ch = Chain(prefix, source)
    apply_rules(ch, [("timestamp", _rule_date()),
                     ("temperature_c", _rule_decimal(-20.0, 50.0, True)),
                     ("rain_mm", _rule_decimal(0.0, None, True)),
                     ("weather_condition", _rule_member(WEATHER))])
    ch.add(date_partition="TRY_CAST(substr(timestamp, 1, 10) AS DATE)")
    return ch.ctes, ch.last


def silver_availability_ctes(prefix: str = "av", readings: str = RAW_AVAILABILITY,
                             stations: str = RAW_STATIONS) -> tuple[list, str]:
    """Flagged availability (before dedup) in ``{prefix}_flagged`` and the deduplicated
    silver in ``{prefix}_silver``."""
    src = (f"SELECT a.station_id, a.timestamp, a.bikes_available, a.slots_free, s.capacity "
           f"FROM ({readings}) a LEFT JOIN (SELECT station_id, min(capacity) AS capacity FROM ({stations}) GROUP BY station_id) s "
           f"ON a.station_id = s.station_id")
    ch = Chain(prefix, src)
    apply_rules(ch, [("station_id", _rule_positive_int()),
                     ("timestamp", _rule_date()),
                     ("bikes_available", _rule_bike_count("slots_free", "capacity")),
                     ("slots_free", _rule_bike_count("bikes_available", "capacity"))])
    ch.add(score="(CASE WHEN station_id IS NULL THEN 1 ELSE 0 END) "
                 "+ (CASE WHEN timestamp IS NULL OR timestamp = '' THEN 1 ELSE 0 END) "
                 "+ (CASE WHEN bikes_available IS NULL THEN 1 ELSE 0 END) "
                 "+ (CASE WHEN slots_free IS NULL THEN 1 ELSE 0 END) "
                 "+ (CASE WHEN capacity IS NULL OR capacity = '' THEN 1 ELSE 0 END)",
           date_partition="TRY_CAST(substr(timestamp, 1, 10) AS DATE)")
    flagged = (f"{prefix}_flagged", f"SELECT station_id, timestamp, bikes_available, slots_free, capacity, "
                                    f"score, date_partition, row_corrected, value_invalid FROM {ch.last}")
    silver = (f"{prefix}_silver",
              f"SELECT {AVAIL_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY station_id, timestamp "
              f"ORDER BY score, bikes_available NULLS FIRST, slots_free NULLS FIRST, capacity NULLS FIRST, "
              f"date_partition NULLS FIRST) AS rn FROM {prefix}_flagged) WHERE rn = 1")
    return ch.ctes + [flagged, silver], f"{prefix}_silver"


def silver_parts(*, stations: bool = False, weather: bool = False, availability: bool = False) -> list:
    parts: list = []
    if stations:
        c, last = silver_stations_ctes()
        parts += c + [("stations_silver", f"SELECT {STATION_COLS} FROM {last} "
                                          f"WHERE NOT ({' AND '.join(x + ' IS NULL' for x in STATION_COLS.split(', '))})")]
    if weather:
        c, last = silver_weather_ctes()
        parts += c + [("weather_silver", f"SELECT {WEATHER_COLS} FROM {last} "
                                         f"WHERE NOT ({' AND '.join(x + ' IS NULL' for x in WEATHER_COLS.split(', '))})")]
    if availability:
        c, last = silver_availability_ctes()
        parts += c + [("availability_silver", f"SELECT * FROM {last}")]
    return parts


def report_sql(which: str, raw: dict[str, str] | None = None) -> str:
    """The report of a silver table, of the given raw tables or of those derived from the data."""
    raw = raw or {"stations": RAW_STATIONS, "availability": RAW_AVAILABILITY, "weather": RAW_WEATHER}
    if which == "availability":
        parts = silver_availability_ctes("av", raw["availability"], raw["stations"])[0]
        final = ("SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_raw, "
                 "CAST(coalesce(sum(c), 0) AS BIGINT) AS rows_corrected, "
                 "CAST(coalesce(sum(i), 0) AS BIGINT) AS rows_invalid, "
                 "CAST(coalesce(sum(n), 0) - count(*) AS BIGINT) AS rows_removed FROM (SELECT count(*) AS n, "
                 "count(*) FILTER (WHERE row_corrected) AS c, count(*) FILTER (WHERE value_invalid) AS i "
                 "FROM av_flagged GROUP BY station_id, timestamp)")
        return with_ctes(parts, final=final)
    ctes, last = (silver_stations_ctes("st", raw["stations"]) if which == "stations" else silver_weather_ctes("wx", raw["weather"]))
    cols = STATION_COLS if which == "stations" else WEATHER_COLS
    all_null = " AND ".join(f"{x} IS NULL" for x in cols.split(", "))
    final = (f"SELECT count(*) AS rows_raw, count(*) FILTER (WHERE row_corrected) AS rows_corrected, "
             f"count(*) FILTER (WHERE value_invalid) AS rows_invalid, "
             f"count(*) FILTER (WHERE {all_null}) AS rows_removed FROM {last}")
    return with_ctes(ctes, final=final)


# --------------------------------------------------------------------------- gold
def round2(x: str) -> str:
    return f"CAST(round(TRY_CAST({x} AS DECIMAL(38,10)), 2) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return round2(f"(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)) * 100.0")


STATION_ONE = ("station_one", """
SELECT station_id, station_name, lat, lon, capacity FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY (station_name IS NULL)::INT + (lat IS NULL)::INT
    + (lon IS NULL)::INT + (capacity IS NULL)::INT, station_name NULLS FIRST, lat NULLS FIRST, lon NULLS FIRST,
    capacity NULLS FIRST) AS rn FROM stations_silver WHERE station_id IS NOT NULL) WHERE rn = 1""")

DIM_STATION = ("dim_station", """
SELECT *, coalesce(CAST(station_id AS BIGINT), -1) AS station_key FROM (
  SELECT *, regexp_extract(station_name, '^([A-Za-z\\-]+) - Station', 1) AS city,
    regexp_extract(station_name, 'Station (\\d+)', 1) AS station_number
  FROM (SELECT * FROM station_one UNION ALL SELECT DISTINCT NULL::INTEGER, NULL::VARCHAR, NULL::FLOAT, NULL::FLOAT,
        NULL::INTEGER FROM stations_silver WHERE station_id IS NULL))""")

DIM_WEATHER = ("dim_weather", """
SELECT weather_condition,
  CAST(dense_rank() OVER (ORDER BY weather_condition NULLS FIRST) AS BIGINT) AS weather_condition_key
FROM (SELECT DISTINCT weather_condition FROM weather_silver)""")

DIM_DATE_SQL = """
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter, strftime(d, '%a') AS day_of_week,
  CAST(isodow(d) AS INTEGER) AS day_of_week_num, isodow(d) >= 6 AS is_weekend,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(isoyear(d) AS INTEGER) AS iso_year,
  CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_key
FROM (SELECT unnest(generate_series(min(lo), max(hi), INTERVAL 1 DAY)) AS d FROM ({span}) WHERE lo IS NOT NULL)"""

DIM_DATE = ("dim_date", DIM_DATE_SQL.format(span="""
  SELECT min(date_partition) AS lo, max(date_partition) AS hi FROM availability_silver
  UNION ALL SELECT min(date_partition), max(date_partition) FROM weather_silver"""))


def fixed_calendar(first: str, last: str) -> tuple[str, str]:
    return ("dim_date", DIM_DATE_SQL.format(span=f"SELECT DATE '{first}' AS lo, DATE '{last}' AS hi"))


JOINED = ("joined", """
SELECT a.station_id, a.timestamp, a.bikes_available, a.slots_free, a.date_partition,
       s.station_name, s.lat, s.lon, s.capacity
FROM availability_silver a JOIN station_one s ON a.station_id = s.station_id""")


def gold_parts() -> list:
    return silver_parts(stations=True, weather=True, availability=True) + [STATION_ONE, DIM_STATION, DIM_WEATHER,
                                                                           DIM_DATE, JOINED]


FACT_AVG_BIKES = ("fact_avg_bikes", f"""
SELECT f.avg_bikes_available, d.date_key, s.station_key FROM (
  SELECT date_partition, station_id, {round2('avg(bikes_available)')} AS avg_bikes_available
  FROM availability_silver GROUP BY date_partition, station_id) f
LEFT JOIN dim_date d ON f.date_partition = d.date
LEFT JOIN dim_station s ON f.station_id = s.station_id""")

FACT_OCCUPANCY = ("fact_occupancy", f"""
SELECT f.occupancy_pct, d.date_key, CAST(f.hour * 60 + f.minute AS BIGINT) AS time_key, s.station_key FROM (
  SELECT station_id, date_partition, {pct('bikes_available', 'bikes_available + slots_free')} AS occupancy_pct,
    hour(TRY_CAST(timestamp AS TIMESTAMP)) AS hour, minute(TRY_CAST(timestamp AS TIMESTAMP)) AS minute
  FROM joined) f
LEFT JOIN dim_date d ON f.date_partition = d.date
LEFT JOIN dim_station s ON f.station_id = s.station_id""")

FACT_DOMINANT = ("fact_dominant", """
SELECT f.count, d.date_key, w.weather_condition_key FROM (
  SELECT date_partition, weather_condition, count, row_number() OVER (PARTITION BY date_partition
    ORDER BY count DESC, weather_condition ASC NULLS FIRST) AS rn
  FROM (SELECT date_partition, weather_condition, count(*) AS count FROM weather_silver
        GROUP BY date_partition, weather_condition)) f
LEFT JOIN dim_date d ON f.date_partition = d.date
LEFT JOIN dim_weather w ON f.weather_condition = w.weather_condition
WHERE f.rn = 1""")

FACT_SATURATION = ("fact_saturation", f"""
SELECT f.saturation_pct, d.date_key, s.station_key FROM (
  SELECT date_partition, station_id,
    {pct('count(*) FILTER (WHERE bikes_available = capacity)', 'count(*)')} AS saturation_pct
  FROM joined GROUP BY date_partition, station_id) f
LEFT JOIN dim_date d ON f.date_partition = d.date
LEFT JOIN dim_station s ON f.station_id = s.station_id""")

FACT_TOP = ("fact_top", """
SELECT saturation_pct, date_key, station_key, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY date_key ORDER BY saturation_pct DESC NULLS LAST,
    station_key ASC NULLS FIRST) AS rank FROM fact_saturation) WHERE rank <= 5""")


def fact_sql(name: str, calendar: tuple[str, str] | None = None) -> str:
    """``calendar``: the first and last day of a fixed calendar instead of the data's own."""
    parts = gold_parts()
    if calendar:
        parts = [fixed_calendar(*calendar) if p[0] == "dim_date" else p for p in parts]
    if name == "fact_avg_bikes":
        return with_ctes(parts, FACT_AVG_BIKES, final="SELECT * FROM fact_avg_bikes")
    if name == "fact_occupancy":
        return with_ctes(parts, FACT_OCCUPANCY, final="SELECT * FROM fact_occupancy")
    if name == "fact_dominant_weather":
        return with_ctes(parts, FACT_DOMINANT, final="SELECT * FROM fact_dominant")
    if name == "fact_saturation":
        return with_ctes(parts, FACT_SATURATION, final="SELECT * FROM fact_saturation")
    if name == "fact_top_saturated":
        return with_ctes(parts, FACT_SATURATION, FACT_TOP,
                         final="SELECT saturation_pct, date_key, station_key FROM fact_top")
    if name == "fact_top_array":
        return with_ctes(parts, FACT_SATURATION, FACT_TOP,
                         final="SELECT date_key, CAST(rank AS INTEGER) AS rank, station_key, saturation_pct FROM fact_top")
    if name == "gold_daily":
        final = f"""
SELECT a.date_key, {round2('a.b')} AS avg_bikes_available_day, {round2('o.o')} AS occupancy_pct_day,
  w.weather_condition_key AS weather_condition_key_day, CAST(t.rank AS INTEGER) AS rank, t.station_key, t.saturation_pct
FROM (SELECT date_key, avg(avg_bikes_available) AS b FROM fact_avg_bikes GROUP BY date_key) a
JOIN fact_dominant w ON a.date_key = w.date_key
JOIN (SELECT date_key, avg(occupancy_pct) AS o FROM fact_occupancy GROUP BY date_key) o ON a.date_key = o.date_key
JOIN fact_top t ON a.date_key = t.date_key"""
        return with_ctes(parts, FACT_AVG_BIKES, FACT_OCCUPANCY, FACT_DOMINANT, FACT_SATURATION, FACT_TOP,
                         final=final)
    raise KeyError(name)


def _landed() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """Of each raw table: which lines are well formed, all its rows, and the rows that the landing gives back."""
    good = {"stations": "capacity IS DISTINCT FROM '23'", "availability": "bikes_available IS DISTINCT FROM '7'",
            "weather": "weather_condition IS DISTINCT FROM 'Fog'"}
    raw = {"stations": RAW_STATIONS, "availability": RAW_AVAILABILITY, "weather": RAW_WEATHER}
    return good, raw, {k: f"SELECT nullif(columns(*), '') FROM ({raw[k]}) WHERE {good[k]}" for k in raw}


def landing_sql(name: str) -> str:
    """What the CSV landing gives back: lines with one field too many are set apart, and an empty
    field is a missing one."""
    good, raw, rows = _landed()
    if name == "csv_rejects":
        return " UNION ALL ".join(f"SELECT '{k}' AS table_name, count(*) FILTER (WHERE {good[k]}) AS rows_read, "
                                  f"count(*) FILTER (WHERE NOT ({good[k]})) AS rows_malformed FROM ({raw[k]})" for k in raw)
    if name == "batch_report":
        return " UNION ALL ".join(
            f"SELECT '{k}_silver' AS table_name, rows_raw, (SELECT count(*) FROM ({raw[k]}) WHERE NOT ({good[k]})) AS rows_malformed, "
            f"rows_corrected, rows_invalid, rows_removed FROM ({report_sql(k, rows)})" for k in raw)
    if name == "station_export":
        ctes, last = silver_stations_ctes("st", rows["stations"])
        return with_ctes(ctes, final=f"SELECT {STATION_COLS} FROM {last} WHERE coalesce({', '.join(f'CAST({c} AS VARCHAR)' for c in STATION_COLS.split(', '))}) IS NOT NULL")
    if name == "csv_stations":
        return rows["stations"]
    ctes, last = silver_availability_ctes("av", rows["availability"], rows["stations"])
    return with_ctes(ctes, final=f"SELECT * FROM {last}")


def station_key_check_sql() -> str:
    return with_ctes(silver_parts(stations=True), STATION_ONE, DIM_STATION, final="""
SELECT (SELECT count(*) FROM stations_silver) AS n_silver_rows,
  (SELECT count(*) FROM (SELECT station_id FROM stations_silver WHERE station_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS n_repeated_ids,
  (SELECT count(*) FROM stations_silver WHERE station_id IS NULL) AS n_without_id,
  (SELECT count(*) FROM dim_station) AS n_members, (SELECT count(DISTINCT station_key) FROM dim_station) AS n_keys,
  (SELECT count(*) FROM (SELECT station_key FROM dim_station GROUP BY 1 HAVING count(*) > 1)) AS n_repeated_keys""")


WEATHER_HOURS = """
SELECT h AS hour, CAST(sum(n) AS BIGINT) AS n_events, min(k) AS k, CAST(floor(sum(s) / sum(n)) AS BIGINT) AS v,
       first(kind ORDER BY n DESC, kind) AS kind
FROM (SELECT date_trunc('hour', ts) AS h, event_type AS kind, count(*) AS n, min(event_id) AS k,
             sum(CAST(floor(value) AS BIGINT)) AS s FROM events GROUP BY 1, 2)
GROUP BY h"""


# --------------------------------------------------------------------------- quality
READ_TIME = "TRY_CAST(timestamp AS TIMESTAMP)"

FROZEN = ("frozen", f"""
SELECT station_id, bikes_available, slots_free, min(t) AS start_time, max(t) AS end_time,
       count(*) AS n_readings
FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY t, bikes_available NULLS FIRST,
                                   slots_free NULLS FIRST)
              - row_number() OVER (PARTITION BY station_id, bikes_available, slots_free ORDER BY t) AS g
      FROM (SELECT station_id, {READ_TIME} AS t, bikes_available, slots_free FROM availability_silver)
      WHERE station_id IS NOT NULL AND t IS NOT NULL)
GROUP BY station_id, bikes_available, slots_free, g HAVING count(*) >= 3""")

CRITICAL = ("critical", f"""
SELECT station_id, min(t) AS start_time, max(t) AS end_time, count(*) AS n_readings,
       (epoch(max(t)) - epoch(min(t))) / 60.0 AS duration_minutes
FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY t, c)
              - row_number() OVER (PARTITION BY station_id, c ORDER BY t) AS g
      FROM (SELECT station_id, {READ_TIME} AS t,
                   CAST(bikes_available AS BIGINT) * 100 < CAST(capacity AS BIGINT) * 20 AS c FROM joined)
      WHERE station_id IS NOT NULL AND t IS NOT NULL AND c IS NOT NULL)
GROUP BY station_id, c, g HAVING c AND (epoch(max(t)) - epoch(min(t))) / 60.0 > 30""")


def quality_sql(name: str) -> str:
    g = gold_parts()
    if name == "enriched_weather":
        final = f"""
SELECT j.station_id, j.timestamp, j.bikes_available, j.timestamp_rounded, w.timestamp AS weather_timestamp,
       w.temperature_c, w.rain_mm, w.weather_condition
FROM (SELECT *, strftime(date_trunc('hour', {READ_TIME} + INTERVAL 30 MINUTE), '%Y-%m-%d %H:%M:%S')
             AS timestamp_rounded FROM joined) j
LEFT JOIN (SELECT * FROM (SELECT *, TRY_CAST(timestamp AS TIMESTAMP) AS wh, row_number() OVER (
             PARTITION BY TRY_CAST(timestamp AS TIMESTAMP) ORDER BY timestamp, weather_condition NULLS FIRST,
             temperature_c NULLS FIRST, rain_mm NULLS FIRST) AS rn FROM weather_silver) WHERE rn = 1) w
  ON TRY_CAST(j.timestamp_rounded AS TIMESTAMP) = w.wh"""
        return with_ctes(g, final=final)
    if name == "quality_negatives":
        return with_ctes(silver_parts(weather=True), final=(
            "SELECT date_partition, count(*) FILTER (WHERE temperature_c < 0) AS nb_neg_temperature_c "
            "FROM weather_silver GROUP BY date_partition"))
    if name == "quality_capacity":
        return with_ctes(silver_parts(stations=True, availability=True), STATION_ONE, final=(
            "SELECT a.station_id, a.date_partition, count(*) FILTER (WHERE "
            "(a.bikes_available + a.slots_free) IS DISTINCT FROM s.capacity OR a.bikes_available IS NULL "
            "OR a.slots_free IS NULL OR s.capacity IS NULL) AS nb_incoherent_capacity "
            "FROM availability_silver a JOIN station_one s ON a.station_id = s.station_id "
            "GROUP BY a.station_id, a.date_partition"))
    if name == "quality_report_lines":
        rep = report_sql("availability")
        body = rep[rep.index("WITH ") + 5:]
        ctes, final = body.rsplit("\nSELECT", 1)
        lines = ["'Quality report - availability_silver'", "'-------------------------------------'",
                 "'- Raw rows : ' || CAST(rows_raw AS VARCHAR)",
                 "'- Corrected rows : ' || CAST(rows_corrected AS VARCHAR)",
                 "'- Invalid rows (values replaced by NULL) : ' || CAST(rows_invalid AS VARCHAR)",
                 "'- Removed rows : ' || CAST(rows_removed AS VARCHAR)"]
        union = " UNION ALL ".join(f"SELECT {i + 1} AS line_no, {x} AS line FROM report"
                                   for i, x in enumerate(lines))
        return f"WITH {ctes}, report AS (SELECT{final})\n{union}"
    if name == "null_audit":
        return with_ctes(g, final=(
            "SELECT count(*) FILTER (WHERE bikes_available IS NULL AND slots_free IS NULL AND capacity IS NOT NULL) "
            "AS n_both_null_capacity_known, count(*) FILTER (WHERE slots_free IS NULL) AS n_slots_null, "
            "count(*) FILTER (WHERE bikes_available IS NULL) AS n_bikes_null, "
            "count(*) FILTER (WHERE capacity IS NULL) AS n_capacity_null FROM joined"))
    if name == "weather_profile":
        return f"SELECT weather_condition, count(*) AS n FROM ({RAW_WEATHER}) GROUP BY weather_condition"
    if name == "frozen_stations":
        return with_ctes(silver_parts(availability=True), FROZEN, final="SELECT * FROM frozen")
    if name == "critical_episodes":
        return with_ctes(g, CRITICAL, final="SELECT * FROM critical")
    if name == "quality_daily":
        final = """
SELECT c.station_id, c.date_partition, c.n_readings, c.nb_neg_bikes_available, c.nb_neg_slots_free,
       c.nb_incoherent_capacity, coalesce(f.n_frozen_runs, 0) AS n_frozen_runs,
       CAST(coalesce(f.n_frozen_readings, 0) AS BIGINT) AS n_frozen_readings
FROM (SELECT a.station_id, a.date_partition, count(*) AS n_readings,
        count(*) FILTER (WHERE a.bikes_available < 0) AS nb_neg_bikes_available,
        count(*) FILTER (WHERE a.slots_free < 0) AS nb_neg_slots_free,
        count(*) FILTER (WHERE s.station_id IS NOT NULL AND ((a.bikes_available + a.slots_free) IS DISTINCT FROM s.capacity
          OR a.bikes_available IS NULL OR a.slots_free IS NULL OR s.capacity IS NULL)) AS nb_incoherent_capacity
      FROM availability_silver a
      LEFT JOIN station_one s ON a.station_id = s.station_id
      GROUP BY a.station_id, a.date_partition) c
LEFT JOIN (SELECT station_id, CAST(start_time AS DATE) AS d, count(*) AS n_frozen_runs,
                  sum(n_readings) AS n_frozen_readings FROM frozen GROUP BY station_id, CAST(start_time AS DATE)) f
  ON c.station_id = f.station_id AND c.date_partition = f.d"""
        return with_ctes(silver_parts(stations=True, availability=True), STATION_ONE, FROZEN, final=final)
    raise KeyError(name)


def cube_sql() -> str:
    return with_ctes(silver_parts(stations=True, availability=True), STATION_ONE, final=f"""
SELECT station_id, date_partition, count(*) AS n_readings, count(*) FILTER (WHERE known) AS n_matched, count(b) AS n_bikes,
       CAST(coalesce(sum(b), 0) AS BIGINT) AS sum_bikes, count(*) FILTER (WHERE known AND b = c) AS n_full, count(occ) AS n_occupancy,
       CAST(coalesce(sum(CAST(occ AS DECIMAL(28,2))), 0) AS DOUBLE) AS sum_occupancy, count(*) FILTER (WHERE b < 0) AS nb_neg_bikes_available,
       count(*) FILTER (WHERE s < 0) AS nb_neg_slots_free,
       count(*) FILTER (WHERE known AND ((b + s) IS DISTINCT FROM c OR b IS NULL OR s IS NULL OR c IS NULL)) AS nb_incoherent_capacity
FROM (SELECT a.station_id, a.date_partition, a.bikes_available AS b, a.slots_free AS s, o.capacity AS c, o.station_id IS NOT NULL AS known,
             CASE WHEN o.station_id IS NOT NULL THEN {pct('a.bikes_available', 'a.bikes_available + a.slots_free')} END AS occ
      FROM availability_silver a LEFT JOIN station_one o ON a.station_id = o.station_id)
GROUP BY station_id, date_partition""")


ALERTS = f"""
SELECT station_id, run_start, t AS alert_time, waited AS minutes_critical, bikes_available, capacity FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id, run_start ORDER BY t, bikes_available) AS rn FROM (
    SELECT station_id, t, bikes_available, capacity, min(t) OVER (PARTITION BY station_id, c, g) AS run_start,
           (epoch(t) - epoch(min(t) OVER (PARTITION BY station_id, c, g))) / 60.0 AS waited, c
    FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY t, c)
                  - row_number() OVER (PARTITION BY station_id, c ORDER BY t) AS g
          FROM (SELECT station_id, {READ_TIME} AS t, bikes_available, capacity,
                       CAST(bikes_available AS BIGINT) * 100 < CAST(capacity AS BIGINT) * 20 AS c FROM joined)
          WHERE station_id IS NOT NULL AND t IS NOT NULL AND c IS NOT NULL)) WHERE c AND waited > 30) WHERE rn = 1"""


def stream_sql(name: str, first_cut: str, late_day: str, late_station: str) -> str:
    """The streams' tables from the batch silver: every reading with a readable time, once. One day's readings come
    again too late, and one reading exactly two hours before the last one ahead of ``first_cut``."""
    if name == "stream_alerts":
        return with_ctes(gold_parts(), final=ALERTS)
    silver = silver_parts(availability=True)
    if name == "stream_silver":
        return with_ctes(silver, final=f"SELECT * FROM availability_silver WHERE {READ_TIME} IS NOT NULL")
    if name == "stream_day_silver":
        return with_ctes(silver, final=f"""
SELECT station_id, timestamp, bikes_available, slots_free, date_partition FROM availability_silver
UNION ALL SELECT {late_station}, strftime(t, '%Y-%m-%d %H:%M:%S'), NULL, NULL, CAST(t AS DATE)
FROM (SELECT max({READ_TIME}) - INTERVAL 2 HOUR AS t FROM availability_silver WHERE {READ_TIME} < TIMESTAMP '{first_cut}')""")
    return with_ctes(silver_availability_ctes()[0], final=f"""
SELECT CASE WHEN {READ_TIME} IS NULL THEN 'timeless' ELSE 'on_time' END AS status, CAST(count(*) AS BIGINT) AS n
FROM av_flagged GROUP BY 1
UNION ALL SELECT 'late', 1 + count(*) FROM av_flagged WHERE CAST({READ_TIME} AS DATE) = DATE '{late_day}'
UNION ALL SELECT 'rejected', count(*) FROM ({RAW_AVAILABILITY}) WHERE bikes_available = '7'""")


# --------------------------------------------------------------------------- features, SQL
def round6(x: str) -> str:
    return f"CAST(round(TRY_CAST({x} AS DECIMAL(38,10)), 6) AS DOUBLE)"


FEATURES = ("features", f"""
SELECT h.station_id, h.hour, CAST(hour(h.hour) AS INTEGER) AS hour_of_day,
  CAST(isodow(h.hour) AS INTEGER) AS day_of_week_num, isodow(h.hour) >= 6 AS is_weekend,
  w.temperature_c, w.rain_mm, w.weather_condition, h.occupancy_pct, h.n_readings,
  lag(h.occupancy_pct) OVER (PARTITION BY h.station_id ORDER BY h.hour) AS lag_1,
  {round6("avg(h.occupancy_pct) OVER (PARTITION BY h.station_id ORDER BY h.hour ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)")} AS moving_avg_3
FROM (SELECT station_id, hr AS hour, {round2('avg(occ)')} AS occupancy_pct, count(*) AS n_readings
      FROM (SELECT station_id, date_trunc('hour', {READ_TIME}) AS hr,
                   {pct('bikes_available', 'bikes_available + slots_free')} AS occ FROM joined)
      WHERE hr IS NOT NULL GROUP BY station_id, hr) h
LEFT JOIN (SELECT wh, weather_condition, temperature_c, rain_mm FROM (
             SELECT {READ_TIME} AS wh, weather_condition, temperature_c, rain_mm,
               row_number() OVER (PARTITION BY {READ_TIME} ORDER BY weather_condition NULLS FIRST,
                 temperature_c NULLS FIRST, rain_mm NULLS FIRST) AS rn FROM weather_silver)
           WHERE rn = 1 AND wh IS NOT NULL) w ON h.hour = w.wh""")


X = ("hour_of_day", "is_weekend", "temperature_c", "rain_mm", "lag_1", "moving_avg_3")


def regression_sql(name: str) -> str:
    """The linear regression from its normal equations: centred products of the training rows,
    then one elimination step a feature, each a CTE over the 6 x 7 system."""
    k = len(X)
    usable = ("usable", "SELECT station_id, hour, CAST(hour AS DATE) AS day, lag_1, moving_avg_3, occupancy_pct AS y, "
              + ", ".join(f"CAST({x} AS DOUBLE) AS x{i}" for i, x in enumerate(X))
              + " FROM features WHERE occupancy_pct IS NOT NULL AND " + " AND ".join(f"{x} IS NOT NULL" for x in X))
    train = ("train", "SELECT * FROM usable WHERE day < (SELECT max(day) FROM usable)")
    means = ("means", "SELECT avg(y) AS my, " + ", ".join(f"avg(x{i}) AS m{i}" for i in range(k)) + " FROM train")
    side = lambda j: "(y - my)" if j == k else f"(x{j} - m{j})"
    steps = [("e0", "SELECT " + ", ".join(f"sum((x{i} - m{i}) * {side(j)}) AS a{i}_{j}" for i in range(k)
                                          for j in range(k + 1)) + " FROM train, means")]
    for p in range(k):
        cells = [f"a{p}_{j} / a{p}_{p} AS a{p}_{j}" if i == p else f"a{i}_{j} - a{i}_{p} * a{p}_{j} / a{p}_{p} AS a{i}_{j}"
                 for i in range(k) for j in range(k + 1)]
        steps.append((f"e{p + 1}", f"SELECT {', '.join(cells)} FROM e{p}"))
    fit = ("scored", "SELECT station_id, hour, y, lag_1, moving_avg_3, my + "
           + " + ".join(f"a{i}_{k} * (x{i} - m{i})" for i in range(k))
           + f" AS p FROM usable, means, e{k} WHERE day >= (SELECT max(day) FROM usable)")
    if name == "predictions":
        final = ("SELECT station_id, hour, y AS occupancy_pct, lag_1, moving_avg_3, round(p, 3) AS predicted_occupancy_pct "
                 "FROM scored")
    else:
        final = " UNION ALL ".join(
            f"SELECT '{m}' AS model, count(*) AS n, {round6(f'avg(abs({c} - y))')} AS mae, "
            f"{round6(f'sqrt(avg(({c} - y) * ({c} - y)))')} AS rmse FROM scored"
            for m, c in (("linear_regression", "p"), ("persistence", "lag_1"), ("moving_average_3", "moving_avg_3")))
    return with_ctes(gold_parts(), FEATURES, usable, train, means, *steps, fit, final=final)


def feature_sql(name: str) -> str:
    g = gold_parts()
    if name == "features_hourly":
        return with_ctes(g, FEATURES, final="SELECT * FROM features")
    if name == "baseline_errors":
        final = f"""
SELECT baseline, count(*) AS n, {round6('avg(abs(pred - actual))')} AS mae,
       {round6('sqrt(avg((pred - actual) * (pred - actual)))')} AS rmse
FROM (SELECT 'persistence' AS baseline, lag_1 AS pred, occupancy_pct AS actual FROM features
      UNION ALL SELECT 'moving_average_3', moving_avg_3, occupancy_pct FROM features)
WHERE pred IS NOT NULL AND actual IS NOT NULL GROUP BY baseline"""
        return with_ctes(g, FEATURES, final=final)
    if name in ("predictions", "model_errors"):
        return regression_sql(name)
    facts = [FACT_OCCUPANCY, FACT_DOMINANT]
    if name == "sql_station_ranking":
        final = f"""SELECT station_key, count(*) AS n_readings, {round2('avg(occupancy_pct)')} AS avg_occupancy_pct
FROM fact_occupancy WHERE station_key IS NOT NULL GROUP BY station_key"""
    elif name == "sql_weather_impact":
        final = f"""SELECT w.weather_condition, count(DISTINCT o.date_key) AS n_days, count(*) AS n_readings,
  {round2('avg(o.occupancy_pct)')} AS avg_occupancy_pct
FROM fact_occupancy o JOIN fact_dominant d ON o.date_key = d.date_key
JOIN dim_weather w ON d.weather_condition_key = w.weather_condition_key GROUP BY w.weather_condition"""
    elif name == "sql_hourly_profile":
        final = f"""SELECT CAST(o.time_key // 60 AS INTEGER) AS hour_of_day, d.is_weekend, count(*) AS n_readings,
  {round2('avg(o.occupancy_pct)')} AS avg_occupancy_pct
FROM fact_occupancy o JOIN dim_date d ON o.date_key = d.date_key
WHERE o.time_key IS NOT NULL GROUP BY CAST(o.time_key // 60 AS INTEGER), d.is_weekend"""
    else:
        raise KeyError(name)
    return with_ctes(g, *facts, final=final)
