"""The same results in SQL, written from the definitions and not from the Spark code.

Each text is self-contained: shared parts are prefixed as common table expressions.
"""

from __future__ import annotations

from envgrade.config import CITIES, REGIONS, TEMPERATURE_NORMALS, VEGETATION_REFERENCE

W = 360


def _bucket(minutes: int, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{minutes} minutes', {ts}, TIMESTAMP '1970-01-01 00:00:00')"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


NORMALS = _values((r, m, v) for r, t in TEMPERATURE_NORMALS.items() for m, v in enumerate(t, 1))
VEGETATION = _values((r, m, v) for r, t in VEGETATION_REFERENCE.items() for m, v in enumerate(t, 1))
POINTS = _values(
    (REGIONS[i // 3], f"C{i:02d}", c.latitude, c.longitude)
    for i, c in enumerate(c for r in REGIONS for c in CITIES[r])
)

REGION_CASE = "CASE WHEN {ci} < 3 THEN 'EUR' WHEN {ci} < 6 THEN 'NAM' WHEN {ci} < 9 THEN 'AFR' ELSE 'ASI' END"
CITY_EXPR = "'C' || lpad(CAST({ci} AS VARCHAR), 2, '0')"


def _place(ci: str) -> str:
    return f"{REGION_CASE.format(ci=ci)} AS region, {CITY_EXPR.format(ci=ci)} AS city"


BASE = f"""
base AS (
  SELECT event_id, ts, user_id, event_type AS action, value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k, {_place('(user_id % 12)')}
  FROM events),
ev AS (
  SELECT *, CASE WHEN action = 'purchase' THEN 'satellite'
                 WHEN action IN ('error', 'signup') AND region <> 'AFR' THEN 'station'
                 ELSE 'weather' END AS kind
  FROM base),
st AS (
  SELECT event_id, date_trunc('hour', ts) AS ts, region, city, 'S' || CAST(user_id AS VARCHAR) AS station_id,
         value - 5e0 AS pm, 1 + CAST(k AS BIGINT) % 4 AS samples,
         CASE WHEN CAST(k AS BIGINT) % 4 = 0 THEN 'PROVIDER_HOURLY' ELSE 'COMPUTED_MEAN' END AS construction
  FROM ev WHERE kind = 'station'),
sat AS (SELECT event_id, ts, region, city, value AS pm, k FROM ev WHERE kind = 'satellite')"""


def _index(minutes: int, source: str = "ev", prefix: str = "") -> str:
    p = prefix
    return f"""
normals(region, month, normal_c) AS (VALUES {NORMALS}),
{p}agg AS (
  SELECT region, {_bucket(minutes)} AS window_start,
         count(*) FILTER (kind = 'weather') AS n_weather,
         count(*) FILTER (kind = 'satellite') AS n_satellite,
         avg(value / 10e0) FILTER (kind = 'weather') AS mean_temperature_c,
         avg(k / 4e0) FILTER (kind = 'weather') AS mean_rainfall_mm,
         avg((k - 50e0) / 50e0) FILTER (kind = 'satellite') AS mean_vegetation,
         avg(value / 50e0) FILTER (kind = 'satellite') AS mean_aerosol,
         avg(k) FILTER (kind = 'satellite') AS mean_cloud_pct,
         avg(value) FILTER (kind = 'satellite') AS model_pm25_ugm3
  FROM {source} WHERE kind <> 'station' GROUP BY 1, 2),
{p}parts AS (
  SELECT a.*, window_start + INTERVAL '{minutes} minutes' AS window_end, CAST(n.normal_c AS DOUBLE) AS normal_c,
         coalesce(mean_temperature_c - CAST(n.normal_c AS DOUBLE), 0e0) AS temperature_anomaly,
         CASE WHEN n_weather > 0 AND n_satellite > 0
              THEN (greatest(0e0, least(1e0, 1e0 - mean_rainfall_mm / 20e0)) + (1e0 - mean_vegetation) / 2e0) / 2e0
              WHEN n_weather > 0 THEN greatest(0e0, least(1e0, 1e0 - mean_rainfall_mm / 20e0))
              ELSE (1e0 - mean_vegetation) / 2e0 END AS dryness_index,
         CASE WHEN n_satellite > 0
              THEN (greatest(0e0, least(1e0, mean_aerosol / 2e0)) + mean_cloud_pct / 100e0) / 2e0
              ELSE 0e0 END AS pollution_index,
         CASE WHEN n_weather + n_satellite < 2 THEN 'AMBIGUOUS'
              WHEN n_weather > 0 AND n_satellite > 0 THEN 'MEASURED' ELSE 'INFERRED' END AS confidence
  FROM {p}agg a JOIN normals n ON a.region = n.region AND n.month = month(a.window_start)),
{p}rec AS (
  SELECT *, greatest(0e0, least(100e0, 100e0 * (0.4e0 * greatest(0e0, least(1e0, temperature_anomaly / 10e0))
         + 0.3e0 * dryness_index + 0.3e0 * pollution_index))) AS impact_index
  FROM {p}parts)"""


TOLERANCE = "2e0 * 0.36e0 * sqrt(0.75e0 * ({o}) * ({o}) + 156.25e0)"


def _cw(minutes: int) -> str:
    return f"""
sv AS (SELECT region, city, {_bucket(minutes)} AS window_start, median(pm) AS o, count(*) AS n,
              count(DISTINCT station_id) AS distinct_n,
              CASE WHEN min(construction) = max(construction) THEN min(construction) ELSE 'MIXED' END AS construction
       FROM st GROUP BY 1, 2, 3),
mv AS (SELECT region, city, {_bucket(minutes)} AS window_start, avg(pm) AS m FROM sat GROUP BY 1, 2, 3),
cw0 AS (SELECT coalesce(sv.region, mv.region) AS region, coalesce(sv.city, mv.city) AS city,
               coalesce(sv.window_start, mv.window_start) AS window_start, o, m, coalesce(n, 0) AS n, construction
        FROM sv FULL OUTER JOIN mv
          ON sv.region = mv.region AND sv.city = mv.city AND sv.window_start = mv.window_start),
cw AS (SELECT *, window_start + INTERVAL '{minutes} minutes' AS window_end,
              CASE WHEN n >= 3 AND o IS NOT NULL AND m IS NOT NULL THEN {TOLERANCE.format(o='o')} END AS tol,
              CASE WHEN n < 3 OR o IS NULL OR m IS NULL THEN 'NOT_COMPARED'
                   WHEN abs(o - m) > {TOLERANCE.format(o='o')} THEN 'DISAGREED' ELSE 'AGREED' END AS state
       FROM cw0),
roll AS (SELECT region, window_start, window_end,
                count(*) FILTER (state = 'DISAGREED') AS flagged, count(*) FILTER (state <> 'NOT_COMPARED') AS covered,
                count(*) AS cities,
                string_agg(city || ':' || state || ':' || n, ';' ORDER BY city) AS detail,
                string_agg(city, ',' ORDER BY city) AS names
         FROM cw GROUP BY 1, 2, 3)"""


ROLL_STATE = """CASE WHEN flagged > 0 THEN 'DISAGREED' WHEN covered > 0 THEN 'AGREED' ELSE 'NOT_COMPARED' END"""
ROLL_TIER = "CASE WHEN covered > 0 THEN 'STATION_CHECKED' ELSE 'UNCHECKED' END"


def _done(rec: str = "rec") -> str:
    """Reconciled records and the compared city-windows."""
    return f"""
done AS (SELECT r.*, coalesce(flagged, 0) AS flagged, coalesce(covered, 0) AS covered, coalesce(cities, 0) AS cities,
                {ROLL_STATE.replace('flagged', 'coalesce(flagged, 0)').replace('covered', 'coalesce(covered, 0)')} AS pm25_disagreement,
                {ROLL_TIER.replace('covered >', 'coalesce(covered, 0) >')} AS provenance_tier
         FROM {rec} r LEFT JOIN roll USING (region, window_start)),
cc AS (SELECT cw.* FROM cw SEMI JOIN {rec} USING (region, window_start)),
cov AS (SELECT *, abs(o - m) AS diff FROM cc WHERE state <> 'NOT_COMPARED')"""


MESSAGES = """
msg AS (
  SELECT *, CASE WHEN event_id % 113 = 0 THEN 'unknown' WHEN event_id % 107 = 0 THEN 'radar' ELSE kind END AS claimed_type,
         CASE WHEN event_id % 113 = 0 OR event_id % 127 = 0 THEN 'parse'
              WHEN event_id % 137 = 0 OR event_id % 107 = 0 THEN 'schema'
              WHEN event_id % 97 = 0 THEN 'range'
              WHEN event_id % 101 = 0 THEN 'parse'
              WHEN event_id % 103 = 0 OR event_id % 109 = 0 OR event_id % 131 = 0 THEN 'schema' END AS reason_code
  FROM ev),
ok AS (SELECT * FROM msg WHERE reason_code IS NULL)"""

HOURS = """
hr AS (
  SELECT event_id, user_id, 'S' || CAST(user_id AS VARCHAR) AS station_id, region, city, value - 5e0 AS v, k,
         date_trunc('hour', ts) + CASE WHEN event_id % 17 = 0 THEN INTERVAL '30 minutes' ELSE INTERVAL '0 minutes' END AS starts,
         CASE WHEN event_id % 31 = 0 THEN 90 ELSE 60 END AS len,
         CASE WHEN event_id % 29 = 0 THEN 0 ELSE 1 + CAST(k AS BIGINT) % 4 END AS observed
  FROM base),
gh AS (
  SELECT *, CASE WHEN event_id % 37 = 0 THEN 'malformed' WHEN event_id % 23 = 0 THEN 'null_value'
                 WHEN event_id % 31 = 0 THEN 'period_not_one_hour_long' WHEN event_id % 17 = 0 THEN 'period_not_hour_aligned'
                 WHEN event_id % 19 = 0 THEN 'has_flags_true' WHEN event_id % 29 = 0 THEN 'observed_count_below_one'
                 ELSE 'retained' END AS reason,
         CASE WHEN observed = 1 THEN 'PROVIDER_HOURLY' ELSE 'COMPUTED_MEAN' END AS construction
  FROM hr),
kept AS (SELECT * FROM gh WHERE reason = 'retained')"""

HOURLY = """
hv AS (SELECT region, city, date_trunc('hour', ts) AS hour, avg(value) AS mv, avg(k) AS mk,
              CAST(floor(epoch(date_trunc('hour', ts)) / 3600) AS BIGINT) AS hn
       FROM base GROUP BY 1, 2, 3)"""

HISTORY = f"""{HOURLY},
veg(region, month, vegetation_index) AS (VALUES {VEGETATION}),
slots AS (
  SELECT region, city, hour, strftime(hour, '%Y-%m-%dT%H:%M') AS slot, mv,
         CASE WHEN hn % 13 = 0 THEN 'missing_field' WHEN hn % 17 = 0 THEN 'out_of_range' ELSE 'reading' END AS w,
         CASE WHEN hn % 13 = 0 THEN NULL
              WHEN hn % 5 = 0 OR hn % 7 = 0 OR day(hour) = 9 THEN 'missing_field' ELSE 'reading' END AS s
  FROM hv WHERE hour <= TIMESTAMP '2024-01-25 00:00:00'),
hist AS (
  SELECT 'weather' AS stream, region, city, slot, w AS status,
         CASE WHEN w = 'reading' THEN mv / 10e0 END AS value, CAST(NULL AS DOUBLE) AS vegetation FROM slots
  UNION ALL
  SELECT 'satellite', slots.region, city, slot, s, CASE WHEN s = 'reading' THEN mv END,
         CASE WHEN s = 'reading' THEN CAST(vegetation_index AS DOUBLE) END
  FROM slots JOIN veg ON veg.region = slots.region AND veg.month = month(hour) WHERE s IS NOT NULL)"""

PLACES = f"""
cust AS (SELECT c_custkey AS location_id, {_place('(c_custkey % 12)')},
                c_mktsegment = 'BUILDING' AS is_mobile, c_mktsegment <> 'MACHINERY' AS is_monitor,
                c_nationkey, c_acctbal FROM customer),
sens AS (SELECT o_orderkey AS sensor_id, o_custkey AS location_id,
                o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS pm25, o_orderkey % 50 = 0 AS odd,
                o_orderdate <= TIMESTAMP '1997-03-01' AND
                o_orderdate + to_days(CAST(floor(o_totalprice / 200e0) AS INTEGER)) >= TIMESTAMP '1997-05-01' AS covers
         FROM orders),
resolved AS (
  SELECT location_id, city, coalesce(candidates, 0) AS candidates, coalesce(covering, 0) AS covering,
         coalesce(fault, false) AS identity_fault,
         CASE WHEN candidates IS NULL THEN 'no_pm25_sensor' WHEN fault OR covering = 0 THEN 'none_covering_window'
              WHEN covering > 1 THEN 'ambiguous_multiple_covering' ELSE 'resolved' END AS kind, only_id
  FROM cust LEFT JOIN (SELECT location_id, count(*) AS candidates, count(*) FILTER (covers) AS covering,
                              bool_or(odd) AS fault, max(sensor_id) FILTER (covers) AS only_id
                       FROM sens WHERE pm25 GROUP BY 1) USING (location_id))"""

RADIUS = f"""
pts(region, city, lat, lon) AS (VALUES {POINTS}),
dom AS (SELECT region, city, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon,
               CASE WHEN city IN ('C00', 'C01', 'C02', 'C08') THEN 0.1e0 ELSE 0.4e0 END AS step FROM pts),
grid AS (SELECT region, city, step, floor(lat / step) * step AS glat, floor(lon / step) * step AS glon FROM dom),
reach AS (SELECT *, CAST(floor(least(25000e0, 500e0 * sqrt(pow(step * 111.32e0, 2) +
                 pow(step * 111.32e0 * cos(radians(glat)), 2)))) AS BIGINT) AS radius_m FROM grid),
loc AS (SELECT location_id, is_mobile, is_monitor, glat + (c_nationkey - 12e0) * 0.02e0 AS la,
               glon + (c_acctbal - 4500e0) / 20000e0 AS lo FROM cust JOIN reach USING (city)),
near AS (SELECT location_id, is_mobile, is_monitor, reach.region, reach.city, radius_m, 12742000e0 * asin(sqrt(
            pow(sin(radians(glat - la) / 2e0), 2) +
            cos(radians(la)) * cos(radians(glat)) * pow(sin(radians(glon - lo) / 2e0), 2))) AS dist
         FROM loc, reach),
inr AS (SELECT * FROM near WHERE dist <= radius_m),
pm AS (SELECT location_id, bool_or(covers) AS any_c, arg_min(covers, sensor_id) AS first_c FROM sens WHERE pm25 GROUP BY 1),
judged AS (SELECT inr.*, NOT is_mobile AS fixed, NOT is_mobile AND is_monitor AS graded,
                  NOT is_mobile AND is_monitor AND any_c IS NOT NULL AS measured,
                  NOT is_mobile AND is_monitor AND coalesce(any_c, false) AS admitted,
                  NOT is_mobile AND is_monitor AND coalesce(first_c, false) AS by_first
           FROM inr LEFT JOIN pm USING (location_id))"""


def r(expr: str, name: str | None = None) -> str:
    return f"round({expr}, 10) AS {name or expr.split('.')[-1]}"


INDEX_OUT = (
    "region, window_start, window_end, " + ", ".join(
        r(c) for c in ("impact_index", "temperature_anomaly", "dryness_index", "pollution_index")
    ) + ", confidence, " + r("model_pm25_ugm3")
)
PLAIN = INDEX_OUT + (
    ", 'NOT_COMPARED' AS pm25_disagreement, 'UNCHECKED' AS provenance_tier, "
    "CAST(0 AS BIGINT) AS flagged_city_count, CAST(0 AS BIGINT) AS covered_city_count"
)
RECONCILED = INDEX_OUT + (
    ", pm25_disagreement, provenance_tier, flagged AS flagged_city_count, covered AS covered_city_count, cities"
)


def sql(ctes: str | list[str], body: str) -> str:
    parts = [ctes] if isinstance(ctes, str) else ctes
    return "WITH " + ",".join(p.strip().rstrip(",") + "\n" for p in parts if p) + body


I360 = [BASE, _index(W)]
CW = [BASE, _cw(W)]
# The same from accepted messages only.
BASE_OK = BASE.replace("st AS (", MESSAGES.strip() + ",\nst AS (", 1).replace("FROM ev WHERE kind", "FROM ok WHERE kind")
OK360 = [BASE_OK, _index(W, "ok")]
OK_ALL = [BASE_OK, _index(W, "ok"), _cw(W), _done()]
ALL = [BASE, _index(W), _cw(W), _done()]
GRID = [PLACES, RADIUS]


def _median(x: str, name: str) -> str:
    return r(f"median({x})", name)


def _arm(dim: str, arms: list[str], rows: str = "cov") -> str:
    listed = ", ".join(f"('{a}')" for a in [*arms, "pooled"])
    return f"""SELECT arm, coalesce(covered, 0) AS covered, coalesce(flagged, 0) AS flagged,
      round(CASE WHEN covered > 0 THEN CAST(flagged AS DOUBLE) / covered END, 10) AS flag_rate, coalesce(covered, 0) = 0 AS empty
    FROM (VALUES {listed}) a(arm) FULL OUTER JOIN (
      SELECT {dim} AS arm, count(*) AS covered, count(*) FILTER (state = 'DISAGREED') AS flagged FROM {rows} GROUP BY 1
      UNION ALL SELECT 'pooled', count(*), count(*) FILTER (state = 'DISAGREED') FROM {rows}) x USING (arm)"""


DOMAIN = "CASE WHEN city IN ('C00', 'C01', 'C02', 'C08') THEN 'europe' ELSE 'global' END"
SCALAR = "SELECT event_id, {0} FROM events"
BIAS = """bias AS (SELECT city, count(*) AS covered, count(*) FILTER (state = 'DISAGREED') AS flagged,
   median(o) AS sm, median(m) AS mm, median(tol) AS tm FROM cov GROUP BY 1)"""
_JUDGED_TS = "CASE WHEN reason_code IS NULL THEN {ts} END AS ts"


def _payload(kind: str, columns: str, ts: str = "ts") -> str:
    return sql([BASE, MESSAGES], f"SELECT event_id, reason_code, CASE WHEN reason_code IS NULL THEN {ts} END AS ts, {columns} FROM msg WHERE claimed_type = '{kind}'")


def _ok(expr: str, name: str) -> str:
    return f"round(CASE WHEN reason_code IS NULL THEN {expr} END, 10) AS {name}"


GATE_TALLY_COLUMNS = ("malformed", "null_value", "period_not_one_hour_long", "period_not_hour_aligned", "has_flags_true", "observed_count_below_one")
TALLY = "count(*) AS returned, count(*) FILTER (reason = 'retained') AS retained, " + ", ".join(
    f"count(*) FILTER (reason = '{c}') AS {c}" for c in GATE_TALLY_COLUMNS
)
RESOLUTION = "count(*) AS locations_admitted, count(*) FILTER (kind = 'resolved') AS resolved, count(*) FILTER (kind <> 'resolved') AS refused, " + ", ".join(
    f"count(*) FILTER (kind = '{c}') AS {c}" for c in ("no_pm25_sensor", "none_covering_window", "ambiguous_multiple_covering")
)
GUARD = "SELECT '{0}' AS guard, count(*) AS checked, CAST(0 AS BIGINT) AS violations, {1} AS passed FROM {2}"
INDEX_GUARD = "(SELECT region, window_start FROM rec GROUP BY 1, 2)"


def _unpivot(section: str, source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}', '{c}', CAST({c} AS BIGINT), NULL FROM {source}" for c in columns
    )


ORACLE: dict[str, str] = {
    # sources
    "s_01_read_envelopes": sql(BASE, "SELECT region AS key, count(*) AS n FROM ev GROUP BY 1"),
    "s_02_explode_station_hours": sql([BASE, HOURS], """SELECT user_id AS location_id, station_id, city, region,
        CASE WHEN event_id % 37 = 0 OR event_id % 23 = 0 THEN NULL ELSE round(v, 10) END AS value,
        CASE WHEN event_id % 37 = 0 THEN NULL ELSE starts END AS starts,
        CASE WHEN event_id % 37 = 0 THEN NULL ELSE starts + to_minutes(len) END AS ends,
        event_id % 19 = 0 AND event_id % 37 <> 0 AS flagged,
        CASE WHEN event_id % 37 = 0 THEN NULL ELSE observed END AS observed FROM gh"""),
    "s_03_explode_model_hours": sql([BASE, HOURLY], """SELECT region, city, hour AS ts, round(mv, 10) AS model_pm25_ugm3 FROM hv
        WHERE hn % 13 <> 0 AND hour < TIMESTAMP '2024-01-16'"""),
    "s_04_weather_air_history": sql([BASE, HISTORY], "SELECT stream, region, city, slot, status, round(value, 10) AS value, round(vegetation, 10) AS vegetation FROM hist"),
    "s_05_flatten_current": sql(BASE, """SELECT 'weather' AS stream, region, 'U' || user_id AS city, date_trunc('minute', max(ts)) AS ts,
          round(arg_max(value, (ts, event_id)) / 10e0, 10) AS v1, round(arg_max(k, (ts, event_id)) / 4e0, 10) AS v2
        FROM base WHERE action <> 'purchase' GROUP BY region, user_id
        UNION ALL SELECT 'satellite', a.region, 'U' || a.user_id, date_trunc('minute', a.t), round(a.v, 10), w.k
        FROM (SELECT region, user_id, max(ts) AS t, arg_max(value, (ts, event_id)) AS v FROM base WHERE action = 'purchase' GROUP BY 1, 2) a
        JOIN (SELECT region, user_id, arg_max(k, (ts, event_id)) AS k FROM base WHERE action <> 'purchase' GROUP BY 1, 2) w
          ON a.user_id = w.user_id WHERE CAST(w.k AS BIGINT) % 5 <> 0"""),
    "s_06_read_capture": sql(BASE, """SELECT ts, region, city, station_id, round(pm, 10) AS value, construction FROM st WHERE ts < TIMESTAMP '2024-01-16'
        UNION ALL SELECT ts, region, city, NULL, round(pm, 10), NULL FROM sat WHERE ts < TIMESTAMP '2024-01-16'"""),
    "s_07_read_admission": sql(PLACES, f"SELECT '2024-03-01' AS version, city, region, {DOMAIN} AS domain, location_id, CAST(location_id AS VARCHAR) AS station_id FROM cust WHERE location_id % 3 <> 0"),
    "s_08_union_sources": sql(BASE, """SELECT 'stations' AS source, city, count(*) AS n, count(*) AS station_values, CAST(0 AS BIGINT) AS model_values, CAST(NULL AS VARCHAR) AS fault FROM st GROUP BY 2
        UNION ALL SELECT 'models', city, count(*), 0, count(*), NULL FROM sat GROUP BY 2
        UNION ALL SELECT 'absent', NULL, 0, NULL, NULL, 'AnalysisException'"""),
    "s_08_land_sources": sql(BASE, """SELECT 'stations' AS source, city, count(*) AS n, count(*) AS station_values, CAST(0 AS BIGINT) AS model_values FROM st GROUP BY 2
        UNION ALL SELECT 'models', city, count(*), 0, count(*) FROM sat GROUP BY 2
        UNION ALL SELECT 'refused', NULL, 0, NULL, NULL"""),
    "s_09_wrap_envelopes": sql(BASE, """SELECT event_id, region AS key, kind AS event_type,
        strftime(CASE WHEN kind = 'station' THEN date_trunc('hour', ts) ELSE ts END, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_text,
        round(CASE kind WHEN 'weather' THEN value / 10e0 WHEN 'satellite' THEN value ELSE value - 5e0 END, 10) AS main_value,
        CAST(CASE kind WHEN 'weather' THEN 5 ELSE 7 END AS BIGINT) AS fields FROM ev"""),
    # tables
    "k_01_upsert_records": sql(I360, """SELECT CAST(2 AS BIGINT) AS batch_id, region, count(*) AS n FROM rec GROUP BY region
        UNION ALL SELECT 1, region, count(*) FROM (SELECT DISTINCT region, window_start FROM rec) x
          WHERE EXISTS (SELECT 1 FROM ev WHERE ev.region = x.region AND kind <> 'station' AND ts < TIMESTAMP '2024-01-16'
                        AND ts >= x.window_start AND ts < x.window_start + INTERVAL '360 minutes') GROUP BY region"""),
    "k_02_append_raw": sql([BASE, MESSAGES], "SELECT kind AS event_type, region, strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n FROM ok GROUP BY 1, 2, 3"),
    "k_03_fan_out": sql(I360, """SELECT copy, region, count(*) AS n, round(avg(impact_index), 10) AS mean_index
        FROM rec, (VALUES ('durable'), ('serving')) c(copy) GROUP BY 1, 2"""),
    "k_04_current_records": sql(I360, f"SELECT {PLAIN}, CAST(2 AS BIGINT) AS batch_id FROM rec"),
    "k_04_compact_records": sql(I360, f"SELECT {PLAIN}, CAST(2 AS BIGINT) AS batch_id FROM rec"),
    "k_05_region_series": sql(I360, f"SELECT {PLAIN} FROM rec WHERE region = 'NAM'"),
    "k_06_legacy_states": sql(I360, "SELECT " + PLAIN.replace("round(model_pm25_ugm3, 10) AS", "CAST(NULL AS DOUBLE) AS") + ", CAST(0 AS BIGINT) AS details FROM rec"),
    "k_07_write_quarantine": sql([BASE, MESSAGES], "SELECT claimed_type AS event_type, reason_code, count(*) AS n, count(*) AS with_raw FROM msg WHERE reason_code IS NOT NULL GROUP BY 1, 2"),
    "k_08_verify_snapshot": sql(I360, "SELECT count(*) AS n_rows, count(*) AS n_keys, max(window_start) AS newest_window_start, '' AS missing_regions FROM rec"),
    "k_08_publish_snapshot": sql(I360, "SELECT region, count(*) AS n, round(avg(impact_index), 10) AS mean_index, '2' AS version FROM rec GROUP BY 1"),
    "k_09_capture_report": sql([BASE, HOURS, PLACES], f""", tally AS (SELECT {TALLY} FROM gh), res AS (SELECT {RESOLUTION} FROM resolved),
        bounds AS (SELECT 'station' AS side, count(*) AS n, strftime(min(starts), '%Y-%m-%d %H:%M') || '/' || strftime(max(starts), '%Y-%m-%d %H:%M') AS span FROM kept
                   UNION ALL SELECT 'model', count(*), strftime(min(ts), '%Y-%m-%d %H:%M') || '/' || strftime(max(ts), '%Y-%m-%d %H:%M') FROM sat),
        cities AS (SELECT city, count(*) FILTER (s = 1) AS a, count(*) FILTER (s = 0) AS b
                   FROM (SELECT city, 1 AS s FROM kept UNION ALL SELECT city, 0 FROM sat) GROUP BY 1)
        SELECT 'window_requested' AS section, 'month' AS name, CAST(NULL AS BIGINT) AS n, side AS text FROM bounds
        UNION ALL SELECT 'observed_bounds', side, n, span FROM bounds
        UNION ALL SELECT 'station_rows', city, a, NULL FROM cities UNION ALL SELECT 'model_rows', city, b, NULL FROM cities
        UNION ALL {_unpivot('validity_gate', 'tally', ['returned', 'retained', *GATE_TALLY_COLUMNS])}
        UNION ALL {_unpivot('sensor_resolution', 'res', ['locations_admitted', 'resolved', 'refused', 'no_pm25_sensor', 'none_covering_window', 'ambiguous_multiple_covering'])}
        UNION ALL SELECT 'off_hour_by_city', city, count(*), NULL FROM gh WHERE reason LIKE 'period_%' GROUP BY city""").replace("\n, tally", ", tally"),
    "k_10_capture_run": sql([BASE, HOURS], """, sound AS (SELECT *, event_id % 37 <> 0 AND ((event_id % 41 = 0 AND observed <> 2) OR (observed = 1 AND event_id % 43 = 0)) AS conflict FROM gh),
        once AS (SELECT station_id, starts FROM kept GROUP BY 1, 2 HAVING count(*) = 1),
        n AS (SELECT count(*) AS n FROM sound SEMI JOIN once USING (station_id, starts) WHERE reason = 'retained' AND NOT conflict),
        rows("window", outcome, fault) AS (VALUES ('month', 'void', 'CaptureFault'), ('month', 'kept', NULL), ('first_half', 'void', 'WindowViolation'))
        SELECT r."window", outcome, fault, CASE WHEN outcome = 'kept' THEN n.n ELSE 0 END AS station_rows,
          CASE WHEN outcome = 'kept' THEN (SELECT count(*) FROM sat) ELSE 0 END AS model_rows, n.n AS readable_rows FROM rows r, n""").replace("\n, sound", ", sound"),
    # gate
    "p_01_validate_envelopes": sql([BASE, MESSAGES], "SELECT event_id, claimed_type, reason_code FROM msg"),
    "p_02_validate_weather": _payload("weather", ", ".join([_ok("value / 10e0", "temperature_c"), _ok("k / 4e0", "rainfall_mm"), _ok("k / 10e0", "wind_speed_ms")])),
    "p_03_validate_satellite": _payload("satellite", ", ".join([_ok("k", "cloud_cover_pct"), _ok("(k - 50e0) / 50e0", "vegetation_index"), _ok("value / 50e0", "aerosol_index"), _ok("value", "model_pm25_ugm3")])),
    "p_04_validate_station": _payload(
        "station",
        "CASE WHEN reason_code IS NULL THEN 'S' || user_id END AS station_id, " + _ok("value - 5e0", "pm25_ugm3") +
        ", CASE WHEN reason_code IS NULL THEN 1 + CAST(k AS BIGINT) % 4 END AS sample_count"
        ", CASE WHEN reason_code IS NULL THEN CASE WHEN CAST(k AS BIGINT) % 4 = 0 THEN 'PROVIDER_HOURLY' ELSE 'COMPUTED_MEAN' END END AS construction",
        ts="date_trunc('hour', ts)",
    ),
    "p_05_classify_reason": SCALAR.format("CASE WHEN event_id % 5 = 0 THEN 'range' WHEN event_id % 3 = 0 THEN 'parse' WHEN event_id % 2 = 0 THEN 'schema' END AS reason_code"),
    "p_06_split_valid": sql([BASE, MESSAGES], "SELECT count(*) AS consumed, count(*) FILTER (reason_code IS NULL) AS forwarded, count(*) FILTER (reason_code IS NOT NULL) AS quarantined, CAST(0 AS BIGINT) AS region_mismatch FROM msg"),
    "p_07_parse_utc": SCALAR.format("""CASE WHEN event_id % 8 IN (0, 1, 4) THEN date_trunc('second', ts) END AS instant,
        CASE event_id % 8 WHEN 2 THEN 'schema' WHEN 3 THEN 'schema' WHEN 5 THEN 'schema' WHEN 6 THEN 'parse' WHEN 7 THEN 'schema' END AS reason_code"""),
    "p_08_parse_provider_time": SCALAR.format("CASE WHEN event_id % 6 <> 0 AND event_id % 7 <> 0 THEN date_trunc('minute', ts) END AS instant"),
    "p_09_region_is_configured": sql(BASE, "SELECT CASE WHEN event_id % 10 = 0 THEN 'ANT' ELSE region END AS region, event_id % 10 <> 0 AS configured, count(*) AS n FROM ev GROUP BY 1, 2"),
    "p_10_station_hour_gate": sql([BASE, HOURS], "SELECT user_id AS location_id, reason AS gate_reason, count(*) AS n FROM gh GROUP BY 1, 2"),
    "p_11_sample_count_conflict": sql([BASE, HOURS], """SELECT city, event_id % 37 <> 0 AND ((event_id % 41 = 0 AND observed <> 2) OR (observed = 1 AND event_id % 43 = 0)) AS conflict,
        count(*) AS n FROM gh GROUP BY 1, 2"""),
    "p_12_construction": sql([BASE, HOURS], "SELECT city, construction, count(*) AS n FROM kept GROUP BY 1, 2"),
    "p_13_settled_only": sql(BASE, "SELECT city, count(*) AS n, max(ts) AS newest FROM st WHERE ts <= TIMESTAMP '2024-01-18' GROUP BY 1"),
    "p_14_drop_future": sql(BASE, "SELECT city, count(*) AS n, max(ts) AS newest FROM sat WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY 1"),
    "p_15_in_named_window": sql(BASE, "SELECT city, count(*) AS n, min(ts) AS oldest FROM sat WHERE ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1"),
    "p_16_stray_report": sql(BASE, """SELECT count(*) AS n_rows, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS stray_rows,
        count(DISTINCT ts) FILTER (ts >= TIMESTAMP '2024-01-16') AS stray_timestamps, min(ts) FILTER (ts >= TIMESTAMP '2024-01-16') AS first_stray
        FROM (SELECT ts FROM st UNION ALL SELECT ts FROM sat)"""),
    "p_17_check_pm25_sensor": sql(PLACES, """SELECT CASE WHEN pm25 THEN 'pm25' ELSE 'o3' END AS parameter,
        CASE WHEN NOT pm25 THEN 'measures o3 in ppm' WHEN odd THEN 'measures pm25 in ppm' END AS rejection, count(*) AS n FROM sens GROUP BY 1, 2"""),
    "p_18_rejection_reason": sql([BASE, HISTORY], "SELECT stream, city, status AS reason, count(*) AS n FROM hist WHERE status <> 'reading' GROUP BY 1, 2, 3"),
    "p_19_reason_ledger": sql(BASE, """SELECT CASE WHEN action = 'purchase' THEN 'model' ELSE 'station' END AS source, action AS stream, city,
        CASE WHEN event_id % 13 = 0 THEN 'timeout' WHEN event_id % 11 = 0 THEN 'rate_limited' WHEN event_id % 7 = 0 THEN 'missing_field'
             WHEN event_id % 5 = 0 THEN 'no_hour' ELSE 'status' END AS reason, count(*) AS n FROM base GROUP BY 1, 2, 3, 4"""),
    # joins
    "j_01_monthly_normal": f"""WITH normals(region, month, normal_c) AS (VALUES {NORMALS}),
        daily AS (SELECT {_place('(o_custkey % 12)')}, o_orderdate AS date, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice / 10000e0 END AS value FROM orders)
        SELECT d.region, CAST(n.month AS BIGINT) AS month, CAST(normal_c AS DOUBLE) AS normal_c, count(*) AS n, round(avg(value - CAST(normal_c AS DOUBLE)), 10) AS mean_anomaly
        FROM daily d JOIN normals n ON d.region = n.region AND month(date) = n.month GROUP BY 1, 2, 3""",
    "j_02_vegetation_reference": f"""WITH veg(region, month, vegetation_index) AS (VALUES {VEGETATION}),
        daily AS (SELECT {_place('(o_custkey % 12)')}, o_orderdate AS date FROM orders)
        SELECT d.region, CAST(v.month AS BIGINT) AS month, CAST(vegetation_index AS DOUBLE) AS vegetation_index, count(*) AS n
        FROM daily d JOIN veg v ON d.region = v.region AND month(date) = v.month GROUP BY 1, 2, 3""",
    "j_03_weather_air_join": sql([BASE, HOURLY], """SELECT city, count(*) AS slots,
        count(*) FILTER (hn % 5 <> 0 AND hn % 7 <> 0 AND day(hour) <> 9) AS matched,
        round(avg(mv) FILTER (hn % 5 <> 0 AND hn % 7 <> 0 AND day(hour) <> 9), 10) AS mean_pm25 FROM hv GROUP BY 1"""),
    "j_04_event_to_record": sql([BASE], f"""SELECT s.region, s.window_start, count(*) AS n, count(*) FILTER (kind = 'station') AS stations
        FROM (SELECT DISTINCT region, {_bucket(W)} AS window_start FROM ev WHERE kind <> 'station') s
        JOIN (SELECT region, kind, CASE WHEN kind = 'station' THEN date_trunc('hour', ts) ELSE ts END AS ts FROM ev) e
          ON e.region = s.region AND e.ts >= s.window_start AND e.ts < s.window_start + INTERVAL '12 hours' GROUP BY 1, 2"""),
    "j_05_city_windows": sql(CW, f"SELECT region, city, window_start, window_end, {r('o', 'station_pm25_ugm3')}, {r('m', 'model_pm25_ugm3')}, {r('tol', 'tolerance')}, n AS station_count, state FROM cw"),
    "j_06_attach_reconciliation": sql(
        [BASE, "wev AS (SELECT * FROM ev WHERE kind = 'weather')", _index(60, "wev"), _cw(60), _done()],
        f"SELECT {RECONCILED} FROM done",
    ),
    "j_07_resolve_sensors": sql(PLACES, "SELECT location_id, city, kind, CASE WHEN kind = 'resolved' THEN only_id END AS pm25_sensor_id, candidates, covering, identity_fault FROM resolved"),
    "j_08_stations_in_radius": sql(GRID, "SELECT location_id, city, radius_m, round(dist, 3) AS distance_m FROM inr"),
    "j_09_cities_without_rows": sql([BASE, HOURS], f""", seen AS (SELECT city, reason FROM gh WHERE station_id IN (SELECT station_id FROM st))
        SELECT c.city, CASE WHEN count(s.city) > 0 THEN 'off_hour_periods' ELSE 'nothing_served' END AS cause, count(s.city) AS off_hour_rows
        FROM (SELECT DISTINCT {CITY_EXPR.format(ci='(c_custkey % 12)')} AS city FROM customer) c
        LEFT JOIN (SELECT city FROM seen WHERE reason LIKE 'period_%') s ON s.city = c.city
        WHERE c.city NOT IN (SELECT city FROM seen WHERE reason = 'retained') GROUP BY 1""").replace("\n, seen", ", seen"),
    "j_10_instrument_drift": sql([BASE, HOURS], """, a AS (SELECT DISTINCT station_id FROM kept WHERE day(starts) < 16), b AS (SELECT DISTINCT station_id FROM kept WHERE day(starts) >= 16)
        SELECT station_id, 'first' AS only_in FROM (FROM a EXCEPT FROM b) UNION ALL SELECT station_id, 'second' FROM (FROM b EXCEPT FROM a)""").replace("\n, a AS", ", a AS"),
    "j_11_revision_check": sql([BASE, HOURLY], "SELECT city, hn % 9 = 0 AS revised, count(*) AS n FROM hv GROUP BY 1, 2"),
    # index
    "a_01_compute_records": sql(I360, f"SELECT {PLAIN} FROM rec"),
    "a_02_temperature_anomaly": sql(I360, f"SELECT region, window_start, {r('mean_temperature_c')}, {r('normal_c')}, {r('temperature_anomaly')} FROM rec"),
    "a_03_dryness_index": sql(I360, f"SELECT region, window_start, {r('mean_rainfall_mm')}, {r('mean_vegetation')}, {r('dryness_index')} FROM rec"),
    "a_04_pollution_index": sql(I360, f"SELECT region, window_start, {r('mean_aerosol')}, {r('mean_cloud_pct')}, {r('pollution_index')} FROM rec"),
    "a_05_impact_index": sql(I360, f"SELECT region, window_start, {r('impact_index')} FROM rec"),
    "a_06_window_model_pm25": sql(I360, f"SELECT region, window_start, {r('model_pm25_ugm3')} FROM rec"),
    "a_07_grade_confidence": sql([BASE, _index(60)], "SELECT region, window_start, n_weather, n_satellite, confidence FROM rec"),
    "a_08_city_station_values": sql(CW, f"SELECT region, city, window_start, window_start + INTERVAL '{W} minutes' AS window_end, n AS station_count, {r('o', 'station_pm25_ugm3')}, distinct_n AS distinct_stations FROM sv"),
    "a_09_compare_city": sql(CW, "SELECT region, city, state, count(*) AS n, round(avg(tol), 10) AS mean_tolerance FROM cw GROUP BY 1, 2, 3"),
    "a_10_rollup_region": sql(CW, f"SELECT region, window_start, window_end, {ROLL_STATE} AS pm25_disagreement, {ROLL_TIER} AS provenance_tier, flagged AS flagged_city_count, covered AS covered_city_count, detail FROM roll"),
    "a_11_reconcile": sql(ALL, f"SELECT {RECONCILED} FROM done"),
    # reports
    "a_12_run_summary": sql(ALL, """SELECT count(*) AS region_windows, CAST(sum(covered) AS BIGINT) AS covered_city_windows, CAST(sum(flagged) AS BIGINT) AS flagged_city_windows,
        count(*) FILTER (pm25_disagreement = 'AGREED') AS agreed, count(*) FILTER (pm25_disagreement = 'DISAGREED') AS disagreed,
        count(*) FILTER (pm25_disagreement = 'NOT_COMPARED') AS not_compared,
        count(*) FILTER (provenance_tier = 'STATION_CHECKED') AS station_checked, count(*) FILTER (provenance_tier = 'UNCHECKED') AS unchecked FROM done"""),
    "a_13_per_city_breakdown": sql(ALL, "SELECT city, count(*) AS covered, count(*) FILTER (state = 'DISAGREED') AS flagged FROM cov GROUP BY 1"),
    "a_14_rates_by_domain": sql(ALL, _arm(DOMAIN, ["europe", "global"])),
    "a_14_rates_by_construction": sql(ALL, _arm("construction", ["PROVIDER_HOURLY", "COMPUTED_MEAN", "MIXED"])),
    "a_14_rates_by_region": sql(ALL, _arm("region", list(REGIONS))),
    "a_15_weaker_condition": sql(ALL, "SELECT count(*) AS covered, count(*) FILTER (diff <= tol / 2e0) AS within_u, count(*) FILTER (diff > tol / 2e0) AS outside_u FROM cov"),
    "a_16_covered_cross_check": sql(ALL, "SELECT (SELECT CAST(sum(covered) AS BIGINT) FROM done) AS by_scalar, (SELECT count(*) FROM cov) AS by_detail, (SELECT sum(covered) FROM done) = (SELECT count(*) FROM cov) AS ok"),
    "a_17_gate_tally": sql([BASE, HOURS], f"SELECT {TALLY} FROM gh"),
    "a_18_breakdown_checks": sql([BASE, HOURS, PLACES], """, t AS (SELECT count(*) AS returned, count(*) FILTER (reason = 'retained') AS retained, count(*) FILTER (reason LIKE 'period_%') AS off FROM gh),
        z AS (SELECT count(*) AS adm, count(*) FILTER (kind <> 'resolved') AS ref FROM resolved)
        SELECT c.check, c.total, c.parts, c.total = c.parts AS ok FROM (
        SELECT 'gate_sum' AS "check", returned AS total, returned AS parts FROM t UNION ALL SELECT 'off_hour_by_city', off, off FROM t
        UNION ALL SELECT 'off_hour_by_station', off, off FROM t UNION ALL SELECT 'off_hour_gate', off, off FROM t UNION ALL SELECT 'landed_rows', retained, retained FROM t
        UNION ALL SELECT 'resolution_sum', adm, adm FROM z UNION ALL SELECT 'refusals_by_kind', ref, ref FROM z) c""").replace("\n, t AS", ", t AS"),
    "a_19_observed_bounds": sql(BASE, "SELECT 'station' AS side, count(*) AS n_rows, min(ts) AS min_ts, max(ts) AS max_ts FROM st UNION ALL SELECT 'model', count(*), min(ts), max(ts) FROM sat"),
    "a_20_rows_per_city": sql(BASE, "SELECT city, count(*) FILTER (kind = 'station') AS station_rows, count(*) FILTER (kind = 'satellite') AS model_rows FROM ev WHERE kind <> 'weather' GROUP BY 1"),
    "a_21_off_hour_breakdown": sql([BASE, HOURS], """SELECT city, station_id, CAST(2 - grouping(city) - grouping(station_id) AS BIGINT) AS level,
        count(*) FILTER (reason = 'period_not_hour_aligned') AS not_aligned, count(*) FILTER (reason = 'period_not_one_hour_long') AS not_one_hour, count(*) AS n_rows
        FROM gh WHERE reason LIKE 'period_%' GROUP BY ROLLUP (city, station_id)"""),
    "a_22_resolution_summary": sql(PLACES, f"SELECT {RESOLUTION} FROM resolved"),
    "a_23_negative_profile": sql(BASE, """SELECT coalesce(city, 'pooled') AS arm, count(*) AS n_rows, count(*) FILTER (pm < 0) AS negatives,
        round(min(pm) FILTER (pm < 0), 10) AS min_negative, round(max(pm) FILTER (pm < 0), 10) AS max_negative,
        count(*) FILTER (pm >= -1 AND pm < 0) AS from_minus_1, count(*) FILTER (pm >= -5 AND pm < -1) AS from_minus_5,
        count(*) FILTER (pm >= -10 AND pm < -5) AS from_minus_10, count(*) FILTER (pm < -10) AS below_minus_10,
        round(CAST(count(*) FILTER (pm < 0) AS DOUBLE) / count(*), 10) AS share,
        round(median(pm) FILTER (pm < 0), 10) AS median_negative FROM st GROUP BY ROLLUP (city)"""),
    "a_24_bias_table": sql([*ALL, BIAS], f"""SELECT city, covered, flagged, {r('sm', 'station_median')}, {r('mm', 'model_median')}, {r('tm', 'tolerance_median')},
        round(CASE WHEN sm <> 0 THEN (mm - sm) / sm * 100e0 END, 10) AS model_bias_pct, round(CASE WHEN sm <> 0 THEN tm / sm END, 10) AS tolerance_over_station,
        round(CAST(flagged AS DOUBLE) / nullif(covered, 0), 10) AS flag_rate FROM bias"""),
    "a_25_difference_quartiles": sql(ALL, "SELECT city, count(*) AS n, " + ", ".join(
        [r(f"quantile_cont({x}, {p})", f"{name}_{q}") for x, name in (("diff", "diff"), ("tol", "tolerance")) for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("max", 1.0))]
        + [r("median(diff / tol)", "ratio_median"), r("max(diff / tol)", "ratio_max")]) + " FROM cov GROUP BY 1"),
    "a_26_zero_model_passes": sql([*ALL, BIAS], f"SELECT city, {r('sm', 'station_median')}, {r(TOLERANCE.format(o='sm'), 'tolerance_at_median')}, abs(sm) <= {TOLERANCE.format(o='sm')} AS zero_model_passes FROM bias"),
    "a_27_verdicts": sql(ALL, """SELECT covered, flagged, round(CAST(flagged AS DOUBLE) / nullif(covered, 0), 10) AS flag_rate,
        CASE WHEN covered < 200 THEN 'NOT_EVALUABLE' WHEN CAST(flagged AS DOUBLE) / covered > 0.01 AND CAST(flagged AS DOUBLE) / covered < 0.33 THEN 'DISCRIMINATES' ELSE 'UNINFORMATIVE' END AS discrimination,
        CASE WHEN flagged > 0 THEN 'EVALUABLE' ELSE 'NOT_EVALUABLE' END AS reporting
        FROM (SELECT count(*) AS covered, count(*) FILTER (state = 'DISAGREED') AS flagged FROM cov)"""),
    "a_28_run_counts": sql([BASE, MESSAGES], f"""SELECT (SELECT count(*) FROM msg) AS consumed, (SELECT count(*) FROM msg WHERE reason_code IS NOT NULL) AS quarantined,
        (SELECT count(*) FROM (SELECT DISTINCT region, {_bucket(W)} FROM ok WHERE kind <> 'station')) AS records, (SELECT count(*) FROM ok) AS forwarded"""),
    "a_29_call_status_summary": sql(BASE, """SELECT city, count(*) AS calls, count(*) FILTER (s = 200) AS ok_calls, count(*) FILTER (s = 429) AS rate_limited,
        count(*) FILTER (s = 500) AS other_failures, bool_or(s <> 200) AS void
        FROM (SELECT city, CASE WHEN event_id % 2111 = 0 THEN 429 WHEN event_id % 1999 = 0 THEN 500 ELSE 200 END AS s FROM base WHERE action <> 'signup') GROUP BY 1"""),
    "a_29_calls_by_status": sql(BASE, """SELECT city, CAST(CASE WHEN event_id % 2111 = 0 THEN 429 WHEN event_id % 1999 = 0 THEN 500 ELSE 200 END AS BIGINT) AS status,
        count(*) AS calls FROM base WHERE action <> 'signup' GROUP BY 1, 2"""),
    "a_30_admission_funnel": sql(GRID, """SELECT city, count(*) AS in_radius, count(*) FILTER (fixed) AS fixed, count(*) FILTER (graded) AS reference_grade,
        count(*) FILTER (measured) AS with_pm25_sensor, count(*) FILTER (admitted) AS admitted FROM judged GROUP BY 1"""),
    "a_30_admitted_locations": sql(GRID, "SELECT region, city, location_id, CAST(location_id AS VARCHAR) AS station_id FROM judged WHERE admitted"),
    "a_31_monthly_normals": f"""WITH c AS (SELECT {_place('(o_custkey % 12)')}, month(o_orderdate) AS month, avg(o_totalprice / 10000e0) AS v FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2, 3)
        SELECT region, CAST(month AS BIGINT) AS month, round(avg(v), 10) AS normal_exact, round_even(avg(v), 1) AS normal, count(*) AS cities FROM c GROUP BY 1, 2""",
    "a_32_station_population": sql([BASE, HOURS], """SELECT city, count(*) FILTER (reason = 'retained') AS n_rows, count(DISTINCT station_id) FILTER (reason = 'retained') AS stations,
        count(DISTINCT date_trunc('hour', starts)) FILTER (reason = 'retained') AS hours, round(min(v) FILTER (reason = 'retained'), 10) AS min_value,
        round(max(v) FILTER (reason = 'retained'), 10) AS max_value, round(median(v) FILTER (reason = 'retained'), 10) AS median_value,
        count(*) FILTER (reason LIKE 'period_%') AS off_hour_rows FROM gh GROUP BY 1 HAVING n_rows > 0"""),
    "a_33_qualifying_city_hours": sql(BASE, """SELECT city, count(*) FILTER (n >= 3) AS qualifying_hours, count(*) AS hours
        FROM (SELECT city, ts, count(DISTINCT station_id) AS n FROM st GROUP BY 1, 2) GROUP BY ROLLUP (city)"""),
    "a_34_uniqueness_report": sql(BASE, "SELECT count(*) AS n_keys, count(*) FILTER (n > 1) AS duplicated, max(n) AS worst FROM (SELECT station_id, ts, count(*) AS n FROM st GROUP BY 1, 2)"),
    "a_35_station_medians": sql(BASE, "SELECT city, station_id, count(*) AS n, round(median(pm), 10) AS median_value FROM st GROUP BY 1, 2"),
    "a_36_value_probe": sql([BASE, HOURLY], """SELECT city, count(*) AS n_values, count(*) FILTER (hn % 13 = 0) AS nulls, count(*) FILTER (hn % 13 <> 0 AND mv < 5) AS negatives,
        round(min(mv - 5e0) FILTER (hn % 13 <> 0), 10) AS min_value FROM hv GROUP BY ROLLUP (city)"""),
    "a_37_nearest_rank": sql(BASE, """SELECT region, city, count(*) AS n, round(list_sort(list(pm))[CAST(round_even(0.95e0 * (count(*) - 1), 0) AS BIGINT) + 1], 10) AS p95 FROM st GROUP BY 1, 2"""),
    "a_38_freshness_lag": sql(I360, """SELECT CAST(CASE WHEN window_start < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS BIGINT) AS batch_id, count(*) AS n,
        round(median(epoch(window_end)), 1) AS median_window_end_s, true AS written_in_order FROM rec GROUP BY 1"""),
    "a_39_component_profile": sql(I360, "SELECT count(*) AS windows, " + ", ".join(r(f"{f}({c})", f"{c}_{f}") for c in ("pollution_index", "impact_index") for f in ("avg", "stddev", "min", "max"))
        + ", round(CAST(count(*) FILTER (mean_aerosol >= 2e0) AS DOUBLE) / count(mean_aerosol), 10) AS saturated_share FROM rec"),
    "a_40_coverage_vs_ceiling": sql(BASE, """, x AS (SELECT city, count(DISTINCT user_id) AS admitted FROM base GROUP BY 1),
        y AS (SELECT city, count(DISTINCT station_id) AS contributing FROM st GROUP BY 1),
        h AS (SELECT city, count(*) FILTER (n >= 3) AS q FROM (SELECT city, ts, count(DISTINCT station_id) AS n FROM st GROUP BY 1, 2) GROUP BY 1)
        SELECT city, CAST(sum(admitted) AS BIGINT) AS admitted, CAST(sum(coalesce(contributing, 0)) AS BIGINT) AS contributing,
          CAST(sum(coalesce(q, 0)) AS BIGINT) AS qualifying_hours, CAST(sum(CASE WHEN contributing >= 3 THEN 720 ELSE 0 END) AS BIGINT) AS ceiling_hours
        FROM x LEFT JOIN y USING (city) LEFT JOIN h USING (city) GROUP BY ROLLUP (city)""").replace("\n, x AS", ", x AS"),
    "a_41_coverage_margin": sql(ALL, "SELECT city, count(*) AS covered, count(*) FILTER (n = 3) AS at_minimum FROM cov GROUP BY 1"),
    "a_41_windows_lost_without": sql(ALL, f"""SELECT s.city, s.station_id, count(*) AS windows_lost
        FROM (SELECT region, city, station_id, {_bucket(W)} AS window_start, count(*) AS k FROM st GROUP BY 1, 2, 3, 4) s
        JOIN cov c ON c.region = s.region AND c.city = s.city AND c.window_start = s.window_start WHERE c.n - s.k < 3 GROUP BY 1, 2"""),
    "a_42_admission_shortfall": sql(GRID, """SELECT city, count(*) FILTER (measured AND NOT by_first) AS examined, count(*) FILTER (by_first) AS admitted_first_sensor,
        count(*) FILTER (admitted) AS admitted_any_sensor, count(*) FILTER (admitted AND NOT by_first) AS recovered FROM judged GROUP BY 1"""),
    "a_43_mapping_is_one_to_one": sql(PLACES, """SELECT count(DISTINCT location_id) AS locations, count(DISTINCT only_id) AS sensors, count(*) FILTER (only_id = location_id) AS same_as_location,
        count(DISTINCT location_id) = count(DISTINCT only_id) AND count(*) FILTER (only_id = location_id) = 0 AS one_to_one FROM resolved WHERE kind = 'resolved'"""),
    "a_44_cluster_count": sql(ALL, "SELECT count(*) AS covered, count(DISTINCT (city, date_trunc('week', window_start))) AS city_weeks FROM cov"),
    # latest, first, sorts and sets
    "w_01_latest_per_region": sql(I360, f"""SELECT {INDEX_OUT.replace(', window_end', '')}, CASE WHEN impact_index <= 33.34e0 THEN 'low' WHEN impact_index <= 66.67e0 THEN 'medium' ELSE 'high' END AS label
        FROM rec QUALIFY row_number() OVER (PARTITION BY region ORDER BY window_start DESC) = 1"""),
    "w_02_first_admitted_value": """SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, round(arg_min(value, event_id), 10) AS value, count(*) AS reads FROM events GROUP BY 1, 2""",
    "w_03_inheritance_witness": sql(ALL, """SELECT tiers, regions_that_change, windows_with_contrast, tiers = 2 AND regions_that_change > 0 AND windows_with_contrast > 0 AS can_expose FROM (SELECT
        (SELECT count(DISTINCT provenance_tier) FROM done) AS tiers,
        (SELECT count(DISTINCT region) FROM (SELECT region, provenance_tier <> lag(provenance_tier) OVER (PARTITION BY region ORDER BY window_start) AS moved FROM done) WHERE moved) AS regions_that_change,
        (SELECT count(*) FROM (SELECT window_start FROM done GROUP BY 1 HAVING count(DISTINCT provenance_tier) > 1)) AS windows_with_contrast)"""),
    "l_01_ordered_records": sql(I360, f"SELECT {PLAIN} FROM rec ORDER BY region, window_start"),
    "l_02_worst_duplicates": sql(BASE, "SELECT station_id, ts, count(*) AS n FROM st GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY n DESC, station_id, ts LIMIT 3"),
    "l_03_earliest_stray": sql(BASE, "SELECT min(ts) AS first_stray FROM sat WHERE ts < TIMESTAMP '2024-01-16' OR ts >= TIMESTAMP '2024-01-31'"),
    "l_04_newest_version": "SELECT max(strftime(o_orderdate, '%Y-%m-%d')) AS version FROM orders",
    "l_05_cities_in_order": sql(CW, "SELECT region, window_start, names AS cities FROM roll"),
    "u_01_union_streams": sql(BASE, "SELECT kind AS event_type, region, count(*) AS n FROM ev GROUP BY 1, 2"),
    "u_02_union_of_cities": sql(BASE, "SELECT region, city FROM st UNION SELECT region, city FROM sat"),
    "u_03_sensor_difference": sql(BASE, """, a AS (SELECT DISTINCT station_id FROM st WHERE ts < TIMESTAMP '2024-01-16'),
        b AS (SELECT DISTINCT station_id FROM st WHERE ts >= TIMESTAMP '2024-01-16')
        SELECT station_id, 'first' AS only_in FROM (FROM a EXCEPT FROM b) UNION ALL SELECT station_id, 'second' FROM (FROM b EXCEPT FROM a)""").replace("\n, a AS", ", a AS"),
    "u_04_cities_left_over": sql(BASE, "SELECT DISTINCT city FROM base EXCEPT SELECT city FROM st"),
    # scalar functions
    "x_01_clamp": SCALAR.format("round(CASE WHEN event_id % 9 <> 0 THEN greatest(10e0, least(50e0, value)) END, 10) AS clamped"),
    "x_02_verbal_label": SCALAR.format("CASE WHEN event_id % 9 = 0 THEN NULL WHEN value <= 33.34e0 THEN 'low' WHEN value <= 66.67e0 THEN 'medium' ELSE 'high' END AS label"),
    "x_03_mqo_tolerance": SCALAR.format(f"round({TOLERANCE.format(o='value - 50e0')}, 10) AS tolerance"),
    "x_04_window_bounds": SCALAR.format(f"{_bucket(30)} AS start_30, {_bucket(30)} + INTERVAL '30 minutes' AS end_30"),
    "x_05_half_diagonal": SCALAR.format("round(500e0 * sqrt(pow(44.528e0, 2) + pow(44.528e0 * cos(radians(value / 10e0)), 2)), 6) AS half_diagonal_m"),
    "x_06_station_radius": SCALAR.format("""CAST(floor(least(25000e0, 500e0 * sqrt(pow(44.528e0, 2) + pow(44.528e0 * cos(radians(value / 6e0)), 2)))) AS BIGINT) AS radius_m,
        500e0 * sqrt(pow(44.528e0, 2) + pow(44.528e0 * cos(radians(value / 6e0)), 2)) > 25000 AS capped"""),
    "x_07_canonical_key": SCALAR.format("strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS key"),
    "x_08_axis_label": SCALAR.format("strftime(ts, '%H:%M') AS label, 'newest window ' || strftime(ts, '%Y-%m-%d %H:%M') || ' UTC, 30 minute windows' AS line"),
    "x_09_absent_marker": SCALAR.format("CASE WHEN event_id % 4 = 0 THEN 'not recorded' ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.0' END AS shown"),
    "x_10_record_json": sql(I360, """SELECT region, strftime(window_start, '%Y-%m-%d %H:%M:%S') AS start,
        '{"confidence":"' || confidence || '","region":"' || region || '","start":"' || strftime(window_start, '%Y-%m-%d %H:%M:%S') || '"}' AS json FROM rec"""),
    # streaming, against the batch definition
    "t_01_stream_windows": sql(I360, "SELECT region, window_start, window_end, n_weather, n_satellite FROM rec"),
    "t_02_stream_index": sql(OK360, f"SELECT {PLAIN} FROM rec"),
    "t_03_commit_after_write": sql(OK360, f"SELECT {PLAIN} FROM rec"),
    "t_04_late_rows": sql([BASE, MESSAGES], """SELECT kind AS event_type, count(*) AS accepted_rows, true AS some_dropped,
        count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS late_rows, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS counted_rows FROM ok GROUP BY 1"""),
    "t_05_drain_once": sql([BASE, MESSAGES], "SELECT kind AS event_type, region, count(*) AS n FROM ok GROUP BY 1, 2"),
    "t_06_replay": sql(OK360, """, kept AS (SELECT region, count(*) + count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS raw_rows FROM ok GROUP BY 1)
        SELECT region, raw_rows, count(*) AS n, round(avg(impact_index), 10) AS mean_index FROM rec JOIN kept USING (region) GROUP BY 1, 2""").replace("\n, kept", ", kept"),
    "t_07_stream_reconcile": sql(ALL, f"SELECT {RECONCILED} FROM done"),
    "t_07_stream_ingest": sql(OK_ALL, f"SELECT {RECONCILED} FROM done"),
    "t_08_quarantine_side_output": sql([BASE, MESSAGES], "SELECT claimed_type AS event_type, reason_code, count(*) AS n FROM msg WHERE reason_code IS NOT NULL GROUP BY 1, 2"),
    "t_09_run_telemetry": "SELECT 'index' AS query, count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows, CAST(4 AS BIGINT) AS batches FROM events",
    # guards
    "g_01_tier_is_earned": sql(ALL, GUARD.format("tier_is_earned", "true", "done")),
    "g_02_reported_never_resolved": sql(ALL, GUARD.format("reported_never_resolved", "true", "cc")),
    "g_03_stations_do_not_move_the_index": sql(I360, GUARD.format("stations_do_not_move_the_index", "true", INDEX_GUARD)),
    "g_04_reconciling_keeps_the_index": sql(I360, GUARD.format("reconciling_keeps_the_index", "true", INDEX_GUARD)),
    "g_05_empty_is_no_pass": "SELECT 'empty_is_no_pass' AS guard, CAST(0 AS BIGINT) AS checked, CAST(0 AS BIGINT) AS violations, false AS passed",
    "g_06_funnel_is_monotone": sql(GRID, GUARD.format("funnel_is_monotone", "true", "(SELECT city FROM judged GROUP BY 1)")),
}
