"""DuckDB SQL equal to each registered query, over the driver's tables.

The SQL restates each query's meaning directly on ``events`` (sensor =
event type, the sub-meter's late flag, the derived meter), independently of
the Spark code path.
"""

from __future__ import annotations

from gridsense.plans import queries as q
from gridsense.sources import events as ev


def _in(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


SUB = f"'{ev.SUB_METER}'"
FLAGGED = f"(event_type = {SUB} AND event_id % {ev.LATE_EVERY} = 0)"
DOMAIN = ("CASE " + " ".join(f"WHEN event_type = '{s.name}' THEN '{s.domain}'"
                             for s in ev.EVENT_SENSORS) + " ELSE 'other' END")
DAY = "date_trunc('day', ts) + INTERVAL 1 DAY"



def _sum(value: str = "value") -> str:
    """A sum in decimals, rounded to cents."""
    return f"CAST(round(sum(CAST({value} AS DECIMAL(28,8))), 2) AS DOUBLE)"


def _avg(value: str = "value") -> str:
    """An average in whole numbers of 1e-8, rounded half up to cents."""
    units = f"sum(CAST(CAST({value} AS DECIMAL(28,8)) * 100000000 AS HUGEINT))"
    return f"(CAST((2 * {units} + count({value}) * 1000000) // (2 * count({value}) * 1000000) AS DOUBLE) / 100)"


# Gauge readings plus the 0/1 motion stream, as (Sensor, t, value).
READINGS = f"""
  SELECT event_type AS Sensor, date_trunc('second', ts) AS t, value FROM events
  WHERE event_type IS NOT NULL
  UNION ALL
  SELECT '{ev.MOTION}' AS Sensor, date_trunc('second', ts) AS t,
         CAST(CASE WHEN event_type = '{ev.MOTION_SOURCE}' THEN 1 ELSE 0 END AS DOUBLE) AS value
  FROM events"""

DAILY_BY_SENSOR = f"""
  SELECT Sensor, date_trunc('day', t) + INTERVAL 1 DAY AS Day,
         CASE WHEN Sensor IN {_in(s.name for s in ev.EVENT_SENSORS if s.how == 'avg')}
              THEN {_avg()} ELSE {_sum()} END AS Total
  FROM ({READINGS}) r GROUP BY 1, 2"""

# The meter: running exact total of the part sensors, read at each day label.
COUNTER = f"""
  SELECT t, CAST(sum(tot) OVER (ORDER BY t) AS DOUBLE) AS v FROM (
    SELECT {DAY} AS t, sum(CAST(value AS DECIMAL(18,2))) AS tot
    FROM events WHERE event_type IN {_in(ev.COUNTER_PARTS)} GROUP BY 1) d"""



def _steady(sensor: str) -> str:
    """A steady counter: whole cents of the day's average, so many times."""
    return f"""
  SELECT t, CAST(sum(tot) OVER (ORDER BY t) AS DOUBLE) / 100 AS v FROM (
    SELECT {DAY} AS t,
      CAST(floor(sum(CAST(round(value * 100) AS BIGINT)) / count(value)) AS BIGINT) * {ev.STEADY[sensor]} AS tot
    FROM events GROUP BY 1) d"""


def _windows(counter: str) -> str:
    """By label: the reading of the day and that of the day before."""
    return f"""
  SELECT Day, max(v) FILTER (WHERE later) AS after, max(v) FILTER (WHERE NOT later) AS before
  FROM (SELECT t AS Day, v, true AS later FROM ({counter}) c
        UNION ALL SELECT t + INTERVAL 1 DAY AS Day, v, false AS later FROM ({counter}) c) w
  GROUP BY Day"""


def _single(counter: str, bound: float) -> str:
    """A single reading reports itself; a bound hides running totals."""
    return f"""
  SELECT * FROM (SELECT Day, round(CASE WHEN after IS NOT NULL AND before IS NOT NULL THEN after - before
                                   ELSE coalesce(after, before) END, 2) AS daily_diff
                 FROM ({_windows(counter)}) x) y WHERE daily_diff < {bound}"""


COUNTER_PAIRS = f"""
  SELECT '{ev.COUNTER}' AS Sensor, Day, round(after - before, 2) AS daily_diff
  FROM ({_windows(COUNTER)}) x WHERE after IS NOT NULL AND before IS NOT NULL"""

ACCEPTED = f"""
  SELECT {DAY} AS Day, {_sum()} AS Totalw1
  FROM events WHERE event_type = {SUB} AND NOT {FLAGGED}
  GROUP BY 1 HAVING {_sum()} > {q.SUB_GT}"""

REJECTED = f"""
  SELECT time_bucket(INTERVAL '10 minutes', date_trunc('second', ts)) + INTERVAL '10 minutes'
           AS RejectedEvent,
         CAST(sum(CAST(value AS DECIMAL(28,8))) AS DOUBLE) AS RejectedVal
  FROM events WHERE {FLAGGED} GROUP BY 1"""

LEAK = f"""
  SELECT a.Day, round(p.daily_diff - a.Totalw1, 2) AS LeakValue
  FROM ({ACCEPTED}) a JOIN ({COUNTER_PAIRS}) p ON a.Day = p.Day"""

# What an append-mode stream has sent once all readings are in: days of the
# sub-meter that are the accepted lateness behind its latest reading, and
# differences whose second day the meter's watermark has passed.
SENT_SUB = f"""
  SELECT * FROM ({ACCEPTED}) a WHERE Day <= (
    SELECT max(date_trunc('second', ts)) - INTERVAL '{q.ACCEPT_DELAY}' FROM events
    WHERE event_type = {SUB} AND NOT {FLAGGED})"""
SENT_TOTAL = f"""
  SELECT * FROM ({COUNTER_PAIRS}) p WHERE Day + INTERVAL 1 DAY <= (
    SELECT max(t) - INTERVAL '{q.GAUGE_DELAY}' FROM ({COUNTER}) c)"""

# The sub-meter's readings in three runs: what the last run finds closed.
_LATE_ROWS = f"""
  WITH r AS (
    SELECT {DAY} AS Day, value, date_trunc('second', ts) AS t,
           ts < TIMESTAMP '{q.LATE_SPLIT}' AND event_id % 50 = 0 AS late
    FROM events WHERE event_type = {SUB}),
  mark AS (SELECT max(t) FILTER (WHERE NOT late) - INTERVAL '{q.ACCEPT_DELAY}' AS before,
                  max(t) - INTERVAL '{q.ACCEPT_DELAY}' AS m FROM r)
  SELECT CASE WHEN late AND Day <= before THEN 'late' WHEN Day <= m THEN 'accepted' ELSE 'open' END AS kind,
         Day, {_sum()} AS Total, count(*) AS n FROM r, mark GROUP BY 1, 2"""

# The panels' time range.
RANGE = f"BETWEEN TIMESTAMP '{q.PANEL_START}' AND TIMESTAMP '{q.PANEL_END}'"
_of_domain = {d: _in(s.name for s in ev.EVENT_SENSORS if s.domain == d and s.kind != "counter")
              for d in ("energy", "temp", "water")}
# Distinct results of one application run: every daily row of a gauge but the
# sub-meter's, pairs of all counters, and so on.
_PAIRS_ALL = " UNION ALL ".join(
    f"SELECT '{name}' AS Sensor, Day, round(after - before, 2) AS daily_diff FROM ({_windows(c)}) x "
    "WHERE after IS NOT NULL AND before IS NOT NULL"
    for name, c in ((ev.COUNTER, COUNTER), ("etot", _steady("etot")), ("wtot", _steady("wtot"))))
_GAUGE_ROWS = _in(s.name for s in ev.EVENT_SENSORS if s.kind != "counter" and s.name != ev.SUB_METER)

ORACLE: dict[str, str] = {
    "parse_reading": f"""
      SELECT event_type AS Sensor, date_trunc('second', ts) AS DateTime, value AS NumVal
      FROM events WHERE event_type IS NOT NULL""",
    "raw_envelope": f"""
      SELECT event_type AS Sensor, strftime(ts, '%Y-%m-%d %H:%M:%S') AS DateTime, value,
             {DOMAIN} AS domain
      FROM events WHERE event_type IS NOT NULL AND NOT {FLAGGED}""",
    "json_roundtrip": f"""
      SELECT event_type AS Sensor, date_trunc('second', ts) AS DateTime, value,
             {DOMAIN} AS domain
      FROM events WHERE event_type IS NOT NULL AND NOT {FLAGGED}""",
    "daily_sum": f"""
      SELECT {DAY} AS Day, {_sum()} AS Total
      FROM events WHERE event_type = 'purchase' GROUP BY 1""",
    "daily_avg": f"""
      SELECT {DAY} AS Day, {_avg()} AS Total
      FROM events WHERE event_type = '{q.AVG_SENSOR}' GROUP BY 1""",
    "movement_sum": f"""
      SELECT {DAY} AS Day,
             round(sum(CAST(CASE WHEN event_type = '{ev.MOTION_SOURCE}' THEN 1 ELSE 0 END AS DOUBLE)), 2) AS Total
      FROM events GROUP BY 1""",
    "daily_by_sensor": DAILY_BY_SENSOR,
    "counter_diff": COUNTER_PAIRS,
    "counter_diff_sql": COUNTER_PAIRS,
    "counter_diff_threshold": f"""
      SELECT 'etot' AS Sensor, CAST(Day AS DATE) AS Day, daily_diff
      FROM ({_single(_steady("etot"), q.COUNTER_LT)}) s""",
    "energy_job": f"""
      SELECT Sensor, Day, Total FROM ({DAILY_BY_SENSOR}) d WHERE Sensor IN {_of_domain["energy"]}
      UNION ALL
      SELECT 'etot' AS Sensor, Day, daily_diff AS Total FROM ({_single(_steady("etot"), q.COUNTER_LT)}) s""",
    "temp_job": f"""
      SELECT Sensor, Day, Total FROM ({DAILY_BY_SENSOR}) d WHERE Sensor IN {_of_domain["temp"]}""",
    "water_job": f"""
      SELECT 'accepted_daily' AS result, Day AS At, Totalw1 AS Value FROM ({ACCEPTED}) a
      UNION ALL
      SELECT 'counter_diff', Day, daily_diff FROM ({_single(_steady("wtot"), q.WATER_LT)}) s
      UNION ALL
      SELECT 'rejected', RejectedEvent, round(RejectedVal, 2) FROM ({REJECTED}) r""",
    "late_by_arrival": f"""
      SELECT {FLAGGED} AS late, {DAY} AS Day, {_sum()} AS Total
      FROM events WHERE event_type = {SUB} GROUP BY 1, 2""",
    "accepted_daily": ACCEPTED,
    "rejected_10min": REJECTED,
    "leak": LEAK,
    "leak_revisions": LEAK,
    "latest_per_day": f"""
      WITH hourly AS (
        SELECT {DAY} AS Day, date_trunc('hour', ts) AS hour, sum(CAST(value AS DECIMAL(28,8))) AS s
        FROM events WHERE event_type = {SUB} AND NOT {FLAGGED} GROUP BY 1, 2),
      revisions AS (
        SELECT Day, hour, CAST(round(sum(s) OVER (PARTITION BY Day ORDER BY hour), 2) AS DOUBLE) AS Totalw1
        FROM hourly)
      SELECT Day, arg_max(Totalw1, hour) AS Totalw1 FROM revisions GROUP BY Day""",
    "panel_sensor_range": f"""
      SELECT event_type AS Sensor, date_trunc('second', ts) AS DateTime, value,
             {DOMAIN} AS domain
      FROM events
      WHERE event_type = {SUB} AND NOT {FLAGGED}
        AND date_trunc('second', ts) BETWEEN TIMESTAMP '{q.PANEL_START}' AND TIMESTAMP '{q.PANEL_END}'""",
    "panel_clustered_range": f"""
      SELECT event_type AS Sensor, date_trunc('second', ts) AS DateTime, value,
             {DOMAIN} AS domain
      FROM events
      WHERE event_type = {SUB} AND NOT {FLAGGED}
        AND date_trunc('second', ts) BETWEEN TIMESTAMP '{q.PANEL_START}' AND TIMESTAMP '{q.PANEL_END}'""",
    "panel_daily_avg": f"""
      SELECT * FROM ({DAILY_BY_SENSOR}) d
      WHERE Sensor = '{q.AVG_SENSOR}'
        AND Day BETWEEN TIMESTAMP '{q.PANEL_START}' AND TIMESTAMP '{q.PANEL_END}'""",
    # Append mode emits a window once the watermark (latest event time less
    # the delay, over the whole stream) has passed its end.
    "stream_daily_sum": f"""
      SELECT * FROM ({DAILY_BY_SENSOR}) d
      WHERE Day <= (SELECT max(t) FROM ({READINGS}) r) - INTERVAL '{q.GAUGE_DELAY}'""",
    # Update mode emits every window; the last revision of a day is final.
    "stream_accepted_update": ACCEPTED,
    # Rows of the first part that come last are dropped where their window
    # had closed: 3 days behind the latest reading of the first two parts.
    "stream_late_rows": f"""
      WITH r AS (
        SELECT {DAY} AS Day, value, date_trunc('second', ts) AS t,
               ts < TIMESTAMP '{q.LATE_SPLIT}' AND event_id % 50 = 0 AS late
        FROM events WHERE event_type = {SUB}),
      mark AS (SELECT max(t) - INTERVAL '{q.ACCEPT_DELAY}' AS m FROM r WHERE NOT late)
      SELECT Day, {_sum()} AS Totalw1 FROM r, mark WHERE NOT late OR Day > m GROUP BY Day""",
    "stream_progress": f"""
      SELECT CAST((SELECT count(*) FROM events WHERE event_type = {SUB}) AS BIGINT) AS input_rows,
             (SELECT count(*) FROM ({_LATE_ROWS}) x WHERE kind = 'late') AS dropped""",
    "stream_rejected": REJECTED,
    "stream_counter_diff": COUNTER_PAIRS,
    "stream_leak": LEAK,
    "stream_leak_join": f"""
      WITH a AS ({SENT_SUB}), p AS ({SENT_TOTAL}),
      mark AS (SELECT least((SELECT max(Day) FROM a), (SELECT max(Day) FROM p)) - INTERVAL '{q.JOIN_DELAY}' AS m)
      SELECT a.Day, Totalw1, round(daily_diff - Totalw1, 2) AS LeakValue
      FROM a LEFT JOIN p ON a.Day = p.Day, mark WHERE daily_diff IS NOT NULL OR a.Day <= m""",
    "stream_keyed_daily": f"""
      WITH r AS (
        SELECT event_type AS Sensor, value, date_trunc('second', ts)
               + CASE WHEN event_type = {SUB} THEN INTERVAL '{q.AHEAD}' ELSE INTERVAL '0 days' END AS t
        FROM events WHERE event_type IS NOT NULL),
      mark AS (SELECT Sensor, max(t) - INTERVAL '{q.GAUGE_DELAY}' AS m FROM r GROUP BY Sensor),
      d AS (
        SELECT Sensor, date_trunc('day', t) + INTERVAL 1 DAY AS Day, count(*) AS n,
               CASE WHEN Sensor IN {_in(ev.AVERAGED)} THEN {_avg()} ELSE {_sum()} END AS Total
        FROM r GROUP BY 1, 2)
      SELECT Sensor, 'accepted' AS kind, Day, Total, n FROM d JOIN mark USING (Sensor) WHERE Day <= m""",
    "stream_late_split": _LATE_ROWS,
    "stream_open_windows": f"""
      SELECT {SUB} AS Sensor, Day, Total, n FROM ({_LATE_ROWS}) x WHERE kind = 'open'""",
    "stream_counter_state": _PAIRS_ALL,
    # The same leak through the whole application, labelled by its meter.
    "stream_household": f"""
      SELECT '{ev.COUNTER}' AS Meter, Day, LeakValue FROM ({LEAK}) s""",
    "store_twice": f"""
      SELECT 'daily' AS dataset, count(*) AS n FROM ({DAILY_BY_SENSOR}) d WHERE Sensor IN {_GAUGE_ROWS}
      UNION ALL SELECT 'counter_diff', count(*) FROM ({_PAIRS_ALL}) p
      UNION ALL SELECT 'accepted_daily', count(*) FROM ({ACCEPTED}) a
      UNION ALL SELECT 'rejected', count(*) FROM ({REJECTED}) r
      UNION ALL SELECT 'leak', count(*) FROM ({LEAK}) l
      UNION ALL SELECT 'raw', (SELECT count(*) FROM ({READINGS}) g)
          - (SELECT count(*) FROM events WHERE {FLAGGED})
          + (SELECT count(*) FROM ({COUNTER}) a) + (SELECT count(*) FROM ({_steady("etot")}) b)
          + (SELECT count(*) FROM ({_steady("wtot")}) c)""",
    "panel_th1_raw": f"""
      SELECT event_type AS Sensor, date_trunc('second', ts) AS At, round(value, 2) AS Value
      FROM events WHERE event_type = '{q.AVG_SENSOR}' AND date_trunc('second', ts) {RANGE}""",
    "panel_w1_raw": f"""
      SELECT event_type AS Sensor, date_trunc('second', ts) AS At, round(value, 2) AS Value
      FROM events WHERE event_type = {SUB} AND NOT {FLAGGED} AND date_trunc('second', ts) {RANGE}""",
    "panel_late_rejected": f"""
      SELECT {SUB} AS Sensor, RejectedEvent AS At, round(RejectedVal, 2) AS Value
      FROM ({REJECTED}) r WHERE RejectedEvent {RANGE}""",
    "panel_etot_diff": f"""
      SELECT Sensor, Day AS At, daily_diff AS Value FROM ({_PAIRS_ALL}) p
      WHERE Sensor = 'etot' AND Day {RANGE}""",
    "panel_water_leak": f"""
      SELECT '{ev.COUNTER}' AS Sensor, Day AS At, LeakValue AS Value FROM ({LEAK}) l WHERE Day {RANGE}""",
}
