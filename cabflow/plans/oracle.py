"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written as plain ordered-window SQL over the driver views (``events``,
``orders``, ``lineitem``, ``documents``) – deliberately the naive form, so
it checks the distributed Spark plans rather than restating them.
"""

from __future__ import annotations

from cabflow.plans.driver import (ALLOWED_LATENESS_US, COUNT_WINDOW, HOUR_US, IDLE_GAP_US, LATE_DELAY_US, MARKER_TYPE, MINUTE_US,
                                  SESSION_GAP_US, WALLCLOCK_DELAY_US, WATERMARK_PERIOD_US, WINDOW_LATE_DELAY_US)
from cabflow.operators.useragg import BASE, MODULUS
from cabflow.sources.tables import (ARRIVAL_MOD_MINUTES, ARRIVAL_MULT, COORD_STEP, END_LAT_MOD, END_LON_MOD,
                                    LAT_BASE, LAT_MOD, LON_BASE, LON_MOD)

ARR = f"ts + to_minutes(CAST((event_id * {ARRIVAL_MULT}) % {ARRIVAL_MOD_MINUTES} AS INTEGER))"
CENTS = "CAST(round(value * 100) AS BIGINT)"
W_UE = "ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _coord(base, mod, col="event_id"):
    return (f"CAST(CAST({base} AS DOUBLE) + CAST({col} % {mod} AS DOUBLE) * CAST({COORD_STEP} AS DOUBLE)"
            " AS REAL)")


def _inside(lon, lat):
    return (f"(NOT (CAST({lon} AS DOUBLE) > -73.7 OR CAST({lon} AS DOUBLE) < -74.05) AND "
            f"NOT (CAST({lat} AS DOUBLE) > 41.0 OR CAST({lat} AS DOUBLE) < 40.5))")


def _cell(lon, lat):
    return (f"CAST(floor((CAST(74.05 AS DOUBLE) - CAST(abs({lon}) AS DOUBLE)) / CAST(0.0014 AS DOUBLE)) + "
            f"floor((CAST(41.0 AS DOUBLE) - CAST({lat} AS DOUBLE)) / CAST(0.00125 AS DOUBLE)) * 250 AS INTEGER)")


def _label(x):
    return (f"CASE CAST(trunc(({x}) / 2.5) AS INTEGER) WHEN 0 THEN 'calm' WHEN 1 THEN 'busy' "
            "ELSE 'crazy' END")


def _windows(size_us, slide_us, offset_us, key="event_type"):
    n = -(-size_us // slide_us)
    return f"""
WITH b AS (SELECT {key}, epoch_us(ts) AS t FROM events),
w AS (SELECT {key}, t, t - (((t - {offset_us}) % {slide_us}) + {slide_us}) % {slide_us} - k * {slide_us} AS ws
      FROM b, range({n}) r(k))
SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {size_us}) AS window_end, {key},
       count(*) AS n
FROM w WHERE ws <= t AND t < ws + {size_us}
GROUP BY ws, {key}"""


def _sessions(select_extra: str, gap_expr: str, ts="ts", cols="user_id, event_id, ts, value, event_type",
              src="events"):
    return f"""
WITH b AS (SELECT {cols}, epoch_us({ts}) AS t, epoch_us({ts}) + ({gap_expr}) AS e FROM {src}),
p AS (SELECT *, max(e) OVER (PARTITION BY user_id ORDER BY t, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM b),
s AS (SELECT *, max(CASE WHEN pe IS NULL OR t > pe THEN t END) OVER (PARTITION BY user_id ORDER BY t, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ss FROM p)
SELECT user_id, {select_extra} FROM s GROUP BY user_id, ss"""


def _late(wm_src: str, delay_us: int, select: str, late: bool = True) -> str:
    cond = "epoch_us(ts) <= wm" if late else "(wm IS NULL OR epoch_us(ts) > wm)"
    return f"""
WITH b AS (SELECT event_id, user_id, ts, event_type, {ARR} AS arr FROM events),
w AS (SELECT *, max({wm_src}) OVER (ORDER BY arr, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay_us} AS wm FROM b)
SELECT {select} FROM w WHERE {cond}"""


def _late_window(late: bool, allowed_us: int = 0) -> str:
    end = f"epoch_us(window_start) + {HOUR_US + allowed_us}"
    cond = f"{end} <= wm" if late else f"(wm IS NULL OR {end} > wm)"
    return f"""
WITH b AS (SELECT event_id, ts, event_type, {ARR} AS arr, date_trunc('hour', ts) AS window_start FROM events),
w AS (SELECT *, max(epoch_us(ts)) OVER (ORDER BY arr, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {WINDOW_LATE_DELAY_US} AS wm FROM b)
SELECT * FROM w WHERE {cond}"""


_STOP = f"""
WITH b AS (SELECT user_id, event_id, ts, value, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS stop
           FROM events),
s AS (SELECT *, coalesce(sum(stop) OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM b),
g AS (SELECT user_id, CAST(seg AS BIGINT) AS segment,
             CAST(count(*) FILTER (WHERE stop = 0) AS INTEGER) AS length,
             min((epoch_us(ts) // 1000)) FILTER (WHERE stop = 0) AS startTime,
             CAST(max(value) FILTER (WHERE stop = 0) AS REAL) AS max_speed,
             CAST(stddev_pop(value) FILTER (WHERE stop = 0) AS REAL) AS err
      FROM s GROUP BY user_id, seg
      HAVING max(stop) = 1 AND count(*) FILTER (WHERE stop = 0) > 0)"""

_RIDES = f"""
WITH r AS (SELECT event_id, user_id, event_type, ts, {ARR} AS arr,
                  {_coord(LON_BASE, LON_MOD)} AS slon,
                  CASE WHEN event_type = 'signup' THEN CAST(0.0 AS REAL) ELSE {_coord(LAT_BASE, LAT_MOD)} END AS slat,
                  {_coord(LON_BASE, END_LON_MOD)} AS elon, {_coord(LAT_BASE, END_LAT_MOD)} AS elat
           FROM events WHERE event_type <> 'error')"""

_PAIRS = """
WITH u AS (SELECT o_orderkey AS k, o_orderdate AS t, 0 AS side, CAST(0 AS BIGINT) AS i, o_totalprice AS price FROM orders
           UNION ALL
           SELECT l_orderkey AS k, l_shipdate AS t, 1 AS side, CAST(l_linenumber AS BIGINT) AS i, l_extendedprice FROM lineitem),
a AS (SELECT *, row_number() OVER w AS rn, lag(side) OVER w AS ps, lag(i) OVER w AS pi, lag(t) OVER w AS pt, lag(price) OVER w AS pp
      FROM u WINDOW w AS (PARTITION BY k ORDER BY t, side, i, price)),
b AS (SELECT *, max(CASE WHEN ps IS NULL OR ps = side THEN rn END) OVER (PARTITION BY k ORDER BY t, side, i, price
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st FROM a)
SELECT k AS orderkey, CASE WHEN side = 1 THEN i ELSE pi END AS l_linenumber,
       CASE WHEN side = 1 THEN pt ELSE t END AS order_time,
       CASE WHEN side = 1 THEN t ELSE pt END AS item_time,
       CASE WHEN side = 1 THEN pp ELSE price END AS o_totalprice,
       CASE WHEN side = 1 THEN price ELSE pp END AS l_extendedprice
FROM b WHERE (rn - st) % 2 = 1"""

_DYN_GAP = (f"CASE event_type WHEN 'click' THEN {10 * HOUR_US} WHEN 'view' THEN {20 * HOUR_US} "
            f"ELSE {5 * HOUR_US} END")

_WORDS = """
WITH l AS (SELECT unnest(string_split(regexp_replace(text, '\\r?\\n\\z', ''), chr(10))) AS line FROM documents),
l2 AS (SELECT lower(regexp_replace(line, '\\r\\z', '')) AS line FROM l),
t AS (SELECT CASE WHEN line = '' THEN [''] WHEN regexp_replace(line, '( )+\\z', '') = '' THEN CAST([] AS VARCHAR[])
                  ELSE string_split(regexp_replace(line, '( )+\\z', ''), ' ') END AS arr FROM l2)
SELECT w AS word, count(*) AS n FROM (SELECT unnest(arr) AS w FROM t) GROUP BY w"""

_WORDS_RUNNING = """
WITH d AS (SELECT doc_id, string_split(regexp_replace(text, '\\r?\\n\\z', ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS raw, generate_subscripts(lines, 1) AS line_no FROM d),
l2 AS (SELECT doc_id, line_no, lower(regexp_replace(raw, '\\r\\z', '')) AS line FROM l),
t AS (SELECT doc_id, line_no, CASE WHEN line = '' THEN [''] WHEN regexp_replace(line, '( )+\\z', '') = ''
             THEN CAST([] AS VARCHAR[]) ELSE string_split(regexp_replace(line, '( )+\\z', ''), ' ') END AS arr
      FROM l2),
w AS (SELECT doc_id, line_no, unnest(arr) AS word, generate_subscripts(arr, 1) AS pos FROM t)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(pos AS INTEGER) AS pos, word,
       count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n
FROM w"""

ORACLE: dict[str, str] = {
    "hourly_tips": f"""SELECT date_trunc('hour', ts) AS window_start, user_id,
        CAST(sum({CENTS}) AS DOUBLE) / 100.0 AS tips FROM events GROUP BY 1, 2""",
    "hourly_top": f"""WITH h AS (SELECT date_trunc('hour', ts) AS window_start, user_id,
        CAST(sum({CENTS}) AS BIGINT) AS cents FROM events GROUP BY 1, 2)
        SELECT window_start, user_id, CAST(cents AS DOUBLE) / 100.0 AS tips FROM h
        QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY cents DESC, user_id) = 1""",
    "hourly_top3": f"""WITH h AS (SELECT date_trunc('hour', ts) AS window_start, user_id,
        CAST(sum({CENTS}) AS BIGINT) AS cents FROM events GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cents DESC, user_id) AS rank FROM h)
        SELECT window_start, user_id, CAST(cents AS DOUBLE) / 100.0 AS tips, rank FROM r WHERE rank <= 3""",
    "keyed_count": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
    "running_count": f"SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id {W_UE}) AS n FROM events",
    "running_max": f"SELECT user_id, event_id, max(value) OVER (PARTITION BY user_id {W_UE}) AS max_value FROM events",
    "running_sum": f"""SELECT user_id, event_id,
        CAST(sum(event_id) OVER (PARTITION BY user_id {W_UE}) AS BIGINT) AS running_sum FROM events""",
    "running_concat": f"""SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id {W_UE}) AS pos,
        CAST(event_id AS VARCHAR) AS item FROM events""",
    "concat_text": f"""WITH t AS (SELECT user_id, count(*) AS n_items,
            'contains:' || string_agg(CAST(event_id AS VARCHAR), ' and ' ORDER BY ts, event_id) AS text FROM events GROUP BY user_id)
        SELECT user_id, n_items, CAST(strlen(text) AS BIGINT) AS n_bytes,
            CAST(list_reduce(list_transform(string_split(text, ''), lambda c: CAST(ascii(c) AS BIGINT)),
                             lambda h, b: (h * {BASE} + b) % {MODULUS}, CAST(0 AS BIGINT)) AS BIGINT) AS digest FROM t""",
    "count_window_avg": f"""WITH r AS (SELECT user_id, event_id,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
        SELECT user_id, CAST((rn - 1) // {COUNT_WINDOW} AS BIGINT) AS bucket, avg(event_id) AS average FROM r
        GROUP BY 1, 2 HAVING count(*) = {COUNT_WINDOW}""",
    "count_window_sum": f"""WITH r AS (SELECT user_id, {CENTS} AS cents,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
        SELECT user_id, CAST((rn - 1) // {COUNT_WINDOW} AS BIGINT) AS bucket,
        CAST(sum(cents) AS BIGINT) AS total_cents FROM r GROUP BY 1, 2 HAVING count(*) = {COUNT_WINDOW}""",
    "count_accumulating": f"""WITH r AS (SELECT user_id,
        count(*) OVER (PARTITION BY user_id {W_UE}) AS n_rows,
        CAST(sum({CENTS}) OVER (PARTITION BY user_id {W_UE}) AS BIGINT) AS total_cents FROM events)
        SELECT user_id, n_rows, total_cents FROM r WHERE n_rows % {COUNT_WINDOW} = 0""",
    "longest_per_key": """SELECT o_custkey,
        max((epoch_us(l_shipdate) - epoch_us(o_orderdate)) // 60000000) AS max_minutes
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_shipdate >= o_orderdate GROUP BY o_custkey""",
    "sliding_count": _windows(10 * MINUTE_US, 5 * MINUTE_US, 0),
    "sliding_panes": f"""
        WITH p AS (SELECT epoch_us(ts) // {MINUTE_US} AS pane, {CENTS} AS cents FROM events),
        w AS (SELECT pane - unnest(range({24 * 60})) AS w, cents FROM p)
        SELECT make_timestamp(w * {MINUTE_US}) AS window_start, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents, max(cents) AS most
        FROM w GROUP BY w""",
    "tumbling_offset": _windows(HOUR_US, HOUR_US, 15 * MINUTE_US),
    "sliding_offset": _windows(HOUR_US, 30 * MINUTE_US, 15 * MINUTE_US),
    "window_all": f"""SELECT date_trunc('hour', ts) AS window_start, count(*) AS n,
        CAST(sum({CENTS}) AS DOUBLE) / 100.0 AS tips FROM events GROUP BY 1""",
    "session_stats": _sessions(
        "make_timestamp(ss) AS session_start, make_timestamp(max(e)) AS session_end, "
        "CAST(count(*) AS INTEGER) AS length, min((epoch_us(ts) // 1000)) AS startTime, max(value) AS maxSpeed, "
        f"round(stddev_pop(value), 4) AS erraticness, {_label('stddev_pop(value)')} AS label",
        str(SESSION_GAP_US)),
    "session_dynamic": _sessions(
        "make_timestamp(ss) AS session_start, make_timestamp(max(e)) AS session_end, count(*) AS n", _DYN_GAP),
    "stop_segments": _STOP + f"""
        SELECT user_id, segment, length, startTime, CAST(max_speed AS DOUBLE) AS maxSpeed,
        round(CAST(err AS DOUBLE), 3) AS erraticness, {_label('err')} AS label FROM g""",
    "segment_text": _STOP + f"""
        SELECT user_id, startTime, CAST(user_id AS VARCHAR) || ',' || CAST(startTime AS VARCHAR) || ',' ||
        CAST(length AS VARCHAR) || ' events,' || CAST(max_speed AS VARCHAR) || ' kph,' || {_label('err')} AS line
        FROM g""",
    "collect_window": """SELECT date_trunc('hour', ts) AS window_start, event_type,
        row_number() OVER (PARTITION BY date_trunc('hour', ts), event_type ORDER BY ts, event_id) AS pos,
        CAST(event_id AS VARCHAR) || '|' || strftime(ts, '%H:%M:%S') AS item FROM events""",
    "late_events": _late("epoch_us(ts)", LATE_DELAY_US, "event_id, user_id, ts, arr"),
    "event_sort": _late("epoch_us(ts)", LATE_DELAY_US,
                        "user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos",
                        late=False),
    "late_marker": _late(f"CASE WHEN event_type = '{MARKER_TYPE}' THEN epoch_us(ts) END", LATE_DELAY_US,
                         "event_id, user_id, ts, arr"),
    "late_window": f"SELECT window_start, event_type, count(*) AS n FROM ({_late_window(False)}) GROUP BY 1, 2",
    "late_window_allowed": f"""SELECT window_start, event_type, count(*) AS n
        FROM ({_late_window(False, ALLOWED_LATENESS_US)}) GROUP BY 1, 2""",
    "late_window_firings": f"""WITH w AS ({_late_window(False, ALLOWED_LATENESS_US)}),
        f AS (SELECT *, coalesce(epoch_us(window_start) + {HOUR_US} <= wm, false) AS again FROM w),
        c AS (SELECT window_start, event_type, again, count(*) FILTER (WHERE NOT again) OVER k AS first,
                     row_number() OVER (PARTITION BY window_start, event_type ORDER BY again, arr, event_id) AS n
              FROM f WINDOW k AS (PARTITION BY window_start, event_type))
        SELECT window_start, event_type, 1 AS firing, first AS n FROM c GROUP BY ALL HAVING first > 0
        UNION ALL SELECT window_start, event_type, CAST(n - first + CASE WHEN first > 0 THEN 1 ELSE 0 END AS INTEGER), n FROM c WHERE again""",
    "late_periodic": f"""
        WITH b AS (SELECT event_id, user_id, ts, {ARR} AS arr, epoch_us({ARR}) // {WATERMARK_PERIOD_US} AS period FROM events),
        p AS (SELECT period, max(max(epoch_us(ts))) OVER (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                     - {LATE_DELAY_US} AS wm FROM b GROUP BY period)
        SELECT event_id, user_id, ts, arr FROM b JOIN p USING (period) WHERE epoch_us(ts) <= wm""",
    "late_window_side": f"SELECT event_id, event_type, window_start FROM ({_late_window(True)})",
    "late_wallclock": f"""
WITH b AS (SELECT event_type, epoch_us(ts) AS t, epoch_us({ARR}) AS a FROM events),
w AS (SELECT event_type, t, a, t - (t % {5 * MINUTE_US}) - k * {5 * MINUTE_US} AS ws FROM b, range(2) r(k))
SELECT make_timestamp(ws) AS window_start, make_timestamp(ws + {10 * MINUTE_US}) AS window_end, event_type,
       count(*) AS n
FROM w WHERE ws <= t AND t < ws + {10 * MINUTE_US} AND ws + {10 * MINUTE_US} > a - {WALLCLOCK_DELAY_US}
GROUP BY ws, event_type""",
    "idle_count": _sessions(
        "make_timestamp(ss) AS first_arrival, make_timestamp(max(e)) AS emit_at, count(*) AS n",
        str(IDLE_GAP_US), ts="arr", cols=f"user_id, event_id, {ARR} AS arr"),
    "pair_join": """SELECT o_orderkey, l_linenumber, o_totalprice, l_extendedprice
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "pair_first_come": _PAIRS,
    "pair_unmatched": """SELECT DISTINCT o_orderkey AS orderkey, 'left' AS side FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
        UNION ALL
        SELECT DISTINCT l_orderkey AS orderkey, 'right' AS side FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""",
    "word_count": _WORDS,
    "word_running_count": _WORDS_RUNNING,
    "bbox_filter": f"""SELECT * FROM (SELECT event_id, {_coord(LON_BASE, LON_MOD)} AS lon,
        {_coord(LAT_BASE, LAT_MOD)} AS lat FROM events) WHERE {_inside('lon', 'lat')}""",
    "grid_cell": f"""SELECT event_id, {_cell('lon', 'lat')} AS cell FROM (SELECT event_id,
        {_coord(LON_BASE, LON_MOD)} AS lon, {_coord(LAT_BASE, LAT_MOD)} AS lat FROM events)
        WHERE {_inside('lon', 'lat')}""",
    "parse_rides": _RIDES + """
        SELECT event_id AS rideId, event_type IN ('view', 'signup') AS isStart,
        date_trunc('second', ts) AS startTime,
        CASE WHEN event_type IN ('view', 'signup') THEN TIMESTAMP '1970-01-01 00:00:00'
             ELSE date_trunc('second', arr) END AS endTime,
        slon AS startLon, slat AS startLat, elon AS endLon, elat AS endLat,
        CAST(event_id % 6 + 1 AS SMALLINT) AS passengerCnt, user_id AS taxiId, user_id AS driverId FROM r""",
    "ride_count": _RIDES + f"""
        SELECT user_id AS driverId, count(*) AS rides FROM r
        WHERE {_inside('slon', 'slat')} AND {_inside('elon', 'elat')} GROUP BY user_id""",
    "enrich_rides": _RIDES + f"""
        SELECT event_id AS rideId, {_cell('slon', 'slat')} AS startCell, {_cell('elon', 'elat')} AS endCell FROM r
        WHERE {_inside('slon', 'slat')} AND {_inside('elon', 'elat')}""",
    "ride_text": _RIDES + f"""
        SELECT event_id AS rideId, concat_ws(',', event_id, CASE WHEN event_type IN ('view', 'signup') THEN 'START' ELSE 'END' END,
        strftime(ts, '%Y-%m-%d %H:%M:%S'), CASE WHEN event_type IN ('view', 'signup') THEN '1970-01-01 00:00:00'
        ELSE strftime(arr, '%Y-%m-%d %H:%M:%S') END, slon, slat, elon, elat, event_id % 6 + 1, user_id, user_id,
        {_cell('slon', 'slat')}, {_cell('elon', 'elat')}) AS line FROM r
        WHERE {_inside('slon', 'slat')} AND {_inside('elon', 'elat')}""",
    "fare_text": """SELECT o_orderkey AS rideId, concat_ws(',', o_orderkey, o_custkey, o_custkey,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), CASE WHEN o_orderkey % 2 = 0 THEN 'CRD' ELSE 'CSH' END,
        CASE WHEN o_orderstatus = 'F' THEN CAST(0.0 AS REAL) ELSE CAST(o_orderkey % 20 AS REAL) END, CAST(0.0 AS REAL),
        CAST(floor(CAST(o_totalprice AS REAL)) AS REAL)) AS line FROM orders WHERE o_orderstatus <> 'P'""",
    "car_text": f"""SELECT CAST(event_id AS VARCHAR) AS id, concat('ConnectedCarEvent{{id=', chr(39), event_id, chr(39), ', carId=', chr(39), 'car',
        user_id, chr(39), ', timestamp=', epoch_us(date_trunc('second', ts)) // 1000, ', longitude=', {_coord(LON_BASE, LON_MOD)},
        ', latitude=', {_coord(LAT_BASE, LAT_MOD)}, ', consumption=', CAST(value AS REAL), ', speed=',
        CASE WHEN event_type = 'error' THEN CAST(0 AS REAL) ELSE CAST(value AS REAL) END, ', throttle=', CAST(value AS REAL),
        ', engineload=', CAST(1.5 AS REAL), '}}') AS line FROM events""",
    "gap_segments": f"""SELECT user_id, session_start, length, startTime, maxSpeed, round(CAST(err AS DOUBLE), 3) AS erraticness,
        {_label('err')} AS label FROM (""" + _sessions(
        "make_timestamp(ss) AS session_start, CAST(count(*) AS INTEGER) AS length, min((epoch_us(ts) // 1000)) AS startTime, "
        "CAST(CAST(max(value) AS REAL) AS DOUBLE) AS maxSpeed, CAST(stddev_pop(value) AS REAL) AS err", str(SESSION_GAP_US)) + ")",
    "running_max_by": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
             max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM events),
        b AS (SELECT *, max(CASE WHEN pm IS NULL OR value > pm THEN rn END) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS brn FROM r)
        SELECT b.user_id, b.event_id, m.event_id AS best_event, m.value AS best_value FROM b JOIN r m ON m.user_id = b.user_id AND m.rn = b.brn""",
    "parse_rides_bad": "SELECT event_id AS rideId, 'flag' AS reason FROM events WHERE event_type = 'error'",
    "cell_longest": _RIDES + f""",
        d AS (SELECT {_cell('slon', 'slat')} AS startCell, user_id AS driverId,
              (epoch_us(date_trunc('second', arr)) - epoch_us(date_trunc('second', ts))) // 60000000 AS minutes
              FROM r WHERE event_type IN ('purchase', 'click')
              AND {_inside('slon', 'slat')} AND {_inside('elon', 'elat')})
        SELECT startCell, max(minutes) OVER (PARTITION BY startCell) AS max_minutes, driverId FROM d
        QUALIFY row_number() OVER (PARTITION BY startCell ORDER BY minutes DESC, driverId) = 1""",
    "parse_fares": """SELECT o_orderkey AS rideId, o_custkey AS taxiId, o_custkey AS driverId,
        date_trunc('second', o_orderdate) AS startTime,
        CASE WHEN o_orderkey % 2 = 0 THEN 'CRD' ELSE 'CSH' END AS paymentType,
        CASE WHEN o_orderstatus = 'F' THEN CAST(0.0 AS REAL) ELSE CAST(o_orderkey % 20 AS REAL) END AS tip,
        CAST(0.0 AS REAL) AS tolls, CAST(o_totalprice AS REAL) AS totalFare
        FROM orders WHERE o_orderstatus <> 'P'""",
    "fare_hourly_top": """WITH f AS (SELECT o_custkey AS driverId, date_trunc('hour', o_orderdate) AS window_start,
             CASE WHEN o_orderstatus = 'F' THEN CAST(0.0 AS REAL) ELSE CAST(o_orderkey % 20 AS REAL) END AS tip
             FROM orders WHERE o_orderstatus <> 'P'),
        h AS (SELECT window_start, driverId, CAST(sum(CAST(round(CAST(tip AS DOUBLE) * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS tips FROM f GROUP BY 1, 2)
        SELECT window_start, driverId, tips FROM h
        QUALIFY row_number() OVER (PARTITION BY window_start ORDER BY tips DESC, driverId) = 1""",
    "parse_cars": f"""SELECT CAST(event_id AS VARCHAR) AS id, 'car' || CAST(user_id AS VARCHAR) AS carId,
        date_trunc('second', ts) AS ts, (epoch_us(date_trunc('second', ts)) // 1000) AS timestamp,
        {_coord(LON_BASE, LON_MOD)} AS longitude, {_coord(LAT_BASE, LAT_MOD)} AS latitude,
        CAST(value AS REAL) AS consumption,
        CASE WHEN event_type = 'error' THEN CAST(0 AS REAL) ELSE CAST(value AS REAL) END AS speed,
        CAST(value AS REAL) AS throttle,
        CAST(1.5 AS REAL) AS engineload FROM events""",
    "parse_key_ts": """SELECT CAST(user_id AS VARCHAR) AS key, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts,
        (epoch_us(ts) // 1000) AS ts_ms FROM events""",
}
