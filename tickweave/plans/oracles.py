"""SQL oracles: the definition of every query, written for DuckDB without the library's tricks."""

from __future__ import annotations

_T = "strftime(ts, '%m/%d/%Y,%H:%M:%S')"
_SECOND = "date_trunc('second', ts)"


def _ticks(symbol: str, where: str = "true") -> str:
    return (f"SELECT {symbol} AS symbol, ts, value, CAST(round(value * 100) AS BIGINT) AS cents, "
            f"event_id AS seq FROM events WHERE {where}")


TYPE_TICKS = f"ticks AS ({_ticks('event_type')})"
USER_TICKS = f"ticks AS ({_ticks('CAST(user_id AS VARCHAR)')})"

LATE_TICKS = """late AS (
  SELECT event_type AS symbol, ts, value, CAST(round(value * 100) AS BIGINT) AS cents,
         (event_id + (event_id * 31) % 17) * 10000000000 + event_id AS seq FROM events),
clamped AS (SELECT symbol, value, cents, seq,
    max(ts) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ts FROM late),
ticks AS (SELECT * FROM clamped QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY seq) = 1)"""

INTERVALS = """iv AS (
  SELECT symbol, begin_ts, ts AS end_ts, CAST(cents - prev AS DOUBLE) AS delta FROM (
    SELECT symbol, ts, cents, lag(ts) OVER w AS begin_ts, lag(cents) OVER w AS prev FROM ticks
    WINDOW w AS (PARTITION BY symbol ORDER BY ts)) WHERE begin_ts IS NOT NULL)"""

OVERLAPS = """ov AS (
  SELECT a.symbol AS id0, b.symbol AS id1, a.delta AS delta0, b.delta AS delta1,
         a.begin_ts AS begin_ts0, b.begin_ts AS begin_ts1, a.end_ts AS end_ts0, b.end_ts AS end_ts1
  FROM iv a JOIN iv b ON a.symbol < b.symbol AND a.begin_ts < b.end_ts AND b.begin_ts < a.end_ts)"""

CORRELATION = """ss AS (SELECT symbol, sum(delta * delta) AS s FROM iv GROUP BY symbol HAVING sum(delta * delta) > 0),
num AS (SELECT id0, id1, sum(delta0 * delta1) AS n FROM ov GROUP BY id0, id1),
corr AS (SELECT a.symbol AS id0, b.symbol AS id1,
    greatest(least(coalesce(n, 0) / (sqrt(a.s) * sqrt(b.s)), 1.0), -1.0) AS value
  FROM ss a JOIN ss b ON a.symbol < b.symbol LEFT JOIN num ON num.id0 = a.symbol AND num.id1 = b.symbol)"""


def _windows(size: str, advance: str) -> str:
    """Per-window correlation straight from its definition."""
    return f"""bounds AS (SELECT min(ts) AS t0, max(ts) AS t1 FROM ticks),
grid AS (SELECT unnest(generate_series(t0, t1 - INTERVAL '{size}', INTERVAL '{advance}')) AS w FROM bounds),
wiv AS (SELECT w, iv.* FROM grid JOIN iv ON end_ts >= w AND end_ts < w + INTERVAL '{size}'),
wss AS (SELECT w, symbol, sum(delta * delta) AS s FROM wiv GROUP BY w, symbol HAVING sum(delta * delta) > 0),
wnum AS (SELECT w, id0, id1, sum(delta0 * delta1) AS n FROM grid JOIN ov
    ON end_ts0 >= w AND end_ts0 < w + INTERVAL '{size}' AND end_ts1 >= w AND end_ts1 < w + INTERVAL '{size}'
    GROUP BY w, id0, id1),
win AS (SELECT a.symbol AS id0, b.symbol AS id1, a.w AS window_start, a.w + INTERVAL '{size}' AS window_end,
    round(greatest(least(coalesce(n, 0) / (sqrt(a.s) * sqrt(b.s)), 1.0), -1.0), 6) AS value
  FROM wss a JOIN wss b ON a.w = b.w AND a.symbol < b.symbol
  LEFT JOIN wnum ON wnum.w = a.w AND wnum.id0 = a.symbol AND wnum.id1 = b.symbol)"""


TYPE_WINDOWS = f"{TYPE_TICKS}, {INTERVALS}, {OVERLAPS}, {_windows('1 day', '6 hours')}"


def _changes(rows: str, threshold: str, name: str) -> str:
    return f"""{name} AS (
  SELECT id0 AS v0, id1 AS v1, window_end AS ts, flag AS is_add FROM (
    SELECT *, lag(flag, 1, false) OVER (PARTITION BY id0, id1 ORDER BY window_end) AS was FROM (
      SELECT *, abs(value) >= {threshold} AS flag FROM {rows})) WHERE flag <> was)"""


NATION = """trade AS (
  SELECT least(cn.n_name, sn.n_name) AS id0, greatest(cn.n_name, sn.n_name) AS id1,
         date_trunc('month', o_orderdate)::TIMESTAMP AS window_start, count(*) AS c
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey WHERE cn.n_name <> sn.n_name GROUP BY ALL),
nr AS (SELECT id0, id1, window_start, window_start + INTERVAL 1 MONTH AS window_end,
    c * 300.0::DOUBLE / sum(c) OVER (PARTITION BY window_start) AS value FROM trade)"""
NATION_EVENTS = f"{NATION}, {_changes('nr', '1.5', 'ev')}"
NATION_SPANS = f"""{NATION_EVENTS}, spans AS (
  SELECT v0, v1, ts AS valid_from, next_ts AS valid_to FROM (
    SELECT *, lead(ts) OVER (PARTITION BY v0, v1 ORDER BY ts) AS next_ts FROM ev) WHERE is_add)"""
NATION_GRAPH = f"""{NATION_EVENTS}, pairs AS (SELECT DISTINCT v0, v1 FROM ev WHERE is_add),
adj AS (SELECT v0 AS src, v1 AS dst FROM pairs UNION ALL SELECT v1, v0 FROM pairs)"""

PARAMS = """plog AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'correlationThreshold' ELSE 'hubListSize' END AS name,
    CASE WHEN event_id % 2 = 0 THEN (event_id % 20) / 100.0::DOUBLE ELSE CAST(event_id % 9 + 1 AS DOUBLE) END AS value,
    ts FROM events WHERE event_type = 'error')"""



def _size_log(every: int, hours: list[float]) -> str:
    steps = ", ".join(f"{h * 3600.0}::DOUBLE" for h in hours)
    return f"""slog AS (SELECT ts, list_extract([{steps}], CAST(event_id // {every} % {len(hours)} + 1 AS INTEGER)) AS value
    FROM events WHERE event_type = 'error' AND event_id % {every} = 3)"""


# window k closes at the first tick that is its size of that moment past the window's start
SIZED_WINDOWS = f"""{_size_log(40, [12, 30, 48, 18, 96, 24])},
sized AS (SELECT t.ts, coalesce(p.value, 86400) AS s FROM (SELECT DISTINCT ts FROM ticks) t ASOF LEFT JOIN slog p ON t.ts >= p.ts),
grid AS (SELECT unnest(generate_series(t0, t1, INTERVAL '6 hours')) AS w FROM (SELECT min(ts) AS t0, max(ts) AS t1 FROM ticks)),
closing AS (SELECT w, min(ts) AS closes, arg_min(s, ts) AS s FROM grid JOIN sized ON epoch_us(ts) - CAST(s * 1000000 AS BIGINT) >= epoch_us(w) GROUP BY w),
wss AS (SELECT w, symbol, sum(delta * delta) AS s FROM closing JOIN iv ON end_ts >= w AND end_ts < closes
  GROUP BY w, symbol HAVING sum(delta * delta) > 0),
wnum AS (SELECT w, id0, id1, sum(delta0 * delta1) AS n FROM closing JOIN ov
  ON end_ts0 >= w AND end_ts0 < closes AND end_ts1 >= w AND end_ts1 < closes GROUP BY w, id0, id1)
SELECT a.symbol AS id0, b.symbol AS id1, a.w AS window_start, a.w + to_microseconds(CAST(c.s * 1000000 AS BIGINT)) AS window_end,
  round(greatest(least(coalesce(n, 0) / (sqrt(a.s) * sqrt(b.s)), 1.0), -1.0), 6) AS value
FROM wss a JOIN wss b ON a.w = b.w AND a.symbol < b.symbol JOIN closing c ON c.w = a.w
LEFT JOIN wnum ON wnum.w = a.w AND wnum.id0 = a.symbol AND wnum.id1 = b.symbol"""

LINES = """lines AS (SELECT event_id AS seq, concat_ws(',', event_type,
    CASE WHEN event_id % 50 = 7 THEN '15/04/2016' ELSE strftime(ts, '%m/%d/%Y') END, strftime(ts, '%H:%M:%S'),
    CASE WHEN event_id % 50 = 11 THEN 'abc' ELSE CAST(value AS VARCHAR) END,
    CASE WHEN event_id % 50 = 13 THEN 'x' ELSE CAST(event_id % 90 AS VARCHAR) END) AS value FROM events)"""

COMMANDS = """cmd AS (SELECT ts, CAST(user_id AS VARCHAR) AS player, event_type = 'signup' AS is_add
    FROM events WHERE event_type IN ('signup', 'error'))"""

EDGE_LINES = f"""elines AS (SELECT v0 || ',' || v1 || ',' || {_T} || ',' ||
    CASE WHEN month(ts) = 7 THEN '2' WHEN is_add THEN '1' ELSE '0' END AS value, * FROM ev)"""

VISITS = """upd AS (SELECT CAST(user_id AS VARCHAR) AS node, CAST(round(value * 100) AS BIGINT) AS visits,
    ts, event_id AS seq FROM events)"""
WINDOWED_VISITS = f"""{VISITS}, latest AS (
  SELECT time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '2024-01-01') AS w, node, max_by(visits, seq) AS visits, max(ts) AS ts
  FROM upd GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY visits DESC, node) AS rank FROM latest)"""


# signal by signal: the next one is the earliest instant that is one period of its time past the last
PERIOD_SIGNALS = f"""{_size_log(20, [2, 10.5, 1, 30, 5])},
stretches AS (SELECT since, p, coalesce(lead(since) OVER (ORDER BY since), 9000000000000000000) AS until FROM (
  SELECT -9000000000000000000 AS since, 21600000000 AS p UNION ALL
  SELECT epoch_us(ts), CAST(max(value) * 1000000 AS BIGINT) FROM slog GROUP BY ts)),
signals AS (SELECT epoch_us(min(ts)) // 21600000000 * 21600000000 AS t, epoch_us(max(ts)) AS stop FROM upd
  UNION ALL SELECT (SELECT min(greatest(since, s.t + p)) FROM stretches WHERE greatest(since, s.t + p) < until), stop
  FROM signals s WHERE t <= stop),
spans AS (SELECT make_timestamp(t) AS w, make_timestamp(lead(t) OVER (ORDER BY t)) AS closes FROM signals),
latest AS (SELECT w, closes, node, max_by(visits, seq) AS visits FROM upd ASOF JOIN spans ON upd.ts >= spans.w GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY visits DESC, node) AS rank FROM latest),
sized AS (SELECT w, coalesce(p.value, 10) AS k FROM (SELECT DISTINCT w, closes FROM latest) d ASOF LEFT JOIN
  (SELECT ts, value FROM plog WHERE name = 'hubListSize') p ON closes >= p.ts)"""


def _draw(use: str, seed: int = 7, gen: str = "0") -> str:
    """The walk's uniform draw: 52 bits of an MD5."""
    return (f"(CAST('0x' || md5('{seed},{use},' || walk_id || ',' || {gen} || ',' || step)[1:13] AS BIGINT) "
            "/ 4503599627370496.0::DOUBLE)")


def _samples(interval: str, end: str) -> str:
    """Basic windows of a whole number of hours, carried forward."""
    hours = int(interval.split()[0])
    number = f"CAST(floor(epoch(ts) / {hours * 3600}) AS BIGINT)"
    return f"""closing AS (SELECT symbol, {number} AS g, max_by(value, seq) AS value FROM ticks GROUP BY ALL),
last_g AS (SELECT max(g) AS hi FROM closing),
smp AS (SELECT symbol, unnest(generate_series(g, coalesce(next_g - 1, hi))) AS g, value FROM (
  SELECT *, lead(g) OVER (PARTITION BY symbol ORDER BY g) AS next_g FROM closing), last_g)"""


RANGES = """firsts AS (SELECT symbol, min(seq) AS seq, min_by(value, seq) AS value FROM ticks GROUP BY symbol),
created AS (SELECT a.symbol AS id0, b.symbol AS id1, greatest(a.seq, b.seq) AS at,
    (SELECT max_by(value, seq) FROM ticks t WHERE t.symbol = a.symbol AND t.seq <= greatest(a.seq, b.seq)) AS v0,
    (SELECT max_by(value, seq) FROM ticks t WHERE t.symbol = b.symbol AND t.seq <= greatest(a.seq, b.seq)) AS v1
  FROM firsts a JOIN firsts b ON a.symbol < b.symbol),
binned AS (SELECT c.id0, c.id1, a.g,
    CAST(coalesce(greatest(least(floor((a.value - v0 / 1.2::DOUBLE) / nullif(v0 * 1.2::DOUBLE - v0 / 1.2::DOUBLE, 0) * 30), 29), 0), 0) AS INTEGER) AS x,
    CAST(coalesce(greatest(least(floor((b.value - v1 / 1.2::DOUBLE) / nullif(v1 * 1.2::DOUBLE - v1 / 1.2::DOUBLE, 0) * 30), 29), 0), 0) AS INTEGER) AS y
  FROM created c JOIN smp a ON a.symbol = c.id0 JOIN smp b ON b.symbol = c.id1 AND b.g = a.g)"""

DIRECTED = """moves AS (SELECT * FROM (SELECT id0, id1, g, x, y,
    lag(x) OVER (PARTITION BY id0, id1 ORDER BY g) AS px, lag(y) OVER (PARTITION BY id0, id1 ORDER BY g) AS py
  FROM binned) WHERE px IS NOT NULL),
dir AS (SELECT id0, id1, g, y AS nxt, py AS own, px AS oth FROM moves
        UNION ALL SELECT id1, id0, g, x, px, py FROM moves)"""


def _textbook(source: str, window: str) -> str:
    """Schreiber's sum over the joint states, with conditional probabilities."""
    return f"""c3 AS (SELECT {window}, id0, id1, nxt, own, oth, count(*) AS n FROM {source} GROUP BY ALL),
probs AS (SELECT *, sum(n) OVER (PARTITION BY {window}, id0, id1) AS m,
    sum(n) OVER (PARTITION BY {window}, id0, id1, own, oth) AS n_own_oth,
    sum(n) OVER (PARTITION BY {window}, id0, id1, nxt, own) AS n_nxt_own,
    sum(n) OVER (PARTITION BY {window}, id0, id1, own) AS n_own FROM c3),
te AS (SELECT {window}, id0, id1, max(m) AS m,
    sum(n / m * log2((n / n_own_oth) / (n_nxt_own / n_own))) AS value FROM probs GROUP BY ALL)"""


HOURLY_TE = f"""{TYPE_TICKS}, {_samples('1 hour', '')}, {RANGES}, {DIRECTED}, {_textbook('(SELECT *, 0 AS w FROM dir)', 'w')},
span AS (SELECT id0, id1, min(g) - 1 AS g0, max(g) AS g1 FROM dir GROUP BY ALL),
tr AS (SELECT id0, id1, to_timestamp(g0 * 3600)::TIMESTAMP AS window_start,
    to_timestamp((g1 + 1) * 3600)::TIMESTAMP AS window_end, round(value, 6) AS value
  FROM te JOIN span USING (id0, id1) WHERE m + 1 >= 30 AND abs(value) > 1e-9)"""

SLIDING_TE = f"""{TYPE_TICKS}, {_samples('6 hours', '')}, {RANGES}, {DIRECTED},
ends AS (SELECT id0, id1, min(g) AS g0, max(g) AS g1 FROM binned GROUP BY ALL),
wins AS (SELECT d.*, w FROM dir d JOIN (SELECT least(id0, id1) AS a, greatest(id0, id1) AS b,
unnest(generate_series(g0 + 29, g1)) AS w FROM ends) e
ON least(d.id0, d.id1) = a AND greatest(d.id0, d.id1) = b AND d.g BETWEEN w - 28 AND w),
{_textbook('wins', 'w')},
slid AS (SELECT id0, id1, to_timestamp((w - 29) * 21600)::TIMESTAMP AS window_start,
  to_timestamp((w + 1) * 21600)::TIMESTAMP AS window_end, round(value, 6) AS value
  FROM te WHERE abs(value) > 1e-9)"""

REQUESTS = """req AS (SELECT s_suppkey AS ticket, TIMESTAMP '1996-01-01' + to_months(CAST(s_suppkey % 24 AS INTEGER)) AS start_ts,
    TIMESTAMP '1996-01-01' + to_months(CAST(s_suppkey % 24 AS INTEGER)) + INTERVAL 12 MONTH AS end_ts,
    ['NATION_' || s_nationkey, 'NATION_' || ((s_nationkey + 7) % 25)] AS players FROM supplier)"""

SNAPSHOT = f"""{NATION_SPANS}, q AS (SELECT DISTINCT date_trunc('quarter', o_orderdate)::TIMESTAMP AS start_ts FROM orders),
snap AS (SELECT strftime(start_ts, '%Y-%m') AS query_id, start_ts, v0, v1 FROM q LEFT JOIN spans
  ON valid_from <= start_ts AND (valid_to IS NULL OR start_ts < valid_to)),
snapj AS (SELECT query_id, start_ts, 'snapshots:[{{"time":"' || strftime(start_ts, '%m/%d/%Y,%H:%M:%S') || '","edges":[' ||
    coalesce(string_agg('{{"v0":"' || v0 || '","v1":"' || v1 || '"}}', ',' ORDER BY v0, v1), '') || ']}}]' AS snapshot FROM snap GROUP BY query_id, start_ts)"""

PATHS = f"""{NATION_SPANS}, pq AS (SELECT s_suppkey AS query_id, 'NATION_' || s_nationkey AS source,
    'NATION_' || ((s_nationkey + 1 + s_suppkey % 24) % 25) AS target,
    ['SHORTEST', 'CONTINUOUS', 'EARLIEST', 'REACHABILITY'][CAST(s_suppkey % 4 + 1 AS INTEGER)] AS type,
    TIMESTAMP '1996-01-01' + to_months(CAST(s_suppkey % 36 AS INTEGER)) AS s,
    CASE WHEN s_suppkey % 5 = 0 THEN INTERVAL 0 MONTH ELSE INTERVAL 3 MONTH END AS len FROM supplier),
pq2 AS (SELECT *, s + len AS e, CASE WHEN s_suppkey_instant THEN s + INTERVAL 1 MICROSECOND ELSE s + len END AS e2
  FROM (SELECT *, query_id % 5 = 0 AS s_suppkey_instant FROM pq)),
ways AS (SELECT v0 AS src, v1 AS dst, valid_from, coalesce(valid_to, TIMESTAMP '9999-01-01') AS valid_to FROM spans
         UNION ALL SELECT v1, v0, valid_from, coalesce(valid_to, TIMESTAMP '9999-01-01') FROM spans),
-- instants at which a lifespan inside a query's period can start; the graph is static at each
moments AS (SELECT query_id, type, source, target, s, e2, s AS lo FROM pq2 WHERE source <> target
  UNION SELECT query_id, type, source, target, s, e2, valid_from FROM pq2 JOIN ways ON valid_from > s AND valid_from < e2
  WHERE type <> 'CONTINUOUS' AND source <> target),
live AS (SELECT query_id, lo, src, dst, greatest(s, valid_from) AS a, least(e2, valid_to) AS b
  FROM moments JOIN ways ON CASE WHEN type = 'CONTINUOUS' THEN valid_from <= s AND valid_to >= e2
    ELSE valid_from <= lo AND valid_to > lo END),
flood AS (SELECT query_id, lo, source AS node, 0 AS hops FROM moments
  UNION
  SELECT f.query_id, f.lo, dst, hops + 1 FROM flood f JOIN live l ON l.query_id = f.query_id AND l.lo = f.lo AND src = node
  WHERE hops < 25),
near AS (SELECT query_id, lo, node, min(hops) AS hops FROM flood GROUP BY ALL),
chosen AS (SELECT n.query_id, n.lo, n.hops, m.source, m.target, m.s, m.e2 FROM near n JOIN moments m
  ON m.query_id = n.query_id AND m.lo = n.lo AND m.target = n.node
  QUALIFY row_number() OVER (PARTITION BY n.query_id ORDER BY CASE WHEN type = 'EARLIEST' THEN n.lo END, n.hops, n.lo) = 1),
trails AS (SELECT query_id, lo AS at, source AS node, [source] AS path, s AS lo, e2 AS hi, 0 AS k FROM chosen
  UNION ALL
  SELECT t.query_id, t.at, dst, list_append(path, dst), greatest(t.lo, l.a), least(t.hi, l.b), k + 1 FROM trails t
  JOIN live l ON l.query_id = t.query_id AND l.lo = t.at AND l.src = t.node
  JOIN near n ON n.query_id = t.query_id AND n.lo = t.at AND n.node = l.dst AND n.hops = k + 1
  JOIN chosen c ON c.query_id = t.query_id WHERE k < c.hops),
best AS (SELECT t.* FROM trails t JOIN chosen c ON c.query_id = t.query_id AND t.node = c.target
  QUALIFY row_number() OVER (PARTITION BY t.query_id ORDER BY path) = 1),
ans AS (SELECT pq2.query_id, CAST(best.path IS NOT NULL AS INTEGER) AS path_found,
    array_to_string(best.path, '>') AS path, array_to_string(best.path, ',') AS listed, best.lo AS start_ts,
    CASE WHEN s_suppkey_instant THEN best.lo ELSE best.hi END AS end_ts
  FROM pq2 LEFT JOIN best ON best.query_id = pq2.query_id)"""


def _decimals(value: str) -> str:
    return f"regexp_replace(CAST(CAST({value} AS DECIMAL(38,6)) AS VARCHAR), '\\.?0+$', '')"


def all_oracles() -> dict[str, str]:
    accepted = "event_id % 50 NOT IN (7, 11)"
    known_time = _SECOND + "::TIMESTAMP"
    return {
        "parse_ticks": f"""SELECT event_id AS seq, event_type AS symbol, {known_time} AS ts, value,
            CAST(CASE WHEN event_id % 50 = 13 THEN 0 ELSE event_id % 90 END AS INTEGER) AS volume
            FROM events WHERE {accepted}""",
        "parse_ticks_rejects": f"WITH {LINES} SELECT value AS line FROM lines WHERE seq % 50 IN (7, 11)",
        "parse_ticks_with_arrival": f"""SELECT event_id + 1700000000123 AS arrival_ms, event_type AS symbol,
            {known_time} AS ts, value,
            CAST(CASE WHEN event_id % 50 = 13 THEN 0 ELSE event_id % 90 END AS INTEGER) AS volume
            FROM events WHERE {accepted}""",
        "feed_quotes": f"""SELECT concat_ws(',', CAST(event_id AS VARCHAR), {_T}, CAST(value AS VARCHAR),
            CAST(event_id % 90 AS VARCHAR)) AS value FROM events WHERE event_type IN ('click', 'purchase')""",
        "feed_symbols": """SELECT CAST(event_id AS VARCHAR) AS symbol, 'NASDAQ·signup·NoExpiry' AS name
            FROM events WHERE event_type = 'signup'""",
        "feed_depth_and_errors": """SELECT 'DEPTH,' || event_id || ',1,2' AS message, 'depth' AS route
            FROM events WHERE event_type = 'view'
            UNION ALL SELECT 'ERROR,' || event_id, 'errors' FROM events WHERE event_type = 'error'
            UNION ALL SELECT 'NYSE|a|b|c|d', 'errors' FROM events WHERE event_type = 'signup'""",
        "read_symbol_list": """SELECT 'NASDAQ·' || c_name || '·NoExpiry' AS symbol FROM customer
            WHERE c_custkey % 10 <> 0""",
        "parse_edge_log": f"WITH {NATION_EVENTS} SELECT v0, v1, ts, is_add FROM ev WHERE month(ts) <> 7",
        "parse_edge_log_rejects": f"WITH {NATION_EVENTS}, {EDGE_LINES} SELECT value AS line FROM elines WHERE month(ts) = 7",
        "read_edge_files": f"WITH {NATION_EVENTS}, {EDGE_LINES} SELECT value FROM elines",
        "symbol_key": """SELECT event_id AS seq, CASE WHEN event_id % 5 IN (0, 1) THEN '' ELSE event_type END AS symbol
            FROM events""",
        "parse_player_commands": f"WITH {COMMANDS} SELECT * FROM cmd",
        "parse_snapshot_queries": f"""SELECT event_id AS query_id, {known_time} AS start_ts, {known_time} AS end_ts
            FROM events WHERE event_type IN ('click', 'view')""",
        "parse_path_queries": f"""SELECT event_id AS query_id, {known_time} AS start_ts,
            {known_time} + INTERVAL 1 HOUR AS end_ts, CAST(user_id AS VARCHAR) AS source,
            CAST(user_id + 1 AS VARCHAR) AS target,
            CASE WHEN event_id % 3 = 0 THEN 'SHORTEST' ELSE 'EARLIEST' END AS type
            FROM events WHERE event_type = 'signup' AND event_id % 7 <> 0""",
        "parse_graph_query_rejects": f"""SELECT {_T} || ',' || user_id AS line FROM events
            WHERE event_type = 'purchase'
            UNION ALL SELECT {_T} || ',' || strftime(ts + INTERVAL 1 HOUR, '%m/%d/%Y,%H:%M:%S') || ',' || user_id
              || ',' || (user_id + 1) || ',unknown' FROM events WHERE event_type = 'signup' AND event_id % 7 = 0""",
        "parse_recommendations": f"""SELECT CAST(user_id AS VARCHAR) AS stock, value AS impact, {known_time} AS ts,
            'kw+' || event_type AS keywords,
            unnest([CAST(user_id AS VARCHAR), CAST((user_id + 1) % 15 AS VARCHAR)]) AS related_stock
            FROM events WHERE event_type <> 'error'""",
        "clamp_out_of_order": f"WITH {LATE_TICKS} SELECT seq, symbol, ts, value FROM clamped",
        "dedup_same_timestamp": f"WITH {LATE_TICKS} SELECT seq, symbol, ts, value FROM ticks",
        "filter_known_symbols": f"""WITH {USER_TICKS} SELECT seq, symbol, ts, value FROM ticks
            WHERE symbol IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)""",
        "filter_known_symbols_from_arrival": f"""WITH {USER_TICKS} SELECT seq, symbol, ts, value FROM ticks
            WHERE symbol IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 0)
            AND ts >= (SELECT min(TIMESTAMP '2024-01-05' + to_days(CAST(c_custkey % 20 AS INTEGER)))
              FROM customer WHERE c_acctbal > 0)""",
        **dict.fromkeys(("filter_focus_players", "filter_focus_players_merged"), f"""WITH {USER_TICKS}, {COMMANDS}
            SELECT seq, symbol, t.ts FROM ticks t ASOF JOIN cmd c ON t.symbol = c.player AND t.ts >= c.ts
            WHERE c.is_add"""),
        "attach_symbol_names": f"""WITH {USER_TICKS} SELECT seq, symbol, c_name AS name FROM ticks
            LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = symbol AND c_custkey % 3 <> 0""",
        "drop_repeated_records": f"""WITH {TYPE_TICKS} SELECT symbol, seq FROM (
            SELECT *, lag(symbol) OVER (ORDER BY seq) AS p FROM ticks) WHERE symbol IS DISTINCT FROM p""",
        "limit_symbols": f"""WITH {USER_TICKS} SELECT seq, symbol FROM ticks WHERE symbol IN (
            SELECT symbol FROM ticks GROUP BY symbol ORDER BY min(seq) LIMIT 20)""",
        "subscribe_pairs": f"""WITH {NATION}, log AS (
            SELECT least(a, b) AS a, greatest(a, b) AS b, ts, max_by(on_, seq) AS on_ FROM (
              SELECT 'NATION_' || (o_custkey % 25) AS a, 'NATION_' || ((o_custkey // 25) % 25) AS b,
                o_orderdate AS ts, o_orderstatus = 'F' AS on_, o_orderkey AS seq FROM orders)
            WHERE a <> b GROUP BY 1, 2, 3)
            SELECT id0, id1, window_end, round(value, 6) AS value FROM nr ASOF JOIN log
            ON nr.id0 = log.a AND nr.id1 = log.b AND nr.window_end >= log.ts WHERE on_""",
        "tag_kind": f"""WITH base AS (SELECT 'f' AS kind, * FROM ({_ticks('event_type')})
              UNION ALL SELECT 'w', * FROM ({_ticks('CAST(user_id % 7 AS VARCHAR)')})),
            iv AS (SELECT kind, symbol, begin_ts, ts AS end_ts, CAST(cents - prev AS DOUBLE) AS delta FROM (
              SELECT *, lag(ts) OVER w AS begin_ts, lag(cents) OVER w AS prev FROM base
              WINDOW w AS (PARTITION BY kind, symbol ORDER BY ts)) WHERE begin_ts IS NOT NULL),
            ss AS (SELECT kind, symbol, sum(delta * delta) AS s FROM iv GROUP BY ALL HAVING sum(delta * delta) > 0),
            num AS (SELECT a.kind, a.symbol AS id0, b.symbol AS id1, sum(a.delta * b.delta) AS n FROM iv a JOIN iv b
              ON a.kind = b.kind AND a.symbol < b.symbol AND a.begin_ts < b.end_ts AND b.begin_ts < a.end_ts GROUP BY ALL)
            SELECT a.kind, a.symbol AS id0, b.symbol AS id1,
              round(greatest(least(coalesce(n, 0) / (sqrt(a.s) * sqrt(b.s)), 1.0), -1.0), 6) AS value
            FROM ss a JOIN ss b ON a.kind = b.kind AND a.symbol < b.symbol
            LEFT JOIN num ON num.kind = a.kind AND num.id0 = a.symbol AND num.id1 = b.symbol""",
        "tick_intervals": f"WITH {USER_TICKS}, {INTERVALS} SELECT * FROM iv",
        "symbol_pairs": """WITH s AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS symbol FROM events)
            SELECT a.symbol AS id0, b.symbol AS id1 FROM s a JOIN s b ON a.symbol < b.symbol""",
        "overlap_join": f"WITH {TYPE_TICKS}, {INTERVALS}, {OVERLAPS} SELECT * FROM ov",
        "hy_correlation": f"""WITH {TYPE_TICKS}, {INTERVALS}, {OVERLAPS}, {CORRELATION}
            SELECT id0, id1, round(value, 6) AS value FROM corr""",
        "hy_correlation_users": f"""WITH {USER_TICKS}, {INTERVALS}, {OVERLAPS}, {CORRELATION}
            SELECT id0, id1, round(value, 6) AS value FROM corr""",
        "hy_correlation_sliding": f"WITH {TYPE_WINDOWS} SELECT * FROM win",
        "hy_correlation_sliding_spike": f"""WITH ticks AS (SELECT event_type AS symbol, ts, event_id AS seq,
              CASE WHEN event_id % 509 = 7 THEN value * 1e6 ELSE value END AS cents FROM events),
            {INTERVALS}, {OVERLAPS}, {_windows('1 day', '6 hours')} SELECT * REPLACE (CASE WHEN value = 0 THEN 0.0::DOUBLE ELSE value END AS value) FROM win""",
        "hy_correlation_stream": f"WITH {TYPE_WINDOWS} SELECT * FROM win",
        "hy_correlation_sliding_with_parameter": f"WITH {TYPE_TICKS}, {INTERVALS}, {OVERLAPS}, {SIZED_WINDOWS}",
        "hy_correlation_late": f"WITH {LATE_TICKS}, {INTERVALS}, {OVERLAPS}, {_windows('2 days', '12 hours')} SELECT * FROM win",
        "pairwise_measure": f"WITH {TYPE_TICKS}, {INTERVALS}, {OVERLAPS}, {_windows('5 days', '1 day')} SELECT * FROM win",
        "sample_basic_windows": f"WITH {USER_TICKS}, {_samples('6 hours', '')} SELECT symbol, g, value FROM smp",
        "discretize": f"WITH {TYPE_TICKS}, {_samples('1 hour', '')}, {RANGES} SELECT * FROM binned",
        "transfer_entropy": f"WITH {HOURLY_TE} SELECT * FROM tr",
        "transfer_entropy_sliding": f"WITH {SLIDING_TE} SELECT * FROM slid",
        "transfer_entropy_stream": f"""WITH {SLIDING_TE} SELECT * FROM slid
            WHERE epoch_ms(window_end) < (SELECT epoch_ms(max(ts)) FROM ticks)""",
        "emit_on_change": f"""WITH RECURSIVE {TYPE_WINDOWS},
            num_rows AS (SELECT id0, id1, window_end, value,
              row_number() OVER (PARTITION BY id0, id1 ORDER BY window_end) AS rn FROM win),
            steps AS (SELECT id0, id1, window_end, value, rn, value AS last, true AS hit FROM num_rows WHERE rn = 1
              UNION ALL
              SELECT n.id0, n.id1, n.window_end, n.value, n.rn,
                CASE WHEN abs(n.value - last) > 0.2::DOUBLE * abs(last) THEN n.value ELSE last END,
                abs(n.value - last) > 0.2::DOUBLE * abs(last)
              FROM steps s JOIN num_rows n ON n.id0 = s.id0 AND n.id1 = s.id1 AND n.rn = s.rn + 1)
            SELECT id0, id1, window_end, value FROM steps WHERE hit AND value <> 0""",
        "emit_on_change_nulls": f"""WITH RECURSIVE {TYPE_WINDOWS},
            num_rows AS (SELECT id0, id1, window_end, value,
              row_number() OVER (PARTITION BY id0, id1 ORDER BY window_end) AS rn FROM win WHERE hour(window_end) < 18),
            steps AS (SELECT id0, id1, window_end, value, rn, value AS last, true AS hit FROM num_rows WHERE rn = 1
              UNION ALL
              SELECT n.id0, n.id1, n.window_end, n.value, n.rn,
                CASE WHEN abs(n.value - last) > 0.2::DOUBLE * abs(last) THEN n.value ELSE last END,
                abs(n.value - last) > 0.2::DOUBLE * abs(last)
              FROM steps s JOIN num_rows n ON n.id0 = s.id0 AND n.id1 = s.id1 AND n.rn = s.rn + 1)
            SELECT id0, id1, window_end, value FROM steps WHERE hit AND value <> 0""",
        "canonical_edge": """SELECT event_id, least(event_type, CAST(user_id AS VARCHAR)) AS v0,
            greatest(event_type, CAST(user_id AS VARCHAR)) AS v1 FROM events""",
        "edge_changes": f"WITH {TYPE_WINDOWS}, {_changes('win', '0.08', 'ev')} SELECT * FROM ev",
        "edge_changes_transfer": f"""WITH {SLIDING_TE}, one AS (SELECT least(id0, id1) AS id0, greatest(id0, id1) AS id1,
              window_end, max(abs(value)) AS value FROM slid GROUP BY ALL),
            {_changes('one', '0.5', 'ev')} SELECT * FROM ev""",
        "edge_changes_with_parameter": f"""WITH {TYPE_WINDOWS}, {PARAMS}, lim AS (
            SELECT win.*, coalesce(p.value, 0.7) AS t FROM win ASOF LEFT JOIN
              (SELECT ts, value FROM plog WHERE name = 'correlationThreshold') p ON win.window_end >= p.ts),
            {_changes('lim', 't', 'ev')} SELECT * FROM ev""",
        "edge_changes_stream_with_parameter": f"""WITH {TYPE_WINDOWS}, {PARAMS}, lim AS (
            SELECT win.*, coalesce(p.value, 0.7) AS t FROM win ASOF LEFT JOIN
              (SELECT ts, value FROM plog WHERE name = 'correlationThreshold') p ON win.window_end >= p.ts),
            {_changes('lim', 't', 'ev')} SELECT * FROM ev WHERE epoch_ms(ts) < -172800000 + (
              SELECT greatest((SELECT epoch_ms(max(window_end)) FROM win), (SELECT epoch_ms(max(ts)) FROM plog WHERE name = 'correlationThreshold')))""",
        "edge_intervals": f"WITH {NATION_SPANS} SELECT * FROM spans",
        "vertex_first_seen": f"""WITH {NATION_EVENTS} SELECT v, min(ts) AS first_seen FROM (
            SELECT v0 AS v, ts FROM ev WHERE is_add UNION ALL SELECT v1, ts FROM ev WHERE is_add) GROUP BY v""",
        "symmetrize": f"""WITH {NATION_EVENTS} SELECT v0 AS src, v1 AS dst, ts, is_add FROM ev
            UNION ALL SELECT v1, v0, ts, is_add FROM ev""",
        "expected_visits": f"""WITH RECURSIVE {NATION_GRAPH},
            deg AS (SELECT src, count(*) AS d FROM adj GROUP BY src),
            w AS (SELECT adj.src, dst, 0.8::DOUBLE / d AS p FROM adj JOIN deg ON deg.src = adj.src),
            x AS (SELECT 0 AS k, src AS node, 1.0::DOUBLE AS v FROM deg
              UNION ALL
              SELECT k + 1, dst, 1.0 + sum(v * p) FROM x JOIN w ON w.src = node WHERE k < 50 GROUP BY k, dst)
            SELECT node, round(v * 10, 4) AS visits FROM x WHERE k = 50""",
        "visit_counts_mc": f"""WITH RECURSIVE {NATION_GRAPH},
            idx AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS i,
              count(*) OVER (PARTITION BY src) AS d FROM adj),
            deg AS (SELECT DISTINCT src, d FROM idx),
            walk AS (SELECT src || '#' || r AS walk_id, 0 AS step, src AS node, d FROM deg, range(10) t(r)
              UNION ALL
              SELECT walk_id, step + 1, dst, deg.d FROM walk JOIN idx ON idx.src = node
                AND i = least(CAST(floor({_draw('edge')} * walk.d) AS BIGINT), walk.d - 1)
              JOIN deg ON deg.src = dst WHERE {_draw('stop')} >= 0.2)
            SELECT node, count(*) AS visits FROM walk GROUP BY node""",
        **dict.fromkeys(("update_walks", "update_walks_incremental"), f"""WITH RECURSIVE {NATION_EVENTS},
            last_ts AS (SELECT max(ts) AS t FROM ev),
            was AS (SELECT v0, v1 FROM ev, last_ts WHERE ts < t GROUP BY v0, v1 HAVING arg_max(is_add, ts)),
            old AS (SELECT v0 AS src, v1 AS dst FROM was UNION ALL SELECT v1, v0 FROM was),
            chg AS (SELECT v0 AS src, v1 AS dst, is_add FROM ev, last_ts WHERE ts = t
              UNION ALL SELECT v1, v0, is_add FROM ev, last_ts WHERE ts = t),
            now AS (SELECT src, dst FROM old UNION SELECT src, dst FROM chg WHERE is_add
              EXCEPT SELECT src, dst FROM chg WHERE NOT is_add),
            added AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS j FROM (
              SELECT src, dst FROM chg WHERE is_add EXCEPT SELECT src, dst FROM old)),
            idx AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS i FROM old),
            nidx AS (SELECT src, dst, row_number() OVER (PARTITION BY src ORDER BY dst) - 1 AS i FROM now),
            deg AS (SELECT src, count(*) AS d FROM old GROUP BY src),
            ndeg AS (SELECT src, count(*) AS d FROM now GROUP BY src),
            walk AS (SELECT src || '#' || r AS walk_id, 0 AS step, src AS node, d FROM deg, range(10) t(r)
              UNION ALL
              SELECT walk_id, step + 1, dst, deg.d FROM walk JOIN idx ON idx.src = node
                AND i = least(CAST(floor({_draw('edge')} * walk.d) AS BIGINT), walk.d - 1)
              JOIN deg ON deg.src = dst WHERE {_draw('stop')} >= 0.2),
            hops AS (SELECT *, lead(node) OVER (PARTITION BY walk_id ORDER BY step) AS next_node FROM walk),
            met AS (SELECT walk_id, step, node, coalesce(n.d, 0) AS nd, coalesce(g.gained, 0) AS gained,
                EXISTS (SELECT 1 FROM chg c WHERE NOT c.is_add AND c.src = node AND c.dst = next_node) AS broken,
                next_node IS NOT NULL AND {_draw('reroute', 8)} * coalesce(n.d, 0) < coalesce(g.gained, 0) AS through
              FROM hops LEFT JOIN ndeg n ON n.src = node
              LEFT JOIN (SELECT src, count(*) AS gained FROM added GROUP BY src) g ON g.src = node
              WHERE node IN (SELECT src FROM chg)),
            cut AS (SELECT * FROM met WHERE broken OR through QUALIFY row_number() OVER (PARTITION BY walk_id ORDER BY step) = 1),
            turned AS (SELECT walk_id, step, coalesce(a.dst, n.dst) AS dst FROM cut
              LEFT JOIN nidx n ON broken AND n.src = node AND n.i = CAST(floor({_draw('edge', 8, '1')} * nd) AS BIGINT)
              LEFT JOIN added a ON NOT broken AND a.src = node AND a.j = CAST(floor({_draw('edge', 8, '1')} * gained) AS BIGINT)),
            begun AS (SELECT walk_id, 1 AS gen, step + 1 AS step, dst AS node FROM turned WHERE dst IS NOT NULL
              UNION ALL SELECT src || '#' || r, 0, 0, src FROM (SELECT DISTINCT src FROM added WHERE src NOT IN (SELECT src FROM old)), range(10) t(r)),
            anew AS (SELECT walk_id, gen, step, node, coalesce(d, 0) AS d FROM begun LEFT JOIN ndeg ON src = node
              UNION ALL
              SELECT walk_id, gen, step + 1, dst, coalesce(n.d, 0) FROM anew JOIN nidx ON nidx.src = node
                AND i = least(CAST(floor({_draw('edge', 8, 'gen')} * anew.d) AS BIGINT), anew.d - 1)
              LEFT JOIN ndeg n ON n.src = dst WHERE {_draw('stop', 8, 'gen')} >= 0.2)
            SELECT node, count(*) AS visits FROM (
              SELECT w.node FROM walk w LEFT JOIN cut USING (walk_id) WHERE cut.step IS NULL OR w.step <= cut.step
              UNION ALL SELECT node FROM anew) GROUP BY node"""),
        "update_walks_checks": f"""WITH {NATION_SPANS}, last_ts AS (SELECT max(ts) AS t FROM ev)
            SELECT DISTINCT v AS node, CAST(10 AS BIGINT) AS starts, CAST(0 AS BIGINT) AS duplicates,
              CAST(0 AS BIGINT) AS dead_hops FROM (
              SELECT unnest([v0, v1]) AS v FROM ev, last_ts WHERE ts = t
              UNION ALL SELECT unnest([v0, v1]) FROM spans, last_ts WHERE valid_from < t AND (valid_to IS NULL OR valid_to >= t))""",
        "latest_visits": f"WITH {VISITS} SELECT node, max_by(visits, seq) AS visits FROM upd GROUP BY node",
        "top_hubs": f"""WITH {VISITS}, l AS (SELECT node, max_by(visits, seq) AS visits FROM upd GROUP BY node)
            SELECT CAST(row_number() OVER (ORDER BY visits DESC, node) AS INTEGER) AS rank, node, visits
            FROM l ORDER BY rank LIMIT 10""",
        "top_hubs_windowed": f"""WITH {WINDOWED_VISITS} SELECT w AS window_start, w + INTERVAL 6 HOUR AS window_end,
            CAST(rank AS INTEGER) AS rank, node, visits FROM ranked WHERE rank <= 3""",
        "top_hubs_stream": f"""WITH {WINDOWED_VISITS} SELECT w AS window_start, w + INTERVAL 6 HOUR AS window_end,
            CAST(rank AS INTEGER) AS rank, node, visits FROM ranked
            WHERE rank <= 3 AND w + INTERVAL 6 HOUR <= (SELECT max(upd.ts) FROM upd) - INTERVAL 1 HOUR""",
        "top_hubs_windowed_with_parameter": f"""WITH {WINDOWED_VISITS}, {PARAMS}, periods AS (
            SELECT DISTINCT w, w + INTERVAL 6 HOUR AS closes FROM latest),
            sized AS (SELECT w, coalesce(p.value, 10) AS k FROM periods ASOF LEFT JOIN
              (SELECT ts, value FROM plog WHERE name = 'hubListSize') p ON closes >= p.ts),
            ks AS (SELECT w, k FROM sized)
            SELECT w AS window_start, w + INTERVAL 6 HOUR AS window_end,
            CAST(rank AS INTEGER) AS rank, node, visits FROM ranked JOIN ks USING (w) WHERE rank <= k""",
        "top_hubs_windowed_with_period": f"""WITH RECURSIVE {VISITS}, {PARAMS}, {PERIOD_SIGNALS}
            SELECT w AS window_start, closes AS window_end, CAST(rank AS INTEGER) AS rank, node, visits
            FROM ranked JOIN sized USING (w) WHERE rank <= k""",
        "snapshot_at": f"WITH {SNAPSHOT} SELECT query_id, start_ts, v0, v1 FROM snap",
        "snapshot_with_ticket": f"""WITH {NATION_SPANS}, q AS (SELECT query_id, s AS start_ts,
              CASE WHEN month(s) = 5 THEN 't' || query_id END AS ticket FROM (
                SELECT DISTINCT strftime(date_trunc('quarter', o_orderdate), '%Y-%m') AS query_id,
                  date_trunc('quarter', o_orderdate)::TIMESTAMP - INTERVAL 8 MONTH AS s FROM orders))
            SELECT query_id, start_ts, ticket, v0, v1 FROM q LEFT JOIN spans
              ON valid_from <= start_ts AND (valid_to IS NULL OR start_ts < valid_to)""",
        "snapshot_before_history": f"""WITH {NATION_SPANS}, q AS (SELECT DISTINCT
              date_trunc('quarter', o_orderdate)::TIMESTAMP AS s FROM orders)
            SELECT strftime(s, '%Y-%m') AS query_id, s - INTERVAL 3 YEAR AS start_ts, v0, v1 FROM q LEFT JOIN spans
              ON valid_from <= s - INTERVAL 3 YEAR AND (valid_to IS NULL OR s - INTERVAL 3 YEAR < valid_to)""",
        "snapshots_between": f"""WITH {NATION_SPANS},
            q AS (SELECT DISTINCT date_trunc('quarter', o_orderdate)::TIMESTAMP AS s FROM orders),
            pts AS (SELECT s, s AS ts FROM q UNION SELECT s, c.ts FROM q JOIN (
              SELECT valid_from AS ts FROM spans UNION SELECT valid_to FROM spans WHERE valid_to IS NOT NULL) c
              ON c.ts >= s AND c.ts < s + INTERVAL 2 MONTH)
            SELECT strftime(s, '%Y-%m') AS query_id, ts, v0, v1 FROM pts LEFT JOIN spans
              ON valid_from <= ts AND (valid_to IS NULL OR ts < valid_to)""",
        "snapshot_json": f"""WITH {SNAPSHOT} SELECT query_id, start_ts, CAST(0 AS BIGINT) AS part,
            CAST(1 AS BIGINT) AS parts, snapshot FROM snapj""",
        "paths": f"WITH RECURSIVE {PATHS} SELECT query_id, path_found, path, start_ts, end_ts FROM ans",
        "format_correlation": f"""WITH {TYPE_WINDOWS} SELECT 'f,' || id0 || ',' || id1 || ',' ||
            strftime(window_end, '%m/%d/%Y,%H:%M:%S') || ',' || {_decimals('value')} AS line FROM win""",
        "format_web": f"""SELECT 'w,' || user_id || ',' || {_T} || ',' || value AS line FROM events""",
        "format_transfer": f"""WITH {HOURLY_TE} SELECT 'te,' || CASE WHEN id0 < id1 THEN 'te_replay_response,7,'
            ELSE 'te_response,' END || id0 || ',' || id1 || ',' ||
            strftime(window_end, '%m/%d/%Y,%H:%M:%S') || ',' || {_decimals('value')} AS line FROM tr""",
        "format_hubs": f"""WITH {WINDOWED_VISITS} SELECT 'hubList,' || string_agg(node, ',' ORDER BY rank) AS line
            FROM ranked WHERE rank <= 3 GROUP BY w""",
        "format_focus_edges": f"""WITH {NATION_EVENTS} SELECT 'focusPip,' || month(ts) || ',resultsNodes_response,' ||
            v0 || ',' || v1 || ',' || {_T} || ',' || CASE WHEN is_add THEN '1' ELSE '0' END AS line FROM ev""",
        "format_focus_suggestions": f"""SELECT 'focusPip,suggestion_response,' || user_id || ',' || value || ',' || {_T}
            || ',kw;' || event_type || ',' || user_id || ';' || ((user_id + 1) % 15) AS line
            FROM events WHERE event_type <> 'error'""",
        "format_snapshots": f"WITH {SNAPSHOT} SELECT 'snapshots,snapshot_response,1/1,' || snapshot AS line FROM snapj",
        "format_paths": f"""WITH RECURSIVE {PATHS} SELECT 'snapshots,path_response,' || CASE WHEN path_found = 1
            THEN '1,' || strftime(start_ts, '%m/%d/%Y,%H:%M:%S') || ',' || strftime(end_ts, '%m/%d/%Y,%H:%M:%S')
              || ',' || listed ELSE 'No path' END AS line FROM ans""",
        "write_results": f"SELECT 'w,' || event_type || ',' || {_T} || ',' || value AS line FROM events",
        "throughput": """SELECT date_trunc('minute', ts)::TIMESTAMP AS window_start,
            date_trunc('minute', ts)::TIMESTAMP + INTERVAL 1 MINUTE AS window_end,
            round(count(*) / 60.0::DOUBLE, 6) AS tuples_per_sec FROM events GROUP BY 1, 2""",
        **dict.fromkeys(("replay_selection", "replay_stored"), f"""WITH {NATION}, {REQUESTS} SELECT ticket, id0, id1, window_end, round(value, 6) AS value
            FROM nr JOIN req ON window_end BETWEEN start_ts AND end_ts
            AND (list_contains(players, id0) OR list_contains(players, id1))"""),
        **dict.fromkeys(("with_parameter", "with_parameter_merged"), f"""WITH {TYPE_TICKS}, {PARAMS}
            SELECT seq, ticks.ts, coalesce(p.value, 0.7) AS "correlationThreshold" FROM ticks ASOF LEFT JOIN
              (SELECT ts, value FROM plog WHERE name = 'correlationThreshold') p ON ticks.ts >= p.ts"""),
    }
