"""ANSI SQL for the registered queries, over the same tables."""

from __future__ import annotations

ORIGIN = "TIMESTAMP '2024-01-01'"
LO, HI = 0, 20
DAYS = {"1d": 1, "3d": 3, "23d": 23, "full": 30}

EVENTS = """
t AS (
  SELECT event_id, ts AS event_ts, user_id AS vault_id, value AS temp,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS failure,
         'M' || (user_id % 5) AS model,
         json_extract_string(props, '$.k') AS serial_number
  FROM events
)"""

RETURNS = """
t AS (
  SELECT l_shipdate AS event_ts, l_suppkey AS vault_id,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS failure,
         'L' || l_linenumber AS model,
         CAST(l_partkey AS VARCHAR) AS serial_number
  FROM lineitem
)"""


def bucket(days: int, ts: str = "event_ts", origin: str = ORIGIN) -> str:
    return f"time_bucket(INTERVAL '{days} days', {ts}, {origin})"


def stats(days: int, where: str = "TRUE") -> str:
    return f"""
SELECT {bucket(days)} AS window_start, vault_id, count(*) AS n_tuples,
       avg(temp) AS mean, coalesce(stddev_samp(temp), 0.0) AS stddev
FROM t WHERE {where}
GROUP BY 1, 2"""


def rounded_stats(days: int, where: str = "TRUE", extra: str = "") -> str:
    return f"""
SELECT {extra} window_start, vault_id, n_tuples,
       round(round(mean, 9), 6) AS mean, round(round(stddev, 9), 6) AS stddev
FROM ({stats(days, where)}) s"""


def per_device(days: int, origin: str = ORIGIN) -> str:
    return f"""
SELECT {bucket(days, origin=origin)} AS window_start, vault_id, model, serial_number,
       CAST(sum(failure) AS BIGINT) AS failures, count(*) AS n_tuples
FROM t WHERE failure > 0 GROUP BY 1, 2, 3, 4"""


def totals(days: int, origin: str = ORIGIN) -> str:
    return f"""
SELECT window_start, vault_id, CAST(sum(failures) AS BIGINT) AS group_failures,
       count(*) AS group_devices
FROM ({per_device(days, origin)}) d
GROUP BY 1, 2"""


def ranked(days: int, origin: str = ORIGIN) -> str:
    return f"""
SELECT * FROM (
  SELECT x.*, CAST(row_number() OVER (PARTITION BY window_start
           ORDER BY group_failures DESC, vault_id NULLS FIRST) AS INTEGER) AS rank
  FROM ({totals(days, origin)}) x
) y WHERE rank <= 10"""


def best_of_all(days: int, origin: str = ORIGIN) -> str:
    order = "group_failures DESC, window_start, vault_id NULLS FIRST"
    return f"""
SELECT x.*, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank
FROM ({totals(days, origin)}) x
ORDER BY {order} LIMIT 10"""


def rank(days: int, extra: str = "", origin: str = ORIGIN, groups=ranked) -> str:
    return f"""
SELECT {extra} r.window_start, r.rank, r.vault_id, r.group_failures, r.group_devices,
       d.model, d.serial_number, d.failures, d.n_tuples
FROM ({groups(days, origin)}) r JOIN ({per_device(days, origin)}) d
  ON d.window_start = r.window_start AND d.vault_id IS NOT DISTINCT FROM r.vault_id"""


def lists(days: int, parts: int = 1, groups=ranked) -> str:
    """One row per (window, part, group) with its devices as text."""
    device = "coalesce(model, '') || ',' || coalesce(serial_number, '')"
    order = "ORDER BY model NULLS FIRST, serial_number NULLS FIRST"
    return f"""
SELECT window_start, rank, vault_id, group_failures, group_devices, part,
       CAST(sum(n_tuples) AS BIGINT) AS n_tuples,
       string_agg(device, ',' {order}) AS hdds, string_agg(device, ';' {order}) AS hdd_list
FROM (
  SELECT *, {device} AS device,
         CAST(CAST('0x' || substr(md5({device}), 1, 6) AS INTEGER) % {parts} AS INTEGER) AS part
  FROM ({rank(days, groups=groups)}) x
) y GROUP BY 1, 2, 3, 4, 5, 6"""


def three_decimals(x: str) -> str:
    exact = f"CAST(CAST(round({x}, 9) AS VARCHAR) AS DECIMAL(38, 9))"
    return f"CAST(CAST({exact} AS DECIMAL(38, 3)) AS VARCHAR)"


def stats_lines(days: int, where: str = "TRUE") -> str:
    return f"""
SELECT strftime(window_start, '%Y-%m-%d') || ',' || vault_id || ',' || n_tuples || ',' ||
       {three_decimals('mean')} || ',' || {three_decimals('stddev')} AS line
FROM ({stats(days, where)}) s"""


def rank_lines(parts: int) -> str:
    head = "strftime(window_start, '%Y-%m-%d')" + (" || ',' || part" if parts > 1 else "")
    group = "',' || rank || ','" if parts > 1 else "','"
    group += " || coalesce(CAST(vault_id AS VARCHAR), '') || ',' || group_failures"
    return f"""
SELECT part, {head} || string_agg({group} || ',(' || hdds || ')', '' ORDER BY rank) AS line,
       CAST(sum(n_tuples) AS BIGINT) AS n_tuples
FROM ({lists(1, parts)}) r
GROUP BY window_start, part"""


RANK_LINES = f"SELECT line, n_tuples FROM ({rank_lines(1)}) l"
RANK_LISTS = f"SELECT * EXCLUDE (hdd_list) FROM ({lists(1, 3)}) l"
NULL_KEY = EVENTS.replace("t AS (", "t0 AS (").replace("SELECT event_id,", "SELECT event_type, event_id,") + """,
t AS (
  SELECT event_ts, temp, serial_number,
         CASE WHEN event_type = 'click' THEN NULL ELSE vault_id END AS vault_id,
         CASE WHEN event_type = 'click' THEN NULL ELSE model END AS model,
         CASE WHEN event_type = 'click' THEN 1 ELSE failure END AS failure
  FROM t0
)"""


def wide(days: int, parts: int = 1, groups=ranked) -> str:
    columns = ",\n".join(
        f"""coalesce(max(CAST(vault_id AS VARCHAR)) FILTER (rank = {i}), '') AS vault_id_{i},
       coalesce(max(group_failures) FILTER (rank = {i}), 0) AS group_failures_{i},
       coalesce(max(hdd_list) FILTER (rank = {i}), '') AS hdds_{i}"""
        for i in range(1, 11)
    )
    return f"""
SELECT strftime(window_start, '%Y-%m-%dT%H:%M:%S.%f') AS ts, part,
       {columns}
FROM ({lists(days, parts, groups)}) p
GROUP BY window_start, part"""


PARSED = """
SELECT event_ts, serial_number, model, failure, CAST(vault_id AS INTEGER) AS vault_id,
       temp AS s194_temperature_celsius
FROM t"""

REJECTS = """
SELECT CASE event_type WHEN 'signup' THEN 's194_temperature_celsius'
                       WHEN 'click' THEN 'event_ts'
                       WHEN 'view' THEN 'vault_id'
                       ELSE 'failure' END AS unreadable,
       count(*) AS n_lines
FROM events WHERE event_type <> 'error'
GROUP BY 1"""

NUMBERED = """
n AS (
  SELECT t.*, date_trunc('day', event_ts) AS day,
         row_number() OVER (
           PARTITION BY date_trunc('day', event_ts) ORDER BY event_id) - 1 AS i,
         count(*) OVER (PARTITION BY date_trunc('day', event_ts)) AS n
  FROM t
)"""

STEP = """(86400000000 // n + CASE
    WHEN 2 * (86400000000 % n) > n THEN 1
    WHEN 2 * (86400000000 % n) = n AND (86400000000 // n) % 2 = 1 THEN 1
    ELSE 0 END)"""

RESTAMP = f"SELECT event_id, day + to_microseconds(i * {STEP}) AS event_ts FROM n"
RESTAMP_EXACT = """
SELECT event_id,
       day + to_microseconds(CAST(CAST(i AS HUGEINT) * 86400000000 // n AS BIGINT)) AS event_ts
FROM n"""
EXACT = "to_microseconds(CAST(CAST(i AS HUGEINT) * 86400000000 // n AS BIGINT))"


def line(at: str) -> str:
    return f"""strftime({at}, '%Y-%m-%dT%H:%M:%S.%f') || ',' ||
       serial_number || ',' || model || ',' || failure || ',' || vault_id ||
       repeat(',', 21) || CAST(temp AS VARCHAR) || repeat(',', 13)"""


RESTAMP_LINES = f"SELECT event_id, {line('day + ' + EXACT)} AS value FROM n"
DUPLICATES = """
SELECT failure, day + to_microseconds(CAST(CAST(i AS HUGEINT) * 86400000000 // n AS BIGINT))
         AS event_ts
FROM (
  SELECT failure, date_trunc('day', event_ts) AS day,
         row_number() OVER (PARTITION BY date_trunc('day', event_ts) ORDER BY failure) - 1 AS i,
         count(*) OVER (PARTITION BY date_trunc('day', event_ts)) AS n
  FROM t
) d"""

RATES = """
WITH e AS (
  SELECT event_type AS query, event_id,
         epoch_us(TIMESTAMP '2024-01-01') + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1440 AS us
  FROM events
), s AS (
  SELECT query, max(us) AS us, max(event_id) % 4999 AS counter FROM e GROUP BY query, us // 10000000
), g AS (
  SELECT *, coalesce(CASE WHEN counter < lag(counter) OVER w THEN counter ELSE counter - lag(counter) OVER w END, 0)
           AS grown
  FROM s WINDOW w AS (PARTITION BY query ORDER BY us)
), m AS (
  SELECT *, sum(grown) OVER m - first_value(grown) OVER m AS growth, (us - min(us) OVER m) / 1000000 AS span
  FROM g WINDOW m AS (PARTITION BY query ORDER BY us RANGE BETWEEN 60000000 PRECEDING AND CURRENT ROW)
)
SELECT query, make_timestamp(us) AS ts, counter, round(CASE WHEN span > 0 THEN growth / span END, 6) AS rate FROM m
"""

SENT_ROWS = """
s AS (
  SELECT t.*, CAST(event_ts AS DATE) AS day,
         row_number() OVER (PARTITION BY CAST(event_ts AS DATE) ORDER BY event_ts, event_id) - 1 AS number,
         count(*) OVER (PARTITION BY CAST(event_ts AS DATE)) AS day_rows
  FROM t
)"""
SENT = f"SELECT CAST(day AS VARCHAR) AS day, number, day_rows, {line('event_ts')} AS value FROM s"

COVERAGE = f"""
SELECT window_start, count(*) AS n_results, CAST(sum(n_tuples) AS BIGINT) AS n_tuples
FROM ({stats(1)}) s GROUP BY 1"""
COVERAGE_RANK = f"""
SELECT window_start, count(*) AS n_results, CAST(sum(n_tuples) AS BIGINT) AS n_tuples
FROM ({lists(1)}) r GROUP BY 1"""
LATENCY = f"""
SELECT {bucket(1)} AS window_start, vault_id, count(*) AS n_tuples,
       epoch_us({bucket(1)} + INTERVAL '1 day') // 1000 - epoch_us(max(event_ts)) // 1000
         AS latency_ms
FROM t GROUP BY 1, 2"""

INGEST = f"""
SELECT {bucket(1)} AS window_start, CAST(vault_id AS INTEGER) AS vault_id, count(*) AS n_tuples,
       max(event_ts) + INTERVAL '5 minutes' AS last_arrival
FROM t GROUP BY 1, 2"""

IN_RANGE = f"vault_id BETWEEN {LO} AND {HI}"


def _union(make, days: tuple[int, ...]) -> str:
    return " UNION ALL ".join(
        make(d, extra=f"CAST({d} AS INTEGER) AS window_days,") for d in days
    )


def _restamped_stats_lines(days: int) -> str:
    moved = f"r AS (SELECT vault_id, temp, day + {EXACT} AS event_ts FROM n)"
    body = stats_lines(days, IN_RANGE).replace("FROM t WHERE", "FROM r WHERE")
    return f"WITH {EVENTS}, {NUMBERED}, {moved} {body}"


def _on_events(body: str, *ctes: str) -> str:
    return f"WITH {', '.join([EVENTS, *ctes])} {body}"


ORACLE: dict[str, str] = {
    **{f"stats_{name}": _on_events(rounded_stats(d)) for name, d in DAYS.items()},
    **{
        f"query1_{name}": _on_events(rounded_stats(DAYS[name], IN_RANGE))
        for name in ("1d", "3d", "23d")
    },
    **{f"rank_{name}": _on_events(rank(d)) for name, d in DAYS.items()},
    "global_top10": _on_events(rank(1, groups=best_of_all)),
    "rollup_stats_3d": _on_events(rounded_stats(3)),
    "rollup_rank_3d": _on_events(rank(3)),
    "stats_all_windows": _on_events(_union(rounded_stats, (1, 3, 23))),
    "rank_all_windows": _on_events(_union(rank, (1, 3, 23))),
    "stats_lines_1d": _on_events(stats_lines(1)),
    "rank_lines_1d": _on_events(RANK_LINES),
    "rank_lines_parts_1d": _on_events(rank_lines(3)),
    "rank_lists_parts_1d": _on_events(RANK_LISTS),
    "rank_lines_null_key": f"WITH {NULL_KEY} {RANK_LINES}",
    "rank_wide_1d": _on_events(wide(1)),
    "rank_wide_parts_1d": _on_events(wide(1, 3)),
    "global_wide_3d": _on_events(wide(3, groups=best_of_all)),
    "parse_lines": _on_events(PARSED),
    "parse_rejects": REJECTS,
    "dataset_scan": _on_events(PARSED),
    "dataset_wide_rows": _on_events(f"SELECT {line('event_ts')} || ',a,,c,d,,f' AS value FROM t"),
    "dataset_quotes": _on_events(PARSED.replace(" model,", " 'M\"' || substr(model, 2) AS model,")),
    "restamp_even": _on_events(RESTAMP_EXACT, NUMBERED),
    "restamp_rounded": _on_events(RESTAMP, NUMBERED),
    "restamp_duplicates": _on_events(DUPLICATES),
    "replay_multi_file": _on_events(f"SELECT value FROM ({RESTAMP_LINES}) l", NUMBERED),
    "restamp_exact": _on_events(RESTAMP_EXACT, NUMBERED),
    "restamp_lines": _on_events(RESTAMP_LINES, NUMBERED),
    "coverage_1d": _on_events(COVERAGE),
    "coverage_rank_1d": _on_events(COVERAGE_RANK),
    "latency_1d": _on_events(LATENCY),
    "lineitem_returns_rank": f"WITH {RETURNS} {rank(23, origin="TIMESTAMP '1992-01-01'")}",
    "stream_stats_1d": _on_events(rounded_stats(1, IN_RANGE)),
    "stream_rank_1d": _on_events(rank(1)),
    "stream_rank_documents_1d": _on_events(rank(1)),
    "stream_live_rank_1d": _on_events(rank(1)),
    "stream_global_top10": _on_events(rank(1, groups=best_of_all)),
    "stream_stats_all_windows": _on_events(_union(rounded_stats, (1, 3, 23))),
    "stream_rank_all_windows": _on_events(_union(rank, (1, 3, 23))),
    "stream_delay_3min": _on_events(rounded_stats(1)),
    "progress_1d": "SELECT 'progress_1d' AS query, count(*) + 1 AS input_rows FROM events",
    "parse_ingest": _on_events(INGEST),
    "stream_late_drop": _on_events(rounded_stats(1)),
    "stream_replay_lines_3d": _restamped_stats_lines(3),
    "stream_replay_deliveries": _on_events(rounded_stats(1)),
    "replay_sent_order": _on_events(SENT, SENT_ROWS),
    "stream_stats_file_1d": _on_events(stats_lines(1, IN_RANGE)),
    "stream_routed": REJECTS.replace("WHERE event_type <> 'error'", "").replace(
        "CASE event_type", "CASE event_type WHEN 'error' THEN ''"
    ),
    "rates_1m": RATES,
}
