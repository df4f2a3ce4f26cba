"""DuckDB SQL for the registered queries, written against the given ``events`` table alone."""

from __future__ import annotations

from checks.registry import REPO_METRICS

# The events table as bronze rows; independent of the Spark code it is compared with.
BRONZE = """
base AS (
  SELECT event_id AS src_id, copy, ts, user_id, event_type AS kind, props,
    CASE WHEN event_id % 997 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS event_id,
    CASE WHEN event_id % 499 = 1 THEN NULL
         WHEN event_type = 'click' THEN 'PushEvent'
         WHEN event_type = 'purchase' THEN 'PullRequestEvent'
         WHEN event_type = 'view' THEN 'WatchEvent'
         WHEN event_type = 'signup' THEN 'ForkEvent'
         WHEN event_id % 4 = 0 THEN 'IssuesEvent'
         WHEN event_id % 4 = 1 THEN 'ReleaseEvent'
         WHEN event_id % 4 = 2 THEN 'CreateEvent'
         ELSE 'DeleteEvent' END AS event_type,
    CASE WHEN event_id % 499 = 2 THEN NULL ELSE ts END AS event_ts,
    CASE WHEN event_id % 998 = 2 THEN 'not a time' WHEN event_id % 998 = 501 THEN NULL
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS created_at,
    CASE WHEN user_id % 17 = 0 THEN NULL
         WHEN user_id % 10 = 1 THEN concat('user_', CAST(user_id AS VARCHAR), '[Bot]')
         ELSE concat('user_', CAST(user_id AS VARCHAR)) END AS actor_login,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE concat('org_', CAST(user_id % 7 AS VARCHAR)) END AS org_login,
    CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id % 7 END AS org_id,
    CASE WHEN event_id % 101 = 0 THEN NULL
         ELSE concat('org_', CAST(user_id % 7 AS VARCHAR), '/repo_', CAST(event_id % 23 AS VARCHAR)) END AS repo_name,
    CASE event_id % 5 WHEN 0 THEN 'Python' WHEN 1 THEN 'Go' WHEN 2 THEN 'Rust' WHEN 3 THEN 'Java'
         ELSE NULL END AS repo_language,
    CASE WHEN event_id % 211 = 5 THEN ts - INTERVAL 1 DAY WHEN event_id % 211 = 6 THEN ts + INTERVAL 1 DAY
         ELSE ts END AS file_ts
  FROM (
    SELECT *, 0 AS copy FROM events
    UNION ALL SELECT * REPLACE (CASE WHEN event_id % 350 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END AS ts), 1 AS copy
    FROM events WHERE event_id % 50 = 0)),
bronze AS (
  SELECT src_id, copy, ts, event_id, event_type, created_at, event_ts,
    CASE WHEN src_id % 101 = 0 THEN NULL ELSE src_id % 23 END AS repo_id,
    repo_name,
    CASE WHEN src_id % 101 = 0 THEN NULL ELSE concat('org_', CAST(user_id % 7 AS VARCHAR)) END AS repo_owner,
    org_id, org_login, user_id AS actor_id, actor_login, 'User' AS actor_type,
    CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) + 1000 * copy AS payload_size,
    CAST(NULL AS BIGINT) AS payload_distinct_size,
    CASE WHEN event_type = 'CreateEvent' THEN concat('branch_', CAST(src_id % 5 AS VARCHAR)) END AS payload_ref,
    CASE event_type WHEN 'WatchEvent' THEN 'started' WHEN 'PullRequestEvent' THEN 'opened' END AS payload_action,
    CASE WHEN event_type = 'PullRequestEvent' THEN concat('user_', CAST(user_id AS VARCHAR)) END AS pr_user_login,
    CASE event_type WHEN 'WatchEvent' THEN 'started' END AS watch_action,
    repo_language, CAST(NULL AS VARCHAR) AS repo_created_at,
    CASE WHEN copy = 0 THEN '2024-02-01T00:00:00+00:00' WHEN src_id % 700 = 0 THEN '2024-01-31T18:00:00+00:00'
      ELSE '2024-02-01T06:00:00+00:00' END AS ingest_ts,
    concat(strftime(file_ts, '%Y-%m-%d'), '-', CAST(hour(file_ts) AS VARCHAR), '.json.gz') AS source_file,
    CAST(file_ts AS DATE) AS date, CAST(hour(file_ts) AS VARCHAR) AS hour,
    date_trunc('hour', file_ts) AS file_hour
  FROM base)"""

SILVER = (
    BRONZE
    + """,
silver AS (
  SELECT * FROM (
    SELECT *, CAST(event_ts AS DATE) AS event_day, date_trunc('hour', event_ts) AS event_hour_ts,
      contains(lower(actor_login), '[bot]') AS is_bot,
      row_number() OVER (PARTITION BY event_id ORDER BY ingest_ts) AS rn
    FROM bronze
    WHERE event_id IS NOT NULL AND event_type IS NOT NULL AND event_ts IS NOT NULL) t
  WHERE rn = 1)"""
)

# entity -> (key, metric, filter)
GOLD = {
    "event_type": ("event_type", "event_count", "true"),
    "push_user": ("actor_login", "push_count", "event_type = 'PushEvent' AND NOT is_bot AND actor_login IS NOT NULL"),
    "pr_org": ("org_login", "pr_count", "event_type = 'PullRequestEvent' AND org_login IS NOT NULL"),
    "pr_repo": ("repo_name", "pr_count", "event_type = 'PullRequestEvent' AND repo_name IS NOT NULL"),
}
GOLD_CTES = ",".join(
    f"""
{name}_daily AS (
  SELECT event_day, {key}, CAST(count(*) AS BIGINT) AS {metric} FROM silver WHERE {cond} GROUP BY ALL),
{name}_hourly AS (
  SELECT event_day, event_hour_ts, {key}, CAST(count(*) AS BIGINT) AS {metric} FROM silver WHERE {cond} GROUP BY ALL)"""
    for name, (key, metric, cond) in GOLD.items()
)

LINES = (
    BRONZE
    + """,
lines AS (
  SELECT source_file, date, hour, src_id, copy, event_id, event_type, created_at,
    CASE src_id % 4 WHEN 3 THEN NULL ELSE repo_id END AS repo_id,
    CASE WHEN src_id % 29 = 0 THEN '/' || repo_name WHEN src_id % 29 = 1 THEN 'noslash' ELSE repo_name END AS repo_name,
    CASE WHEN src_id % 58 < 29 THEN 'fallback' END AS owner,
    org_id, org_login, actor_id, actor_login, actor_type,
    CASE WHEN src_id % 13 <> 0 THEN payload_size END AS payload_size, payload_distinct_size,
    CASE WHEN src_id % 13 <> 0 THEN payload_ref END AS payload_ref,
    CASE WHEN src_id % 13 <> 0 THEN payload_action END AS payload_action,
    CASE WHEN src_id % 13 <> 0 THEN pr_user_login END AS pr_user_login,
    CASE WHEN src_id % 13 <> 0 THEN watch_action END AS watch_action,
    repo_language, repo_created_at,
    CASE src_id % 331 WHEN 3 THEN 'bad_json' WHEN 4 THEN 'bad_json' WHEN 5 THEN 'bad_json'
      WHEN 6 THEN 'not_an_object' END AS reason
  FROM bronze),
kept AS (SELECT * FROM lines WHERE reason IS NULL AND (copy = 0 OR event_id IS NULL OR src_id % 350 = 0))"""
)


def _bronze(body: str) -> str:
    return f"WITH {BRONZE}\n{body}"


def _silver(body: str) -> str:
    return f"WITH {SILVER}\n{body}"


def _gold(body: str) -> str:
    return f"WITH {SILVER},{GOLD_CTES}\n{body}"


def _lines(body: str) -> str:
    return f"WITH {LINES}\n{body}"


ORACLE: dict[str, str] = {
    "file_hour_parse": _bronze(
        "SELECT source_file, date AS file_date, hour AS file_hour, CAST(count(*) AS BIGINT) AS row_count "
        "FROM bronze GROUP BY ALL"
    ),
    "json_path_get": (
        "SELECT event_id, regexp_extract(props, '(\\d+)', 1) AS k_text, "
        "CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS below_leaf, "
        "CAST(NULL AS VARCHAR) AS absent FROM events"
    ),
    "to_int_rules": (
        "SELECT event_id, CAST(trunc(value) AS BIGINT) AS number_value, CAST(-trunc(value) AS BIGINT) AS negative_value, "
        "CAST(NULL AS BIGINT) AS text_value, event_id AS padded_value, CAST(1 AS BIGINT) AS flag_value, "
        "CAST(NULL AS BIGINT) AS none_value, CAST(NULL AS BIGINT) AS list_value, CAST(NULL AS BIGINT) AS absent_value "
        "FROM events"
    ),
    "repo_owner": (
        "SELECT event_id, CASE WHEN event_id % 4 = 2 THEN concat('own', CAST(event_id % 7 AS VARCHAR)) "
        "WHEN event_id % 3 = 0 THEN 'fallback' END AS repo_owner FROM events"
    ),
    "watch_action": _bronze(
        "SELECT event_type, watch_action, CAST(count(*) AS BIGINT) AS row_count FROM bronze GROUP BY ALL"
    ),
    "bronze_from_json": _lines(
        """SELECT event_id, event_type, created_at, repo_id, repo_name,
  coalesce(CASE WHEN contains(repo_name, '/') THEN nullif(split_part(repo_name, '/', 1), '') END, owner) AS repo_owner,
  org_id, org_login, actor_id, actor_login, actor_type, payload_size, payload_distinct_size, payload_ref,
  payload_action, pr_user_login, watch_action, repo_language, repo_created_at,
  '2024-02-01T00:00:00+00:00' AS ingest_ts, source_file, date, hour FROM kept"""
    ),
    "bronze_bad_lines": _lines(
        "SELECT source_file, date, hour, reason, src_id % 331 = 5 AS is_blank FROM lines WHERE reason IS NOT NULL"
    ),
    "bronze_dedup": _lines("SELECT source_file, event_id, payload_size FROM kept"),
    "bronze_stats": _lines(
        """SELECT source_file, date, hour,
  CAST(count(*) FILTER (reason IS NULL AND (copy = 0 OR event_id IS NULL OR src_id % 350 = 0)) AS BIGINT) AS rows,
  CAST(count(*) FILTER (reason IS NULL AND copy = 1 AND event_id IS NOT NULL AND src_id % 350 <> 0) AS BIGINT) AS duplicates,
  CAST(count(*) FILTER (reason IS NOT NULL) AS BIGINT) AS bad
FROM lines GROUP BY ALL"""
    ),
    "expected_hours": (
        "SELECT unnest(generate_series(hi - INTERVAL 23 HOUR, hi, INTERVAL 1 HOUR)) AS hour_ts "
        "FROM (SELECT date_trunc('hour', max(ts)) AS hi FROM events)"
    ),
    "missing_hours": (
        "SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_ts FROM "
        "(SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events) "
        "EXCEPT SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'purchase'"
    ),
    "dq_hour_completeness": _bronze(
        """, hours AS (SELECT file_hour AS hour_ts, count(*) AS n, CAST(epoch(file_hour) AS BIGINT) // 3600 % 37 AS f FROM bronze GROUP BY ALL),
told AS (SELECT hour_ts, CASE WHEN f = 11 THEN 0 ELSE 1 END AS files,
  CASE WHEN f NOT IN (5, 9) THEN n + CASE WHEN f = 7 THEN 1 ELSE 0 END END AS ledger_rows,
  CASE WHEN f NOT IN (3, 9) THEN n ELSE 0 END AS stored_rows, f FROM hours)
SELECT hour_ts, CAST(files AS BIGINT) AS files, CAST(ledger_rows AS BIGINT) AS ledger_rows, CAST(stored_rows AS BIGINT) AS stored_rows,
  CASE f WHEN 3 THEN 'lost' WHEN 5 THEN 'unrecorded' WHEN 7 THEN 'count_differs' WHEN 9 THEN 'not_landed' END AS problem FROM told"""
    ),
    "dq_bronze_columns": _bronze(
        """SELECT DISTINCT date, hour, CASE f WHEN 3 THEN 'repo_id' ELSE 'actor_id' END AS "column",
  CASE f WHEN 3 THEN 'missing' ELSE 'string instead of int64' END AS problem
FROM (SELECT date, hour, CAST(epoch(file_hour) AS BIGINT) // 3600 % 37 AS f FROM bronze) WHERE f IN (3, 5)"""
    ),
    "parse_created_at": _bronze("SELECT event_id, created_at, event_ts FROM bronze"),
    "bot_flag": _bronze(
        "SELECT actor_login, contains(lower(actor_login), '[bot]') AS is_bot, CAST(count(*) AS BIGINT) AS row_count "
        "FROM bronze GROUP BY ALL"
    ),
    "silver_events": _silver(
        """SELECT event_id, event_type, created_at, repo_id, repo_name, repo_owner, org_id, org_login, actor_id,
  actor_login, actor_type, payload_size, payload_distinct_size, payload_ref, payload_action, pr_user_login,
  watch_action, repo_language, repo_created_at, ingest_ts, source_file, event_ts, event_hour_ts, is_bot, event_day
FROM silver"""
    ),
    "quarantine_rows": _bronze(
        """SELECT event_id, event_type, created_at, source_file, ingest_ts, CAST(event_ts AS DATE) AS event_day,
  CASE WHEN event_id IS NULL THEN 'missing_event_id' WHEN event_type IS NULL THEN 'missing_event_type'
    ELSE 'bad_event_ts' END AS reason
FROM bronze WHERE event_id IS NULL OR event_type IS NULL OR event_ts IS NULL"""
    ),
    "quarantine_accounting": _silver(
        """SELECT CAST((SELECT count(*) FROM bronze) AS BIGINT) AS bronze_rows,
  CAST((SELECT count(*) FROM silver) AS BIGINT) AS silver_rows,
  CAST((SELECT count(*) FROM bronze WHERE event_id IS NOT NULL AND event_type IS NOT NULL AND event_ts IS NOT NULL)
    - (SELECT count(*) FROM silver) AS BIGINT) AS duplicate_rows,
  CAST((SELECT count(*) FROM bronze WHERE event_id IS NULL OR event_type IS NULL OR event_ts IS NULL) AS BIGINT)
    AS quarantined_rows"""
    ),
    "gold_daily_from_hourly": _gold("SELECT event_day, actor_login, push_count FROM push_user_daily"),
    "gold_hourly_cube": _gold(
        " UNION ALL ".join(
            f"SELECT '{name}' AS entity, event_day, event_hour_ts, {key} AS key, {metric} AS n FROM {name}_hourly"
            for name, (key, metric, _) in GOLD.items()
        )
    ),
    "gold_union_by_name": _gold(
        "SELECT event_day, org_login, pr_count FROM pr_org_daily UNION ALL BY NAME "
        "SELECT pr_count, repo_name, event_day FROM pr_repo_daily"
    ),
    "view_event_type_daily": _gold(
        "SELECT event_day, event_type, CAST(sum(event_count) AS BIGINT) AS event_count FROM event_type_daily GROUP BY ALL"
    ),
    "latest_hour": _gold("SELECT max(event_hour_ts) AS latest_hour FROM event_type_hourly"),
    "preset_ranges": _gold(
        """, hi AS (SELECT max(event_hour_ts) + INTERVAL 1 HOUR AS e FROM event_type_hourly)
SELECT '1h' AS preset, e - INTERVAL 1 HOUR AS start_ts, e AS end_ts FROM hi
UNION ALL SELECT '4h', e - INTERVAL 4 HOUR, e FROM hi
UNION ALL SELECT '24h', e - INTERVAL 24 HOUR, e FROM hi
UNION ALL SELECT '7d', TIMESTAMP '2024-01-23 12:00:00', TIMESTAMP '2024-01-30 12:00:00'
UNION ALL SELECT '30d', TIMESTAMP '2023-12-31 12:00:00', TIMESTAMP '2024-01-30 12:00:00'
UNION ALL SELECT 'max', CAST(NULL AS TIMESTAMP), TIMESTAMP '2024-01-30 12:00:00'"""
    ),
    "dq_silver_event_count": _silver(
        "SELECT event_day, 'silver_event_count' AS check_name, CAST(count(*) AS BIGINT) AS value FROM silver GROUP BY ALL"
    ),
    "dq_null_event_type": _silver(
        "SELECT event_day, 'null_event_type' AS check_name, CAST(count(*) FILTER (event_type IS NULL) AS BIGINT) AS value "
        "FROM silver GROUP BY ALL"
    ),
    "dq_duplicate_event_ids": _silver(
        "SELECT event_day, 'duplicate_event_ids' AS check_name, "
        "CAST(count(*) - count(DISTINCT event_id) AS BIGINT) AS value FROM silver GROUP BY ALL"
    ),
    "dq_silver_report": _silver(
        ", c AS (SELECT event_day, count(*) AS n, count(*) - count(DISTINCT event_id) AS d, "
        "count(*) FILTER (event_id IS NULL) AS ni, count(*) FILTER (event_type IS NULL) AS nt, "
        "count(*) FILTER (event_ts IS NULL) AS ns, count(*) FILTER (CAST(event_ts AS DATE) <> event_day) AS m "
        "FROM silver GROUP BY ALL) "
        + " UNION ALL ".join(
            f"SELECT event_day, '{check}' AS check_name, CAST({column} AS BIGINT) AS value FROM c"
            for check, column in {
                "silver_event_count": "n",
                "duplicate_event_ids": "d",
                "null_event_id": "ni",
                "null_event_type": "nt",
                "null_event_ts": "ns",
                "day_mismatch": "m",
            }.items()
        )
    ),
    "dq_bronze_nulls": _bronze(
        " UNION ALL ".join(
            f"SELECT '{c}' AS check_name, CAST(count(*) - count({c}) AS BIGINT) AS value FROM bronze"
            for c in ("event_id", "event_type", "created_at", "actor_login")
        )
    ),
    "dq_bronze_duplicate_ids": _bronze(
        "SELECT date AS event_day, 'duplicate_event_ids' AS check_name, "
        "CAST(count(*) - count(DISTINCT event_id) AS BIGINT) AS value FROM bronze GROUP BY ALL"
    ),
    "dq_gold_reconciliation": _gold(
        "SELECT 'gold_event_type_reconciliation' AS check_name, CAST(s.n - g.n AS BIGINT) AS value "
        "FROM (SELECT count(*) AS n FROM silver) s CROSS JOIN (SELECT sum(event_count) AS n FROM event_type_daily) g"
    ),
    "dq_gold_reconciliation_by_day": _gold(
        """SELECT event_day, CAST(coalesce(s.n, 0) AS BIGINT) AS silver_events,
  CAST(coalesce(g.n, 0) AS BIGINT) AS gold_events, CAST(coalesce(s.n, 0) - coalesce(g.n, 0) AS BIGINT) AS value
FROM (SELECT event_day, count(*) AS n FROM silver GROUP BY ALL) s
FULL JOIN (SELECT event_day, sum(event_count) AS n FROM event_type_daily GROUP BY ALL) g USING (event_day)"""
    ),
    "dq_day_mismatch": _bronze(
        "SELECT date, CAST(count(*) AS BIGINT) AS row_count, "
        "CAST(count(*) FILTER (CAST(event_ts AS DATE) <> date) AS BIGINT) AS mismatched FROM bronze GROUP BY ALL"
    ),
    "dq_gold_nonempty": _gold(
        " UNION ALL ".join(
            f"SELECT '{name}_{grain}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, count(*) > 0 AS passed "
            f"FROM {name}_{grain}"
            for name in GOLD
            for grain in ("daily", "hourly")
        )
    ),
    "dq_nonnegative": _gold(
        " UNION ALL ".join(
            f"SELECT '{name}_{grain}' AS table_name, CAST(count(*) FILTER ({metric} < 0) AS BIGINT) AS negative_rows "
            f"FROM {name}_{grain}"
            for name, (_, metric, _c) in GOLD.items()
            for grain in ("daily", "hourly")
        )
    ),
    "dq_freshness": _gold(
        """SELECT 'freshness' AS check_name, h AS latest_hour,
  CAST(epoch(TIMESTAMP '2024-01-30 12:00:00') - epoch(h + INTERVAL 1 HOUR) AS BIGINT) AS lag_seconds,
  epoch(TIMESTAMP '2024-01-30 12:00:00') - epoch(h + INTERVAL 1 HOUR) <= 7200 AS within_sla
FROM (SELECT max(event_hour_ts) AS h FROM event_type_hourly)"""
    ),
    "dq_layer_lag": _gold(
        """SELECT 'bronze' AS layer, max(file_hour) AS latest_hour FROM bronze
UNION ALL SELECT 'silver', max(event_hour_ts) FROM silver
UNION ALL SELECT 'gold', max(event_hour_ts) FROM event_type_hourly"""
    ),
    "stream_dedup": _silver("SELECT event_id, event_type, event_ts FROM silver"),
    "stream_event_type_hourly": _gold("SELECT event_hour_ts, event_type, event_count FROM event_type_hourly"),
    "repo_daily_activity": _silver(
        "SELECT event_day, repo_name, event_type, CAST(count(*) AS BIGINT) AS event_count FROM silver "
        "WHERE repo_name IS NOT NULL GROUP BY ALL"
    ),
    "org_daily_activity": _silver(
        "SELECT event_day, org_login, CAST(count(*) AS BIGINT) AS event_count FROM silver "
        "WHERE org_login IS NOT NULL GROUP BY ALL"
    ),
    "actor_daily_activity": _silver(
        "SELECT event_day, actor_login, is_bot, CAST(count(*) AS BIGINT) AS event_count FROM silver "
        "WHERE actor_login IS NOT NULL GROUP BY ALL"
    ),
    "language_daily_activity": _silver(
        "SELECT event_day, repo_language, CAST(count(*) AS BIGINT) AS event_count FROM silver "
        "WHERE repo_language IS NOT NULL GROUP BY ALL"
    ),
    "push_pr_ratio": _gold(
        """SELECT event_day, CAST(p AS BIGINT) AS push_count, CAST(r AS BIGINT) AS pr_count,
  CASE WHEN r > 0 THEN round(CAST(p AS DOUBLE) / r, 6) END AS push_pr_ratio
FROM (SELECT event_day, coalesce(sum(event_count) FILTER (event_type = 'PushEvent'), 0) AS p,
  coalesce(sum(event_count) FILTER (event_type = 'PullRequestEvent'), 0) AS r FROM event_type_daily GROUP BY ALL)"""
    ),
}

for _name, (_key, _metric, _cond) in GOLD.items():
    ORACLE[f"gold_{_name}_daily"] = _gold(f"SELECT event_day, {_key}, {_metric} FROM {_name}_daily")
    ORACLE[f"gold_{_name}_hourly"] = _gold(f"SELECT event_day, event_hour_ts, {_key}, {_metric} FROM {_name}_hourly")

for _view, _name in {
    "view_top_push_users_30d": "push_user",
    "view_top_pr_orgs_30d": "pr_org",
    "view_top_pr_repos_30d": "pr_repo",
}.items():
    _key, _metric, _ = GOLD[_name]
    ORACLE[_view] = _gold(
        f"SELECT {_key}, CAST(sum({_metric}) AS BIGINT) AS {_metric} FROM {_name}_daily "
        f"WHERE event_day >= DATE '2024-01-30' - INTERVAL 30 DAY GROUP BY ALL ORDER BY {_metric} DESC, {_key}"
    )

for _query, _type in REPO_METRICS.items():
    ORACLE[_query] = _silver(
        "SELECT event_day, repo_name, CAST(count(*) AS BIGINT) AS event_count FROM silver "
        f"WHERE event_type = '{_type}' AND repo_name IS NOT NULL GROUP BY ALL"
    )

for _days in (7, 30):
    ORACLE[f"rolling_{_days}d"] = _gold(
        f"""SELECT event_day, event_type, CAST(sum(event_count) OVER (PARTITION BY event_type ORDER BY event_day
  RANGE BETWEEN INTERVAL {_days - 1} DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_{_days}d
FROM event_type_daily"""
    )

for _query, _table, _time, _step, _type in (
    ("dod_change", "event_type_daily", "event_day", "DAY", "DATE"),
    ("hoh_change", "event_type_hourly", "event_hour_ts", "HOUR", "TIMESTAMP"),
):
    ORACLE[_query] = _gold(
        f""", times AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 {_step})) AS {_type}) AS {_time}
  FROM (SELECT CAST(min({_time}) AS TIMESTAMP) AS lo, CAST(max({_time}) AS TIMESTAMP) AS hi FROM {_table})),
dense AS (SELECT t.{_time}, k.event_type, CAST(coalesce(c.event_count, 0) AS BIGINT) AS event_count
  FROM times t CROSS JOIN (SELECT DISTINCT event_type FROM {_table}) k
  LEFT JOIN {_table} c ON c.{_time} = t.{_time} AND c.event_type = k.event_type),
lagged AS (SELECT *, lag(event_count) OVER (PARTITION BY event_type ORDER BY {_time}) AS p FROM dense)
SELECT {_time}, event_type, event_count,
  CASE WHEN p > 0 THEN round(100.0::DOUBLE * (event_count - p) / p, 6) END AS pct_change FROM lagged"""
    )

for _query, _time, _step, _type in (
    ("repo_dod_change", "event_day", "DAY", "DATE"),
    ("repo_hoh_change", "event_hour_ts", "HOUR", "TIMESTAMP"),
):
    # Every count with the next bucket's zero beside it: where both meet, the count stays.
    ORACLE[_query] = _silver(
        f"""SELECT {_time}, repo_name, CAST(sum(n) AS BIGINT) AS event_count,
  CASE WHEN sum(p) > 0 THEN round(100.0::DOUBLE * (sum(n) - sum(p)) / sum(p), 6) END AS pct_change
FROM (SELECT {_time}, repo_name, n, 0 AS p FROM counted
  UNION ALL SELECT CAST({_time} + INTERVAL 1 {_step} AS {_type}), repo_name, 0, n FROM counted)
WHERE {_time} <= (SELECT max({_time}) FROM counted) GROUP BY ALL""".replace(
            "FROM counted",
            f"FROM (SELECT {_time}, repo_name, count(*) AS n FROM silver WHERE repo_name IS NOT NULL GROUP BY ALL)",
        )
    )

# preset -> (hourly?, start, end); short presets are anchored on the newest hour in the data
_HI = "(SELECT max(event_hour_ts) + INTERVAL 1 HOUR FROM event_type_hourly)"
PRESETS = {
    "1h": (True, f"{_HI} - INTERVAL 1 HOUR", _HI),
    "4h": (True, f"{_HI} - INTERVAL 4 HOUR", _HI),
    "24h": (True, f"{_HI} - INTERVAL 24 HOUR", _HI),
    "7d": (False, "TIMESTAMP '2024-01-23 12:00:00'", "TIMESTAMP '2024-01-30 12:00:00'"),
    "30d": (False, "TIMESTAMP '2023-12-31 12:00:00'", "TIMESTAMP '2024-01-30 12:00:00'"),
    "max": (False, None, "TIMESTAMP '2024-01-30 12:00:00'"),
}


def _dashboard(preset: str) -> None:
    hourly, start, end = PRESETS[preset]
    envelope = f"'{preset}' AS preset, {start or 'CAST(NULL AS TIMESTAMP)'} AS start_ts, {end} AS end_ts"
    if hourly:
        where, time = f"event_hour_ts >= {start} AND event_hour_ts < {end}", "event_hour_ts"
        label = "strftime(event_hour_ts, '%Y-%m-%dT%H:%M:%S')"
    else:
        where = f"event_day BETWEEN CAST({start} AS DATE) AND CAST({end} AS DATE)" if start else "true"
        time, label = "event_day", "CAST(event_day AS VARCHAR)"
    grain = "hourly" if hourly else "daily"
    ORACLE[f"summary_{preset}"] = _gold(
        f"SELECT {envelope}, CAST(coalesce(sum(event_count), 0) AS BIGINT) AS total_events "
        f"FROM event_type_{grain} WHERE {where}"
    )
    ORACLE[f"event_types_{preset}"] = _gold(
        f"SELECT {envelope}, event_type, CAST(sum(event_count) AS BIGINT) AS event_count "
        f"FROM event_type_{grain} WHERE {where} GROUP BY event_type"
    )
    ORACLE[f"event_type_series_{preset}"] = _gold(
        f"SELECT {envelope}, {label} AS bucket, event_type, CAST(sum(event_count) AS BIGINT) AS event_count "
        f"FROM event_type_{grain} WHERE {where} GROUP BY {time}, event_type"
    )
    for query, name in {"top_push_users": "push_user", "top_pr_orgs": "pr_org", "top_pr_repos": "pr_repo"}.items():
        key, metric, _ = GOLD[name]
        ORACLE[f"{query}_{preset}"] = _gold(
            f"SELECT {envelope}, {key}, {metric} FROM (SELECT {key}, CAST(sum({metric}) AS BIGINT) AS {metric} "
            f"FROM {name}_{grain} WHERE {where} GROUP BY {key} ORDER BY {metric} DESC, {key} LIMIT 10)"
        )


for _preset in PRESETS:
    _dashboard(_preset)
