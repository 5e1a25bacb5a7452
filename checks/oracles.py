"""Oracle SQL for the registered queries, built from shared common table expressions.

Windows, joins and ranks are written out literally here (copied hops, range joins with
``row_number``, ranked hosts), so that each one checks the form the Spark plan uses.
"""

from __future__ import annotations

#: The days that the backfill entries rebuild.
IN_BACKFILL = "event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-20'"

CTES = {
    "auth": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_time, 'U' || user_id AS user_id,
               'C' || json_extract_string(props, '$.k') AS computer_id, event_type <> 'error' AS success
        FROM events
        WHERE ts IS NOT NULL AND user_id IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1""",
    "flagged": """
        SELECT *, row_number() OVER (PARTITION BY user_id, computer_id ORDER BY event_time, event_id) = 1
                  AS is_new_device
        FROM auth""",
    "hop1": """
        SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, user_id, '1h' AS window_size,
               count(DISTINCT computer_id) AS unique_hosts, count(*) AS event_count,
               bool_or(is_new_device) AS has_new_device
        FROM (SELECT f.*, time_bucket(INTERVAL 5 MINUTE, event_time) - to_minutes(5 * CAST(k AS INTEGER))
                     AS window_start
              FROM flagged f, range(0, 12) t(k))
        GROUP BY window_start, user_id""",
    "hop24": """
        SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, user_id, '24h' AS window_size,
               count(DISTINCT computer_id) AS unique_hosts, count(*) AS event_count,
               bool_or(is_new_device) AS has_new_device
        FROM (SELECT f.*, time_bucket(INTERVAL 1 HOUR, event_time) - to_hours(CAST(k AS INTEGER))
                     AS window_start
              FROM flagged f, range(0, 24) t(k))
        GROUP BY window_start, user_id""",
    "features": "SELECT * FROM hop1 UNION ALL SELECT * FROM hop24",
    "near1": """
        SELECT e.*, coalesce(f.event_count, 0) AS window_1h_event_count,
               coalesce(f.unique_hosts, 0) AS window_1h_unique_hosts,
               coalesce(f.has_new_device, FALSE) AS has_new_device
        FROM auth e LEFT JOIN hop1 f
          ON e.user_id = f.user_id AND e.event_time >= f.window_start AND e.event_time < f.window_end
        QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY f.window_end) = 1""",
    "near24": """
        SELECT e.event_id, coalesce(f.unique_hosts, 0) AS window_24h_unique_hosts
        FROM auth e LEFT JOIN hop24 f
          ON e.user_id = f.user_id AND e.event_time >= f.window_start AND e.event_time < f.window_end
        QUALIFY row_number() OVER (PARTITION BY e.event_id ORDER BY f.window_end) = 1""",
    "enriched": """
        SELECT e.event_id, e.event_time, e.user_id, CAST(NULL AS VARCHAR) AS src_host, e.computer_id AS dst_host,
               coalesce(e.success, TRUE) AS success, e.window_1h_event_count, e.window_1h_unique_hosts,
               f.window_24h_unique_hosts, e.has_new_device
        FROM near1 e LEFT JOIN near24 f ON e.event_id = f.event_id""",
    "popularity_a": """
        SELECT strftime(event_time, '%Y-%m-%d') AS event_date, computer_id, count(*) AS access_count,
               count(DISTINCT user_id) AS unique_users, count(*) < 5 AS is_rare
        FROM auth GROUP BY 1, 2""",
    "rare": """
        SELECT event_date, computer_id, unique_users
        FROM (SELECT *, percent_rank() OVER (PARTITION BY event_date ORDER BY unique_users) AS pr
              FROM popularity_a)
        WHERE pr <= 0.05""",
    "rolling": """
        SELECT *, count(*) OVER hour AS login_count_1h, count(DISTINCT computer_id) OVER hour AS unique_computers_1h,
               count(*) OVER day AS login_count_24h, count(DISTINCT computer_id) OVER day AS unique_computers_24h
        FROM flagged
        WINDOW hour AS (PARTITION BY user_id ORDER BY event_time
                        RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW),
               day AS (PARTITION BY user_id ORDER BY event_time
                       RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)""",
    "indicated": """
        SELECT r.event_id, r.event_time, r.user_id, r.computer_id, r.success, r.login_count_1h,
               r.unique_computers_1h, r.login_count_24h, r.unique_computers_24h,
               CAST(r.is_new_device AS INTEGER) AS is_new_device,
               CAST(r.login_count_1h >= 2 AS INTEGER) AS is_burst_login,
               CAST(r.unique_computers_1h >= 2 AS INTEGER) AS is_lateral_movement,
               CAST(p.computer_id IS NOT NULL AS INTEGER) AS is_rare_host
        FROM rolling r LEFT JOIN rare p
          ON strftime(r.event_time, '%Y-%m-%d') = p.event_date AND r.computer_id = p.computer_id""",
    "wide_scored": """
        SELECT *, concat_ws(',', CASE WHEN is_new_device = 1 THEN 'new_device' END,
                                 CASE WHEN is_burst_login = 1 THEN 'burst_login' END,
                                 CASE WHEN is_lateral_movement = 1 THEN 'lateral_movement' END,
                                 CASE WHEN is_rare_host = 1 THEN 'rare_host' END) AS risk_flags,
               30 * is_new_device + 25 * is_burst_login + 35 * is_lateral_movement + 10 * is_rare_host AS risk_score,
               strftime(event_time, '%Y-%m-%d') AS event_date
        FROM indicated""",
    "wide": """
        SELECT *, CASE WHEN risk_score <= 25 THEN 'LOW' WHEN risk_score <= 50 THEN 'MEDIUM'
                       WHEN risk_score <= 75 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level
        FROM wide_scored""",
    "lagged": """
        SELECT ts AS event_time, ts + to_seconds(CAST(floor(value) AS INTEGER)) AS processing_time,
               CAST(floor(value) AS BIGINT) AS lag
        FROM events""",
}


def _scored(hosts_1h, events_1h, hosts_24h, rare="has_new_device", source="enriched"):
    rules = (
        ("lateral_movement", 35, f"window_1h_unique_hosts >= {hosts_1h}"),
        ("burst_login", 25, f"window_1h_event_count >= {events_1h}"),
        ("rare_host", 10, rare),
        ("new_device_spike", 30, f"has_new_device AND window_24h_unique_hosts >= {hosts_24h}"),
    )
    score = " + ".join(f"CASE WHEN {test} THEN {weight} ELSE 0 END" for _, weight, test in rules)
    flags = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, _, test in rules)
    return (
        f"SELECT *, {score} AS risk_score, concat_ws(',', {flags}) AS risk_flags, "
        f"strftime(event_time, '%Y-%m-%d') AS event_date FROM {source}"
    )


CTES["curated"] = _scored(2, 2, 4)
CTES["curated_defaults"] = _scored(10, 50, 25)
CTES["enriched_rare"] = """
    SELECT e.*, p.computer_id IS NOT NULL AS is_rare_host
    FROM enriched e LEFT JOIN rare p
      ON strftime(e.event_time, '%Y-%m-%d') = p.event_date AND e.dst_host = p.computer_id"""
CTES["curated_popularity"] = _scored(2, 2, 4, rare="is_rare_host", source="enriched_rare")
CTES["exploded"] = """
    SELECT c.*, unnest(string_split(risk_flags, ',')) AS risk_flag FROM curated c WHERE risk_flags <> ''"""
CTES["levelled"] = """
    SELECT *, CASE WHEN risk_score <= 25 THEN 'LOW' WHEN risk_score <= 50 THEN 'MEDIUM'
                   WHEN risk_score <= 75 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level
    FROM curated"""
CTES["hourly"] = """
    SELECT date_trunc('hour', event_time) AS window_start, date_trunc('hour', event_time) + INTERVAL 1 HOUR
           AS window_end, user_id, '1h' AS window_size, count(DISTINCT dst_host) AS unique_hosts,
           count(*) AS event_count, max(CASE WHEN has_new_device THEN 1 ELSE 0 END) = 1 AS has_new_device
    FROM curated GROUP BY 1, 2, 3"""
CTES["risk_hourly"] = """
    SELECT date_trunc('hour', event_time) AS window_start, date_trunc('hour', event_time) + INTERVAL 1 HOUR
           AS window_end, user_id, count(*) AS total_logins, count(DISTINCT computer_id) AS unique_computers,
           count(*) FILTER (WHERE risk_score > 0) AS anomaly_count,
           CAST(sum(risk_score) AS BIGINT) AS total_risk_score, max(risk_score) AS max_risk_score
    FROM wide GROUP BY 1, 2, 3"""
CTES["popularity_b"] = """
    SELECT CAST(event_time AS DATE) AS event_date, dst_host AS host_id, count(DISTINCT user_id) AS distinct_users,
           count(*) AS total_events
    FROM curated GROUP BY 1, 2"""

NEEDS = {
    "auth": [],
    "flagged": ["auth"],
    "hop1": ["flagged"],
    "hop24": ["flagged"],
    "features": ["hop1", "hop24"],
    "near1": ["auth", "hop1"],
    "near24": ["auth", "hop24"],
    "enriched": ["near1", "near24"],
    "popularity_a": ["auth"],
    "rare": ["popularity_a"],
    "rolling": ["flagged"],
    "indicated": ["rolling", "rare"],
    "wide_scored": ["indicated"],
    "wide": ["wide_scored"],
    "lagged": [],
    "curated": ["enriched"],
    "curated_defaults": ["enriched"],
    "enriched_rare": ["enriched", "rare"],
    "curated_popularity": ["enriched_rare"],
    "exploded": ["curated"],
    "levelled": ["curated"],
    "hourly": ["curated"],
    "risk_hourly": ["wide"],
    "popularity_b": ["curated"],
}


def sql(select: str, *uses: str) -> str:
    """``select`` preceded by the expressions it uses, and those they use."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS[name]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        add(name)
    if not ordered:
        return select.strip()
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({CTES[n].strip()})" for n in ordered) + "\n" + select.strip()


NOW = "(SELECT max(ts) FROM events)"
MIDNIGHT = f"(date_trunc('day', {NOW}) + INTERVAL 1 DAY)"
YESTERDAY = f"strftime({NOW} - INTERVAL 1 DAY, '%Y-%m-%d')"
TODAY = f"strftime({NOW}, '%Y-%m-%d')"
EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"
HOST = "json_extract_string(props, '$.k')"

CURATED_COLUMNS = (
    "event_time, user_id, src_host, dst_host, success, window_1h_event_count, window_1h_unique_hosts, "
    "window_24h_unique_hosts, has_new_device, risk_score, risk_flags, event_date"
)
FEATURE_COLUMNS = "window_start, window_end, user_id, window_size, unique_hosts, event_count, has_new_device"

# Faulty records derived from every event: its type decides which fault it gets.
OUTCOME = """CASE event_type WHEN 'error' THEN 'blank_user_id' WHEN 'signup' THEN 'field_count'
             WHEN 'view' THEN 'time_not_digits' ELSE 'ok' END"""
PAYLOAD_OUTCOME = """CASE event_type WHEN 'error' THEN 'blank_computer_id' WHEN 'signup' THEN 'malformed_json'
             WHEN 'view' THEN 'event_time_without_zone' WHEN 'purchase' THEN 'unknown_field' END"""


def _dq(failed: list[tuple[str, str, str]], source: str, schema_failed: int, *uses: str) -> str:
    """One row per check; ``failed`` is (name, type, condition)."""
    rows = [f"SELECT 'schema_columns' AS name, 'schema' AS type, {schema_failed} AS failed_rows"]
    rows += [
        f"SELECT '{name}', '{kind}', (SELECT count(*) FROM {source} WHERE {condition})"
        for name, kind, condition in failed
    ]
    return sql(
        f"""
        SELECT name, type, total_rows, CAST(failed_rows AS BIGINT) AS failed_rows,
               round(failed_rows / total_rows * 100.0, 6) AS failure_pct,
               CASE WHEN (type = 'schema' AND failed_rows > 0)
                      OR (type <> 'schema' AND failed_rows / total_rows * 100.0 > 0.1) THEN 'FAIL' ELSE 'PASS' END
               AS status
        FROM ({' UNION ALL '.join(rows)}), (SELECT count(*) AS total_rows FROM {source})""",
        *uses,
    )


CURATED_FAILURES = [
    ("not_null_user_id", "not_null", "user_id IS NULL"),
    ("not_null_event_time", "not_null", "event_time IS NULL"),
    ("value_range_risk_score", "range", "risk_score < 0 OR risk_score > 100"),
    ("allowed_values_success", "range", "success NOT IN (TRUE, FALSE)"),
]
CTES["spoiled"] = """
    SELECT CASE WHEN dst_host = 'C1' THEN NULL ELSE user_id END AS user_id, event_time,
           CASE WHEN success THEN risk_score + 50 ELSE risk_score END AS risk_score,
           CASE WHEN has_new_device THEN success END AS success
    FROM curated"""
NEEDS["spoiled"] = ["curated"]
CTES["minutes"] = """
    SELECT date_trunc('minute', event_time) AS minute, count(*) AS value FROM auth GROUP BY 1"""
NEEDS["minutes"] = ["auth"]
CTES["all_minutes"] = """
    SELECT m AS minute, coalesce(value < 2, TRUE) AS breach
    FROM (SELECT unnest(generate_series((SELECT min(minute) FROM minutes), (SELECT max(minute) FROM minutes),
                                        INTERVAL 1 MINUTE)) AS m) g
    LEFT JOIN minutes ON g.m = minutes.minute"""
NEEDS["all_minutes"] = ["minutes"]
CTES["closed_minutes"] = """
    SELECT * FROM all_minutes
    WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(event_time) FROM auth) - INTERVAL 5 MINUTE"""
NEEDS["closed_minutes"] = ["all_minutes", "auth"]
CTES["lag_minutes"] = """
    SELECT date_trunc('minute', processing_time) AS minute, max(lag) AS value FROM lagged GROUP BY 1"""
NEEDS["lag_minutes"] = ["lagged"]
CTES["all_lag_minutes"] = """
    SELECT m AS minute, coalesce(value >= 20, FALSE) AS breach
    FROM (SELECT unnest(generate_series((SELECT min(minute) FROM lag_minutes), (SELECT max(minute) FROM lag_minutes),
                                        INTERVAL 1 MINUTE)) AS m) g
    LEFT JOIN lag_minutes ON g.m = lag_minutes.minute"""
NEEDS["all_lag_minutes"] = ["lag_minutes"]
CTES["backfilled"] = """
    SELECT * FROM curated WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-20'"""
NEEDS["backfilled"] = ["curated"]
CTES["spans"] = """
    SELECT user_id, computer_id, event_id, event_time, min(event_id) OVER (PARTITION BY user_id, computer_id, event_time)
           AS first_id,
           lag(event_time) OVER (PARTITION BY user_id, computer_id ORDER BY event_time, event_id) AS before
    FROM auth"""
NEEDS["spans"] = ["auth"]


def _alarm(minutes: str, datapoints: int, periods: int, *uses: str) -> str:
    return sql(
        f"""
        SELECT minute, CAST(points AS BIGINT) AS breaching_points
        FROM (SELECT minute, sum(CAST(breach AS INTEGER)) OVER (ORDER BY minute
                     ROWS BETWEEN {periods - 1} PRECEDING AND CURRENT ROW) AS points FROM {minutes})
        WHERE points >= {datapoints}""",
        *uses,
    )


def oracle_sql() -> dict[str, str]:
    return {
        # sources, parsing, validation
        "log_scan": f"""
            SELECT date_trunc('second', ts) AS event_time, 'U' || user_id AS user_id, 'C' || {HOST} AS computer_id,
                   substr(sha256({EPOCH} || '|U' || user_id || '|C' || {HOST}), 1, 32) AS event_id, TRUE AS success
            FROM events""",
        "log_scan_joined_ids": f"""
            SELECT date_trunc('second', ts) AS event_time, {EPOCH} || '-U' || user_id || '-C' || {HOST} AS event_id
            FROM events""",
        "log_scan_base_epoch": f"""
            SELECT date_trunc('second', ts) + (TIMESTAMP '2024-01-01' - TIMESTAMP '1970-01-01') AS event_time,
                   'U' || user_id AS user_id FROM events""",
        "log_reject_counts": f"SELECT {OUTCOME} AS outcome, count(*) AS records FROM events GROUP BY 1",
        "payload_encode": f"""
            SELECT 'U' || user_id AS key,
                   '{{"event_time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","user_id":"U' || user_id ||
                   '","computer_id":"C' || {HOST} || '","event_id":"' || event_id || '"}}' AS value
            FROM events""",
        "payload_roundtrip": f"""
            SELECT ts AS event_time, 'U' || user_id AS user_id, 'C' || {HOST} AS computer_id,
                   CAST(event_id AS VARCHAR) AS event_id FROM events""",
        "payload_rejects": f"""
            SELECT {PAYLOAD_OUTCOME} AS reject_reason, count(*) AS records FROM events
            WHERE event_type <> 'click' GROUP BY 1""",
        "invalid_rate_per_hour": """
            SELECT date_trunc('hour', ts) AS hour, count(*) AS total_records,
                   count(*) FILTER (WHERE event_type IN ('error', 'view')) AS invalid_records,
                   round(count(*) FILTER (WHERE event_type IN ('error', 'view')) * 100.0 / count(*), 6) AS invalid_pct,
                   count(*) FILTER (WHERE event_type IN ('error', 'view')) * 100.0 / count(*) > 0.1 AS breached
            FROM events GROUP BY 1""",
        "ingest_summary": """
            SELECT count(*) FILTER (WHERE event_type NOT IN ('error', 'view')) AS sent,
                   count(*) FILTER (WHERE event_type IN ('error', 'view')) AS failed FROM events""",
        "canonical_events": sql("SELECT event_time, user_id, computer_id, event_id FROM auth", "auth"),
        "scoring_view": sql(
            """SELECT event_time, user_id, CAST(NULL AS VARCHAR) AS src_host, computer_id AS dst_host, success, event_id
               FROM auth""",
            "auth",
        ),
        "raw_table": sql(
            """SELECT event_time, user_id, computer_id, event_id, strftime(event_time, '%Y-%m-%d') AS event_date
               FROM auth""",
            "auth",
        ),
        "time_range_scan": sql(
            """SELECT event_time, user_id FROM auth
               WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-12'""",
            "auth",
        ),
        # deduplication and first-seen state
        "dedup_events": sql(
            """SELECT event_id, event_time, user_id, computer_id
               FROM (SELECT * FROM auth UNION ALL
                     SELECT event_id, event_time + INTERVAL 1 SECOND, user_id, computer_id, success FROM auth)
               QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_time) = 1""",
            "auth",
        ),
        "first_seen_flags": sql("SELECT event_id, user_id, computer_id, is_new_device FROM flagged", "flagged"),
        "first_seen_ttl": sql(
            """SELECT event_id, event_id = first_id AND (before IS NULL OR event_time - before > INTERVAL 3 DAY)
                      AS is_new_device FROM spans""",
            "spans",
        ),
        "seen_pairs": sql(
            "SELECT user_id, computer_id, min(event_time) AS first_seen, max(event_time) AS last_seen FROM auth GROUP BY 1, 2",
            "auth",
        ),
        "new_pairs": sql(
            """SELECT DISTINCT user_id, computer_id FROM auth a WHERE success AND NOT EXISTS (
                 SELECT 1 FROM auth h WHERE NOT h.success AND h.user_id = a.user_id AND h.computer_id = a.computer_id)""",
            "auth",
        ),
        "merged_history": sql(
            "SELECT user_id, computer_id, min(event_time) AS first_seen, max(event_time) AS last_seen FROM auth GROUP BY 1, 2",
            "auth",
        ),
        # windows and rollups
        "features_1h": sql(f"SELECT {FEATURE_COLUMNS} FROM hop1", "hop1"),
        "features_24h": sql(f"SELECT {FEATURE_COLUMNS} FROM hop24", "hop24"),
        "features_all": sql(f"SELECT {FEATURE_COLUMNS} FROM features", "features"),
        "features_tumbling": sql(
            """SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
                      time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS window_end, user_id,
                      '1h' AS window_size, count(DISTINCT computer_id) AS unique_hosts, count(*) AS event_count,
                      bool_or(is_new_device) AS has_new_device
               FROM flagged GROUP BY 1, 2, 3
               UNION ALL
               SELECT time_bucket(INTERVAL 24 HOUR, event_time), time_bucket(INTERVAL 24 HOUR, event_time)
                      + INTERVAL 24 HOUR, user_id, '24h', count(DISTINCT computer_id), count(*),
                      bool_or(is_new_device)
               FROM flagged GROUP BY 1, 2, 3""",
            "flagged",
        ),
        "user_behavior_hourly": sql(f"SELECT {FEATURE_COLUMNS} FROM hourly", "hourly"),
        "user_risk_hourly": sql("SELECT * FROM risk_hourly", "risk_hourly"),
        "host_access_daily": sql("SELECT * FROM popularity_a", "popularity_a"),
        "host_popularity_daily": sql("SELECT * FROM popularity_b", "popularity_b"),
        "host_risk_daily": sql(
            """SELECT CAST(event_time AS DATE) AS date, computer_id, count(DISTINCT user_id) AS unique_users,
                      count(*) AS total_logins,
                      count(*) FILTER (WHERE risk_level IN ('HIGH', 'CRITICAL')) AS high_risk_events
               FROM wide GROUP BY 1, 2""",
            "wide",
        ),
        "rolling_activity": sql(
            """SELECT event_id, login_count_1h, unique_computers_1h, login_count_24h, unique_computers_24h
               FROM rolling""",
            "rolling",
        ),
        "rare_hosts_daily": sql("SELECT * FROM rare", "rare"),
        # joins with features
        "event_features_1h": sql(
            """SELECT event_id, window_1h_event_count, window_1h_unique_hosts,
                      has_new_device AS window_1h_has_new_device FROM near1""",
            "near1",
        ),
        "event_features_24h": sql("SELECT event_id, window_24h_unique_hosts FROM near24", "near24"),
        "event_features_both": sql(
            """SELECT event_id, window_1h_event_count, window_1h_unique_hosts, window_24h_unique_hosts,
                      has_new_device FROM enriched""",
            "enriched",
        ),
        "exploded_flags": sql("SELECT event_id, risk_score, risk_flag FROM exploded", "exploded"),
        # scoring
        "curated_events": sql(f"SELECT {CURATED_COLUMNS} FROM curated", "curated"),
        "curated_default_rules": sql(f"SELECT {CURATED_COLUMNS} FROM curated_defaults", "curated_defaults"),
        "curated_popularity_rule": sql(f"SELECT {CURATED_COLUMNS} FROM curated_popularity", "curated_popularity"),
        "risk_sql_functions": sql("SELECT event_id, risk_score, risk_flags FROM curated", "curated"),
        "risk_predicates": sql(
            """SELECT event_id, window_1h_unique_hosts >= 2 AS lateral, window_1h_event_count >= 2 AS burst,
                      has_new_device AS new_device, has_new_device AS rare_host,
                      has_new_device AND window_24h_unique_hosts >= 4 AS spike FROM enriched""",
            "enriched",
        ),
        "basic_risk": sql(
            """SELECT event_id, CASE WHEN is_new_device THEN 30 ELSE 0 END
                                + CASE WHEN NOT success THEN 20 ELSE 0 END AS risk_score,
                      concat_ws(',', CASE WHEN is_new_device THEN 'new_device' END,
                                     CASE WHEN NOT success THEN 'login_burst' END) AS flags
               FROM flagged""",
            "flagged",
        ),
        "risk_levels": sql("SELECT event_id, risk_score, risk_level FROM levelled", "levelled"),
        "wide_events": sql("SELECT * FROM wide", "wide"),
        # reports
        "high_risk_users": sql(
            f"""SELECT user_id, count(*) AS event_count, max(risk_score) AS max_risk_score,
                       CAST(sum(risk_score) AS BIGINT) AS total_risk_score,
                       array_to_string(list_sort(list(DISTINCT risk_flag)), ',') AS triggered_rules
                FROM exploded WHERE event_date >= {YESTERDAY} AND risk_score > 0 GROUP BY user_id
                ORDER BY max_risk_score DESC, total_risk_score DESC, user_id LIMIT 50""",
            "exploded",
        ),
        "risky_hosts": sql(
            f"""SELECT dst_host, count(*) AS high_risk_events, count(DISTINCT user_id) AS distinct_users,
                       max(risk_score) AS max_risk_score,
                       array_to_string(list_sort(list(DISTINCT risk_flag)), ',') AS triggered_rules
                FROM exploded WHERE event_date >= {YESTERDAY} AND risk_score >= 35 AND dst_host IS NOT NULL
                GROUP BY dst_host ORDER BY high_risk_events DESC, dst_host LIMIT 50""",
            "exploded",
        ),
        "events_per_minute": sql(
            f"""SELECT strftime(event_time, '%Y-%m-%d %H:%M') AS minute_bucket, count(*) AS events FROM curated
                WHERE event_date = {TODAY} GROUP BY 1 ORDER BY 1 DESC LIMIT 120""",
            "curated",
        ),
        "unique_users_per_hour": sql(
            f"""SELECT strftime(event_time, '%Y-%m-%d %H:00') AS hour_bucket, count(DISTINCT user_id) AS unique_users,
                       count(*) AS total_events
                FROM curated WHERE event_date >= {YESTERDAY} GROUP BY 1 ORDER BY 1 DESC""",
            "curated",
        ),
        "lateral_movement_windows": sql(
            f"""SELECT user_id, window_start, window_end, unique_hosts, event_count FROM hop1
                WHERE unique_hosts >= 2 AND window_start >= {NOW} - INTERVAL 24 HOUR
                ORDER BY unique_hosts DESC, window_start DESC, user_id LIMIT 100""",
            "hop1",
        ),
        "new_device_alerts": sql(
            f"""SELECT event_time, user_id, dst_host, risk_score, risk_flags FROM curated
                WHERE event_date >= {YESTERDAY} AND has_new_device
                ORDER BY event_time DESC, user_id, dst_host LIMIT 200""",
            "curated",
        ),
        "data_freshness": sql(
            f"""SELECT max(event_time) AS latest_event_time, {MIDNIGHT} AS query_time,
                       date_sub('second', max(event_time), {MIDNIGHT}) AS lag_seconds,
                       CASE WHEN date_sub('second', max(event_time), {MIDNIGHT}) <= 300 THEN 'OK'
                            ELSE 'SLA_BREACH' END AS freshness_status
                FROM curated WHERE event_date >= strftime({MIDNIGHT} - INTERVAL 1 DAY, '%Y-%m-%d')""",
            "curated",
        ),
        "latest_events": sql(
            f"SELECT {CURATED_COLUMNS} FROM curated ORDER BY event_time DESC, user_id, dst_host LIMIT 20", "curated"
        ),
        "high_risk_events": sql(
            f"""SELECT user_id, dst_host, event_time, risk_score, risk_flags FROM curated
                WHERE event_time >= {NOW} - INTERVAL 1 DAY AND risk_score >= 50
                ORDER BY risk_score DESC, event_time DESC, user_id, dst_host LIMIT 50""",
            "curated",
        ),
        "users_by_average_risk": sql(
            """SELECT user_id, round(avg(risk_score), 6) AS avg_risk, count(*) AS events FROM curated GROUP BY 1
               ORDER BY avg(risk_score) DESC, user_id LIMIT 10""",
            "curated",
        ),
        "events_by_triage_level": sql(
            """SELECT CASE WHEN risk_score >= 75 THEN 'CRITICAL' WHEN risk_score >= 50 THEN 'HIGH'
                           WHEN risk_score >= 25 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level, count(*) AS events
               FROM curated GROUP BY 1""",
            "curated",
        ),
        "latest_hourly_windows": sql(
            """SELECT window_start, window_end, user_id, unique_hosts, event_count, has_new_device FROM hop1
               ORDER BY window_start DESC, user_id LIMIT 50""",
            "hop1",
        ),
        "widest_daily_windows": sql(
            """SELECT window_start, user_id, unique_hosts, event_count, has_new_device FROM hop24
               ORDER BY unique_hosts DESC, window_start DESC, user_id LIMIT 50""",
            "hop24",
        ),
        "top_hosts_of_day": sql(
            f"""SELECT host_id, distinct_users, total_events FROM popularity_b
                WHERE event_date = CAST({NOW} AS DATE)
                ORDER BY distinct_users DESC, total_events DESC, host_id LIMIT 50""",
            "popularity_b",
        ),
        "high_risk_with_behavior": sql(
            f"""SELECT e.user_id, e.event_time, e.dst_host, e.risk_score, e.risk_flags,
                       b.unique_hosts AS unique_hosts_1h, b.event_count AS event_count_1h, b.has_new_device,
                       b.window_start
                FROM curated e LEFT JOIN hop1 b ON e.user_id = b.user_id
                WHERE e.event_time >= {NOW} - INTERVAL 1 DAY AND e.risk_score >= 50
                ORDER BY e.risk_score DESC, e.event_time DESC, e.user_id, e.dst_host, b.window_start LIMIT 50""",
            "curated",
            "hop1",
        ),
        "high_risk_users_last_hour": sql(
            f"""SELECT user_id, count(*) AS event_count, CAST(sum(risk_score) AS BIGINT) AS total_risk,
                       array_to_string(list_sort(list(DISTINCT '[' || risk_flags || ']')), ';') AS flags
                FROM levelled
                WHERE event_time >= {NOW} - INTERVAL 1 HOUR AND risk_level IN ('HIGH', 'CRITICAL')
                GROUP BY 1 ORDER BY total_risk DESC, user_id LIMIT 20""",
            "levelled",
        ),
        "volume_per_day": sql(
            "SELECT strftime(event_time, '%Y-%m-%d') AS event_date, count(*) AS events FROM auth GROUP BY 1", "auth"
        ),
        "unique_actors": sql(
            """SELECT count(*) AS rows_loaded, min(event_time) AS min_event_time, max(event_time) AS max_event_time,
                      count(DISTINCT user_id) AS unique_users, count(DISTINCT computer_id) AS unique_hosts FROM auth""",
            "auth",
        ),
        "unique_actors_per_day": sql(
            """SELECT strftime(event_time, '%Y-%m-%d') AS event_date, count(DISTINCT user_id) AS unique_users,
                      count(DISTINCT computer_id) AS unique_hosts FROM auth GROUP BY 1""",
            "auth",
        ),
        "risk_flag_distribution": sql(
            "SELECT risk_flag, count(*) AS events FROM exploded GROUP BY 1", "exploded"
        ),
        "risk_level_distribution": sql(
            "SELECT risk_level, count(*) AS events FROM levelled GROUP BY 1", "levelled"
        ),
        "logins_by_hour_of_day": sql(
            """SELECT CAST(hour(event_time) AS INTEGER) AS hour_of_day, count(*) AS events,
                      count(DISTINCT user_id) AS unique_users FROM auth GROUP BY 1""",
            "auth",
        ),
        "host_access_distribution": sql(
            """SELECT computer_id, count(*) AS events, count(DISTINCT user_id) AS unique_users
               FROM auth GROUP BY 1""",
            "auth",
        ),
        "new_devices_per_day": sql(
            """SELECT strftime(event_time, '%Y-%m-%d') AS event_date,
                      count(*) FILTER (WHERE is_new_device) AS new_devices, count(*) AS events
               FROM flagged GROUP BY 1""",
            "flagged",
        ),
        # key figures and service levels
        "kpi_freshness": sql(
            """SELECT count(*) AS events, round(avg(lag), 6) AS avg_lag_seconds,
                      round(quantile_cont(lag, 0.95), 6) AS p95_lag_seconds, max(lag) AS max_lag_seconds,
                      round(avg(CAST(lag <= 300 AS INTEGER)), 6) AS share_within_limit FROM lagged""",
            "lagged",
        ),
        "kpi_missing_dates": sql(
            f"""SELECT strftime(d, '%Y-%m-%d') AS event_date
                FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-25', CAST(CAST({NOW} AS DATE) AS TIMESTAMP)
                                                    + INTERVAL 5 DAY, INTERVAL 1 DAY)) AS d)
                WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT strftime(event_time, '%Y-%m-%d') FROM auth)""",
            "auth",
        ),
        "kpi_reconcile_counts": sql(
            """SELECT coalesce(r.event_date, c.event_date) AS event_date, coalesce(raw_events, 0) AS raw_events,
                      coalesce(curated_events, 0) AS curated_events,
                      coalesce(raw_events, 0) - coalesce(curated_events, 0) AS difference
               FROM (SELECT strftime(event_time, '%Y-%m-%d') AS event_date, count(*) AS raw_events
                     FROM auth GROUP BY 1) r
               FULL JOIN (SELECT event_date, count(*) AS curated_events FROM curated WHERE success GROUP BY 1) c
                 ON r.event_date = c.event_date""",
            "auth",
            "curated",
        ),
        "kpi_sla_violations": sql(
            f"""SELECT * FROM (
                  SELECT 'freshness_p95' AS check_name, 'all' AS subject,
                         round(quantile_cont(lag, 0.95), 6) AS observed, CAST(300 AS DOUBLE) AS limit_value
                  FROM lagged HAVING quantile_cont(lag, 0.95) > 300
                  UNION ALL
                  SELECT 'completeness', strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S'),
                         round(count(*) FILTER (WHERE event_type IN ('error', 'view')) * 100.0 / count(*), 6), 0.1
                  FROM events GROUP BY 2
                  HAVING count(*) FILTER (WHERE event_type IN ('error', 'view')) * 100.0 / count(*) > 0.1
                  UNION ALL
                  SELECT 'availability', strftime(d, '%Y-%m-%d'), 0, 1
                  FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-01-05',
                                                      INTERVAL 1 DAY)) AS d)
                  WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT event_date FROM curated)
                  UNION ALL
                  SELECT 'record_count', r.event_date, raw_events - coalesce(curated_events, 0), 0
                  FROM (SELECT strftime(event_time, '%Y-%m-%d') AS event_date, count(*) AS raw_events
                        FROM auth GROUP BY 1) r
                  LEFT JOIN (SELECT event_date, count(*) AS curated_events FROM curated WHERE success GROUP BY 1) c
                    ON r.event_date = c.event_date
                  WHERE raw_events <> coalesce(curated_events, 0))""",
            "auth",
            "curated",
            "lagged",
        ),
        "kpi_throughput": sql(
            """SELECT date_trunc('minute', event_time) AS minute, count(*) AS events,
                      round(count(*) / 60, 6) AS events_per_sec FROM auth GROUP BY 1""",
            "auth",
        ),
        "kpi_high_risk_rate": sql(
            f"""SELECT round(count(*) FILTER (WHERE risk_level IN ('HIGH', 'CRITICAL')) * 100.0 / count(*), 6)
                       AS risk_rate FROM wide WHERE event_date = {TODAY}""",
            "wide",
        ),
        "kpi_new_device_rate": sql(
            f"""SELECT round(sum(is_new_device) * 100.0 / count(*), 6) AS new_device_rate
                FROM wide WHERE event_date = {TODAY}""",
            "wide",
        ),
        "kpi_lateral_users_per_hour": sql(
            f"""SELECT date_trunc('hour', event_time) AS hour, count(DISTINCT user_id) AS users_flagged FROM wide
                WHERE is_lateral_movement = 1 AND event_date = {TODAY} GROUP BY 1""",
            "wide",
        ),
        "kpi_burst_logins": sql("SELECT count(*) AS burst_logins FROM wide WHERE is_burst_login = 1", "wide"),
        "kpi_average_risk_per_hour": sql(
            f"""SELECT window_start, round(sum(total_risk_score) * 1.0 / nullif(sum(total_logins), 0), 6)
                       AS avg_risk_score
                FROM risk_hourly WHERE window_start >= {NOW} - INTERVAL 24 HOUR GROUP BY 1""",
            "risk_hourly",
        ),
        "kpi_rare_host_events": sql(
            "SELECT event_date, CAST(sum(is_rare_host) AS BIGINT) AS rare_host_events FROM wide GROUP BY 1", "wide"
        ),
        "kpi_active_users_per_hour": sql(
            "SELECT window_start, count(DISTINCT user_id) AS active_users FROM hourly GROUP BY 1", "hourly"
        ),
        "kpi_active_users_per_day": sql(
            """SELECT strftime(event_time, '%Y-%m-%d') AS event_date, count(DISTINCT user_id) AS active_users
               FROM auth GROUP BY 1""",
            "auth",
        ),
        "kpi_host_coverage": sql(
            """SELECT strftime(event_time, '%Y-%m-%d') AS event_date, count(DISTINCT computer_id) AS hosts,
                      (SELECT count(DISTINCT computer_id) FROM auth) AS known_hosts,
                      round(count(DISTINCT computer_id) * 100.0 / (SELECT count(DISTINCT computer_id) FROM auth), 6)
                      AS coverage_pct
               FROM auth GROUP BY 1""",
            "auth",
        ),
        "kpi_high_risk_hours": sql(
            """SELECT date_trunc('hour', event_time) AS hour, count(*) AS high_risk_events FROM wide
               WHERE risk_level IN ('HIGH', 'CRITICAL') GROUP BY 1 HAVING count(*) > 2""",
            "wide",
        ),
        "kpi_low_volume_alarm": _alarm("all_minutes", 5, 5, "all_minutes"),
        "kpi_lag_alarm": _alarm("all_lag_minutes", 2, 3, "all_lag_minutes"),
        # data quality
        "dq_curated": _dq(CURATED_FAILURES, "curated", 0, "curated"),
        "dq_spoiled": _dq(CURATED_FAILURES, "spoiled", 1, "spoiled"),
        "dq_schema_of_files": _dq(CURATED_FAILURES, "curated", 1, "curated"),
        "dq_invalid_stats": sql(
            """SELECT round(max(failed) / max(n) * 100.0, 6) AS invalid_record_percent,
                      CAST(max(failed) AS BIGINT) AS invalid_rows, CAST(max(n) AS BIGINT) AS total_rows
               FROM (SELECT count(*) FILTER (WHERE user_id IS NULL) AS failed, count(*) AS n FROM spoiled
                     UNION ALL
                     SELECT count(*) FILTER (WHERE risk_score < 0 OR risk_score > 100), count(*) FROM spoiled)""",
            "spoiled",
        ),
        "dq_overall": "SELECT 'PASS' AS overall_status",
        # jobs
        "job_backfill_curated": sql(f"SELECT {CURATED_COLUMNS} FROM backfilled", "backfilled"),
        "job_backfill_hourly": sql(
            """SELECT date_trunc('hour', event_time) AS window_start, date_trunc('hour', event_time) + INTERVAL 1 HOUR
                      AS window_end, user_id, count(DISTINCT dst_host) AS unique_hosts, count(*) AS event_count,
                      bool_or(has_new_device) AS has_new_device,
                      strftime(date_trunc('hour', event_time), '%Y-%m-%d') AS event_date, '1h' AS window_size
               FROM backfilled GROUP BY 1, 2, 3, 7""",
            "backfilled",
        ),
        "job_ingest_twice": sql("SELECT event_id, event_time, user_id, computer_id FROM auth", "auth"),
        "events_without_ids": sql(
            """SELECT user_id, count(*) AS events
               FROM (SELECT DISTINCT user_id, computer_id, event_time, CASE WHEN success THEN event_id END FROM auth)
               GROUP BY 1""",
            "auth",
        ),
        "job_backfill_hosts": sql(
            """SELECT CAST(event_time AS DATE) AS event_date, dst_host AS host_id,
                      count(DISTINCT user_id) AS distinct_users, count(*) AS total_events
               FROM backfilled GROUP BY 1, 2""",
            "backfilled",
        ),
        "job_backfill_wide": sql(f"SELECT * FROM wide WHERE {IN_BACKFILL}", "wide"),
        "job_backfill_host_risk": sql(
            f"""SELECT CAST(event_time AS DATE) AS date, computer_id, count(DISTINCT user_id) AS unique_users,
                      count(*) AS total_logins,
                      count(*) FILTER (WHERE risk_level IN ('HIGH', 'CRITICAL')) AS high_risk_events,
                      strftime(event_time, '%Y-%m-%d') AS event_date
               FROM wide WHERE {IN_BACKFILL} GROUP BY 1, 2, 6""",
            "wide",
        ),
        "job_backfill_user_risk": sql(
            f"""SELECT *, strftime(window_start, '%Y-%m-%d') AS event_date FROM risk_hourly
               WHERE strftime(window_start, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-19'""",
            "risk_hourly",
        ),
        "job_backfill_features": sql(
            f"""SELECT {FEATURE_COLUMNS}, strftime(window_start, '%Y-%m-%d') AS event_date FROM features
               WHERE strftime(window_start, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-19'""",
            "features",
        ),
        "job_refresh_changed": sql("SELECT * FROM wide", "wide"),
        "job_refresh_changed_features": sql(f"SELECT {FEATURE_COLUMNS} FROM features", "features"),
        # streams
        "stream_dedup": sql("SELECT event_id, event_time, user_id, computer_id FROM auth", "auth"),
        "stream_first_seen": sql("SELECT event_id, user_id, computer_id, is_new_device FROM flagged", "flagged"),
        "stream_first_seen_ttl": sql(
            """SELECT event_id, event_id = first_id AND (before IS NULL OR event_time - before > INTERVAL 3 DAY)
                      AS is_new_device FROM spans""",
            "spans",
        ),
        "stream_rolling_activity": sql(
            """SELECT event_id, login_count_1h, unique_computers_1h, login_count_24h, unique_computers_24h
               FROM rolling""",
            "rolling",
        ),
        # A stream judges a minute once the watermark, five minutes behind the newest event, has passed it.
        "stream_low_volume_alarm": _alarm("closed_minutes", 5, 5, "closed_minutes"),
        "replay_in_steps": sql("SELECT event_id, event_time, user_id, computer_id FROM auth", "auth"),
        "stream_features": sql(
            f"SELECT {FEATURE_COLUMNS} FROM features", "features"
        ),
        "stream_curated": sql(
            f"SELECT {CURATED_COLUMNS} FROM curated",
            "curated",
        ),
    }
