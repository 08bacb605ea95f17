"""For each registered query the same result in DuckDB SQL."""

from __future__ import annotations

_START = "make_timestamp((epoch_us(ts) // 1000) * 1000)"

_LOG = f"""
    SELECT event_type AS page,
           'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS song,
           epoch_us(ts) // 1000 AS ms,
           {_START} AS start_time,
           CAST(user_id AS VARCHAR) AS user_id,
           'F' || CAST(user_id AS VARCHAR) AS first_name,
           'L' || CAST(user_id AS VARCHAR) AS last_name,
           CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           CASE WHEN value > 100 THEN 'paid' ELSE 'free' END AS level,
           event_id AS session_id,
           json_extract_string(props, '$.k') AS location,
           props AS user_agent
    FROM events
"""

_LOG_LINES = f"""SELECT page, song, ms AS ts, user_id AS "userId", first_name AS "firstName",
    last_name AS "lastName", gender, level, session_id AS "sessionId", location,
    user_agent AS "userAgent" FROM ({_LOG})"""

_PLAYS = f"SELECT * FROM ({_LOG}) WHERE page = 'purchase'"

_CUSTOMER_SONGS = """
    SELECT CAST(c_custkey AS VARCHAR) AS song_id, c_name AS title,
           'A' || CAST(c_nationkey AS VARCHAR) AS artist_id,
           c_nationkey + 1990 AS year, c_acctbal AS duration,
           c_mktsegment AS artist_name,
           CASE WHEN c_nationkey < 20 THEN c_mktsegment END AS artist_location,
           c_nationkey / 2.0::DOUBLE AS artist_latitude,
           c_nationkey / 4.0::DOUBLE - 90 AS artist_longitude
    FROM customer
"""

_PART_SONGS = """
    SELECT p_partkey AS song_id, p_name AS title, p_brand AS artist_id, p_size AS year,
           p_retailprice AS duration, p_type AS artist_name,
           split_part(p_name, ' ', 1) AS artist_location,
           CAST(p_size AS DOUBLE) AS artist_latitude, CAST(NULL AS DOUBLE) AS artist_longitude
    FROM part
"""

_FINISHED_ORDERS = """
    SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS first_name,
           CAST(NULL AS VARCHAR) AS last_name,
           CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, o_orderpriority AS level
    FROM orders WHERE o_orderstatus = 'F'
"""


def _songs(source: str, *keys: str) -> str:
    columns = ", ".join(["song_id", "title", "artist_id", "year", "duration", *keys])
    return f"SELECT DISTINCT {columns} FROM ({source})"


def _artists(source: str) -> str:
    return f"""SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
        artist_latitude AS latitude, artist_longitude AS longitude FROM ({source})"""


def _parts(ts: str) -> str:
    return f"""CAST(hour({ts}) AS INT) AS hour, CAST(day({ts}) AS INT) AS day,
        CAST(week({ts}) AS INT) AS week, CAST(month({ts}) AS INT) AS month,
        CAST(year({ts}) AS INT) AS year, CAST(dayofweek({ts}) + 1 AS INT) AS weekday"""


def _month_keys(ts: str) -> str:
    return f"CAST(year({ts}) AS INT) AS year_partition, CAST(month({ts}) AS INT) AS month_partition"


def _time(source: str, ts: str, keyed: bool = True) -> str:
    keys = f", {_month_keys(ts)}" if keyed else ""
    return f"SELECT DISTINCT {ts} AS start_time, {_parts(ts)}{keys} FROM {source}"


def _fact(plays: str, songs: str, on: str = "song = title", distinct: bool = False, keyed: bool = True) -> str:
    keys = f", {_month_keys('start_time')}" if keyed else ""
    return f"""SELECT {"DISTINCT" if distinct else ""} start_time, user_id, level, song_id, artist_id,
        session_id, location, user_agent{keys} FROM ({plays}) JOIN ({songs}) ON {on}"""


_FANOUT = _fact(
    f"SELECT p.*, part.p_name AS asked FROM ({_PLAYS}) p JOIN part ON CAST(p.location AS BIGINT) = part.p_partkey",
    "SELECT DISTINCT p_name AS title, p_brand AS song_id, p_brand AS artist_id FROM part",
    "asked = title",
)

_UNIQUE = _fact(_PLAYS, _CUSTOMER_SONGS)

_TWICE = ("year AS year_partition", "year AS artist_id_partition")

_SHOWN = {
    "songs": _songs(_CUSTOMER_SONGS),
    "artists": _artists(_CUSTOMER_SONGS),
    "users": f"SELECT DISTINCT user_id, first_name, last_name, gender, level FROM ({_PLAYS})",
    "time": f"SELECT DISTINCT start_time FROM ({_PLAYS})",
    "songplays": _UNIQUE,
}

ORACLES: dict[str, str] = {
    "filter_events": "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'",
    "rename_column": "SELECT p_partkey, p_size AS song_year FROM part",
    "dim_songs": _songs(_PART_SONGS, *_TWICE),
    "dim_artists": _artists(_PART_SONGS),
    "dim_users": _FINISHED_ORDERS,
    "epoch_ms_to_timestamp": f"SELECT event_id, {_START} AS start_time FROM events",
    "epoch_out_of_range": f"SELECT event_id, CASE WHEN event_id % 7 > 1 THEN {_START} END AS start_time FROM events",
    "calendar_parts": f"SELECT event_id, {_parts('ts')} FROM events",
    "dim_time": _time("events", "ts"),
    "dim_time_orders": _time("orders", "o_orderdate"),
    "fact_unique_title": _UNIQUE,
    "fact_unique_title_grid": _UNIQUE,
    "fact_title_fanout": _FANOUT,
    "fact_title_fanout_grid": _FANOUT,
    "fact_two_keys": _fact(_PLAYS, _CUSTOMER_SONGS, "song = title AND user_id = song_id"),
    "fact_case_and_null": _fact(
        f"""SELECT * REPLACE (CASE WHEN level = 'paid' THEN upper(song) WHEN gender = 'F' THEN song END AS song)
        FROM ({_PLAYS})""",
        _CUSTOMER_SONGS,
    ),
    "fact_star": _UNIQUE,
    "dedup_before_id": _fact(
        f"""SELECT * REPLACE (CAST(date_trunc('day', start_time) AS TIMESTAMP) AS start_time,
        CAST(0 AS BIGINT) AS session_id, CAST(NULL AS VARCHAR) AS location, gender AS user_agent) FROM ({_PLAYS})""",
        _CUSTOMER_SONGS,
        distinct=True,
    ),
    "surrogate_key": f"SELECT count(*) AS n, count(*) AS n_ids FROM ({_UNIQUE})",
    "surrogate_key_rows": "SELECT o_orderstatus, count(*) AS n, count(*) AS n_ids FROM orders GROUP BY o_orderstatus",
    "surrogate_key_stable": """SELECT event_id,
        row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS songplay_id
        FROM events WHERE event_type = 'purchase'""",
    "scan_songs_leaf": _songs(_CUSTOMER_SONGS),
    "scan_songs_root": _songs(_CUSTOMER_SONGS, *_TWICE),
    "scan_songs_by_artist": _songs(
        _CUSTOMER_SONGS,
        "year AS year_partition",
        "CAST(('0x' || substr(md5(artist_id), 1, 4)) AS INT) % 64 AS artist_bucket",
    ),
    "scan_songs_null_key": _songs(
        f"""SELECT * REPLACE (CASE WHEN artist_location IS NOT NULL THEN artist_id END AS artist_id)
        FROM ({_CUSTOMER_SONGS})""",
        "year AS year_partition",
        "artist_id AS artist_id_partition",
    ),
    "scan_time_leaf": _time("orders", "o_orderdate", keyed=False),
    "scan_songplays_leaf": _fact(_PLAYS, _CUSTOMER_SONGS, keyed=False),
    "sink_artists": _artists(_PART_SONGS),
    "sink_users": _FINISHED_ORDERS,
    "sink_artists_by_id": _artists(_PART_SONGS),
    "sink_users_by_id": _FINISHED_ORDERS,
    "sink_time_by_month": _time("orders", "o_orderdate"),
    "sink_overwrite": _songs(_CUSTOMER_SONGS, *_TWICE),
    "scan_json_log": _LOG_LINES,
    "scan_json_log_inferred": _LOG_LINES,
    "scan_json_log_strays": _LOG_LINES,
    "scan_json_catalogue": _CUSTOMER_SONGS,
    "preview": "SELECT count(*) AS n, true AS all_there FROM (SELECT * FROM part LIMIT 10)",
    "star_songs": _songs(_CUSTOMER_SONGS, *_TWICE),
    "star_artists": _artists(_CUSTOMER_SONGS),
    "star_users": _SHOWN["users"],
    "star_time": _time(f"({_PLAYS})", "start_time"),
    "star_songplays": _UNIQUE,
    "star_ordered_key": f"""SELECT row_number() OVER (ORDER BY start_time, user_id, level, song_id, artist_id,
        session_id, location, user_agent) AS songplay_id, * FROM ({_UNIQUE})""",
    "star_required": f"SELECT DISTINCT user_id, first_name, last_name, gender, level FROM ({_PLAYS}) WHERE gender = 'F'",
    "star_preview": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n, true AS all_there FROM (SELECT * FROM ({sql}) LIMIT 10)"
        for name, sql in _SHOWN.items()
    ),
}
