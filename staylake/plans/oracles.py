"""Check SQL for the registered queries, in DuckDB's dialect, over the same views.

The SQL is written the direct way (full joins, range joins, ``lag`` sessions, one row per window an
event falls in) rather than the way the jobs work, so that it checks them.
"""

from __future__ import annotations

from staylake.functions.geohash import GEOHASH_ALPHABET
from staylake.plans.views import MEAN_PLACES, MEANS, STATUS_CODES, UNKNOWN


def _geohash4(lat: str, lng: str) -> str:
    x = f"greatest(0, least(1023, CAST(floor(({lng} + 180.0::DOUBLE) / 360.0::DOUBLE * 1024.0::DOUBLE) AS BIGINT)))"
    y = f"greatest(0, least(1023, CAST(floor(({lat} + 90.0::DOUBLE) / 180.0::DOUBLE * 1024.0::DOUBLE) AS BIGINT)))"
    letters = []
    for i in range(4):
        bits = []
        for j in range(5):
            position = 5 * i + j
            axis = x if position % 2 == 0 else y
            bits.append(f"((({axis} >> {9 - position // 2}) & 1) << {4 - j})")
        letters.append(f"substr('{GEOHASH_ALPHABET}', CAST({' + '.join(bits)} AS INT) + 1, 1)")
    return f"CASE WHEN {lat} BETWEEN -90 AND 90 AND {lng} BETWEEN -180 AND 180 THEN {' || '.join(letters)} END"


_LAT = "(-6000 + 13 + ((s_suppkey * 37) % 120) * 100)"
_LNG = "(-17000 + 13 + ((s_suppkey * 53) % 340) * 100)"
_DEG = "(CAST({} AS DOUBLE) / 100)".format
_TXT = "CAST(CAST(CAST({} AS DOUBLE) / 100 AS DECIMAL(9,2)) AS VARCHAR)".format
_DAY = """l_extendedprice / 1000 AS avg_tmpr_c, l_extendedprice / 1000 * 9 / 5 + 32 AS avg_tmpr_f,
    strftime(l_shipdate, '%Y-%m-%d') AS wthr_date, CAST(year(l_shipdate) AS INT) AS year,
    CAST(month(l_shipdate) AS INT) AS month, CAST(day(l_shipdate) AS INT) AS day"""
# Five places, halves away from zero as Spark rounds; exact because it happens on decimals.
_HALF_UP = "CAST(round(CAST({} AS DECIMAL(28,12)), 5) AS DOUBLE)".format
_CODES = ", ".join(f"({code}, '{text}')" for code, text in STATUS_CODES)

# View name -> (views it reads, SQL).
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "place": (
        (),
        """SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, 'No. ' || s_suppkey AS address,
    n_name AS city, r_name AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""",
    ),
    "hotel": (
        ("place",),
        f"""SELECT id AS "Id", name AS "Name", country AS "Country", city AS "City", address AS "Address",
    CASE s_suppkey % 5 WHEN 1 THEN NULL WHEN 2 THEN 'NA' ELSE {_TXT(_LAT)} END AS "Latitude",
    CASE s_suppkey % 5 WHEN 1 THEN NULL WHEN 3 THEN NULL WHEN 2 THEN 'NA' ELSE {_TXT(_LNG)} END AS "Longitude"
    FROM place""",
    ),
    "repaired": (
        ("place",),
        f"""SELECT id AS "Id", name AS "Name", country AS "Country", city AS "City", address AS "Address",
    {_TXT(_LAT)} AS "Latitude", {_TXT(_LNG)} AS "Longitude" FROM place""",
    ),
    "hotel_cell": (
        ("repaired",),
        f"""SELECT *, {_geohash4('CAST("Latitude" AS DOUBLE)', 'CAST("Longitude" AS DOUBLE)')} AS "Geohash"
    FROM repaired""",
    ),
    "station_obs": (
        (),
        f"""SELECT {_DEG(_LNG.replace('s_suppkey', 'l_suppkey') + ' + l_linenumber * 4')} AS lng,
    {_DEG(_LAT.replace('s_suppkey', 'l_suppkey') + ' + l_linenumber * 2')} AS lat, {_DAY} FROM lineitem""",
    ),
    "weather_cell": (("station_obs",), f"""SELECT *, {_geohash4('lat', 'lng')} AS "Geohash" FROM station_obs"""),
    "hotel_weather": (
        ("place",),
        f"""SELECT name AS address, city, country, {_geohash4(_DEG(_LAT), _DEG(_LNG))} AS "geoHash", id,
    address AS name, {_DEG(_LAT)} AS latitude, {_DEG(_LNG)} AS longitude, {_DAY}
    FROM lineitem JOIN place ON l_suppkey = s_suppkey""",
    ),
    "silver": (
        ("hotel_weather",),
        """SELECT id, address AS name, name AS address, avg_tmpr_c, avg_tmpr_f, city, country, "geoHash",
    latitude, longitude, wthr_date, year, month, day FROM hotel_weather
    WHERE CAST(id AS BIGINT) % 5 NOT IN (1, 2, 3)""",
    ),
    "daily": (
        ("hotel_weather",),
        f"""SELECT id, name, address, city, country, "geoHash", latitude, longitude, wthr_date, year, month, day,
    avg(avg_tmpr_c) AS avg_tmpr_c, avg(avg_tmpr_f) AS avg_tmpr_f FROM hotel_weather GROUP BY ALL""",
    ),
    "begun": (
        (),
        """SELECT *, CAST(l_quantity AS INT) AS q, CAST(l_shipdate AS DATE) + (l_linenumber - 1) AS b,
    CAST(l_quantity AS INT) - 3 + CASE WHEN l_quantity = 50 THEN 360 ELSE 0 END AS n FROM lineitem""",
    ),
    "visit": (
        ("begun",),
        f"""SELECT l_orderkey AS id, strftime(b, '%Y-%m-%d') || ' 12:30:00' AS date_time,
    l_linenumber AS site_name, CAST(l_suppkey % 6 AS INT) AS posa_continent,
    CAST(l_partkey % 200 AS INT) AS user_location_country, CAST(l_partkey % 50 AS INT) AS user_location_region,
    CAST(l_partkey % 1000 AS INT) AS user_location_city,
    CASE WHEN l_discount <> 0.1 THEN CAST(l_extendedprice AS DECIMAL(12,2)) END AS orig_destination_distance,
    CAST(l_partkey AS INT) AS user_id, CAST(l_returnflag = 'R' AS INT) AS is_mobile,
    CAST(l_linestatus = 'O' AS INT) AS is_package, l_linenumber AS channel,
    CASE WHEN l_discount <> 0 THEN strftime(b, '%Y-%m-%d') END AS srch_ci,
    CASE WHEN l_tax <> 0 THEN strftime(b + n, '%Y-%m-%d') END AS srch_co,
    l_linenumber AS srch_adults_cnt, q % 3 AS srch_children_cnt, q % 2 + 1 AS srch_rm_cnt,
    CAST(l_suppkey AS INT) AS srch_destination_id, q % 9 AS srch_destination_type_id,
    l_suppkey + CASE WHEN l_partkey % 40 = 0 THEN {UNKNOWN} ELSE 0 END AS hotel_id FROM begun""",
    ),
    "stay": (
        ("visit",),
        """SELECT *, ci_d, co_d, co_d - ci_d AS nights, CAST(month(ci_d) AS INT) AS month_ci,
    CAST(month(co_d) AS INT) AS month_co FROM (SELECT *, CAST(srch_ci AS DATE) AS ci_d,
    CAST(srch_co AS DATE) AS co_d FROM visit)""".replace("*, ci_d, co_d, ", "*, "),
    ),
    "months_apart": (
        ("stay",),
        """SELECT *, CASE WHEN day(ci_d) = day(co_d) OR (ci_d = last_day(ci_d) AND co_d = last_day(co_d))
    THEN CAST(whole AS DOUBLE) ELSE round(whole + (day(co_d) - day(ci_d)) / 31.0::DOUBLE, 8) END AS apart
    FROM (SELECT *, (year(co_d) - year(ci_d)) * 12 + month(co_d) - month(ci_d) AS whole FROM stay)""",
    ),
    "hotel_day": (("daily",), "SELECT *, CAST(id AS BIGINT) AS hid, CAST(wthr_date AS DATE) AS d FROM daily"),
    "joined": (
        ("stay", "hotel_weather"),
        "SELECT s.*, w.address FROM stay s JOIN hotel_weather w ON s.hotel_id = CAST(w.id AS BIGINT)",
    ),
    "click": (
        (),
        f"""SELECT epoch_us(ts) // 1000 AS _time, ts, user_id + CASE WHEN event_id % 20 = 0 THEN {UNKNOWN} ELSE 0 END AS userid,
    '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip,
    event_type || CASE WHEN event_type IN ('click', 'view') THEN '.html' ELSE '' END AS request,
    CASE WHEN event_type <> 'error' THEN 200 ELSE CAST(json_extract(props, '$.k') AS INT) % 6 + 400 END AS status,
    CAST(trunc(value * 1024) AS BIGINT) AS bytes FROM events""",
    ),
    "web_user": (
        (),
        """SELECT c_custkey AS user_id, c_name AS username, n_name AS city FROM customer
    JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "code": ((), f"SELECT * FROM (VALUES {_CODES}) t(code, definition)"),
    "user_click": (
        ("click", "web_user"),
        """SELECT userid, username, ip, city, request, status, bytes, ts FROM click
    LEFT JOIN web_user ON userid = user_id""",
    ),
    "code_click": (("click", "code"), "SELECT code, definition, ts FROM click LEFT JOIN code ON status = code"),
    "gold": (
        ("silver",),
        """SELECT city, wthr_date, count(DISTINCT id) AS distinct_hotels, round(round(avg(avg_tmpr_c), 10), 1) AS avg_t,
    round(max(avg_tmpr_c), 1) AS max_t, round(min(avg_tmpr_c), 1) AS min_t FROM silver GROUP BY city, wthr_date""",
    ),
    "city_rank": (
        ("gold",),
        """SELECT city, num_of_hotels, CAST(row_number() OVER (ORDER BY num_of_hotels DESC, city) AS INT) AS rank
    FROM (SELECT city, max(distinct_hotels) AS num_of_hotels FROM gold GROUP BY city)
    ORDER BY num_of_hotels DESC, city LIMIT 10""",
    ),
}

HOUR = 3600 * 1000
_DAY_MS = 24 * HOUR


def _sql(body: str, *reads: str) -> str:
    """``body`` behind the views it reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for inner in _VIEWS[name][0]:
                visit(inner)
            order.append(name)

    for name in reads:
        visit(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_VIEWS[n][1]})" for n in order) + "\n" + body


def _ranked(source: str, group: str, order: str, columns: str, where: str = "") -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS i "
        f"FROM {source}) WHERE i <= 10 {where}"
    )


def _windows(source: str, keys: str, out: str, size: int, hop: int | None = None, where="TRUE", having="TRUE") -> str:
    """One row per window an event falls in, then a count."""
    hop = hop or size
    nulls = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"""SELECT {keys}, start AS "EVENT_TS", count(*) AS "{out}" FROM (
    SELECT {keys}, unnest(generate_series(epoch_us(ts) // 1000 // {hop} * {hop} - {size - hop},
        epoch_us(ts) // 1000 // {hop} * {hop}, {hop})) AS start FROM {source} WHERE {where} AND {nulls})
    GROUP BY {keys}, start HAVING {having}"""


def _sessions(keys: str, gap_ms: int) -> str:
    nulls = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return f"""SELECT {keys}, epoch_us(max(ts)) // 1000 AS "EVENT_TS", count(*) AS events,
    sum(bytes) / 1024.0::DOUBLE AS kbytes FROM (SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY ts
    ROWS UNBOUNDED PRECEDING) AS no FROM (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER
    (PARTITION BY {keys} ORDER BY ts) <= {gap_ms * 1000} THEN 0 ELSE 1 END AS fresh
    FROM user_click WHERE {nulls})) GROUP BY {keys}, no"""


_CATEGORY = """CASE WHEN n BETWEEN 1 AND 4 THEN '{}' WHEN n BETWEEN 5 AND 10 THEN '{}'
    WHEN n BETWEEN 11 AND 14 THEN '{}' WHEN n > 14 THEN '{}' ELSE 'Erroneous data' END""".format
_CODED = _CATEGORY("Short stay", "Short stay", "Standard stay", "Standard extended stay")
_STATED = _CATEGORY("Short stay", "Standard stay", "Standard extended stay", "Long stay")
_NIGHTS = "(SELECT *, coalesce(nights, 0) AS n FROM stay)"
_EDGE = "abs(day(co_d) - day(ci_d)) >= 7"
_MONTHS = "unnest([8, 9, 10])"
_STAY = "id, hotel_id, srch_ci, srch_co"
_BEFORE_DISTANCE = """id date_time site_name posa_continent user_location_country user_location_region
    user_location_city""".split()
_AFTER_DISTANCE = """user_id is_mobile is_package channel srch_ci srch_co srch_adults_cnt srch_children_cnt srch_rm_cnt
    srch_destination_id srch_destination_type_id hotel_id""".split()
_OBJECT = lambda names: "CAST(json_object(" + ", ".join(f"'{c}', {c}" for c in names) + ") AS VARCHAR)"
# The decimal with all its places, which json_object leaves out.
_DISTANCE = "coalesce(CAST(orig_destination_distance AS VARCHAR), 'null')"
_MESSAGE = (
    f"rtrim({_OBJECT(_BEFORE_DISTANCE)}, '}}') || ',\"orig_destination_distance\":' || {_DISTANCE}"
    f" || ',' || ltrim({_OBJECT(_AFTER_DISTANCE)}, '{{')"
)
_VISITS = "SELECT month_ci, month_co, hotel_id, count(hotel_id) AS visitors FROM stay GROUP BY ALL"
_JOINED = "SELECT month_ci, month_co, address, count(address) AS visitors FROM joined GROUP BY ALL"
_GUESTS = """SELECT DISTINCT month_ci, month_co, address, srch_adults_cnt, srch_children_cnt,
    srch_adults_cnt + srch_children_cnt AS visitors FROM joined WHERE srch_adults_cnt > 0 OR srch_children_cnt > 0"""
_LISTED = "(SELECT m.*, l.month FROM ({}) m JOIN (SELECT unnest([8, 9, 10]) AS month) l ON month_ci = l.month OR month_co = l.month)".format
_RANGE = "SELECT month AS month, round(max(avg_tmpr_c) - min(avg_tmpr_c), 5) AS tmpr_diff_cmax, address FROM hotel_weather GROUP BY month, address"
_NAMED = """(SELECT s.srch_ci, s.srch_co, s.month_ci, s.month_co, s.hotel_id, w.address,
    count(s.hotel_id) AS visits FROM stay s LEFT JOIN hotel_weather w ON s.hotel_id = CAST(w.id AS BIGINT) GROUP BY ALL)"""
_EVERY_MONTH = """(SELECT *, CAST(ci_d + to_months(CAST(k AS INT)) AS DATE) AS m FROM (SELECT *,
    unnest(generate_series(0, greatest(CAST(round(apart) AS BIGINT), 0))) AS k FROM months_apart WHERE apart IS NOT NULL))"""
_TOUCHED = """(SELECT *, CAST(unnest(generate_series(date_trunc('month', ci_d), date_trunc('month', co_d),
    INTERVAL 1 MONTH)) AS DATE) AS m FROM stay WHERE co_d >= ci_d)"""
_TERMS1 = "(SELECT DISTINCT {0} FROM v WHERE {0} IS NOT NULL ORDER BY {0} DESC LIMIT 10)".format


def _nested_terms(by: list[str]) -> str:
    """Rows of ``v`` under the ten highest terms of each level."""
    source = f"(SELECT * FROM v WHERE {' AND '.join(f'{c} IS NOT NULL' for c in by)})"
    for depth, name in enumerate(by):
        part = f"PARTITION BY {', '.join(by[:depth])} " if depth else ""
        source = f"(SELECT * EXCLUDE (t{depth}) FROM (SELECT *, dense_rank() OVER ({part}ORDER BY {name} DESC) AS t{depth} FROM {source}) WHERE t{depth} <= 10)"
    return source


def _rollup(view: str, metric: str, out: str, by: list[str], reads: tuple[str, ...], bucket: bool = True) -> str:
    source = _nested_terms(by) if by else "v"
    keys = [*by, *([f'"EVENT_TS" // {_DAY_MS} * {_DAY_MS}'] if bucket else [])]
    shown = [*by, *([f'"EVENT_TS" // {_DAY_MS} * {_DAY_MS} AS bucket'] if bucket else [])]
    return _sql(
        f"SELECT {', '.join(shown)}, {metric} AS {out} FROM (SELECT * FROM (WITH v AS ({view}) SELECT * FROM {source})) GROUP BY {', '.join(keys)}",
        *reads,
    )


# The second version of the users: every third moved, every tenth left.
_USERS_AFTER = """SELECT c_custkey AS user_id, c_name AS username, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE n_name END
    AS city FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 <> 0"""
# Clicks arrive in four parts; each is late for windows that end ten days before the latest click of earlier parts.
_ARRIVED = f"""SELECT *, "EVENT_TS" + {_DAY_MS} AS closes,
    coalesce("EVENT_TS" + {_DAY_MS} <= (SELECT max(b._time) FROM click b WHERE b._time % 4 < a._time % 4) - 10 * {_DAY_MS}, false) AS late
    FROM (SELECT *, _time // {_DAY_MS} * {_DAY_MS} AS "EVENT_TS" FROM click WHERE userid IS NOT NULL) a"""

_CLICKS = {
    "user_clickstream": ("SELECT * EXCLUDE (ts) FROM user_click", ("user_click",)),
    "enriched_error_codes": ("SELECT code, definition FROM code_click", ("code_click",)),
    "events_per_min": (_windows("click", "userid", "events", _DAY_MS), ("click",)),
    "pages_per_min": (
        _windows("click", "userid", "pages", _DAY_MS, 6 * HOUR, "request LIKE '%html%'"),
        ("click",),
    ),
    "click_user_sessions": (
        f'SELECT username, "EVENT_TS", events FROM ({_sessions("username", 4 * HOUR)})',
        ("user_click",),
    ),
    "errors_per_min_alert": (
        _windows("click", "status", "errors", _DAY_MS, 8 * HOUR, "status > 400", "count(*) > 5"),
        ("click",),
    ),
    "errors_per_min": (_windows("click", "status", "errors", _DAY_MS, 6 * HOUR, "status > 400"), ("click",)),
    "enriched_error_codes_count": (
        _windows("code_click", "code, definition", "count", 12 * HOUR, having="count(*) > 1"),
        ("code_click",),
    ),
    "user_ip_activity": (
        _windows("user_click", "username, ip, city", "count", _DAY_MS, having="count(*) > 1"),
        ("user_click",),
    ),
    "user_session_kbytes": (
        f'SELECT username, ip, "EVENT_TS", kbytes FROM ({_sessions("username, ip", 4 * HOUR)}) WHERE kbytes > 100',
        ("user_click",),
    ),
}

# The stated model of the scoring queries: 64 weights and an intercept.
_SCORES = """SELECT vec_id, round(1 / (1 + exp(-(0.25::DOUBLE + list_sum(list_transform(range(64),
    lambda i: CAST(embedding[i + 1] AS DOUBLE) * ((i * 37) % 11 - 5) / 10))))), 6) AS prediction FROM embeddings"""
_BUSY = _sql(
    _ranked(
        f"""(SELECT DISTINCT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month, hotel_id, address, visits
FROM (SELECT srch_ci, srch_co, m, hotel_id, w.address, count(hotel_id) AS visits FROM {_EVERY_MONTH} e
JOIN hotel_weather w ON e.hotel_id = CAST(w.id AS BIGINT) GROUP BY ALL))""",
        "year, month",
        "visits DESC, hotel_id, address",
        "year, month, hotel_id, address, visits",
    ),
    "months_apart",
    "hotel_weather",
)

ORACLES: dict[str, str] = {
    # Sources and sinks
    "src_csv_schema": _sql("SELECT * FROM hotel", "hotel"),
    "src_union_files": """SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, CAST(month(l_shipdate) AS INT) AS month
    FROM lineitem""",
    "src_union_schemas": """SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""",
    "src_parquet_parts": _sql("SELECT * FROM hotel_weather", "hotel_weather"),
    "sink_partitioned": _sql(
        _ranked(f"({_RANGE})", "month", "tmpr_diff_cmax DESC, address", "address, month, tmpr_diff_cmax"),
        "hotel_weather",
    ),
    "catalog_table": """SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
    count(*) AS observations FROM lineitem GROUP BY ALL""",
    "catalog_partitions": _sql(
        "SELECT year, month, count(*) AS observations, max(avg_tmpr_c) AS max_t FROM hotel_weather GROUP BY ALL",
        "hotel_weather",
    ),
    "ctas_mart": _sql("SELECT * FROM gold", "gold"),
    "json_encode_rows": _sql(f"SELECT {_MESSAGE} AS value FROM visit", "visit"),
    "json_decode_rows": _sql(
        "SELECT * FROM visit WHERE srch_co IS NOT NULL", "visit"
    ),
    "json_reject_rows": _sql(
        f"SELECT substr(m, 1, CAST(length(m) // 2 AS INT)) AS value FROM (SELECT {_MESSAGE} AS m FROM visit WHERE srch_co IS NULL)",
        "visit",
    ),
    "stream_file_source": "SELECT event_id, user_id, event_type, value FROM events",
    "stream_append_sink": _sql("SELECT _time, userid, ip, request, status, bytes FROM click", "click"),
    "stream_complete_sink": _sql(
        """SELECT city, wthr_date, count(*) AS observations, max(avg_tmpr_c) AS max_t, min(avg_tmpr_c) AS min_t
    FROM hotel_weather GROUP BY city, wthr_date""",
        "hotel_weather",
    ),
    "sink_drop_null_records": _sql(
        "SELECT * EXCLUDE (ts) FROM user_click WHERE username IS NOT NULL OR city IS NOT NULL", "user_click"
    ),
    "copy_one_day_per_cycle": _sql(
        """SELECT address, avg_tmpr_c, wthr_date FROM hotel_weather WHERE wthr_date IN
    (SELECT DISTINCT wthr_date FROM hotel_weather ORDER BY wthr_date LIMIT 3)""",
        "hotel_weather",
    ),
    # Cleansing
    "missing_coords": _sql(
        """SELECT * FROM hotel WHERE "Latitude" IS NULL OR "Longitude" IS NULL
    OR regexp_matches("Latitude", 'NA') OR regexp_matches("Longitude", 'NA')""",
        "hotel",
    ),
    "repair_coords": _sql("SELECT * FROM repaired", "repaired"),
    "geohash4_hotels": _sql("SELECT * FROM hotel_cell", "hotel_cell"),
    "geohash4_weather": _sql('SELECT lng, lat, wthr_date, "Geohash" FROM weather_cell', "weather_cell"),
    "mask_field": _sql(
        "SELECT id, '0000-00-00 00:00:00' AS date_time, srch_ci, srch_co, hotel_id FROM visit", "visit"
    ),
    "silver_projection": _sql("SELECT * FROM silver", "silver"),
    "clean_column_names": "SELECT * FROM part",
    "null_profile": _sql(
        """SELECT 'Id' AS "column", false AS has_nulls UNION ALL SELECT 'Name', bool_or("Name" IS NULL) FROM hotel
    UNION ALL SELECT 'Country', bool_or("Country" IS NULL) FROM hotel
    UNION ALL SELECT 'City', bool_or("City" IS NULL) FROM hotel
    UNION ALL SELECT 'Address', bool_or("Address" IS NULL) FROM hotel
    UNION ALL SELECT 'Latitude', bool_or("Latitude" IS NULL) FROM hotel
    UNION ALL SELECT 'Longitude', bool_or("Longitude" IS NULL) FROM hotel""",
        "hotel",
    ),
    "threshold_label": "SELECT vec_id, label, CAST(label >= 7 AS INT) AS high FROM embeddings",
    "tagged_union": """SELECT c_name AS name, c_acctbal AS balance, 0 AS is_supplier FROM customer
    UNION ALL SELECT s_name, s_acctbal, 1 FROM supplier""",
    "distinct_rows": _sql(
        """SELECT DISTINCT 'year_month' AS kind, year, month FROM hotel_weather
    UNION ALL SELECT DISTINCT 'month', CAST(NULL AS INT), month FROM hotel_weather
    UNION ALL SELECT DISTINCT 'check_in_month', CAST(NULL AS INT), month_ci FROM joined""",
        "hotel_weather",
        "joined",
    ),
    # Stays
    "stay_length": _sql(
        """SELECT hotel_id, srch_ci, srch_co, CAST(nights AS INT) AS datediff, round(apart, 2) AS monthdiff
    FROM months_apart""",
        "months_apart",
    ),
    "long_stays": _sql(
        "SELECT hotel_id, srch_ci, srch_co, CAST(nights AS INT) AS datediff FROM stay WHERE nights > 365", "stay"
    ),
    "stay_category_ref": _sql(f"SELECT {_STAY}, {_CODED} AS category FROM {_NIGHTS}", "stay"),
    "stay_category_spec": _sql(f"SELECT {_STAY}, {_STATED} AS category FROM {_NIGHTS}", "stay"),
    "stay_category_stream": _sql(f"SELECT {_STAY}, {_CODED} AS category FROM {_NIGHTS} WHERE srch_co IS NOT NULL", "stay"),
    "stay_category_rejects": _sql(
        f"SELECT substr(m, 1, CAST(length(m) // 2 AS INT)) AS value FROM (SELECT {_MESSAGE} AS m FROM visit WHERE srch_co IS NULL)",
        "visit",
    ),
    # Streams that keep tables
    "users_changelog": f"SELECT user_id, username, city FROM ({_USERS_AFTER})",
    "user_clickstream_changing": _sql(
        f"""SELECT userid, u.username, ip, u.city, request, status, bytes FROM click c LEFT JOIN (
    SELECT 0 AS part, user_id, username, city FROM web_user
    UNION ALL SELECT 1, user_id, username, city FROM ({_USERS_AFTER})) u ON u.user_id = userid AND u.part = _time % 2""",
        "click",
        "web_user",
    ),
    "events_per_min_closed": _sql(
        f"""SELECT userid, "EVENT_TS", count(*) AS events FROM ({_ARRIVED})
    WHERE NOT late AND closes <= (SELECT max(_time) - 10 * {_DAY_MS} FROM click) GROUP BY ALL""",
        "click",
    ),
    "events_per_min_late": _sql(f'SELECT userid, "EVENT_TS", _time FROM ({_ARRIVED}) WHERE late', "click"),
    "stay_months_ref": _sql(f'SELECT {_STAY}, m AS "dtMonth" FROM {_EVERY_MONTH}', "months_apart"),
    "stay_months_spec": _sql(f'SELECT {_STAY}, m AS "dtMonth" FROM {_TOUCHED}', "stay"),
    "extended_stay_filter_ref": _sql(f"SELECT {_STAY} FROM stay WHERE {_EDGE}", "stay"),
    "extended_stay_filter_spec": _sql(f"SELECT {_STAY} FROM stay WHERE nights > 7", "stay"),
    # Joins
    "semi_prefilter": _sql(
        'SELECT * FROM weather_cell WHERE "Geohash" IN (SELECT "Geohash" FROM hotel_cell)',
        "weather_cell",
        "hotel_cell",
    ),
    "join_geohash_inner": _sql(
        'SELECT * FROM hotel_cell JOIN weather_cell USING ("Geohash")', "weather_cell", "hotel_cell"
    ),
    "join_geohash_left": _sql(
        'SELECT * FROM hotel_cell LEFT JOIN weather_cell USING ("Geohash")', "weather_cell", "hotel_cell"
    ),
    "join_geohash_daily": _sql(
        f"""SELECT * FROM hotel_cell LEFT JOIN (SELECT "Geohash", wthr_date, avg(avg_tmpr_c) AS mean_tmpr_c,
    count(*) AS measurements FROM weather_cell GROUP BY ALL) USING ("Geohash")""",
        "weather_cell",
        "hotel_cell",
    ),
    "join_unmatched": _sql(
        """SELECT * FROM hotel_cell LEFT JOIN weather_cell USING ("Geohash")
    EXCEPT SELECT * FROM hotel_cell JOIN weather_cell USING ("Geohash")""",
        "weather_cell",
        "hotel_cell",
    ),
    "visit_weather_full": _sql(
        """SELECT v.* EXCLUDE (id), d.* EXCLUDE (id) FROM visit v JOIN daily d
    ON v.hotel_id = CAST(d.id AS BIGINT) AND v.srch_ci = d.wthr_date""",
        "visit",
        "daily",
    ),
    "visit_weather_sizes": _sql(
        """SELECT year, month, day, count(*) AS rows FROM visit JOIN hotel_weather
    ON visit.hotel_id = CAST(hotel_weather.id AS BIGINT) GROUP BY ALL""",
        "visit",
        "hotel_weather",
    ),
    "visit_hotel_left": _sql(
        f"SELECT srch_ci, srch_co, month_ci, month_co, hotel_id, address, visits FROM {_NAMED}", "stay", "hotel_weather"
    ),
    "topn_by_selfjoin": _sql(
        """SELECT t1.address, t1.month, t1.avg_tmpr_c, t1.wthr_date FROM daily t1 JOIN daily t2
    ON t1.month = t2.month AND t2.avg_tmpr_c >= t1.avg_tmpr_c GROUP BY ALL HAVING count(*) <= 10""",
        "daily",
    ),
    "stay_weather_range": _sql(
        f"""SELECT DISTINCT hotel_id, address, avg_tmpr_c, wthr_date, srch_ci, srch_co, city, country, "geoHash",
    year, month FROM stay JOIN hotel_day ON hotel_id = hid WHERE {_EDGE} AND d BETWEEN ci_d AND co_d""",
        "stay",
        "hotel_day",
    ),
    "stay_edges": _sql(
        f"""SELECT hotel_id, address, avg_tmpr_c, wthr_date, srch_ci, srch_co,
    CASE WHEN d = ci_d THEN avg_tmpr_c END AS avg_tmpr_c_ci, CASE WHEN d = co_d THEN avg_tmpr_c END AS avg_tmpr_c_co,
    count(*) AS visits FROM stay JOIN hotel_day ON hotel_id = hid
    WHERE {_EDGE} AND (d = ci_d OR d = co_d OR d BETWEEN co_d AND ci_d) GROUP BY ALL""",
        "stay",
        "hotel_day",
    ),
    # Marts
    "temp_range_month": _sql(f"SELECT address, month, tmpr_diff_cmax FROM ({_RANGE})", "hotel_weather"),
    "top10_temp_range": _sql(
        _ranked(f"({_RANGE})", "month", "tmpr_diff_cmax DESC, address", "address, month, tmpr_diff_cmax"),
        "hotel_weather",
    ),
    "top10_obs_month": _sql(
        _ranked("hotel_weather", "month", "avg_tmpr_c DESC, address, wthr_date", "address, month, avg_tmpr_c, wthr_date"),
        "hotel_weather",
    ),
    "month_summary": _sql(
        """SELECT month, count(month) AS observations, max(avg_tmpr_c) AS avg_tmpr_cmax FROM hotel_weather
    GROUP BY month""",
        "hotel_weather",
    ),
    "year_month_count": _sql("SELECT year, month, count(month) AS cm FROM hotel_weather GROUP BY ALL", "hotel_weather"),
    "max_temp_hotel_month": _sql(
        "SELECT address, month, max(avg_tmpr_c) AS avg_tmpr_cmax FROM hotel_weather GROUP BY ALL", "hotel_weather"
    ),
    "max_temp_one_month": _sql(
        """SELECT address, month, max(avg_tmpr_c) AS avg_tmpr_cmax FROM hotel_weather WHERE month = 8
    GROUP BY ALL ORDER BY avg_tmpr_cmax DESC, address LIMIT 10""",
        "hotel_weather",
    ),
    "obs_count_hotel": _sql(
        """SELECT month, address, count(address) AS visitors FROM hotel_weather GROUP BY ALL
    ORDER BY visitors DESC, month, address LIMIT 10""",
        "hotel_weather",
    ),
    "obs_count_hotel_month": _sql(
        "SELECT address, count(address) AS visitors FROM hotel_weather WHERE month = 8 GROUP BY ALL", "hotel_weather"
    ),
    "obs_count_hotel_day": _sql(
        "SELECT day, address, count(address) AS visitors FROM hotel_weather WHERE month = 8 GROUP BY ALL",
        "hotel_weather",
    ),
    "union_top10_months": _sql(
        " UNION ALL ".join(
            f"(SELECT * FROM hotel_weather WHERE month = {m} ORDER BY avg_tmpr_c DESC, address, wthr_date LIMIT 10)"
            for m in (8, 9, 10)
        ),
        "hotel_weather",
    ),
    "union_top10_obs": _sql(
        " UNION ALL ".join(
            f"""(SELECT month, address, count(address) AS visitors FROM hotel_weather WHERE month = {m}
    GROUP BY ALL ORDER BY visitors DESC, address LIMIT 10)"""
            for m in (8, 9, 10)
        ),
        "hotel_weather",
    ),
    "union_top10_joined": _sql(
        _ranked(_LISTED(_JOINED), "month", "visitors DESC, month_ci NULLS FIRST, month_co NULLS FIRST, address", "month, month_ci, month_co, address, visitors"),
        "joined",
    ),
    "union_top10_visits": _sql(
        _ranked(_LISTED(_VISITS), "month", "visitors DESC, month_ci NULLS FIRST, month_co NULLS FIRST, hotel_id", "month, month_ci, month_co, hotel_id, visitors"),
        "stay",
    ),
    "union_top10_guests": _sql(
        _ranked(_LISTED(_GUESTS), "month", "visitors DESC, month_ci NULLS FIRST, month_co NULLS FIRST, address, srch_adults_cnt", "month, month_ci, month_co, address, visitors"),
        "joined",
    ),
    "visits_ci_co_month": _sql(
        f"""SELECT * FROM ({_VISITS}) WHERE month_ci = 10 OR month_co = 10
    ORDER BY visitors DESC, month_ci NULLS FIRST, month_co NULLS FIRST, hotel_id LIMIT 10""",
        "stay",
    ),
    "visits_two_months": _sql(
        f"SELECT * FROM ({_JOINED}) WHERE month_ci = 8 AND month_co = 9 ORDER BY visitors DESC, address LIMIT 10",
        "joined",
    ),
    "joined_visitors": _sql(_JOINED, "joined"),
    "joined_visitors_one_month": _sql(
        """SELECT address, count(address) AS visitors FROM joined WHERE month_ci = 8 OR month_co = 8
    GROUP BY address ORDER BY visitors DESC, address LIMIT 10""",
        "joined",
    ),
    "guests_per_stay": _sql(
        f"""SELECT month_ci, month_co, address, visitors FROM ({_GUESTS}) WHERE month_ci = 8 OR month_co = 8
    ORDER BY visitors DESC, month_ci NULLS FIRST, month_co NULLS FIRST, address, srch_adults_cnt LIMIT 10""",
        "joined",
    ),
    "visits_by_exact_stay": _sql(
        _ranked(
            "(SELECT srch_ci, srch_co, month_ci, month_co, hotel_id, count(hotel_id) AS visitors FROM stay GROUP BY ALL)",
            "month_ci",
            "visitors DESC, hotel_id, srch_ci NULLS FIRST, srch_co NULLS FIRST",
            "srch_ci, srch_co, month_ci, month_co, hotel_id, visitors",
            "AND srch_ci IS NOT NULL",
        ),
        "stay",
    ),
    "visits_by_exact_stay_named": _sql(
        _ranked(
            _NAMED,
            "month_ci",
            "visits DESC, hotel_id, srch_ci NULLS FIRST, srch_co NULLS FIRST, address NULLS FIRST",
            "srch_ci, srch_co, month_ci, month_co, hotel_id, address, visits",
            "AND srch_ci IS NOT NULL",
        ),
        "stay",
        "hotel_weather",
    ),
    "top10_busy_ref": _BUSY,
    "top10_busy_spec": _sql(
        _ranked(
            f"""(SELECT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month, hotel_id, count(*) AS visits
    FROM {_TOUCHED} GROUP BY ALL)""",
            "year, month",
            "visits DESC, hotel_id",
            "year, month, hotel_id, visits",
        ),
        "stay",
    ),
    "stay_trend_ref": _sql(
        f"""SELECT da.address, da.avg_tmpr_c, da.wthr_date, da.srch_ci, da.srch_co, da.avg_tmpr_c AS avg_tmpr_c_co,
    db.avg_tmpr_c AS avg_tmpr_c_ci, {_HALF_UP('abs(da.avg_tmpr_c - db.avg_tmpr_c)')} AS weather_trend,
    {_HALF_UP('(da.avg_tmpr_c + db.avg_tmpr_c) / 2')} AS avg_tmpr_c_visits, count(*) AS copies
    FROM (SELECT * FROM stay JOIN hotel_day ON hotel_id = hid WHERE {_EDGE} AND d = co_d) da
    JOIN (SELECT * FROM stay JOIN hotel_day ON hotel_id = hid WHERE {_EDGE} AND d = ci_d) db
    ON da.srch_ci = db.srch_ci AND da.address = db.address GROUP BY ALL""",
        "stay",
        "hotel_day",
    ),
    "stay_trend_spec": _sql(
        f"""SELECT hotel_id, address, srch_ci, srch_co, visits,
    {_HALF_UP('arg_max(avg_tmpr_c, d) - arg_min(avg_tmpr_c, d)')} AS weather_trend,
    avg(avg_tmpr_c) AS avg_tmpr_c_stay,
    count(*) AS days_observed FROM (SELECT hotel_id, srch_ci, srch_co, ci_d, co_d, count(*) AS visits FROM stay
    WHERE nights > 7 GROUP BY ALL) JOIN hotel_day ON hotel_id = hid AND d BETWEEN ci_d AND co_d
    GROUP BY hotel_id, address, srch_ci, srch_co, visits""",
        "stay",
        "hotel_day",
    ),
    "sink_partitioned_busy": _BUSY,
    "category_hotels": _sql(
        f"""SELECT {_STATED} AS category, count(*) AS hotels, count(DISTINCT hotel_id) AS distinct_hotels
    FROM {_NIGHTS} GROUP BY 1""",
        "stay",
    ),
    "city_day_exact": _sql("SELECT * FROM gold", "gold"),
    "top10_cities": _sql("SELECT * FROM city_rank", "city_rank"),
    "city_series": _sql("SELECT * FROM gold JOIN city_rank USING (city)", "gold", "city_rank"),
    "city_series_first": _sql("SELECT * FROM gold JOIN city_rank USING (city) WHERE rank = 1", "gold", "city_rank"),
    # Clickstream, as tables and as streams
    **{name: _sql(body, *reads) for name, (body, reads) in _CLICKS.items()},
    **{f"{name}_stream": _sql(body, *reads) for name, (body, reads) in _CLICKS.items()},
    # Approximate distinct counts; a city has few hotels a day, where the sketch is exact.
    "medallion_city_day": _sql("SELECT * FROM gold", "gold"),
    # Rollups
    "roll_alert_status": _rollup(
        _CLICKS["errors_per_min_alert"][0], "max(errors)", "max_errors", ["status"], ("click",)
    ),
    "roll_ip_user_city": _rollup(
        _CLICKS["user_ip_activity"][0], "count(*)", "records", ["ip", "username", "city"], ("user_click",), False
    ),
    "roll_sessions": _rollup(
        _CLICKS["click_user_sessions"][0], "max(events)", "max_events", ["username"], ("user_click",)
    ),
    "roll_pages": _rollup(_CLICKS["pages_per_min"][0], "avg(pages)", "avg_pages", [], ("click",)),
    "roll_codes": _rollup(
        _CLICKS["enriched_error_codes_count"][0], 'max("count")', "max_count", ["code", "definition"], ("code_click",)
    ),
    "roll_events": _rollup(_CLICKS["events_per_min"][0], "max(events)", "max_events", [], ("click",)),
    "roll_kbytes": _rollup(
        _CLICKS["user_session_kbytes"][0], "max(kbytes)", "max_kbytes", ["username", "ip"], ("user_click",)
    ),
    # Tabular models
    "train_test_split": """SELECT vec_id, CAST('0x' || substr(md5('123:' || vec_id), 1, 8) AS BIGINT) % 100 < 75
    AS is_train FROM embeddings""",
    "rf_baseline": """SELECT 10::BIGINT AS trees, count(*) FILTER (is_train) AS train_rows,
    count(*) FILTER (NOT is_train) AS test_rows, true AS is_auc FROM (SELECT
    CAST('0x' || substr(md5('123:' || vec_id), 1, 8) AS BIGINT) % 100 < 75 AS is_train FROM embeddings)""",
    "feature_importance": """SELECT 'f' || i AS feature, i IN (3, 7) AS is_top, 1.0::DOUBLE AS total
    FROM (SELECT unnest(range(max(len(embedding)))) AS i FROM embeddings)""",
    "stored_model_scores": "SELECT vec_id, true AS read_agrees, true AS sql_agrees FROM embeddings",
    "tuned_sweep": """SELECT CAST(unnest(range(1, 7)) AS INT) AS place, true AS is_auc, true AS in_range
    FROM (SELECT 1 FROM embeddings LIMIT 1)""",
    "batch_score": _SCORES,
    "score_udf": _SCORES,
    "label_histogram": "SELECT label, count(*) AS rows FROM embeddings GROUP BY label",
    "box_stats_by_label": """SELECT label, feature, round(min(value), 6) AS min,
    round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
    round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max
    FROM (SELECT label, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS feature,
    CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings) GROUP BY label, feature""",
}

for _name, _by in {"roll_alert_status": ["status"], "roll_sessions": ["username"], "roll_events": []}.items():
    _keys = "".join(f"{c}, " for c in _by)
    ORACLES[f"{_name}_filled"] = f"""WITH r AS ({ORACLES[_name]}) SELECT * FROM (SELECT {_keys}
    unnest(generate_series(low, high, {_DAY_MS})) AS bucket FROM (SELECT {_keys} min(bucket) AS low, max(bucket) AS high
    FROM r {'GROUP BY ALL' if _by else ''})) LEFT JOIN r USING ({_keys}bucket)"""
ORACLES["sink_partitioned_ci"] = ORACLES["joined_visitors"]
ORACLES["sink_partitioned_stays"] = f"SELECT *, substr(srch_ci, 1, 7) AS ci_month FROM ({ORACLES['stay_edges']})"
for _name, _columns in MEANS.items():
    _shown = ", ".join(f"round({c}, {MEAN_PLACES}) AS {c}" for c in _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({_shown}) FROM ({ORACLES[_name]})"
