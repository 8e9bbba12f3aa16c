"""For every registered query the SQL that a plain database answers it with.

Written from the definitions, not from the Spark plans: joins and frames are
used freely here where the Spark form avoids them for scale.
"""

from __future__ import annotations

HOUR = 3_600_000_000
DAY = 24 * HOUR
FIVE_MINUTES = 300_000_000

BEHAVIOR = """behavior AS (
  SELECT event_id, user_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS item_id,
         event_type AS behavior, ts, epoch_us(ts) AS us FROM events)"""
SENSOR = """sensor AS (
  SELECT event_id, 'sensor_' || user_id AS id, value AS temperature, ts,
         epoch_us(ts) AS us FROM events)"""
LOGINS = """logins AS (
  SELECT event_id, user_id,
         '10.0.0.' || regexp_extract(props, '[0-9]+') AS ip,
         CASE event_type WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'success'
              ELSE event_type END AS event_type, epoch_us(ts) AS us FROM events)"""
ORDER_EVENTS = """order_events AS (
  SELECT event_id, user_id AS order_id,
         CASE event_type WHEN 'signup' THEN 'create' ELSE 'pay' END AS event_type,
         epoch_us(ts) AS us, ts
  FROM events WHERE event_type IN ('signup', 'purchase'))"""
MONEY = """money AS (
  SELECT user_id, event_id, ts, epoch_us(ts) AS us,
         CAST(round(value * 100) AS BIGINT) AS cents, event_type FROM events)"""
ARRIVALS = f"""arrivals AS (
  SELECT event_id, user_id, epoch_us(ts) AS us,
         epoch_us(ts) + (event_id * 7919 % 97) * 240000000 AS arrived FROM events),
watermarked AS (
  SELECT *, max(us) OVER (ORDER BY arrived, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
  FROM arrivals)"""


def tumbling(source: str, size: int, keys: str, agg: str, where: str = "true") -> str:
    """Aggregate per epoch-aligned window, named by its end in milliseconds."""
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}((us // {size}) + 1) * {size} // 1000 AS window_end, {agg}
FROM {source} WHERE {where} GROUP BY {lead}((us // {size}) + 1) * {size} // 1000"""


def sliding(
    source: str, size: int, slide: int, keys: str, agg: str, where: str = "true"
) -> str:
    """As ``tumbling``, each row copied to all windows that contain it."""
    lead = f"{keys}, " if keys else ""
    return f"""SELECT {lead}w // 1000 AS window_end, {agg} FROM (
  SELECT *, unnest(range((us // {slide} + 1) * {slide},
                         (us // {slide} + 1) * {slide} + {size}, {slide})) AS w
  FROM {source} WHERE {where}) GROUP BY {lead}w"""


def ranked(counts: str, by: str, tie: str, n: int) -> str:
    return f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end
                               ORDER BY {by} DESC, {tie}) AS rank
  FROM ({counts})) WHERE rank <= {n}"""


def bit_offset(text: str) -> str:
    return f"""list_reduce(list_prepend(0::BIGINT, list_transform(
  str_split({text}, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, x: (a * 61 + x) % 536870912)"""


def string_hash(text: str, factor: int) -> str:
    low = f"""(list_reduce(list_prepend(0::BIGINT, list_transform(
  str_split({text}, ''), lambda x: ascii(x)::BIGINT)),
  lambda a, x: (a * 31 + x) % 4294967296)::HUGEINT * {factor}) % 4294967296"""
    return f"""CAST(CASE WHEN {low} >= 2147483648 THEN {low} - 4294967296
                     ELSE {low} END AS INTEGER)"""


def greedy_alerts(rows: str, key: str, hold: int, at_least: int) -> str:
    """Windows opened by the first arming row outside the window before."""
    return f"""WITH RECURSIVE {rows},
islands AS (
  SELECT *, sum(CASE WHEN resets THEN 1 ELSE 0 END)
              OVER (PARTITION BY {key} ORDER BY us, event_id) AS island
  FROM flagged),
arming AS (SELECT {key}, us, island FROM islands WHERE arms),
ends AS (
  SELECT {key}, island - 1 AS island, min(us) AS reset_us
  FROM islands WHERE resets GROUP BY {key}, island),
opened AS (
  SELECT {key}, island, min(us) AS at_us FROM arming GROUP BY {key}, island
  UNION ALL
  SELECT o.{key}, o.island,
         (SELECT min(a.us) FROM arming a
          WHERE a.{key} IS NOT DISTINCT FROM o.{key} AND a.island = o.island
            AND a.us > o.at_us + {hold})
  FROM opened o WHERE o.at_us IS NOT NULL)
SELECT o.{key}, o.at_us AS opened_us, count(*) AS n
FROM opened o
JOIN arming a ON a.{key} IS NOT DISTINCT FROM o.{key} AND a.island = o.island
             AND a.us BETWEEN o.at_us AND o.at_us + {hold}
LEFT JOIN ends e ON e.{key} IS NOT DISTINCT FROM o.{key} AND e.island = o.island
WHERE e.reset_us IS NULL OR e.reset_us > o.at_us + {hold}
GROUP BY o.{key}, o.at_us, o.island HAVING count(*) >= {at_least}"""


def pattern(select: str, where: str) -> str:
    return f"""WITH {LOGINS}, steps AS (
  SELECT user_id, event_type, us, ip,
         lead(event_type, 1) OVER w AS t2, lead(us, 1) OVER w AS us2,
         lead(ip, 1) OVER w AS ip2,
         lead(event_type, 2) OVER w AS t3, lead(us, 2) OVER w AS us3,
         lead(ip, 2) OVER w AS ip3
  FROM logins WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
SELECT {select} FROM steps WHERE {where}"""


def order_pairs(select: str, where: str) -> str:
    return f"""WITH {ORDER_EVENTS}, pairs AS (
  SELECT order_id, event_type, us,
         lead(event_type) OVER w AS next_type, lead(us) OVER w AS next_us
  FROM order_events WINDOW w AS (PARTITION BY order_id ORDER BY us, event_id))
SELECT {select} FROM pairs WHERE event_type = 'create' AND {where}"""


RECONCILE = f"""WITH {ORDER_EVENTS}, near AS (
  SELECT *, lag(event_type) OVER w AS prev_type, lag(us) OVER w AS prev_us,
         lead(event_type) OVER w AS next_type, lead(us) OVER w AS next_us,
         lead(event_id) OVER w AS next_id,
         row_number() OVER w AS place
  FROM order_events WINDOW w AS (PARTITION BY order_id ORDER BY us, event_id)),
stretches AS (
  SELECT *, max(CASE WHEN prev_type IS NULL OR prev_type = event_type
                       OR us - prev_us > {DAY} THEN place END)
              OVER (PARTITION BY order_id ORDER BY us, event_id) AS began
  FROM near),
waiting AS (
  SELECT *, coalesce(next_us - us <= {DAY}, false) AS in_time
  FROM stretches WHERE (place - began) % 2 = 0)
"""

RISES = f"""{SENSOR}, lagged AS (
  SELECT *, lag(temperature) OVER (PARTITION BY id ORDER BY us, event_id) AS prev
  FROM sensor),
flagged AS (
  SELECT id, us, event_id,
         prev IS NOT NULL AND prev <> 0 AND temperature > prev AS arms,
         prev IS NULL OR prev = 0 OR temperature < prev AS resets
  FROM lagged)"""

FAILS = f"""{LOGINS}, flagged AS (
  SELECT user_id, us, event_id, event_type = 'fail' AS arms,
         event_type = 'success' AS resets FROM logins)"""

HOT_ITEMS = f"""WITH {BEHAVIOR} {ranked(
    sliding("behavior", HOUR, FIVE_MINUTES, "item_id", "count(*) AS n",
            "behavior = 'view'"), "n", "item_id", 3)}"""

UV_BITMAP = f"""WITH {BEHAVIOR} {tumbling(
    "behavior", HOUR, "", f"count(DISTINCT {bit_offset('user_id::VARCHAR')}) AS uv",
    "behavior = 'view'")}"""

ORACLES: dict[str, str] = {
    "q1_hot_items_top3": HOT_ITEMS,
    "q2_hot_items_sql_hop": HOT_ITEMS,
    "q3_hot_items_tumble_rank": f"""WITH {BEHAVIOR} {ranked(
        tumbling("behavior", HOUR, "item_id", "count(*) AS icount",
                 "behavior = 'view'"), "icount", "item_id", 3)}""",
    "q4_hot_item_documents": f"""WITH {BEHAVIOR},
top AS ({ranked(sliding("behavior", HOUR, FIVE_MINUTES, "item_id", "count(*) AS n",
                        "behavior = 'view'"), "n", "item_id", 1)})
SELECT window_end::VARCHAR AS doc_id,
       '{{"window_end":' || window_end || ',"item_id":' || item_id || ',"n":' || n || '}}'
         AS document FROM top""",
    "q5_hot_urls": f"""WITH {BEHAVIOR},
log AS (SELECT '/item/' || item_id AS url, us // 1000000 * 1000000 AS us FROM behavior)
{ranked(sliding("log", HOUR, FIVE_MINUTES, "url", "count(*) AS n"), "n", "url", 1)}""",
    "q6_pv_hourly": f"""WITH {BEHAVIOR} {tumbling(
        "behavior", HOUR, "", "count(*) AS pv", "behavior = 'view'")}""",
    "q7_uv_exact": f"""WITH {BEHAVIOR} {tumbling(
        "behavior", HOUR, "", "count(DISTINCT user_id) AS uv", "behavior = 'view'")}""",
    "q8_uv_two_stage": f"""WITH {BEHAVIOR} {tumbling(
        "behavior", HOUR, "", "count(DISTINCT user_id) AS uv", "behavior = 'view'")}""",
    "q9_uv_bitmap_tumble": UV_BITMAP,
    "q9_uv_bitmap_slide": f"""WITH {BEHAVIOR} {sliding(
        "behavior", HOUR, FIVE_MINUTES, "",
        f"count(DISTINCT {bit_offset('user_id::VARCHAR')}) AS uv",
        "behavior = 'view'")}""",
    "q10_marketing_by_channel": f"""WITH {BEHAVIOR}, marketing AS (
  SELECT CASE WHEN item_id % 2 = 0 THEN 'channel_even' ELSE 'channel_odd' END AS channel,
         behavior, us FROM behavior)
{sliding("marketing", 6 * HOUR, HOUR, "channel, behavior", "count(*) AS n",
         "behavior <> 'error'")}""",
    "q10_marketing_total": f"""WITH {BEHAVIOR} {sliding(
        "behavior", 6 * HOUR, HOUR, "", "count(*) AS n", "behavior <> 'error'")}""",
    "q11_login_fail_pattern": pattern(
        """user_id, ip AS first_ip, ip2 AS second_ip, ip3 AS third_ip,
           us AS first_us, us2 AS second_us, us3 AS third_us""",
        f"event_type = 'fail' AND t2 = 'fail' AND t3 = 'fail' AND us3 - us < {2 * DAY}",
    ),
    "q11_login_fail_state": greedy_alerts(FAILS, "user_id", 2 * DAY, 3),
    "q12_order_matched": order_pairs(
        "order_id, us AS create_us, next_us AS pay_us",
        f"next_type = 'pay' AND next_us - us < {DAY}",
    ),
    "q12_order_timeout": order_pairs(
        "order_id, us AS create_us", f"(next_us IS NULL OR next_us - us >= {DAY})"
    ),
    "q12_order_timeout_state": f"""WITH {ORDER_EVENTS}, placed AS (
  SELECT *, min(us) OVER (PARTITION BY order_id ORDER BY us
                          RANGE BETWEEN {DAY} PRECEDING AND CURRENT ROW) + {DAY} AS fires_us
  FROM order_events)
SELECT order_id, min(us) AS create_us, fires_us FROM placed
GROUP BY order_id, fires_us HAVING bool_and(event_type = 'create')""",
    "q13_recon_matched": RECONCILE
    + """SELECT order_id, event_id AS first_event, next_id AS second_event
FROM waiting WHERE in_time AND next_type <> event_type""",
    "q13_recon_unmatched": RECONCILE
    + """SELECT order_id,
       CASE event_type WHEN 'create' THEN 'order' ELSE 'pay' END AS side,
       coalesce(in_time AND next_type = event_type, false) AS superseded, event_id
FROM waiting WHERE NOT coalesce(in_time AND next_type <> event_type, false)""",
    "q14_sensor_min": f"""WITH {SENSOR} {tumbling(
        "sensor", DAY, "id", "min(temperature) AS lowest")}""",
    "q14_sensor_minmax": f"""WITH {SENSOR} {tumbling(
        "sensor", DAY, "id",
        "min(temperature) AS min_value, max(temperature) AS max_value")}""",
    "q14_sensor_avg": f"""WITH {SENSOR} {tumbling(
        "sensor", DAY, "id", "round(avg(temperature), 6) AS average")}""",
    "q14_sensor_count": f"""WITH {SENSOR} {tumbling(
        "sensor", DAY, "id", "count(*) AS n")}""",
    "q14_sensor_tumble_sql": f"""WITH {SENSOR} {tumbling(
        "sensor", DAY, "id", "count(*) AS n")}""",
    "q15_jump_alert_default0": f"""WITH {SENSOR}, lagged AS (
  SELECT id, us AS ts_us, temperature,
         coalesce(lag(temperature) OVER (PARTITION BY id ORDER BY us, event_id), 0.0)
           AS previous FROM sensor)
SELECT * FROM lagged WHERE abs(temperature - previous) > 50.0""",
    "q15_jump_alert_skip_first": f"""WITH {SENSOR}, lagged AS (
  SELECT id, us AS ts_us, temperature,
         lag(temperature) OVER (PARTITION BY id ORDER BY us, event_id) AS previous
  FROM sensor)
SELECT * FROM lagged WHERE abs(temperature - previous) > 50.0""",
    "q15_rising_run": greedy_alerts(RISES, "id", 6 * HOUR, 1),
    "q15_freezing": f"""WITH {SENSOR}
SELECT event_id, 'freezing alarm: ' || id AS message FROM sensor
WHERE temperature < 32.0""",
    "q15_gate": f"""SELECT r.event_id, r.user_id, r.value FROM events r
WHERE r.event_type <> 'signup' AND EXISTS (
  SELECT 1 FROM events s WHERE s.event_type = 'signup'
    AND s.user_id IS NOT DISTINCT FROM r.user_id
    AND epoch_us(r.ts) >= epoch_us(s.ts) AND epoch_us(r.ts) < epoch_us(s.ts) + {6 * HOUR})""",
    "q16_word_count": r"""WITH t AS (
  SELECT regexp_replace(text, '(\s)+$', '') AS text FROM documents
  WHERE text <> '' AND NOT regexp_full_match(text, '\s+')),
w AS (SELECT unnest(regexp_split_to_array(text, '\s')) AS word FROM t)
SELECT word, count(*) AS n FROM w GROUP BY word""",
    "q16_word_count_windowed": f"""WITH w AS (
  SELECT epoch_us(ts) AS us, unnest(str_split(props, ' ')) AS word FROM events)
{tumbling("w", DAY, "word", "count(*) AS n")}""",
    "s1_behavior_file": f"""WITH {BEHAVIOR}
SELECT user_id, item_id, 1 AS category_id, behavior, us // 1000000 * 1000000 AS ts_us
FROM behavior""",
    "s2_access_log": f"""WITH {BEHAVIOR}
SELECT '10.0.0.' || item_id AS ip, user_id::VARCHAR AS user_id,
       us // 1000000 * 1000000 AS ts_us, 'GET' AS method, '/item/' || item_id AS url
FROM behavior""",
    "s1_behavior_rejects": f"""WITH {BEHAVIOR}
SELECT user_id || ',' || item_id || ',1,error,unknown' AS line FROM behavior
WHERE behavior = 'error'""",
    "s2_access_log_rejects": f"""WITH {BEHAVIOR}
SELECT '10.0.0.' || item_id || ' - ' || user_id || ' 99/99/2024 +0000 GET /item/'
         || item_id AS line FROM behavior WHERE behavior = 'error'""",
    "s3_keyed_times": f"""WITH k AS (SELECT event_type AS key, epoch_us(ts) AS us FROM events)
{tumbling("k", DAY, "key", "count(*) AS n")}""",
    "s4_kafka_decode": f"""WITH {BEHAVIOR}
SELECT user_id, item_id, CASE behavior WHEN 'view' THEN 'pv' ELSE behavior END AS behavior,
       us // 1000000 * 1000000 AS ts_us FROM behavior""",
    "s6_table_subset": f"""WITH {SENSOR}
SELECT id AS sensor, temperature AS reading, us AS rowtime_us FROM sensor""",
    "s7_sql_view": f"WITH {SENSOR} SELECT id, max(temperature) AS top FROM sensor GROUP BY id",
    "k5_latest_per_key": f"""WITH {SENSOR}, n AS (
  SELECT id, temperature, row_number() OVER (PARTITION BY id
                                             ORDER BY us DESC, event_id DESC) AS rn
  FROM sensor) SELECT id, temperature FROM n WHERE rn = 1""",
    "k8_visitor_store": f"""SELECT window_end::VARCHAR AS field, uv::VARCHAR AS stored
FROM ({UV_BITMAP})""",
    "k5_keyed_store": f"""WITH {SENSOR}, n AS (
  SELECT id, temperature, row_number() OVER (PARTITION BY id
                                             ORDER BY us DESC, event_id DESC) AS rn
  FROM sensor) SELECT id, temperature FROM n WHERE rn = 1""",
    "t1_map": f"WITH {SENSOR} SELECT event_id, id, temperature * 2 AS doubled FROM sensor",
    "t2_filter": f"WITH {SENSOR} SELECT event_id, temperature FROM sensor WHERE id = 'sensor_1'",
    "t3_filter_greater": "SELECT event_id, value FROM events WHERE value > 10",
    "t4_not_equal": f"""WITH {BEHAVIOR}
SELECT CASE WHEN item_id % 2 = 0 THEN 'channel_even' ELSE 'channel_odd' END AS channel,
       behavior, count(*) AS n
FROM behavior WHERE behavior <> 'error' GROUP BY 1, 2""",
    "t5_flatmap": """SELECT event_id, event_type FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'purchase'""",
    "t6_tokenise": r"""WITH t AS (
  SELECT doc_id, regexp_replace(text, '(\s)+$', '') AS text FROM documents
  WHERE text <> '' AND NOT regexp_full_match(text, '\s+'))
SELECT doc_id, unnest(regexp_split_to_array(text, '\s')) AS word FROM t""",
    "t7_table_select": f"WITH {SENSOR} SELECT id, temperature FROM sensor WHERE id = 'sensor_1'",
    "t8_rich_map": "SELECT event_id, event_id + 1 AS plus_one FROM events",
    "t9_split": """SELECT event_id, value,
       CASE WHEN value > 50 THEN 'large' ELSE 'small' END AS branch FROM events""",
    "t11_connect": f"""WITH {LOGINS}, {ORDER_EVENTS}
SELECT 'first: ' || event_type AS label, event_id FROM logins WHERE event_type <> 'view'
UNION ALL
SELECT 'second: ' || event_type, event_id FROM order_events WHERE event_type <> 'create'""",
    "t12_repartition": "SELECT event_id, user_id FROM events",
    "u1_union": """SELECT event_id, event_type FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'purchase')""",
    "j3_split_lateral": """SELECT p_partkey, p_name, word, CAST(length(word) AS INTEGER) AS length
FROM (SELECT p_partkey, p_name, unnest(str_split(p_name, ' ')) AS word FROM part)""",
    "j4_orders_without_payment": f"""WITH {ORDER_EVENTS}
SELECT order_id, us AS create_us FROM order_events c
WHERE event_type = 'create' AND NOT EXISTS (
  SELECT 1 FROM order_events p WHERE p.event_type = 'pay' AND p.order_id = c.order_id
    AND abs(p.us - c.us) <= {DAY})""",
    "a1_rolling_sum": f"""WITH {MONEY}
SELECT user_id, event_id, CAST(sum(cents) OVER w AS BIGINT) AS cents,
       first_value(event_type) OVER w AS event_type
FROM money WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id
                        ROWS UNBOUNDED PRECEDING)""",
    "a2_rolling_min": f"""WITH {MONEY}
SELECT user_id, event_id, min(cents) OVER w AS cents,
       first_value(event_type) OVER w AS event_type
FROM money WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id
                        ROWS UNBOUNDED PRECEDING)""",
    "a3_rolling_reduce": """SELECT l_orderkey, l_linenumber, l_partkey,
       string_agg(l_partkey::VARCHAR, ',') OVER (
         PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
         ROWS UNBOUNDED PRECEDING) AS parts FROM lineitem""",
    "a4_windowed_sum": f"""WITH {MONEY} {tumbling(
        "money", DAY, "user_id", "CAST(sum(cents) AS BIGINT) AS total")}""",
    "a5_sliding_min": f"""WITH {SENSOR} {sliding(
        "sensor", 2 * DAY, DAY, "id", "min(temperature) AS lowest")}""",
    "a14_min_max_row": f"""WITH {MONEY}
SELECT user_id, min(cents) AS lo, max(cents) AS hi FROM money GROUP BY user_id""",
    "a15_top2": f"""WITH {MONEY}, r AS (
  SELECT user_id, cents, row_number() OVER (PARTITION BY user_id
                                            ORDER BY cents DESC, event_id) AS rank
  FROM money) SELECT * FROM r WHERE rank <= 2""",
    "a15_top2_changelog": f"""WITH {MONEY}, v AS (
  SELECT user_id, event_id, row_number() OVER w AS nth, list_reverse_sort(list(cents) OVER w)[1:2] AS top
  FROM money WHERE cents IS NOT NULL
  WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)),
c AS (SELECT *, lag(top) OVER (PARTITION BY user_id ORDER BY nth) AS was FROM v),
p AS (SELECT user_id, event_id, rank, top[rank] AS new, was[rank] AS old FROM c, (SELECT unnest([1, 2]) AS rank))
SELECT user_id, event_id, true AS is_add, new AS cents, rank FROM p WHERE new IS NOT NULL AND new IS DISTINCT FROM old
UNION ALL
SELECT user_id, event_id, false, old, rank FROM p WHERE old IS NOT NULL AND new IS DISTINCT FROM old""",
    "a19_channel_counts": f"""WITH {BEHAVIOR}, marketing AS (
  SELECT CASE WHEN item_id % 2 = 0 THEN 'channel_even' ELSE 'channel_odd' END AS channel,
         behavior, us FROM behavior)
{sliding("marketing", 6 * HOUR, HOUR, "channel, behavior", "count(*) AS n")}""",
    "w4_busiest_users": f"""WITH {BEHAVIOR} {ranked(
        tumbling("behavior", DAY, "user_id", "count(*) AS n"), "n", "user_id", 5)}""",
    "w5_hot_items_report": f"""SELECT window_end,
       string_agg('No.' || rank || ' item=' || item_id || ' count=' || n, chr(10)
                  ORDER BY rank) AS report
FROM ({HOT_ITEMS}) GROUP BY window_end""",
    "f2_time_functions": """SELECT event_id, epoch_us(ts) // 1000000 * 1000 AS ms,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS text,
       epoch_us(ts) // 1000000 * 1000000 AS back_us FROM events""",
    "f5_scalar_functions": """SELECT event_id, abs(value - 50) AS distance,
       least(value, 10.0) AS low, greatest(value, 10.0) AS high,
       CAST(length(event_type) AS INTEGER) AS len, split_part(props, ' ', 1) AS head,
       event_type || ' at ' || user_id AS label FROM events""",
    "f7_java_hash": f"""SELECT c_custkey, {string_hash("c_name", 1)} AS h,
       {string_hash("c_name", 13)} AS h13, {bit_offset("c_name")} AS bit FROM customer""",
    "x1_hash_in_sql": f"SELECT c_custkey, {string_hash('c_name', 13)} AS h FROM customer",
    "x2_split_words": """SELECT p_partkey, p_name, word, CAST(length(word) AS INTEGER) AS length
FROM (SELECT p_partkey, p_name, unnest(str_split(p_name, ' ')) AS word FROM part)""",
    "st4_timers": f"""WITH {SENSOR}
SELECT DISTINCT id, us + 5000000 AS fires_us FROM sensor""",
    "st5_tumbling_close": f"""WITH {BEHAVIOR} {tumbling(
        "behavior", 6 * HOUR, "behavior", "count(*) AS n")}""",
    "st11_early_fire": f"""WITH {SENSOR}, placed AS (
  SELECT id, us, (us // {DAY} + 1) * {DAY} AS end_us FROM sensor),
opened AS (SELECT id, end_us, min(us) AS first_us FROM placed GROUP BY id, end_us),
fires AS (
  SELECT id, end_us,
         unnest(range((first_us // {HOUR} + 1) * {HOUR}, end_us + 1, {HOUR})) AS at_us
  FROM opened)
SELECT f.id, f.end_us // 1000 AS window_end, f.at_us // 1000 AS fire_at, count(*) AS n
FROM fires f JOIN placed p ON p.id = f.id AND p.end_us = f.end_us AND p.us < f.at_us
GROUP BY 1, 2, 3""",
    "st11b_fire_each_element": f"""WITH {BEHAVIOR}, seen AS (
  SELECT event_id, us, ((us // {HOUR}) + 1) * {HOUR} // 1000 AS window_end,
         {bit_offset("user_id::VARCHAR")} AS bit FROM behavior WHERE behavior = 'view'),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY window_end, bit ORDER BY us, event_id) AS rn
  FROM seen)
SELECT event_id, window_end,
       CAST(sum(CASE WHEN rn = 1 THEN 1 ELSE 0 END) OVER (
         PARTITION BY window_end ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)
         AS BIGINT) AS uv FROM firsts""",
    "st12_changelog": f"""WITH {MONEY}, versions AS (
  SELECT user_id, event_id, us, min(cents) OVER w AS lo, max(cents) OVER w AS hi
  FROM money WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id
                          ROWS UNBOUNDED PRECEDING)),
changes AS (
  SELECT *, lag(lo) OVER w AS old_lo, lag(hi) OVER w AS old_hi,
    row_number() OVER w > 1 AS again
  FROM versions WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
SELECT user_id, event_id, true AS is_add, lo, hi FROM changes
WHERE NOT again OR lo IS DISTINCT FROM old_lo OR hi IS DISTINCT FROM old_hi
UNION ALL
SELECT user_id, event_id, false, old_lo, old_hi FROM changes
WHERE again AND (lo IS DISTINCT FROM old_lo OR hi IS DISTINCT FROM old_hi)""",
    "st12_ranked_changelog": f"""WITH {BEHAVIOR}, c AS (
  SELECT event_id, item_id, us, w, row_number() OVER (PARTITION BY w ORDER BY us, event_id) AS step,
         row_number() OVER (PARTITION BY w, item_id ORDER BY us, event_id) AS n
  FROM (SELECT *, unnest(range((us // {FIVE_MINUTES} + 1) * {FIVE_MINUTES},
                               (us // {FIVE_MINUTES} + 1) * {FIVE_MINUTES} + {HOUR}, {FIVE_MINUTES})) AS w
        FROM behavior WHERE behavior = 'view')),
a AS (
  SELECT x.w, x.step, y.item_id, max(y.n) AS n FROM c x JOIN c y ON y.w = x.w AND y.step <= x.step GROUP BY ALL),
t AS (
  SELECT *, row_number() OVER (PARTITION BY w, step ORDER BY n DESC, item_id)::INTEGER AS rank FROM a
  QUALIFY rank <= 3),
moved AS (
  SELECT o.w, o.step + 1 AS step, false AS is_add, o.item_id, o.n, o.rank FROM t o
  JOIN t e ON e.w = o.w AND e.step = o.step + 1 AND e.rank = o.rank
  WHERE o.n <> e.n OR o.item_id IS DISTINCT FROM e.item_id
  UNION ALL
  SELECT e.w, e.step, true, e.item_id, e.n, e.rank FROM t e
  LEFT JOIN t o ON e.w = o.w AND e.step = o.step + 1 AND e.rank = o.rank
  WHERE o.n IS NULL OR o.n <> e.n OR o.item_id IS DISTINCT FROM e.item_id)
SELECT m.w // 1000 AS window_end, c.event_id, is_add, m.item_id, m.n, rank
FROM moved m JOIN c ON c.w = m.w AND c.step = m.step""",
    "st13_late": f"""WITH {ARRIVALS}, ended AS (
  SELECT *, (us // {HOUR} + 1) * {HOUR} AS end_us, seen - {HOUR} AS wm FROM watermarked)
SELECT event_id, end_us // 1000 AS window_end,
       CASE WHEN wm IS NULL OR end_us > wm THEN 'on_time'
            WHEN wm < end_us + {HOUR} THEN 'update' ELSE 'dropped' END AS lateness
FROM ended""",
    "st14_behind_watermark": f"""WITH {ARRIVALS}
SELECT event_id FROM watermarked WHERE us < seen""",
    "st15_allowed_lateness": f"""WITH {ARRIVALS}, ended AS (
  SELECT *, (us // {DAY} + 1) * {DAY} AS end_us, seen - {HOUR} AS wm FROM watermarked),
kept AS (
  SELECT user_id, end_us, wm IS NULL OR end_us > wm AS in_time,
         row_number() OVER (PARTITION BY user_id, end_us ORDER BY arrived, event_id) AS n
  FROM ended WHERE wm IS NULL OR end_us > wm OR wm < end_us + {HOUR})
SELECT user_id, end_us // 1000 AS window_end, 'first' AS kind, max(n) AS n
FROM kept WHERE in_time GROUP BY user_id, end_us
UNION ALL
SELECT user_id, end_us // 1000, CASE WHEN n = 1 THEN 'first' ELSE 'update' END, n
FROM kept WHERE NOT in_time""",
}



def judged(marks: str, delay: int) -> str:
    """Events that come behind the watermark of earlier quarters of the arrival time."""
    return f"""WITH a AS (
  SELECT event_id, event_type, epoch_us(ts) AS us, epoch_us(ts) + (event_id * 7919 % 97) * 240000000 AS arrived
  FROM events WHERE ts IS NOT NULL),
b AS (
  SELECT *, least(floor((arrived - low) * 4 / greatest(high - low, 1)::DOUBLE), 3) AS part
  FROM a, (SELECT min(arrived) AS low, max(arrived) AS high FROM a)),
m AS (SELECT part, max(us) AS last FROM b WHERE {marks} GROUP BY part),
w AS (SELECT p.part, max(m.last) AS last FROM (SELECT DISTINCT part FROM b) p LEFT JOIN m ON m.part < p.part GROUP BY ALL)
SELECT event_id, coalesce((us + 999) // 1000 <= last // 1000 - {delay // 1000}, false) AS late
FROM b JOIN w USING (part)"""


# A stream replayed to its end gives what the batch query gives.
ORACLES |= {
    "w3_hot_items_stream": ORACLES["q1_hot_items_top3"],
    "a11_uv_two_stage_stream": ORACLES["q8_uv_two_stage"],
    "p4_order_attempts_stream": order_pairs(
        f"""order_id,
       CASE WHEN next_us - us < {DAY} THEN 'matched' ELSE 'timeout' END AS outcome,
       us AS create_us, CASE WHEN next_us - us < {DAY} THEN next_us END AS pay_us""",
        f"(next_us IS NULL OR next_us - us >= {DAY} OR next_type = 'pay')",
    ),
    "st2_jumps_stream": ORACLES["q15_jump_alert_skip_first"],
    "st3_rising_run_stream": ORACLES["q15_rising_run"],
    "st4_timers_stream": f"""WITH {SENSOR}
SELECT DISTINCT id, (us + 5000000) // 1000 AS fires_ms FROM sensor""",
    "st5_tumbling_stream": ORACLES["st5_tumbling_close"],
    "st7_order_timeout_stream": ORACLES["q12_order_timeout_state"],
    "st8_recon_stream": ORACLES["q13_recon_matched"],
    "st9_gate_stream": f"SELECT event_id, user_id FROM ({ORACLES['q15_gate']})",
    "st10_login_fail_stream": ORACLES["q11_login_fail_state"],
    "st11_early_fire_stream": ORACLES["st11_early_fire"],
    "st11b_uv_bitmap_stream": ORACLES["st11b_fire_each_element"],
    "a15_top2_changelog_stream": ORACLES["a15_top2_changelog"],
    "st12_changelog_stream": ORACLES["st12_changelog"],
    "st13_late_rows_stream": f"""SELECT event_id,
       CASE lateness WHEN 'dropped' THEN 'late' ELSE 'on_time' END AS side
FROM ({ORACLES["st13_late"]})""",
    "k6_document_index": ORACLES["q4_hot_item_documents"],
    "k6_committed_stream": """SELECT event_id::VARCHAR AS doc_id, '{' ||
  CASE WHEN user_id IS NULL THEN '' ELSE '"user_id":' || user_id || ',' END || '"event_type":"view"}' AS document
FROM events WHERE event_type = 'view'""",
    "u1_union_stream": f"""WITH e AS (
  SELECT event_type, epoch_us(ts) AS us FROM events WHERE event_type IN ('view', 'click', 'purchase'))
{tumbling("e", DAY, "event_type", "count(*) AS n")}""",
    "j2_gate_join_stream": ORACLES["q15_gate"],
    "j4_unpaid_join_stream": ORACLES["j4_orders_without_payment"],
    "st1_bounded_stream": judged("true", HOUR),
    "st1_custom_stream": judged("event_type = 'signup'", 0),
    "st17_resumed_stream": ORACLES["q15_jump_alert_skip_first"],
    "k8_visitor_store_written": ORACLES["k8_visitor_store"],
    "k7_two_sinks_stream": """SELECT event_id,
  CASE WHEN event_type = 'view' THEN 'views' ELSE 'rest' END AS sink FROM events""",
}
