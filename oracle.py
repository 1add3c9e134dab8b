"""DuckDB SQL giving the expected result of every query."""

from __future__ import annotations

TASK = "'t-0001'"
START, END = "2024-01-05", "2024-01-25"

TABLES = {
    "user_visit_action": """
        SELECT d AS date, user_id, concat(CAST(user_id AS VARCHAR), '_', d) AS session_id,
               CAST(k % 10 AS BIGINT) AS page_id,
               concat(d, ' ', CAST(user_id % 24 AS VARCHAR), ':',
                      lpad(CAST(CAST(FLOOR(off / 60.0) AS INT) AS VARCHAR), 2, '0'), ':',
                      lpad(CAST(off % 60 AS VARCHAR), 2, '0')) AS action_time,
               CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 12 AS VARCHAR)) END AS search_keyword,
               CAST(CASE WHEN event_type = 'click' THEN k ELSE -1 END AS BIGINT) AS click_category_id,
               CAST(CASE WHEN event_type = 'click' THEN (event_id * 7) % 100 ELSE -1 END AS BIGINT)
                   AS click_product_id,
               CASE WHEN event_type = 'purchase'
                    THEN concat(CAST(k AS VARCHAR), ',', CAST((k + 17) % 100 AS VARCHAR)) END AS order_category_ids,
               CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END AS order_product_ids,
               CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
               CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END AS pay_product_ids,
               CAST(event_id % 27 AS BIGINT) AS city_id, event_id AS action_seq
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
                     CAST(CAST(ts AS DATE) AS VARCHAR) AS d,
                     CAST(FLOOR((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 30.0) AS INT) AS off
              FROM events)""",
    "user_info": """
        SELECT c_custkey AS user_id, c_name AS name, CAST(c_custkey % 60 AS INT) AS age,
               c_mktsegment AS professional, n_name AS city,
               CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "product_info": """
        SELECT p_partkey AS product_id, p_name AS product_name,
               concat('{"product_status": ', CAST(p_size % 2 AS VARCHAR), '}') AS extend_info
        FROM part""",
    "city_info": """
        SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "city_dimension": """
        SELECT * FROM (VALUES
            (0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'),
            (4, '三亚', '华南'), (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'),
            (8, '成都', '西南'), (9, '哈尔滨', '东北')) AS c(city_id, city_name, area)""",
    "in_range": f"""
        SELECT * FROM user_visit_action WHERE date >= '{START}' AND date <= '{END}'""",
    "actions": """
        SELECT * REPLACE (strptime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time),
               nullif(search_keyword, '') AS keyword,
               nullif(click_category_id, -1) AS category_id,
               nullif(click_product_id, -1) AS product_id
        FROM in_range""",
    "summary": """
        SELECT session_id, min(user_id) AS user_id,
               string_agg(DISTINCT keyword, ',' ORDER BY keyword) AS search_keywords,
               array_to_string(list_sort(list(DISTINCT category_id) FILTER (category_id IS NOT NULL)), ',')
                   AS click_category_ids,
               date_diff('second', min(action_time), max(action_time)) AS visit_length,
               count(*) AS step_length,
               strftime(min(action_time), '%Y-%m-%d %H:%M:%S') AS start_time
        FROM actions GROUP BY session_id""",
    "enriched": """
        SELECT s.*, u.age, u.professional, u.city, u.sex FROM summary s JOIN user_info u USING (user_id)""",
    "filtered": "SELECT * FROM enriched WHERE age BETWEEN 20 AND 50",
    "by_attributes": """
        SELECT * FROM enriched
        WHERE age BETWEEN 10 AND 55 AND professional IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AND sex = 'female'
          AND city NOT IN ('NATION_0', 'NATION_1', 'NATION_2')""",
    "by_interests": """
        SELECT * FROM filtered
        WHERE list_has_any(string_split(search_keywords, ','), ['kw1', 'kw7', 'kw10'])
          AND list_has_any(CAST(string_split(click_category_ids, ',') AS BIGINT[]), range(0, 100, 3))""",
    "buckets": """
        SELECT *,
               CASE WHEN visit_length < 1 THEN NULL WHEN visit_length <= 3 THEN '1s_3s'
                    WHEN visit_length <= 6 THEN '4s_6s' WHEN visit_length <= 9 THEN '7s_9s'
                    WHEN visit_length <= 30 THEN '10s_30s' WHEN visit_length <= 60 THEN '30s_60s'
                    WHEN visit_length <= 180 THEN '1m_3m' WHEN visit_length <= 600 THEN '3m_10m'
                    WHEN visit_length <= 1800 THEN '10m_30m' ELSE '30m' END AS visit_bucket,
               CASE WHEN step_length <= 3 THEN '1_3' WHEN step_length <= 6 THEN '4_6'
                    WHEN step_length <= 9 THEN '7_9' WHEN step_length <= 30 THEN '10_30'
                    WHEN step_length <= 60 THEN '30_60' ELSE '60' END AS step_bucket
        FROM filtered""",
    "detail": "SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM filtered)",
    "category_kinds": """
        SELECT session_id, 'click' AS kind, category_id FROM detail WHERE category_id IS NOT NULL
        UNION ALL
        SELECT session_id, 'order', CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) FROM detail
        UNION ALL
        SELECT session_id, 'pay', CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) FROM detail""",
    "totals": """
        SELECT category_id, count(*) FILTER (kind = 'click') AS click_count,
               count(*) FILTER (kind = 'order') AS order_count, count(*) FILTER (kind = 'pay') AS pay_count
        FROM category_kinds GROUP BY category_id""",
    "top_categories": """
        SELECT * FROM totals ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10""",
    "session_clicks": """
        SELECT category_id, session_id, count(*) AS click_count
        FROM category_kinds WHERE kind = 'click' GROUP BY ALL""",
    "top_sessions": """
        SELECT * FROM session_clicks SEMI JOIN top_categories USING (category_id)
        QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) <= 10""",
    "hourly": """
        SELECT *, CAST(sum(session_count) OVER (PARTITION BY start_date) AS BIGINT) AS day_session_count
        FROM (SELECT start_time[1:10] AS start_date, start_time[12:13] AS start_hour, count(*) AS session_count
              FROM filtered GROUP BY ALL)""",
    "quota": """
        SELECT *, least(session_count, session_count * (1000 // days) // day_session_count) AS quota,
               least(session_count, session_count * (100 // days) // day_session_count + 1) AS one_more,
               least(session_count, session_count * (1200 // days) // day_session_count) AS larger
        FROM hourly, (SELECT count(DISTINCT start_date) AS days FROM hourly)""",
    "drawn": """
        SELECT f.*, quota, one_more, larger,
               row_number() OVER (PARTITION BY start_date, start_hour
                                  ORDER BY md5(concat('7', session_id)), session_id) AS draw
        FROM filtered f JOIN quota ON start_date = start_time[1:10] AND start_hour = start_time[12:13]""",
    "steps": """
        SELECT session_id, page_id,
               lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_seq) AS next_page_id
        FROM actions""",
    "pairs": """
        SELECT *, concat(page_id, '_', next_page_id) AS pair FROM steps WHERE next_page_id IS NOT NULL""",
    "clicks": """
        SELECT city_id, click_product_id FROM in_range
        WHERE click_product_id IS NOT NULL AND click_product_id <> -1""",
    "basic": """
        SELECT city_id, city_name, area, click_product_id AS product_id FROM clicks JOIN city_info USING (city_id)""",
    "ad_lines": """
        SELECT CASE WHEN event_id % 97 = 0 THEN concat('bad line ', event_id)
                    ELSE concat_ws(' ', epoch_us(ts) // 1000, user_id % 10, user_id % 10, user_id, event_id % 20)
               END AS line
        FROM events""",
}


def _sql(select: str) -> str:
    tables = ",\n".join(f"{name} AS ({table})" for name, table in TABLES.items())
    return f"WITH {tables}\n{select}"


def _ratio(part: str, whole: str) -> str:
    return f"((200 * {part} + {whole}) // (2 * nullif({whole}, 0))) / 100.0"


def _aggr_stat(table: str) -> str:
    visits = ["1s_3s", "4s_6s", "7s_9s", "10s_30s", "30s_60s", "1m_3m", "3m_10m", "10m_30m", "30m"]
    steps = ["1_3", "4_6", "7_9", "10_30", "30_60", "60"]
    shares = [
        f"{_ratio(f'count(*) FILTER ({kind}_bucket = {label!r})', 'count(*)')} AS {kind}_length_{label}_ratio"
        for kind, labels in (("visit", visits), ("step", steps))
        for label in labels
    ]
    return f"SELECT {TASK} AS taskid, count(*) AS session_count, {', '.join(shares)} FROM {table}"


def _detail(table: str) -> str:
    return f"""
        SELECT {TASK} AS taskid, user_id AS userid, session_id AS sessionid, page_id AS pageid,
               action_time AS "actionTime", search_keyword AS "searchKeyword",
               click_category_id AS "clickCategoryId", click_product_id AS "clickProductId",
               order_category_ids AS "orderCategoryIds", order_product_ids AS "orderProductIds",
               pay_category_ids AS "payCategoryIds", pay_product_ids AS "payProductIds"
        FROM in_range WHERE session_id IN (SELECT session_id FROM {table})"""


def _extract(condition: str) -> str:
    return f"""
        SELECT {TASK} AS taskid, session_id AS sessionid, start_time AS "startTime",
               search_keywords AS "searchKeywords", click_category_ids AS "clickCategoryIds"
        FROM drawn WHERE {condition}"""


def _top_category(task: str = TASK) -> str:
    return f"""
        SELECT {task} AS taskid, category_id AS categoryid, click_count AS "clickCount",
               order_count AS "orderCount", pay_count AS "payCount" FROM top_categories"""


def _path(path: tuple[int, ...]) -> str:
    rows = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(zip(path, path[1:]), 1))
    return f"(VALUES {rows}) AS p(pos, a, b)"


def _conversion(path: tuple[int, ...]) -> str:
    return f"""
        SELECT pos, concat(a, '_', b) AS pair, pv, previous_pv, {_ratio('pv', 'previous_pv')} AS rate
        FROM (SELECT *, coalesce(lag(pv) OVER (ORDER BY pos),
                                 (SELECT count(*) FROM actions WHERE page_id = {path[0]})) AS previous_pv
              FROM (SELECT pos, a, b, (SELECT count(*) FROM steps WHERE page_id = a AND next_page_id = b) AS pv
                    FROM {_path(path)}))"""


def _area_clicks(cities: str) -> str:
    return f"""
        SELECT area, product_id, CAST(sum(n) AS BIGINT) AS click_count,
               string_agg(concat(city_id, ':', city_name), ',' ORDER BY city_id, city_name) AS city_infos
        FROM (SELECT area, click_product_id AS product_id, city_id, city_name, count(*) AS n
              FROM clicks JOIN {cities} USING (city_id) GROUP BY ALL)
        GROUP BY area, product_id"""


def _area_full(cities: str) -> str:
    return f"""
        SELECT area, product_id, click_count, city_infos, product_name,
               CASE WHEN json_extract_string(extend_info, '$.product_status') = '0'
                    THEN 'Self' ELSE 'Third Party' END AS product_status
        FROM ({_area_clicks(cities)}) JOIN product_info USING (product_id)"""


def _area_top(cities: str, level: str) -> str:
    return f"""
        SELECT {TASK} AS taskid, area, {level} AS "areaLevel", product_id AS productid,
               city_infos AS "cityInfos", click_count AS "clickCount", product_name AS "productName",
               product_status AS "productStatus"
        FROM ({_area_full(cities)})
        QUALIFY row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) <= 3"""


_SESSION = """session_id, user_id, search_keywords, click_category_ids, visit_length, step_length, start_time"""
_USER = "age, professional, city, sex"
_PATH = (1, 2, 3, 4, 5, 6, 7)
_RETURNING_PATH = (3, 4, 3, 4, 12, 5)
_PACKED_VALUE = "coalesce(CAST(CAST(rate AS DOUBLE) AS VARCHAR), '')"

_AD_CLICKS = """
    SELECT CASE WHEN ok THEN strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S.%g') END AS ts,
           CASE WHEN ok THEN CAST(province AS VARCHAR) END AS province,
           CASE WHEN ok THEN CAST(city AS VARCHAR) END AS city,
           CASE WHEN ok THEN CAST(user_id AS VARCHAR) END AS user_id,
           CASE WHEN ok THEN CAST(ad_id AS VARCHAR) END AS ad_id,
           CASE WHEN NOT ok THEN line END AS _corrupt
    FROM (SELECT *, len(w) = 5 AND ms IS NOT NULL AND province IS NOT NULL AND city IS NOT NULL
                    AND user_id IS NOT NULL AND ad_id IS NOT NULL AS ok
          FROM (SELECT line, w, TRY_CAST(w[1] AS BIGINT) AS ms, TRY_CAST(w[2] AS BIGINT) AS province,
                       TRY_CAST(w[3] AS BIGINT) AS city, TRY_CAST(w[4] AS BIGINT) AS user_id,
                       TRY_CAST(w[5] AS BIGINT) AS ad_id
                FROM (SELECT line, string_split(line, ' ') AS w FROM ad_lines)))"""

_LEVEL = """CASE WHEN area IN ('AFRICA', 'AMERICA') THEN 'A Level' WHEN area = 'ASIA' THEN 'B Level'
                 WHEN area = 'EUROPE' THEN 'C Level' ELSE 'D Level' END"""
_DIMENSION_LEVEL = """CASE WHEN area IN ('华北', '华东') THEN 'A Level' WHEN area IN ('华南', '华中') THEN 'B Level'
                           WHEN area IN ('西北', '西南') THEN 'C Level' ELSE 'D Level' END"""

_SELECTS = {
    "actions_in_range": "SELECT * FROM in_range",
    "normalised_actions": """
        SELECT action_seq, user_id, session_id, page_id, city_id,
               strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time,
               strftime(action_time, '%Y-%m-%d_%H') AS date_hour,
               strftime(action_time, '%Y%m%d') AS date_key,
               strftime(action_time, '%Y%m%d%H%M') AS minute_key,
               keyword, CAST(category_id AS VARCHAR) AS category_id, CAST(product_id AS VARCHAR) AS product_id,
               order_category_ids AS order_categories, order_product_ids AS order_products,
               pay_category_ids AS pay_categories, pay_product_ids AS pay_products
        FROM actions""",
    "clicked_products": "SELECT * FROM clicks",
    "session_summary": f"SELECT {_SESSION} FROM summary",
    "session_enriched": f"SELECT {_SESSION}, {_USER} FROM enriched",
    "session_filtered": f"SELECT {_SESSION}, {_USER} FROM filtered",
    "session_filtered_by_attributes": f"SELECT {_SESSION}, {_USER} FROM by_attributes",
    "session_filtered_by_interests": f"SELECT {_SESSION}, {_USER} FROM by_interests",
    "session_buckets": "SELECT session_id, visit_length, step_length, visit_bucket, step_bucket FROM buckets",
    "session_aggr_stat": _aggr_stat("buckets"),
    "session_aggr_stat_by_interests": _aggr_stat("buckets SEMI JOIN by_interests USING (session_id)"),
    "session_aggr_stat_observed": _aggr_stat("buckets"),
    "session_summary_over_time": """
        SELECT session_id, user_id, visit_length, step_length, start_time,
               coalesce(list_has_any(string_split(search_keywords, ','), ['kw1', 'kw7', 'kw10']), false) AS keyword_match,
               coalesce(list_has_any(CAST(string_split(nullif(click_category_ids, ''), ',') AS BIGINT[]), range(0, 100, 3)), false)
                   AS category_match
        FROM summary""",
    "session_values_over_time": """
        SELECT DISTINCT session_id, 'keyword' AS kind, keyword AS value FROM actions WHERE keyword IS NOT NULL
        UNION ALL
        SELECT DISTINCT session_id, 'category', CAST(category_id AS VARCHAR) FROM actions WHERE category_id IS NOT NULL""",
    "session_detail": _detail("filtered"),
    "session_hourly_counts": "SELECT * FROM hourly",
    "session_sample_quota": "SELECT start_date, start_hour, session_count, day_session_count, quota FROM quota",
    "session_random_extract": _extract("draw <= quota"),
    "session_random_extract_one_more": _extract("draw <= one_more"),
    "session_random_extract_by_bins": _extract("draw <= larger"),
    "session_random_detail": _detail("drawn WHERE draw <= quota"),
    "category_universe": "SELECT DISTINCT category_id FROM category_kinds",
    "category_click_counts": "SELECT category_id, click_count FROM totals WHERE click_count > 0",
    "category_order_counts": "SELECT category_id, order_count FROM totals WHERE order_count > 0",
    "category_pay_counts": "SELECT category_id, pay_count FROM totals WHERE pay_count > 0",
    "category_activity": "SELECT * FROM totals",
    "top10_category": _top_category(),
    "category_session_clicks": "SELECT * FROM session_clicks",
    "top10_session": f"""
        SELECT {TASK} AS taskid, category_id AS categoryid, session_id AS sessionid,
               click_count AS "clickCount" FROM top_sessions""",
    "top10_session_detail": _detail("top_sessions"),
    "target_page_pairs": f"""
        SELECT pos, CAST(a AS BIGINT) AS page_id, CAST(b AS BIGINT) AS next_page_id,
               concat(a, '_', b) AS pair, coalesce(page_pv, 0) AS page_pv
        FROM {_path(_PATH)} LEFT JOIN (SELECT page_id, count(*) AS page_pv FROM actions GROUP BY ALL) ON page_id = a""",
    "session_page_pairs": "SELECT * FROM pairs",
    "page_pair_pv": f"""
        SELECT pair, count(*) AS pv FROM pairs
        WHERE pair IN (SELECT concat(a, '_', b) FROM {_path(_PATH)}) GROUP BY pair""",
    "start_page_pv": "SELECT count(*) AS pv FROM actions WHERE page_id = 1",
    "page_conversion": _conversion(_PATH),
    "page_conversion_returning_path": _conversion(_RETURNING_PATH),
    "page_split_convert_rate": f"""
        SELECT {TASK} AS taskid, string_agg(concat(pair, '=', {_PACKED_VALUE}), '|' ORDER BY pos) AS "convertRate"
        FROM ({_conversion(_PATH)})""",
    "kv_report_decode": f"""
        SELECT {TASK} AS taskid, pos, pair AS field,
               CASE WHEN pair = '4_3' THEN '9.9' ELSE nullif({_PACKED_VALUE}, '') END AS value
        FROM ({_conversion(_RETURNING_PATH)})""",
    "click_product_basic": "SELECT * FROM basic",
    "area_product_clicks": _area_clicks("city_info"),
    "area_product_full": _area_full("city_info"),
    "area_top3_product": _area_top("city_info", _LEVEL),
    "area_top3_product_by_sql": _area_top("city_info", _LEVEL),
    "area_top3_product_city_dimension": _area_top("city_dimension", _DIMENSION_LEVEL),
    "report_append": f"{_top_category()} UNION ALL {_top_category(chr(39) + 't-0002' + chr(39))}",
    "report_append_once": f"{_top_category()} UNION ALL {_top_category(chr(39) + 't-0002' + chr(39))}",
    "table_overwrite_dates": """
        SELECT date, count(*) AS actions, CAST(sum(page_id) AS BIGINT) AS pages FROM in_range GROUP BY date""",
    "table_overwrite": """
        SELECT date, count(*) AS actions, count(order_category_ids) AS orders
        FROM in_range GROUP BY date""",
    "ad_click_events": _AD_CLICKS,
    "ad_click_stream": _AD_CLICKS,
    "ad_click_sinks": f"SELECT *, CASE WHEN _corrupt IS NULL THEN 'clicks' ELSE 'corrupt' END AS sink FROM ({_AD_CLICKS})",
    "scalar_functions": """
        SELECT date, replace(date, '-', '') AS date_key, date AS date_again,
               CAST(CAST(CAST(date AS DATE) - INTERVAL 1 DAY AS DATE) AS VARCHAR) AS day_before,
               CAST(count(*) AS VARCHAR) AS views, CAST(NULL AS VARCHAR) AS pages, CAST(NULL AS VARCHAR) AS absent, '0' AS views_replaced
        FROM in_range GROUP BY date""",
    "actions_of_yesterday": """
        SELECT date, count(*) AS actions FROM user_visit_action WHERE date = '2024-01-06' GROUP BY date""",
}

ORACLE = {name: _sql(select) for name, select in _SELECTS.items()}
