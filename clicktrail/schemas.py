"""Input and output schemas, and the fixed values reports are built from."""

from __future__ import annotations

# Columns of the four input tables and of the decoded ad clicks.
USER_VISIT_ACTION = """
    date STRING, user_id BIGINT, session_id STRING, page_id BIGINT, action_time STRING,
    search_keyword STRING, click_category_id BIGINT, click_product_id BIGINT,
    order_category_ids STRING, order_product_ids STRING,
    pay_category_ids STRING, pay_product_ids STRING, city_id BIGINT
"""

USER_INFO = """
    user_id BIGINT, username STRING, name STRING, age INT,
    professional STRING, city STRING, sex STRING
"""

PRODUCT_INFO = "product_id BIGINT, product_name STRING, extend_info STRING"

CITY_INFO = "city_id BIGINT, city_name STRING, area STRING"

AD_CLICK = """
    ts TIMESTAMP, province BIGINT, city BIGINT, user_id BIGINT, ad_id BIGINT, _corrupt STRING
"""

# Fixed values: (label, lowest, highest) of each session bucket, both inclusive.
VISIT_BUCKETS = (
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
)
STEP_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
)

# The city dimension and the level of each area.
CITIES = (
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
)
AREA_LEVELS = {
    "华北": "A Level",
    "华东": "A Level",
    "华南": "B Level",
    "华中": "B Level",
    "西北": "C Level",
    "西南": "C Level",
}
OTHER_LEVEL = "D Level"
