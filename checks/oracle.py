"""DuckDB SQL for each registered query, over the same driver tables.

Written from the definitions rather than from the DataFrame code: joins where the library uses
windows, row-level windows where it aggregates first, integer rounding where it rounds doubles.
"""

from __future__ import annotations

START, END = "2024-01-01", "2024-01-30"
CUT_START, CUT_END = "2024-01-02", "2024-01-29"
ORDERS_START, ORDERS_END = "1995-01-01", "2001-08-01"
ORDERS_CUT_START, ORDERS_CUT_END = "1996-01-01", "2000-12-31"
K_CATEGORIES, K_ITEMS = 5, 3
# Output labels in the order of the rules, and repurchase buckets.
SEGMENT_LABELS = (
    "重要价值客户", "重要发展客户", "重要保持客户", "重要挽留客户",
    "一般价值客户", "一般发展客户", "一般保持客户", "一般挽留客户",
)
REPURCHASE_BUCKETS = (
    ("1次（一次性买家）", 1, 1),
    ("2次（首次复购）", 2, 2),
    ("3-5次（活跃买家）", 3, 5),
    ("6-10次（高频买家）", 6, 10),
    ("11次以上（核心买家）", 11, None),
)

BEHAVIORS = ("pv", "fav", "cart", "buy")

RAW_EVENTS = """keyed AS (
  SELECT event_id, user_id,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS item_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav' WHEN 'signup' THEN 'cart'
                         WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior,
         epoch_us(ts) // 1000000 AS timestamp
  FROM events
),
raw AS (
  SELECT user_id, item_id, item_id // 10 AS category_id, behavior, timestamp FROM keyed
)"""

RAW_ORDERS = """raw AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id,
         CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS category_id,
         CASE l_linenumber % 4 WHEN 0 THEN 'pv' WHEN 1 THEN 'fav' WHEN 2 THEN 'cart'
                               ELSE 'buy' END AS behavior,
         epoch_us(o_orderdate) // 1000000 AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""


def base(raw: str = RAW_EVENTS, start: str = START, end: str = END) -> str:
    return f"""
WITH {raw},
dated AS (
  SELECT *, make_timestamp(timestamp * 1000000) AS moment,
         strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d')
           BETWEEN '{start}' AND '{end}' AS in_range
  FROM raw
),
accepted AS (
  SELECT * FROM dated WHERE behavior IN ('pv', 'fav', 'cart', 'buy') AND in_range
),
detail AS (
  SELECT user_id, item_id, min(category_id) AS category_id, behavior, timestamp,
         strftime(moment, '%Y-%m-%d %H:%M:%S') AS event_time,
         CAST(hour(moment) AS INTEGER) AS event_hour,
         CAST(dayofweek(moment) + 1 AS INTEGER) AS day_of_week,
         CAST(CASE WHEN dayofweek(moment) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
         strftime(moment, '%Y-%m-%d') AS event_date
  FROM accepted GROUP BY user_id, item_id, behavior, timestamp, moment
)"""


def n(behavior: str) -> str:
    return f"CAST(count(*) FILTER (WHERE behavior = '{behavior}') AS BIGINT)"


def half_up(num: str, den: str, places: int, scale: int = 1) -> str:
    """num * scale / den rounded half up in integers, as DOUBLE; null if den is 0."""
    p = 10**places
    top = f"(2 * CAST({num} AS HUGEINT) * {scale * p} + ({den}))"
    return f"CAST({top} // NULLIF(2 * CAST({den} AS HUGEINT), 0) AS DOUBLE) / {p}"


def sql(body: str, *ctes: str) -> str:
    return base() + "".join(f",\n{c}" for c in ctes) + "\n" + body


FOUR = ", ".join(f"{n(b)} AS {b}_count" for b in BEHAVIORS)
SHARE_RAW = f"""SELECT behavior, count(*) AS cnt,
  {half_up('count(*)', '(SELECT count(*) FROM raw)', 2, 100)} AS pct FROM raw GROUP BY behavior"""

DAILY = f"""daily AS (
  SELECT event_date, {n('pv')} AS pv, count(DISTINCT user_id) AS uv,
         count(DISTINCT CASE WHEN behavior = 'pv' THEN item_id END) AS item_count,
         {half_up(n('pv'), 'count(DISTINCT user_id)', 2)} AS avg_pv_per_user
  FROM detail GROUP BY event_date)"""

HOURLY = f"""hourly AS (
  SELECT event_hour, {n('pv')} AS pv, count(DISTINCT user_id) AS uv,
         {n('cart')} AS cart_count, {n('buy')} AS buy_count
  FROM detail GROUP BY event_hour)"""

FUNNEL = f"""stages(ord, code, label) AS (
  VALUES (1, 'pv', '浏览(pv)'), (2, 'fav', '收藏(fav)'), (3, 'cart', '加购(cart)'),
         (4, 'buy', '购买(buy)')),
reached AS (
  SELECT s.ord, s.label, count(DISTINCT d.user_id) AS users
  FROM stages s LEFT JOIN detail d ON d.behavior = s.code GROUP BY s.ord, s.label),
funnel AS (
  SELECT c.label AS behavior, c.users AS user_count,
         coalesce({half_up('c.users', 'p.users', 2, 100)}, 0.0) AS ratio,
         coalesce({half_up('c.users', 'f.users', 2, 100)}, 0.0) AS overall_rate
  FROM reached c JOIN reached p ON p.ord = greatest(c.ord - 1, 1) JOIN reached f ON f.ord = 1
  WHERE f.users > 0)"""

TOP_ITEMS = f"""item_scores AS (
  SELECT item_id, {FOUR},
         CAST(sum(CASE behavior WHEN 'pv' THEN 1 WHEN 'fav' THEN 3 WHEN 'cart' THEN 5
                                ELSE 10 END) AS DOUBLE) AS total_score
  FROM detail GROUP BY item_id),
top_items AS (
  SELECT CAST(row_number() OVER (ORDER BY total_score DESC, item_id) AS INTEGER) AS ranking, *
  FROM item_scores QUALIFY ranking <= 100)"""

TOP_CATEGORIES = f"""category_counts AS (
  SELECT category_id, {n('pv')} AS pv_count, {n('buy')} AS buy_count
  FROM detail GROUP BY category_id),
top_categories AS (
  SELECT CAST(row_number() OVER (ORDER BY pv_count DESC, category_id) AS INTEGER) AS ranking,
         category_id, pv_count, buy_count,
         {half_up('buy_count', 'pv_count', 4, 100)} AS conversion_rate
  FROM category_counts QUALIFY ranking <= 20)"""

WEEKDAY = f"""weekday AS (
  SELECT CASE WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END AS day_type, behavior,
         count(*) AS total_count, count(DISTINCT user_id) AS user_count,
         {half_up('count(*)', 'count(DISTINCT user_id)', 2)} AS avg_per_user
  FROM detail GROUP BY is_weekend, behavior)"""


def retention(offsets: tuple[int, ...]) -> str:
    joins = " ".join(
        f"LEFT JOIN active a{k} ON a{k}.user_id = f.user_id AND a{k}.day = f.first_day + {k}"
        for k in offsets
    )
    rates = ", ".join(
        f"{half_up(f'count(a{k}.user_id)', 'count(*)', 2, 100)} AS day_{k}" for k in offsets
    )
    return f"""active AS (SELECT DISTINCT user_id, CAST(event_date AS DATE) AS day FROM detail),
firsts AS (SELECT user_id, min(day) AS first_day FROM active GROUP BY user_id),
cohorts AS (
  SELECT strftime(f.first_day, '%Y-%m-%d') AS first_date, count(*) AS new_users, {rates}
  FROM firsts f {joins} GROUP BY f.first_day)"""


def _case(pairs: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END"


SEGMENTS = _case(
    [
        (f"{m} AND {r} AND {f}", f"'{label}'")
        for (m, r, f), label in zip(
            (
                (m, r, f)
                for m in ("m_score >= 2", "m_score < 2")
                for r in ("r_score >= 2", "r_score < 2")
                for f in ("f_score >= 2", "f_score < 2")
            ),
            SEGMENT_LABELS,
        )
    ],
    "NULL",
)

RFM = f"""buyers AS (
  SELECT user_id,
         CAST(date_diff('day', max(CAST(event_date AS DATE)) FILTER (WHERE behavior = 'buy'),
                        DATE '{END}') AS INTEGER) AS recency,
         {n('buy')} AS frequency, 10 * {n('buy')} + 3 * {n('cart')} AS tenths
  FROM detail GROUP BY user_id HAVING {n('buy')} > 0),
medians AS (
  SELECT quantile_disc(recency, 0.5) AS r, quantile_disc(frequency, 0.5) AS f,
         quantile_disc(tenths, 0.5) AS m FROM buyers),
scored AS (
  SELECT user_id, recency, frequency, CAST(tenths AS DOUBLE) / 10 AS monetary, tenths,
         CAST(CASE WHEN recency <= r THEN 3 WHEN recency <= 2 * r THEN 2 ELSE 1 END
              AS INTEGER) AS r_score,
         CAST(CASE WHEN frequency >= 2 * f THEN 3 WHEN frequency >= f THEN 2 ELSE 1 END
              AS INTEGER) AS f_score,
         CAST(CASE WHEN tenths >= 2 * m THEN 3 WHEN tenths >= m THEN 2 ELSE 1 END
              AS INTEGER) AS m_score
  FROM buyers, medians),
rfm AS (SELECT * EXCLUDE (tenths), {SEGMENTS} AS segment FROM scored),
segments AS (
  SELECT segment, count(*) AS user_count,
         {half_up('sum(recency)', 'count(*)', 2)} AS avg_recency,
         {half_up('sum(frequency)', 'count(*)', 2)} AS avg_frequency,
         {half_up('sum(CAST(round(monetary * 10) AS BIGINT))', '10 * count(*)', 2)} AS avg_monetary
  FROM rfm GROUP BY segment)"""

PATH = f"""steps AS (
  SELECT lag(behavior) OVER (PARTITION BY user_id ORDER BY timestamp, behavior) AS from_behavior,
         behavior AS to_behavior FROM detail),
edges AS (
  SELECT from_behavior, to_behavior, count(*) AS path_count FROM steps
  WHERE from_behavior IS NOT NULL GROUP BY ALL),
path AS (
  SELECT e.from_behavior, e.to_behavior, e.path_count,
         {half_up('e.path_count', 't.n', 2, 100)} AS path_ratio
  FROM edges e JOIN (SELECT from_behavior, CAST(sum(path_count) AS BIGINT) AS n
                     FROM edges GROUP BY from_behavior) t USING (from_behavior)),
names(code, word) AS (
  VALUES ('pv', '浏览'), ('fav', '收藏'), ('cart', '加购'), ('buy', '购买')),
named AS (
  SELECT p.*, a.word AS from_word, b.word AS to_word FROM path p
  JOIN names a ON a.code = p.from_behavior JOIN names b ON b.code = p.to_behavior)"""

HEATMAP = f"""heatmap AS (
  SELECT day_of_week, event_hour, count(*) AS pv_count, {n('buy')} AS buy_count,
         count(DISTINCT user_id) AS active_users
  FROM detail GROUP BY day_of_week, event_hour)"""

_BUCKET = _case(
    [(f"times <= {most}", str(i + 1)) for i, (_, _, most) in enumerate(REPURCHASE_BUCKETS[:-1])],
    str(len(REPURCHASE_BUCKETS)),
)
_BUCKET_NAME = _case(
    [(f"bucket_order = {i + 1}", f"'{name}'") for i, (name, _, _) in enumerate(REPURCHASE_BUCKETS)],
    "NULL",
)
REPURCHASE = f"""times AS (
  SELECT user_id, count(*) AS times FROM detail WHERE behavior = 'buy' GROUP BY user_id),
bucketed AS (SELECT times, CAST({_BUCKET} AS INTEGER) AS bucket_order FROM times),
repurchase AS (
  SELECT {_BUCKET_NAME} AS buy_times_bucket, bucket_order, count(*) AS user_count,
         {half_up('count(*)', '(SELECT count(*) FROM times)', 2, 100)} AS user_ratio,
         CAST(sum(times) AS BIGINT) AS total_buy,
         {half_up('sum(times)', '(SELECT sum(times) FROM times)', 2, 100)} AS buy_contribution
  FROM bucketed GROUP BY bucket_order)"""

CATEGORY_ITEMS = f"""category_views AS (
  SELECT category_id, {n('pv')} AS category_pv FROM detail GROUP BY category_id
  ORDER BY category_pv DESC, category_id LIMIT {K_CATEGORIES}),
item_views AS (
  SELECT category_id, item_id, {n('pv')} AS item_pv, {n('buy')} AS item_buy
  FROM detail GROUP BY category_id, item_id),
category_items AS (
  SELECT category_id, category_pv, item_id, item_pv, item_buy,
         CAST(row_number() OVER (PARTITION BY category_id ORDER BY item_pv DESC, item_id)
              AS INTEGER) AS rank_in_category
  FROM item_views JOIN category_views USING (category_id)
  QUALIFY rank_in_category <= {K_ITEMS})"""

AUDIT = """reasons AS (
  SELECT *, CASE WHEN user_id IS NULL OR item_id IS NULL OR category_id IS NULL
                      OR behavior IS NULL OR timestamp IS NULL THEN 'null'
                 WHEN behavior NOT IN ('pv', 'fav', 'cart', 'buy') THEN 'behavior'
                 WHEN NOT in_range THEN 'date'
                 ELSE 'ok' END AS reason
  FROM dated),
final AS (SELECT count(*) AS n FROM detail)"""

WINDOWS = """windows AS (
  SELECT e.behavior, (e.timestamp // 10) * 10 - 10 * i.i AS window_start_s,
         (e.timestamp // 10) * 10 - 10 * i.i + 30 AS window_end_s
  FROM raw e, range(3) i(i))"""

ALL_RAW = "SELECT user_id, item_id, category_id, behavior, timestamp FROM raw"
# The tables of each layer.
CATALOG = ", ".join(
    f"('{layer}', '{table}')"
    for layer, tables in {
        "ods": "user_behavior",
        "dwd": "user_behavior_detail",
        "dws": "user_daily_behavior item_daily_behavior category_daily_behavior hourly_behavior activity",
        "ads": "daily_pv_uv hourly_distribution behavior_funnel top_items top_categories "
        "weekday_vs_weekend retention user_rfm rfm_summary user_path heatmap_hour_dow "
        "repurchase_distribution category_top_items",
    }.items()
    for table in tables.split()
)
_MATRIX = ", ".join(
    f"CAST(coalesce(sum(buy_count) FILTER (WHERE event_hour = {h}), 0) AS BIGINT) AS h{h}"
    for h in range(24)
)
_PIVOT = """SELECT day_type,
  CASE day_type WHEN 'weekday' THEN '工作日' ELSE '周末' END AS day_label, {columns}
  FROM weekday GROUP BY day_type"""


def _pivot(value: str, kind: str) -> str:
    return _PIVOT.format(
        columns=", ".join(
            f"coalesce(CAST(max({value}) FILTER (WHERE behavior = '{b}') AS {kind}), 0) AS {b}"
            for b in ("pv", "cart", "fav", "buy")
        )
    )


def _share(table: str, label: str, value: str, places: int = 2) -> str:
    total = f"(SELECT CAST(sum({value}) AS BIGINT) FROM {table})"
    return f"""SELECT {label} AS label, {value} AS value, {total} AS total,
  {half_up(value, total, places, 100)} AS share FROM {table}"""


def daily_summary(key: str) -> str:
    return sql(f"SELECT {key}, event_date, {FOUR} FROM detail GROUP BY {key}, event_date")


ORACLE: dict[str, str] = {
    "etl_behavior_share": sql(SHARE_RAW),
    "etl_clean_audit": sql(
        f"""SELECT count(*) AS raw, count(*) FILTER (WHERE reason = 'null') AS null_removed,
  count(*) FILTER (WHERE reason = 'behavior') AS behavior_removed,
  count(*) FILTER (WHERE reason = 'date') AS date_removed,
  count(*) FILTER (WHERE reason = 'ok') - any_value(n) AS dedup_removed,
  any_value(n) AS final, {half_up('any_value(n)', 'count(*)', 2, 100)} AS keep_rate
FROM reasons, final""",
        AUDIT,
    ),
    "etl_detail": sql("SELECT * EXCLUDE (timestamp) FROM detail"),
    "etl_rows_per_day": sql("SELECT event_date, count(*) AS cnt FROM detail GROUP BY event_date"),
    "dedup_survivor": sql(
        """SELECT event_id, user_id, item_id, item_id // 10 AS category_id, behavior, timestamp,
  strftime(make_timestamp(timestamp * 1000000), '%Y-%m-%d') AS event_date
FROM keyed
QUALIFY row_number() OVER (PARTITION BY user_id, item_id, behavior, event_date
                           ORDER BY event_id) = 1"""
    ),
    "dws_user_daily": daily_summary("user_id"),
    "dws_item_daily": daily_summary("item_id"),
    "dws_category_daily": daily_summary("category_id"),
    "dws_hourly": sql(
        f"""SELECT event_date, event_hour, {FOUR}, count(DISTINCT user_id) AS uv_count
FROM detail GROUP BY event_date, event_hour"""
    ),
    "daily_pv_uv": sql("SELECT * FROM daily", DAILY),
    "hourly_distribution": sql("SELECT * FROM hourly", HOURLY),
    "behavior_funnel": sql("SELECT * FROM funnel", FUNNEL),
    "top_items": sql("SELECT * FROM top_items", TOP_ITEMS),
    "top_categories": sql("SELECT * FROM top_categories", TOP_CATEGORIES),
    "weekday_vs_weekend": sql("SELECT * FROM weekday", WEEKDAY),
    "retention": sql("SELECT * FROM cohorts", retention((1, 2, 3))),
    "retention_long": sql("SELECT * FROM cohorts", retention((1, 2, 3, 7, 14))),
    "user_rfm": sql("SELECT * FROM rfm", RFM),
    "rfm_summary": sql("SELECT * FROM segments", RFM),
    "user_path": sql("SELECT * FROM path", PATH),
    "heatmap_hour_dow": sql("SELECT * FROM heatmap", HEATMAP),
    "repurchase_distribution": sql("SELECT * FROM repurchase", REPURCHASE),
    "category_top_items": sql("SELECT * FROM category_items", CATEGORY_ITEMS),
    "verify_counts": sql(
        """SELECT count(*) AS row_count, count(DISTINCT user_id) AS user_count,
  count(DISTINCT item_id) AS item_count, count(DISTINCT category_id) AS category_count,
  min(event_date) AS min_date, max(event_date) AS max_date FROM detail"""
    ),
    "verify_behaviors": sql("SELECT behavior, count(*) AS cnt FROM detail GROUP BY behavior"),
    "readback_heatmap": sql(
        "SELECT * FROM heatmap ORDER BY day_of_week, event_hour LIMIT 30", HEATMAP
    ),
    "readback_path": sql(
        "SELECT * FROM path ORDER BY path_count DESC, from_behavior, to_behavior LIMIT 20", PATH
    ),
    "sankey_nodes": sql(
        """SELECT '前序_' || from_word AS name FROM named
UNION SELECT '后续_' || to_word FROM named""",
        PATH,
    ),
    "sankey_links": sql(
        """SELECT '前序_' || from_word AS source, '后续_' || to_word AS target,
  path_count AS value FROM named""",
        PATH,
    ),
    "transition_labels": sql(
        """SELECT CAST(row_number() OVER (ORDER BY from_behavior, path_count DESC, to_behavior)
            AS INTEGER) AS position,
  from_word || ' → ' || to_word AS path, path_count, path_ratio
FROM named QUALIFY position <= 15""",
        PATH,
    ),
    "category_tree": sql(
        """SELECT '类目' || category_id AS name, category_pv AS value,
  string_agg('商品' || item_id || '=' || item_pv, ',' ORDER BY rank_in_category) AS children
FROM category_items GROUP BY category_id, category_pv""",
        CATEGORY_ITEMS,
    ),
    "category_totals": sql(
        "SELECT DISTINCT category_id, category_pv FROM category_items", CATEGORY_ITEMS
    ),
    "heatmap_matrix": sql(
        f"""SELECT CAST(d.d AS INTEGER) AS day_of_week, {_MATRIX}
FROM range(1, 8) d(d) LEFT JOIN heatmap h ON h.day_of_week = d.d GROUP BY d.d""",
        HEATMAP,
    ),
    "heatmap_cells": sql(
        """SELECT event_hour AS x, day_of_week - 1 AS y, buy_count AS value,
  (SELECT max(buy_count) FROM heatmap) AS max_value FROM heatmap""",
        HEATMAP,
    ),
    "weekday_pivot": sql(_pivot("total_count", "BIGINT"), WEEKDAY),
    "weekday_pivot_avg": sql(_pivot("avg_per_user", "DOUBLE"), WEEKDAY),
    "funnel_share": sql(_share("funnel", "behavior", "user_count"), FUNNEL),
    "rfm_share": sql(_share("segments", "segment", "user_count", 1), RFM),
    "category_share": sql(
        _share("best", "category_id", "pv_count"),
        TOP_CATEGORIES,
        "best AS (SELECT * FROM top_categories WHERE ranking <= 15)",
    ),
    # The sample keeps up to 2000 buyers, which is all of them in the driver's tables.
    "rfm_sample": sql(
        "SELECT user_id, recency, frequency, monetary, monetary * 3 + 10 AS size FROM rfm", RFM
    ),
    "rfm_sample_cut": sql(
        """SELECT user_id, recency, frequency, monetary, monetary * 3 + 10 AS size FROM rfm
ORDER BY md5(user_id || ':42'), user_id LIMIT 7""",
        RFM,
    ),
    "result_csv_head": sql("SELECT * FROM rfm ORDER BY user_id LIMIT 20", RFM),
    "category_conversion_feed": sql(
        """SELECT ranking, CAST(category_id AS VARCHAR) AS category, pv_count, conversion_rate,
  (SELECT min(pv_count) FROM top_categories) AS min_pv,
  (SELECT max(pv_count) FROM top_categories) AS max_pv FROM top_categories""",
        TOP_CATEGORIES,
    ),
    "top_items_feed": sql(
        """SELECT ranking, '#' || ranking || ' 商品' || item_id AS label,
  '综合=' || CAST(total_score AS BIGINT) || ' / 购买=' || buy_count AS value_label,
  total_score, pv_count, buy_count FROM top_items WHERE ranking <= 20""",
        TOP_ITEMS,
    ),
    "retention_extremes": sql(
        """SELECT b.first_date AS best_date, b.day_1 AS best_rate,
  w.first_date AS worst_date, w.day_1 AS worst_rate
FROM (SELECT * FROM cohorts ORDER BY day_1 DESC, first_date LIMIT 1) b,
     (SELECT * FROM cohorts ORDER BY day_1, first_date LIMIT 1) w""",
        retention((1, 2, 3)),
    ),
    "repurchase_feed": sql(
        "SELECT bucket_order, buy_times_bucket, user_ratio, buy_contribution FROM repurchase",
        REPURCHASE,
    ),
    "hourly_feed": sql(
        "SELECT event_hour, event_hour || ':00' AS hour_label, pv, uv, cart_count, buy_count "
        "FROM hourly",
        HOURLY,
    ),
    "stored_partition_scan": sql(
        """SELECT event_date, count(*) AS cnt FROM detail
WHERE event_date BETWEEN '2024-01-08' AND '2024-01-14' GROUP BY event_date"""
    ),
    "ods_csv_load": sql(SHARE_RAW),
    "keyed_json_messages": sql(
        """SELECT CAST(user_id AS VARCHAR) AS key,
  '{"user_id":' || user_id || ',"item_id":' || item_id || ',"category_id":' || category_id ||
  ',"behavior":"' || behavior || '","timestamp":' || timestamp || '}' AS value FROM raw"""
    ),
    "decoded_messages": sql(ALL_RAW),
    "stream_pv_uv": sql(
        """SELECT window_start_s, window_end_s, behavior, count(*) AS count FROM windows
GROUP BY ALL""",
        WINDOWS,
    ),
    "stream_uv_tolerance": sql(
        "SELECT DISTINCT window_start_s, behavior, CAST(1 AS INTEGER) AS within FROM windows", WINDOWS
    ),
    "stream_batch_files": sql(ALL_RAW),
    "stream_numbered_files": sql(ALL_RAW),
    "stream_file_sizes": sql(
        """SELECT i.i + 1 AS batch, least(300, n - 300 * i.i) AS cnt
FROM (SELECT count(*) AS n FROM raw), range(1000000) i(i) WHERE 300 * i.i < n"""
    ),
    "stream_row_limit": sql("SELECT least(700, count(*)) AS taken FROM raw"),
    "stream_late_events": sql(
        """SELECT window_start_s, behavior, count(*) AS events FROM windows
GROUP BY window_start_s, behavior""",
        WINDOWS,
    ),
    "ods_rejects": sql(
        """SELECT CASE kind WHEN 2 THEN 'item_id' WHEN 3 THEN 'user_id,timestamp' ELSE 'fields' END AS reason,
  CASE kind WHEN 0 THEN concat_ws(',', user_id, item_id, category_id, behavior)
            WHEN 1 THEN concat_ws(',', user_id, item_id, category_id, behavior, timestamp, 'x')
            WHEN 2 THEN concat_ws(',', user_id, 'n/a', category_id, behavior, timestamp)
            ELSE concat_ws(',', 'u' || user_id, item_id, category_id, behavior, 'soon') END AS rejected_line
FROM (SELECT *, (user_id + timestamp) % 10 AS kind FROM raw) WHERE kind <= 3"""
    ),
    "ods_accepted": sql(f"{ALL_RAW} WHERE (user_id + timestamp) % 10 > 3"),
    "catalog_tables": sql(
        f"""SELECT layer, "table", CAST(CASE "table"
    WHEN 'user_behavior_detail' THEN (SELECT count(*) FROM detail)
    WHEN 'daily_pv_uv' THEN (SELECT count(*) FROM daily) ELSE 0 END AS BIGINT) AS row_count
FROM (VALUES {CATALOG}) AS t(layer, "table")""",
        DAILY,
    ),
    "catalog_columns": sql(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS col_name, '{kind}' AS data_type, {c == 'event_date'} AS is_partition,"
            f" count({c}) AS filled FROM detail"
            for c, kind in (
                ("user_id", "bigint"),
                ("item_id", "bigint"),
                ("category_id", "bigint"),
                ("behavior", "string"),
                ("event_time", "string"),
                ("event_hour", "int"),
                ("day_of_week", "int"),
                ("is_weekend", "int"),
                ("event_date", "string"),
            )
        )
        + ")"
    ),
}


def over_orders(events_sql: str) -> str:
    """The same query over order lines."""
    body = events_sql.removeprefix(base())
    return base(RAW_ORDERS, ORDERS_START, ORDERS_END) + body.replace(END, ORDERS_END)


ORACLE["stored_day_rerun"] = ORACLE["summary_hourly"] = ORACLE["catalog_round_trip"] = ORACLE["dws_hourly"]
ORACLE["summary_hourly_distribution"] = ORACLE["hourly_distribution"]
ORACLE["summary_heatmap"] = ORACLE["heatmap_hour_dow"]
ORACLE["result_csv_reload"] = ORACLE["daily_pv_uv"]
ORACLE["summary_repurchase"] = ORACLE["repurchase_distribution"]
for _name in (
    "daily_pv_uv",
    "behavior_funnel",
    "top_items",
    "top_categories",
    "weekday_vs_weekend",
    "retention",
    "user_rfm",
):
    ORACLE[f"summary_{_name}"] = ORACLE[_name]
ORACLE["orders_retention"] = over_orders(sql("SELECT * FROM cohorts", retention((1, 7, 30))))
ORACLE["orders_clean_audit"] = over_orders(ORACLE["etl_clean_audit"])
for _name in (
    "daily_pv_uv",
    "behavior_funnel",
    "top_items",
    "top_categories",
    "weekday_vs_weekend",
    "user_rfm",
    "rfm_summary",
    "user_path",
    "heatmap_hour_dow",
    "repurchase_distribution",
    "category_top_items",
    "verify_counts",
):
    ORACLE[f"orders_{_name}"] = over_orders(ORACLE[_name])

# the cleaning queries leave out the outer days
ORACLE["etl_null_audit"] = ORACLE["etl_clean_audit"].replace(
    "SELECT user_id, item_id, item_id // 10 AS category_id",
    "SELECT user_id, CASE WHEN item_id >= 10 THEN item_id END AS item_id, item_id // 10 AS category_id",
)
ORACLE["etl_null_audit"] = ORACLE["etl_null_audit"].replace(
    "'buy') AND in_range", "'buy') AND in_range AND item_id IS NOT NULL"
)
for _name in ("etl_clean_audit", "etl_null_audit", "etl_detail", "etl_rows_per_day"):
    ORACLE[_name] = ORACLE[_name].replace(f"'{START}' AND '{END}'", f"'{CUT_START}' AND '{CUT_END}'")
ORACLE["orders_clean_audit"] = ORACLE["orders_clean_audit"].replace(
    f"'{ORDERS_START}' AND '{ORDERS_END}'", f"'{ORDERS_CUT_START}' AND '{ORDERS_CUT_END}'"
)
# a fifth behaviour is accepted
_FIVE = ("behavior IN ('pv', 'fav', 'cart', 'buy') AND", "behavior IN ('pv', 'fav', 'cart', 'buy', 'error') AND")
ORACLE["weekday_vs_weekend_all"] = ORACLE["weekday_vs_weekend"].replace(*_FIVE)
ORACLE["weekday_pivot_all"] = ORACLE["weekday_pivot"].replace(*_FIVE).replace(
    " FROM weekday GROUP BY",
    ", coalesce(CAST(max(total_count) FILTER (WHERE behavior = 'error') AS BIGINT), 0) AS error"
    " FROM weekday GROUP BY",
).replace("\n  , coalesce", ", coalesce")
