"""DuckDB SQL oracles, one per registered query (same column names).

They restate each rule in its literal per-row form (windows over the whole
key history, ``lag``/``lead``/``first_value``), independent of the Spark
plans, which use aggregates and bucketed windows instead.
"""

from __future__ import annotations

# ----------------------------------------------------------- shared views
_TRAFFIC = """
traffic AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, (epoch_us(ts) // 1000) AS ts,
         CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
         event_type = 'view' AS is_entry, event_type, value, props
  FROM events)"""

_DAY = "strftime(make_timestamp(({x}) * 1000), '%Y-%m-%d')"


def _day(x: str) -> str:
    return _DAY.format(x=x)


_REPAIR = f"""
repaired AS (
  SELECT *, CASE WHEN is_new = '1' AND visit_dt <> first_dt THEN '0' ELSE is_new END AS is_new_fixed
  FROM (
    SELECT *, {_day('ts')} AS visit_dt,
      first_value(CASE WHEN is_new = '1' THEN {_day('ts')} ELSE {_day('ts - 86400000')} END)
        OVER (PARTITION BY mid ORDER BY ts, event_id) AS first_dt
    FROM traffic))"""

VISITOR_REPAIR = f"""WITH {_TRAFFIC}, {_REPAIR}
SELECT event_id, mid, ts, visit_dt, is_new_fixed AS is_new FROM repaired"""

UNIQUE_VISITOR = f"""WITH {_TRAFFIC}
SELECT event_id, mid, ts, visit_dt FROM (
  SELECT *, lag(visit_dt) OVER (PARTITION BY mid ORDER BY ts, event_id) AS prev_dt
  FROM (SELECT event_id, mid, ts, {_day('ts')} AS visit_dt FROM traffic))
WHERE prev_dt IS NULL OR prev_dt <> visit_dt"""

UNIQUE_VISITOR_ENTRY = f"""WITH {_TRAFFIC}
SELECT event_id, mid, ts, visit_dt FROM (
  SELECT *, lag(visit_dt) OVER (PARTITION BY mid ORDER BY ts, event_id) AS prev_dt
  FROM (SELECT event_id, mid, ts, {_day('ts')} AS visit_dt FROM traffic WHERE is_entry))
WHERE prev_dt IS NULL OR prev_dt <> visit_dt"""

_JUMP_MS = 6 * 3600 * 1000

USER_JUMP = f"""WITH {_TRAFFIC}
SELECT event_id, mid, ts FROM (
  SELECT *, lead(ts) OVER w AS next_ts, lead(is_entry) OVER w AS next_entry
  FROM traffic WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
WHERE is_entry AND (next_ts IS NULL OR next_ts - ts >= {_JUMP_MS} OR next_entry)"""

# Log records as the adapter builds them, after repair (job 2).
_LOG = f"""{_TRAFFIC}, {_REPAIR},
logrec AS (
  SELECT event_id, mid, is_new_fixed AS is_new, ts, event_type, value,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM repaired)"""

LOG_SPLIT_PAGE = f"""WITH {_LOG}
SELECT mid, is_new, ts, event_type AS page_id,
       CASE WHEN event_type <> 'view' THEN 'home' END AS last_page_id,
       CAST(k AS VARCHAR) AS item
FROM logrec WHERE event_type <> 'signup'"""

LOG_SPLIT_START = f"""WITH {_LOG}
SELECT mid, is_new, ts, 'icon' AS entry FROM logrec WHERE event_type = 'signup'"""

LOG_SPLIT_ACTION = f"""WITH {_LOG}
SELECT mid, ts, event_type AS page_id, 'click' AS action_id, CAST(k AS VARCHAR) AS item
FROM logrec WHERE event_type = 'click'
UNION ALL
SELECT mid, ts, event_type, 'favor_add', CAST(k + 1 AS VARCHAR) FROM logrec WHERE event_type = 'click'"""

LOG_SPLIT_DISPLAY = f"""WITH {_LOG}
SELECT mid, ts, event_type AS page_id, CAST(k AS VARCHAR) AS item, '1' AS display_order
FROM logrec WHERE event_type IN ('purchase', 'view')
UNION ALL
SELECT mid, ts, event_type, CAST(k + 1 AS VARCHAR), '2' FROM logrec WHERE event_type = 'purchase'"""

LOG_SPLIT_ERROR = f"""WITH {_LOG}
SELECT CAST(k AS VARCHAR) AS error_code, 'app crash' AS msg FROM logrec WHERE event_type = 'error'"""

PAGE_UNIQUE_VISITOR = f"""WITH {_LOG}
SELECT mid, ts, page_id FROM (
  SELECT mid, ts, event_type AS page_id, {_day('ts')} AS d,
         lag({_day('ts')}) OVER (PARTITION BY mid ORDER BY ts, event_id) AS prev_d
  FROM logrec WHERE event_type = 'view')
WHERE prev_d IS NULL OR prev_d <> d"""

PAGE_USER_JUMP = f"""WITH {_LOG}
SELECT mid, ts FROM (
  SELECT *, lead(ts) OVER w AS next_ts, lead(event_type = 'view') OVER w AS next_entry
  FROM logrec WHERE event_type <> 'signup'
  WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
WHERE event_type = 'view' AND (next_ts IS NULL OR next_ts - ts >= {_JUMP_MS} OR next_entry)"""

_RAW = """
raw AS (
  SELECT event_id, CASE
    WHEN event_type = 'error' THEN substring(props, 1, length(props) - 1)
    WHEN event_type = 'signup' THEN '[' || props || ']'
    WHEN event_type = 'click' THEN '{"type":"bootstrap-insert","data":' || props || '}'
    WHEN event_type = 'purchase' AND value < 10 THEN '{"type":"bootstrap-start","data":' || props || '}'
    WHEN event_type = 'purchase' THEN '{"type":"insert","data":' || props || '}'
    ELSE props END AS value
  FROM events),
classified AS (
  SELECT event_id, value,
    CASE WHEN coalesce(json_valid(value), false) THEN
      CASE WHEN json_type(value) = 'OBJECT' THEN
        coalesce(json_extract_string(value, '$.type') NOT IN ('bootstrap-start', 'bootstrap-complete'), true)
      ELSE false END
    ELSE false END AS ok
  FROM raw)"""

CLEAN_JSON = f"""WITH {_RAW}
SELECT event_id, json_extract_string(value, '$.type') AS type,
       coalesce(json_extract_string(value, '$.data.k'), json_extract_string(value, '$.k')) AS k
FROM classified WHERE ok"""

DIRTY_JSON = f"""WITH {_RAW}
SELECT event_id, value FROM classified WHERE NOT ok"""

DELIMITED_RECORDS = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_custkey * 1000 AS ts
FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'AUTOMOBILE'"""

DELIMITED_LEFT_JOIN = """
SELECT n.id, n.name, s.sex, n.name_ts, s.sex_ts
FROM (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_custkey * 1000 AS name_ts
      FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'AUTOMOBILE') n
LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_acctbal < 0 THEN 'F' ELSE 'M' END AS sex,
                  s_suppkey * 1000 + 500 AS sex_ts FROM supplier) s
ON n.id = s.id"""

TIME_FORMATS = """
SELECT event_id, (epoch_us(ts) // 1000) AS ts,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS date_gmt8,
  strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS datetime_gmt8,
  strftime(ts + INTERVAL 8 HOUR - INTERVAL 1 DAY, '%Y-%m-%d') AS prev_date_gmt8,
  epoch_us(date_trunc('second', ts)) // 1000 AS second_ms,
  epoch_us(date_trunc('day', ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR) // 1000 AS day_start_ms
FROM events"""

# ------------------------------------------------------------ trade views
_DIC = """
base_dic(dic_code, dic_name) AS (VALUES
  ('A', 'source A'), ('N', 'source N'), ('1101', 'payment type 1'),
  ('1102', 'payment type 2'), ('1103', 'payment type 3'))"""

_D2 = "CAST({x} AS DECIMAL(16,2))"


def _d2(x: str) -> str:
    return _D2.format(x=x)


_SECS = "CAST(epoch_us({x}) // 1000000 AS BIGINT)"


def _secs(x: str) -> str:
    return _SECS.format(x=x)


_DETAIL_ID = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
              "strftime(l_shipdate, '%Y%m%d'))")

_OD = f"""
od AS (
  SELECT {_DETAIL_ID} AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, 'sku-' || l_partkey AS sku_name,
    CAST({_d2('l_extendedprice')} AS VARCHAR) AS order_price,
    CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
    l_returnflag AS source_type, CAST(l_suppkey AS VARCHAR) AS source_id,
    CAST({_d2('l_extendedprice')} * (1 - {_d2('l_discount')}) AS VARCHAR) AS split_total_amount,
    CAST({_d2('l_extendedprice')} * {_d2('l_discount')} AS VARCHAR) AS split_activity_amount,
    CAST({_d2('l_extendedprice')} * {_d2('l_tax')} AS VARCHAR) AS split_coupon_amount,
    CAST({_d2('l_extendedprice')} * CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(16,2)) AS VARCHAR)
      AS split_original_amount,
    {_secs('l_shipdate')} AS od_ts
  FROM lineitem),
oi AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS oi_id, '1001' AS order_status,
    CAST(o_custkey AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS operate_time,
    substr(o_orderpriority, 1, 1) AS province_id, {_secs('o_orderdate')} AS oi_ts,
    'insert' AS type, CAST(NULL AS VARCHAR) AS old
  FROM orders
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus = 'F' THEN '1003' ELSE '1002' END,
    CAST(o_custkey AS VARCHAR), strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S'),
    substr(o_orderpriority, 1, 1), {_secs('o_orderdate')} + 86400,
    'update', '{{"order_status":"1001"}}'
  FROM orders WHERE o_orderstatus IN ('F', 'P')),
act AS (
  SELECT {_DETAIL_ID} AS order_detail_id,
    'act-' || CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS activity_id,
    CAST(l_linenumber AS VARCHAR) AS activity_rule_id
  FROM lineitem WHERE l_discount >= 0.05),
cou AS (
  SELECT {_DETAIL_ID} AS order_detail_id,
    'cpn-' || CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) AS coupon_id,
    'use-' || {_DETAIL_ID} AS coupon_use_id
  FROM lineitem WHERE l_tax >= 0.06),
pre AS (
  SELECT od.id, od.order_id, od.sku_id, od.sku_name, od.order_price, od.sku_num,
    od.create_time, b.dic_name AS source_type, od.source_id, od.split_total_amount,
    od.split_activity_amount, od.split_coupon_amount, od.split_original_amount, od.od_ts,
    oi.order_status, oi.user_id, oi.operate_time, oi.province_id, oi.oi_ts,
    act.activity_id, act.activity_rule_id, cou.coupon_id, cou.coupon_use_id, oi.type, oi.old
  FROM od
  JOIN oi ON od.order_id = oi.oi_id
  LEFT JOIN act ON od.id = act.order_detail_id
  LEFT JOIN cou ON od.id = cou.order_detail_id
  JOIN base_dic b ON b.dic_code = od.source_type)"""

_DETAIL_COLS = """id, order_id, sku_id, sku_name, order_price, sku_num, create_time, source_type,
  source_id, split_total_amount, split_activity_amount, split_coupon_amount,
  split_original_amount, od_ts, order_status, user_id, operate_time, province_id, oi_ts,
  activity_id, activity_rule_id, coupon_id, coupon_use_id"""

ORDER_PRE_PROCESS = f"WITH {_DIC}, {_OD}\nSELECT * FROM pre"
ORDER_DETAIL = f"WITH {_DIC}, {_OD}\nSELECT {_DETAIL_COLS} FROM pre WHERE type = 'insert'"
CANCEL_DETAIL = (f"WITH {_DIC}, {_OD}\nSELECT {_DETAIL_COLS} FROM pre "
                 "WHERE type = 'update' AND order_status = '1003'")
PAY_DETAIL = f"""WITH {_DIC}, {_OD},
pi AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '110' || substr(o_orderpriority, 1, 1) AS payment_type,
    strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS create_time
  FROM orders WHERE o_orderstatus = 'P')
SELECT {', '.join('p.' + c.strip() for c in _DETAIL_COLS.split(','))},
  b.dic_name AS payment_type, pi.create_time AS pay_time
FROM pi JOIN (SELECT * FROM pre WHERE type = 'insert') p ON pi.order_id = p.order_id
JOIN base_dic b ON pi.payment_type = b.dic_code"""

CART_ADD = f"""WITH {_DIC},
v AS (
  SELECT *, row_number() OVER w AS n, lag(l_quantity) OVER w AS prev_q
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate, l_partkey, l_suppkey)),
c AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, CAST(l_orderkey AS VARCHAR) AS user_id,
    CAST(l_partkey AS VARCHAR) AS sku_id, CAST({_d2('l_extendedprice')} AS VARCHAR) AS cart_price,
    CASE WHEN n = 1 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
         ELSE CAST(CAST(l_quantity AS BIGINT) - CAST(prev_q AS BIGINT) AS VARCHAR) END AS sku_num,
    'sku-' || l_partkey AS sku_name, '1' AS is_checked,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
    CASE WHEN n > 1 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS operate_time,
    '0' AS is_ordered, CAST(NULL AS VARCHAR) AS order_time, l_returnflag AS source_type,
    CAST(l_suppkey AS VARCHAR) AS source_id
  FROM v WHERE n = 1 OR CAST(l_quantity AS BIGINT) - CAST(prev_q AS BIGINT) > 0)
SELECT c.id, c.user_id, c.sku_id, c.cart_price, c.sku_num, c.sku_name, c.is_checked,
  c.create_time, c.operate_time, c.is_ordered, c.order_time, b.dic_name, c.source_id
FROM c JOIN base_dic b ON c.source_type = b.dic_code"""

_CP = f"""{_TRAFFIC},
l AS (SELECT event_id AS click_id, mid, ts AS click_ts FROM traffic WHERE event_type = 'click'),
r AS (SELECT event_id AS purchase_id, mid, ts AS purchase_ts FROM traffic WHERE event_type = 'purchase')"""

INTERVAL_JOIN = f"""WITH {_CP}
SELECT l.click_id, r.purchase_id, l.mid, l.click_ts, r.purchase_ts
FROM l JOIN r ON l.mid = r.mid AND r.purchase_ts BETWEEN l.click_ts - 3600000 AND l.click_ts + 3600000"""

INTERVAL_LEFT_JOIN = f"""WITH {_CP}
SELECT l.click_id, r.purchase_id, l.mid, l.click_ts, r.purchase_ts
FROM l LEFT JOIN r ON l.mid = r.mid AND r.purchase_ts BETWEEN l.click_ts - 3600000 AND l.click_ts + 3600000"""

UPSERT_LATEST = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity,
  strftime(l_shipdate, '%Y-%m-%d') AS ship_dt
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
      FROM lineitem) WHERE rn = 1"""

DIM_SYNC = f"""
SELECT 'dim_customer' AS sink_table, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
  CAST(c_nationkey AS VARCHAR) AS nation_id,
  CASE WHEN c_acctbal < 0 THEN '0.00' ELSE CAST({_d2('c_acctbal')} AS VARCHAR) END AS acctbal,
  CAST(NULL AS VARCHAR) AS brand, CAST(NULL AS VARCHAR) AS size
FROM customer
UNION ALL
SELECT 'dim_part', CAST(p_partkey AS VARCHAR), p_name, NULL, NULL, p_brand, CAST(p_size AS VARCHAR)
FROM part
UNION ALL
SELECT 'dim_supplier', CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR),
  CAST({_d2('s_acctbal')} AS VARCHAR), NULL, NULL
FROM supplier"""

# Job 2 on open records: the expected texts, spelled out with keys in order.
def _open(ties: bool) -> str:
    ts = "epoch_us(date_trunc('hour', ts)) // 1000" if ties else "epoch_us(ts) // 1000"
    return f"""
traffic AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, ({ts}) AS ts,
         CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new, event_type,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events), {_REPAIR},
open AS (
  SELECT *, '{{"device":{{"area":' || k || ',"ch":"web"}},"is_new":"' || is_new_fixed || '","mid":"' || mid || '"}}' AS common,
    '{{"during_time":' || k || CASE WHEN event_type <> 'view' THEN ',"last_page_id":"home"' ELSE '' END
      || ',"page_id":"' || event_type || '"}}' AS page,
    '"extra":{{"v":[1,' || k || ']}}' AS extra
  FROM repaired)"""


LOG_TOPIC_START = f"""WITH {_open(False)}
SELECT event_id, '{{"common":' || common || ',' || extra || ',"start":{{"entry":"icon","loading_time":' || k || '}},"ts":' || ts || '}}' AS value
FROM open WHERE event_type = 'signup'"""

LOG_TOPIC_ERROR = f"""WITH {_open(False)}
SELECT event_id, '{{"error_code":' || k || ',"msg":"app crash"}}' AS value FROM open WHERE event_type = 'error'"""

LOG_TOPIC_ACTION = f"""WITH {_open(False)}
SELECT event_id, '{{"action_id":"click","common":' || common || ',"item":' || k || ',"page":' || page || ',"ts":' || ts || '}}' AS value
FROM open WHERE event_type = 'click'
UNION ALL
SELECT event_id, '{{"action_id":"favor_add","common":' || common || ',"item":' || (k + 1) || ',"page":' || page || ',"ts":' || ts || '}}'
FROM open WHERE event_type = 'click'"""

LOG_TOPIC_DISPLAY = f"""WITH {_open(False)}
SELECT event_id, '{{"common":' || common || ',"item":' || k || ',"order":1,"page":' || page || ',"ts":' || ts || '}}' AS value
FROM open WHERE event_type IN ('purchase', 'view')"""

LOG_TOPIC_PAGE = f"""WITH {_open(False)}
SELECT event_id, '{{"common":' || common || ',' || extra || ',"page":' || page || ',"ts":' || ts || '}}' AS value
FROM open WHERE event_type <> 'signup'"""

VISITOR_REPAIR_TIES = f"""WITH {_open(True)}
SELECT event_id, mid, ts, is_new_fixed AS is_new FROM repaired"""

PAGE_USER_JUMP_TIES = f"""WITH {_open(True)}
SELECT event_id, mid, ts FROM (
  SELECT *, lead(ts) OVER w AS next_ts, lead(event_type = 'view') OVER w AS next_entry
  FROM open WHERE event_type <> 'signup' WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
WHERE event_type = 'view' AND (next_ts IS NULL OR next_ts - ts >= {_JUMP_MS} OR next_entry)"""

ORDER_CURRENT = f"""WITH {_DIC}, {_OD}
SELECT id, type, order_status, oi_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY oi_ts DESC) AS rn FROM pre) WHERE rn = 1"""

CONFIG_FOLD = """
SELECT lower(r_name) AS source_table, 'dim_' || lower(r_name) AS sink_table, 'id,name' AS sink_columns, 'id' AS sink_pk
FROM region WHERE r_regionkey % 2 = 1"""

DICTIONARY_FILE = """
SELECT c_custkey, n_name AS dic_name, n_name || ',' || c_mktsegment AS joined, 2 AS parts
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

ORDER_WITHIN_BOUND = f"""
SELECT {_DETAIL_ID} AS id, o_orderstatus AS status, epoch_us(o_orderdate) // 1000 AS order_ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderdate BETWEEN l_shipdate - INTERVAL 30 DAY AND l_shipdate + INTERVAL 30 DAY"""

# Rows by arrival: the watermark is the newest time of all rows before, less delay and a millisecond.
_ARRIVING = """
arriving AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS mid, epoch_us(ts) // 1000 AS ts, event_type = 'view' AS is_entry,
         epoch_us(ts) // 1000 + CAST(floor(value * 60000) AS BIGINT) AS arrival
  FROM events),
met AS (
  SELECT *, coalesce(ts <= max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1800001, false) AS late
  FROM arriving)"""

USER_JUMP_ON_TIME = f"""WITH {_ARRIVING}
SELECT event_id, mid, ts FROM (
  SELECT *, lead(ts) OVER w AS next_ts, lead(is_entry) OVER w AS next_entry
  FROM met WHERE NOT late WINDOW w AS (PARTITION BY mid ORDER BY ts, arrival, event_id))
WHERE is_entry AND (next_ts IS NULL OR next_ts - ts >= {_JUMP_MS} OR next_entry)"""

USER_JUMP_LATE = f"""WITH {_ARRIVING} SELECT event_id, mid, ts, arrival FROM met WHERE late"""

CART_ADD_AS_OF = f"""WITH versions(code, name, since, gone) AS (VALUES
  ('A', 'source A', 0, false), ('A', 'source A renamed', 883612800, false), ('N', 'source N', 852076800, false),
  ('R', 'source R', 0, false), ('R', 'source R', 915148800, true), ('R', 'source R again', 946684800, false)),
v AS (
  SELECT *, row_number() OVER w AS n, lag(l_quantity) OVER w AS prev_q, {_secs('l_shipdate')} AS ts
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey))
SELECT l_orderkey || '-' || l_linenumber AS id,
  CAST(CAST(l_quantity AS BIGINT) - CASE WHEN n = 1 THEN 0 ELSE CAST(prev_q AS BIGINT) END AS VARCHAR) AS sku_num,
  CAST(l_suppkey AS VARCHAR) AS source_id, d.name AS dic_name, ts
FROM v JOIN versions d ON d.code = v.l_returnflag AND NOT d.gone
  AND d.since = (SELECT max(x.since) FROM versions x WHERE x.code = v.l_returnflag AND x.since <= v.ts)
WHERE n = 1 OR CAST(l_quantity AS BIGINT) - CAST(prev_q AS BIGINT) > 0"""

CLICK_AS_OF_PURCHASE = f"""WITH {_TRAFFIC}
SELECT c.event_id, c.mid, c.ts, arg_max(p.event_id, (p.ts, p.event_id)) AS purchase_id
FROM traffic c LEFT JOIN traffic p ON p.event_type = 'purchase' AND p.mid = c.mid AND p.ts <= c.ts
WHERE c.event_type = 'click' GROUP BY c.event_id, c.mid, c.ts"""

# The literal state machine: a right row finds those left rows that no gap of two days has dropped before it.
LEFT_JOIN_IDLE = f"""WITH {_CP},
pairs AS (
  SELECT l.click_id, l.click_ts, r.purchase_id, r.purchase_ts,
         purchase_ts - lag(purchase_ts, 1, click_ts) OVER (PARTITION BY l.click_id, purchase_ts >= click_ts ORDER BY purchase_ts, purchase_id) AS gap
  FROM l JOIN r ON l.mid = r.mid),
met AS (
  SELECT 'create' AS rule, click_id, click_ts, purchase_id, purchase_ts FROM pairs WHERE abs(purchase_ts - click_ts) < 172800000
  UNION ALL
  SELECT 'read_write', click_id, click_ts, purchase_id, purchase_ts
  FROM (SELECT *, max(gap) OVER (PARTITION BY click_id, purchase_ts >= click_ts ORDER BY purchase_ts, purchase_id) AS widest FROM pairs)
  WHERE CASE WHEN purchase_ts < click_ts THEN click_ts - purchase_ts < 172800000 ELSE widest < 172800000 END)
SELECT rule, click_id, purchase_id, greatest(click_ts, purchase_ts) AS row_from, CAST(NULL AS BIGINT) AS row_to FROM met
UNION ALL
SELECT rules.rule, l.click_id, NULL, l.click_ts, (SELECT min(purchase_ts) FROM met m WHERE m.rule = rules.rule AND m.click_id = l.click_id)
FROM l, (VALUES ('create'), ('read_write')) rules(rule)
WHERE NOT EXISTS (SELECT 1 FROM met m WHERE m.rule = rules.rule AND m.click_id = l.click_id AND m.purchase_ts < l.click_ts)"""

ORDER_RETRACTIONS = f"""WITH {_DIC}, {_OD},
a AS (SELECT {_DETAIL_ID} AS k, 'act-' || CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS activity_id,
             ({_secs('l_shipdate')} + (l_partkey % 7 - 3) * 2592000) * 8 + 3 AS p FROM lineitem WHERE l_discount >= 0.05),
c AS (SELECT {_DETAIL_ID} AS k, 'cpn-' || CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) AS coupon_id,
             ({_secs('l_shipdate')} + (l_suppkey % 5 - 2) * 3888000) * 8 + 4 AS p FROM lineitem WHERE l_tax >= 0.06),
one AS (SELECT od.id, b.dic_name AS source_type, oi.order_status, oi.oi_ts,
               greatest(od.od_ts * 8, oi.oi_ts * 8 + CASE WHEN oi.type = 'insert' THEN 1 ELSE 2 END) AS f
        FROM od JOIN oi ON od.order_id = oi.oi_id JOIN base_dic b ON b.dic_code = od.source_type),
two AS (
  SELECT one.id, source_type, order_status, oi_ts, a.activity_id, greatest(f, p) AS f, CAST(NULL AS BIGINT) AS t FROM one JOIN a ON a.k = one.id
  UNION ALL
  SELECT id, source_type, order_status, oi_ts, NULL, f, (SELECT min(p) FROM a WHERE a.k = one.id) AS t FROM one
  WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.k = one.id AND a.p < one.f)),
three AS (
  SELECT two.* EXCLUDE (f), c.coupon_id, greatest(f, p) AS f FROM two JOIN c ON c.k = two.id WHERE t IS NULL OR greatest(f, p) < t
  UNION ALL
  SELECT id, source_type, order_status, oi_ts, activity_id, least(t, (SELECT min(p) FROM c WHERE c.k = two.id)) AS t, NULL, f FROM two
  WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k = two.id AND c.p < two.f))
SELECT id, f AS place, false AS tombstone, order_status, oi_ts, source_type, activity_id, coupon_id FROM three
UNION ALL
SELECT id, t, true, NULL, NULL, NULL, NULL, NULL FROM three WHERE t IS NOT NULL"""

DIM_ARRIVAL = """
SELECT 'dim_part' AS sink_table, CAST(p_partkey AS VARCHAR) AS pk,
       '{"id":"' || p_partkey || '","name":"' || p_name || '","extra":"x"}' AS data FROM part WHERE p_partkey >= 5
UNION ALL
SELECT 'dim_customer', CAST(c_custkey AS VARCHAR), '{"id":"' || c_custkey || '","name":"' || c_name || '"}'
FROM customer WHERE c_custkey BETWEEN 21 AND 59 OR c_custkey >= 110
UNION ALL
SELECT 'dim_buyer', CAST(c_custkey AS VARCHAR), '{"id":"' || c_custkey || '","extra":"x"}' FROM customer WHERE c_custkey BETWEEN 60 AND 89"""

TOPIC_ARRIVAL = """
SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(ts) // 1000 AS ts,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_type <> 'signup', event_id) AS INTEGER) AS nth
FROM events"""

SNAPSHOT_THEN_LOG = f"""
WITH s AS (SELECT c_custkey AS id, CAST({_d2('c_acctbal')} AS VARCHAR) AS value, c_custkey // 100 * 300 AS read_at FROM customer WHERE c_acctbal >= 0)
SELECT 'r' AS op, id, value, read_at AS place FROM s
UNION ALL
SELECT 'u', o_custkey, CAST({_d2('o_totalprice')} AS VARCHAR), o_orderkey
FROM orders LEFT JOIN s ON s.id = o_custkey WHERE o_orderkey > coalesce(read_at, 0)"""

ORACLES: dict[str, str] = {
    "order_current_compacted": ORDER_CURRENT,
    "dim_buckets": DIM_SYNC,
    "dim_arrival": DIM_ARRIVAL,
    "dim_arrival_stream": DIM_ARRIVAL,
    "topic_arrival": TOPIC_ARRIVAL,
    "snapshot_then_log": SNAPSHOT_THEN_LOG,
    "stream_log_page": f"SELECT value FROM ({LOG_TOPIC_PAGE})",
    "stream_user_jump": PAGE_USER_JUMP,
    "stream_unique_visitor": PAGE_UNIQUE_VISITOR,
    "stream_dim_sync": DIM_SYNC,
    "order_retractions": ORDER_RETRACTIONS,
    "left_join_idle": LEFT_JOIN_IDLE,
    "cart_add_as_of": CART_ADD_AS_OF,
    "click_as_of_purchase": CLICK_AS_OF_PURCHASE,
    "user_jump_on_time": USER_JUMP_ON_TIME,
    "user_jump_late": USER_JUMP_LATE,
    "log_topic_start": LOG_TOPIC_START,
    "log_topic_error": LOG_TOPIC_ERROR,
    "log_topic_action": LOG_TOPIC_ACTION,
    "log_topic_display": LOG_TOPIC_DISPLAY,
    "log_topic_page": LOG_TOPIC_PAGE,
    "visitor_repair_ties": VISITOR_REPAIR_TIES,
    "page_user_jump_ties": PAGE_USER_JUMP_TIES,
    "order_current": ORDER_CURRENT,
    "config_fold": CONFIG_FOLD,
    "dictionary_file": DICTIONARY_FILE,
    "order_within_bound": ORDER_WITHIN_BOUND,
    "visitor_repair": VISITOR_REPAIR,
    "unique_visitor": UNIQUE_VISITOR,
    "unique_visitor_entry": UNIQUE_VISITOR_ENTRY,
    "user_jump": USER_JUMP,
    "log_split_page": LOG_SPLIT_PAGE,
    "log_split_start": LOG_SPLIT_START,
    "log_split_action": LOG_SPLIT_ACTION,
    "log_split_display": LOG_SPLIT_DISPLAY,
    "log_split_error": LOG_SPLIT_ERROR,
    "page_unique_visitor": PAGE_UNIQUE_VISITOR,
    "page_user_jump": PAGE_USER_JUMP,
    "clean_json": CLEAN_JSON,
    "dirty_json": DIRTY_JSON,
    "delimited_records": DELIMITED_RECORDS,
    "delimited_left_join": DELIMITED_LEFT_JOIN,
    "time_formats": TIME_FORMATS,
    "cart_add": CART_ADD,
    "order_pre_process": ORDER_PRE_PROCESS,
    "order_detail": ORDER_DETAIL,
    "cancel_detail": CANCEL_DETAIL,
    "pay_detail": PAY_DETAIL,
    "interval_join": INTERVAL_JOIN,
    "interval_left_join": INTERVAL_LEFT_JOIN,
    "upsert_latest": UPSERT_LATEST,
    "dim_sync": DIM_SYNC,
}
