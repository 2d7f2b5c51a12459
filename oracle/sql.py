"""Independent SQL for the registered queries, over the same tables.

``CTES`` are the derived inputs and intermediate layers; ``query`` puts the ones a
statement needs, in order, in front of it.
"""

from __future__ import annotations

import re

GAP_MS = 6 * 3_600_000
HOUR_MS = 3_600_000
AS_OF_MS = 1_704_067_200_000


def clock(ms: str) -> str:
    return f"strftime(make_timestamp(CAST({ms} AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S')"


def day(ms: str) -> str:
    return f"strftime(make_timestamp(CAST({ms} AS BIGINT) * 1000), '%Y-%m-%d')"


def ms_of(text: str, hours: int = 0) -> str:
    return f"(epoch_ms(CAST({text} AS TIMESTAMP)) - {hours * HOUR_MS})"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def window(ms: str, size: int = HOUR_MS) -> str:
    start = f"({ms} - {ms} % {size})"
    return f"{clock(start)} AS stt, {clock(start + f' + {size}')} AS edt"


LINE_MS = "o.ms + ((l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 15 - 7) * 1000"

CTES: dict[str, str] = {
    # ---- inputs
    "log": """
        SELECT e.event_id AS seq, epoch_us(ts) // 1000 AS ts, 'mid_' || user_id AS mid,
               'v' || (user_id % 3) AS vc, 'c' || (e.event_id % 4) AS ch, 'a' || (user_id % 5) AS ar,
               CASE WHEN e.event_id % 2 = 0 THEN '1' ELSE '0' END AS raw_new,
               CASE event_type WHEN 'view' THEN 'good_detail' WHEN 'error' THEN 'search'
                    WHEN 'signup' THEN 'login' WHEN 'purchase' THEN 'cart' ELSE 'home' END AS page_id,
               CASE WHEN event_type NOT IN ('signup', 'error') THEN 'home'
                    WHEN e.event_id % 3 = 0 THEN '' END AS last_page_id,
               CAST(round(value * 100) AS BIGINT) AS during_time,
               CASE event_type WHEN 'view' THEN CAST(e.event_id * 7919 % skus AS VARCHAR)
                    WHEN 'error' THEN p_name END AS item, skus,
               CASE event_type WHEN 'view' THEN 'sku_id' WHEN 'error' THEN 'keyword' END AS item_type,
               event_type = 'signup' AND e.event_id % 3 = 0 AS is_start
        FROM events e CROSS JOIN (SELECT max(p_partkey) + 1 AS skus FROM part)
        LEFT JOIN part p ON p.p_partkey = e.event_id * 7919 % skus""",
    "orders_ms": """
        SELECT *, epoch_ms(o_orderdate) + (o_orderkey % 86400) * 1000 AS ms FROM orders""",
    "order_info": f"""
        SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id,
               CASE o_orderstatus WHEN 'O' THEN '1001' WHEN 'P' THEN '1002' ELSE '1004' END AS order_status,
               o_custkey AS user_id, {money('o_totalprice')} AS total_amount,
               {money('o_orderkey % 10')} AS activity_reduce_amount,
               {money('o_orderkey % 5')} AS coupon_reduce_amount,
               {money(money('o_totalprice') + ' + o_orderkey % 10 + o_orderkey % 5')} AS original_total_amount,
               {money('o_orderkey % 20')} AS feight_fee,
               {clock('ms + 900000')} AS expire_time, {clock('ms')} AS create_time,
               CASE WHEN o_orderstatus <> 'O' THEN {clock('ms + 60000')} END AS operate_time, ms
        FROM orders_ms LEFT JOIN customer ON c_custkey = o_custkey""",
    "lines": f"""
        SELECT l.*, {LINE_MS} AS ms, {clock(LINE_MS)} AS create_time
        FROM lineitem l JOIN orders_ms o ON o.o_orderkey = l.l_orderkey""",
    "order_detail": f"""
        SELECT l_orderkey * 100 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
               {money('l_extendedprice')} AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
               'line_' || l_partkey AS sku_name, create_time, ms,
               {money('l_extendedprice')} AS split_total_amount,
               {money('l_linenumber')} AS split_activity_amount,
               CASE WHEN l_linenumber % 2 = 0 THEN {money('l_linenumber')} END AS split_coupon_amount
        FROM lines""",
    "payment_info": f"""
        SELECT o_orderkey + 1000000 AS id, o_orderkey AS order_id, o_custkey AS user_id,
               {money('o_totalprice')} AS total_amount, 'order ' || o_orderkey AS subject,
               CASE WHEN o_orderkey % 2 = 0 THEN '1101' ELSE '1102' END AS payment_type,
               ms + (o_orderkey % 1201 - 100) * 1000 AS ms,
               {clock('ms + (o_orderkey % 1201 - 100) * 1000')} AS create_time,
               {clock('ms + (o_orderkey % 1201 - 100) * 1000 + 5000')} AS callback_time
        FROM orders_ms WHERE o_orderstatus <> 'O'""",
    "user_dim": f"""
        SELECT c_custkey AS id, DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS birthday,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
        FROM customer WHERE c_acctbal >= 0""",
    "province_dim": """
        SELECT n_nationkey AS id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS area_code,
               'ISO-' || n_nationkey AS iso_code, 'P-' || n_nationkey AS iso_3166_2 FROM nation""",
    "product_dim": f"""
        SELECT p_partkey AS id, p_name AS sku_name, {money('p_retailprice')} AS price,
               p_partkey % 50 AS spu_id, 'spu_' || (p_partkey % 50) AS spu_name,
               CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS tm_id, p_brand AS tm_name,
               CAST(p_size AS BIGINT) AS category3_id, 'category_' || p_size AS category3_name
        FROM part""",
    # ---- log layer
    "repaired": """
        SELECT *, CASE WHEN raw_new = '1' AND row_number() OVER (
                           PARTITION BY mid, raw_new ORDER BY ts, seq) = 1 THEN '1' ELSE '0' END AS is_new
        FROM log""",
    "pages": "SELECT * FROM repaired WHERE NOT is_start",
    "entries": "SELECT * FROM pages WHERE coalesce(last_page_id, '') = ''",
    "uniques": f"""
        SELECT * EXCLUDE (prev) FROM (
            SELECT *, lag({day('ts')}) OVER (PARTITION BY mid ORDER BY ts, seq) AS prev FROM entries)
        WHERE prev IS NULL OR prev <> {day('ts')}""",
    "bounced": f"""
        SELECT * FROM entries s WHERE NOT EXISTS (
            SELECT 1 FROM pages f WHERE f.mid = s.mid AND coalesce(f.last_page_id, '') <> ''
               AND (f.ts > s.ts OR (f.ts = s.ts AND f.seq > s.seq)) AND f.ts < s.ts + {GAP_MS})""",
    "displays": """
        SELECT ts, page_id, CAST((seq * 7 + i) % skus AS VARCHAR) AS item,
               CASE WHEN (seq + i) % 3 = 0 THEN 'promotion' ELSE 'sku_id' END AS item_type
        FROM (SELECT *, unnest(range(seq % 4)) AS i FROM log WHERE NOT is_start)""",
    "visitor_events": """
        SELECT vc, ch, ar, is_new, 0 AS uv_ct, 1 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, during_time AS dur_sum, ts FROM pages
        UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 1, 0, 0, ts FROM entries
        UNION ALL SELECT vc, ch, ar, is_new, 1, 0, 0, 0, 0, ts FROM uniques
        UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM bounced""",
    "searches": """
        SELECT item AS full_word, ts - ts % 1000 AS ts FROM log
        WHERE NOT is_start AND item_type = 'keyword' AND item IS NOT NULL""",
    "tokens": """
        SELECT unnest(regexp_extract_all(lower(full_word), '[\\p{L}\\p{N}]+')) AS keyword, ts FROM searches""",
    # ---- wide layer
    "order_pairs": """
        SELECT o.id AS order_id, d.id AS detail_id, d.sku_id, d.order_price, d.sku_num,
               d.sku_name, o.province_id, o.order_status, o.user_id, o.total_amount,
               o.activity_reduce_amount, o.coupon_reduce_amount, o.original_total_amount,
               o.feight_fee, d.split_activity_amount, d.split_coupon_amount, d.split_total_amount,
               o.create_time, o.ms AS order_ms, d.ms AS detail_ms
        FROM order_info o JOIN order_detail d ON d.order_id = o.id
        WHERE d.ms BETWEEN o.ms - 5000 AND o.ms + 5000""",
    "order_wide": f"""
        SELECT w.detail_id, w.order_id, w.sku_id, w.order_price, w.sku_num,
               CASE WHEN p.id IS NULL THEN w.sku_name ELSE p.sku_name END AS sku_name,
               w.province_id, w.order_status, w.user_id, w.total_amount, w.activity_reduce_amount,
               w.coupon_reduce_amount, w.original_total_amount, w.feight_fee,
               CAST(NULL AS DECIMAL(18,2)) AS split_feight_fee, w.split_activity_amount,
               w.split_coupon_amount, w.split_total_amount, CAST(NULL AS VARCHAR) AS expire_time,
               w.create_time, CAST(NULL AS VARCHAR) AS operate_time,
               substr(w.create_time, 1, 10) AS create_date, substr(w.create_time, 12) AS create_hour,
               v.name AS province_name, v.area_code AS province_area_code,
               v.iso_code AS province_iso_code, v.iso_3166_2 AS province_3166_2_code,
               CAST(({AS_OF_MS} - epoch_ms(CAST(u.birthday AS TIMESTAMP))) // 31536000000 AS INTEGER) AS user_age,
               u.gender AS user_gender, p.spu_id, p.tm_id, p.category3_id, p.spu_name, p.tm_name,
               p.category3_name
        FROM order_pairs w LEFT JOIN user_dim u ON u.id = w.user_id
        LEFT JOIN province_dim v ON v.id = w.province_id LEFT JOIN product_dim p ON p.id = w.sku_id""",
    "payment_wide": f"""
        SELECT p.id AS payment_id, p.subject, p.payment_type, p.create_time AS payment_create_time,
               p.callback_time, w.* EXCLUDE (order_id, user_id, total_amount, create_time,
               create_date, create_hour, expire_time, operate_time),
               p.order_id, p.user_id, p.total_amount, w.create_time AS order_create_time
        FROM payment_info p JOIN order_wide w ON w.order_id = p.order_id
        WHERE {ms_of('w.create_time')} BETWEEN p.ms - 900000 AND p.ms""",
    "product_events": f"""
        SELECT CAST(item AS BIGINT) AS sku_id, ts, 'click' AS kind, NULL AS order_id, 1 AS n,
               NULL AS amount, NULL AS split FROM log WHERE NOT is_start AND page_id = 'good_detail'
        UNION ALL SELECT CAST(item AS BIGINT), ts, 'display', NULL, 1, NULL, NULL FROM displays WHERE item_type = 'sku_id'
        UNION ALL SELECT l_partkey, {ms_of('create_time', 8)}, 'favor', NULL, 1, NULL, NULL FROM lines WHERE l_linenumber = 1
        UNION ALL SELECT l_partkey, {ms_of('create_time', 8)}, 'cart', NULL, 1, NULL, NULL FROM lines WHERE l_linenumber = 2
        UNION ALL SELECT sku_id, {ms_of('create_time', 8)}, 'order', order_id, sku_num, total_amount, split_total_amount FROM order_wide
        UNION ALL SELECT sku_id, {ms_of('payment_create_time', 8)}, 'paid', order_id, 1, split_total_amount, NULL FROM payment_wide
        UNION ALL SELECT l_partkey, {ms_of('create_time', 8)}, 'refund', l_orderkey, 1, {money('l_extendedprice')}, NULL FROM lines WHERE l_returnflag = 'R'
        UNION ALL SELECT l_partkey, {ms_of('create_time', 8)}, CASE WHEN l_linenumber % 4 = 2 THEN 'good' ELSE 'comment' END, NULL, 1, NULL, NULL FROM lines WHERE l_returnflag = 'A'""",
    "product_stats": f"""
        SELECT {window('ts')}, sku_id,
               count(*) FILTER (kind = 'display') AS display_ct,
               count(*) FILTER (kind = 'click') AS click_ct,
               count(*) FILTER (kind = 'favor') AS favor_ct,
               count(*) FILTER (kind = 'cart') AS cart_ct,
               CAST(coalesce(sum(n) FILTER (kind = 'order'), 0) AS BIGINT) AS order_sku_num,
               count(*) FILTER (kind IN ('comment', 'good')) AS comment_ct,
               count(*) FILTER (kind = 'good') AS good_comment_ct,
               CAST(coalesce(sum(amount) FILTER (kind = 'order'), 0) AS DECIMAL(28,2)) AS order_amount,
               CAST(coalesce(sum(split) FILTER (kind = 'order'), 0) AS DECIMAL(28,2)) AS order_split_amount,
               CAST(coalesce(sum(amount) FILTER (kind = 'paid'), 0) AS DECIMAL(28,2)) AS payment_amount,
               CAST(coalesce(sum(amount) FILTER (kind = 'refund'), 0) AS DECIMAL(28,2)) AS refund_amount,
               count(DISTINCT order_id) FILTER (kind = 'order') AS order_ct,
               count(DISTINCT order_id) FILTER (kind = 'paid') AS paid_order_ct,
               count(DISTINCT order_id) FILTER (kind = 'refund') AS refund_order_ct
        FROM product_events GROUP BY ALL""",
    "product_stats_enriched": """
        SELECT s.*, p.sku_name, p.price AS sku_price, p.spu_id, p.spu_name, p.tm_id, p.tm_name,
               p.category3_id, p.category3_name
        FROM product_stats s LEFT JOIN product_dim p ON p.id = s.sku_id""",
    # ---- change layer
    "changes": """
        SELECT 'order_info' AS tab, 'insert' AS raw_type, CAST(id AS VARCHAR) AS id, id * 2 AS seq,
               map {'id': CAST(id AS VARCHAR), 'province_id': CAST(province_id AS VARCHAR),
                    'user_id': CAST(user_id AS VARCHAR), 'order_status': '1001',
                    'total_amount': CAST(total_amount AS VARCHAR), 'create_time': create_time,
                    'note': 'web'} AS data FROM order_info
        UNION ALL SELECT 'order_info', 'update', CAST(id AS VARCHAR), id * 2 + 1,
               map {'id': CAST(id AS VARCHAR), 'order_status': order_status, 'operate_time': operate_time}
               FROM order_info WHERE order_status = '1004'
        UNION ALL SELECT 'user_info', 'insert', CAST(c_custkey AS VARCHAR), c_custkey * 10,
               map {'id': CAST(c_custkey AS VARCHAR), 'name': c_name,
                    'birthday': CAST(DATE '1960-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS VARCHAR),
                    'gender': CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END, 'segment': c_mktsegment}
               FROM customer
        UNION ALL SELECT 'user_info', 'update', CAST(c_custkey AS VARCHAR), c_custkey * 10 + 1,
               map {'id': CAST(c_custkey AS VARCHAR), 'gender': 'X', 'segment': c_mktsegment}
               FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT 'user_info', 'delete', CAST(c_custkey AS VARCHAR), c_custkey * 10 + 2,
               map {'id': CAST(c_custkey AS VARCHAR), 'name': c_name}
               FROM customer WHERE c_mktsegment = 'MACHINERY'
        UNION ALL SELECT 'user_info', 'insert', CAST(c_custkey AS VARCHAR), c_custkey * 10 + 3,
               map {'id': CAST(c_custkey AS VARCHAR), 'name': 'again ' || c_name}
               FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_acctbal < 0
        UNION ALL SELECT 'base_province', 'bootstrap-insert', CAST(n_nationkey AS VARCHAR), n_nationkey,
               map {'id': CAST(n_nationkey AS VARCHAR), 'name': n_name, 'area_code': CAST(n_regionkey AS VARCHAR)}
               FROM nation
        UNION ALL SELECT 'sku_info', 'insert', CAST(id AS VARCHAR), id,
               map {'id': CAST(id AS VARCHAR), 'sku_name': sku_name, 'price': CAST(price AS VARCHAR),
                    'spu_id': CAST(spu_id AS VARCHAR), 'tm_id': CAST(tm_id AS VARCHAR),
                    'category3_id': CAST(category3_id AS VARCHAR)} FROM product_dim
        UNION ALL SELECT 'supplier_info', 'insert', CAST(s_suppkey AS VARCHAR), s_suppkey * 2,
               CASE WHEN s_acctbal < 2000 THEN map {} ELSE map {'id': CAST(s_suppkey AS VARCHAR), 'name': s_name} END
               FROM supplier WHERE s_acctbal >= 0 AND (s_acctbal < 2000 OR s_nationkey > 3)
        UNION ALL SELECT 'supplier_info', 'update', CAST(s_suppkey AS VARCHAR), s_suppkey * 2 + 1,
               map {'id': CAST(s_suppkey AS VARCHAR), 'name': s_name} FROM supplier
        UNION ALL SELECT 'sku_info', 'insert', NULL, s_suppkey, map {'sku_name': s_name}
               FROM supplier WHERE s_suppkey % 3 = 0""",
    "normal": """
        SELECT * EXCLUDE (raw_type),
               CASE raw_type WHEN 'bootstrap-insert' THEN 'insert' ELSE raw_type END AS type FROM changes""",
    "routes": """
        SELECT * FROM (VALUES
          ('order_info', 'insert', 'kafka', 'dwd_order_info', 'id,province_id,order_status,user_id,total_amount,create_time'),
          ('order_info', 'update', 'kafka', 'dwd_order_info_update', 'id,order_status'),
          ('user_info', 'insert', 'hbase', 'dim_user_info', 'id,name,birthday,gender'),
          ('user_info', 'update', 'hbase', 'dim_user_info', 'id,name,birthday,gender'),
          ('user_info', 'delete', 'hbase', 'dim_user_info', 'id,name'),
          ('base_province', 'insert', 'hbase', 'dim_base_province', 'id,name,area_code'),
          ('sku_info', 'insert', 'hbase', 'dim_sku_info', 'id,sku_name,price,spu_id,tm_id'),
          ('supplier_info', 'insert', 'clickhouse', 'supplier_info', 'id,name'))
        AS r(source_table, operate_type, sink_type, sink_table, sink_columns)""",
    "routed": """
        SELECT n.*, r.sink_type, r.sink_table,
               list_filter(map_entries(n.data), lambda e: list_contains(string_split(r.sink_columns, ','), e.key)) AS kept
        FROM normal n LEFT JOIN routes r ON r.source_table = n.tab AND r.operate_type = n.type""",
    "route_images": """
        SELECT p_partkey AS seq, 't' || (p_partkey % 97) AS source_table,
               CASE p_size % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS operate_type,
               CASE WHEN p_size % 2 = 0 THEN 'hbase' ELSE 'kafka' END AS sink_type,
               'dim_t' || (p_partkey % 97) AS sink_table, 'id,name,c' || p_size AS sink_columns,
               CASE WHEN p_size % 5 <> 0 THEN CASE WHEN p_size % 10 = 1 THEN 'name' ELSE 'id' END END AS sink_pk,
               CASE WHEN p_size % 7 = 0 THEN ' salt_buckets = 4' END AS sink_extend
        , p_size % 11 = 0 AS deleted FROM part""",
    "route_config": """
        SELECT * EXCLUDE (seq, rn, deleted) FROM (SELECT *, row_number() OVER (
            PARTITION BY source_table, operate_type ORDER BY seq DESC) AS rn FROM route_images)
        WHERE rn = 1 AND NOT deleted""",
    # ---- rules
    "txns": f"""
        SELECT o_orderkey AS "transactionId", ms AS "eventTime", o_custkey AS "payeeId",
               o_orderkey % 100 AS "beneficiaryId", {money('o_totalprice')} AS "paymentAmount",
               CASE WHEN o_orderkey % 2 = 0 THEN 'CSH' ELSE 'CRD' END AS "paymentType",
               o_orderpriority AS priority
        FROM orders_ms""",
    "fanned": """
        SELECT t.*, rule_id, CASE grouping_keys WHEN 'payeeId' THEN '{payeeId=' || "payeeId" || '}' WHEN '' THEN '{}'
                    ELSE '{payeeId=' || "payeeId" || ';beneficiaryId=' || "beneficiaryId" || '}' END AS key,
               CAST(window_minutes AS BIGINT) * 60000 AS w_ms, aggregator, limit_operator, limit_value
        FROM txns t, active WHERE window_minutes >= 0 AND limit_operator IS NOT NULL""",
    "active": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY seq DESC) AS rn FROM rules
            WHERE rule_state <> 'CONTROL' AND seq > coalesce(
                (SELECT max(seq) FROM rules WHERE control_type = 'DELETE_RULES_ALL'), -1))
        WHERE rn = 1 AND rule_state = 'ACTIVE'""",
    "rule_lines": """
        SELECT p_partkey AS seq, p_partkey % 19 + 1 AS rule_id, p_size, p_size % 8 AS variant,
               CASE WHEN p_size % 8 = 0 AND p_partkey % 3 = 0 OR p_partkey % 1499 = 700 THEN 'control'
                    WHEN p_size % 8 IN (0, 1, 3, 4) THEN 'bad' WHEN p_size % 8 = 2 THEN 'json'
                    ELSE 'plain' END AS kind
        FROM part""",
    "rules": """
        SELECT seq, CAST(CASE WHEN kind <> 'control' THEN rule_id END AS INTEGER) AS rule_id,
               CASE WHEN kind = 'control' THEN 'CONTROL' WHEN variant = 5 THEN 'PAUSE'
                    WHEN variant = 7 AND seq % 2 = 0 THEN 'DELETE' ELSE 'ACTIVE' END AS rule_state,
               CASE kind WHEN 'json' THEN 'payeeId' WHEN 'plain' THEN
                    CASE WHEN seq % 4 = 1 THEN '' ELSE 'payeeId&beneficiaryId' END END AS grouping_keys,
               CASE WHEN kind <> 'control' THEN 'paymentAmount' END AS aggregate_field,
               CASE WHEN kind = 'control' THEN NULL WHEN kind = 'json' THEN 'MAX' WHEN variant = 5 THEN 'AVG'
                    WHEN variant = 6 THEN 'MIN' WHEN seq % 2 = 1 AND seq % 3 = 0 THEN 'AVG' ELSE 'SUM' END AS aggregator,
               CASE WHEN kind = 'control' THEN NULL WHEN kind = 'json' THEN 'GREATER_EQUAL'
                    WHEN variant = 5 THEN 'LESS' WHEN variant = 6 THEN NULL
                    WHEN seq % 2 = 0 THEN 'GREATER' ELSE 'GREATER_EQUAL' END AS limit_operator,
               CASE WHEN kind <> 'control' THEN CAST(p_size * 9000 AS DECIMAL(28,4)) END AS limit_value,
               CAST(CASE WHEN kind <> 'control' AND NOT (kind = 'json' AND seq % 5 = 0)
                         THEN (p_size % 9 - 1) * 720 END AS INTEGER) AS window_minutes,
               CASE WHEN kind = 'control' THEN CASE WHEN seq % 1499 = 700 THEN 'DELETE_RULES_ALL'
                    ELSE 'EXPORT_RULES_CURRENT' END END AS control_type
        FROM rule_lines WHERE kind <> 'bad'""",
}

_NAMES = re.compile(r"\b(" + "|".join(CTES) + r")\b")


def query(select: str) -> str:
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name in _NAMES.findall(text):
            if name not in needed and name not in open_:
                open_.add(name)
                visit(CTES[name])
                needed[name] = None

    open_: set[str] = set()
    visit(select)
    if not needed:
        return select
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {ctes}\n{select}"


def data_json(entries: str) -> str:
    """A list of map entries as JSON text, keys in order."""
    return (f"('{{' || coalesce(array_to_string(list_transform(list_sort({entries}), "
            "lambda e: '\"' || e.key || '\":\"' || e.value || '\"'), ','), '') || '}')")


PAGE = ("seq, ts, mid, vc, ch, ar, is_new, page_id, last_page_id, during_time, item, item_type")
WIDE = ("stt, edt, sku_id, sku_name, sku_price, spu_id, spu_name, tm_id, tm_name, category3_id, "
        "category3_name, display_ct, click_ct, favor_ct, cart_ct, order_sku_num, order_amount, "
        "order_ct, payment_amount, paid_order_ct, refund_order_ct, refund_amount, comment_ct, "
        "good_comment_ct")


def _product_kind(kinds: str, **columns: str) -> str:
    picked = ", ".join(f"{source} AS {name}" for name, source in columns.items())
    return query(f"SELECT sku_id, ts, {picked} FROM product_events WHERE kind IN ({kinds})")


VISITOR_SUMS = ("CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct, "
                "CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct, "
                "CAST(sum(dur_sum) AS BIGINT) AS dur_sum")

ALERTS = """
    SELECT rule_id, key, "transactionId", "eventTime", value FROM (
        SELECT rule_id, key, "transactionId", "eventTime", limit_operator, limit_value, CAST(CASE aggregator
                 WHEN 'SUM' THEN sum("paymentAmount") OVER w
                 WHEN 'MAX' THEN max("paymentAmount") OVER w
                 WHEN 'AVG' THEN CAST((2 * CAST(sum("paymentAmount") OVER w * 100 AS HUGEINT) * 100 + count(*) OVER w)
                                  // (2 * count(*) OVER w) AS DECIMAL(38,0)) / 10000
                 WHEN 'MIN' THEN min("paymentAmount") OVER w END AS DECIMAL(28,4)) AS value
        FROM fanned
        WINDOW w AS (PARTITION BY rule_id, key ORDER BY "eventTime" RANGE BETWEEN w_ms PRECEDING AND CURRENT ROW))
    WHERE CASE limit_operator WHEN 'GREATER' THEN value > limit_value
                              WHEN 'GREATER_EQUAL' THEN value >= limit_value END"""


def statements() -> dict[str, str]:
    q = query
    kept, whole = data_json("kept"), data_json("map_entries(data)")
    return {
        # ---- logs
        "dirty_records": q("""
            SELECT seq, 'malformed' AS problem,
                   '{"common":{"mid":"' || mid || '"},"ts":' || ts AS raw
            FROM log WHERE page_id = 'home' AND CAST(right(mid, 1) AS INTEGER) % 2 = 1
            UNION ALL
            SELECT seq, 'missing_key' AS problem,
                   '{"common":{"vc":"' || vc || '","ch":"' || ch || '","ar":"' || ar || '","is_new":"' || raw_new
                   || '"},"page":{"page_id":"login"'
                   || CASE WHEN last_page_id IS NULL THEN '' ELSE ',"last_page_id":"' || last_page_id || '"' END
                   || ',"during_time":' || during_time || '},"displays":['
                   || coalesce(array_to_string(list_transform(range(seq % 4), lambda i:
                        '{"item":"' || ((seq * 7 + i) % skus) || '","item_type":"'
                        || CASE WHEN (seq + i) % 3 = 0 THEN 'promotion' ELSE 'sku_id' END || '"}'), ','), '')
                   || ']' || CASE WHEN is_start THEN ',"start":"{\\"entry\\":\\"icon\\"}"' ELSE '' END
                   || ',"ts":' || ts || '}' AS raw
            FROM log WHERE page_id = 'login' AND CAST(right(mid, 1) AS INTEGER) % 2 = 1"""),
        "log_parse": q(f"""
            SELECT seq, ts, mid, vc, ch, ar, raw_new AS is_new, page_id, last_page_id, during_time, item,
                   item_type, seq % 4 AS displays
            FROM log"""),
        "log_parse_strict": q("""
            SELECT seq, ts, mid, vc, ch, ar, raw_new AS is_new, page_id, last_page_id, during_time, item,
                   item_type, seq % 4 AS displays FROM log"""),
        "log_new_user_repair": q(f"SELECT {PAGE} FROM repaired"),
        "log_split_page": q(f"SELECT {PAGE} FROM pages"),
        "log_split_start": q(f"SELECT {PAGE}, '{{\"entry\":\"icon\"}}' AS start FROM repaired WHERE is_start"),
        "log_split_display": q("SELECT item, item_type, page_id FROM displays"),
        "entry_pages": q(f"SELECT {PAGE} FROM entries"),
        "daily_unique_visit": q(f"SELECT {PAGE} FROM uniques"),
        "user_bounce": q(f"SELECT {PAGE} FROM bounced"),
        "visitor_events": q("SELECT * FROM visitor_events"),
        "visitor_stats": q(f"""
            SELECT {window('ts')}, vc, ch, ar, is_new, {VISITOR_SUMS} FROM visitor_events GROUP BY ALL"""),
        "visitor_running_totals": q(f"""
            SELECT vc, ch, ar, is_new, {VISITOR_SUMS} FROM visitor_events GROUP BY ALL"""),
        "late_audit": q("""
            SELECT seq, mid, ts, arrival, seen_ts FROM (
                SELECT *, max(ts) OVER (PARTITION BY mid ORDER BY arrival
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_ts
                FROM (SELECT seq, mid, ts, (seq + seq * 7 % 20) * 1000 + seq % 1000 AS arrival FROM log))
            WHERE ts < seen_ts - 1200000"""),
        "keyword_filter": q(f"SELECT full_word, {clock('ts')} AS rowtime FROM searches"),
        "keyword_tokens": q(f"SELECT keyword, {clock('ts')} AS rowtime FROM tokens"),
        "keyword_stats": q(f"""
            SELECT keyword, count(*) AS ct, 'SEARCH' AS source, {window('ts')} FROM tokens GROUP BY ALL"""),
        "rowtime_from_ms": q(f"SELECT seq, ts, {clock('ts')} AS rowtime, {day('ts')} AS day FROM log"),
        # ---- changes
        "cdc_nonempty": q(f"""
            SELECT 'shop' AS database, tab AS "table", raw_type AS type, {whole} AS data, seq FROM changes"""),
        "cdc_bootstrap_normalize": q(f"""
            SELECT 'shop' AS database, tab AS "table", type, {whole} AS data, seq FROM normal"""),
        "cdc_route_fact": q(f"""
            SELECT 'shop' AS database, tab AS "table", type, {kept} AS data, seq, sink_table, id AS pk
            FROM routed WHERE sink_type = 'kafka' AND id IS NOT NULL"""),
        "cdc_route_dim": q(f"""
            SELECT 'shop' AS database, tab AS "table", type, {kept} AS data, seq, sink_table, id AS pk
            FROM routed WHERE sink_type = 'hbase' AND id IS NOT NULL"""),
        "cdc_dirty": q("""
            SELECT seq, 'missing_key' AS problem FROM routed WHERE sink_type IN ('kafka', 'hbase') AND id IS NULL
            UNION ALL SELECT s_suppkey, CASE s_suppkey % 3 WHEN 1 THEN 'no_object' ELSE 'malformed' END
            FROM supplier WHERE s_suppkey % 3 <> 0"""),
        "cdc_unrouted": q(f"""
            SELECT 'shop' AS database, tab AS "table", type, {whole} AS data, seq,
                   CASE WHEN sink_type IS NULL THEN 'no_route' ELSE 'unknown_sink' END AS reason
            FROM routed WHERE sink_type IS NULL OR sink_type NOT IN ('kafka', 'hbase')"""),
        "cdc_column_prune": q(f"""
            SELECT tab AS "table", type, seq, len(kept) AS kept, len(map_entries(data)) - len(kept) AS pruned
            FROM routed WHERE sink_type IN ('kafka', 'hbase') AND id IS NOT NULL"""),
        "cdc_fact_payload": q(f"""
            SELECT sink_table AS topic, {kept} AS value FROM routed WHERE sink_type = 'kafka' AND id IS NOT NULL"""),
        "dim_upsert": q(f"""
            SELECT sink_table, id AS pk, {data_json("list({'key': column_name, 'value': value})")} AS data, max(seq) AS seq
            FROM (
                SELECT sink_table, id, seq, cell.key AS column_name, cell.value AS value,
                       row_number() OVER (PARTITION BY sink_table, id, cell.key ORDER BY seq DESC) AS rn
                FROM (SELECT r.*, unnest(kept) AS cell FROM routed r WHERE sink_type = 'hbase' AND id IS NOT NULL AND type <> 'delete'
                      AND NOT EXISTS (SELECT 1 FROM routed d WHERE d.sink_type = 'hbase' AND d.type = 'delete'
                          AND d.sink_table = r.sink_table AND d.id = r.id AND d.seq >= r.seq)))
            WHERE rn = 1 GROUP BY sink_table, id"""),
        "dim_schema_from_config": q("""
            SELECT sink_table, 'create table if not exists dims.' || sink_table || '('
                   || array_to_string(list_transform(string_split(sink_columns, ','), lambda c: c || ' varchar'
                      || CASE WHEN c = coalesce(sink_pk, 'id') THEN ' primary key' ELSE '' END), ',')
                   || ')' || coalesce(sink_extend, '') AS statement
            FROM (SELECT *, row_number() OVER (PARTITION BY sink_table ORDER BY source_table, operate_type) AS n
                  FROM route_config WHERE sink_type = 'hbase') WHERE n = 1"""),
        "config_latest": q("SELECT * FROM route_config"),
        "config_rename": q("""
            SELECT source_table AS "sourceTable", operate_type AS "operateType", sink_type AS "sinkType",
                   sink_table AS "sinkTable", sink_columns AS "sinkColumns", sink_pk AS "sinkPk",
                   sink_extend AS "sinkExtend" FROM route_config"""),
        "changelog_envelope": q("""
            SELECT 'shop' AS database, 'user_info' AS "table",
                   CASE c_nationkey % 4 WHEN 0 THEN 'read' WHEN 1 THEN 'create' WHEN 2 THEN 'update' ELSE 'delete' END AS type,
                   CASE WHEN c_nationkey % 4 = 3 THEN '{}' ELSE '{"id":"' || c_custkey || '","name":"' || c_name
                        || '","segment":"' || c_mktsegment || '"}' END AS data,
                   CASE WHEN c_nationkey % 4 <> 3 THEN '{}' ELSE '{"id":"' || c_custkey || '","name":"' || c_name
                        || '","segment":"' || c_mktsegment || '"}' END AS before,
                   c_custkey AS seq FROM customer"""),
        "changelog_latest": q(f"""
            SELECT tab AS "table", id AS pk, type, {whole} AS data, seq FROM (
                SELECT *, row_number() OVER (PARTITION BY tab, id ORDER BY seq DESC) AS rn
                FROM normal WHERE map_contains(data, 'id')) WHERE rn = 1 AND type <> 'delete'"""),
        "changelog_bootstrap": q("""
            SELECT CAST(c_custkey AS VARCHAR) AS pk, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'again ' ELSE '' END || c_name AS name,
                   CASE WHEN c_mktsegment = 'BUILDING' THEN 'X' WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender
            FROM customer WHERE c_mktsegment <> 'MACHINERY' OR c_acctbal < 0"""),
        "route_as_of": q("""
            SELECT id, c.tab AS "table", c.type, place, sink_type, sink_table, sink_columns, r.seq AS route_seq
            FROM (SELECT l_orderkey * 100 + l_linenumber AS id, 't' || (l_orderkey % 97) AS tab, l_partkey AS place,
                         CASE l_suppkey % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS type FROM lineitem) c
            ASOF JOIN route_images r ON c.tab = r.source_table AND c.type = r.operate_type AND c.place >= r.seq
            WHERE NOT deleted"""),
        "blank_entry_filter": q(f"""
            SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   '{{' || CASE WHEN l_returnflag <> 'N' THEN '"flag":"' || l_returnflag || '",' ELSE '' END
                   || '"status":"' || l_linestatus || '"}}' AS data FROM lineitem"""),
        # ---- wide rows
        "order_time_parts": q("""
            SELECT id, create_time, substr(create_time, 1, 10) AS create_date,
                   substr(create_time, 12) AS create_hour, ms AS create_ts FROM order_info"""),
        "order_detail_interval_join": q("""
            SELECT order_id, detail_id, sku_id, split_total_amount, order_ms, detail_ms FROM order_pairs"""),
        "payment_interval_join": q("""
            SELECT payment_id, order_id, detail_id, sku_id, payment_create_time, order_create_time FROM payment_wide"""),
        "order_wide": q("SELECT * FROM order_wide"),
        "payment_wide": q("SELECT * FROM payment_wide"),
        "dim_user": q(f"""
            SELECT o.id, user_id,
                   CAST(({AS_OF_MS} - epoch_ms(CAST(birthday AS TIMESTAMP))) // 31536000000 AS INTEGER) AS user_age,
                   gender AS user_gender FROM order_info o LEFT JOIN user_dim u ON u.id = o.user_id"""),
        "dim_province": q("""
            SELECT o.id, province_id, name AS province_name, area_code AS province_area_code,
                   iso_code AS province_iso_code, iso_3166_2 AS province_3166_2_code
            FROM order_info o LEFT JOIN province_dim v ON v.id = o.province_id"""),
        "dim_product": q("""
            SELECT d.id, d.sku_id, p.sku_name, p.price AS sku_price, spu_id, tm_id, category3_id, spu_name,
                   tm_name, category3_name FROM order_detail d LEFT JOIN product_dim p ON p.id = d.sku_id"""),
        "dim_lookup_multi": q(f"""
            SELECT l_orderkey AS order_id, l_partkey AS sku_id, {money('l_extendedprice')} AS refund_amount,
                   line_status, first_price
            FROM lineitem LEFT JOIN (
                SELECT l_orderkey AS k1, l_partkey AS k2, min(l_linestatus) AS line_status,
                       min({money('l_extendedprice')}) AS first_price
                FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2) ON k1 = l_orderkey AND k2 = l_partkey
            WHERE l_returnflag = 'R'"""),
        "wide_coalesce_merge": q("""
            SELECT a.order_id, a.detail_id, order_status, a.create_time, create_date, coupon_reduce_amount,
                   activity_reduce_amount, original_total_amount, feight_fee, total_amount, user_id,
                   b.sku_id, b.sku_name, b.order_price, b.sku_num,
                   CAST(NULL AS DECIMAL(18,2)) AS split_activity_amount,
                   CAST(NULL AS DECIMAL(18,2)) AS split_coupon_amount,
                   CAST(NULL AS DECIMAL(18,2)) AS split_total_amount
            FROM (SELECT d.id AS detail_id, d.order_id, o.order_status, o.create_time,
                         substr(o.create_time, 1, 10) AS create_date, o.coupon_reduce_amount,
                         o.activity_reduce_amount, o.original_total_amount, o.feight_fee, o.total_amount, o.user_id
                  FROM order_detail d JOIN order_info o ON o.id = d.order_id) a
            FULL JOIN order_detail b ON a.order_id = b.order_id AND a.detail_id = b.id"""),
        # ---- products, provinces
        "product_click": _product_kind("'click'", click_ct="n"),
        "product_display": _product_kind("'display'", display_ct="n"),
        "product_favor_cart": q("""
            SELECT sku_id, ts, CAST(kind = 'favor' AS INTEGER) AS favor_ct, CAST(kind = 'cart' AS INTEGER) AS cart_ct
            FROM product_events WHERE kind IN ('favor', 'cart')"""),
        "product_order": _product_kind("'order'", order_id="order_id", order_sku_num="n",
                                       order_amount="amount", order_split_amount="split"),
        "product_payment": _product_kind("'paid'", order_id="order_id", payment_amount="amount"),
        "product_refund": _product_kind("'refund'", order_id="order_id", refund_amount="amount"),
        "product_comment": q("""
            SELECT sku_id, ts, 1 AS comment_ct, CAST(kind = 'good' AS INTEGER) AS good_comment_ct
            FROM product_events WHERE kind IN ('comment', 'good')"""),
        "product_events": q("""
            SELECT sku_id, ts, CAST(kind = 'display' AS INTEGER) AS display_ct, CAST(kind = 'click' AS INTEGER) AS click_ct,
                   CAST(kind = 'favor' AS INTEGER) AS favor_ct, CAST(kind = 'cart' AS INTEGER) AS cart_ct,
                   CASE WHEN kind = 'order' THEN n ELSE 0 END AS order_sku_num,
                   CAST(kind IN ('comment', 'good') AS INTEGER) AS comment_ct, CAST(kind = 'good' AS INTEGER) AS good_comment_ct,
                   CAST(CASE WHEN kind = 'order' THEN amount ELSE 0 END AS DECIMAL(18,2)) AS order_amount,
                   CAST(CASE WHEN kind = 'order' THEN split ELSE 0 END AS DECIMAL(18,2)) AS order_split_amount,
                   CAST(CASE WHEN kind = 'paid' THEN amount ELSE 0 END AS DECIMAL(18,2)) AS payment_amount,
                   CAST(CASE WHEN kind = 'refund' THEN amount ELSE 0 END AS DECIMAL(18,2)) AS refund_amount,
                   CASE WHEN kind IN ('order', 'paid', 'refund') THEN kind END AS order_kind, order_id
            FROM product_events"""),
        "product_stats": q("SELECT * FROM product_stats"),
        "product_stats_enriched": q("SELECT * FROM product_stats_enriched"),
        "sink_projection": q(f"SELECT {WIDE}, {AS_OF_MS} AS ts FROM product_stats_enriched"),
        "province_stats": q(f"""
            SELECT {window(ms_of('create_time'))}, province_id, province_name, province_area_code,
                   province_iso_code, province_3166_2_code,
                   CAST(sum(split_total_amount) AS DECIMAL(28,2)) AS order_amount, count(*) AS order_count,
                   count(DISTINCT order_id) AS distinct_order_count
            FROM order_wide GROUP BY ALL"""),
        "ts_parse_plus8": q(f"SELECT id, create_time, {ms_of('create_time', 8)} AS ts FROM order_info"),
        "code_labels": q("""
            SELECT id, order_status, CASE order_status WHEN '1001' THEN 'unpaid' WHEN '1002' THEN 'paid' ELSE 'finished' END AS label
            FROM order_info"""),
        # ---- rules
        "rule_ingest": q("SELECT * FROM rules"),
        "rule_dropped": q("SELECT seq FROM rule_lines WHERE kind = 'bad'"),
        "rule_active_set": q("SELECT * FROM active"),
        "rule_unusable": q("""
            SELECT seq, rule_id, CASE WHEN window_minutes IS NULL THEN 'no_window'
                   WHEN window_minutes < 0 THEN 'negative_window' ELSE 'no_operator' END AS reason
            FROM active WHERE NOT coalesce(window_minutes >= 0 AND limit_operator IS NOT NULL, false)"""),
        "rules_in_force": q("""
            SELECT count(*) FILTER (usable) AS applied, count(*) FILTER (NOT usable) AS unusable
            FROM (SELECT coalesce(window_minutes >= 0 AND limit_operator IS NOT NULL, false) AS usable FROM active)"""),
        "txn_ingest": q(f"""
            SELECT "transactionId", "eventTime", "payeeId", "beneficiaryId", "paymentAmount", "paymentType",
                   CASE WHEN priority = '5-LOW' THEN 1 ELSE {AS_OF_MS} END AS "ingestionTimestamp"
            FROM txns WHERE priority <> '4-NOT SPECIFIED'
              AND NOT (priority = '3-MEDIUM' AND "transactionId" % 2 = 1)"""),
        "rule_fanout": q("""
            SELECT "transactionId", "eventTime", "payeeId", "beneficiaryId", "paymentAmount", "paymentType", rule_id, key
            FROM fanned"""),
        "rule_as_of": q("""
            SELECT "transactionId", "payeeId" AS place, rule_id,
                   CASE grouping_keys WHEN 'payeeId' THEN '{payeeId=' || "payeeId" || '}' WHEN '' THEN '{}'
                        ELSE '{payeeId=' || "payeeId" || ';beneficiaryId=' || "beneficiaryId" || '}' END AS key,
                   CAST("paymentAmount" AS DECIMAL(28,4)) AS amount, aggregator, limit_value
            FROM txns JOIN (
                SELECT *, coalesce(lead(seq) OVER (PARTITION BY rule_id ORDER BY seq), 9000000000000000000) AS next_line,
                       coalesce((SELECT min(w.seq) FROM rules w WHERE w.control_type = 'DELETE_RULES_ALL'
                                 AND w.seq > r.seq), 9000000000000000000) AS next_wipe
                FROM rules r WHERE rule_state <> 'CONTROL') v
            ON "payeeId" >= seq AND "payeeId" < least(next_line, next_wipe)
            WHERE rule_state = 'ACTIVE' AND window_minutes >= 0 AND limit_operator IS NOT NULL"""),
        "rule_alerts": q(ALERTS),
    }


def stream_statements() -> dict[str, str]:
    """SQL for the streaming forms: as the batch form."""
    q, batch = query, statements()
    return {
        "stream_log_split_display": batch["log_split_display"],
        "stream_log_dirty": batch["dirty_records"],
        "stream_log_split_page": batch["log_split_page"],
        "stream_log_split_start": batch["log_split_start"],
        "stream_log_new_user_repair": batch["log_new_user_repair"],
        "stream_daily_unique_visit": batch["daily_unique_visit"],
        "stream_user_bounce": batch["user_bounce"],
        "stream_visitor_stats": batch["visitor_stats"],
        "stream_visitor_running_totals": batch["visitor_running_totals"],
        "stream_keyword_stats": batch["keyword_stats"],
        "stream_fact_topics": batch["cdc_fact_payload"],
        "stream_log_table": q(f"SELECT mid, ts, {clock('ts')} AS rowtime FROM log"),
        "stream_cdc_dirty": batch["cdc_dirty"],
        "stream_cdc_accounted": q("""
            SELECT went, count(*) AS changes FROM (
                SELECT CASE WHEN sink_type IS NULL THEN 'no_route' WHEN sink_type NOT IN ('kafka', 'hbase') THEN 'unknown_sink'
                            WHEN id IS NULL THEN 'missing_key' WHEN sink_type = 'kafka' THEN 'fact' ELSE 'dimension' END AS went
                FROM routed
                UNION ALL SELECT CASE s_suppkey % 3 WHEN 1 THEN 'no_object' ELSE 'malformed' END FROM supplier WHERE s_suppkey % 3 <> 0
                UNION ALL SELECT 'empty' FROM supplier WHERE s_acctbal < 0 OR s_acctbal >= 2000 AND s_nationkey <= 3) GROUP BY went"""),
        "stream_cdc_route_fact": batch["cdc_route_fact"],
        "stream_cdc_route_dim": batch["cdc_route_dim"],
        "stream_changelog_latest": batch["changelog_latest"],
        "stream_changelog_bootstrap": batch["changelog_bootstrap"],
        "stream_dim_upsert": batch["dim_upsert"],
        "stream_cdc_fact_payload": batch["cdc_fact_payload"],
        "stream_order_detail_interval_join": q("""
            SELECT order_id, detail_id, sku_id, split_total_amount, create_time FROM order_pairs"""),
        "stream_payment_interval_join": batch["payment_interval_join"],
        "stream_order_wide": batch["order_wide"],
        "stream_payment_wide": batch["payment_wide"],
        "stream_province_stats": batch["province_stats"],
        "stream_product_stats": batch["product_stats"],
        "stream_product_stats_enriched": batch["product_stats_enriched"],
        "stream_rule_fanout": batch["rule_fanout"],
        "stream_rule_alerts": batch["rule_alerts"],
    }
