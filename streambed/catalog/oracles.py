"""DuckDB SQL for the registered queries, over the shared tables."""

from __future__ import annotations

# The accented letters of the source system, and what each becomes.
ACCENTED = (
    "ÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚÝàáâãèéêìíòóôõùúýĂăĐđĨĩŨũƠơƯưẠạẢảẤấẦầẨẩẪẫẬậẮắẰằẲẳẴẵẶặẸẹẺẻẼẽẾếỀềỂểỄễỆệỈỉỊịỌọỎỏỐốỒồỔổỖỗỘộỚớỜờỞởỠỡỢợỤụỦủỨứỪừỬửỮữỰựỲỳỴỵỶỷỸỹ"
)
PLAIN = (
    "AAAAEEEIIOOOOUUYaaaaeeeiioooouuyAaDdIiUuOoUuAaAaAaAaAaAaAaAaAaAaAaAaEeEeEeEeEeEeEeEeIiIiOoOoOoOoOoOoOoOoOoOoOoOoUuUuUuUuUuUuUuYyYyYyYy"
)

MS = "(epoch_us({0}) // 1000)"
AS_OF = "'2024-02-01 00:00:00'"

# Domain views, as common table expressions by name. Each may use the ones before it.
CTES = {
    "customer_users": """
        SELECT c_custkey AS id, c_name AS name,
               lower(replace(c_name, '#', '_')) || '@example.com' AS email,
               CAST(1704067200000 AS BIGINT) AS updated_at
        FROM customer""",
    "supplier_users": """
        SELECT s_suppkey + 1000000000000 AS id, s_name AS name,
               lower(replace(s_name, '#', '_')) || '@example.com' AS email,
               CAST(1704067200000 AS BIGINT) AS updated_at
        FROM supplier""",
    "users": "SELECT * FROM customer_users UNION ALL SELECT * FROM supplier_users",
    "devices": f"""
        SELECT o_orderkey AS id, 'Device ' || o_orderkey AS name, o_orderpriority AS device_type,
               CASE o_orderstatus WHEN 'O' THEN 'online' WHEN 'F' THEN 'offline' END AS status,
               CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey + 2000000000000
                    WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS owner_id,
               {MS.format('o_orderdate')} AS updated_at
        FROM orders""",
    "bills": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS user_id, l_orderkey AS device_id,
               CAST(l_extendedprice AS DECIMAL(15,2)) AS amount,
               CASE l_returnflag WHEN 'A' THEN 'monthly' WHEN 'N' THEN 'quarterly' ELSE 'yearly' END AS plan_type,
               CASE WHEN l_linestatus = 'F' THEN 'paid' ELSE 'pending' END AS status,
               {MS.format('l_shipdate')} AS updated_at
        FROM lineitem""",
    "invoices": f"""
        SELECT o_orderkey AS id, o_custkey AS user_id, o_orderkey AS device_id,
               CAST(o_totalprice AS DECIMAL(15,2)) AS amount,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'monthly'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'quarterly' ELSE 'yearly' END AS plan_type,
               CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'pending' END AS status,
               {MS.format('o_orderdate')} AS updated_at
        FROM orders""",
    "dated_invoices": """
        SELECT *, CAST(make_timestamp(updated_at * 1000) AS DATE) AS first_day,
               CASE plan_type WHEN 'monthly' THEN 30 WHEN 'quarterly' THEN 90 ELSE 365 END AS days FROM invoices""",
    "payments0": """
        SELECT CASE WHEN status = 'pending' AND plan_type = 'quarterly' THEN id + 3000000000000 ELSE id END AS bill_id,
               user_id,
               ['ViettelMoney', 'VNPay', 'Momo', 'MBBank', 'Vietcombank', 'Techcombank'][1 + user_id % 6] AS payment_gateway,
               CASE WHEN status = 'pending' AND plan_type = 'yearly' THEN CAST(amount + 1 AS DECIMAL(15,2)) ELSE amount END AS trans_amount,
               make_timestamp(updated_at * 1000) AS trans_time,
               CASE WHEN user_id % 7 = 0 THEN NULL WHEN status = 'paid' AND plan_type = 'quarterly' THEN 'REFUNDED'
                    WHEN status = 'paid' THEN 'SUCCESS' ELSE 'PENDING' END AS trans_status,
               ['MBBank', 'Vietcombank', 'Techcombank', 'BIDV', 'VietinBank', 'VPBank'][1 + id % 6] AS bank_code
        FROM (SELECT * FROM invoices UNION ALL
              SELECT * FROM invoices WHERE status = 'paid' AND plan_type = 'yearly' AND user_id % 5 = 0)""",
    "payments": """
        SELECT upper(substr(payment_gateway, 1, 3)) || '_' || strftime(trans_time, '%Y%m%d') || '_'
                   || printf('%06d', bill_id) AS partner_trans_id,
               *, round(trans_amount * CAST(0.011 AS DECIMAL(4,3)), 2) AS partner_fee
        FROM payments0""",
    "event_log": f"""
        SELECT user_id AS id, event_id AS seq, {MS.format('ts')} AS ts_ms, ts,
               CASE WHEN event_type = 'error' AND value > 200 THEN 'd' WHEN event_type = 'signup' THEN 'c'
                    WHEN event_type = 'purchase' THEN 'r' ELSE 'u' END AS op,
               user_id, event_id AS device_id, CAST(value AS DECIMAL(15,2)) AS amount,
               CASE event_type WHEN 'signup' THEN 'yearly' WHEN 'view' THEN 'quarterly' ELSE 'monthly' END AS plan_type,
               CASE WHEN event_type = 'purchase' THEN 'paid' ELSE 'pending' END AS status,
               {MS.format('ts')} AS updated_at
        FROM events""",
    "order_log": f"""
        SELECT o_orderkey AS id, CAST(0 AS BIGINT) AS seq, {MS.format('o_orderdate')} AS ts_ms,
               CASE WHEN o_orderstatus = 'F' THEN 'r' ELSE 'c' END AS op,
               o_custkey AS user_id, o_orderkey AS device_id, CAST(o_totalprice AS DECIMAL(15,2)) AS amount,
               'monthly' AS plan_type, 'pending' AS status, {MS.format('o_orderdate')} AS updated_at
        FROM orders""",
    "line_log": f"""
        SELECT l_orderkey AS id, CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey AS seq,
               {MS.format('l_shipdate')} AS ts_ms,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'd'
                    WHEN l_returnflag = 'N' AND l_linenumber = 7 THEN 't' ELSE 'u' END AS op,
               l_partkey AS user_id, l_suppkey AS device_id, CAST(l_extendedprice AS DECIMAL(15,2)) AS amount,
               CASE l_returnflag WHEN 'A' THEN 'monthly' WHEN 'N' THEN 'quarterly' ELSE 'yearly' END AS plan_type,
               CASE WHEN l_linestatus = 'F' THEN 'paid' ELSE 'pending' END AS status,
               {MS.format('l_shipdate')} AS updated_at
        FROM lineitem""",
    "bill_log": "SELECT * FROM order_log UNION ALL SELECT * FROM line_log",
    "device_logs": f"""
        SELECT printf('evt-%012x', event_id) AS event_id, {MS.format('ts')} AS ms, ts, user_id AS device_id,
               CASE event_type WHEN 'error' THEN 'connection_lost' WHEN 'signup' THEN 'sd_card_error'
                    WHEN 'view' THEN 'motion_detected' WHEN 'click' THEN 'human_detected' ELSE 'heartbeat' END AS event_type,
               CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END AS severity,
               ['v1.4.2', 'v2.0.1', 'v2.1.0', 'v2.2.0-beta'][1 + event_id % 4] AS firmware_version,
               '192.168.1.' || (user_id % 254 + 1) AS ip_address,
               25 AS fps, 2048 AS bitrate_kbps,
               CASE WHEN event_type IN ('view', 'click') THEN CAST(10 + event_id % 51 AS INTEGER) ELSE 0 END AS duration_sec,
               CASE event_type
                    WHEN 'error' THEN ['ERR_SOCKET_TIMEOUT', 'ERR_DHCP_FAILED', 'ERR_SIGNAL_WEAK'][1 + event_id % 3]
                    WHEN 'signup' THEN ['ERR_SD_CARD_FULL', 'ERR_WRITE_FAILED'][1 + event_id % 2] END AS error_code
        FROM events""",
    "device_counts": """
        SELECT owner_id, count(id) AS total_devices,
               count(CASE WHEN status = 'online' THEN 1 END) AS online_devices,
               count(CASE WHEN status <> 'online' THEN 1 END) AS offline_devices
        FROM devices GROUP BY owner_id""",
    "bill_totals": """
        SELECT user_id, count(id) AS total_bills,
               coalesce(sum(CASE WHEN status = 'paid' THEN amount ELSE 0 END), 0) AS total_spent
        FROM bills GROUP BY user_id""",
    "reconciled": """
        SELECT coalesce(b.id, p.bill_id) AS bill_id, coalesce(b.user_id, p.user_id) AS user_id,
               coalesce(p.payment_gateway, 'none') AS payment_gateway, coalesce(b.status, 'none') AS bill_status,
               coalesce(p.trans_status, 'none') AS trans_status,
               CAST(b.amount AS DOUBLE) AS billed_amount, CAST(p.trans_amount AS DOUBLE) AS paid_amount,
               CAST(p.partner_fee AS DOUBLE) AS partner_fee,
               CASE WHEN b.id IS NULL THEN 'orphan_payment' WHEN p.bill_id IS NULL THEN 'missing_payment'
                    WHEN b.amount IS DISTINCT FROM p.trans_amount THEN 'amount_mismatch'
                    WHEN CASE WHEN b.status = 'paid' THEN 'SUCCESS' ELSE 'PENDING' END IS DISTINCT FROM p.trans_status THEN 'status_mismatch'
                    ELSE 'matched' END AS outcome
        FROM invoices b FULL OUTER JOIN payments p ON b.id = p.bill_id""",
    "merged": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, seq DESC) AS rn
                       FROM bill_log WHERE op IN ('c', 'r', 'u', 'd')) WHERE rn = 1 AND op <> 'd'""",
    "kept_updates": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, seq DESC) AS rn
                                    FROM bill_log WHERE op = 'u') WHERE rn = 1""",
    "kept_inserts": """
        SELECT b.* FROM (SELECT * FROM bill_log WHERE op IN ('c', 'r')) b
        LEFT JOIN (SELECT DISTINCT id AS updated_id FROM bill_log WHERE op = 'u') ON b.id = updated_id
        WHERE updated_id IS NULL""",
    "deleted_keys": "SELECT DISTINCT id AS deleted_id FROM bill_log WHERE op = 'd'",
}


def with_views(names: str, body: str) -> str:
    """The body behind the named views; `names` lists them, separated by spaces, in order."""
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names.split()) + "\n" + body


BILL = "id, user_id, device_id, CAST(amount AS DOUBLE) AS amount, plan_type, status, updated_at"
CHANGE = """CAST(id AS VARCHAR) AS id, op, ts_ms, seq,
    CASE WHEN op <> 'd' THEN CAST(amount AS DOUBLE) END AS amount, CASE WHEN op <> 'd' THEN status END AS status"""
LATEST = "row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, seq DESC)"
PARTS = "CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month, CAST(day({0}) AS INTEGER) AS day"
INGEST = with_views(
    "event_log",
    f"""SELECT CAST(id AS VARCHAR) AS id, op, ts_ms, seq,
        CASE WHEN op <> 'd' THEN CAST(amount AS DOUBLE) END AS amount, 'cam_bills' AS source_table,
        seq + 1000 AS transaction, {PARTS.format('ts')} FROM event_log""",
)
USER_360 = f"""
    SELECT u.id AS user_id, u.name AS user_name, u.email,
           CAST(coalesce(total_devices, 0) AS BIGINT) AS total_devices,
           CAST(coalesce(online_devices, 0) AS BIGINT) AS online_devices,
           CAST(coalesce(offline_devices, 0) AS BIGINT) AS offline_devices,
           CAST(coalesce(total_bills, 0) AS BIGINT) AS total_bills,
           CAST(round(coalesce(total_spent, 0), 2) AS DOUBLE) AS total_spent,
           CASE WHEN total_spent >= 1000000 THEN 'DIAMOND' WHEN total_spent >= 500000 THEN 'GOLD'
                WHEN total_spent > 0 THEN 'SILVER' ELSE 'STANDARD' END AS vip_tier,
           'monthly' AS primary_plan, {AS_OF} AS updated_at
    FROM users u LEFT JOIN device_counts d ON u.id = d.owner_id LEFT JOIN bill_totals b ON u.id = b.user_id"""
DEVICE_MART = f"""
    SELECT d.id AS device_id, d.name AS device_name, d.device_type, d.status, coalesce(d.owner_id, 0) AS owner_id,
           coalesce(u.name, 'Unassigned') AS owner_name, coalesce(u.email, 'N/A') AS owner_email,
           CAST(round(coalesce(b.amount, 0), 2) AS DOUBLE) AS bill_amount, coalesce(b.plan_type, 'none') AS plan_type,
           coalesce(b.status, 'unbilled') AS bill_status, {AS_OF} AS updated_at
    FROM devices d LEFT JOIN users u ON d.owner_id = u.id LEFT JOIN {{0}} b ON d.id = b.device_id"""
NEWEST_BILLS = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device_id
    ORDER BY updated_at DESC, id DESC, amount DESC, plan_type DESC, status DESC) AS rn FROM bills) WHERE rn = 1)"""
KPI = f"""
    SELECT '2024-02-01' AS report_date, CAST(n_users AS BIGINT) AS total_registered_users,
           CAST(n_devices AS BIGINT) AS total_active_devices, CAST(n_online AS BIGINT) AS online_devices,
           CAST(round(CAST(n_online * 100 AS DECIMAL(20,0)) / n_devices, 2) AS DOUBLE) AS device_online_ratio_pct,
           CAST(revenue AS DOUBLE) AS total_revenue, CAST(n_paid AS BIGINT) AS total_paid_transactions,
           CAST(round(revenue / n_users, 2) AS DOUBLE) AS avg_revenue_per_user, {AS_OF} AS updated_at
    FROM (SELECT count(*) AS n_users FROM users),
         (SELECT count(*) AS n_devices, count(CASE WHEN status = 'online' THEN 1 END) AS n_online FROM devices),
         (SELECT coalesce(sum(amount), 0) AS revenue, count(id) AS n_paid FROM {{0}} WHERE status = 'paid')"""
COUNTS = """count(id) AS total_devices, count(CASE WHEN status = 'online' THEN 1 END) AS online_devices,
    count(CASE WHEN status <> 'online' THEN 1 END) AS offline_devices"""
USER_360_SQL = with_views("customer_users supplier_users users devices bills device_counts bill_totals", USER_360)
DEVICE_SQL = with_views("customer_users supplier_users users devices bills", DEVICE_MART.format("bills"))

SQL: dict[str, str] = {
    "tombstone_filter": with_views("event_log", "SELECT true AS framed, op = 'd' AS deletes, ts_ms FROM event_log"),
    "wire_frame_decode": with_views("event_log", "SELECT CASE op WHEN 'd' THEN 8 ELSE 7 END AS schema_id, op, seq, ts_ms FROM event_log"),
    "envelope_decode": with_views(
        "event_log",
        """SELECT id, op, 'cam_bills' AS source_table, 'shop' AS source_db, seq, ts_ms,
            CASE WHEN op <> 'd' THEN CAST(amount AS DOUBLE) END AS amount,
            CASE WHEN op <> 'd' THEN plan_type END AS plan_type, op IN ('u', 'd') AS has_before FROM event_log""",
    ),
    "bronze_ingest_batch": INGEST,
    "bronze_ingest_stream": INGEST,
    "stream_progress": with_views(
        "event_log",
        """SELECT 'stream_progress' AS name, CAST(3 AS BIGINT) AS batches,
            CAST(count(*) + count(CASE WHEN op = 'd' THEN 1 END) AS BIGINT) AS input_rows, CAST(2 AS BIGINT) AS runs,
            CAST(1 AS BIGINT) AS failed_runs, CAST(count(*) AS BIGINT) AS bronze_rows FROM event_log""",
    ),
    "bronze_partition_cols": f"SELECT event_id, {PARTS.format('ts')} FROM events",
    "bronze_inspect": with_views(
        "event_log",
        f"""SELECT CAST(id AS VARCHAR) AS id, op, ts_ms, seq, {PARTS.format('ts')},
            (SELECT count(*) FROM event_log) AS total_rows FROM event_log ORDER BY ts_ms, seq LIMIT 5""",
    ),
    "lake_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "empty_fallback": with_views(
        "customer_users supplier_users users",
        f"""SELECT id AS user_id, name AS user_name, email, CAST(0 AS BIGINT) AS total_devices, CAST(0 AS BIGINT) AS online_devices,
            CAST(0 AS BIGINT) AS offline_devices, CAST(0 AS BIGINT) AS total_bills, CAST(0 AS DOUBLE) AS total_spent, 'STANDARD' AS vip_tier,
            'monthly' AS primary_plan, {AS_OF} AS updated_at FROM users""",
    ),
    "split_by_op": with_views(
        "event_log",
        """SELECT CAST(id AS VARCHAR) AS id, op, ts_ms, seq,
            CASE op WHEN 'u' THEN 'update' WHEN 'd' THEN 'delete' ELSE 'insert' END AS part FROM event_log""",
    ),
    "first_sample": with_views(
        "event_log", f"SELECT {BILL} FROM event_log WHERE op <> 'd' ORDER BY ts_ms, seq LIMIT 1"
    ),
    "silver_payload_expand": with_views("event_log", f"SELECT {BILL} FROM event_log WHERE op <> 'd'"),
    "infer_json_schema": with_views("event_log", f"SELECT {BILL} FROM event_log WHERE op <> 'd'"),
    "row_to_json": with_views("customer_users supplier_users users", "SELECT id, name, email FROM users"),
    "snapshot_diff": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, CASE c_mktsegment WHEN 'FURNITURE' THEN 'd' ELSE 'u' END AS op,
               CAST(1704067200000 AS BIGINT) AS ts_ms, c_name AS old_name,
               CASE c_mktsegment WHEN 'MACHINERY' THEN c_name || ' (Pro)' END AS new_name
        FROM customer WHERE c_mktsegment IN ('FURNITURE', 'MACHINERY')
        UNION ALL
        SELECT CAST(s_suppkey + 1000000000000 AS VARCHAR), 'c', CAST(1704067200000 AS BIGINT), NULL, s_name FROM supplier""",
    "latest_update": with_views(
        "order_log line_log bill_log kept_updates", f"SELECT {CHANGE} FROM kept_updates"
    ),
    "latest_per_key": with_views(
        "event_log", f"SELECT {CHANGE} FROM (SELECT *, {LATEST} AS rn FROM event_log) WHERE rn = 1"
    ),
    "latest_per_key_agg": with_views(
        "order_log line_log bill_log", f"SELECT {CHANGE} FROM (SELECT *, {LATEST} AS rn FROM bill_log) WHERE rn = 1"
    ),
    "anti_join_updates": with_views(
        "order_log line_log bill_log kept_inserts", f"SELECT {CHANGE} FROM kept_inserts"
    ),
    "union_changes": with_views(
        "order_log line_log bill_log kept_updates kept_inserts",
        f"SELECT {CHANGE} FROM (SELECT * FROM kept_inserts UNION ALL SELECT * FROM kept_updates)",
    ),
    "crud_reconstruct": with_views(
        "order_log line_log bill_log kept_updates kept_inserts deleted_keys",
        f"""SELECT {BILL} FROM (SELECT * FROM kept_inserts UNION ALL SELECT * FROM kept_updates)
            LEFT JOIN deleted_keys ON id = deleted_id WHERE deleted_id IS NULL""",
    ),
    "silver_merge": with_views("order_log line_log bill_log merged", f"SELECT {BILL} FROM merged"),
    "silver_merge_stream": with_views(
        "event_log", f"SELECT {BILL} FROM (SELECT *, {LATEST} AS rn FROM event_log) WHERE rn = 1 AND op <> 'd'"
    ),
    "merge_on_read": with_views("order_log line_log bill_log merged", f"SELECT {BILL} FROM merged"),
    "evolve_on_write": with_views(
        "order_log line_log bill_log merged",
        """SELECT id, status, CAST(amount AS DOUBLE) AS amount,
            CASE WHEN seq > 0 THEN seq // 1000000000000 END AS line,
            CASE WHEN seq >= 2000000000000 THEN seq % 1000000000000 + 0.5::DOUBLE
                 WHEN seq > 0 THEN CAST(seq % 1000000000000 AS DOUBLE) END AS bought FROM merged""",
    ),
    "keyed_stream": with_views(
        "event_log",
        f"SELECT {CHANGE}, CAST(1 AS BIGINT) AS times FROM (SELECT *, {LATEST} AS rn FROM event_log) WHERE rn = 1",
    ),
    "decode_by_schema": with_views(
        "event_log",
        """SELECT CAST(id AS VARCHAR) AS id, op, seq, CASE WHEN op <> 'd' THEN CAST(amount AS DOUBLE) END AS amount,
            CASE op WHEN 'r' THEN 'monthly' WHEN 'u' THEN plan_type END AS plan_type,
            CASE WHEN op <> 'd' THEN status END AS status FROM event_log WHERE op <> 'c'""",
    ),
    "schema_quarantine": with_views(
        "event_log", "SELECT CAST(22 AS INTEGER) AS schema_id, false AS known, ts_ms FROM event_log WHERE op = 'c'"
    ),
    "snapshot_handover": with_views(
        "invoices line_log",
        f"""SELECT {CHANGE} FROM line_log
            UNION ALL
            SELECT CAST(id AS VARCHAR), 'r', low, 0, CAST(amount AS DOUBLE), status
            FROM (SELECT *, {MS.format("make_timestamp(1992 + id % 4, 1, 1, 0, 0, 0)")} AS low,
                         {MS.format("make_timestamp(1992 + id % 4, 7, 1, 0, 0, 0)")} AS high FROM invoices) s
            WHERE NOT EXISTS (SELECT 1 FROM line_log l WHERE l.id = s.id AND (l.ts_ms > s.low OR (l.ts_ms = s.low AND l.seq > 0))
                              AND (l.ts_ms < s.high OR (l.ts_ms = s.high AND l.seq <= 0)))""",
    ),
    "replica_stream": with_views(
        "event_log", f"SELECT {BILL} FROM (SELECT *, {LATEST} AS rn FROM event_log WHERE op <> 'd') WHERE rn = 1"
    ),
    "replica_upsert": with_views(
        "invoices line_log",
        f"""SELECT {BILL} FROM (SELECT *, {LATEST} AS rn FROM line_log WHERE op = 'u') WHERE rn = 1
            UNION ALL
            SELECT {BILL} FROM invoices WHERE id NOT IN (SELECT id FROM line_log WHERE op = 'u')""",
    ),
    "insert_if_absent": with_views(
        "customer_users",
        f"""SELECT * FROM customer_users
            UNION ALL
            SELECT id, name, email, updated_at FROM (
                SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at, name) AS rn
                FROM (SELECT l_partkey AS id, 'Seen on ' || l_orderkey AS name, 'unknown' AS email,
                             {MS.format('l_shipdate')} AS updated_at FROM lineitem)
                WHERE id NOT IN (SELECT id FROM customer_users)) WHERE rn = 1""",
    ),
    "schema_evolve": with_views(
        "customer_users supplier_users",
        """SELECT id, name, email, CAST(NULL AS VARCHAR) AS nation FROM customer_users
            UNION ALL
            SELECT u.id, u.name, u.email, CAST(s_nationkey AS VARCHAR)
            FROM supplier_users u JOIN supplier s ON u.id = s.s_suppkey + 1000000000000""",
    ),
    "keep_latest": with_views(
        "device_logs",
        """SELECT event_type, device_id, event_id, ms AS timestamp FROM (
            SELECT *, row_number() OVER (PARTITION BY event_type, device_id ORDER BY ms DESC, event_id DESC) AS rn
            FROM device_logs) WHERE rn = 1""",
    ),
    "id_high_water": with_views(
        "customer_users supplier_users users devices bills",
        """SELECT 'users' AS table_name, max(id) AS max_id FROM users
            UNION ALL SELECT 'devices', max(id) FROM devices UNION ALL SELECT 'cam_bills', max(id) FROM bills""",
    ),
    "conditional_update": with_views(
        "customer_users supplier_users users",
        """SELECT id, CASE WHEN name NOT LIKE '%(%' THEN name || ' (VIP)' ELSE name END AS name, email,
            CASE WHEN name NOT LIKE '%(%' THEN 1704067200000 ELSE updated_at END AS updated_at FROM users""",
    ),
    "toggle_device_status": with_views(
        "devices",
        "SELECT id, device_type, CASE WHEN status = 'online' THEN 'offline' ELSE 'online' END AS status FROM devices",
    ),
    "settle_pending_bills": with_views(
        "invoices",
        """SELECT id, user_id, device_id, CAST(amount AS DOUBLE) AS amount, plan_type, 'paid' AS status,
            CASE WHEN status = 'pending' THEN 1704067200000 ELSE updated_at END AS updated_at FROM invoices""",
    ),
    "scalar_subquery": with_views(
        "invoices",
        """SELECT id, user_id, device_id, CAST(amount AS DOUBLE) AS amount, plan_type, 'paid' AS status, updated_at
            FROM invoices WHERE id = (SELECT id FROM invoices WHERE status = 'pending'
                                      ORDER BY md5(id || ':42'), id LIMIT 1)""",
    ),
    "user_360": USER_360_SQL,
    "mart_export": USER_360_SQL,
    "folded_exports": USER_360_SQL,
    "device_performance": DEVICE_SQL,
    "contract_cast": DEVICE_SQL,
    "device_performance_latest": with_views(
        "customer_users supplier_users users devices bills", DEVICE_MART.format(NEWEST_BILLS)
    ),
    "executive_kpi": with_views("customer_users supplier_users users devices bills", KPI.format("bills")),
    "kpi_from_changes": with_views(
        "customer_users supplier_users users devices order_log line_log bill_log merged", KPI.format("merged")
    ),
    "kpi_by_differences": with_views(
        "customer_users supplier_users users devices order_log line_log bill_log merged", KPI.format("merged")
    ),
    "user_360_by_differences": with_views(
        "customer_users supplier_users users devices order_log line_log bill_log merged device_counts",
        USER_360.replace(
            "bill_totals b",
            """(SELECT user_id, count(id) AS total_bills, sum(CASE WHEN status = 'paid' THEN amount ELSE 0 END) AS total_spent
                FROM merged GROUP BY user_id) b""",
        ),
    ),
    "user_main_plan": with_views(
        "bills",
        """SELECT user_id AS bill_user_id, plan_type AS main_plan FROM (
            SELECT user_id, plan_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, plan_type) AS rn
            FROM bills GROUP BY user_id, plan_type) WHERE rn = 1""",
    ),
    "device_status_counts": with_views(
        "devices", f"SELECT device_type, {COUNTS} FROM devices GROUP BY device_type"
    ),
    "paid_totals": with_views(
        "bills bill_totals",
        "SELECT user_id AS bill_user_id, total_bills, CAST(total_spent AS DOUBLE) AS total_spent FROM bill_totals",
    ),
    "vip_tier": with_views(
        "bills bill_totals",
        """SELECT user_id AS bill_user_id,
            CASE WHEN total_spent >= 1000000 THEN 'DIAMOND' WHEN total_spent >= 500000 THEN 'GOLD'
                 WHEN total_spent > 0 THEN 'SILVER' ELSE 'STANDARD' END AS vip_tier FROM bill_totals""",
    ),
    "bills_by_day": with_views(
        "bills",
        """SELECT CAST(CAST(make_timestamp(updated_at * 1000) AS DATE) AS VARCHAR) AS bill_date,
            count(*) AS bills, CAST(sum(amount) AS DOUBLE) AS amount FROM bills GROUP BY 1""",
    ),
    "monthly_revenue": with_views(
        "bills",
        """SELECT strftime(make_timestamp(updated_at * 1000), '%Y-%m') AS month, plan_type,
            CAST(sum(CASE WHEN status = 'paid' THEN amount ELSE 0 END) AS DOUBLE) AS revenue, count(id) AS bills,
            count(CASE WHEN status = 'paid' THEN 1 END) AS paid_bills, count(DISTINCT device_id) AS devices
            FROM bills GROUP BY 1, 2""",
    ),
    "device_logs_fact": with_views(
        "device_logs",
        """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
            device_id, event_type, severity, firmware_version, ip_address, fps, bitrate_kbps, duration_sec, error_code,
            CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month FROM device_logs""",
    ),
    "file_stream_facts": with_views(
        "device_logs",
        """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
            device_id, event_type, severity, firmware_version, ip_address, fps, bitrate_kbps, duration_sec, error_code,
            CAST(1 AS BIGINT) AS rejected FROM device_logs""",
    ),
    "monthly_devices": with_views(
        "device_logs",
        """SELECT strftime(ts, '%Y-%m') AS month, event_type, CAST(count(*) AS BIGINT) AS events,
            count(DISTINCT device_id) AS exact_devices, true AS within FROM device_logs GROUP BY 1, 2""",
    ),
    "payment_fact": with_views(
        "invoices payments0 payments",
        """SELECT partner_trans_id, bill_id, user_id, payment_gateway, CAST(trans_amount AS DOUBLE) AS trans_amount,
            CAST(partner_fee AS DOUBLE) AS partner_fee, strftime(trans_time, '%Y-%m-%d %H:%M:%S') AS trans_time,
            CAST(CAST(trans_time AS DATE) AS VARCHAR) AS trans_date, trans_status, bank_code FROM payments""",
    ),
    "reconcile_payments": with_views("invoices payments0 payments reconciled", "SELECT * FROM reconciled"),
    "reconcile_summary": with_views(
        "invoices payments0 payments reconciled",
        """SELECT payment_gateway, outcome, CAST(count(*) AS BIGINT) AS payments,
            CAST(coalesce(sum(CASE WHEN nth = 1 THEN CAST(billed_amount AS DECIMAL(15,2)) END), 0) AS DOUBLE) AS billed_amount,
            CAST(coalesce(sum(CAST(paid_amount AS DECIMAL(15,2))), 0) AS DOUBLE) AS paid_amount,
            CAST(coalesce(sum(CAST(partner_fee AS DECIMAL(15,2))), 0) AS DOUBLE) AS partner_fee
            FROM (SELECT *, row_number() OVER (PARTITION BY payment_gateway, outcome, bill_id) AS nth FROM reconciled)
            GROUP BY payment_gateway, outcome""",
    ),
    "connection_errors": with_views(
        "devices device_logs",
        """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, coalesce(device_type, 'unknown') AS device_type,
            event_type, error_code, CAST(count(*) AS BIGINT) AS errors, count(DISTINCT device_id) AS devices
            FROM device_logs LEFT JOIN (SELECT id, device_type FROM devices) d ON device_id = d.id
            WHERE error_code IS NOT NULL GROUP BY 1, 2, 3, 4""",
    ),
    "subscription_renewals": with_views(
        "invoices dated_invoices",
        """SELECT id AS first_bill_id, user_id, device_id, CAST(amount AS DOUBLE) AS amount, plan_type,
            CAST(n AS INTEGER) AS renewal_no, CAST(first_day + CAST(n * days AS INTEGER) AS VARCHAR) AS renewal_date
            FROM (SELECT *, unnest(range(1, 1 + (DATE '2001-08-01' - first_day) // days)) AS n
                  FROM dated_invoices WHERE status = 'paid')""",
    ),
    "bills_with_renewals": with_views(
        "invoices dated_invoices",
        """SELECT id AS first_bill_id, 0 AS renewal_no, user_id, device_id, CAST(amount AS DOUBLE) AS amount, plan_type,
                status, CAST(first_day AS VARCHAR) AS bill_date FROM dated_invoices
            UNION ALL
            SELECT id, CAST(n AS INTEGER), user_id, device_id, CAST(amount AS DOUBLE), plan_type, status,
                CAST(first_day + CAST(n * days AS INTEGER) AS VARCHAR)
            FROM (SELECT *, unnest(range(1, 1 + (DATE '2001-08-01' - first_day) // days)) AS n
                  FROM dated_invoices WHERE status = 'paid')""",
    ),
    "timed_stream": INGEST,
    "overwrite_table": with_views("customer_users", "SELECT * FROM customer_users"),
    "numbered_rows": """
        WITH n AS (SELECT (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM supplier) AS s)
        SELECT 'first' AS step, c AS table_rows, c AS keys, CAST(1 AS BIGINT) AS least, c AS most, c AS high_water FROM n
        UNION ALL SELECT 'second', c + s, c + s, 1, c + s, c + s FROM n
        UNION ALL SELECT 'truncated', 0, 0, NULL, NULL, 0 FROM n
        UNION ALL SELECT 'again', c, c, 1, c, c FROM n""",
    "truncate_table": with_views(
        "customer_users supplier_users users",
        """SELECT 'full' AS state, count(*) AS table_rows FROM users
            UNION ALL SELECT 'emptied', CAST(0 AS BIGINT)""",
    ),
    "skip_empty_export": with_views(
        "customer_users supplier_users users",
        """SELECT id, (SELECT count(*) FROM users) AS first_rows, CAST(0 AS BIGINT) AS second_rows, 0 AS new_files
            FROM users""",
    ),
    "tables_in_turn": """
        SELECT 'customer' AS name, count(*) AS table_rows FROM customer
        UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'supplier', count(*) FROM supplier
        UNION ALL SELECT 'no_such_table', NULL""",
    "email_normalise": f"""
        SELECT doc_id, replace(lower(translate(text, '{ACCENTED}', '{PLAIN}')), ' ', '') AS folded FROM documents""",
    "epoch_format": f"""
        SELECT event_id, {MS.format('ts')} AS ts_ms, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second,
               CAST(CAST(ts AS DATE) AS VARCHAR) AS day, strftime(ts, '%Y%m%d') AS compact_day
        FROM events""",
}
