"""SQL that states, independently of the operators, what each registered query returns."""

from __future__ import annotations

ORDER_KEY = "concat('REQ-', order_key) AS req_id, concat('FO-', order_key) AS fo_id"
USER_KEY = "concat('REQ-', user_id) AS req_id, concat('FO-', user_id) AS fo_id"
DAY_KEY = "concat('REQ-', user_id) AS req_id, concat('FO-', CAST(day AS VARCHAR)) AS fo_id"

_COUNTS = """
counts AS (
  SELECT l_orderkey AS order_key,
         CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS dt,
         CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS dm
  FROM {items} GROUP BY l_orderkey)"""

_CONTROL = """
control AS (
  SELECT o_orderkey AS order_key,
         CAST(CASE WHEN o_orderkey % 10 = 0 THEN coalesce(dt, 0) + 1
                   WHEN o_orderkey % 10 = 1 THEN greatest(coalesce(dt, 0) - 1, 0)
                   ELSE coalesce(dt, 0) END AS BIGINT) AS ct,
         CAST(coalesce(dm, 0) AS BIGINT) AS cm
  FROM orders LEFT JOIN all_counts ON all_counts.order_key = o_orderkey
  WHERE o_orderkey % 10 <> 2)"""

_ALL_COUNTS = _COUNTS.format(items="lineitem").replace("counts AS", "all_counts AS")

_RECONCILED = """
reconciled AS (
  SELECT coalesce(control.order_key, counts.order_key) AS order_key,
         coalesce(ct, 0) AS declared_trade_data, coalesce(cm, 0) AS declared_market_data,
         coalesce(dt, 0) AS received_trade_data, coalesce(dm, 0) AS received_market_data,
         coalesce(ct, 0) - coalesce(dt, 0) AS delta_trade_data,
         coalesce(cm, 0) - coalesce(dm, 0) AS delta_market_data,
         control.order_key IS NOT NULL AS has_control, counts.order_key IS NOT NULL AS has_data,
         CASE WHEN control.order_key IS NULL THEN 'NO_CTRL'
              WHEN coalesce(ct, 0) = coalesce(dt, 0) AND coalesce(cm, 0) = coalesce(dm, 0) THEN 'COMPLETE'
              WHEN counts.order_key IS NULL THEN 'NO_DATA'
              WHEN ct < dt OR cm < dm THEN 'OVER' ELSE 'INCOMPLETE' END AS status
  FROM control FULL OUTER JOIN counts ON control.order_key = counts.order_key)"""

_UNIQUE_ITEMS = "(SELECT DISTINCT l_orderkey, l_linestatus, l_linenumber FROM lineitem) unique_items"


def _with_reconciled(select: str, items: str = "lineitem") -> str:
    return f"WITH {_ALL_COUNTS}, {_COUNTS.format(items=items)}, {_CONTROL}, {_RECONCILED} {select}"


_RECONCILED_COLUMNS = f"""{ORDER_KEY}, declared_trade_data, declared_market_data, received_trade_data,
  received_market_data, delta_trade_data, delta_market_data, has_control, has_data, status"""

_REVISIONS = """
revisions AS (
  SELECT o_orderkey AS order_key, 0 AS seq, o_orderdate AS ts, o_orderkey % 7 AS trades FROM orders
  UNION ALL
  SELECT o_orderkey, 1, o_orderdate + INTERVAL 1 DAY, o_orderkey % 7 + 1 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT o_orderkey, 2, o_orderdate, o_orderkey % 7 + 2 FROM orders WHERE o_orderkey % 5 = 0)"""

_DATA = """
data AS (
  SELECT event_id AS seq, user_id, CAST(ts AS DATE) AS day, ts,
         CASE event_type WHEN 'purchase' THEN 'TRADE_DATA' WHEN 'view' THEN 'MARKET_DATA'
              ELSE 'UNRECOGNIZED' END AS type,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS t,
         CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS m,
         json_extract_string(props, '$.k') AS value
  FROM events)"""

_EVENT_CONTROL = """
control AS (
  SELECT user_id, day, min(ts) AS ts, max(ts) AS last_ts, count(*) AS n,
         CAST(sum(t) AS BIGINT) AS dt, CAST(sum(m) AS BIGINT) AS dm,
         CAST(sum(t) + CASE WHEN user_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS ct,
         CAST(sum(m) AS BIGINT) AS cm
  FROM data GROUP BY user_id, day)"""

_DAILY = """
goal AS (
  SELECT user_id, sum(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN t ELSE 0 END) AS ct,
         sum(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN m ELSE 0 END) AS cm
  FROM data GROUP BY user_id),
daily AS (SELECT user_id, day, sum(t) AS t, sum(m) AS m FROM data GROUP BY user_id, day),
states AS (
  SELECT user_id, day,
         ct = sum(t) OVER so_far AND cm = sum(m) OVER so_far AS done
  FROM daily JOIN goal USING (user_id)
  WINDOW so_far AS (PARTITION BY user_id ORDER BY day))"""

_DECODED = """
WITH data AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type, props, event_id % 100 AS damage FROM events)
SELECT event_id AS "offset",
       CASE WHEN damage > 3 THEN concat('REQ-', user_id) END AS req_id,
       CASE WHEN damage > 3 THEN concat('FO-', CAST(day AS VARCHAR)) END AS fo_id,
       CASE WHEN damage > 3 THEN CASE WHEN event_type = 'purchase' THEN 'TRADE_DATA' ELSE 'MARKET_DATA' END END AS type,
       CASE WHEN damage > 3 THEN concat('Trade-', event_id) END AS id,
       CASE WHEN damage > 3 THEN json_extract_string(props, '$.k') END AS value,
       CASE damage WHEN 0 THEN 'BAD_VALUE' WHEN 1 THEN 'NULL_VALUE' WHEN 2 THEN 'BAD_KEY' WHEN 3 THEN 'NULL_KEY' END AS error
FROM data"""

_HOT = """
hot AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, CASE WHEN user_id % 3 <> 0 THEN day END AS day,
         ts, seq, t, m FROM data)"""

# What the streams over slices take: records of the two known types, and an announcement per request.
_KNOWN = """
known AS (SELECT *, (day(ts) - 1) // 5 AS slice FROM data WHERE t + m > 0)"""

_USER_GOAL = """
goal AS (
  SELECT user_id, min(ts) AS ts, (day(min(ts)) - 1) // 5 AS slice,
         CAST(sum(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN t ELSE 0 END) AS BIGINT) AS ct,
         CAST(sum(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN m ELSE 0 END) AS BIGINT) AS cm
  FROM data GROUP BY user_id)"""

_STATUS = """CASE WHEN ct = dt AND cm = dm THEN 'COMPLETE' WHEN n_data = 0 THEN 'NO_DATA'
              WHEN ct < dt OR cm < dm THEN 'OVER' ELSE 'INCOMPLETE' END"""

# A user's day as a session: its announcement and known records, closed a day after the last of them.
_SESSIONS = """
sessions AS (
  SELECT control.user_id, control.day, ct, cm, dt, dm, greatest(control.ts, coalesce(max(known.ts), control.ts)) AS last_ts
  FROM control LEFT JOIN known ON known.user_id = control.user_id AND known.day = control.day
  GROUP BY control.user_id, control.day, ct, cm, dt, dm, control.ts),
closed AS (
  SELECT * FROM sessions
  WHERE last_ts + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(last_ts) - INTERVAL 1 HOUR) FROM sessions))"""

ORACLES = {
    "declared_or_fail": f"""
        WITH keyed AS (SELECT o_orderkey AS order_key FROM orders)
        SELECT {ORDER_KEY}, CAST(order_key % 7 AS BIGINT) AS declared_trade_data,
               CAST(order_key % 5 AS BIGINT) AS declared_market_data FROM keyed""",
    "latest_declared": f"""
        WITH {_REVISIONS},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY ts DESC, seq DESC) AS rank FROM revisions)
        SELECT {ORDER_KEY}, CAST(trades AS BIGINT) AS declared_trade_data,
               CAST(order_key % 5 AS BIGINT) AS declared_market_data
        FROM ranked WHERE rank = 1""",
    "decode_text": _DECODED,
    "published_repeatedly": f"""
        WITH {_DATA}, {_KNOWN},
        had AS (SELECT user_id, day, CAST(sum(t) AS BIGINT) AS t, CAST(sum(m) AS BIGINT) AS m FROM known GROUP BY user_id, day)
        SELECT {DAY_KEY}, t AS declared_trade_data, m AS declared_market_data, t AS received_trade_data,
               m AS received_market_data, CAST(0 AS BIGINT) AS delta_trade_data, CAST(0 AS BIGINT) AS delta_market_data,
               TRUE AS has_control, TRUE AS has_data, 'COMPLETE' AS status
        FROM had""",
    "consumed_notices": f"""
        WITH {_DATA}, {_KNOWN}
        SELECT DISTINCT {USER_KEY}, concat('REQ-', user_id, ' Finished.') AS message FROM known""",
    "stream_restarted": f"""
        WITH {_DATA}, {_KNOWN}, {_USER_GOAL},
        had AS (
          SELECT user_id, ct, cm, CAST(coalesce(sum(known.t), 0) AS BIGINT) AS dt,
                 CAST(coalesce(sum(known.m), 0) AS BIGINT) AS dm, count(known.seq) AS n_data
          FROM goal LEFT JOIN known USING (user_id) GROUP BY user_id, ct, cm)
        SELECT {USER_KEY}, ct AS declared_trade_data, cm AS declared_market_data, dt AS received_trade_data,
               dm AS received_market_data, TRUE AS has_control, n_data > 0 AS has_data, {_STATUS} AS status
        FROM had""",
    "state_history": f"""
        WITH {_DATA}, {_KNOWN}, {_USER_GOAL},
        sent AS (
          SELECT user_id, slice, ts, t, m, 1 AS n FROM known UNION ALL SELECT user_id, slice, ts, 0, 0, 0 FROM goal),
        had AS (
          SELECT user_id, slice, sum(t) AS t, sum(m) AS m, sum(n) AS n, max(ts) AS ts FROM sent GROUP BY user_id, slice),
        so_far AS (
          SELECT user_id, slice, ct, cm, CAST(sum(t) OVER w AS BIGINT) AS dt, CAST(sum(m) OVER w AS BIGINT) AS dm,
                 sum(n) OVER w AS n_data, max(had.ts) OVER w AS last_ts
          FROM had JOIN (SELECT user_id, ct, cm FROM goal) g USING (user_id)
          WINDOW w AS (PARTITION BY user_id ORDER BY slice))
        SELECT CAST(slice AS BIGINT) AS batch_id, {USER_KEY}, ct AS declared_trade_data, cm AS declared_market_data,
               dt AS received_trade_data, dm AS received_market_data, TRUE AS has_control, n_data > 0 AS has_data,
               last_ts, {_STATUS} AS status
        FROM so_far""",
    "stream_session_expiry": f"""
        WITH {_DATA}, {_KNOWN}, {_EVENT_CONTROL}, {_SESSIONS}
        SELECT {DAY_KEY}, CASE WHEN ct = dt THEN 'COMPLETE' ELSE 'EXPIRED' END AS status,
               ct AS declared_trade_data, cm AS declared_market_data,
               dt AS received_trade_data, dm AS received_market_data
        FROM closed""",
    "stream_completed_bounded": f"""
        WITH {_DATA}, {_KNOWN}, {_EVENT_CONTROL}, {_SESSIONS}
        SELECT {DAY_KEY}, concat('REQ-', user_id, ' Finished.') AS message FROM closed WHERE ct = dt""",
    "stream_edges": f"""
        WITH {_DATA}, {_DAILY},
        done AS (SELECT user_id, day FROM states WHERE done),
        horizon AS (SELECT max(day) AS last_day FROM states)
        SELECT {USER_KEY}, CAST(day AS TIMESTAMP) AS snapshot_ts, 'rising' AS edge
        FROM done WHERE NOT EXISTS (
          SELECT 1 FROM done earlier WHERE earlier.user_id = done.user_id AND earlier.day = done.day - 1)
        UNION ALL
        SELECT {USER_KEY}, CAST(day + 1 AS TIMESTAMP), 'falling'
        FROM done, horizon WHERE day < last_day AND NOT EXISTS (
          SELECT 1 FROM done later WHERE later.user_id = done.user_id AND later.day = done.day + 1)""",
    "stream_late": f"""
        WITH {_DATA},
        came AS (
          SELECT *, least((day(ts) - 1) // 5 + CASE WHEN seq % 50 = 0 THEN 2 ELSE 0 END, 6) AS arrival FROM data),
        newest AS (SELECT arrival, max(ts) AS ts FROM came GROUP BY arrival),
        marks AS (
          SELECT arrival, (SELECT epoch_us(date_trunc('milliseconds', max(n.ts) - INTERVAL 1 HOUR))
                           FROM newest n WHERE n.arrival < newest.arrival) AS mark
          FROM newest),
        judged AS (SELECT came.*, mark - epoch_us(ts) AS behind FROM came JOIN marks USING (arrival))
        SELECT {DAY_KEY}, concat('Trade-', seq) AS id, coalesce(behind >= 0, FALSE) AS late,
               CASE WHEN behind >= 0 THEN behind END AS late_by_us
        FROM judged""",
    "running_counts_hot": f"""
        WITH {_DATA}, {_HOT}
        SELECT user_id, day, ts, seq, CAST(sum(t) OVER so_far AS BIGINT) AS running_trade_data,
               CAST(sum(m) OVER so_far AS BIGINT) AS running_market_data
        FROM hot WINDOW so_far AS (PARTITION BY user_id, day ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)""",
    "first_completion_hot": f"""
        WITH {_DATA}, {_HOT},
        feed AS (
          SELECT user_id, day, ts, 1 AS kind, seq, t, m, NULL AS ct, NULL AS cm FROM hot
          UNION ALL
          SELECT user_id, day, ts, 0, seq, 0, 0, seq // 2, seq * 3 // 4 FROM hot WHERE seq % 100 = 0
          UNION ALL
          SELECT user_id, day, max(ts), 0, max(seq) + 1, 0, 0, sum(t), sum(m) FROM hot GROUP BY user_id, day),
        prefix AS (
          SELECT user_id, day, ts, kind, seq, sum(t) OVER so_far AS dt, sum(m) OVER so_far AS dm,
                 last_value(ct IGNORE NULLS) OVER so_far AS ct, last_value(cm IGNORE NULLS) OVER so_far AS cm
          FROM feed
          WINDOW so_far AS (PARTITION BY user_id, day ORDER BY ts, kind, seq ROWS UNBOUNDED PRECEDING)),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, kind, seq) AS rank
          FROM prefix WHERE ct = dt AND cm = dm)
        SELECT user_id, day, ts AS completed_at, CAST(dt AS BIGINT) AS received_trade_data,
               CAST(dm AS BIGINT) AS received_market_data
        FROM ranked WHERE rank = 1""",
    "data_messages": f"""
        SELECT concat('REQ-', l_orderkey) AS req_id, concat('FO-', l_orderkey) AS fo_id,
               CASE l_linestatus WHEN 'O' THEN 'TRADE_DATA' WHEN 'F' THEN 'MARKET_DATA'
                    ELSE 'UNRECOGNIZED' END AS type,
               concat('Trade-', l_linenumber) AS id,
               CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) AS value
        FROM lineitem""",
    "type_counts": f"""
        WITH {_COUNTS.format(items="lineitem")}
        SELECT {ORDER_KEY}, dt AS received_trade_data, dm AS received_market_data FROM counts""",
    "control_totals": f"""
        WITH {_COUNTS.format(items="lineitem")}
        SELECT {ORDER_KEY}, 'TRADE_DATA' AS type, dt AS declared FROM counts
        UNION ALL
        SELECT {ORDER_KEY}, 'MARKET_DATA', dm FROM counts""",
    "describe_counts": f"""
        WITH {_COUNTS.format(items="lineitem")}
        SELECT {ORDER_KEY}, concat('num trade: ', dt, '; num market data: ', dm) AS description FROM counts""",
    "declared_counts": f"""
        SELECT concat('REQ-', o_orderkey) AS req_id, concat('FO-', o_orderkey) AS fo_id,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 2 END AS BIGINT) AS n_types,
               TRUE AS has_trade_data, o_orderkey % 7 <> 0 AS has_market_data,
               CAST(o_orderkey % 7 AS BIGINT) AS declared_trade_data,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 5 END AS BIGINT) AS declared_market_data
        FROM orders""",
    "latest_control_edge": f"""
WITH keyed AS (SELECT o_orderkey AS order_key FROM orders)
SELECT {ORDER_KEY},
       CAST(CASE WHEN order_key % 11 = 0 THEN 99 ELSE order_key % 7 + 1 END AS BIGINT) AS declared_trade_data,
       CAST(CASE WHEN order_key % 11 = 0 THEN 99 WHEN order_key % 3 <> 0 THEN order_key % 5 END AS BIGINT)
         AS declared_market_data
FROM keyed""",
    "published_rejects": f"""
WITH {_DATA}
SELECT {DAY_KEY}, 'UNKNOWN_TYPE' AS error, count(*) AS n
FROM data WHERE type = 'UNRECOGNIZED' GROUP BY user_id, day""",
    "declared_quarantine": f"""
        SELECT concat('REQ-', o_orderkey) AS req_id, concat('FO-', o_orderkey) AS fo_id,
               CAST(o_orderkey % 7 AS BIGINT) AS declared_trade_data,
               CAST(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 5 END AS BIGINT) AS declared_market_data,
               CASE WHEN o_orderkey % 7 = 0 THEN 'MISSING_TYPE:MARKET_DATA' END AS error
        FROM orders""",
    "latest_control": f"""
        WITH {_REVISIONS},
        ranked AS (SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY ts DESC, seq DESC) AS rank FROM revisions)
        SELECT {ORDER_KEY}, concat('fo-', seq) AS fo_name, ts, CAST(seq AS BIGINT) AS seq,
               CAST(trades AS BIGINT) AS declared_trade_data, CAST(order_key % 5 AS BIGINT) AS declared_market_data
        FROM ranked WHERE rank = 1""",
    "merge_control": f"""
        SELECT concat('REQ-', o_orderkey) AS req_id, concat('FO-', o_orderkey) AS fo_id,
               CASE WHEN o_orderkey % 4 = 2 THEN concat('new-', o_orderkey % 10)
                    ELSE concat('fo-', o_orderkey % 10) END AS fo_name,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 2 END AS BIGINT) AS n_types,
               TRUE AS has_trade_data, o_orderkey % 7 <> 0 AS has_market_data,
               CAST(CASE WHEN o_orderkey % 2 = 0 THEN 100 + o_orderkey % 3 ELSE o_orderkey % 7 END AS BIGINT)
                 AS declared_trade_data,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 5 END AS BIGINT) AS declared_market_data
        FROM orders""",
    "reconcile_status": _with_reconciled(f"SELECT {_RECONCILED_COLUMNS} FROM reconciled"),
    "reconcile_summary": _with_reconciled(
        """SELECT status, count(*) AS n, CAST(sum(CASE WHEN has_data THEN 0 ELSE 1 END) AS BIGINT) AS no_data_rows
           FROM reconciled GROUP BY status"""
    ),
    "completion_delta": _with_reconciled(
        f"SELECT {ORDER_KEY}, delta_trade_data, delta_market_data FROM reconciled WHERE has_control AND has_data"
    ),
    "completed_notifications": _with_reconciled(
        f"""SELECT {ORDER_KEY}, concat('REQ-', order_key, ' Finished.') AS message
            FROM reconciled WHERE status = 'COMPLETE'"""
    ),
    "data_without_control": _with_reconciled(
        f"SELECT {ORDER_KEY}, received_trade_data, received_market_data FROM reconciled WHERE NOT has_control"
    ),
    "control_without_data": _with_reconciled(
        f"SELECT {ORDER_KEY}, declared_trade_data, declared_market_data FROM reconciled WHERE NOT has_data"
    ),
    "dedup_reconcile": _with_reconciled(f"SELECT {_RECONCILED_COLUMNS} FROM reconciled", _UNIQUE_ITEMS),
    "published_status": f"""
        WITH {_COUNTS.format(items="lineitem")}
        SELECT {ORDER_KEY}, dt AS declared_trade_data, dm AS declared_market_data,
               dt AS received_trade_data, dm AS received_market_data,
               CAST(0 AS BIGINT) AS delta_trade_data, CAST(0 AS BIGINT) AS delta_market_data,
               TRUE AS has_control, TRUE AS has_data, 'COMPLETE' AS status
        FROM counts""",
    "running_counts": f"""
        WITH {_DATA}
        SELECT {DAY_KEY}, ts, seq, CAST(sum(t) OVER so_far AS BIGINT) AS running_trade_data,
               CAST(sum(m) OVER so_far AS BIGINT) AS running_market_data
        FROM data WINDOW so_far AS (PARTITION BY user_id, day ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)""",
    "first_completion": f"""
        WITH {_DATA}, {_EVENT_CONTROL},
        feed AS (
          SELECT user_id, day, ts, 0 AS kind, 0 AS seq, 0 AS t, 0 AS m, ct, cm FROM control
          UNION ALL
          SELECT user_id, day, ts, 1, seq, t, m, NULL, NULL FROM data),
        prefix AS (
          SELECT user_id, day, ts, kind, seq, sum(t) OVER so_far AS dt, sum(m) OVER so_far AS dm,
                 last_value(ct IGNORE NULLS) OVER so_far AS ct, last_value(cm IGNORE NULLS) OVER so_far AS cm
          FROM feed
          WINDOW so_far AS (PARTITION BY user_id, day ORDER BY ts, kind, seq ROWS UNBOUNDED PRECEDING)),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, kind, seq) AS rank
          FROM prefix WHERE ct = dt AND cm = dm)
        SELECT {DAY_KEY}, ts AS completed_at, CAST(dt AS BIGINT) AS received_trade_data,
               CAST(dm AS BIGINT) AS received_market_data
        FROM ranked WHERE rank = 1""",
    "newly_completed": f"""
        WITH {_DATA}, {_DAILY},
        changes AS (
          SELECT user_id, day, done,
                 coalesce(lag(done) OVER (PARTITION BY user_id ORDER BY day), FALSE) AS before
          FROM states)
        SELECT {USER_KEY}, CAST(day AS TIMESTAMP) AS snapshot_ts,
               CASE WHEN done THEN 'rising' ELSE 'falling' END AS edge
        FROM changes WHERE done <> before""",
    "snapshot_edges": f"""
        WITH {_DATA}, {_DAILY},
        done AS (SELECT user_id, day FROM states WHERE done),
        horizon AS (SELECT max(day) AS last_day FROM states)
        SELECT {USER_KEY}, CAST(day AS TIMESTAMP) AS snapshot_ts, 'rising' AS edge
        FROM done WHERE NOT EXISTS (
          SELECT 1 FROM done earlier WHERE earlier.user_id = done.user_id AND earlier.day = done.day - 1)
        UNION ALL
        SELECT {USER_KEY}, CAST(day + 1 AS TIMESTAMP), 'falling'
        FROM done, horizon WHERE day < last_day AND NOT EXISTS (
          SELECT 1 FROM done later WHERE later.user_id = done.user_id AND later.day = done.day + 1)""",
    "windowed_counts": f"""
        WITH {_DATA}, starts AS (
          SELECT user_id, day AS start, t, m FROM data
          UNION ALL
          SELECT user_id, day - 1, t, m FROM data)
        SELECT {USER_KEY}, CAST(start AS TIMESTAMP) AS window_start, CAST(start + 2 AS TIMESTAMP) AS window_end,
               CAST(sum(t) AS BIGINT) AS received_trade_data, CAST(sum(m) AS BIGINT) AS received_market_data
        FROM starts GROUP BY user_id, start""",
    "decode_quarantine": _DECODED,
    "quarantined": """
        WITH sent AS (
          SELECT event_id, event_id % 100 AS damage,
                 concat('{"ReqId":"REQ-', user_id, '","FOId":"FO-', CAST(CAST(ts AS DATE) AS VARCHAR), '"}') AS k,
                 concat('{"Type":"', CASE WHEN event_type = 'purchase' THEN 'TRADE_DATA' ELSE 'MARKET_DATA' END,
                        '","Id":"Trade-', event_id, '","Value":"', json_extract_string(props, '$.k'), '"}') AS v
          FROM events)
        SELECT event_id AS "offset",
               CASE damage WHEN 0 THEN 'BAD_VALUE' WHEN 1 THEN 'NULL_VALUE' WHEN 2 THEN 'BAD_KEY' ELSE 'NULL_KEY' END AS error,
               CASE damage WHEN 2 THEN '{' WHEN 3 THEN NULL ELSE k END AS raw_key,
               CASE damage WHEN 0 THEN substring(v, 1, 5) WHEN 1 THEN NULL ELSE v END AS raw_value
        FROM sent WHERE damage <= 3""",
    "decode_protobuf": _DECODED,
    "stream_reconcile": _with_reconciled(
        f"""SELECT {ORDER_KEY}, declared_trade_data, declared_market_data, received_trade_data,
                   received_market_data, has_control, has_data, status FROM reconciled"""
    ),
    "stream_completed": _with_reconciled(
        f"""SELECT {ORDER_KEY}, concat('REQ-', order_key, ' Finished.') AS message
            FROM reconciled WHERE status = 'COMPLETE'"""
    ),
    "stream_expiry": f"""
        WITH {_DATA}, {_EVENT_CONTROL}
        SELECT {DAY_KEY}, CASE WHEN ct = dt THEN 'COMPLETE' ELSE 'EXPIRED' END AS status,
               ct AS declared_trade_data, cm AS declared_market_data,
               dt AS received_trade_data, dm AS received_market_data
        FROM control
        WHERE ct = dt OR date_trunc('milliseconds', last_ts) + INTERVAL 1 DAY
                         <= (SELECT date_trunc('milliseconds', max(ts) - INTERVAL 1 HOUR) FROM events)""",
    "stream_end_states": f"""
        WITH {_DATA}, {_EVENT_CONTROL}
        SELECT {DAY_KEY}, ct AS declared_trade_data, cm AS declared_market_data,
               dt AS received_trade_data, dm AS received_market_data,
               TRUE AS has_control, TRUE AS has_data, last_ts,
               CASE WHEN ct = dt THEN 'COMPLETE'
                    ELSE 'INCOMPLETE' END AS status
        FROM control
        WHERE last_ts + INTERVAL 1 DAY <= (SELECT date_trunc('milliseconds', max(ts) - INTERVAL 1 HOUR) FROM events)""",
    "state_snapshot": f"""
        WITH {_DATA}, {_EVENT_CONTROL}
        SELECT {DAY_KEY}, ct AS declared_trade_data, cm AS declared_market_data,
               dt AS received_trade_data, dm AS received_market_data,
               TRUE AS has_control, TRUE AS has_data, last_ts,
               CASE WHEN ct = dt THEN 'COMPLETE'
                    ELSE 'INCOMPLETE' END AS status
        FROM control""",
}
