"""The same queries as plain SQL, each rule written directly from raw rows."""

from __future__ import annotations

from tillsight.settings import Thresholds
from tillsight.verify.queries import (
    BUSY,
    CHUNK_ROWS,
    CLOCK,
    EVENT_CHUNK,
    EVENTS,
    LINES,
    STREAM_CHUNK_ROWS,
)

LINE_TXN = """
  SELECT concat('''C', o_custkey, '''') AS customer, concat('''M', s_nationkey, '''') AS merchant,
         concat('''es_', l_returnflag, '''') AS category, l_extendedprice AS amount,
         concat('''', CASE WHEN o_custkey % 10 = 0 AND l_linenumber = 2 THEN 'U'
                           WHEN o_custkey % 10 = 1 AND l_linenumber = 3 THEN 'U'
                           WHEN o_custkey % 10 = 9 THEN 'E'
                           WHEN o_custkey % 10 = 4 THEN 'U'
                           WHEN o_custkey % 10 IN (0, 3, 5, 8) THEN 'F' ELSE 'M' END, '''') AS gender,
         l_quantity AS qty, l_discount AS discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"""

LINE_IMP = """
  SELECT customer AS customerId, merchant AS merchantId, qty AS weight,
         category AS transactionType
  FROM txn WHERE category <> '''es_N'''"""

EVENT_IMP = """
  SELECT concat('''C', user_id, '''') AS customerId, concat('''M', event_type, '''') AS merchantId,
         CAST((user_id * 7 + length(event_type) * 13) % 50 + 1 AS DOUBLE) AS weight,
         concat('''es_', event_type, '''') AS transactionType
  FROM (SELECT DISTINCT user_id, event_type FROM events WHERE user_id % 6 <> 0)"""


def event_txn(chunk_rows: int) -> str:
    return f"""
  SELECT concat('''C', user_id, '''') AS customer, concat('''M', event_type, '''') AS merchant,
         value AS amount,
         concat('''', CASE WHEN user_id % 10 = 9 THEN 'E'
                           WHEN user_id % 10 = 4 AND event_id % 3 = 0 THEN 'U'
                           WHEN user_id % 10 IN (0, 3, 5, 8) THEN 'F' ELSE 'M' END, '''') AS gender,
         CAST(floor((row_number() OVER (ORDER BY ts, event_id) - 1) / {chunk_rows}) AS BIGINT)
           AS chunk_id
  FROM events"""


def with_lines(body: str) -> str:
    return f"WITH txn AS ({LINE_TXN}), imp AS ({LINE_IMP}) {body}"


def with_events(
    body: str, history: bool = False, chunk_rows: int = CHUNK_ROWS, more: str = ""
) -> str:
    """With history, every chunk sees the rows of all chunks up to it."""
    seen = "SELECT * FROM ev"
    if history:
        seen = (
            "SELECT ev.customer, ev.merchant, ev.amount, ev.gender, chunks.chunk_id "
            "FROM ev JOIN chunks ON ev.chunk_id <= chunks.chunk_id"
        )
    ctes = [
        f"ev AS ({event_txn(chunk_rows)})",
        f"imp AS ({EVENT_IMP})",
        "chunks AS (SELECT DISTINCT chunk_id FROM ev)",
        f"txn AS ({seen})",
        *([more] if more else []),
    ]
    return f"WITH {', '.join(ctes)} {body}"


def head(pattern: str, action: str, customer: str, scope: str) -> str:
    return (
        f"SELECT {scope}'{CLOCK.start}' AS YStartTime, '{CLOCK.detected}' AS detectionTime, "
        f"'{pattern}' AS patternId, '{action}' AS actionType, {customer} AS customerName, "
        "merchantId"
    )


def pairs(scope: str) -> str:
    return (
        f"SELECT {scope}merchant AS merchantId, customer AS customerId, count(*) AS txn_count "
        f"FROM txn WHERE merchant IS NOT NULL GROUP BY ALL"
    )


def ranked(lim: Thresholds, scope: str) -> str:
    """Customers of eligible merchants in the top share."""
    return f"""
  SELECT * FROM (
    SELECT {scope}merchantId, customerId, txn_count,
           round(percent_rank() OVER (PARTITION BY {scope}merchantId ORDER BY txn_count DESC), 4)
             AS txn_percentile_rank
    FROM (SELECT *, sum(txn_count) OVER (PARTITION BY {scope}merchantId) AS total_txns
          FROM ({pairs(scope)}))
    WHERE total_txns >= {lim.min_merchant_txns})
  WHERE txn_percentile_rank <= {lim.top_share}"""


def weighted(lim: Thresholds, scope: str) -> str:
    return f"""
  SELECT {scope}merchantId, customerId, avg(weight) AS avg_weight
  FROM ({ranked(lim, scope)}) JOIN imp USING (merchantId, customerId) GROUP BY ALL"""


def upgrade(lim: Thresholds, scope: str = "") -> str:
    return f"""
  {head("PatId1", "UPGRADE", "customerId", scope)} FROM (
    SELECT *, percent_rank() OVER (PARTITION BY {scope}merchantId
                                   ORDER BY avg_weight NULLS FIRST) AS weight_rank
    FROM ({weighted(lim, scope)}))
  WHERE weight_rank <= {lim.bottom_share}"""


def child(lim: Thresholds, scope: str = "") -> str:
    return f"""
  {head("PatId2", "CHILD", "customerId", scope)} FROM (
    SELECT {scope}merchant AS merchantId, customer AS customerId,
           avg(amount) AS avg_amount, count(*) AS txn_count
    FROM txn GROUP BY ALL)
  WHERE avg_amount < {lim.max_avg_amount} AND txn_count >= {lim.min_pair_txns}"""


def stripped(scope: str = "") -> str:
    return f"""
  SELECT {scope}substring(merchant, 2, length(merchant) - 2) AS merchantId,
         substring(customer, 2, length(customer) - 2) AS customerId,
         substring(gender, 2, 1) AS gender FROM txn"""


def triples(scope: str = "") -> str:
    return f"""
  SELECT {scope}merchantId, customerId, min(gender) AS gender FROM ({stripped(scope)})
  WHERE merchantId IS NOT NULL AND customerId IS NOT NULL
  GROUP BY {scope}merchantId, customerId HAVING count(DISTINCT gender) = 1"""


def letters(scope: str = "") -> str:
    return f"""
  SELECT {scope}merchantId, CAST(count(*) FILTER (WHERE gender = 'F') AS INTEGER) AS F,
         CAST(count(*) FILTER (WHERE gender = 'M') AS INTEGER) AS M
  FROM ({triples(scope)}) GROUP BY ALL"""


def gender_skew(lim: Thresholds, scope: str = "") -> str:
    return f"""
  {head("PatId3", "DEI-NEEDED", "''", scope)} FROM ({letters(scope)})
  WHERE F > {lim.min_female} AND F < M"""


def union(*parts: str) -> str:
    return " UNION ALL ".join(f"({p})" for p in parts)


def everything(lim: Thresholds, scope: str = "") -> str:
    return union(upgrade(lim, scope), child(lim, scope), gender_skew(lim, scope))


KEYS = "patternId, actionType, customerName, merchantId"
CHUNK = "chunk_id, "
FIRST = f"firsts AS (SELECT min(chunk_id) AS chunk_id, {KEYS} FROM fired GROUP BY {KEYS})"


def fired(body: str, chunk_rows: int = CHUNK_ROWS, lim: Thresholds = EVENTS) -> str:
    return with_events(
        body, True, chunk_rows, f"fired AS ({everything(lim, CHUNK)}), {FIRST}"
    )


NUMBERED = f"""
  SELECT *, CAST(floor((seq - 1) / 50) AS BIGINT) AS file_id FROM (
    SELECT chunk_id, {KEYS},
           row_number() OVER (ORDER BY chunk_id, patternId, merchantId, customerName) AS seq
    FROM firsts)"""

FINAL_STEP = 1_000_000_000  # after every chunk

STREAMED = f"""
  SELECT CAST(floor((row_number() OVER (ORDER BY step, patternId, merchantId, customerName) - 1)
                    / 50) AS BIGINT) AS file_id,
         '{CLOCK.start}' AS YStartTime, '{CLOCK.detected}' AS detectionTime, {KEYS}
  FROM (SELECT chunk_id AS step, {KEYS} FROM firsts WHERE patternId <> 'PatId2'
        UNION ALL
        SELECT {FINAL_STEP} AS step, {KEYS} FROM fired
        WHERE patternId = 'PatId2' AND chunk_id = (SELECT max(chunk_id) FROM ev))"""

ORACLE: dict[str, str] = {
    "txn_normalize": with_lines(
        "SELECT customer AS customerId, merchant AS merchantId, category AS transactionType, "
        "amount, substring(gender, 2, 1) AS gender FROM txn"
    ),
    "importance_normalize": with_lines("SELECT * FROM imp"),
    "strip_quotes": with_lines(stripped()),
    "ist_time": (
        "SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS ist_time "
        "FROM events"
    ),
    "merchant_txn_counts": with_lines(
        "SELECT merchant AS merchantId, count(*) AS total_txns FROM txn GROUP BY ALL"
    ),
    "eligible_merchants": with_lines(
        "SELECT merchant AS merchantId FROM txn GROUP BY ALL "
        f"HAVING count(*) >= {LINES.min_merchant_txns}"
    ),
    "eligible_transactions": with_lines(
        "SELECT merchant AS merchantId, customer AS customerId, category AS transactionType "
        "FROM txn WHERE merchant IN (SELECT merchant FROM txn GROUP BY ALL "
        f"HAVING count(*) >= {LINES.min_merchant_txns})"
    ),
    "pair_txn_counts": with_lines(pairs("")),
    "upgrade_stage_top_txn": with_lines(ranked(LINES, "")),
    "upgrade_stage_weights": with_lines(
        f"SELECT merchantId, customerId, round(avg_weight, 6) AS avg_weight "
        f"FROM ({weighted(LINES, '')})"
    ),
    "upgrade": with_lines(upgrade(LINES)),
    "pair_amount_stats": with_lines(
        "SELECT customer AS customerId, merchant AS merchantId, "
        "round(avg(amount), 6) AS avg_amount, count(*) AS txn_count FROM txn GROUP BY ALL"
    ),
    "child": with_lines(child(LINES)),
    "child_fine_amounts": with_lines(child(LINES)).replace(
        "l_extendedprice AS amount", "l_extendedprice * (1 - l_discount) AS amount"
    ),
    "csv_transactions": with_lines("SELECT customer, merchant, category, amount, gender FROM txn"),
    "csv_importance": with_lines(
        'SELECT customerId AS "Source", merchantId AS "Target", weight AS "Weight", '
        'transactionType AS "typeTrans" FROM imp'
    ),
    "clear_gender_pairs": with_lines(f"SELECT merchantId, customerId FROM ({triples()})"),
    "unique_gender_triples": with_lines(triples()),
    "gender_counts": with_lines(letters()),
    "gender_distribution": with_lines(
        f"SELECT gender, count(*) AS customers FROM ({triples()}) "
        f"WHERE merchantId = (SELECT min(merchantId) FROM ({gender_skew(LINES)})) GROUP BY ALL"
    ),
    "gender_skew": with_lines(gender_skew(LINES)),
    "all_detections": with_lines(everything(LINES)),
    "detections_without_child": with_lines(union(upgrade(LINES), gender_skew(LINES))),
    "detections_by_pattern": with_lines(
        f"SELECT patternId, count(*) AS detections FROM ({everything(LINES)}) GROUP BY ALL"
    ),
    "chunk_assign": (
        "SELECT event_id, seq, CAST(floor((seq - 1) / "
        f"{CHUNK_ROWS}) AS BIGINT) AS chunk_id FROM (SELECT event_id, "
        "row_number() OVER (ORDER BY ts, event_id) AS seq FROM events)"
    ),
    "chunk_files": (
        "SELECT event_id, seq, CAST(floor((seq - 1) / "
        f"{CHUNK_ROWS}) AS BIGINT) AS chunk_id, CAST((seq - 1) % {CHUNK_ROWS} + 1 AS BIGINT) AS place "
        "FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS seq FROM events)"
    ),
    "chunk_child": with_events(child(EVENT_CHUNK, CHUNK)),
    "chunk_detections": with_events(everything(EVENT_CHUNK, CHUNK)),
    "cumulative_upgrade": with_events(upgrade(EVENTS, CHUNK), True),
    "cumulative_child": with_events(child(EVENTS, CHUNK), True),
    "cumulative_gender_skew": with_events(gender_skew(EVENTS, CHUNK), True),
    "stream_progress": fired(
        """SELECT chunk_id, txns, detections,
                  CAST(sum(txns) OVER w AS BIGINT) AS total_txns,
                  CAST(sum(detections) OVER w AS BIGINT) AS total_detections
           FROM (SELECT chunk_id, count(*) AS txns FROM ev GROUP BY ALL)
           JOIN (SELECT chunks.chunk_id, count(patternId) AS detections
                 FROM chunks LEFT JOIN firsts USING (chunk_id) GROUP BY ALL) USING (chunk_id)
           WINDOW w AS (ORDER BY chunk_id)"""
    ),
    "first_detection": fired("SELECT * FROM firsts"),
    "first_detection_rows": fired(
        f"SELECT chunk_id, '{CLOCK.start}' AS YStartTime, '{CLOCK.detected}' AS detectionTime, {KEYS} "
        "FROM firsts"
    ),
    "emit_once": fired("SELECT * FROM firsts"),
    "occurs_once": fired(
        f"SELECT min(chunk_id) AS chunk_id, {KEYS} FROM fired GROUP BY {KEYS} HAVING count(*) = 1"
    ),
    "emit_batches": fired(
        f"SELECT * FROM ({NUMBERED}) WHERE seq <= (SELECT count(*) - count(*) % 50 FROM firsts)"
    ),
    "emit_batches_flush": fired(NUMBERED),
    "stream_cumulative": with_events(everything(EVENTS)),
    "stream_child_final": with_events(child(EVENTS)),
    "stream_emit_once": fired("SELECT * FROM firsts", STREAM_CHUNK_ROWS),
    "stream_any_order": fired("SELECT * FROM firsts", STREAM_CHUNK_ROWS),
    "stream_named_files": fired("SELECT * FROM firsts", STREAM_CHUNK_ROWS),
    "stream_restart": fired("SELECT * FROM firsts", STREAM_CHUNK_ROWS),
    "stream_chunk_detections": with_events(
        everything(EVENT_CHUNK, CHUNK), chunk_rows=STREAM_CHUNK_ROWS
    ),
    "stream_files": fired(STREAMED, STREAM_CHUNK_ROWS, BUSY),
}
