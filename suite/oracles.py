"""The same results in plain SQL, written without regard to how the queries work."""

from __future__ import annotations

_CUSTOMERS = """
c AS (
  SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal,
         c_mktsegment
  FROM customer),
base AS (SELECT * FROM c WHERE c_custkey % 20 <> 11),
h AS (
  SELECT base.*, row_number() OVER (ORDER BY c_custkey) AS sk,
         DATE '2024-01-01' AS effective_date, DATE '9999-12-31' AS expiration_date,
         TRUE AS current_flag
  FROM base
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'LEGACY',
         (SELECT count(*) FROM base) + row_number() OVER (ORDER BY c_custkey),
         DATE '2023-01-01', DATE '2024-01-01', FALSE
  FROM base WHERE c_custkey % 50 = 0),
s AS (
  SELECT c_custkey, c_name,
         CAST(CASE WHEN c_custkey % 20 = 3 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END
              AS INTEGER) AS c_nationkey,
         CAST(CASE WHEN c_custkey % 20 = 5 THEN c_acctbal + 100 ELSE c_acctbal END
              AS DECIMAL(12,2)) AS c_acctbal,
         c_mktsegment
  FROM c WHERE c_custkey % 20 <> 7)"""

_ORDERS = """
c AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
         CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
  FROM orders),
base AS (SELECT * FROM c WHERE o_orderkey % 20 <> 11),
h AS (
  SELECT base.*, row_number() OVER (ORDER BY o_orderkey) AS sk,
         DATE '2024-01-01' AS effective_date, DATE '9999-12-31' AS expiration_date,
         TRUE AS current_flag
  FROM base
  UNION ALL
  SELECT o_orderkey, o_custkey, 'L', o_totalprice, o_orderdate, o_orderpriority,
         (SELECT count(*) FROM base) + row_number() OVER (ORDER BY o_orderkey),
         DATE '2023-01-01', DATE '2024-01-01', FALSE
  FROM base WHERE o_orderkey % 50 = 0),
s AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 20 = 3 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         CAST(CASE WHEN o_orderkey % 20 = 5 THEN o_totalprice + 100 ELSE o_totalprice END
              AS DECIMAL(12,2)) AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM c WHERE o_orderkey % 20 <> 7)"""

_CONVERSATIONS = """
c AS (SELECT conv_id, turn, role, text FROM conversations),
base AS (SELECT * FROM c WHERE (conv_id * 7 + turn) % 20 <> 11),
h AS (
  SELECT base.*, row_number() OVER (ORDER BY conv_id, turn) AS sk,
         DATE '2024-01-01' AS effective_date, DATE '9999-12-31' AS expiration_date,
         TRUE AS current_flag
  FROM base
  UNION ALL
  SELECT conv_id, turn, 'legacy', text,
         (SELECT count(*) FROM base) + row_number() OVER (ORDER BY conv_id, turn),
         DATE '2023-01-01', DATE '2024-01-01', FALSE
  FROM base WHERE (conv_id * 7 + turn) % 50 = 0),
s AS (
  SELECT conv_id, turn,
         CASE WHEN (conv_id * 7 + turn) % 20 = 5 THEN NULL ELSE role END AS role,
         CASE WHEN (conv_id * 7 + turn) % 20 = 3 THEN concat(text, '.') ELSE text END AS text
  FROM c WHERE (conv_id * 7 + turn) % 20 <> 7)"""

_CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_ORDER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
]
_CONVERSATION_COLUMNS = ["conv_id", "turn", "role", "text"]
_SCD = ["sk", "effective_date", "expiration_date", "current_flag"]


def _branches(frames: str, columns: list[str], n_keys: int) -> str:
    """The classes of rows, each by its own join of active history and snapshot."""
    keys, cols = columns[:n_keys], ", ".join(columns)
    on = " AND ".join(f"a.{k} = s.{k}" for k in keys)
    same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM s.{c}" for c in columns)
    a_cols, s_cols = (", ".join(f"{t}.{c}" for c in columns) for t in "as")
    by = ", ".join(f"s.{k}" for k in keys)
    opened = "DATE '2024-06-01' AS effective_date, DATE '9999-12-31' AS expiration_date, TRUE AS current_flag"
    closed = "DATE '2024-06-01' AS expiration_date, FALSE AS current_flag"
    return f"""{frames},
a AS (SELECT * FROM h WHERE current_flag),
top AS (SELECT max(sk) AS sk FROM h),
nochange AS (SELECT a.* FROM a JOIN s ON {on} WHERE {same}),
deleted AS (
  SELECT {a_cols}, a.sk, a.effective_date, {closed}
  FROM a WHERE NOT EXISTS (SELECT 1 FROM s WHERE {on})),
updated_old AS (
  SELECT {a_cols}, a.sk, a.effective_date, {closed} FROM a JOIN s ON {on} WHERE NOT ({same})),
inserted AS (
  SELECT {s_cols}, (SELECT sk FROM top) + row_number() OVER (ORDER BY {by}) AS sk, {opened}
  FROM s WHERE NOT EXISTS (SELECT 1 FROM a WHERE {on})),
updated_new AS (
  SELECT {s_cols}, (SELECT sk FROM top) + (SELECT count(*) FROM inserted)
         + row_number() OVER (ORDER BY {by}) AS sk, {opened}
  FROM s JOIN a ON {on} WHERE NOT ({same})),
merged AS (
  SELECT {cols}, {", ".join(_SCD)} FROM h WHERE NOT current_flag
  UNION ALL SELECT {cols}, {", ".join(_SCD)} FROM nochange
  UNION ALL SELECT {cols}, {", ".join(_SCD)} FROM deleted
  UNION ALL SELECT {cols}, {", ".join(_SCD)} FROM updated_old
  UNION ALL SELECT {cols}, {", ".join(_SCD)} FROM inserted
  UNION ALL SELECT {cols}, {", ".join(_SCD)} FROM updated_new)"""


_BRANCHES = _branches(_CUSTOMERS, _CUSTOMER_COLUMNS, 1)


def _pairs(same: str) -> str:
    old = ", ".join(f"a.{c} AS {c}_history" for c in _CUSTOMER_COLUMNS + _SCD)
    new = ", ".join(f"s.{c} AS {c}_current" for c in _CUSTOMER_COLUMNS)
    return f"""{_CUSTOMERS},
pairs AS (
  SELECT {old}, {new},
         CASE WHEN s.c_custkey IS NULL THEN 'DELETE' WHEN a.c_custkey IS NULL THEN 'INSERT'
              WHEN {same} THEN 'NOCHANGE' ELSE 'UPDATE' END AS action
  FROM (SELECT * FROM h WHERE current_flag) a FULL OUTER JOIN s ON a.c_custkey = s.c_custkey)"""


_EXACT = " AND ".join(f"a.{c} IS NOT DISTINCT FROM s.{c}" for c in _CUSTOMER_COLUMNS)


def _md5(alias: str) -> str:
    return f"md5(concat_ws('', {', '.join(f'{alias}{c}' for c in _CUSTOMER_COLUMNS)}))"


_PAIRS = _pairs(_EXACT)
_LINES = """
lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
         CAST(l_discount AS DECIMAL(12,2)) AS l_discount, CAST(l_tax AS DECIMAL(12,2)) AS l_tax,
         l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
  FROM lineitem)"""
_LINE_ORDER = ", ".join(
    f"{c} DESC NULLS LAST"
    for c in ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
)


#: Values of the wrong kind or size, and the reasons for which their rows are rejected.
_LOSSY = """,
         concat(CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 23 = 0 THEN '.129' ELSE '.100' END)
           AS credit,
         CASE WHEN c_custkey % 29 = 0 THEN '16777217'
              ELSE concat(CAST(c_custkey AS VARCHAR), 'e0') END AS ratio,
         concat('2024-01-02 03:04:05', CASE WHEN c_custkey % 31 = 0 THEN '+05:00'
                WHEN c_custkey % 37 = 0 THEN '.0000001' ELSE '' END) AS seen,
         CAST(CASE WHEN c_custkey % 41 = 0 THEN 5 ELSE c_custkey % 2 END AS INTEGER) AS vip"""
_LOSSY_REASONS = """
              WHEN c_custkey % 23 = 0 THEN 'bad value: credit'
              WHEN c_custkey % 29 = 0 THEN 'bad value: ratio'
              WHEN c_custkey % 31 = 0 OR c_custkey % 37 = 0 THEN 'bad value: seen'
              WHEN c_custkey % 41 = 0 THEN 'bad value: vip'"""


def _awkward(rows: str, more: str = "", reasons: str = "") -> str:
    return f"""
awkward AS (
  SELECT CASE WHEN c_custkey % 17 <> 0 THEN c_custkey END AS c_custkey, c_name,
         CASE WHEN c_custkey % 13 = 0 THEN 'n/a' ELSE CAST(c_nationkey AS VARCHAR) END
           AS c_nationkey,
         CAST(CAST(c_acctbal AS DECIMAL(12,2)) + CASE WHEN c_custkey % 19 = 0
              THEN 0.0009 ELSE 0 END AS DECIMAL(14,4)) AS c_acctbal, c_mktsegment{more},
         CASE WHEN c_custkey % 13 = 0 THEN 'bad value: c_nationkey'
              WHEN c_custkey % 19 = 0 THEN 'bad value: c_acctbal'{reasons}
              WHEN c_custkey % 17 = 0 THEN 'null key: c_custkey' END AS reject_reason
  FROM {rows})"""


_AWKWARD = _awkward("customer", _LOSSY, _LOSSY_REASONS)
_CHECKS = [
    "one active row per key",
    "surrogate keys are unique",
    "no null surrogate key or flag",
    "new surrogate keys are dense",
    "active rows are the snapshot",
    "closed rows stay as they were",
    "no row is lost",
    "intervals do not end before they start",
    "active intervals are open",
    "new rows start at the processing date",
    "no null date",
    "closed intervals end",
    "versions of a key do not overlap",
]


def _with(frames: str, select: str) -> str:
    return f"WITH {frames.strip()}\n{select}"


def _h(select: str) -> str:
    return _with(_CUSTOMERS, select)


def _b(table: str) -> str:
    columns = ", ".join(_CUSTOMER_COLUMNS + _SCD)
    return _with(_BRANCHES, f"SELECT {columns} FROM {table}")


#: The history with surrogate keys that rows share.
_SHARED = _CUSTOMERS.replace("\nh AS (", "\nh0 AS (", 1) + """,
h AS (SELECT * REPLACE (CAST(sk % 97 + 1 AS BIGINT) AS sk) FROM h0)"""
#: A rejected row that tells its key counts as one that agrees with the active version.
_HELD = _CUSTOMERS.replace("\ns AS (", "\ns0 AS (", 1) + """,
s AS (
  SELECT * FROM s0 WHERE c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 19 <> 0
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM h
  WHERE current_flag AND c_custkey % 17 <> 0 AND (c_custkey % 13 = 0 OR c_custkey % 19 = 0)
    AND c_custkey IN (SELECT c_custkey FROM s0))"""
_DAMAGED = _BRANCHES + """,
fewer AS (SELECT * FROM merged WHERE NOT (current_flag AND c_custkey % 41 = 0)),
more AS (SELECT * FROM fewer UNION ALL
         SELECT * FROM fewer WHERE current_flag AND c_custkey % 43 = 0),
d AS (SELECT * REPLACE (
    CASE WHEN NOT (current_flag AND c_custkey % 47 = 0) THEN sk END AS sk,
    CASE WHEN NOT current_flag AND c_custkey % 53 = 0 THEN 'changed' ELSE c_name END AS c_name,
    CASE WHEN c_custkey % 59 = 0 THEN DATE '2000-01-01'
         WHEN NOT current_flag AND c_custkey % 71 = 0 THEN DATE '9999-12-31'
         WHEN c_custkey % 73 <> 0 THEN expiration_date END AS expiration_date,
    CASE WHEN c_custkey % 61 = 0 THEN CAST(effective_date - INTERVAL 1 DAY AS DATE)
         WHEN c_custkey % 67 <> 0 THEN effective_date END AS effective_date) FROM more),
fresh AS (SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.sk = d.sk))"""
_SOURCE = ", ".join(_CUSTOMER_COLUMNS)
_ALL = ", ".join(_CUSTOMER_COLUMNS + _SCD)
_VIOLATIONS = {
    "one active row per key": "SELECT 1 FROM d WHERE current_flag GROUP BY c_custkey HAVING count(*) > 1",
    "surrogate keys are unique": "SELECT 1 FROM d GROUP BY sk HAVING count(*) > 1",
    "no null surrogate key or flag": "SELECT 1 FROM d WHERE sk IS NULL OR current_flag IS NULL",
    "new surrogate keys are dense": "SELECT 1 FROM (SELECT count(*) AS n, min(sk) AS lo, "
    "max(sk) AS hi FROM fresh), top WHERE n > 0 AND NOT (lo = top.sk + 1 AND hi = top.sk + n)",
    "active rows are the snapshot": f"(SELECT {_SOURCE} FROM d WHERE current_flag EXCEPT ALL "
    f"SELECT {_SOURCE} FROM s) UNION ALL (SELECT {_SOURCE} FROM s EXCEPT ALL "
    f"SELECT {_SOURCE} FROM d WHERE current_flag)",
    "closed rows stay as they were": f"SELECT {_ALL} FROM h WHERE NOT current_flag "
    f"EXCEPT ALL SELECT {_ALL} FROM d",
    "no row is lost": "SELECT 1 FROM h WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.sk = h.sk)",
    "intervals do not end before they start": "SELECT 1 FROM d WHERE effective_date > expiration_date",
    "active intervals are open": "SELECT 1 FROM d WHERE current_flag "
    "AND expiration_date IS DISTINCT FROM DATE '9999-12-31'",
    "new rows start at the processing date": "SELECT 1 FROM fresh "
    "WHERE effective_date IS DISTINCT FROM DATE '2024-06-01'",
    "no null date": "SELECT 1 FROM d WHERE effective_date IS NULL OR expiration_date IS NULL",
    "closed intervals end": "SELECT 1 FROM d WHERE NOT current_flag "
    "AND expiration_date = DATE '9999-12-31'",
    "versions of a key do not overlap": "SELECT 1 FROM (SELECT effective_date, max(expiration_date) "
    "OVER (PARTITION BY c_custkey ORDER BY effective_date, expiration_date, sk "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_end FROM d "
    "WHERE effective_date < expiration_date) WHERE effective_date < last_end",
}

ORACLES: dict[str, str] = {
    "scan_csv": _h("SELECT * FROM c"),
    "scan_csv_columns": _h(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, "
            f"count({c}) AS filled FROM h"
            for i, c in enumerate(_CUSTOMER_COLUMNS + _SCD)
        )
    ),
    "sink_keyed_insert": _with(
        _BRANCHES,
        f"SELECT {', '.join(_CUSTOMER_COLUMNS + _SCD)} FROM h "
        f"UNION ALL SELECT {', '.join(_CUSTOMER_COLUMNS + _SCD)} FROM inserted",
    ),
    "sink_keyed_update": _with(
        _BRANCHES,
        " UNION ALL ".join(
            f"SELECT {', '.join(_CUSTOMER_COLUMNS + _SCD)} FROM {t}"
            for t in ["(SELECT * FROM h WHERE NOT current_flag)", "nochange", "deleted", "updated_old"]
        ),
    ),
    "ensure_table": _h(
        "SELECT 'before' AS step, TRUE AS created, CAST(0 AS BIGINT) AS n_rows "
        "UNION ALL SELECT 'after', FALSE, count(*) FROM h"
    ),
    "table_exists": _h(
        "SELECT 'before' AS step, FALSE AS found, CAST(0 AS BIGINT) AS n_rows "
        "UNION ALL SELECT 'after', TRUE, count(*) FROM h"
    ),
    "normalize_columns": _h("SELECT * FROM c"),
    "suffix_append": _h(
        "SELECT " + ", ".join(f"{c} AS {c}_history" for c in _CUSTOMER_COLUMNS + _SCD) + " FROM h"
    ),
    "suffix_strip": _h("SELECT * RENAME (c_name AS c_history_name) FROM c"),
    "row_fingerprint": _h(f"SELECT sk, {_md5('')} AS hash_md5 FROM h"),
    "row_fingerprint_empty": _h("SELECT sk, md5('1') AS hash_md5 FROM h"),
    "project_columns": _h("SELECT sk, c_mktsegment, c_custkey FROM h"),
    "add_constants": _h(
        "SELECT *, TRUE AS current_flag, DATE '9999-12-31' AS expiration_date FROM c"
    ),
    "stamp_as_of": _h("SELECT *, DATE '2024-06-01' AS effective_date FROM c"),
    "reformat_date": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders",
    "assign_surrogate_keys": _h(
        "SELECT *, (SELECT max(sk) FROM h) + row_number() OVER (ORDER BY c_custkey) AS sk FROM s"
    ),
    "dense_row_number": "SELECT l_orderkey, l_linenumber, "
    "row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS row_number FROM lineitem",
    "filter_active": _h("SELECT * FROM h WHERE current_flag"),
    "filter_inactive": _h("SELECT * FROM h WHERE NOT current_flag"),
    "join_full_outer": _with(_PAIRS, "SELECT * EXCLUDE (action) FROM pairs"),
    "classify_changes": _with(_PAIRS, "SELECT c_custkey_history, c_custkey_current, action FROM pairs"),
    "detect_changes": _with(_PAIRS, "SELECT * FROM pairs"),
    "detect_changes_md5": _with(
        _pairs(f"{_md5('a.')} = {_md5('s.')}"), "SELECT * FROM pairs"
    ),
    "filter_action": _with(_PAIRS, "SELECT * FROM pairs WHERE action = 'UPDATE'"),
    "action_counts": _with(_PAIRS, "SELECT action, count(*) AS n FROM pairs GROUP BY action"),
    "is_empty_guard": _with(
        _BRANCHES,
        "SELECT 'INSERT' AS action, (SELECT count(*) FROM inserted) = 0 AS skipped, "
        "TRUE AS skipped_when_same UNION ALL "
        "SELECT 'DELETE', (SELECT count(*) FROM deleted) = 0, TRUE UNION ALL "
        "SELECT 'UPDATE', (SELECT count(*) FROM updated_old) = 0, TRUE",
    ),
    "max_surrogate_key": _h("SELECT max(sk) AS max_sk FROM h"),
    "max_inserted_key": _with(
        _BRANCHES,
        "SELECT (SELECT sk FROM top) + (SELECT count(*) FROM inserted) AS max_sk",
    ),
    "rows_nochange": _b("nochange"),
    "rows_inserted": _b("inserted"),
    "rows_deleted": _b("deleted"),
    "rows_updated_old": _b("updated_old"),
    "rows_updated_new": _b("updated_new"),
    "union_by_name": _h("SELECT * FROM h UNION ALL SELECT * FROM h WHERE NOT current_flag"),
    "initial_load": _h(
        "SELECT *, row_number() OVER (ORDER BY c_custkey) AS sk, "
        "DATE '2024-06-01' AS effective_date, DATE '9999-12-31' AS expiration_date, "
        "TRUE AS current_flag FROM s"
    ),
    "merge_history": _b("merged"),
    "merge_history_md5": _b("merged"),
    "merge_history_orders": _with(
        _branches(_ORDERS, _ORDER_COLUMNS, 1),
        f"SELECT {', '.join(_ORDER_COLUMNS + _SCD)} FROM merged",
    ),
    "merge_history_composite_key": _with(
        _branches(_CONVERSATIONS, _CONVERSATION_COLUMNS, 2),
        f"SELECT {', '.join(_CONVERSATION_COLUMNS + _SCD)} FROM merged",
    ),
    "apply_snapshot": _b("merged"),
    "apply_changes": _b("merged"),
    "accepted_rows": _with(
        _AWKWARD,
        "SELECT c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, "
        "CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM awkward WHERE reject_reason IS NULL",
    ),
    "rejected_rows": _with(_AWKWARD, "SELECT * FROM awkward WHERE reject_reason IS NOT NULL"),
    "duplicate_keys": _with(
        _LINES,
        "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lines "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    ),
    "latest_per_key": _with(
        _LINES,
        "SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, "
        f"l_linenumber ORDER BY {_LINE_ORDER}) AS place FROM lines) WHERE place = 1",
    ),
    "post_conditions": " UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", CAST(0 AS BIGINT) AS violations" for c in _CHECKS
    ),
}
ORACLES |= {
    "scan_csv_text": _h("SELECT * FROM c WHERE c_custkey % 11 <> 0 AND c_custkey % 23 <> 0"),
    "scan_csv_text_rejects": _h(
        "SELECT CASE WHEN c_custkey % 11 = 0 "
        "THEN concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal) "
        "ELSE concat_ws(',', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'extra') "
        "END AS corrupt_record, 'malformed line' AS reject_reason "
        "FROM c WHERE c_custkey % 11 = 0 OR c_custkey % 23 = 0"
    ),
    "assign_surrogate_keys_null_key": _with(
        _CUSTOMERS,
        "SELECT *, row_number() OVER (ORDER BY c_custkey NULLS FIRST) AS sk FROM "
        "(SELECT * REPLACE (CASE WHEN c_custkey <> 7 THEN c_custkey END AS c_custkey) FROM c)",
    ),
    "merge_history_shared_sk": _with(
        _branches(_SHARED, _CUSTOMER_COLUMNS, 1), f"SELECT {_ALL} FROM merged"
    ),
    "merge_history_with_rejects": _with(
        _branches(_HELD, _CUSTOMER_COLUMNS, 1), f"SELECT {_ALL} FROM merged"
    ),
    "merge_history_rejects": _with(
        _CUSTOMERS + "," + _awkward("s"), "SELECT * FROM awkward WHERE reject_reason IS NOT NULL"
    ),
    "post_conditions_damaged": _with(
        _DAMAGED,
        " UNION ALL ".join(
            f"SELECT '{check}' AS \"check\", count(*) AS violations FROM ({rows})"
            for check, rows in _VIOLATIONS.items()
        ),
    ),
}
ORACLES["initial_load_stored"] = ORACLES["initial_load"]
