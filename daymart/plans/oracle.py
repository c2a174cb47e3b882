"""Oracle SQL (DuckDB dialect) for every driver query in ``tpch.QUERIES``.

Independent re-expressions of the operator semantics in plain SQL over
the same tables; the driver compares row count, schema and values.
"""

from __future__ import annotations

from daymart.contracts import DATASETS
from daymart.plans import tpch

D1, D2, EARLY, FLD, EXB = (tpch.DAY1, tpch.DAY2, tpch.EARLY_LOAD, tpch.FACT_LOAD_DATE,
                           tpch.EXISTING_FACTS_BEFORE)

SNAP1 = "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 0"
SNAP2 = ("SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 8000 THEN (c_nationkey + 1) % 25 "
         "ELSE c_nationkey END AS c_nationkey, CASE WHEN c_acctbal < 500 THEN NULL ELSE c_mktsegment END "
         "AS c_mktsegment FROM customer WHERE c_acctbal < 9000")
H1 = (f"SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS user_key, c_custkey, c_name, "
      f"c_nationkey, c_mktsegment, DATE '{D1}' AS effective_date, DATE '9999-12-31' AS expiry_date, "
      f"TRUE AS is_current FROM snap1")
CHANGED = ("(d.c_name IS DISTINCT FROM s.c_name OR d.c_nationkey IS DISTINCT FROM s.c_nationkey "
           "OR d.c_mktsegment IS DISTINCT FROM s.c_mktsegment)")
H2 = f"""
cls AS (
  SELECT d.user_key AS d_key, d.c_custkey AS d_id, d.c_name AS d_name, d.c_nationkey AS d_nation,
         d.c_mktsegment AS d_seg, d.effective_date AS d_eff,
         s.c_custkey AS s_id, s.c_name AS s_name, s.c_nationkey AS s_nation, s.c_mktsegment AS s_seg,
         (d.c_custkey IS NOT NULL AND s.c_custkey IS NOT NULL AND {CHANGED}) AS changed
  FROM (SELECT * FROM h1 WHERE is_current) d FULL OUTER JOIN snap2 s ON d.c_custkey = s.c_custkey),
h2 AS (
  SELECT * FROM h1 WHERE NOT is_current
  UNION ALL
  SELECT d_key, d_id, d_name, d_nation, d_seg, d_eff, DATE '9999-12-31', TRUE FROM cls
   WHERE d_id IS NOT NULL AND NOT changed
  UNION ALL
  SELECT d_key, d_id, d_name, d_nation, d_seg, d_eff, DATE '{D2}', FALSE FROM cls WHERE changed
  UNION ALL
  SELECT (SELECT max(user_key) FROM h1) + CAST(row_number() OVER (ORDER BY s_id) AS BIGINT),
         s_id, s_name, s_nation, s_seg, DATE '{D2}', DATE '9999-12-31', TRUE
    FROM cls WHERE s_id IS NOT NULL AND (d_id IS NULL OR changed))"""
SNAP_ALL = "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer"
HIST_ALL = f"WITH snap1 AS ({SNAP_ALL}), snap2 AS ({SNAP2}), h1 AS ({H1}), {H2}"
HIST = f"WITH snap1 AS ({SNAP1}), snap2 AS ({SNAP2}), h1 AS ({H1}), {H2}"
SALES = ("sales AS (SELECT o_orderkey AS salesid, o_custkey AS buyerid, "
         "(o_custkey + 1) % (SELECT count(*) FROM customer) AS sellerid, "
         "CAST(substr(o_orderpriority, 1, 1) AS SMALLINT) AS qtysold, "
         "CAST(o_totalprice AS DECIMAL(12,2)) AS pricepaid, "
         "CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(0.15 AS DECIMAL(2,2)), 2) AS DECIMAL(12,2)) AS commission, "
         "o_orderdate AS saletime FROM orders)")


def _cover(alias, dim, col):
    return (f"JOIN {dim} {alias} ON {alias}.c_custkey = s.{col} AND {alias}.effective_date <= CAST(s.saletime AS DATE) "
            f"AND CAST(s.saletime AS DATE) < {alias}.expiry_date")


RESOLVED = (f"resolved AS (SELECT s.*, b.user_key AS buyer_key, se.user_key AS seller_key FROM sales s "
            f"{_cover('b', 'h2', 'buyerid')} {_cover('se', 'h2', 'sellerid')})")
EXISTING = (f"existing AS (SELECT s.*, b.user_key AS buyer_key, se.user_key AS seller_key FROM sales s "
            f"{_cover('b', 'h1', 'buyerid')} {_cover('se', 'h1', 'sellerid')} "
            f"WHERE s.saletime < TIMESTAMP '{EXB} 00:00:00')")
LEFT_RESOLVED = (f"lresolved AS (SELECT s.*, b.user_key AS buyer_key, se.user_key AS seller_key FROM sales s "
                 f"{_cover('b', 'h2', 'buyerid').replace('JOIN', 'LEFT JOIN', 1)} "
                 f"{_cover('se', 'h2', 'sellerid').replace('JOIN', 'LEFT JOIN', 1)})")

LINE_SALES = ("lsales AS (SELECT l_orderkey * 10 + l_linenumber AS salesid, l_partkey AS event_key, "
              "l_suppkey AS venue_key, CAST(l_quantity AS BIGINT) AS qtysold, "
              "CAST(l_extendedprice AS DECIMAL(12,2)) AS pricepaid, l_shipdate AS saletime, l_linestatus "
              "FROM lineitem)")
VENUE = ("venue AS (SELECT s.s_suppkey AS venue_key, s.s_name AS venuename, n.n_name AS venuecity, "
         "r.r_name AS venuestate FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey "
         "LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)")
PART = ("pev AS (SELECT p_partkey AS event_key, p_name AS eventname, p_brand AS catgroup, "
        "p_type AS catname FROM part)")
MEASURES = ("count(DISTINCT s.salesid) AS total_sales, CAST(sum(s.qtysold) AS BIGINT) AS total_tickets_sold, "
            "CAST(sum(s.pricepaid) AS DECIMAL(18,2)) AS total_revenue, "
            "CAST(sum(s.pricepaid) AS DOUBLE) / count(s.pricepaid) AS avg_sale_price")

CORRUPT = f"""{HIST},
bad AS (SELECT user_key, c_custkey, c_name, c_nationkey, c_mktsegment, effective_date,
  CASE WHEN NOT is_current AND c_mktsegment = 'BUILDING' THEN CAST(expiry_date - 1 AS DATE)
       WHEN NOT is_current AND c_mktsegment = 'MACHINERY' THEN CAST(expiry_date + 30 AS DATE)
       ELSE expiry_date END AS expiry_date,
  CASE WHEN is_current AND effective_date = DATE '{D2}' AND c_nationkey = 3 THEN FALSE ELSE is_current END AS is_current
  FROM h2)"""


def _guards(snap: str, load_date: str) -> str:
    """Violation rows of one users load against the day-2 history."""
    return f"""{HIST},
stage AS ({snap}),
wm AS (SELECT DISTINCT effective_date AS load_date FROM h2),
processed AS (SELECT count(*) > 0 AS p FROM wm WHERE load_date = DATE '{load_date}'),
hist AS (
  SELECT c_custkey, effective_date, expiry_date, is_current,
         lead(effective_date) OVER (PARTITION BY c_custkey ORDER BY effective_date) AS nxt,
         sum(CASE WHEN is_current THEN 1 ELSE 0 END) OVER (PARTITION BY c_custkey) AS ncur,
         row_number() OVER (PARTITION BY c_custkey ORDER BY effective_date) AS rn
  FROM h2),
cur AS (SELECT * FROM h2 WHERE is_current)
SELECT 10 AS priority, 'invalid_history' AS rule, 'users' AS dataset, CAST(c_custkey AS VARCHAR) AS key FROM hist
 WHERE (ncur <> 1 AND rn = 1) OR effective_date >= expiry_date
    OR (nxt IS NOT NULL AND (expiry_date <> nxt OR is_current))
    OR (nxt IS NULL AND (NOT is_current OR expiry_date <> DATE '9999-12-31'))
UNION ALL SELECT 20, 'out_of_order', 'users', NULL FROM wm WHERE load_date > DATE '{load_date}'
UNION ALL SELECT 20, 'out_of_order', 'users', CAST(c_custkey AS VARCHAR) FROM h2 WHERE effective_date > DATE '{load_date}'
UNION ALL SELECT 30, 'stage_key', 'users', CAST(c_custkey AS VARCHAR) FROM stage GROUP BY c_custkey
 HAVING count(*) > 1 OR c_custkey IS NULL
UNION ALL SELECT 31, 'same_day_new_key', 'users', CAST(s.c_custkey AS VARCHAR) FROM stage s
 WHERE (SELECT p FROM processed) AND NOT EXISTS (SELECT 1 FROM cur d WHERE d.c_custkey = s.c_custkey)
UNION ALL SELECT 32, 'same_day_changed', 'users', CAST(s.c_custkey AS VARCHAR) FROM stage s JOIN cur d
 ON d.c_custkey = s.c_custkey WHERE (d.effective_date >= DATE '{load_date}' OR (SELECT p FROM processed))
 AND {CHANGED}"""


def _ledger(floor: str = "") -> str:
    where = f"WHERE value >= {floor}" if floor else ""
    return f"""SELECT event_type || '-' || CAST(year(ts) * 10000 + month(ts) * 100 + dayofmonth(ts) AS VARCHAR) AS batch_id,
  CAST(ts AS DATE) AS load_date,
  sha256(CAST(sum(event_id) AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR)) AS input_sha,
  CASE WHEN min(value) < 0.5 THEN 'FAILED' ELSE 'QUEUED' END AS state,
  count(*) AS fence_epoch
FROM events {where} GROUP BY 1, 2"""


def _outputs(floor: str = "") -> str:
    where = f"WHERE value >= {floor}" if floor else ""
    names = ", ".join(f"'{n}'" for n in DATASETS)
    return f"""SELECT batch_id, dataset, bytes, n, 'batches/batch=' || batch_id || '/attempt=1/' || dataset || '/task=t/part-'
    || hour || '.parquet' AS key, sha256(CAST(bytes AS VARCHAR) || ':' || CAST(n AS VARCHAR)) AS sha
  FROM (SELECT 'day-' || strftime(ts, '%Y%m%d') AS batch_id, ([{names}])[CAST(event_id % 6 + 1 AS INT)] AS dataset,
          strftime(ts, '%H') AS hour, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS bytes
        FROM events {where} GROUP BY 1, 2, 3)"""


# ---- fixed values: credential patterns, same text as the Spark operator ----
from daymart.operators.audit import SECRET_ASSIGNMENT, SECRET_PATTERNS  # noqa: E402


def _sq(p: str) -> str:
    return p.replace("'", "''")


def _secret_sql() -> str:
    arms = []
    for cat, pat in SECRET_PATTERNS.items():
        arms.append(f"SELECT doc_id, line_no, '{cat}' AS category, "
                    f"CAST(len(regexp_extract_all(line, '{_sq(pat)}')) AS BIGINT) AS matches FROM lines")
    arms.append("SELECT doc_id, line_no, 'credential assignment', "
                f"CAST(CASE WHEN regexp_matches(line, '{_sq(SECRET_ASSIGNMENT)}') AND NOT starts_with("
                f"regexp_extract(line, '{_sq(SECRET_ASSIGNMENT)}', 1), 'REPLACE_WITH_') THEN 1 ELSE 0 END AS BIGINT) FROM lines")
    return ("WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), "
            "lines AS (SELECT doc_id, i AS line_no, ls[i] AS line FROM parts, "
            "generate_series(1, len(ls)) AS g(i)), "
            "hits AS (" + " UNION ALL ".join(arms) + ") "
            "SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, category, matches FROM hits WHERE matches > 0")


def _event_snapshot(day2: bool) -> str:
    start = "CAST(DATE '2008-01-01' + p_size AS TIMESTAMP) + INTERVAL 18 HOUR"
    if day2:
        start = f"CASE WHEN p_retailprice > 995 THEN {start} + INTERVAL 1 HOUR ELSE {start} END"
    name = "CASE WHEN s.s_acctbal > 9000 THEN s.s_name || ' (renamed)' ELSE s.s_name END" if day2 else "s.s_name"
    where = "p_retailprice >= 901" if day2 else "p_size < 50"
    return f"""SELECT CAST(p_partkey AS BIGINT) AS eventid, CAST(p_size AS BIGINT) AS venueid,
  CAST(substr(p_brand, 7, 3) AS BIGINT) AS catid, CAST(p_size + 1827 AS INTEGER) AS dateid, p_name AS eventname,
  {start} AS starttime, {name} AS venuename, CAST(s.s_nationkey AS VARCHAR) AS venuecity,
  CASE WHEN s.s_suppkey IS NULL THEN NULL ELSE 'TX' END AS venuestate,
  CASE WHEN s.s_suppkey IS NULL THEN NULL ELSE CAST(trunc(greatest(s.s_acctbal, 0.0)) AS INTEGER) END AS venueseats,
  upper(n.n_name) AS catgroup, n.n_name AS catname, 'Nation ' || n.n_name AS catdesc
FROM part p LEFT JOIN supplier s ON CAST(p.p_size AS BIGINT) = s.s_suppkey
LEFT JOIN nation n ON CAST(substr(p.p_brand, 7, 3) AS BIGINT) = n.n_nationkey WHERE {where}"""


EV_ATTRS = ['venueid', 'catid', 'dateid', 'eventname', 'starttime', 'venuename', 'venuecity', 'venuestate', 'venueseats', 'catgroup', 'catname', 'catdesc']
EV_COLS = ", ".join(EV_ATTRS)
EV_CHANGED = " OR ".join(f"d.{a} IS DISTINCT FROM s.{a}" for a in EV_ATTRS)
EV_HIST = f"""WITH e1 AS ({_event_snapshot(False)}), e2 AS ({_event_snapshot(True)}),
h1 AS (SELECT CAST(row_number() OVER (ORDER BY eventid) AS BIGINT) AS event_key, eventid, {EV_COLS},
  DATE '{D1}' AS effective_date, DATE '9999-12-31' AS expiry_date, TRUE AS is_current FROM e1),
c AS (SELECT d.event_key AS d_key, d.eventid AS d_id, s.eventid AS s_id,
  (d.eventid IS NOT NULL AND s.eventid IS NOT NULL AND ({EV_CHANGED})) AS changed
  FROM (SELECT * FROM h1 WHERE is_current) d FULL OUTER JOIN e2 s ON d.eventid = s.eventid),
h2 AS (
  SELECT * FROM h1 WHERE NOT is_current
  UNION ALL SELECT h1.* FROM h1 JOIN c ON h1.event_key = c.d_key WHERE NOT c.changed
  UNION ALL SELECT h1.event_key, h1.eventid, {", ".join("h1." + a for a in EV_ATTRS)}, h1.effective_date,
    DATE '{D2}', FALSE FROM h1 JOIN c ON h1.event_key = c.d_key WHERE c.changed
  UNION ALL SELECT (SELECT max(event_key) FROM h1) + CAST(row_number() OVER (ORDER BY e2.eventid) AS BIGINT),
    e2.eventid, {", ".join("e2." + a for a in EV_ATTRS)}, DATE '{D2}', DATE '9999-12-31', TRUE
    FROM e2 JOIN c ON e2.eventid = c.s_id WHERE c.d_id IS NULL OR c.changed)
SELECT * FROM h2"""

RAW_SALES = """raw AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS salesid FROM lineitem)"""

ORACLE = {
    "scd2_event_dim": EV_HIST,
    "clean_event": """WITH v AS (
  SELECT s_suppkey, s_name AS venuename, s_acctbal, 0 AS delivery FROM supplier
  UNION ALL SELECT s_suppkey, s_name || '   (renamed)', s_acctbal, 1 FROM supplier WHERE s_acctbal > 9000),
venue AS (SELECT CAST(s_suppkey AS BIGINT) AS venueid, venuename, 'Metropolis' AS venuecity,
    CASE WHEN s_acctbal > 5000 THEN 'TX' END AS venuestate,
    CASE WHEN s_acctbal < 0 THEN 0 ELSE CAST(trunc(s_acctbal) AS INTEGER) END AS venueseats
  FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY delivery DESC) AS rn FROM v) WHERE rn = 1),
cat AS (SELECT CAST(n_nationkey AS BIGINT) AS catid, upper(n_name) AS catgroup, n_name AS catname,
    'Nation ' || n_name AS catdesc FROM nation),
ev AS (SELECT CAST(p_partkey AS BIGINT) AS eventid, CAST(p_size AS BIGINT) AS venueid,
    CASE WHEN p_retailprice > 990 THEN NULL ELSE CAST(substr(p_brand, 7, 3) AS BIGINT) END AS catid,
    CAST(1827 + p_size AS INTEGER) AS dateid, p_name AS eventname,
    CASE WHEN p_retailprice < 905 THEN NULL
         ELSE CAST(DATE '2008-01-01' + p_size AS TIMESTAMP) + INTERVAL 18 HOUR END AS starttime
  FROM part)
SELECT ev.eventid, ev.venueid, ev.catid, ev.dateid, ev.eventname, ev.starttime, venue.venuename, venue.venuecity,
  venue.venuestate, venue.venueseats, cat.catgroup, cat.catname, cat.catdesc
FROM ev LEFT JOIN venue ON ev.venueid = venue.venueid LEFT JOIN cat ON ev.catid = cat.catid""",
    "receipt_status": f"""WITH req AS ({_ledger('1.0')}), com AS (SELECT * FROM ({_ledger()})
  WHERE starts_with(batch_id, 'purchase-') OR starts_with(batch_id, 'view-'))
SELECT r.batch_id, CASE WHEN c.input_sha IS NULL THEN 'new' WHEN c.input_sha = r.input_sha THEN 'duplicate'
  ELSE 'conflict' END AS status FROM req r LEFT JOIN com c ON r.batch_id = c.batch_id""",
    "stage_key_violations": f"WITH {RAW_SALES} SELECT salesid, count(*) AS n FROM raw GROUP BY salesid "
                            "HAVING count(*) > 1 OR salesid IS NULL",
    "fact_not_null": f"""{HIST}, {SALES}, {LEFT_RESOLVED},
c AS (SELECT 'salesid' AS "column", count(*) FILTER (WHERE salesid IS NULL) AS n FROM lresolved
  UNION ALL SELECT 'buyer_key', count(*) FILTER (WHERE buyer_key IS NULL) FROM lresolved
  UNION ALL SELECT 'seller_key', count(*) FILTER (WHERE seller_key IS NULL) FROM lresolved
  UNION ALL SELECT 'saletime', count(*) FILTER (WHERE saletime IS NULL) FROM lresolved)
SELECT 'fact_sales' AS "table", "column", n FROM c WHERE n > 0""",
    "v_venue": f"WITH {LINE_SALES}, {VENUE} SELECT v.venuename, v.venuecity, v.venuestate, {MEASURES} "
               "FROM lsales s JOIN venue v ON s.venue_key = v.venue_key GROUP BY 1, 2, 3",
    "v_top_events": f"WITH {LINE_SALES}, {VENUE}, {PART} SELECT p.eventname, p.catname, v.venuename, v.venuecity, "
                    f"{MEASURES} FROM lsales s JOIN pev p ON s.event_key = p.event_key "
                    "JOIN venue v ON s.venue_key = v.venue_key GROUP BY 1, 2, 3, 4",
    "v_category": f"WITH {LINE_SALES}, {PART} SELECT p.catgroup, p.catname, {MEASURES} FROM lsales s "
                  "JOIN pev p ON s.event_key = p.event_key GROUP BY 1, 2",
    "v_monthly": f"WITH {LINE_SALES} SELECT CAST(year(s.saletime) AS SMALLINT) AS year, "
                 "CAST(month(s.saletime) AS INTEGER) AS month_num, strftime(s.saletime, '%b') AS month_name, "
                 f"{MEASURES} FROM lsales s WHERE s.saletime IS NOT NULL GROUP BY 1, 2, 3",
    "v_seller": f"{HIST_ALL}, {SALES}, {RESOLVED} SELECT u.c_name AS username, u.c_name || ' ' || u.c_mktsegment "
                "AS seller_name, u.c_nationkey, count(DISTINCT s.salesid) AS total_sales, "
                "CAST(sum(s.qtysold) AS BIGINT) AS total_tickets_sold, "
                "CAST(sum(s.pricepaid) AS DECIMAL(18,2)) AS total_revenue, "
                "CAST(sum(s.commission) AS DECIMAL(18,2)) AS total_commission_paid "
                "FROM resolved s JOIN h2 u ON s.seller_key = u.user_key "
                "GROUP BY u.c_name, u.c_mktsegment, u.c_nationkey",
    "top_buyers": f"{HIST_ALL}, {SALES}, {RESOLVED} SELECT u.c_custkey AS userid, u.c_name AS username, "
                  "count(DISTINCT s.salesid) AS total_sales, CAST(sum(s.qtysold) AS BIGINT) AS total_tickets_sold, "
                  "CAST(sum(s.pricepaid) AS DECIMAL(18,2)) AS total_revenue "
                  "FROM resolved s JOIN h2 u ON s.buyer_key = u.user_key GROUP BY 1, 2 "
                  f"ORDER BY total_revenue DESC, userid LIMIT {tpch.TOP_N}",
    "listed_vs_sold": f"WITH {LINE_SALES}, "
                      "l AS (SELECT event_key AS eventid, count(DISTINCT salesid) AS listings, "
                      "CAST(sum(qtysold) AS BIGINT) AS tickets_listed FROM lsales GROUP BY 1), "
                      "s AS (SELECT event_key AS eventid, count(DISTINCT salesid) AS total_sales, "
                      "CAST(sum(qtysold) AS BIGINT) AS tickets_sold, CAST(sum(pricepaid) AS DECIMAL(18,2)) AS total_revenue "
                      "FROM lsales WHERE l_linestatus = 'F' GROUP BY 1) "
                      "SELECT coalesce(l.eventid, s.eventid) AS eventid, coalesce(l.listings, 0) AS listings, "
                      "coalesce(l.tickets_listed, 0) AS tickets_listed, coalesce(s.total_sales, 0) AS total_sales, "
                      "coalesce(s.tickets_sold, 0) AS tickets_sold, "
                      "coalesce(s.total_revenue, CAST(0 AS DECIMAL(18,2))) AS total_revenue "
                      "FROM l FULL JOIN s ON l.eventid = s.eventid",
    "denormalise_star": "SELECT l.*, p.p_name, p.p_brand, s.s_name FROM lineitem l "
                        "LEFT JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey",
    "dedup_latest": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
                    "l_tax, l_returnflag, l_linestatus, l_shipdate FROM (SELECT *, row_number() OVER (PARTITION BY "
                    "l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, "
                    "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1",
    "dedup_last_position": "SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER "
                           "(PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1",
    "scd2_day1": f"WITH snap1 AS ({SNAP1}), h1 AS ({H1}) SELECT * FROM h1",
    "scd2_day2": f"{HIST} SELECT * FROM h2",
    "scd2_replay": f"{HIST} SELECT * FROM h2",
    "scd2_changed_keys": f"{HIST} SELECT d_id AS c_custkey, d_name IS DISTINCT FROM s_name AS c_name_changed, "
                         "d_nation IS DISTINCT FROM s_nation AS c_nationkey_changed, "
                         "d_seg IS DISTINCT FROM s_seg AS c_mktsegment_changed FROM cls WHERE changed",
    "scd2_guard_same_day": _guards(SNAP1, D2),
    "scd2_guard_out_of_order": _guards(SNAP2, EARLY),
    "history_violations": f"""{CORRUPT},
hist AS (SELECT c_custkey, effective_date, expiry_date, is_current,
  lead(effective_date) OVER (PARTITION BY c_custkey ORDER BY effective_date) AS nxt,
  sum(CASE WHEN is_current THEN 1 ELSE 0 END) OVER (PARTITION BY c_custkey) AS ncur,
  row_number() OVER (PARTITION BY c_custkey ORDER BY effective_date) AS rn FROM bad)
SELECT c_custkey, effective_date, 'current_count' AS rule FROM hist WHERE ncur <> 1 AND rn = 1
UNION ALL SELECT c_custkey, effective_date, 'invalid_range' FROM hist WHERE effective_date >= expiry_date
UNION ALL SELECT c_custkey, effective_date, 'gap_or_overlap' FROM hist WHERE nxt IS NOT NULL AND expiry_date <> nxt
UNION ALL SELECT c_custkey, effective_date, 'closed_is_current' FROM hist WHERE nxt IS NOT NULL AND is_current
UNION ALL SELECT c_custkey, effective_date, 'open_end' FROM hist
 WHERE nxt IS NULL AND (NOT is_current OR expiry_date <> DATE '9999-12-31')""",
    "interval_overlaps": f"""{CORRUPT}
SELECT DISTINCT b.c_custkey, b.user_key, b.effective_date FROM bad a JOIN bad b ON a.c_custkey = b.c_custkey
 AND (a.effective_date < b.effective_date OR (a.effective_date = b.effective_date AND a.user_key < b.user_key))
 AND b.effective_date < a.expiry_date""",
    "dim_integrity": f"{HIST} SELECT count(*) AS total_rows, CAST(sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS BIGINT) "
                     "AS current_rows, count(DISTINCT CASE WHEN is_current THEN c_custkey END) AS distinct_current_keys, "
                     "count(*) FILTER (WHERE c_custkey IS NULL) AS null_keys FROM h2",
    "null_audit": f"{HIST} SELECT count(*) AS total_rows, count(*) - count(c_name) AS null_c_name, "
                  "count(*) - count(c_nationkey) AS null_c_nationkey, count(*) - count(c_mktsegment) AS null_c_mktsegment FROM h2",
    "dup_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "stage_counts": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                                       for t in tpch.TABLES),
    "fact_resolve": f"{HIST_ALL}, {SALES}, {RESOLVED} SELECT salesid, buyer_key, seller_key, saletime, qtysold, "
                    "pricepaid, commission FROM resolved",
    "fact_coverage": f"""{HIST}, {SALES}, {EXISTING},
stage AS (SELECT * FROM sales s WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.salesid = s.salesid)),
r AS (SELECT s.*, b.user_key AS buyer_key, se.user_key AS seller_key FROM stage s
  LEFT JOIN h2 b ON b.c_custkey = s.buyerid AND b.effective_date <= CAST(s.saletime AS DATE) AND CAST(s.saletime AS DATE) < b.expiry_date
  LEFT JOIN h2 se ON se.c_custkey = s.sellerid AND se.effective_date <= CAST(s.saletime AS DATE) AND CAST(s.saletime AS DATE) < se.expiry_date)
SELECT count(*) AS new_facts, count(*) FILTER (WHERE saletime IS NULL) AS null_time,
  count(*) FILTER (WHERE CAST(saletime AS DATE) > DATE '{FLD}') AS after_load_date,
  count(*) FILTER (WHERE buyer_key IS NULL) AS missing_buyer_key,
  count(*) FILTER (WHERE seller_key IS NULL) AS missing_seller_key,
  count(*) FILTER (WHERE saletime IS NULL OR CAST(saletime AS DATE) > DATE '{FLD}' OR buyer_key IS NULL OR seller_key IS NULL) AS bad
FROM r""",
    "fact_append_idempotent": f"""{HIST_ALL}, {SALES}, {EXISTING}, {LEFT_RESOLVED}
SELECT salesid, buyer_key, seller_key, saletime FROM existing
UNION ALL
SELECT salesid, buyer_key, seller_key, saletime FROM lresolved r
 WHERE CAST(saletime AS DATE) <= DATE '{FLD}' AND buyer_key IS NOT NULL AND seller_key IS NOT NULL
   AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.salesid = r.salesid)""",
    "fact_temporal_audit": f"""{HIST}, {SALES},
f AS (SELECT s.salesid, s.saletime, b.user_key AS buyer_key, se.user_key AS seller_key FROM sales s
  JOIN h2 b ON b.c_custkey = s.buyerid AND b.is_current JOIN h2 se ON se.c_custkey = s.sellerid AND se.is_current),
a AS (
  SELECT f.salesid, 'buyer' AS role, CASE WHEN v.user_key IS NULL THEN 'missing_version'
    WHEN f.saletime IS NULL THEN 'null_time'
    WHEN CAST(f.saletime AS DATE) < v.effective_date OR CAST(f.saletime AS DATE) >= v.expiry_date THEN 'outside_interval' END AS reason
  FROM f LEFT JOIN h2 v ON f.buyer_key = v.user_key
  UNION ALL
  SELECT f.salesid, 'seller', CASE WHEN v.user_key IS NULL THEN 'missing_version'
    WHEN f.saletime IS NULL THEN 'null_time'
    WHEN CAST(f.saletime AS DATE) < v.effective_date OR CAST(f.saletime AS DATE) >= v.expiry_date THEN 'outside_interval' END
  FROM f LEFT JOIN h2 v ON f.seller_key = v.user_key)
SELECT * FROM a WHERE reason IS NOT NULL""",
    "calendar": """WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
ids AS (SELECT CAST(i AS INTEGER) AS dateid FROM b, generate_series(CAST(lo - DATE '2003-01-01' AS BIGINT) + 1,
  CAST(hi - DATE '2003-01-01' AS BIGINT) + 1) AS g(i)),
d AS (SELECT dateid, CAST(DATE '2003-01-01' + (dateid - 1) AS DATE) AS caldate FROM ids)
SELECT dateid, caldate, strftime(caldate, '%a') AS day, CAST(week(caldate) AS SMALLINT) AS week,
  strftime(caldate, '%b') AS month, CAST(quarter(caldate) AS VARCHAR) AS qtr, CAST(year(caldate) AS SMALLINT) AS year,
  FALSE AS holiday FROM d""",
    "manifest_rows": "SELECT event_type, count(*) AS n_events, "
                     "sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS declared_rows FROM events GROUP BY 1",
    "output_shas": f"""WITH f AS ({_outputs()}), doc AS (SELECT *, '{{"bytes":' || CAST(bytes AS VARCHAR) || ',"dataset":"' || dataset
    || '","key":"' || key || '","rows":' || CAST(n AS VARCHAR) || ',"sha256":"' || sha || '","task":"t"}}' AS j FROM f)
SELECT batch_id, dataset, count(*) AS files, CAST(sum(n) AS BIGINT) AS rows, sha256(string_agg(j, chr(10) ORDER BY j)) AS sha
FROM doc GROUP BY 1, 2""",
    "output_row_faults": f"""WITH f AS (SELECT batch_id, dataset, CAST(sum(n) AS BIGINT) AS rows FROM ({_outputs()}) GROUP BY 1, 2),
g AS (SELECT batch_id, dataset, CAST(sum(n) AS BIGINT) AS declared FROM ({_outputs('1.0')}) GROUP BY 1, 2)
SELECT batch_id, dataset, rows, declared, CASE WHEN rows IS NULL THEN 'missing_dataset'
  WHEN declared IS NULL THEN 'unexpected_dataset' ELSE 'row_count' END AS rule
FROM f FULL JOIN g USING (batch_id, dataset) WHERE rows IS DISTINCT FROM declared""",
    "secret_findings": _secret_sql(),
    "pending_batches": f"SELECT batch_id, load_date, input_sha FROM ({_ledger()}) WHERE state = 'QUEUED' "
                       f"ORDER BY load_date, batch_id LIMIT {tpch.PENDING_N}",
    "batch_conflicts": f"SELECT i.batch_id, l.input_sha AS registered_sha, i.input_sha AS incoming_sha "
                       f"FROM ({_ledger('1.0')}) i JOIN ({_ledger()}) l ON i.batch_id = l.batch_id "
                       "WHERE i.input_sha <> l.input_sha",
    "stale_epochs": f"WITH led AS ({_ledger()}) SELECT batch_id, fence_epoch FROM led "
                    "WHERE NOT starts_with(batch_id, 'purchase-') AND fence_epoch < "
                    "(SELECT coalesce(max(fence_epoch), 0) FROM led WHERE starts_with(batch_id, 'purchase-'))",
    "time_gate_violations": "SELECT event_id AS key, 'null_ts' AS rule FROM events WHERE event_type = 'error'",
    "clean_sales": """WITH raw AS (SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS salesid,
  CAST(l_orderkey AS BIGINT) AS listid, CAST(l_suppkey AS BIGINT) AS sellerid, CAST(l_partkey AS BIGINT) AS buyerid,
  CAST(l_partkey AS BIGINT) AS eventid, CAST(CAST(l_shipdate AS DATE) - DATE '2003-01-01' + 1 AS INTEGER) AS dateid,
  CAST(CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity - 3 END AS SMALLINT) AS qtysold,
  CAST(CASE WHEN l_discount = 0 THEN NULL ELSE round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.1 AS DECIMAL(1,1)), 2) END AS DECIMAL(8,2)) AS pricepaid,
  CAST(CASE WHEN l_tax = 0 THEN NULL ELSE round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) * CAST(0.1 AS DECIMAL(1,1)), 2) END AS DECIMAL(8,2)) AS commission,
  l_shipdate AS saletime, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem),
f AS (SELECT * FROM raw WHERE salesid IS NOT NULL AND (qtysold IS NULL OR qtysold >= 1))
SELECT salesid, listid, sellerid, buyerid, eventid, dateid, qtysold,
  coalesce(pricepaid, CAST(0 AS DECIMAL(8,2))) AS pricepaid, coalesce(commission, CAST(0 AS DECIMAL(8,2))) AS commission, saletime
FROM (SELECT *, row_number() OVER (PARTITION BY salesid ORDER BY saletime DESC NULLS LAST, l_orderkey, l_linenumber,
  l_partkey, l_suppkey) AS rn FROM f) WHERE rn = 1""",
    "clean_users": """WITH raw AS (SELECT c_custkey,
  CAST(trunc(CAST(trim(CAST(c_custkey AS VARCHAR) || CASE WHEN c_acctbal < 0 THEN '.7' ELSE '' END) AS DOUBLE)) AS INTEGER) AS userid,
  c_name, c_mktsegment, c_nationkey, c_acctbal FROM customer),
tok AS (SELECT *, ['T', 'no', ' yes ', '0', 'maybe', 'F', '1', 'TRUE', 'false', ''] AS toks FROM raw)
SELECT userid, trim(c_name) AS username, c_mktsegment AS firstname, CAST(c_nationkey AS VARCHAR) AS lastname,
  'Springfield' AS city,
  CASE WHEN length(upper(trim(CASE WHEN c_acctbal > 5000 THEN lower(substr(c_mktsegment, 1, 2)) ELSE c_mktsegment END))) = 2
       THEN upper(trim(CASE WHEN c_acctbal > 5000 THEN lower(substr(c_mktsegment, 1, 2)) ELSE c_mktsegment END)) END AS state,
  lower(trim(' ' || upper(c_name) || '@EXAMPLE.COM ')) AS email, '555-0100' AS phone,
""" + ",\n".join(
        f"  CASE upper(trim(toks[((c_nationkey + {i}) % 10) + 1])) WHEN 'TRUE' THEN TRUE WHEN 'T' THEN TRUE "
        f"WHEN '1' THEN TRUE WHEN 'YES' THEN TRUE WHEN 'FALSE' THEN FALSE WHEN 'F' THEN FALSE WHEN '0' THEN FALSE "
        f"WHEN 'NO' THEN FALSE END AS {b}" for i, b in enumerate(
            ("likesports", "liketheatre", "likeconcerts", "likejazz", "likeclassical",
             "likeopera", "likerock", "likevegas", "likebroadway", "likemusicals"))) + """
FROM (SELECT *, row_number() OVER (PARTITION BY userid ORDER BY c_custkey DESC) AS rn FROM tok) WHERE rn = 1""",
    "clean_venue": """SELECT CAST(s_suppkey AS BIGINT) AS venueid, s_name AS venuename, 'Metropolis' AS venuecity,
  CASE WHEN s_acctbal > 5000 THEN 'TX' WHEN s_acctbal > 0 THEN '' ELSE '' END AS venuestate,
  CASE WHEN s_acctbal < 0 THEN 0 ELSE CAST(trunc(s_acctbal) AS INTEGER) END AS venueseats
FROM supplier""",
}

ORACLE["v_category_merged"] = ORACLE["v_category"]
ORACLE["v_monthly_merged"] = ORACLE["v_monthly"]
