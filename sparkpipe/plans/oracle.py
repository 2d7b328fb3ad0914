"""SQL giving the same rows as the registered queries, from the same tables."""

from __future__ import annotations

from sparkpipe.operators.metrics import BOUNDARIES

_CODE = "CASE event_id % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END"
_TIME = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"

_TXN = f"""
txn AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id, ts AS "timestamp",
    CAST(user_id AS VARCHAR) AS account_id,
    CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN CAST(0 AS DOUBLE) ELSE value END AS amount,
    ' ' || lower({_CODE}) || ' ' AS currency,
    event_type AS transaction_type,
    CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'M' || user_id
      ELSE CAST(user_id AS VARCHAR) END AS merchant_id,
    CASE WHEN event_id % 4 <> 0 THEN event_type END AS category
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 17 = 0))"""

_LOOKUP = """
lookup AS (
  SELECT CAST(c_custkey AS VARCHAR) AS merchant_id, c_mktsegment AS category
  FROM customer)"""

_CURATED = f"""{_TXN},{_LOOKUP},
curated AS (
  SELECT DISTINCT t.transaction_id, t."timestamp", sha256(t.account_id) AS hashed_account_id,
    coalesce(t.amount, 0) AS amount, trim(upper(t.currency)) AS currency, t.transaction_type,
    t.merchant_id, coalesce(l.category, t.category) AS category,
    coalesce(t.amount, 0) = 0 AS is_amount_zero_flag
  FROM txn t LEFT JOIN lookup l ON t.merchant_id = l.merchant_id)"""

_CLEANSED = """
  SELECT *, coalesce(amount, 0) AS amount_clean, trim(upper(currency)) AS currency_clean,
    coalesce(amount, 0) = 0 AS is_amount_zero_flag
  FROM txn"""

_ENRICHED = f"""
  WITH {_TXN},{_LOOKUP}
  SELECT t.*, coalesce(l.category, t.category) AS enriched_category
  FROM txn t LEFT JOIN lookup l ON t.merchant_id = l.merchant_id"""

# The contract asks for an amount above zero, which a few event values are not.
_ROUTE = """CASE WHEN event_id % 50 IN (0, 3, 10) THEN 'malformed'
  WHEN event_id % 50 IN (1, 2, 4, 5, 7, 8, 9) OR value <= 0 THEN 'dlq' ELSE 'curated' END"""

_REASONS = """concat_ws(',',
  CASE WHEN event_id % 50 IN (0, 2, 3, 10) THEN 'transaction_id:required' END,
  CASE WHEN event_id % 50 IN (0, 10) THEN 'timestamp:required' END,
  CASE WHEN event_id % 50 IN (0, 3, 10) THEN 'account_id:required'
    WHEN event_id % 50 IN (7, 8, 9) THEN 'account_id:type' END,
  CASE WHEN event_id % 50 IN (0, 3, 10) THEN 'amount:required' WHEN event_id % 50 = 1 THEN 'amount:type'
    WHEN event_id % 50 = 4 OR value <= 0 THEN 'amount:gt' END,
  CASE WHEN event_id % 50 IN (0, 3, 10) THEN 'currency:required'
    WHEN event_id % 50 = 5 THEN 'currency:max_length' END,
  CASE WHEN event_id % 50 IN (0, 3, 10) THEN 'transaction_type:required' END)"""


def _decoded(lenient: bool) -> str:
    """The lenient reading takes single quotes, and anything as text; the strict one
    takes a number in quotes."""
    there = f"event_id % 50 NOT IN ({'0, 3' if lenient else '0, 3, 10'})"
    no_amount = "0, 1, 3, 6" if lenient else "0, 1, 3, 10"
    amount = f"""CASE WHEN event_id % 50 IN ({no_amount}) THEN NULL
      WHEN event_id % 50 = 4 THEN -1 ELSE value END"""
    odd = ("'5'", "'true'", "'{\"x\":1}'") if lenient else ("NULL",) * 3
    return f"""
    CASE WHEN {there} AND event_id % 50 <> 2 THEN CAST(event_id AS VARCHAR) END AS transaction_id,
    CASE WHEN {there} OR event_id % 50 = 3 THEN ts END AS "timestamp",
    CASE event_id % 50 WHEN 7 THEN {odd[0]} WHEN 8 THEN {odd[1]} WHEN 9 THEN {odd[2]}
      ELSE CASE WHEN {there} THEN CAST(user_id AS VARCHAR) END END AS account_id,
    {amount} AS amount,
    CASE WHEN event_id % 50 = 5 THEN 'USDX' WHEN {there} THEN {_CODE} END AS currency,
    CASE WHEN {there} THEN event_type END AS transaction_type,
    CASE WHEN {there} THEN CAST(user_id AS VARCHAR) END AS merchant_id,
    CASE WHEN event_id % 50 = 12 THEN 'gift' END AS category,
    CASE WHEN event_id % 50 = 12 THEN true END AS is_flagged"""


_CLAIM = """CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS claim_id,
    CAST(l_partkey AS VARCHAR) AS policy_id, l_shipdate AS claim_date, l_linestatus AS status,
    l_returnflag AS claim_type, l_shipdate AS incident_date, CAST(l_suppkey AS VARCHAR) AS vehicle_vin"""

_DAMAGES = f"""
  SELECT {_CLAIM}, 'body' AS damage_part, l_extendedprice AS damage_amount
  FROM lineitem WHERE l_quantity > 10
  UNION ALL
  SELECT {_CLAIM}, 'glass', l_extendedprice * l_discount
  FROM lineitem WHERE l_quantity > 1 AND l_discount > 0
  UNION ALL
  SELECT {_CLAIM}, 'paint', l_extendedprice * l_tax
  FROM lineitem WHERE l_quantity > 1 AND l_tax > 0"""


def _address(kind: str, condition: str) -> str:
    return f"""
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
    lower(c_name) || '@example.org' AS email, '555-' || CAST(c_custkey AS VARCHAR) AS phone,
    CAST(c_custkey AS VARCHAR) || ' Main St' AS address_street,
    'City ' || CAST(c_nationkey AS VARCHAR) AS address_city,
    lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS address_zip, '{kind}' AS address_type
  FROM customer WHERE {condition}"""


_PROFILES = f"{_address('home', 'c_acctbal >= 0')} UNION ALL {_address('billing', 'c_acctbal > 5000')}"

_ORDER = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

_UPDATES = f"""
updates AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
    '5-LOW' AS o_orderpriority
  FROM orders WHERE o_orderstatus = 'P'
  UNION ALL
  SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderpriority = '1-URGENT')"""

_UPSERTED = f"""{_UPDATES},
upserted AS (
  SELECT {_ORDER} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM updates)
  UNION ALL SELECT {_ORDER} FROM updates)"""

_MERGE_FEED = f"""
  SELECT o.*, 'update_preimage' AS _change_type
  FROM orders o JOIN updates u ON o.o_orderkey = u.o_orderkey
  UNION ALL
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, u.o_totalprice, o.o_orderdate,
    u.o_orderpriority, 'update_postimage'
  FROM orders o JOIN updates u ON o.o_orderkey = u.o_orderkey
  UNION ALL
  SELECT u.*, 'insert' FROM updates u
  WHERE u.o_orderkey NOT IN (SELECT o_orderkey FROM orders)"""

_MERGED = f"""
  WITH {_UPDATES}
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus,
    coalesce(u.o_totalprice, o.o_totalprice) AS o_totalprice, o.o_orderdate,
    coalesce(u.o_orderpriority, o.o_orderpriority) AS o_orderpriority
  FROM orders o LEFT JOIN updates u ON o.o_orderkey = u.o_orderkey
  UNION ALL
  SELECT {_ORDER} FROM updates WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)"""

_CHANGED = " OR ".join(
    f"b.{c} IS DISTINCT FROM a.{c}"
    for c in ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
)

_STATES = f"""{_UPSERTED},
s0 AS (SELECT * FROM orders WHERE o_orderpriority <> '1-URGENT'),
s1 AS (SELECT * FROM upserted),
s2 AS (SELECT * FROM upserted WHERE o_orderstatus <> 'F'),
s3 AS (SELECT * FROM orders)"""


def _between(version: int) -> str:
    b, a = f"s{version - 1} b", f"s{version} a"
    v = f"CAST({version} AS BIGINT) AS _commit_version"
    return f"""
      SELECT b.*, 'delete' AS _change_type, {v} FROM {b} ANTI JOIN {a} USING (o_orderkey)
      UNION ALL SELECT a.*, 'insert', {v} FROM {a} ANTI JOIN {b} USING (o_orderkey)
      UNION ALL SELECT b.*, 'update_preimage', {v} FROM {b} JOIN {a} ON b.o_orderkey = a.o_orderkey WHERE {_CHANGED}
      UNION ALL SELECT a.*, 'update_postimage', {v} FROM {b} JOIN {a} ON b.o_orderkey = a.o_orderkey WHERE {_CHANGED}"""


_BUCKET = " + ".join(f"CAST(amount > CAST({b} AS DOUBLE) AS INTEGER)" for b in BOUNDARIES)
_UPPER = " ".join(f"WHEN {i} THEN CAST({b} AS DOUBLE)" for i, b in enumerate(BOUNDARIES))

_LATER = """
later AS (
  SELECT event_id, ts, user_id, CASE WHEN event_id % 9 = 0 THEN 'view' ELSE event_type END AS event_type,
    CASE WHEN event_id % 5 = 0 THEN value / 2 ELSE value END AS value, props
  FROM events WHERE coalesce(event_id % 7 <> 0 AND value < 200, true)
  UNION ALL
  SELECT event_id + 1000000000, ts, user_id, event_type, value, props FROM events WHERE event_id % 6 = 0)"""

_HISTORY = """
WITH history AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS TIMESTAMP) AS valid_from,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 90 DAY END AS valid_to
  FROM orders
), changes AS (
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 4 <> 2 THEN o_totalprice + n ELSE o_totalprice END AS o_totalprice,
    CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_orderkey % 60 - 20
      + CASE WHEN o_orderkey % 12 = 0 THEN 0 ELSE n * 50 END AS INTEGER)) AS on_time,
    o_orderkey % 5 = 0 AND n = 2 AS gone
  FROM orders, range(1, 3) AS r(n) WHERE o_orderkey % 4 <> 3
), events AS (
  SELECT o_orderkey, valid_from AS on_time, o_orderstatus, o_totalprice, false AS gone, 1 AS lvl FROM history
  UNION ALL SELECT o_orderkey, valid_to, NULL, NULL, true, 0 FROM history WHERE valid_to IS NOT NULL
  UNION ALL SELECT o_orderkey, on_time, o_orderstatus, o_totalprice, gone, 2 FROM changes
), once AS (
  SELECT * FROM events
  QUALIFY row_number() OVER (PARTITION BY o_orderkey, on_time ORDER BY lvl DESC, gone DESC, o_totalprice DESC) = 1
), told AS (
  SELECT *, lag(struct_pack(g := gone, s := o_orderstatus, p := o_totalprice)) OVER (
    PARTITION BY o_orderkey ORDER BY on_time) AS before
  FROM once
), apart AS (
  SELECT * FROM told WHERE before IS NULL OR before.g <> gone
    OR (NOT gone AND (before.s IS DISTINCT FROM o_orderstatus OR before.p IS DISTINCT FROM o_totalprice))
), dated AS (
  SELECT *, lead(on_time) OVER (PARTITION BY o_orderkey ORDER BY on_time) AS valid_to FROM apart
)
SELECT o_orderkey, o_orderstatus, o_totalprice, on_time AS valid_from, valid_to FROM dated WHERE NOT gone"""

_RULES = {
    "transaction_id_present": "transaction_id IS NOT NULL",
    "amount_not_negative": "amount >= 0",
    "amount_not_zero": "NOT is_amount_zero_flag",
    "currency_is_code": "regexp_full_match(currency, '[A-Z]{3}')",
    "account_masked": "length(hashed_account_id) = 64",
    "category_present": "category IS NOT NULL",
}


def _rule(name: str, condition: str) -> str:
    failed = f"count(*) FILTER (WHERE NOT coalesce({condition}, false))"
    return f"SELECT '{name}' AS rule, {failed} AS failed, count(*) AS total, {failed} = 0 AS passed FROM curated"


_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _profile(table: str, named: bool) -> str:
    selects = []
    for position, column in enumerate(_TABLES[table].split(", ")):
        name, kind = column.split(" ")
        zero = " + 0" if kind == "double" else ""
        low, high = (
            ("NULL", "NULL")
            if kind.startswith("array")
            else (f"min({name}){zero}", f"max({name}){zero}")
        )
        selects.append(f"""
  SELECT {f"'{table}' AS table_name, " if named else ""}{position} AS position,
    '{name}' AS column_name, '{kind}' AS column_type,
    count(*) AS total, count(*) - count({name}) AS nulls,
    CAST({low} AS VARCHAR) AS low, CAST({high} AS VARCHAR) AS high
  FROM {table}""")
    return " UNION ALL ".join(selects)


_VALUE = f"""CASE WHEN event_id % 50 = 0 THEN 'not json'
  WHEN event_id % 50 = 3 THEN '{{"bad_field": "not a real transaction", "timestamp": "' || {_TIME.format("ts")} || '"}}'
  ELSE '{{' || CASE WHEN event_id % 50 = 2 THEN '' ELSE '"transaction_id": "' || event_id || '", ' END
    || '"timestamp": "' || CASE WHEN event_id % 50 = 11 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f789Z')
      ELSE {_TIME.format("ts")} END || '", "account_id": '
    || CASE event_id % 50 WHEN 7 THEN '5' WHEN 8 THEN 'true' WHEN 9 THEN '{{"x":1}}' ELSE '"' || user_id || '"' END
    || ', "amount": '
    || CASE event_id % 50 WHEN 1 THEN '"not-a-number"' WHEN 4 THEN '-1' WHEN 6 THEN '"' || value || '"' ELSE CAST(value AS VARCHAR) END
    || ', "currency": "' || CASE WHEN event_id % 50 = 5 THEN 'USDX' ELSE {_CODE} END
    || '", "transaction_type": "' || event_type || '", "merchant_id": "' || user_id || '"}}' END"""

# A record that already had a stamp is written anew, without blanks.
_ANEW = f"""'{{"transaction_id":"' || event_id || '","timestamp":"' || {_TIME.format("ts")}
    || '","account_id":"' || user_id || '","category":"gift","is_flagged":true,"amount":'
    || CAST(value AS VARCHAR) || ',"currency":"' || {_CODE} || '","transaction_type":"' || event_type
    || '","merchant_id":"' || user_id || '","processed_timestamp":"2024-06-01T00:00:00.000000Z"}}'"""

_MESSAGE = f"""
  SELECT CAST(event_id AS VARCHAR) AS key,
    '{{' || concat_ws(',',
      '"transaction_id":"' || transaction_id || '"',
      '"timestamp":"' || {_TIME.format('"timestamp"')} || '"',
      '"account_id":"' || account_id || '"',
      '"amount":' || CAST(amount AS VARCHAR),
      '"currency":"' || currency || '"',
      '"transaction_type":"' || transaction_type || '"',
      '"merchant_id":"' || merchant_id || '"',
      '"category":"' || category || '"',
      '"is_flagged":' || CAST(is_flagged AS VARCHAR)) || '}}' AS value,
    route || '_financial_events' AS topic
  FROM typed"""

_OBJECTS = """
  SELECT 's3:ObjectCreated:Put' AS event_name, 'raw-zone' AS bucket, url AS object_key,
    md5(html) AS etag, CAST(length(html) AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS reason
  FROM pages WHERE page_id % 40 > 1
  UNION ALL
  SELECT 's3:ObjectCreated:Copy', 'curated-zone', 'pages/' || CAST(page_id AS VARCHAR) || '.parquet',
    md5(html), CAST(length(html) AS BIGINT), NULL FROM pages WHERE page_id % 40 > 1
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, CASE WHEN page_id % 40 = 0 THEN 'unreadable' ELSE 'no records' END
  FROM pages WHERE page_id % 40 <= 1"""

_VERDICT = f"SELECT event_id, {_ROUTE} AS route, {_REASONS} AS reasons FROM events"

def _scored(rows: str) -> str:
    logistic = "1 / (1 + exp(-(-2.0 + 0.05 * amount + 0.5 * CASE WHEN amount > 35 THEN 1 ELSE 0 END)))"
    return f"""
      SELECT transaction_id, amount, category,
        CAST(coalesce({logistic} > 0.5, false) AS DOUBLE) AS fraud_prediction,
        round({logistic}, 9) AS fraud_probability
      FROM {rows}"""


_FRACTION = "CAST(CAST('0x' || left(md5(transaction_id), 8) AS UBIGINT) AS DOUBLE) / 4294967296.0"


def _newton(rounds: int, penalty: float) -> str:
    """Newton steps of a logistic regression with two inputs, one query per step."""
    steps = [
        f"""fit AS (
        SELECT CASE WHEN amount > 35 THEN 1.0 ELSE 0.0 END AS y, amount / 100 AS u, {_FRACTION} AS v
        FROM curated WHERE amount IS NOT NULL),
      w0 AS (SELECT CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS c)"""
    ]
    for k in range(rounds):
        steps.append(f"""
      p{k} AS (
        SELECT fit.*, a, b, c, 1 / (1 + exp(-(a + b * u + c * v))) AS p FROM fit, w{k}),
      s{k} AS (
        SELECT any_value(a) AS a, any_value(b) AS b, any_value(c) AS c,
          avg(p - y) + {penalty} * any_value(a) AS g0,
          avg((p - y) * u) + {penalty} * any_value(b) AS g1,
          avg((p - y) * v) + {penalty} * any_value(c) AS g2,
          avg(p * (1 - p)) + {penalty} AS h00, avg(p * (1 - p) * u) AS h01,
          avg(p * (1 - p) * v) AS h02, avg(p * (1 - p) * u * u) + {penalty} AS h11,
          avg(p * (1 - p) * u * v) AS h12, avg(p * (1 - p) * v * v) + {penalty} AS h22
        FROM p{k}),
      d{k} AS (
        SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02)
          + h02 * (h01 * h12 - h11 * h02) AS det
        FROM s{k}),
      w{k + 1} AS (
        SELECT
          a - (g0 * (h11 * h22 - h12 * h12) + g1 * (h02 * h12 - h01 * h22)
            + g2 * (h01 * h12 - h02 * h11)) / det AS a,
          b - (g0 * (h12 * h02 - h01 * h22) + g1 * (h00 * h22 - h02 * h02)
            + g2 * (h02 * h01 - h00 * h12)) / det AS b,
          c - (g0 * (h01 * h12 - h11 * h02) + g1 * (h01 * h02 - h00 * h12)
            + g2 * (h00 * h11 - h01 * h01)) / det AS c
        FROM d{k})""")
    return ",".join(steps)


ORACLE: dict[str, str] = {
    "label_features": f"""
      WITH {_CURATED}
      SELECT transaction_id, CASE WHEN amount > 35 THEN 1 ELSE 0 END AS label,
        round({_FRACTION}, 9) AS feature_1
      FROM curated""",
    "fit_weights": f"""
      WITH {_CURATED},
      {_newton(8, 0.01)}
      SELECT 'intercept' AS term, round(a, 6) AS weight FROM w8
      UNION ALL SELECT 'amount_share', round(b, 6) FROM w8
      UNION ALL SELECT 'feature_1', round(c, 6) FROM w8""",
    "merge_bucketed": _MERGED,
    "cleanse_transactions": f"WITH {_TXN} {_CLEANSED}",
    "enrich_category": _ENRICHED,
    "enrich_category_salted": _ENRICHED,
    "enrich_without_lookup": f"WITH {_TXN} SELECT *, category AS enriched_category FROM txn",
    "curate_transactions": f"WITH {_CURATED} SELECT * FROM curated",
    "decode_payload": f"SELECT event_id, {_decoded(lenient=True)} FROM events",
    "typed_payload": f"SELECT event_id, {_ROUTE} AS route, {_decoded(lenient=False)} FROM events",
    "contract_financial": _VERDICT,
    "contract_insurance": """
      SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 3 THEN 'malformed'
          WHEN o_orderkey % 20 < 5 THEN 'dlq' ELSE 'curated' END AS route,
        CASE o_orderkey % 20 WHEN 0 THEN 'claim_amount:required' WHEN 1 THEN 'claim_amount:gt'
          WHEN 2 THEN 'claim_amount:type' WHEN 4 THEN 'policy_number:type'
          WHEN 3 THEN 'claim_id:required,timestamp:required,policy_number:required,'
            || 'claim_amount:required,claim_type:required,claim_status:required,'
            || 'customer_id:required,incident_date:required'
          ELSE '' END AS reasons
      FROM orders""",
    "contract_sports": """
      SELECT event_id, CASE WHEN event_id % 30 = 2 THEN 'malformed'
          WHEN event_id % 30 < 4 THEN 'dlq' ELSE 'curated' END AS route,
        CASE event_id % 30 WHEN 0 THEN 'status:required' WHEN 1 THEN 'score_a:type'
          WHEN 3 THEN 'team_a:type'
          WHEN 2 THEN 'event_id:required,timestamp:required,sport:required,team_a:required,'
            || 'team_b:required,status:required'
          ELSE '' END AS reasons
      FROM events""",
    "route_counts": f"SELECT {_ROUTE} AS route, count(*) AS records FROM events GROUP BY 1",
    "flatten_claims": _DAMAGES,
    "flatten_claims_outer": f"""{_DAMAGES}
  UNION ALL
  SELECT {_CLAIM}, NULL, NULL FROM lineitem
  WHERE l_quantity <= 1 OR (l_quantity <= 10 AND l_discount <= 0 AND l_tax <= 0)""",
    "flatten_profiles": _PROFILES,
    "documents_inferred": _PROFILES,
    "rename_events": """
      SELECT event_id, event_type AS type, user_id, ts AS "timestamp",
        '10.0.0.' || CAST(user_id % 256 AS VARCHAR) AS ip_address,
        CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
        CASE WHEN event_type = 'error' THEN props END AS failure_reason,
        CAST(NULL AS INTEGER) AS login_attempts
      FROM events""",
    "json_records": f"WITH {_TXN} SELECT * FROM txn",
    "point_lookup": "SELECT * FROM orders WHERE o_orderkey = 7",
    "lookup_exists": "SELECT count(*) > 0 AS found FROM orders WHERE o_orderkey = 7",
    "topk_recent": "SELECT * FROM events ORDER BY ts DESC, event_id LIMIT 5",
    "bounded_subset": "SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 10",
    "stratified_subset": """
      SELECT * FROM orders QUALIFY row_number() OVER (
        PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) <= 10""",
    "filter_suffix": "SELECT page_id, url FROM pages WHERE url LIKE '%#top'",
    "merge_upsert": _MERGED,
    "read_latest_version": _MERGED,
    "upsert_full_row": f"WITH {_UPSERTED} SELECT * FROM upserted",
    "apply_feed": f"WITH {_UPSERTED} SELECT * FROM upserted",
    "stream_upsert": f"WITH {_UPSERTED} SELECT * FROM upserted",
    "upsert_last_wins": """
      SELECT * FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
          l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
    "merge_feed": f"WITH {_UPDATES} {_MERGE_FEED}",
    "merge_feed_large": f"WITH {_UPDATES} {_MERGE_FEED}",
    "merge_upsert_large": _MERGED,
    "merge_audited": f"""
      WITH {_UPDATES}
      SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus,
        coalesce(u.o_totalprice, o.o_totalprice) AS o_totalprice, o.o_orderdate,
        coalesce(u.o_orderpriority, o.o_orderpriority) AS o_orderpriority,
        TIMESTAMP '2020-01-01' AS created_at,
        CASE WHEN u.o_orderkey IS NULL THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '2024-06-01' END AS updated_at
      FROM orders o LEFT JOIN updates u ON o.o_orderkey = u.o_orderkey
      UNION ALL
      SELECT {_ORDER}, TIMESTAMP '2024-06-01', TIMESTAMP '2024-06-01'
      FROM updates WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
    "change_feed": f"""
      WITH {_UPSERTED},
      b AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'),
      a AS (SELECT * FROM upserted WHERE o_orderstatus <> 'F')
      SELECT b.*, 'delete' AS _change_type FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)
      UNION ALL
      SELECT a.*, 'insert' FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
      UNION ALL
      SELECT b.*, 'update_preimage' FROM b JOIN a ON b.o_orderkey = a.o_orderkey WHERE {_CHANGED}
      UNION ALL
      SELECT a.*, 'update_postimage' FROM b JOIN a ON b.o_orderkey = a.o_orderkey WHERE {_CHANGED}""",
    "version_change_feed": f"""
      WITH {_UPDATES}
      SELECT *, 'insert' AS _change_type, CAST(0 AS BIGINT) AS _commit_version FROM orders
      UNION ALL SELECT *, CAST(1 AS BIGINT) FROM ({_MERGE_FEED})""",
    "feed_of_states": f"""
      WITH {_STATES}
      SELECT *, 'insert' AS _change_type, CAST(0 AS BIGINT) AS _commit_version FROM s0
      UNION ALL {_between(1)} UNION ALL {_between(2)} UNION ALL {_between(3)}""",
    "feed_since_version": f"WITH {_STATES} {_between(2)} UNION ALL {_between(3)}",
    "feed_replayed": "SELECT * FROM orders",
    "schema_evolution": f"""
      WITH {_TXN}
      SELECT *, CASE WHEN transaction_type = 'purchase' THEN amount > 35 END AS is_flagged FROM txn""",
    "merge_history": _HISTORY,
    "merge_history_large": _HISTORY,
    "enrich_as_of": """
      WITH facts AS (
        SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 11 <> 0 THEN user_id END AS merchant,
          CASE WHEN event_id % 13 <> 0 THEN ts END AS ts, value
        FROM events
      ), side AS (
        SELECT c_custkey AS merchant, TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 10 + 10 * n AS INTEGER)) AS since,
          c_custkey % 3 = 0 AS ends, c_mktsegment || '-' || n AS category
        FROM customer, range(3) AS r(n)
      )
      SELECT event_id, f.merchant, ts, value,
        CASE WHEN NOT ends OR ts < since + INTERVAL 6 DAY THEN category END AS category,
        CASE WHEN NOT ends OR ts < since + INTERVAL 6 DAY THEN since END AS since
      FROM facts f ASOF LEFT JOIN side s ON f.merchant = s.merchant AND f.ts >= s.since""",
    "upkeep_counters": f"""
      WITH {_LATER} SELECT event_type, user_id, count(*) AS ingested_total FROM later GROUP BY 1, 2""",
    "upkeep_histogram": f"""
      WITH {_LATER}, measured AS (
        SELECT event_type, value AS amount, CAST({_BUCKET.replace("amount", "value")} AS INTEGER) AS bucket
        FROM later WHERE value IS NOT NULL)
      SELECT event_type, bucket, count(*) AS count, round(sum(amount), 4) AS sum,
        min(amount) AS min, max(amount) AS max, CASE bucket {_UPPER} END AS upper_bound
      FROM measured GROUP BY event_type, bucket""",
    "upkeep_curated": f"WITH {_LATER}, {_CURATED.replace('FROM events', 'FROM later')} SELECT * FROM curated",
    "row_count": "SELECT count(*) AS total FROM lineitem",
    "dq_rule_suite": f"WITH {_CURATED} " + " UNION ALL ".join(_rule(n, c) for n, c in _RULES.items()),
    "ingest_counters": f"""
      SELECT CASE WHEN event_id % 50 NOT IN (0, 3, 10) THEN event_type END AS transaction_type,
        CASE WHEN event_id % 50 = 5 THEN 'USDX' WHEN event_id % 50 NOT IN (0, 3, 10) THEN {_CODE} END AS currency,
        CASE WHEN {_ROUTE} = 'curated' THEN 'success' ELSE 'failed' END AS status,
        count(*) AS ingested_total
      FROM events GROUP BY 1, 2, 3""",
    "claim_counters": """
      SELECT CASE WHEN o_orderkey % 20 <> 3 THEN o_orderpriority END AS claim_type,
        CASE WHEN o_orderkey % 20 <> 3 THEN o_orderstatus END AS claim_status,
        CASE WHEN o_orderkey % 20 < 5 THEN 'failed' ELSE 'success' END AS status,
        count(*) AS ingested_total
      FROM orders GROUP BY 1, 2, 3""",
    "amount_histogram": f"""
      WITH {_TXN}, measured AS (
        SELECT transaction_type, currency, amount, CAST({_BUCKET} AS INTEGER) AS bucket
        FROM txn WHERE amount IS NOT NULL)
      SELECT transaction_type, currency, bucket, count(*) AS count,
        round(sum(amount), 4) AS sum,
        min(amount) AS min, max(amount) AS max, CASE bucket {_UPPER} END AS upper_bound
      FROM measured GROUP BY transaction_type, currency, bucket""",
    "profile_table": _profile("orders", named=False),
    "merged_profile": " UNION ALL ".join(
        f"""SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS column_type, count(*) AS total,
          count(*) - count({name}) AS nulls,
          {f"CAST(min({name}) AS DOUBLE)" if kind in ("bigint", "double") else "NULL"} AS low,
          {f"CAST(max({name}) AS DOUBLE)" if kind in ("bigint", "double") else "NULL"} AS high,
          true AS distinct_close, {"true" if name == "o_totalprice" else "NULL"} AS median_close
        FROM orders"""
        for i, (name, kind) in enumerate(c.split(" ") for c in _TABLES["orders"].split(", "))
    ),
    "catalog_tables": " UNION ALL ".join(_profile(t, named=True) for t in _TABLES),
    "stamp_json_status": f"""
      WITH messages AS (SELECT event_id, {_VALUE} AS message FROM events)
      SELECT event_id,
        CASE WHEN event_id % 50 = 12 THEN {_ANEW} WHEN event_id % 50 NOT IN (0, 10) THEN left(message, length(message) - 1)
          || ', "processed_timestamp": "2024-06-01T00:00:00.000000Z"}}' END AS stamped,
        CASE WHEN event_id % 50 IN (0, 10) THEN 400 ELSE 200 END AS status_code
      FROM messages JOIN events USING (event_id)""",
    "stamp_request_bodies": """
      SELECT event_id, props AS value, left(props, length(props) - 1)
        || ', "processed_timestamp": "2024-06-01T00:00:00.000000Z"}' AS stamped, 200 AS status_code
      FROM events""",
    "publish_json": f"WITH typed AS (SELECT event_id, {_ROUTE} AS route, {_decoded(lenient=False)} FROM events) {_MESSAGE}",
    "object_events": _OBJECTS,
    "new_parquet_objects": f"SELECT * FROM ({_OBJECTS}) WHERE object_key LIKE '%.parquet'",
    "label_rule": f"""
      WITH {_CURATED}
      SELECT transaction_id, amount, CASE WHEN amount > 35 THEN 1 ELSE 0 END AS label FROM curated""",
    "score_fallback": f"""
      WITH {_CURATED}
      SELECT transaction_id, amount, category, CAST(0 AS DOUBLE) AS fraud_prediction,
        CAST(NULL AS DOUBLE) AS fraud_probability
      FROM curated""",
    "score_transactions": f"WITH {_CURATED} {_scored('curated')}",
    "messages_to_scored": f"""
      WITH {_LOOKUP}, curated AS (
        SELECT CAST(e.event_id AS VARCHAR) AS transaction_id, e.value AS amount,
          coalesce(l.category, CASE WHEN e.event_id % 50 = 12 THEN 'gift' END) AS category
        FROM events e LEFT JOIN lookup l ON CAST(e.user_id AS VARCHAR) = l.merchant_id
        WHERE {_ROUTE} = 'curated') {_scored('curated')}""",
    "messages_to_curated": f"""
      WITH {_LOOKUP}
      SELECT DISTINCT CAST(e.event_id AS VARCHAR) AS transaction_id, e.ts AS "timestamp",
        sha256(CAST(e.user_id AS VARCHAR)) AS hashed_account_id, e.value AS amount,
        {_CODE} AS currency, e.event_type AS transaction_type,
        CAST(e.user_id AS VARCHAR) AS merchant_id,
        coalesce(l.category, CASE WHEN e.event_id % 50 = 12 THEN 'gift' END) AS category,
        e.value = 0 AS is_amount_zero_flag
      FROM events e LEFT JOIN lookup l ON CAST(e.user_id AS VARCHAR) = l.merchant_id
      WHERE {_ROUTE} = 'curated'""",
    "stream_append": f"SELECT {_decoded(lenient=True)} FROM events",
    "stream_route": _VERDICT,
    "stream_incremental": f"WITH {_TXN} SELECT * FROM txn",
    "stream_gated": f"WITH {_TXN} SELECT * REPLACE (coalesce(amount, 0) AS amount) FROM txn",
    "stream_change_feed": """
      SELECT *, 'insert' AS _change_type, 0 AS batch FROM customer
      UNION ALL SELECT *, 'update_preimage', 1 FROM customer WHERE c_custkey % 3 = 0
      UNION ALL SELECT c_custkey, c_name, (c_nationkey + 1) % 25, c_acctbal + 1, c_mktsegment,
        'update_postimage', 1 FROM customer WHERE c_custkey % 3 = 0""",
    "stream_counters": f"""
      WITH {_TXN}
      SELECT transaction_type, currency, count(*) AS ingested_total FROM txn GROUP BY 1, 2""",
}
