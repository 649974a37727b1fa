"""DuckDB oracle SQL for the registered queries (same column names, doubles rounded alike).

Input derivations shared with the Spark side (``cars.*_SQL``, ``registry.NULL_RULES_SQL``) are
plain SQL that both engines accept, so both sides start from identical inputs.
"""

from __future__ import annotations

from valuemill.plans import cars
from valuemill.plans.boosted import BOOST_SQL
from valuemill.plans.registry import CUT, NULL_RULES_SQL, PRIORITY_RANKS

EPS = "2.220446049250313e-16"
CONST_STD = "2.220446049250313e-15"


def _torque_sql() -> str:
    """The expected value and speed of each text come from the numbers that the text was made of, not from parsing it."""
    return f"""
WITH src AS (SELECT l_orderkey, l_linenumber, {cars.TORQUE_TEXT_SQL} AS torque, CAST(l_quantity AS BIGINT) AS q, l_partkey AS p FROM lineitem)
SELECT l_orderkey, l_linenumber, torque,
  round(CAST(CASE l_linenumber WHEN 1 THEN q * 5 WHEN 2 THEN (q + (p % 10) / 10.0) * 9.81 WHEN 3 THEN q * 4 WHEN 4 THEN q * 10 * 9.81
             WHEN 5 THEN q * 6 WHEN 6 THEN q * 9.81 ELSE q * 3 END AS DOUBLE), 6) AS torque_peak_power,
  CAST(CASE l_linenumber WHEN 1 THEN 1500 + p % 3000 WHEN 2 THEN 2000 + p % 2500 WHEN 3 THEN 2500 + p % 1000 WHEN 4 THEN 2000 + p % 2000
            WHEN 5 THEN 1000 + p % 4000 WHEN 6 THEN (1 + p % 3) * 1000 + 100 + p % 900 ELSE 1000 + p % 3000 END AS DOUBLE) AS torque_peak_speed
FROM src"""


def _mileage_sql() -> str:
    """The expected value comes from the numbers, unit and fuel that the text was made of, not from parsing it."""
    return f"""
WITH m AS (SELECT p_partkey, p_size, {cars.FUEL_SQL} AS fuel, {cars.MILEAGE_TEXT_SQL} AS mileage FROM part)
SELECT p_partkey, fuel, mileage, round(CAST(CASE
  WHEN p_partkey % 3 = 0 AND p_partkey % 6 IN (0, 1, 5) THEN p_size + (p_partkey % 10) / 10.0
  WHEN p_partkey % 3 = 1 AND p_partkey % 6 IN (2, 3) THEN p_size * 1.39
  END AS DOUBLE), 6) AS mileage_kmpl FROM m"""


def _one_hot(col: str, values: list[str]) -> str:
    return ", ".join(f"CAST(CASE WHEN {col} = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS \"{col}_{v}\"" for v in values)


def _key(cols_sql: list[str]) -> str:
    return "concat_ws(' ', " + ", ".join(f"coalesce(substr({c}, 1, 15), 'nan')" for c in cols_sql) + ")"


_KEYED = f"""
WITH r AS (SELECT event_id, ts, value,
    sha256({_key(["event_type", "CAST(CAST(user_id AS DECIMAL(38,6)) AS VARCHAR)",
                  "CAST(CAST(hour(ts) AS DECIMAL(38,6)) AS VARCHAR)"])}) AS hashed FROM events)"""
_REQ = f"""{_KEYED},
s AS (SELECT hashed, avg(value) AS prediction FROM r WHERE ts < TIMESTAMP '{CUT}' GROUP BY hashed),
q AS (SELECT event_id, hashed, value FROM r WHERE ts >= TIMESTAMP '{CUT}')"""

_PARTY = """
SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment,
       'customer' AS source FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, 'supplier' AS source
FROM supplier"""

_NULLS = ", ".join(f"{e} AS {c}" for c, e in NULL_RULES_SQL.items())
_NULL_COLS = list(NULL_RULES_SQL)
_NULL_PROFILE = f"""
WITH t AS (SELECT {_NULLS} FROM lineitem),
a AS (SELECT count(*) AS n,
        count(*) FILTER (WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _NULL_COLS)}) AS complete,
        {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS n{i}' for i, c in enumerate(_NULL_COLS))} FROM t)
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, n{i} AS null_count, n AS row_count, n{i} = n AS all_null, complete AS complete_rows FROM a"
    for i, c in enumerate(_NULL_COLS))

_SCORED = """WITH s AS (SELECT l_extendedprice AS y, l_quantity * 1000 AS c1, l_quantity * 1500 - l_discount * 10000 AS c2
FROM lineitem)"""

_GAPS = """WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity AS q,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_extendedprice END AS p FROM lineitem)"""

SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
AMERICA_KEPT = ["NATION_11", "NATION_16", "NATION_21", "NATION_6"]

_ALLOWED = ", ".join(f"'{v}'" for v in ["view", "click", "purchase", "signup"])
_ERRORS = f"""concat_ws(';',
    CASE WHEN NOT coalesce(event_type IN ({_ALLOWED}), false) THEN 'event_type_not_allowed' END,
    CASE WHEN NOT coalesce(value BETWEEN 0.0 AND 300.0, false) THEN 'value_out_of_range' END,
    CASE WHEN user_id IS NULL THEN 'user_id_missing' END,
    CASE WHEN props IS NULL THEN 'props_missing' END)"""

_PRIORITY = " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRIORITY_RANKS.items())

ORACLE_SQL: dict[str, str] = {
    "name_split": """SELECT p_partkey, p_name,
  CASE WHEN strpos(p_name, ' ') = 0 THEN p_name ELSE substr(p_name, 1, strpos(p_name, ' ') - 1) END AS make,
  CASE WHEN strpos(p_name, ' ') = 0 THEN NULL ELSE substr(p_name, strpos(p_name, ' ') + 1) END AS model
FROM part""",
    "digits_to_number": """SELECT p_partkey,
  try_cast(regexp_replace(p_brand, '[^0-9.]+', '', 'g') AS DOUBLE) AS brand_number,
  try_cast(regexp_replace(p_type, '[^0-9.]+', '', 'g') AS DOUBLE) AS type_number FROM part""",
    "mileage_kmpl": _mileage_sql(),
    "torque_nm_rpm": _torque_sql(),
    "owner_rank": f"SELECT o_orderkey, o_orderpriority, CASE o_orderpriority {_PRIORITY} END AS owner_rank FROM orders",
    "round_half_even": """SELECT l_orderkey, l_linenumber, l_quantity / 2 AS half_qty,
  CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS seats FROM lineitem""",
    "label_log": "SELECT o_orderkey, round(ln(1 + o_totalprice), 6) AS price_log FROM orders",
    "label_inverse": """SELECT o_orderkey, round(exp(ln(1 + o_totalprice)) - 1, 6) AS price_expm1,
  round(exp(ln(1 + o_totalprice)), 6) AS price_exp FROM orders""",
    "one_hot_segment": f"SELECT c_custkey, {_one_hot('c_mktsegment', SEGMENTS)} FROM customer",
    "one_hot_unseen": f"""SELECT c_custkey, {_one_hot('n_name', AMERICA_KEPT)}
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "standard_scale": f"""WITH s AS (SELECT avg(l_tax) AS mt, stddev_pop(l_tax) AS st, avg(l_quantity) AS mq,
    stddev_pop(l_quantity) AS sq FROM lineitem)
SELECT l_orderkey, l_linenumber,
  round((l_tax - mt) / CASE WHEN st < {CONST_STD} THEN 1 ELSE st END, 6) AS l_tax,
  round((l_quantity - mq) / CASE WHEN sq < {CONST_STD} THEN 1 ELSE sq END, 6) AS l_quantity
FROM lineitem, s""",
    "dedupe_rows": "SELECT DISTINCT * FROM (SELECT * FROM supplier UNION ALL SELECT * FROM supplier)",
    "hash_split": """SELECT o_orderkey,
  CASE WHEN substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) < '4ccccccd' THEN 'test' ELSE 'train' END AS split
FROM orders""",
    "k_fold": """SELECT o_orderkey,
  CAST(('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 9, 8))::BIGINT % 5 AS INTEGER) AS fold FROM orders""",
    "row_key_hash": f"""WITH k AS (SELECT l_orderkey, l_linenumber, {_key([f"CAST(CAST({c} AS DECIMAL(18,6)) AS VARCHAR)" for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]])} AS row_key
  FROM lineitem)
SELECT l_orderkey, l_linenumber, row_key, sha256(row_key) AS hashed FROM k""",
    "upsert_latest": """SELECT user_id, event_id, ts, event_type, round(value, 6) AS value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "lookup_or_score": _REQ + """
SELECT q.event_id, q.hashed, s.prediction IS NOT NULL AS hit,
  round(CASE WHEN s.prediction IS NOT NULL THEN s.prediction ELSE exp(ln(1 + q.value)) END, 6) AS prediction
FROM q LEFT JOIN s ON q.hashed = s.hashed""",
    "lookup_miss": _REQ + """
SELECT q.event_id, q.hashed, round(q.value, 6) AS value FROM q
WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.hashed = q.hashed)""",
    "union_sources": _PARTY,
    "optional_source": _PARTY,
    "requests_by_day": """SELECT CAST(ts AS DATE) AS request_date, count(*) AS n_requests, round(sum(value), 6) AS total_value
FROM events GROUP BY 1""",
    "yesterday_requests": """SELECT event_id, user_id, event_type, round(value, 6) AS value, CAST(ts AS DATE) AS request_date
FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) - 1""",
    "validate_requests": f"SELECT event_id, {_ERRORS} AS errors, {_ERRORS} = '' AS is_valid FROM events",
    "null_profile": _NULL_PROFILE,
    "regression_metrics": _SCORED + f"""
SELECT round(avg(abs(y - c1)), 6) AS mae, round(sqrt(avg((y - c1) * (y - c1))), 6) AS rmse,
  round(avg(abs(y - c1) / greatest(abs(y), {EPS})), 6) AS mape,
  round(1 - sum((y - c1) * (y - c1)) / (var_pop(y) * count(*)), 6) AS r2,
  round(-avg((y - c1) * (y - c1)), 0) AS neg_mse, count(*) AS n FROM s""",
    "champion_challenger": _SCORED + """
SELECT round(-avg((y - c1) * (y - c1)), 0) AS neg_mse_champion, round(-avg((y - c2) * (y - c2)), 0) AS neg_mse_challenger,
  CASE WHEN -avg((y - c2) * (y - c2)) > -avg((y - c1) * (y - c1)) THEN 'Challenger' ELSE 'Champion' END AS winner
FROM s""",
    "latest_run": """SELECT event_id AS run_id, ts, event_type AS model, round(value, 6) AS score FROM events
ORDER BY ts DESC, event_id DESC LIMIT 1""",
    "best_run": """SELECT user_id AS candidate, round(avg(value), 6) AS mean_score FROM events GROUP BY user_id
ORDER BY avg(value) DESC, user_id LIMIT 1""",
    "impute_mean": _GAPS + """
SELECT l_orderkey, l_linenumber, round(coalesce(p, avg(p) OVER ()), 6) AS l_extendedprice FROM t""",
    "impute_ols": _GAPS + """, c AS (SELECT regr_slope(p, q) AS b, regr_intercept(p, q) AS a FROM t)
SELECT l_orderkey, l_linenumber, round(coalesce(p, a + b * q), 6) AS l_extendedprice FROM t, c""",
    "csv_round_trip": "SELECT * FROM nation",
    "decode_utf8": "SELECT doc_id, text, length(text) AS n_chars FROM documents",
    "rename_tail": "SELECT * FROM nation",
}

# The strict rules written out, apart from the engine's own constants.
_STRICT_ERRORS = """concat_ws(';',
  CASE WHEN fuel IN ('petrol', 'diesel', 'cng', 'lpg', 'electric') THEN NULL ELSE 'fuel_not_allowed' END,
  CASE WHEN seller_type IN ('individual', 'dealer', 'trustmark dealer') THEN NULL ELSE 'seller_type_not_allowed' END,
  CASE WHEN transmission IN ('manual', 'automatic') THEN NULL ELSE 'transmission_not_allowed' END,
  CASE WHEN owner IN ('first', 'second', 'third', 'fourth & above') THEN NULL ELSE 'owner_not_allowed' END,
  CASE WHEN brand IS NULL THEN 'brand_missing' END,
  CASE WHEN model IS NULL THEN 'model_missing' END,
  CASE WHEN year >= 1886 AND year <= 2024 THEN NULL ELSE 'year_out_of_range' END,
  CASE WHEN km_driven >= 0 THEN NULL ELSE 'km_driven_out_of_range' END,
  CASE WHEN mileage >= 0 THEN NULL ELSE 'mileage_out_of_range' END,
  CASE WHEN engine >= 50 AND engine <= 10000 THEN NULL ELSE 'engine_out_of_range' END,
  CASE WHEN max_power >= 0 THEN NULL ELSE 'max_power_out_of_range' END,
  CASE WHEN torque_peak_power >= 0 THEN NULL ELSE 'torque_peak_power_out_of_range' END,
  CASE WHEN torque_peak_speed >= 0 THEN NULL ELSE 'torque_peak_speed_out_of_range' END,
  CASE WHEN seats >= 2 AND seats <= 12 THEN NULL ELSE 'seats_out_of_range' END,
  CASE WHEN year = floor(year) THEN NULL ELSE 'year_not_int' END,
  CASE WHEN km_driven = floor(km_driven) THEN NULL ELSE 'km_driven_not_int' END,
  CASE WHEN engine = floor(engine) THEN NULL ELSE 'engine_not_int' END,
  CASE WHEN torque_peak_speed = floor(torque_peak_speed) THEN NULL ELSE 'torque_peak_speed_not_int' END,
  CASE WHEN seats = floor(seats) THEN NULL ELSE 'seats_not_int' END)"""
ORACLE_SQL["validate_strict"] = f"""WITH r AS (SELECT {cars.STRICT_SELECT_SQL} FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_orderkey, l_linenumber, {_STRICT_ERRORS} AS errors, {_STRICT_ERRORS} = '' AS is_valid FROM r"""
ORACLE_SQL["exact_split"] = """WITH h AS (SELECT o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)) AS hv FROM orders),
c AS (SELECT CAST(ceil(0.3 * count(*)) AS BIGINT) AS k FROM orders),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY hv) AS rn FROM h)
SELECT o_orderkey, CASE WHEN rn <= k THEN 'test' ELSE 'train' END AS split FROM r, c"""
_RAW_COLS = ", ".join(cars.FEATURE_INPUTS + [cars.LABEL])
ORACLE_SQL["land_raw_csv"] = f"""WITH raw AS (SELECT {cars.RAW_SELECT_SQL} FROM lineitem JOIN part ON l_partkey = p_partkey),
d AS (SELECT DISTINCT {_RAW_COLS} FROM raw)
SELECT fuel, transmission, count(*) AS n_records, round(avg(selling_price), 6) AS avg_price FROM d GROUP BY 1, 2"""
ORACLE_SQL["row_slice"] = """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 5 OFFSET 10"""
ORACLE_SQL["table_shape"] = "SELECT count(*) AS n_rows, 11 AS n_cols FROM lineitem"

ORACLE_SQL["store_lookup"] = _REQ + """,
d AS (SELECT hashed, CAST(ts AS DATE) AS day, avg(value) AS prediction FROM r WHERE ts < TIMESTAMP '""" + CUT + """'
      GROUP BY 1, 2),
n AS (SELECT hashed, prediction FROM d QUALIFY row_number() OVER (PARTITION BY hashed ORDER BY day DESC) = 1)
SELECT q.event_id, q.hashed, n.prediction IS NOT NULL AS hit,
  round(CASE WHEN n.prediction IS NOT NULL THEN n.prediction ELSE exp(ln(1 + q.value)) END, 6) AS prediction
FROM q LEFT JOIN n ON q.hashed = n.hashed"""

# The streaming lookup returns what the batch lookup returns.
ORACLE_SQL["stream_score"] = ORACLE_SQL["lookup_or_score"]

ORACLE_SQL["store_bucketed"] = ORACLE_SQL["store_lookup"]
# Sent again within the delay: once. Late: later than the end of the second part's time less the delay.
ORACLE_SQL["stream_requests_once"] = """
WITH w AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 12 DAY AS wm FROM events WHERE ts < TIMESTAMP '2024-01-21'),
e AS (SELECT event_id, ts, ts < TIMESTAMP '2024-01-11' AND event_id % 11 = 0 AND ts <= wm AS late FROM events, w)
SELECT event_id, CASE WHEN late THEN 'late' ELSE 'answered' END AS outcome, CASE WHEN NOT late THEN CAST(ts AS DATE) END AS request_date FROM e"""
ORACLE_SQL["stream_promoted"] = _KEYED + """,
a AS (SELECT hashed, max(event_id) AS event_id, max_by(value, event_id) AS value FROM r
  WHERE ts < TIMESTAMP '2024-01-11' AND event_id % 11 <> 0 GROUP BY hashed),
b AS (SELECT hashed, max(event_id) AS event_id, max_by(value, event_id) AS value FROM r
  WHERE ts >= TIMESTAMP '2024-01-21' OR (ts >= TIMESTAMP '2024-01-11' AND event_id % 7 = 0) OR (ts < TIMESTAMP '2024-01-11' AND event_id % 11 = 0) GROUP BY hashed)
SELECT event_id, hashed, FALSE AS hit, 'first' AS model_id, round(value * 2, 6) AS prediction FROM a
UNION ALL SELECT b.event_id, b.hashed, a.hashed IS NOT NULL, CASE WHEN a.hashed IS NULL THEN 'second' END,
  round(CASE WHEN a.hashed IS NULL THEN b.value * 3 ELSE a.value * 2 END, 6) FROM b LEFT JOIN a ON a.hashed = b.hashed"""

ORACLE_SQL["csv_documents"] = "SELECT * FROM documents"
ORACLE_SQL["csv_split_documents"] = "SELECT * FROM documents"
_UNTYPED = cars.KEY_COLS + cars.FEATURE_INPUTS + [cars.LABEL]
_RAW_CARS = f"raw AS (SELECT {cars.RAW_SELECT_SQL} FROM lineitem JOIN part ON l_partkey = p_partkey)"
ORACLE_SQL["csv_inferred_records"] = f"WITH {_RAW_CARS} SELECT {', '.join(_UNTYPED)} FROM raw"
ORACLE_SQL["csv_inferred_types"] = f"""WITH {_RAW_CARS},
v AS ({" UNION ALL ".join(f"SELECT '{c}' AS name, CAST({c} AS VARCHAR) AS v FROM raw" for c in _UNTYPED)}),
k AS (SELECT name, CASE WHEN v IS NULL OR v = '' THEN 0 WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 1
  WHEN regexp_full_match(v, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN 2 ELSE 3 END AS kind FROM v)
SELECT name, CASE WHEN max(kind) = 3 THEN 'string' WHEN max(kind) = 1 AND min(kind) = 1 THEN 'int64' ELSE 'float64' END AS dtype FROM k GROUP BY name"""
ORACLE_SQL["validate_car_requests"] = f"""WITH raw AS (SELECT {cars.RAW_SELECT_SQL} FROM lineitem JOIN part ON l_partkey = p_partkey),
r AS (SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN seats + 0.5 ELSE seats END AS seats,
                        CASE WHEN l_orderkey % 9 = 0 THEN 'Steam' ELSE fuel END AS fuel) FROM raw),
e AS (SELECT l_orderkey, l_linenumber, concat_ws(';',
  CASE WHEN name IS NULL THEN 'name_missing' END, CASE WHEN year IS NULL THEN 'year_missing' END,
  CASE WHEN km_driven IS NULL THEN 'km_driven_missing' END, CASE WHEN fuel IS NULL THEN 'fuel_missing' END,
  CASE WHEN seller_type IS NULL THEN 'seller_type_missing' END, CASE WHEN transmission IS NULL THEN 'transmission_missing' END,
  CASE WHEN owner IS NULL THEN 'owner_missing' END, CASE WHEN mileage IS NULL THEN 'mileage_missing' END,
  CASE WHEN engine IS NULL THEN 'engine_missing' END, CASE WHEN max_power IS NULL THEN 'max_power_missing' END,
  CASE WHEN torque IS NULL THEN 'torque_missing' END, CASE WHEN seats IS NULL THEN 'seats_missing' END,
  CASE WHEN seats = floor(seats) THEN NULL ELSE 'seats_not_int' END,
  CASE WHEN fuel IN ('Diesel', 'Petrol', 'LPG', 'CNG') THEN NULL ELSE 'fuel_not_allowed' END,
  CASE WHEN seller_type IN ('Dealer', 'Individual', 'Trustmark Dealer') THEN NULL ELSE 'seller_type_not_allowed' END,
  CASE WHEN transmission IN ('Manual', 'Automatic') THEN NULL ELSE 'transmission_not_allowed' END,
  CASE WHEN owner IN ('First Owner', 'Second Owner', 'Third Owner', 'Fourth & Above Owner', 'Test Drive Car') THEN NULL ELSE 'owner_not_allowed' END) AS errors FROM r)
SELECT l_orderkey, l_linenumber, errors, errors = '' AS is_valid FROM e"""

_GAPPY = ["seats", "mileage_kmpl", "engine_cc", "max_power_bhp", "torque_peak_power", "torque_peak_speed"]
_NUMERIC = ["year", "km_driven", "owner"] + _GAPPY
# Every number comes from the columns that the raw texts were made of, not from parsing them.
ORACLE_SQL["feature_build_mean"] = f"""
WITH raw AS (SELECT {cars.RAW_SELECT_SQL}, CAST(l_quantity AS BIGINT) AS q, l_partkey AS p, l_discount AS d, p_size, p_retailprice FROM lineitem JOIN part ON l_partkey = p_partkey),
one AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY {_RAW_COLS} ORDER BY l_orderkey DESC, l_linenumber DESC, request_ts DESC) = 1),
x AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN substr(sha256(l_orderkey || '|' || l_linenumber), 1, 8) < '4ccccccd' THEN 'test' ELSE 'train' END AS split,
  CAST(year AS DOUBLE) AS year, CAST(km_driven AS DOUBLE) AS km_driven,
  CAST(CASE WHEN l_linenumber <= 5 THEN l_linenumber ELSE 1 END AS DOUBLE) AS owner, seats,
  CAST(CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN p % 4 IN (0, 1) THEN 10 + round(d * 100) + (p % 10) / 10.0 ELSE (15 + p_size % 10) * 1.39 END AS DOUBLE) AS mileage_kmpl,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(600 + p_size * 50 AS DOUBLE) END AS engine_cc,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(floor(p_retailprice / 10) AS DOUBLE) END AS max_power_bhp,
  CAST(CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_linenumber = 1 THEN q * 5 WHEN l_linenumber = 2 THEN (q + (p % 10) / 10.0) * 9.81 WHEN l_linenumber = 3 THEN q * 4
       WHEN l_linenumber = 4 THEN q * 10 * 9.81 WHEN l_linenumber = 5 THEN q * 6 WHEN l_linenumber = 6 THEN q * 9.81 ELSE q * 3 END AS DOUBLE) AS torque_peak_power,
  CAST(CASE WHEN l_orderkey % 23 = 0 THEN NULL WHEN l_linenumber = 1 THEN 1500 + p % 3000 WHEN l_linenumber = 2 THEN 2000 + p % 2500 WHEN l_linenumber = 3 THEN 2500 + p % 1000
       WHEN l_linenumber = 4 THEN 2000 + p % 2000 WHEN l_linenumber = 5 THEN 1000 + p % 4000 WHEN l_linenumber = 6 THEN (1 + p % 3) * 1000 + 100 + p % 900
       ELSE 1000 + p % 3000 END AS DOUBLE) AS torque_peak_speed FROM one),
m AS (SELECT {", ".join(f"avg({c}) AS m_{c}" for c in _GAPPY)} FROM x WHERE split = 'train'),
f AS (SELECT l_orderkey, l_linenumber, split, year, km_driven, owner, round_even(coalesce(seats, m_seats), 0) AS seats,
  {", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in _GAPPY if c != "seats")} FROM x, m),
s AS (SELECT {", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in _NUMERIC)} FROM f WHERE split = 'train')
SELECT l_orderkey, l_linenumber, split, {", ".join(f"round(({c} - a_{c}) / CASE WHEN s_{c} < {CONST_STD} THEN 1 ELSE s_{c} END, 6) AS {c}" for c in _NUMERIC)} FROM f, s"""

ORACLE_SQL.update(BOOST_SQL)
