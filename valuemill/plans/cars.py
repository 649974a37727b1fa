"""The used-car configuration: raw schema, request rules, and a raw-record view over the test tables.

The engine's operators take column names as parameters; this module is one configuration of
them. ``raw_records`` derives car-like raw records from ``lineitem`` joined with ``part`` with
deterministic SQL (the same text on Spark and DuckDB), so every query built on it reads whole
driver tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuemill.functions.text import OWNER_RANKS
import valuemill.operators.validate as V
from valuemill.session import sf_path, spread

RAW_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("km_driven", T.IntegerType()),
    T.StructField("fuel", T.StringType()),
    T.StructField("seller_type", T.StringType()),
    T.StructField("transmission", T.StringType()),
    T.StructField("owner", T.StringType()),
    T.StructField("mileage", T.StringType()),
    T.StructField("engine", T.StringType()),
    T.StructField("max_power", T.StringType()),
    T.StructField("torque", T.StringType()),
    T.StructField("seats", T.DoubleType()),
])
FEATURE_INPUTS = [f.name for f in RAW_SCHEMA.fields]
LABEL = "selling_price"
CATEGORICAL = ["fuel", "seller_type", "transmission", "make"]

# ---------------------------------------------------------------------------
# Allowed request values (service schema) and the strict schema's domains/ranges.
# ---------------------------------------------------------------------------
FUELS = ["Diesel", "Petrol", "LPG", "CNG"]
SELLER_TYPES = ["Dealer", "Individual", "Trustmark Dealer"]
TRANSMISSIONS = ["Manual", "Automatic"]
OWNERS = list(OWNER_RANKS)
STRICT_FUELS = ["petrol", "diesel", "cng", "lpg", "electric"]
STRICT_SELLER_TYPES = ["individual", "dealer", "trustmark dealer"]
STRICT_TRANSMISSIONS = ["manual", "automatic"]
STRICT_OWNERS = ["first", "second", "third", "fourth & above"]
STRICT_RANGES = {
    "year": (1886, 2024),
    "km_driven": (0, None),
    "mileage": (0.0, None),
    "engine": (50, 10000),
    "max_power": (0.0, None),
    "torque_peak_power": (0.0, None),
    "torque_peak_speed": (0, None),
    "seats": (2, 12),
}
STRICT_INTEGERS = ["year", "km_driven", "engine", "torque_peak_speed", "seats"]
# ---------------------------------------------------------------------------


def request_rules() -> dict[str, Column]:
    """Every field required and typed; categorical fields restricted to the allowed labels."""
    rules = {f"{c}_missing": V.required(c) for c in FEATURE_INPUTS}
    rules.update({
        "year_not_int": V.typed("year", "int"),
        "km_driven_not_int": V.typed("km_driven", "int"),
        "seats_not_int": V.typed("seats", "int"),
        "fuel_not_allowed": V.allowed("fuel", FUELS),
        "seller_type_not_allowed": V.allowed("seller_type", SELLER_TYPES),
        "transmission_not_allowed": V.allowed("transmission", TRANSMISSIONS),
        "owner_not_allowed": V.allowed("owner", OWNERS),
    })
    return rules


def strict_rules() -> dict[str, Column]:
    """The strict request schema: lower-case domains and numeric ranges."""
    rules = {
        "fuel_not_allowed": V.allowed("fuel", STRICT_FUELS),
        "seller_type_not_allowed": V.allowed("seller_type", STRICT_SELLER_TYPES),
        "transmission_not_allowed": V.allowed("transmission", STRICT_TRANSMISSIONS),
        "owner_not_allowed": V.allowed("owner", STRICT_OWNERS),
        "brand_missing": V.required("brand"),
        "model_missing": V.required("model"),
    }
    for c, (lo, hi) in STRICT_RANGES.items():
        rules[f"{c}_out_of_range"] = V.in_range(c, lo, hi)
    for c in STRICT_INTEGERS:
        rules[f"{c}_not_int"] = V.typed(c, "int")
    return rules


# Raw-record derivation from lineitem x part. Plain SQL that Spark and DuckDB both accept.
TORQUE_TEXT_SQL = """CASE l_linenumber
  WHEN 1 THEN CAST(CAST(l_quantity AS BIGINT) * 5 AS STRING) || 'Nm@ ' || CAST(1500 + l_partkey % 3000 AS STRING) || 'rpm'
  WHEN 2 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || '.' || CAST(l_partkey % 10 AS STRING) || 'kgm@ ' || CAST(2000 + l_partkey % 2500 AS STRING) || 'rpm'
  WHEN 3 THEN CAST(CAST(l_quantity AS BIGINT) * 4 AS STRING) || ' Nm at ' || CAST(1500 + l_partkey % 1000 AS STRING) || '-' || CAST(2500 + l_partkey % 1000 AS STRING) || 'rpm'
  WHEN 4 THEN CAST(CAST(l_quantity AS BIGINT) * 10 AS STRING) || '(' || CAST(CAST(l_quantity AS BIGINT) AS STRING) || ' kgm)@ ' || CAST(2000 + l_partkey % 2000 AS STRING) || 'rpm'
  WHEN 5 THEN CAST(CAST(l_quantity AS BIGINT) * 6 AS STRING) || ' / ' || CAST(1000 + l_partkey % 4000 AS STRING)
  WHEN 6 THEN CAST(CAST(l_quantity AS BIGINT) AS STRING) || '@ ' || CAST(1 + l_partkey % 3 AS STRING) || ',' || CAST(100 + l_partkey % 900 AS STRING) || '(kgm@ rpm)'
  ELSE CAST(CAST(l_quantity AS BIGINT) * 3 AS STRING) || 'Nm@ ' || CAST(1000 + l_partkey % 3000 AS STRING) || '+/-500rpm'
END"""

FUEL_SQL = "CASE p_partkey % 6 WHEN 0 THEN 'Diesel' WHEN 1 THEN 'Petrol' WHEN 2 THEN 'CNG' WHEN 3 THEN 'LPG' WHEN 4 THEN 'Electric' ELSE 'diesel' END"
MILEAGE_TEXT_SQL = """CASE p_partkey % 3
  WHEN 0 THEN CAST(p_size AS STRING) || '.' || CAST(p_partkey % 10 AS STRING) || ' kmpl'
  WHEN 1 THEN CAST(p_size AS STRING) || ' km/kg'
  ELSE NULL END"""

RAW_SELECT_SQL = f"""
  l_orderkey AS l_orderkey,
  l_linenumber AS l_linenumber,
  p_name AS name,
  CAST(year(l_shipdate) AS INT) AS year,
  CAST(round(l_quantity * 1000) + l_partkey % 1000 AS INT) AS km_driven,
  CASE l_partkey % 4 WHEN 0 THEN 'Diesel' WHEN 1 THEN 'Petrol' WHEN 2 THEN 'CNG' ELSE 'LPG' END AS fuel,
  CASE l_suppkey % 3 WHEN 0 THEN 'Individual' WHEN 1 THEN 'Dealer' ELSE 'Trustmark Dealer' END AS seller_type,
  CASE WHEN l_returnflag = 'R' THEN 'Automatic' ELSE 'Manual' END AS transmission,
  CASE l_linenumber WHEN 1 THEN 'First Owner' WHEN 2 THEN 'Second Owner' WHEN 3 THEN 'Third Owner'
       WHEN 4 THEN 'Fourth & Above Owner' WHEN 5 THEN 'Test Drive Car' ELSE 'First Owner' END AS owner,
  CASE WHEN l_orderkey % 11 = 0 THEN NULL
       WHEN l_partkey % 4 IN (0, 1) THEN CAST(10 + CAST(round(l_discount * 100) AS INT) AS STRING) || '.' || CAST(l_partkey % 10 AS STRING) || ' kmpl'
       ELSE CAST(15 + p_size % 10 AS STRING) || ' km/kg' END AS mileage,
  CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(600 + p_size * 50 AS STRING) || ' CC' END AS engine,
  CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE CAST(CAST(floor(p_retailprice / 10) AS INT) AS STRING) || ' bhp' END AS max_power,
  CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE {TORQUE_TEXT_SQL} END AS torque,
  CASE WHEN l_orderkey % 19 = 0 THEN NULL ELSE CAST(4 + l_linenumber % 4 AS DOUBLE) END AS seats,
  l_extendedprice AS selling_price,
  l_shipdate AS request_ts
"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, table))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Car-like raw records (one per lineitem row) with key (l_orderkey, l_linenumber),
    label ``selling_price`` and request time ``request_ts``."""
    return spark.sql(f"SELECT {RAW_SELECT_SQL} FROM {{li}} JOIN {{pa}} ON l_partkey = p_partkey",
                     li=spread(read(spark, sf_dir, "lineitem")), pa=read(spark, sf_dir, "part"))


KEY_COLS = ["l_orderkey", "l_linenumber"]


# Strict-schema requests derived from lineitem x part (plain SQL for Spark and DuckDB).
STRICT_SELECT_SQL = """
  l_orderkey AS l_orderkey,
  l_linenumber AS l_linenumber,
  p_brand AS brand,
  p_type AS model,
  CAST(year(l_shipdate) AS INT) + l_linenumber * 4 AS year,
  CAST(l_quantity * 1000 AS BIGINT) - 2000 AS km_driven,
  CASE p_partkey % 6 WHEN 0 THEN 'diesel' WHEN 1 THEN 'petrol' WHEN 2 THEN 'cng' WHEN 3 THEN 'lpg'
       WHEN 4 THEN 'electric' ELSE 'hydrogen' END AS fuel,
  CASE l_suppkey % 4 WHEN 0 THEN 'individual' WHEN 1 THEN 'dealer' WHEN 2 THEN 'trustmark dealer'
       ELSE 'broker' END AS seller_type,
  CASE WHEN l_returnflag = 'R' THEN 'automatic' ELSE 'manual' END AS transmission,
  CASE l_linenumber % 5 WHEN 0 THEN 'first' WHEN 1 THEN 'second' WHEN 2 THEN 'third'
       WHEN 3 THEN 'fourth & above' ELSE 'test drive' END AS owner,
  l_discount * 300 - 3 AS mileage,
  p_size * 250 AS engine,
  p_retailprice / 10.0 - 95 AS max_power,
  l_quantity * 5.0 AS torque_peak_power,
  1500 + l_partkey % 3000 AS torque_peak_speed,
  l_linenumber + CASE WHEN l_partkey % 11 = 0 THEN 0.5 ELSE 1.0 END AS seats
"""


def strict_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(f"SELECT {STRICT_SELECT_SQL} FROM {{li}} JOIN {{pa}} ON l_partkey = p_partkey",
                     li=read(spark, sf_dir, "lineitem"), pa=read(spark, sf_dir, "part"))
