"""Registered queries: one per operator (or operator group), each over the whole driver tables.

Every callable takes (spark, sf_dir) and returns a DataFrame. Computed columns carry the same
names as the matching DuckDB oracle in ``valuemill.plans.oracle``; doubles are rounded to 6 places.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuemill.functions import keys, numeric, text
from valuemill.operators import (OneHotDropFirst, PopulationStandardScaler, best_by_mean, champion_challenger,
                                 dedupe, hash_split, last_wins, lookup_miss, lookup_or_score, null_profile,
                                 regression_metrics, slice_rows, top_n, union_by_name, upsert, validate_rows, with_folds)
from valuemill.operators.impute import IterativeImputer
from valuemill.plans import cars
from valuemill.session import materialize, scratch_path, sf_path, spread
from valuemill.sources import (append_requests, decode_binary, infer_types, read_csv, read_csv_inferred, read_csv_split, read_day, read_optional,
                               rename_tail, write_csv)

R = numeric.round6


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, name))


# ------------------------------------------------------------------ scalar functions (F1-F8)

def q_name_split(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    make, model = text.split_name("p_name")
    return p.select("p_partkey", "p_name", make.alias("make"), model.alias("model"))


def q_digits_to_number(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", text.digits_to_number("p_brand").alias("brand_number"),
                    text.digits_to_number("p_type").alias("type_number"))


def q_mileage_kmpl(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", F.expr(cars.FUEL_SQL).alias("fuel"),
                                         F.expr(cars.MILEAGE_TEXT_SQL).alias("mileage"))
    return p.select("p_partkey", "fuel", "mileage", R(text.mileage_kmpl("mileage", "fuel")).alias("mileage_kmpl"))


def q_torque_nm_rpm(spark, sf_dir):
    li = spread(_t(spark, sf_dir, "lineitem")).select("l_orderkey", "l_linenumber",
                                               F.expr(cars.TORQUE_TEXT_SQL).alias("torque"))
    t = text.torque_parts("torque")
    return li.select("l_orderkey", "l_linenumber", "torque",
                     R(t.getField("torque_peak_power")).alias("torque_peak_power"),
                     t.getField("torque_peak_speed").alias("torque_peak_speed"))


PRIORITY_RANKS = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4}


def q_owner_rank(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderpriority",
                    text.map_values("o_orderpriority", PRIORITY_RANKS).alias("owner_rank"))


def q_round_half_even(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    half = F.col("l_quantity") / 2
    return li.select("l_orderkey", "l_linenumber", half.alias("half_qty"),
                     numeric.round_half_even(half).alias("seats"))


def q_label_log(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", R(numeric.label_log("o_totalprice")).alias("price_log"))


def q_label_inverse(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    lg = numeric.label_log("o_totalprice")
    return o.select("o_orderkey", R(numeric.label_inverse(lg, "expm1")).alias("price_expm1"),
                    R(numeric.label_inverse(lg, "exp")).alias("price_exp"))


# ------------------------------------------------------------------ encoders, scaler (M1, M3)

def q_one_hot_segment(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return OneHotDropFirst(inputCols=["c_mktsegment"]).fit(c).transform(c)


def q_one_hot_unseen(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation")
    region = _t(spark, sf_dir, "region")
    fit_on = nation.join(region.where(F.col("r_name") == "AMERICA"), nation.n_regionkey == region.r_regionkey,
                         "left_semi").select("n_name")
    cust = _t(spark, sf_dir, "customer").join(nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
                                              "c_nationkey").select("c_custkey", "n_name")
    model = OneHotDropFirst(inputCols=["n_name"]).fit(fit_on)
    out = model.transform(cust)
    return out.select("c_custkey", *[R(F.col(f"`{c}`")).alias(c) for c in model.output_names()])


def q_standard_scale(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_quantity")
    scaled = PopulationStandardScaler(inputCols=["l_tax", "l_quantity"]).fit(li).transform(li)
    return scaled.select("l_orderkey", "l_linenumber", R("l_tax").alias("l_tax"), R("l_quantity").alias("l_quantity"))


# ------------------------------------------------------------------ dedupe, split, keys

def q_dedupe_rows(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier")
    return dedupe(s.unionByName(s))


def q_hash_split(spark, sf_dir):
    return hash_split(_t(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 0.3)


def q_exact_split(spark, sf_dir):
    from valuemill.operators.split import exact_split
    return exact_split(_t(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 0.3)


def q_k_fold(spark, sf_dir):
    return with_folds(_t(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 5)


KEY_NUMERICS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def q_row_key_hash(spark, sf_dir):
    li = spread(_t(spark, sf_dir, "lineitem")).select("l_orderkey", "l_linenumber", *KEY_NUMERICS)
    k = keys.row_key(li, KEY_NUMERICS, precision=18, scale=6)
    return li.select("l_orderkey", "l_linenumber", k.alias("row_key"), keys.key_hash(k).alias("hashed"))


# ------------------------------------------------------------------ store

CUT = "2024-01-16 00:00:00"  # history before, requests / updates from this instant on


def _events(spark, sf_dir):
    return _t(spark, sf_dir, "events")


def q_upsert_latest(spark, sf_dir):
    ev = _events(spark, sf_dir).select("user_id", "ts", "event_id", "event_type", "value")
    mid = F.expr(f"TIMESTAMP_NTZ '{CUT}'")
    existing = last_wins(ev.where(F.col("ts") < mid), ["user_id"], ["ts", "event_id"])
    updates = ev.where(F.col("ts") >= mid)
    return upsert(existing, updates, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "ts", "event_type", R("value").alias("value"))


def _request_keys(ev: DataFrame) -> DataFrame:
    ev = ev.withColumn("hour", F.hour("ts"))
    return ev.withColumn("hashed", keys.key_hash(keys.row_key(ev, ["event_type", "user_id", "hour"])))


def _store_and_requests(spark, sf_dir):
    ev = _events(spark, sf_dir)
    cut = F.expr(f"TIMESTAMP_NTZ '{CUT}'")
    history = _request_keys(ev.where(F.col("ts") < cut))
    store = history.groupBy("hashed").agg(F.avg("value").alias("prediction"))
    requests = _request_keys(ev.where(F.col("ts") >= cut)).select("event_id", "hashed", "value")
    return store, requests


def q_lookup_or_score(spark, sf_dir):
    store, requests = _store_and_requests(spark, sf_dir)
    out = lookup_or_score(requests, store, "hashed", "prediction",
                          numeric.label_inverse(numeric.label_log("value"), "exp"))
    return out.select("event_id", "hashed", "hit", R("prediction").alias("prediction"))


def _looked_up(store, requests):
    j = store.lookup(requests, "prediction")
    score = numeric.label_inverse(numeric.label_log("value"), "exp")
    hit = F.col("_stored").isNotNull()
    return j.select("event_id", "hashed", hit.alias("hit"), R(F.when(hit, F.col("_stored")).otherwise(score)).alias("prediction"))


def q_store_lookup(spark, sf_dir):
    """Merge-on-read store: history loaded as one batch per day (newest batch wins per key), then
    the later requests are looked up; misses are scored."""
    from valuemill.sources import KeyedStore
    ev = _events(spark, sf_dir)
    cut = F.expr(f"TIMESTAMP_NTZ '{CUT}'")
    daily = _request_keys(ev.where(F.col("ts") < cut)).groupBy("hashed", F.to_date("ts").alias("day")) \
        .agg(F.avg("value").alias("prediction"))
    store = KeyedStore(spark, scratch_path(spark, "keyed-store"), "hashed",
                       T.StructType([T.StructField("hashed", T.StringType()), T.StructField("prediction", T.DoubleType())]),
                       order=["prediction"])  # one row per key and day: nothing to tell apart within a batch
    store.write_batches(daily.withColumn("b", F.datediff("day", F.lit("1970-01-01"))), "b")
    requests = _request_keys(ev.where(F.col("ts") >= cut)).select("event_id", "hashed", "value")
    return _looked_up(store, requests)


def q_store_bucketed(spark, sf_dir):
    """The answers of ``store_lookup`` from a store bucketed by the key: history loaded as one batch per ten days (the newest day
    wins per key), then the later requests are looked up in the batches whose filters pass them; misses are scored."""
    from valuemill.sources import BucketedStore
    ev = _events(spark, sf_dir)
    cut = F.expr(f"TIMESTAMP_NTZ '{CUT}'")
    daily = _request_keys(ev.where(F.col("ts") < cut)).groupBy("hashed", F.to_date("ts").alias("day")).agg(F.avg("value").alias("prediction"))
    schema = T.StructType([T.StructField("hashed", T.StringType()), T.StructField("day", T.DateType()), T.StructField("prediction", T.DoubleType())])
    store = BucketedStore(spark, scratch_path(spark, "bucketed-store"), "hashed", schema, order=["day"], buckets=8)
    store.write_batches(daily.withColumn("b", F.floor(F.datediff("day", F.lit("1970-01-01")) / 10)), "b")
    return _looked_up(store, _request_keys(ev.where(F.col("ts") >= cut)).select("event_id", "hashed", "value"))


def q_lookup_miss(spark, sf_dir):
    store, requests = _store_and_requests(spark, sf_dir)
    return lookup_miss(requests, store, "hashed").select("event_id", "hashed", R("value").alias("value"))


# ------------------------------------------------------------------ union, optional source

def _customer_supplier(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"))
    s = _t(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"))
    return c, s


def q_union_sources(spark, sf_dir):
    c, s = _customer_supplier(spark, sf_dir)
    return union_by_name(c, s, source_col="source", sources=["customer", "supplier"])


PARTY_SCHEMA = T.StructType([
    T.StructField("party_key", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("nationkey", T.IntegerType()), T.StructField("acctbal", T.DoubleType()),
    T.StructField("mktsegment", T.StringType())])


def q_optional_source(spark, sf_dir):
    """customer (required) + supplier (optional, present) + pending requests (optional, absent)."""
    c, _ = _customer_supplier(spark, sf_dir)
    s = read_optional(spark, sf_path(sf_dir, "supplier"), T.StructType([
        T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())]))
    s = s.select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                 F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    pending = read_optional(spark, sf_path(sf_dir, "pending_requests"), PARTY_SCHEMA)
    return union_by_name(c, s, pending, source_col="source", sources=["customer", "supplier", "pending"])


# ------------------------------------------------------------------ request log

def _log_events(spark, sf_dir) -> str:
    path = scratch_path(spark, "request-log")
    ev = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "ts")
    append_requests(ev, path, ts_col="ts")
    return path


def q_requests_by_day(spark, sf_dir):
    path = _log_events(spark, sf_dir)
    log = spark.read.parquet(path)
    return log.groupBy("request_date").agg(F.count(F.lit(1)).alias("n_requests"),
                                            R(F.sum("value")).alias("total_value"))


def q_yesterday_requests(spark, sf_dir):
    run_date = _events(spark, sf_dir).agg(F.max(F.to_date("ts"))).first()[0]
    path = _log_events(spark, sf_dir)
    day = read_day(spark, path, run_date - _dt.timedelta(days=1))
    return day.select("event_id", "user_id", "event_type", R("value").alias("value"), "request_date")


# ------------------------------------------------------------------ validation, profile

ALLOWED_EVENT_TYPES = ["view", "click", "purchase", "signup"]


def event_rules():
    import valuemill.operators.validate as V
    return {
        "event_type_not_allowed": V.allowed("event_type", ALLOWED_EVENT_TYPES),
        "value_out_of_range": V.in_range("value", 0.0, 300.0),
        "user_id_missing": V.required("user_id"),
        "props_missing": V.required("props"),
    }


def q_validate_requests(spark, sf_dir):
    v = validate_rows(_events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "props"), event_rules())
    return v.select("event_id", F.concat_ws(";", "errors").alias("errors"), "is_valid")


def q_validate_strict(spark, sf_dir):
    v = validate_rows(cars.strict_requests(spark, sf_dir), cars.strict_rules())
    return v.select("l_orderkey", "l_linenumber", F.concat_ws(";", "errors").alias("errors"), "is_valid")


def q_row_slice(spark, sf_dir):
    """Rows 11-15 of orders by price (highest first, then key): an explicit order, then offset/limit."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return slice_rows(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10, 5)


def q_table_shape(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(len(li.columns)).alias("n_cols"))


NULL_RULES_SQL = {
    "l_quantity": "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END",
    "l_discount": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END",
    "l_tax": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_tax END",
    "l_comment": "CAST(NULL AS STRING)",
    "l_returnflag": "l_returnflag",
}


def _lineitem_with_nulls(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select(*[F.expr(e).alias(c) for c, e in NULL_RULES_SQL.items()])


def q_null_profile(spark, sf_dir):
    return null_profile(_lineitem_with_nulls(spark, sf_dir))


# ------------------------------------------------------------------ metrics, selection

def _scored_lines(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1000).alias("yhat_champion"),
                     (F.col("l_quantity") * 1500 - F.col("l_discount") * 10000).alias("yhat_challenger"))


def q_regression_metrics(spark, sf_dir):
    m = regression_metrics(_scored_lines(spark, sf_dir), "y", "yhat_champion")
    return m.select(*[R(c).alias(c) for c in ["mae", "rmse", "mape", "r2"]],
                    F.round("neg_mse", 0).alias("neg_mse"), "n")


def q_champion_challenger(spark, sf_dir):
    m = champion_challenger(_scored_lines(spark, sf_dir), "y", "yhat_champion", "yhat_challenger")
    return m.select(F.round("neg_mse_champion", 0).alias("neg_mse_champion"),
                    F.round("neg_mse_challenger", 0).alias("neg_mse_challenger"), "winner")


def q_latest_run(spark, sf_dir):
    runs = _events(spark, sf_dir).select(F.col("event_id").alias("run_id"), "ts",
                                         F.col("event_type").alias("model"), R("value").alias("score"))
    return top_n(runs, ["ts", "run_id"], 1)


def q_best_run(spark, sf_dir):
    runs = _events(spark, sf_dir).select(F.col("user_id").alias("candidate"), "value")
    b = best_by_mean(runs, "candidate", "value")
    return b.select("candidate", R("mean_score").alias("mean_score"))


# ------------------------------------------------------------------ imputation (M2)

def _lines_with_price_gaps(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity",
                     F.expr("CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_extendedprice END").alias("l_extendedprice"))


def q_impute_mean(spark, sf_dir):
    from valuemill.operators.impute import mean_imputer_model
    df = _lines_with_price_gaps(spark, sf_dir)
    out = mean_imputer_model(df, ["l_extendedprice"]).transform(df)
    return out.select("l_orderkey", "l_linenumber", R("l_extendedprice").alias("l_extendedprice"))


def q_impute_ols(spark, sf_dir):
    df = _lines_with_price_gaps(spark, sf_dir)
    model = IterativeImputer(inputCols=["l_extendedprice", "l_quantity"], regressor="ols", order="ascending").fit(df)
    out = model.transform(df)
    return out.select("l_orderkey", "l_linenumber", R("l_extendedprice").alias("l_extendedprice"))


def q_impute_iterative(spark, sf_dir):
    """Bayesian-ridge rounds over the raw car records' numeric features (rows-only check)."""
    from valuemill.plans import featurize
    raw = cars.raw_records(spark, sf_dir)
    stages = featurize.feature_pipeline(cars.KEY_COLS + [cars.LABEL, "request_ts"]).getStages()[:7]
    from pyspark.ml import PipelineModel
    clean = PipelineModel(stages=stages).transform(raw).drop("fuel", "seller_type", "transmission", "make")
    clean = materialize(clean, "parsed")   # parse once; the imputer's passes read the narrow table
    cols = featurize.PROCESSED_HEAD
    model = IterativeImputer(inputCols=cols).fit(clean)
    return model.transform(clean).select(*cars.KEY_COLS, *[R(c).alias(c) for c in cols])


# ------------------------------------------------------------------ landing

def q_csv_round_trip(spark, sf_dir):
    n = _t(spark, sf_dir, "nation")
    path = scratch_path(spark, "nation-csv")
    write_csv(n, path)
    return read_csv(spark, path, n.schema)


def q_csv_documents(spark, sf_dir):
    """Texts with line breaks, quotes and commas through CSV and back."""
    docs = _t(spark, sf_dir, "documents")
    path = scratch_path(spark, "csv-documents")
    write_csv(docs, path)
    return read_csv(spark, path, docs.schema)


def q_csv_split_documents(spark, sf_dir):
    """Texts with line breaks through CSV and back, one file for each split of the table, each file read by its own splits."""
    docs = _t(spark, sf_dir, "documents")
    path = scratch_path(spark, "csv-split-documents")
    write_csv(docs, path)
    return read_csv_split(spark, path, docs.schema)


def _cars_without_schema(spark, sf_dir):
    path = scratch_path(spark, "cars-untyped")
    write_csv(cars.raw_records(spark, sf_dir).select(*cars.KEY_COLS, *cars.FEATURE_INPUTS, cars.LABEL), path)
    return path


def q_csv_inferred_records(spark, sf_dir):
    """Raw car records through CSV without a schema: every column in the type that all its values allow."""
    return read_csv_inferred(spark, _cars_without_schema(spark, sf_dir))


def q_csv_inferred_types(spark, sf_dir):
    """The types themselves, of the car records written with their gaps."""
    from valuemill.sources.csv_split import read_texts
    types = infer_types(read_texts(spark, _cars_without_schema(spark, sf_dir)))
    return spark.createDataFrame(list(types.items()), "name string, dtype string")


def q_land_raw_csv(spark, sf_dir):
    """Raw car records landed as CSV under path-like column names, read back with an explicit
    schema, names tidied, full-row dedupe, then a summary per fuel and transmission."""
    raw = cars.raw_records(spark, sf_dir).select(*cars.FEATURE_INPUTS, cars.LABEL)
    path = scratch_path(spark, "raw-csv")
    write_csv(raw.toDF(*[f"raw/cars/{c}" for c in raw.columns]), path)
    landed_schema = T.StructType([T.StructField(f"raw/cars/{f.name}", f.dataType) for f in raw.schema.fields])
    back = dedupe(rename_tail(read_csv(spark, path, landed_schema)))
    return back.groupBy("fuel", "transmission").agg(F.count(F.lit(1)).alias("n_records"),
                                                     R(F.avg(cars.LABEL)).alias("avg_price"))


def q_decode_utf8(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", F.encode("text", "UTF-8").alias("text"))
    return decode_binary(d).select("doc_id", "text", F.length("text").cast("long").alias("n_chars"))


def q_rename_tail(spark, sf_dir):
    n = _t(spark, sf_dir, "nation")
    landed = n.toDF(*[f"raw/cars/{c}" for c in n.columns])
    return rename_tail(landed)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "name_split": q_name_split,
    "digits_to_number": q_digits_to_number,
    "mileage_kmpl": q_mileage_kmpl,
    "torque_nm_rpm": q_torque_nm_rpm,
    "owner_rank": q_owner_rank,
    "round_half_even": q_round_half_even,
    "label_log": q_label_log,
    "label_inverse": q_label_inverse,
    "one_hot_segment": q_one_hot_segment,
    "one_hot_unseen": q_one_hot_unseen,
    "standard_scale": q_standard_scale,
    "dedupe_rows": q_dedupe_rows,
    "hash_split": q_hash_split,
    "exact_split": q_exact_split,
    "k_fold": q_k_fold,
    "row_key_hash": q_row_key_hash,
    "upsert_latest": q_upsert_latest,
    "lookup_or_score": q_lookup_or_score,
    "lookup_miss": q_lookup_miss,
    "store_lookup": q_store_lookup,
    "store_bucketed": q_store_bucketed,
    "union_sources": q_union_sources,
    "optional_source": q_optional_source,
    "requests_by_day": q_requests_by_day,
    "yesterday_requests": q_yesterday_requests,
    "validate_requests": q_validate_requests,
    "validate_strict": q_validate_strict,
    "row_slice": q_row_slice,
    "table_shape": q_table_shape,
    "null_profile": q_null_profile,
    "regression_metrics": q_regression_metrics,
    "champion_challenger": q_champion_challenger,
    "latest_run": q_latest_run,
    "best_run": q_best_run,
    "impute_mean": q_impute_mean,
    "impute_ols": q_impute_ols,
    "impute_iterative": q_impute_iterative,
    "csv_documents": q_csv_documents,
    "csv_split_documents": q_csv_split_documents,
    "csv_inferred_records": q_csv_inferred_records,
    "csv_inferred_types": q_csv_inferred_types,
    "csv_round_trip": q_csv_round_trip,
    "land_raw_csv": q_land_raw_csv,
    "decode_utf8": q_decode_utf8,
    "rename_tail": q_rename_tail,
}
