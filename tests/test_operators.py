"""Properties of the relational, store, split, encoding, scaling, validation and metric operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuemill.operators import (OneHotDropFirst, PopulationStandardScaler, champion_challenger, dedupe,
                                 hash_split, last_wins, lookup_miss, lookup_or_score, null_profile,
                                 regression_metrics, top_n, union_by_name, upsert, validate_rows, with_folds)
import valuemill.operators.validate as VR


def test_one_hot_fixture(spark):
    fit = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    model = OneHotDropFirst(inputCols=["c"]).fit(fit)
    assert model.output_names() == ["c_b", "c_c"]
    test = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (3, "z"), (4, None)], "i int, c string")
    out = model.transform(test).orderBy("i").collect()
    assert [(r.c_b, r.c_c) for r in out] == [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]
    assert "c" not in model.transform(test).columns


def test_one_hot_null_category(spark):
    fit = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    model = OneHotDropFirst(inputCols=["c"]).fit(fit)
    assert model.output_names() == ["c_b", "c_nan"]
    out = model.transform(fit).collect()
    assert sorted((r.c_b, r.c_nan) for r in out) == [(0.0, 0.0), (0.0, 1.0), (1.0, 0.0)]


def test_one_hot_bound(spark):
    fit = spark.range(50).select(F.col("id").cast("string").alias("c"))
    try:
        OneHotDropFirst(inputCols=["c"], maxCategories=10).fit(fit)
        raise AssertionError("expected bound error")
    except ValueError:
        pass


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    m = PopulationStandardScaler(inputCols=["a", "b"]).fit(df)
    out = m.transform(df)
    a = [r.a for r in out.collect() if r.a is not None]
    assert math.isclose(np.mean(a), 0.0, abs_tol=1e-12) and math.isclose(np.std(a), 1.0, rel_tol=1e-12)
    assert math.isclose(m.getOrDefault("scales")[0], math.sqrt(2 / 3))
    assert all(r.b == 0.0 for r in out.collect())          # constant column: divisor 1


def test_hash_split_disjoint_complete(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    s = hash_split(df, ["k"], 0.3)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts["train"] + counts["test"] == 20000
    assert abs(counts["test"] / 20000 - 0.3) < 0.02
    again = hash_split(df.repartition(7), ["k"], 0.3)
    assert s.join(again, ["k", "split"]).count() == 20000   # independent of partitioning


def test_folds_range(spark):
    df = with_folds(spark.range(5000).withColumnRenamed("id", "k"), ["k"], 5)
    vals = {r.fold: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(vals) == set(range(5)) and min(vals.values()) > 800


def test_last_wins_and_upsert(spark):
    rows = [(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "x")]
    df = spark.createDataFrame(rows, "k int, seq int, v string")
    lw = {r.k: r.v for r in last_wins(df, ["k"], ["seq"]).collect()}
    assert lw == {1: "c", 2: "x"}
    store = spark.createDataFrame([(1, 0, "old"), (3, 0, "keep")], "k int, seq int, v string")
    up = upsert(store, df, ["k"], ["seq"])
    got = {r.k: r.v for r in up.collect()}
    assert got == {1: "c", 2: "x", 3: "keep"}
    twice = upsert(up, df, ["k"], ["seq"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, up.collect()))   # idempotent


def test_last_wins_hot_key_uses_partial_aggregation(spark):
    hot = spark.range(30000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("seq"))
    out = last_wins(hot, ["k"], ["seq"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert {r.k: r.seq for r in out.collect()} == {0: 29999, 1: 29997}


def test_lookup_and_miss_complement(spark):
    req = spark.createDataFrame([(1, "h1", 2.0), (2, "h2", 3.0), (3, "h3", 4.0)], "id int, hashed string, x double")
    store = spark.createDataFrame([("h1", 10.0), ("h3", 30.0)], "hashed string, prediction double")
    out = {r.id: (r.hit, r.prediction) for r in lookup_or_score(req, store, "hashed", "prediction", F.col("x") * 2).collect()}
    assert out == {1: (True, 10.0), 2: (False, 6.0), 3: (True, 30.0)}
    assert [r.id for r in lookup_miss(req, store, "hashed").collect()] == [2]


def test_union_by_name_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2,)], "k int")
    u = union_by_name(a, b, source_col="src", sources=["a", "b"]).orderBy("k").collect()
    assert [(r.k, r.s, r.src) for r in u] == [(1, "x", "a"), (2, None, "b")]


def test_dedupe_null_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert dedupe(df).count() == 2


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, None), (None, 2, None), (3, 4, None)], "a int, b int, c int")
    prof = {r.column_name: r for r in null_profile(df).collect()}
    assert prof["a"].null_count == 1 and prof["c"].all_null and not prof["a"].all_null
    assert prof["a"].complete_rows == 0 and prof["a"].row_count == 3


def test_validate_rules(spark):
    df = spark.createDataFrame([("Diesel", 2000), ("Steam", 1800), (None, None)], "fuel string, year int")
    rules = {"fuel_not_allowed": VR.allowed("fuel", ["Diesel", "Petrol"]),
             "year_out_of_range": VR.in_range("year", 1886, 2024)}
    out = validate_rows(df, rules).collect()
    assert [r.is_valid for r in out] == [True, False, False]
    assert out[2].errors == ["fuel_not_allowed", "year_out_of_range"]


def test_metrics_match_numpy(spark):
    rng = np.random.RandomState(0)
    y = rng.uniform(1, 100, 500)
    p = y + rng.normal(0, 5, 500)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    m = regression_metrics(df, "y", "p").first()
    e = y - p
    assert math.isclose(m.mae, np.mean(np.abs(e)), rel_tol=1e-9)
    assert math.isclose(m.rmse, np.sqrt(np.mean(e ** 2)), rel_tol=1e-9)
    assert math.isclose(m.mape, np.mean(np.abs(e) / np.abs(y)), rel_tol=1e-9)
    assert math.isclose(m.r2, 1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2), rel_tol=1e-9)


def test_champion_keeps_ties(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (2.0, 3.0, 3.0)], "y double, a double, b double")
    assert champion_challenger(df, "y", "a", "b").first().winner == "Champion"
    df2 = spark.createDataFrame([(1.0, 0.0, 1.0)], "y double, a double, b double")
    assert champion_challenger(df2, "y", "a", "b").first().winner == "Challenger"


def test_top_n(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0), (3, 6.0)], "id int, ts double")
    assert [r.id for r in top_n(df, ["ts"], 2).collect()] == [2, 3]


def test_exact_split_counts_and_ties(spark):
    from valuemill.operators.split import exact_split
    df = spark.range(10007).withColumnRenamed("id", "k")
    s = exact_split(df, ["k"], 0.3)
    assert s.where("split = 'test'").count() == math.ceil(0.3 * 10007)
    dup = df.unionByName(df.where("k < 100"))           # repeated keys: equal hashes stay together
    s2 = exact_split(dup, ["k"], 0.3)
    per_key = s2.groupBy("k").agg(F.countDistinct("split").alias("sides"))
    assert per_key.where("sides > 1").count() == 0
    assert s2.where("split = 'test'").count() >= math.ceil(0.3 * dup.count())


def test_lookup_hot_key_is_split_by_aqe_and_complete(spark):
    """One key holds a third of the requests. With broadcast off and small skew thresholds, AQE
    splits the hot partition of the sort-merge join; every request row is kept."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        req = spark.range(30000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("hashed"),
            (F.col("id") * 1.0).alias("x"))
        store = spark.range(0, 30000, 7).select(F.col("id").cast("string").alias("hashed"),
                                                 (F.col("id") * 10.0).alias("prediction")) \
            .unionByName(spark.createDataFrame([("hot", -1.0)], "hashed string, prediction double"))
        out = lookup_or_score(req, store, "hashed", "prediction", F.col("x"))
        rows = out.collect()
        assert len(rows) == 30000
        assert sum(1 for r in rows if r.hashed == "hot" and r.prediction == -1.0) == 10000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan[:2000]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_split_edge_fractions(spark):
    from valuemill.operators.split import exact_split
    df = spark.range(500).withColumnRenamed("id", "k")
    for frac, want in ((0.0, 0), (1.0, 500)):
        assert exact_split(df, ["k"], frac).where("split = 'test'").count() == want
        assert hash_split(df, ["k"], frac).where("split = 'test'").count() == want


def test_null_keys_have_a_side_and_a_fold(spark):
    from valuemill.operators.split import exact_split
    df = spark.createDataFrame([(None, 1), (None, 2), (1, None), (2, 3), (3, 4)], "k int, j int")
    assert exact_split(df, ["k"], 0.4).where("split is not null").count() == 5
    folds = with_folds(df, ["k", "j"], 3)
    assert folds.where("fold between 0 and 2").count() == 5
    from valuemill.operators.split import key_digest
    assert spark.createDataFrame([("a", None), (None, "a")], "x string, y string").select(key_digest(["x", "y"])).distinct().count() == 2


def test_integer_fields_take_no_fraction(spark):
    df = spark.createDataFrame([(4.0,), (4.5,), (None,)], "seats double")
    assert [r[0] for r in df.select(VR.typed("seats", "int")).collect()] == [True, False, False]
    assert [r[0] for r in spark.createDataFrame([("4",), ("4.5",), ("x",)], "s string").select(VR.typed("s", "int")).collect()] == [True, False, False]


def test_store_needs_an_order(spark):
    from valuemill.sources import KeyedStore
    with pytest.raises(ValueError):
        KeyedStore(spark, "/nowhere", "k", spark.range(1).schema, order=[])
