"""Streaming scorer: requests arrive as files; each micro-batch is validated, keyed, looked up in the
prediction store, and the misses are scored, added to the store and logged.

Built from ``readStream`` -> ``foreachBatch``, which is at-least-once. A batch that runs again gives the
same results, store rows and log rows, and replaces its own:

* it has a fixed number ``base + batch_id`` in the store, above all batches that were there when the
  stream first started, and looks up lower numbers only, so it never hits rows of its own first attempt;
* the base, the log day and the scoring time are written once, when the stream first starts;
* results, rejects, store rows and log rows of a batch go to folders of that batch, written with overwrite.

Logged misses are in the layout that ``read_day`` / ``read_yesterday`` read. The ``availableNow`` trigger
drains what is there and stops, which suits scheduled runs and tests.

Two things may change while a stream runs:

* the model: ``scorer_of`` names the scorer of each batch. ``score_champion_stream`` asks the runs table before
  a batch is scored and writes the champion's id beside the batch first, so a promotion takes effect from the
  next batch on and a batch that runs again uses the model of its first attempt;
* what arrives: with ``event_time`` a request that is sent again within ``delay`` of its time is answered and
  logged once, also over batches and restarts (``dropDuplicatesWithinWatermark``: the state holds the ids of the
  last ``delay`` only). A request that comes after the watermark has passed it goes to ``late``, is not scored,
  and the log's day is that of the request's own time.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuemill.functions import numeric
from valuemill.operators.store import last_wins
from valuemill.operators.validate import validate
from valuemill.plans import scoring, selection
from valuemill.session import materialize, scratch_path
from valuemill.sources.files import read_optional
from valuemill.sources.keyed_store import KeyedStore
from valuemill.sources.request_log import append_batch, append_batch_by_day

_RUN_SCHEMA = "batch_base long, log_day date, scored_at timestamp"
_ONCE, _TIME = "_once", "_event_time"


class Scorer(NamedTuple):
    """What answers a batch: the model's id, what adds ``hashed`` to valid requests, what adds ``prediction`` to misses."""

    model_id: str
    keyed: Callable[[DataFrame], DataFrame]
    predict: Callable[[DataFrame], DataFrame]


def _run(query_builder, checkpoint: str) -> None:
    q = query_builder.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _started(spark: SparkSession, path: str, base: int, day: _dt.date | None) -> tuple[int, _dt.date, _dt.datetime]:
    """What the first start of this stream fixed; later starts read it."""
    known = read_optional(spark, path, _RUN_SCHEMA).first()
    if known is None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        spark.createDataFrame([(base, day or now.date(), now)], _RUN_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
        known = spark.read.schema(_RUN_SCHEMA).parquet(path).first()
    return known["batch_base"], known["log_day"], known["scored_at"]


def _once_within(checked: DataFrame, request_id: str, event_time: str, delay: str) -> DataFrame:
    """Each valid request that is neither sent again nor late, marked, and beside them all rows as they came."""
    timed = checked.where("is_valid").withColumn(_TIME, F.col(event_time).cast("timestamp"))  # a watermark takes no time without zone
    once = timed.withWatermark(_TIME, delay).dropDuplicatesWithinWatermark([request_id]).drop(_TIME)
    return once.withColumn(_ONCE, F.lit(True)).unionByName(checked.withColumn(_ONCE, F.lit(False)))


def run_request_stream(spark: SparkSession, source_dir: str, schema: T.StructType, rules: dict,
                       keyed: Callable[[DataFrame], DataFrame] | None, predict: Callable[[DataFrame], DataFrame] | None,
                       store, out_dir: str, request_id: str, max_files_per_trigger: int | None = None,
                       batch_base: int | None = None, log_dir: str | None = None, log_day: _dt.date | None = None,
                       scorer_of: Callable[[int], Scorer] | None = None, event_time: str | None = None, delay: str = "1 hour") -> dict[str, str]:
    """Score every request file under ``source_dir``.

    ``keyed`` adds ``hashed`` to valid requests; ``predict`` adds ``prediction`` to misses; ``scorer_of``, if
    given, names both for each batch number instead. ``store`` is a
    ``KeyedStore`` (keys scored by an earlier batch hit; misses become store batch ``base + batch_id``;
    the base is the store's next free id unless ``batch_base`` is given, which must not be below it) or a
    static DataFrame of (hashed, prediction, ...) rows (misses then go to ``out_dir/store_added``).
    With ``event_time`` (a timestamp column) requests without an id or a time are rejected, equal ids within
    ``delay`` are one request, and late ones are set aside.
    Returns the folders: ``results`` (request_id, hashed, hit, prediction; with ``scorer_of`` also model_id, null
    for hits), ``rejected`` (request_id, errors), ``store_added``, ``log`` (requests that were scored, by day) and
    ``late`` (with ``event_time``: late requests as they came, one row an id and batch)."""
    paths = {k: f"{out_dir}/{k}" for k in ("results", "rejected", "store_added", "log", "late", "_checkpoint", "_started")}
    paths["log"] = log_dir or paths["log"]
    keyed_store = store if isinstance(store, KeyedStore) else None
    free = keyed_store.next_batch() if keyed_store else 0
    base, day, scored_at = _started(spark, paths["_started"], free if batch_base is None else batch_base, log_day)
    if batch_base is not None and batch_base != base:
        raise ValueError(f"this stream started with batch_base {base}")
    if batch_base is not None and batch_base < free and not _has_commits(spark, paths["_checkpoint"]):
        raise ValueError(f"batch_base {batch_base} is below the store's next free batch {free}")
    src = spark.readStream.schema(schema)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)
    if event_time is not None:
        rules = {**rules, f"{request_id}_missing": F.col(request_id).isNotNull(), f"{event_time}_missing": F.col(event_time).isNotNull()}
    checked = validate(src.parquet(source_dir), rules)
    if event_time is not None:
        checked = _once_within(checked, request_id, event_time, delay)
    static = None if keyed_store else materialize(store.select("hashed", F.col("prediction").alias("_stored")), "static-store")

    def set_late_aside(came: DataFrame, valid: DataFrame, batch_id: int) -> None:
        """Valid rows whose id is not answered in this batch were sent again, if an earlier batch answered them, or late."""
        gone = came.join(valid.select(request_id), request_id, "left_anti").dropDuplicates([request_id])
        if not gone.isEmpty():
            earlier = read_optional(spark, paths["results"], T.StructType([schema[request_id], T.StructField("batch_id", T.LongType())]))
            gone = gone.join(earlier.where(F.col("batch_id") < batch_id).select(request_id), request_id, "left_anti")
            gone.select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{paths['late']}/batch_id={batch_id}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={batch_id}"
        scorer = scorer_of(batch_id) if scorer_of else Scorer("", keyed, predict)
        batch = batch.persist()
        came = batch.where(f"NOT {_ONCE}").drop(_ONCE) if event_time is not None else batch
        came.where("NOT is_valid").select(request_id, F.concat_ws(";", "errors").alias("errors")) \
            .write.mode("overwrite").parquet(f"{paths['rejected']}/{part}")
        valid = (batch.where(_ONCE).drop(_ONCE) if event_time is not None else batch.where("is_valid")).drop("errors", "is_valid")
        if event_time is not None:
            set_late_aside(came.where("is_valid"), valid, batch_id)
        feats = scorer.keyed(valid)
        joined = keyed_store.lookup(feats, "prediction", before=base + batch_id) if keyed_store else feats.join(static, "hashed", "left")
        joined = joined.persist()
        misses = scorer.predict(joined.where(F.col("_stored").isNull()))
        hits = joined.where(F.col("_stored").isNotNull()).withColumn("prediction", F.col("_stored"))
        named = (lambda model: [model.cast("string").alias("model_id")]) if scorer_of else (lambda model: [])
        res = hits.select(request_id, "hashed", F.lit(True).alias("hit"), "prediction", *named(F.lit(None))).unionByName(
            misses.select(request_id, "hashed", F.lit(False).alias("hit"), "prediction", *named(F.lit(scorer.model_id))))
        res.write.mode("overwrite").parquet(f"{paths['results']}/{part}")
        scored = spark.read.parquet(f"{paths['results']}/{part}").where("NOT hit")
        added = scored.select("hashed", "prediction", F.lit(scored_at).cast("timestamp").alias("scored_at"))
        if keyed_store:
            keyed_store.write_batch(added.select(*keyed_store.schema.fieldNames()), base + batch_id)
        else:
            last_wins(added, ["hashed"], ["prediction"]).write.mode("overwrite").parquet(f"{paths['store_added']}/{part}")
        logged = valid.join(scored.select(request_id), request_id, "left_semi")
        if event_time is not None:
            append_batch_by_day(logged, paths["log"], base + batch_id, event_time)
        else:
            append_batch(logged, paths["log"], base + batch_id, day)
        joined.unpersist()
        batch.unpersist()

    _run(checked.writeStream.foreachBatch(handle), paths["_checkpoint"])
    return paths


def _has_commits(spark: SparkSession, checkpoint: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/offsets")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def score_request_stream(spark: SparkSession, source_dir: str, schema: T.StructType, rules: dict,
                         pipeline: PipelineModel, feature_cols: list[str], model: GBTRegressionModel,
                         store, out_dir: str, request_id: str, inverse: str = "exp", **options) -> dict[str, str]:
    """``run_request_stream`` with a fitted feature pipeline and model; ``options`` are its options."""
    return run_request_stream(
        spark, source_dir, schema, rules, lambda df: scoring.keyed(pipeline.transform(df), feature_cols),
        lambda df: scoring.predict(df, feature_cols, model, inverse), store, out_dir, request_id, **options)


def score_champion_stream(spark: SparkSession, source_dir: str, schema: T.StructType, rules: dict, runs: str,
                          store, out_dir: str, request_id: str, inverse: str = "exp", **options) -> dict[str, str]:
    """``run_request_stream`` with the champion that the runs table names when a batch is first met.

    Its id and location stand in ``out_dir/_champions/batch_id=N`` before the batch is scored; a batch that runs
    again reads them. A stored prediction answers a request whichever champion made it, until a scoring job
    writes a newer one. The driver holds one loaded champion."""
    from valuemill.plans import lifecycle
    loaded: dict[str, Scorer] = {}

    def scorer_of(batch_id: int) -> Scorer:
        run = selection.pinned_champion(spark, runs, f"{out_dir}/_champions", batch_id)
        if run["location"] not in loaded:
            loaded.clear()
            c = lifecycle.champion_at(spark, run)
            loaded[run["location"]] = Scorer(c.model_id, lambda df: scoring.keyed(c.pipeline.transform(df), c.features),
                                             lambda df: scoring.predict(df, c.features, c.model, inverse))
        return loaded[run["location"]]

    return run_request_stream(spark, source_dir, schema, rules, None, None, store, out_dir, request_id, scorer_of=scorer_of, **options)


def stream_lookup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache-aside lookup of event requests by ``run_request_stream`` (the batch ``lookup_or_score`` rule).

    History before the cut is the first batch of a keyed store; the later events are written as request
    files and streamed; misses are scored (exp of log1p of value), stored and logged.
    """
    from valuemill.plans.registry import _store_and_requests
    history, requests = _store_and_requests(spark, sf_dir)
    store = KeyedStore(spark, scratch_path(spark, "event-store"), "hashed", scoring.STORE_SCHEMA, order=["scored_at", "prediction"])
    store.write_batch(history.select("hashed", "prediction", F.lit("2024-01-01").cast("timestamp").alias("scored_at")), 0)
    src = scratch_path(spark, "event-requests")
    requests.repartition(4).write.parquet(src)
    score = numeric.label_inverse(numeric.label_log("value"), "exp")
    paths = run_request_stream(spark, src, requests.schema, {"event_id_missing": F.col("event_id").isNotNull()},
                               lambda df: df, lambda df: df.withColumn("prediction", score),
                               store, scratch_path(spark, "event-stream"), "event_id")
    return spark.read.parquet(paths["results"]).select("event_id", "hashed", "hit", numeric.round6("prediction").alias("prediction"))


def _arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Events as requests that arrive in three parts, by date.

    Every seventh event of the first two parts is sent again with the next one; every eleventh of the first part is held back until the last."""
    from valuemill.plans.registry import _events, _request_keys
    ev = _request_keys(_events(spark, sf_dir)).select("event_id", "ts", "hashed", "value")
    day = F.to_date("ts")
    first, second = day < F.lit("2024-01-11").cast("date"), (day >= F.lit("2024-01-11").cast("date")) & (day < F.lit("2024-01-21").cast("date"))
    held, again = F.col("event_id") % 11 == 0, F.col("event_id") % 7 == 0
    return [ev.where(first & ~held), ev.where(second).unionByName(ev.where(first & ~held & again)),
            ev.where(day >= F.lit("2024-01-21").cast("date")).unionByName(ev.where(second & again)).unionByName(ev.where(first & held))]


def stream_requests_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, outcome (answered or late) and the log's day of requests that are sent again, and of some that come late.

    The stream is started anew for each part, so its state and watermark come from its checkpoint."""
    src, out = scratch_path(spark, "once-requests"), scratch_path(spark, "once-stream")
    store = KeyedStore(spark, scratch_path(spark, "once-store"), "hashed", scoring.STORE_SCHEMA, order=["scored_at", "prediction"])
    for part in _arrivals(spark, sf_dir):
        part.write.mode("append").parquet(src)
        paths = run_request_stream(spark, src, part.schema, {}, lambda df: df.withColumn("hashed", F.col("event_id").cast("string")),
                                   lambda df: df.withColumn("prediction", F.col("value")), store, out, "event_id", event_time="ts", delay="12 days")
    answered = spark.read.parquet(paths["results"]).select("event_id", F.lit("answered").alias("outcome"))
    late = read_optional(spark, paths["late"], part.schema).select("event_id", F.lit("late").alias("outcome"))
    logged = spark.read.parquet(paths["log"]).select("event_id", "request_date")
    return answered.unionByName(late).join(logged, "event_id", "left")


def stream_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, model_id, prediction: requests in two parts, and a challenger promoted between them.

    The runs table holds the two models' factors as parameters; each is applied to the request's value. Keys that the first part scored hit."""
    runs, src, out = (scratch_path(spark, f"promoted-{n}") for n in ("runs", "requests", "stream"))
    store = KeyedStore(spark, scratch_path(spark, "promoted-store"), "hashed", scoring.STORE_SCHEMA, order=["scored_at", "prediction"])

    def scorer_of(batch_id: int) -> Scorer:
        run = selection.pinned_champion(spark, runs, f"{out}/_champions", batch_id)
        factor = float(run["params"]["factor"])
        return Scorer(run["model_id"], lambda df: df, lambda df: df.withColumn("prediction", F.col("value") * factor))

    early, mid, late = _arrivals(spark, sf_dir)
    selection.record_run(spark, runs, "first", "champion", {"factor": 2}, {}, _dt.datetime(2024, 1, 1))
    for part in (early, late.join(early.select("event_id"), "event_id", "left_anti")):
        part = part.groupBy("hashed").agg(F.max("event_id").alias("event_id"), F.max_by("value", "event_id").alias("value"))
        part.write.mode("append").parquet(src)
        paths = run_request_stream(spark, src, part.schema, {}, None, None, store, out, "event_id", scorer_of=scorer_of)
        selection.promote(spark, runs, "Challenger", "first", "second", {"factor": 3}, {})
    return spark.read.parquet(paths["results"]).select("event_id", "hashed", "hit", "model_id", numeric.round6("prediction").alias("prediction"))
