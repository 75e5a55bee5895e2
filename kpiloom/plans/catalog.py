"""Named queries over the benchmark tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame built from the
tables under ``sf_dir`` through the test-data adapter, so the work of every
query grows with the tables it reads. Round-trip entries write through a
sink into a fresh folder under the shared checkpoint root and return the
read-back table.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.derive import revenue_estimate, sale_price, spike_flag
from kpiloom.ml import revenue_model
from kpiloom.operators import kpis, serving
from kpiloom.operators.clean import clean_market
from kpiloom.operators.export import unify_kpis
from kpiloom.operators.serving import money_display, revenue_share, serving_summary
from kpiloom.plans.kpis_sql import SQL_KPIS, run_sql_kpi
from kpiloom.plans.shared_scan import all_kpis, kpi_order, some_kpis
from kpiloom.schemas import ALERT_SCHEMA, MARKET_TYPES, ML_PREDICTION
from kpiloom.session import materialize, move_files, scratch_path
from kpiloom.sinks import writers
from kpiloom.sources import events as event_sources
from kpiloom.sources import kpi_store, market, testdata
from kpiloom.streaming.alerts import BATCH, Sink, await_any, await_rows, hype_alerts, parse_events, start_alert_queries, start_shared_sinks

STREAM_FILES = 64  # files a micro-batch of the stream query takes

Query = Callable[[SparkSession, str], DataFrame]


def market_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.market_raw(spark, sf_dir)


def market_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_market(testdata.market_raw(spark, sf_dir))


def _kpi(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.KPIS[name](market_clean(spark, sf_dir))


def _sql_kpi(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql_kpi(spark, name, market_clean(spark, sf_dir))


def revenue_share_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by genre with its share of the total and a ``$1,234.50`` text column."""
    batch = some_kpis(market_clean(spark, sf_dir), ["kpi2_revenue_genre"], materialize=True)
    return money_display(revenue_share(batch["kpi2_revenue_genre"]), ["total_revenue_usd"])


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = some_kpis(market_clean(spark, sf_dir), ["kpi1_revenue_platform", "kpi2_revenue_genre", "kpi6_discount_rate"], materialize=True)
    return serving_summary(batch["kpi1_revenue_platform"], batch["kpi2_revenue_genre"],
                           batch["kpi6_discount_rate"])


def kpi_export_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unify_kpis(some_kpis(market_clean(spark, sf_dir), list(kpis.KPIS), materialize=True))


def chart_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of every dashboard chart with their positions."""
    return serving.chart_tables(some_kpis(market_clean(spark, sf_dir), list(serving.CHARTS), materialize=True))


def kpi_export_sql_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL-form KPI tables stacked into one text table (same one-pass aggregate)."""
    _, sql = all_kpis(market_clean(spark, sf_dir), materialize=True)
    return unify_kpis(sql)


def kpi_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all 16 KPI tables with their places in each table's own order."""
    batch, sql = all_kpis(market_clean(spark, sf_dir), materialize=True)
    return kpi_order(batch, sql)


def market_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows written as CSV and read back with types found in a pass over all of them; the types as text, too."""
    path = scratch_path(spark, "market-csv-inferred")
    writers.write_market_csv(testdata.market_raw(spark, sf_dir), path)
    found = market.read_market_csv(spark, path, infer_schema=True)
    return found.withColumn("types", F.lit(", ".join(f"{c} {t}" for c, t in found.dtypes)))


def curated_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rows written partitioned by platform and scanned back."""
    path = scratch_path(spark, "curated")
    writers.write_curated(market_clean(spark, sf_dir), path)
    return market.read_curated(spark, path)


def market_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows written as CSV, read back as text and cleaned."""
    path = scratch_path(spark, "market-csv")
    writers.write_market_csv(testdata.market_raw(spark, sf_dir), path)
    return clean_market(market.read_market_csv(spark, path))


def market_csv_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, from files with another column order, more columns, whole numbers as "7.0" and dates with a time."""
    raw = testdata.market_raw(spark, sf_dir)
    whole = [c for c, t in MARKET_TYPES.items() if t.typeName() == "integer"]
    other = raw.select(F.lit("x").alias("note"), *[F.col(c).cast("double").alias(c) if c in whole else F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if c == "obs_date" else F.col(c)
                                                   for c in reversed(raw.columns)], F.lit(1).alias("more"))
    path = scratch_path(spark, "market-csv-variants")
    writers.write_market_csv(other, path)
    return clean_market(market.read_market_csv(spark, path))


def curated_view_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL KPI 6 through a named view over the curated Parquet folder."""
    path = scratch_path(spark, "curated-view")
    writers.write_curated(market_clean(spark, sf_dir), path)
    view = market.register_curated_view(spark, path, f"market_curated_{path.rsplit('-', 1)[-1]}")
    return run_sql_kpi(spark, "sql_kpi6_discount_rate", view)


def kpi_export_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPI folders written, loaded tolerantly (one left missing), unified, CSV round trip."""
    base = scratch_path(spark, "kpis")
    frames = some_kpis(market_clean(spark, sf_dir), list(kpis.KPIS), materialize=True)
    paths = writers.write_kpis(frames, base)
    paths["kpi9_not_written"] = f"{base}/kpi9_not_written"
    loaded = kpi_store.load_kpis(spark, paths)
    export_path = scratch_path(spark, "export")
    writers.write_csv_single(unify_kpis(loaded), export_path)
    return kpi_store.read_export_csv(spark, export_path)


def _comparable_alerts(df: DataFrame) -> DataFrame:
    # event_time is a session-zone timestamp; as wall-clock time (the session
    # zone is UTC) it compares equal across engines and client time zones.
    return df.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def event_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records encoded as JSON messages and parsed back."""
    messages = writers.encode_events(testdata.event_rows(spark, sf_dir))
    return _comparable_alerts(parse_events(messages))


def hype_alerts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spike alerts over JSON message files read as a batch."""
    path = scratch_path(spark, "event-messages")
    writers.write_event_messages(testdata.event_rows(spark, sf_dir), path)
    return _comparable_alerts(hype_alerts(parse_events(event_sources.read_event_messages(spark, path))))


def hype_alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spike alerts through the streaming job (file source → Parquet sink), read back."""
    source = scratch_path(spark, "event-stream-in")
    writers.write_event_messages(testdata.event_rows(spark, sf_dir), source)
    output = scratch_path(spark, "alerts")
    _run_alerts(spark, source, output, scratch_path(spark, "alerts-checkpoint"))
    return _comparable_alerts(spark.read.schema(ALERT_SCHEMA).parquet(output))


def _run_alerts(spark: SparkSession, source: str, output: str, checkpoint: str) -> None:
    stream = event_sources.read_event_stream(spark, path=source, max_per_trigger=STREAM_FILES)
    await_any(spark, start_alert_queries(hype_alerts(parse_events(stream)), output, checkpoint, available_now=True), finite=True)


def hype_alerts_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spike alerts of a stream that is stopped, gets more messages and is started again."""
    source, output, checkpoint = (scratch_path(spark, f"restart-{n}") for n in ("in", "alerts", "checkpoint"))
    for part in (0, 1):
        rows = writers.encode_events(testdata.event_rows(spark, sf_dir).where(F.pmod(F.xxhash64("timestamp", "platform", "genre"), F.lit(2)) == part))
        rows.write.mode("append").text(source)
        _run_alerts(spark, source, output, checkpoint)
    return _comparable_alerts(spark.read.schema(ALERT_SCHEMA).parquet(output))


def hype_alerts_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream into two sinks, Parquet and JSON, stopped and started again; the rows of both."""
    source, checkpoint = scratch_path(spark, "shared-in"), scratch_path(spark, "shared-checkpoint")
    sinks = [Sink(kind, scratch_path(spark, f"shared-{kind}")) for kind in ("parquet", "json")]
    for sale in (0, 1):
        rows = testdata.event_rows(spark, sf_dir).where(F.col("is_on_sale") == sale)
        writers.encode_events(rows).write.mode("append").text(source)
        stream = event_sources.read_event_stream(spark, path=source, max_per_trigger=STREAM_FILES)
        start_shared_sinks(hype_alerts(parse_events(stream)), sinks, checkpoint, available_now=True).awaitTermination()
    read = [sink.read(spark, ALERT_SCHEMA).withColumn("sink", F.lit(sink.format)).drop(BATCH) for sink in sinks]
    return _comparable_alerts(read[0].unionByName(read[1]))


def hype_alerts_from_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that come in two parts, read by streams that start at the earliest file and after the first part."""
    source = scratch_path(spark, "position-in")
    parts = [scratch_path(spark, f"position-part-{sale}") for sale in (0, 1)]
    for sale, part in enumerate(parts):
        writers.write_event_messages(testdata.event_rows(spark, sf_dir).where(F.col("is_on_sale") == sale), part)
        if not sale:
            start = event_sources.newest_file_time(spark, part)
            time.sleep(0.05)  # for a clock of milliseconds
    for part in parts:
        move_files(spark, part, source)
    out = []
    for name, position in (("earliest", event_sources.EARLIEST), ("after the first part", start)):
        output, checkpoint = scratch_path(spark, "position-alerts"), scratch_path(spark, "position-checkpoint")
        stream = event_sources.read_event_stream(spark, path=source, max_per_trigger=STREAM_FILES, starting_files=position or event_sources.EARLIEST, start_file=f"{checkpoint}-start")
        await_any(spark, start_alert_queries(hype_alerts(parse_events(stream)), output, checkpoint, available_now=True), finite=True)
        out.append(spark.read.schema(ALERT_SCHEMA).parquet(output).withColumn("start", F.lit(name)))
    return _comparable_alerts(out[0].unionByName(out[1]))


def hype_alerts_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a stream with a timed trigger over two arrivals of files; arrival: in which of them a row came.

    The second part is handed over when the query's progress shows all rows of
    the first one, and the query is stopped when it shows those of the second.
    """
    source, checkpoint = scratch_path(spark, "timed-in"), scratch_path(spark, "timed-checkpoint")
    sink, sizes = Sink("parquet", scratch_path(spark, "timed-alerts")), []
    parts = [scratch_path(spark, f"timed-part-{sale}") for sale in (0, 1)]
    for sale, part in enumerate(parts):
        writers.write_event_messages(testdata.event_rows(spark, sf_dir).where(F.col("is_on_sale") == sale), part)
        sizes.append(event_sources.read_event_messages(spark, part).count())
    move_files(spark, parts[0], source)
    query = start_shared_sinks(hype_alerts(parse_events(event_sources.read_event_stream(spark, path=source))), [sink], checkpoint, trigger="500 milliseconds")
    try:
        first = await_rows(query, sizes[0])
        move_files(spark, parts[1], source)
        await_rows(query, sum(sizes), first)
    finally:
        query.stop()
    arrival = F.when(F.col(BATCH) <= max(first, default=-1), 1).otherwise(2).alias("arrival")
    return _comparable_alerts(sink.read(spark, ALERT_SCHEMA).select(*ALERT_SCHEMA.names, arrival))


def ml_training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_model.training_set(market_clean(spark, sf_dir))


def ml_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled row with the side of the split and the fold that its hash gives."""
    return revenue_model.sided(revenue_model.keyed(ml_training_set(spark, sf_dir)))


# Where the model and the test rows of these tables, in the state named by their files, were saved.
_SAVED: dict[tuple, tuple[str, str]] = {}


def _train(spark: SparkSession, sf_dir: str) -> revenue_model.TrainedModel:
    """Trains, and saves the model and the test rows for the queries that only read them."""
    state = testdata.state_of(spark, sf_dir, ["lineitem", "part"])
    trained = revenue_model.train(ml_training_set(spark, sf_dir))
    model, test = scratch_path(spark, "model"), scratch_path(spark, "model-test")
    revenue_model.save_model(trained.model, model)
    trained.test.write.parquet(test)
    _SAVED[spark.sparkContext.applicationId, sf_dir, state] = (model, test)
    return trained


def _saved(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    """The saved model and test rows; trains if there are none for the tables as they are now."""
    key = (spark.sparkContext.applicationId, sf_dir, testdata.state_of(spark, sf_dir, ["lineitem", "part"]))
    if key not in _SAVED:
        _train(spark, sf_dir)
    model, test = _SAVED[key]
    return revenue_model.load_model(model), spark.read.parquet(test)


def ml_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid search itself, always anew: the mean RMSE over the folds of every combination."""
    return _in_digits(revenue_model.grid_scores(spark, _train(spark, sf_dir).avg_rmse), "avg_rmse")


def _in_digits(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: revenue_model.digits(c) for c in columns})


def _scores(model: PipelineModel, test: DataFrame) -> DataFrame:
    return _in_digits(revenue_model.predictions(model, test), ML_PREDICTION)


def ml_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(*_saved(spark, sf_dir))


def ml_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _saved(spark, sf_dir)
    return _in_digits(revenue_model.metrics(model.transform(test)), "rmse", "r2")


def ml_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_digits(revenue_model.coefficients(spark, _saved(spark, sf_dir)[0]), "value")


def ml_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded model saved again, loaded back and used to score the test rows."""
    model, test = _saved(spark, sf_dir)
    path = scratch_path(spark, "model")
    revenue_model.save_model(model, path)
    return _scores(revenue_model.load_model(path), test)


def ml_least_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients, RMSE and R² of the regression without a penalty, which has a closed form; six digits."""
    train, test = revenue_model.split(materialize(revenue_model.keyed(ml_training_set(spark, sf_dir)), "ml-rows"))
    pipeline, _ = revenue_model.regression(regParam=0.0, elasticNetParam=0.0)
    model = pipeline.fit(train)
    scores = revenue_model.metrics(model.transform(test)).unpivot([], ["rmse", "r2"], "term", "value")
    found = revenue_model.coefficients(spark, model).select("term", "value").unionByName(scores)
    # Six digits: the solvers of two engines differ in the last ones of a double.
    return found.select("term", F.format_string("%.5e", "value").alias("value"))


# Revenue-estimate parameters of the derived-columns query.
ESTIMATE_RATE = 0.15
ESTIMATE_FALLBACK = 100.0


def derived_price_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sale price, revenue estimate and spike flag derived from list prices."""
    # The price in a projection of its own: both of its readers take the computed column.
    rows = testdata.listing_rows(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "concurrent_players",
        sale_price("base_price_usd", "discount_pc", "is_on_sale").alias("current_price_usd"))
    return rows.select(
        "l_orderkey", "l_linenumber", "current_price_usd",
        revenue_estimate("concurrent_players", "current_price_usd", ESTIMATE_RATE, ESTIMATE_FALLBACK).alias("estimated_revenue_usd"),
        spike_flag("concurrent_players").alias("hype_spike"),
    )


def catalog() -> dict[str, Query]:
    out: dict[str, Query] = {
        "market_raw": market_raw,
        "market_clean": market_clean,
    }
    for name in kpis.KPIS:
        out[name] = partial(_kpi, name)
    for name in SQL_KPIS:
        out[name] = partial(_sql_kpi, name)
    out.update({
        "revenue_share_genre": revenue_share_genre,
        "serving_summary": summary,
        "kpi_export_unified": kpi_export_unified,
        "kpi_export_sql_unified": kpi_export_sql_unified,
        "chart_tables": chart_tables,
        "kpi_positions": kpi_positions,
        "curated_roundtrip": curated_roundtrip,
        "market_csv_variants": market_csv_variants,
        "market_csv_inferred": market_csv_inferred,
        "market_csv_roundtrip": market_csv_roundtrip,
        "curated_view_kpi": curated_view_kpi,
        "kpi_export_from_store": kpi_export_from_store,
        "event_json_roundtrip": event_json_roundtrip,
        "hype_alerts_batch": hype_alerts_batch,
        "hype_alerts_stream": hype_alerts_stream,
        "hype_alerts_restart": hype_alerts_restart,
        "hype_alerts_two_sinks": hype_alerts_two_sinks,
        "hype_alerts_from_position": hype_alerts_from_position,
        "hype_alerts_timed": hype_alerts_timed,
        "derived_price_revenue": derived_price_revenue,
        "ml_training_set": ml_training_set,
        "ml_split": ml_split,
        "ml_training": ml_training,
        "ml_predictions": ml_predictions,
        "ml_metrics": ml_metrics,
        "ml_coefficients": ml_coefficients,
        "ml_model_roundtrip": ml_model_roundtrip,
        "ml_least_squares": ml_least_squares,
    })
    return out

