"""One query per operator, on whole tables.

Results hold plain columns only: windows are two columns, vectors are taken
apart, times carry no zone.
"""

from __future__ import annotations

from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions import day_name, elapsed, key_bucket, speed, total
from fareloom.operators import (
    assign_split,
    correlation_matrix,
    describe_columns,
    join_role,
    null_counts,
    numeric_columns,
    small_side,
)
from fareloom.operators.asof import as_of
from fareloom.operators.split import bottom_k, sample_by_key
from fareloom.operators.windows import (
    pane_sketches,
    session_windows,
    united_distinct,
    windowed_distinct,
)
from fareloom.operators.joins import role_of
from fareloom.operators.topk import with_speed
from fareloom.plans import news as N
from fareloom.plans import prepare as P
from fareloom.plans import moments as M
from fareloom.plans import regression as R
from fareloom.plans import tuning as T
from fareloom.plans import reports
from fareloom.plans.views import SPLIT_WEIGHTS, TRIP_KEY, news, table, trips, zones
from fareloom.session import app_id, modified, scratch_path
from fareloom.sources import load_table, parse_events, read_events, save_table
from fareloom.streaming import run_append, run_complete, run_parts
from fareloom.streaming.topic import write_topic

KEY = list(TRIP_KEY)

_once: dict[tuple, object] = {}
_once_lock = RLock()

# Of the streams, whatever the size of the input.
FILES_PER_TRIGGER = 2
STATE_PARTITIONS = 8
SESSION_GAP = "30 seconds"


def once(spark: SparkSession, name: str, sf_dir: str, build):
    """The result of ``build``, kept for the application and the data folder as it is."""
    tables = ("lineitem", "orders", "events")
    changed = tuple(modified(spark, f"{sf_dir}/{t}.parquet") for t in tables)
    slot = (app_id(spark), name, sf_dir, changed)
    with _once_lock:
        if slot not in _once:
            _once[slot] = build()
        return _once[slot]


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the tables hold them."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def prepared(spark, d):
    return P.prepare_trips(trips(spark, d))


def prepared_zones(spark, d):
    return P.add_zones(prepared(spark, d), zones(spark, d))


def prepared_pickup(spark, d):
    """With the pickup zone alone, which is all that some reports read."""
    zone = small_side(zones(spark, d))
    return join_role(prepared(spark, d), zone, "PULocationID", "LocationID", "PU")


# --- sources and sinks ---------------------------------------------------


def scan_parquet(spark, d):
    return load_table(spark, f"{d}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )


def scan_csv(spark, d):
    path = scratch_path(spark, "zones-csv")
    save_table(zones(spark, d), path, "csv")
    return load_table(spark, path, "csv", P.ZONE_SCHEMA)


def scan_csv_inferred(spark, d):
    """Zones by way of CSV, every type taken from the file."""
    path = scratch_path(spark, "zones-csv")
    save_table(zones(spark, d), path, "csv")
    return load_table(spark, path, "csv")


def load_any(spark, d):
    """Suppliers by way of CSV with inferred types, beside their nation from parquet."""
    path = scratch_path(spark, "supplier-csv")
    save_table(table(spark, d, "supplier"), path, "csv")
    supplier = load_table(spark, path, "csv")
    nation = load_table(spark, f"{d}/nation.parquet")
    return supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).select(
        F.col("s_suppkey").cast("long").alias("s_suppkey"),
        "s_name",
        F.col("s_acctbal").cast("double").alias("s_acctbal"),
        "n_name",
    )


def sink_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "processed")
    return reports.write_prepared(trips(spark, d), zones(spark, d), path)


def topic(spark, d):
    """Folder of the news topic, which is written once."""

    def build():
        path = scratch_path(spark, "topic")
        write_topic(news(spark, d), path)
        return path

    return once(spark, "topic", d, build)


def event_stream(spark, d):
    """The parsed topic, ``FILES_PER_TRIGGER`` files a micro-batch."""
    return read_events(
        spark, "text", path=topic(spark, d), maxFilesPerTrigger=str(FILES_PER_TRIGGER)
    )


def stream_source_json(spark, d):
    return plain_times(run_append(event_stream(spark, d), scratch_path(spark, "events")))


def ml_model_roundtrip(spark, d):
    """Whether a tuned forest predicts the same for a test row after save and load."""
    kind, label, features = TUNED["cv_forest"]
    rows, bins = folded(spark, d, "cv_forest")
    model = T.tune(rows, kind, label, {"numTrees": [5, 10], "maxDepth": [5]})
    path = scratch_path(spark, "model")
    R.save_model(model, path)
    _, test = parts(spark, d)
    test = T.in_bins(R.complete_rows(test, features, label), bins).select(*KEY, "features")
    before = model.transform(test).withColumnRenamed("prediction", "saved_prediction")
    after = R.load_tuned(path).transform(before)
    return after.select(
        *KEY,
        (F.col("prediction") == F.col("saved_prediction")).alias("same"),
    )


# --- projections, filters, scalar functions --------------------------------


def trips_valid(spark, d):
    return P.valid_trips(trips(spark, d)).select(*KEY, P.PICKUP, P.DROPOFF)


def speed_valid_trips(spark, d):
    timed = with_speed(trips(spark, d), P.PICKUP, P.DROPOFF, "trip_distance", reports.MIN_HOURS)
    return timed.select(*KEY, "trip_distance", "trip_duration_hours")


def finance_events(spark, d):
    return plain_times(N.finance_events(news(spark, d)))


def select_features(spark, d):
    return prepared(spark, d).select(*KEY, *R.CLEAN.columns, "total_amount")


def drop_fee_columns(spark, d):
    """Two of the eight names are constants added here; the rest are in the view."""
    raw = trips(spark, d).withColumns(
        {"RatecodeID": F.lit(1), "store_and_fwd_flag": F.lit("N")}
    )
    return raw.drop(*P.UNUSED, *P.FEES)


def zones_as_pickup(spark, d):
    return role_of(zones(spark, d), "PULocationID", "LocationID", "PU", P.ZONE_ATTRIBUTES)


def trip_time_parts(spark, d):
    return P.with_time_parts(trips(spark, d)).select(*KEY, "hour", "day_of_week")


def trip_extras(spark, d):
    return trips(spark, d).select(*KEY, total(P.FEES).alias("extras"))


def trip_duration(spark, d):
    seconds = elapsed(P.PICKUP, P.DROPOFF)
    return trips(spark, d).select(
        *KEY, seconds.alias("triptime"), (seconds / 3600.0).alias("trip_duration_hours")
    )


def trip_speed(spark, d):
    timed = with_speed(trips(spark, d), P.PICKUP, P.DROPOFF, "trip_distance", reports.MIN_HOURS)
    return timed.select(
        *KEY, speed("trip_distance", "trip_duration_hours").alias("avg_speed_mph")
    )


def day_names(spark, d):
    return P.with_time_parts(trips(spark, d)).select(
        *KEY,
        "day_of_week",
        day_name("day_of_week").alias("day_name"),
        day_name("day_of_week", legacy_labels=True).alias("legacy_day_name"),
    )


def parse_events_json(spark, d):
    events = table(spark, d, "events")
    return events.select(
        "event_id", F.from_json("props", "k BIGINT").alias("record")
    ).select("event_id", "record.k")


def drop_null_rows(spark, d):
    return R.complete_rows(prepared(spark, d), R.CLEAN, "total_amount").select(
        *KEY, *R.CLEAN.columns, "total_amount"
    )


def numeric_columns_of_trips(spark, d):
    df = prepared_zones(spark, d)
    return df.select(*numeric_columns(df))


def sample_rows(spark, d):
    return prepared(spark, d).select(*KEY, "total_amount").sample(False, 0.01, 42)


def sample_of_keys(spark, d):
    return sample_by_key(prepared(spark, d).select(*KEY, "total_amount"), SPLIT_WEIGHTS)


def sample_per_payment(spark, d):
    """Fifty trips of each kind of payment, whatever the partitions."""
    rows = prepared(spark, d).select(*KEY, "payment_type", "total_amount")
    return bottom_k(rows, KEY, 50, ["payment_type"])


def train_test_split(spark, d):
    return assign_split(prepared(spark, d).select(*KEY), SPLIT_WEIGHTS)


# --- joins -------------------------------------------------------------------


def join_pickup_zone(spark, d):
    fact = prepared(spark, d).select(*KEY, "PULocationID")
    return join_role(fact, small_side(zones(spark, d)), "PULocationID", "LocationID", "PU")


def join_both_zones(spark, d):
    fact = prepared(spark, d).select(*KEY, "PULocationID", "DOLocationID")
    return P.add_zones(fact, zones(spark, d))


def zone_versions(spark, d):
    """Zones that change their name every 500 days, each from another day on."""
    days = F.expr("make_interval(0, 0, 0, LocationID * 37 + v * 500)")
    every = zones(spark, d).select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("v"))
    return every.select(
        "LocationID",
        (F.expr("TIMESTAMP_NTZ '1992-01-01 00:00:00'") + days).alias("valid_from"),
        F.concat("Zone", F.lit(" "), F.col("v").cast("string")).alias("Zone"),
    )


def join_zone_as_of(spark, d):
    """Trips with the name that their pickup zone had at the time."""
    fact = prepared(spark, d).select(*KEY, P.PICKUP, "PULocationID")
    versions = zone_versions(spark, d)
    return plain_times(
        as_of(fact, versions, "PULocationID", P.PICKUP, "LocationID", "valid_from", ["Zone"])
    )


# --- profiles ------------------------------------------------------------------


def profiled(spark, d):
    return prepared_zones(spark, d).drop(*KEY)


# --- streams ---------------------------------------------------------------------


def complete_stream(transform, post=None, rank=None):
    """A query over the topic in complete mode, its result sorted by ``rank``."""

    def run(spark, d):
        result = transform(event_stream(spark, d))
        if rank and post is None:
            result = N.ranked(result, rank)
        out = run_complete(result, scratch_path(spark, "stream"), post, STATE_PARTITIONS)
        return plain_times(N.ranked(out, rank) if rank and post else out)

    return run


def batch_twin(transform, rank=None):
    def run(spark, d):
        result = transform(news(spark, d))
        return plain_times(N.ranked(result, rank) if rank else result)

    return run


def stream_device_usage_append(spark, d):
    """Closed windows only. The topic is in order of time, so no event is late."""
    events = event_stream(spark, d).withWatermark("timestamp", "10 minutes")
    path = scratch_path(spark, "stream")
    return plain_times(run_append(N.device_usage(events), path, STATE_PARTITIONS))


def stream_active_sessions_append(spark, d):
    """Exact sessions of closed windows; both steps forget the windows they closed."""
    events = event_stream(spark, d).withWatermark("timestamp", "10 minutes")
    path = scratch_path(spark, "stream")
    return plain_times(run_append(N.closed_sessions(events), path, STATE_PARTITIONS))


def active_sessions_error(spark, d):
    """Exact counts, and whether the estimate lies within three deviations."""
    events = news(spark, d)
    keys = ["window_start", "window_end", "location"]
    estimate = N.active_sessions(events).withColumnRenamed("active_sessions", "estimate")
    both = N.active_sessions_exact(events).join(estimate, keys)
    exact = F.col("active_sessions")
    within = F.abs(F.col("estimate") - exact) <= 3 * 0.05 * exact + 1
    return plain_times(both.select(*keys, "active_sessions", within.alias("within")))


def sliding_sessions_error(spark, d):
    """Exact sessions of sliding windows, and whether the estimate from stored sketches of
    minutes lies within three deviations."""
    events, keys = news(spark, d), ["window_start", "window_end", "location"]

    def build():
        path = scratch_path(spark, "sketches")
        save_table(pane_sketches(events, "timestamp", N.PANE, ["location"], "session_id"), path)
        return path

    panes = load_table(spark, once(spark, "sketches", d, build))
    estimate = united_distinct(panes, "15 minutes", ["location"], "5 minutes", "estimate")
    slid = events.withColumn("timestamp", F.explode(F.array(*(
        F.col("timestamp") - F.expr(f"INTERVAL {m} MINUTES") for m in (0, 5, 10)
    ))))
    starts = windowed_distinct(slid, "timestamp", "5 minutes", ["location"], "session_id", exact=True)
    exact = starts.withColumn("window_end", F.col("window_start") + F.expr("INTERVAL 15 MINUTES"))
    both = exact.join(estimate, keys)
    known = F.col("distinct_count")
    within = F.abs(F.col("estimate") - known) <= 3 * 1.04 / 64 * known + 1
    return plain_times(both.select(*keys, known.alias("active_sessions"), within.alias("within")))


def user_sessions(spark, d):
    return plain_times(session_windows(news(spark, d), "timestamp", SESSION_GAP, ["user_id"]))


def stream_user_sessions_append(spark, d):
    """Sessions that have ended for certain, merged in state."""
    events = event_stream(spark, d).withWatermark("timestamp", "10 minutes")
    sessions = session_windows(events, "timestamp", SESSION_GAP, ["user_id"])
    return plain_times(run_append(sessions, scratch_path(spark, "stream"), STATE_PARTITIONS))


def alert_stream(transform):
    """Alerts over the topic; each leaves the micro-batch that raised it."""

    def run(spark, d):
        found = transform(event_stream(spark, d))
        return plain_times(run_append(found, scratch_path(spark, "alerts"), STATE_PARTITIONS))

    return run


def stream_panes(spark, d):
    """What the one stream behind all queries on panes counted in each micro-batch."""

    def build():
        path = scratch_path(spark, "panes")
        return run_parts(event_stream(spark, d), path, N.minute_panes)

    return once(spark, "panes", d, build)


def paned(facet, width, name, slide=None, min_count=None):
    def run(spark, d):
        panes = stream_panes(spark, d)
        return plain_times(N.from_panes(panes, facet, width, name, slide, min_count))

    return run


# --- regression -------------------------------------------------------------------


def processed(spark, d):
    """Prepared trips with trip time, written once: training passes over its input
    many times, and a file does not repeat the joins or change when a node is lost. Its
    buckets do not follow from the machine; the join shuffles into them, so that a task
    holds as many rows on large tables as on small ones."""

    def build():
        buckets = R.buckets_of(table(spark, d, "lineitem").count() * 8 // 10)
        timed = P.with_trip_time(P.prepare_trips(trips(spark, d, buckets)))
        labelled = assign_split(timed, SPLIT_WEIGHTS).drop(P.PICKUP, P.DROPOFF)
        path = scratch_path(spark, "training")
        return R.training_table(
            labelled, KEY, path, partition_by=["split"], parted=(buckets, KEY[0])
        )

    return once(spark, "training", d, build)


def parts(spark, d):
    """Train rows and test rows."""
    data = processed(spark, d)
    return tuple(data.filter(F.col("split") == p).drop("split") for p in ("train", "test"))


def scored(kind, label, features, scale=False):
    """Scores on the test part of a model fitted on the train part."""

    def run(spark, d):
        train, test = parts(spark, d)
        model = R.fit(train, kind, label, features, scale)
        predictions = R.predict(model, test, features, label)
        return R.metrics(predictions, label).select(
            F.lit(kind).alias("model"), F.lit(label).alias("label"), "*"
        )

    return run


# Tuning jobs: estimator, label, features.
TUNED = {
    "cv_forest": ("forest", "total_amount", R.LEAKY),
    "cv_gbt": ("boosted", "total_amount", R.LEAKY),
    "cv_distance": ("forest", "trip_distance", R.DISTANCE),
}


def folded(spark, d, name):
    """Training rows of a tuning job as (features, label, fold), and the stages that make
    the features."""
    kind, label, features = TUNED[name]
    train, _ = parts(spark, d)
    rows = R.complete_rows(train, features, label)
    bins = T.fit_bins(rows, features)
    fold = key_bucket(SPLIT_WEIGHTS, R.FOLDS[kind], shift=10)
    binned = T.in_bins(rows, bins).select("features", label, fold.alias("fold"))
    return T.in_parts(binned), bins


def tuned(spark, d, name):
    """A model tuned over its full grid, on all training rows."""
    kind, label, _ = TUNED[name]
    rows, _ = folded(spark, d, name)
    return T.tune(rows, kind, label, maxMemoryInMB=1024, cacheNodeIds=True)


def cv_scores(name):
    def run(spark, d):
        def build():
            """Scores as the session keeps them; a deep forest would fill its driver."""
            return R.grid_scores(tuned(spark, d, name), table(spark, d, "lineitem")).collect()

        scores = spark.createDataFrame(
            once(spark, name, d, build),
            "params MAP<STRING, DOUBLE>, avg_rmse DOUBLE, std_rmse DOUBLE",
        )
        names = sorted(R.GRIDS[TUNED[name][0]])
        return scores.select(
            *(F.col("params")[n].alias(n) for n in names), "avg_rmse", "std_rmse"
        )

    return run


# One feature of few values: trees that see all rows and features predict the mean of
# its group, so these models can be recomputed in SQL.
ONE_CODE = R.FeatureSet(("payment_type",))
ONE_NUMBER = R.FeatureSet(("trip_distance",))
RIDGE_FOLDS, RIDGE_PENALTIES = 3, (0.0, 0.01, 0.1, 1.0)
EXACT = {
    "linear": {"regParam": 0.0, "maxIter": 25},
    "tree": {},
    "forest": {"numTrees": 3, "bootstrap": False, "featureSubsetStrategy": "all"},
    "boosted": {"maxIter": 1},
}


def exact_model(kind, label):
    """Predictions for the test rows of a model that SQL can recompute."""
    features = ONE_NUMBER if kind == "linear" else ONE_CODE

    def run(spark, d):
        train, test = parts(spark, d)
        model = R.fit(train, kind, label, features, **EXACT[kind])
        predictions = R.predict(model, test, features, label)
        return predictions.select(*KEY, F.round("prediction", 6).alias("prediction"))

    return run


def exact_cv(spark, d):
    """Fold scores of trees that predict group means."""
    train, _ = parts(spark, d)
    grid = {"maxDepth": [4, 5]}
    model = R.cross_validate(train, "tree", "tip_amount", ONE_CODE, SPLIT_WEIGHTS, grid, 3)
    return R.grid_scores(model, train).select(
        F.col("params")["maxDepth"].alias("maxDepth"), F.round("avg_rmse", 6).alias("avg_rmse")
    )


def linear_moments(spark, d):
    """Sums of products of all terms of the linear model, by fold of the train rows."""
    train, _ = parts(spark, d)
    fold = key_bucket(SPLIT_WEIGHTS, RIDGE_FOLDS, shift=10)
    return M.moments(train, R.CLEAN, "total_amount", fold)


def ml_moments(spark, d):
    return linear_moments(spark, d).withColumn("total", F.round("total", 4) + 0.0)


def ml_ridge_cv(spark, d):
    """Fold scores of the linear model for several penalties, from one pass."""
    scores = M.ridge_scores(linear_moments(spark, d), RIDGE_PENALTIES)
    return spark.createDataFrame(scores, "penalty double, avg_rmse double, std_rmse double")


def exact_top100(spark, d):
    train, test = parts(spark, d)
    model = R.fit(train, "tree", "total_amount", ONE_CODE)
    predictions = R.predict(model, test, ONE_CODE, "total_amount")
    largest = R.top_predictions(predictions, "total_amount", KEY)
    return largest.withColumn("prediction", F.round("prediction", 6))


def prediction_top100(spark, d):
    train, test = parts(spark, d)
    model = R.fit(train, "forest", "total_amount", R.LEAKY)
    predictions = R.predict(model, test, R.LEAKY, "total_amount")
    return R.top_predictions(predictions, "total_amount", KEY)


def fare_rule(df):
    """A fixed formula in place of a model, so that scores can be recomputed in SQL."""
    return df.withColumn(
        "prediction", F.lit(6.0) + F.col("fare_amount") + F.col("trip_distance") * 0.25
    )


def regression_metrics(spark, d):
    return R.metrics(fare_rule(prepared(spark, d)), "total_amount", digits=6)


def rule_top100(spark, d):
    return R.top_predictions(fare_rule(prepared(spark, d)), "total_amount", KEY)


def onehot_codes(spark, d):
    coded = prepared(spark, d).select(*KEY, *R.CLEAN.codes)
    return R.onehot_positions(coded, R.CLEAN.codes)


def assemble_features(spark, d):
    names = R.LEAKY.columns
    (assembler,) = R.feature_stages(R.LEAKY)
    assembled = assembler.transform(prepared(spark, d))
    return assembled.select(*KEY, *R.feature_columns(assembled, [f"f_{n}" for n in names]))


def normalize_features(spark, d):
    numeric = R.FeatureSet(R.LEAKY.numeric)
    data = processed(spark, d)
    assembler, scaler = R.feature_stages(numeric, scale=True)
    assembled = assembler.transform(data)
    scaled = scaler.fit(assembled).transform(assembled)
    flat = scaled.select(*KEY, *R.feature_columns(scaled, [f"z_{n}" for n in numeric.numeric]))
    return flat.select(
        *KEY, *((F.round(f"z_{n}", 6) + 0.0).alias(f"z_{n}") for n in numeric.numeric)
    )


QUERIES = {
    # named batch queries
    "revenue_by_hour_zone": lambda s, d: reports.revenue_by_hour_zone(prepared_pickup(s, d)),
    "prepare_trips": prepared_zones,
    "zone_pair_counts": lambda s, d: reports.zone_pair_counts(prepared_zones(s, d)),
    "fastest_trips": lambda s, d: reports.fastest_trips(prepared_zones(s, d)),
    "avg_speed_by_pair": lambda s, d: reports.avg_speed_by_pair(prepared_zones(s, d), digits=6),
    "avg_tip_by_hour": lambda s, d: reports.avg_tip_by_hour(prepared(s, d), digits=6),
    "trips_by_day_hour": lambda s, d: reports.trips_by_day_hour(prepared(s, d)),
    "trips_by_day_hour_legacy": lambda s, d: reports.trips_by_day_hour(
        prepared(s, d), legacy_labels=True
    ),
    # sources and sinks
    "scan_parquet": scan_parquet,
    "scan_csv": scan_csv,
    "scan_csv_inferred": scan_csv_inferred,
    "load_table": load_any,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "stream_source_json": stream_source_json,
    # projections, filters, scalar functions
    "trips_valid": trips_valid,
    "speed_valid_trips": speed_valid_trips,
    "finance_events": finance_events,
    "select_features": select_features,
    "drop_fee_columns": drop_fee_columns,
    "zones_as_pickup": zones_as_pickup,
    "trip_time_parts": trip_time_parts,
    "trip_extras": trip_extras,
    "trip_duration": trip_duration,
    "trip_speed": trip_speed,
    "day_names": day_names,
    "parse_events_json": parse_events_json,
    "drop_null_rows": drop_null_rows,
    "numeric_columns": numeric_columns_of_trips,
    "sample_rows": sample_rows,
    "sample_of_keys": sample_of_keys,
    "sample_per_payment": sample_per_payment,
    "train_test_split": train_test_split,
    # joins
    "join_pickup_zone": join_pickup_zone,
    "join_both_zones": join_both_zones,
    "join_zone_as_of": join_zone_as_of,
    # profiles
    "null_counts": lambda s, d: null_counts(profiled(s, d)),
    "describe_columns": lambda s, d: describe_columns(profiled(s, d), digits=6),
    "correlation_matrix": lambda s, d: correlation_matrix(
        processed(s, d).drop(*KEY, "triptime", "split"), digits=6
    ),
    # windows on static tables
    "finance_by_country": batch_twin(N.finance_by_country, "count"),
    "top10_countries": batch_twin(lambda e: N.top_countries(N.finance_by_country(e)), "count"),
    "device_usage": batch_twin(N.device_usage, "count"),
    "active_sessions_approx": batch_twin(N.active_sessions, "active_sessions"),
    "active_sessions": batch_twin(N.active_sessions_exact, "active_sessions"),
    "article_spikes": batch_twin(N.article_spikes),
    "bot_users": batch_twin(N.bot_users),
    "bot_users_distinct_articles": batch_twin(N.bot_users_distinct_articles),
    # the same on streams
    "stream_finance_by_country": complete_stream(N.finance_by_country, rank="count"),
    "stream_top10_countries": complete_stream(N.finance_by_country, N.top_countries, "count"),
    "stream_device_usage": complete_stream(N.device_usage, rank="count"),
    "stream_active_sessions": complete_stream(N.active_sessions, rank="active_sessions"),
    "stream_active_sessions_exact": complete_stream(
        N.session_activity, N.count_sessions, "active_sessions"
    ),
    "stream_article_spikes": complete_stream(N.article_spikes),
    "stream_bot_users": complete_stream(N.bot_users),
    "stream_device_usage_append": stream_device_usage_append,
    "stream_active_sessions_append": stream_active_sessions_append,
    "active_sessions_error": active_sessions_error,
    "sliding_sessions_error": sliding_sessions_error,
    "user_sessions": user_sessions,
    "stream_user_sessions_append": stream_user_sessions_append,
    "spike_alerts": batch_twin(N.spike_alerts),
    "bot_alerts": batch_twin(N.bot_alerts),
    "stream_spike_alerts": alert_stream(N.spike_alerts),
    "stream_bot_alerts": alert_stream(N.bot_alerts),
    # from the panes of one stream
    "panes_finance_by_country": paned("finance", N.FINANCE_WIDTH, "location"),
    "panes_device_usage": paned("device", N.DEVICE_WIDTH, "device_type"),
    "panes_article_spikes": paned(
        "article", N.SPIKE_WIDTH, N.SPIKE_COLUMN, min_count=N.SPIKE_VIEWS
    ),
    "panes_bot_users": paned("user", N.BOT_WIDTH, N.BOT_COLUMN, min_count=N.BOT_VIEWS),
    "panes_sliding_spikes": paned(
        "article", N.SPIKE_WIDTH, N.SPIKE_COLUMN, "5 minutes", N.SPIKE_VIEWS
    ),
    # regression
    "onehot_codes": onehot_codes,
    "assemble_features": assemble_features,
    "normalize_features": normalize_features,
    "regression_metrics": regression_metrics,
    "rule_top100": rule_top100,
    "ml_glr_total": scored("linear", "total_amount", R.CLEAN),
    "ml_tree_total": scored("tree", "total_amount", R.CLEAN),
    "ml_forest_total": scored("forest", "total_amount", R.LEAKY),
    "ml_forest_distance": scored("forest", "trip_distance", R.DISTANCE),
    "ml_gbt_total": scored("boosted", "total_amount", R.LEAKY),
    "ml_tip": scored("linear", "tip_amount", R.CLEAN, scale=True),
    "ml_duration": scored("forest", "triptime", R.CLEAN),
    "ml_cv_forest": cv_scores("cv_forest"),
    "ml_cv_gbt": cv_scores("cv_gbt"),
    "ml_cv_distance": cv_scores("cv_distance"),
    "ml_moments": ml_moments,
    "ml_ridge_cv": ml_ridge_cv,
    "ml_exact_linear": exact_model("linear", "total_amount"),
    "ml_exact_tree": exact_model("tree", "total_amount"),
    "ml_exact_tree_tip": exact_model("tree", "tip_amount"),
    "ml_exact_forest_distance": exact_model("forest", "trip_distance"),
    "ml_exact_forest_duration": exact_model("forest", "triptime"),
    "ml_exact_boosted": exact_model("boosted", "total_amount"),
    "ml_exact_cv": exact_cv,
    "ml_exact_top100": exact_top100,
    "ml_model_roundtrip": ml_model_roundtrip,
    "prediction_top100": prediction_top100,
}
