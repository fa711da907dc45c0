"""Every operator as a query over the test tables, for the correctness checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setwise import contract as C
from setwise.functions import scalars as S
from setwise.operators import cleaning, models, phases, relational, signals
from setwise.operators.ordered import rolling_max, row_numbers
from setwise.plans.scoring import ScoringJob
from setwise.plans.training import train
from setwise.plans.views import event_rows, load, sessions
from setwise.session import cut, stored, work_dir
from setwise.sources import tables
from setwise.sources.change_log import ChangeLog, diff_changes, new_rows
from setwise.sources.run_store import RunStore
from setwise.sources.session_files import rescue_cells
from setwise.streaming.ingest import ingest
from setwise.streaming.silver import SilverJob

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ID = ("filename", "event_id")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- edges, runs, latches, labels ---------------------------------------------------


@query
def rising_edges(spark, sf):
    df, axis = sessions(spark, sf)
    return signals.rising_edge(df, axis, "peak", "rising").select(*ID, "peak", "rising")


@query
def falling_edges(spark, sf):
    df, axis = sessions(spark, sf)
    return signals.falling_edge(df, axis, F.col("peak"), "falling").select(*ID, "peak", "falling")


@query
def edges_chunked(spark, sf):
    df, axis = sessions(spark, sf, chunked=True)
    return signals.edges(df, axis, "peak", "rising", "falling").select(*ID, "rising", "falling")


@query
def edge_counts(spark, sf):
    df, axis = sessions(spark, sf)
    df = signals.edges(df, axis, "peak", "rising", "falling")
    return df.groupBy("filename").agg(F.sum("rising").alias("rises"), F.sum("falling").alias("falls"))


@query
def island_runs(spark, sf):
    df, axis = sessions(spark, sf)
    return signals.island_id(df, axis, "peak", "run_id").select(*ID, "peak", "run_id")


@query
def island_runs_chunked(spark, sf):
    df, axis = sessions(spark, sf, chunked=True)
    return signals.island_id(df, axis, "peak", "run_id").select(*ID, "peak", "run_id")


@query
def island_legacy(spark, sf):
    df, axis = sessions(spark, sf)
    return signals.island_id(df, axis, "peak", "run_id", legacy=True).select(*ID, "peak", "run_id")


@query
def row_number_in_session(spark, sf):
    df, axis = sessions(spark, sf)
    return row_numbers(df, axis, "rn").select(*ID, F.col("rn").cast("long").alias("rn"))


def _first_run(spark, sf):
    df, axis = sessions(spark, sf)
    df = signals.first_event_run(df, axis, "first_run")
    return signals.class_code(df, axis, "first_run", "excercise_id"), axis


@query
def first_run_class(spark, sf):
    return _first_run(spark, sf)[0].select(*ID, "first_run", "excercise_id")


@query
def blank_first_run(spark, sf):
    return signals.blank_first_run(_first_run(spark, sf)[0], "first_run").select(*ID, *signals.BUTTONS)


@query
def toggle_latch(spark, sf):
    df, axis = sessions(spark, sf)
    return signals.toggle_latch(df, axis, signals.START_END, "latch").select(*ID, "latch")


@query
def active_class(spark, sf):
    df, axis = _first_run(spark, sf)
    df = signals.blank_first_run(df, "first_run")
    df = signals.toggle_latch(df, axis, signals.START_END, "latch")
    return signals.active_class(df, "latch", "excercise_id", "active").select(*ID, "latch", "active")


@query
def relative_time(spark, sf):
    df, axis = sessions(spark, sf)
    df = signals.toggle_latch(df, axis, signals.START_END, "latch")
    return signals.relative_time(df, axis, "latch", "relative_time").select(*ID, "latch", "relative_time")


LABELLED = (*ID, "relative_time", *signals.BUTTONS, *signals.LABELS)


@query
def phase_labels(spark, sf):
    return signals.label_session(*sessions(spark, sf)).select(*LABELLED)


@query
def phase_labels_chunked(spark, sf):
    return signals.label_session(*sessions(spark, sf, chunked=True)).select(*LABELLED)


@query
def phase_labels_legacy(spark, sf):
    return signals.label_session(*sessions(spark, sf), legacy=True).select(*LABELLED)


# --- smoothing, phases, summaries ---------------------------------------------------

def predicted_class() -> Column:
    return F.when(F.col("event_type") == "purchase", 7).when(F.col("event_type") == "view", 5).otherwise(0)


@query
def rolling_max_101(spark, sf):
    df, axis = sessions(spark, sf)
    out = phases.smooth_class(df.withColumn("code", predicted_class()), axis, "code", "smooth")
    return out.select(*ID, "code", "smooth")


@query
def rolling_max_values(spark, sf):
    df, axis = sessions(spark, sf)
    return rolling_max(df, axis, F.col("value"), "highest", 5, 3).select(*ID, "highest")


@query
def rolling_max_chunked(spark, sf):
    df, axis = sessions(spark, sf, chunked=True)
    return rolling_max(df, axis, F.col("value"), "highest", 5, 3).select(*ID, "highest")


@query
def label_map(spark, sf):
    df = event_rows(spark, sf).withColumn("code", predicted_class())
    return df.select(*ID, "code", S.class_name("code").alias("label"))


def _directions(df: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return df.withColumns(
        {
            phases.LABEL: S.class_name(predicted_class()),
            "concentric": kind.isin("click", "purchase", "view").cast("double"),
            "eccentric": kind.isin("error", "purchase").cast("double"),
        }
    )


@query
def xor_flag(spark, sf):
    return _directions(event_rows(spark, sf)).select(*ID, phases.movement().alias("events"))


@query
def time_markers(spark, sf):
    df, _ = sessions(spark, sf)
    return phases.time_markers(_directions(df)).select(*ID, *phases.SPANS)


@query
def time_markers_legacy(spark, sf):
    df, _ = sessions(spark, sf)
    return phases.time_markers(_directions(df), rest_rule="legacy").select(*ID, *phases.SPANS)


def _marked(spark, sf, chunked=False, legacy=False):
    """Sessions whose own labels stand for predictions."""
    df, axis = sessions(spark, sf, chunked)
    df = signals.label_session(df, axis)
    if chunked:  # read twice: for the stretches and to give these to the rows
        df = cut(df)
    rule = "legacy" if legacy else "both_zero"
    return phases.mark_phases(df, axis, rest_rule=rule, legacy=legacy), axis


def _phases(spark, sf, legacy=False):
    marked, axis = _marked(spark, sf, legacy=legacy)
    table = phases.phase_table(marked, ("filename",), "time_us")
    return table, phases.phase_axis(axis.chunk)


@query
def movement_runs(spark, sf):
    return _marked(spark, sf)[0].select(*ID, phases.LABEL, "events", "events_groups")


@query
def movement_runs_chunked(spark, sf):
    return _marked(spark, sf, chunked=True)[0].select(*ID, phases.LABEL, "events", "events_groups")


@query
def phase_spans(spark, sf):
    return _phases(spark, sf)[0]


def _phases_of_chunks(spark, sf):
    """Phases of sessions in chunks, straight from their labelled rows."""
    df, axis = sessions(spark, sf, chunked=True)
    return phases.phases_of(signals.label_session(df, axis), axis, ("filename",)), axis


@query
def phase_spans_chunked(spark, sf):
    return _phases_of_chunks(spark, sf)[0]


@query
def phase_spans_legacy(spark, sf):
    return _phases(spark, sf, legacy=True)[0]


@query
def set_ids(spark, sf):
    return phases.set_ids(*_phases(spark, sf)).select(
        "filename", "events_groups", phases.LABEL, "phase_start", "group_id"
    )


@query
def session_summary(spark, sf):
    return phases.session_summary(phases.set_ids(*_phases(spark, sf)), ("filename",))


@query
def session_summary_chunked(spark, sf):
    return phases.summarise_phases(*_phases_of_chunks(spark, sf), ("filename",))


@query
def json_report(spark, sf):
    path, summary = work_dir(spark, "report"), session_summary(spark, sf)
    tables.write_report(summary, path)
    return tables.read_report(spark, path, summary.schema)


@query
def conditional_aggregates(spark, sf):
    named = F.col("event_type") != "signup"
    return event_rows(spark, sf).groupBy("filename").agg(
        F.countDistinct(F.when(named, F.col("event_type"))).alias("kinds"),
        F.mode(F.when(named, F.col("event_type")), deterministic=True).alias("commonest"),
        F.round(F.sum("value"), 4).alias("total"),
        F.round(F.avg("value"), 4).alias("mean"),
        F.count_if(F.col("value") > 50).alias("above_50"),
        F.count(F.lit(1)).alias("n"),
    )


# --- cleaning, resampling, projection -----------------------------------------------


@query
def raster_columns(spark, sf):
    df, _ = sessions(spark, sf)
    added = ("time_sec", "time_100ms", "time_10ms", "dec_100ms", "dec_10ms")
    return cleaning.raster_columns(df).select(*ID, "time_vector", *added)


@query
def downsample_ticks(spark, sf):
    df, _ = sessions(spark, sf)
    return cleaning.downsample(df, 20).select(*ID, "time_vector")


@query
def resample_condition(spark, sf):
    df, _ = sessions(spark, sf)
    return cleaning.resample_where(df, F.col("dec_10ms") == 0).select(*ID, "time_vector")


@query
def clean_samples(spark, sf):
    """Zero discounts and taxes count as missing; the inverse quantity-free rate is
    infinite where the discount is zero."""
    df = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax", F.pow("l_discount", F.lit(-1.0)).alias("inverse")
    )
    return cleaning.clean_samples(df, ["l_tax"])


@query
def clean_events(spark, sf):
    return cleaning.clean_samples(event_rows(spark, sf), ["value"]).select(*ID, "value")


@query
def infinite_to_nan(spark, sf):
    df = load(spark, sf, "lineitem").select("l_returnflag", F.pow("l_discount", F.lit(-1.0)).alias("inverse"))
    df = cleaning.infinite_to_nan(df)
    return df.groupBy("l_returnflag").agg(
        F.count_if(F.isnan("inverse")).alias("nans"), F.count_if(~F.isnan("inverse")).alias("numbers")
    )


@query
def route_split(spark, sf):
    training, production = cleaning.route(_first_run(spark, sf)[0])
    both = training.withColumn("route", F.lit("training")).unionByName(production.withColumn("route", F.lit("production")))
    return both.select(*ID, "excercise_id", "route")


@query
def rename_project(spark, sf):
    names = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "price"}
    return cleaning.select_renamed(load(spark, sf, "orders"), names)


@query
def project_without(spark, sf):
    return cleaning.without(load(spark, sf, "part"), ["p_size", "p_retailprice"])


@query
def filter_contains(spark, sf):
    return load(spark, sf, "part").where(F.col("p_name").contains("ring")).select("p_partkey", "p_name")


@query
def where_sql(spark, sf):
    return load(spark, sf, "orders").where("o_orderstatus = 'F' AND o_totalprice > 1000").select("o_orderkey")


# --- scalar functions ---------------------------------------------------------------


def _named_events(spark, sf):
    """Events with the file name a recorder would give a session that starts there."""
    start = F.col("ts").cast("timestamp")
    device = F.when(F.col("event_type") == "signup", "_MPU9250_").otherwise("_MPU6500_")
    name = F.concat(F.date_format(start, C.STAMP_FORMAT), device, F.col("user_id").cast("string"), F.lit(".csv"))
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("20249999-999999_000000"), device)).otherwise(name)
    path = F.concat(F.lit("/data/in/"), broken)
    return load(spark, sf, "events").select("event_id", "value", path.alias("path"))


@query
def regex_fields(spark, sf):
    return _named_events(spark, sf).select(
        "event_id",
        S.base_name("path").alias("base_name"),
        S.session_stamp("path").alias("stamp"),
        S.device_version("path").alias("device"),
    )


@query
def url_base_name(spark, sf):
    return load(spark, sf, "pages").select("page_id", S.base_name("url").alias("base_name"))


@query
def name_to_timestamp(spark, sf):
    return _named_events(spark, sf).select("event_id", S.session_start("path").alias("started"))


@query
def event_wall_time(spark, sf):
    start = S.session_start("path")
    return _named_events(spark, sf).select(
        "event_id",
        S.wall_time(start, "value").alias("at"),
        S.wall_time_text(start, "value").alias("at_text"),
    )


@query
def temperature_c(spark, sf):
    return event_rows(spark, sf).select(*ID, F.round(S.celsius("value"), 6).alias("celsius"))


@query
def world_frame(spark, sf):
    """The 64 numbers of an embedding as nine poses, a vector and a quaternion each; the last
    number is left over."""
    starts = F.explode(F.sequence(F.lit(0), F.lit(56), F.lit(7)))
    rows = load(spark, sf, "embeddings").select("vec_id", "embedding", starts.alias("start"))
    cells = [F.get("embedding", F.col("start") + i).cast("double") for i in range(7)]
    x, y, z = S.to_world_frame(cells[:3], cells[3:])
    return rows.select(
        "vec_id", "start", *[F.round(c, 6).alias(n) for c, n in ((x, "wx"), (y, "wy"), (z, "wz"))]
    )


@query
def button_codes(spark, sf):
    return event_rows(spark, sf).select(*ID, S.button_code("start_end_excercise", "peak", "trough").alias("code"))


@query
def plot_traces(spark, sf):
    df, axis = sessions(spark, sf)
    df = signals.island_id(df, axis, "peak", "events_groups")
    cells = {f"accel{a}_{s}": F.col("value") + i for i, (a, s) in enumerate([(a, s) for a in "XYZ" for s in ("cs", "ws")])}
    return phases.plot_traces(df.withColumns(cells), "accel")


# --- joins, splits, order -----------------------------------------------------------


@query
def semi_join_keys(spark, sf):
    done = load(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey")).distinct()
    return relational.restrict_to_keys(load(spark, sf, "lineitem"), done, ["l_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query
def left_join_keys(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return relational.left_join_on_keys(
        orders, load(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_custkey"]
    )


@query
def asof_hold_last(spark, sf):
    df, axis = sessions(spark, sf)
    views = df.where("event_type = 'view'").select(*ID, "time_us")
    clicks = df.where("event_type = 'click'").select("filename", "time_us", F.col("value").alias("click_value"))
    return relational.align_hold_last(views, clicks, axis, ["click_value"], stamp="click_us")


@query
def asof_hold_last_chunked(spark, sf):
    df, axis = sessions(spark, sf, chunked=True)
    views = df.where("event_type = 'view'").select(*ID, "time_us")
    clicks = df.where("event_type = 'click'").select("filename", "time_us", F.col("value").alias("click_value"))
    return relational.align_hold_last(views, clicks, axis, ["click_value"], stamp="click_us")


@query
def asof_heavy_right(spark, sf):
    """The latest click by the time of each view, where a third of all users share one device
    and so one session: few views, and clicks that are too many for one task."""
    device = F.when(F.col("filename") % 3 == 0, F.lit(0)).otherwise(F.col("filename"))
    rows = event_rows(spark, sf).withColumn("device", device)
    views = rows.where("event_type = 'view' AND (device <> 0 OR filename = 0 OR value > 90)").select("device", "event_id", "ts_us")
    clicks = rows.where("event_type = 'click'").select("device", "ts_us")
    axis = relational.fit_both(views, clicks, ("device",), "ts_us", ("event_id",), max_rows=20)
    if axis.chunk is None:
        raise AssertionError("the clicks of the shared device are a heavy session")
    return relational.align_hold_last(views, clicks, axis, [], stamp="click_us")


@query
def top1_latest(spark, sf):
    return relational.latest(load(spark, sf, "events"), "ts", ties=["event_id"]).select("event_id", "user_id")


@query
def distinct_keys(spark, sf):
    return load(spark, sf, "events").select("user_id").distinct()


@query
def sorted_scan(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query
def split_by_key(spark, sf):
    train, test = relational.split_by_key(event_rows(spark, sf), "filename", C.TRAIN_PERCENT, C.SPLIT_SEED)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.select(*ID, "part")


@query
def confusion_metrics(spark, sf):
    measured = relational.confusion_metrics(load(spark, sf, "labels"), "quality", "toxic")
    return measured.select(*[F.round(c, 9).alias(c) for c in measured.columns])


# --- tables, upserts, change feeds --------------------------------------------------

ORDER_KEYS = ("o_orderkey",)
ORDER_PART = "o_orderpriority"


def _order_versions(spark, sf):
    """Orders as known before 1996, and a later delivery that repeats two years of them
    at new prices and brings the newer ones."""
    orders = load(spark, sf, "orders")
    known = orders.where("o_orderdate < '1996-01-01'")
    delivery = orders.where("o_orderdate >= '1994-01-01'")
    return known, delivery.withColumn("o_totalprice", F.col("o_totalprice") * 1.1)


def _upserted(spark, target, sf, log=None, between=lambda: None):
    known, delivery = _order_versions(spark, sf)
    for version, updates in enumerate((known, delivery)):
        updates = updates.persist(StorageLevel.DISK_ONLY)
        tables.upsert(spark, target, updates, ORDER_KEYS, ORDER_PART, updates.schema, log, version)
        updates.unpersist()
        between()


@query
def upsert(spark, sf):
    target = work_dir(spark, "orders")
    _upserted(spark, target, sf)
    return tables.read_table(spark, target)


@query
def upsert_null_partition(spark, sf):
    """Orders without a priority are a partition too, whether the touched partitions are
    few enough to be listed or not."""
    known, delivery = _order_versions(spark, sf)
    unknown = F.when(F.col(ORDER_PART) != "5-LOW", F.col(ORDER_PART))
    out = []
    for most in (tables.PRUNED_KEYS, 1):
        target = work_dir(spark, "orders")
        for updates in (known, delivery):
            updates = updates.withColumn(ORDER_PART, unknown)
            tables.upsert(spark, target, updates, ORDER_KEYS, ORDER_PART, max_listed=most)
        out.append(tables.read_table(spark, target).withColumn("listed", F.lit(most > 1)))
    return out[0].unionByName(out[1])


@query
def upsert_duplicates(spark, sf):
    """Every order is delivered twice."""
    target = work_dir(spark, "orders")
    for updates in _order_versions(spark, sf):
        tables.upsert(spark, target, updates.union(updates), ORDER_KEYS, ORDER_PART)
    return tables.read_table(spark, target)


@query
def upsert_by_name(spark, sf):
    """The same through a catalog table."""
    tables.create_database(spark, "setwise_check", work_dir(spark, "warehouse"))
    name = f"setwise_check.orders_{work_dir(spark, 'n').rsplit('-', 1)[1]}"
    schema = load(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).schema
    tables.create_table(spark, name, schema, [ORDER_PART], work_dir(spark, "orders"))
    _upserted(spark, name, sf)
    return tables.read_table(spark, name)


@query
def change_feed(spark, sf):
    known, delivery = _order_versions(spark, sf)
    return diff_changes(known, delivery, ORDER_KEYS)


@query
def upsert_changes(spark, sf):
    log = ChangeLog(spark, work_dir(spark, "log"))
    target = work_dir(spark, "orders")
    _upserted(spark, target, sf, log)
    kinds = ("insert", "update_preimage", "update_postimage")
    return log.read(tables.read_table(spark, target).schema, 0, None, kinds, keep_meta=True).drop("_commit_timestamp")


def _reader(log, schema, times=1):
    """A reader that runs as a stream and writes what is new to it, with the batch that
    brought it. ``times``: how often it does its work for a batch."""
    seen, checkpoint = (work_dir(log.spark, n) for n in ("seen", "checkpoint"))

    def use(records, batch):
        for _ in range(times):
            rows = new_rows(records, batch).withColumn("read_version", F.lit(batch).cast("long"))
            rows.write.mode("overwrite").parquet(f"{seen}/batch={batch}")

    def read():
        log.follow(schema, checkpoint, use)
        return log.spark.read.parquet(seen).drop("batch")

    return read


@query
def incremental_read(spark, sf):
    """A reader that runs after each version and keeps what is new to it."""
    log, target = ChangeLog(spark, work_dir(spark, "log")), work_dir(spark, "orders")
    read = _reader(log, load(spark, sf, "orders").schema)
    _upserted(spark, target, sf, log, between=read)
    return read()


@query
def incremental_read_after_crash(spark, sf):
    """As after crashes: every delivery comes twice, and the reader does its work twice."""
    log, target = ChangeLog(spark, work_dir(spark, "log")), work_dir(spark, "orders")
    read = _reader(log, load(spark, sf, "orders").schema, times=2)
    for version, updates in enumerate(_order_versions(spark, sf)):
        for _ in range(2):
            tables.upsert(spark, target, updates, ORDER_KEYS, ORDER_PART, log=log, delivery=version)
        read()
    return read()


@query
def feed_after_retry(spark, sf):
    """A delivery comes again after its source has grown. The feed has every order once, in
    the version that brought it to the table."""
    log, target = ChangeLog(spark, work_dir(spark, "log")), work_dir(spark, "orders")
    known, delivery = _order_versions(spark, sf)
    deliveries = (0, known), (1, delivery.where("o_orderdate < '1997-01-01'")), (1, delivery), (2, delivery)
    for version, updates in deliveries:
        tables.upsert(spark, target, updates, ORDER_KEYS, ORDER_PART, log=log, delivery=version)
    return log.read(known.schema, 0, keep_meta=True).select("o_orderkey", "_commit_version")


@query
def file_sizes(spark, sf):
    """The largest file of a table that is overwritten with a cap of 300 rows a file, after
    it was written with another one."""
    tables.create_database(spark, "setwise_check", work_dir(spark, "warehouse"))
    name = f"setwise_check.events_{work_dir(spark, 'n').rsplit('-', 1)[1]}"
    rows = load(spark, sf, "events").select("event_id", "event_type")
    out = []
    for kind, target in (("catalog", name), ("path", work_dir(spark, "events"))):
        for most in (2000, 300):
            tables.overwrite_partitions(rows, target, "event_type", most)
        files = tables.read_table(spark, target).groupBy(F.col("_metadata.file_path")).count()
        out.append(files.agg(F.lit(kind).alias("target"), (F.max("count") <= 300).alias("capped"), F.sum("count").alias("n")))
    return out[0].unionByName(out[1])


@query
def capped_append(spark, sf):
    path = work_dir(spark, "gold")
    tables.append_table(load(spark, sf, "events"), path, max_rows_per_file=C.GOLD_ROWS_PER_FILE)
    return tables.read_table(spark, path).select("event_id", "user_id", "value")


# --- streams ------------------------------------------------------------------------


def _recordings(spark, sf, landing=None, part=None) -> str:
    """Every user's history as session files in the recorder's format. ``part`` picks the
    rows of one delivery. A recorder has a folder that names its stamp and device. Its files
    hold many sessions, named in their last cell, and a bounded number of rows, so that there
    are few files for any number of users and no user is too much for a task."""
    df, _ = sessions(spark, sf)
    df = df if part is None else df.join(part, ["filename", "event_id"], "left_semi")
    name = F.concat(F.col("filename").cast("string"), F.lit(".csv"))
    buttons = {"button1": "trough", "button2": "peak", "button3": "start_end_excercise"}
    cells = [F.col(buttons.get(c, "value")).alias(c) for c in C.RAW if c != "timevector"]
    landing = landing or work_dir(spark, "landing")
    recorder = F.lit("20240115-101112_000123_MPU6500").alias("recorder")
    rows = df.select(F.col("time_vector").alias("timevector"), *cells, name.alias(SESSION), recorder)
    rows.hint("rebalance", SESSION).write.mode("append").partitionBy("recorder").option("header", True).csv(landing)
    return landing


SESSION = "session"


def _ingest(spark, landing, bronze, state) -> None:
    recorder = F.regexp_extract(F.col("_metadata.file_path"), r"recorder=([^/]+)", 1)
    ingest(spark, landing, bronze, state, name=F.concat_ws("_", recorder, SESSION), session=SESSION)


def _ingested(spark, sf) -> str:
    landing, bronze, state = _recordings(spark, sf), work_dir(spark, "bronze"), work_dir(spark, "state")
    _ingest(spark, landing, bronze, state)
    return bronze


@query
def stream_ingest(spark, sf):
    bronze = spark.read.schema(C.BRONZE).parquet(_ingested(spark, sf))
    return bronze.select("filename", "timevector", "ax1", "temp2", "button1", "button2", "button3", "_rescued_data")


def _silver_rows(spark, training, production):
    rows = tables.read_table(spark, training, C.TRAINING).withColumn("route", F.lit("training"))
    rest = tables.read_table(spark, production, C.PRODUCTION).withColumn("route", F.lit("production"))
    both = rows.unionByName(rest, allowMissingColumns=True)
    return both.select(
        "filename", "time_vector", "accelX_ws", "relative_time", *signals.LABELS,
        "measure_date", "timestamp", "mpuVersion", "route",
    )


@query
def stream_silver(spark, sf):
    training, production, state = (work_dir(spark, n) for n in ("training", "production", "state"))
    SilverJob(spark, _ingested(spark, sf), training, production, state).run()
    return _silver_rows(spark, training, production)


@query
def capped_batches(spark, sf):
    """A stream that may read a fifth of the bytes at a time reads every row once."""
    bronze = _ingested(spark, sf)
    sizes = spark.read.schema(C.BRONZE).parquet(bronze).select("_metadata.file_path", "_metadata.file_size").distinct()
    cap = sizes.agg(F.sum("file_size")).first()[0] // 5
    training, production, state = (work_dir(spark, n) for n in ("training", "production", "state"))
    job = SilverJob(spark, bronze, training, production, state, max_bytes=cap)
    job.run()
    fits = F.bool_and((F.col("n_bytes") <= cap) | (F.col("n_files") == 1))
    told = job.batches().agg(
        (F.count(F.lit(1)) >= 5).alias("several"), fits.alias("capped"), F.sum("n_rows").alias("n_rows"), F.sum("n_files").alias("n_files")
    )
    once = sizes.agg(F.count(F.lit(1)).alias("all_files"))
    return told.join(once, F.col("n_files") == F.col("all_files")).select("several", "capped", "n_rows")


@query
def stream_silver_split(spark, sf):
    """Each history comes in two deliveries, the first up to the first event with a button,
    so that many sessions go to production first and to training when the rest is there."""
    landing, bronze, state = (work_dir(spark, n) for n in ("landing", "bronze", "state"))
    training, production, silver = (work_dir(spark, n) for n in ("training", "production", "silver"))
    pressed = F.col("trough") + F.col("peak") + F.col("start_end_excercise") > 0
    presses = F.sum(pressed.cast("int")).over(Window.partitionBy("filename").orderBy("time_us", "event_id"))
    for first in (True, False):
        df, _ = sessions(spark, sf)
        part = df.withColumn("__presses", presses).where((F.col("__presses") == 0) == first)
        _recordings(spark, sf, landing, part.select("filename", "event_id"))
        _ingest(spark, landing, bronze, state)
        SilverJob(spark, bronze, training, production, silver).run()
    return _silver_rows(spark, training, production)


@query
def rescued_cells(spark, sf):
    """Events as text, with a type that only some of the cells fit."""
    raw = load(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.get_json_object("props", "$.k").alias("k"),
    )
    kinds = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("k", T.IntegerType()),
        ]
    )
    rescued = rescue_cells(raw, kinds)
    return rescued.select("event_id", "user_id", "k", F.get_json_object("_rescued_data", "$.user_id").alias("rescued"))


# --- models -------------------------------------------------------------------------

MODEL_INPUTS = ("kind", "twin", "value")
KINDS = {"click": 0, "error": 10, "purchase": 20, "signup": 30, "view": 40}


def _training_rows(spark, sf):
    """Events whose labels are exact rules of their kind, which two inputs tell clearly; so
    the rules say what a model has to predict, for known and for new sessions."""
    number = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(float(n))) for k, n in KINDS.items()])
    rows = event_rows(spark, sf).withColumns(
        {
            "kind": number,
            "twin": -number + F.pmod("event_id", F.lit(3)),
            models.SET_LABEL: predicted_class(),
            models.UP_LABEL: F.col("event_type").isin("click", "purchase").cast("int"),
            models.DOWN_LABEL: F.col("event_type").isin("error", "view").cast("int"),
        }
    )
    return rows.select(*ID, *MODEL_INPUTS, models.SET_LABEL, models.UP_LABEL, models.DOWN_LABEL)


@query
def scaled_features(spark, sf):
    rows = _training_rows(spark, sf)
    scaled = models.fit(models.chained_specs(MODEL_INPUTS)[0], rows).transform(rows)
    cells = vector_to_array(C.SCALED_COLUMN)
    return scaled.select(*ID, *[F.round(cells[i], 6).alias(f"scaled_{c}") for i, c in enumerate(MODEL_INPUTS)])


@query
def fold_ids(spark, sf):
    folds = relational.key_bucket("filename", C.SPLIT_SEED + 1, C.FOLDS)
    return event_rows(spark, sf).select("filename", folds.alias("fold")).distinct()


@query
def tree_scores(spark, sf):
    rows = _training_rows(spark, sf)
    spec = models.chained_specs(MODEL_INPUTS)[0]
    return models.predict(models.fit(spec, rows), rows, "prediction").select(*ID, spec.label, "prediction")


@query
def forest_scores(spark, sf):
    rows = _training_rows(spark, sf)
    spec = models.chained_specs(MODEL_INPUTS)[1]
    return models.predict(models.fit(spec, rows), rows, "prediction").select(*ID, spec.label, "prediction")


@query
def cv_by_group(spark, sf):
    rows = _training_rows(spark, sf)
    validated, metrics = models.evaluate_by_group(models.chained_specs(MODEL_INPUTS)[0], rows, "filename")
    return metrics.withColumn("cv_f1", F.lit(validated.avgMetrics[0]))


@query
def chained_scores(spark, sf):
    rows = _training_rows(spark, sf)
    fitted = [models.fit(spec, rows) for spec in models.chained_specs(MODEL_INPUTS)]
    unlabelled = rows.drop(models.SET_LABEL, models.UP_LABEL, models.DOWN_LABEL)
    return models.score_chained(unlabelled, *fitted).select(*ID, models.SET_LABEL, models.UP_LABEL, models.DOWN_LABEL)


@query
def train_run(spark, sf):
    """Train and store all three models; load them again and measure them on all rows."""
    store, rows = RunStore(spark, work_dir(spark, "models")), _training_rows(spark, sf)
    train(rows, store, MODEL_INPUTS)
    run = store.latest(C.RUN_NAME, models=3)
    loaded = [store.load(run["run_id"], spec.name) for spec in models.chained_specs(MODEL_INPUTS)]
    labels = {models.SET_LABEL: "set", models.UP_LABEL: "up", models.DOWN_LABEL: "down"}
    truth = rows.withColumnsRenamed(labels)
    scored = models.score_chained(truth, *loaded)
    measured = [
        relational.confusion_metrics(scored, told, predicted).withColumn("model", F.lit(told)) for predicted, told in labels.items()
    ]
    stored = store.runs().select(
        F.coalesce(*[F.when(F.col("model") == n, k) for n, k in ((C.SET_MODEL, "set"), (C.UP_MODEL, "up"), (C.DOWN_MODEL, "down"))]).alias("model"),
        F.col("metrics.f1").alias("held_out_f1"), F.col("metrics.cv_f1").alias("cv_f1"),
    )
    return measured[0].unionByName(measured[1]).unionByName(measured[2]).join(stored, "model")


def _own_labels(spark, sf):
    """Sessions with the labels that their own buttons give, and what each sample was."""
    df, axis = sessions(spark, sf)
    number = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(float(n))) for k, n in KINDS.items()])
    rows = signals.label_session(df, axis).withColumn("kind", number)
    return rows.select(*ID, "kind", models.SET_LABEL, models.UP_LABEL, models.DOWN_LABEL)


# Trees that split as long as there is anything to tell apart, and one tree on all rows in
# place of a forest: each prediction is then the commonest label of equal inputs, which SQL
# can work out.
PLAIN_TREE = {"maxBins": 32, "maxDepth": 16, "minInfoGain": 0.0, "minInstancesPerNode": 1, "impurity": "entropy"}
PLAIN_FOREST = {"numTrees": 1, "bootstrap": False, "maxDepth": 16, "maxBins": 32, "minInfoGain": 0.0, "impurity": "entropy"}


@query
def own_label_scores(spark, sf):
    """What the chained models say of sessions they have not seen, by fold."""
    specs = models.chained_specs(("kind",), PLAIN_TREE, PLAIN_FOREST)
    scored = models.out_of_fold(specs, _own_labels(spark, sf), "filename", work_dir(spark, "folds"))
    labels = [c for spec in specs for c in (f"told_{spec.label}", spec.label)]
    return scored.select(*ID, "fold", *labels)


@query
def own_label_folds(spark, sf):
    """Size and metrics of each fold of the set model, from its stored predictions."""
    spec = models.chained_specs(("kind",), PLAIN_TREE)[0]
    scored = models.out_of_fold([spec], _own_labels(spark, sf), "filename", work_dir(spark, "folds"))
    told = f"told_{spec.label}"
    sizes = scored.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("filename").alias("sessions"), F.count_if(F.col(told) != 0).alias("in_sets")
    )
    metrics = models.fold_metrics(scored, told, spec.label)
    rounded = [F.round(c, 9).alias(c) for c in metrics.columns if c != "fold"]
    return sizes.join(metrics.select("fold", *rounded), "fold")


@query
def own_label_run(spark, sf):
    """Train and store on the sessions' own labels; what the run store says of the models. In a
    fold, a chained model may meet inputs it was not fitted on, so only the first one's
    validation is told."""
    store, rows = RunStore(spark, work_dir(spark, "models")), _own_labels(spark, sf)
    train(rows, store, ("kind",), tree=PLAIN_TREE, forest=PLAIN_FOREST)
    metric = lambda name: F.round(F.col("metrics")[name], 9).alias(name)
    told = store.runs().select("model", *map(metric, ("accuracy", "weighted_precision", "weighted_recall", "f1", "cv_f1")))
    return told.withColumn("cv_f1", F.when(F.col("model") == C.SET_MODEL, F.col("cv_f1")))


def _sensor_rows(spark, sf):
    """The labelled events in the shape of the silver tables. Times are whole microseconds,
    so that all spans are exact."""
    rows = _training_rows(spark, sf).drop("kind", "twin", "value")
    timed, _ = sessions(spark, sf)
    number = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(float(n))) for k, n in KINDS.items()])
    cells = {c: number * (i % 3 + 1) + F.pmod("event_id", F.lit(2 + i % 5)) for i, c in enumerate(C.SENSOR_CHANNELS)}
    timed = timed.withColumns(cells).withColumn("time_vector", F.col("time_us").cast("double"))
    rows = timed.select(*ID, "time_vector", *C.SENSOR_CHANNELS).join(rows, list(ID))
    return rows.withColumn("filename", F.col("filename").cast("string")).drop("event_id")


@query
def score_sessions(spark, sf):
    """The scoring job over a production table that comes in two deliveries, each session
    cut in two: a run after each, and one with nothing new. Every session has one summary."""
    production, gold, reports, log, mark, models_at = (
        work_dir(spark, n) for n in ("production", "gold", "reports", "log", "mark", "models")
    )
    store, rows, changes = RunStore(spark, models_at), stored(_sensor_rows(spark, sf)), ChangeLog(spark, log)
    run = store.start()
    for spec in models.chained_specs():
        store.save(run, C.RUN_NAME, spec.name, models.fit(spec, rows), spec.settings(), {})
    absent = {f.name: F.lit(None).cast(f.dataType) for f in C.PRODUCTION.fields if f.name not in rows.columns}
    samples = rows.withColumns(absent).select(*C.PRODUCTION.names)
    job = ScoringJob(spark, production, changes, mark, store, gold, reports)
    even = F.pmod(F.xxhash64("time_vector"), F.lit(2)) == 0
    for number, part in enumerate((samples.where(even), samples.where(~even))):
        tables.upsert(spark, production, part, ("filename", "time_vector"), "filename", C.PRODUCTION, changes, number, packed=True)
        job.run()
    if job.run() is not None:
        raise AssertionError("nothing was new")
    if tables.read_table(spark, gold).count() != samples.count():
        raise AssertionError("gold must have every sample once")
    return tables.read_report(spark, reports, C.SUMMARY)
