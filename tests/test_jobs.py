"""The jobs end to end on invented recordings: files, bronze, silver, models, gold."""

import os

import pytest
from pyspark.sql import functions as F
from recordings import DEADLIFT, SQUAT, buttons, write_recording

from setwise import contract as C
from setwise.operators import models
from setwise.plans import scoring, training
from setwise.session import work_dir
from setwise.sources import tables
from setwise.sources.files import exists
from setwise.sources.run_store import RunStore
from setwise.sources.session_files import session_files
from setwise.streaming import silver
from setwise.streaming.ingest import ingest

REST = "." * 30


def stamped(n: int, device: str = "MPU6500") -> str:
    return f"20240115-10{n:02d}12_000123_{device}_fixture.csv"


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def run_all(spark, landing, where=None, **limits):
    """Ingest and label everything in ``landing``; returns the silver job."""
    where = where or work_dir(spark, "lake")
    ingest(spark, str(landing), f"{where}/bronze", f"{where}/state/bronze", **limits)
    job = silver.SilverJob(
        spark, f"{where}/bronze", f"{where}/training", f"{where}/production", f"{where}/state/silver", **limits
    )
    job.run()
    return job


def both_tables(spark, job):
    return (
        rows_of(tables.read_table(spark, job.training, C.TRAINING)),
        rows_of(tables.read_table(spark, job.production, C.PRODUCTION)),
    )


def fill(folder):
    write_recording(folder, stamped(1), SQUAT)
    write_recording(folder, stamped(2), DEADLIFT)
    write_recording(folder, stamped(3), REST)
    write_recording(folder, stamped(4, "MPU9250"), SQUAT)
    write_recording(folder, "nostamp_MPU6500_fixture.csv", SQUAT)
    write_recording(
        folder, stamped(5), REST,
        {2: {"qx1": "NULL"}, 4: {"temp2": "inf"}, 6: {"gx1": "0.000000"}, 8: {"ay2": "bad"}, 10: {"qw1": "0.000000"}},
    )
    return folder


@pytest.fixture()
def landing(tmp_path):
    return fill(tmp_path / "landing")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """The same recordings, ingested and labelled. Only to be read."""
    return run_all(spark, fill(tmp_path_factory.mktemp("landing")))


def test_files_are_typed_and_bad_cells_kept(spark, landing):
    with open(landing / "short.csv", "w") as out:
        out.write(C.HEADER + "\n1.0,2.0\n")
    df = session_files(spark, str(landing))
    assert df.columns == C.BRONZE.names and df.schema["button1"].dataType.simpleString() == "int"
    bad = {r["filename"]: r["_rescued_data"] for r in df.where("_rescued_data is not null").collect()}
    assert bad == {stamped(5): '{"ay2":"bad"}', "short.csv": '{"_line":"1.0,2.0"}'}
    assert df.where(F.col("filename") == stamped(5)).where("qx1 is null").count() == 1


def test_ingest_takes_every_file_once(spark, landing, tmp_path):
    bronze, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    ingest(spark, str(landing), bronze, state, max_files=2)
    first = spark.read.schema(C.BRONZE).parquet(bronze)
    n = first.count()
    assert n == 4 * len(SQUAT) + 2 * len(REST) and first.select("filename").distinct().count() == 6
    ingest(spark, str(landing), bronze, state)
    assert spark.read.parquet(bronze).count() == n
    write_recording(landing, stamped(9), REST)
    ingest(spark, str(landing), bronze, state)
    assert spark.read.parquet(bronze).count() == n + len(REST)


def test_ingest_cuts_batches_by_bytes(spark, landing, tmp_path):
    sizes = [path.stat().st_size for path in landing.iterdir()]
    query = ingest(spark, str(landing), str(tmp_path / "bronze"), str(tmp_path / "state"), max_bytes=2 * max(sizes))
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) >= len(sizes) // 2 > 1
    assert sum(batches) == 4 * len(SQUAT) + 2 * len(REST)


def test_a_session_that_gets_buttons_later_leaves_production(spark, tmp_path):
    """The first delivery has no button and goes to production; the whole session then goes to
    training, and the log says that its old rows went."""
    name, landing, where = F.lit(stamped(1)), tmp_path / "landing", work_dir(spark, "lake")
    write_recording(tmp_path / "whole", stamped(1), SQUAT)
    lines = (tmp_path / "whole" / stamped(1)).read_text().splitlines()
    os.makedirs(landing)
    for part, body in (("a.csv", lines[1:3]), ("b.csv", lines[3:])):
        (landing / part).write_text("\n".join([lines[0], *body]) + "\n")
        ingest(spark, str(landing), f"{where}/bronze", f"{where}/state/bronze", name=name)
        job = silver.SilverJob(spark, f"{where}/bronze", f"{where}/training", f"{where}/production", f"{where}/state/silver")
        job.run()
    assert both_tables(spark, job) == both_tables(spark, run_all(spark, tmp_path / "whole"))
    log = job.production_log()
    assert log.read(C.PRODUCTION, 0).count() == log.read(C.PRODUCTION, 0, kinds=("delete",)).count() == 2


def test_jobs_work_on_catalog_tables(spark, landing, lake, tmp_path):
    tables.create_database(spark, "lake", work_dir(spark, "db"))
    ingest(spark, str(landing), "lake.bronze_table", str(tmp_path / "state"))
    assert spark.table("lake.bronze_table").select("filename").distinct().count() == 6
    tables.create_table(spark, "lake.training_silver", C.TRAINING, ["filename"])
    tables.create_table(spark, "lake.production_silver", C.PRODUCTION, ["filename"])
    job = silver.SilverJob(
        spark, "lake.bronze_table", "lake.training_silver", "lake.production_silver", str(tmp_path / "silver")
    )
    job.run()
    assert both_tables(spark, job) == both_tables(spark, lake)


def test_silver_routes_labels_and_cleans(spark, lake):
    job = lake
    training_rows = tables.read_table(spark, job.training)
    production = tables.read_table(spark, job.production)
    assert set(training_rows.columns) == set(C.TRAINING.names) and set(production.columns) == set(C.PRODUCTION.names)
    codes = {r[0]: r[1] for r in training_rows.select("filename", "excercise_id").distinct().collect()}
    assert codes == {stamped(1): 7, stamped(2): 5, "nostamp_MPU6500_fixture.csv": 7}
    sizes = {r["filename"]: r["count"] for r in production.groupBy("filename").count().collect()}
    assert sizes == {stamped(3): len(REST), stamped(5): len(REST) - 4}
    one = training_rows.where(F.col("filename") == stamped(1)).orderBy("time_vector").first()
    assert str(one["measure_date"]) == "2024-01-15 10:01:12.000123" and one["mpuVersion"] == "MPU6500"
    assert one["timestamp"] == "2024-01-15 10:01:12"
    assert training_rows.where("measure_date is null").count() == len(SQUAT)


def test_batches_and_repeats_give_the_same_tables(spark, landing):
    whole, pieces = run_all(spark, landing), run_all(spark, landing, max_files=1)
    want = both_tables(spark, whole)
    assert both_tables(spark, pieces) == want
    whole.run()
    assert both_tables(spark, whole) == want
    # The same micro-batch again, as after a crash before the stream's own commit.
    logged = rows_of(whole.production_log().read(C.PRODUCTION, 0))
    whole.update(spark.read.schema(C.BRONZE).parquet(whole.bronze), 0)
    assert both_tables(spark, whole) == want
    assert rows_of(whole.production_log().read(C.PRODUCTION, 0)) == logged


def test_a_session_in_two_files_is_labelled_as_a_whole(spark, tmp_path):
    """One session split over two deliveries; the second completes the labels."""
    name = F.lit(stamped(1))
    landing, half = tmp_path / "landing", len(SQUAT) // 2
    write_recording(tmp_path / "whole", stamped(1), SQUAT)
    lines = (tmp_path / "whole" / stamped(1)).read_text().splitlines()
    where = work_dir(spark, "lake")
    os.makedirs(landing)
    for part, body in (("a.csv", lines[1 : 1 + half]), ("b.csv", lines[1 + half :])):
        (landing / part).write_text("\n".join([lines[0], *body]) + "\n")
        ingest(spark, str(landing), f"{where}/bronze", f"{where}/state/bronze", name=name)
        split = silver.SilverJob(
            spark, f"{where}/bronze", f"{where}/training", f"{where}/production", f"{where}/state/silver"
        )
        split.run()
    assert both_tables(spark, split) == both_tables(spark, run_all(spark, tmp_path / "whole"))


def test_heavy_sessions_give_the_same_tables(spark, lake):
    job, where = lake, work_dir(spark, "lake")
    heavy = silver.SilverJob(
        spark, job.bronze, f"{where}/t2", f"{where}/p2", f"{where}/state/heavy", max_rows=9
    )
    assert silver.session_axis(spark.read.schema(C.BRONZE).parquet(job.bronze), 9).chunk is not None
    heavy.run()
    assert both_tables(spark, heavy) == both_tables(spark, job)


def test_resampling_condition(spark, lake):
    job, where = lake, work_dir(spark, "lake")
    thin = silver.SilverJob(
        spark, job.bronze, f"{where}/t2", f"{where}/p2", f"{where}/state/thin", condition=F.col("dec_10ms") == 0
    )
    thin.run()
    times = {r[0] for r in tables.read_table(spark, thin.training).select("time_vector").distinct().collect()}
    assert times == {0.0, 0.1, 0.2, 0.3}


SMALL_TREE = C.TREE_PARAMS | {"maxDepth": 5}
SMALL_FOREST = C.FOREST_PARAMS | {"numTrees": 5, "maxDepth": 5}


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    """A lake with twenty labelled and three unlabelled sessions, and a trained run."""
    landing = tmp_path_factory.mktemp("landing")
    for n in range(20):
        write_recording(landing, stamped(n), SQUAT if n % 2 else DEADLIFT)
    for n in range(20, 23):
        write_recording(landing, stamped(n), REST)
    job = run_all(spark, landing)
    store = RunStore(spark, work_dir(spark, "models"))
    samples = tables.read_table(spark, job.training)
    run = training.train(samples, store, tree=SMALL_TREE, forest=SMALL_FOREST)
    return landing, job, store, run


def test_training_stores_models_and_measurements(spark, trained):
    _, job, store, run = trained
    rows = {r["model"]: r for r in store.runs().collect()}
    assert set(rows) == {spec.name for spec in models.chained_specs()}
    for row in rows.values():
        assert set(row["metrics"]) == {"accuracy", "weighted_precision", "weighted_recall", "f1", "cv_f1"}
        assert row["run_id"] == run and 0 <= row["metrics"]["f1"] <= 1
    assert rows["concentric-model"]["params"]["numTrees"] == "5"
    assert store.latest(C.RUN_NAME, 3)["run_id"] == run
    assert store.latest("other") is None and store.latest(C.RUN_NAME, 4) is None


def test_stored_models_predict_like_fresh_ones(spark, trained):
    _, job, store, run = trained
    samples = tables.read_table(spark, job.training)
    spec = models.chained_specs(tree=SMALL_TREE)[0]
    fresh = models.predict(models.fit(spec, samples), samples, "p").select("filename", "time_vector", "p")
    stored = models.predict(store.load(run, spec.name), samples, "p").select("filename", "time_vector", "p")
    assert rows_of(fresh) == rows_of(stored)


def test_folds_keep_sessions_together(spark, trained):
    _, job, _, _ = trained
    spec = models.chained_specs(tree=SMALL_TREE)[0]
    model, metrics = models.evaluate_by_group(spec, tables.read_table(spark, job.training), "filename")
    assert len(model.avgMetrics) == 1 and metrics.count() == 1


def scoring_job(spark, trained, where, **options):
    _, job, store, _ = trained
    return scoring.ScoringJob(
        spark, job.production, job.production_log(), f"{where}/mark", store, f"{where}/gold", f"{where}/reports", **options
    )


def test_scoring_is_incremental_and_survives_a_crash(spark, trained, monkeypatch):
    landing, job, store, _ = trained
    where = work_dir(spark, "scored")
    score = scoring_job(spark, trained, where)
    # Dies after gold, before the checkpoint moves.
    with monkeypatch.context() as m:
        m.setattr(scoring, "write_report", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            score.run()
    assert not exists(spark, f"{score.checkpoint}/commits/0")
    summary = score.run()
    assert summary.count() == 3
    gold = tables.read_table(spark, score.gold)
    assert gold.count() == 3 * len(REST), "the rows of the failed run were replaced"
    assert {"start_end_excercise_id", "concentric", "eccentric", "events", "events_groups", "rest_time"} <= set(gold.columns)
    assert score.run() is None
    write_recording(landing, stamped(30), REST)
    run_all(spark, landing, os.path.dirname(job.bronze))
    assert score.run().count() == 1
    assert tables.read_table(spark, score.gold).count() == 4 * len(REST)


def test_scoring_heavy_sessions_gives_the_same_rows(spark, trained):
    results = []
    for rows in (10_000, 7):
        score = scoring_job(spark, trained, work_dir(spark, "scored"), max_rows=rows)
        summary = score.run()
        results.append((rows_of(summary), rows_of(tables.read_table(spark, score.gold))))
    assert results[0] == results[1]


def test_scoring_needs_a_complete_run(spark, trained):
    with pytest.raises(LookupError):
        scoring_job(spark, trained, work_dir(spark, "scored"), run_name="absent").run()


def test_recordings_helper():
    assert len(buttons(SQUAT)) == len(SQUAT) and buttons("a") == [(1, 1, 1)]
