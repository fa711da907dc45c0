"""Tables, upserts, change logs, incremental reads, run store."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from setwise.session import cut, shared_dir, work_dir
from setwise.sources import tables
from setwise.sources.change_log import KINDS, ChangeLog, diff_changes, new_rows
from setwise.sources.session_files import rescue_cells

SCHEMA = "k int, v string, part string"


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def upsert(spark, target, rows, log=None, delivery=None, **options):
    updates = frame(spark, *rows)
    return tables.upsert(spark, target, updates, ["k", "part"], "part", updates.schema, log, delivery, **options)


def test_upsert_updates_inserts_and_repeats(spark):
    target = work_dir(spark, "t")
    upsert(spark, target, [(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (None, "n", "x")])
    for _ in range(2):
        upsert(spark, target, [(2, "B", "x"), (4, "D", "x"), (None, "N", "x"), (5, "e", "z")])
        want = [(1, "a", "x"), (2, "B", "x"), (3, "c", "y"), (4, "D", "x"), (5, "e", "z"), (None, "N", "x")]
        assert content(tables.read_table(spark, target)) == sorted(want, key=repr)


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    target = str(tmp_path / "t")
    upsert(spark, target, [(1, "a", "x"), (3, "c", "y")])
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob(f"{tables.BUCKET}=*/part=y/*")}
    assert files
    upsert(spark, target, [(1, "A", "x")])
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob(f"{tables.BUCKET}=*/part=y/*")} == files


def test_many_touched_partitions_become_a_join(spark, monkeypatch):
    table, updates = frame(spark, (1, "a", "x"), (2, "b", "y"), (3, "c", "z")), frame(spark, (9, "q", "x"), (9, "q", "y"))
    want = [(1, "a", "x"), (2, "b", "y")]
    assert content(tables.touched_rows(table, updates, "part").select(*table.columns)) == want
    monkeypatch.setattr(tables, "PRUNED_KEYS", 1)
    assert content(tables.touched_rows(table, updates, "part").select(*table.columns)) == want


def fail(*args, **kwargs):
    raise OSError("lost")


def reader(spark, log):
    """A reader that keeps what is new; returns a function that runs it."""
    seen, checkpoint = work_dir(spark, "seen"), work_dir(spark, "checkpoint")

    def use(records, batch):
        new_rows(records, batch).write.mode("overwrite").parquet(f"{seen}/batch={batch}")

    def read():
        log.follow(frame(spark).schema, checkpoint, use)
        return content(tables.read_table(spark, seen, T.StructType([*frame(spark).schema.fields, T.StructField("batch", T.IntegerType())])))

    return read


STEPS = [(ChangeLog, "outcome"), (tables, "overwrite_partitions"), (ChangeLog, "publish")]


@pytest.mark.parametrize("owner, step", STEPS)
def test_an_upsert_survives_a_crash_at_any_point(spark, monkeypatch, owner, step):
    """The retry finishes what was written down, though the source has grown; a reader that
    runs for the first time between sees every row once."""
    target, log = work_dir(spark, "t"), ChangeLog(spark, work_dir(spark, "log"))
    upsert(spark, target, [(1, "a", "x"), (3, "c", "y")], log, 0)
    second = [(1, "A", "x"), (2, "b", "x"), (3, "c", "y")]
    with monkeypatch.context() as m:
        m.setattr(owner, step, fail)
        with pytest.raises(OSError):
            upsert(spark, target, second, log, 1)
    assert log.latest() == 0
    read = reader(spark, log)
    assert read() == [(1, "a", "x", 0), (3, "c", "y", 0)]
    grown = [*second, (4, "d", "x")]
    for _ in range(2):  # once to finish, once as a second delivery
        assert upsert(spark, target, grown if step != "outcome" else second, log, 1) == 1
    assert content(tables.read_table(spark, target)) == [(1, "A", "x"), (2, "b", "x"), (3, "c", "y")]
    kinds = ("insert", "update_preimage", "update_postimage")
    changes = log.read(frame(spark).schema, 1, 1, kinds, True).drop("_commit_timestamp")
    assert content(changes) == [
        (1, "A", "x", "update_postimage", 1), (1, "a", "x", "update_preimage", 1), (2, "b", "x", "insert", 1),
    ], "unchanged rows are not logged"
    assert upsert(spark, target, grown, log) == 2
    assert read() == read() == [(1, "a", "x", 0), (2, "b", "x", 1), (3, "c", "y", 0), (4, "d", "x", 1)]


def test_an_upsert_can_replace_partitions(spark):
    target, log = work_dir(spark, "t"), ChangeLog(spark, work_dir(spark, "log"))
    upsert(spark, target, [(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", "z")], log)
    names = spark.createDataFrame([("x",), ("y",)], "part string")
    upsert(spark, target, [(2, "B", "x"), (5, "e", "x")], log, replace=names)
    assert content(tables.read_table(spark, target)) == [(2, "B", "x"), (4, "d", "z"), (5, "e", "x")]
    changes = log.read(frame(spark).schema, 1, 1, KINDS, True).drop("_commit_timestamp", "_commit_version")
    assert content(changes) == [
        (1, "a", "x", "delete"), (2, "B", "x", "update_postimage"), (2, "b", "x", "update_preimage"),
        (3, "c", "y", "delete"), (5, "e", "x", "insert"),
    ]
    read = reader(spark, log)
    assert [r[:3] for r in read()] == content(tables.read_table(spark, target)), "the first batch makes the table"


def test_one_row_per_key(spark):
    target = work_dir(spark, "t")
    upsert(spark, target, [(1, "a", "x"), (1, "a", "x"), (2, "b", "x")])
    assert content(tables.read_table(spark, target)) == [(1, "a", "x"), (2, "b", "x")]
    with pytest.raises(Exception, match="different rows for one key"):
        upsert(spark, target, [(1, "p", "x"), (1, "q", "x")])
    upsert(spark, target, [(1, "p", "x"), (1, "q", "x")], latest_by="v")
    assert content(tables.read_table(spark, target)) == [(1, "q", "x"), (2, "b", "x")]


@pytest.mark.parametrize("listed", [10_000, 1])
def test_a_null_partition_survives_batches_of_any_size(spark, monkeypatch, listed):
    monkeypatch.setattr(tables, "PRUNED_KEYS", listed)
    target = work_dir(spark, "t")
    upsert(spark, target, [(1, "a", "x"), (2, "b", None), (3, "c", "y")])
    upsert(spark, target, [(1, "A", "x"), (4, "d", None)])
    want = [(1, "A", "x"), (2, "b", None), (3, "c", "y"), (4, "d", None)]
    assert content(tables.read_table(spark, target)) == want


def test_only_touched_folders_are_listed(spark):
    target = work_dir(spark, "t")
    upsert(spark, target, [(i, "v", f"p {i}:") for i in range(40)])
    touched = frame(spark, (1, "v", "p 7:"), (1, "v", "absent"))
    rows = tables.read_touched(spark, target, touched, "part", frame(spark).schema)
    assert content(rows) == [(7, "v", "p 7:")] and len(rows.inputFiles()) == 1


def test_reads_continue_after_the_last_batch(spark):
    target, log = work_dir(spark, "t"), ChangeLog(spark, work_dir(spark, "log"))
    assert log.latest() is None and log.read(frame(spark).schema, 0).isEmpty()
    read = reader(spark, log)
    assert read() == []
    upsert(spark, target, [(1, "a", "x")], log, 0)
    assert read() == read() == [(1, "a", "x", 0)]
    upsert(spark, target, [(1, "A", "x"), (2, "b", "x")], log, 1)
    upsert(spark, target, [(3, "c", "y")], log, 2)
    assert read() == [(1, "a", "x", 0), (2, "b", "x", 1), (3, "c", "y", 1)]
    assert content(log.read(frame(spark).schema, 1, 1)) == [(2, "b", "x")]
    assert log.read(frame(spark).schema, 7).isEmpty()
    late = reader(spark, log)
    assert late() == [(1, "A", "x", 0), (2, "b", "x", 0), (3, "c", "y", 0)]
    with pytest.raises(ValueError):
        log.read(frame(spark).schema, None)


def test_a_reader_that_fails_reads_again(spark):
    target, log = work_dir(spark, "t"), ChangeLog(spark, work_dir(spark, "log"))
    upsert(spark, target, [(1, "a", "x")], log)
    seen, checkpoint, told = work_dir(spark, "seen"), work_dir(spark, "checkpoint"), []

    def use(records, batch):
        new_rows(records, batch).write.mode("overwrite").parquet(f"{seen}/batch={batch}")
        told.append(batch)
        if len(told) < 3:
            fail()

    for _ in range(2):
        with pytest.raises(OSError):
            log.follow(frame(spark).schema, checkpoint, use)
    upsert(spark, target, [(2, "b", "x")], log)
    log.follow(frame(spark).schema, checkpoint, use)
    assert told == [0, 0, 0, 1] and content(spark.read.parquet(seen)) == [(1, "a", "x", 0), (2, "b", "x", 1)]


def test_diff_changes(spark):
    old = frame(spark, (1, "a", "x"), (2, "b", "x"), (3, None, "x"))
    new = frame(spark, (2, "B", "x"), (3, None, "x"), (4, "d", "x"))
    assert content(diff_changes(old, new, ["k"])) == [
        (1, "a", "x", "delete"), (2, "B", "x", "update_postimage"), (2, "b", "x", "update_preimage"), (4, "d", "x", "insert"),
    ]


def test_create_table_keeps_the_order_and_an_existing_one(spark):
    schema = T.StructType(
        [
            T.StructField("n", T.IntegerType(), False),
            T.StructField("d", T.DoubleType()),
            T.StructField("at", T.TimestampType()),
            T.StructField("b", T.StringType()),
            T.StructField("a", T.StringType()),
            T.StructField("m", T.MapType(T.StringType(), T.ArrayType(T.DecimalType(5, 2)))),
        ]
    )
    assert "NOT NULL" not in tables.column_ddl(schema)
    tables.create_database(spark, "made", work_dir(spark, "made"))
    for _ in range(2):
        tables.create_table(spark, "made.t", schema, ["b"], properties={"made_by": "tests"})
    assert tables.table_exists(spark, "made.t") and not tables.table_exists(spark, "made.u")
    assert spark.table("made.t").columns == ["n", "d", "at", "a", "m", "b"]


def test_missing_targets_read_as_empty(spark):
    path = work_dir(spark, "none")
    assert not tables.table_exists(spark, path)
    assert tables.read_table(spark, path, frame(spark).schema).isEmpty()


def test_append_caps_the_rows_of_a_file(spark, tmp_path):
    target = str(tmp_path / "gold")
    for _ in range(2):
        tables.append_table(spark.range(100).coalesce(1), target, max_rows_per_file=30)
    sizes = [spark.read.parquet(str(f)).count() for f in (tmp_path / "gold").glob("*.parquet")]
    assert sum(sizes) == 200 and max(sizes) == 30


def test_overwrite_caps_the_rows_of_a_file_and_makes_the_table(spark):
    tables.create_database(spark, "capped", work_dir(spark, "capped"))
    rows = spark.range(100).coalesce(1).select(F.col("id").alias("k"), F.lit("x").alias("part"))
    path = work_dir(spark, "capped_path")
    for target in ("capped.t", path):
        for part in ("x", "y"):
            tables.overwrite_partitions(rows.withColumn("part", F.lit(part)), target, "part", 30)
        files = tables.read_table(spark, target).groupBy("part", F.col("_metadata.file_path")).count()
        assert files.agg(F.max("count"), F.sum("count")).first() == (30, 200)
        tables.overwrite_partitions(rows.withColumn("part", F.lit("x")), target, "part", 7)
        files = tables.read_table(spark, target).where("part = 'x'").groupBy(F.col("_metadata.file_path")).count()
        assert files.agg(F.max("count"), F.sum("count")).first() == (7, 100)
    spark.sql("CREATE TABLE capped.other (k LONG, part STRING) USING parquet PARTITIONED BY (part)")
    with pytest.raises(ValueError):
        tables.overwrite_partitions(rows, "capped.other", "part")


def test_reports_keep_columns_without_values(spark):
    path = work_dir(spark, "report")
    schema = T.StructType([T.StructField("filename", T.StringType()), T.StructField("n", T.LongType()), T.StructField("m", T.DoubleType())])
    for n in (1, 2):
        tables.write_report(spark.createDataFrame([("a", n, None)], schema), path)
    tables.write_report(spark.createDataFrame([("b", 5, None)], schema), path)
    assert content(tables.read_report(spark, path, schema)) == [("a", 2, None), ("b", 5, None)]


def test_a_report_forgets_sessions_that_left(spark):
    path = work_dir(spark, "report")
    schema = T.StructType([T.StructField("filename", T.StringType()), T.StructField("n", T.LongType())])
    tables.write_report(spark.createDataFrame([(f"s{i}", i) for i in range(30)] + [(None, 7)], schema), path)
    tables.write_report(spark.createDataFrame([("s1", 100)], schema), path, "filename", spark.createDataFrame([("s2",), (None,)], schema[:1]))
    want = sorted([(f"s{i}", i) for i in range(30) if i not in (1, 2)] + [("s1", 100)], key=repr)
    assert content(tables.read_report(spark, path, schema)) == want
    assert len(spark.read.schema(schema).json(path).inputFiles()) <= 4, "many sessions share a file"
    tables.write_report(spark.createDataFrame([("s2", 5)], schema), path)
    assert ("s2", 5) in content(tables.read_report(spark, path, schema)), "a session may come back"


@pytest.mark.parametrize("name", [None, "left.t"])
def test_partitions_that_left_are_dropped(spark, monkeypatch, name):
    monkeypatch.setattr(tables, "STATEMENT", 2)
    if name:
        tables.create_database(spark, "left", work_dir(spark, "left"))
    target = name or work_dir(spark, "t")
    parts = ["a b", "c:d", "e'f", "g=h", None, "kept"]
    tables.overwrite_partitions(frame(spark, *[(i, "v", part) for i, part in enumerate(parts)]), target, "part")
    touched = frame(spark, *[(0, "v", part) for part in [*parts[:-1], "absent"]])
    tables.replace_partitions(frame(spark, (9, "w", "c:d")), target, "part", touched)
    assert content(tables.read_table(spark, target)) == [(5, "v", "kept"), (9, "w", "c:d")]


def test_rescued_cells(spark):
    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.IntegerType())])
    raw = spark.createDataFrame([("1.5", "2"), ("x", "2"), ("inf", "1.5z"), (None, None)], "a string, b string")
    rows = rescue_cells(raw, schema).collect()
    assert [(r["a"], r["b"], r["_rescued_data"]) for r in rows] == [
        (1.5, 2, None), (None, 2, '{"a":"x"}'), (float("inf"), None, '{"b":"1.5z"}'), (None, None, None),
    ]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(shared_dir(spark)) and work_dir(spark, "x") != work_dir(spark, "x")
    df = cut(spark.range(5).select(F.sum("id").alias("s")))
    assert df.first()["s"] == 10 and "Scan ExistingRDD" in df._jdf.queryExecution().toString()
