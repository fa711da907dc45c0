"""Phases and summaries of random predictions: sessions in chunks against whole ones."""

import random

import pytest
from pyspark.sql import functions as F

from setwise.operators import phases
from setwise.operators.ordered import Axis

WHOLE = Axis(("filename",), "time_vector", ("n",))


def predictions(spark, seed, sessions=6, rows=400):
    """Codes and directions that stay for a while or flicker, with ties in time and gaps."""
    draw = random.Random(seed)
    out = []
    for s in range(sessions):
        time, code, up, down = 0.0, 0, 0, 0
        for n in range(draw.randint(1, rows)):
            time += draw.choice([0.0, 1.0, 1.0, 1.0, 9.0])
            if draw.random() < (0.9 if s % 3 == 0 else 0.1):
                code, up, down = draw.choice([0, 0, 5, 7]), draw.choice([0, 1]), draw.choice([0, 0, 1])
            if draw.random() < 0.02:
                code = None
            out.append((f"s{s}", "2024-01-15" if s else None, time, n, code, float(up), float(down)))
    columns = "filename string, measure_date string, time_vector double, n int, start_end_excercise_id int, concentric double, eccentric double"
    return spark.createDataFrame(out, columns).repartition(5)


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, chunk, reach", [(1, 30.0, (3, 3)), (2, 4.0, (2, 5)), (3, 200.0, (50, 50)), (4, 11.0, (0, 0)), (5, 0.5, (1, 0))])
@pytest.mark.parametrize("rule", ["both_zero", "legacy"])
def test_chunks_give_the_same_phases(spark, seed, chunk, reach, rule):
    df = predictions(spark, seed).persist()
    split = Axis(WHOLE.keys, WHOLE.time, WHOLE.ties, chunk)
    before, after = reach
    marked = [phases.mark_phases(df, axis, rest_rule=rule, before=before, after=after) for axis in (WHOLE, split)]
    assert rows_of(marked[0]) == rows_of(marked[1])
    tables = [phases.phases_of(df, axis, rest_rule=rule, before=before, after=after) for axis in (WHOLE, split)]
    assert rows_of(tables[0]) == rows_of(tables[1]) == rows_of(phases.phase_table(marked[1]))
    summaries = [rows_of(phases.summarise_phases(tables[0], axis)) for axis in (WHOLE, split)]
    assert summaries[0] == summaries[1]
    df.unpersist()


def test_a_heavy_session_is_summed_up_in_few_shuffles(spark):
    """The rows are shuffled once; what follows reads stretches and phases only."""
    split = Axis(WHOLE.keys, WHOLE.time, WHOLE.ties, 30.0)
    df = predictions(spark, 6)
    summary = phases.summarise_phases(phases.phases_of(df, split), split)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("BroadcastExchange") <= 5


def test_empty_rows(spark):
    split = Axis(WHOLE.keys, WHOLE.time, WHOLE.ties, 30.0)
    df = predictions(spark, 7).where("false")
    assert phases.summarise_phases(phases.phases_of(df, split), split).isEmpty()
    assert phases.mark_phases(df, split).isEmpty()
