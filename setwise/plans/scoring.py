"""Score new sessions and summarise their sets, phases and repetitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from setwise.contract import GOLD_ROWS_PER_FILE, PRODUCTION, RUN_NAME, SUMMARY
from setwise.operators.models import chained_specs, score_chained
from setwise.operators.ordered import MAX_ROWS, Axis, fit_axis
from setwise.operators.phases import mark_phases, phase_table, summarise_phases
from setwise.session import cut
from setwise.sources.change_log import ChangeLog
from setwise.sources.run_store import RunStore
from setwise.sources.tables import is_path, read_report, read_table, read_touched, replace_packed, replace_partitions, write_report


def summarise(marked: DataFrame, axis: Axis) -> DataFrame:
    """Per-session summary of rows that carry predictions and phase markers."""
    return summarise_phases(phase_table(marked), axis)


@dataclass(frozen=True)
class ScoringJob:
    """Reads which sessions of the production table changed, scores these as a whole, and
    writes their gold rows and summaries.

    Gold is a packed table (partitioned by session, if it is a name), and a session replaces what was there; in the reports its
    last summary counts. One that has left the production table is in neither. So a session that came in several
    deliveries has one summary, and a run that is repeated after a failure gives the same
    tables. The change log is followed as a stream, whose ``checkpoint`` moves last.
    """

    spark: SparkSession
    production: str
    log: ChangeLog
    checkpoint: str
    store: RunStore
    gold: str
    reports: str
    run_name: str = RUN_NAME
    rest_rule: str = "both_zero"
    legacy: bool = False
    max_rows: int = MAX_ROWS

    def run(self) -> DataFrame | None:
        """The summary of the changed sessions, or None if nothing has changed."""
        specs = chained_specs()
        run = self.store.latest(self.run_name, models=len(specs))
        if run is None:
            raise LookupError(f"no complete run named {self.run_name}")
        models = [self.store.load(run["run_id"], spec.name) for spec in specs]
        scored: list[DataFrame] = []

        def use(records: DataFrame, batch: int) -> None:
            touched = cut(records.select("filename").distinct())
            if not touched.isEmpty():
                self._score(touched, models)
                scored.append(touched)

        self.log.follow(PRODUCTION, self.checkpoint, use)
        if not scored:
            return None
        touched = scored[0]
        for more in scored[1:]:
            touched = touched.union(more)
        return read_report(touched.sparkSession, self.reports, SUMMARY).join(touched, "filename", "left_semi")

    def _score(self, touched: DataFrame, models: list[PipelineModel]) -> None:
        spark = touched.sparkSession
        sessions = read_touched(spark, self.production, touched, "filename", PRODUCTION)
        axis = fit_axis(sessions, ("filename",), "time_vector", max_rows=self.max_rows)
        # Scored once: the frame is read for the gold rows and the summary, and on a chunked
        # axis twice by the scans.
        scored = score_chained(sessions, *models).persist(StorageLevel.DISK_ONLY)
        marked = mark_phases(scored, axis, rest_rule=self.rest_rule, legacy=self.legacy).persist(StorageLevel.DISK_ONLY)
        try:
            replace = replace_packed if is_path(self.gold) else replace_partitions
            replace(marked, self.gold, "filename", touched, GOLD_ROWS_PER_FILE)
            gone = touched.join(marked.select("filename").distinct(), "filename", "left_anti")
            write_report(summarise(marked, axis), self.reports, "filename", gone)
        finally:
            marked.unpersist()
            scored.unpersist()
