"""What the stages of runs did, noted as it happens: one line when a stage begins, one when it ends.

A run's record is folded from its lines, so that it exists for a run that
raised, and, for one that was killed, up to the stage it was in.
"""

import json
from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.sources import files

BEGUN, DONE, FAILED, SKIPPED = "begun", "success", "failed", "skipped"
JOURNAL = "run_at string, dag_run_id string, place int, stage string, state string, error string, found string"


class Journal:
    """The lines of one run, and its stages, run one after the other until one raises."""

    def __init__(self, spark: SparkSession, path: str, run_at: datetime, run_id: str):
        self.spark, self.path, self.run_at, self.run_id = spark, path, run_at, run_id
        self.failed: str | None = None
        self.place = 0

    def note(self, stage: str, state: str, error: str | None = None, found: dict[str, Any] | None = None) -> None:
        """Add a line; `found` is what the stage has to tell, a few plain values."""
        line = (self.run_at.isoformat(), self.run_id, self.place, stage, state, error, json.dumps(found or {}, default=str))
        self.place += 1
        self.spark.createDataFrame([line], JOURNAL).coalesce(1).write.mode("append").json(self.path)

    def run(self, stage: str, work: Callable[[], dict[str, Any] | None]) -> None:
        """Run a stage unless one before it failed. It returns what it found, or None if it had nothing to do."""
        if self.failed:
            return self.note(stage, SKIPPED)
        self.note(stage, BEGUN)
        try:
            found = work()
        except Exception as problem:  # whatever it is, it belongs in the record
            self.failed = stage
            return self.note(stage, FAILED, f"{type(problem).__name__}: {problem}"[:2000])
        self.note(stage, SKIPPED if found is None else DONE, found=found)


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """All lines of all runs."""
    return spark.read.schema(JOURNAL).json(path) if files.exists(spark, path) else spark.createDataFrame([], JOURNAL)


def stage_states(journal: DataFrame) -> DataFrame:
    """The last state of every stage of every run, with its error; a stage that only began did not end."""
    last = journal.groupBy("run_at", "dag_run_id", "stage").agg(F.max(F.struct("place", "state", "error", "found")).alias("last"))
    return last.select("run_at", "dag_run_id", "stage", "last.*")


def flat_run(journal: DataFrame, columns: dict[str, str], run_at: datetime, run_id: str) -> DataFrame:
    """One row of what a run's stages found, by the names and types given, with the stage that failed and its error."""
    mine = journal.where((F.col("run_at") == run_at.isoformat()) & (F.col("dag_run_id") == run_id))
    states = stage_states(mine)
    broken = F.when(F.col("state").isin(FAILED, BEGUN), F.struct("place", "stage", "error"))
    value = lambda name: F.get_json_object("found", f"$.{name}")
    found = [F.max(F.when(F.col("state") == DONE, value(name)).try_cast(kind)).alias(name) for name, kind in columns.items()]
    row = states.agg(F.min(broken).alias("_broken"), *found)
    return row.select(
        F.lit(run_at.isoformat()).alias("execution_timestamp"), F.lit(run_at.date().isoformat()).alias("execution_date"),
        F.lit(run_id).alias("dag_run_id"), *columns, F.col("_broken.stage").alias("failed_stage"), F.col("_broken.error").alias("error"),
    )
