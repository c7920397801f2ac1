"""Stage records: what a stage read, wrote and took, one row on success and one on failure."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.profile import append_stage_record, stage_record


@dataclass
class Stage:
    """What a running stage has to say; its values become the record's."""

    data_rows: dict[str, int] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)
    artifacts: dict[str, str] = field(default_factory=dict)
    _observed: list[tuple[str, Observation]] = field(default_factory=list)

    def observe(self, name: str, df: DataFrame, **metrics: Column) -> DataFrame:
        """``df`` with its rows counted under ``name``, and more aggregates as metrics, by the job that runs it anyway.

        Exact where no shuffle follows in that job: its last stage counts a task once, however often it was tried.
        """
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        self._observed.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])

    def observed_rows(self, name: str) -> int:
        """Rows that the finished job counted under ``name``."""
        found = dict(next(seen for known, seen in self._observed if known == name).get)
        self.data_rows[name] = int(found.pop("rows"))
        self.metrics.update(found)
        return self.data_rows[name]


@dataclass(frozen=True)
class Run:
    """Where the records of a pipeline run go. ``run_id`` tells several runs of a stage within it apart."""

    spark: SparkSession
    path: str
    pipeline_run_id: str
    run_id: str = "1"

    @contextmanager
    def stage(self, name: str) -> Iterator[Stage]:
        """Run a stage; its record is appended also when it fails, and the error goes on to the caller."""
        stage, start = Stage(), time.monotonic()
        created = datetime.now(timezone.utc).isoformat()
        status, error = "failed", None
        try:
            yield stage
            status = "success"
        except BaseException as raised:
            error = f"{type(raised).__name__}: {raised}"[:2000]
            raise
        finally:
            metrics = {**stage.metrics, "duration_seconds": round(time.monotonic() - start, 3)}
            record = stage_record(
                self.spark, name, self.pipeline_run_id, self.run_id, created, status,
                stage.data_rows, metrics, stage.artifacts, error,
            )
            append_stage_record(record.coalesce(1), self.path)


@contextmanager
def recorded(run: Run | None, name: str) -> Iterator[Stage]:
    """The stage of ``run``, or one whose values nobody keeps."""
    if run is None:
        yield Stage()
    else:
        with run.stage(name) as stage:
            yield stage
