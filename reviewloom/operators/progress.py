"""How far a job is, while it runs.

A thread asks Spark's status tracker for the stages of the jobs that the block starts; no task and no data is touched.
Task counts say how much of the work is done; exact row counts come from observations when the job has ended.
"""

import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import SparkSession

logger = logging.getLogger("reviewloom")
_GROUP, _DESCRIPTION, _CANCEL = "spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"


class Progress(NamedTuple):
    """What was seen at one moment. ``stage`` is the running stage with the most tasks left, None between stages."""

    tasks_done: int
    tasks_failed: int
    tasks_total: int
    stage: int | None
    seconds: float
    finished: bool = False

    @property
    def percent(self) -> float:
        """Share of the tasks of all stages that have begun; 100 only once the block has ended well."""
        if self.finished:
            return 100.0
        return min(100.0 * self.tasks_done / self.tasks_total, 99.9) if self.tasks_total else 0.0


class _Watch:
    """Stages of a job group, also of those that the tracker has forgotten since."""

    def __init__(self, spark: SparkSession, group: str):
        self._tracker = spark.sparkContext.statusTracker()
        self._group, self._started = group, time.monotonic()
        self._stages: dict[int, tuple[int, int, int]] = {}

    def look(self, finished: bool = False) -> Progress:
        running: dict[int, int] = {}
        for job in self._tracker.getJobIdsForGroup(self._group):
            info = self._tracker.getJobInfo(job)
            for stage in info.stageIds if info else []:
                seen = self._tracker.getStageInfo(stage)
                if seen is None or not (seen.numActiveTasks or seen.numCompletedTasks or seen.numFailedTasks):
                    continue  # not begun, or left out because its output is there already
                self._stages[stage] = (seen.numCompletedTasks, seen.numFailedTasks, seen.numTasks)
                if seen.numActiveTasks:
                    running[stage] = seen.numTasks - seen.numCompletedTasks
        done, failed, total = (sum(column) for column in zip(*self._stages.values(), strict=True)) if self._stages else (0, 0, 0)
        busiest = max(running, key=lambda stage: (running[stage], -stage)) if running else None
        return Progress(done, failed, total, busiest, time.monotonic() - self._started, finished)


@contextmanager
def progress(spark: SparkSession, report: Callable[[Progress], None], interval: float = 5.0) -> Iterator[None]:
    """Call ``report`` every ``interval`` seconds with the progress of the jobs that this thread starts in the block,
    and once more when it has ended without an error. What ``report`` raises ends the reports, not the job."""
    context, ended = spark.sparkContext, threading.Event()
    before = [(key, context.getLocalProperty(key)) for key in (_GROUP, _DESCRIPTION, _CANCEL)]
    group = f"progress-{uuid.uuid4().hex}"
    context.setJobGroup(group, before[1][1] or "watched")
    watch = _Watch(spark, group)

    def poll() -> None:
        while not ended.wait(interval):
            try:
                report(watch.look())
            except Exception:
                logger.exception("progress is not reported any more")
                return

    thread = threading.Thread(target=poll, name=group, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()
        for key, value in before:
            context.setLocalProperty(key, value)
    report(watch.look(finished=True))
