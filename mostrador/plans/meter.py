"""What runs take of the executors, from the counters of the session itself.

Every run carries a job tag. A snapshot before it and one after it list the executors with
the task time of the jobs under that tag, so runs that share a session do not count each
other's tasks. The snapshots are a table, from which operators/utilisation.py has the shares.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.operators.utilisation import executor_usage

SNAPSHOT_SCHEMA = (
    "run_id string, snapshot int, executor string, totalDuration long, totalCores int, "
    "memoryUsed long, peakMemoryMetrics struct<JVMHeapMemory: long, JVMOffHeapMemory: long>"
)
RUN_SCHEMA = "run_id string, elapsed_s double"
DRIVER = "driver"


def _listed(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


class Meter:
    """Snapshots around the runs of a session, few rows each: one per executor."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._context = spark.sparkContext
        self._snapshots: list[tuple] = []
        self._runs: list[tuple[str, float]] = []

    @contextmanager
    def run(self) -> Iterator[str]:
        """Measures what is run inside; yields the id of the run, which is also its job tag."""
        tag = f"mostrador-{uuid.uuid4().hex}"
        self._context.addJobTag(tag)
        self._take(tag, 0)
        started = time.perf_counter()
        try:
            yield tag
        finally:
            self._runs.append((tag, time.perf_counter() - started))
            self._context.removeJobTag(tag)
            self._take(tag, 1)

    def snapshots(self) -> DataFrame:
        return self.spark.createDataFrame(self._snapshots, SNAPSHOT_SCHEMA)

    def usage(self) -> DataFrame:
        """cpu (percent) and mem (MB) per run_id."""
        return executor_usage(self.snapshots(), self.spark.createDataFrame(self._runs, RUN_SCHEMA))

    def _take(self, tag: str, snapshot: int) -> None:
        core = self._context._jsc.sc()
        # the counters are kept by a listener, which is handed events a little later
        core.listenerBus().waitUntilEmpty()
        busy = self._task_time(core, tag) if snapshot else {}
        for executor in _listed(core.statusStore().executorList(True)):
            name, cores = executor.id(), executor.totalCores()
            if name == DRIVER and not cores:
                continue  # a driver that runs no tasks
            self._snapshots.append(
                (tag, snapshot, name, busy.get(name, 0), cores, executor.memoryUsed(), _peak(executor))
            )

    def _task_time(self, core, tag: str) -> dict[str, int]:
        """Milliseconds of tasks per executor, over all attempts of all stages under a tag."""
        store, jvm = core.statusStore(), self._context._jvm
        stages = {
            int(stage)
            for job in core.statusTracker().getJobIdsForTag(tag)
            for stage in _listed(store.job(job).stageIds())
        }
        no_quantiles = self._context._gateway.new_array(jvm.double, 0)
        busy: dict[str, int] = {}
        for stage in stages:
            for attempt in _listed(store.stageData(stage, False, jvm.java.util.ArrayList(), False, no_quantiles)):
                if attempt.status().toString() == "SKIPPED":
                    continue
                executors = store.executorSummary(stage, attempt.attemptId()).iterator()
                while executors.hasNext():
                    entry = executors.next()
                    busy[entry._1()] = busy.get(entry._1(), 0) + entry._2().taskTime()
        return busy


def _peak(executor) -> tuple[int, int] | None:
    """Peak memory of an executor; None until a heartbeat has brought it."""
    peak = executor.peakMemoryMetrics()
    if not peak.isDefined():
        return None
    heap, off_heap = (peak.get().getMetricValue(f"JVM{kind}Memory") for kind in ("Heap", "OffHeap"))
    return (heap, off_heap) if heap + off_heap > 0 else None


def with_usage(records: DataFrame, usage: DataFrame, engine: str) -> DataFrame:
    """Run records with the shares of one engine's runs, found by the column ``{engine}_run``."""
    run, cpu, mem = f"{engine}_run", f"{engine}_cpu_pct", f"{engine}_mem_mb"
    measured = usage.select(F.col("run_id").alias(run), F.col("cpu").alias(cpu), F.col("mem").alias(mem))
    return records.drop(cpu, mem).join(measured, run, "left").drop(run)
