"""CPU and memory of a run from executor snapshots or application totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.functions.numbers import rounded

MEGABYTE = 1024.0 * 1024.0


def _share(busy: Column, available: Column) -> Column:
    return F.least(F.lit(100.0), rounded(F.try_divide(busy, available) * 100.0, 1))


def executor_usage(executors: DataFrame, runs: DataFrame) -> DataFrame:
    """CPU percent and memory of runs (run_id, elapsed_s) from two snapshots of executors.

    ``executors`` has run_id, snapshot (0 before the run, 1 after it), totalDuration,
    totalCores, memoryUsed and the nullable struct peakMemoryMetrics(JVMHeapMemory,
    JVMOffHeapMemory). Busy time is the difference of the snapshots; cores (at least one)
    and memory are those after the run. Both snapshots fold in one aggregate.
    """
    peak, zero = F.col("peakMemoryMetrics"), F.lit(0)
    held = F.when(
        peak.isNotNull(),
        F.coalesce(peak["JVMHeapMemory"], zero) + F.coalesce(peak["JVMOffHeapMemory"], zero),
    ).otherwise(F.coalesce("memoryUsed", zero))

    def total(snapshot: int, value: Column) -> Column:
        return F.sum(F.when(F.col("snapshot") == snapshot, value))

    busy, cores = F.coalesce("totalDuration", zero), F.coalesce("totalCores", zero)
    deltas = executors.groupBy("run_id").agg(
        (total(1, busy) - total(0, busy)).alias("busy_ms"),
        F.greatest(total(1, cores), F.lit(1)).alias("cores"),
        total(1, held).alias("bytes"),
    )
    elapsed_ms = F.col("elapsed_s") * 1000.0
    cpu = F.when(elapsed_ms > 0, _share(F.col("busy_ms"), elapsed_ms * F.col("cores")))
    return runs.join(deltas, "run_id").select(
        "run_id",
        F.when(F.col("busy_ms").isNotNull(), F.coalesce(cpu, F.lit(0.0))).alias("cpu"),
        rounded(F.col("bytes") / MEGABYTE, 1).alias("mem"),
    )


def application_usage(applications: DataFrame) -> DataFrame:
    """CPU percent and mean memory from whole-application totals: elapsed_ms,
    memory_seconds (MB), vcore_seconds and the cluster's total_cores."""
    seconds = F.col("elapsed_ms") / 1000.0
    ran = F.col("elapsed_ms") > 0
    cores = F.greatest("total_cores", F.lit(1))
    per_second = F.try_divide(F.col("vcore_seconds"), seconds)
    return applications.select(
        "run_id",
        F.when(ran, _share(per_second, cores)).alias("cpu"),
        F.when(ran, rounded(F.try_divide(F.col("memory_seconds"), seconds), 1)).alias("mem"),
    )
