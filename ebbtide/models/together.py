"""Rows dealt evenly over tasks, and tasks that run together and exchange their sums.

An iterative fit of hundreds of rounds would pay for a job, and for reading the rows, in every round. Tasks of one barrier
stage keep their rows instead and exchange their sums; a lost task starts the whole stage anew, which gives the same result,
since every draw is seeded by what it is for.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyarrow.fs import FileSystem, FileType
from pyspark import RDD, BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession

from ebbtide.session import scratch_path

MOST_TOGETHER = 64  # every task receives every task's sums


def slots(spark: SparkSession) -> int:
    """How many tasks the application can run at a time, as a barrier stage counts them."""
    context = spark.sparkContext._jsc.sc()
    return max(1, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))


def dealt(rows: DataFrame, tasks: int) -> RDD:
    """The stored rows as tuples, dealt in turn over ``tasks`` partitions."""
    return rows.rdd.map(tuple).zipWithIndex().map(lambda r: (r[1], r[0])).partitionBy(tasks, int).values()


class Exchange:
    """Arrays of all tasks by way of small files in the shared scratch folder: Spark's own ``allGather`` takes a second whenever it
    has to wait. Whoever has all files of a step knows that those of the step before have been read, and removes its own."""

    def __init__(self, folder: str, me: int, tasks: int):
        self.store, self.folder = FileSystem.from_uri(folder)
        self.me, self.tasks, self.step = me, tasks, 0
        self.store.create_dir(self.folder, recursive=True)

    def _name(self, step: int, task: int) -> str:
        return f"{self.folder}/{step}-{task}"

    def _read(self, name: str) -> np.ndarray:
        pause = 0.0005
        while self.store.get_file_info(name).type == FileType.NotFound:
            time.sleep(pause)
            pause = min(2 * pause, 0.01)
        with self.store.open_input_stream(name) as f:
            return np.frombuffer(f.read(), np.float64)

    def __call__(self, values: np.ndarray) -> list[np.ndarray]:
        """Every task's values, in the tasks' order."""
        name = self._name(self.step, self.me)
        with self.store.open_output_stream(f"{name}.part") as f:
            f.write(np.ascontiguousarray(values, np.float64).tobytes())
        self.store.move(f"{name}.part", name)
        found = [self._read(self._name(self.step, task)) for task in range(self.tasks)]
        if self.step:
            self.store.delete_file(self._name(self.step - 1, self.me))
        self.step += 1
        return found


def run_together(spark: SparkSession, rows: RDD, work: Callable[[Iterable, Callable[[np.ndarray], list[np.ndarray]]], object]):
    """Call ``work(rows of the task, gather)`` in all partitions at the same time; what the first one returns. ``gather``
    gives every task the arrays of all tasks, in the tasks' order."""
    folder = scratch_path(spark, "together")

    def run(part: Iterator) -> Iterator:
        context = BarrierTaskContext.get()
        attempt = context.allGather(uuid.uuid4().hex)  # a stage that begins anew reads nothing of the one before
        found = work(part, Exchange(f"{folder}/{attempt[0]}", context.partitionId(), len(attempt)))
        if context.partitionId() == 0:
            yield found

    return rows.barrier().mapPartitions(run).collect()[0]
