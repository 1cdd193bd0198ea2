"""Consuming a queue: the worker's loop, its limits and retries, and the same as a structured stream."""

from __future__ import annotations

import random
import signal
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cloudweft.functions.messages import parse_body, validated
from cloudweft.streaming.queue import QueueSource

#: Seconds, and failures in a row after which a worker gives up.
POLL_S, IDLE_S, RUN_S, BACKOFF_S = 15.0, 60.0, 43_200.0, 300.0
FAILURES = 10
JITTER = (0.8, 1.2)


def backoff(failures: int, jitter: float | None = None) -> float:
    """Seconds before the next try: doubling, times a jitter, at most the cap."""
    factor = random.uniform(*JITTER) if jitter is None else jitter
    return min(POLL_S * 2.0 ** (failures - 1) * factor, BACKOFF_S)


def backoff_column(failures: Column) -> Column:
    """The same without jitter."""
    return F.least(F.lit(POLL_S) * F.pow(F.lit(2.0), failures - 1), F.lit(BACKOFF_S))


@dataclass
class Failures:
    """Failures in a row, for each stage on its own."""

    limit: int = FAILURES
    counts: Counter = field(default_factory=Counter)

    def failed(self, stage: str) -> int:
        self.counts[stage] += 1
        return self.counts[stage]

    def succeeded(self, stage: str) -> None:
        self.counts[stage] = 0

    def over(self, stage: str) -> bool:
        return self.counts[stage] >= self.limit


@dataclass
class Worker:
    """Takes one message at a time from ``queue`` and acknowledges it once ``handle`` has returned. ``run`` returns why it
    stopped: "idle", "runtime", "failures: <stage>" or "signal"."""

    queue: Any
    handle: Callable[[Any], None]
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    failures: Failures = field(default_factory=Failures)
    stopping: bool = False

    def stop(self, *_: Any) -> None:
        self.stopping = True

    def on_signals(self) -> Worker:
        for number in (signal.SIGTERM, signal.SIGINT):
            signal.signal(number, self.stop)
        return self

    def _work(self, message: Any) -> None:
        body = parse_body(message.body)
        if not message.lease_id:
            raise RuntimeError("a message came without a lease")
        self.handle(body)
        self.queue.ack(message.lease_id)

    def run(self) -> str:
        began = worked = self.clock()
        while not self.stopping:
            if self.clock() - began > RUN_S:
                return "runtime"
            stage = "poll"
            try:
                messages = self.queue.pull()
                self.failures.succeeded(stage)
                if not messages and self.clock() - worked >= IDLE_S:
                    messages = self.queue.pull()
                    if not messages:
                        return "idle"
                if not messages:
                    self.sleep(POLL_S)
                    continue
                stage = "processing"
                self._work(messages[0])
                self.failures.succeeded(stage)
                worked = self.clock()
            except Exception:
                n = self.failures.failed(stage)
                if self.failures.over(stage):
                    return f"failures: {stage}"
                self.sleep(backoff(n))
        return "signal"


def messages(spark: SparkSession, folder: str, log: str, **options: Any) -> DataFrame:
    """The queue as a stream of (body, lease_id)."""
    spark.dataSource.register(QueueSource)
    return spark.readStream.format("leased_queue").options(folder=folder, log=log, **{k: str(v) for k, v in options.items()}).load()


def start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, poll_s: float = POLL_S) -> StreamingQuery:
    """Validated messages to ``handle``, at least once: leases are acknowledged only after a batch has been committed."""
    return validated(stream).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(processingTime=f"{int(poll_s * 1000)} milliseconds").start()


def supervise(begin: Callable[[], StreamingQuery], idle_s: float = IDLE_S, run_s: float = RUN_S, failures: Failures | None = None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, look_s: float = 1.0) -> str:
    """Runs a stream until it has been idle or has run long enough; restarts it after errors, with backoff, up to the limit.
    Before it stops as idle, it waits for one more poll that brings nothing."""
    tracker = failures or Failures()
    began = worked = clock()
    while True:
        query, batch, confirming = begin(), -1, None
        try:
            while query.isActive:
                sleep(look_s)
                seen = query.lastProgress
                if seen and seen["batchId"] != batch:
                    batch = seen["batchId"]
                    if seen["numInputRows"]:
                        worked = clock()
                        tracker.succeeded("processing")
                if clock() - began > run_s:
                    return "runtime"
                if clock() - worked < idle_s:
                    confirming = None
                elif confirming is None:
                    confirming = seen["timestamp"] if seen else ""
                elif seen and seen["timestamp"] != confirming and not query.status["isTriggerActive"]:
                    return "idle"
            if query.exception() is None:
                return "signal"
        finally:
            query.stop()
        n = tracker.failed("processing")
        if tracker.over("processing"):
            return "failures: processing"
        sleep(backoff(n))


def failure_streaks(events: DataFrame, key: str, order: list[str], failed: Column) -> DataFrame:
    """(key, longest, current): failures in a row, longest ever and at the end. A success starts a new island."""
    by = Window.partitionBy(key).orderBy(*order)
    marked = events.select(key, *order, failed.cast("int").alias("bad")).withColumn("island", F.sum(1 - F.col("bad")).over(by))
    runs = marked.groupBy(key, "island").agg(F.sum("bad").alias("n"))
    return runs.groupBy(key).agg(F.max("n").alias("longest"), F.max_by("n", "island").alias("current"))


def idle_gaps(events: DataFrame, key: str, ts: str, seconds: float = IDLE_S) -> DataFrame:
    """(key, ts, previous) where a key was silent for ``seconds`` or more."""
    before = F.lag(ts).over(Window.partitionBy(key).orderBy(ts))
    gap = F.make_dt_interval(secs=F.lit(float(seconds)).cast("decimal(18,6)"))
    return events.select(key, ts, before.alias("previous")).where(F.col(ts) - F.col("previous") >= gap)


def streak_stream(events: DataFrame, key: str, limit: int = FAILURES) -> DataFrame:
    """(key, streak, over) for a stream with a boolean column ``failed``: each key's failures in a row so far."""

    def count(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        for pdf in batches:
            for bad in pdf["failed"]:
                streak = streak + 1 if bad else 0
        state.update((streak,))
        yield pd.DataFrame({key: [keys[0]], "streak": [streak], "over": [streak >= limit]})

    kind = events.schema[key].dataType.simpleString()
    return events.groupBy(key).applyInPandasWithState(count, f"{key} {kind}, streak long, over boolean", "streak long", "update", GroupStateTimeout.NoTimeout)


def main() -> int:
    """A worker on a folder queue that checks each message and logs its type; 1 if it gave up after failures.

    A message that cannot be handled is not acknowledged, so it is offered again.
    """
    import logging

    from cloudweft.config import require_env
    from cloudweft.functions.messages import parse_job
    from cloudweft.streaming.queue import FolderQueue

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    log = logging.getLogger("cloudweft.worker")

    def handle(body: Any) -> None:
        log.info("message of type %s", parse_job(body).type)

    reason = Worker(FolderQueue(require_env("QUEUE_FOLDER")["QUEUE_FOLDER"]), handle).on_signals().run()
    log.info("stopped: %s", reason)
    return int(reason.startswith("failures"))
