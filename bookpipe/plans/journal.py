"""What a run has finished, so that the next one goes on from there or removes what a dead one left."""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from bookpipe.sources.commits import LEASE_SECONDS, Files

log = logging.getLogger(__name__)
START, DONE, FAILED = "start.json", "done.json", "failed.json"


class Journal:
    """A folder per run below ``root/_runs``, with a small file for its start, each finished step, and its end.

    A run is dead if it says that it failed, or has not ended within its lease. The lease is long, as a run that was taken for dead while it goes on
    would lose its working files; the tables would stay right even then, as they are committed by number.
    """

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.root, self.run = spark, root, run
        self.files = Files(spark, f"{root}/_runs/{run}")

    def start(self, task: dict, seconds: float = LEASE_SECONDS) -> None:
        """Say what is done: runs of the same task can be resumed by one another."""
        context = self.spark.sparkContext._jsc.sc()
        folder = context.getCheckpointDir()
        self.files.replace(START, {"task": task, "until": time.time() + seconds, "application": context.applicationId(),
                                   "checkpoints": folder.get() if folder.isDefined() else None})

    def step(self, name: str, work: Callable, *args, again: bool = True):
        """Do a step and note it. A step that need not be done ``again`` is left out if the resumed run has finished it; then its result is None."""
        if not again and f"{name}.json" in self.files.names():
            log.info("%s was finished by an earlier try", name)
            return None
        began = time.monotonic()
        result = work(*args)
        seconds = time.monotonic() - began
        log.info("%s took %.1f seconds", name, seconds)
        self.files.replace(f"{name}.json", {"seconds": seconds, "result": result if isinstance(result, (bool, int, str, type(None))) else None})
        return result

    def result(self, name: str):
        """What a finished step has returned."""
        return (self.files.read(f"{name}.json") or {}).get("result")

    def end(self, failed: bool) -> None:
        self.files.replace(FAILED if failed else DONE, {"at": time.time()})


def dead_runs(spark: SparkSession, root: str) -> dict[str, dict]:
    """Runs that have not ended well and do not go on, with what they said at their start. Journals of ended runs whose lease is over go."""
    runs, found = Files(spark, f"{root}/_runs"), {}
    for run in runs.names():
        files = Files(spark, f"{root}/_runs/{run}")
        names, start = files.names(), files.read(START)
        over = start is not None and start["until"] < time.time()
        if DONE in names:
            if over:
                runs.remove(run)
        elif start is not None and (over or FAILED in names):
            found[run] = start
    return found


def take_over(spark: SparkSession, root: str, run: str) -> bool:
    """Become the one that resumes or removes a dead run; false if another run was first. A run that was taken over is not dead any more until it fails again."""
    files = Files(spark, f"{root}/_runs/{run}")
    tries = sum(name.startswith("try-") for name in files.names())
    if not files.create(f"try-{tries:04}.json", {"by": uuid.uuid4().hex, "at": time.time()}):
        return False
    files.remove(FAILED)
    return True
