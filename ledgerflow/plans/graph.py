"""Jobs that depend on each other, run side by side.

Every step starts as soon as the steps that it reads from are done, in a
thread and a fair-scheduler pool of its own, with a copy of the session (a
step that tunes its own shuffles changes no other step's settings). With a
history, a step that the run has recorded is skipped: a run that died is
started again under its name and goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from ledgerflow.plans.history import RunHistory

Counts = Mapping[str, int]


@dataclass(frozen=True)
class Step:
    name: str
    work: Callable[[SparkSession], Counts]
    after: Sequence[str] = ()


def copied_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings and views."""
    return SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())


def run_steps(spark: SparkSession, steps: Sequence[Step], *, history: RunHistory | None = None, run: str | None = None, parallel: int = 4) -> dict[str, dict[str, int]]:
    """The counts of every step, by name. When a step fails, those that run
    are waited for (and recorded), no other starts, and its error is raised
    with a note of what was done."""
    names = [s.name for s in steps]
    for s in steps:
        unknown = [a for a in s.after if a not in names[: names.index(s.name)]]
        if unknown:
            raise ValueError(f"step {s.name!r} comes before {unknown}")
    if history is not None and run is None:
        raise ValueError("a history needs the name of the run")

    def work(step: Step) -> dict[str, int]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", step.name)
        own = copied_session(spark)
        if history is None:
            return dict(step.work(own))
        return history.step(run, step.name, lambda: step.work(own))

    done: dict[str, dict[str, int]] = {}
    failed: tuple[str, BaseException] | None = None
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        running: dict[Future, str] = {}
        waiting = list(steps)
        while waiting or running:
            for step in [s for s in waiting if failed is None and all(a in done for a in s.after)]:
                waiting.remove(step)
                running[pool.submit(inheritable_thread_target(spark)(work), step)] = step.name
            if not running:
                break
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if future.exception() is None:
                    done[name] = future.result()
                elif failed is None:
                    failed = (name, future.exception())
    if failed is not None:
        failed[1].add_note(f"step {failed[0]!r} failed; done: {', '.join(n for n in names if n in done) or 'none'}")
        raise failed[1]
    return {n: done[n] for n in names}
