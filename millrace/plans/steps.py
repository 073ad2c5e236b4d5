"""Independent steps of a run at the same time."""

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


class StepFailed(RuntimeError):
    """A step of a run failed; its error is the cause."""


def run_steps(spark: SparkSession, steps: dict[str, tuple[tuple, Callable]], at_once: int = 4) -> dict:
    """Results by name of steps {name: (names it needs, function of their results)}.

    A step starts when those it needs are done, up to `at_once` run together. Each works in the
    scheduler pool of its name, so that with fair scheduling a small step is not kept waiting by a large
    one. When a step fails, the jobs of the others are cancelled and no further step starts.
    """
    unknown = {n for needs, _ in steps.values() for n in needs} - set(steps)
    if unknown:
        raise ValueError(f"steps that are needed but not there: {sorted(unknown)}")
    context, tag = spark.sparkContext, f"run-{uuid.uuid4().hex}"

    def work(name, function, given):
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return function(*given)
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    done: dict = {}
    waiting, running, failed = dict(steps), {}, None
    with ThreadPoolExecutor(at_once) as pool:
        while (waiting and not failed) or running:
            ready = [n for n, (needs, _) in waiting.items() if all(k in done for k in needs)]
            if not ready and not running:
                raise ValueError(f"steps that wait for each other: {sorted(waiting)}")
            for name in ready if not failed else ():
                needs, function = waiting.pop(name)
                target = inheritable_thread_target(spark)(work)
                running[pool.submit(target, name, function, [done[k] for k in needs])] = name
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in finished:
                name = running.pop(future)
                if error := future.exception():
                    # Errors of the steps cancelled after it say nothing new.
                    failed = failed or (name, error)
                    context.cancelJobsWithTag(tag)
                else:
                    done[name] = future.result()
    if failed:
        raise StepFailed(f"step {failed[0]}: {failed[1]}") from failed[1]
    return done
