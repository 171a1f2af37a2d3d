"""Independent steps of a run side by side in one Spark application."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import SparkSession


def together(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Run the steps at the same time, each in a thread that inherits the
    caller's job group, tags and local properties, so that a cluster's free
    cores take the next step's tasks while another plans, lists or commits.

    All steps are waited for; if any failed, the first failure in the order of
    the arguments is raised once the others have stopped, with the rest as its
    notes.  One step alone runs in the caller's thread."""
    if len(steps) == 1:
        steps[0]()
        return
    failures: dict[int, BaseException] = {}

    def guarded(n: int, step: Callable[[], None]) -> Callable[[], None]:
        def run() -> None:
            try:
                step()
            except BaseException as e:  # noqa: BLE001  raised again below
                failures[n] = e

        return run

    threads = [InheritableThread(target=guarded(n, step), session=spark) for n, step in enumerate(steps)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failures:
        first, *rest = (failures[n] for n in sorted(failures))
        for e in rest:
            first.add_note(f"another step failed too: {type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}")
        raise first
