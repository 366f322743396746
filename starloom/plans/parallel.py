"""Concurrent submission of independent Spark jobs.

Independent branches of a batch (the two dimensions, the date dimension, the landing of
several feeds) each run as their own Spark jobs. Submitting them from separate driver
threads lets the scheduler run their tasks side by side when one branch alone does not
fill the cluster; the results are the same as running them one after another.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import Any


def run_parallel(tasks: dict[str, Callable[[], Any]], max_workers: int | None = None) -> dict[str, Any]:
    if len(tasks) <= 1:
        return {k: fn() for k, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=max_workers or len(tasks)) as pool:
        # each thread sees the caller's context (its staging block)
        futures = {k: pool.submit(copy_context().run, fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}
