"""Submitting independent Spark jobs side by side."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def run_concurrently(tasks: dict[str, Callable[[], object]], workers: int = 4) -> dict[str, object]:
    """Run independent actions from driver threads so their tasks share the
    executors (one application schedules concurrent jobs).  Plans should be
    built before submission; only the actions run in the threads."""
    if workers <= 1 or len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}
