"""Batch control: data gate, bounded fan-out over tables, retries, aggregates last."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark import alerts
from tidemark.store import Conflict, Store


@dataclass(frozen=True)
class Retry:
    """Tries again after transient errors only, waiting longer each time."""

    attempts: int = 3
    seconds: float = 30.0
    factor: float = 2.0
    transient: tuple[type[Exception], ...] = (ConnectionError, TimeoutError, Conflict)

    def __call__(self, f: Callable, sleep: Callable[[float], None] = time.sleep):
        wait = self.seconds
        for left in range(self.attempts, -1, -1):
            try:
                return f()
            except self.transient:
                if not left:
                    raise
                sleep(wait)
                wait *= self.factor


@dataclass
class Outcome:
    status: str
    codes: dict[str, int] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


def with_timeout(spark: SparkSession, seconds: float, what: str, f: Callable):
    """f(), its Spark jobs cancelled and TimeoutError raised if it takes longer."""
    group = f"{what}-{time.monotonic_ns()}"

    def run():
        spark.sparkContext.setJobGroup(group, what, interruptOnCancel=True)
        return f()

    pool = ThreadPoolExecutor(1)
    try:
        return pool.submit(run).result(timeout=seconds)
    except TimeoutError:
        spark.sparkContext.cancelJobGroup(group)
        raise
    finally:
        pool.shutdown(wait=False)


def run_batch(
    tables: Sequence[str],
    has_data: Callable[[str], bool],
    silver: Callable[[str], int],
    gold: Callable[[], None],
    notify: Callable[[str, str], None] = lambda subject, message: None,
    concurrency: int = 3,
    retry: Retry = Retry(),  # noqa: B008
    sleep: Callable[[float], None] = time.sleep,
) -> Outcome:
    """One batch over all tables.

    Without data it ends well and silently. Each table with data gets its job,
    ``concurrency`` at a time; a failure or a broken schema of any keeps the
    aggregates from running and is told once.
    """
    ready = [t for t in tables if retry(lambda t=t: has_data(t), sleep)]
    if not ready:
        return Outcome("NO_DATA")
    out = Outcome("SUCCESS")

    def one(table: str) -> None:
        try:
            out.codes[table] = retry(lambda: silver(table), sleep)
        except Exception as e:  # each table's failure is reported with the others'
            out.errors[table] = f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        list(pool.map(one, ready))
    broken = {t: f"returned {c}" for t, c in out.codes.items() if c}
    failed = {**broken, **out.errors}
    if not failed:
        try:
            retry(gold, sleep)
            return out
        except Exception as e:
            failed = {"gold": f"{type(e).__name__}: {e}"}
            out.errors |= failed
    out.status = "FAILED"
    notify(alerts.STEP_FAILURE, "; ".join(f"{t}: {e}" for t, e in sorted(failed.items())))
    return out


def maintain(store: Store, tables: Sequence[str], retention_days: float = 7, keep: int = 5, warn: Callable[[str], None] = print, at: float | None = None) -> dict[str, dict]:
    """Compact, expire and clean each table; one table's failure only warns."""
    cutoff = (time.time() if at is None else at) - retention_days * 86_400
    done: dict[str, dict] = {}
    for t in tables:
        try:
            compacted = store.compact(t)
            done[t] = {"compacted": compacted is not None, "expired": store.expire(t, cutoff, keep), "orphans": store.remove_orphans(t, cutoff)}
        except Exception as e:
            warn(f"maintenance of {t} failed: {type(e).__name__}: {e}")
    return done
