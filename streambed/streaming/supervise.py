"""Several streams in one application."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

log = logging.getLogger(__name__)


def for_each_table(tables: Iterable[str], action: Callable[[str], Any]) -> tuple[dict[str, Any], dict[str, Exception]]:
    """Run the action per table. A table that fails is reported and the others go on."""
    results, failures = {}, {}
    for table in tables:
        try:
            results[table] = action(table)
        except Exception as error:  # noqa: BLE001 - one table must not stop the rest
            log.warning("table %s skipped: %s", table, error)
            failures[table] = error
    return results, failures


def supervise(spark: SparkSession, queries: list[StreamingQuery], poll_seconds: int = 10) -> None:
    """Wait until every stream has ended. A failed stream, or an interrupt, stops them all."""
    try:
        while any(query.isActive for query in queries):
            spark.streams.awaitAnyTermination(poll_seconds)
            for query in queries:
                if not query.isActive and query.exception() is not None:
                    raise query.exception()
            spark.streams.resetTerminated()
    except KeyboardInterrupt:
        log.info("interrupted, stopping all streams")
    finally:
        for query in queries:
            query.stop()


def _any_ended(spark: SparkSession, seconds: float) -> None:
    """Wait until some stream ends; the failure of one is for the caller to look at."""
    try:
        spark.streams.awaitAnyTermination(seconds)
    except StreamingQueryException:
        pass
    spark.streams.resetTerminated()


def keep_running(
    spark: SparkSession, starters: dict[str, Callable[[], StreamingQuery]], restarts: int = 3, poll_seconds: float = 10
) -> dict[str, Exception]:
    """Start every stream and wait until all have ended; what was given up, by name.

    A stream that fails is started again, from its checkpoint, while the others go on; after ``restarts``
    failures without a finished batch in between it is given up. An interrupt stops them all.
    """
    running: dict[str, StreamingQuery] = {}
    failed: dict[str, int] = dict.fromkeys(starters, 0)
    given_up: dict[str, Exception] = {}

    def start(name: str) -> None:
        try:
            running[name] = starters[name]()
        except Exception as error:  # noqa: BLE001 - one stream must not stop the rest
            after_failure(name, error)

    def after_failure(name: str, error: Exception) -> None:
        running.pop(name, None)
        failed[name] += 1
        if failed[name] > restarts:
            log.error("stream %s given up: %s", name, error)
            given_up[name] = error
        else:
            log.warning("stream %s starts again (%d of %d): %s", name, failed[name], restarts, error)
            start(name)

    try:
        for name in starters:
            start(name)
        while running:
            for name, query in list(running.items()):
                if query.isActive:
                    continue
                if any(p["numInputRows"] for p in query.recentProgress):
                    failed[name] = 0
                if query.exception() is not None:
                    after_failure(name, query.exception())
                else:
                    del running[name]
            if running and all(query.isActive for query in running.values()):
                _any_ended(spark, poll_seconds)
    except KeyboardInterrupt:
        log.info("interrupted, stopping all streams")
    finally:
        for query in running.values():
            query.stop()
    return given_up
