"""Failure records of streaming queries by a listener (SNK-8).

A query that ends with an error leaves one record with its cause, also where the driver code never looks at the query again: Spark tells
the listener, which writes the record. Failures of single messages and of the validation are recorded by the batch itself, with their
coordinates; ``skip`` keeps the listener from recording those again.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from jobloom.streaming.storage import record_failure


class FailureListener(StreamingQueryListener):
    """Records how the queries of a session end that it follows, or all of them where it follows none.

    Register it with ``spark.streams.addListener``; it stays as long as the session unless it is removed."""

    def __init__(self, spark: SparkSession, path: str | None, skip: Callable[[], bool] | None = None):
        self.spark, self.path, self.skip = spark, path, skip or (lambda: False)
        self.started: list[str] = []
        self.ended: dict[str, threading.Event] = {}
        self._followed: set[str] | None = None
        self._lock = threading.Lock()

    def _event(self, run_id) -> threading.Event:
        with self._lock:
            return self.ended.setdefault(str(run_id), threading.Event())

    def follow(self, query: StreamingQuery) -> None:
        """Record this query only."""
        self._followed = (self._followed or set()) | {str(query.runId)}
        self._event(query.runId)

    def settle(self, seconds: float = 30.0) -> None:
        """Wait until the ends of the followed queries are recorded."""
        for run_id in self._followed or ():
            if not any(str(q.runId) == run_id for q in self.spark.streams.active):
                self._event(run_id).wait(seconds)

    def onQueryStarted(self, event) -> None:
        self.started.append(str(event.runId))

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run_id = str(event.runId)
        if self._followed is not None and run_id not in self._followed:
            return
        # the write is a Spark job: not on the thread that Spark delivers its events with
        threading.Thread(target=self._record, args=(run_id, event.exception), daemon=True).start()

    def _record(self, run_id: str, cause: str | None) -> None:
        try:
            if cause and not self.skip():
                record_failure(self.spark, self.path, "query", message=cause.splitlines()[0], detail=cause)
        finally:
            self._event(run_id).set()
