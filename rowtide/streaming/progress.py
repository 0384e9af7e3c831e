"""What streams have taken in, counted over all their batches."""

from __future__ import annotations

import threading
import time
from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Progress(StreamingQueryListener):
    """Counts the rows that queries read, and those dropped for coming later than a watermark.

    Spark keeps the progress of a limited number of batches only; this adds up every batch as it
    is reported, from the time it is added to the session. A query with a watermark should be
    watched: what it drops is nowhere else to be seen.
    """

    def __init__(self) -> None:
        self._read: dict[str, int] = defaultdict(int)
        self._late: dict[str, int] = defaultdict(int)
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def watch(self, spark: SparkSession) -> Progress:
        spark.streams.addListener(self)
        return self

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's name
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        batch = event.progress
        with self._changed:
            self._read[str(batch.runId)] += batch.numInputRows
            self._late[str(batch.runId)] += sum(
                s.numRowsDroppedByWatermark for s in batch.stateOperators
            )

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _settled(self, query: StreamingQuery, timeout: float) -> str:
        """Waits for the reports of a run that has ended; they come on another thread."""
        run, until = str(query.runId), time.monotonic() + timeout
        with self._changed:
            while not query.isActive and run not in self._ended:
                if not self._changed.wait(until - time.monotonic()):
                    raise TimeoutError("the end of the query was not reported")
        return run

    def rows_read(self, query: StreamingQuery, timeout: float = 30.0) -> int:
        """Records that all batches of a run took in so far."""
        return self._read[self._settled(query, timeout)]

    def rows_late(self, query: StreamingQuery, timeout: float = 30.0) -> int:
        """Rows that a run dropped because they were later than its watermark."""
        return self._late[self._settled(query, timeout)]
