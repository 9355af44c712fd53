"""Counts of what becomes of messages, batch by batch, from the observed metrics of a stream."""

import threading

from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class Accounts(StreamingQueryListener):
    """A listener that keeps the counts of every micro-batch of all queries that observe some.

    Add it with ``spark.streams.addListener`` before a query starts. A micro-batch that is
    repeated after a failure is told once, by its last attempt.
    """

    def __init__(self, name: str):
        self.name = name
        self.batches: dict[tuple[str, int], dict[str, int]] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        observed = progress.observedMetrics.get(self.name)
        if observed is not None and observed["messages"]:
            with self._news:
                self.batches[str(progress.id), progress.batchId] = observed.asDict()

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def of(self, query: StreamingQuery, timeout: float = 30.0) -> list[dict[str, int]]:
        """The counts of each micro-batch of a query that has ended, in order."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError("the query has not ended")
            own = [(batch, counts) for (of, batch), counts in self.batches.items() if of == str(query.id)]
            return [{"batch": batch, **counts} for batch, counts in sorted(own, key=lambda x: x[0])]
