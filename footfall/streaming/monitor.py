"""Progress figures and stopping of a running query."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class RunTotals(StreamingQueryListener):
    """Adds up every batch of every query of a session, however long they run.

    Register with ``spark.streams.addListener``; :meth:`of` gives a query's figures since its start.
    """

    def __init__(self):
        self.runs: dict[str, dict[str, int]] = {}

    def _run(self, run_id) -> dict[str, int]:
        names = ("batches", "rows_read", "rows_written", "rows_dropped_late")
        return self.runs.setdefault(str(run_id), dict.fromkeys(names, 0))

    def onQueryStarted(self, event):
        self._run(event.runId)

    def onQueryProgress(self, event):
        batch = event.progress
        run = self._run(batch.runId)
        run["batches"] += 1
        run["rows_read"] += batch.numInputRows
        run["rows_written"] += max(batch.sink.numOutputRows, 0)
        run["rows_dropped_late"] += sum(s.numRowsDroppedByWatermark for s in batch.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def of(self, query: StreamingQuery) -> dict[str, int]:
        return dict(self._run(query.runId))


def progress_totals(query: StreamingQuery) -> dict[str, float]:
    """Figures of the batches Spark still remembers (100 by default) and last rates of a query.

    :class:`RunTotals` covers the whole run. A late event is
    counted once per window it would have belonged to.
    """
    batches = query.recentProgress
    dropped = sum(
        op.numRowsDroppedByWatermark for batch in batches for op in batch.stateOperators
    )
    last = batches[-1] if batches else None
    return {
        "batches": len(batches),
        "rows_read": sum(b.numInputRows for b in batches),
        "rows_written": sum(max(b.sink.numOutputRows, 0) for b in batches),
        "rows_dropped_late": dropped,
        "input_rows_per_second": last.inputRowsPerSecond if last else 0.0,
        "processed_rows_per_second": last.processedRowsPerSecond if last else 0.0,
    }


def stop_after_backlog(query: StreamingQuery) -> None:
    """Work off what has arrived, then stop."""
    query.processAllAvailable()
    query.stop()


def run_until_interrupted(query: StreamingQuery) -> None:
    """Block until the query ends; an interrupt from the keyboard stops it cleanly."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
