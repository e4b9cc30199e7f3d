"""Counters and gauges of a running mirror, added up as its batches end."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener


class MirrorProgress(StreamingQueryListener):
    """Adds up what each batch of one query did, per log: rows and payload bytes seen, flushes, the offset expected next.

    The batch's own rows per log are handed in by the mirror (seen); they count when Spark reports the batch as ended, so
    a batch that is tried again counts once, however many batches there are.
    """

    def __init__(self):
        self.lock, self.over = threading.Lock(), threading.Event()
        self.pending: dict[int, list[tuple]] = {}
        self.logs: dict[tuple[str, int], list[int]] = {}
        self.batches, self.observed, self.run = 0, [0, 0], None

    def seen(self, batch_id: int, rows: list[tuple]) -> None:
        """rows: topic, partition, rows, payload bytes, segments committed, next offset."""
        with self.lock:
            self.pending[batch_id] = rows

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) != self.run or p.batchId not in self.pending:
            return
        with self.lock:
            for topic, partition, n, size, flushes, upto in self.pending.pop(p.batchId):
                now = self.logs.setdefault((topic, partition), [0, 0, 0, 0])
                self.logs[topic, partition] = [now[0] + n, now[1] + size, now[2] + flushes, max(now[3], upto)]
            self.batches += 1
            if (found := p.observedMetrics.get("mirror")) is not None:
                self.observed = [self.observed[0] + found["n_records"], self.observed[1] + (found["payload_bytes"] or 0)]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            self.over.set()

    def table(self, spark: SparkSession) -> DataFrame:
        """topic, partition, records_total, bytes_total, flushes_total, expected: a row per log."""
        with self.lock:
            rows = [(*log, *sums) for log, sums in self.logs.items()]
        return spark.createDataFrame(rows, "topic string, partition int, records_total bigint, bytes_total bigint, flushes_total bigint, expected bigint")
