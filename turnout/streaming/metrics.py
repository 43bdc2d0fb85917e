"""What ``observe`` measures in a stream, stored batch by batch by a query listener."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from turnout.streaming.state import _folder


class MetricStore(StreamingQueryListener):
    """Writes the observed metrics ``name`` of every micro-batch to ``path``/batch_id=<n>.json.

    A replayed batch overwrites its file.  Progress comes after the batch is committed, so if the driver is lost
    in between, that batch's figures are missing: they monitor a stream and are no result of it.
    """

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path
        self.ended = threading.Event()
        self.run_id = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = event.runId

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        fs, place = _folder(self.spark, f"{self.path}/batch_id={event.progress.batchId}.json")
        out = fs.create(place, True)
        out.write(bytearray(json.dumps(row.asDict()).encode()))
        out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run_id:
            self.ended.set()

    def close(self, timeout: float = 60) -> None:
        """Waits until the stopped query's last progress has been stored, and leaves the session."""
        if not self.ended.wait(timeout):
            raise TimeoutError(f"the progress of {self.name} did not end in {timeout} s")
        self.spark.streams.removeListener(self)

    def read(self, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).json(self.path)
