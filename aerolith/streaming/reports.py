"""Reports of running streams: what each micro-batch read, dropped and found wrong.

Counts are observed inside the query; a listener writes them to a table, one folder
per run and batch, so a batch reported twice is there once.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from aerolith.operators.quality import failures

REPORT = "query_id string, batch_id long, metric string, name string, value long"
LATE = "late"


def observe_rules(stream: DataFrame, rules: Sequence[tuple[str, str]], metric: str = "rules") -> DataFrame:
    """The stream, with the failures of column rules counted per micro-batch as ``metric``."""
    counts = [failures(column, rule).alias(f"{column} {rule}") for column, rule in rules]
    return stream.observe(metric, F.count(F.lit(1)).alias("rows"), *counts)


class BatchReport(StreamingQueryListener):
    """Writes observed counts and rows dropped behind the watermark of every batch below ``path``.

    Rows dropped by a windowed aggregate are counted as Spark counts them, after
    rows of one window and key have been combined in their task.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}
        self.lock = threading.Lock()

    def event(self, run: str) -> threading.Event:
        with self.lock:
            return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = [(str(progress.id), progress.batchId, "batch", "rows", progress.numInputRows)]
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        rows.append((str(progress.id), progress.batchId, "batch", LATE, late))
        for metric, counts in progress.observedMetrics.items():
            rows += [(str(progress.id), progress.batchId, metric, k, int(v)) for k, v in counts.asDict().items()]
        made = self.spark.createDataFrame(rows, REPORT)
        made.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={progress.runId}/batch={progress.batchId}")

    def onQueryTerminated(self, event) -> None:
        self.event(str(event.runId)).set()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the last batch of an ended query is in the table."""
        if not self.event(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of run {query.runId} was reported")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """All reported counts."""
    return spark.read.schema(REPORT).option("recursiveFileLookup", "true").parquet(path)
