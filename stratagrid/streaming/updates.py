"""Micro-batch updates with Structured Streaming: references and windowed statistics."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..sources import store

#: Partitions of the target that a batch may name for pruning; beyond, the whole target is read.
PARTITIONS = 10_000


def new_rows(batch: DataFrame, target: str, keys: list[str], prune: list[str] | None = None) -> DataFrame:
    """Rows of the batch whose keys the target table doesn't have yet, each once.

    prune: those of the keys that partition the target; only the partitions that the
    batch touches are then read (dynamic pruning by a semi join).
    """
    fresh = batch.dropDuplicates(keys)
    have = store.read(batch.sparkSession, target)
    if have is None:  # the first batch
        return fresh
    if prune:
        have = have.join(F.broadcast(batch.select(*prune).distinct().limit(PARTITIONS)), prune, "left_semi") if batch.select(*prune).distinct().limit(PARTITIONS + 1).count() <= PARTITIONS else have
    return fresh.join(have.select(*keys), keys, "left_anti")


def append_once(stream: DataFrame, target: str, checkpoint: str, keys: list[str], every: str | None = None) -> StreamingQuery:
    """Append each key once to the table at `target`, one commit a batch, none if it is empty.

    The table is the state: a batch that is run again after a failure adds nothing.
    Without `every` all that is available is taken and the query ends.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        rows = new_rows(batch, target, keys).withColumn("batch", F.lit(batch_id))
        if not rows.isEmpty():
            rows.write.mode("append").parquet(target)

    writer = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def append_within(stream: DataFrame, target: str, checkpoint: str, keys: list[str], at: str, window: str, every: str | None = None) -> StreamingQuery:
    """Append each key once to the table at `target`, knowing keys by state and not by reading the table.

    A key stands for one thing of one time `at`. What is less than `window` behind the
    newest time of the batches before the last one is accepted late; older rows are
    refused (Spark judges a batch by the watermark that the batch before it ran with), so
    a key's state may go once the watermark has passed it by `window`. Rows of null `at`
    are refused too. Spark's file sink logs which files a batch has committed: a batch that runs
    again after a failure adds nothing.
    """
    fresh = stream.where(F.col(at).isNotNull()).withWatermark(at, window).dropDuplicatesWithinWatermark(keys)
    writer = fresh.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


class Progress(StreamingQueryListener):
    """What the batches of streaming queries did, as rows: add it to `spark.streams` before a query starts."""

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = {name: json.dumps(row.asDict(), default=str) for name, row in (p.observedMetrics or {}).items()}
        self._rows.append((str(p.runId), p.name, p.batchId, p.numInputRows, p.batchDuration, seen))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended.setdefault(str(event.runId), threading.Event()).set()

    def rows(self, query: StreamingQuery, seconds: float = 30.0) -> DataFrame:
        """(run, name, batch, input_rows, milliseconds, observed) of an ended query; `observed` are its metrics by name, as JSON."""
        run = str(query.runId)
        if not self._ended.setdefault(run, threading.Event()).wait(seconds):
            raise TimeoutError(f"the end of run {run} was not reported")
        schema = "run string, name string, batch long, input_rows long, milliseconds long, observed map<string, string>"
        return SparkSession.active().createDataFrame([r for r in self._rows if r[0] == run], schema)


def read_files(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def windowed_stats(stream: DataFrame, time: str, keys: list[str], value: str, window: str = "1 hour", late: str = "20 hours") -> DataFrame:
    """Counts and sums per window and key; rows later than `late` behind the newest are dropped, as are closed windows."""
    g = stream.withWatermark(time, late).groupBy(F.window(time, window), *keys)
    return g.agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def deadline_reached(fired: int, now: int, limit: int, grace: int = 30) -> bool:
    """Whether an update that was fired at `fired` must stop: `limit` seconds less `grace` have gone."""
    return now >= fired + limit - grace


def pending(expected: DataFrame, published: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Work of one sweep: expected, not published yet, and listed by the source."""
    return expected.join(published.select(*keys), keys, "left_anti").join(listed.select(*keys).distinct(), keys, "left_semi")
