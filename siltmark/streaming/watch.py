"""Following a tree: Structured Streaming over a log of events, or over polled listings."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltmark.operators.changes import coalesce_changes, event_changes
from siltmark.schema import FS_EVENTS

log = logging.getLogger(__name__)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """File system events that arrive as JSON files in a folder."""
    return spark.readStream.schema(FS_EVENTS).option("maxFilesPerTrigger", 1000).json(folder)


def follow(events: DataFrame, root: str, apply: Callable[[DataFrame], None], checkpoint: str, seconds: float = 1.0, listing: Callable[[], DataFrame] | None = None, once: bool = False):
    """Starts a query that applies each micro-batch's changes, the last one of each path. Batches never overlap, and what arrives meanwhile waits for the next.

    A batch that fails is logged and lost, and the query lives on.
    """

    def batch(rows: DataFrame, number: int) -> None:
        changes = coalesce_changes(event_changes(rows, root, listing() if listing else None))
        try:
            if not changes.isEmpty():
                apply(changes)
        except Exception:
            log.exception("batch %s was not applied", number)

    writer = events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")).start()


def sessions(events: DataFrame, gap: str, late: str = "10 seconds") -> DataFrame:
    """A stream's quiet-separated batches, for replays: (start, end, n), emitted once the watermark has passed."""
    one = (F.length("event_type") * 0).alias("one")  # a stream's session windows need a key beside the window
    windowed = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), one).agg(F.count(F.lit(1)).alias("n"))
    return windowed.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
