"""One stream of wide rows to several sinks, and delivery that isolates what a receiver rejects."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wirelens.operators import delivery, project

#: A receiver's answer to a batch of lines: delivered, try again, or rejected.
DELIVERED, AGAIN, REJECTED = "delivered", "again", "rejected"
FIRST_WAIT, LONGEST_WAIT = 1.0, 30.0


def answer(status: int | None) -> str:
    """What an HTTP status (none: no connection) means: 429 and 5xx may pass, other errors never will."""
    if status is None or status == 429 or status >= 500:
        return AGAIN
    return DELIVERED if status < 400 else REJECTED


def deliver(lines: list[str], post: Callable[[list[str]], int | None], sleep: Callable[[float], None] = time.sleep) -> Iterator[str]:
    """Posts the lines and gives those that are rejected by themselves: a rejected batch is halved until they stand alone.

    What may pass later is tried again for ever, after 1 s and then twice as long each time, up to 30 s.
    """
    open_ = [lines] if lines else []
    while open_:
        batch, wait = open_.pop(), FIRST_WAIT
        while (said := answer(post(batch))) == AGAIN:
            sleep(wait)
            wait = min(LONGEST_WAIT, 2 * wait)
        if said == REJECTED and len(batch) == 1:
            yield batch[0]
        elif said == REJECTED:
            half = len(batch) // 2
            open_ += [batch[half:], batch[:half]]


def delivered(lines: DataFrame, post: Callable[[list[str]], int | None], size: int = 500) -> DataFrame:
    """Posts the column ``line``, ``size`` lines at a time in each task, and gives the lines that were rejected.

    A task that is run again posts its lines again: delivery is at least once.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            held = frame["line"].tolist()
            for k in range(0, len(held), size):
                yield pd.DataFrame({"line": list(deliver(held[k : k + size], post))}, dtype="object")

    return lines.select("line").mapInPandas(run, "line string")


def collector_sink(lines: DataFrame, post: Callable[[list[str]], int | None], folder: str, checkpoint: str) -> StreamingQuery:
    """A stream of lines to a collector. What it rejects is kept in ``folder``/batch=<n> before the batch counts as done."""

    def write(batch: DataFrame, n: int) -> None:
        kept = delivered(batch, post).select(F.lit("hec_rejected").alias("reason"), F.col("line").alias("payload"))
        kept.write.mode("overwrite").parquet(f"{folder}/batch={n}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def write_wide(rows: DataFrame, path: str) -> None:
    """Rows by day, within a day in the order of the table's key, which gives files narrow ranges to prune by."""
    dated = rows.withColumn("observed_date", F.substring("observed_time", 1, 10))
    dated.sortWithinPartitions("observed_date", "source_type", "observed_time", "event_id").write.mode("overwrite").partitionBy("observed_date").parquet(path)


def wide_sink(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """A stream of wide rows into ``folder/batch=<n>``: a batch that runs again replaces its own rows.

    Its own checkpoint makes it one consumer of the stream among others.
    """
    write = lambda batch, n: write_wide(batch, f"{folder}/batch={n}")
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def json_sink(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """The same rows as JSON lines."""
    bodies = project.row_json(rows).select(F.col("body").alias("value"))
    return bodies.writeStream.format("text").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dead_letter_sink(entries: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Entries that can't be decoded, kept before the batch counts as done."""
    letters = delivery.dead_letters(entries)
    return letters.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
