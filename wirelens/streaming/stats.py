"""Counters of a running stream, from metrics that Spark observes: lines of what each interval and the whole run had."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

NAME = "outcomes"
COUNTED = ["OBSERVED", "UNANSWERED", "UNMATCHED", "LATE"]


def observed(outcomes: DataFrame) -> DataFrame:
    """``outcomes`` as they are; each micro-batch counts them on the way."""
    return outcomes.observe(NAME, *[F.count_if(F.col("outcome") == c).alias(c.lower()) for c in COUNTED], F.count_if(F.col("rtt_valid") == 1).alias("rtt_valid"))


class Lines:
    """A line for each interval: its counts and those since the beginning."""

    def __init__(self):
        self.total: Counter[str] = Counter()

    def line(self, batch: int, metrics: dict[str, int]) -> str:
        self.total.update(metrics)
        return json.dumps({"batch": batch, "interval": metrics, "total": {k: self.total[k] for k in metrics}})


def lines(progress: Iterable, counted: Lines | None = None) -> Iterator[str]:
    """Lines of micro-batches from their progress, in order; those without counts (no data, other queries) have none."""
    counted = counted or Lines()
    for p in progress:
        metrics = p.observedMetrics.get(NAME)
        if metrics is not None:
            yield counted.line(p.batchId, metrics.asDict())


class StatsListener(StreamingQueryListener):
    """Writes lines while queries run: ``spark.streams.addListener(StatsListener(print))``. Each query's run has its own totals."""

    def __init__(self, write: Callable[[str], None]):
        self.write, self.runs = write, {}

    def onQueryStarted(self, event) -> None:
        self.runs[str(event.runId)] = Lines()

    def onQueryProgress(self, event) -> None:
        for line in lines([event.progress], self.runs.setdefault(str(event.progress.runId), Lines())):
            self.write(line)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.runs.pop(str(event.runId), None)
