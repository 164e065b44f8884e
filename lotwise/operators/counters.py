"""Counters of a run: row counts that stand in its plans and are read once these have run, so they need no job of their own.

A count is taken by the first action that runs the plan it stands in. Plans that stop early (limits) count what they have read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


def count(condition: Column | None) -> Column:
    return F.count(F.lit(1)) if condition is None else F.count_if(condition)


class Counters:
    """Named counts over several frames of a run."""

    def __init__(self) -> None:
        self.watched: list[Observation] = []

    def of(self, df: DataFrame, **counts: Column | None) -> DataFrame:
        """df that counts its rows under each name: all of them (None), or those for which a condition holds."""
        watch = Observation(f"counters-{uuid.uuid4().hex}")
        self.watched.append(watch)
        return df.observe(watch, *[count(c).alias(name) for name, c in counts.items()])

    def read(self) -> dict[str, int]:
        """All counts, in the order of their names' appearance. Waits until every frame has been run."""
        return {name: n for watch in self.watched for name, n in watch.get.items()}


class StreamCounters(StreamingQueryListener):
    """Counts of a stream, by what streaming_counts() has put into its plan; a batch that runs again counts once.

    Add it by spark.streams.addListener(). Streams that end in foreachBatch may run a batch's plan several times; count there
    with Counters.
    """

    def __init__(self) -> None:
        self.batches: dict[tuple[str, int], dict[str, int]] = {}

    def onQueryStarted(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            self.batches[name, event.progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def total(self, name: str) -> dict[str, int]:
        """Sums over the batches."""
        out: dict[str, int] = {}
        for (own, _), row in self.batches.items():
            if own == name:
                for k, v in row.items():
                    out[k] = out.get(k, 0) + v
        return out


def streaming_counts(stream: DataFrame, name: str, **counts: Column | None) -> DataFrame:
    """The stream with counts that StreamCounters reads under that name."""
    return stream.observe(name, *[count(c).alias(k) for k, c in counts.items()])
