"""Streams of titles against a fixed vocabulary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import exact


def match_stream(titles: DataFrame, targets: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, **trigger: object) -> StreamingQuery:
    """Match each micro-batch of a stream with a title column exactly, then hand it to sink(frame, batch number).

    A batch is an ordinary frame, so the batch operators serve; the sink makes a batch idempotent by its number.
    """

    def each(batch: DataFrame, number: int) -> None:
        sink(batch.join(exact.match_titles_exact(batch, targets), "title", "left"), number)

    return titles.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
