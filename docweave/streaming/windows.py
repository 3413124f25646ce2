"""Event-time windows of streams: tumbling, sliding and sessions, under a watermark.

A window's row comes once, when the stream's time (the latest event less what may be late) has passed its end; state holds open
windows only. What comes later than that is dropped, and counted apart in the stream's progress (``late_rows``). Rows whose time
or name is null are dropped before: they belong to no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: The name of rows that only let time pass.
CLOCK = "_clock"


def spans(time: str, size: str, slide: str | None = None) -> Column:
    """Windows of one size, from epoch on (UTC); with ``slide`` one begins so often, and an event is in several."""
    return F.window(time, size, slide) if slide else F.window(time, size)


def sessions(time: str, gap: str) -> Column:
    """Windows of events with less than ``gap`` between them, up to a gap behind the last."""
    return F.session_window(time, gap)


def aggregated(stream: DataFrame, time: str, window: Column, name: str, late: str, *aggregates: Column) -> DataFrame:
    """(start, end, name, aggregates): a row per window and name."""
    known = stream.where(F.col(time).isNotNull() & F.col(name).isNotNull()).withWatermark(time, late)
    grouped = known.groupBy(window.alias("_w"), F.col(name).alias("name")).agg(*aggregates)
    rest = [c for c in grouped.columns if c not in ("_w", "name")]
    return grouped.select("_w.start", "_w.end", "name", *rest)


def finished(windows: DataFrame, to: str, checkpoint: str) -> StreamingQuery:
    """Write the windows that are closed by what has landed; the query has ended."""
    query = windows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(to)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows (sums of a batch's rows of one window, where Spark adds up first) that came too late, of the batches the query remembers."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])
