"""Alert windows as streams, written to a folder as they close."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from docflow.operators import monitor


def _append(windows: DataFrame, path: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        windows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def error_rate_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 hour",
    threshold: float = 0.10,
    watermark: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Error-rate windows; a window is written once the watermark has passed its end."""
    return _append(
        monitor.error_rate_windows(events, width, threshold, watermark), path, checkpoint, trigger
    )


def rate_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    width: str = "1 minute",
    watermark: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Download counts per window. `monitor.fill_windows` and `monitor.sustained_breach` turn
    the written table into alerts: ordered windows over rows are not defined on streams."""
    return _append(monitor.rate_windows(events, width, watermark), path, checkpoint, trigger)
