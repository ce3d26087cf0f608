"""Run-to-completion streaming queries."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start_drain(
    writer: DataStreamWriter, checkpoint: str, name: str | None = None
) -> StreamingQuery:
    """Start an append query that stops once it has read what was there at its start.

    The next run on the same checkpoint continues after it.
    """
    if name:
        writer = writer.queryName(name)
    return (
        writer.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark in this run, as far as the kept progress reports reach."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for report in _reports(query)
        for operator in report.get("stateOperators", [])
    )


def input_rows(query: StreamingQuery) -> int:
    return sum(report["numInputRows"] for report in _reports(query))


def _reports(query: StreamingQuery) -> list[dict]:
    return [report if isinstance(report, dict) else report.__dict__ for report in query.recentProgress]
