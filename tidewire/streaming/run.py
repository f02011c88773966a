"""Start streams: one checkpoint folder per query, an explicit trigger."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

# Fixed value: micro-batch interval.
INTERVAL = "5 seconds"


def start(
    writer: DataStreamWriter, checkpoint: str, available_now: bool = False, interval: str = INTERVAL
) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def drain(writer: DataStreamWriter, checkpoint: str, timeout: int | None = None) -> None:
    """Work off everything that has arrived, then stop."""
    _await(start(writer, checkpoint, available_now=True), timeout)


def drain_all(writers: dict[str, DataStreamWriter], timeout: int | None = None) -> None:
    """Several streams side by side, keyed by their own checkpoint folders."""
    running = [start(writer, folder, available_now=True) for folder, writer in writers.items()]
    for query in running:
        _await(query, timeout)


def _await(query: StreamingQuery, timeout: int | None) -> None:
    if query.awaitTermination(timeout) is False:
        query.stop()
        raise TimeoutError(f"stream {query.id} still running after {timeout} s")


def append_to(
    df: DataFrame, path: str, fmt: str = "parquet", partitions: Sequence[str] = ("event_day",)
) -> DataStreamWriter:
    """Append rows to a table partitioned by event day; Parquet files are packed well, as most are texts."""
    writer = df.writeStream.format(fmt).outputMode("append").partitionBy(*partitions).option("path", path)
    return writer.option("compression", "zstd") if fmt == "parquet" else writer


def each_batch(df: DataFrame, mode: str, write: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    return df.writeStream.outputMode(mode).foreachBatch(write)


def memory_table(df: DataFrame, name: str, mode: str = "update") -> DataStreamWriter:
    """Named in-memory result, for looking at small results while developing."""
    return df.writeStream.format("memory").queryName(name).outputMode(mode)
