"""Row-local steps on a streaming table.

The cascade itself has no event time, windows or state.  Range flags, rule matching, first
failures and lookups against a static table work on each row alone, so they accept a streaming
DataFrame as it is; survivors go to the stage table batch by batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

Step = Callable[[DataFrame], DataFrame]


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    for step in steps:
        df = step(df)
    return df


def write_stream(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append to a Parquet table, exactly once through the sink's log."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
