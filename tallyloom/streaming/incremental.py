"""Exports that follow a growing source.

Projection and filters of the exports are row-local, so they run on a streaming frame as they are: no state, no
watermark, no shuffle. A cap needs the whole source and is not offered here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery


def start_jsonl_export(rows: DataFrame, path: str, checkpoint: str, *, available_now: bool = True) -> StreamingQuery:
    """Append passing rows of a streaming export frame to a JSONL folder, exactly once per source row.

    ``checkpoint`` must lie in a folder every executor can reach; the file sink's log there makes restarts safe.
    """
    writer = (
        rows.drop("pos")
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("ignoreNullFields", "false")
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
