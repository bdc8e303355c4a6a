"""Continuous form of the resumable stages: a stream of results merged into a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.resume import merge_last
from ..sources.files import read_table, write_table


def upsert_stream(stream: DataFrame, path: str, key: str | list[str], checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Merge every micro-batch into the table at path; of rows with equal keys the latest batch wins.

    Merging is idempotent for a repeated batch, so a restart after a failure gives the same table.
    """
    keys = [key] if isinstance(key, str) else key

    def merge(batch: DataFrame, number: int) -> None:
        new = batch.dropDuplicates(keys)
        old = read_table(batch.sparkSession, path)
        write_table(new if old is None else merge_last(old, new, keys), path)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
